"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoweave.llm.common import Rounds

# So few edges (16 bytes each) are less work than one shuffle; a graph of more is never held by one task.
FEW_EDGES = 1 << 17


def components(edges: DataFrame, kept: list[Rounds] | None = None) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b); component is the smallest id reachable.

    A graph of at most ``FEW_EDGES`` distinct edges, which adaptive execution would give to one task
    anyway, is solved in that task; rounds would cost a dozen shuffles of next to nothing. Any larger one
    alternates large-star and small-star rounds (Kiveris et al., 2014) until nothing
    changes: each round points the larger neighbours of a node, then the node itself, to
    its smallest neighbour. All steps are partial aggregates and equi-joins, so a hub's
    edges are split like any skewed join. Rows with a null end are ignored; self-loops
    only name their node. Rounds are written to the shared folder, and the one before goes. What the result reads
    is added to ``kept``, so that a caller who is done with it can drop it.
    """
    spark = edges.sparkSession
    every, rounds = Rounds(spark), Rounds(spark)
    if kept is not None:
        kept += [every, rounds]
    edges = every.put(edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b").distinct())
    if edges.count() <= FEW_EDGES:
        return rounds.put(edges.coalesce(1).mapInArrow(_least_reachable, "id long, component long"))
    links = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    before = None
    while True:
        links = rounds.put(_small_star(_large_star(links)))
        now = tuple(
            links.agg(
                F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
            ).first()
        )
        if now == before:
            break
        before = now
    lone = edges.select(F.col("a").alias("id")).union(edges.select("b"))
    found = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return (
        found.union(lone.select("id", F.col("id").alias("component")))
        .groupBy("id")
        .agg(F.min("component").alias("component"))
    )


def _least_reachable(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, component) of a small graph's edges, by union-find with the smaller id on top."""
    above: dict[int, int] = {}

    def top(node: int) -> int:
        above.setdefault(node, node)
        while (up := above[node]) != node:
            above[node] = node = above[up]
        return node

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    columns = [pa.array(list(above), pa.int64()), pa.array([top(node) for node in above], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["id", "component"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    near = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

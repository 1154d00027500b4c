"""Nearest neighbours by an inverted multi-index.

Both halves of a vector have a codebook of their own, so ``codes`` centroids a half make
``codes`` squared cells. A query walks the cells by rising sum of its distances to the two centroids,
from a heap, until the cells hold the share of all vectors that the index was fitted to need. The
vectors of these cells are ranked by their exact distance.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermoweave.llm.common import cut, map_batches
from thermoweave.llm.egojoin import usable

SAMPLE = 16_384  # vectors that codebooks and share are fitted on, those of the smallest hashes
CODES = 64
RECALL = 0.97  # of the sample's neighbours that the walk must reach
QUERIES_A_BLOCK, VECTORS_A_BLOCK = 512, 2048


@dataclass
class Index:
    """Codebooks of the two halves, and the share of all vectors that a query's cells must hold."""

    first: np.ndarray
    second: np.ndarray
    share: float

    def halves(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the vectors' halves to the centroids."""
        at = self.first.shape[1]
        return _squares(v[:, :at], self.first), _squares(v[:, at:], self.second)

    def cells(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = self.halves(v)
        return near[0].argmin(axis=1), near[1].argmin(axis=1)

    def walk(self, near_1: np.ndarray, near_2: np.ndarray, sizes: np.ndarray, enough: float):
        """Cells by rising summed distance, until ``sizes`` of them add up to ``enough``."""
        rows, columns = np.argsort(near_1, kind="stable"), np.argsort(near_2, kind="stable")
        a, b = near_1[rows].tolist(), near_2[columns].tolist()
        rows, columns = rows.tolist(), columns.tolist()
        heap, reached, held = [(a[0] + b[0], 0, 0)], [0] * len(a), 0
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            reached[i] = j + 1
            held += sizes[rows[i]][columns[j]]
            yield rows[i], columns[j], held
            # A cell joins the heap once the cells before it in its row and column are out.
            if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if i + 1 < len(a) and reached[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * x @ y.T)


def _codebook(x: np.ndarray, codes: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's rounds from spread-out rows of ``x``; empty centroids keep their place."""
    centers = x[np.linspace(0, len(x) - 1, min(codes, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = _squares(x, centers).argmin(axis=1)
        count = np.bincount(own, minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, own, x)
        centers[count > 0] = total[count > 0] / count[count > 0, None]
    return centers


def fit(sample: np.ndarray, k: int, codes: int = CODES, recall: float = RECALL, probes: int = 256) -> Index:
    """Codebooks from the sample, and the share of it that finds ``recall`` of true neighbours."""
    half = sample.shape[1] // 2
    index = Index(_codebook(sample[:, :half], codes), _codebook(sample[:, half:], codes), 1.0)
    cell_1, cell_2 = index.cells(sample)
    sizes = np.zeros((len(index.first), len(index.second)), int)
    np.add.at(sizes, (cell_1, cell_2), 1)
    needed = []
    for q in sample[:probes]:
        true = np.argsort(_squares(q[None], sample)[0], kind="stable")[1 : k + 1]
        near = index.halves(q[None])
        at = {(i, j): held for i, j, held in index.walk(near[0][0], near[1][0], sizes.tolist(), len(sample))}
        needed += [at[cell_1[t], cell_2[t]] / len(sample) for t in true]
    if needed:
        index.share = float(np.quantile(needed, recall, method="higher"))
    return index


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` nearest of ``vectors``.

    Score is the Euclidean distance in double precision; nearest first, ties to the smaller id, all there
    are if fewer than ``k``. A query's own id is no neighbour of it. Vectors that are null, zero, hold
    null or non-finite components or have no id take no part. Neighbours are as long as the query: each length
    among the queries has an index of its own, so jobs grow with the number of lengths.
    ``queries`` has the columns of ``vectors`` and must be rows of it. Equal rows count once.

    Equal vectors are searched for once, and of each only the k + 1 smallest ids can matter.
    """
    narrow = lambda df: df.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")
    ).where(usable("v") & F.col("vec_id").isNotNull())
    good, asked = narrow(vectors), narrow(queries)
    schema = "query_id long, rank int, vec_id long, score double"
    found = None
    for (length,) in asked.select(F.size("v").alias("d")).distinct().orderBy("d").collect():
        own = [x.where(F.size("v") == length) for x in (good, asked)]
        if length == 1:  # an index needs two halves
            own = [x.withColumn("v", F.concat("v", F.array(F.lit(0.0)))) for x in own]
        one = _nearest(*own, k, sample)
        found = one if found is None else found.union(one)
    return vectors.sparkSession.createDataFrame([], schema) if found is None else found


def _nearest(good: DataFrame, asked: DataFrame, k: int, sample: int) -> DataFrame:
    """The rows of ``nearest`` for vectors (vec_id, v) of one length."""
    order = Window.partitionBy("v").orderBy("vec_id")
    distinct = (
        good.distinct().withColumn("n", F.row_number().over(order)).where(f"n <= {k + 1}")
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    some = good.distinct().orderBy(F.xxhash64("v"), "vec_id").limit(sample).select("v").collect()
    index = fit(_rows(some), k)

    def place(rows: dict) -> dict:
        v = np.array(rows["v"])
        first, second = index.cells(v)
        return {"ids": rows["ids"], "v": [x.tobytes() for x in v.astype("<f8")], "first": first, "second": second}

    members = cut(map_batches(distinct, place, "ids array<long>, v binary, first int, second int"))
    sizes = np.zeros((len(index.first), len(index.second)), np.int64)
    for i, j, n in members.groupBy("first", "second").count().collect():
        sizes[i, j] = n
    total, table, mask_bytes = int(sizes.sum()), sizes.tolist(), -(-sizes.shape[1] // 8)

    def walk(rows: dict) -> dict:
        v = np.array(rows["v"])
        near = index.halves(v)
        out: dict = {"query": [], "v": [], "stripe": [], "cells": []}
        for q in range(len(v)):
            visited: dict[int, int] = {}
            for i, j, _ in index.walk(near[0][q], near[1][q], table, index.share * total):
                visited[i] = visited.get(i, 0) | 1 << j
            for stripe, cells in visited.items():
                values = (rows["query"][q], v[q].tobytes(), stripe, cells.to_bytes(mask_bytes, "little"))
                for key, value in zip(out, values, strict=True):
                    out[key].append(value)
        return out

    leaders = asked.distinct().groupBy("v").agg(F.min("vec_id").alias("query"))
    n_queries = leaders.count()
    walked = map_batches(leaders.select("query", "v"), walk, "query long, v binary, stripe int, cells binary")
    query_chunks = max(1, -(-n_queries // QUERIES_A_BLOCK))
    vector_chunks = max(1, -(-int(sizes.sum(axis=1).max()) // VECTORS_A_BLOCK))
    query_blocks = walked.groupBy("stripe", F.pmod(F.xxhash64("query"), F.lit(query_chunks)).alias("part")).agg(
        F.collect_list("query").alias("queries"), F.collect_list("v").alias("qv"), F.collect_list("cells").alias("cells")
    ).drop("part")
    vector_blocks = (
        members.groupBy("first", F.pmod(F.xxhash64("v"), F.lit(vector_chunks)).alias("part"))
        .agg(F.collect_list(F.struct("ids", "v", "second")).alias("m"))
        .select(F.col("first").alias("stripe"), F.col("m.ids").alias("ids"), F.col("m.v").alias("mv"),
                F.col("m.second").alias("second"))
    )

    def rank(rows: dict) -> dict:
        out: dict = {"query": [], "vec_id": [], "score": []}
        for names, qv, cells, ids, mv, second in zip(
            *(rows[c] for c in ("queries", "qv", "cells", "ids", "mv", "second")), strict=True
        ):
            q, m = (np.frombuffer(b"".join(x), "<f8").reshape(len(x), -1) for x in (qv, mv))
            for name, found in zip(names, _best(q, m, cells, ids, np.array(second), k + 1), strict=True):
                for score, one in found:
                    out["query"].append(name)
                    out["vec_id"].append(one)
                    out["score"].append(score)
        return out

    pairs = query_blocks.join(vector_blocks, "stripe").select("queries", "qv", "cells", "ids", "mv", "second")
    ranked = map_batches(pairs, rank, "query long, vec_id long, score double")
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    top = ranked.withColumn("n", F.row_number().over(best)).where(f"n <= {k + 1}").drop("n")
    own = asked.distinct().join(leaders.select("v", "query"), "v").select(F.col("vec_id").alias("query_id"), "query")
    final = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    return (
        own.join(top, "query").where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(final)).where(f"rank <= {k}")
        .select("query_id", "rank", "vec_id", "score")
    )


def _rows(collected: list) -> np.ndarray:
    """Distinct vectors of a sample, in its order."""
    v = np.array([r[0] for r in collected])
    return v[np.sort(np.unique(v, axis=0, return_index=True)[1])]


def _best(q: np.ndarray, m: np.ndarray, cells: list, ids: list, second: np.ndarray, k: int):
    """For each query the ``k`` best (score, id) among the vectors in its cells."""
    rough = _squares(q, m)
    slack = 1e-9 * (1 + float((q * q).sum(axis=1).max()) + float((m * m).sum(axis=1).max()))
    for row, x, mask in zip(rough, q, cells, strict=True):
        bits = np.unpackbits(np.frombuffer(mask, np.uint8), bitorder="little").astype(bool)
        at = np.flatnonzero(bits[second])
        if len(at) > k:
            bound = np.partition(row[at], k - 1)[k - 1] + slack
            at = at[row[at] <= bound]
        exact = np.sqrt(((m[at] - x) ** 2).sum(axis=1)).tolist()
        yield sorted((s, one) for s, i in zip(exact, at.tolist(), strict=True) for one in ids[i])[:k]


def neighbour_report(embeddings: DataFrame) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return nearest(embeddings, embeddings.where(F.col("vec_id") % 100 == 0))

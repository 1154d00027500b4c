"""Embedding near-dedup by an epsilon grid order join.

Unit vectors are turned onto their principal axes, sorted by label and by the grid cells of the
leading axes, and cut into blocks, so that a block is an interval of the sequence. Sixteen
neighbouring intervals make a larger one, and so on up. The join starts with pairs of the largest intervals and
descends: a pair that is provably distant is dropped, one that is provably near is counted
as a whole, any other goes down to its parts. Only pairs of blocks that survive compare vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermoweave.llm.common import cut, map_batches
from thermoweave.llm.components import components

GRID_AXES = 6
BLOCK = 256
PART = 32  # rows of the smallest interval, within a block
FAN_BITS = 4
SLACK = 1e-7


def usable(vector: str) -> F.Column:
    """Not null, not empty, every component finite, at least one not zero."""
    return F.coalesce(
        F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
        & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def principal_axes(vectors: DataFrame) -> np.ndarray:
    """Orthonormal rows, by falling spread, from the second moments of all unit vectors.

    Tasks add up their own moments; the driver gets one square matrix.
    """

    def moments(rows: dict) -> dict:
        u = _units(rows["v"])
        return {"m": [(u.T @ u).ravel()]}

    parts = map_batches(vectors, moments, "m array<double>")
    total = parts.select(F.posexplode("m").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    size = int(round(len(total) ** 0.5))
    matrix = np.zeros(size * size)
    for i, x in total:
        matrix[i] = x
    matrix = matrix.reshape(size, size)
    return np.linalg.eigh((matrix + matrix.T) / 2)[1].T[::-1].copy()


def _units(vectors: list) -> np.ndarray:
    v = np.array(vectors, dtype=np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def linked_vectors(
    embeddings: DataFrame,
    min_cosine: float = 0.98,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id) per vector.

    Two vectors link when their labels are equal and not null, they are equally long and their cosine, in double
    precision, is at least ``min_cosine`` (above 0). Vectors that are null, zero, hold null or
    non-finite components or lack a label link with nothing. Equal rows are one vector; a row without an id
    has no component. Different vectors under one id are compared as vectors: ``n_links`` then counts pairs of rows.

    Lengths from one power of two to the next are joined in one run, filled up with zeros, with the length as part
    of the label; so a table of one length takes one run, any other at most one per power of two.

    Every pair within reach is compared: leaving one out takes proof. A dense group of any size costs
    no more than its intervals, as provably near intervals are counted without their vectors.
    """
    reach = float(np.sqrt(2 - 2 * min_cosine))
    rows = embeddings.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"),
        F.col(label).cast("string").alias("label"),
    )
    good = rows.where(usable("v") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    size_class = F.floor(F.log2(F.size("v")))
    classes = good.groupBy(size_class.alias("c")).agg(F.max(F.size("v")).alias("d")).orderBy("c").collect()
    alone = rows.select("vec_id").distinct().select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    if not classes:
        return alone
    links, edges = None, None
    for c, longest in classes:
        zeros = F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("v"))
        own = good.where(size_class == c).select(
            "vec_id", F.concat("v", zeros).alias("v"), F.concat_ws(":", F.size("v").cast("string"), "label").alias("label")
        )
        n, e = _linked(own, min_cosine, reach, block)
        links, edges = (n, e) if links is None else (links.union(n), edges.union(e))
    found = components(edges)
    links = links.groupBy("vec_id").agg(F.sum("n").cast("long").alias("n"))
    return (
        alone.select("vec_id")
        .join(links, "vec_id", "left")
        .join(found.withColumnRenamed("id", "vec_id"), "vec_id", "left")
        .select(
            "vec_id", F.coalesce("n", F.lit(0)).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )


def _linked(good: DataFrame, min_cosine: float, reach: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Links (vec_id, n) and edges (a, b) that connect what links, among vectors (vec_id, v, label) of one length."""
    axes = principal_axes(good.select("v"))
    blocks = cut(_numbered(_blocks(good, axes, reach, block)))
    top, levels = _levels(blocks)
    near, close = _descend(levels, top, reach)
    compared = cut(_compare(close, blocks, axes, min_cosine, reach))

    members = blocks.select("label", "node", F.explode("ids").alias("vec_id"))
    ancestors = members.select(
        "label", "vec_id", F.posexplode(F.array(*[F.shiftright("node", FAN_BITS * k) for k in range(top + 1)]))
        .alias("level", "g"),
    )
    both = near.select("level", "label", F.col("a").alias("g"), F.col("b").alias("h")).union(
        near.where("a <> b").select("level", "label", "b", "a")
    )
    whole = both.join(levels.select("level", "label", F.col("node").alias("h"), "size"), ["level", "label", "h"])
    whole = whole.groupBy("level", "label", "g").agg(
        F.sum(F.col("size") - F.when(F.col("g") == F.col("h"), 1).otherwise(0)).alias("n")
    )
    counted = cut(
        ancestors.join(whole, ["level", "label", "g"])
        .join(levels.select("level", "label", F.col("node").alias("g"), "first"), ["level", "label", "g"])
        .select("vec_id", "n", F.col("first").alias("other"))
    )
    firsts = levels.select("level", "label", "node", "first")
    bridges = (
        near.join(firsts.withColumnsRenamed({"node": "a", "first": "x"}), ["level", "label", "a"])
        .join(firsts.withColumnsRenamed({"node": "b", "first": "y"}), ["level", "label", "b"])
        .select("x", "y")
    )
    edges = (
        compared.select(F.col("vec_id").alias("a"), F.col("other").alias("b"))
        .union(counted.select("vec_id", "other"))
        .union(bridges)
    )
    return compared.select("vec_id", "n").union(counted.select("vec_id", "n")), edges


BLOCK_SCHEMA = (
    "shard long, number long, label string, ids array<long>, vectors binary, "
    "size long, first long, center array<double>, radius double, low array<double>, high array<double>"
)


def _blocks(good: DataFrame, axes: np.ndarray, reach: float, block: int) -> DataFrame:
    """The sorted sequence, cut at every label and every ``block`` vectors."""
    depth = min(GRID_AXES, len(axes))

    def cells(rows: dict) -> dict:
        grid = np.floor(_units(rows["v"]) @ axes[:depth].T / reach).astype(int)
        return {
            **{k: rows[k] for k in ("vec_id", "label")},
            **{f"c{k}": grid[:, k] for k in range(depth)},
            "v": [np.array(v, "<f8").tobytes() for v in rows["v"]],
        }

    grid_names = [f"c{k}" for k in range(depth)]
    schema = "vec_id long, label string, " + ", ".join(f"{c} long" for c in grid_names) + ", v binary"
    order = ["label", *grid_names, "vec_id", "v"]
    ordered = map_batches(good, cells, schema).repartitionByRange(*order).sortWithinPartitions(*order)

    def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        label, ids, vectors, last = None, [], [], None
        for batch in batches:
            out = []
            columns = (batch.column(n).to_pylist() for n in ("label", "vec_id", "v"))
            for own, vec_id, v in zip(*columns, strict=True):
                if (own, vec_id, v) == last:
                    continue
                last = (own, vec_id, v)
                if ids and (own != label or len(ids) == block):
                    out.append((shard, number, label, *_summary(ids, vectors, axes)))
                    number, ids, vectors = number + 1, [], []
                label = own
                ids.append(vec_id)
                vectors.append(v)
            yield _block_rows(out)
        if ids:
            yield _block_rows([(shard, number, label, *_summary(ids, vectors, axes))])

    return ordered.select("label", "vec_id", "v").mapInArrow(slices, BLOCK_SCHEMA)


def _summary(ids: list[int], vectors: list[bytes], axes: np.ndarray) -> tuple:
    packed = b"".join(vectors)
    u = _units(np.frombuffer(packed, "<f8").reshape(len(ids), -1)) @ axes.T
    center = u.mean(axis=0)
    radius = float(np.linalg.norm(u - center, axis=1).max())
    return ids, packed, len(ids), min(ids), center, radius, u.min(axis=0), u.max(axis=0)


def _block_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(),
             pa.list_(pa.float64()), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names
    )


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with their number in the whole sequence, ``node``."""
    blocks = cut(blocks)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.groupBy("shard").agg(F.count("*").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    return blocks.join(offsets, "shard").withColumn("node", F.col("offset") + F.col("number")).drop(
        "shard", "number", "offset"
    )


def _levels(blocks: DataFrame) -> tuple[int, DataFrame]:
    """The number of the top level, and the intervals of all levels with their bounds."""
    last = blocks.agg(F.max("node")).first()[0]
    top = 0
    while last >> (FAN_BITS * top) >= 1 << FAN_BITS:
        top += 1
    bounds = ["size", "first", "center", "radius", "low", "high"]
    level = blocks.select(F.lit(0).alias("level"), "label", "node", *bounds)
    levels = [level]
    schema = (
        "level int, label string, node long, size long, first long, center array<double>, radius double, "
        "low array<double>, high array<double>"
    )

    def merge(t: pa.Table) -> pa.Table:
        rows = t.to_pydict()
        size = np.array(rows["size"], float)
        centers = np.array(rows["center"])
        center = (centers * size[:, None]).sum(axis=0) / size.sum()
        radius = float((np.linalg.norm(centers - center, axis=1) + np.array(rows["radius"])).max())
        values = {
            "level": [rows["level"][0] + 1], "label": [rows["label"][0]], "node": [rows["node"][0] >> FAN_BITS],
            "size": [int(size.sum())], "first": [min(rows["first"])], "center": [center.tolist()],
            "radius": [radius], "low": [np.min(rows["low"], axis=0).tolist()],
            "high": [np.max(rows["high"], axis=0).tolist()],
        }
        return pa.table(values, schema=t.schema)

    for _ in range(top):
        grouped = level.groupBy("label", F.shiftright("node", FAN_BITS))
        level = grouped.applyInArrow(merge, schema)
        levels.append(level)
    every = levels[0]
    for one in levels[1:]:
        every = every.union(one)
    return top, cut(every)


def _descend(levels: DataFrame, top: int, reach: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a <= b) of intervals that are near as a whole, and pairs of blocks left to compare."""

    def judge(rows: dict) -> dict:
        ca, cb, la, ha, lb, hb = (np.array(rows[k]) for k in ("ca", "cb", "la", "ha", "lb", "hb"))
        between = np.linalg.norm(ca - cb, axis=1)
        radii = np.array(rows["ra"]) + np.array(rows["rb"])
        gaps = np.maximum(0, np.maximum(lb - ha, la - hb))
        apart = np.maximum(between - radii, np.linalg.norm(gaps, axis=1))
        verdict = np.where(apart > reach + SLACK, 0, np.where(between + radii < reach - SLACK, 2, 1))
        keep = verdict > 0
        return {
            **{k: [x for x, y in zip(rows[k], keep, strict=True) if y] for k in ("label", "a", "b")},
            "verdict": verdict[keep],
        }

    names = {"node": "a", "center": "ca", "radius": "ra", "low": "la", "high": "ha"}
    near, pairs = [], None
    for depth in range(top, -1, -1):
        level = levels.where(F.col("level") == depth).select("label", *names)
        left = level.withColumnsRenamed(names)
        right = level.withColumnsRenamed({k: f"{v[:-1]}b" for k, v in names.items()})
        if pairs is None:
            joined = left.join(right, "label").where("a <= b")
        else:
            up = lambda side: F.shiftright(side, FAN_BITS)
            joined = (
                pairs.withColumnsRenamed({"a": "pa", "b": "pb"})
                .join(left.withColumn("pa", up("a")), ["label", "pa"])
                .join(right.withColumn("pb", up("b")), ["label", "pb"])
                .where("a <= b")
            )
        judged = cut(
            map_batches(
                joined.select("label", "a", "b", "ca", "cb", "ra", "rb", "la", "ha", "lb", "hb"),
                judge, "label string, a long, b long, verdict long",
            )
        )
        near.append(judged.where("verdict = 2").select(F.lit(depth).alias("level"), "label", "a", "b"))
        pairs = judged.where("verdict = 1").select("label", "a", "b")
    every = near[0]
    for one in near[1:]:
        every = every.union(one)
    return every, pairs


def _compare(pairs: DataFrame, blocks: DataFrame, axes: np.ndarray, min_cosine: float, reach: float) -> DataFrame:
    """(vec_id, n, other): links of a vector within a pair of blocks, and one vector it is connected to."""

    def compare(rows: dict) -> dict:
        out: list[tuple[int, int, int]] = []
        for a, b, ia, ib, va, vb in zip(*(rows[k] for k in ("a", "b", "ia", "ib", "va", "vb")), strict=True):
            left = np.frombuffer(va, "<f8").reshape(len(ia), -1)
            right = np.frombuffer(vb, "<f8").reshape(len(ib), -1)
            out += block_links(np.array(ia), np.array(ib), left, right, a == b, axes, min_cosine, reach)
        return {k: [r[i] for r in out] for i, k in enumerate(("vec_id", "n", "other"))}

    left = blocks.select(F.col("node").alias("a"), "label", F.col("ids").alias("ia"), F.col("vectors").alias("va"))
    right = blocks.select(F.col("node").alias("b"), "label", F.col("ids").alias("ib"), F.col("vectors").alias("vb"))
    joined = pairs.join(left, ["label", "a"]).join(right, ["label", "b"])
    return map_batches(joined.select("a", "b", "ia", "ib", "va", "vb"), compare, "vec_id long, n long, other long")


def block_links(
    ia: np.ndarray, ib: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool,
    axes: np.ndarray, min_cosine: float, reach: float,
) -> list[tuple[int, int, int]]:
    """Per vector with links: its id, how many, and the smallest id it is connected to here.

    Intervals of ``PART`` vectors are the last level: only those with touching boxes are multiplied.
    """
    ua, ub = _units(left), _units(right)
    starts_a, starts_b = np.arange(0, len(ua), PART), np.arange(0, len(ub), PART)
    ta, tb = ua @ axes.T, ub @ axes.T
    low_a, high_a = np.minimum.reduceat(ta, starts_a), np.maximum.reduceat(ta, starts_a)
    low_b, high_b = np.minimum.reduceat(tb, starts_b), np.maximum.reduceat(tb, starts_b)
    gaps = np.maximum(0, np.maximum(low_b[None] - high_a[:, None], low_a[:, None] - high_b[None]))
    touching = np.linalg.norm(gaps, axis=2) <= reach + SLACK
    i_found, j_found = [], []
    for p, start in enumerate(starts_a):
        parts = np.flatnonzero(touching[p])
        if same:
            parts = parts[parts >= p]
        if not len(parts):
            continue
        columns = np.concatenate([np.arange(starts_b[q], min(starts_b[q] + PART, len(ub))) for q in parts])
        cosine = ua[start : start + PART] @ ub[columns].T
        i, j = np.nonzero(cosine >= min_cosine - 1e-12)
        values = cosine[i, j]
        i, j = i + start, columns[j]
        sure = values > min_cosine + 1e-12
        for k in np.flatnonzero(~sure):
            x, y = left[i[k]], right[j[k]]
            sure[k] = x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= min_cosine
        if same:
            sure &= i < j
        i_found.append(i[sure])
        j_found.append(j[sure])
    i, j = (np.concatenate(x) if x else np.empty(0, int) for x in (i_found, j_found))
    if not len(i):
        return []
    offset = 0 if same else len(ia)
    ids = ia if same else np.concatenate([ia, ib])
    n = np.bincount(i, minlength=len(ids)) + np.bincount(j + offset, minlength=len(ids))
    lowest = ids.copy()
    while True:
        least = np.minimum(lowest[i], lowest[j + offset])
        new = lowest.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j + offset, least)
        if (new == lowest).all():
            break
        lowest = new
    some = np.flatnonzero(n)
    return list(zip(ids[some].tolist(), n[some].tolist(), lowest[some].tolist(), strict=True))


def near_vector_report(embeddings: DataFrame) -> DataFrame:
    """Per vector: links, component, and whether it stays."""
    return linked_vectors(embeddings).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


REPORT_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98
), walk AS (
  SELECT vec_id AS id, vec_id AS reached FROM embeddings
  UNION SELECT w.id, l.b FROM walk w JOIN links l ON w.reached = l.a
), lowest AS (SELECT id, min(reached) AS c FROM walk GROUP BY id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, c AS component_id, e.vec_id = c AS kept
FROM (SELECT DISTINCT vec_id FROM embeddings) e JOIN lowest ON id = e.vec_id LEFT JOIN counts ON a = e.vec_id
"""

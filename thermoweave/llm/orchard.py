"""Vector codes from one codebook per part, whose nearest entries are found by Orchard's search.

Every codebook entry has the list of all entries by rising distance to it. A search holds the best
entry so far and walks its list; a better entry is jumped to and its list walked from the start.
What was looked at is marked. Beyond twice the distance to the best entry nothing in the list can be
nearer, so the search stops there. Components are whole numbers, so every distance is exact and ties
are real ones: they go to the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermoweave.llm.common import cut

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 60  # a component beyond it counts as it; sums of 2^60 such rows fit decimal(38)
ROWS_AT_ONCE = 4096


@dataclass
class Codebook:
    """Entries (entries, width) of one part, with the lists of Orchard's search."""

    entries: np.ndarray
    order: np.ndarray
    gaps: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Codebook:
        gaps = _squares(entries[:, None], entries[None])
        first = gaps.copy()
        np.fill_diagonal(first, -1)  # an entry leads its own list, whatever equals it
        order = np.argsort(first, axis=1, kind="stable")
        return cls(entries, order, np.take_along_axis(gaps, order, axis=1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry, for all rows of ``x`` side by side."""
        best_at = np.zeros(len(x), np.int64)
        best = _squares(x, self.entries[:1])
        step = np.ones(len(x), np.int64)  # next place in the list of the best entry
        seen = np.zeros((len(x), len(self.entries)), bool)
        seen[:, 0] = True
        walking = np.arange(len(x))
        while True:
            walking = walking[step[walking] < len(self.entries)]
            # Twice the distance, in squares; an entry exactly there may tie.
            walking = walking[self.gaps[best_at[walking], step[walking]] <= 4 * best[walking]]
            if not len(walking):
                return best_at, best
            entry = self.order[best_at[walking], step[walking]]
            step[walking] += 1
            fresh = ~seen[walking, entry]
            row, entry = walking[fresh], entry[fresh]
            seen[row, entry] = True
            d = _squares(x[row], self.entries[entry])
            better = (d < best[row]) | ((d == best[row]) & (entry < best_at[row]))
            row = row[better]
            best_at[row], best[row], step[row] = entry[better], d[better], 1


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return ((x - y) ** 2).sum(axis=-1)


def finite(vector: str) -> Column:
    """The vector and all its components are there and finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~odd


def _scaled(x: np.ndarray, parts: int, scale: int) -> np.ndarray:
    """Whole-number components (rows, parts, width); a length that does not divide is filled up with zeros.

    64-bit numbers where all sums of squares fit them, Python's otherwise.
    """
    width = -(-x.shape[1] // parts)
    with np.errstate(over="ignore"):
        whole = np.floor(np.clip(x * float(scale), -LARGEST, LARGEST)).astype(np.int64)
    whole = np.pad(whole, ((0, 0), (0, width * parts - x.shape[1]))).reshape(len(x), parts, width)
    return whole


def _fitting(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as they are, or with Python's numbers if squares could pass 64 bits."""
    top = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    width = max(a.shape[-1] * a.shape[-2] for a in arrays)
    if 16 * (width + 1) * (top + 1) ** 2 < 1 << 62:
        return list(arrays)
    return [a.astype(object) for a in arrays]


def _lengths(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of a batch with vectors of one length, as (rows, matrix)."""
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        piece = batch.slice(start, ROWS_AT_ONCE)
        sizes = piece.column("v").value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            rows = piece if (sizes == size).all() else piece.filter(pa.array(sizes == size))
            yield rows, rows.column("v").flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, int(size))


class _Search:
    """Codebooks of every vector length, as tasks use them."""

    def __init__(self, books: dict[int, np.ndarray], parts: int, scale: int) -> None:
        self.books, self.parts, self.scale = books, parts, scale
        self.ready: dict[tuple[int, bool], list[Codebook]] = {}

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Components, indexes and squared distances, each (rows, parts, ...)."""
        entries = self.books[x.shape[1]]
        whole, entries = _fitting(_scaled(x, self.parts, self.scale), entries)
        key = (x.shape[1], entries.dtype == object)
        if key not in self.ready:
            self.ready[key] = [Codebook.of(e) for e in entries]
        found = [book.nearest(whole[:, p]) for p, book in enumerate(self.ready[key])]
        return whole, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _start(kept: DataFrame, parts: int, entries: int, scale: int) -> dict[int, np.ndarray]:
    """Per length the codebooks (parts, entries, width) made of the vectors of its smallest ids."""
    low = Window.partitionBy("d").orderBy(F.asc_nulls_last("vec_id"))
    ids = (
        kept.select(F.size("v").alias("d"), "vec_id")
        .withColumn("n", F.dense_rank().over(low)).where(F.col("n") <= entries)
        .distinct()
    )
    same = (F.size("v") == F.col("ids.d")) & F.col("k.vec_id").eqNullSafe(F.col("ids.vec_id"))
    # ``entries`` rows for each vector length: bounded by the longest vector.
    rows = (
        kept.alias("k").join(F.broadcast(ids.alias("ids")), same)
        .groupBy("ids.d", "ids.n").agg(F.min("k.v").alias("v")).orderBy("d", "n").collect()
    )
    books: dict[int, list] = {}
    for r in rows:
        books.setdefault(r["d"], []).append(r["v"])
    return {d: _scaled(np.array(v, float).reshape(len(v), d), parts, scale).transpose(1, 0, 2) for d, v in books.items()}


def _moved(kept: DataFrame, books: dict[int, np.ndarray], parts: int, scale: int) -> dict[int, np.ndarray]:
    """Every entry replaced by the floored mean of the parts it is nearest to; unused ones stay."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(books, parts, scale)
        totals: dict[int, np.ndarray] = {d: np.zeros(b.shape, object) for d, b in books.items()}
        counts: dict[int, np.ndarray] = {d: np.zeros(b.shape[:2], np.int64) for d, b in books.items()}
        for batch in batches:
            for _, x in _lengths(batch):
                whole, codes, _ = search(x)
                d = x.shape[1]
                for part in range(parts):
                    for entry in np.unique(codes[:, part]):
                        own = whole[codes[:, part] == entry, part]
                        small = own.dtype != object and len(own) * int(np.abs(own).max(initial=0)) < 1 << 62
                        totals[d][part, entry] += (own if small else own.astype(object)).sum(axis=0).astype(object)
                        counts[d][part, entry] += len(own)
        out: dict[str, list] = {f.name: [] for f in _SUMS}
        for d, n in counts.items():
            for part, entry in zip(*np.nonzero(n), strict=True):
                for place, total in enumerate(totals[d][part, entry]):
                    row = (d, part, entry, place, str(total), n[part, entry])
                    for column, value in zip(out.values(), row, strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_pydict(out, schema=_SUMS)

    sums = kept.select("v").mapInArrow(partial, "d int, part int, entry int, place int, total string, n long")
    new = {d: b.copy() for d, b in books.items()}
    where = ("d", "part", "entry", "place")
    folded = sums.groupBy(*where).agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    for r in folded.collect():  # one row per number of the codebooks
        new[r["d"]][r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return new


_SUMS = pa.schema(
    [("d", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.string()), ("n", pa.int64())]
)


def fit(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    vector: str = "embedding", vec_id: str = "vec_id",
) -> dict[int, np.ndarray]:
    """Codebooks (parts, entries, width) per vector length, after ``rounds`` rounds over all vectors.

    Rounds are jobs over the whole table; what comes back is sums per codebook number.
    """
    kept = _kept(vectors, vector, vec_id)
    books = _start(kept, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = _moved(kept, books, parts, scale)
    return books


def _kept(vectors: DataFrame, vector: str, vec_id: str, *more: Column) -> DataFrame:
    slim = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), *more)
    return slim.where(finite("v"))


def encode(
    vectors: DataFrame, books: dict[int, np.ndarray], scale: int = SCALE,
    vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of every vector that is there and finite.

    ``code`` has two hex digits per part; more than 256 entries take four. ``error`` is null where it
    passes a long. Vectors of different lengths have codebooks of their own, and a length that the parts
    do not divide is filled up with zeros. Rows without an id or a label are coded like others, repeated
    rows each by themselves; a component beyond 2^60 / ``scale`` counts as that.
    """
    digits = 2 if all(b.shape[1] <= 256 for b in books.values()) else 4
    digest = {d: hashlib.sha256(",".join(map(str, b.ravel().tolist())).encode()).hexdigest() for d, b in books.items()}
    parts = next((b.shape[0] for b in books.values()), PARTS)
    kept = _kept(vectors, vector, vec_id, F.col(label).alias("label"))
    target = pa.schema(
        [("code", pa.string()), ("error", pa.int64()), ("codebooks_sha256", pa.string())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(books, parts, scale)
        for batch in batches:
            for rows, x in _lengths(batch):
                _, codes, squares = search(x)
                error = [e if e < 1 << 63 else None for e in squares.sum(axis=1).tolist()]
                text = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
                new = [text, error, [digest[x.shape[1]]] * len(text)]
                columns = [pa.array(v, f.type) for v, f in zip(new, target, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("label"), *columns], names=["vec_id", "label", *target.names]
                )

    kind = kept.schema["label"].dataType.simpleString()
    return kept.mapInArrow(run, f"vec_id long, label {kind}, code string, error long, codebooks_sha256 string")


def code_report(embeddings: DataFrame) -> DataFrame:
    """Codes of all vectors with the error of each and of its label's vectors together; empty tables give no rows."""
    coded = cut(encode(embeddings, fit(embeddings)))
    whole = F.count(F.lit(1)) == F.count("error")
    sums = coded.groupBy(F.col("label").alias("l")).agg(F.when(whole, F.try_sum("error")).alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("l"))).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )


def _report_sql(rounds: int = ROUNDS) -> str:
    assign = """a{k} AS MATERIALIZED (SELECT r, part, min(d * 16 + e) AS m FROM (
        SELECT x.r, x.part, b.e, sum((x.x - b.x) * (x.x - b.x))::BIGINT AS d
        FROM x JOIN b{k} b ON x.part = b.part AND x.i = b.i GROUP BY ALL) GROUP BY ALL)"""
    move = """b{n} AS MATERIALIZED (SELECT b.part, b.e, b.i, coalesce(c.x, b.x) AS x FROM b{k} b LEFT JOIN (
        SELECT part, e, i, (s - ((s % n) + n) % n) // n AS x FROM (
          SELECT x.part, a.m % 16 AS e, x.i, sum(x.x)::BIGINT AS s, count(*) AS n
          FROM x JOIN a{k} a ON a.r = x.r AND a.part = x.part GROUP BY ALL)) c
        ON c.part = b.part AND c.e = b.e AND c.i = b.i)"""
    steps = [assign.format(k=0)]
    for k in range(rounds):
        steps += [move.format(k=k, n=k + 1), assign.format(k=k + 1)]
    return f"""
WITH good AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
places AS (SELECT r, vec_id, embedding, unnest(range(len(embedding))) AS p, len(embedding) // {PARTS} AS w FROM good),
x AS MATERIALIZED (
  SELECT r, p // w AS part, p % w AS i, floor({SCALE} * embedding[p + 1]::DOUBLE)::BIGINT AS x FROM places),
b0 AS MATERIALIZED (
  SELECT x.part, s.e, x.i, x.x FROM x JOIN (
    SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM good ORDER BY vec_id LIMIT {ENTRIES}) s USING (r)),
{", ".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', m % 16), '' ORDER BY part) AS code, sum(m // 16)::BIGINT AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, e, i)) FROM b{rounds}) AS codebooks_sha256
FROM good JOIN coded USING (r)
"""


REPORT_SQL = _report_sql()

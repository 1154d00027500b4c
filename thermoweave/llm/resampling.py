"""Importance resampling of documents towards a target, on hashed word runs.

The tokenizers library's Split, an untrained pre-tokeniser, cuts ASCII-lowered text into words and says where each
lies. Runs of neighbouring words, in the order of their offset pairs, are features, hashed into buckets. A
bucket's gain is how much more common it is in the target; a document's weight is its mean gain, and
documents are drawn by weight plus noise that depends on the document alone.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoweave.llm.common import cut, written
from thermoweave.llm.order import numbered

# Fixed: what a word is made of, after A-Z are lowered.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, RUN, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
CACHED_WORDS = 500_000
CHUNK = 1 << 20  # bytes that are cut into words at once


class Features:
    """Bucket numbers of all runs of 1 to ``run`` words of texts."""

    def __init__(self, run: int = RUN, buckets: int = BUCKETS) -> None:
        from tokenizers import PreTokenizedString, Regex, pre_tokenizers

        self.run, self.buckets, self.string = run, buckets, PreTokenizedString
        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self.single = _Buckets(buckets)
        self.kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def words(self, text: str) -> Iterator[list[tuple[str, tuple[int, int], None]]]:
        """Words with byte offsets in the lowered text, chunk by chunk: a long text is cut at a sign between words."""
        lowered = text.encode().lower()  # of bytes, lower() changes A-Z alone
        at = 0
        while at < len(lowered):
            end = _between_words(lowered, at + CHUNK)
            cut_out = self.string(lowered[at:end].decode())
            self.split.pre_tokenize(cut_out)
            yield cut_out.get_splits("original", "byte")
            at = end

    def __call__(self, text: str) -> tuple[int, bytes]:
        """Number of words, and the buckets as little-endian numbers, runs of one length after another."""
        found = [array("I") for _ in range(self.run)]
        held: list[int] = []  # checksums of the runs that end with the word before, shortest first
        for chunk in self.words(text):
            found[0].extend([self.single[word] for word, _, _ in chunk])
            if self.run > 1:
                for word, _, _ in chunk:
                    raw = word.encode()
                    joined = b" " + raw
                    held = [zlib.crc32(raw), *(zlib.crc32(joined, before) for before in held[: self.run - 1])]
                    for length, checksum in enumerate(held[1:], 1):
                        found[length].append(checksum % self.buckets)
        every = np.concatenate([np.frombuffer(f, np.uint32) for f in found])
        return len(found[0]), every.astype(self.kind).tobytes()


class _Buckets(dict):
    """Bucket of a word; what finds no room is hashed again."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> int:
        bucket = zlib.crc32(word.encode()) % self.buckets
        if len(self) < CACHED_WORDS and len(word) < 64:
            self[word] = bucket
        return bucket


def _between_words(text: bytes, at: int) -> int:
    """The first place from ``at`` behind a byte that no word holds, or the end."""
    while at < len(text):
        b = text[at - 1]
        if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F:
            return at
        at += 1
    return len(text)


def bucketed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, buckets) of whole texts; a null or wordless text has none. Repeated rows stay, ids may be null."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.binary())])

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(run, buckets)
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column("text")]
            columns = [batch.column("doc_id"), [n for n, _ in found], [b for _, b in found]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return slim.mapInArrow(hashed, "doc_id long, n_words long, buckets binary")


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows. Tasks add up their own; the driver sees one number per bucket."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column("buckets"):
                total += np.bincount(np.frombuffer(row.as_buffer(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counts = features.select("buckets").mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of smoothed bucket shares, target over corpus."""
    s_all, t_all, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
            for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist(), strict=True)
        ],
        np.int64,
    )


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of each row's features, 0 without any."""
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [gain[np.frombuffer(row.as_buffer(), kind)] for row in batch.column("buckets")]
            means = [int(g.sum()) // len(g) if len(g) else 0 for g in own]
            columns = [batch.column("doc_id"), batch.column("n_words"), [len(g) for g in own], means]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return features.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Whole thousandths of a Gumbel draw that depends on the seed and the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    h = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED, text: str = "text", doc_id: str = "doc_id", target_id: str = "item_id",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    Of the N rows with an id and ``least_words`` words or more, ``percent`` in a hundred (floored) are drawn: those of the
    highest scores, ties to the smaller id; ``rank`` counts them from 1 and is null elsewhere. A null text has no
    features and weight 0. Rows without an id have no score and are never drawn. Equal rows are ranked next to
    each other. With an empty target or corpus the counts are zero and all else holds.

    Texts are cut into words once; their bucket numbers are kept, two bytes a word.
    """
    features = written(bucketed(docs, text, doc_id, run, buckets))
    sought = bucketed(target, text, target_id, run, buckets)
    gain = gains(histogram(features, buckets), histogram(sought, buckets))
    scored = weighed(features, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = cut(scored.withColumns({"__down": -F.col("score"), "__row": F.monotonically_increasing_id()}))
    able = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    drawn = scored.where(able).count() * percent // 100
    ranked = numbered(scored.where(able), ["__down", "doc_id", "__row"], "__rank").withColumn(
        "rank", F.when(F.col("__rank") <= drawn, F.col("__rank")).cast("long")
    )
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(columns).unionByName(
        scored.where(~able).withColumn("rank", F.lit(None).cast("long")).select(columns)
    )


def resampling_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents drawn towards the texts of ``benchmark``."""
    return resample(documents, benchmark)


def _words_sql(text: str) -> str:
    low, high = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{high}', '{low}'), '{WORD}')"


# CRC-32 step by step: the table of one byte's changes from the polynomial, then a fold over a word's bytes.
REPORT_SQL = f"""
WITH steps AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)) AS t),
doc_words AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_words_sql("text")} AS w FROM documents),
own AS (SELECT r, unnest(w) AS w FROM doc_words),
sought AS (SELECT unnest({_words_sql("text")}) AS w FROM benchmark),
vocabulary AS (SELECT DISTINCT w FROM (SELECT w FROM own UNION ALL SELECT w FROM sought)),
spelled AS (
  SELECT w, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS b
  FROM vocabulary),
hashed AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])),
                4294967295::BIGINT) % {BUCKETS} AS bucket
  FROM spelled, steps),
s AS (SELECT bucket, count(*) AS n FROM own JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM sought JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM own)::DOUBLE AS s, (SELECT count(*) FROM sought)::DOUBLE AS t),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (totals.s + {BUCKETS})
                                 / ((s.n::DOUBLE + 1) * (totals.t + {BUCKETS}))))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket), totals),
means AS (
  SELECT r, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
  FROM own JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('{SEED}:' || doc_id::VARCHAR), 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296::DOUBLE)))::BIGINT AS score
  FROM doc_words LEFT JOIN means USING (r)),
able AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS n FROM scored WHERE n_features >= {LEAST_WORDS} AND doc_id IS NOT NULL)
SELECT doc_id, n_features, weight, score, CASE WHEN n <= (SELECT count(*) FROM able) * {PERCENT} // 100 THEN n END AS rank
FROM scored LEFT JOIN able USING (r)
"""

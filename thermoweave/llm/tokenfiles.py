"""Token-id files: range-coded, checksummed blocks in document order."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thermoweave.llm import coder
from thermoweave.llm.common import map_batches, sliced
from thermoweave.llm.tokens import encoder
from thermoweave.session import new_path

TEXTS = 4096  # encoded together
FILE_SCHEMA = (
    "shard long, block long, start long, docs array<long>, ordinals array<long>, "
    "lengths array<long>, checksum long, payload binary"
)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 1,
    text: str = "text",
    doc_id: str = "doc_id",
) -> None:
    """Write the ids of every whole text, then ``end_id``, in ascending doc_id order.

    The files at ``path`` are Parquet shards; shards follow each other by number, blocks
    within a shard by number. A block holds at most ``coder.BLOCK`` ids, coded from a fresh
    model, their CRC-32, its place in the shard, and which documents its ids belong to
    (``docs``, ``ordinals`` within the shard, ``lengths``).
    A null text is the end id alone; null ids come first; rows that repeat an id follow each other.
    """

    def shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).many, end_id.to_bytes(4, "little")
        number, rows, start, ordinal = TaskContext.get().partitionId(), _Rows(), 0, 0
        held, parts = b"", []  # ids of the open block and the documents they belong to
        for batch in sliced(batches, TEXTS):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                ids, done = ids + end, 0
                while done < len(ids):
                    part = min(len(ids) - done, 4 * coder.BLOCK - len(held))
                    held += ids[done : done + part]
                    done += part
                    parts.append((doc, ordinal, part // 4))
                    if len(held) == 4 * coder.BLOCK:
                        rows.add(start, held, parts)
                        start, held, parts = start + coder.BLOCK, b"", []
                        if len(rows.blocks) == coder.LANES:
                            yield rows.flush(number)
                ordinal += 1
        if held:
            rows.add(start, held, parts)
        if rows.blocks:
            yield rows.flush(number)

    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(shard, FILE_SCHEMA).write.option("compression", "none").parquet(path)


class _Rows:
    """Blocks that wait until enough of them can be coded side by side."""

    def __init__(self) -> None:
        self.blocks: list[tuple[int, np.ndarray, list]] = []
        self.sent = 0

    def add(self, start: int, ids: bytes, parts: list) -> None:
        self.blocks.append((start, np.frombuffer(ids, "<u4"), parts))

    def flush(self, shard: int) -> pa.RecordBatch:
        blocks, self.blocks = self.blocks, []
        payloads = coder.encode([b[1] for b in blocks])
        columns = [
            pa.array([shard] * len(blocks), pa.int64()),
            pa.array(range(self.sent, self.sent + len(blocks)), pa.int64()),
            pa.array([b[0] for b in blocks], pa.int64()),
            *(pa.array([[p[k] for p in b[2]] for b in blocks], pa.list_(pa.int64())) for k in range(3)),
            pa.array([coder.checksum(b[1]) for b in blocks], pa.int64()),
            pa.array(payloads, pa.binary()),
        ]
        self.sent += len(blocks)
        names = ["shard", "block", "start", "docs", "ordinals", "lengths", "checksum", "payload"]
        return pa.RecordBatch.from_arrays(columns, names=names)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """What ``write_tokens`` wrote, one row per document: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before. ``ids`` (array<int>) comes along unless
    ``with_ids`` is false. Every block is checked against its checksum; a damaged one fails the job.
    """

    def pieces(rows: dict) -> dict:
        names = ("shard", "ordinal", "doc_id", "start", "length", "crc", "ids")
        out: dict = {k: [] for k in names}
        sizes = [sum(x) for x in rows["lengths"]]
        for i, ids in enumerate(coder.decode(rows["payload"], sizes)):
            if coder.checksum(ids) != rows["checksum"][i]:
                raise ValueError(f"shard {rows['shard'][i]}, block {rows['block'][i]} is damaged")
            at, start = 0, rows["start"][i]
            documents = zip(*(rows[k][i] for k in ("docs", "ordinals", "lengths")), strict=True)
            for doc, ordinal, length in documents:
                own = ids[at : at + length]
                values = (
                    rows["shard"][i], ordinal, doc, start + at, length, coder.checksum(own),
                    own.astype(np.int32) if with_ids else [],
                )
                for k, v in zip(names, values, strict=True):
                    out[k].append(v)
                at += length
        return out

    schema = (
        "shard long, ordinal long, doc_id long, start long, length long, crc long, ids array<int>"
    )
    blocks = spark.read.parquet(path)
    found = map_batches(blocks, pieces, schema)
    piece = F.struct("start", "length", "crc", "ids")
    joined = (
        found.groupBy("shard", "ordinal", "doc_id")
        .agg(F.sort_array(F.collect_list(piece)).alias("p"))
        .select(
            "shard", "doc_id", F.col("p.start").getItem(0).alias("start"),
            F.col("p.length").alias("lengths"), F.col("p.crc").alias("crcs"), F.flatten("p.ids").alias("ids"),
        )
    )

    def fold(rows: dict) -> dict:
        return {
            **{k: rows[k] for k in ("shard", "doc_id", "start", "ids")},
            "length": [sum(x) for x in rows["lengths"]],
            "crc": [joined_crc(n, c) for n, c in zip(rows["lengths"], rows["crcs"], strict=True)],
        }

    folded = map_batches(joined, fold, "shard long, doc_id long, start long, length long, crc long, ids array<int>")
    totals = blocks.select("shard", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        totals.groupBy("shard").agg(F.sum("n").alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    names = ["doc_id", (F.col("start") + F.col("base")).alias("start"), F.col("length").alias("n_tokens"),
             F.col("crc").alias("ids_crc32")]
    return folded.join(bases, "shard").select(*names, *(["ids"] if with_ids else []))


def joined_crc(lengths: list[int], crcs: list[int]) -> int:
    """CRC-32 of pieces laid end to end, from the CRC-32 of each (4 bytes an id)."""
    total = crcs[0]
    for length, crc in zip(lengths[1:], crcs[1:], strict=True):
        zeros = bytes(4 * length)
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


def token_file_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the ids of all documents, read the files back, and tell what is in them."""
    path = new_path(spark, "token-files")
    write_tokens(docs, path)
    return read_tokens(spark, path, with_ids=False)

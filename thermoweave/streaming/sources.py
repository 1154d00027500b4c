"""Streaming readings from files of lines and from message logs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from thermoweave.sources.readings import event_time, parse_readings

# Files of a micro-batch whose order does not matter.
FILES_PER_TRIGGER = 64
LOG_SCHEMA = "key string, value string"


def stream_lines(
    spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """Lines of the text files that appear in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def with_arrival(stream: DataFrame) -> DataFrame:
    """Add ``seq``: the arrival number inside a micro-batch of one file, in line order.

    The numbers start again in every micro-batch.

    Streams have no built-in row number, so Arrow batches are numbered as they pass: task
    number in the high bits, position in the task in the low ones. A task that runs again
    gives the same numbers.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            seq = pa.array(range(at, at + batch.num_rows), pa.int64())
            at += batch.num_rows
            yield batch.append_column("seq", seq)

    return stream.mapInArrow(number, StructType([*stream.schema, StructField("seq", LongType())]))


PLACE = ["_time", "_feed", "_part", "_at"]


def with_place(stream: DataFrame) -> DataFrame:
    """Add where each line of a file stream stands: file time, file, block of the file, line in the block.

    Ordered by these, the lines of a micro-batch stand as if its files had come one at a time, the
    oldest first, however they were dealt to tasks. Lines are numbered as Arrow batches pass; a task that
    runs again gives the same numbers. ``in_arrival_order`` makes arrival numbers of it.
    """
    meta = {
        "_time": F.unix_millis("_metadata.file_modification_time"),
        "_feed": F.col("_metadata.file_path"),
        "_part": F.col("_metadata.file_block_start"),
    }
    placed = stream.withColumns(meta)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            feed = batch.column("_feed").dictionary_encode()
            name, part = feed.indices.to_numpy(), batch.column("_part").to_numpy()
            new = np.flatnonzero((name[1:] != name[:-1]) | (part[1:] != part[:-1])) + 1
            starts = np.concatenate([[0], new])
            lengths = np.diff(np.append(starts, len(name)))
            numbers = np.arange(len(name)) - np.repeat(starts, lengths)
            first = (feed.dictionary[int(name[0])].as_py(), int(part[0]))
            if first == last:  # goes on from the batch before
                numbers[: lengths[0]] += at
            last = (feed.dictionary[int(name[-1])].as_py(), int(part[-1]))
            at = int(numbers[-1]) + 1
            yield batch.append_column("_at", pa.array(numbers, pa.int64()))

    return placed.mapInArrow(number, StructType([*placed.schema, StructField("_at", LongType())]))


def with_log_place(log: DataFrame) -> DataFrame:
    """The same columns for rows of a message log: its partition and offset."""
    return log.withColumns(
        {
            "_time": F.lit(0).cast("bigint"),
            "_feed": F.lit(""),
            "_part": F.col("partition").cast("bigint"),
            "_at": F.col("offset").cast("bigint"),
        }
    )


def in_arrival_order(batch: DataFrame, base: int = 0) -> DataFrame:
    """Rows with their place (``with_place``, ``with_log_place``) numbered ``base`` + 1, + 2, ... as ``seq``.

    The rows of a file block, or of a log partition, know their order; how many come before a block is a running
    sum over one row per block. A log with gaps in its offsets leaves gaps in ``seq``.
    """
    part = PLACE[:-1]
    spans = batch.groupBy(*part).agg(F.min("_at").alias("_first"), (F.max("_at") - F.min("_at") + 1).alias("_span"))
    earlier = Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    before = spans.select(
        *part, "_first", F.coalesce(F.sum("_span").over(earlier), F.lit(0)).alias("_before")
    )
    return batch.join(before, part).withColumn(
        "seq", F.lit(base + 1) + F.col("_before") + F.col("_at") - F.col("_first")
    ).drop(*PLACE, "_first", "_before")


def arrived(batch: DataFrame) -> DataFrame:
    """A micro-batch with ``seq``: its own, or one made of the rows' places."""
    return in_arrival_order(batch) if set(PLACE) <= set(batch.columns) else batch


def stream_readings(
    spark: SparkSession,
    path: str,
    unit: str = "s",
    files_per_trigger: int | None = None,
    arrival: bool = False,
) -> DataFrame:
    """Typed readings with ``ts``; with ``arrival`` also what order-dependent work needs.

    For one file per micro-batch (the default with ``arrival``) that is ``seq``, for the keyed
    processors. Asked for more files, rows carry their place instead (``with_place``), for the functions
    of ``ordered``, which number a micro-batch of any number of files.
    """
    files = files_per_trigger or (1 if arrival else FILES_PER_TRIGGER)
    lines = stream_lines(spark, path, files)
    if arrival and files > 1:
        typed = parse_readings(with_place(lines))
    else:
        typed = parse_readings(lines)
        typed = with_arrival(typed) if arrival else typed
    return typed.withColumn("ts", event_time(F.col("timestamp"), unit))


def stream_messages(
    spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """(key, value) rows from JSON files: the shape of a message log without the log."""
    reader = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)

"""Start streaming queries with the usual sinks and triggers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from thermoweave.sinks.files import OUTPUT_TABLE, check_columns
from thermoweave.streaming.batches import BatchWriter

CHECKPOINT_EVERY = "1 second"


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A fixed interval, or everything available now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_console(stream: DataFrame, name: str, mode: str = "append", every: str | None = CHECKPOINT_EVERY) -> StreamingQuery:
    """Print each micro-batch under a name."""
    writer = stream.writeStream.format("console").queryName(name).outputMode(mode)
    return _triggered(writer.option("truncate", "false"), every).start()


def to_files(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "text", every: str | None = CHECKPOINT_EVERY
) -> StreamingQuery:
    """Append files of one format; the sink's log makes each micro-batch count once."""
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    return _triggered(writer.outputMode("append"), every).start(path)


def to_csv_table(
    stream: DataFrame, path: str, checkpoint: str, declared=OUTPUT_TABLE, every: str | None = CHECKPOINT_EVERY
) -> StreamingQuery:
    """Insert into a declared CSV table; names and types are checked first."""
    check_columns(stream, declared)
    return to_files(stream, path, checkpoint, "csv", every)


def to_log(
    stream: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = CHECKPOINT_EVERY
) -> StreamingQuery:
    """Send a ``value`` column (and ``key`` if there is one) to a message log topic."""
    writer = (
        stream.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, every).start()


def to_batches(
    stream: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append", every: str | None = CHECKPOINT_EVERY
) -> StreamingQuery:
    """Run a ``foreachBatch`` function; the checkpoint makes a restart go on where it was."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer.outputMode(mode), every).start()

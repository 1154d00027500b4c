"""Message-log source: connection options and payload decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.sources.readings import READING, event_time, parse_readings


def log_options(
    servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None
) -> dict[str, str]:
    """Options for Spark's ``kafka`` stream reader, which ships as a separate package."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_log(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """(key, value, partition, offset) rows of the log as a stream, key and value as text."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset"
    )


def decode_log(log: DataFrame, unit: str = "ms") -> DataFrame:
    """Typed readings plus ``ts`` from a log whose value is ``id,timestamp,temperature``.

    Where the log has ``partition`` and ``offset`` they stay, and ``seq`` is the arrival number
    that order-dependent work needs: an id's readings are ordered when they share a partition.
    """
    place = [c for c in ("partition", "offset") if c in log.columns]
    typed = parse_readings(log.select(F.col("value").cast("string").alias("value"), *place))
    if len(place) == 2:
        typed = typed.withColumn("seq", F.expr("shiftleft(CAST(partition AS BIGINT), 48) + offset"))
    return typed.withColumn("ts", event_time(F.col("timestamp"), unit))


def log_table(log: DataFrame, view: str) -> DataFrame:
    """The log as a declared table with CSV payload, registered under ``view``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in READING.fields)
    table = log.select(
        F.from_csv(F.col("value").cast("string"), ddl, {"mode": "FAILFAST"}).alias("r")
    ).select("r.*")
    table.createOrReplaceTempView(view)
    return table

"""The reading record: schema, parsing and the views that produce it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

READING = StructType(
    [
        StructField("id", StringType()),
        StructField("timestamp", LongType()),
        StructField("temperature", DoubleType()),
    ]
)
ARRIVAL_SPREAD = 512
UNITS = {"s": F.timestamp_seconds, "ms": F.timestamp_millis}


def event_time(timestamp: Column, unit: str) -> Column:
    """Epoch number to TIMESTAMP; the unit is always stated, never guessed."""
    return UNITS[unit](timestamp)


def from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Readings from a literal list, numbered by position from 1."""
    numbered = [(i, *row) for i, row in enumerate(rows, start=1)]
    return spark.createDataFrame(numbered, StructType([StructField("seq", LongType()), *READING]))


def parse_readings(lines: DataFrame, column: str = "value") -> DataFrame:
    """``id,timestamp,temperature`` text to typed columns; other columns are kept.

    Extra fields are ignored. A short line or a malformed number fails the job.
    """
    part = F.split(F.col(column), ",", -1)
    return lines.select(
        *[c for c in lines.columns if c != column],
        F.element_at(part, 1).alias("id"),
        F.element_at(part, 2).cast("bigint").alias("timestamp"),
        F.element_at(part, 3).cast("double").alias("temperature"),
    )


def parse_or_reject(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Like ``parse_readings`` but bad lines go to a second frame (``_corrupt_record``)."""
    part = F.split(F.col(column), ",", -1)
    rest = [c for c in lines.columns if c != column]
    tried = lines.select(
        *rest,
        F.get(part, 0).alias("id"),
        F.get(part, 1).try_cast("bigint").alias("timestamp"),
        F.get(part, 2).try_cast("double").alias("temperature"),
        F.col(column).alias("_corrupt_record"),
    )
    good = F.col("timestamp").isNotNull() & F.col("temperature").isNotNull()
    return tried.filter(good).drop("_corrupt_record"), tried.filter(~good).select(
        *rest, "_corrupt_record"
    )


def read_csv_table(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """A declared, header-less CSV table of readings, optionally registered by name."""
    df = spark.read.schema(READING).option("mode", "FAILFAST").csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def sensor_readings(events: DataFrame) -> DataFrame:
    """Readings mapped from the ``events`` table: (seq, id, ts, timestamp ms, temperature)."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("sensor_"), (F.col("user_id") % 10).cast("string")).alias("id"),
        ts.alias("ts"),
        F.unix_millis(ts).alias("timestamp"),
        F.col("value").alias("temperature"),
    )


def shuffled_arrivals(readings: DataFrame, spread: int = ARRIVAL_SPREAD) -> DataFrame:
    """The same readings with arrival numbers displaced by up to ``spread`` positions.

    The displacement depends on ``seq`` modulo ``spread`` only, so the new numbers stay
    unique and anyone can recompute them.
    """
    moved = F.col("seq") + (F.col("seq") * 37) % spread
    return readings.withColumn("seq", moved * spread + F.col("seq") % spread)

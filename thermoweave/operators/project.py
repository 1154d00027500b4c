"""Projection and filter, as DataFrame functions and as SQL over a view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.functions.text import wrap_int


def select_filter(readings: DataFrame, sensor: str = "sensor_1") -> DataFrame:
    return readings.select("id", "temperature").filter(F.col("id") == sensor)


def select_filter_sql(spark: SparkSession, view: str, sensor: str = "sensor_1") -> DataFrame:
    return spark.sql(
        "SELECT id, temperature FROM IDENTIFIER(:view) WHERE id = :sensor",
        args={"view": view, "sensor": sensor},
    )


def rename_project(readings: DataFrame) -> DataFrame:
    """(id, temp, ts): reordered and renamed on table creation; ``ts`` is the raw number."""
    return readings.select(
        "id", F.col("temperature").alias("temp"), F.col("timestamp").alias("ts")
    )


def int_timestamp(readings: DataFrame) -> DataFrame:
    """The BIGINT timestamp narrowed to INT the way the JVM does: high bits are lost."""
    return readings.select("seq", "id", wrap_int(F.col("timestamp")).alias("ts_int"))

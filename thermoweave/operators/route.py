"""Splitting, connecting and uniting streams of readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 30.0


def is_high(threshold: float = THRESHOLD) -> Column:
    """Strictly above the threshold; a NaN or missing temperature is not."""
    t = F.col("temperature")
    return F.coalesce((t > threshold) & ~F.isnan(t), F.lit(False))


def tag_readings(readings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return readings.withColumn(
        "tag", F.when(is_high(threshold), F.lit("high")).otherwise(F.lit("low"))
    )


def select_tags(tagged: DataFrame, *tags: str) -> DataFrame:
    """Rows carrying any of the tags, each row once."""
    return tagged.filter(F.col("tag").isin(*tags)).drop("tag")


def connect_map(readings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """High readings as (id, temperature, warning), low ones as (id, normal): one output.

    Both branches read one input and no row changes place, so this is a single projection.
    """
    high = is_high(threshold)
    return readings.select(
        "id",
        F.when(high, F.col("temperature")).alias("temperature"),
        F.when(high, F.lit("high temp warning")).otherwise(F.lit("normal")).alias("message"),
    )


def connect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two differently typed frames in one: columns missing on a side are null there."""
    return left.unionByName(right, allowMissingColumns=True)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def side_outputs(
    readings: DataFrame, threshold: float = THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """(main, side): high readings unchanged; the others as (id, temperature, timestamp)."""
    high = is_high(threshold)
    return readings.filter(high), readings.filter(~high).select("id", "temperature", "timestamp")

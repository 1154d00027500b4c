"""The benchmark tables as the operators want them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.sources.readings import sensor_readings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Windows and epoch numbers are computed under UTC, whatever the caller's session had.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return sensor_readings(table(spark, sf_dir, "events"))


def plain_times(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns as zone-less ones, the type the tables themselves use."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})

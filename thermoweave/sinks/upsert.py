"""Keyed upserts: one row per sensor, newest arrival wins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.operators.alerts import latest_by_arrival
from thermoweave.sinks.keyed import KeyedTable
from thermoweave.streaming.sources import arrived


def merge_statement(target: str, staging: str) -> str:
    """The database-side half: move staged rows into the target, update or insert."""
    return (
        f"MERGE INTO {target} t USING {staging} s ON t.sensor = s.sensor "
        "WHEN MATCHED THEN UPDATE SET t.temperature = s.temperature "
        "WHEN NOT MATCHED THEN INSERT (sensor, temperature) VALUES (s.sensor, s.temperature)"
    )


def stage_jdbc(readings: DataFrame, url: str, staging: str, properties: dict[str, str]) -> None:
    """Write the newest row per sensor to a staging table; tasks write in parallel.

    Credentials belong in ``properties``. Run ``merge_statement`` in the database next.
    """
    latest_by_arrival(readings).selectExpr("id AS sensor", "temperature").write.jdbc(
        url, staging, mode="overwrite", properties=properties
    )


def upsert_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, "sensor string, temperature double", "sensor")


def upsert_batches(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges each micro-batch into the table."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        newest = latest_by_arrival(arrived(batch)).select(F.col("id").alias("sensor"), "temperature")
        table.merge(newest, batch_id)

    return merge

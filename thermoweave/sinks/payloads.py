"""Record payloads for logs, key-value stores and document indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoweave.operators.alerts import latest_by_arrival

# Target names in the outside systems and the record's text form.
HASH_NAME = "sensor_temp"
INDEX_NAME, DOC_TYPE = "sensor_temp", "readingdata"
RECORD_NAME = "SensorReading"


def record_text(readings: DataFrame) -> DataFrame:
    """(value): the record in its text form, ``SensorReading(id,timestamp,temperature)``."""
    fields = F.concat_ws(
        ",", "id", F.col("timestamp").cast("string"), F.col("temperature").cast("string")
    )
    return readings.select(F.concat(F.lit(f"{RECORD_NAME}("), fields, F.lit(")")).alias("value"))


def csv_payload(rows: DataFrame) -> DataFrame:
    """(value): (id, temp) as one CSV line."""
    return rows.select(F.to_csv(F.struct("id", "temp")).alias("value"))


def hash_entries(readings: DataFrame) -> DataFrame:
    """(hash, field, value): the newest temperature of each id as text."""
    return latest_by_arrival(readings).select(
        F.lit(HASH_NAME).alias("hash"),
        F.col("id").alias("field"),
        F.col("temperature").cast("string").alias("value"),
    )


def documents(readings: DataFrame) -> DataFrame:
    """(index, type, source): one new JSON document per reading, all fields as text."""
    source = F.to_json(
        F.struct(
            F.col("id").alias("sensor_id"),
            F.col("temperature").cast("string").alias("sensor_temp"),
            F.col("timestamp").cast("string").alias("sensor_timestamp"),
        )
    )
    return readings.select(
        F.lit(INDEX_NAME).alias("index"), F.lit(DOC_TYPE).alias("type"), source.alias("source")
    )

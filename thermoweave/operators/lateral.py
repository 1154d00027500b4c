"""Lateral joins with table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.functions.text import split_words


def lateral_split(df: DataFrame, column: str = "id", sep: str = "_") -> DataFrame:
    """Each row times the parts of ``column``: (word, length in UTF-16 units). No part, no row."""
    parts = split_words(F.col(column), sep)
    return df.select("*", F.explode(parts).alias("word")).withColumn(
        "length", F.expr("CAST(octet_length(encode(word, 'UTF-16BE')) div 2 AS INT)")
    )


def lateral_split_sql(spark: SparkSession, view: str, function: str = "split_words") -> DataFrame:
    """The comma-lateral form; ``function`` comes from ``functions.registry``."""
    return spark.sql(
        f"SELECT seq, id, ts, word, length FROM {view}, LATERAL {function}(id) AS parts(word, length)"
    )

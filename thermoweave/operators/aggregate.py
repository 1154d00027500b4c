"""Grouped aggregates and word counts. All of them combine on the map side first."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.functions.text import split_lines, split_words
from thermoweave.operators.scan import BLOCK, running, seq_block


def group_count(readings: DataFrame) -> DataFrame:
    return readings.groupBy("id").agg(F.count("id").alias("cnt"))


def group_count_sql(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(
        "SELECT id, count(id) AS cnt FROM IDENTIFIER(:view) GROUP BY id", args={"view": view}
    )


def min_by_final(readings: DataFrame) -> DataFrame:
    """The whole record with the lowest temperature per id; of equals, the earliest."""
    record = F.struct("temperature", "seq", "timestamp")
    return readings.groupBy("id").agg(F.min(record).alias("r")).select(
        "id", "r.seq", "r.timestamp", "r.temperature"
    )


def mean_temperature(readings: DataFrame) -> DataFrame:
    """Average temperature per id."""
    return readings.groupBy("id").agg(F.avg("temperature").alias("avg_temp"))


def text_lines(df: DataFrame, column: str = "text") -> DataFrame:
    """One row per line of a text column, as a line reader would give."""
    return df.select(F.explode(split_lines(F.col(column))).alias("value"))


def words(lines: DataFrame, sep: str = " ", lower: bool = False, drop_empty: bool = False) -> DataFrame:
    value = F.lower("value") if lower else F.col("value")
    if drop_empty:  # trailing empty words go with the others
        out = lines.select(F.explode(F.split(value, re.escape(sep), -1)).alias("word"))
        return out.filter(F.length("word") > 0)
    return lines.select(F.explode(split_words(value, sep)).alias("word"))


def word_count(lines: DataFrame, sep: str = " ", lower: bool = False, drop_empty: bool = False) -> DataFrame:
    """(word, n). Defaults count empty words too, as splitting on each single space does."""
    return words(lines, sep, lower, drop_empty).groupBy("word").agg(F.count("*").alias("n"))


def text_word_count(docs: DataFrame, sep: str = ",", lower: bool = True) -> DataFrame:
    """(word, n) of the non-empty words between separators and line ends, in one explode."""
    value = F.lower("text") if lower else F.col("text")
    parts = F.split(value, rf"\r?\n|{re.escape(sep)}", -1)
    found = docs.select(F.explode(parts).alias("word")).filter(F.length("word") > 0)
    return found.groupBy("word").agg(F.count("*").alias("n"))


def running_word_count(docs: DataFrame, block_docs: int = 2048) -> DataFrame:
    """Every non-empty word with its count so far, in (doc_id, position) order.

    A (word, block) holds at most the words of ``block_docs`` documents.
    """
    kept = F.array_remove(F.split("text", r"\r?\n| ", -1), "")
    placed = docs.select("doc_id", F.posexplode(kept).alias("pos", "word"))
    blocked = placed.withColumn(BLOCK, seq_block("doc_id", block_docs))
    return running(
        blocked, {"n": ("sum", F.lit(1))}, keys=["word"], order=["doc_id", "pos"]
    )

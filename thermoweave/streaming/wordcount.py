"""Running word counts on a stream of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoweave.operators.aggregate import word_count
from thermoweave.functions.text import split_words
from thermoweave.streaming.processors import running_sum
from thermoweave.streaming.sources import with_arrival


def word_count_stream(lines: DataFrame) -> DataFrame:
    """(word, n) without empty words; update mode gives each changed count per micro-batch."""
    return word_count(lines, drop_empty=True)


def word_count_per_record(lines: DataFrame) -> DataFrame:
    """(seq, word, n): every word with its count so far."""
    words = lines.select(F.explode(split_words(F.col("value"), " ")).alias("word"))
    ones = words.filter(F.length("word") > 0).select("word", F.lit(1).alias("one"))
    counted = running_sum(with_arrival(ones), "one", key="word")
    return counted.select("seq", "word", F.col("total").cast("bigint").alias("n"))

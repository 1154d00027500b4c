"""Watermarks and event-time windows on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoweave.operators.windows import micros


def bounded_disorder(stream: DataFrame, delay: str = "1 second", ts: str = "ts") -> DataFrame:
    """Event times may be up to ``delay`` older than the newest one."""
    return stream.withWatermark(ts, delay)


def ascending(stream: DataFrame, ts: str = "ts") -> DataFrame:
    return stream.withWatermark(ts, "0 seconds")


def punctuated(stream: DataFrame, marker: str = "sensor_1", delay: str = "1 second") -> DataFrame:
    """Only readings of the ``marker`` id move the watermark.

    The watermark sits on ``marker_ts``, which is null on all other rows.
    """
    marked = stream.withColumn("marker_ts", F.when(F.col("id") == marker, F.col("ts")))
    return marked.withWatermark("marker_ts", delay)


def tumble_stream(stream: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Count per id and tumbling window; the stream carries a watermark on ``ts``."""
    return (
        stream.groupBy("id", F.window("ts", size))
        .agg(F.count("id").alias("cnt"))
        .select("id", "cnt", F.col("window.end").alias("window_end"))
    )


def slide_stream(stream: DataFrame, size: str = "15 seconds", slide: str = "5 seconds") -> DataFrame:
    """Count per id and sliding window with the window start in ms."""
    return (
        stream.groupBy("id", F.window("ts", size, slide))
        .agg(F.count("*").alias("cnt"))
        .select("id", F.unix_millis(F.col("window.start")).alias("window_start_ms"), "cnt")
    )


def offset_stream(stream: DataFrame, size: str = "1 hour", offset: str = "-8 hours") -> DataFrame:
    """Tumbling windows shifted by ``offset``."""
    width = micros(size)
    parts = [f"{n} microseconds" for n in (width, width, micros(offset) % width)]
    return (
        stream.groupBy("id", F.window("ts", *parts))
        .agg(F.count("id").alias("cnt"))
        .select("id", F.col("window.start").alias("window_start"), "cnt")
    )


def reduce_stream(stream: DataFrame, size: str = "15 seconds", slide: str = "5 seconds") -> DataFrame:
    """Highest timestamp and lowest temperature per id and sliding window."""
    return (
        stream.groupBy("id", F.window("ts", size, slide))
        .agg(
            F.max("timestamp").alias("max_timestamp"),
            F.min("temperature").alias("min_temperature"),
        )
        .select(
            "id",
            F.unix_millis(F.col("window.start")).alias("window_start_ms"),
            "max_timestamp",
            "min_temperature",
        )
    )


def session_stream(stream: DataFrame, gap: str = "1 minute") -> DataFrame:
    """Sessions per id: start, end and count."""
    return (
        stream.groupBy("id", F.session_window("ts", gap))
        .agg(F.count("*").alias("cnt"))
        .select(
            "id",
            F.col("session_window.start").alias("session_start"),
            F.col("session_window.end").alias("session_end"),
            "cnt",
        )
    )


def group_count_stream(stream: DataFrame) -> DataFrame:
    """Count per id; run it in update or complete mode."""
    return stream.groupBy("id").agg(F.count("id").alias("cnt"))


def late_updates(
    stream: DataFrame,
    size: str = "15 seconds",
    slide: str = "5 seconds",
    delay: str = "1 second",
    lateness: str = "1 minute",
) -> DataFrame:
    """Sliding counts that take late readings until ``lateness`` after the window's end.

    Run it in update mode: each micro-batch emits the windows it changed, and a window is
    forgotten once its end plus ``lateness`` is behind the watermark. For one result at the
    window's end and one per late reading use ``processors.late_firings``.
    """
    wait = f"{micros(delay) + micros(lateness)} microseconds"
    return slide_stream(stream.withWatermark("ts", wait), size, slide)

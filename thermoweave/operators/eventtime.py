"""Watermark replays over a finished set of readings, one record at a time.

``seq`` is the arrival order and ``ts`` the event time. The watermark after a record is the
highest event time so far minus the allowed disorder; a record meets the watermark the
records before it left behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoweave.operators.scan import BLOCK_ROWS, add_seq_block, running
from thermoweave.operators.windows import _starts, micros


def _trace(readings: DataFrame, ts_ms: Column, delay: str, block_rows: int) -> DataFrame:
    out = running(add_seq_block(readings, rows=block_rows), {"top": ("max", ts_ms)})
    return out.select(
        "seq", "id", "timestamp",
        (F.col("top") - F.lit(micros(delay) // 1000)).alias("watermark_ms"),
    )


def watermark_trace(readings: DataFrame, delay: str = "1 second", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Watermark (ms) after each record: running maximum of event time minus ``delay``."""
    return _trace(readings, F.unix_millis("ts"), delay, block_rows)


def punctuated_trace(
    readings: DataFrame, marker: str = "sensor_1", delay: str = "1 second", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The same when only records of the ``marker`` id move the watermark; null before any."""
    return _trace(readings, F.when(F.col("id") == marker, F.unix_millis("ts")), delay, block_rows)


def with_watermark_before(
    readings: DataFrame,
    delay: str,
    start_ms: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``wm_ms``: the watermark each record meets (null before the first one).

    ``start_ms`` is the highest event time of records that came before this frame.
    """
    out = running(
        add_seq_block(readings, rows=block_rows),
        {"_top": ("max", F.unix_millis("ts"))},
        before=True,
    )
    top = F.greatest(F.col("_top"), F.lit(start_ms).cast("bigint"))
    return out.withColumn("wm_ms", top - F.lit(micros(delay) // 1000)).drop("_top")


def mark_late(
    readings: DataFrame,
    size: str = "15 seconds",
    slide: str = "5 seconds",
    delay: str = "1 second",
    lateness: str = "1 minute",
    start_ms: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add BOOLEAN ``late``: even the last window holding the record is already gone.

    A window is gone once its last millisecond plus ``lateness`` is not after the watermark.
    """
    step = micros(slide) // 1000
    met = with_watermark_before(readings, delay, start_ms, block_rows)
    at = F.unix_millis("ts")
    last_ms = at - F.pmod(at, F.lit(step)) + F.lit(micros(size) // 1000 - 1)
    gone = last_ms + F.lit(micros(lateness) // 1000) <= F.col("wm_ms")
    return met.withColumn("late", F.coalesce(gone, F.lit(False)))


def late_split(readings: DataFrame, **params) -> tuple[DataFrame, DataFrame]:
    """(on time, late) readings, both without helper columns."""
    marked = mark_late(readings, **params)
    late = F.col("late")
    return marked.filter(~late).drop("late", "wm_ms"), marked.filter(late).drop("late", "wm_ms")


def window_elements(
    readings: DataFrame, size: str, slide: str, delay: str, lateness: str, start_ms: int | None, block_rows: int
) -> DataFrame:
    """(seq, id, _start, fired): each record with every window that still takes it, and whether that has fired.

    ``_start`` is in epoch micros; ``start_ms`` as in ``mark_late``.
    """
    wm = F.coalesce("wm_ms", F.lit(-(2**62)))
    met = mark_late(
        readings.select("seq", "id", "ts"), size, slide, delay, lateness, start_ms, block_rows
    ).filter(~F.col("late"))
    start = F.explode(_starts(F.unix_micros("ts"), micros(size), micros(slide)))
    last_ms = ((F.col("_start") + F.lit(micros(size))) / 1000).cast("bigint") - 1
    placed = met.select("seq", "id", "wm_ms", start.alias("_start")).withColumn("last_ms", last_ms)
    kept = placed.filter(F.col("last_ms") + F.lit(micros(lateness) // 1000) > wm)
    return kept.select("seq", "id", "_start", (F.col("last_ms") <= wm).alias("fired"))


def lateness_firings(
    readings: DataFrame,
    size: str = "15 seconds",
    slide: str = "5 seconds",
    delay: str = "1 second",
    lateness: str = "1 minute",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every result a sliding count emits when late elements make windows fire again.

    A window fires once when the watermark passes its end, with the elements it has by
    then, and again for each element that comes later but not beyond ``lateness``. Output:
    (id, window_start_ms, firing, cnt); firing 0 is the regular one.
    """
    kept = window_elements(readings, size, slide, delay, lateness, None, block_rows)
    fired = F.col("fired")
    # A window's elements in time are one row of their own, in front of the late ones.
    regular = kept.filter(~fired).groupBy("id", "_start").agg(F.count("*").alias("n"))
    late = kept.filter(fired).select("id", "_start", "seq", F.lit(1).cast("bigint").alias("n"))
    steps = regular.withColumn("seq", F.lit(-1).cast("bigint")).unionByName(late)
    counted = running(
        add_seq_block(steps, rows=block_rows),
        {"cnt": ("sum", F.col("n")), "firing": ("sum", (F.col("seq") >= 0).cast("bigint"))},
        ["id", "_start"],
    )
    return counted.select(
        "id", (F.col("_start") / 1000).cast("bigint").alias("window_start_ms"), "firing", "cnt"
    )

"""Per-record results over everything a key has sent so far, in arrival order (``seq``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoweave.operators.scan import BLOCK_ROWS, add_seq_block, previous, running

JUMP = 10.0


def rolling_sum(df: DataFrame, value: str, keys=("id",), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each record with the sum of ``value`` so far."""
    return running(
        add_seq_block(df, rows=block_rows), {"total": ("sum", F.col(value))}, list(keys)
    )


def rolling_reduce(readings: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Latest timestamp and lowest temperature so far, one row per input."""
    out = running(
        add_seq_block(readings, rows=block_rows),
        {
            "max_timestamp": ("max", F.col("timestamp")),
            "min_temperature": ("min", F.col("temperature")),
        },
        ["id"],
    )
    return out.select("seq", "id", "max_timestamp", "min_temperature")


def rolling_min_by(readings: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The whole record of the lowest temperature so far; of equals, the earliest."""
    record = F.struct("temperature", F.col("seq").alias("at_seq"), "timestamp")
    out = running(
        add_seq_block(readings, rows=block_rows), {"best": ("min", record)}, ["id"]
    )
    return out.select(
        "seq",
        "id",
        F.col("best.at_seq").alias("min_seq"),
        F.col("best.timestamp").alias("min_timestamp"),
        F.col("best.temperature").alias("min_temperature"),
    )


def changelog_count(
    readings: DataFrame, block_rows: int = BLOCK_ROWS, weight: Column | None = None
) -> DataFrame:
    """Retracting count: (added, id, cnt); before each new count the old one is withdrawn.

    ``weight`` is how many records a row stands for, 1 by default.
    """
    counted = running(
        add_seq_block(readings, rows=block_rows), {"n": ("sum", F.lit(1) if weight is None else weight)}, ["id"]
    )
    change = F.filter(
        F.array(
            F.struct(F.lit(False).alias("added"), (F.col("n") - 1).alias("cnt")),
            F.struct(F.lit(True).alias("added"), F.col("n").alias("cnt")),
        ),
        lambda c: c["cnt"] > 0,
    )
    return counted.select("seq", "id", F.explode(change).alias("c")).select(
        "seq", "c.added", "id", "c.cnt"
    )


def running_number(readings: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """1, 2, 3 … over all records: block counts, offsets, then numbering inside blocks."""
    return running(add_seq_block(readings, rows=block_rows), {"n": ("sum", F.lit(1))})


def _jumped(threshold: float) -> Column:
    """|current - last| strictly above the threshold; comparing with NaN is never true."""
    gap = F.abs(F.col("temperature") - F.col("last_temp"))
    return (gap > threshold) & ~F.isnan(gap)


def _with_last(readings: DataFrame, default: float | None, block_rows: int) -> DataFrame:
    return previous(
        add_seq_block(readings, rows=block_rows),
        "temperature",
        "last_temp",
        ["id"],
        default=default,
    )


def jump_alert(readings: DataFrame, threshold: float = JUMP, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Readings further than ``threshold`` from the one before; a first reading never alerts."""
    last = _with_last(readings, None, block_rows)
    return last.filter(_jumped(threshold)).select(
        "seq", "id", "last_temp", F.col("temperature").alias("cur_temp")
    )


def jump_alert_zero_init(
    readings: DataFrame, threshold: float = JUMP, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The same with unset state read as 0.0, so a first reading may alert."""
    last = _with_last(readings, 0.0, block_rows)
    return last.filter(_jumped(threshold)).select(
        "seq", "id", "last_temp", F.col("temperature").alias("cur_temp")
    )


def jump_map(readings: DataFrame, threshold: float = JUMP, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per reading: (last, current) where it jumped, (0.0, 0.0) where not."""
    last = _with_last(readings, 0.0, block_rows)
    jumped = F.coalesce(_jumped(threshold), F.lit(False))
    return last.select(
        "seq",
        "id",
        F.when(jumped, F.col("last_temp")).otherwise(0.0).alias("last_temp"),
        F.when(jumped, F.col("temperature")).otherwise(0.0).alias("cur_temp"),
    )

"""Windows over event time, element count and neighbouring rows (batch).

Time windows are aggregated to *panes* first: the largest intervals no window edge cuts.
A pane is one row per id, however many readings it had, so sliding windows copy panes and
not readings, and a hot id is combined on the map side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thermoweave.operators.scan import (
    BLOCK,
    BLOCK_ROWS,
    add_seq_block,
    add_time_block,
    finished,
    in_block,
    previous,
    running,
    seq_block,
    with_halo,
    with_totals,
)

_MICROS = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(duration: str) -> int:
    """``'10 seconds'`` or ``'-8 hours'`` as microseconds."""
    amount, unit = duration.split()
    return int(amount) * _MICROS[unit.rstrip("s")]


# ---------------------------------------------------------------- time windows


def tumble_count(readings: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Count per id and tumbling window, with the exclusive window end."""
    return (
        readings.groupBy("id", F.window("ts", size))
        .agg(F.count("id").alias("cnt"))
        .select("id", "cnt", F.col("window.end").alias("window_end"))
    )


def tumble_count_sql(spark: SparkSession, view: str, size: str = "10 seconds") -> DataFrame:
    return spark.sql(
        f"""
        SELECT id, count(id) AS cnt, window.end AS window_end
        FROM {view}
        GROUP BY id, window(ts, '{size}')
        """
    )


def tumble_offset(readings: DataFrame, size: str = "1 hour", offset: str = "-8 hours") -> DataFrame:
    """Tumbling windows shifted by ``offset``; count per id, window start and end."""
    width = micros(size)
    shift = micros(offset) % width  # Spark wants an offset inside the window
    frame = F.window("ts", f"{width} microseconds", f"{width} microseconds", f"{shift} microseconds")
    return (
        readings.groupBy("id", frame)
        .agg(F.count("id").alias("cnt"))
        .select("id", F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), "cnt")
    )


def _starts(at: Column, size: int, slide: int) -> Column:
    """Starts (epoch micros) of all sliding windows that hold the instant ``at``.

    Null where windows leave gaps and the instant is in one: ``explode`` drops such a row.
    """
    past = F.pmod(at, F.lit(slide))  # since the newest start
    newest = at - past
    older = F.floor((F.lit(size - 1) - past) / slide).cast("bigint")
    return F.when(past < size, F.sequence(newest - older * slide, newest, F.lit(slide)))


MANY_WINDOWS = 8
PANES_TOGETHER = 8  # stretches are this many window sizes long


def partition_count(df: DataFrame) -> int:
    """For Python or expanding stages: their small inputs must not be merged into one task."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sliding(
    readings: DataFrame,
    size: str,
    slide: str,
    partial: dict[str, Column],
    final: dict[str, Callable[[str], Column]],
) -> DataFrame:
    """Aggregate per id and sliding window through panes.

    ``partial`` aggregates the readings of a pane, ``final`` the pane results by name.
    Result: (id, window_start TIMESTAMP, *final).
    """
    width, step = micros(size), micros(slide)
    pane = math.gcd(width, step)
    at = F.unix_micros("ts")
    panes = readings.groupBy("id", (at - F.pmod(at, F.lit(pane))).alias("_pane")).agg(
        *[agg.alias(name) for name, agg in partial.items()]
    )
    if width // step > MANY_WINDOWS:
        # Neighbouring panes into one task, so that their copies combine before the shuffle.
        stretch = F.floor(F.col("_pane") / F.lit(PANES_TOGETHER * width))
        panes = panes.repartition(partition_count(panes), F.col("id"), stretch)
    return (
        panes.withColumn("_start", F.explode(_starts(F.col("_pane"), width, step)))
        .groupBy("id", "_start")
        .agg(*[agg(name).alias(name) for name, agg in final.items()])
        .withColumn("window_start", F.timestamp_micros("_start"))
        .drop("_start")
    )


def slide_count_keyed(readings: DataFrame, size: str = "15 seconds", slide: str = "5 seconds") -> DataFrame:
    """(id, window_start_ms, cnt) per id and sliding window."""
    counted = sliding(readings, size, slide, {"cnt": F.count("*")}, {"cnt": F.sum})
    return counted.select("id", F.unix_millis("window_start").alias("window_start_ms"), "cnt")


def slide_count(readings: DataFrame, size: str = "15 seconds", slide: str = "5 seconds") -> DataFrame:
    """(window_start_ms, cnt), one row per id and window with the id left out."""
    return slide_count_keyed(readings, size, slide).drop("id")


def slide_reduce(readings: DataFrame, size: str = "15 seconds", slide: str = "5 seconds") -> DataFrame:
    """Latest timestamp and lowest temperature per id and sliding window."""
    names = {"max_timestamp": (F.max, "timestamp"), "min_temperature": (F.min, "temperature")}
    out = sliding(
        readings,
        size,
        slide,
        {name: fold(column) for name, (fold, column) in names.items()},
        {name: fold for name, (fold, _) in names.items()},
    )
    return out.select("id", F.unix_millis("window_start").alias("window_start_ms"), *names)


def slide_apply(
    readings: DataFrame,
    function: Callable[[str, int, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    size: str = "15 seconds",
    slide: str = "5 seconds",
    ends: tuple[int, int] | None = None,
) -> DataFrame:
    """A user function over all elements of each (id, sliding window).

    ``function(id, window_start_ms, batches)`` gets the whole window as Arrow batches that pass
    by one at a time, in no given order, and yields batches of ``schema``; nothing is gathered
    for it. What can be merged from parts is cheaper through ``sliding``, which copies panes.
    With ``ends`` only windows that end after the first and not after the second instant (epoch micros).
    Result: (id, window_start_ms, *schema).
    """
    width, step = micros(size), micros(slide)
    group = ["id", "_start"]
    placed = readings.select(
        "*", F.explode(_starts(F.unix_micros("ts"), width, step)).alias("_start")
    )
    if ends is not None:
        end = F.col("_start") + F.lit(width)
        placed = placed.where((end > ends[0]) & (end <= ends[1]))

    def whole_window(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        sensor, start_ms = key[0].as_py(), key[1].as_py() // 1000
        for out in function(sensor, start_ms, (b.drop_columns(["_start"]) for b in batches)):
            n = out.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([sensor] * n, pa.string()), pa.array([start_ms] * n, pa.int64()), *out.columns],
                names=["id", "window_start_ms", *out.schema.names],
            )

    return (
        placed.repartition(partition_count(placed), *group)
        .groupBy(*group)
        .applyInArrow(whole_window, f"id string, window_start_ms bigint, {schema}")
    )


def window_sizes(readings: DataFrame, size: str = "15 seconds", slide: str = "5 seconds") -> DataFrame:
    """The element count through ``slide_apply``; the id is left out as in ``slide_count``."""

    def count_elements(
        _id: str, _start_ms: int, elements: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"cnt": pa.array([sum(b.num_rows for b in elements)], pa.int64())})

    return slide_apply(readings.select("id", "ts"), count_elements, "cnt bigint", size, slide).drop("id")


SESSION_PANES = 1 << 16


def session_count(readings: DataFrame, gap: str = "1 minute", block_panes: int = SESSION_PANES) -> DataFrame:
    """Sessions per id: readings at most ``gap`` apart; start, end (last + gap) and count.

    Readings in one interval as wide as the gap always share a session, so they are
    combined to panes first. Panes are scanned in blocks of time: which of them open a session, and how
    many did before, needs one row per block of an id together.
    """
    wide = micros(gap)
    at = F.unix_micros("ts")
    panes = readings.groupBy("id", F.floor(at / F.lit(wide)).alias("_pane")).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n")
    )
    blocked = panes.withColumn(BLOCK, seq_block("_pane", block_panes))
    seen = previous(blocked, "last", "_last", ["id"], ["_pane"], keep_block=True)
    opens = F.coalesce(F.col("first") > F.col("_last") + F.lit(wide), F.lit(True)).cast("int")
    numbered = running(seen, {"_session": ("sum", opens)}, ["id"], ["_pane"])
    return (
        numbered.groupBy("id", "_session")
        .agg(
            F.timestamp_micros(F.min("first")).alias("session_start"),
            F.timestamp_micros(F.max("last") + F.lit(wide)).alias("session_end"),
            F.sum("n").alias("cnt"),
        )
        .drop("_session")
    )


# ------------------------------------------------------- count and row windows


def count_window(
    readings: DataFrame, size: int = 10, every: int = 2, block_rows: int = BLOCK_ROWS, weight: Column | None = None
) -> DataFrame:
    """At every ``every``-th element of an id: the window of its latest ``size`` elements.

    ``weight`` is how many elements a row counts for, 1 by default.
    """
    one = (F.lit(1) if weight is None else weight).alias("_one")
    blocked = add_seq_block(
        readings.select("seq", "id", "timestamp", "temperature", one), rows=block_rows
    )
    haloed = with_halo(blocked, size - 1, ["id"], ["seq"], ["timestamp", "temperature"])
    rows = with_totals(haloed, {"nth": ("sum", F.col("_one"))}, ["id"])
    here = in_block(["id"], ["seq"])
    frame = here.rowsBetween(1 - size, Window.currentRow)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns(
        {
            "nth": F.sum("_v_nth").over(so_far),
            "elements": F.count("seq").over(frame),
            "max_timestamp": F.max("timestamp").over(frame),
            "min_temperature": F.min("temperature").over(frame),
        }
    )
    return (
        finished(placed)
        .filter(F.col("nth") % every == 0)
        .select("seq", "id", "elements", "max_timestamp", "min_temperature")
    )


def with_preceding(readings: DataFrame, preceding: int = 2, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Readings cut by time with the rows a ``preceding``-row frame reaches back to.

    Columns added: the block and ``is_halo``. Any frame over (id, block) by (ts, seq) is
    complete for rows that are not halo rows.
    """
    blocked = add_time_block(readings.select("seq", "id", "ts", "temperature"), rows=block_rows)
    return with_halo(blocked, preceding, ["id"], ["ts", "seq"], ["temperature"])


def over_rows(readings: DataFrame, preceding: int = 2, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Count and mean temperature over each reading and the ``preceding`` ones before it."""
    frame = in_block(["id"], ["ts", "seq"]).rowsBetween(-preceding, Window.currentRow)
    rows = with_preceding(readings, preceding, block_rows)
    return finished(
        rows.withColumns(
            {"cnt": F.count("id").over(frame), "avg_temp": F.avg("temperature").over(frame)}
        )
    ).select("seq", "id", "ts", "cnt", "avg_temp")


def over_rows_sql(spark: SparkSession, view: str, preceding: int = 2) -> DataFrame:
    """The same as SQL with a named window; ``view`` holds ``with_preceding`` rows."""
    return spark.sql(
        f"""
        SELECT seq, id, ts, cnt, avg_temp FROM (
          SELECT seq, id, ts, is_halo,
                 count(id) OVER w AS cnt,
                 avg(temperature) OVER w AS avg_temp
          FROM {view}
          WINDOW w AS (
            PARTITION BY id, {BLOCK}
            ORDER BY ts, seq
            ROWS BETWEEN {preceding} PRECEDING AND CURRENT ROW
          )
        ) WHERE NOT is_halo
        """
    )

"""Event-time operators on streams whose micro-batches hold many files and hot keys.

A micro-batch is a batch job. Rows whose time has not come wait in a ``TimedTable``, appended once and opened again
when the watermark reaches their interval; what the watermark has passed goes through the batch operators. No state is
called per row, no task gathers a key, and the bytes written follow what came and not what waits.

The watermark after a micro-batch is the newest event time so far less ``delay``. A window has passed once its last
millisecond is not after the watermark, a row once its own is not; what passes in a micro-batch is in
that micro-batch's results. Rows without an event time take no part. Streams carry their rows' place
(``stream_readings`` with ``arrival`` and several files, or ``with_log_place``). Every function writes one folder per
micro-batch, and a repeated micro-batch replaces its results and its state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thermoweave.operators import windows
from thermoweave.operators.eventtime import window_elements
from thermoweave.operators.scan import BLOCK_ROWS, add_seq_block, running
from thermoweave.operators.windows import micros
from thermoweave.sinks.keyed import KeyedTable
from thermoweave.sinks.timed import TimedTable
from thermoweave.streaming.batches import BatchWriter, _put
from thermoweave.streaming.sources import in_arrival_order

READING = "id string, timestamp bigint, temperature double, ts timestamp"
_FAR = -(2**62)
_AT = "_at_us"


def _passed(top_ms: int | None, delay: str) -> int:
    """Epoch micros of the first instant the watermark has not passed."""
    return _FAR if top_ms is None else (top_ms - micros(delay) // 1000 + 1) * 1000


def _newest(rows: DataFrame, known: int | None) -> tuple[int | None, int | None]:
    """(highest event time in ms, highest arrival number) after ``rows``."""
    seq = F.max("seq") if "seq" in rows.columns else F.lit(None)
    row = rows.agg(F.max(F.unix_millis("ts")).alias("ms"), seq.alias("seq")).first()
    return max((ms for ms in (row["ms"], known) if ms is not None), default=None), row["seq"]


def window_apply_batches(
    spark: SparkSession,
    function: Callable[[str, int, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    path: str,
    state_path: str,
    size: str = "15 seconds",
    slide: str = "5 seconds",
    delay: str = "1 second",
    columns: str = READING,
) -> BatchWriter:
    """N9: ``windows.slide_apply`` on a stream, each (id, window) once, when the watermark has passed it.

    ``function`` gets a window as Arrow batches that pass by. A row that comes late is in those of its windows that
    have not passed by the micro-batches before its own. ``columns`` are what the function sees, ``id`` and ``ts`` among them.
    """
    width = micros(size)
    names = [c.split()[0] for c in columns.split(", ")]
    waiting = TimedTable(spark, state_path, f"{columns}, {_AT} bigint", _AT, width)

    def write(batch: DataFrame, batch_id: int) -> None:
        known = waiting.meta(before=batch_id).get("top_ms")
        new = batch.where(F.col("ts").isNotNull()).select(*names, F.unix_micros("ts").alias(_AT)).persist()
        try:
            top, _ = _newest(new, known)
            gone, passed = _passed(known, delay), _passed(top, delay)
            at = F.col(_AT)
            fresh = new.where(at > gone - width)  # in a window that has not passed
            due = waiting.read(batch_id, gone - width + 1, passed).unionByName(fresh.where(at < passed))
            _put(windows.slide_apply(due.select(*names), function, schema, size, slide, (gone, passed)), path, batch_id)
            waiting.add(fresh.where(at > passed - width), batch_id, {"top_ms": top}, passed - width + 1)
        finally:
            new.unpersist()

    return write


def over_rows_batches(
    spark: SparkSession,
    path: str,
    state_path: str,
    preceding: int = 2,
    delay: str = "1 second",
    interval: str = "1 minute",
    block_rows: int = BLOCK_ROWS,
) -> BatchWriter:
    """N10: count and mean over each reading and the ``preceding`` earlier ones of its id, in order of event time.

    Readings wait in intervals of time until the watermark has passed them; the last ``preceding`` of every id
    are carried in a ``KeyedTable``. A reading the watermark had passed before its micro-batch takes no part, as its place
    in the order is gone; ``batches.route_late`` gives such readings. Ties stand in order of arrival.
    Result: (seq, id, ts, cnt, avg_temp).
    """
    row = ["seq", "id", "ts", "temperature"]
    waiting = TimedTable(
        spark, f"{state_path}/waiting", f"seq bigint, id string, ts timestamp, temperature double, {_AT} bigint",
        _AT, micros(interval),
    )
    carried = KeyedTable(
        spark, f"{state_path}/carried",
        "id string, rows array<struct<seq: bigint, ts: timestamp, temperature: double>>", "id",
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        meta = waiting.meta(before=batch_id)
        known, base = meta.get("top_ms"), meta.get("rows", 0)
        new = in_arrival_order(batch, base).select(*row, F.unix_micros("ts").alias(_AT)).persist()
        due = None
        try:
            top, last = _newest(new, known)
            gone, passed = _passed(known, delay), _passed(top, delay)
            at = F.col(_AT)
            fresh = new.where(at >= gone)
            due = waiting.read(batch_id, gone, passed).unionByName(fresh.where(at < passed)).persist()
            ids = due.select("id").distinct()
            buckets = carried.buckets_of(ids)
            same = F.col("old.id").eqNullSafe(F.col("due.id"))
            old = carried.read(before=batch_id, buckets=buckets).alias("old").join(ids.alias("due"), same, "left_semi")
            rows = old.select("id", F.inline("rows")).select(*row).unionByName(due.select(*row))
            out = windows.over_rows(rows, preceding, block_rows).where(F.unix_micros("ts") >= gone)
            _put(out, path, batch_id)
            newest = Window.partitionBy("id").orderBy(F.desc("ts"), F.desc("seq"))
            kept = rows.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= preceding)
            kept = kept.groupBy("id").agg(F.collect_list(F.struct("seq", "ts", "temperature")).alias("rows"))
            carried.merge(kept, batch_id)
            after = {"top_ms": top, "rows": base if last is None else last}
            waiting.add(fresh.where(at >= passed), batch_id, after, passed)
        finally:
            new.unpersist()
            if due is not None:
                due.unpersist()

    return write


def late_firing_batches(
    spark: SparkSession,
    path: str,
    state_path: str,
    size: str = "15 seconds",
    slide: str = "5 seconds",
    delay: str = "1 second",
    lateness: str = "1 minute",
    block_rows: int = BLOCK_ROWS,
) -> BatchWriter:
    """T5: sliding counts that fire when the watermark passes a window and again for every late record.

    (id, window_start_ms, firing, cnt) as ``eventtime.lateness_firings``: lateness is judged record by record, in
    order of arrival. A window's regular result (firing 0) is in the micro-batch whose records move the watermark past it. State is
    the counts each micro-batch adds to the windows it touched; they go when the lateness is over.
    """
    width, late_us = micros(size), micros(lateness)
    counts = TimedTable(spark, state_path, "id string, _start bigint, n bigint, late bigint", "_start", width)
    group = ["id", "_start"]

    def write(batch: DataFrame, batch_id: int) -> None:
        meta = counts.meta(before=batch_id)
        known, base = meta.get("top_ms"), meta.get("rows", 0)
        new = in_arrival_order(batch, base).select("seq", "id", "ts").persist()
        placed = None
        try:
            top, last = _newest(new, known)
            gone, passed = _passed(known, delay), _passed(top, delay)
            timed = new.where(F.col("ts").isNotNull())
            placed = window_elements(timed, size, slide, delay, lateness, known, block_rows).persist()
            late = placed.where("fired")
            added = placed.groupBy(*group).agg(
                F.count_if(~F.col("fired")).alias("n"), F.count_if("fired").alias("late")
            )
            # Windows that pass now, and those already passed that got a late record.
            first_open, none_open = gone - width + 1, passed - width + 1
            due = counts.read(batch_id, first_open, none_open)
            again = counts.read(
                batch_id, first_open - late_us, first_open, counts.intervals_of(late.where(F.col("_start") < first_open))
            )
            zero = F.lit(0).cast("bigint")
            earlier = due.unionByName(again).select(*group, "n", "late", zero.alias("now"))
            parts = earlier.unionByName(added.select(*group, "n", zero.alias("late"), F.col("late").alias("now")))
            totals = parts.groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("n", "late", "now")])
            end = F.col("_start") + F.lit(width)
            regular = totals.where((end > gone) & (end <= passed) & (F.col("n") > 0)).select(
                *group, zero.alias("firing"), F.col("n").alias("cnt")
            )
            # What a window had before the late records of this micro-batch is one row in front of them.
            one = F.lit(1).cast("bigint")
            steps = totals.where("now > 0").select(
                F.lit(-1).cast("bigint").alias("seq"), *group, (F.col("n") + F.col("late")).alias("n"),
                F.col("late").alias("fired"),
            ).unionByName(late.select("seq", *group, one.alias("n"), one.alias("fired")))
            counted = running(
                add_seq_block(steps, rows=block_rows),
                {"cnt": ("sum", F.col("n")), "firing": ("sum", F.col("fired"))},
                group,
            ).where("seq >= 0").select(*group, "firing", "cnt")
            start_ms = (F.col("_start") / 1000).cast("bigint").alias("window_start_ms")
            _put(regular.unionByName(counted).select("id", start_ms, "firing", "cnt"), path, batch_id)
            after = {"top_ms": top, "rows": base if last is None else last}
            keeps = added.where(end + F.lit(late_us) > passed)
            counts.add(keeps, batch_id, after, passed - width - late_us + 1)
        finally:
            new.unpersist()
            if placed is not None:
                placed.unpersist()

    return write

"""Keyed alert logic and per-sensor profiles (batch forms of the stream processors)."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermoweave.operators.scan import BLOCK, BLOCK_ROWS, add_time_block, previous
from thermoweave.operators.windows import micros, partition_count

# Workers get the functions with the task; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the alert text, with the whole seconds of the interval inside.
RISE_MESSAGE = ("温度值连续", "秒上升")


def rise_message(interval: str) -> str:
    return f"{micros(interval) // 1_000_000}".join(RISE_MESSAGE)


def rise_alert(readings: DataFrame, interval: str = "10 seconds", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Alerts of the rise timer replayed on event time: (id, alert_ts, message).

    A rise starts a timer unless one runs, a drop stops it, equal temperatures do neither;
    before the first reading the temperature counts as 0.0. A timer due at τ fires before
    a reading at or after τ, and timers pending at the end fire. Readings without a time are compared
    with, but start and stop nothing.

    An id's readings are walked in time blocks. All that a block needs to know of earlier ones is when the
    pending timer is due. So each block first gives a table, the due time it leaves for every due time it may
    find; a pass over these rows in order tells every block its own and settles timers that outlast
    their block. No id and no stretch of rises is gathered.
    """
    wait = micros(interval)
    blocked = add_time_block(readings.select("seq", "id", "ts", "temperature"), rows=block_rows)
    compared = previous(blocked, "temperature", "last", ["id"], ["ts", "seq"], 0.0, keep_block=True)
    # Comparisons with NaN are false: such a reading neither starts nor stops a timer, it only is the last.
    known = ~F.isnan("temperature") & ~F.isnan("last")
    moved = known & (F.col("temperature") != F.col("last")) & F.col("ts").isNotNull()
    moves = compared.filter(moved).select(
        "id", *[F.col(f"{BLOCK}.{f}").alias(b) for f, b in zip(_BLOCK_FIELDS, _BLOCK_KEY, strict=True)],
        F.unix_micros("ts").alias("at"), "seq", (F.col("temperature") < F.col("last")).alias("drop"),
    )
    key = ["id", *_BLOCK_KEY]

    def steps(block_key: tuple, table: pa.Table) -> pa.Table:
        return _keyed(block_key, _Block(table, wait).steps(), _STEPS)

    def fired(block_key: tuple, table: pa.Table) -> pa.Table:
        head = table.filter(pc.is_null(table["at"])).to_pylist()[0]
        block = _Block(table.filter(pc.is_valid(table["at"])), wait)
        carried = [] if head["fired"] is None else [head["fired"]]
        return _keyed(block_key, [(due,) for due in carried + block.fired(head["due"], head["is_last"])], _FIRED)

    tables = moves.groupBy(*key).applyInArrow(steps, _ddl(_STEPS))
    ordered = tables.repartition(partition_count(tables), "id").sortWithinPartitions(*key, "found")
    heads = ordered.mapInArrow(_handed_on, _ddl(_HEADS))
    alerts = moves.unionByName(heads, allowMissingColumns=True).groupBy(*key).applyInArrow(fired, _ddl(_FIRED))
    return alerts.select(
        "id", F.timestamp_micros("alert").alias("alert_ts"), F.lit(rise_message(interval)).alias("message")
    )


_BLOCK_FIELDS, _BLOCK_KEY = ("rows_before", "ms", "inside"), ("_b0", "_b1", "_b2")
_NEVER = 1 << 62


def _schema(**more: pa.DataType) -> pa.Schema:
    return pa.schema([("id", pa.string()), *[(k, pa.int64()) for k in _BLOCK_KEY], *more.items()])


_STEPS = _schema(found=pa.int64(), left=pa.int64(), first_drop=pa.int64(), last=pa.int64())
_HEADS = _schema(due=pa.int64(), fired=pa.int64(), is_last=pa.bool_())
_FIRED = _schema(alert=pa.int64())


def _ddl(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "bigint", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _keyed(block_key: tuple, rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * (len(schema) - len(block_key))
    keys = [[k.as_py()] * len(rows) for k in block_key]
    return pa.table([pa.array(list(c), f.type) for c, f in zip([*keys, *columns], schema, strict=True)], schema=schema)


class _Block:
    """The rises of one block, and what a timer started at each of them comes to."""

    def __init__(self, table: pa.Table, wait: int) -> None:
        at, seq = (table[c].to_numpy() for c in ("at", "seq"))
        order = np.lexsort((seq, at))
        at, drop = at[order], table["drop"].to_numpy()[order].astype(bool)
        rises, drops = np.flatnonzero(~drop), np.flatnonzero(drop)
        self.rises, self.last = at[rises], int(at[-1])
        self.due = self.rises + wait
        behind = np.searchsorted(drops, rises)  # the next drop behind each rise
        stop = np.append(at[drops], _NEVER)[behind]
        self.fires = stop >= self.due
        # Without a drop behind it, a timer due after the last reading is open still.
        self.open = (stop == _NEVER) & (self.due > self.last)
        # The rise that starts a timer next: the first at or after the due time, or the first behind the drop.
        free = np.maximum(np.searchsorted(self.rises, self.due), np.arange(len(rises)) + 1)
        reset = np.searchsorted(rises, np.append(drops, len(at))[behind])
        self.next = np.where(self.fires, free, reset)
        self.first_drop = int(at[drops[0]]) if len(drops) else None
        self.after_first_drop = int(np.searchsorted(rises, drops[0])) if len(drops) else len(rises)
        self.after_last_drop = int(np.searchsorted(rises, drops[-1])) if len(drops) else 0

    def fired(self, due: int, is_last: bool) -> list[int]:
        """Due times of the timers that fire, of those started here; an open one fires if nothing follows.

        ``due`` is that of the timer pending at the start.
        """
        at, started = min(int(np.searchsorted(self.rises, due)), self.after_first_drop), []
        while at < len(self.rises):
            started.append(at)
            at = int(self.next[at])
        return self.due[[s for s in started if self.fires[s] and (is_last or not self.open[s])]].tolist()

    def steps(self) -> list[tuple]:
        """(found, left, first drop, last time): a due time found up to ``found`` leaves ``left``; beyond the
        last step it stays. A timer that is not open leaves nothing, and after a drop nothing found counts."""
        n = len(self.rises)
        last = np.arange(n)  # the last timer started from each rise on, by doubling jumps
        jump = np.append(np.where(self.next < n, self.next, np.arange(n)), n)
        for _ in range(n.bit_length()):
            last, jump = jump[last], np.append(jump[jump[:-1]], n)
        leaves = np.where(self.open, self.due, -_NEVER)[last]
        if self.first_drop is not None:
            at = self.after_last_drop
            return [(_NEVER, int(leaves[at]) if at < n else -_NEVER, self.first_drop, self.last)]
        # No due time found is further than one interval from the first rise.
        far = int(np.searchsorted(self.rises, self.due[0])) + 1
        found, left = self.rises[:far], leaves[:far]
        step = np.append(left[1:] != left[:-1], True)
        return [(f, v, None, self.last) for f, v in zip(found[step].tolist(), left[step].tolist(), strict=True)]


def _handed_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps of ids' blocks in order -> per block the due time it finds, and whether a timer from before fires by its end."""
    block, due, after, head = None, -_NEVER, None, None

    def settled(is_last: bool) -> tuple:
        first_drop, last = head
        fires = first_drop is None or first_drop >= due
        # Pending since an earlier block: it fires here, or never is heard of again.
        here = due > -_NEVER and fires and (is_last or due <= last)
        return (*block, due, due if here else None, is_last)

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        nonlocal block, due, after, head
        for *key, found, left, first_drop, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != block:
                new_id = block is None or key[0] != block[0]
                if head:
                    yield settled(new_id)
                due = -_NEVER if new_id else due if after is None else after
                head = (first_drop, last)
                block, after = key, None
            if after is None and found >= due:
                after = left

    for batch in batches:
        yield _rows_of(list(rows(batch)))
    if head:
        yield _rows_of([settled(True)])


def _rows_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_HEADS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _HEADS, strict=True)], schema=_HEADS)


BANDS = (10.0, 30.0)


def band(temperature: Column) -> Column:
    """A NaN or null temperature is above no threshold."""
    low, high = BANDS
    above = lambda bound: (temperature > bound) & ~F.isnan(temperature)
    return F.when(above(high), "high").when(above(low), "mid").otherwise("low")


def sensor_profile(readings: DataFrame, latest: int = 3) -> DataFrame:
    """Per id: last temperature, the latest few, count per band, highest ts, lowest temperature.

    Everything is a bounded partial aggregate; the latest few are cut per task before the
    shuffle, so no id is gathered whole.
    """
    t = F.col("temperature")
    base = readings.groupBy("id").agg(
        F.max_by("temperature", "seq").alias("last_temp"),
        *[
            F.count(F.when(band(t) == name, 1)).alias(f"n_{name}")
            for name in ("low", "mid", "high")
        ],
        F.max("timestamp").alias("max_timestamp"),
        F.min("temperature").alias("min_temperature"),
    )
    newest = Window.partitionBy("id").orderBy(F.desc("seq"))
    tail = (
        readings.select("id", "seq", "temperature")
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= latest)
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "temperature"))).alias("_tail"))
        .select("id", F.array_join(F.transform("_tail", lambda r: r["temperature"].cast("string")), ";").alias("latest_temps"))
    )
    return base.join(tail, base["id"].eqNullSafe(tail["id"])).drop(tail["id"])


def upsert_latest(target: DataFrame, readings: DataFrame) -> DataFrame:
    """Table (sensor, temperature) after the readings: newest arrival per sensor wins.

    Sensors without new readings keep their row.
    """
    newest = latest_by_arrival(readings)
    old = target.select("sensor", "temperature", F.lit(0).alias("_new"))
    new = newest.select(F.col("id").alias("sensor"), "temperature", F.lit(1).alias("_new"))
    return (
        old.unionByName(new)
        .groupBy("sensor")
        .agg(F.max_by("temperature", "_new").alias("temperature"))
    )


def latest_by_arrival(readings: DataFrame) -> DataFrame:
    """(id, temperature) of the last record of each id; combines on the map side."""
    return readings.groupBy("id").agg(F.max_by("temperature", "seq").alias("temperature"))

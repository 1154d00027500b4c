"""Keyed processors with state and timers.

Each handles the rows one key got in one micro-batch, in arrival order (``seq``). A
micro-batch is bounded by the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``), and
so is what a task holds for one key. State is a few numbers per key or a list whose length
is fixed by the operator.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from thermoweave.operators.alerts import BANDS, rise_message
from thermoweave.operators.windows import micros

# Workers get the classes with the task; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Frames = Iterator[pd.DataFrame]


def _arrived(rows: Frames) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values("seq", ignore_index=True)


def _run(
    stream: DataFrame,
    processor: StatefulProcessor,
    schema: str,
    time_mode: str = "none",
    key: str = "id",
    mode: str = "Append",
) -> DataFrame:
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode=mode, timeMode=time_mode
    )


class RunningSum(StatefulProcessor):
    """Every record with the sum of ``value`` up to it."""

    def __init__(self, key: str, value: str):
        self.key, self.value = key, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total double")

    def handleInputRows(self, key, rows, timerValues) -> Frames:
        pdf = _arrived(rows)
        before = self.total.get()[0] if self.total.exists() else 0.0
        sums = before + pdf[self.value].cumsum()
        self.total.update((float(sums.iloc[-1]),))
        yield pd.DataFrame({"seq": pdf["seq"], self.key: key[0], "total": sums})


def running_sum(stream: DataFrame, value: str, key: str = "id") -> DataFrame:
    return _run(
        stream.select("seq", key, F.col(value).cast("double").alias(value)),
        RunningSum(key, value),
        f"seq bigint, {key} string, total double",
        key=key,
    )


class RollingReduce(StatefulProcessor):
    """Highest timestamp and lowest temperature up to each record."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "ts bigint, temp double")

    def handleInputRows(self, key, rows, timerValues) -> Frames:
        pdf = _arrived(rows)
        high, low = pdf["timestamp"].cummax(), pdf["temperature"].cummin()
        if self.best.exists():
            ts, temp = self.best.get()
            high, low = high.clip(lower=ts), low.clip(upper=temp)
        self.best.update((int(high.iloc[-1]), float(low.iloc[-1])))
        yield pd.DataFrame(
            {"seq": pdf["seq"], "id": key[0], "max_timestamp": high, "min_temperature": low}
        )


def rolling_reduce(stream: DataFrame) -> DataFrame:
    return _run(
        stream.select("seq", "id", "timestamp", "temperature"),
        RollingReduce(),
        "seq bigint, id string, max_timestamp bigint, min_temperature double",
    )


class Changelog(StatefulProcessor):
    """Per record: withdraw the old count, then add the new one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Frames:
        pdf = _arrived(rows)
        before = self.count.get()[0] if self.count.exists() else 0
        new = before + np.arange(1, len(pdf) + 1)
        self.count.update((int(new[-1]),))
        changes = pd.DataFrame(
            {
                "seq": np.repeat(pdf["seq"].to_numpy(), 2),
                "added": np.tile([False, True], len(pdf)),
                "id": key[0],
                "cnt": np.column_stack([new - 1, new]).ravel(),
            }
        )
        yield changes[changes["cnt"] > 0]


def changelog(stream: DataFrame) -> DataFrame:
    return _run(
        stream.select("seq", "id"), Changelog(), "seq bigint, added boolean, id string, cnt bigint"
    )


class Jump(StatefulProcessor):
    """Compare each temperature with the one before it."""

    def __init__(self, threshold: float, initial: float | None, every_row: bool):
        self.threshold, self.initial, self.every_row = threshold, initial, every_row

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "temp double")

    def handleInputRows(self, key, rows, timerValues) -> Frames:
        pdf = _arrived(rows)
        first = self.last.get()[0] if self.last.exists() else self.initial
        cur = pdf["temperature"]
        last = cur.shift(1)
        last.iloc[0] = np.nan if first is None else first
        self.last.update((float(cur.iloc[-1]),))
        out = pd.DataFrame({"seq": pdf["seq"], "id": key[0], "last_temp": last, "cur_temp": cur})
        jumped = (cur - last).abs() > self.threshold
        if self.every_row:
            out.loc[~jumped, ["last_temp", "cur_temp"]] = 0.0
            yield out
        else:
            yield out[jumped]


_JUMP_SCHEMA = "seq bigint, id string, last_temp double, cur_temp double"


def _jump(stream: DataFrame, threshold: float, initial: float | None, every_row: bool) -> DataFrame:
    return _run(
        stream.select("seq", "id", "temperature"), Jump(threshold, initial, every_row), _JUMP_SCHEMA
    )


def jump_alert(stream: DataFrame, threshold: float = 10.0) -> DataFrame:
    return _jump(stream, threshold, None, False)


def jump_alert_zero_init(stream: DataFrame, threshold: float = 10.0) -> DataFrame:
    return _jump(stream, threshold, 0.0, False)


def jump_map(stream: DataFrame, threshold: float = 10.0) -> DataFrame:
    return _jump(stream, threshold, 0.0, True)


class CountWindow(StatefulProcessor):
    """At every ``every``-th record: the window of the latest ``size`` records."""

    def __init__(self, size: int, every: int):
        self.size, self.every = size, every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")
        self.latest = handle.getListState("latest", "ts bigint, temp double")

    def handleInputRows(self, key, rows, timerValues) -> Frames:
        pdf = _arrived(rows)
        kept = list(self.latest.get()) if self.latest.exists() else []
        n = self.count.get()[0] if self.count.exists() else 0
        old = pd.DataFrame(kept, columns=["timestamp", "temperature"])
        joined = pdf if old.empty else pd.concat([old, pdf], ignore_index=True)
        frame = joined[["timestamp", "temperature"]].rolling(self.size, min_periods=1)
        out = pd.DataFrame(
            {
                "seq": joined["seq"],
                "id": key[0],
                "elements": np.minimum(np.arange(1, len(joined) + 1) + n - len(old), self.size),
                "max_timestamp": frame["timestamp"].max(),
                "min_temperature": frame["temperature"].min(),
            }
        ).iloc[len(old):]
        nth = n + np.arange(1, len(pdf) + 1)
        self.count.update((int(nth[-1]),))
        tail = joined.tail(self.size - 1)
        self.latest.put([(int(t), float(x)) for t, x in zip(tail["timestamp"], tail["temperature"])])
        fired = out[nth % self.every == 0]
        yield fired.astype({"seq": "int64", "elements": "int64", "max_timestamp": "int64"})


def count_window(stream: DataFrame, size: int = 10, every: int = 2) -> DataFrame:
    return _run(
        stream.select("seq", "id", "timestamp", "temperature"),
        CountWindow(size, every),
        "seq bigint, id string, elements bigint, max_timestamp bigint, min_temperature double",
    )


class OverRows(StatefulProcessor):
    """Count and mean over each reading and the ``preceding`` earlier ones, by event time.

    Readings wait until the watermark has passed them; a timer at the earliest waiting one
    wakes the key.
    """

    def __init__(self, preceding: int):
        self.preceding = preceding

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ms bigint, seq bigint, temp double")
        self.before = handle.getListState("before", "temp double")

    def handleInputRows(self, key, rows, timerValues) -> Frames:
        fresh = []
        for pdf in rows:
            fresh += [
                (int(ms), int(seq), float(temp))
                for ms, seq, temp in zip(pdf["ms"], pdf["seq"], pdf["temperature"])
            ]
        self.waiting.appendList(fresh)
        if not list(self.handle.listTimers()):
            self.handle.registerTimer(min(ms for ms, _, _ in fresh))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Frames:
        watermark = timerValues.getCurrentWatermarkInMs()
        rows = sorted(self.waiting.get())
        due = [r for r in rows if r[0] <= watermark]
        later = rows[len(due):]
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(later[0][0])
        else:
            self.waiting.clear()
        if not due:
            return
        temps = [t for (t,) in self.before.get()] if self.before.exists() else []
        values = pd.Series(temps + [t for _, _, t in due])
        frame = values.rolling(self.preceding + 1, min_periods=1)
        out = pd.DataFrame({"cnt": frame.count().astype("int64"), "avg_temp": frame.mean()})
        out = out.iloc[len(temps):].reset_index(drop=True)
        if self.preceding:
            self.before.put([(float(t),) for t in values.tail(self.preceding)])
        out.insert(0, "ms", [ms for ms, _, _ in due])
        out.insert(0, "id", key[0])
        yield out


def over_rows(stream: DataFrame, preceding: int = 2) -> DataFrame:
    """(id, ms, cnt, avg_temp); the stream carries a watermark on ``ts``."""
    slim = stream.select("seq", "id", "ts", F.unix_millis("ts").alias("ms"), "temperature")
    return _run(
        slim, OverRows(preceding), "id string, ms bigint, cnt bigint, avg_temp double", "EventTime"
    )


class RiseAlert(StatefulProcessor):
    """A rise starts a processing-time timer, a drop stops it, and it fires as an alert."""

    def __init__(self, wait_ms: int, message: str):
        self.wait_ms, self.message = wait_ms, message

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "last double, timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Frames:
        last, timer = self.state.get() if self.state.exists() else (0.0, 0)
        now = timerValues.getCurrentProcessingTimeInMs()
        if timer and timer <= now:  # due before these rows, which Spark hands over first
            self.handle.deleteTimer(timer)
            yield self._alert(key, timer)
            timer = 0
        for temp in _arrived(rows)["temperature"]:
            if temp > last and timer == 0:
                timer = now + self.wait_ms
                self.handle.registerTimer(timer)
            elif temp < last:
                if timer:
                    self.handle.deleteTimer(timer)
                timer = 0
            last = float(temp)
        self.state.update((last, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Frames:
        last, _ = self.state.get()
        self.state.update((last, 0))
        yield self._alert(key, expiredTimerInfo.getExpiryTimeInMs())

    def _alert(self, key, at: int) -> pd.DataFrame:
        return pd.DataFrame({"id": [key[0]], "alert_ms": [at], "message": [self.message]})


def rise_alert(stream: DataFrame, interval: str = "10 seconds") -> DataFrame:
    """(id, alert_ms, message). Start it with an interval: processing-time timers never let a run of
    everything available end."""
    return _run(
        stream.select("seq", "id", "temperature"),
        RiseAlert(micros(interval) // 1000, rise_message(interval)),
        "id string, alert_ms bigint, message string",
        "ProcessingTime",
    )


class SensorProfile(StatefulProcessor):
    """One of each kind of state: last value, latest few, count per band, running extremes."""

    def __init__(self, latest: int):
        self.latest = latest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.extremes = handle.getValueState("extremes", "last double, ts bigint, low double")
        self.tail = handle.getListState("tail", "temp double")
        self.bands = handle.getMapState("bands", "band string", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Frames:
        pdf = _arrived(rows)
        temps = pdf["temperature"]
        ts, low = int(pdf["timestamp"].max()), float(temps.min())
        if self.extremes.exists():
            _, ts0, low0 = self.extremes.get()
            ts, low = max(ts, ts0), min(low, low0)
        last = float(temps.iloc[-1])
        self.extremes.update((last, ts, low))

        tail = [t for (t,) in self.tail.get()] if self.tail.exists() else []
        tail = (tail + [float(t) for t in temps])[-self.latest:]
        self.tail.put([(t,) for t in tail])

        cold, hot = BANDS
        named = np.select([temps > hot, temps > cold], ["high", "mid"], "low")
        counts = {}
        for name in ("low", "mid", "high"):
            before = self.bands.getValue((name,))[0] if self.bands.containsKey((name,)) else 0
            counts[name] = before + int((named == name).sum())
            self.bands.updateValue((name,), (counts[name],))
        yield pd.DataFrame(
            {
                "id": [key[0]],
                "last_temp": [last],
                "latest_temps": [";".join(str(t) for t in tail)],
                "n_low": [counts["low"]],
                "n_mid": [counts["mid"]],
                "n_high": [counts["high"]],
                "max_timestamp": [ts],
                "min_temperature": [low],
            }
        )


def sensor_profile(stream: DataFrame, latest: int = 3) -> DataFrame:
    """The profile of every id a micro-batch touched (update mode)."""
    return _run(
        stream.select("seq", "id", "timestamp", "temperature"),
        SensorProfile(latest),
        "id string, last_temp double, latest_temps string, n_low bigint, n_mid bigint, "
        "n_high bigint, max_timestamp bigint, min_temperature double",
        mode="Update",
    )


class LateFirings(StatefulProcessor):
    """Sliding counts: one result when the watermark passes a window, one per late reading.

    Spark's watermark trails far enough (``delay + lateness + size``) that it drops only
    readings no window wants; the watermark meant by the job is that one plus ``hold_ms``.
    """

    def __init__(self, size_ms: int, slide_ms: int, late_ms: int):
        self.size_ms, self.slide_ms, self.late_ms = size_ms, slide_ms, late_ms
        self.hold_ms = late_ms + size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start bigint", "n bigint, fired boolean")

    def _watermark(self, timerValues) -> int:
        wm = timerValues.getCurrentWatermarkInMs()
        return wm + self.hold_ms if wm > 0 else -(2**62)

    def _due(self, key, wm: int) -> list[tuple]:
        """Regular results of the windows the watermark has passed; forgets finished ones."""
        out = []
        for (start,), (n, fired) in list(self.open.iterator()):
            last_ms = start + self.size_ms - 1
            if last_ms <= wm and not fired:
                out.append((key[0], start, n))
                self.open.updateValue((start,), (n, True))
            if last_ms + self.late_ms <= wm:
                self.open.removeKey((start,))
        return out

    def _results(self, out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["id", "window_start_ms", "cnt"])
        return frame.astype({"window_start_ms": "int64", "cnt": "int64"})

    def handleInputRows(self, key, rows, timerValues) -> Frames:
        wm = self._watermark(timerValues)
        out, timers = self._due(key, wm), set()
        for ms in _arrived(rows)["ms"]:
            start = int(ms) - int(ms) % self.slide_ms
            while start + self.size_ms > ms:
                last_ms = start + self.size_ms - 1
                if last_ms + self.late_ms > wm:
                    held = self.open.containsKey((start,))
                    n = self.open.getValue((start,))[0] if held else 0
                    late = last_ms <= wm
                    self.open.updateValue((start,), (n + 1, late))
                    if late:
                        out.append((key[0], start, n + 1))
                    elif not held:
                        timers.add(last_ms - self.hold_ms)
                    if not held:
                        timers.add(last_ms + self.late_ms - self.hold_ms)
                start -= self.slide_ms
        for at in timers:
            self.handle.registerTimer(at)
        yield self._results(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Frames:
        yield self._results(self._due(key, self._watermark(timerValues)))


def late_firings(
    stream: DataFrame,
    size: str = "15 seconds",
    slide: str = "5 seconds",
    delay: str = "1 second",
    lateness: str = "1 minute",
) -> DataFrame:
    """(id, window_start_ms, cnt) per firing. Sets its own watermark on ``ts``."""
    size_ms, slide_ms, late_ms = (micros(d) // 1000 for d in (size, slide, lateness))
    held = f"{micros(delay) // 1000 + late_ms + size_ms} milliseconds"
    slim = stream.select("seq", "id", "ts", F.unix_millis("ts").alias("ms"))
    return _run(
        slim.withWatermark("ts", held),
        LateFirings(size_ms, slide_ms, late_ms),
        "id string, window_start_ms bigint, cnt bigint",
        "EventTime",
    )

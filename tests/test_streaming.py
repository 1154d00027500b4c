"""Streams over files, one file per micro-batch, against goldens and the batch operators."""

import json
import os
import random
import tempfile
import time

import pytest
from sample import BASE, SAMPLE
from pyspark.sql import functions as F

from thermoweave.operators import alerts, rolling, windows
from thermoweave.operators.project import rename_project
from thermoweave.sinks import payloads
from thermoweave.sinks.upsert import merge_statement, upsert_batches, upsert_table
from thermoweave.sources.log import decode_log, log_table
from thermoweave.streaming import batches, processors, sources, starters
from thermoweave.streaming import eventtime as st
from thermoweave.streaming.wordcount import word_count_per_record, word_count_stream

S1 = "sensor_1"


def write_files(batches_of_lines, folder=None):
    """One text file per micro-batch, aged so that the source takes them in order."""
    folder = folder or tempfile.mkdtemp(prefix="stream-")
    start = len(os.listdir(folder))
    for i, lines in enumerate(batches_of_lines, start=start):
        path = f"{folder}/part-{i:04d}.txt"
        with open(path, "w") as f:
            f.write("".join(f"{line}\n" for line in lines))
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    return folder


def as_lines(rows):
    return [f"{i},{BASE + s},{t}" for i, s, t in rows]


def chunks(rows, n):
    return [as_lines(rows[i:i + n]) for i in range(0, len(rows), n)]


def readings(spark, folder):
    return sources.stream_readings(spark, folder, "s", arrival=True)


_names = iter(range(10_000))


def drain(stream, mode="append", checkpoint=None):
    """Run over everything available; the emitted rows of all micro-batches in order."""
    name = f"drained_{next(_names)}"
    seen = []

    def keep(batch, batch_id):
        seen.extend(tuple(r) for r in batch.collect())

    query = starters.to_batches(
        stream, keep, checkpoint or tempfile.mkdtemp(prefix=f"cp-{name}-"), mode, every=None
    )
    try:
        assert query.awaitTermination(120)
        assert query.exception() is None
    finally:
        query.stop()
    return seen


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(11)
    return [
        (rng.choice(["s1", "s1", "s1", "s2", "s3"]), 10 * i + rng.randrange(10), round(rng.uniform(5, 60), 1))
        for i in range(60)
    ]


# ---------------------------------------------------------------- per-record operators


RECORD_OPERATORS = {
    "sum": (lambda s: processors.running_sum(s, "temperature"),
            lambda b: rolling.rolling_sum(b, "temperature").select("seq", "id", "total")),
    "reduce": (processors.rolling_reduce, rolling.rolling_reduce),
    "changelog": (processors.changelog, rolling.changelog_count),
    "jump": (processors.jump_alert, rolling.jump_alert),
    "jump_zero": (processors.jump_alert_zero_init, rolling.jump_alert_zero_init),
    "jump_map": (processors.jump_map, rolling.jump_map),
    "count_window": (processors.count_window, windows.count_window),
}


@pytest.mark.parametrize("name", sorted(RECORD_OPERATORS))
def test_stream_equals_batch(spark, make, random_rows, name):
    on_stream, on_batch = RECORD_OPERATORS[name]
    got = drain(on_stream(readings(spark, write_files(chunks(random_rows, 25)))))
    want = [tuple(r) for r in on_batch(make(random_rows)).collect()]
    # Arrival numbers start again in every micro-batch, so they are left out.
    clean = lambda rows: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r[1:]) for r in rows)
    assert clean(got) == clean(want)


def test_profile_stream(spark, make, random_rows):
    got = drain(processors.sensor_profile(readings(spark, write_files(chunks(random_rows, 20)))), "update")
    last = {r[0]: r for r in got}  # a later micro-batch replaces an earlier one
    want = alerts.sensor_profile(make(random_rows)).select(
        "id", "last_temp", "latest_temps", "n_low", "n_mid", "n_high", "max_timestamp", "min_temperature"
    )
    assert last == {r[0]: tuple(r) for r in want.collect()}


def test_restart_goes_on_from_the_checkpoint(spark, random_rows):
    folder = write_files(chunks(random_rows[:30], 15))
    checkpoint = tempfile.mkdtemp(prefix="cp-restart-")
    first = drain(processors.jump_alert(readings(spark, folder)), checkpoint=checkpoint)
    write_files(chunks(random_rows[30:], 15), folder)
    second = drain(processors.jump_alert(readings(spark, folder)), checkpoint=checkpoint)
    whole = drain(processors.jump_alert(readings(spark, write_files(chunks(random_rows, 15)))))
    assert second and sorted(r[1:] for r in first + second) == sorted(r[1:] for r in whole)


def test_word_counts(spark):
    folder = write_files([["hello world", "hello  spark"], ["hello you"]])
    updates = drain(word_count_stream(sources.stream_lines(spark, folder, 1)), "update")
    assert dict(updates) == {"hello": 3, "world": 1, "spark": 1, "you": 1}
    assert ("hello", 2) in updates
    each = drain(word_count_per_record(sources.stream_lines(spark, folder, 1)))
    assert sorted(r[1:] for r in each) == [
        ("hello", 1), ("hello", 2), ("hello", 3), ("spark", 1), ("world", 1), ("you", 1)
    ]


def test_group_count_update(spark):
    got = drain(st.group_count_stream(readings(spark, write_files(chunks(SAMPLE, 2)))), "update")
    assert dict(got) == {S1: 3, "sensor_6": 1, "sensor_7": 1, "sensor_10": 1}
    assert (S1, 2) in got


# ---------------------------------------------------------------- windows and lateness


FLUSH = [as_lines([("flush", 9_000, 0)]), as_lines([("flush", 9_001, 0)])]


def no_flush(rows):
    return sorted(r for r in rows if r[0] != "flush")


def test_windows_equal_batch(spark, make, random_rows):
    ordered = chunks(random_rows, 20) + FLUSH
    batch = make(random_rows)
    pairs = [
        (lambda s: st.tumble_stream(s, "30 seconds"), windows.tumble_count(batch, "30 seconds")),
        (lambda s: st.slide_stream(s), windows.slide_count_keyed(batch)),
        (lambda s: st.reduce_stream(s), windows.slide_reduce(batch)),
        (lambda s: st.session_stream(s, "25 seconds"), windows.session_count(batch, "25 seconds")),
        (lambda s: st.offset_stream(s, "1 minute", "-10 seconds"),
         windows.tumble_offset(batch, "1 minute", "-10 seconds").drop("window_end")),
    ]
    for on_stream, want in pairs:
        stream = st.bounded_disorder(readings(spark, write_files(ordered)), "10 seconds")
        got = no_flush(drain(on_stream(stream)))
        assert got == sorted(tuple(r) for r in want.select(*on_stream(stream).columns).collect())


LATE_FILES = [[(S1, 100, 1), (S1, 101, 1), ("s2", 102, 1)], [(S1, 200, 1)], [(S1, 201, 1)], [(S1, 103, 1), ("s2", 202, 1)]]


@pytest.mark.parametrize("with_third", [True, False])
def test_late_rows_at_micro_batch_granularity(spark, with_third):
    files = [as_lines(f) for i, f in enumerate(LATE_FILES) if with_third or i != 2]
    stream = st.bounded_disorder(readings(spark, write_files(files + FLUSH)))
    got = drain(st.slide_stream(stream))
    at = {(i, ms // 1000 - BASE): n for i, ms, n in got}
    for start in (90, 95, 100):
        assert at[("s2", start)] == 1
        assert at[(S1, start)] == (2 if with_third else 3)


def test_ascending_and_punctuated(spark):
    files = chunks([("a", 0, 1), ("a", 5, 1), ("a", 20, 1)], 1)
    done = drain(st.tumble_stream(st.ascending(readings(spark, write_files(files)))))
    assert [(i, n) for i, n, _ in done] == [("a", 2)]

    # Only the marker id moves the watermark: the far-ahead "b" does not make "a" late.
    rows = [[("b", 900, 1)], [("b", 901, 1)], [("a", 5, 1)], [(S1, 950, 1)], [(S1, 951, 1)], [(S1, 952, 1)]]
    marked = st.punctuated(readings(spark, write_files([as_lines(r) for r in rows])))
    counted = marked.groupBy("id", F.window("ts", "10 seconds")).count()
    updates = drain(counted.select("id", "count"), "update")
    assert ("a", 1) in updates


def test_late_updates(spark):
    rows = [[("a", 100, 1)], [("a", 120, 1)], [("a", 121, 1)], [("a", 101, 1)]]
    got = drain(st.late_updates(readings(spark, write_files([as_lines(r) for r in rows]))), "update")
    # 101 comes long after the watermark passed its windows and still updates them
    assert ("a", (BASE + 100) * 1000, 2) in got


def test_late_firings(spark):
    rows = [[("a", 100, 1), ("a", 112, 1)], [("a", 200, 1)], [("a", 201, 1)], [("a", 138, 1)],
            [("a", 123, 1), ("a", 139, 1)], [("a", 9_000, 0)], [("a", 9_001, 0)]]
    got = drain(processors.late_firings(readings(spark, write_files([as_lines(r) for r in rows]))))
    seen = sorted((ms // 1000 - BASE, n) for _, ms, n in got)
    # 138 and 139 meet the watermark 200: the window of 125 is gone, 130 and 135 fire again.
    assert [x for x in seen if x[0] < 300] == [
        (90, 1), (95, 1), (100, 2), (105, 1), (110, 1),
        (130, 1), (130, 2), (135, 1), (135, 2),
        (190, 2), (195, 2), (200, 2),
    ]


def test_over_rows_stream(spark, make, random_rows):
    stream = st.bounded_disorder(readings(spark, write_files(chunks(random_rows, 20) + FLUSH)), "10 seconds")
    got = no_flush(drain(processors.over_rows(stream)))
    want = windows.over_rows(make(random_rows)).select("id", F.unix_millis("ts"), "cnt", "avg_temp")
    clean = lambda rows: sorted((i, ms, n, round(x, 6)) for i, ms, n, x in rows)
    assert clean(got) == clean(want.collect())


def test_route_late(spark):
    late_rows = [("a", s, 1) for s in (100, 200, 138, 123, 124, 125)]
    out = {n: tempfile.mkdtemp(prefix=f"{n}-") for n in ("on_time", "late", "state")}
    write = batches.route_late(spark, out["on_time"], out["late"], out["state"])
    query = starters.to_batches(
        readings(spark, write_files(chunks(late_rows, 1))), write, tempfile.mkdtemp(), every=None
    )
    assert query.awaitTermination(120)
    seconds = lambda path: sorted(r[0] - BASE for r in spark.read.parquet(path).select("timestamp").collect())
    assert seconds(out["late"]) == [123, 124]
    assert seconds(out["on_time"]) == [100, 125, 138, 200]


def test_number_records(spark, random_rows):
    out, state = tempfile.mkdtemp(prefix="num-"), tempfile.mkdtemp(prefix="state-")
    folder = write_files(chunks(random_rows[:40], 20))
    checkpoint = tempfile.mkdtemp()
    for more in ([], chunks(random_rows[40:], 20)):
        write_files(more, folder)
        write = batches.number_records(spark, out, state)
        assert starters.to_batches(readings(spark, folder), write, checkpoint, every=None).awaitTermination(120)
    got = spark.read.parquet(out)
    assert sorted(r.n for r in got.collect()) == list(range(1, 61))
    # repeating a micro-batch replaces its folder
    again = batches.number_records(spark, out, state)
    again(got.filter("batch = 1").drop("n", "batch"), 1)
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == list(range(1, 61))


# ---------------------------------------------------------------- timers


def test_rise_alert_timer(spark):
    folder = write_files([[f"a,{BASE},5.0", f"b,{BASE},5.0", f"c,{BASE},-1.0"], [f"b,{BASE + 1},4.0"]])
    seen = []
    query = starters.to_batches(
        processors.rise_alert(readings(spark, folder), "6 seconds"),
        lambda batch, _: seen.extend(tuple(r) for r in batch.collect()),
        tempfile.mkdtemp(),
        every="200 milliseconds",
    )
    try:
        deadline = time.time() + 60
        while not seen and time.time() < deadline:
            time.sleep(0.3)
        time.sleep(1.5)
    finally:
        query.stop()
    # b dropped before its timer was due, c never rose
    assert [(r[0], r[2]) for r in seen] == [("a", "温度值连续6秒上升")]


# ---------------------------------------------------------------- sources and sinks


def test_message_stream(spark):
    folder = tempfile.mkdtemp(prefix="log-")
    for i, (sensor, ms) in enumerate([("sensor_1", 1547718199000), ("sensor_2", 1547718200000)]):
        with open(f"{folder}/{i}.json", "w") as f:
            f.write(json.dumps({"key": f"key-{i}", "value": f"{sensor},{ms},35.8"}) + "\n")
    got = drain(decode_log(sources.stream_messages(spark, folder)).select("id", "timestamp", "temperature"))
    assert sorted(got) == [("sensor_1", 1547718199000, 35.8), ("sensor_2", 1547718200000, 35.8)]
    table = log_table(sources.stream_messages(spark, folder), "log_stream")
    assert sorted(drain(table)) == sorted(got)
    filtered = spark.sql("SELECT id, temperature FROM log_stream WHERE id = 'sensor_1'")
    assert drain(filtered) == [("sensor_1", 35.8)]


def test_file_sinks(spark):
    folder = write_files(chunks(SAMPLE, 3))
    text, csv = tempfile.mkdtemp(prefix="text-"), tempfile.mkdtemp(prefix="csv-")
    query = starters.to_files(payloads.record_text(readings(spark, folder)), text, tempfile.mkdtemp(), every=None)
    assert query.awaitTermination(120)
    assert spark.read.text(text).count() == 6
    selected = rename_project(readings(spark, folder)).filter("id = 'sensor_1'").select("id", "temp")
    assert starters.to_csv_table(selected, csv, tempfile.mkdtemp(), every=None).awaitTermination(120)
    assert sorted(r[0] for r in spark.read.text(csv).collect()) == [
        "sensor_1,35.0", "sensor_1,35.8", "sensor_1,39.8"
    ]
    with pytest.raises(ValueError):
        starters.to_csv_table(readings(spark, folder), csv, tempfile.mkdtemp())


def test_console_and_interval_trigger(spark):
    query = starters.to_console(readings(spark, write_files(chunks(SAMPLE, 6))), "result")
    try:
        query.processAllAvailable()
        assert query.name == "result"
        done = [p for p in query.recentProgress if p["numInputRows"] == 6]
        assert done and "ConsoleTable" in done[0]["sink"]["description"]
    finally:
        query.stop()


def test_append_mode_rejects_updating_results(spark):
    with pytest.raises(Exception, match="(?i)append"):
        drain(st.group_count_stream(readings(spark, write_files(chunks(SAMPLE, 6)))), "append")


def test_side_outputs(spark):
    main, side = tempfile.mkdtemp(prefix="main-"), tempfile.mkdtemp(prefix="side-")
    write = batches.write_sides(main, side)
    assert starters.to_batches(readings(spark, write_files(chunks(SAMPLE, 2))), write, tempfile.mkdtemp(), every=None).awaitTermination(120)
    assert spark.read.parquet(main).count() == 4
    assert sorted(r.id for r in spark.read.parquet(side).collect()) == ["sensor_6", "sensor_7"]


def test_upsert_stream(spark):
    table = upsert_table(spark, tempfile.mkdtemp(prefix="table-"))
    rows = SAMPLE + [(S1, 300, 20.5), ("sensor_8", 301, 1.5)]
    query = starters.to_batches(readings(spark, write_files(chunks(rows, 3))), upsert_batches(table), tempfile.mkdtemp(), every=None)
    assert query.awaitTermination(120)
    want = {S1: 20.5, "sensor_10": 38.1, "sensor_6": 15.4, "sensor_7": 6.7, "sensor_8": 1.5}
    assert dict(map(tuple, table.read().collect())) == want
    # a micro-batch that runs twice changes nothing
    again = spark.createDataFrame([(S1, 20.5, 0), ("sensor_8", 1.5, 1)], "id string, temperature double, seq bigint")
    upsert_batches(table)(again, 2)
    assert dict(map(tuple, table.read().collect())) == want
    assert "WHEN NOT MATCHED THEN INSERT" in merge_statement("temp", "staged")


def test_hook_sends_every_row(spark):
    folder = tempfile.mkdtemp(prefix="sent-")

    def send(rows):
        lines = [f"{r.field}={r.value}" for r in rows]
        if lines:
            fd, _ = tempfile.mkstemp(dir=folder)
            with os.fdopen(fd, "w") as f:
                f.write("\n".join(lines))

    write = batches.send_rows(payloads.hash_entries, send)
    query = starters.to_batches(readings(spark, write_files(chunks(SAMPLE, 6))), write, tempfile.mkdtemp(), every=None)
    assert query.awaitTermination(120)
    sent = sorted(line for f in os.listdir(folder) for line in open(f"{folder}/{f}").read().split("\n"))
    assert sent == sorted(["sensor_1=39.8", "sensor_10=38.1", "sensor_6=15.4", "sensor_7=6.7"])


def test_files_of_one_folder_arrive_by_age_whatever_their_size(spark):
    """The older file is the smaller one: packing files by size would number it last."""
    folder = tempfile.mkdtemp()
    for i, lines in enumerate([[("a", 1, 10.0)], [("a", 2, 20.0), ("a", 3, 30.0), ("a", 4, 40.0)]]):
        path = f"{folder}/part-{i}.txt"
        with open(path, "w") as f:
            f.write("".join(f"{line}\n" for line in as_lines(lines)))
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    got = drain(processors.running_sum(readings(spark, folder), "temperature"))
    assert [r[-1] for r in got] == [10.0, 30.0, 60.0, 100.0]
    several = sources.stream_readings(spark, folder, arrival=True, files_per_trigger=2)
    assert set(sources.PLACE) <= set(several.columns)


class FakeState:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class FakeHandle:
    def __init__(self):
        self.timers = set()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class FakeClock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_due_timer_fires_before_a_drop_of_the_same_micro_batch():
    import pandas as pd

    alert = processors.RiseAlert(6000, "up")
    alert.handle, alert.state = FakeHandle(), FakeState()

    def feed(now, *temperatures):
        rows = pd.DataFrame({"seq": range(len(temperatures)), "temperature": temperatures})
        return [r for out in alert.handleInputRows(("a",), iter([rows]), FakeClock(now)) for r in out.alert_ms]

    assert feed(5000, 20.0) == [] and alert.handle.timers == {11000}
    assert feed(12000, 15.0) == [11000] and alert.handle.timers == set()
    assert feed(13000, 16.0, 15.0) == [] and alert.handle.timers == set()

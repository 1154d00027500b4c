"""Event-time operators on micro-batches of many files, against the batch operators, and the tables rows wait in."""

import json
import os
import random
import sys
import tempfile

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from sample import BASE

from thermoweave.operators import eventtime, windows
from thermoweave.sinks.timed import TimedTable
from thermoweave.streaming import sources, starters, timed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE, SLIDE = "15 seconds", "5 seconds"
SCHEMA = "cnt bigint, total double, newest bigint"


def fold(_id, _start_ms, elements):
    """A user function that sees every element of a window, batch by batch."""
    n, total, newest = 0, 0.0, 0
    for batch in elements:
        n += batch.num_rows
        total += sum(batch.column("temperature").to_pylist())
        newest = max([newest, *batch.column("timestamp").to_pylist()])
    yield pa.RecordBatch.from_pydict({"cnt": [n], "total": [total], "newest": [newest]})


@pytest.fixture(scope="module")
def rows():
    """Times rise with a disorder of at most 20 seconds; a third of the rows on one id, ties, and an end far ahead."""
    rng = random.Random(9)
    body = [
        (rng.choice(["hot", "hot", *(f"s{k}" for k in range(4))]), i // 2 + rng.randrange(20), round(rng.uniform(0, 50), 1))
        for i in range(400)
    ]
    return [*body, ("end", 9000, 1.0)]


def files_of(rows, n=9):
    return [rows[i:i + n] for i in range(0, len(rows), n)]


def write_files(files, folder, start=0):
    for i, part in enumerate(files, start=start):
        path = f"{folder}/{'zyxw'[i % 4]}-{10_000 - i}.txt"
        with open(path, "w") as f:
            f.write("".join(f"{s},{BASE + at},{t}\n" for s, at, t in part))
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))


def run(spark, writer, folder, home):
    stream = sources.stream_readings(spark, folder, "s", files_per_trigger=20, arrival=True)
    query = starters.to_batches(stream, writer(home), f"{home}/checkpoint", every=None)
    try:
        assert query.awaitTermination(300)
        assert query.exception() is None
    finally:
        query.stop()


def streamed(spark, writer, rows):
    """Results after two starts of the stream, 20 files a micro-batch."""
    folder, home = tempfile.mkdtemp(prefix="feed-"), tempfile.mkdtemp(prefix="timed-")
    files = files_of(rows)
    write_files(files[:25], folder)
    run(spark, writer, folder, home)
    write_files(files[25:], folder, start=25)
    run(spark, writer, folder, home)
    return spark.read.parquet(f"{home}/out"), home


def placed(make, parts):
    """Micro-batches as plain rows with their place."""
    out = []
    for k, part in enumerate(parts):
        place = {"_time": F.lit(k).cast("bigint"), "_feed": F.lit("f"), "_part": F.lit(0).cast("bigint")}
        out.append(make(part).withColumnRenamed("seq", "_at").withColumns(place))
    return out


def clean(df, columns):
    picked = df.select(*columns).collect()
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in picked), key=str)


def apply_writer(spark, delay):
    return lambda home: timed.window_apply_batches(spark, fold, SCHEMA, f"{home}/out", f"{home}/state", SIZE, SLIDE, delay)


def over_writer(spark, delay, preceding=2, block_rows=16):
    return lambda home: timed.over_rows_batches(
        spark, f"{home}/out", f"{home}/state", preceding, delay, "30 seconds", block_rows
    )


def late_writer(spark, delay="3 seconds", lateness="8 seconds"):
    return lambda home: timed.late_firing_batches(
        spark, f"{home}/out", f"{home}/state", SIZE, SLIDE, delay, lateness, block_rows=16
    )


WINDOW = ["id", "window_start_ms", "cnt", "total", "newest"]
FIRING = ["id", "window_start_ms", "firing", "cnt"]
OVER = ["seq", "id", "ts", "cnt", "avg_temp"]


def test_whole_windows_of_a_stream_equal_the_batch(spark, make, rows):
    got, _ = streamed(spark, apply_writer(spark, "20 seconds"), rows)
    want = windows.slide_apply(make(rows), fold, SCHEMA, SIZE, SLIDE).where("id != 'end'")
    assert got.select("batch").distinct().count() >= 3
    assert clean(got, WINDOW) == clean(want, WINDOW)


def test_a_late_row_is_in_the_windows_that_have_not_passed(spark, make):
    parts = [[("a", 0, 1.0), ("a", 16, 2.0)], [("a", 4, 8.0), ("a", 12, 4.0)], [("a", 100, 0.0)]]
    home = tempfile.mkdtemp(prefix="timed-")
    write = apply_writer(spark, "1 second")(home)
    for k, df in enumerate(placed(make, parts)):
        write(df, k)
    got = {
        r.window_start_ms // 1000 - BASE: (r.cnt, r.total) for r in spark.read.parquet(f"{home}/out").collect()
    }
    # The watermark 15 s passed the windows up to start 0 in the first micro-batch.
    assert got == {-10: (1, 1.0), -5: (1, 1.0), 0: (1, 1.0), 5: (2, 6.0), 10: (2, 6.0), 15: (1, 2.0)}


@pytest.mark.parametrize("preceding", [0, 2])
def test_rows_before_on_a_stream_equal_the_batch(spark, make, rows, preceding):
    got, _ = streamed(spark, over_writer(spark, "20 seconds", preceding), rows)
    want = windows.over_rows(make(rows), preceding).where("id != 'end'")
    columns = OVER[1:]  # arrival numbers start elsewhere
    assert clean(got, columns) == clean(want, columns)


def test_late_firings_of_a_stream_equal_the_replay(spark, make, rows):
    got, _ = streamed(spark, late_writer(spark), rows)
    replay = eventtime.lateness_firings(make(rows), SIZE, SLIDE, "3 seconds", "8 seconds").where("id != 'end'")
    assert replay.where("firing > 0").count() > 20
    assert clean(got, FIRING) == clean(replay, FIRING)


@pytest.mark.parametrize("name", ["apply", "over", "late"])
def test_a_repeated_micro_batch_leaves_each_result_once(spark, make, rows, name):
    writer, columns, want = {
        "apply": (apply_writer(spark, "20 seconds"), WINDOW, windows.slide_apply(make(rows), fold, SCHEMA, SIZE, SLIDE)),
        "over": (over_writer(spark, "20 seconds"), OVER[1:], windows.over_rows(make(rows))),
        "late": (late_writer(spark), FIRING, eventtime.lateness_firings(make(rows), SIZE, SLIDE, "3 seconds", "8 seconds")),
    }[name]
    home = tempfile.mkdtemp(prefix="timed-")
    write = writer(home)
    parts = placed(make, [rows[:150], rows[150:160], [], rows[160:]])
    for k in (0, 0, 1, 2, 2, 3, 3):
        write(parts[k], k)
    assert clean(spark.read.parquet(f"{home}/out"), columns) == clean(want.where("id != 'end'"), columns)


@pytest.mark.parametrize("writer", [apply_writer, over_writer, late_writer])
def test_empty_micro_batches_and_rows_without_a_time(spark, make, writer):
    home = tempfile.mkdtemp(prefix="timed-")
    write = writer(spark, "1 second")(home)
    untimed = make([("a", 0, 1.0)]).withColumn("ts", F.lit(None).cast("timestamp")).drop("seq")
    place = {"_at": F.lit(0).cast("bigint"), "_time": F.lit(0).cast("bigint"), "_feed": F.lit("f"), "_part": F.lit(0).cast("bigint")}
    write(placed(make, [[]])[0], 0)
    write(untimed.withColumns(place), 1)
    assert spark.read.parquet(f"{home}/out").count() == 0
    write(placed(make, [[("a", 0, 1.0), (None, 1, 2.0), ("b", 500, 1.0)]])[0], 2)
    assert {r.id for r in spark.read.parquet(f"{home}/out").collect()} == {"a", None}


def test_waiting_rows_are_written_once_and_go_when_they_have_passed(spark):
    path = tempfile.mkdtemp(prefix="table-")
    table = TimedTable(spark, path, "at bigint, name string", "at", 100)

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "at bigint, name string")

    def segment(version):
        folder = f"{path}/segments/_version={version}"
        return sorted(n for n in os.listdir(folder) if n.startswith("_interval"))

    table.add(rows((-5, "a"), (10, "b"), (250, "c")), 0, {"k": 0}, -(2**62))
    table.add(rows((20, "d")), 1, {"k": 1}, 0)
    assert segment(1) == ["_interval=0"]  # nothing that waits is written again
    read = lambda *a: sorted(r.name for r in table.read(*a).collect())
    assert read(None, -1000, 1000) == ["b", "c", "d"]
    assert read(1, -1000, 1000) == ["a", "b", "c"]
    assert read(None, 11, 250) == ["d"]
    assert read(None, 0, 1000, [2]) == ["c"]
    for version in range(2, 6):
        table.add(rows((900 + version, "e")), version, {}, 800)
    assert sorted(os.listdir(f"{path}/segments")) == [f"_version={v}" for v in range(2, 6)]
    manifests = [n for n in os.listdir(f"{path}/manifests") if n.endswith(".json")]
    assert len(manifests) == table.kept
    with open(f"{path}/manifests/{max(manifests)}") as f:
        assert json.load(f)["segments"] == {"9": [2, 3, 4, 5]}

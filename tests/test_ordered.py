"""Ordered operators on micro-batches of many files, and the keyed tables they carry state in."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from sample import BASE

from thermoweave.operators import rolling, windows
from thermoweave.sinks.keyed import KeyedTable
from thermoweave.sinks.upsert import upsert_batches, upsert_table
from thermoweave.streaming import batches, ordered, sources, starters


def write_aged(files, folder, start=0):
    """Files whose names sort against their age: only the time tells their order."""
    for i, lines in enumerate(files, start=start):
        path = f"{folder}/{'zyxw'[i % 4]}-{10_000 - i}.txt"
        with open(path, "w") as f:
            f.write("".join(f"{line}\n" for line in lines))
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))


@pytest.fixture(scope="module")
def feed():
    """64 files of mixed size, a third of all rows on one id, some ids null-like; and the rows in arrival order."""
    rng = random.Random(5)
    rows, files = [], []
    for i in range(64):
        part = [
            (rng.choice(["hot", "hot", *(f"s{k}" for k in range(5))]), rng.randrange(4000), round(rng.uniform(-5, 60), 1))
            for _ in range(rng.choice([0, 1, 2, 5, 30]))
        ]
        rows += part
        files.append([f"{i},{BASE + s},{t}" for i, s, t in part])
    return files, rows


OPERATORS = {
    "sum": (ordered.running_sum("temperature"), lambda b: rolling.rolling_sum(b, "temperature").select("seq", "id", "total")),
    "reduce": (ordered.ROLLING_REDUCE, rolling.rolling_reduce),
    "min_by": (ordered.ROLLING_MIN_BY, rolling.rolling_min_by),
    "changelog": (ordered.CHANGELOG, rolling.changelog_count),
    "jump": (ordered.jump_alert(), rolling.jump_alert),
    "jump_map": (ordered.jump_map(), rolling.jump_map),
    "count_window": (ordered.count_window(4, 3), lambda b: windows.count_window(b, 4, 3)),
    "count_window_of_one": (ordered.count_window(1, 2), lambda b: windows.count_window(b, 1, 2)),
}


def run(spark, operator, folder, home, files):
    stream = sources.stream_readings(spark, folder, "s", files_per_trigger=files, arrival=True)
    write = ordered.ordered_batches(spark, operator, f"{home}/out", f"{home}/state", block_rows=16)
    query = starters.to_batches(stream, write, f"{home}/checkpoint", every=None)
    try:
        assert query.awaitTermination(300)
        assert query.exception() is None
    finally:
        query.stop()


def clean(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_many_files_at_once_equal_one_at_a_time(spark, make, feed, name):
    """The first 40 files come as one micro-batch, after a restart the rest as another."""
    operator, on_batch = OPERATORS[name]
    files, rows = feed
    folder, home = tempfile.mkdtemp(prefix="feed-"), tempfile.mkdtemp(prefix="ordered-")
    write_aged(files[:40], folder)
    run(spark, operator, folder, home, 64)
    write_aged(files[40:], folder, start=40)
    run(spark, operator, folder, home, 64)
    got = spark.read.parquet(f"{home}/out")
    assert got.select("batch").distinct().count() == 2
    want = on_batch(make(rows))
    assert clean(got.select(*want.columns).collect()) == clean(want.collect())


def test_a_repeated_micro_batch_leaves_each_row_once(spark, make, feed):
    files, rows = feed
    home, placed = tempfile.mkdtemp(prefix="ordered-"), []
    for k, part in enumerate((rows[:200], rows[200:300], rows[300:])):
        df = make(part).drop("ts").withColumnRenamed("seq", "_at").withColumns(
            {"_time": F.lit(k).cast("bigint"), "_feed": F.lit("f"), "_part": F.lit(0).cast("bigint")}
        )
        placed.append(df)
    write = ordered.ordered_batches(spark, ordered.running_sum("temperature"), f"{home}/out", f"{home}/state", 16)
    for k in (0, 1, 1, 2, 2):
        write(placed[k], k)
    got = spark.read.parquet(f"{home}/out").select("seq", "id", "total")
    want = rolling.rolling_sum(make(rows), "temperature").select("seq", "id", "total")
    assert clean(got.collect()) == clean(want.collect())


def test_log_rows_are_numbered_by_partition_and_offset(spark):
    rows = [("a", 1, 50), ("b", 0, 7), ("c", 1, 52), ("d", 0, 9), ("e", 0, 8)]
    log = sources.with_log_place(spark.createDataFrame(rows, "id string, partition int, offset long"))
    numbered = {r.id: r.seq for r in sources.in_arrival_order(log, 100).collect()}
    assert numbered == {"b": 101, "e": 102, "d": 103, "a": 104, "c": 106}  # offset 51 is not there


def test_upserts_and_numbers_of_many_files_at_once(spark, feed):
    files, rows = feed
    folder, home = tempfile.mkdtemp(prefix="feed-"), tempfile.mkdtemp(prefix="ordered-")
    write_aged(files, folder)
    table = upsert_table(spark, f"{home}/table")
    stream = sources.stream_readings(spark, folder, "s", files_per_trigger=64, arrival=True)
    number = batches.number_records(spark, f"{home}/numbered", f"{home}/state")
    merge = upsert_batches(table)

    def both(batch, batch_id):
        merge(batch, batch_id)
        number(batch, batch_id)

    assert starters.to_batches(stream, both, f"{home}/checkpoint", every=None).awaitTermination(300)
    assert dict(shown(table.read())) == {i: t for i, _, t in rows}
    numbered = spark.read.parquet(f"{home}/numbered").orderBy("n").select("n", "id", "temperature").collect()
    assert [tuple(r) for r in numbered] == [(n, i, t) for n, (i, _, t) in enumerate(rows, 1)]


def test_no_window_over_all_rows_of_an_id(spark, make, feed):
    """Only blocks of an id, and one row per block, meet in a task."""
    for operator, _ in OPERATORS.values():
        rows = make(feed[1]).withColumn("weight", F.lit(1).cast("bigint"))
        plan = operator.apply(rows, 16)._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line and "_block" not in line:
                raise AssertionError(line)


# ---------------------------------------------------------------- keyed tables


@pytest.fixture
def table(spark):
    return KeyedTable(spark, tempfile.mkdtemp(prefix="keyed-"), "k string, v bigint", "k", buckets=4, segments=3)


def put(table, version, rows, meta=None):
    table.merge(table.spark.createDataFrame(rows, table.ddl), version, meta)


def shown(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_newest_row_of_a_key_wins_and_versions_can_be_repeated(table):
    assert shown(table.read()) == [] and table.meta() == {}
    put(table, 0, [("a", 1), ("b", 1), (None, 1)], {"n": 1})
    put(table, 1, [("a", 2), (None, 3)], {"n": 2})
    put(table, 1, [("a", 5), (None, 4)], {"n": 3})
    assert shown(table.read()) == [("a", 5), ("b", 1), (None, 4)] and table.meta() == {"n": 3}
    assert shown(table.read(before=1)) == [("a", 1), ("b", 1), (None, 1)]
    put(table, 2, [])
    assert shown(table.read()) == [("a", 5), ("b", 1), (None, 4)]


def test_many_versions_equal_a_dictionary_and_old_files_go(table):
    rng, want = random.Random(3), {}
    for version in range(14):
        new = {f"k{rng.randrange(12)}": rng.randrange(1000) for _ in range(rng.randrange(5))}
        put(table, version, list(new.items()))
        want |= new
        assert shown(table.read()) == sorted(want.items())
    assert len(os.listdir(f"{table.path}/manifests")) <= 2 * table.kept  # with checksum files
    named = table._manifest(None)["segments"]
    assert all(len(v) <= table.segments for v in named.values())
    # What is left on disk: segments of the kept versions, no more than they name.
    assert len(os.listdir(f"{table.path}/segments")) <= 4 * table.segments + table.kept


def test_bytes_written_follow_the_touched_keys(spark):
    table = KeyedTable(spark, tempfile.mkdtemp(prefix="keyed-"), "k string, v bigint", "k")
    whole = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    table.merge(whole, 0)
    put(table, 1, [("17", -1)])
    size = lambda v: sum(
        os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{table.path}/segments/_version={v}") for f in fs
    )
    assert size(1) * 50 < size(0)
    assert table.read().where("k = '17'").first()["v"] == -1 and table.read().count() == 50_000


def test_a_version_without_its_manifest_does_not_exist(table):
    put(table, 0, [("a", 1)])
    put(table, 1, [("a", 2)])
    os.remove(f"{table.path}/manifests/{1:012d}.json")  # as after a crash before it was published
    assert shown(table.read()) == [("a", 1)]
    put(table, 1, [("a", 3)])
    assert shown(table.read()) == [("a", 3)]

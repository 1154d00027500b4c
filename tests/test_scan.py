"""Block scans give what plain windows give, however the blocks are cut."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from thermoweave.operators import alerts, eventtime, rolling, scan, windows

ROWS = 400


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows on one id, a third of them at one instant, arrival out of order."""
    rng = random.Random(7)
    rows = []
    for seq in rng.sample(range(10_000), ROWS):
        sensor = "hot" if rng.random() < 0.5 else f"s{rng.randrange(6)}"
        second = 500 if rng.random() < 0.34 else rng.randrange(1000)
        rows.append((seq, sensor, second, second * 1000, round(rng.uniform(0, 60), 1)))
    df = spark.createDataFrame(
        rows, "seq bigint, id string, s bigint, timestamp bigint, temperature double"
    )
    return df.select("seq", "id", F.timestamp_seconds("s").alias("ts"), "timestamp", "temperature").cache()


def same(got, want):
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a = sorted(map(str, got.select(columns).collect()))
    b = sorted(map(str, want.select(columns).collect()))
    assert a == b


@pytest.mark.parametrize("block", [1, 3, 70, 5_000, 1 << 20])
@pytest.mark.parametrize("before", [False, True])
def test_running_equals_window(skewed, block, before):
    frame = Window.partitionBy("id").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, -1 if before else 0
    )
    aggs = {
        "total": ("sum", F.lit(1)),
        "high": ("max", F.col("timestamp")),
        "low": ("min", F.struct("temperature", "seq")),
    }
    got = scan.running(scan.add_seq_block(skewed, rows=block), aggs, ["id"], before=before)
    want = skewed.withColumns(
        {
            "total": F.sum(F.lit(1)).over(frame),
            "high": F.max("timestamp").over(frame),
            "low": F.min(F.struct("temperature", "seq")).over(frame),
        }
    )
    same(got, want)


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_running_without_key_and_with_null_key(skewed, block):
    numbered = rolling.running_number(skewed, block)
    want = skewed.withColumn("n", F.sum(F.lit(1)).over(Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)))
    same(numbered, want)

    nulls = skewed.withColumn("id", F.when(F.col("id") != "hot", F.col("id")))
    got = rolling.rolling_reduce(nulls, block)
    frame = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = nulls.select(
        "seq", "id",
        F.max("timestamp").over(frame).alias("max_timestamp"),
        F.min("temperature").over(frame).alias("min_temperature"),
    )
    same(got, want)


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_previous_keeps_nulls_apart_from_missing(skewed, block):
    holes = skewed.withColumn("temperature", F.when(F.col("seq") % 3 > 0, F.col("temperature")))
    got = scan.previous(scan.add_seq_block(holes, rows=block), "temperature", "last", ["id"], default=-1.0)
    want = holes.withColumn("last", F.lag("temperature", 1, -1.0).over(Window.partitionBy("id").orderBy("seq")))
    same(got, want)


@pytest.mark.parametrize("block", [1, 9, 60, 1 << 20])
def test_over_rows_with_many_equal_instants(skewed, block):
    got = windows.over_rows(skewed, 2, block).withColumn("avg_temp", F.round("avg_temp", 6))
    frame = Window.partitionBy("id").orderBy("ts", "seq").rowsBetween(-2, 0)
    want = skewed.select(
        "seq", "id", "ts",
        F.count("id").over(frame).alias("cnt"),
        F.round(F.avg("temperature").over(frame), 6).alias("avg_temp"),
    )
    same(got, want)


def test_time_blocks_stay_small(skewed):
    """The crowded instant holds 34 % of the rows and must not end up in one block."""
    blocks = scan.add_time_block(skewed, rows=20).groupBy(scan.BLOCK).count()
    # quantile bins of about 20 rows; an arrival-number part holds at most 20 of an instant
    assert blocks.agg(F.max("count")).first()[0] <= 40


def test_seq_blocks_are_bounded(skewed):
    blocks = scan.add_seq_block(skewed, rows=10).groupBy("id", scan.BLOCK).count()
    assert blocks.agg(F.max("count")).first()[0] <= 10


@pytest.mark.parametrize("block", [1, 30, 1 << 20])
def test_count_window(skewed, block):
    got = windows.count_window(skewed, 10, 2, block)
    by = Window.partitionBy("id").orderBy("seq")
    frame = by.rowsBetween(-9, 0)
    want = (
        skewed.withColumns(
            {
                "nth": F.row_number().over(by),
                "elements": F.count("seq").over(frame),
                "max_timestamp": F.max("timestamp").over(frame),
                "min_temperature": F.min("temperature").over(frame),
            }
        )
        .filter("nth % 2 = 0")
        .select("seq", "id", "elements", "max_timestamp", "min_temperature")
    )
    same(got, want)


@pytest.mark.parametrize(
    "operator",
    [
        rolling.rolling_min_by,
        rolling.changelog_count,
        rolling.jump_alert,
        rolling.jump_alert_zero_init,
        rolling.jump_map,
        eventtime.watermark_trace,
        lambda df, block_rows=1 << 20: eventtime.punctuated_trace(df, "s1", block_rows=block_rows),
        eventtime.mark_late,
        eventtime.lateness_firings,
        alerts.rise_alert,
    ],
)
def test_result_does_not_depend_on_blocks(skewed, operator):
    whole = operator(skewed)
    assert whole.count() > 0
    for block in (1, 25):
        same(operator(skewed, block_rows=block), whole)


def rise_by_hand(rows, wait):
    """The timer's rules, one reading after the other."""
    alerts_, state = [], {}
    for ts, _, sensor, temp in sorted(rows):
        last, due = state.get(sensor, (0.0, None))
        if due is not None and due <= ts:
            alerts_.append((sensor, due))
            due = None
        if temp > last and due is None:
            due = ts + wait
        elif temp < last:
            due = None
        state[sensor] = (temp, due)
    return sorted(alerts_ + [(s, due) for s, (_, due) in state.items() if due is not None])


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_rise_alert_equals_the_state_machine(spark, block):
    rng = random.Random(3)
    rows = [
        (seq, rng.choice("abc"), rng.randrange(600), float(rng.choice([10, 20, 20, 21, 30])))
        for seq in range(300)
    ]
    df = spark.createDataFrame(rows, "seq bigint, id string, s bigint, temperature double").select(
        "seq", "id", F.timestamp_seconds("s").alias("ts"), "temperature"
    )
    got = alerts.rise_alert(df, "10 seconds", block).select("id", F.unix_seconds("alert_ts"))
    want = rise_by_hand([(s, seq, i, t) for seq, i, s, t in rows], 10)
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("seed", range(4))
def test_a_steadily_rising_id_is_walked_in_blocks(spark, seed):
    """No drop, or few, over many blocks; gaps under, at and over the interval; ties; one id per kind."""
    rng = random.Random(seed)
    rows, at = [], {"up": 0, "slow": 0, "saw": 0}
    for seq in range(240):
        sensor = rng.choice(["up", "up", "slow", "saw"])
        at[sensor] += rng.choice([0, 1, 2, 5] if sensor != "slow" else [1, 10, 11])
        rows.append((seq, sensor, at[sensor], float(seq if sensor != "saw" or seq % 17 else -seq)))
    df = spark.createDataFrame(rows, "seq bigint, id string, s bigint, temperature double").select(
        "seq", "id", F.timestamp_seconds("s").alias("ts"), "temperature"
    )
    want = rise_by_hand([(s, seq, i, t) for seq, i, s, t in rows], 10)
    for block in (1, 9):
        got = alerts.rise_alert(df, "10 seconds", block).select("id", F.unix_seconds("alert_ts"))
        assert sorted(map(tuple, got.collect())) == want


def test_the_steps_of_a_block_equal_the_walk(spark):
    """The table of a block against walking it from every due time."""
    import pyarrow as pa

    rng = random.Random(9)
    for _ in range(300):
        n = rng.randrange(1, 12)
        at = sorted(rng.randrange(40) for _ in range(n))
        drop = [rng.random() < rng.choice([0, 0.3]) for _ in at]
        table = pa.table({"at": pa.array(at, pa.int64()), "seq": pa.array(range(n), pa.int64()), "drop": drop})
        steps = alerts._Block(table, 7).steps()
        for due in range(at[0] - 9, at[0] + 8):
            here = due
            for t, down in zip(at, drop, strict=True):
                if down:
                    here = None
                elif here is None or t >= here:
                    here = t + 7
            left = next((x for f, x, *_ in steps if f >= due), due)
            past = here is None or here <= at[-1]
            assert (past and left <= at[-1]) or left == here, (at, drop, due, steps)


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
def test_sessions_do_not_depend_on_blocks(skewed, block):
    same(windows.session_count(skewed, "25 seconds", block), windows.session_count(skewed, "25 seconds"))

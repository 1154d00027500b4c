"""User-defined aggregates: partial states, merges, streams."""

import random
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from thermoweave.operators import useragg
from thermoweave.streaming import batches


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    some = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, round(rng.uniform(0, 60), 1)])) for _ in range(400)]
    return [*some, ("empty", None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, temperature double").repartition(5)


def top2(rows):
    out = []
    for key in {r[0] for r in rows}:
        temps = sorted((t for k, t in rows if k == key and t is not None), reverse=True)[:2]
        out += [(key, n, t) for n, t in enumerate(temps, 1)]
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_top_two_and_mean_equal_plain_python(spark, rows):
    df = frame(spark, rows)
    assert shown(useragg.user_aggregate(df, useragg.HighestTemperatures(2))) == top2(rows)
    got = {r.id: r.avg_temp for r in useragg.user_aggregate(df, useragg.MeanTemperature()).collect()}
    want = {r.id: r.m for r in df.groupBy("id").agg(F.avg("temperature").alias("m")).collect()}
    assert got == pytest.approx(want, nan_ok=True)
    assert useragg.user_aggregate(df.limit(0), useragg.MeanTemperature()).collect() == []


def test_tasks_hand_states_on_and_a_hot_key_has_few(spark, rows):
    df = frame(spark, rows)
    states = useragg.partial_states(df, "id", useragg.HighestTemperatures(2), keys_held=2)
    assert 5 < states.count() < 60
    merged = useragg.merged_states(states, "id", useragg.HighestTemperatures(2))
    assert shown(useragg.finished_states(merged, "id", useragg.HighestTemperatures(2))) == top2(rows)


class Span:
    """A user's own: lowest and highest, keyed by a number."""

    result = "low double, high double"

    def zero(self):
        return None

    def accumulate(self, state, rows):
        temps = [t for t in rows.column("temperature").to_pylist() if t is not None]
        return self.merge(state, (min(temps), max(temps)) if temps else None)

    def merge(self, one, other):
        if one is None or other is None:
            return one or other
        return min(one[0], other[0]), max(one[1], other[1])

    def finish(self, state):
        return [state] if state else []


def test_other_keys_and_shapes(spark, rows):
    numbered = [(len(k or ""), t) for k, t in rows]
    df = spark.createDataFrame(numbered, "id long, temperature double")
    want = shown(df.where("temperature IS NOT NULL").groupBy("id").agg(F.min("temperature"), F.max("temperature")))
    assert shown(useragg.user_aggregate(df, Span())) == want
    assert Span().accumulate(None, pa.RecordBatch.from_pydict({"temperature": [2.0, None]})) == (2.0, 2.0)


def test_stream_carries_states_and_repeats_change_nothing(spark, rows):
    home = tempfile.mkdtemp(prefix="useragg-")
    write = batches.user_aggregate_batches(spark, useragg.HighestTemperatures(2), f"{home}/out", f"{home}/state")
    parts = [rows[:150], rows[150:160], [], rows[160:]]
    for k in (0, 1, 1, 2, 3, 3):
        write(spark.createDataFrame(parts[k], "id string, temperature double"), k)
    for k in (0, 1, 3):
        seen = [r for part in parts[: k + 1] for r in part]
        touched = {r[0] for r in parts[k]}
        got = spark.read.parquet(f"{home}/out/batch={k}")
        assert shown(got) == [r for r in top2(seen) if r[0] in touched]

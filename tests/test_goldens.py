"""Hand-derived results on the small sample and on edge cases."""

import pytest
from sample import BASE, SAMPLE
from pyspark.sql import functions as F

from thermoweave.functions.registry import register_hash, register_split, split_udtf
from thermoweave.functions.text import split_lines, split_words, string_hash, wrap_int
from thermoweave.operators import aggregate, alerts, eventtime, lateral, project, rolling, route, windows
from thermoweave.session import new_path
from thermoweave.sinks import files, payloads
from thermoweave.sources import log, readings

S1 = "sensor_1"


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def rel(column):
    """Seconds after the base time of a TIMESTAMP column."""
    return (F.unix_seconds(column) - BASE).alias(column)


# ---------------------------------------------------------------- sources


def sample_lines(spark):
    return spark.createDataFrame(
        [(f"{i},{BASE + s},{t}",) for i, s, t in SAMPLE], "value string"
    )


def test_parse_and_collection_agree(spark, sample):
    parsed = readings.parse_readings(sample_lines(spark))
    assert rows(parsed) == rows(sample, "id", "timestamp", "temperature")


def test_extra_fields_are_ignored_and_bad_lines_fail(spark):
    extra = spark.createDataFrame([("a,1,2.5,x,y",)], "value string")
    assert rows(readings.parse_readings(extra)) == [("a", 1, 2.5)]
    for bad in ("sensor_1,abc,1.0", "sensor_1,5"):
        with pytest.raises(Exception):
            readings.parse_readings(spark.createDataFrame([(bad,)], "value string")).collect()


def test_reject_split(spark):
    lines = spark.createDataFrame([("a,1,2.5",), ("a,abc,1.0",), ("short",)], "value string")
    good, bad = readings.parse_or_reject(lines)
    assert rows(good) == [("a", 1, 2.5)]
    assert rows(bad) == [("a,abc,1.0",), ("short",)]


def test_csv_table(spark, sample):
    path = new_path(spark, "csv")
    sample_lines(spark).write.text(path)
    table = readings.read_csv_table(spark, path, view="input_table")
    assert rows(spark.table("input_table")) == rows(table) == rows(sample, "id", "timestamp", "temperature")


def test_event_time_units(spark):
    df = spark.range(1).select(
        readings.event_time(F.lit(1547718199), "s").alias("a"),
        readings.event_time(F.lit(1547718199000), "ms").alias("b"),
    )
    assert df.filter("a = b").count() == 1


def test_log_table_and_decoding(spark):
    messages = spark.createDataFrame([("key-1", "sensor_1,1547718199000,35.8")], "key string, value string")
    typed = log.decode_log(messages)
    assert rows(typed.select("id", "timestamp", "temperature", F.unix_millis("ts"))) == [
        (S1, 1547718199000, 35.8, 1547718199000)
    ]
    log.log_table(messages, "log_table")
    assert rows(spark.table("log_table")) == [(S1, 1547718199000, 35.8)]
    assert log.log_options("h:1", "t")["startingOffsets"] == "latest"


# ---------------------------------------------------------------- rows and routing


def test_select_filter_forms(spark, sample):
    want = [(S1, 35.0), (S1, 35.8), (S1, 39.8)]
    sample.createOrReplaceTempView("sensor")
    assert rows(project.select_filter(sample)) == want
    assert rows(project.select_filter_sql(spark, "sensor")) == want
    assert rows(sample.filter("id == 'sensor_1'").selectExpr("id", "temperature")) == want


def test_wrap_int(spark):
    values = [0, 2**31 - 1, 2**31, -1, -(2**31) - 1, 1547718199000, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(x,) for x in values], "x bigint")
    got = dict(df.select("x", wrap_int(F.col("x"))).collect())
    assert got == {x: (x + 2**31) % 2**32 - 2**31 for x in values}


def test_routing(sample):
    tagged = route.tag_readings(sample)
    assert rows(route.select_tags(tagged, "high"), "seq") == [(1,), (2,), (3,), (6,)]
    assert rows(route.select_tags(tagged, "low"), "seq") == [(4,), (5,)]
    both = route.select_tags(tagged, "high", "low")
    assert both.count() == 6
    union = route.union_all(route.select_tags(tagged, "high"), route.select_tags(tagged, "low"), both)
    assert union.count() == 12 and union.distinct().count() == 6
    main, side = route.side_outputs(sample)
    assert rows(main, "seq") == [(1,), (2,), (3,), (6,)]
    assert rows(side) == [("sensor_6", 15.4, BASE + 201), ("sensor_7", 6.7, BASE + 202)]


def test_connect(spark, sample):
    warn = "high temp warning"
    got = route.connect_map(sample)
    assert set(map(tuple, got.collect())) == {
        (S1, 35.8, warn), (S1, 35.0, warn), (S1, 39.8, warn), ("sensor_10", 38.1, warn),
        ("sensor_6", None, "normal"), ("sensor_7", None, "normal"),
    }
    main, side = route.side_outputs(sample)
    two = route.connect(
        main.select("id", "temperature", F.lit(warn).alias("message")),
        side.select("id", F.lit("normal").alias("message")),
    )
    assert set(map(tuple, two.collect())) == set(map(tuple, got.collect()))


def test_nan_and_null_are_low(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (30.0,), (30.1,)], "temperature double")
    assert [r[0] for r in df.filter(route.is_high()).collect()] == [30.1]


# ---------------------------------------------------------------- text and functions


@pytest.mark.parametrize(
    ("text", "parts"),
    [("a_b__", ["a", "b"]), ("", [""]), ("__", []), ("_a", ["", "a"]), ("sensor_1", ["sensor", "1"]),
     ("a__b", ["a", "", "b"]), (None, None)],
)
def test_split_words(spark, text, parts):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(split_words(F.col("s"), "_")).first()[0] == parts


def test_split_lines(spark):
    df = spark.createDataFrame([("a\nb\n\nc\n",), ("",), ("\n",), ("x\r\ny",)], "s string")
    assert [r[0] for r in df.select(split_lines(F.col("s"))).collect()] == [
        ["a", "b", "", "c"], [], [""], ["x", "y"]
    ]


def jvm_hash(text):
    units = text.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i:i + 2], "big")) & 0xFFFFFFFF
    return h


def test_string_hash(spark, sample):
    sample.createOrReplaceTempView("sensor")
    register_hash(spark, "hashcode", 10)
    want = {S1: -263751368, "sensor_6": -263751318, "sensor_7": -263751308, "sensor_10": 413642664}
    assert dict(sample.select("id", string_hash("id", 10)).collect()) == want
    assert dict(spark.sql("SELECT id, hashcode(id) FROM sensor").collect()) == want
    texts = ["", "a", "é", "温度", "😀x", "sensor_10", "z" * 500]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = dict(df.select("s", string_hash("s")).collect())
    assert got == {t: (jvm_hash(t) + 2**31) % 2**32 - 2**31 for t in texts}


def test_lateral_split(spark, sample):
    want = sorted(3 * [(S1, "sensor", 6), (S1, "1", 1)] + [
        (i, w, len(w)) for i in ("sensor_6", "sensor_7", "sensor_10") for w in i.split("_")
    ])
    assert rows(lateral.lateral_split(sample), "id", "word", "length") == want
    sample.createOrReplaceTempView("sensor")
    register_split(spark, "split_words", "_")
    assert rows(lateral.lateral_split_sql(spark, "sensor"), "id", "word", "length") == want
    spark.udtf.register("split_py", split_udtf("_"))
    assert rows(spark.sql("SELECT id, word, length FROM sensor, LATERAL split_py(id)")) == want


def test_lateral_drops_rows_without_parts(spark):
    df = spark.createDataFrame([("__",), ("",), (None,), ("a__",)], "id string")
    assert rows(lateral.lateral_split(df)) == [("", "", 0), ("a__", "a", 1)]
    df.createOrReplaceTempView("edges")
    register_split(spark, "split_words", "_")
    spark.udtf.register("split_py", split_udtf("_"))
    for function in ("split_words", "split_py"):
        assert rows(spark.sql(f"SELECT id, word, length FROM edges, LATERAL {function}(id)")) == [
            ("", "", 0), ("a__", "a", 1)
        ]


LINES = ["hello world", "hello spark", "hello python", "how are you", "are you ok"]


def test_word_counts(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    assert dict(aggregate.word_count(df).collect()) == {
        "hello": 3, "are": 2, "you": 2, "world": 1, "spark": 1, "python": 1, "how": 1, "ok": 1
    }
    assert dict(aggregate.word_count(df, ",", True, True).collect()) == {x: 1 for x in LINES}
    gaps = spark.createDataFrame([("a  b ",), ("",)], "value string")
    assert dict(aggregate.word_count(gaps).collect()) == {"a": 1, "": 2, "b": 1}
    assert dict(aggregate.word_count(gaps, drop_empty=True).collect()) == {"a": 1, "b": 1}
    texts = spark.createDataFrame([("A,b\r\nb,,c d\n",), (None,)], "text string")
    assert dict(aggregate.text_word_count(texts).collect()) == {"a": 1, "b": 2, "c d": 1}


def test_running_words(spark):
    docs = spark.createDataFrame([(1, "a b\na"), (2, " a"), (900, "b a")], "doc_id bigint, text string")
    got = rows(aggregate.running_word_count(docs, block_docs=1), "word", "n")
    assert got == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1), ("b", 2)]


def test_running_words_are_cut_without_a_function_per_word(spark):
    docs = spark.createDataFrame([(1, " a  b\r\n\na "), (2, ""), (3, None), (4, "  ")], "doc_id bigint, text string")
    counted = aggregate.running_word_count(docs)
    assert rows(counted, "word", "pos", "n") == [("a", 0, 1), ("a", 2, 2), ("b", 1, 1)]
    assert "lambda" not in counted._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- aggregates


def test_group_counts(spark, sample):
    want = [(S1, 3), ("sensor_10", 1), ("sensor_6", 1), ("sensor_7", 1)]
    sample.createOrReplaceTempView("sensor")
    assert rows(aggregate.group_count(sample)) == rows(aggregate.group_count_sql(spark, "sensor")) == want


def test_changelog(sample):
    got = [tuple(r) for r in rolling.changelog_count(sample).orderBy("seq", "added").select("added", "id", "cnt").collect()]
    assert got == [
        (True, S1, 1), (False, S1, 1), (True, S1, 2), (False, S1, 2), (True, S1, 3),
        (True, "sensor_6", 1), (True, "sensor_7", 1), (True, "sensor_10", 1),
    ]


def test_rolling(sample):
    got = rolling.rolling_reduce(sample).orderBy("seq").collect()
    assert [(r.max_timestamp - BASE, r.min_temperature) for r in got] == [
        (199, 35.8), (199, 35.0), (199, 35.0), (201, 15.4), (202, 6.7), (205, 38.1)
    ]
    best = rolling.rolling_min_by(sample).orderBy("seq").collect()
    assert [(r.min_timestamp - BASE, r.min_temperature) for r in best][:3] == [
        (199, 35.8), (122, 35.0), (122, 35.0)
    ]
    final = rows(aggregate.min_by_final(sample), "id", "seq")
    assert final == [(S1, 2), ("sensor_10", 6), ("sensor_6", 4), ("sensor_7", 5)]
    assert [r.n for r in rolling.running_number(sample).orderBy("seq").collect()] == [1, 2, 3, 4, 5, 6]
    assert [round(r.total, 6) for r in rolling.rolling_sum(sample, "temperature").orderBy("seq").collect()][:3] == [
        35.8, 70.8, 110.6
    ]


def test_min_by_ties_keep_the_earliest(make):
    df = make([("a", 3, 5), ("a", 1, 5), ("a", 2, 7)])
    assert [r.min_seq for r in rolling.rolling_min_by(df).orderBy("seq").collect()] == [1, 1, 1]
    assert aggregate.min_by_final(df).first()["seq"] == 1


def test_mean(sample):
    got = {r.id: round(r.avg_temp, 6) for r in aggregate.mean_temperature(sample).collect()}
    assert got == {S1: 36.866667, "sensor_6": 15.4, "sensor_7": 6.7, "sensor_10": 38.1}


# ---------------------------------------------------------------- windows


def test_tumble(spark, sample):
    want = sorted([(S1, 1, 130), (S1, 2, 200), ("sensor_6", 1, 210), ("sensor_7", 1, 210), ("sensor_10", 1, 210)])
    sample.createOrReplaceTempView("sensor")
    for got in (windows.tumble_count(sample), windows.tumble_count_sql(spark, "sensor")):
        assert rows(got, "id", "cnt", rel("window_end")) == want


SLIDES = sorted(
    [(S1, s, 1) for s in (110, 115, 120)] + [(S1, s, 2) for s in (185, 190, 195)]
    + [(i, s, 1) for i in ("sensor_6", "sensor_7") for s in (190, 195, 200)]
    + [("sensor_10", s, 1) for s in (195, 200, 205)]
)


def test_slide(sample):
    start = (F.col("window_start_ms") / 1000 - BASE).cast("int")
    assert rows(windows.slide_count_keyed(sample), "id", start, "cnt") == SLIDES
    dropped = sorted((s, n) for _, s, n in SLIDES)
    assert rows(windows.slide_count(sample), start, "cnt") == dropped
    assert rows(windows.window_sizes(sample), start, "cnt") == dropped
    reduced = {(r[0], r[1]): (r[2] - BASE, r[3]) for r in windows.slide_reduce(sample).select("id", start, "max_timestamp", "min_temperature").collect()}
    assert reduced[(S1, 190)] == (199, 35.8) and reduced[(S1, 110)] == (122, 35.0)
    assert len(reduced) == len(SLIDES)


def test_slide_that_does_not_divide_the_size(sample):
    got = windows.slide_count_keyed(sample, "7 seconds", "3 seconds")
    want = (
        sample.groupBy("id", F.window("ts", "7 seconds", "3 seconds")).count()
        .select("id", F.unix_millis("window.start"), "count")
    )
    assert rows(got) == rows(want)


def test_offset_windows(make):
    df = make([("a", 0, 1), ("a", 3600, 1)])  # 09:40 and 10:40 UTC on 2019-01-17
    day = windows.tumble_offset(df, "1 day", "-8 hours").collect()
    assert [(r.window_start.hour, r.cnt) for r in day] == [(16, 2)]
    hour = windows.tumble_offset(df, "1 hour", "-8 hours").collect()
    assert sorted((r.window_start.hour, r.window_end.hour, r.cnt) for r in hour) == [(9, 10, 1), (10, 11, 1)]


def test_sessions(sample, make):
    want = sorted([
        (S1, 122, 182, 1), (S1, 198, 259, 2), ("sensor_6", 201, 261, 1),
        ("sensor_7", 202, 262, 1), ("sensor_10", 205, 265, 1),
    ])
    assert rows(windows.session_count(sample), "id", rel("session_start"), rel("session_end"), "cnt") == want
    touching = make([("a", 0, 1), ("a", 60, 1), ("b", 0, 1), ("b", 61, 1)])
    assert rows(windows.session_count(touching), "id", rel("session_start"), rel("session_end"), "cnt") == [
        ("a", 0, 120, 2), ("b", 0, 60, 1), ("b", 61, 121, 1)
    ]


def test_sessions_equal_built_in(spark):
    df = spark.range(500).select(
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("id"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(4000))).alias("ts"),
    )
    want = df.groupBy("id", F.session_window("ts", "10 seconds")).count().select(
        "id", "session_window.start", "session_window.end", "count"
    )
    assert rows(windows.session_count(df, "10 seconds")) == rows(want)


def test_count_and_row_windows(spark, sample):
    got = windows.count_window(sample).collect()
    assert [(r.id, r.elements) for r in got] == [(S1, 2)]
    want = sorted([
        (S1, 122, 1, 35.0), (S1, 198, 2, 37.4), (S1, 199, 3, 36.866667),
        ("sensor_6", 201, 1, 15.4), ("sensor_7", 202, 1, 6.7), ("sensor_10", 205, 1, 38.1),
    ])
    windows.with_preceding(sample).createOrReplaceTempView("sensor_rows")
    for got in (windows.over_rows(sample), windows.over_rows_sql(spark, "sensor_rows")):
        assert rows(got, "id", rel("ts"), "cnt", F.round("avg_temp", 6)) == want


# ---------------------------------------------------------------- event time and alerts


def test_watermark_traces(sample):
    periodic = eventtime.watermark_trace(sample).orderBy("seq").collect()
    assert [r.watermark_ms // 1000 - BASE for r in periodic] == [198, 198, 198, 200, 201, 204]
    marked = eventtime.punctuated_trace(sample).orderBy("seq").collect()
    assert [r.watermark_ms // 1000 - BASE for r in marked] == [198] * 6


LATE = [("a", s, 1) for s in (100, 200, 138, 123, 124, 125)]


def test_late_split(make):
    on_time, late = eventtime.late_split(make(LATE))
    assert rows(late, rel("ts")) == [(123,), (124,)]
    assert rows(on_time, rel("ts")) == [(100,), (125,), (138,), (200,)]
    again = eventtime.mark_late(make(LATE[2:]), start_ms=(BASE + 200) * 1000)
    assert rows(again.filter("late"), rel("ts")) == [(123,), (124,)]


def test_lateness_firings(make):
    got = eventtime.lateness_firings(make(LATE))
    start = (F.col("window_start_ms") / 1000 - BASE).cast("int")
    fired = rows(got, start, "firing", "cnt")
    # 138 is late but allowed in three windows, 125 in the one starting at 125.
    assert fired == [
        (90, 0, 1), (95, 0, 1), (100, 0, 1),
        (125, 1, 1), (125, 2, 2), (130, 1, 1), (135, 1, 1),
        (190, 0, 1), (195, 0, 1), (200, 0, 1),
    ]


RISES = {
    "a": [(0, 20), (3, 21), (5, 21), (9, 19), (11, 22), (15, 23), (25, 24)],
    "b": [(0, -5), (1, -5), (2, -4), (12, -6)],
}


def test_rise_alert(make):
    df = make([(i, s, t) for i, seq in RISES.items() for s, t in seq])
    got = alerts.rise_alert(df, "10 seconds")
    assert rows(got, "id", rel("alert_ts")) == [("a", 21), ("a", 35), ("b", 12)]
    assert got.first()["message"] == "温度值连续10秒上升"


def test_jumps(sample, make):
    assert rolling.jump_alert(sample).count() == 0
    zero = rows(rolling.jump_alert_zero_init(sample), "seq", "last_temp", "cur_temp")
    assert zero == [(1, 0.0, 35.8), (4, 0.0, 15.4), (6, 0.0, 38.1)]
    assert rows(rolling.jump_map(sample), "seq", "last_temp", "cur_temp") == [
        (1, 0.0, 35.8), (2, 0.0, 0.0), (3, 0.0, 0.0), (4, 0.0, 15.4), (5, 0.0, 0.0), (6, 0.0, 38.1)
    ]
    steps = make([("a", i, t) for i, t in enumerate((10, 20, 31, 31))])
    assert rows(rolling.jump_alert(steps), "last_temp", "cur_temp") == [(20.0, 31.0)]


def test_profile(sample):
    got = {r.id: r for r in alerts.sensor_profile(sample, 2).collect()}[S1]
    assert (got.last_temp, got.latest_temps, got.n_low, got.n_mid, got.n_high) == (39.8, "35.0;39.8", 0, 0, 3)
    assert (got.max_timestamp - BASE, got.min_temperature) == (199, 35.0)


# ---------------------------------------------------------------- sinks


LATEST = [(S1, 39.8), ("sensor_10", 38.1), ("sensor_6", 15.4), ("sensor_7", 6.7)]


def test_payloads(sample):
    first = sample.filter("seq = 1")
    assert rows(payloads.record_text(first)) == [("SensorReading(sensor_1,1547718199,35.8)",)]
    assert rows(payloads.csv_payload(project.rename_project(first))) == [("sensor_1,35.8",)]
    assert rows(payloads.documents(first), "source") == [
        ('{"sensor_id":"sensor_1","sensor_temp":"35.8","sensor_timestamp":"1547718199"}',)
    ]
    assert rows(payloads.hash_entries(sample), "field", "value") == [(i, str(t)) for i, t in LATEST]


def test_upsert(spark, sample):
    old = spark.createDataFrame([(S1, 1.0), ("sensor_99", 2.0)], "sensor string, temperature double")
    assert rows(alerts.upsert_latest(old, sample)) == sorted(LATEST + [("sensor_99", 2.0)])


def test_files(spark, sample):
    path = new_path(spark, "out")
    files.insert_into_csv(project.rename_project(sample).filter("id = 'sensor_1'").select("id", "temp"), path)
    assert rows(spark.read.text(path)) == [("sensor_1,35.0",), ("sensor_1,35.8",), ("sensor_1,39.8",)]
    with pytest.raises(ValueError):
        files.insert_into_csv(sample.select("id", "temperature"), path)

    counts = aggregate.word_count(spark.createDataFrame([("a b a",)], "value string"))
    text = new_path(spark, "text")
    for _ in range(2):  # the second write replaces the first
        files.write_pairs_text(counts, text, files=1)
    assert rows(spark.read.text(text)) == [("(a,2)",), ("(b,1)",)]
    assert len(spark.read.text(text).inputFiles()) == 1
    csv = new_path(spark, "csv")
    files.write_csv(counts, csv)
    assert rows(spark.read.schema("word string, n bigint").csv(csv)) == [("a", 2), ("b", 1)]


# ---------------------------------------------------------------- rules that clean data do not show


def alert_seconds(df):
    got = alerts.rise_alert(df, "10 seconds").select("id", F.unix_seconds("alert_ts") - BASE)
    return sorted(map(tuple, got.collect()))


def test_rise_alert_and_bands_with_nan(make):
    nan = float("nan")
    assert alert_seconds(make([("a", 100, 20), ("a", 102, nan), ("a", 104, 15), ("a", 130, 16)])) == [("a", 110), ("a", 140)]
    assert alert_seconds(make([("a", 100, nan), ("a", 200, -1)])) == []
    profile = alerts.sensor_profile(make([("a", 1, nan), ("a", 2, 31), ("a", 3, 11)])).first()
    assert (profile.n_low, profile.n_mid, profile.n_high, profile.min_temperature) == (1, 1, 1, 11.0)


def test_lengths_count_utf16_units(spark):
    df = spark.createDataFrame([(1, "a🙂_é")], "seq long, id string")
    assert [(r.word, r.length) for r in lateral.lateral_split(df).collect()] == [("a🙂", 3), ("é", 1)]
    register_split(spark, "utf_words", "_")
    got = spark.sql("SELECT word, length FROM utf_words('a🙂_é')").collect()
    assert sorted(map(tuple, got)) == [("a🙂", 3), ("é", 1)]


def test_log_keeps_its_order(spark):
    rows = [("k", "a,1,2.0", 0, 7), ("k", "a,1,3.0", 0, 8), ("k", "a,1,9.0", 0, 6)]
    rows_ = spark.createDataFrame(rows, "key string, value string, partition int, offset long")
    latest = alerts.latest_by_arrival(log.decode_log(rows_)).collect()
    assert [(r.id, r.temperature) for r in latest] == [("a", 3.0)]


def test_building_time_blocks_starts_no_job(spark, sample):
    seen = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job expected")
    try:
        windows.over_rows(sample)
        alerts.rise_alert(sample)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not seen.getJobIdsForGroup("building")


def test_whole_window_function_sees_all_elements(make):
    import pyarrow as pa

    df = make([("a", s, s % 7) for s in range(600)])

    def median(_id, _start, batches):
        values = sorted(t for b in batches for t in b.column("temperature").to_pylist())
        yield pa.RecordBatch.from_pydict({"middle": [values[len(values) // 2]]})

    got = windows.slide_apply(df.select("id", "ts", "temperature"), median, "middle double", "600 seconds", "600 seconds")
    assert all(isinstance(r.middle, float) for r in got.collect()) and got.count() in (1, 2)

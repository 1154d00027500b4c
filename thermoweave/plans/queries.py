"""One named query per operator, over the whole benchmark tables.

Window sizes follow the spacing of ``events`` (minutes to an hour per sensor); the tests use
seconds on small fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.functions.registry import register_hash, register_split
from thermoweave.functions.text import string_hash
from thermoweave.operators import aggregate, alerts, eventtime, lateral, project, rolling, route, useragg, windows
from thermoweave.operators.scan import BLOCK_ROWS
from thermoweave.plans.tables import plain_times, readings, table
from thermoweave.session import new_path
from thermoweave.sinks import files, payloads
from thermoweave.sources.readings import (
    ARRIVAL_SPREAD,
    parse_readings,
    read_csv_table,
    shuffled_arrivals,
)

Query = Callable[[SparkSession, str], DataFrame]

TUMBLE = "6 hours"
SLIDE = ("12 hours", "4 hours")
SESSION_GAP = "30 minutes"
RISE = "30 minutes"
MIDDLE = "2024-01-16 00:00:00"
LATE = {
    "size": "2 hours",
    "slide": "1 hour",
    "delay": "10 minutes",
    "lateness": "3 hours",
    "block_rows": BLOCK_ROWS * ARRIVAL_SPREAD,  # shuffled arrivals use one number in 512
}


def _on_readings(operator: Callable[..., DataFrame], *args, **params) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(operator(readings(spark, sf_dir), *args, **params))

    return query


def _on_late(operator: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(operator(shuffled_arrivals(readings(spark, sf_dir)), **LATE))

    return query


def _in_sql(operator: Callable[..., DataFrame], view: str, prepare=None, *args) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = readings(spark, sf_dir)
        (prepare(source) if prepare else source).createOrReplaceTempView(view)
        return plain_times(operator(spark, view, *args))

    return query


def _on_text(operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        return operator(docs)

    return query


def _csv_lines(source: DataFrame) -> DataFrame:
    line = F.concat_ws(",", "id", F.col("timestamp").cast("string"), F.col("temperature").cast("string"))
    return source.select("seq", line.alias("value"))


def _parse(source: DataFrame) -> DataFrame:
    return parse_readings(_csv_lines(source))


def _csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv_table")
    _csv_lines(readings(spark, sf_dir)).select("value").write.text(path)
    return read_csv_table(spark, path, view="csv_readings")


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv_sink")
    rows = project.rename_project(readings(spark, sf_dir)).select("id", "temp")
    files.insert_into_csv(rows, path)
    return spark.read.schema(files.OUTPUT_TABLE).csv(path)


def _text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "text_sink")
    counts = aggregate.group_count(readings(spark, sf_dir))
    files.write_pairs_text(counts.select(F.col("id").alias("word"), F.col("cnt").alias("n")), path)
    return spark.read.text(path)


def _tags(source: DataFrame) -> DataFrame:
    return route.tag_readings(source).select("seq", "id", "temperature", "tag")


def _selected(*tags: str) -> Callable[[DataFrame], DataFrame]:
    return lambda source: route.select_tags(route.tag_readings(source), *tags).select(
        "seq", "id", "timestamp", "temperature"
    )


def _union(source: DataFrame) -> DataFrame:
    tagged = route.tag_readings(source.select("seq", "id", "temperature"))
    return route.union_all(
        route.select_tags(tagged, "high"),
        route.select_tags(tagged, "low"),
        route.select_tags(tagged, "high", "low"),
    )


def _side(index: int) -> Callable[[DataFrame], DataFrame]:
    return lambda source: route.side_outputs(source.select("id", "timestamp", "temperature"))[index]


def _lateral(source: DataFrame) -> DataFrame:
    return lateral.lateral_split(source.select("seq", "id", "ts"))


def _lateral_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings(spark, sf_dir).createOrReplaceTempView("split_input")
    register_split(spark, "split_words", "_")
    return plain_times(lateral.lateral_split_sql(spark, "split_input", "split_words"))


def _hash(source: DataFrame) -> DataFrame:
    return source.select("seq", "id", "ts", string_hash("id", 10).alias("hash"))


def _hash_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings(spark, sf_dir).createOrReplaceTempView("hash_input")
    register_hash(spark, "hashcode", 10)
    return plain_times(spark.sql("SELECT seq, id, ts, hashcode(id) AS hash FROM hash_input"))


def _rolling_sum(source: DataFrame) -> DataFrame:
    return rolling.rolling_sum(source, "temperature").select(
        "seq", "id", F.round("total", 6).alias("total")
    )


def _user(aggregate_: useragg.Aggregate) -> Callable[[DataFrame], DataFrame]:
    return lambda source: useragg.user_aggregate(source.select("id", "temperature"), aggregate_)


def _rounded(operator: Callable[[DataFrame], DataFrame], *columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda source: operator(source).withColumns({c: F.round(c, 6) for c in columns})


def _running_number(source: DataFrame) -> DataFrame:
    return rolling.running_number(source.select("seq", "id"))


def _upsert(source: DataFrame) -> DataFrame:
    """Target as of the middle of the month, then everything later merged in."""
    later = F.col("ts") >= F.lit(MIDDLE).cast("timestamp")
    target = alerts.latest_by_arrival(source.filter(~later)).select(
        F.col("id").alias("sensor"), "temperature"
    )
    return alerts.upsert_latest(target, source.filter(later))


def _late(source: DataFrame, **params) -> DataFrame:
    marked = eventtime.mark_late(source, **params)
    return marked.select("seq", "id", "timestamp", "wm_ms", "late")


def registered() -> dict[str, Query]:
    sql_rows = _in_sql(windows.over_rows_sql, "over_input", windows.with_preceding)

    def over_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sql_rows(spark, sf_dir).withColumn("avg_temp", F.round("avg_temp", 6))

    lines = aggregate.text_lines
    return {
        # sources
        "parse_readings": _on_readings(_parse),
        "src_csv_table": _csv_table,
        # sinks
        "sink_text_roundtrip": _text_roundtrip,
        "sink_csv_roundtrip": _csv_roundtrip,
        "sink_payload": _on_readings(payloads.record_text),
        "sink_csv_payload": _on_readings(
            lambda r: payloads.csv_payload(project.rename_project(r))
        ),
        "upsert_latest": _on_readings(_upsert),
        "kv_latest": _on_readings(payloads.hash_entries),
        "doc_payload": _on_readings(payloads.documents),
        # projection and routing
        "select_filter": _on_readings(project.select_filter),
        "select_filter_sql": _in_sql(project.select_filter_sql, "filter_input"),
        "rename_project": _on_readings(project.rename_project),
        "wrap_int": _on_readings(project.int_timestamp),
        "split_high": _on_readings(_selected("high")),
        "split_low": _on_readings(_selected("low")),
        "split_tags": _on_readings(_tags),
        "connect_map": _on_readings(route.connect_map),
        "union_all": _on_readings(_union),
        "side_main": _on_readings(_side(0)),
        "side_low": _on_readings(_side(1)),
        "lateral_split": _on_readings(_lateral),
        "lateral_split_sql": _lateral_sql,
        "udf_hash": _on_readings(_hash),
        "udf_hash_sql": _hash_sql,
        # aggregates
        "wc_space": _on_text(lambda d: aggregate.word_count(lines(d))),
        "wc_comma": _on_text(aggregate.text_word_count),
        "wc_running": _on_text(aggregate.running_word_count),
        "group_count": _on_readings(aggregate.group_count),
        "group_count_sql": _in_sql(aggregate.group_count_sql, "count_input"),
        "rolling_sum": _on_readings(_rolling_sum),
        "rolling_reduce": _on_readings(rolling.rolling_reduce),
        "rolling_min_by": _on_readings(rolling.rolling_min_by),
        "min_by_final": _on_readings(aggregate.min_by_final),
        "changelog_count": _on_readings(rolling.changelog_count),
        "udaf_avg_temp": _on_readings(_rounded(aggregate.mean_temperature, "avg_temp")),
        "udaf_user_mean": _on_readings(_rounded(_user(useragg.MeanTemperature()), "avg_temp")),
        "udaf_user_top2": _on_readings(_user(useragg.HighestTemperatures(2))),
        # windows
        "tumble_count": _on_readings(windows.tumble_count, TUMBLE),
        "tumble_count_sql": _in_sql(windows.tumble_count_sql, "tumble_input", None, TUMBLE),
        "slide_count": _on_readings(windows.slide_count, *SLIDE),
        "tumble_offset": _on_readings(windows.tumble_offset, "1 day", "-8 hours"),
        "slide_count_1h": _on_readings(windows.slide_count, "1 hour", "1 minute"),
        "session_count": _on_readings(windows.session_count, SESSION_GAP),
        "count_window": _on_readings(windows.count_window),
        "slide_reduce": _on_readings(windows.slide_reduce, *SLIDE),
        "slide_apply": _on_readings(windows.window_sizes, *SLIDE),
        "over_rows": _on_readings(_rounded(windows.over_rows, "avg_temp")),
        "over_rows_sql": over_sql,
        # event time
        "watermark_trace": _on_readings(eventtime.watermark_trace, "10 minutes"),
        "watermark_punctuated_trace": _on_readings(
            eventtime.punctuated_trace, "sensor_1", "10 minutes"
        ),
        "lateness_firings": _on_late(eventtime.lateness_firings),
        "late_split": _on_late(_late),
        # keyed state
        "jump_alert": _on_readings(rolling.jump_alert),
        "jump_alert_zero_init": _on_readings(rolling.jump_alert_zero_init),
        "jump_map": _on_readings(rolling.jump_map),
        "sensor_profile": _on_readings(alerts.sensor_profile),
        "running_count": _on_readings(_running_number),
        "rise_alert": _on_readings(alerts.rise_alert, RISE),
    }

"""The physical plans are the ones meant: pruned, pushed down, no Python, no nested loops."""

import re

import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from thermoweave.functions.text import string_hash
from thermoweave.operators import alerts, project, rolling, windows
from thermoweave.plans.queries import registered
from thermoweave.session import new_path
from thermoweave.sources.readings import sensor_readings

SF = f"{oracle.TESTDATA}/sf0.001"
PYTHON = {"slide_apply", "rise_alert", "udaf_user_mean", "udaf_user_top2"}
# These write a file first and read it back.
FILES = {"src_csv_table", "sink_text_roundtrip", "sink_csv_roundtrip"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registered()) - FILES))
def test_no_nested_loops_and_no_stray_python(spark, name):
    text = plan(registered()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    python = re.search("Python|Pandas|InArrow", text)
    assert bool(python) == (name in PYTHON)


def test_filter_and_columns_reach_the_scan(spark, sample):
    path = new_path(spark, "scan")
    sample.write.parquet(path)
    text = plan(project.select_filter(spark.read.parquet(path)))
    assert "EqualTo(id,sensor_1)" in text
    assert "ReadSchema: struct<id:string,temperature:double>" in text


def test_group_count_reads_one_column(spark):
    text = plan(registered()["group_count"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint>" in text
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_rows_are_shuffled_by_key_and_block_only_once(spark):
    events = sensor_readings(spark.read.parquet(f"{SF}/events.parquet"))
    text = plan(rolling.rolling_reduce(events))
    # one exchange for the readings, one for partial sums per block, one for block rows per id
    assert text.count("Exchange hashpartitioning") == 3
    assert "partial_max" in text and "partial_min" in text
    assert not re.search(r"Window \[max\(timestamp.*windowspecdefinition\(id#\d+, seq", text)


def test_count_window_uses_one_window_pass(spark):
    events = sensor_readings(spark.read.parquet(f"{SF}/events.parquet"))
    text = plan(windows.count_window(events))
    assert "WindowGroupLimit" in text  # tails are cut before their shuffle
    assert len(re.findall(r"count\(seq#\d+L?\) windowspec", text)) == 1


def test_sliding_windows_copy_panes_not_readings(spark):
    events = sensor_readings(spark.read.parquet(f"{SF}/events.parquet"))
    text = plan(windows.slide_count(events))
    assert text.index("explode") < text.index("partial_count")  # printed root first


def test_no_id_meets_whole_in_sessions_and_rise_alerts(spark):
    events = sensor_readings(spark.read.parquet(f"{SF}/events.parquet"))
    for df in (windows.session_count(events), alerts.rise_alert(events)):
        text = plan(df)
        assert set(re.findall(r"collect_list\((\w+)", text)) <= {"_tail", "struct"}  # the last rows of a block
        for line in text.splitlines():
            # Windows over all of an id see one row per block: they are ordered by it, or count them.
            if " Window [" in line and "windowspecdefinition(id#" in line:
                assert "_block" in line or "_b0" in line or "count(1)" in line, line


def test_user_aggregates_merge_partial_states(spark):
    text = plan(registered()["udaf_user_top2"](spark, SF))
    # Printed root first: finish, merge behind the one shuffle, partial states in front of it.
    assert text.count("Exchange") == 1 and text.count("MapInArrow") == 2
    assert text.index("FlatMapGroupsInArrow") < text.index("Exchange") < text.rindex("MapInArrow")


def test_hash_stays_an_expression(spark, sample):
    assert "Python" not in plan(sample.select(string_hash("id", 10)))


def test_explain_prints_the_plan(sample, capsys):
    project.select_filter(sample).explain("formatted")
    assert "Physical Plan" in capsys.readouterr().out


def test_entry_points(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["id", "cnt", "window_end"] and df.count() > 0
    assert set(registered()) <= set(entry_points.queries()) & set(entry_points.oracle_sql())
    assert df.agg(F.sum("cnt")).first()[0] == 1000

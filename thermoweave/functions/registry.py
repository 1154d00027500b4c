"""Functions made callable from SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from thermoweave.functions.text import _hash_sql


def register_hash(spark: SparkSession, name: str = "hashcode", factor: int = 10) -> None:
    """A SQL-bodied scalar function: it inlines into the plan, no Python worker runs."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS INT "
        f"RETURN {_hash_sql('s', factor)}"
    )


def register_split(spark: SparkSession, name: str = "split_words", sep: str = "_") -> None:
    """A SQL-bodied table function (word, length) with a fixed one-character separator.

    Lengths are those of JVM strings, in UTF-16 units.
    """
    if len(sep) != 1 or sep in "'\\^[]":
        raise ValueError("separator must be one character and none of ' \\\\ ^ [ ]")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) "
        "RETURNS TABLE (word STRING, length INT) RETURN "
        "SELECT w, CAST(octet_length(encode(w, 'UTF-16BE')) div 2 AS INT) FROM (SELECT explode(CASE "
        "WHEN s = '' THEN array('') "
        f"WHEN rtrim('{sep}', s) = '' THEN CAST(array() AS ARRAY<STRING>) "
        f"ELSE split(rtrim('{sep}', s), '[{sep}]', -1) END) AS w)"
    )


def split_udtf(sep: str):
    """The same table function as a Python UDTF, for users who bring their own body."""
    from pyspark.sql.functions import udtf

    class SplitOn:
        def eval(self, s: str):
            if s is None:
                return
            parts = s.split(sep)
            while len(parts) > 1 and parts[-1] == "":
                parts.pop()
            if parts == [""] and s != "":
                return
            for part in parts:
                yield part, len(part.encode("utf-16-le")) // 2

    return udtf(SplitOn, returnType="word string, length int")

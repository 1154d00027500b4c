"""Line dedup: drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoweave.llm.common import ascii_lower

SPACES = " \t\n\x0b\f\r"


def text_lines(text: Column) -> Column:
    """The lines of a text, split at line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """What decides whether two lines are the same: white space stripped, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(SPACES)))


def dedup_lines(
    docs: DataFrame,
    min_documents: int = 10,
    min_chars: int = 1,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` plus ``__lines`` (all lines), ``__kept`` (the kept ones, in order).

    Lines are exploded as 128-bit hashes of their keys, distinct documents are counted per
    hash, and only the positions of dropped lines travel back to their text. A line's
    document is its ``doc_id``: rows that repeat an id count once, rows without an id count
    as one document. A text in which nothing is dropped keeps every line; one in which
    everything is dropped keeps none.

    Hot lines are counted by partial aggregates; joins are equi-joins that adaptive
    execution splits when skewed. Only hashes are shuffled for counting, each text once.
    """
    rows = docs.withColumn("__lines", text_lines(F.col(text)))
    row_key = [F.col(doc_id), F.xxhash64(text), F.xxhash64(F.lit(1), F.col(text))]
    keyed = rows.select(
        F.col(doc_id).alias("d"),
        row_key[1].alias("t1"),
        row_key[2].alias("t2"),
        F.transform("__lines", line_key).alias("keys"),
    )
    lines = keyed.select("d", "t1", "t2", F.posexplode("keys").alias("pos", "key")).where(
        F.length("key") >= min_chars
    ).select("d", "t1", "t2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    frequent = (
        lines.groupBy("h1", "h2", "d")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_documents)
    )
    dropped = (
        lines.join(frequent, ["h1", "h2"], "left_semi")
        .groupBy("d", "t1", "t2")
        .agg(F.collect_set("pos").alias("__dropped"))
        .withColumnsRenamed({"d": "__d", "t1": "__r1", "t2": "__r2"})
    )
    joined = (
        rows.withColumns({"__t1": row_key[1], "__t2": row_key[2]})
        .join(
            dropped,
            F.col(doc_id).eqNullSafe(F.col("__d"))
            & (F.col("__t1") == F.col("__r1"))
            & (F.col("__t2") == F.col("__r2")),
            "left",
        )
        .drop("__d", "__r1", "__r2", "__t1", "__t2")
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    kept = F.when(F.col("__dropped").isNull(), F.col("__lines")).otherwise(
        F.transform(left, lambda i: F.get(F.col("__lines"), i))
    )
    return joined.withColumn("__kept", kept).drop("__dropped")


def drop_common_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``; all other columns unchanged.

    A text that loses no line stays as it was (null stays null).
    """
    text = options.get("text", "text")
    out = dedup_lines(docs, **options)
    changed = F.size("__kept") < F.size("__lines")
    return out.withColumn(
        text, F.when(changed, F.array_join("__kept", "\n")).otherwise(F.col(text))
    ).select(docs.columns)


def line_report(docs: DataFrame) -> DataFrame:
    """Per document: lines before, lines dropped, SHA-256 of what is left."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size("__kept")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("__kept", "\n"), 256).alias("kept_sha256"),
    )


REPORT_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT k.doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY k.doc_id
"""

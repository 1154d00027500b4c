"""Text and CSV file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

OUTPUT_TABLE = StructType([StructField("id", StringType()), StructField("temp", DoubleType())])


def write_pairs_text(counts: DataFrame, path: str, files: int | None = None) -> None:
    """``(word,n)`` per line, replacing the folder. ``files=1`` gives one file and one task."""
    text = counts.select(
        F.concat(F.lit("("), "word", F.lit(","), F.col("n").cast("string"), F.lit(")")).alias("value")
    )
    (text.coalesce(files) if files else text).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None) -> None:
    (df.coalesce(files) if files else df).write.mode(mode).csv(path)


def check_columns(df: DataFrame, declared: StructType) -> None:
    """Names, order and types must be those of the declared table."""
    got = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in declared]
    if got != want:
        raise ValueError(f"columns {got} do not match the declared table {want}")


def insert_into_csv(df: DataFrame, path: str, declared: StructType = OUTPUT_TABLE) -> None:
    """Append to a declared CSV table after checking names and types."""
    check_columns(df, declared)
    df.write.mode("append").csv(path)

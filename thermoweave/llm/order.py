"""One total order over a whole table, without a task that sees the whole table.

Rows go to contiguous ranges of the order. The ranges are kept in the shared folder, so a lost
task cannot draw them anew; only one row per range is looked at together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermoweave.llm.common import cut
from thermoweave.operators.windows import partition_count

RANGE = "__range"


def _ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with the number of each row's range, every range in one partition of its own."""
    n = partition_count(df)
    ranged = cut(df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id()))
    return ranged.repartition(n, RANGE)


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the row's position in ascending ``order``, from 1; nulls come first.

    Rows that agree in all of ``order`` are numbered in any order and meet in one range: add a
    column that tells them apart where there may be many.
    """
    ranges = _ranges(df, order)
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.groupBy(RANGE).count().select(
        RANGE, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__before")
    )
    inside = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    placed = ranges.withColumn("__inside", inside).join(before, RANGE)
    return placed.withColumn(name, F.col("__before") + F.col("__inside")).drop(RANGE, "__inside", "__before")


def with_next(df: DataFrame, order: Sequence[str], values: Sequence[str], name: str) -> DataFrame:
    """Add a struct of the ``values`` of the next row in ascending ``order``; after the last comes the first.

    ``order`` must tell all rows apart.
    """
    ranges = _ranges(df, order)
    row = F.struct(*[F.col(v) for v in dict.fromkeys([*order, *values])])
    inside = F.lead(row).over(Window.partitionBy(RANGE).orderBy(*order))
    every = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = ranges.groupBy(RANGE).agg(F.min(row).alias("__head"))
    behind = heads.select(
        RANGE,
        F.coalesce(F.lead("__head").over(Window.orderBy(RANGE)), F.first("__head").over(every)).alias("__behind"),
    )
    found = ranges.withColumn("__inside", inside).join(behind, RANGE)
    found = found.withColumn("__row", F.coalesce("__inside", "__behind"))
    return found.withColumn(name, F.struct(*[F.col(f"__row.{v}").alias(v) for v in values])).drop(
        RANGE, "__inside", "__behind", "__row"
    )

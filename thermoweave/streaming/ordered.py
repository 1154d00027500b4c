"""Order-dependent operators on streams whose micro-batches hold many files and hot keys.

A micro-batch is a batch job: its rows get arrival numbers, and the batch operators run over them in blocks,
so no task holds all rows of a key. What earlier micro-batches left is carried per key as
ordinary rows with lower arrival numbers, the last reading of an id or the sums so far; the operator sees them
in front of the new rows, and their own results are left out. A micro-batch writes its results to
one folder and the carried rows of the keys it touched to a ``KeyedTable``; both are replaced
when it is repeated, so each result is there once, and a restart goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thermoweave.operators import rolling, windows
from thermoweave.operators.scan import BLOCK_ROWS
from thermoweave.sinks.keyed import KeyedTable
from thermoweave.streaming.batches import BatchWriter, _put
from thermoweave.streaming.sources import in_arrival_order


@dataclass(frozen=True)
class Ordered:
    """A batch operator for use on streams.

    ``apply(rows, block_rows)`` gives results that carry ``seq``. ``carry(rows)`` gives what stands for all
    rows of an id so far, as a few rows (``seq``, ``id``, *columns) that ``apply`` may see in front of later ones;
    their number per id is bounded by the operator. ``weight`` in ``columns`` is 1 on new rows.
    """

    columns: str
    apply: Callable[[DataFrame, int], DataFrame]
    carry: Callable[[DataFrame], DataFrame]


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def running_sum(value: str) -> Ordered:
    """A3: every record with the sum of ``value`` so far."""
    return Ordered(
        f"{value} double",
        lambda rows, n: rolling.rolling_sum(rows, value, block_rows=n).select("seq", "id", "total"),
        lambda rows: rows.groupBy("id").agg(F.max("seq").alias("seq"), F.sum(value).alias(value)),
    )


ROLLING_REDUCE = Ordered(
    "timestamp bigint, temperature double",
    rolling.rolling_reduce,
    lambda rows: rows.groupBy("id").agg(
        F.max("seq").alias("seq"), F.max("timestamp").alias("timestamp"), F.min("temperature").alias("temperature")
    ),
)


def _lowest(rows: DataFrame) -> DataFrame:
    best = F.min(F.struct("temperature", "seq", "timestamp")).alias("best")
    return rows.groupBy("id").agg(best).select("id", "best.*")


ROLLING_MIN_BY = Ordered("timestamp bigint, temperature double", rolling.rolling_min_by, _lowest)

CHANGELOG = Ordered(
    "weight bigint",
    lambda rows, n: rolling.changelog_count(rows, n, F.col("weight")),
    lambda rows: rows.groupBy("id").agg(F.max("seq").alias("seq"), F.sum("weight").alias("weight")),
)


def _last(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.max("seq").alias("seq"), F.max_by("temperature", "seq").alias("temperature"))


def _jump(operator: Callable[..., DataFrame]) -> Callable[..., Ordered]:
    return lambda threshold=rolling.JUMP: Ordered(
        "temperature double", lambda rows, n: operator(rows, threshold, n), _last
    )


jump_alert, jump_alert_zero_init, jump_map = map(
    _jump, (rolling.jump_alert, rolling.jump_alert_zero_init, rolling.jump_map)
)


def count_window(size: int = 10, every: int = 2) -> Ordered:
    """N7: at every ``every``-th record of an id, the window of its latest ``size``."""

    def carry(rows: DataFrame) -> DataFrame:
        # The latest rows; the oldest of them also counts for all that went before.
        newest = Window.partitionBy("id").orderBy(F.desc("seq"))
        kept = max(size - 1, 1)
        latest = rows.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= kept)
        totals = rows.groupBy(F.col("id").alias("_id")).agg(
            F.sum("weight").alias("_all"), F.least(F.count(F.lit(1)), F.lit(kept)).alias("_n")
        )
        joined = latest.join(totals, F.col("id").eqNullSafe(F.col("_id")))
        oldest = F.col("_nth") == F.col("_n")
        return joined.withColumn(
            "weight", F.when(oldest, F.col("_all") - F.col("_n") + 1).otherwise(F.lit(1)).cast("bigint")
        ).select("seq", "id", "timestamp", "temperature", "weight")

    return Ordered(
        "timestamp bigint, temperature double, weight bigint",
        lambda rows, n: windows.count_window(rows, size, every, n, F.col("weight")),
        carry,
    )


def carried_table(spark: SparkSession, path: str, operator: Ordered) -> KeyedTable:
    fields = ", ".join(c.replace(" ", ": ", 1) for c in f"seq bigint, {operator.columns}".split(", "))
    return KeyedTable(spark, path, f"id string, rows array<struct<{fields}>>", "id")


def ordered_batches(
    spark: SparkSession, operator: Ordered, path: str, state_path: str, block_rows: int = BLOCK_ROWS
) -> BatchWriter:
    """A ``foreachBatch`` function: results of ``operator`` over the whole stream, a folder per micro-batch.

    The stream's rows carry their place (``stream_readings`` with ``arrival`` and several files). Arrival
    numbers go on over micro-batches.
    """
    table = carried_table(spark, state_path, operator)
    columns = ["seq", "id", *_names(operator.columns)]

    def write(batch: DataFrame, batch_id: int) -> None:
        base = table.meta(before=batch_id).get("rows", 0)
        new = in_arrival_order(batch, base)
        if "weight" in columns:
            new = new.withColumn("weight", F.lit(1).cast("bigint"))
        new = new.select(*columns).persist()
        try:
            ids = new.select("id").distinct()
            known = table.read(before=batch_id, buckets=table.buckets_of(ids)).alias("known")
            same = F.col("known.id").eqNullSafe(F.col("new.id"))
            old = known.join(ids.alias("new"), same, "left_semi").select("id", F.inline("rows"))
            rows = old.select(*columns).unionByName(new)
            _put(operator.apply(rows, block_rows).where(F.col("seq") > base), path, batch_id)
            top = new.agg(F.max("seq").alias("top")).first()["top"]
            kept = operator.carry(rows).groupBy("id").agg(
                F.collect_list(F.struct("seq", *_names(operator.columns))).alias("rows")
            )
            table.merge(kept, batch_id, {"rows": base if top is None else top})
        finally:
            new.unpersist()

    return write

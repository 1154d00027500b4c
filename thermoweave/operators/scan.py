"""Ordered per-key scans that survive a hot key.

``Window.partitionBy(key)`` puts all rows of a key into one task. The functions here cut
each key's ordered rows into *blocks* and run the window inside (key, block). What the
earlier blocks contribute is put in front of each block as a few flagged rows:

* ``with_totals`` adds one row holding the aggregate of all earlier blocks, so running
  aggregates come out right,
* ``with_halo`` adds copies of the last ``n`` earlier rows, so a sliding row frame is
  complete.

The readings are shuffled once, by (key, block); the added rows come from partial
aggregates over blocks. ``finished`` drops the flagged rows again.

Blocks are a pure function of the row, so a lost executor's tasks recompute the same
blocks. They must be monotone in the scan order. ``seq_block`` bounds every block by
construction because arrival numbers are unique; ``add_time_block`` follows the
distribution of the event times and splits single instants that hold many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

BLOCK_ROWS = 1 << 20
_PARTS = 1 << 44  # microsecond and part of it share one BIGINT
_LEAST = -(1 << 62)  # where rows without a time go
BLOCK = "_block"
HALO = "is_halo"

_FOLDS = {"sum": F.sum, "max": F.max, "min": F.min}


def seq_block(seq: str = "seq", rows: int = BLOCK_ROWS) -> Column:
    """Block of a unique integer position: at most ``rows`` rows of any key share one.

    ``rows`` counts positions. Where numbering has large gaps, widen it by the same factor:
    blocks stay as full and there are as few of them.
    """
    return F.expr(f"`{seq}` div {rows}L")


def add_seq_block(df: DataFrame, seq: str = "seq", rows: int = BLOCK_ROWS) -> DataFrame:
    return df.withColumn(BLOCK, seq_block(seq, rows))


def add_time_block(
    df: DataFrame, ts: str = "ts", seq: str = "seq", rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add a block column for rows ordered by (ts, seq), about ``rows`` rows per block.

    A distributed histogram counts the rows of every millisecond; the rows before a millisecond,
    divided by ``rows``, number its block. A millisecond that holds more than ``rows`` is
    cut further by its microseconds and by ``seq``, so equal timestamps cannot pile up in
    one block either. The plan is the same at every size, and building it starts no job.
    """
    micros = F.coalesce(F.unix_micros(ts), F.lit(_LEAST))
    placed = df.withColumn("_ms", F.floor(micros / 1000))
    counts = placed.groupBy("_ms").agg(F.count("*").alias("_n"))
    counts = counts.withColumn(BLOCK, F.expr(f"_ms div {BLOCK_ROWS}L"))
    before = running(counts, {"_before": ("sum", F.col("_n"))}, (), ["_ms"], before=True)
    crowded = F.col("_n") > rows
    inside = F.when(crowded, F.pmod(micros, F.lit(1000)) * _PARTS + seq_block(seq, rows)).otherwise(0)
    number = F.expr(f"coalesce(_before, 0L) div {rows}L")
    # Milliseconds that share a number with a crowded one come before it: after it the number grows.
    block = F.struct(
        number.alias("rows_before"),
        F.when(crowded, F.col("_ms")).otherwise(F.lit(_LEAST)).alias("ms"),
        inside.alias("inside"),
    )
    return placed.join(before, "_ms").withColumn(BLOCK, block).drop("_ms", "_n", "_before")


def _by(keys: Sequence[str]) -> list:
    return list(keys) or [F.lit(0)]


def in_block(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """The window inside (keys, block); total rows have null order columns and come first."""
    return Window.partitionBy(*keys, BLOCK).orderBy(*[F.asc_nulls_first(c) for c in order])


def finished(rows: DataFrame) -> DataFrame:
    """Without the flagged rows and the helper columns."""
    helpers = [c for c in rows.columns if c.startswith("_v_")]
    return rows.filter(~F.col(HALO)).drop(HALO, BLOCK, *helpers)


def with_totals(
    blocked: DataFrame, values: dict[str, tuple[str, Column]], keys: Sequence[str]
) -> DataFrame:
    """Put one row with the aggregates of all earlier blocks in front of each block.

    ``values`` maps a name to (fold, value), fold one of sum, max, min. Column ``_v_<name>``
    holds the value on ordinary rows and the earlier aggregate on the added row. Halo rows
    already present keep null there.
    """
    own = {f"_v_{name}": value for name, (_, value) in values.items()}
    folds = {f"_v_{name}": _FOLDS[fold] for name, (fold, _) in values.items()}
    if HALO in blocked.columns:
        own = {name: F.when(~F.col(HALO), value) for name, value in own.items()}
        rows = blocked.withColumns(own)
        counted = rows.filter(~F.col(HALO))
    else:
        rows = blocked.withColumns({**own, HALO: F.lit(False)})
        counted = rows
    totals = counted.groupBy(*keys, BLOCK).agg(*[fold(v).alias(v) for v, fold in folds.items()])
    earlier = (
        Window.partitionBy(*_by(keys))
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    heads = totals.withColumns(
        {
            **{v: fold(v).over(earlier) for v, fold in folds.items()},
            "_nth": F.row_number().over(Window.partitionBy(*_by(keys)).orderBy(BLOCK)),
            HALO: F.lit(True),
        }
    )
    heads = heads.filter(F.col("_nth") > 1).drop("_nth")
    return rows.unionByName(heads, allowMissingColumns=True)


def running(
    blocked: DataFrame,
    aggs: dict[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    order: Sequence[str] = ("seq",),
    before: bool = False,
) -> DataFrame:
    """Add running aggregates per key: each row sees all rows up to itself.

    ``blocked`` carries the block column, which is dropped. ``aggs`` maps an output name to
    (fold, value) with fold one of sum, max, min. ``before=True`` leaves the row itself out.
    """
    frame = in_block(keys, order).rowsBetween(
        Window.unboundedPreceding, -1 if before else Window.currentRow
    )
    rows = with_totals(blocked, aggs, keys)
    return finished(
        rows.withColumns({n: _FOLDS[fold](f"_v_{n}").over(frame) for n, (fold, _) in aggs.items()})
    )


def with_halo(
    blocked: DataFrame,
    n: int,
    keys: Sequence[str],
    order: Sequence[str] = ("seq",),
    values: Sequence[str] = (),
) -> DataFrame:
    """Prepend copies of each block's last ``n`` earlier rows, flagged in ``is_halo``.

    Halo rows carry keys, block, ``order`` and ``values``; other columns are null. A window
    partitioned by (keys, block) with a frame of at most ``n`` preceding rows is then
    complete for every unflagged row.
    """
    kept = list(dict.fromkeys([*order, *values]))
    slim = blocked.select(*keys, BLOCK, *kept)
    if n == 1 and len(order) == 1:
        # Primitive columns only: a hash aggregate, no sort.
        last = [F.max(order[0]).alias(order[0])]
        last += [F.max_by(v, order[0]).alias(v) for v in kept[1:]]
        tails = slim.groupBy(*keys, BLOCK).agg(*last).select(
            *keys, BLOCK, F.array(F.struct(*kept)).alias("_tail")
        )
    else:
        newest = Window.partitionBy(*keys, BLOCK).orderBy(*[F.desc(c) for c in order])
        tails = (
            slim.withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") <= n)
            .groupBy(*keys, BLOCK)
            .agg(F.collect_list(F.struct(*kept)).alias("_tail"))
        )
    # Every block holds a row, so the last n blocks hold the last n rows: n*n structs at most.
    reach = Window.partitionBy(*_by(keys)).orderBy(BLOCK).rowsBetween(-n, -1)
    newest_first = F.sort_array(F.flatten("_tails"), asc=False)
    halo = (
        tails.withColumn("_tails", F.collect_list("_tail").over(reach))
        .select(*keys, BLOCK, F.explode(F.slice(newest_first, 1, n)).alias("_row"))
        .select(*keys, BLOCK, "_row.*", F.lit(True).alias(HALO))
    )
    return blocked.withColumn(HALO, F.lit(False)).unionByName(halo, allowMissingColumns=True)


def previous(
    blocked: DataFrame,
    value: str,
    out: str,
    keys: Sequence[str],
    order: Sequence[str] = ("seq",),
    default: object = None,
    keep_block: bool = False,
) -> DataFrame:
    """Add the value of the key's preceding row; ``default`` on its first row."""
    rows = with_halo(blocked, 1, keys, order, [value])
    seen = rows.withColumn(out, F.lag(value, 1, default).over(in_block(keys, order)))
    return seen.filter(~F.col(HALO)).drop(HALO) if keep_block else finished(seen)

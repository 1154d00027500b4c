"""User-defined aggregates that merge: partial states per task, one merge per key.

An aggregate is four functions. Rows reach it as Arrow batches of one key; states travel as bytes. A task keeps
the states of the keys it has met and hands them on when there are many, so a hot key costs a few states
per task and no task sees all its rows. The same states are carried over the micro-batches of a stream.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterable, Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from thermoweave.operators.windows import partition_count

# Workers get the functions with the task; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS_HELD = 10_000  # states a task keeps before it hands them on


class Aggregate(Protocol):
    """``result`` is the schema of what ``finish`` returns: a list of rows for a key, each a tuple.

    States can be pickled. ``merge`` may see states in any order.
    """

    result: str

    def zero(self) -> Any: ...

    def accumulate(self, state: Any, rows: pa.RecordBatch) -> Any: ...

    def merge(self, one: Any, other: Any) -> Any: ...

    def finish(self, state: Any) -> list[tuple]: ...


def _shipped(aggregate: Aggregate) -> Aggregate:
    """The same; its class travels with the tasks, so that a user's module need not be installed on the workers."""
    module = sys.modules.get(type(aggregate).__module__)
    if module is not None and module.__name__ != "__main__":
        cloudpickle.register_pickle_by_value(module)
    return aggregate


def _parts(batch: pa.RecordBatch, key: str) -> Iterator[tuple[Any, pa.RecordBatch]]:
    """The rows of each key of a batch."""
    coded = batch.column(key).dictionary_encode(null_encoding="encode")
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(codes[order])) + 1, len(order))
    start = 0
    for end in ends:
        rows = order[start:end]
        yield coded.dictionary[int(codes[rows[0]])].as_py(), batch.take(pa.array(rows))
        start = end


def partial_states(df: DataFrame, key: str, aggregate: Aggregate, keys_held: int = KEYS_HELD) -> DataFrame:
    """(key, state): what each task makes of its own rows; a key has several rows."""
    _shipped(aggregate)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        kind = None

        def given() -> pa.RecordBatch:
            states = [pickle.dumps(s) for s in held.values()]
            out = pa.RecordBatch.from_arrays([pa.array(list(held), kind), pa.array(states, pa.binary())], names=[key, "state"])
            held.clear()
            return out

        for batch in batches:
            if batch.num_rows:
                kind = batch.column(key).type
                for name, rows in _parts(batch, key):
                    held[name] = aggregate.accumulate(held[name] if name in held else aggregate.zero(), rows)
                if len(held) > keys_held:
                    yield given()
        if held:
            yield given()

    return df.mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, state binary")


def merged_states(states: DataFrame, key: str, aggregate: Aggregate) -> DataFrame:
    """(key, state): one per key. States of a key pass by one after the other."""

    def run(name: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for packed in batch.column("state"):
                state = pickle.loads(packed.as_py())
                total = state if total is None else aggregate.merge(total, state)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name[0].as_py()], name[0].type), pa.array([pickle.dumps(total)], pa.binary())], names=[key, "state"]
        )

    kind = states.schema[key].dataType.simpleString()
    placed = states.repartition(partition_count(states), key)
    return placed.groupBy(key).applyInArrow(run, f"`{key}` {kind}, state binary")


def finished_states(states: DataFrame, key: str, aggregate: Aggregate) -> DataFrame:
    """(key, *result) rows."""
    target = to_arrow_schema(StructType.fromDDL(aggregate.result))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = [], []
            for i, packed in enumerate(batch.column("state")):
                own = aggregate.finish(pickle.loads(packed.as_py()))
                rows += own
                at += [i] * len(own)
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(target)
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, target, strict=True)]
            keys = batch.column(key).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *arrays], names=[key, *target.names])

    kind = states.schema[key].dataType.simpleString()
    return states.mapInArrow(run, f"`{key}` {kind}, {aggregate.result}")


def user_aggregate(df: DataFrame, aggregate: Aggregate, key: str = "id") -> DataFrame:
    """(key, *result): a user's aggregate per key; the null key is a key."""
    return finished_states(merged_states(partial_states(df, key, aggregate), key, aggregate), key, aggregate)


class MeanTemperature:
    """The mean of the temperatures that are there."""

    result = "avg_temp double"

    def zero(self) -> tuple[float, int]:
        return 0.0, 0

    def accumulate(self, state: tuple[float, int], rows: pa.RecordBatch) -> tuple[float, int]:
        temps = rows.column("temperature").drop_null().to_numpy()
        return state[0] + float(temps.sum()), state[1] + len(temps)

    def merge(self, one: tuple[float, int], other: tuple[float, int]) -> tuple[float, int]:
        return one[0] + other[0], one[1] + other[1]

    def finish(self, state: tuple[float, int]) -> list[tuple]:
        return [(state[0] / state[1] if state[1] else None,)]


class HighestTemperatures:
    """The ``n`` highest temperatures with their rank; equal ones count each."""

    result = "rank bigint, temperature double"

    def __init__(self, n: int = 2) -> None:
        self.n = n

    def zero(self) -> list[float]:
        return []

    def accumulate(self, state: list[float], rows: pa.RecordBatch) -> list[float]:
        return self.merge(state, rows.column("temperature").drop_null().to_pylist())

    def merge(self, one: list[float], other: list[float]) -> list[float]:
        return sorted([*one, *other], reverse=True)[: self.n]

    def finish(self, state: list[float]) -> list[tuple]:
        return list(enumerate(state, 1))

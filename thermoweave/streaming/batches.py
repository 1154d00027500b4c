"""``foreachBatch`` functions: batch operators per micro-batch plus a carried number.

Every function writes one folder per micro-batch and replaces it when the micro-batch is
repeated, so results stay exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.operators.eventtime import mark_late
from thermoweave.operators.rolling import running_number
from thermoweave.operators.route import THRESHOLD, side_outputs
from thermoweave.operators.useragg import Aggregate, finished_states, merged_states, partial_states
from thermoweave.sinks.keyed import KeyedTable
from thermoweave.sinks.versions import Scalar
from thermoweave.streaming.sources import arrived

BatchWriter = Callable[[DataFrame, int], None]


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def write_sides(main_path: str, side_path: str, threshold: float = THRESHOLD) -> BatchWriter:
    """High readings to one folder, low ones to another, from one reading of the input."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            main, side = side_outputs(batch, threshold)
            _put(main, main_path, batch_id)
            _put(side, side_path, batch_id)
        finally:
            batch.unpersist()

    return write


def route_late(
    spark: SparkSession, on_time_path: str, late_path: str, state_path: str, **windows: str
) -> BatchWriter:
    """Readings too late for all their windows to one folder, the others to another.

    The highest event time so far is kept per micro-batch, so lateness is judged record by
    record across micro-batches. ``windows`` goes to ``mark_late``.
    """
    top = Scalar(spark, state_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            start = top.get(before=batch_id)
            marked = mark_late(arrived(batch), start_ms=start, **windows)
            late = F.col("late")
            _put(marked.filter(~late).drop("late", "wm_ms"), on_time_path, batch_id)
            _put(marked.filter(late).drop("late", "wm_ms"), late_path, batch_id)
            newest = batch.agg(F.max(F.unix_millis("ts")).alias("ms")).first()["ms"]
            known = [ms for ms in (start, newest) if ms is not None]
            top.put(max(known, default=None), batch_id)
        finally:
            batch.unpersist()

    return write


def number_records(spark: SparkSession, path: str, state_path: str) -> BatchWriter:
    """Records numbered 1, 2, 3 … across micro-batches."""
    count = Scalar(spark, state_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            base = count.get(before=batch_id) or 0
            _put(running_number(arrived(batch)).withColumn("n", F.col("n") + F.lit(base)), path, batch_id)
            count.put(base + batch.count(), batch_id)
        finally:
            batch.unpersist()

    return write


def send_rows(shape: Callable[[DataFrame], DataFrame], send: Callable) -> BatchWriter:
    """Shape each micro-batch and hand its partitions to ``send`` (an iterator of rows).

    For key-value stores and document indexes: ``send`` opens its client inside the task. A task that
    runs again repeats its rows; ``send_once`` tells them apart.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).foreachPartition(send)

    return write


TOKEN = "token"


def send_once(
    spark: SparkSession, shape: Callable[[DataFrame], DataFrame], send: Callable, state_path: str
) -> BatchWriter:
    """``send_rows`` for stores that keep one entry per key: each row has a ``token`` that never changes.

    The shaped micro-batch is written to ``state_path`` first, and a token is (micro-batch, file, position) there. A task or
    micro-batch that runs again sends the same rows under the same tokens, so a store that writes by token, or
    leaves out tokens it has, holds each row once. A micro-batch marked as sent is not sent again. Staged
    micro-batches go when a later one is done; null, repeated and empty rows are rows like others.
    """
    root = state_path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        jvm = spark.sparkContext._jvm
        at = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([root, *parts]))
        files = at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        name, sent = f"batch={batch_id}", at("sent", f"{batch_id:012d}")
        if files.exists(sent):
            return
        if not files.exists(at("staged", name, "_SUCCESS")):
            _put(shape(batch), f"{root}/staged", batch_id)
        place = F.concat_ws("/", F.lit(str(batch_id)), "_metadata.file_name", "_metadata.row_index")
        staged = spark.read.parquet(f"{root}/staged/{name}")
        staged.select("*", place.alias(TOKEN)).foreachPartition(send)
        files.mkdirs(at("sent"))
        files.create(sent, True).close()
        for folder, ended in (("staged", lambda n: int(n.split("=")[1])), ("sent", int)):
            for old in files.listStatus(at(folder)):
                if ended(old.getPath().getName()) < batch_id:
                    files.delete(old.getPath(), True)

    return write


def user_aggregate_batches(
    spark: SparkSession, aggregate: Aggregate, path: str, state_path: str, key: str = "id", kind: str = "string"
) -> BatchWriter:
    """Per micro-batch the result of a user's aggregate for every key it touched, over the whole stream.

    States are carried in a ``KeyedTable``. A key with a third of the rows costs a few states per task.
    """
    table = KeyedTable(spark, state_path, f"`{key}` {kind}, state binary", key)
    same = F.col(key).eqNullSafe(F.col("_key"))

    def write(batch: DataFrame, batch_id: int) -> None:
        new = partial_states(batch, key, aggregate).persist()
        try:
            keys = new.select(F.col(key).alias("_key")).distinct()
            buckets = table.buckets_of(new)
            old = table.read(before=batch_id, buckets=buckets).join(keys, same, "left_semi")
            table.merge(merged_states(old.unionByName(new), key, aggregate), batch_id)
            touched = table.read(before=batch_id + 1, buckets=buckets).join(keys, same, "left_semi")
            _put(finished_states(touched, key, aggregate), path, batch_id)
        finally:
            new.unpersist()

    return write

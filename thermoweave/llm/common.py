"""What several operators share: tables, cut lineage, batches of Arrow rows."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.session import new_path, shared_dir


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package's sources to the Python workers, once per application.

    On a cluster where it is installed this changes nothing; elsewhere workers could not import it.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from the shared folder from now on; lineage ends there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """As ``cut``, for wide rows: a compressed table in the shared folder."""
    path = new_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Rounds:
    """As ``written``, for results that replace each other: the one before goes once the next is there."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path = spark, None

    def put(self, df: DataFrame) -> DataFrame:
        path = new_path(self.spark, "round")
        df.write.parquet(path)
        self.drop()
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete the newest result; nothing may read it any more."""
        if self.path:
            context = self.spark.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(self.path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        self.path = None


SLICE_ROWS = 256


def sliced(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, at most ``rows`` at a time, without copies.

    A batch holds 10,000 rows. A worker that makes Python objects of all of them needs several times the memory
    of the batch, and keeps it for the tasks that follow.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()  # workers live on, also through stages without Python


def map_batches(df: DataFrame, function, schema: str, rows: int | None = None) -> DataFrame:
    """``function(batch as dict of Python lists) -> dict of columns``, once per Arrow batch, or per ``rows`` of it.

    The function must return every column of ``schema``; how many rows is up to it.
    """
    target = _arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, rows) if rows else batches:
            if batch.num_rows:
                out = function(batch.to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in target], schema=target
                )

    return df.mapInArrow(run, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a flat schema string such as ``"id long, bands array<long>"``."""
    simple = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
    }

    def kind(text: str) -> pa.DataType:
        if text.startswith("array<"):
            return pa.list_(kind(text[6:-1]))
        return simple[text]

    return pa.schema([(n, kind(t)) for n, t in (x.split() for x in schema.split(", "))])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with more underscores in front where ``df`` has such columns."""
    out = []
    for name in names:
        while name in df.columns:
            name = f"_{name}"
        out.append(name)
    return out


def ascii_lower(col):
    """A-Z lower-cased, every other character left alone."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

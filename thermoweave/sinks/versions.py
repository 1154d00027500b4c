"""Small tables kept as one folder per micro-batch below a shared path.

Version ``n`` is written once micro-batch ``n`` is done. Writing it again gives the same
rows, so a repeated micro-batch does no harm, and a reader never sees half a version. Only the
newest versions are kept, so a long stream lists a few folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


KEPT = 3  # two are needed to repeat the newest


class Versions:
    def __init__(self, spark: SparkSession, path: str, ddl: str):
        self.spark, self.path, self.ddl = spark, path.rstrip("/"), ddl

    def _root(self):
        sc = self.spark.sparkContext
        root = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(sc._jsc.hadoopConfiguration())

    def _finished(self) -> list[int]:
        sc = self.spark.sparkContext
        root, files = self._root()
        if not files.exists(root):
            return []
        folders = [s.getPath() for s in files.listStatus(root)]
        return sorted(
            int(f.getName().split("=")[1])
            for f in folders
            if files.exists(sc._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))
        )

    def read(self, before: int | None = None) -> DataFrame:
        """The newest finished version, or the newest one older than ``before``."""
        kept = [v for v in self._finished() if before is None or v < before]
        if not kept:
            return self.spark.createDataFrame([], self.ddl)
        return self.spark.read.schema(self.ddl).parquet(f"{self.path}/version={kept[-1]}")

    def write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/version={version}")
        root, files = self._root()
        for old in self._finished()[:-KEPT]:
            files.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"version={old}"), True)


class Scalar:
    """One BIGINT carried from micro-batch to micro-batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.versions = Versions(spark, path, "value bigint")

    def get(self, before: int) -> int | None:
        row = self.versions.read(before).first()
        return None if row is None else row["value"]

    def put(self, value: int | None, version: int) -> None:
        self.versions.write(self.spark.createDataFrame([(value,)], "value bigint"), version)

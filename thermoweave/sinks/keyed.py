"""Tables of one row per key that grow by what changes.

A version writes the rows of the keys it touches, split by hashed buckets, as one *segment*. A manifest per
version names the segments of every bucket; the newest row of a key wins. A bucket with many segments is written
anew as a whole, and segments and manifests that no kept version needs are deleted. So a
micro-batch writes in proportion to the keys it touches and opens one small manifest, however old
the table is.

Version ``n`` belongs to micro-batch ``n``. Writing it again replaces it, from the version before,
which is kept; a version without its manifest does not exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.sinks.segments import _VERSION, KEPT, SegmentTable

BUCKETS = 64
SEGMENTS = 8  # of a bucket, before it is written anew
_BUCKET = "_bucket"


class KeyedTable(SegmentTable):
    """``buckets`` should let one bucket's rows fit a task; keys may be null."""

    def __init__(
        self, spark: SparkSession, path: str, ddl: str, key: str,
        buckets: int = BUCKETS, segments: int = SEGMENTS, kept: int = KEPT,
    ) -> None:
        super().__init__(spark, path, ddl, kept)
        self.key, self.buckets, self.segments = key, buckets, segments

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets that hold the keys of some rows: at most ``buckets`` numbers."""
        return sorted(r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect())

    def read(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The newest row of every key, in the newest version or the newest older than ``before``."""
        return self._rows(self._manifest(before)["segments"], buckets)

    def _rows(self, segments: dict[str, list[int]], buckets: list[int] | None = None) -> DataFrame:
        wanted = segments if buckets is None else {str(b): segments.get(str(b), []) for b in buckets}
        paths = [
            f"{self.path}/segments/{_VERSION}={v}/{_BUCKET}={b}" for b, versions in wanted.items() for v in versions
        ]
        empty = self.spark.createDataFrame([], self.ddl)
        if not paths:
            return empty
        found = (
            self.spark.read.schema(f"{self.ddl}, {_VERSION} bigint, {_BUCKET} int")
            .option("basePath", f"{self.path}/segments").parquet(*paths)
        )
        newest = found.groupBy(self.key).agg(F.max_by(F.struct(*empty.columns), _VERSION).alias("_row"))
        return newest.select("_row.*")

    def merge(self, rows: DataFrame, version: int, meta: dict | None = None) -> None:
        """Version ``version``: ``rows``, one per key, replace the rows of their keys."""
        before = self._manifest(version)
        placed = rows.select(*self.spark.createDataFrame([], self.ddl).columns).withColumn(_BUCKET, self._bucket())
        placed.persist()
        try:
            touched = sorted(r[0] for r in placed.select(_BUCKET).distinct().collect())
            segments = dict(before["segments"])
            full = [b for b in touched if len(segments.get(str(b), [])) >= self.segments]
            if full:
                same = F.col(f"old.{self.key}").eqNullSafe(F.col(f"new.{self.key}"))
                rest = self._rows(segments, full).alias("old").join(placed.alias("new"), same, "left_anti")
                placed_all = placed.unionByName(rest.withColumn(_BUCKET, self._bucket()))
            else:
                placed_all = placed
            target = f"{self.path}/segments/{_VERSION}={version}"
            placed_all.repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(target)
            for b in touched:
                segments[str(b)] = [version] if b in full else [*segments.get(str(b), []), version]
            self._publish({"version": version, "meta": meta or {}, "segments": segments})
        finally:
            placed.unpersist()
        self._clean()

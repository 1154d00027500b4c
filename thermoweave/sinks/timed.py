"""Tables of rows that wait for their time.

Rows are appended, never written anew: a version adds one segment, cut into intervals of time, and a reader
opens only the intervals it asks for. What lies wholly behind is dropped from the manifest, and its
files go once no kept version needs them. So a micro-batch writes what came, however much waits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoweave.sinks.segments import _VERSION, KEPT, SegmentTable

_INTERVAL = "_interval"


class TimedTable(SegmentTable):
    """``at`` is the column that cuts the table, in epoch micros and never null; ``width`` the width of an interval."""

    def __init__(self, spark: SparkSession, path: str, ddl: str, at: str, width: int, kept: int = KEPT) -> None:
        super().__init__(spark, path, ddl, kept)
        self.at, self.width = at, width

    def _interval(self):
        return F.floor(F.col(self.at) / F.lit(self.width)).cast("bigint")

    def intervals_of(self, rows: DataFrame) -> list[int]:
        """The intervals some rows lie in: as many numbers as the rows' times span intervals."""
        return sorted(r[0] for r in rows.select(self._interval().alias("i")).distinct().collect())

    def read(
        self, before: int | None, first: int, until: int, intervals: list[int] | None = None
    ) -> DataFrame:
        """Rows of the newest version older than ``before`` with ``first <= at < until``, of some or all intervals."""
        segments = self._manifest(before)["segments"]
        wanted = None if intervals is None else set(intervals)
        paths = [
            f"{self.path}/segments/{_VERSION}={v}/{_INTERVAL}={i}"
            for i, versions in segments.items()
            if first < (int(i) + 1) * self.width and int(i) * self.width < until
            and (wanted is None or int(i) in wanted)
            for v in versions
        ]
        empty = self.spark.createDataFrame([], self.ddl)
        if not paths:
            return empty
        found = (
            self.spark.read.schema(f"{self.ddl}, {_VERSION} bigint, {_INTERVAL} bigint")
            .option("basePath", f"{self.path}/segments").parquet(*paths)
        )
        return found.where((F.col(self.at) >= first) & (F.col(self.at) < until)).select(*empty.columns)

    def add(self, rows: DataFrame, version: int, meta: dict, needed_from: int) -> None:
        """Version ``version``: the one before and ``rows``, without intervals wholly older than ``needed_from``."""
        before = self._manifest(version)["segments"]
        segments = {i: vs for i, vs in before.items() if (int(i) + 1) * self.width > needed_from}
        placed = rows.select(*self.spark.createDataFrame([], self.ddl).columns).withColumn(_INTERVAL, self._interval())
        name = f"{_VERSION}={version}"
        # A crowded interval is split over tasks, small ones share a task.
        rebalanced = placed.hint("rebalance", _INTERVAL)
        rebalanced.write.mode("overwrite").partitionBy(_INTERVAL).parquet(f"{self.path}/segments/{name}")
        for folder in self._names("segments", name):
            if folder.startswith(f"{_INTERVAL}="):
                i = folder.split("=")[1]
                segments[i] = [*segments.get(i, []), version]
        self._publish({"version": version, "meta": meta, "segments": segments})
        self._clean()

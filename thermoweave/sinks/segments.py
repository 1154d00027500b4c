"""Versions of a table as a manifest each over shared segments of Parquet files.

A version writes its new rows as one *segment*, a folder cut by a bucket column, and a manifest that names, for every
bucket, the versions whose segments hold its rows. Manifests appear whole or not at all, segments and manifests
that no kept version needs are deleted, and version ``n`` belongs to micro-batch ``n``: writing
it again replaces it, from the version before, which is kept.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

KEPT = 3  # versions; two are needed to repeat the newest
_VERSION = "_version"


class SegmentTable:
    def __init__(self, spark: SparkSession, path: str, ddl: str, kept: int = KEPT) -> None:
        if kept < 2:
            raise ValueError("the version before the newest is needed")
        self.spark, self.path, self.ddl, self.kept = spark, path.rstrip("/"), ddl, kept

    def _at(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        return jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _files(self):
        return self._at().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        files, folder = self._files(), self._at(*parts)
        return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []

    def _versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json")]

    def _manifest(self, before: int | None) -> dict:
        versions = [v for v in self._versions() if before is None or v < before]
        if not versions:
            return {"version": None, "meta": {}, "segments": {}}
        stream = self._files().open(self._at("manifests", f"{versions[-1]:012d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        """The manifest appears whole or not at all."""
        files = self._files()
        name = f"{manifest['version']:012d}"
        draft, final = self._at("manifests", f"{name}.draft"), self._at("manifests", f"{name}.json")
        out = files.create(draft, True)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        files.delete(final, False)
        if not files.rename(draft, final):
            raise OSError(f"cannot publish {final}")

    def _clean(self) -> None:
        """Delete old manifests, then segments no kept manifest names."""
        versions = self._versions()
        old = versions[: -self.kept]
        if not old:
            return
        for version in old:
            self._files().delete(self._at("manifests", f"{version:012d}.json"), False)
        needed = {v for b in versions[-self.kept :] for vs in self._manifest(b + 1)["segments"].values() for v in vs}
        for name in self._names("segments"):
            version = int(name.split("=")[1])
            if version < versions[-1] and version not in needed:
                self._files().delete(self._at("segments", name), True)

    def meta(self, before: int | None = None) -> dict:
        """What was put beside the newest version (older than ``before``)."""
        return self._manifest(before)["meta"]

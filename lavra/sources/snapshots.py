"""Tables that are replaced as a whole, or not at all.

A table's root holds data folders and ``_versions/<n>`` files. A version names
the folders that make it up; it is written aside and renamed into place, which
fails if the number is taken. So readers see the last complete version whatever
a writer is doing, a write that breaks off leaves the one before, and of two
writers that start from the same version one is told that it has lost. The
rename is atomic where the store's is (HDFS, ABFS and the like; on a local disk
within one host).
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from .files import hadoop_path

KEPT_MARKERS = 64


class VersionConflict(RuntimeError):
    """Another writer has committed the version that this one meant to."""


class Versions:
    """The version files of one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs, _ = hadoop_path(spark, self.root)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def numbers(self) -> list[int]:
        folder = self._path("_versions")
        if not self.fs.exists(folder):
            return []
        return sorted(int(n) for n in (f.getPath().getName() for f in self.fs.listStatus(folder)) if n.isdigit())

    def read(self, version: int) -> dict:
        stream = self.fs.open(self._path(f"_versions/{version:012d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """(0, {}) before the first version."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def commit(self, base: int, state: dict) -> int:
        """Makes ``state`` the version after ``base``; VersionConflict if there is one already."""
        jvm = self.spark._jvm
        aside, place = self._path(f"_versions/.{uuid.uuid4().hex}"), self._path(f"_versions/{base + 1:012d}")
        out = self.fs.create(aside, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        never_replace = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(aside, place, never_replace)
        except Exception as exc:
            self.fs.delete(aside, False)
            if self.fs.exists(place):
                raise VersionConflict(f"version {base + 1} of {self.root} is taken") from exc
            raise
        if (base + 1) % KEPT_MARKERS == 0:
            for n in self.numbers()[:-KEPT_MARKERS]:
                self.fs.delete(self._path(f"_versions/{n:012d}"), False)
        return base + 1

    def drop_unused(self, keep: int = 2, older_than_s: float = 86_400.0) -> list[str]:
        """Deletes the data folders that none of the last ``keep`` versions names, if they are old enough
        to be neither a running writer's nor read by a running query; returns their names."""
        used = {f for n in self.numbers()[-keep:] for f in self.read(n)["folders"]}
        gone, before = [], (time.time() - older_than_s) * 1000
        for f in self.fs.listStatus(self._path("")) if self.fs.exists(self._path("")) else []:
            name = f.getPath().getName()
            if f.isDirectory() and name.startswith("data-") and name not in used and f.getModificationTime() <= before:
                self.fs.delete(f.getPath(), True)
                gone.append(name)
        return sorted(gone)


def data_folder() -> str:
    return f"data-{uuid.uuid4().hex}"


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None) -> int:
    """Writes the rows to a new folder and makes it the table's next version; returns the version."""
    versions = Versions(df.sparkSession, root)
    base, _ = versions.current()
    folder = data_folder()
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{versions.root}/{folder}")
    return versions.commit(base, {"folders": [folder], "schema": df.schema.json()})


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of its last version, or of an earlier one that is still kept."""
    from pyspark.sql.types import StructType
    versions = Versions(spark, root)
    number, state = versions.current() if version is None else (version, versions.read(version))
    if not number:
        raise FileNotFoundError(f"no version of {root}")
    return spark.read.schema(StructType.fromJson(json.loads(state["schema"]))).parquet(f"{versions.root}/{state['folders'][0]}")


__all__ = ["VersionConflict", "Versions", "data_folder", "publish", "read_snapshot"]

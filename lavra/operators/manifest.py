"""Which landed files are new, changed or gone, by their content.

A manifest has a row per file: key, file, length, modified, sha256. A file whose
length and time are those of the last manifest keeps the hash it has there; only
others are read and hashed, so a look at unchanged bronze reads no content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..sources.jsonl import missing_path

MANIFEST_SCHEMA = "key string, file string, length bigint, modified timestamp, sha256 string"
NEW, CHANGED, MISSING, SAME = "new", "changed", "missing", "same"


def file_manifest(spark: SparkSession, path: str, key: Column, glob: str = "*", known: DataFrame | None = None) -> DataFrame:
    """The manifest of the files under a path; ``key`` is taken from the column ``file`` (null: not listed)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    try:
        files = reader.load(path)
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    named = files.withColumnsRenamed({"path": "file", "modificationTime": "modified"}).withColumn("key", key).filter("key is not null")
    listed = named.select("key", "file", "length", "modified")
    if known is None:
        return named.select("key", "file", "length", "modified", F.sha2("content", 256).alias("sha256"))
    held = known.select("file", "length", "modified", "sha256")
    kept = listed.join(held, ["file", "length", "modified"]).select("key", "file", "length", "modified", "sha256")
    other = listed.join(held, ["file", "length", "modified"], "left_anti").select("file")
    hashed = named.join(other, "file", "left_semi").select("key", "file", "length", "modified", F.sha2("content", 256).alias("sha256"))
    return kept.unionByName(hashed)


def content_of(manifest: DataFrame) -> DataFrame:
    """key, content: one hash of all files of a key, whatever their names' order or times."""
    return manifest.groupBy("key").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ","), 256).alias("content"))


def manifest_diff(committed: DataFrame, present: DataFrame) -> DataFrame:
    """key, status of every key of either manifest: new, changed, missing (committed, but no file is left) or same."""
    was, now = content_of(committed).withColumnRenamed("content", "was"), content_of(present).withColumnRenamed("content", "now")
    status = (F.when(F.col("was").isNull(), NEW).when(F.col("now").isNull(), MISSING)
              .when(F.col("was") != F.col("now"), CHANGED).otherwise(SAME))
    return was.join(now, "key", "full_outer").select("key", status.alias("status"))

"""Landed raw files: listing and byte reads through the binaryFile source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def list_layer(spark: SparkSession, root: str, layer: str, glob: str | None = None) -> DataFrame:
    """Files under ``root/layer/`` (the trailing slash keeps ``x`` apart from ``x_y``).

    Only metadata columns are selected, so file contents are never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    prefix = root.rstrip("/") + "/" + layer.strip("/") + "/"
    return reader.load(prefix).select("path", "length", "modificationTime")


def read_bytes(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, modificationTime, length, content)`` rows, one per file."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def with_extension(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Add the lower-cased extension used to route files to a reader."""
    return df.withColumn("ext", F.lower(F.regexp_extract(F.col(path_col), r"\.([^./]+)$", 1)))


def route_by_extension(files: DataFrame, supported: list[str], path_col: str = "path") -> dict[str, DataFrame]:
    """Split landed files by lower-cased extension; an unsupported one is an error.

    Returns one DataFrame per supported extension (filters over one scan).
    The unsupported check is a single aggregate over file metadata, and the
    error names a few offending paths.
    """
    tagged = with_extension(files, path_col)
    bad = tagged.filter(~F.col("ext").isin(list(supported)))
    sample = [r[path_col] for r in bad.select(path_col).limit(5).collect()]
    if sample:
        raise ValueError(f"unsupported file type(s), e.g. {sample}")
    return {ext: tagged.filter(F.col("ext") == ext) for ext in supported}


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API, for any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> bool:
    """Removes a folder with all in it; False if there was none."""
    system, p = hadoop_path(spark, path)
    return system.delete(p, True)

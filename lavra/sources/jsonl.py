"""JSON-lines bronze and landed API pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Declared-schema JSON lines; blank lines skipped; missing path → empty frame."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return spark.createDataFrame([], schema)


def missing_path(exc: AnalysisException) -> bool:
    """Whether a read failed only because there is nothing at the path."""
    return exc.getCondition() == "PATH_NOT_FOUND"


# no JSON text holds it raw, so a file without it is read as one record
_FILE_END = "\u0000"


def page_reader(spark: SparkSession, schema: StructType | str) -> DataFrameReader:
    """Reader of files of one JSON value each, however many lines it spans.

    Spark's multi-line reader opens the file again for every raw text (an object
    read as a string) in it; a record held as bytes has its raw texts copied out.
    """
    return spark.read.schema(schema).option("lineSep", _FILE_END)


def read_envelope_pages(spark: SparkSession, path: str, rows_field: str = "data") -> DataFrame:
    """Paged API responses ``{data:[…], totalPaginas}`` → one row per record.

    Each record is kept as its JSON text (a string field captures the raw
    object), with the page file it came from and its position in the page.
    """
    pages = (page_reader(spark, f"`{rows_field}` array<string>, totalPaginas bigint").json(path)
             .withColumn("source_file", F.col("_metadata.file_path")))
    return pages.select("source_file", "totalPaginas",
                        F.posexplode(rows_field).alias("position", "payload"))


# a string field keeps the geometry's own text, whatever it holds besides rings
ESRI_SCHEMA = "features array<struct<attributes: map<string, string>, geometry: string>>"
GEOMETRY_SCHEMA = "rings array<array<array<double>>>"


def esri_features(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Page texts ``(source_file, payload)`` → one row per feature, as ``read_esri_pages`` gives them."""
    kept = ["source_file", *(keep or [])]
    doc = pages.select(*kept, F.explode(F.array(F.from_json("payload", ESRI_SCHEMA))).alias("doc"))  # parsed once
    return doc.select(*kept, F.posexplode("doc.features").alias("position", "f")).select(
        *kept, "position", "f.attributes", F.from_json("f.geometry", GEOMETRY_SCHEMA).alias("geometry"),
        F.col("f.geometry").alias("geometry_raw"))


def read_esri_pages(spark: SparkSession, path: str) -> DataFrame:
    """ESRI query pages ``{features:[{attributes, geometry}]}`` → one row per feature."""
    pages = (page_reader(spark, ESRI_SCHEMA).json(path)
             .withColumn("source_file", F.col("_metadata.file_path")))
    return pages.select("source_file", F.posexplode("features").alias("position", "f")) \
                .select("source_file", "position", "f.attributes",
                        F.from_json("f.geometry", GEOMETRY_SCHEMA).alias("geometry"),
                        F.col("f.geometry").alias("geometry_raw"))

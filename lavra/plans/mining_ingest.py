"""Mining claims: landed attribute and geometry pages → bronze → silver, resumable.

Each section is a stream of its landed pages (``streaming.pages``). A batch is
written to its own folder, which a replay of it replaces, and Spark commits its
offsets after that; the next run goes on at the first page that is not in yet. A
section whose pages are all in starts no batch. Overwrite forgets a section's
bronze and offsets before it starts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..sources.files import delete_path
from ..sources.jsonl import esri_features, missing_path
from ..streaming.pages import read_page_stream
from . import mining

SECTIONS = ("attributes", "geometry")
LINEAGE = "start_offset bigint, end_offset bigint, source_file string, position int"
FEATURES = {"attributes": f"attributes map<string,string>, fid bigint, {LINEAGE}, dt_ingestao string",
            "geometry": f"processo string, lat double, lon double, geometry_raw string, {LINEAGE}, dt_ingestao string"}


def _bronze(lake: str, section: str) -> str:
    return f"{lake}/bronze/{section}"


def section_rows(pages: DataFrame, section: str, ingest_date: str) -> DataFrame:
    """Pages → the section's bronze rows; a page that isn't a feature page fails the batch."""
    checked = pages.withColumn("payload", F.when(
        F.get_json_object("payload", "$.features").isNotNull(), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("not a feature page: "), F.col("source_file")))))
    rows = esri_features(checked, keep=["start_offset", "end_offset"])
    shaped = (mining.attributes_rows if section == "attributes" else mining.geometry_rows)(rows, ingest_date, keep=["start_offset", "end_offset"])
    return shaped.select(*[f.split()[0] for f in FEATURES[section].replace("map<string,string>", "map").split(", ")])


def ingest_section(spark: SparkSession, landing: str, lake: str, section: str, ingest_date: str, mode: str = "append",
                   after_write: Callable[[int], None] | None = None) -> int:
    """Loads the section's pages that follow the watermark; returns the new watermark.

    ``after_write`` is called with the batch id once a batch is written and not yet committed.
    """
    if section not in SECTIONS:
        raise ValueError(f"section must be one of {SECTIONS}")
    out, offsets = _bronze(lake, section), f"{lake}/_offsets/{section}"
    if mode == "overwrite":
        delete_path(spark, out)
        delete_path(spark, offsets)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        section_rows(batch, section, ingest_date).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if after_write:
            after_write(batch_id)

    query = (read_page_stream(spark, f"{landing}/{section}").writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", offsets).trigger(availableNow=True).start())
    query.awaitTermination()
    return watermark(spark, lake, section)


def read_bronze(spark: SparkSession, lake: str, section: str) -> DataFrame:
    try:
        return spark.read.schema(FEATURES[section]).option("recursiveFileLookup", "true").parquet(_bronze(lake, section))
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return spark.createDataFrame([], FEATURES[section])


def watermark(spark: SparkSession, lake: str, section: str) -> int:
    """The end of the last page in bronze."""
    return read_bronze(spark, lake, section).agg(F.max("end_offset").alias("at")).first()["at"] or 0


def ingest(spark: SparkSession, landing: str, lake: str, ingest_date: str, mode: str = "append") -> dict[str, int]:
    """Both sections; the watermark of each."""
    return {s: ingest_section(spark, landing, lake, s, ingest_date, mode) for s in SECTIONS}


def silver(spark: SparkSession, lake: str) -> DataFrame:
    """Silver from all of bronze: claims of the state and substances, joined to their geometry."""
    attrs, geometry = (read_bronze(spark, lake, s) for s in SECTIONS)
    return mining.silver(mining.source_filter(attrs), geometry)

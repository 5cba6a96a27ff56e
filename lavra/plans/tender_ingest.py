"""Tender ingest: landed monthly archives → bronze, by period, with a ledger.

Periods are planned per year; committed ones are skipped, and only the
archives of pending periods are opened. Non-empty periods are written in
batches of a few months, in order; a batch's periods are committed after its
write. A period is a folder of bronze that its load replaces, so a load that
was written but not committed is not doubled by the next one, on any day. A period fails if its archive can't be read, or if it has no works rows
where an empty month counts as a failure; failed periods stay pending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..operators import batch_ids, commit_keys, monthly_periods, outcome_status, pending, read_ledger, reset_ledger
from ..sources.jsonl import missing_path
from ..sources.sinks import write_parquet
from ..sources.snapshots import publish, read_snapshot
from .tenders import bronze_from_lines, landed_lines, silver

PIPELINE = "tenders"
BATCH_PERIODS = 6
STAGE = "line_no bigint, line string, error string, period string"


def landed_archives(spark: SparkSession, landing: str) -> DataFrame:
    """path, period of the landed ``…yyyy-MM….zip`` files: a listing, nothing is opened."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.zip").load(landing).select("path"))
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return spark.createDataFrame([], "path string, period string")
    period = F.regexp_extract("path", r"(\d{4}-\d{2})[^/]*\.zip$", 1)
    return files.withColumn("period", period).filter("period <> ''")


def ingest(spark: SparkSession, landing: str, lake: str, years: list[int], ingest_date: str,
           batch_periods: int = BATCH_PERIODS, empty_is_failure: bool = False, mode: str = "append") -> DataFrame:
    """Load what is pending; returns period, status, error, rows_seen, rows_kept, batch_id of the periods tried."""
    ledger = f"{lake}/_ledger"
    if mode == "overwrite":
        reset_ledger(spark, ledger, PIPELINE)
    plan = monthly_periods(spark.createDataFrame([(y,) for y in years], "year int")).withColumnRenamed("period", "key")
    todo = pending(plan, read_ledger(spark, ledger, PIPELINE))
    # one archive a period, so at most the plan's length
    found = landed_archives(spark, landing).join(todo.select(F.col("key").alias("period")), "period", "left_semi").collect()
    empty = "period string, error string, rows_seen bigint, rows_kept bigint, status string, seq int, batch_id int"
    if not found:
        return spark.createDataFrame([], empty)
    periods = sorted({r["period"] for r in found})
    # every pending archive is parsed once, into the run's own folder of the lake, by period
    stage = f"{lake}/_stage/date={ingest_date}"
    lines = landed_lines(spark, landing, periods)
    write_parquet(lines.filter("error is not null or (line_no > 0 and line <> '')"), stage, partition_by=["period"])
    staged = spark.read.schema(STAGE).parquet(stage)
    rows = bronze_from_lines(staged.filter("error is null").select("period", "line"), ingest_date)
    kept = rows.groupBy(F.col("periodo").alias("period")).agg(F.count(F.lit(1)).alias("rows_kept"))
    outcome = (spark.createDataFrame([(p,) for p in periods], "period string")
               .join(staged.groupBy("period").agg(F.max("error").alias("error"), F.count("line").alias("rows_seen")),
                     "period", "left").join(kept, "period", "left").fillna(0, ["rows_seen", "rows_kept"])
               .withColumn("status", outcome_status(F.col("error").isNotNull().cast("int"), F.col("rows_kept"),
                                                    empty_is_failure)))
    batches = batch_ids(outcome.filter("status = 'ok'"), ["period"], batch_periods, F.col("rows_kept") > 0)
    done = outcome.join(batches.select("period", "seq", "batch_id"), "period", "left")
    result = f"{lake}/_outcomes/date={ingest_date}"
    write_parquet(done.select("period", "error", "rows_seen", "rows_kept", "status", "seq", "batch_id"), result)
    done = spark.read.parquet(result)
    closed = done.filter("batch_id is not null").groupBy("batch_id").agg(F.collect_list("period").alias("periods"))
    for r in closed.orderBy("batch_id").collect():  # at most the plan's periods, a few in each batch
        mine = F.col("period").isin(r["periods"])
        (bronze_from_lines(staged.filter(mine & F.col("error").isNull()).select("period", "line"), ingest_date)
         .withColumn("period", F.col("periodo")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("period").parquet(f"{lake}/bronze"))
        commit_keys(done.filter(mine).select("period"), ledger, PIPELINE, "period")
    # read in full and empty: an answer, where empty months are no failure
    commit_keys(done.filter("status = 'ok' and batch_id is null").select("period"), ledger, PIPELINE, "period")
    return done


def write_silver(spark: SparkSession, lake: str) -> DataFrame:
    """Rebuild silver from all of bronze as the table's next version; returns it."""
    publish(silver(spark.read.parquet(f"{lake}/bronze").drop("period")), f"{lake}/silver")
    return read_snapshot(spark, f"{lake}/silver")

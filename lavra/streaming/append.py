"""Append-only bronze loads that resume where they stopped.

The stream checkpoint remembers which landed files were processed, so a
rerun with ``trigger(availableNow=True)`` picks up only new files. Each
micro-batch writes its data into its own ``batch_id=<n>`` folder with
overwrite, so a batch replayed after a failure replaces itself instead of
duplicating rows; only after that write do its source files enter the ledger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.ledger import commit_keys
from ..sources.jsonl import missing_path


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return spark.createDataFrame([], schema)


def stream_append_jsonl(spark: SparkSession, src: str, schema: str, pipeline: str,
                        root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Load every not-yet-seen JSON-lines file under ``src`` into ``root/bronze``.

    Returns the whole bronze table after the run (old and new rows).
    """
    bronze, ckpt, ledger = f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_ledger"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(src).withColumn("source_file", F.col("_metadata.file_path"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = f"{bronze}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(out)
        # the ledger takes its keys from what was written (a one-column Parquet
        # scan), not from a second pass over the JSON source
        written = spark.read.parquet(out).select(F.col("source_file").alias("key")).distinct()
        commit_keys(written, ledger, pipeline)

    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    query.awaitTermination()
    return _read_or_empty(spark, bronze, schema + ", source_file string, batch_id int")


def stream_distinct_keys(spark: SparkSession, src: str, schema: str, keys: Sequence[str],
                         root: str, event_time: str | None = None,
                         delay: str = "1 day") -> DataFrame:
    """Streaming keep-first by business key: each key is emitted once, ever.

    Without ``event_time`` the state holds every key seen (use the RocksDB
    state store at scale); with it, keys expire once the watermark passes
    (``dropDuplicatesWithinWatermark``). The batch ``keep_first`` stays the
    authority on *which* row of a key is first.
    """
    out, ckpt = f"{root}/keys", f"{root}/_checkpoint"
    stream = spark.readStream.schema(schema).json(src)
    if event_time:
        deduped = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    else:
        deduped = stream.dropDuplicates(list(keys))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.select(*keys).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (deduped.writeStream.foreachBatch(write_batch).outputMode("append")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    query.awaitTermination()
    return _read_or_empty(spark, out, schema).select(*keys)

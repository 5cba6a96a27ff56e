"""Small helpers shared by the operators: scratch tables, words, declared strata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.session import scratch_path

WORD_SEPARATORS = " \t\n\x0b\f\r"
SEPARATOR_RUN = r"[\x20\x09-\x0D]+"

# Strata known by name; every other or missing language is one stratum more,
# so a table with a row per stratum is bounded whatever the input holds.
LANGUAGES = ("en", "de", "fr", "es")
OTHER = "other"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write to a fresh folder of the shared scratch space and read it back.

    Cuts the lineage with a table that any executor can read again, so a lost
    executor costs the tasks it ran and nothing that was finished before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1_000, read: int = 128) -> None:
    """At most so many rows of whole texts in one Arrow batch, so that a task holds a few MB of them.

    ``read``: rows that the Parquet reader decodes at once. Its default of 4096 makes arrays of tens of MB
    of texts or token lists, which the JVM needs in one piece and doesn't move.
    """
    for key, usual, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", rows),
                             ("spark.sql.parquet.columnarReaderBatchSize", "4096", read)):
        now = int(spark.conf.get(key, usual))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank text have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SEPARATORS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SEPARATOR_RUN))


def stratum(lang: Column, known: Sequence[str] = LANGUAGES) -> Column:
    """The language if it is a declared one, else ``other`` (null too)."""
    return F.when(lang.isin(*known), lang).otherwise(F.lit(OTHER))

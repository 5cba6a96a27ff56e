"""Tender line items: monthly zipped ``;`` CSV → bronze → typed silver.

Bronze: the first member of each monthly archive, decoded as ISO-8859-1,
split into lines and parsed with the strict bad-line policy (too many fields
→ dropped, too few → null-padded), renamed by position, filtered to works
tenders, with ``periodo`` and ``dt_ingestao`` lineage. Silver: Brazilian
money/quantity parsing, day-first dates, whitespace-stripped text and
full-row distinct (a re-ingest on another day is not a duplicate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import config
from ..functions import br_money, br_quantity, parse_dayfirst, parse_iso, strip_unicode
from ..operators import distinct_rows
from ..sources import read_quoted, read_zip, zip_lines
from ..sources.delimited import parse_delimited_lines

SOURCE_COLUMNS = config.TENDER_COLUMNS[:21]


def parse_lines(lines: DataFrame, columns: list[str], sep: str = ";") -> DataFrame:
    """CSV text lines → columns with the strict bad-line policy (all text)."""
    return parse_delimited_lines(lines, columns, sep)


def archive_lines(archives: DataFrame) -> DataFrame:
    """``(path, period, content)`` monthly archives → path, period, line_no, line, error.

    A broken or empty archive is one row with ``error``; callers report those rows.
    """
    return zip_lines(archives, ["path", "period"])


def landed_lines(spark: SparkSession, landing: str, periods: list[str]) -> DataFrame:
    """The landed ``…yyyy-MM….zip`` archives of these periods → period, line_no, line (a record), error.

    Members are read where they lie; archives of other periods aren't opened.
    """
    if not periods:
        return spark.createDataFrame([], "period string, line_no bigint, line string, error string")
    rows = read_zip(spark, landing, names=f"(?:{'|'.join(periods)})[^/]*\\.zip$", first=True, sep=";", charset="ISO-8859-1")
    return rows.select(F.regexp_extract("archive", r"(\d{4}-\d{2})[^/]*\.zip$", 1).alias("period"), "line_no", "line", "error")


def bronze_from_archives(archives: DataFrame, ingest_date: str) -> DataFrame:
    """Monthly archives → works-tender bronze rows (archives with an error have none)."""
    lines = archive_lines(archives).filter((F.col("line_no") > 0) & (F.col("line") != ""))
    return bronze_from_lines(lines.select("period", "line"), ingest_date)


def bronze_from_files(spark: SparkSession, path: str, ingest_date: str,
                      period_col: str = "period") -> DataFrame:
    """Landed monthly CSV files (``path/period=yyyy-MM/*``, no header) → works-tender bronze."""
    rows = read_quoted(spark, path, SOURCE_COLUMNS, sep=";", charset="ISO-8859-1", header=False)
    works = rows.filter(F.col("objeto") == F.lit(config.TENDER_WORKS_OBJECT))
    return works.select(*SOURCE_COLUMNS, F.col(period_col).cast("string").alias("periodo"),
                        F.lit(ingest_date).alias("dt_ingestao"))


def bronze_from_lines(lines: DataFrame, ingest_date: str) -> DataFrame:
    """``(period, line)`` CSV data lines → works-tender bronze rows."""
    rows = parse_lines(lines, SOURCE_COLUMNS)
    works = rows.filter(F.col("objeto") == F.lit(config.TENDER_WORKS_OBJECT))
    return works.select(*SOURCE_COLUMNS, F.col("period").alias("periodo"),
                        F.lit(ingest_date).alias("dt_ingestao"))


def silver(bronze: DataFrame) -> DataFrame:
    typed = {c: br_money(c) for c in config.TENDER_MONEY_COLUMNS if c in bronze.columns}
    typed.update({c: br_quantity(c) for c in config.TENDER_QUANTITY_COLUMNS if c in bronze.columns})
    if "dt_edital" in bronze.columns:
        typed["dt_edital"] = parse_dayfirst("dt_edital")
    if "dt_ingestao" in bronze.columns:
        typed["dt_ingestao"] = parse_iso("dt_ingestao")
    out = bronze.withColumns(typed)
    text_cols = [c for c, t in out.dtypes if t == "string"]
    # stripped as one array: an expression for each column would make a method too long for the JVM to compile
    out = out.withColumn("__texts", F.transform(F.array(*[F.col(f"`{c}`") for c in text_cols]), strip_unicode))
    out = out.withColumns({c: F.get("__texts", F.lit(i)) for i, c in enumerate(text_cols)})
    return distinct_rows(out.drop("__texts"))

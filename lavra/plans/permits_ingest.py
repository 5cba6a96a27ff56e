"""Building permits: landed yearly grids → bronze → silver, reloading only what has to be.

A year's workbook lies in ``<landing>/ano=<year>/`` as Parquet files of its grid
(file, sheet, sheet_idx, row_idx, cells). A planned year is loaded if it is not
committed, if its landed files hold something else than when it was (by
hash), if it is the current year, if its bronze is gone, or if all are to be
overwritten. Each load replaces the year's folder of bronze, and the manifest
that says what bronze was made of becomes its next version after the write. A
year that can't be read is reported and stays pending; the others go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.manifest import CHANGED, MANIFEST_SCHEMA, file_manifest, manifest_diff
from ..sources.files import hadoop_path
from ..sources.snapshots import publish, read_snapshot
from . import permits

GRID_SCHEMA = "file string, sheet string, sheet_idx int, row_idx bigint, cells array<string>"
YEAR = r"/ano=(\d{4})/"


def committed_manifest(spark: SparkSession, lake: str) -> DataFrame:
    """The files that bronze was made of, by year."""
    try:
        return read_snapshot(spark, f"{lake}/_manifest")
    except FileNotFoundError:
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def _loaded_years(spark: SparkSession, lake: str) -> list[str]:
    """Years that bronze has a folder of."""
    fs, root = hadoop_path(spark, f"{lake}/bronze")
    names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(n.removeprefix("ano=") for n in names if n.startswith("ano="))


def plan(spark: SparkSession, landing: str, lake: str, years: list[int], as_of: int,
         overwrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """(key, status, reason to load or null) of every planned or committed year, and the manifest of what is landed."""
    committed = committed_manifest(spark, lake)
    present = file_manifest(spark, landing, F.nullif(F.regexp_extract("file", YEAR, 1), F.lit("")), "*.parquet", committed)
    planned = spark.createDataFrame([(str(y), True) for y in years], "key string, planned boolean")
    loaded = spark.createDataFrame([(y, True) for y in _loaded_years(spark, lake)], "key string, loaded boolean")
    known = committed.select("key", F.lit(True).alias("committed")).distinct()
    state = (planned.join(manifest_diff(committed, present), "key", "full_outer").join(loaded, "key", "left").join(known, "key", "left"))
    reason = (F.when(F.col("planned").isNull(), None).when(F.col("status").isNull() | (F.col("status") == "missing"), None)
              .when(F.lit(overwrite), "overwrite").when(F.col("committed").isNull(), "not committed")
              .when(F.col("status") == CHANGED, "changed").when(F.col("loaded").isNull(), "bronze gone")
              .when(F.col("key") == str(as_of), "current year"))
    return state.select("key", F.coalesce("status", F.lit("not landed")).alias("status"), reason.alias("reason")), present


def ingest(spark: SparkSession, landing: str, lake: str, years: list[int], as_of: int, overwrite: bool = False) -> DataFrame:
    """Loads what is pending; returns key, status, reason, error of every planned or committed year."""
    found, present = plan(spark, landing, lake, years, as_of, overwrite)
    rows = [r.asDict() for r in found.collect()]  # a row per year
    done, errors = [], {}
    for year in sorted(r["key"] for r in rows if r["reason"]):  # years are few and each is a write of its own
        try:
            (spark.read.schema(GRID_SCHEMA).parquet(f"{landing}/ano={year}")
             .write.mode("overwrite").parquet(f"{lake}/bronze/ano={year}"))
            done.append(year)
        except Exception as exc:  # isolate one bad year
            errors[year] = f"{type(exc).__name__}: {str(exc).splitlines()[0]}"
    if done:
        kept = committed_manifest(spark, lake).filter(~F.col("key").isin(done))
        publish(kept.unionByName(present.filter(F.col("key").isin(done))), f"{lake}/_manifest")
    if errors and not done:
        raise RuntimeError(f"no year readable: {errors}")
    return spark.createDataFrame([(r["key"], r["status"], r["reason"], errors.get(r["key"])) for r in rows],
                                 "key string, status string, reason string, error string")


def write_silver(spark: SparkSession, lake: str, ingest_date: str) -> DataFrame:
    """Rebuild silver from all of bronze as the table's next version; returns it."""
    grid = spark.read.schema(f"{GRID_SCHEMA}, ano string").parquet(f"{lake}/bronze")
    years = grid.select("file", "ano").distinct()
    publish(permits.silver(permits.records(grid.drop("ano"), years, ingest_date)), f"{lake}/silver")
    return read_snapshot(spark, f"{lake}/silver")

"""Investment announcements: registered CSV sources → silver per source.

Each source is read with its own delimiter and charset (windows-1252 via
ISO-8859-1 plus the 0x80–0x9F re-mapping), types inferred, column names
folded to ASCII snake case; unknown requested sources are reported and
skipped, and one unreadable source does not stop the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import config
from ..functions import rename_all, snake_ascii
from ..operators import select_sources, with_lineage
from ..sources import read_inferred, read_inferred_zip
from ..sources.snapshots import publish


def catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(config.INVESTMENT_SOURCES,
                                 "name string, kind string, sep string, charset string")


def selection(spark: SparkSession, requested: list[str]) -> DataFrame:
    req = spark.createDataFrame([(r,) for r in requested], "name string")
    return select_sources(req, catalog(spark).select("name"))


def silver_for(spark: SparkSession, name: str, path: str, ingest_date: str,
               charset: str | None = None, kind: str | None = None) -> DataFrame:
    """One registered source → silver; ``charset`` and ``kind`` override the catalog's (re-encoded or zipped landings)."""
    spec = {n: (k, s, c) for n, k, s, c in config.INVESTMENT_SOURCES}[name]
    catalog_kind, sep, catalog_charset = spec
    kind = kind or ("zip" if path.lower().endswith(".zip") else catalog_kind)
    if kind not in ("csv", "zip"):
        raise ValueError(f"unsupported source type: {kind}")
    read = read_inferred_zip if kind == "zip" else read_inferred
    df = rename_all(read(spark, path, sep=sep, charset=charset or catalog_charset), snake_ascii)
    return with_lineage(df, fonte=name, dt_ingestao=ingest_date)


def load_all(spark: SparkSession, paths: dict[str, str], ingest_date: str, lake: str) -> tuple[dict[str, str], dict[str, str]]:
    """Rebuild every readable source's silver table under ``lake``; (path per source, error per failed one).

    A source counts as read when its whole table was written; one that fails on
    any row is reported, keeps the silver it had (``read_snapshot``) and doesn't stop the others. All failed → error.
    """
    ok, failed = {}, {}
    for name, path in paths.items():  # a handful of registered sources
        try:
            publish(silver_for(spark, name, path, ingest_date), f"{lake}/silver/{name}")
            ok[name] = f"{lake}/silver/{name}"
        except Exception as exc:  # isolate one bad source
            failed[name] = f"{type(exc).__name__}: {exc}"
    if paths and not ok:
        raise RuntimeError(f"no source readable: {failed}")
    return ok, failed


__all__ = ["catalog", "selection", "silver_for", "load_all", "F"]

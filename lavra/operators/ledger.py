"""Incremental-load bookkeeping: a commit-after-write ledger and its rules.

The ledger is a versioned table of ``(pipeline, key, committed_at, version)``.
A commit adds a small file of keys whose data write already succeeded; every
``MERGE_AFTER`` of them are merged into one sorted, distinct base, so any number
of commits is read as a bounded number of files. Every commit is a version of the table, and
two writers can't make the same one: the later looks again at what has been
committed since. A reset (overwrite mode) notes the version up to which its
pipeline is forgotten; order never rests on clocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path
from ..sources.snapshots import VersionConflict, Versions, data_folder

LEDGER_SCHEMA = "pipeline string, key string, committed_at timestamp, version bigint"
MERGE_AFTER = 32  # files of keys beside the base
ATTEMPTS = 50


class KeyConflict(RuntimeError):
    """A key that was to be committed once has been committed by another writer."""


def _rows(versions: Versions, state: dict) -> DataFrame:
    """All rows that a ledger version names, but those that a reset hides.

    A commit's file holds no version, as it is written before its number is known; the state names it.
    """
    spark, folders = versions.spark, state.get("folders", [])
    if not folders:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(*[f"{versions.root}/{f}" for f in folders])
    numbers = F.create_map(*[F.lit(x) for pair in state["versions"].items() for x in pair]) if state["versions"] else None
    if numbers is not None:
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"(data-[0-9a-f]+)/[^/]*$", 1)
        rows = rows.withColumn("version", F.coalesce("version", F.try_element_at(numbers, folder)))
    for pipeline, upto in state.get("resets", {}).items():  # a few pipelines
        rows = rows.filter((F.col("pipeline") != pipeline) | (F.col("version") > upto))
    return rows


def _merged(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("pipeline", "key").agg(F.max("committed_at").alias("committed_at"), F.max("version").alias("version"))
            .select("pipeline", "key", "committed_at", "version"))


def read_ledger(spark: SparkSession, path: str, pipeline: str) -> DataFrame:
    """Committed keys of one pipeline since its last reset; none when absent."""
    versions = Versions(spark, path)
    rows = _rows(versions, versions.current()[1]).filter(F.col("pipeline") == pipeline)
    return rows.groupBy("key").agg(F.max("committed_at").alias("committed_at"))


def commit_keys(keys: DataFrame, path: str, pipeline: str, key_col: str = "key", once: bool = False) -> int:
    """Adds keys whose data is already written (call only after the write); returns the ledger's version.

    ``once``: KeyConflict, and nothing added, if another writer has any of them in the ledger.
    """
    spark = keys.sparkSession
    versions, own = Versions(spark, path), data_folder()
    (keys.select(F.lit(pipeline).alias("pipeline"), F.col(key_col).cast("string").alias("key"),
                 F.current_timestamp().alias("committed_at"), F.lit(None).cast("bigint").alias("version"))
     .write.parquet(f"{versions.root}/{own}"))
    new = spark.read.schema(LEDGER_SCHEMA).parquet(f"{versions.root}/{own}")
    for _ in range(ATTEMPTS):
        base, state = versions.current()
        if once:
            held = _rows(versions, state).select("pipeline", "key")
            taken = new.join(held, ["pipeline", "key"], "left_semi").select("key").limit(5).collect()
            if taken:
                raise KeyConflict(f"{pipeline}: {[r['key'] for r in taken]} committed before")
        folders, numbers = [*state.get("folders", []), own], {**state.get("versions", {}), own: base + 1}
        if len(folders) > MERGE_AFTER:
            merged = data_folder()
            _merged(_rows(versions, {**state, "folders": folders, "versions": numbers})).sortWithinPartitions(
                "pipeline", "key").write.parquet(f"{versions.root}/{merged}")
            folders, numbers = [merged], {}
        try:
            return versions.commit(base, {"folders": folders, "versions": numbers, "resets": state.get("resets", {})})
        except VersionConflict:
            continue
    raise VersionConflict(f"{path}: others committed {ATTEMPTS} times meanwhile")


def reset_ledger(spark: SparkSession, path: str, pipeline: str) -> int:
    """Overwrite mode: forget every key committed so far for this pipeline."""
    versions = Versions(spark, path)
    for _ in range(ATTEMPTS):
        base, state = versions.current()
        resets = {**state.get("resets", {}), pipeline: base + 1}
        try:
            return versions.commit(base, {"folders": state.get("folders", []), "versions": state.get("versions", {}), "resets": resets})
        except VersionConflict:
            continue
    raise VersionConflict(f"{path}: others committed {ATTEMPTS} times meanwhile")


def pending(planned: DataFrame, committed: DataFrame, key: str = "key") -> DataFrame:
    """Planned keys not yet committed (anti join; the ledger side is small)."""
    return planned.join(committed.select(key), key, "left_anti")


def pending_with_refresh(planned: DataFrame, committed: DataFrame, year: Column,
                         current_year: int, key: str = "key",
                         overwrite: bool = False) -> DataFrame:
    """Pending when not committed, or in the current (still growing) year, or overwrite."""
    if overwrite:
        return planned
    done = committed.select(key, F.lit(True).alias("__done")).dropDuplicates([key])
    return (planned.join(done, key, "left")
            .filter(F.col("__done").isNull() | (year == F.lit(current_year))).drop("__done"))


def stale_commits(committed: DataFrame, present: DataFrame, key: str = "key") -> DataFrame:
    """Committed keys whose landed data is gone: they must be loaded again."""
    return committed.select(key).join(present.select(key), key, "left_anti")


def number_rows(df: DataFrame, order: Sequence[str], name: str = "seq") -> DataFrame:
    """The rows with their number, from 1, in an order that should be total; no task sees them all.

    Rows are dealt into ranges of the order and numbered inside each; a range's
    first number follows from the sizes of those before it, one number per
    range. The ranges are stored, as another evaluation could cut them elsewhere.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "numbered")
    keys = [F.col(f"`{o}`") for o in order]
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
     .write.parquet(path))
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__at", T.LongType())])).parquet(path)
    part = F.shiftright("__at", 33)
    sizes = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per range
    before, upto = {}, 0
    for p in sorted(sizes):
        before[p], upto = upto, upto + sizes[p]
    if not before:
        return rows.drop("__at").withColumn(name, F.lit(None).cast("bigint"))
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), part)
    here = F.col("__at").bitwiseAND((1 << 33) - 1)
    return rows.withColumn(name, (offset + here + 1).cast("bigint")).drop("__at")


def batch_ids(periods: DataFrame, order: Sequence[str], size: int,
              non_empty: Column | None = None) -> DataFrame:
    """Number non-empty periods in order and close a write batch every ``size``."""
    kept = periods.filter(non_empty) if non_empty is not None else periods
    numbered = number_rows(kept, order).withColumn("seq", F.col("seq").cast("int"))
    return numbered.withColumn("batch_id", F.floor((F.col("seq") - 1) / F.lit(size)).cast("int"))


def contiguous_watermark(pages: DataFrame, section: str = "section",
                         start: str = "start_offset", end: str = "end_offset",
                         ok: str = "ok", batch_rows: int | None = None,
                         totals: DataFrame | None = None, resume: str | None = None) -> DataFrame:
    """Per section: the offset safe to resume from.

    Paging stops at the first failed page, so the watermark is the end of the
    last page before it — or the last closed write batch before it when
    ``batch_rows`` is given (a batch closes every ``batch_rows`` rows from the
    resume point, and at the section total). No failure → the last end.
    Two aggregations, no ordering window: safe when one section is most rows.
    """
    first_fail = (pages.groupBy(section)
                  .agg(F.min(F.when(~F.col(ok), F.col(start))).alias("__fail"), F.max(end).alias("__last")))
    joined = pages.join(first_fail, section)
    prefix = F.col(ok) & (F.col("__fail").isNull() | (F.col(start) < F.col("__fail")))
    closes = F.lit(True)
    if batch_rows:
        base = F.col(resume) if resume else F.lit(0)
        closes = ((F.col(end) - base) % F.lit(batch_rows)) == 0
        if totals is not None:
            joined = joined.join(totals, section, "left")
            closes = closes | (F.col(end) >= F.col("total"))
    return (joined.groupBy(section)
            .agg(F.coalesce(F.max(F.when(prefix & closes, F.col(end))), F.lit(0)).alias("watermark"),
                 F.max("__fail").alias("first_failed_offset"), F.max("__last").alias("last_offset")))


def latest_variant(df: DataFrame, group: str, value: str, rank: Sequence[str]) -> DataFrame:
    """Per group, the value with the greatest ``rank`` tuple (later wins ties)."""
    return df.groupBy(group).agg(
        F.max_by(F.col(value), F.struct(*[F.col(r) for r in rank])).alias(value))


def override_merge(fixed: DataFrame, recent: DataFrame, key: str, value: str) -> DataFrame:
    """``{**fixed, **recent}``: a recent value replaces the fixed one for its key."""
    f = fixed.select(F.col(key), F.col(value).alias("__fixed"))
    r = recent.select(F.col(key), F.col(value).alias("__recent"))
    return (f.join(r, key, "full_outer")
             .select(key, F.coalesce("__recent", "__fixed").alias(value),
                     F.when(F.col("__recent").isNotNull(), F.lit("recent"))
                      .otherwise(F.lit("fixed")).alias("origin")))


def select_sources(requested: DataFrame, catalog: DataFrame, name: str = "name") -> DataFrame:
    """Requested names split into ``selected`` (in the catalog) and ``unknown``."""
    known = catalog.select(name, F.lit("selected").alias("status")).dropDuplicates([name])
    return (requested.select(name).distinct().join(known, name, "left")
            .withColumn("status", F.coalesce("status", F.lit("unknown"))))


def outcome_status(n_events: Column, rows: Column, empty_is_failure: bool = False) -> Column:
    """A window/period outcome: any event fails it; zero rows fail only if asked."""
    status = F.when(n_events > 0, F.lit("failed"))
    if empty_is_failure:
        status = status.when(rows == 0, F.lit("failed"))
    return status.otherwise(F.lit("ok"))

"""Grouped summaries, coverage, diagnostics and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def grouped_report(df: DataFrame, keys: Sequence[str], count_col: str, sum_col: str,
                   count_name: str = "qtd", sum_name: str = "valor",
                   scale: float = 1.0, digits: int = 2, order: Sequence[Column] | None = None,
                   exact: bool = True, pre_counted: bool = False) -> DataFrame:
    """``GROUP BY keys``: non-null count of one column, rounded scaled sum of another.

    Rows with a null key are left out; an all-null sum is 0; rounding is
    half-even. With ``exact`` the sum runs in DECIMAL(38,6), so the answer
    does not depend on the order partial sums meet after the shuffle.
    Partial aggregation happens map-side, so a hot key costs one row per task.
    ``pre_counted``: the input was already aggregated below a join, so
    ``count_col`` holds counts to add up (eager aggregation).
    """
    if exact:
        total = F.coalesce(F.sum(F.col(sum_col).cast("decimal(38,6)")),
                           F.lit(0).cast("decimal(38,6)"))
    else:
        total = F.coalesce(F.sum(F.col(sum_col).cast("double")), F.lit(0.0))
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    out = (df.filter(not_null)
             .groupBy(*keys)
             .agg((F.coalesce(F.sum(count_col), F.lit(0)).cast("bigint") if pre_counted
                   else F.count(count_col)).alias(count_name),
                  F.bround(total.cast("double") / F.lit(float(scale)), digits).alias(sum_name)))
    return out.orderBy(*order) if order else out


def coverage(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Totals with / without a value and their percentages; null when empty."""
    total = F.count(F.lit(1))
    present = F.count(column)

    def pct(n: Column) -> Column:
        return F.when(total > 0, F.bround(n.cast("double") * 100.0 / total, digits))

    return df.agg(total.alias("total"),
                  present.alias("with_value"),
                  (total - present).alias("without_value"),
                  pct(present).alias("pct_with"),
                  pct(total - present).alias("pct_without"))


def window_diagnostics(outcomes: DataFrame, category: str = "category") -> DataFrame:
    """Per category: pending windows, skipped, with events, rows seen and kept.

    ``outcomes`` has ``category, skipped bool, n_events, rows_seen, rows_kept``.
    A window with an event counts as failed; its partial rows still count.
    """
    pending = ~F.col("skipped")
    return (outcomes.groupBy(category)
            .agg(F.count_if(pending).alias("windows"),
                 F.count_if(F.col("skipped")).alias("skipped"),
                 F.count_if(pending & (F.col("n_events") > 0)).alias("with_event"),
                 F.coalesce(F.sum(F.when(pending, F.col("rows_seen"))), F.lit(0)).alias("evaluated"),
                 F.coalesce(F.sum(F.when(pending, F.col("rows_kept"))), F.lit(0)).alias("found")))


def diagnosis(windows: Column | str = "windows", evaluated: Column | str = "evaluated",
              with_event: Column | str = "with_event") -> Column:
    """Label a category: nothing queried / maybe genuinely empty / calls failing / ok."""
    w, e, f = (F.col(x) if isinstance(x, str) else x for x in (windows, evaluated, with_event))
    return (F.when(w == 0, F.lit("nothing queried"))
             .when((e == 0) & (f == 0), F.lit("no rows and no events: check one window by hand"))
             .when((e == 0) & (f > 0), F.lit("every window failed: calls are failing"))
             .otherwise(F.lit("ok")))


def preview(df: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """The first ``n`` rows in ``order`` plus ``n_more``: how many were left out.

    The limit is the feature (a preview); Spark plans it as a per-task top-n
    (``TakeOrderedAndProject``), and the count is a separate global aggregate.
    """
    head = df.orderBy(*order).limit(n).withColumn("__one", F.lit(1))
    rest = df.agg(F.greatest(F.count(F.lit(1)) - F.lit(n), F.lit(0)).alias("n_more"))
    # the aggregate is exactly one row: an equi-join on a constant attaches it
    return head.join(F.broadcast(rest.withColumn("__one", F.lit(1))), "__one").drop("__one")

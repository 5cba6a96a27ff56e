"""Date-window planning: monthly, weekly and period keys for incremental loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _year(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("int")


def monthly_windows(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Each year → 12 windows ``(yyyyMM01, yyyyMM<last day>)``."""
    y = _year(year_col)
    starts = F.sequence(F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.lit(12), F.lit(1)),
                        F.expr("INTERVAL 1 MONTH"))
    d = F.col("__d")
    return (years.select(F.col(year_col).alias("year"), F.explode(starts).alias("__d"))
            .select("year",
                    F.date_format(d, "yyyyMMdd").alias("start"),
                    F.date_format(F.last_day(d), "yyyyMMdd").alias("end")))


def weekly_windows(years: DataFrame, year_col: str = "year") -> DataFrame:
    """7-day windows from 1 January; the last one is cut at 31 December (53 a year)."""
    y = _year(year_col)
    first, last = F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.lit(12), F.lit(31))
    d = F.col("__d")
    return (years.select(F.col(year_col).alias("year"),
                         F.explode(F.sequence(first, last, F.expr("INTERVAL 7 DAYS"))).alias("__d"),
                         last.alias("__last"))
            .select("year",
                    F.date_format(d, "yyyyMMdd").alias("start"),
                    F.date_format(F.least(F.date_add(d, 6), F.col("__last")), "yyyyMMdd").alias("end")))


def monthly_periods(years: DataFrame, year_col: str = "year",
                    url_template: str | None = None) -> DataFrame:
    """Each year → ``yyyy-MM`` period keys, optionally with a formatted URL."""
    y = _year(year_col)
    months = F.sequence(F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.lit(12), F.lit(1)),
                        F.expr("INTERVAL 1 MONTH"))
    out = years.select(F.col(year_col).alias("year"), F.explode(months).alias("__d")) \
               .withColumn("period", F.date_format("__d", "yyyy-MM"))
    if url_template:
        out = out.withColumn("url", F.format_string(url_template, F.col("period")))
    return out.drop("__d")


def window_key(category: Column | str, start: Column | str, end: Column | str) -> Column:
    """``category:start:end`` — the ledger key of one request window."""
    cs = [F.col(c) if isinstance(c, str) else c for c in (category, start, end)]
    return F.concat_ws(":", *[c.cast("string") for c in cs])


def window_plan(categories: DataFrame, years: DataFrame, year_col: str = "year") -> DataFrame:
    """Every category × the windows of its own granularity, keyed for the ledger.

    ``categories`` has ``category, granularity ('monthly'|'weekly'), name``.
    The window tables are derived per year; the join is on granularity.
    """
    monthly = monthly_windows(years, year_col).withColumn("granularity", F.lit("monthly"))
    weekly = weekly_windows(years, year_col).withColumn("granularity", F.lit("weekly"))
    plan = categories.join(monthly.unionByName(weekly), "granularity")
    return plan.withColumn("key", window_key("category", "start", "end"))

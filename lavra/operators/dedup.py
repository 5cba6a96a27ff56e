"""Deterministic keep-first deduplication and row-level distinct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order`` (nulls in a key compare equal).

    ``row_number() = 1`` is planned as a partial ``WindowGroupLimit`` before the
    shuffle and a final one after it, so a hot key is cut to one row per map
    task before it moves; the order must be total for a repeatable answer.
    """
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(
        *[F.col(o) if isinstance(o, str) else o for o in order])
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full-row set semantics over the given (default: all) columns."""
    return (df.select(*columns) if columns else df).distinct()

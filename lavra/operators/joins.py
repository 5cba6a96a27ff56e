"""Null-safe equi-joins; which side is broadcast is left to AQE's measured sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join where null keys match each other (``<=>``), keys kept once.

    Still a hash/sort-merge join on ``(coalesce(k, …), isnull(k))``; no
    broadcast hint — AQE switches to a broadcast from measured sizes only.
    """
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])

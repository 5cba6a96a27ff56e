"""Polygon helpers on ESRI ``rings`` (array<array<array<double>>>, [lon, lat])."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col


def _ring_mean(ring: Column, axis: int) -> Column:
    total = F.aggregate(ring, F.lit(0.0), lambda acc, pt: acc + F.get(pt, axis).cast("double"))
    return F.try_divide(total, F.size(ring).cast("double"))


def first_ring_centroid(rings: Column | str, digits: int = 6) -> tuple[Column, Column]:
    """(lat, lon): vertex mean of the first ring, rounded half-even.

    A closed ring counts its closing vertex twice, as the source does; no
    ring or an empty first ring gives nulls (``get`` and ``try_divide``
    keep ANSI mode from raising).
    """
    ring = F.get(_col(rings), 0)
    lat = F.bround(_ring_mean(ring, 1), digits)
    lon = F.bround(_ring_mean(ring, 0), digits)
    return lat, lon

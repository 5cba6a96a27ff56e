"""Lenient text → timestamp parsing (results are TIMESTAMP_NTZ wall-clock)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col, strip_unicode

ISO_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
ISO_OFFSET = r"^(\S+[T ]\d{1,2}:[\d:.]+)(?:[Zz]|[+-]\d{2}:?\d{2})$"


def _ntz(ts: Column) -> Column:
    # parsed in the session zone and read back in it: the wall clock is kept
    return ts.cast("timestamp_ntz")


def _try_parse(c: Column, fmt: str | None = None) -> Column:
    return _ntz(F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c))


def parse_iso(c: Column | str) -> Column:
    """ISO-8601 date or date-time; anything else (``2024`` alone too) → null.

    A zone offset is accepted and the wall clock kept: ``…T10:00:00-03:00`` is 10:00.
    """
    c = F.regexp_replace(strip_unicode(_col(c).cast("string")), ISO_OFFSET, "$1")
    return F.when(c.rlike(ISO_TEXT), _try_parse(c))


def parse_dayfirst(c: Column | str) -> Column:
    """Day-first ``d/M/yyyy`` with optional time, else ISO; invalid → null."""
    c = strip_unicode(_col(c).cast("string"))
    return F.coalesce(
        _try_parse(c, "d/M/yyyy"),
        _try_parse(c, "d/M/yyyy H:mm:ss"),
        _try_parse(c, "d/M/yyyy H:mm"),
        parse_iso(c),
    )


def parse_two_formats(c: Column | str) -> Column:
    """``d/M/yyyy`` first, then ``d/M/yy`` for what is left.

    Two-digit years pivot at 69: ``68`` → 2068, ``69`` → 1969, ``99`` → 1999.
    """
    c = strip_unicode(_col(c).cast("string"))
    four = F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), _try_parse(c, "d/M/yyyy"))
    two = F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), _try_parse(c, "d/M/yy"))
    two = F.when(F.year(two) >= 2069, two - F.expr("INTERVAL 100 YEARS")).otherwise(two)
    return F.coalesce(four, two)

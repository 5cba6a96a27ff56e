"""Lenient number parsing with the Brazilian separators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col

# A plain decimal number, optionally signed, with optional exponent, spaces
# around allowed. ``try_cast`` alone would also take ``12d``/``12f`` and ``nan``.
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_double(c: Column | str) -> Column:
    """Text → double, null when the text is not a plain number."""
    c = _col(c).cast("string")
    return F.when(c.rlike(NUMBER_TEXT), F.trim(c).try_cast("double"))


def br_money(c: Column | str) -> Column:
    """``1.234,56`` → 1234.56: drop every ``.``, then ``,`` → ``.``.

    ``1234.56`` therefore reads as 123456, as the source rule does.
    """
    c = _col(c).cast("string")
    return to_double(F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def br_quantity(c: Column | str) -> Column:
    """Quantities only swap the decimal comma: ``2,5`` → 2.5, ``1.234,5`` → null."""
    c = _col(c).cast("string")
    return to_double(F.replace(c, F.lit(","), F.lit(".")))


def nullable_int(c: Column | str) -> Column:
    """Numeric text → bigint when integral (``7.0`` → 7), else null; whole digits stay exact."""
    text = _col(c).cast("string")
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)(?:\.0*)?\s*$", 1)
    d = to_double(text)
    return F.when(digits != "", digits.try_cast("bigint")).when(d == F.floor(d), d.try_cast("bigint"))

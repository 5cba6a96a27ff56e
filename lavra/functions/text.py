"""Text cleaning as Column → Column expressions (all JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

from ..config import CP1252_C1_SOURCE, CP1252_C1_TARGET, NA_TOKENS

# Characters Python's str.isspace() accepts (Unicode White_Space plus the
# ASCII information separators 0x1C–0x1F), built by rule rather than listed.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_unicode(c: Column | str) -> Column:
    """Strip leading/trailing whitespace of every kind (tab, NBSP, …).

    ``F.trim`` only removes the ASCII space; ``btrim`` with the explicit
    whitespace set is a plain scan from both ends (no regex).
    """
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """True for null or whitespace-only text."""
    c = _col(c)
    return c.isNull() | (strip_unicode(c) == F.lit(""))


def concat_skip_blank(sep: str, *cols: Column | str) -> Column:
    """Join the parts that are neither null nor blank; nothing left → null."""
    parts = F.array(*[_col(c).cast("string") for c in cols])
    kept = F.filter(parts, lambda x: ~is_blank(x))
    return F.nullif(F.concat_ws(sep, kept), F.lit(""))


def na_tokens_to_null(c: Column | str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Turn the delimited-text missing-value tokens into null."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def cp1252_from_latin1(c: Column | str) -> Column:
    """Re-map text decoded as ISO-8859-1 to what windows-1252 decoding gives.

    The two charsets differ only on bytes 0x80–0x9F; undefined ones become U+FFFD.
    """
    return F.translate(_col(c), CP1252_C1_SOURCE, CP1252_C1_TARGET)


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    """Whether a text holds any of the terms, as plain byte searches."""
    found = [text.contains(F.lit(t)) for t in terms]
    return reduce(lambda a, b: a | b, found) if found else F.lit(False)


def lower_contains_any(c: Column | str, terms: Iterable[str]) -> Column:
    """Plain-substring keyword test on lower-cased text; null reads as ''.

    The text is the one element of an array, so the (possibly costly)
    expression is evaluated once for all terms, also inside a filter, where
    Spark does not share subexpressions.
    """
    terms = list(dict.fromkeys(terms))
    low = F.lower(F.coalesce(_col(c), F.lit("")))
    return F.exists(F.array(low), lambda t: contains_any(t, terms))


def extract_optional_int(c: Column | str, pattern: str, group: int, default: int = 0) -> Column:
    """Regex capture of an optional numeric group; absent group → ``default``."""
    raw = F.regexp_extract(_col(c), pattern, group)
    return F.coalesce(F.nullif(raw, F.lit("")).try_cast("int"), F.lit(default))

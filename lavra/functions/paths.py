"""Path and URL pieces as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col


def url_basename(c: Column | str) -> Column:
    """Last path segment without query/fragment, percent-decoded."""
    return F.try_url_decode(F.regexp_extract(_col(c), r"([^/?#]+)(?:[?#].*)?$", 1))


def extension(c: Column | str) -> Column:
    """Lower-cased extension after the last dot ('' when none)."""
    return F.lower(F.regexp_extract(_col(c), r"\.([^./]+)$", 1))


def url_host(c: Column | str) -> Column:
    """``scheme://host`` prefix of an absolute URL."""
    return F.regexp_extract(_col(c), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)

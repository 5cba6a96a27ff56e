"""Anchor links out of raw HTML, without a DOM parser."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# a value in either kind of quotes, or bare; an attribute name follows white space
ANCHOR_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]+)"|'([^']+)'|([^\s"'>]+))"""


def extract_links(df: DataFrame, html: str, base: Column | str, keep: Sequence[str] = (),
                  fragment: str | None = None) -> DataFrame:
    """One row per ``<a href="…">`` in document order.

    Links containing ``fragment`` are kept (all when None); a root-relative
    link (``/x``) is prefixed with ``base`` (a host column or literal).
    """
    base_col = F.col(base) if isinstance(base, str) and base in df.columns else (
        base if isinstance(base, Column) else F.lit(base))
    hrefs = F.transform(
        F.arrays_zip(*[F.regexp_extract_all(F.col(html), F.lit(ANCHOR_HREF), g).alias(f"g{g}") for g in (1, 2, 3)]),
        lambda m: F.concat(F.coalesce(m["g1"], F.lit("")), F.coalesce(m["g2"], F.lit("")),
                           F.coalesce(m["g3"], F.lit(""))))
    out = df.select(*keep, base_col.alias("__base"), F.posexplode(hrefs).alias("link_pos", "href"))
    if fragment:
        out = out.filter(F.contains(F.col("href"), F.lit(fragment)))
    absolute = F.when(F.startswith(F.col("href"), F.lit("/")),
                      F.concat(F.col("__base"), F.col("href"))).otherwise(F.col("href"))
    return out.select(*keep, "link_pos", absolute.alias("href"))

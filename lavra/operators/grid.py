"""Spreadsheet grids: pick the sheet, find the header row, turn rows into records.

Input is a *grid table* ``(file, sheet, sheet_idx, row_idx, cells array<string>)``
— one row per sheet row, as landed from workbooks. The workbook codec itself
is outside Spark; everything after it is here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import dedupe_names, snake_keep_accents
from ..functions.text import na_tokens_to_null, strip_unicode
from ..session import scratch_path


def pick_sheet(grid: DataFrame) -> DataFrame:
    """Per file, the sheet with the most rows; a tie keeps the earlier sheet.

    Two aggregations (rows per sheet, then ``max_by`` per file), no window.
    """
    counts = grid.groupBy("file", "sheet_idx", "sheet").agg(F.count(F.lit(1)).alias("n_rows"))
    best = counts.groupBy("file").agg(
        F.max_by(F.struct("sheet_idx", "sheet", "n_rows"),
                 F.struct(F.col("n_rows"), -F.col("sheet_idx"))).alias("__b"))
    return best.select("file", "__b.sheet_idx", "__b.sheet", "__b.n_rows")


def normalized_cells(cells: Column) -> Column:
    """Distinct-ready cell values: non-null, trimmed (any whitespace), lower-cased."""
    return F.transform(F.filter(cells, lambda x: x.isNotNull()), lambda x: F.lower(strip_unicode(x)))


def header_hits(cells: Column, words: Sequence[str]) -> Column:
    """How many distinct header words the row holds (set intersection size)."""
    return F.size(F.array_intersect(normalized_cells(cells), F.array(*[F.lit(w) for w in words])))


def header_rows(grid: DataFrame, words: Sequence[str], min_hits: int = 2) -> DataFrame:
    """Per file, the first row holding ≥ ``min_hits`` header words, else row 0."""
    hit = header_hits(F.col("cells"), words) >= min_hits
    return grid.groupBy("file").agg(
        F.coalesce(F.min(F.when(hit, F.col("row_idx"))), F.lit(0)).alias("header_row"))


def sheet_headers(grid: DataFrame, words: Sequence[str], min_hits: int = 2) -> DataFrame:
    """Per file its chosen sheet and header: file, sheet_idx, n_rows, header_row, header.

    One aggregation per sheet (rows, first row with ``min_hits`` header words, row 0),
    one per file; see ``pick_sheet`` and ``header_rows`` for the rules.
    """
    at = F.col("row_idx")
    hit = F.when(header_hits(F.col("cells"), words) >= min_hits, at)
    sheets = grid.groupBy("file", "sheet_idx").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(hit).alias("hit"), F.min_by("cells", hit).alias("hit_cells"),
        F.min_by("cells", F.when(at == 0, at)).alias("top_cells"))
    best = sheets.groupBy("file").agg(F.max_by(
        F.struct("sheet_idx", "n_rows", "hit", "hit_cells", "top_cells"),
        F.struct(F.col("n_rows"), -F.col("sheet_idx"))).alias("b"))
    found = F.col("b.hit").isNotNull()
    return best.select("file", "b.sheet_idx", "b.n_rows", F.coalesce("b.hit", F.lit(0)).alias("header_row"),
                       F.when(found, F.col("b.hit_cells")).otherwise(F.col("b.top_cells")).alias("header"))


def layout_positions(header: Sequence[str | None], normalize: Callable[[str], str]) -> list[tuple[str, int]]:
    """Final names of the named columns of one header, with their cell numbers."""
    raw = [f"Unnamed: {i}" if h is None else str(h) for i, h in enumerate(header)]
    mangled = dedupe_names(raw)
    kept = [(i, n) for i, n in enumerate(mangled) if not n.startswith("Unnamed")]
    final = dedupe_names([normalize(n) for _, n in kept])
    return [(name, i) for (i, _), name in zip(kept, final)]


def apply_header(grid: DataFrame, headers: DataFrame,
                 normalize: Callable[[str], str] = snake_keep_accents,
                 keep: Sequence[str] = ("file",), columns: Sequence[str] | None = None) -> DataFrame:
    """Rows below each file's header row become records named by that row.

    ``headers`` has ``file, header_row`` (and ``sheet_idx`` when ``grid`` still
    holds several sheets per file), with or without the ``header`` cells. Each
    file's name → cell number map is joined to its rows, so any number of
    layouts takes one lookup per column. ``columns`` are the names wanted; None
    takes every name that some file has (then those names, the output's schema,
    are read first). NA tokens and blank cells are null; all-null rows are
    dropped; blank header cells give no column.
    """
    keys = ["file"] + (["sheet_idx"] if "sheet_idx" in headers.columns else [])
    if "header" not in headers.columns:
        headers = (grid.join(headers, keys).filter(F.col("row_idx") == F.col("header_row"))
                   .select(*keys, "header_row", F.col("cells").alias("header")))

    def positions(batches):
        for pdf in batches:
            pdf["__pos"] = [layout_positions([h if h else None for h in x], normalize) for x in pdf["header"]]
            yield pdf.drop(columns="header")

    schema = ", ".join(f"{k} {headers.schema[k].dataType.simpleString()}" for k in [*keys, "header_row"])
    named = (headers.select(*keys, "header_row", "header")
             .mapInPandas(positions, f"{schema}, __pos array<struct<name:string,at:int>>")
             .withColumn("__pos", F.map_from_entries("__pos")))
    if columns is None:
        path = scratch_path(grid.sparkSession, "grid_headers")
        named.write.mode("overwrite").parquet(path)
        named = grid.sparkSession.read.parquet(path)
        seen = named.select(*keys, F.posexplode(F.map_entries("__pos")).alias("i", "e")).groupBy("e.key").agg(
            F.min(F.struct(*keys, "e.value")).alias("first")).orderBy("first").select("key").collect()
        columns = [r["key"] for r in seen]
    clean = F.transform("cells", lambda x: na_tokens_to_null(x))
    body = (grid.select(*dict.fromkeys([*keys, *keep, "row_idx"]), clean.alias("cells")).join(named, keys)
            .filter((F.col("row_idx") > F.col("header_row")) & F.exists("cells", lambda x: x.isNotNull())))
    return body.select(*[F.col(k) for k in keep], F.col("row_idx"),
                       *[F.get("cells", F.element_at("__pos", F.lit(c))).alias(c) for c in columns])

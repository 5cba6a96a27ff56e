"""Delimited text with the strict bad-line policy and windows-1252 text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numbers import to_double
from ..functions.text import cp1252_from_latin1, na_tokens_to_null

_LINE = "__line"
_RAW = "__raw_line"


# put after a record's last field: the parser reads a blank field and a missing one alike,
# but this mark shows in the first columns only if the record has no field too many
_END = "\u0002"


def _options(sep: str) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnPruning": "false"}


def _marked(raw: Column, columns: Sequence[str], sep: str) -> Column:
    """A record's text → struct of its fields, one column more than asked for, the end marked."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, "__more"])
    return F.from_csv(F.concat(raw, F.lit(sep + _END)), schema, _options(sep))


def _fits(record: Column, columns: Sequence[str]) -> Column:
    return F.array_contains(F.array(*[F.coalesce(record[c], F.lit("")) for c in [*columns, "__more"]]), _END)


def _cell(c: Column, na_tokens: bool) -> Column:
    c = F.when(c != _END, c)
    return na_tokens_to_null(c) if na_tokens else c


def _cells(raw: Column, columns: Sequence[str], sep: str, cell: Callable[[Column], Column]) -> Column:
    """A record's text → array of its cells; null with a field too many.

    The parsed record is a lambda's variable, so each text is parsed once. Tested in a filter, its fields
    would become columns of the plan, and the optimizer would derive a condition for every set of them.
    """
    return F.get(F.transform(F.array(_marked(raw, columns, sep)), lambda r: F.when(
        _fits(r, columns), F.array(*[cell(r[c]) for c in columns]))), F.lit(0))


def _spread(rows: DataFrame, others: Sequence[Column], cells: Column, columns: Sequence[str]) -> DataFrame:
    """The other columns and the array's cells as columns; rows without an array are left out."""
    # explode(array(x)) is a generator the optimizer will not fold into the accesses to the cells
    kept = rows.select(*others, F.explode(F.array(cells)).alias("__cells")).filter(F.col("__cells").isNotNull())
    return kept.select(*others, *[F.get("__cells", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def parse_delimited_lines(lines: DataFrame, columns: Sequence[str], sep: str = ";",
                          line_col: str = "line", na_tokens: bool = True) -> DataFrame:
    """Text lines → all-text columns with the spreadsheet-tool bad-line policy.

    A line with more fields than ``columns`` is dropped, also if the fields too
    many are blank; a shorter one is padded with nulls. Each line is parsed
    once. Every other column of ``lines`` passes through.
    """
    others = [F.col(f"`{c}`") for c in lines.columns if c != line_col]
    return _spread(lines, others, _cells(F.col(line_col), columns, sep, lambda c: _cell(c, na_tokens)), columns)


def read_lines(spark: SparkSession, path: str | Sequence[str], charset: str = "ISO-8859-1",
               header: bool = False, line_col: str = "line") -> DataFrame:
    """The physical lines of text files, decoded with ``charset``.

    A one-column CSV read with separator and quote switched off: every line is
    one well-formed record (blank lines skipped, the first line of each file
    dropped when ``header``). A line holding the switched-off separator (NUL)
    is recovered whole from the corrupt-record column. ``charset='windows-1252'``
    reads ISO-8859-1 and re-maps 0x80–0x9F. Partition columns of the folder
    layout (e.g. ``period=2023-03``) pass through.
    """
    spark_charset = "ISO-8859-1" if charset.lower() in ("windows-1252", "cp1252") else charset
    raw = (spark.read.schema(f"{_LINE} string, {_RAW} string")
           .option("sep", "\u0000").option("quote", "\u0000").option("header", str(header).lower())
           .option("encoding", spark_charset).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _RAW).csv(path))
    line = F.coalesce(F.col(_RAW), F.col(_LINE))
    if spark_charset != charset:
        line = cp1252_from_latin1(line)
    extra = [F.col(f"`{c}`") for c in raw.columns if c not in (_LINE, _RAW)]
    return raw.select(*extra, line.alias(line_col))


def read_delimited(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
                   sep: str = ";", charset: str = "ISO-8859-1", header: bool = True,
                   na_tokens: bool = True, quoted_newlines: bool = True) -> DataFrame:
    """All-text delimited read with the strict bad-line policy (see ``parse_delimited_lines``).

    A quoted field may hold line breaks, so a file is read from its start by one task;
    ``quoted_newlines=False`` lets Spark split files known to hold none.
    """
    spark_charset = "ISO-8859-1" if charset.lower() in ("windows-1252", "cp1252") else charset
    schema = ", ".join(f"`{c}` string" for c in [*columns, _RAW])
    raw = (spark.read.schema(schema).options(**_options(sep)).option("columnNameOfCorruptRecord", _RAW)
           .option("header", str(header).lower()).option("enforceSchema", "true").option("encoding", spark_charset)
           .option("multiLine", str(quoted_newlines).lower()).csv(path))
    others = [F.col(f"`{c}`") for c in raw.columns if c not in (*columns, _RAW)]

    def text(c: Column) -> Column:
        return c if spark_charset == charset else cp1252_from_latin1(c)

    def cell(c: Column) -> Column:
        return _cell(text(c), na_tokens)

    # only records with another number of fields are looked at again
    own = F.transform(F.array(*[F.col(f"`{c}`") for c in columns]), cell)
    again = _cells(F.col(_RAW), columns, sep, cell)
    return _spread(raw, others, F.when(F.col(_RAW).isNull(), own).otherwise(again), columns)


_WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
_TRUTH = r"^(?:True|False|TRUE|FALSE|true|false)$"


def read_inferred(spark: SparkSession, path: str | Sequence[str], sep: str = ";",
                  charset: str = "UTF-8") -> DataFrame:
    """Header + inferred types over the strict read: long lines dropped, short ones padded.

    Names come from the header; one aggregation over the text columns finds those whose every
    value is a whole number, a number or a truth value (missing ones aside); others stay text.
    """
    spark_charset = "ISO-8859-1" if charset.lower() in ("windows-1252", "cp1252") else charset
    head = (spark.read.option("sep", sep).option("header", "true").option("quote", '"').option("escape", '"')
            .option("encoding", spark_charset).option("multiLine", "true").csv(path))
    names = [cp1252_name(c) if spark_charset != charset else c for c in head.columns]
    text = read_delimited(spark, path, names, sep=sep, charset=charset)
    return with_inferred_types(text, names)


def with_inferred_types(text: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text columns of which every value is a whole number, a number or a truth value, as such (missing ones aside)."""
    cols = [F.col(f"`{c}`") for c in names]
    counts = text.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"n{i}"), F.count_if(c.rlike(_WHOLE)).alias(f"i{i}"),
        F.count(to_double(c)).alias(f"d{i}"), F.count_if(c.rlike(_TRUTH)).alias(f"b{i}"))]).first()
    out = []
    for i, (c, name) in enumerate(zip(cols, names)):
        n = counts[f"n{i}"]
        kind = next((k for k, key in (("bigint", "i"), ("double", "d"), ("boolean", "b")) if n and counts[f"{key}{i}"] == n),
                    None)
        out.append((F.trim(c).cast(kind) if kind else c).alias(name))
    return text.select(*[F.col(f"`{c}`") for c in text.columns if c not in names], *out)


def cp1252_name(name: str) -> str:
    """Header names pass through the same byte re-mapping as the values."""
    src = "".join(chr(c) for c in range(0x80, 0xA0))
    if not any(ch in src for ch in name):
        return name
    return name.encode("latin-1").decode("cp1252", errors="replace")

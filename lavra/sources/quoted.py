"""Delimited files with line breaks inside quotes, read by all cores.

Whether a line break ends a record depends on all quotes before it, so a plain
multi-line read gives each file to one task. Here files are split as text lines,
and each line says what it does to the reader's state: whether it ends inside a
quoted field if it began outside of one, and if it began inside. Such functions
compose, so

1. every split reports its own, one row per split;
2. a running composition over each file's splits gives the state that each
   split begins in;
3. every split then puts its lines together to records from its own first record
   edge. What crosses an edge of splits leaves as pieces, which are joined by
   file: one record at a time, however many splits it spans.

Where no line ends inside quotes (most files), one scan shows it and Spark's own
reader does the rest. In others Python puts the records together, in one scan for
the states and one for the records, and another only if some record crosses a
split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import cp1252_from_latin1
from .delimited import parse_delimited_lines, read_delimited

_OWN = ("__file", "__block", "__line", "__out", "__in")
_WHOLE, _OPENS, _THROUGH, _ENDS = range(4)


def quote_patterns(sep: str) -> tuple[str, str]:
    """Regexes of lines that end inside quotes, if they begin outside and inside of them."""
    s = re.escape(sep)
    quoted = '[^"]*+(?:""[^"]*+)*+'
    field = f'(?:"{quoted}"[^{s}]*+|[^"{s}][^{s}]*+|(?={s}|\\z))'
    return (f'\\A(?:{field}{s})*+"{quoted}\\z',
            f'\\A{quoted}(?:\\z|"[^{s}]*+(?:{s}{field})*+{s}"{quoted}\\z)')


def _quote_lines(spark: SparkSession, path: str | Sequence[str], sep: str, charset: str) -> DataFrame:
    """Physical lines with their split (file and offset) and what they do to the state; folder columns pass through."""
    raw = spark.read.option("lineSep", "\n").text(path)
    extra = [F.col(f"`{c}`") for c in raw.columns if c != "value"]
    cp1252 = charset.lower() in ("windows-1252", "cp1252")
    line: Column = F.col("value")
    if charset.upper() == "UTF-8":
        line = F.make_valid_utf8(line)
    else:
        line = F.decode(line.cast("binary"), "ISO-8859-1" if cp1252 else charset)
    line = cp1252_from_latin1(line) if cp1252 else line
    lines = raw.select(*extra, F.col("_metadata.file_path").alias("__file"),
                       F.col("_metadata.file_block_start").alias("__block"), line.alias("__line"))
    line = F.col("__line")
    outside, inside = quote_patterns(sep)
    quotes = line.contains('"')
    return lines.select("*", (quotes & line.rlike(outside)).alias("__out"), (~quotes | line.rlike(inside)).alias("__in"))


def _states(out: np.ndarray, inn: np.ndarray, before: int) -> np.ndarray:
    """State after each line: 1 inside quotes."""
    flips = np.cumsum(out & ~inn) & 1
    last = np.maximum.accumulate(np.where(out == inn, np.arange(len(out)), -1))  # the last line that sets the state
    return np.where(last >= 0, out[last] ^ flips[last], before) ^ flips


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches cut where the split changes, each with its split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = {n: batch.schema.get_field_index(n) for n in ("__file", "__block")}
        block = batch.column(at["__block"]).to_numpy()
        file = batch.column(at["__file"]).dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
        for i, j in zip([0, *edges], [*edges, len(block)], strict=True):
            yield (batch.column(at["__file"])[i].as_py(), int(block[i])), batch.slice(i, j - i)


def _flags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("__out", "__in"))


def _split_functions(lines: DataFrame) -> DataFrame:
    """__file, __block, from_out, from_in: the state at each split's end, from both states at its start."""

    def run(batches):
        now, found = None, [0, 1]

        def row():
            return pa.RecordBatch.from_pylist([{"__file": now[0], "__block": now[1], "from_out": found[0], "from_in": found[1]}])

        for split, batch in _runs(batches):
            if split != now:
                if now:
                    yield row()
                now, found = split, [0, 1]
            found = [int(_states(*_flags(batch), s)[-1]) for s in found]
        if now:
            yield row()

    return lines.select("__file", "__block", "__out", "__in").mapInArrow(
        run, "__file string, __block long, from_out long, from_in long")


def _begin_inside(lines: DataFrame) -> tuple[set[tuple[str, int]], bool]:
    """The splits that begin inside quotes, and whether any ends inside.

    A path and an offset for some of the splits that the driver has listed to
    plan the scan anyway, so the set is smaller than what it already holds.
    """
    order = Window.partitionBy("__file").orderBy("__block")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = F.sum(F.when(F.expr("from_out > from_in"), 1).otherwise(0)).over(upto) % 2
    sets = F.last(F.when(F.expr("from_out = from_in"), (F.col("from_out") + F.col("flips")) % 2), ignorenulls=True).over(upto)
    after = _split_functions(lines).withColumn("flips", flips).withColumn("sets", sets).select(
        "__file", "__block", ((F.coalesce("sets", F.lit(0)) + F.col("flips")) % 2).alias("state"))
    found = after.withColumn("start", F.lag("state", 1, 0).over(order)).filter("state = 1 or start = 1")
    found = found.select("__file", "__block", "start", "state").collect()
    return {(r["__file"], r["__block"]) for r in found if r["start"]}, any(r["state"] for r in found)


class _Records:
    """Lines of a split put together to records; what crosses its edges as pieces."""

    def __init__(self, pieces: bool):
        self.pieces = pieces  # only what crosses an edge, or only whole records
        self.out: list[tuple] = []
        self.begin(False)

    def begin(self, inside: bool) -> None:
        self.state, self.held, self.began, self.first = int(inside), [], not inside, True

    def emit(self, kind: int, at: int, head: bool, lines: list[str]) -> None:
        if (kind == _WHOLE) != self.pieces:
            self.out.append((kind, at, head, "\n".join(lines)))

    def add(self, lines: list[str], flags: tuple[np.ndarray, np.ndarray], at_start: bool) -> None:
        """(kind, row that lends its folder columns, whether it is the file's first record, text) to out."""
        after = _states(*flags, self.state)
        before = np.concatenate([[self.state], after[:-1]])
        starts = np.flatnonzero(before == 0)
        first = int(starts[0]) if len(starts) else len(lines)
        if first:  # the rest of an open record
            self.held += lines[:first]
            if after[first - 1] == 0:
                self.emit(_WHOLE if self.began else _ENDS, 0, self.began and at_start and self.first, self.held)
                self.held, self.began, self.first = [], True, False
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(lines)], strict=False):
            if j == len(lines) and after[-1]:
                self.held, self.began = lines[i:], True
                self.first = self.first and i == 0
            else:
                self.emit(_WHOLE, i, at_start and self.first and i == 0, lines[i:j])
        if len(starts) and (len(starts) > 1 or not after[-1]):
            self.first = False
        self.state = int(after[-1])

    def end(self, at_start: bool) -> None:
        """The split's end: a record that is still open goes on in the next one."""
        if self.held:
            self.emit(_OPENS if self.began else _THROUGH, 0, self.began and at_start and self.first, self.held)


def _records(lines: DataFrame, inside: set[tuple[str, int]], pieces: bool) -> DataFrame:
    """The folder columns, __file, __block, __kind, __head, __line of whole records, or of pieces of others."""
    extra = [c for c in lines.columns if c not in _OWN]

    def run(batches):
        now, last, records = None, None, _Records(pieces)

        def rows(batch):
            if records.out:
                kind, at, head, text = zip(*records.out, strict=True)
                records.out = []
                own = batch.take(pa.array(at))
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [*[own.column(own.schema.get_field_index(c)) for c in extra], pa.array([now[0]] * n), pa.array([now[1]] * n, pa.int64()),
                     pa.array(kind, pa.int32()), pa.array(head, pa.bool_()), pa.array(text, pa.string())],
                    [*extra, "__file", "__block", "__kind", "__head", "__line"])

        for split, batch in _runs(batches):
            if split != now:
                if now:
                    records.end(now[1] == 0)
                    yield from rows(last)
                now = split
                records.begin(split in inside)
            records.add(batch.column(batch.schema.get_field_index("__line")).to_pylist(), _flags(batch), split[1] == 0)
            yield from rows(batch)
            last = batch
        if now:
            records.end(now[1] == 0)
            yield from rows(last)

    kinds = "".join(f"`{c}` {lines.schema[c].dataType.simpleString()}, " for c in extra)
    return lines.mapInArrow(run, kinds + "__file string, __block long, __kind int, __head boolean, __line string")


def quoted_records(spark: SparkSession, path: str | Sequence[str], sep: str = ";", charset: str = "ISO-8859-1",
                   header: bool = True, line_col: str = "line") -> DataFrame:
    """One row per record of delimited files: its text, line breaks in quotes and all, and the folder columns.

    A quote opens a field only as its first character; doubled quotes inside are
    text, and so are line breaks of either kind; empty lines outside of quotes are
    no records. A record that is still open at a file's end
    ends there. ``header`` leaves out each file's first record.
    """
    lines = _quote_lines(spark, path, sep, charset)
    if not header and not _any_open(lines):
        return _texts(lines.drop(*[c for c in _OWN if c != "__line"]), line_col)
    return _texts(_joined(lines, header), line_col)


def _any_open(lines: DataFrame) -> bool:
    """Whether a line ends inside quotes: a file begins outside of them, so where none does from there, none does."""
    return bool(lines.agg(F.bool_or("__out").alias("opens")).first()["opens"])


def _joined(lines: DataFrame, header: bool) -> DataFrame:
    """The folder columns and __line of every record, put together from lines."""
    extra = [F.col(f"`{c}`") for c in lines.columns if c not in _OWN]
    inside, open_ends = _begin_inside(lines)
    rows = _records(lines, inside, pieces=False)
    rows = rows.select(*extra, "__head", "__line")
    # a record that opens in the last split has no split behind it; those before are followed by what they open
    upto = Window.partitionBy("__file").orderBy("__block", "__order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not open_ends:  # no record crosses a split
        return (rows.filter(~F.col("__head")) if header else rows).drop("__head")
    pieces = _records(lines, inside, pieces=True).withColumn("__order", (F.col("__kind") == _OPENS).cast("int"))
    pieces = pieces.withColumn("__owner", F.last(F.when(F.col("__kind") == _OPENS, F.col("__block")), ignorenulls=True).over(upto))
    joined = pieces.groupBy(*extra, "__file", "__owner").agg(
        F.max("__head").alias("__head"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__block", "__line"))), lambda p: p["__line"]), "\n").alias("__line"))
    rows = rows.unionByName(joined.select(*extra, "__head", "__line"))
    return (rows.filter(~F.col("__head")) if header else rows).drop("__head")


def _texts(rows: DataFrame, line_col: str) -> DataFrame:
    """Records without the carriage return before their end, and without empty ones."""
    line = F.col("__line")
    line = F.when(line.endswith("\r"), F.left(line, F.length(line) - 1)).otherwise(line)
    return rows.withColumn("__line", line).filter(F.col("__line") != "").withColumnRenamed("__line", line_col)


def read_quoted(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ";",
                charset: str = "ISO-8859-1", header: bool = True, na_tokens: bool = True) -> DataFrame:
    """``read_delimited`` of files whose quoted fields may hold line breaks, split among all cores.

    Where one scan of the lines finds that no field does, Spark's reader takes the lines as they are.
    """
    lines = _quote_lines(spark, path, sep, charset)
    if not _any_open(lines):
        return read_delimited(spark, path, columns, sep, charset, header, na_tokens, quoted_newlines=False)
    return parse_delimited_lines(_texts(_joined(lines, header), "line"), columns, sep, "line", na_tokens)

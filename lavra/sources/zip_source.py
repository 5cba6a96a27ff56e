"""A Spark data source of zip archives, planned by member.

``spark.read.format("zip_members")`` lists the archives of a folder, reads only
their central directories, and plans one partition per bundle of members: a
large member is a task of its own, small ones and small archives share one, and a
large archive's members are spread over executors. A task seeks to its members and streams them
in bounded batches, so nothing holds an archive or a member whole. An archive
that can't be opened, or has no matching member, and a member that breaks off are
rows with ``error``; all others load.

Options: ``names`` (regex of archive names), ``pattern`` (regex of member
basenames, case-insensitive), ``first`` (only the first matching member), ``charset``,
``rows`` (``lines`` or ``content``), ``sep`` (records of a delimited member:
line breaks in quotes don't end a row), ``bundleBytes`` (compressed bytes a task
takes on) and ``batchRows``. Paths are anything that pyarrow's file systems open.
"""

from __future__ import annotations

import csv
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from io import TextIOWrapper
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..operators.project import union_by_name
from .delimited import parse_delimited_lines, with_inferred_types
from .quoted import quote_patterns

LINES = "archive string, member string, line_no long, line string, error string"
CONTENT = "archive string, member string, content binary, error string"
BUNDLE = 64 << 20
END_RECORD = 22  # bytes of the smallest archive, an empty one
CP1252 = {"windows-1252": "cp1252"}


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a plain path is a local one."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _error(exc: Exception) -> str:
    return f"{type(exc).__name__}: {exc}"


@dataclass
class Part:
    """Members of one archive by their place in its directory, or the error that it has instead."""

    archive: str
    members: tuple[tuple[int, str], ...] = ()
    error: str | None = None
    size: int = 0


@dataclass
class Members(InputPartition):
    """What one task reads."""

    parts: tuple[Part, ...] = ()


def bundled(parts: list[Part], bundle: int, most: int = 64) -> list[Members]:
    """Parts of archives in tasks of so many compressed bytes and parts."""
    out, held, size = [], [], 0
    for p in parts:
        if held and (size + p.size > bundle or len(held) == most):
            out.append(Members(tuple(held)))
            held, size = [], 0
        held.append(p)
        size += p.size
    return [*out, Members(tuple(held))]


def _archives(path: str, names: str | None) -> list[str]:
    system, at = open_path(path)
    info = system.get_file_info(at)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(at, recursive=True))
    prefix = path[:path.index(at)] if at in path else ""
    return sorted(prefix + f.path for f in found if f.is_file and f.path.lower().endswith(".zip")
                  and (names is None or re.search(names, f.base_name)))


def plan_archive(archive: str, pattern: re.Pattern | None, bundle: int, first: bool = False) -> list[Part]:
    """An archive's matching members, bundled up to so many compressed bytes."""
    try:
        system, at = open_path(archive)
        if system.get_file_info(at).size < END_RECORD:
            raise zipfile.BadZipFile("File is not a zip file")
        with system.open_input_file(at) as f, zipfile.ZipFile(f) as zf:
            infos = [(i, x) for i, x in enumerate(zf.infolist()) if not x.is_dir()]
    except Exception as exc:  # one archive's error, the others are planned
        return [Part(archive, error=_error(exc))]
    named = [(i, x.filename.rsplit("/", 1)[-1], x.compress_size) for i, x in infos]
    named = [x for x in named if pattern is None or pattern.search(x[1])]
    if not named:
        return [Part(archive, error="ValueError: no matching member")]
    out, held, size = [], [], 0
    for i, name, n in named[:1] if first else named:
        if held and size + n > bundle:
            out.append(Part(archive, tuple(held), size=size))
            held, size = [], 0
        held.append((i, name))
        size += n
    return [*out, Part(archive, tuple(held), size=size)]


def _records(lines: Iterator[str], sep: str | None) -> Iterator[str]:
    """Lines without their ends; with ``sep``, records, whose quoted fields may hold line breaks."""
    if sep is None:
        yield from (x.rstrip("\r\n") for x in lines)
        return
    outside, inside = (re.compile(p.replace(r"\z", r"\Z")) for p in quote_patterns(sep))
    held: list[str] = []
    for line in lines:
        body = line[:-1] if line.endswith("\n") else line
        open_now = '"' in body and outside.match(body) if not held else '"' not in body or inside.match(body)
        held.append(body)
        if not open_now:
            yield "\n".join(held).removesuffix("\r")
            held = []
    if held:
        yield "\n".join(held)


class ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.pattern = re.compile(options["pattern"], re.IGNORECASE) if options.get("pattern") else None
        charset = options.get("charset", "ISO-8859-1")
        self.charset = CP1252.get(charset.lower(), charset)
        self.names, self.first = options.get("names"), options.get("first", "false").lower() == "true"
        self.content = options.get("rows", "lines") == "content"
        self.sep = options.get("sep")
        self.bundle = int(options.get("bundlebytes", BUNDLE))
        self.batch = int(options.get("batchrows", 20_000))

    def partitions(self) -> list[Members]:
        with ThreadPool(16) as pool:  # directories are small reads at the archives' ends
            planned = pool.map(lambda a: plan_archive(a, self.pattern, self.bundle, self.first),
                               _archives(self.path, self.names))
        return bundled([p for one in planned for p in one], self.bundle)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = ([("content", pa.binary())] if self.content else [("line_no", pa.int64()), ("line", pa.string())])
        names = [("archive", pa.string()), ("member", pa.string()), *kinds, ("error", pa.string())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(names)],
                                          [n for n, _ in names])

    def _member(self, zf: zipfile.ZipFile, archive: str, place: int, name: str) -> Iterator[pa.RecordBatch]:
        with zf.open(zf.infolist()[place]) as raw:
            if self.content:
                yield self._batch([(archive, name, raw.read(), None)])
                return
            held = []
            with TextIOWrapper(raw, encoding=self.charset, errors="replace", newline="\n") as text:
                for n, line in enumerate(_records(text, self.sep)):
                    held.append((archive, name, n, line, None))
                    if len(held) == self.batch:
                        yield self._batch(held)
                        held = []
            if held:
                yield self._batch(held)

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        for part in partition.parts:
            yield from self._part(part)

    def _part(self, part: Part) -> Iterator[pa.RecordBatch]:
        blank = (None,) if self.content else (None, None)
        name = part.archive.rsplit("/", 1)[-1]
        if part.error:
            yield self._batch([(name, None, *blank, part.error)])
            return
        system, at = open_path(part.archive)
        with system.open_input_file(at) as f, zipfile.ZipFile(f) as zf:
            for place, member in part.members:
                try:
                    yield from self._member(zf, name, place, member)
                except Exception as exc:  # a broken member is a row, the next one is read
                    yield self._batch([(name, member, *blank, _error(exc))])


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return CONTENT if self.options.get("rows", "lines") == "content" else LINES

    def reader(self, schema: StructType) -> ZipReader:
        return ZipReader(dict(self.options))


def read_zip(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Members of the archives at a path (see the module); ``archive`` is the file's name."""
    spark.dataSource.register(ZipMembers)
    return spark.read.format("zip_members").options(**{k: str(v) for k, v in options.items()}).load(path)


def read_inferred_zip(spark: SparkSession, path: str, sep: str = ";", charset: str = "UTF-8",
                      pattern: str = r"\.csv$", most_layouts: int = 1_000) -> DataFrame:
    """Delimited members with a header each, merged by name, with types inferred over all of them.

    Archives and members that can't be read have no rows here; ``read_zip`` lists
    their errors. Columns come in the order in which sorted layouts name them.
    """
    rows = read_zip(spark, path, pattern=pattern, sep=sep, charset=charset).filter("error is null")
    heads = rows.filter("line_no = 0").select("archive", "member", F.col("line").alias("head"))
    layouts = [r["head"] for r in heads.select("head").distinct().orderBy("head").limit(most_layouts + 1).collect()]
    if not layouts:
        raise ValueError(f"no readable member at {path}")
    if len(layouts) > most_layouts:
        raise ValueError(f"more than {most_layouts} header layouts")
    body = rows.filter("line_no > 0 and line <> ''").join(heads, ["archive", "member"])
    parts = []
    for head in layouts:  # a source's few spellings of its header
        names = next(csv.reader([head], delimiter=sep))
        lines = body.filter(F.col("head") == F.lit(head)).select("line")
        parts.append(parse_delimited_lines(lines, names, sep))
    text = union_by_name(parts)
    return with_inferred_types(text, text.columns)


def write_zips(members: DataFrame, folder: str) -> DataFrame:
    """Writes ``(archive, member, content)`` rows as zip files of a shared folder; archive, n_members.

    An archive is one file, so its members come to one task, in order, and are
    written as they come; a retried task replaces its own files.
    """
    def pack(batches):
        system, at = open_path(folder)
        now, out, zf, n = None, None, None, 0

        def close():
            zf.close()
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [now], "n_members": pa.array([n], pa.int64())})

        for batch in batches:
            for archive, member, content in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if archive != now:
                    if now is not None:
                        yield close()
                    now, n, out = archive, 0, system.open_output_stream(f"{at}/{archive}")
                    zf = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                zf.writestr(zipfile.ZipInfo(member), content, zipfile.ZIP_DEFLATED)
                n += 1
        if now is not None:
            yield close()

    system, at = open_path(folder)
    system.create_dir(at, recursive=True)
    rows = members.select("archive", "member", "content").repartition("archive").sortWithinPartitions("archive", "member")
    return rows.mapInArrow(pack, "archive string, n_members long")

"""Zip archives → members, in parallel on executors (one archive per row)."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

MEMBER_SCHEMA = "archive string, member string, content binary, error string"


def _member(*row) -> pd.DataFrame:
    return pd.DataFrame([row], columns=["archive", "member", "content", "error"])


def _expand(pattern: str | None, first_only: bool, path_col: str, content_col: str):
    rx = re.compile(pattern, re.IGNORECASE) if pattern else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # input batches are capped in bytes by Arrow batching; members leave one at a time
        for pdf in batches:
            for path, blob in zip(pdf[path_col], pdf[content_col]):
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(blob))) as zf:
                        infos = [i for i in zf.infolist() if not i.is_dir()]
                        if rx is not None:
                            infos = [i for i in infos if rx.search(i.filename.rsplit("/", 1)[-1])]
                        if first_only:
                            infos = infos[:1]
                        if not infos:
                            raise ValueError("no matching member")
                        for info in infos:
                            yield _member(path, info.filename.rsplit("/", 1)[-1], zf.read(info), None)
                except Exception as exc:  # recorded per archive; others go on
                    yield _member(path, None, None, f"{type(exc).__name__}: {exc}")

    return run


def expand_zip(files: DataFrame, member_pattern: str | None = None, first_only: bool = False,
               path_col: str = "path", content_col: str = "content") -> DataFrame:
    """Archive rows ``(path, content)`` → member rows ``(archive, member, content, error)``.

    ``member_pattern`` filters member basenames (case-insensitive), e.g.
    ``r"\\.(csv|xlsx)$"``; ``first_only`` keeps the first member. A broken
    archive or one with no matching member yields a single row with ``error``
    set, so a bad file is reported while the rest load. Works the same on a
    ``binaryFile`` scan or on a table of landed bytes.
    """
    return files.select(path_col, content_col).mapInPandas(
        _expand(member_pattern, first_only, path_col, content_col), MEMBER_SCHEMA)


def _stream_lines(pattern: str | None, charset: str, batch: int, names: list[str]):
    rx = re.compile(pattern, re.IGNORECASE) if pattern else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                given, blob = row[:-1], row[-1]
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(blob))) as zf:
                        infos = [i for i in zf.infolist() if not i.is_dir()
                                 and (rx is None or rx.search(i.filename.rsplit("/", 1)[-1]))]
                        if not infos:
                            raise ValueError("no matching member")
                        with io.TextIOWrapper(zf.open(infos[0]), encoding=charset, newline="\n") as text:
                            held, at = [], 0
                            for line in text:
                                held.append((*given, at, line.rstrip("\r\n"), None))
                                at += 1
                                if len(held) == batch:
                                    yield pd.DataFrame(held, columns=names)
                                    held = []
                            if held:
                                yield pd.DataFrame(held, columns=names)
                except Exception as exc:  # recorded per archive; others go on
                    yield pd.DataFrame([(*given, None, None, f"{type(exc).__name__}: {exc}")], columns=names)

    return run


def zip_lines(files: DataFrame, keep: list[str], member_pattern: str | None = None, charset: str = "ISO-8859-1",
              batch: int = 20_000, content_col: str = "content") -> DataFrame:
    """Lines of each archive's first matching member: the ``keep`` columns, line_no, line, error.

    The member is read as a stream and leaves in bounded batches, so a worker
    holds the archive's bytes and one batch of lines. Broken archives and those
    without a matching member give one row with ``error``.
    """
    kinds = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in keep)
    return files.select(*keep, content_col).mapInPandas(
        _stream_lines(member_pattern, charset, batch, [*keep, "line_no", "line", "error"]),
        f"{kinds}, line_no long, line string, error string")

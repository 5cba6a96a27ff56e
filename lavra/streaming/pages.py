"""Paged API responses landed as files, read as a stream whose offset is the contiguous watermark.

A section's pages lie in one folder as ``page_<start>_<end>.json``; a fetch that
failed is ``page_<start>.error`` until it is landed, and ``total.json`` may hold
``{"count": n}``. The stream's offset is the end of the last page that follows
without a gap from the start, so a failed page stops the load there, and the
next run goes on from it. Spark logs a batch's offsets before it runs and commits
them after its write; a run that dies in between reads the same pages again, and
a sink that replaces the batch's own folder holds them once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..sources.zip_source import open_path

PAGE = re.compile(r"page_(\d+)_(\d+)\.json$")
PAGES_SCHEMA = "start_offset long, end_offset long, source_file string, payload string"
TASK_PAGES = 16


@dataclass
class Pages(InputPartition):
    """Consecutive pages of one task: (start, end, file)."""

    pages: tuple[tuple[int, int, str], ...]


def landed_pages(folder: str) -> dict[int, tuple[int, str]]:
    """start → (end, file) of the pages in a folder: a listing, nothing is opened."""
    system, at = open_path(folder)
    files = system.get_file_info(fs.FileSelector(at, allow_not_found=True))
    found = {}
    for f in files:
        m = PAGE.match(f.base_name)
        if f.is_file and m:
            found[int(m[1])] = (int(m[2]), f"{folder.rstrip('/')}/{f.base_name}")
    return found


def section_total(folder: str) -> int | None:
    """Rows that the section has at its source, if that is landed."""
    system, at = open_path(folder)
    if system.get_file_info(f"{at}/total.json").type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(f"{at}/total.json") as f:
        return int(json.loads(f.read())["count"])


def contiguous_end(pages: dict[int, tuple[int, str]], at: int = 0) -> int:
    """Where the pages that follow each other from an offset end."""
    while at in pages and pages[at][0] > at:
        at = pages[at][0]
    return at


class PageReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.task_pages = int(options.get("taskpages", TASK_PAGES))
        self.at = 0  # all before it was in an earlier answer

    def initialOffset(self) -> dict:  # noqa: N802
        return {"offset": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        total = section_total(self.folder)
        if not (total and self.at >= total):  # else everything is there: no listing
            self.at = contiguous_end(landed_pages(self.folder), self.at)
        return {"offset": self.at}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        pages, at, run = landed_pages(self.folder), start["offset"], []
        while at < end["offset"]:
            if at not in pages:
                raise FileNotFoundError(f"page at {at} of {self.folder} was there when the batch was planned")
            run.append((at, *pages[at]))
            at = pages[at][0]
        self.at = max(self.at, at)
        return [Pages(tuple(run[i:i + self.task_pages])) for i in range(0, len(run), self.task_pages)]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        for start, end, path in partition.pages:
            system, at = open_path(path)
            with system.open_input_stream(at) as f:
                text = f.read().decode("utf-8", "replace")
            yield pa.RecordBatch.from_pydict({"start_offset": pa.array([start], pa.int64()), "end_offset": pa.array([end], pa.int64()),
                                              "source_file": [path], "payload": [text]})

    def commit(self, end: dict) -> None:
        """Pages stay landed; what is committed is Spark's offset log."""


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return PAGES_SCHEMA

    def streamReader(self, schema: StructType) -> PageReader:  # noqa: N802
        return PageReader(dict(self.options))


def read_page_stream(spark: SparkSession, folder: str) -> DataFrame:
    """start_offset, end_offset, source_file, payload (the page's text) of a section's pages, as a stream."""
    spark.dataSource.register(LandedPages)
    return spark.readStream.format("landed_pages").load(folder)


__all__ = ["LandedPages", "PAGES_SCHEMA", "contiguous_end", "landed_pages", "read_page_stream", "section_total"]

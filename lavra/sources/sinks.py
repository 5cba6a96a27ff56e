"""Bronze/silver writers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from .zip_source import open_path


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines keeping null fields (Spark drops them by default)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Silver is a full rebuild: overwrite, optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def land_bytes(files: DataFrame, path: str) -> None:
    """Keep raw files untouched as a bronze table ``(path, length, content)``."""
    files.select("path", "length", "content").write.mode("append").parquet(path)


def land_texts(files: DataFrame, folder: str) -> None:
    """``(name, text)`` rows as files of a shared folder, as a fetcher lands them; names may hold sub-folders."""
    system, at = open_path(folder)
    system.create_dir(at, recursive=True)

    def write(batches):
        out, root = open_path(folder)
        made = set()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parent = f"{root}/{name}".rsplit("/", 1)[0]
                if parent not in made:
                    out.create_dir(parent, recursive=True)
                    made.add(parent)
                with out.open_output_stream(f"{root}/{name}") as f:
                    f.write(text.encode())
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    files.select("name", "text").mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()

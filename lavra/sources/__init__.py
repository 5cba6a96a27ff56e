"""Sources and sinks: landed files → bronze DataFrames, and writers."""

from .archives import expand_zip, zip_lines
from .delimited import read_delimited, read_inferred
from .files import list_layer, read_bytes, route_by_extension, with_extension
from .html import extract_links
from .jsonl import read_envelope_pages, read_esri_pages, read_jsonl
from .quoted import quoted_records, read_quoted
from .sinks import land_bytes, land_texts, write_jsonl, write_parquet
from .zip_source import read_inferred_zip, read_zip, write_zips

__all__ = ["expand_zip", "read_delimited", "read_inferred", "list_layer", "read_bytes",
           "with_extension", "route_by_extension", "extract_links", "read_envelope_pages", "read_esri_pages",
           "read_jsonl", "land_bytes", "land_texts", "write_jsonl", "write_parquet", "quoted_records", "read_quoted", "read_zip",
           "read_inferred_zip", "write_zips", "zip_lines"]

"""Structured Streaming loads: append bronze, resumable pages, ordered keep-first."""

from .append import stream_append_jsonl, stream_distinct_keys
from .ordered import first_rows, stream_keep_first
from .pages import read_page_stream

__all__ = ["first_rows", "read_page_stream", "stream_append_jsonl", "stream_distinct_keys", "stream_keep_first"]

"""Token counts by field or section: whole documents are encoded once, offsets decide.

A document is encoded as a whole with a byte-level BPE. Token byte lengths give
each token's character span; the spans are joined with the sections' spans by
their order (both are sorted, so the interval join is a merge). A token that
crosses a section's edge is allocated by an explicit rule: ``majority`` (the
section with most of its characters, the earlier on a tie), ``start`` (the
section of its first character), or ``split`` (each section the share of the
characters it holds). Under any rule a document's sections add up to its tokens.

Sections are given as spans that tile the text, or are its lines, where a line
break belongs to the line that it ends.

Defined cases: null text is empty text, which has one empty section without
tokens; a section without characters has no tokens; a token that holds a part
of a character counts as holding it; repeated rows are counted alike; spans
that leave characters out or overlap are refused; empty tables give empty
results; other columns than doc_id, text and sections aren't read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lavra.llm.common import small_batches

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# FIXED VALUE: the pattern that the public vocabulary was made with
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("majority", "start", "split")


def read_ranks(path: str = RANKS) -> bytes:
    """The vocabulary file's bytes (of fixed size), read once on the driver."""
    with open(path, "rb") as f:
        return f.read()


def _encoding(data: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, i in ranks.items():
        lengths[i] = len(piece)
    return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, encoding, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end (exclusive) of every token, the ids' spans over the whole text."""
    ids = np.asarray(encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), np.int64)
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if len(raw) == len(text):
        return starts, ends
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # character of each byte
    return char[starts], char[ends - 1] + 1


def line_sections(text: str) -> np.ndarray:
    """Ends of a text's lines, each with its line break."""
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") == 10) + 1
    return ends if len(ends) and ends[-1] == len(text) else np.append(ends, len(text))


def allocate(starts: np.ndarray, ends: np.ndarray, edges: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) per section; edges are the sections' ends, the last the text's length."""
    n = len(edges)
    first = np.searchsorted(edges, starts, side="right")
    last = np.searchsorted(edges, ends, side="left")
    crossing = last > first
    whole = np.bincount(first[~crossing], minlength=n).astype(float)
    touched = np.zeros(n, np.int64)
    for s, e, a, b in zip(starts[crossing], ends[crossing], first[crossing], last[crossing], strict=True):
        lo = np.concatenate([[s], edges[a:b]])
        share = np.diff(np.concatenate([lo, [e]]))
        touched[a:b + 1] += share > 0
        if rule == "split":
            whole[a:b + 1] += share / share.sum()
        else:
            whole[a + (int(np.argmax(share)) if rule == "majority" else 0)] += 1
    return whole, touched


def count_tokens(docs: DataFrame, data: bytes, rule: str = "majority", sections: str | None = None) -> DataFrame:
    """doc_id, section (number, from 0), name, start, end, n_tokens, n_crossing of every row's sections.

    sections: a column array<struct<name:string,start:int,end:int>> of spans in
    text order that tile the text; None: lines. n_tokens is whole unless the
    rule is split.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(docs.sparkSession)
    names = ["doc_id", "section", "name", "start", "end", "n_tokens", "n_crossing"]

    def run(batches):
        encoding, lengths = _encoding(data)
        for batch in batches:
            given = batch.column(2).to_pylist() if sections else None
            kind, parts = batch.schema.field(0).type, []
            docs_, texts = batch.column(0), batch.column(1).to_pylist()
            for i, text in enumerate(texts):
                text = (text or "").encode("utf-8", "replace").decode()
                if given is None:
                    edges, titles = line_sections(text), None
                else:
                    spans = given[i] or [{"name": None, "start": 0, "end": len(text)}]
                    edges = np.array([s["end"] for s in spans], np.int64)
                    titles = [s["name"] for s in spans]
                    begin = [s["start"] for s in spans]
                    if begin != [0, *edges[:-1].tolist()] or edges[-1] != len(text):
                        raise ValueError("sections must tile the text")
                starts, ends = token_spans(text, encoding, lengths)
                tokens, crossing = allocate(starts, ends, edges, rule)
                parts.append((i, edges, titles, tokens, crossing))
            if not parts:
                continue
            sizes = [len(p[1]) for p in parts]
            row = np.repeat([p[0] for p in parts], sizes)
            ends = np.concatenate([p[1] for p in parts])
            yield pa.RecordBatch.from_arrays([
                docs_.take(pa.array(row)).cast(kind),
                pa.array(np.concatenate([np.arange(s) for s in sizes]).astype(np.int32)),
                pa.array([t for p in parts for t in (p[2] or [None] * len(p[1]))], pa.string()),
                pa.array(np.concatenate([np.concatenate([[0], p[1][:-1]]) for p in parts]).astype(np.int64)),
                pa.array(ends.astype(np.int64)),
                pa.array(np.concatenate([p[3] for p in parts])),
                pa.array(np.concatenate([p[4] for p in parts]).astype(np.int64))], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "text", *([sections] if sections else [])]
    return docs.select(*columns).mapInArrow(run, (
        f"doc_id {kind}, section int, name string, start long, end long, n_tokens double, n_crossing long"))

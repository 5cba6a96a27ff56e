"""SentencePiece encoding and decoding; giant documents by a max-plus parallel scan.

The ids are those of the sentencepiece library for a BPE model. A piece
sequence is the BPE encoding of a text if and only if every two neighbours are
the encoding of their own concatenation; so the encoding is the only path of
weight 0 (all others weigh minus infinity) in a lattice over (position, last
piece), and any prefix of a text has one last piece.

A giant document is cut into chunks of fixed length, anywhere. A chunk's
boundary states are the pieces that may lie across or end at its edge: how
many characters before the edge a piece begins, and how many after it it ends.
Each chunk yields the max-plus matrix from its entry states to its exit states
(in parallel, independent of its neighbours), the matrices are multiplied
associatively, prefix products give the states that the start of the text
leads to, suffix products those that lead to its end, and each boundary has one
state in both. Then every chunk walks its lattice back from its exit state to
its entry state, again in parallel. No piece of the model goes from a letter
into a following space mark, so inside a chunk all paths meet at such places,
where a run of spaces and the letters after it is encoded on its own; other
documents are encoded that way in one go, with the library itself as the only
authority on such a unit and a bounded cache in front of it.

Defined cases: null text has null ids and decodes to null; empty text has no
ids and decodes to an empty text; repeated rows are encoded alike; a text
without spaces is one unit however long; characters outside the vocabulary are
coded as bytes. A text that holds the space mark itself (U+2581) decodes with
spaces there, as in the library. Extra columns are kept; empty tables give
empty results. Models that normalise text, or whose pieces hold letters before
a space mark, are refused.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT = 65_536
CHUNK = 16_384
CACHE = 300_000
MARK = "▁"
UNIT = re.compile(" +[^ ]*")


def read_model(path: str = MODEL) -> bytes:
    """The model's bytes (a vocabulary file of fixed size), read once on the driver."""
    with open(path, "rb") as f:
        data = f.read()
    sp = _processor(data)
    pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
    if sp.normalize("  a  b\tﬁ ") != f"{MARK * 3}a{MARK * 2}b\tﬁ{MARK}" or any(
            MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("the model normalises text or has pieces that hold a space mark after a letter")
    return data


def _processor(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


class Units(dict):
    """Ids of units (spaces, then other characters), encoded by the library when first met."""

    def __init__(self, data: bytes):
        self.encode = _processor(data).encode

    def __missing__(self, unit: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        ids = tuple(self.encode(unit[1:]))  # the library puts a space mark before a text
        if len(unit) <= 64:
            self[unit] = ids
        return ids


def _ids_of(units: Units, text: str) -> array:
    if not text:
        return array("i")
    return array("i", chain.from_iterable(map(units.__getitem__, UNIT.findall(" " + text))))


class Lattice:
    """The vocabulary as a lattice of compatible neighbours, over text with space marks."""

    def __init__(self, data: bytes):
        sp = _processor(data)
        kept = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.ids = {sp.id_to_piece(i): i for i in kept}
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in kept}
        self.bytes = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.longest = max(map(len, self.ids))
        self.follows = lru_cache(200_000)(self._follows)

    def _merge(self, text: str) -> list[str]:
        """BPE of a short string: the best-scored neighbours join, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores]
            if not found:
                break
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _follows(self, left: str, right: str) -> bool:
        if right[0] == MARK and left[-1] != MARK:
            return self._merge(left) == [left] and self._merge(right) == [right]
        return self._merge(left + right) == [left, right]

    def piece(self, text: str, start: int, end: int) -> str | None:
        p = text[start:end]
        return p if end - start == 1 or p in self.ids else None

    def ids_for(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]

    def walk(self, text: str, last: dict[int, str | None], start: int, end: int, stop: int) -> dict[int, str | None]:
        """Last piece at every reachable position in (start, stop], for pieces that begin before end.

        last: position to last piece (None: nothing before it). One path leads to a position.
        """
        last = dict(last)
        for at in range(min(last), end):
            before = last.get(at, False)
            if before is False:
                continue
            for to in range(at + 1, min(at + self.longest, stop) + 1):
                if to in last:
                    continue
                p = self.piece(text, at, to)
                if p and (self._merge(p) == [p] if before is None else self.follows(before, p)):
                    last[to] = p
        return last


def _boundaries(text: str, start: int, end: int) -> list[int]:
    """Positions in [start, end] where a unit begins: a space mark after another character."""
    return [m.start() + 1 for m in re.finditer(f"[^{MARK}](?={MARK})", text[start:end])]


def _chunk_states(lat: Lattice, left: str, body: str, right: str, first: bool, final: bool):
    """(entry states, exit states, matrix of 0 and -inf) of a chunk; a state is (before, after) the edge."""
    text, b, e = left + body + right, len(left), len(left) + len(body)

    def crossing(edge: int, n_left: int, n_right: int) -> list[tuple[int, int]]:
        return [(k, o) for o in range(0, min(lat.longest, n_right) + 1)
                for k in range(0 if o else 1, min(lat.longest - o, n_left) + 1)
                if k and lat.piece(text, edge - k, edge + o)]

    entries = [(0, 0)] if first else crossing(b, len(left), min(len(right) + len(body), lat.longest))
    exits: dict[tuple[int, int], int] = {}
    rows = []
    cuts = [b + c for c in _boundaries(text, b, e)]
    suffix = None
    if cuts:  # all paths meet at the last place where a unit begins
        suffix = lat.walk(text, {cuts[-1]: None}, cuts[-1], e, len(text))
    for k, o in entries:
        begin = {b + o: None if first else text[b - k:b + o]}
        if cuts and b + o <= cuts[0]:
            reach = lat.walk(text, begin, b + o, cuts[0], cuts[0])
            out = suffix if cuts[0] in reach else {}
        elif b + o >= e:
            out = begin if b + o > e or (b + o == e) else {}
        else:
            out = lat.walk(text, begin, b + o, e, len(text))
        found = set()
        for at, p in out.items():
            if at >= e and p is not None and at - len(p) < e:
                found.add((e - (at - len(p)), at - e))
        if final:
            found = {s for s in found if s[1] == 0}
        rows.append(found)
        for s in found:
            exits.setdefault(s, len(exits))
    m = np.full((len(entries), len(exits)), -np.inf, np.float32)
    for i, found in enumerate(rows):
        for s in found:
            m[i, exits[s]] = 0.0
    return entries, list(exits), m


def _max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not a.shape[1] or not b.shape[1]:
        return np.full((a.shape[0], b.shape[1]), -np.inf, np.float32)
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _cut(text: str, longest: int) -> list[tuple[int, str, str, str, bool]]:
    """(number, left margin, chunk, right margin, final) of a text with space marks."""
    text = MARK + text.replace(" ", MARK)
    return [(i, text[max(0, at - longest):at], text[at:at + CHUNK], text[at + CHUNK:at + CHUNK + longest],
             at + CHUNK >= len(text)) for i, at in enumerate(range(0, len(text), CHUNK))]


def _encode_giants(giants: DataFrame, data: bytes) -> DataFrame:
    """_pc_key, token_ids of distinct giant documents (_pc_key, text)."""

    def cut(batches):
        longest = Lattice(data).longest
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = _cut(text, longest)
                for at in range(0, len(rows), 64):
                    part = rows[at:at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(part)), pa.array([r[0] for r in part], pa.int32()),
                         *[pa.array([r[j] for r in part], pa.string()) for j in (1, 2, 3)],
                         pa.array([r[4] for r in part], pa.bool_())], ["_pc_key", "n", "l", "body", "r", "final"])

    def states(batches):
        lat = Lattice(data)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                entries, exits, m = _chunk_states(lat, r["l"], r["body"], r["r"], r["n"] == 0, r["final"])
                out.append((r["_pc_key"], r["n"], [list(s) for s in entries], [list(s) for s in exits],
                            [[int(i), int(j)] for i, j in zip(*np.nonzero(m == 0))]))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("_pc_key", "n", "entries", "exits", "arcs"), o, strict=True)) for o in out],
                schema=pa.schema([("_pc_key", pa.string()), ("n", pa.int32()), *[
                    (c, pa.list_(pa.list_(pa.int32()))) for c in ("entries", "exits", "arcs")]]))

    def scan(pdf):
        import pandas as pd

        pdf = pdf.sort_values("n")
        entries = [[tuple(s) for s in x] for x in pdf["entries"]]
        exits = [[tuple(s) for s in x] for x in pdf["exits"]]
        mats = []
        for i, arcs in enumerate(pdf["arcs"]):  # rows: this chunk's entries; columns: the next one's
            nxt = entries[i + 1] if i + 1 < len(entries) else [None]
            m = np.full((len(entries[i]), len(nxt)), -np.inf, np.float32)
            at = {s: j for j, s in enumerate(nxt)}
            for a, b in arcs:
                j = 0 if nxt == [None] else at.get(exits[i][b])
                if j is not None:
                    m[a, j] = 0.0
            mats.append(m)
        ahead, prefix = np.zeros((1, 1), np.float32), []
        for m in mats:
            prefix.append(ahead)
            ahead = _max_plus(ahead, m)
        back, suffix = np.zeros((1, 1), np.float32), []
        for m in reversed(mats):
            back = _max_plus(m, back)
            suffix.append(back)
        suffix.reverse()
        chosen = [int(np.argmax(p[0] + s[:, 0])) for p, s in zip(prefix, suffix, strict=True)]
        state = [entries[i][j] for i, j in enumerate(chosen)]
        end = [*state[1:], (0, 0)]
        return pd.DataFrame({"_pc_key": pdf["_pc_key"].to_numpy(), "n": pdf["n"].to_numpy(),
                             "enter": [s[1] for s in state], "entered": [s[0] for s in state],
                             "leave": [s[1] for s in end], "left": [s[0] for s in end]})

    def back(batches):
        lat, units = Lattice(data), Units(data)

        def between(text, last, start, end):
            """Ids of the path from start to end, walked back from the end."""
            reach, ids = lat.walk(text, {start: last}, start, end, end), []
            at = end
            while at > start:
                p = reach[at]
                ids.append(lat.ids_for(p))
                at -= len(p)
            return list(chain.from_iterable(reversed(ids)))

        for batch in batches:
            keys, ns, ids = [], [], []
            for r in batch.to_pylist():
                text, b = r["l"] + r["body"] + r["r"], len(r["l"])
                start = b + r["enter"]
                last = None if r["n"] == 0 else text[b - r["entered"]:start]
                # this chunk's own pieces end with the one that the next chunk enters by
                end = b + len(r["body"]) + r["leave"]
                cuts = [b + c for c in _boundaries(text, b, b + len(r["body"])) if b + c >= start]
                if start >= end:
                    own = []
                elif cuts and cuts[-1] <= end:
                    inner = text[cuts[0]:cuts[-1]].replace(MARK, " ")
                    own = (between(text, last, start, cuts[0])
                           + list(chain.from_iterable(map(units.__getitem__, UNIT.findall(inner))))
                           + between(text, None, cuts[-1], end))
                else:
                    own = between(text, last, start, end)
                keys.append(r["_pc_key"])
                ns.append(r["n"])
                ids.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ns, pa.int32()),
                                              pa.array(ids, pa.list_(pa.int32()))], ["_pc_key", "n", "ids"])

    chunks = giants.select("_pc_key", "text").mapInArrow(
        cut, "_pc_key string, n int, l string, body string, r string, final boolean")
    spread = chunks.repartition("_pc_key", "n")
    arcs = "array<array<int>>"
    matrices = spread.mapInArrow(states, f"_pc_key string, n int, entries {arcs}, exits {arcs}, arcs {arcs}")
    path = matrices.groupBy("_pc_key").applyInPandas(
        scan, "_pc_key string, n int, enter int, entered int, leave int, left int")
    traced = spread.join(path, ["_pc_key", "n"]).select("_pc_key", "n", "l", "body", "r", "enter", "entered", "leave")
    ids = traced.mapInArrow(back, "_pc_key string, n int, ids array<int>")
    return ids.groupBy("_pc_key").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("n", "ids"))), lambda x: x["ids"])).alias("_pc_ids"))


def encode(docs: DataFrame, data: bytes, giant: int = GIANT) -> DataFrame:
    """The rows with token_ids array<int>; all their columns are kept.

    Documents of more than giant characters take the parallel scan, one row per text.
    """
    small_batches(docs.sparkSession)
    names = docs.columns
    if "token_ids" in names:
        docs, names = docs.drop("token_ids"), [c for c in names if c != "token_ids"]

    def run(batches):
        units = Units(data)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            offsets, flat = [0], array("i")
            for text in texts.to_pylist():
                flat.extend(_ids_of(units, text or ""))
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(flat, np.int32)),
                                           mask=pa.array(np.asarray(texts.is_null())))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "token_ids"])

    def typed(df):
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", token_ids array<int>"

    is_giant = F.coalesce(F.char_length("text") > giant, F.lit(False))
    plain = docs.filter(~is_giant).mapInArrow(run, typed(docs))
    big = docs.filter(is_giant).withColumn("_pc_key", F.sha2("text", 256))
    ids = _encode_giants(big.select("_pc_key", "text").dropDuplicates(["_pc_key"]), data)
    whole = big.join(ids, "_pc_key", "left").select(*[F.col(f"`{c}`") for c in names], F.col("_pc_ids").alias("token_ids"))
    return plain.unionByName(whole)


def decode(rows: DataFrame, data: bytes, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of their ids; bytes pieces are joined before UTF-8 is read."""
    small_batches(rows.sparkSession)
    rows = rows.drop(out)

    def run(batches):
        sp = _processor(data)
        table = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i)
                 else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(sp.vocab_size())]
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(ids))
            flat, offsets = col.values.to_numpy(), col.offsets.to_numpy()
            texts = []
            for i, valid in enumerate(np.asarray(col.is_valid())):
                if not valid:
                    texts.append(None)
                    continue
                raw = b"".join(map(table.__getitem__, flat[offsets[i]:offsets[i + 1]].tolist()))
                texts.append((raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, `{out}` string")

"""Cross-tokenizer alignment: the tokens of two vocabularies over the same bytes.

A document is encoded by both tokenizers. Each token's cumulative end, in bytes,
goes into a dictionary from end to index, one per tokenizer (an end is its own
hash, so these are tables addressed by the end). The ends that both
dictionaries hold are a hash-set intersection; in order they slice both id
lists into groups, the shortest runs of A tokens and B tokens that cover the
same bytes. Inside a slice the only end in common is its last one, so expanding
a slice gives one link, between its last A and its last B token.

How often an id pair is linked is counted over the whole corpus. Of two tokens
that end together the shorter one is a suffix of the longer one, so the pairs
that can occur are fixed by the two vocabularies (``pair_bound``, some hundred
thousand): the table of counts has that size whatever the corpus holds, and
every document is scored against it where it lies, without a shuffle of links.

Both tokenizers cut before a single space between two other characters, so a
text without a space next to other white space is encoded by its space-led
units, with the libraries as only authority on a unit and a bounded store of
units in front of them; other texts are encoded whole.

Defined cases: null or empty text, and texts whose joined token bytes aren't
the text's (those that hold the space mark U+2581 itself), have no tokens,
groups or links; special tokens' strings in texts are plain text; repeated rows
are aligned and counted one by one; ties for a B token's highest count all
count as best; a text without spaces is one unit however long; empty tables
give empty results; other columns than doc_id and text aren't read, so extra
columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import small_batches, store
from lavra.llm.piece_codec import read_model
from lavra.llm.token_counts import PATTERN

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
MARK = "▁"
HELD = 150_000  # units held per task, and those of a block more
BLOCK = 1 << 20  # characters of texts aligned at a time
TOKENS = 1 << 17  # A tokens of aligned rows scored at a time
JOINED = 500  # plain units encoded in one call
SHIFT = 20  # a pair of ids as one number: A id << SHIFT | B id
BESIDE = -1  # number of a unit that makes its text to be encoded whole
PLAIN = re.compile(r"[\n!-~\u00A1-\u00AC\u00AE-\u024F\u2010-\u2027]*").fullmatch


def read_byte_model(path: str = BYTE_MODEL) -> str:
    """The tokenizer file's text (of fixed size), read once on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable Latin-1 stands for itself, others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_tokens(model: str) -> list[bytes]:
    """Bytes of every id of a byte-level tokenizer."""
    from tokenizers import Tokenizer

    return _byte_tokens(Tokenizer.from_str(model))


def _byte_tokens(tokenizer) -> list[bytes]:
    alphabet = byte_alphabet()
    vocab = tokenizer.get_vocab(with_added_tokens=False)
    out = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        out[i] = bytes(alphabet[c] for c in piece)
    return out


def piece_tokens(model: bytes) -> list[bytes]:
    """Bytes of every id of a piece model: the space mark is a space, <0xHH> the byte HH."""
    return _piece_tokens(_pieces(model))


def _piece_tokens(sp) -> list[bytes]:
    return [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
            else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(sp.vocab_size())]


def pair_bound(a_tokens: list[bytes], b_tokens: list[bytes]) -> int:
    """How many id pairs can end together: one token's bytes end the other's."""
    def ends(longer: list[bytes], shorter: list[bytes], proper: int) -> int:
        n: dict[bytes, int] = {}
        for t in shorter:
            n[t] = n.get(t, 0) + 1
        return sum(n.get(t[i:], 0) for t in longer for i in range(proper, len(t)))

    return ends(a_tokens, b_tokens, 0) + ends(b_tokens, a_tokens, 1)


def _pieces(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of so many numbers each, one range after the other."""
    at = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - at, size)


class Units:
    """Ids of units under both tokenizers, each encoded once while it is held."""

    def __init__(self, byte_model: str, piece_model: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_model)
        self.a.encode_special_tokens = True
        self.b = _pieces(piece_model)
        self.a_bytes, self.b_bytes = _byte_tokens(self.a), _piece_tokens(self.b)
        self.lengths = [np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes)]
        ranks = {t: i for i, t in enumerate(self.a_bytes)}
        self.fast = tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.clear()

    def clear(self) -> None:
        self.known: dict[str | tuple[str], int | None] = {}  # unit, or (text,) of a whole one -> its number
        self.ids = array("i"), array("i")
        self.ends = array("q", [0]), array("q", [0])

    def _encode(self, plain: list[str], odd: list[str], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A ids of space + unit one after the other, and how many each unit has. Ranks of merged tokens give the merges'
        order, so the fast encoder's ids are the library's own; only units of characters on which their regexes are known
        to agree are given to it, many at a time. ends: the plain units' cumulative ends in bytes."""
        flat = [np.fromiter(self.fast(" " + " ".join(plain[i:i + JOINED])), np.int32) for i in range(0, len(plain), JOINED)]
        flat = np.concatenate([np.zeros(0, np.int32), *flat])
        upto = np.cumsum(self.lengths[0][flat])
        at = np.searchsorted(upto, ends, side="right")
        slow = odd
        if not np.array_equal(np.concatenate([[0], upto])[at], ends):  # a token crosses from a unit to the next
            flat, at, slow = flat[:0], at[:0], plain + odd
        coded = [e.ids for e in self.a.encode_batch([" " + u for u in slow], add_special_tokens=False)]
        n = np.concatenate([np.diff(at, prepend=0), np.fromiter(map(len, coded), np.int64, len(coded))])
        return np.concatenate([flat, np.fromiter(chain.from_iterable(coded), np.int32)]), n

    def _learn(self, keys: list, units: list[str]) -> None:
        """Encodes units (space + unit) and numbers them; None for those whose tokens spell something else."""
        alike = list(map(PLAIN, units))
        plain, odd = [u for u, p in zip(units, alike, strict=True) if p], [u for u, p in zip(units, alike, strict=True) if not p]
        keys = [k for k, p in zip(keys, alike, strict=True) if p] + [k for k, p in zip(keys, alike, strict=True) if not p]
        units = plain + odd
        spelled = [(" " + u).encode() for u in units]
        size = np.fromiter(map(len, spelled), np.int64, len(units))
        pieces = self.b.encode(units)
        n = np.fromiter(map(len, pieces), np.int64, len(units))
        coded = self._encode(plain, odd, np.cumsum(size[:len(plain)])), (np.fromiter(chain.from_iterable(pieces), np.int32), n)
        good = np.ones(len(units), bool)
        for tokens, lengths, (flat, n) in zip((self.a_bytes, self.b_bytes), self.lengths, coded, strict=True):
            end = np.cumsum(n)
            good &= np.diff(np.concatenate([[0], np.cumsum(lengths[flat])])[end], prepend=0) == size
            # with every unit's size right, the units are right if all bytes in a row are
            if not good.all() or b"".join(map(tokens.__getitem__, flat.tolist())) != b"".join(spelled):
                good &= [b"".join([tokens[t] for t in flat[e - k:e].tolist()]) == u
                         for e, k, u in zip(end.tolist(), n.tolist(), spelled, strict=True)]
        self.known.update(zip(keys, (len(self.ends[0]) - 2 + np.cumsum(good)).tolist(), strict=True))
        self.known.update((keys[i], None) for i in np.flatnonzero(~good).tolist())
        for side, (flat, n) in enumerate(coded):
            self.ends[side].frombytes((len(self.ids[side]) + np.cumsum(n[good])).astype(np.int64).tobytes())
            self.ids[side].frombytes(flat[np.repeat(good, n)].tobytes())

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The numbers of each text's units, or of the text as one; none where tokens spell something else."""
        if len(self.known) > HELD or len(self.ids[0]) > 8 * HELD:
            self.clear()
        parts = [t.split(" ") if t else [] for t in texts]
        new = set().union(*parts).difference(self.known)
        # a unit that is empty or begins or ends with white space has a space next to other white space
        beside = {u for u in new if not u or len(u.strip()) < len(u)}
        self.known.update(dict.fromkeys(beside, BESIDE))
        new = list(new - beside)
        self._learn(new, new)
        found = [list(map(self.known.__getitem__, p)) for p in parts]
        whole = [i for i, n in enumerate(found) if BESIDE in n]
        self._learn([(texts[i],) for i in whole], [texts[i] for i in whole])
        for i in whole:
            found[i] = [self.known[texts[i],]]
        return [[] if None in n else n for n in found]

    def joined(self, side: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after the other, and how many each has."""
        ends = np.frombuffer(self.ends[side], np.int64)
        start, size = ends[numbers], ends[numbers + 1] - ends[numbers]
        ids = np.frombuffer(self.ids[side], np.int32) if len(self.ids[side]) else np.zeros(0, np.int32)
        return ids[_ranges(start, size)], size


class Aligner:
    """The groups that both tokenizers cut texts into."""

    def __init__(self, byte_model: str, piece_model: bytes):
        self.units = Units(byte_model, piece_model)

    def align(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(values, numbers per text) of a_ids, b_ids, a_sizes and b_sizes."""
        texts = [(t or "").encode("utf-8", "replace").decode() for t in texts]
        numbers = self.units.numbers(texts)
        text = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])  # of each unit
        flat = np.fromiter(chain.from_iterable(numbers), np.int64, len(text))
        ids, per_text, index, ends = [], [], [], []
        for side in (0, 1):
            found, size = self.units.joined(side, flat)
            ids.append(found)
            per_text.append(np.bincount(text, weights=size, minlength=len(texts)).astype(np.int64))
            ends.append(np.cumsum(self.units.lengths[side][found]))
        # end -> index: an end is its own hash, so the dictionary is a table addressed by it; 0 is no entry
        for e in ends:
            table = np.zeros(int(ends[0][-1]) + 1 if len(flat) else 1, np.int32)
            table[e] = np.arange(1, len(e) + 1)
            index.append(table)
        common = np.flatnonzero((index[0] > 0) & (index[1] > 0))  # in both, in order
        groups = np.searchsorted(index[0][common], np.cumsum(per_text[0]), side="right")
        per_text += [np.diff(groups, prepend=0)] * 2
        return list(zip([*ids, *[np.diff(t[common], prepend=0) for t in index]], per_text, strict=True))


def _blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in blocks of a bounded number of characters, or of one text."""
    block, size = [], 0
    for text in texts:
        if block and size + len(text or "") > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text or "")
    if block:
        yield block


def align(docs: DataFrame, byte_model: str, piece_model: bytes) -> DataFrame:
    """doc_id, a_ids, b_ids, a_sizes, b_sizes (tokens of each group, in order) of every row."""
    small_batches(docs.sparkSession)

    def run(batches):
        aligner = Aligner(byte_model, piece_model)
        for batch in batches:
            at = 0
            for block in _blocks(batch.column(1).to_pylist()):
                lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]).astype(np.int32)), pa.array(v.astype(np.int32)))
                         for v, n in aligner.align(block)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(block)), *lists],
                                                 ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])
                at += len(block)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of aligned batches, up to TOKENS A tokens at a time or one row."""
    for batch in batches:
        upto = np.cumsum(batch.column(batch.schema.get_field_index("a_ids")).value_lengths().to_numpy())
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + TOKENS, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and where each row's begin and the last one's end."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The linked id pair of every group of a batch, and each row's first group."""
    (a, _), (b, _) = _flat(batch, "a_ids"), _flat(batch, "b_ids")
    (a_size, at), (b_size, _) = _flat(batch, "a_sizes"), _flat(batch, "b_sizes")
    last_a, last_b = a[np.cumsum(a_size) - 1].astype(np.int64), b[np.cumsum(b_size) - 1].astype(np.int64)
    return last_a << SHIFT | last_b, at


def link_counts(aligned: DataFrame) -> DataFrame:
    """a_id, b_id, n, best (n is the highest of b_id): links of every linked id pair in the corpus."""
    def run(batches):
        for batch in _slices(batches):
            pairs, n = np.unique(_links(batch)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])

    pairs = (aligned.select("a_ids", "b_ids", "a_sizes", "b_sizes").mapInArrow(run, "pair long, n long")
             .groupBy("pair").agg(F.sum("n").alias("n")))
    pairs = pairs.select(F.shiftright("pair", SHIFT).cast("int").alias("a_id"),
                         F.col("pair").bitwiseAND((1 << SHIFT) - 1).cast("int").alias("b_id"), "n")
    most = pairs.groupBy("b_id").agg(F.max("n").alias("most"))
    return pairs.join(most, "b_id").select("a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


class GroupText:
    """``a1,a2|b1;a3|b2`` of a batch's groups: each id's digits with the mark that follows it, laid out in order."""

    def __init__(self, n_a: int, n_b: int):
        self.marked = [b"%d%s" % (i, mark) for mark, n in ((b",", n_a), (b"|", n_a), (b",", n_b), (b";", n_b)) for i in range(n)]
        self.start = (0, n_a, 2 * n_a, 2 * n_a + n_b)

    def texts(self, batch: pa.RecordBatch) -> list[bytes]:
        (a, a_at), (b, b_at) = _flat(batch, "a_ids"), _flat(batch, "b_ids")
        (a_size, _), (b_size, _) = _flat(batch, "a_sizes"), _flat(batch, "b_sizes")
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
        out = np.zeros(len(a) + len(b), np.int64)
        a_code, b_code = a.astype(np.int64) + self.start[0], b.astype(np.int64) + self.start[2]
        a_code[a_end - 1] += self.start[1] - self.start[0]
        b_code[b_end - 1] += self.start[3] - self.start[2]
        out[np.arange(len(a)) + np.repeat(b_end - b_size, a_size)] = a_code
        out[np.arange(len(b)) + np.repeat(a_end, b_size)] = b_code
        codes, at = out.tolist(), (a_at + b_at).tolist()
        return [b"".join([self.marked[c] for c in codes[i:j]])[:-1] for i, j in zip(at, at[1:], strict=False)]


def score(aligned: DataFrame, counts: DataFrame, a_tokens: list[bytes], b_tokens: list[bytes]) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every aligned row.

    counts goes to every task: its rows are id pairs that can end together, a
    number that the vocabularies set and that is checked here.
    """
    table = store(counts, "link-counts").toArrow()
    if table.num_rows > pair_bound(a_tokens, b_tokens):
        raise ValueError("more id pairs than two vocabularies can link")
    pair = table["a_id"].to_numpy().astype(np.int64) << SHIFT | table["b_id"].to_numpy()
    order = np.argsort(pair)
    shared = aligned.sparkSession.sparkContext.broadcast(
        (pair[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order].astype(np.int64)))
    sizes = len(a_tokens), len(b_tokens)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(batches):
        known, n, best = shared.value
        writer = GroupText(*sizes)
        for batch in _slices(batches):
            links, at = _links(batch)
            where = np.searchsorted(known, links)

            def total(values, at=at):
                upto = np.concatenate([[0], np.cumsum(values)])
                return upto[at[1:]] - upto[at[:-1]]

            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in writer.texts(batch)]
            columns = [np.diff(_flat(batch, "a_ids")[1]), np.diff(_flat(batch, "b_ids")[1]), np.diff(at), np.diff(at),
                       total(best[where]), total(n[where])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c.astype(np.int64)) for c in columns], pa.array(digests, pa.string())],
                ["doc_id", *names, "groups_sha256"])

    kind = aligned.schema["doc_id"].dataType.simpleString()
    return aligned.select("doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names) + ", groups_sha256 string")


def align_and_score(docs: DataFrame, byte_model: str | None = None, piece_model: bytes | None = None) -> DataFrame:
    """The rows' alignment, scored by the corpus-wide counts of its links."""
    byte_model, piece_model = byte_model or read_byte_model(), piece_model or read_model()
    aligned = store(align(docs, byte_model, piece_model), "aligned")
    return score(aligned, link_counts(aligned), byte_tokens(byte_model), piece_tokens(piece_model))

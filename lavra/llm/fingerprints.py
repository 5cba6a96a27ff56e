"""Document fingerprints: improbable-feature digests compared by Bloom-filter overlap.

Every 64-byte window of a text's UTF-8 bytes has an entropy, read on a scale of
0 to 1000. How often each entropy occurs over all documents gives its rarity
rank (``fit_ranks``, one histogram of 1001 numbers whatever the input). A
window is selected if it is the leftmost rarest of enough of the neighbourhoods
it is in; windows of very low entropy (runs, padding) never are. Where no window
has enough votes, the most voted ones are selected; a text of nothing but weak
windows has one feature, the hash of the whole text. Selected windows are
hashed and put, five bits each, into a chain of 2048-bit Bloom filters, a new
one after 160 features. Two fingerprints are compared filter by filter: the
overlap of their bits beyond what chance gives, on a scale up to the smaller
filter's bits; each filter of the shorter chain counts with its best match, and
the mean is the likeness.

Defined cases: null text is empty text; an empty text has an empty fingerprint,
like only another empty one (1.0); a text shorter than a window is one feature;
equal texts have equal fingerprints, and equal fingerprints are 1.0 alike;
repeated rows are handled row by row; very long texts are read in blocks with
the windows that cross them; empty tables give empty results; only doc_id and
text are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lavra.llm.common import store

WINDOW = 64
NEIGHBOURS = 64
POPULAR = 16
SCALE = 1000
WEAK = 100  # entropies below this are never features
BITS = 2048
PER_FILTER = 160
CHANCE = 0.3
BLOCK = 1 << 19
_NLOGN = np.concatenate([[0.0], np.arange(1, WINDOW + 1) * np.log2(np.arange(1, WINDOW + 1))])


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy (0 to 1000) of every 64-byte window of a byte array.

    Counts of a window's first byte in it and of its last byte in it come from
    comparing the array with itself shifted by 1 to 63; the sum of n log n then
    changes from window to window by the byte that leaves and the one that comes.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int16)
    ahead = np.ones(len(data), np.uint8)  # of the byte, in the window that it begins
    behind = np.ones(len(data), np.uint8)  # of the byte, in the window that it ends
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    first = _NLOGN[np.bincount(data[:WINDOW], minlength=256)].sum()
    leave, come = ahead[:n - 1].astype(np.intp), behind[WINDOW:].astype(np.intp)
    change = _NLOGN[leave - 1] - _NLOGN[leave] + _NLOGN[come] - _NLOGN[come - 1]
    total = first + np.concatenate([[0.0], np.cumsum(change)])
    bits = np.log2(WINDOW) - total / WINDOW
    return np.rint(bits * (SCALE / np.log2(WINDOW))).clip(0, SCALE).astype(np.int16)


def _blocks(data: np.ndarray, overlap: int) -> Iterator[np.ndarray]:
    for at in range(0, max(len(data) - overlap, 1), BLOCK):
        yield data[at:at + BLOCK + overlap]


def fit_ranks(docs: DataFrame) -> list[int]:
    """Rarity rank of each entropy (0: rarest) over all windows of all documents, 1001 numbers."""

    def histogram(batches):
        sums = np.zeros(SCALE + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
                for part in _blocks(raw, WINDOW - 1):
                    sums += np.bincount(entropies(part), minlength=SCALE + 1)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], ["entropy", "n"])

    counts = (docs.select("text").mapInArrow(histogram, "entropy int, n long").groupBy("entropy")
              .agg(F.sum("n").alias("n")).collect())  # at most 1001 rows
    n = {r["entropy"]: r["n"] for r in counts}
    order = sorted(range(SCALE + 1), key=lambda e: (n.get(e, 0), e))
    ranks = [0] * (SCALE + 1)
    for rank, e in enumerate(order):
        ranks[e] = rank
    return ranks


def _leftmost_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of width keys."""
    step = 1
    while step * 2 <= width:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    rest = width - step
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def features(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Hashes of the selected windows, in text order."""
    if len(data) == 0:
        return np.zeros(0, np.uint64)
    if len(data) < WINDOW:
        return _hash(np.concatenate([data, np.zeros(WINDOW - len(data), np.uint8)])[None, :])
    overlap = WINDOW - 1
    h = np.concatenate([entropies(p) for p in _blocks(data, overlap)])
    rank = np.where(h < WEAK, np.int64(SCALE + 1), ranks[h])
    n = len(h)
    width = min(NEIGHBOURS, n)
    key = (rank << 40) | np.arange(n)
    best = _leftmost_min(key, width) & ((1 << 40) - 1)
    votes = np.bincount(best, minlength=n)
    strong = rank <= SCALE
    if not strong.any():
        return _whole(data)
    # a short text has few neighbourhoods: its most voted windows are selected where none has enough votes
    need = min(POPULAR, votes[strong].max())
    at = np.flatnonzero((votes >= need) & strong)
    out = [_hash(data[part[:, None] + np.arange(WINDOW)]) for part in np.array_split(at, len(at) // 65536 + 1)]
    return np.concatenate(out)


def _whole(data: np.ndarray) -> np.ndarray:
    """Hash of a whole text as one feature."""
    raw = hashlib.blake2b(data.tobytes(), digest_size=WINDOW).digest()
    return _hash(np.frombuffer(raw, np.uint8)[None, :])


def _hash(windows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(windows).view("<u8")
    out = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words.shape[1]):
        out ^= words[:, k]
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xC4CEB9FE1A85EC53)
        out ^= out >> np.uint64(32)
    return out


def digest(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Chain of filters as bytes, shape (filters, 256); no feature, no filter."""
    found = features(data, ranks)
    if not len(found):
        return np.zeros((0, BITS // 8), np.uint8)
    n = -(-len(found) // PER_FILTER)
    bits = np.zeros((n, BITS), np.uint8)
    row = np.arange(len(found)) // PER_FILTER
    for k in range(5):
        bits[row, ((found >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.intp)] = 1
    return np.packbits(bits, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two chains, 0 to 1."""
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    na, nb = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    wa, wb = a.view("<u8"), b.view("<u8")
    best = np.zeros(len(a))
    for i in range(len(a)):
        both = np.bitwise_count(wa[i] & wb).sum(axis=1, dtype=np.int64)
        most = np.minimum(na[i], nb)
        chance = na[i] * nb / BITS
        floor = chance + CHANCE * (most - chance)
        best[i] = max(0.0, ((both - floor) / np.maximum(most - floor, 1e-9)).max())
    return float(min(1.0, best.mean()))


def as_text(filters: np.ndarray) -> str:
    """``filters:features base64`` form of a chain; empty for an empty one."""
    return f"{len(filters)}:{base64.b64encode(filters.tobytes()).decode()}" if len(filters) else ""


def from_text(text: str) -> np.ndarray:
    raw = base64.b64decode(text.partition(":")[2])
    return np.frombuffer(raw, np.uint8).reshape(-1, BITS // 8)


def fingerprints(docs: DataFrame, ranks: list[int]) -> DataFrame:
    """doc_id and fingerprint of every row."""
    table = np.asarray(ranks, np.int64)

    def run(batches):
        for batch in batches:
            out = [as_text(digest(np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8), table))
                   for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint string")


def in_sequence(docs: DataFrame, ranges: int) -> DataFrame:
    """doc_id, text, part, ends: the rows dealt into ranges of descending doc_id, ready to be read in order.

    The ranges' edges are quantiles of the ids. The first row of each range is
    added to the end of the one before it (ends true), and the first of all to
    the last, so that every range holds the successor of each of its rows. At
    most one extra row per range is dealt. Equal ids are ordered by text hash
    and text; null ids come last.
    """
    last = F.lit(-(2**63)).cast("long")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), last).alias("_at"))
    edges = rows.agg(F.percentile_approx("_at", [i / ranges for i in range(1, ranges)], 10_000).alias("q")
                     ).first()["q"] if ranges > 1 else None
    edges = sorted(set(edges or []), reverse=True)
    # part 0 holds the highest ids
    part = F.size(F.filter(F.array(*[F.lit(e) for e in edges]).cast("array<bigint>"), lambda e: F.col("_at") < e))
    rows = rows.withColumn("part", part)
    heads = store(rows.groupBy("part").agg(F.max("_at").alias("_at")), "heads")  # a row per range
    before = W.orderBy("part")
    top = heads.agg(F.min("part").alias("part"), F.max("part").alias("low")).first()
    if top["part"] is None:
        return rows.select("doc_id", "text", "part", "_at", F.lit(False).alias("ends"))
    into = heads.withColumn("into", F.coalesce(F.lag("part").over(before), F.lit(top["low"])))
    first = (rows.join(F.broadcast(into.withColumnRenamed("part", "_p")), "_at")  # bounded by the number of ranges
             .groupBy("into").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "doc_id")).alias("r"),
                                  F.max("_at").alias("_at")))
    extra = first.select("r.doc_id", "r.text", F.col("into").alias("part"), "_at", F.lit(True).alias("ends"))
    return rows.select("doc_id", "text", "part", "_at", F.lit(False).alias("ends")).unionByName(extra)


def compare_edited(docs: DataFrame, ranks: list[int], ranges: int | None = None) -> DataFrame:
    """Each document against its edited text and the next document, in descending doc_id.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (in_sequence(docs, ranges).repartition(ranges, "part")
             .sortWithinPartitions("part", "ends", F.col("_at").desc(), F.xxhash64("text"), "text"))
    table = np.asarray(ranks, np.int64)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        held = None  # (doc_id, text, chain, part): the row whose successor comes next
        for batch in batches:
            out = []
            for doc, text, part, ends in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                chain = digest(np.frombuffer(raw, np.uint8), table)
                if held is not None and held[3] == part:
                    mine, cut = held[1], len(held[1]) // 3
                    edited = (mine[:len(mine) - cut] + text[:cut]).encode("utf-8", "surrogatepass")
                    other = digest(np.frombuffer(edited, np.uint8), table)
                    out.append((held[0], len(mine), hashlib.sha256(edited).hexdigest(), as_text(held[2]), as_text(other),
                                likeness(held[2], other), likeness(held[2], chain)))
                held = None if ends else (doc, text, chain, part)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                        batch.schema.field(0).type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2), strict=True)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.select("doc_id", "text", "part", "ends").mapInArrow(run, (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"))

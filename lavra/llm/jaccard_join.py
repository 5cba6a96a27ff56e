"""N-gram Jaccard join: a token-group matrix opened only where its bounds allow.

A document's set is its distinct five-word shingles (64-bit hashes). Two sets
link when 100 * intersection >= 80 * union, exactly; the result is the
connected components of all links.

1. Documents with equal sets are one node.
2. Tokens get one common order: tokens that recur within some block of the
   input come last (the ``FREQUENT`` most counted of them), ties by hash. Of a
   set of n tokens, a partner shares at least ceil(0.8 n), so it shares one of
   the first n - ceil(0.8 n) + 1 in that order. Any order is exact; this one
   keeps tokens of common passages out of the first ones. Only tokens that
   two nodes have among their first are kept on.
3. If the first token that a pair shares has place i in one set and j in the
   other, the intersection is at most min(n_a - i, n_b - j). So a token is worth
   following for a pair only if 80 * (n_a + n_b) <= 180 * min(u_a, u_b), where
   u = n - place, and the sizes allow a link; a linking pair passes by its first
   shared token at least. The tokens in the lowest REGION of all hashes are
   counted over all sets, not only where they come first: those that no other
   node has are in no partner, and u is at most n minus their number.
4. Similar nodes are partitioned into groups: for each token, its nodes are
   compared with the one of them that has the fewest rare tokens, and groups
   are the components of the links so found; a group of thousands of near
   copies takes as many comparisons as it has nodes and tokens, not the square.
5. The token-group matrix holds each group's union of first tokens, with the
   sizes and the largest u of the group's nodes that have the token.
   Groups that share a token are bounded against each other, and each node of
   the one that has fewer there against the other; only groups whose bound
   allows a link are opened, and the node is compared with their nodes that
   pass step 3.
6. Components of all links give the result.

Tokens, nodes and pairs are keyed rows spread by hash; counts are pre-aggregated, joins on a
common token can be split, and no group is ever held in one place.

Defined cases: null or blank text has an empty set and is linked with nothing
(its component is its own doc_id); under five words the whole sequence is one
shingle; rows that share a doc_id are separate rows; a null doc_id takes part
in links, but a component's id is its smallest non-null doc_id (null if it has
none); repeated rows are one node; very long texts are read in segments of whole
words; empty tables give empty results; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import small_batches, store
from lavra.llm.graph import connected_components

WORDS = 5
PERCENT = 80
FREQUENT = 1 << 17
REGION = 0.3
BITS = 1 << 26
LOCAL_MIN = 3
BLOCK_TOKENS = 2_000_000
SEGMENT = 1 << 18  # bytes of text hashed at a time: an array over them takes 2 MB

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle sets of texts, many texts at a time."""

    def __init__(self, words: int = WORDS):
        self.words = words
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.separator = np.zeros(256, bool)
        self.separator[[32, *range(9, 14)]] = True
        self.value = _mix(lower.astype(np.uint64) + np.uint64(1))  # of a byte, upper case as lower
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            for name, base in (("power", _MULT), ("inverse", _INV)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def word_hashes(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of every word of a byte array."""
        sep = self.separator[raw]
        edge = np.diff(np.concatenate([[True], sep, [True]]).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self._powers(len(raw) + 1)
        run = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.value[raw] * self.power[:len(raw)], out=run[1:])
        return start, _mix((run[end] - run[start]) * self.inverse[start])

    def _segments(self, raw: np.ndarray) -> Iterator[np.ndarray]:
        at = 0
        while at < len(raw):
            end = min(len(raw), at + SEGMENT)
            while end < len(raw) and not self.separator[raw[end - 1]]:  # to the end of a word
                more = np.flatnonzero(self.separator[raw[end:end + SEGMENT]])
                end = end + int(more[0]) + 1 if len(more) else min(len(raw), end + SEGMENT)
            yield raw[at:end]
            at = end

    def sets(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text's index, text of each token within the part, token), sorted by both and distinct."""
        at = 0
        while at < len(texts):
            parts, size, first = [], 0, at
            while at < len(texts) and (not parts or size < SEGMENT):
                parts.append((texts[at] or "").encode("utf-8", "surrogatepass"))
                size += len(parts[-1]) + 1
                at += 1
            if len(parts) > 1 or size <= 2 * SEGMENT:
                starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
                where, word = self.word_hashes(np.frombuffer(b" ".join(parts), np.uint8))
                doc = np.searchsorted(starts, where, side="right") - 1
            else:
                word = np.concatenate([self.word_hashes(s)[1] for s in self._segments(np.frombuffer(parts[0], np.uint8))])
                doc = np.zeros(len(word), np.int64)
            yield first, *self._shingles(doc, word)

    def _shingles(self, doc: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = self.words
        n = max(len(word) - k + 1, 0)
        acc = np.zeros(n, np.uint64)
        for i in range(k):
            acc = _mix(acc * np.uint64(_MULT) + word[i:i + n])
        whole = doc[:n] == doc[k - 1:] if n else np.zeros(0, bool)
        docs, tokens = doc[:n][whole], acc[whole]
        ids, begin, count = np.unique(doc, return_index=True, return_counts=True)
        short_doc, short = [], []
        for d, b, c in zip(ids[count < k], begin[count < k], count[count < k], strict=True):
            h = np.full(1, c, np.uint64)
            for i in range(b, b + c):
                h = _mix(h * np.uint64(_MULT) + word[i:i + 1])
            short_doc.append(d)
            short.append(h[0])
        if short:
            docs = np.concatenate([docs, np.array(short_doc, docs.dtype)])
            tokens = np.concatenate([tokens, np.array(short, np.uint64)])
        tokens = tokens.view(np.int64)
        order = np.lexsort((tokens, docs))
        docs, tokens = docs[order], tokens[order]
        keep = np.ones(len(docs), bool)
        keep[1:] = (docs[1:] != docs[:-1]) | (tokens[1:] != tokens[:-1])
        return docs[keep], tokens[keep]


def _nodes(doc: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, size, set's 64-bit identity) of the texts that have tokens."""
    ids, begin, n = np.unique(doc, return_index=True, return_counts=True)
    if not len(ids):
        return ids, n, np.zeros(0, np.int64)
    t = token.view(np.uint64)
    a = np.add.reduceat(_mix(t ^ np.uint64(0xA5A5A5A55A5A5A5A)), begin)
    b = np.bitwise_xor.reduceat(_mix(t * np.uint64(_MULT)), begin)
    return ids, n, _mix(a + _mix(b + n.astype(np.uint64))).view(np.int64)


def _recurring(held: list[np.ndarray], least: int = LOCAL_MIN) -> tuple[np.ndarray, np.ndarray]:
    """(token, count) of the tokens that occur ``least`` times or more; sorted in place, one copy of them at a time."""
    token, back = np.concatenate(held), least - 1
    held.clear()
    token.sort()
    token, n = np.unique(token[back:][token[back:] == token[:len(token) - back]], return_counts=True)
    return token, (n + back).astype(np.int64)


def _survey(docs: DataFrame, words: int) -> DataFrame:
    """kind 0: doc_id, row (text hash), n, node of every row; kind 1: token and count of recurring tokens."""

    def run(batches):
        shingler = Shingler(words)
        held, size, seen = [], 0, set()
        kind = None

        def recurring():
            nonlocal held, size, seen
            if held:
                token, n = _recurring(held)
                if len(token):
                    yield _batch(1, pa.nulls(len(token), kind), np.zeros(len(token), np.int64), n, token)
            held, size, seen = [], 0, set()

        def _batch(k, ids, rows, n, node):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k, np.int32)), ids, pa.array(rows), pa.array(n),
                                               node if isinstance(node, pa.Array) else pa.array(node)],
                                              ["kind", "doc_id", "row", "n", "node"])

        for batch in batches:
            kind = batch.schema.field(0).type
            count = np.zeros(batch.num_rows, np.int64)
            node = np.zeros(batch.num_rows, np.int64)
            for first, doc, token in shingler.sets(batch.column(2).to_pylist()):
                ids, n, sig = _nodes(doc, token)
                count[first + ids] = n
                node[first + ids] = sig
                new = np.array([s not in seen for s in sig.tolist()], bool)
                seen.update(sig.tolist())
                own = token[np.repeat(new, n)] if len(n) else token
                held.append(own)
                size += len(own)
                if size >= BLOCK_TOKENS:
                    yield from recurring()
            yield _batch(0, batch.column(0), batch.column(1).to_numpy(), count, pa.array(node, mask=count == 0))
        yield from recurring()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(
        run, f"kind int, doc_id {kind}, row long, n long, node long")


def _frequent(survey: DataFrame) -> np.ndarray:
    """The most counted recurring tokens, at most FREQUENT numbers, sorted."""
    top = (survey.filter("kind = 1").groupBy("node").agg(F.sum("n").alias("c"))
           .orderBy(F.desc("c"), "node").limit(FREQUENT).select("node").toArrow())
    return np.sort(top.column(0).to_numpy())


def _need(n):
    """Tokens that a partner of a set of n shares at least."""
    return (PERCENT * n + 99) // 100


def _bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """BITS bits, of which each key (a well mixed long) sets one; of fixed size whatever the input."""
    rows = (keys.select(F.pmod(key, F.lit(BITS)).alias("b")).groupBy(F.shiftright("b", 6).alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("v")).toArrow())
    words = np.zeros(BITS // 64, np.int64)
    words[rows.column("w").to_numpy()] = rows.column("v").to_numpy()
    return words


def _maybe_in(words: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key & (BITS - 1)
    return (words[at >> 6] >> (at & 63)) & 1 == 1


def _low_tokens(docs: DataFrame, frequent: np.ndarray, words: int, wanted: np.ndarray | None = None) -> DataFrame:
    """token, node, n, rare, u, reg, first: a set's first tokens and its tokens in the region, once per node and task.

    The region is the same for all sets: the lowest REGION of all hashes, without frequent tokens, so
    it is complete for every set. rare: tokens that aren't frequent; u: tokens from this one on in the
    common order; reg: tokens in the region, which come first; first: whether a partner could share
    this one as its first. wanted: a bitmap, of which other tokens are left out.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((frequent, wanted))  # FREQUENT numbers and BITS bits at most
    edge = np.int64(-(1 << 63) + int(REGION * (1 << 64)))

    def run(batches):
        shingler, (often, bits), seen = Shingler(words), shared.value, set()
        for batch in batches:
            for _, doc, token in shingler.sets(batch.column(0).to_pylist()):
                ids, n, sig = _nodes(doc, token)
                if not len(ids):
                    continue
                new = np.array([s not in seen for s in sig.tolist()], bool)
                seen.update(sig.tolist())
                if len(seen) > BLOCK_TOKENS:
                    seen = set()
                late = np.zeros(len(token), bool)
                if len(often):
                    late = often[np.minimum(np.searchsorted(often, token), len(often) - 1)] == token
                begin = np.cumsum(n) - n
                index = np.repeat(np.arange(len(ids)), n)
                order = np.lexsort((token, late, index))
                place = np.arange(len(token)) - np.repeat(begin, n)
                rare = np.add.reduceat((~late).astype(np.int64), begin)
                reg = np.add.reduceat((~late & (token < edge)).astype(np.int64), begin)
                prefix = n - _need(n) + 1
                chosen = (place < np.repeat(np.maximum(prefix, reg), n)) & np.repeat(new, n)
                if bits is not None:
                    chosen &= _maybe_in(bits, token[order])
                take, at, who = order[chosen], place[chosen], index[chosen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token[take]), pa.array(sig[who]), pa.array(n[who].astype(np.int32)),
                     pa.array(rare[who].astype(np.int32)), pa.array((n[who] - at).astype(np.int32)),
                     pa.array(reg[who].astype(np.int32)), pa.array(at < prefix[who])],
                    ["token", "node", "n", "rare", "u", "reg", "first"])

    return docs.select("text").mapInArrow(
        run, "token long, node long, n int, rare int, u int, reg int, first boolean")


def _only(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """row, text of one document per text hash in rows (row)."""
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(rows, "row"))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_maybe_in(bits.value, batch.column(0).to_numpy())))

    # the bitmap leaves most texts where they are; the join is exact
    near = docs.select(F.xxhash64("text").alias("row"), "text").mapInArrow(run, "row long, text string")
    return near.join(rows, "row", "left_semi").dropDuplicates(["row"])


def _token_sets(texts: DataFrame, words: int) -> DataFrame:
    """node, tokens array of the texts."""

    def run(batches):
        shingler = Shingler(words)
        for batch in batches:
            for _, doc, token in shingler.sets(batch.column(0).to_pylist()):
                _, n, sig = _nodes(doc, token)
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig), pa.ListArray.from_arrays(pa.array(offsets), pa.array(token))], ["node", "tokens"])

    return texts.select("text").mapInArrow(run, "node long, tokens array<long>")


def _may_link(na: str, ua: str, nb: str, ub: str) -> Column:
    """The size and bound conditions of step 3."""
    return ((F.col(na) * 100 >= F.col(nb) * PERCENT) & (F.col(nb) * 100 >= F.col(na) * PERCENT)
            & ((F.col(na) + F.col(nb)) * PERCENT <= F.least(ua, ub) * (100 + PERCENT)))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """src, dst of the pairs a, b that link, by their whole sets."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (pairs.join(left, "a").join(right, "b")
            .filter(both * 100 >= (F.size("ta") + F.size("tb") - both) * PERCENT)
            .select(F.col("a").alias("src"), F.col("b").alias("dst")))


def link_nodes(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows, links): doc_id, row, n and node of every input row, and links src, dst between nodes.

    The links hold a spanning set: every link between groups, and enough inside groups to connect them.
    """
    small_batches(docs.sparkSession)
    survey = store(_survey(docs, words), "survey", ["kind"])
    rows = survey.filter("kind = 0").select("doc_id", "row", "n", "node")
    frequent = _frequent(survey)
    recurring = store(_low_tokens(docs, frequent, words).groupBy("token").agg(F.count(F.lit(1)).alias("c"))
                      .filter("c > 1").select("token"), "recurring")
    low = _low_tokens(docs, frequent, words, _bitmap(recurring, "token"))
    kept = store(low.join(recurring, "token", "left_semi").distinct(), "low")
    # of those, tokens that two different nodes have; copies in other tasks were counted above
    shared = (kept.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi")
              .select("token"))
    kept = store(kept.join(shared, "token", "left_semi"), "shared")
    # tokens of the region that no other node has are in no partner
    bound = kept.groupBy("node").agg((F.max("n") - F.max("reg") + F.count_if(F.col("n") - F.col("u") < F.col("reg")))
                                     .cast("int").alias("most"))
    matrix = store(kept.filter("first").join(bound, "node").select(
        "token", "node", "n", "rare", F.least("u", "most").alias("u")), "matrix")
    lead = matrix.groupBy("token").agg(F.min(F.struct("rare", "node", "n", "u")).alias("l"),
                                       F.min("n").alias("n_min"), F.max("n").alias("n_max"))
    led = store(matrix.join(lead, "token"), "led")
    stars = (led.filter(F.col("node") != F.col("l.node"))
             .select(F.col("node").alias("a"), F.col("l.node").alias("b"), "n", "u", F.col("l.n").alias("nb"),
                     F.col("l.u").alias("ub"))
             .filter(_may_link("n", "u", "nb", "ub")).select("a", "b").distinct())
    # nodes that some size among the token's nodes, within reach of theirs, still suits
    least = F.greatest(F.col("n_min"), F.ceil(F.col("n") * PERCENT / 100).cast("int"))
    alive = store(led.filter((least <= F.col("n_max")) & ((F.col("n") + least) * PERCENT <= F.col("u") * (100 + PERCENT)))
                  .select("node").distinct(), "alive")
    wanted = rows.join(alive, "node", "left_semi").groupBy("node").agg(F.min("row").alias("row")).select("row")
    sets = store(_token_sets(_only(docs, store(wanted, "wanted")), words), "sets")
    links = store(_verified(stars, sets), "links")
    groups = store(connected_components(links), "groups")

    member = (matrix.join(alive, "node", "left_semi").join(groups, "node", "left")
              .withColumn("g", F.coalesce("component", "node")).drop("component"))
    member = store(member, "member")  # token, node, n, rare, u, g
    # two groups that share a token, in the best case of any of their nodes; the one with fewer nodes there opens the other
    union = member.groupBy("token", "g").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("n_min"),
                                             F.max("n").alias("n_max"), F.max("u").alias("u_max"))
    other = union.toDF("token", "other", "m_o", "n_min_o", "n_max_o", "u_max_o")
    facing = union.join(other, "token").filter(
        (F.struct("m", "g") < F.struct(F.col("m_o").alias("m"), F.col("other").alias("g")))
        & (F.col("n_max") * 100 >= F.col("n_min_o") * PERCENT) & (F.col("n_max_o") * 100 >= F.col("n_min") * PERCENT)
        & ((F.col("n_min") + F.col("n_min_o")) * PERCENT <= F.least("u_max", "u_max_o") * (100 + PERCENT)))
    # and each of its nodes against that group
    opened = (member.join(facing.select("token", "g", "other", "n_min_o", "n_max_o", "u_max_o"), ["token", "g"]).filter(
        (F.col("n") * 100 >= F.col("n_min_o") * PERCENT) & (F.col("n_max_o") * 100 >= F.col("n") * PERCENT)
        & ((F.col("n") + F.col("n_min_o")) * PERCENT <= F.least("u", "u_max_o") * (100 + PERCENT)))
        .select("token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("u").alias("ua"), "other"))
    inside = member.select("token", F.col("g").alias("other"), F.col("node").alias("b"), F.col("n").alias("nb"),
                           F.col("u").alias("ub"))
    pairs = (opened.join(inside, ["token", "other"]).filter(_may_link("na", "ua", "nb", "ub"))
             .select("a", "b").distinct())
    across = store(_verified(pairs, sets), "across")
    return rows, links.unionByName(across)


def jaccard_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, row, n_shingles, component_id of every row."""
    rows, links = link_nodes(docs, words)
    parts = connected_components(links)
    known = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    known = store(known.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")), "nodes")
    ids = known.groupBy("component").agg(F.min("low").alias("component_id"))
    named = known.join(ids, "component").select("node", "component_id")
    return (rows.join(named, "node", "left")
            .select("doc_id", "row", F.col("n").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One document of each component (its smallest doc_id); documents without shingles stay.

    Of rows that share the smallest doc_id, those with the smallest text hash stay once.
    """
    found = jaccard_components(docs, words).withColumn("_jj_id", F.xxhash64("doc_id"))
    chosen = (found.filter("n_shingles > 0").groupBy("component_id").agg(F.min(F.when(
        F.col("doc_id").eqNullSafe(F.col("component_id")), F.col("row"))).alias("_jj_row"))
              .select("_jj_row", F.xxhash64("component_id").alias("_jj_id")))
    empty = found.filter("n_shingles = 0").select(F.col("row").alias("_jj_row"), "_jj_id").distinct()
    key = ["_jj_row", "_jj_id"]
    # joined and made distinct by one key, so that texts are dealt out once
    return (docs.withColumns({"_jj_row": F.xxhash64("text"), "_jj_id": F.xxhash64("doc_id")})
            .join(chosen.unionByName(empty), key).dropDuplicates(key).select(*[F.col(f"`{c}`") for c in docs.columns]))

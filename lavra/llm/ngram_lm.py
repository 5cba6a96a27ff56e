"""Quality classifier: interpolated modified Kneser-Ney n-grams over characters.

One model per stratum, trained on all trusted text: documents labelled quality
1 and not toxic. Strata are the declared languages, every other language that
has ``min_trusted`` trusted documents, and one for all that is left. Symbols
are all lower-cased characters (digits as one) and one for the start, so the
n-grams grow with the text; none is left out, and no task holds them all.

Texts are packed into blocks of about ``BLOCK`` characters, compressed and
stored. A block's distinct n-grams, with their counts in its trusted documents,
are summed in shards of (stratum, n-gram). Lower orders use continuation counts
(distinct left neighbours), the discounts D1, D2, D3+ come from the counts of
counts of each order, and the probability of each n-gram that any document
holds comes from its context's totals and the shorter n-gram's probability,
joined in shards of (stratum, context) and (stratum, n-gram). Each block then
gets the probabilities of its own distinct n-grams, and its documents are
scored with them: what moves are packed blocks and distinct n-grams a block,
not every n-gram of every document. Under the lowest order all characters that
the stratum's documents hold, and one more, are equally likely.

A document's perplexity is compared with a quantile of the perplexities of its
stratum's trusted documents.

Defined cases: null or empty text has no perplexity and is rejected; a null
language, or an undeclared one with fewer than ``min_trusted`` trusted
documents, is scored in stratum ``other``; a stratum with fewer than
``min_trusted`` trusted documents rejects nothing but empty text; conflicting
labels of one doc_id count as not trusted; repeated rows are scored alike; very
long texts are read in segments that carry their left context; empty tables
give empty results; only the columns named here are read.
"""

from __future__ import annotations

import bz2
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lavra.llm.common import LANGUAGES, OTHER, small_batches, store, stratum

ORDER = 4
QUANTILE = 0.99
MARGIN = 1.15
MIN_TRUSTED = 20
SEGMENT = 1 << 20
BLOCK = 1 << 24
BITS = 21  # of a symbol: code points, and the start after the last of them
START = 0x110000
SYMBOL = (1 << BITS) - 1


def _segments(text: str, context: int) -> Iterator[tuple[str, int]]:
    """(segment with its left context, symbols of context) of a whole text."""
    for at in range(0, len(text), SEGMENT):
        back = min(at, context)
        yield text[at - back:at + SEGMENT], back


def _grams(text: str | None, order: int) -> Iterator[np.ndarray]:
    """Per segment of a text, a row of packed contexts and one of the symbols that follow them."""
    for part, back in _segments((text or "").lower(), order - 1):
        symbols = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        symbols[(symbols >= 48) & (symbols < 58)] = 48
        if back < order - 1:  # the text's start
            symbols = np.concatenate([np.full(order - 1 - back, START), symbols])
        n = len(symbols) - order + 1
        ctx = np.zeros(n, np.int64)
        for k in range(order - 1):
            ctx = (ctx << BITS) | symbols[k:k + n]
        yield np.stack([ctx, symbols[order - 1:]])


class Pool:
    """Collects arrays per key and hands them over joined, a bounded number of entries at a time."""

    def __init__(self, take):
        self.take, self.held, self.size = take, {}, {}

    def add(self, s, values: np.ndarray) -> None:
        self.held.setdefault(s, []).append(values)
        self.size[s] = self.size.get(s, 0) + values.shape[-1]
        if self.size[s] >= SEGMENT:
            self.flush(s)
        elif sum(self.size.values()) >= 4 * SEGMENT:
            self.close()

    def flush(self, s) -> None:
        if self.held.get(s):
            self.take(s, np.concatenate(self.held.pop(s), axis=-1))
        self.size[s] = 0

    def close(self) -> None:
        for s in list(self.held):
            self.flush(s)


def _store(df: DataFrame, name: str) -> DataFrame:
    """A stored table; its shuffle files go once it is written, as nothing reads them again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return store(df, name)
    finally:
        conf.set(key, before)


def pack_blocks(docs: DataFrame, known: list[str]) -> DataFrame:
    """block, ids (distinct), rows: doc_id, row_id, stratum and text of a block's rows, compressed."""

    def pack(batches):
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            table = pa.Table.from_batches(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            ids = table.column("doc_id").unique().drop_null()
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | n], pa.int64()), pa.array([ids.to_pylist()], pa.list_(ids.type)),
                 pa.array([bz2.compress(sink.getvalue())], pa.binary())], ["block", "ids", "rows"])

        for batch in batches:
            held.append(batch)
            size += batch.column(3).nbytes
            if size >= BLOCK:
                yield block()
                n, held, size = n + 1, [], 0
        if size or held:
            yield block()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("row_id"), stratum(F.col("lang"), known).alias("stratum"), "text"
                       ).mapInArrow(pack, f"block long, ids array<{kind}>, rows binary")


def _rows(blocks: pa.Table) -> Iterator[pa.RecordBatch]:
    for rows in blocks.column("rows"):
        yield from pa.ipc.open_stream(bz2.decompress(rows.as_buffer()))


def _tally(ctx: np.ndarray, sym: np.ndarray, n: np.ndarray | None = None) -> tuple:
    """Distinct (context, symbol) and the sum of n, or how often they occur."""
    contexts = np.unique(ctx)
    key = (np.searchsorted(contexts, ctx) << BITS) | sym
    if n is None:
        key, n = np.unique(key, return_counts=True)
    else:
        key, at = np.unique(key, return_inverse=True)
        n = np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)
    return contexts[key >> BITS], key & SYMBOL, n


def gram_counts(blocks: DataFrame, trusted: DataFrame, order: int) -> DataFrame:
    """block, stratum, ctx, sym, c of each block's distinct n-grams; c: count in its trusted documents, or 0."""

    def count(packed: pa.Table, ids: pa.Table) -> pa.Table:
        good, sums = set(ids.column("doc_id").to_pylist()), {}

        def take(key, grams):
            ctx, sym, n = _tally(*grams)
            sums.setdefault(key[0], []).append((ctx, sym, n * key[1]))

        pool = Pool(take)
        for batch in _rows(packed):
            for doc, s, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                for grams in _grams(text, order):
                    pool.add((s, int(doc in good)), grams)
        pool.close()
        out = []
        for s, parts in sums.items():
            ctx, sym, n = _tally(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            out.append(pa.table([pa.array(np.repeat(packed.column("block")[0].as_py(), len(n)), pa.int64()),
                                 pa.array([s] * len(n), pa.string()), pa.array(ctx), pa.array(sym), pa.array(n)],
                                schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    schema = pa.schema([("block", pa.int64()), ("stratum", pa.string()), ("ctx", pa.int64()), ("sym", pa.int64()),
                        ("c", pa.int64())])
    return blocks.select("block", "rows").groupBy("block").cogroup(trusted.groupBy("of")).applyInArrow(
        count, "block long, stratum string, ctx long, sym long, c long")


def _discounts(grams: DataFrame) -> DataFrame:
    """stratum, d1, d2, d3 of modified Kneser-Ney from the counts of counts; a row per stratum."""
    n = [F.count_if(F.col("c") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def d(k: int, fallback: float):
        est = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        return F.when((F.col(f"n{k}") > 0) & (F.col("n1") > 0), F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), est))
                      ).otherwise(F.lit(fallback)).alias(f"d{k}")

    return grams.groupBy("stratum").agg(*n).select("stratum", d(1, 0.5), d(2, 1.0), d(3, 1.5))


def train(counts: DataFrame, order: int = ORDER, size: int | None = None) -> DataFrame:
    """stratum, ctx, sym, logp: log probability of every n-gram of the highest order that is in a document.

    size: number of symbols that are equally likely under the lowest order.
    """
    levels = [_store(counts.groupBy("stratum", "ctx", "sym").agg(F.sum("c").alias("c")), "grams")]
    for level in range(order - 1, 0, -1):  # continuation counts: distinct symbols before the shorter n-gram
        levels.append(_store(levels[-1].groupBy("stratum", _last(level), "sym")
                            .agg(F.count_if(F.col("c") > 0).alias("c")), "grams"))
    lowest = levels[-1].groupBy("stratum").agg(
        (F.lit(1.0) / (F.lit(size) if size else F.count(F.lit(1)) + 1)).alias("lower"))
    out = None
    for level, grams in enumerate(reversed(levels), 1):
        by = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        within = W.partitionBy("stratum", "ctx")  # at most a row per character
        rows = (grams.join(F.broadcast(_discounts(grams.filter("c > 0"))), "stratum", "left")  # a row per stratum
                .withColumn("d", F.when(F.col("c") > 0, F.least(by, F.col("c"))).otherwise(F.lit(0.0)))
                .withColumn("total", F.sum("c").over(within)).withColumn("held", F.sum("d").over(within)))
        rows = (rows.join(F.broadcast(lowest), "stratum") if out is None else
                rows.withColumn("_short", _last(level - 1)).join(out, ["stratum", "_short", "sym"]))
        p = F.when(F.col("total") > 0, (F.col("c") - F.col("d") + F.col("held") * F.col("lower")) / F.col("total")
                   ).otherwise(F.col("lower"))
        out = rows.select("stratum", "ctx", "sym", p.alias("p"))
        if level < order:
            out = _store(out, "model").select("stratum", F.col("ctx").alias("_short"), "sym", F.col("p").alias("lower"))
    return out.select("stratum", "ctx", "sym", F.log(F.greatest("p", F.lit(1e-12))).cast("float").alias("logp"))


def _last(level: int):
    """The context of an n-gram's last ``level`` symbols."""
    return F.col("ctx").bitwiseAND(F.lit((1 << BITS * (level - 1)) - 1).cast("long")).alias("ctx")


def score(blocks: DataFrame, counts: DataFrame, model: DataFrame, kind: str, order: int = ORDER) -> DataFrame:
    """doc_id, stratum, row_id, n_symbols, perplexity (null without symbols) of every row."""

    def run(packed: pa.Table, known: pa.Table) -> pa.Table:
        strata, models = np.asarray(known.column("stratum").to_pylist(), dtype=object), {}
        ctx, sym, logp = (known.column(c).to_numpy() for c in ("ctx", "sym", "logp"))
        for s in set(strata):
            at = np.flatnonzero(strata == s)
            contexts = np.unique(ctx[at])
            key = (np.searchsorted(contexts, ctx[at]) << BITS) | sym[at]
            by = np.argsort(key)
            models[s] = contexts, key[by], logp[at][by]
        out = []
        for batch in _rows(packed):
            n, ppl = [], []
            for s, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                total, count = 0.0, 0
                for c, w in _grams(text, order):
                    contexts, key, value = models[s]
                    total += float(value[np.searchsorted(key, (np.searchsorted(contexts, c) << BITS) | w)]
                                   .sum(dtype=np.float64))
                    count += len(w)
                n.append(count)
                ppl.append(float(np.exp(-total / count)) if count else None)
            out.append(pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(1), pa.array(n, pa.int64()), pa.array(ppl, pa.float64())],
                ["doc_id", "stratum", "row_id", "n_symbols", "perplexity"]))
        return pa.Table.from_batches(out)

    known = counts.select("block", "stratum", "ctx", "sym").join(model, ["stratum", "ctx", "sym"])
    return blocks.select("block", "rows").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        run, f"doc_id {kind}, stratum string, row_id long, n_symbols long, perplexity double")


def trusted_ids(labels: DataFrame) -> DataFrame:
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    return (labels.filter("doc_id is not null").groupBy("doc_id")
            .agg(F.min(F.coalesce(F.col("quality"), F.lit(0))).alias("q"), F.max(toxic).alias("t"))
            .filter("q = 1 and t = 0").select("doc_id"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN,
             order: int = ORDER, size: int | None = None, min_trusted: int = MIN_TRUSTED) -> DataFrame:
    """doc_id, row_id, stratum, n_symbols, perplexity, limit, kept of every row.

    limit: the quantile of the trusted documents' perplexities in the stratum, times margin.
    """
    if not 1 <= order <= 4:
        raise ValueError("a context of more than three symbols doesn't fit its 63 bits")
    small_batches(docs.sparkSession)
    trust = _store(trusted_ids(labels), "trusted")
    # merged, not broadcast while the labels are few: one plan whatever the size
    labelled = (docs.filter("lang is not null").select("doc_id", "lang").distinct()
                .join(trust.hint("merge"), "doc_id", "left_semi").groupBy("lang").count())
    known = sorted({*LANGUAGES, *(r["lang"] for r in labelled.filter(F.col("count") >= min_trusted).collect())} - {OTHER})
    blocks = _store(pack_blocks(docs, known), "blocks")
    trusted = blocks.select(F.col("block").alias("of"), F.explode("ids").alias("doc_id")).join(trust.hint("merge"), "doc_id", "left_semi")
    counts = _store(gram_counts(blocks, trusted, order), "block-grams")
    model = _store(train(counts, order, size), "model")
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = _store(score(blocks, counts, model, kind, order), "scores")
    limits = (scored.filter("perplexity is not null").join(trust, "doc_id", "left_semi").groupBy("stratum")
              .agg((F.percentile_approx("perplexity", quantile, 10_000) * margin).alias("limit"),
                   F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_trusted).select("stratum", "limit"))
    return (scored.join(F.broadcast(limits), "stratum", "left")  # a row per language with labels
            .withColumn("kept", F.col("perplexity").isNotNull()
                        & F.coalesce(F.col("perplexity") <= F.col("limit"), F.lit(True))))


def keep_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier keeps, with the same columns."""
    bad = (classify(docs, labels, **options).filter(~F.col("kept"))
           .select(F.col("doc_id").alias("_lm_doc"), F.col("row_id").alias("_lm_row")).distinct().hint("merge"))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_lm_doc"))
                     & (F.xxhash64("text") == F.col("_lm_row")), "left_anti")

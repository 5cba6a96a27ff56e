"""Line dedup over repeated line runs (native DataFrame functions only).

A document is the sequence of its lines that hold a word, each line known by
an ID. Prefix doubling names the run of 2^k lines at every position by the
pair of names of its two halves, level by level; equal names are equal runs,
so the positions that share a name are one interval of the suffix array whose
longest common prefix is at least 2^k lines. Names are hashes of the pair,
which needs no ranking shuffle between the levels: the intervals are what
counts here, their order is not used. A run of m lines is named by (m, name of
its first 2^k, name of its last 2^k lines).

Only runs of at least ``min_words`` words are deleted. A line goes if some run
of at least that many words that covers it also occurs at an earlier position
(doc_id, then line). Every such run is covered by minimal ones: from each of
its lines forward, and from its last line backward, the fewest lines that
reach ``min_words``. So each position names its two minimal runs, the first
position of every name is found by one pre-aggregated shuffle, and later
copies are deleted. Doubling ends at the longest minimal run, at most
log2(min_words) levels, however long the documents are.

Defined cases: null text has no lines and stays null; lines without a word are
never deleted and not part of runs; rows that share a doc_id count as one
position in the order, so they don't delete each other; a null doc_id comes
last; a document whose worded lines are all deleted is dropped by
``dedup_lines(..., drop_emptied=True)``; extra columns are kept as they are;
empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import store, words

MIN_WORDS = 50
_LAST = 2**63 - 1
_RUN = "_lr_"  # prefix of working columns, so that callers' columns can't clash


def _c(name: str) -> str:
    return _RUN + name


def _power_at_most(n: Column, levels: int) -> Column:
    """floor(log2(n)) for 1 <= n < 2^(levels+1)."""
    out = F.lit(0)
    for k in range(1, levels + 1):
        out = F.when(n >= 2**k, F.lit(k)).otherwise(out)
    return out


def run_names(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row the minimal runs of at least min_words words: struct(key, first, last), in worded lines.

    Input: ``_lr_lines``, the worded lines of the row.
    """
    levels = max(0, min_words.bit_length() - 1)
    df = rows.withColumn(_c("id0"), F.transform(_c("lines"), lambda x: F.xxhash64(x)))
    df = df.withColumn(_c("nw"), F.transform(_c("lines"), lambda x: F.size(words(x))))

    def doubled(prev: str, half: int) -> Column:
        return F.transform(F.slice(prev, 1, F.greatest(F.size(prev) - half, F.lit(0))),
                           lambda x, i: F.xxhash64(x, F.get(prev, i + half)))

    for k in range(1, levels + 1):  # 2^k lines from two halves
        df = df.withColumn(_c(f"id{k}"), doubled(_c(f"id{k - 1}"), 2 ** (k - 1)))
    steps = min_words  # a minimal run of worded lines has at most min_words lines

    def reach(back: bool):
        """Lines of the minimal run from i on (or back), or null."""
        def at(x, i):
            take = F.when(F.lit(back), F.reverse(F.slice(
                _c("nw"), F.greatest(i - steps + 2, F.lit(1)), F.least(i + 1, F.lit(steps))))).otherwise(
                F.slice(_c("nw"), i + 1, F.lit(steps)))
            acc = F.aggregate(take, F.struct(F.lit(0).alias("w"), F.lit(0).alias("m")),
                              lambda a, v: F.when(a["w"] >= min_words, a).otherwise(
                                  F.struct((a["w"] + v).alias("w"), (a["m"] + 1).alias("m"))),
                              lambda a: F.when(a["w"] >= min_words, a["m"]))
            return F.when(x >= min_words, F.lit(1)).otherwise(acc)
        return F.transform(_c("nw"), at)

    df = df.withColumn(_c("fwd"), reach(False)).withColumn(_c("bwd"), reach(True))

    df = df.withColumn(_c("ids"), F.array(*[_c(f"id{k}") for k in range(levels + 1)]))
    power = F.array(*[F.lit(2**k) for k in range(levels + 1)])

    def name(first: Column, m: Column) -> Column:
        k = F.length(F.bin(m)) - 1  # of the largest power of two in m
        at_level = F.get(_c("ids"), k)
        return F.struct(F.xxhash64(m, F.get(at_level, first), F.get(at_level, first + m - F.get(power, k))).alias("key"),
                        first.cast("int").alias("first"), (first + m - 1).cast("int").alias("last"))

    # a backward run that is some line's forward run too is listed once
    df = df.withColumn(_c("bwd"), F.transform(_c("bwd"), lambda m, i: F.when(
        ~F.coalesce(F.get(_c("fwd"), i - m + 1) == m, F.lit(False)), m)))
    df = df.withColumn(_c("f"), F.transform(_c("fwd"), lambda m, i: F.when(m.isNotNull(), name(i, m))))
    df = df.withColumn(_c("b"), F.transform(_c("bwd"), lambda m, i: F.when(m.isNotNull(), name(i - m + 1, m))))
    return df.withColumn(_c("runs"), F.filter(F.concat(_c("f"), _c("b")), lambda r: r.isNotNull()))


def _worded(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, row_id and the worded lines (0-based numbers) to delete, for rows that lose any.

    row_id tells rows with one doc_id apart by their text.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("row_id"), _worded(F.col("text")).alias(_c("lines")))
    # a position as one number: doc_id, then line; null doc_id last
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).cast("decimal(19,0)")
    # explode_outer: for explode, Catalyst writes size(runs) > 0 out below every step of run_names
    runs = run_names(rows, min_words).select("doc_id", "row_id", F.explode_outer(_c("runs")).alias("r")).select(
        "doc_id", "row_id", F.col("r.key").alias("key"), F.col("r.first").alias("first"),
        F.col("r.last").alias("last"),
        (order * F.lit(10**12).cast("decimal(13,0)") + F.col("r.first")).cast("decimal(38,0)").alias("at"))
    runs = store(runs.filter("key is not null"), "runs")
    first = (runs.groupBy("key").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
             .filter("first_at < last_at").select("key", "first_at"))
    copies = runs.join(first, "key").filter("at > first_at")
    return (copies.groupBy("doc_id", "row_id")
            .agg(F.collect_set(F.struct("first", "last")).alias("_r"))
            .select("doc_id", "row_id", F.array_distinct(F.flatten(F.transform(
                "_r", lambda r: F.sequence(r["first"], r["last"])))).alias("deleted")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = False) -> DataFrame:
    """The documents with later copies of repeated line runs deleted; other columns unchanged.

    Adds n_lines_deleted. ``n_chars``, where there is one, follows the text.
    With drop_emptied, rows that lose all their worded lines are dropped.
    """
    gone = later_copies(docs, min_words).withColumnsRenamed(
        {"doc_id": _c("doc"), "row_id": _c("row"), "deleted": _c("gone")})
    cut = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(_c("doc")))
                    & (F.xxhash64("text") == F.col(_c("row"))), "left")
    cut = cut.withColumn(_c("all"), F.when(F.col(_c("gone")).isNotNull(), F.split("text", "\n")))
    cut = cut.withColumn(_c("worded"), F.filter(
        F.transform(_c("all"), lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), i)), lambda i: i.isNotNull()))
    cut = cut.withColumn(_c("cut"), F.transform(_c("gone"), lambda j: F.get(_c("worded"), j)))
    cut = cut.withColumn(_c("left"), F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(_c("all")) - 1), F.col(_c("cut"))),
        lambda i: F.get(_c("all"), i)), "\n"))
    lost = F.coalesce(F.size(_c("gone")), F.lit(0))
    lost = F.when(F.col(_c("gone")).isNull(), F.lit(0)).otherwise(lost)
    if drop_emptied:
        cut = cut.filter(F.col(_c("gone")).isNull() | (F.size(_c("gone")) < F.size(_c("worded"))))
    text = F.when(F.col(_c("gone")).isNull(), F.col("text")).otherwise(F.col(_c("left")))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(text.alias("text"))
        elif c == "n_chars":
            out.append(F.when(F.col(_c("gone")).isNull(), F.col("n_chars")).otherwise(
                F.char_length(F.col(_c("left"))).cast(docs.schema["n_chars"].dataType)).alias("n_chars"))
        else:
            out.append(F.col(f"`{c}`"))
    return cut.select(*out, lost.cast("long").alias(_c("n_deleted")))

"""Quality rules with risk-controlled cutoffs (native DataFrame functions only).

``text_features`` measures every whole text. ``fit_cutoffs`` reads labelled
good documents as a holdout: each rule has a declared sequence of cutoffs from
lenient to strict, tested in that order per stratum. A cutoff is accepted while
the exact binomial tail P(X <= k | n, limit) stays at or under the level, where
k of the n good documents would be rejected; that is the same as the
Clopper-Pearson upper bound of the false-rejection rate being at most the
limit. The total limit is split over the rules and the error level over all
(stratum, rule) tests (Bonferroni); along one sequence testing stops at the
first failure, so it needs no further correction. With probability of at least
``1 - delta`` no stratum loses more than ``max_false_rejection`` of its good
documents to all rules together.

Defined cases: a null or blank text has no words and fails the base rule; a
document with a null or undeclared language is judged in stratum ``other``; a
stratum with too few labels gets no cutoff and rejects nothing beyond the base
rule; repeated rows are judged alike, row by row; conflicting labels of one
doc_id count as not good; only the columns named here are read, so extra
columns don't matter; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import OTHER, LANGUAGES, store, stratum, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
MAX_FALSE_REJECTION = 0.05
DELTA = 0.05


@dataclass(frozen=True)
class Rule:
    """Rejects where the feature is at or beyond the cutoff, on one side."""

    name: str
    feature: str
    above: bool
    cutoffs: tuple[float, ...]  # lenient first

    def rejects(self, cutoff) -> Column:
        c = F.lit(cutoff) if not isinstance(cutoff, Column) else cutoff
        f = F.col(self.feature)
        return (f >= c) if self.above else (f <= c)


RULES = (
    Rule("symbols", "symbols_per_word", True,
         (8.0, 4.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)),
    Rule("repeats", "repeat_share", True,
         (0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.04, 0.02)),
    Rule("dup_lines", "dup_line_share", True,
         (0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    Rule("long_words", "mean_word_chars", True,
         (40.0, 30.0, 24.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0, 9.0, 8.0)),
    Rule("short_words", "mean_word_chars", False,
         (1.0, 1.5, 2.0, 2.5, 3.0, 3.25, 3.5, 3.75, 4.0)),
)


def text_features(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, stratum and the counts of every whole text, one row per row.

    Windows are compared by a 64-bit hash of their words; sorting the hashes
    inside the row finds repeated windows without a shuffle, in n log n.
    """
    df = docs.select("doc_id", stratum(F.col("lang")).alias("stratum"),
                     F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    df = df.withColumn("_words", words(F.col("_text")))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"),
                                          lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.select(
        "doc_id", "stratum",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda x: F.xxhash64(x)).alias("_hash"))
    n = F.size("_hash")
    df = df.withColumn("_win", F.when(n >= window, F.transform(
        F.sequence(F.lit(0), F.greatest(n - window, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("_hash", i + k) for k in range(window)]))))
    df = df.withColumn("_sorted", F.when(
        F.size("_win") > F.size(F.array_distinct("_win")),
        F.array_sort(F.transform("_win", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    at = lambda i: F.get("_sorted", i)["h"]
    df = df.withColumn("_hits", F.when(F.col("_sorted").isNotNull(), F.sort_array(F.transform(
        F.filter("_sorted", lambda p, i: (F.coalesce(F.when(i > 0, at(i - 1)) == p["h"], F.lit(False))
                                          | F.coalesce(at(i + 1) == p["h"], F.lit(False)))),
        lambda p: p["i"]))))
    covered = F.aggregate(
        F.transform("_hits", lambda x, i: F.least(
            F.lit(window), F.coalesce(F.get("_hits", i + 1) - x, F.lit(window)))),
        F.lit(0), lambda acc, x: acc + x)
    return df.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_lines",
                     "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def with_ratios(features: DataFrame) -> DataFrame:
    nw = F.greatest(F.col("n_words"), F.lit(1))
    return features.withColumns({
        "base_failed": ((F.col("n_words") < MIN_WORDS)
                        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)),
        "symbols_per_word": F.col("n_symbols") / nw,
        "repeat_share": F.col("n_repeat_words") / nw,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "mean_word_chars": F.col("word_chars") / nw,
    })


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), exactly summed in log space; 1 from k = np on."""
    step = F.struct((n * F.log(F.lit(1 - p))).alias("l"), F.exp(n * F.log(F.lit(1 - p))).alias("s"))
    odds = F.log(F.lit(p / (1 - p)))

    def add(acc, i):
        l = acc["l"] + F.log((n - i + 1) / i) + odds  # noqa: E741
        return F.struct(l.alias("l"), (acc["s"] + F.exp(l)).alias("s"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1)))).otherwise(
        F.array().cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(
        F.aggregate(terms, step, add, lambda acc: acc["s"]))


def fit_cutoffs(features: DataFrame, labels: DataFrame, rules=RULES,
                max_false_rejection: float = MAX_FALSE_REJECTION, delta: float = DELTA) -> DataFrame:
    """One row per stratum with labels: stratum, and a cutoff per rule (null: none accepted).

    At most one row per declared stratum, whatever the input's size.
    """
    limit, level = max_false_rejection / len(rules), delta / (len(rules) * (len(LANGUAGES) + 1))
    good = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.min(F.coalesce(F.col("quality"), F.lit(0))).alias("_good"))
            .filter("_good = 1").select("doc_id"))
    held = with_ratios(features).filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    counts = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(r.rejects(c).cast("long")).alias(f"k_{r.name}_{i}")
          for r in rules for i, c in enumerate(r.cutoffs)])

    tested = counts.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(i).alias("i"), F.lit(float(c)).alias("cutoff"),
                 F.col(f"k_{r.name}_{i}").alias("k")) for r in rules for i, c in enumerate(r.cutoffs)])).alias("t"))
    tested = tested.select("stratum", "n", "t.*").withColumn(
        "ok", binomial_tail(F.col("k"), F.col("n"), limit) <= level)
    # the last cutoff before the first that failed
    per_rule = tested.groupBy("stratum", "n", "rule").agg(
        F.min(F.when(~F.col("ok"), F.col("i"))).alias("fail"), F.max("i").alias("last"),
        F.map_from_entries(F.collect_list(F.struct("i", "cutoff"))).alias("cutoffs"))
    per_rule = per_rule.withColumn(
        "cutoff", F.col("cutoffs")[F.coalesce(F.col("fail"), F.col("last") + 1) - 1])
    return per_rule.groupBy("stratum", F.col("n").alias("n_holdout")).agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cut_{r.name}") for r in rules])


def judge(features: DataFrame, cutoffs: DataFrame, rules=RULES) -> DataFrame:
    """Features with base_failed, kept and the first rule that rejects.

    The cutoffs have at most one row per declared stratum, so they are broadcast.
    """
    rated = with_ratios(features).join(F.broadcast(cutoffs), "stratum", "left")
    first = F.coalesce(*[F.when(r.rejects(F.col(f"cut_{r.name}")), F.lit(r.name)) for r in rules])
    rejected_by = F.when(F.col("base_failed"), F.lit("base")).otherwise(first)
    return rated.withColumn("rejected_by", rejected_by).withColumn("kept", F.col("rejected_by").isNull())


def quality_rules(docs: DataFrame, labels: DataFrame, rules=RULES,
                  max_false_rejection: float = MAX_FALSE_REJECTION, delta: float = DELTA) -> DataFrame:
    """Judge every document: its counts, base_failed, kept, rejected_by, stratum.

    The counts are stored once in the shared folder; fitting and judging read them back.
    """
    features = store(text_features(docs), "features")
    cutoffs = fit_cutoffs(features, labels, rules, max_false_rejection, delta)
    return judge(features, cutoffs, rules)


__all__ = ["OTHER", "RULES", "Rule", "binomial_tail", "fit_cutoffs", "judge", "quality_rules", "text_features"]

"""Spelling variant grouping: words one edit apart, found by asymmetric q-chunks.

Two words are near if exactly one inserted, deleted or replaced code point
parts them. A word of length m contributes two disjoint chunks, its halves: one
edit touches only one of them, so the other is a positional gram of the near
word, at the same place if the edit comes after it, and moved by the difference
in length, one at most, if the edit comes before it. The longer word (either, if
they are equally long) contributes all its positional grams that can be such a
chunk of a word of its own length or one less. Chunks and grams are joined on
their text, place and length of the chunk's word, and each pair is verified.

Halves alone are common (a prefix of three letters is in thousands of words),
so the half that the edit is in is cut in two again by the same argument, and
the chunk that stays there is part of the key: a word has 2 ** LEVELS keys, each
the word without one window that the edit lies in.

A word's form is its near word of largest count if that is at least RATIO times
its own. A form's count grows by that factor with every step, so there are no
cycles and few steps; roots are found by doubling, in joins.

Words are counted where they are read and pre-aggregated before the shuffle, so
a word that is a third of all words is one row per task. No list of a key's
words is ever built: joins on a common key can be split.

Defined cases: null texts have no words; a null doc_id reads as an empty one; a
form's ties go to the smallest word in code-point order; repeated rows count
again; very long texts and words are read whole; empty tables give empty
results; other columns than doc_id and text aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import store

RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
LEVELS = 2


def corpus_words(docs: DataFrame, erased_every: int | None = 31, min_length: int = MIN_LENGTH,
                 min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the words of all texts that have enough code points and occurrences.

    erased_every: of the (document, word) pairs whose CRC-32 it divides, one code
    point of the word is deleted, at a place drawn by the same CRC-32 (misspellings
    planted by rule); None leaves all words as they are.
    """
    # a maximal run that is too short can't give a word, so it isn't matched; a run of the class that is long enough is
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run"))
    word = F.translate("run", UPPER, LOWER)
    if erased_every:
        mark = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
        runs = runs.select(word.alias("run"), mark.alias("h"))
        at = F.pmod("h", F.length("run")).cast("int")
        word = F.when(F.col("h") % erased_every == 0, F.concat(
            F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def _windows(lo: Column, hi: Column, levels: int) -> list[tuple[Column, Column]]:
    """Windows [start, end) that the edit may lie in, after so many halvings."""
    if not levels:
        return [(lo, hi)]
    mid = F.floor((lo + hi) / 2).cast("int")
    return _windows(lo, mid, levels - 1) + _windows(mid, hi, levels - 1)


def _keys(words: DataFrame, shift: int, levels: int) -> DataFrame:
    """word, n, m, w, key: a word's chunks (shift 0), or its grams that are chunks of words shorter by shift."""
    m = F.length("word") - F.lit(shift)
    rows = words.withColumn("m", m).select("word", "n", "m", F.posexplode(F.array(*[
        F.struct(s.alias("s"), e.alias("e")) for s, e in _windows(F.lit(0), F.col("m"), levels)])).alias("w", "at"))
    return rows.select("word", "n", "m", "w", F.concat(
        F.substring("word", F.lit(1), F.col("at.s")), F.lit("|"),
        F.substring("word", F.col("at.e") + shift + 1, F.col("m") - F.col("at.e"))).alias("key"))


def near_words(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """word, n, near, near_n: every word with every near word of the table, in both directions."""
    chunks = _keys(words, 0, levels).withColumnsRenamed({"word": "a", "n": "a_n"})
    grams = _keys(words, 0, levels).unionByName(_keys(words, 1, levels)).withColumnsRenamed({"word": "b", "n": "b_n"})
    pairs = (chunks.join(grams, ["m", "w", "key"])
             .filter((F.length("b") > F.col("m")) | (F.col("a") < F.col("b")))
             .filter(F.levenshtein("a", "b", 1) == 1)
             .select("a", "a_n", "b", "b_n").distinct())
    pairs = store(pairs, "near-words")
    return pairs.toDF("word", "n", "near", "near_n").unionByName(
        pairs.select("b", "b_n", "a", "a_n").toDF("word", "n", "near", "near_n"))


def word_forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n of every word."""
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near"))).alias("best"))
    found = words.join(best, "word", "left")
    led = -F.col("best.rank") >= F.col("n") * ratio
    return found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                        F.when(led, F.col("best.near")).alias("form"),
                        F.when(led, -F.col("best.rank")).cast("long").alias("form_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """The forms with root: the word that following forms ends at, the word itself without a form."""
    step = store(forms.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:  # the distance covered doubles with each round
        ahead = step.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        further = store(step.join(ahead, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        step = further.select("word", "root")
        if further.filter("moved").isEmpty():
            break
    return forms.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, erased_every: int | None = 31, min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the corpus."""
    words = store(corpus_words(docs, erased_every, min_length, min_count), "words")
    forms = store(word_forms(words, near_words(words), ratio), "forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")

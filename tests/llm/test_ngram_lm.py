import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lavra.llm import ngram_lm as lm

LABELS = "doc_id long, quality int, toxic int"


def brute_model(texts, order):
    """Modified Kneser-Ney written out from its formulas, over symbols (None before the start)."""
    grams = {order: Counter()}
    for t in texts:
        s = [None] * (order - 1) + list(t.lower())
        for i in range(len(s) - order + 1):
            grams[order][tuple(s[i:i + order])] += 1
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    disc = {}
    for k, c in grams.items():
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        disc[k] = [max(0.05, min(j - 0.05, j - (j + 1) * y * n[j + 1] / n[j])) if n[j] and n[1] else fallback
                   for j, fallback in ((1, 0.5), (2, 1.0), (3, 1.5))]
    by_ctx = {k: defaultdict(dict) for k in grams}
    for k, c in grams.items():
        for g, v in c.items():
            by_ctx[k][g[:-1]][g[-1]] = v

    def p(ctx, w, size):
        k = len(ctx) + 1
        lower = p(ctx[1:], w, size) if k > 1 else 1 / size
        seen = by_ctx[k].get(ctx)
        if not seen:
            return lower
        d = lambda v: min(disc[k][min(v, 3) - 1], v)
        total = sum(seen.values())
        held = sum(map(d, seen.values()))
        return (seen.get(w, 0) - d(seen[w]) if w in seen else 0) / total + held / total * lower

    return p


def test_perplexity_matches_the_formulas(spark, docs_of):
    train = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "on the mat the dog sat on a cat"]
    probe = train + ["the mat and the cat", "sat sat sat", "dot", "t"]
    docs = docs_of(probe)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4)] + [(4, 0, 0), (5, 1, 1)], LABELS)
    size = 30
    got = {r.doc_id: r for r in lm.classify(docs, labels, order=3, size=size, min_trusted=1).collect()}
    p = brute_model(train, 3)
    for i, t in enumerate(probe):
        s = [None, None, *t]
        logs = [math.log(p(tuple(s[j:j + 2]), s[j + 2], size)) for j in range(len(t))]
        assert math.isclose(got[i].perplexity, math.exp(-sum(logs) / len(t)), rel_tol=1e-3), t
        assert got[i].n_symbols == len(t)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter("doc_id % 3 <> 0")
    held = labels.filter("doc_id % 3 = 0 and toxic = 0")
    judged = lm.classify(docs, train).join(held, "doc_id")
    r = judged.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double")).alias("right"),
                   F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("double"))).alias("kept")).first()
    assert r.right > 0.9 and r.kept > 0.95


def test_edge_rows_and_segments(spark, docs_of, monkeypatch):
    texts = ["plain words here " * 40, None, "", (None, "plain words"), (0, "plain words here " * 40), "Z" * 5000]
    docs = docs_of(texts)
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, None), (None, 1, 0), (5, None, None)], LABELS)
    one = sorted((str(r.doc_id), r.kept, r.n_symbols, r.perplexity and round(r.perplexity, 6))
                 for r in lm.classify(docs, labels, min_trusted=1).collect())
    assert [r[1] for r in one if r[0] in ("1", "2")] == [False, False]
    assert all(r[1] for r in one if r[0] == "0") and not [r for r in one if r[0] == "5"][0][1]
    monkeypatch.setattr(lm, "SEGMENT", 37)
    two = sorted((str(r.doc_id), r.kept, r.n_symbols, r.perplexity and round(r.perplexity, 6))
                 for r in lm.classify(docs, labels, min_trusted=1).collect())
    assert one == two
    kept = lm.keep_quality(docs, labels, min_trusted=1)
    assert kept.columns == docs.columns and kept.filter("doc_id in (1, 2, 5)").count() == 0
    assert lm.classify(docs.limit(0), labels).count() == 0


def test_all_characters_and_every_labelled_language_count(spark):
    """A script of many characters keeps its n-grams, and languages with labels have their own strata."""
    rng = random.Random(7)
    signs = [chr(0x4E00 + i) for i in range(600)]
    zh = ["".join(rng.choice(signs[:200] if i % 2 else signs) for _ in range(60)) for i in range(12)]
    ja = ["".join(rng.choice(signs[300:]) for _ in range(60)) for _ in range(4)]
    rows = [(i, t, "zh" if i < 12 else "ja") for i, t in enumerate(zh + ja)] + [(20, zh[0], "ko")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in (*range(8), 12, 13, 14)], LABELS)
    got = {r.doc_id: r for r in lm.classify(docs, labels, order=3, size=1000, min_trusted=3).collect()}
    assert {i: r.stratum for i, r in got.items()} == {i: s if s != "ko" else "other" for i, _, s in rows}
    for train, held in ((zh[:8], range(12)), (ja[:3], range(12, 16))):
        p = brute_model(train, 3)
        for i in held:
            s = [None, None, *rows[i][1]]
            logs = [math.log(p(tuple(s[j:j + 2]), s[j + 2], 1000)) for j in range(60)]
            assert math.isclose(got[i].perplexity, math.exp(-sum(logs) / 60), rel_tol=1e-3)

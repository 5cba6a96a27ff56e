import math
import re

from pyspark.sql import functions as F

from lavra.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_features_match_brute_force(docs_of, small):
    texts = [None, "", " \n\t ", "a", "a b c d e a b c d e", "x " * 40, "a\nb\n\na\n b\nb", "é🙂 #$%& |<>*",
             "one two three four five six one two three four five seven " * 3, " a b c d e f", "w" * 50_000,
             "a b c d e f g\n" * 3000]
    for docs in (docs_of(texts), small["documents"]):
        got = {r.doc_id: tuple(r)[1:] for r in q.text_features(docs).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
        want = {r.doc_id: brute(r.text) for r in docs.collect()}
        assert got == want


def test_binomial_tail_is_exact(spark):
    cases = [(0, 100, 0.01), (3, 1000, 0.01), (2, 50, 0.1), (0, 5000, 0.02), (60, 5000, 0.02), (10, 10, 0.5)]
    for k, n, p in cases:
        want = 1.0 if k >= n * p else sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
        got = spark.range(1).select(q.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert math.isclose(got, want, rel_tol=1e-9)


def _features(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, "
                                       "n_lines long, n_dup_lines long, n_repeat_words long")


def test_cutoffs_are_the_strictest_that_the_bound_allows(spark):
    # 3,000 good documents of which 12 have 0.3 symbols a word: 12 of 3000 pass a limit of 1 %, 60 don't
    rows = [(i, "en", 100, 500, 30 if i < 12 else 12 if i < 72 else 0, 5, 0, 0) for i in range(3000)]
    rows += [(10_000 + i, "de", 100, 500, 0, 5, 0, 0) for i in range(20)]  # too few to accept anything
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows] + [(None, 1, 0), (5, 1, 0)], LABELS)
    cuts = {r.stratum: r.asDict() for r in q.fit_cutoffs(_features(spark, rows), labels).collect()}
    assert cuts["en"]["cut_symbols"] == 0.15 and cuts["en"]["n_holdout"] == 3000
    assert all(cuts["de"][f"cut_{r.name}"] is None for r in q.RULES)
    limit, level = q.MAX_FALSE_REJECTION / len(q.RULES), q.DELTA / (len(q.RULES) * 5)
    tail = sum(math.comb(3000, i) * limit**i * (1 - limit)**(3000 - i) for i in range(13))
    assert tail <= level


def test_verdicts_and_edge_rows(spark, docs_of):
    text = " ".join(f"word{i}" for i in range(30))
    docs = docs_of([text, None, "", (None, text), (0, text), "short text"])
    labels = spark.createDataFrame([], LABELS)
    got = sorted((str(r.doc_id), r.kept, r.base_failed) for r in q.quality_rules(docs, labels).collect())
    assert got == sorted([("0", True, False), ("0", True, False), ("None", True, False), ("1", False, True),
                          ("2", False, True), ("5", False, True)])
    assert q.quality_rules(docs.limit(0), labels).count() == 0

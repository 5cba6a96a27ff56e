import random
import re
import zlib
from collections import Counter

from lavra.llm import spelling_variants as sv

LOW = str.maketrans(sv.UPPER, sv.LOWER)


def brute_words(docs, every=31):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n, ratio=10):
    close = {w: [v for v in n if near(v, w)] for w in n}
    form = {}
    for w, vs in close.items():
        if vs:
            best = min(vs, key=lambda v: (-n[v], v))
            form[w] = best if n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form.get(root):
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(close[w]), n[form[w]] if form.get(w) else None))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def edited(rng, w):
    i, c = rng.randrange(len(w) + 1), rng.choice("abcxé×")
    kind = rng.randrange(3)
    return w[:i] + c + w[i:] if kind == 0 else w[:i] + w[i + 1:] if kind == 1 else w[:i] + c + w[i + 1:]


def corpus(rng):
    base = ["ordinary", "Straßenbahn", "aaaaaaa", "aaaaaaaa", "ÉCOLES×École", "mississippi", "international",
            "internazional", "shortly", "ababababab"]
    words = base + [edited(rng, rng.choice(base)) for _ in range(150)]
    words += [edited(rng, w) for w in words[-60:]]
    texts = [" ".join(rng.choice(words[:10]) for _ in range(200)) + " " + ", ".join(rng.sample(words, 90)) for _ in range(12)]
    return list(enumerate(texts)) + [(None, texts[0]), (7, texts[1]), (7, texts[1]), (90, None), (91, ""), (92, "a 1 - ü")]


def test_variants_match_brute_force(docs_of):
    docs = corpus(random.Random(3))
    n = brute_words(docs)
    got = rows(sv.spelling_variants(docs_of(docs)))
    assert got == brute(n)
    assert sum(r[1] is not None for r in got) > 20


def test_corpus_of_the_small_table(small):
    docs = [(r.doc_id, r.text) for r in small["documents"].collect()]
    n = brute_words(docs)
    words = sv.corpus_words(small["documents"])
    assert {r.word: r.n for r in words.collect()} == n
    common = dict(Counter(n).most_common(1200))
    got = sv.near_words(words.filter(words.word.isin(list(common))))
    assert sorted((r.word, r.near) for r in got.collect()) == sorted((a, b) for a in common for b in common if near(a, b))


def test_each_number_of_chunks_finds_every_pair(spark):
    rng = random.Random(8)
    words = {w for b in ("abcdefg", "aaaaaaa", "abababab", "internationally") for w in [b] + [edited(rng, b) for _ in range(60)]}
    words = sorted(w for w in words if len(w) >= 3)
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    want = sorted((a, b) for a in words for b in words if near(a, b))
    for levels in (1, 2, 3):
        assert sorted((r.word, r.near) for r in sv.near_words(df, levels).collect()) == want


def test_ties_chains_and_empty(spark, docs_of):
    counts = [("aaaaaaab", 1000), ("aaaaaaac", 1000), ("aaaaaaad", 100), ("aaaaaadd", 10), ("aaaaddd", 1), ("zzzzzzz", 5)]
    df = spark.createDataFrame(counts, "word string, n long")
    got = {r.word: r for r in sv.with_roots(sv.word_forms(df, sv.near_words(df))).collect()}
    assert got["aaaaaaad"].form == "aaaaaaab" and got["aaaaaadd"].form == "aaaaaaad" and got["aaaaaadd"].root == "aaaaaaab"
    assert got["zzzzzzz"].form is None and got["zzzzzzz"].root == "zzzzzzz" and got["zzzzzzz"].n_near == 0
    assert got["aaaaaaab"].form is None and got["aaaaaaab"].n_near == 2
    assert sv.spelling_variants(docs_of(["a"]).limit(0)).count() == 0

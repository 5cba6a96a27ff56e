import random
import re
import tracemalloc

import numpy as np

from lavra.llm import jaccard_join as jj
from lavra.llm.jaccard_join import jaccard_components, keep_one

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(docs):
    out = []
    for _, t in docs:
        w = WORD.findall((t or "").translate(LOW))
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute(docs):
    sets, n = sets_of(docs), len(docs)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(n):
        groups.setdefault(find(i), []).append(i)
    out = []
    for i in range(n):
        ids = [docs[j][0] for j in groups[find(i)] if docs[j][0] is not None]
        out.append((docs[i][0], len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def near_copies(rng, base, n, share):
    out = []
    for _ in range(n):
        w = list(base)
        for k in range(len(w)):
            if rng.random() < share:
                w[k] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_components_match_brute_force(docs_of):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    passage = " ".join(f"common{i}" for i in range(25))
    texts = [" ".join(word() for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    for share in (0.01, 0.02, 0.03, 0.05):
        texts += near_copies(rng, [word() for _ in range(80)], 25, share)
    texts += [passage + " " + " ".join(word() for _ in range(rng.randrange(0, 12))) for _ in range(40)]
    texts += [None, "", " \n", "one", "One", "one two", "a b c d", "A\tB C\nD", "a b c d e", "a b c d e f"]
    texts += texts[:5] + [t.upper() for t in texts[5:8]]
    docs = [(7 * i % 1009, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "alone in null"), (3000, texts[2])]
    rng.shuffle(docs)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs_of(docs)).collect()), key=str)
    assert got == brute(docs)


def test_threshold_is_exact(docs_of):
    words = [f"x{i}" for i in range(22)]  # 18 shingles; without the last two words 16 of 18
    a, b = " ".join(words), " ".join(words[:-2])
    c, d = " ".join(words[:13]), " ".join(words[:13] + ["q"] * 3)  # 9 of 12: under
    e, f = " ".join(f"y{i}" for i in range(12)), " ".join([f"y{i}" for i in range(12)] + ["z", "zz"])  # 8 of 10: equal
    docs = list(enumerate([a, b, c, d, e, f]))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs_of(docs)).collect()), key=str)
    assert got == brute(docs) and (5, 10, 4) in got


def test_keep_one(docs_of):
    text = " ".join(f"k{i}" for i in range(40))
    docs = docs_of([(3, text), (2, text + " more"), (2, text + " more"), (9, None), (9, None), (8, "other words here now ok")])
    out = keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.text) == [(2, text + " more"), (8, "other words here now ok")]
    assert keep_one(docs.limit(0)).count() == 0


def test_tokens_are_counted_and_texts_hashed_in_little_memory():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 500):
        held = [rng.integers(0, 150, size), rng.integers(0, 250, size)]
        token, n = np.unique(np.concatenate(held), return_counts=True)
        got = jj._recurring(held)
        assert got[0].tolist() == token[n >= jj.LOCAL_MIN].tolist() and got[1].tolist() == n[n >= jj.LOCAL_MIN].tolist()
    texts = [" ".join(map(str, rng.integers(0, 10**6, 300))) for _ in range(2000)]  # 4 MB
    tracemalloc.start()
    try:
        count = sum(len(token) for _, _, token in jj.Shingler().sets(texts))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert count == sum(len(jj.Shingler().sets([t]).__next__()[2]) for t in texts) and peak < 30_000_000

import hashlib
import math
import random
from collections import Counter

import numpy as np

from lavra.llm import fingerprints as f


def test_entropies_match_brute_force():
    rng = random.Random(1)
    for n in (0, 10, 63, 64, 65, 400):
        data = np.array([rng.choice(b"abcdeeeeffgh   \n") for _ in range(n)], np.uint8)
        want = []
        for i in range(n - 63):
            c = Counter(data[i:i + 64].tolist())
            bits = -sum(v / 64 * math.log2(v / 64) for v in c.values())
            want.append(round(bits * 1000 / 6))
        assert np.abs(f.entropies(data).astype(int) - np.array(want, int)).max(initial=0) <= 1


def test_blocks_don_t_change_the_digest(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 123, 5000).astype(np.uint8)
    ranks = np.arange(1001)
    whole = f.digest(data, ranks)
    monkeypatch.setattr(f, "BLOCK", 700)
    assert np.array_equal(f.digest(data, ranks), whole)


def _likeness(a, b):
    """Filter by filter in plain Python."""
    if len(a) > len(b):
        a, b = b, a
    bits = lambda x: {i for i, v in enumerate(np.unpackbits(x)) if v}
    total = 0.0
    for x in map(bits, a):
        best = 0.0
        for y in map(bits, b):
            most, chance = min(len(x), len(y)), len(x) * len(y) / 2048
            floor = chance + 0.3 * (most - chance)
            best = max(best, (len(x & y) - floor) / max(most - floor, 1e-9))
        total += best
    return min(1.0, total / len(a))


def test_likeness_matches_brute_force_and_orders_texts():
    rng = random.Random(3)
    words = [rng.choice("th er on an re he in ed nd ha at en es of or".split()) for _ in range(9000)]
    make = lambda w: np.frombuffer(" ".join(w).encode(), np.uint8)
    ranks = np.arange(1001)
    text, other = words[:4000], words[4000:8000]
    edited = text[:3000] + words[8000:9000]
    a, b, c = (f.digest(make(x), ranks) for x in (text, edited, other))
    assert f.likeness(a, a) == 1.0 and f.likeness(a, b) > 0.4 > 0.2 > f.likeness(a, c)
    for x, y in ((a, b), (a, c), (b, c)):
        assert math.isclose(f.likeness(x, y), _likeness(x, y), abs_tol=1e-9)
        assert f.likeness(x, y) == f.likeness(y, x)
    assert np.array_equal(f.from_text(f.as_text(a)), a) and f.as_text(a[:0]) == ""
    assert f.likeness(a[:0], a[:0]) == 1.0 and f.likeness(a, a[:0]) == 0.0


def _expected(docs):
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        cut = len(t) // 3
        edited = t[:len(t) - cut] + nxt[:cut]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest())
    return out


def test_edited_texts_in_descending_order(docs_of, small):
    texts = [None, "", "a", "é🙂ü" * 50, "short one", "x" * 3000, "abc " * 400]
    docs = docs_of([(i * 3, t) for i, t in enumerate(texts)])
    for frame, ranges in ((docs, 3), (docs, 1), (docs.limit(1), 4), (small["documents"], 7)):
        ranks = f.fit_ranks(frame)
        rows = f.compare_edited(frame, ranks, ranges).collect()
        plain = [(r.doc_id, r.text) for r in frame.collect()]
        assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == _expected(plain)
        prints = {r.doc_id: r.fingerprint for r in f.fingerprints(frame, ranks).collect()}
        assert {r.doc_id: r.fingerprint for r in rows} == prints
        same = {}
        for i, t in plain:
            assert same.setdefault(t or "", prints[i]) == prints[i]
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert f.compare_edited(docs.limit(0), [0] * 1001, 3).count() == 0


def test_repeated_and_null_ids_each_give_a_row(docs_of):
    docs = docs_of([(1, "one text"), (1, "one text"), (1, "another"), (None, "no id"), (None, None)])
    rows = f.compare_edited(docs, [0] * 1001, 2).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "1", "None", "None"]


def test_short_texts_have_features():
    """Texts of 64 to 300 bytes: none is empty, and distinct ones aren't wholly alike."""
    rng = random.Random(5)
    words = "the quick brown fox jumps over one lazy dog while seven wizards judge my vow".split()
    ranks = np.array(rng.sample(range(1001), 1001))
    chains = []
    for n in range(64, 301):
        text = " ".join(rng.choice(words) + str(rng.randrange(100)) for _ in range(n))[:n]
        chains.append(f.digest(np.frombuffer(text.encode(), np.uint8), ranks))
    assert all(len(c) for c in chains)
    assert all(f.likeness(a, b) < 1.0 for i, a in enumerate(chains) for b in chains[:i])
    weak = [f.digest(np.frombuffer(t, np.uint8), ranks) for t in (b"x" * 100, b"x" * 300, b"y" * 300, b"x" * 3000)]
    assert all(len(c) for c in weak) and all(f.likeness(a, b) < 1.0 for i, a in enumerate(weak) for b in weak[:i])

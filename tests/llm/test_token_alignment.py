import hashlib
from collections import Counter
from itertools import accumulate

import pytest

from lavra.llm import token_alignment as ta
from lavra.llm.piece_codec import read_model

ODD = ["a  b", "  a", " a ", "x\n \ny", "x \ny", "it 's 5 o'clock", "<|endoftext|> <s> a", "▁x", "a ▁ b", "tab\t end",
       "é̀ ñ 漢字 かな 😀 ok", "x\x1c y", "a\x85b c", " ", "\n", "ﬁ ½ K", "0 x0A <0x0A> y", "a\x00b c", "", None,
       "wordwithoutspaces" * 500, "to be or not to be", "To be or not to be", "to be or not to be"]


@pytest.fixture(scope="module")
def models():
    return ta.read_byte_model(), read_model()


def brute(texts, units):
    """Rows of the query's columns, from whole texts and the libraries."""
    found, counts = [], Counter()
    for t in texts:
        a = units.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = units.b.encode(t) if t else []
        spelt = [b"".join(x[i] for i in ids) for x, ids in ((units.a_bytes, a), (units.b_bytes, b))]
        if not t or not spelt[0] == spelt[1] == (" " + t).encode():
            a, b = [], []
        ends = [list(accumulate(len(x[i]) for i in ids)) for x, ids in ((units.a_bytes, a), (units.b_bytes, b))]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], (0, 0)
        for e in common:
            to = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append((a[at[0]:to[0]], b[at[1]:to[1]]))
            at = to
        links = [(i, j) for i, x in zip(a, ends[0], strict=True) for j, y in zip(b, ends[1], strict=True) if x == y] if len(
            a) < 300 else [(x[-1], y[-1]) for x, y in groups]
        counts.update(links)
        found.append((a, b, groups, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def test_scores_match_brute_force(docs_of, small, models):
    texts = ODD + [r.text for r in small["documents"].limit(60).collect()]
    got = {r.doc_id: tuple(r)[1:] for r in ta.align_and_score(docs_of(texts).repartition(3), *models).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, ta.Units(*models))
    assert got[ODD.index("▁x")] == (0, 0, 0, 0, 0, 0, "") and got[ODD.index(None)][6] == ""


def test_units_are_the_library(small, models):
    """Whole texts of a table, and every plain character next to letters, digits and marks."""
    units = ta.Units(*models)
    texts = [r.text for r in small["documents"].collect()]
    found = units.numbers(texts)
    for side, whole in ((0, [e.ids for e in units.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]),
                        (1, units.b.encode(texts))):
        for n, ids in zip(found, whole, strict=True):
            assert not n or [i for k in n for i in units.ids[side][units.ends[side][k]:units.ends[side][k + 1]]] == ids
    plain = [c for c in map(chr, range(0x2028)) if ta.PLAIN(c)]
    tried = [x for c in plain for x in (f" a{c}b", f" {c}{c}", f" 1{c}2{c}", f" {c}'s{c}", f" .{c}.{c}\n{c}a")]
    assert [units.fast(x) for x in tried] == [e.ids for e in units.a.encode_batch(tried, add_special_tokens=False)]


def test_groups_and_pairs_stay_within_bounds(docs_of, models):
    units = ta.Units(*models)
    aligned = ta.align(docs_of(ODD), *models)
    assert aligned.columns == ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"]
    for r in aligned.collect():
        assert sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids) and len(r.a_sizes) == len(r.b_sizes)
    for r in ta.link_counts(aligned).collect():
        a, b = units.a_bytes[r.a_id], units.b_bytes[r.b_id]
        assert a.endswith(b) or b.endswith(a)
    assert ta.pair_bound([b"ab", b"b"], [b"b", b"xab"]) == 4
    assert 50_000 < ta.pair_bound(units.a_bytes, units.b_bytes) < 500_000


def test_empty_and_blocks(docs_of, models):
    assert ta.align_and_score(docs_of(["a"]).limit(0), *models).count() == 0
    assert [len(b) for b in ta._blocks(["a" * ta.BLOCK, "b", None, "c" * ta.BLOCK])] == [1, 2, 1]


def test_plain_units_are_encoded_many_at_a_time(models):
    """One call of the fast encoder for many new units, with the ids that one call for each would give."""
    units = ta.Units(*models)
    calls, fast = [], units.fast
    units.fast = lambda text: calls.append(text) or fast(text)
    words = [f"word{i} x{i}, ñandú{i}" for i in range(700)]
    found = units.numbers([" ".join(words), "a▁b c", "漢字 word1"])
    assert len(calls) <= 2100 // ta.JOINED + 2 and found[1] == []
    for unit in ("word1", "x699,", "ñandú3", "漢字"):
        ids, _ = units.joined(0, ta.np.array([units.known[unit]]))
        assert ids.tolist() == units.a.encode(" " + unit, add_special_tokens=False).ids


def test_units_that_run_together_are_encoded_alone(models):
    """An encoder whose token crosses from a unit to the next isn't believed."""
    units = ta.Units(*models)
    want = {u: units.a.encode(" " + u, add_special_tokens=False).ids for u in ("ab", "cd", "ef")}
    whole = units.a_bytes.index(b" the")
    units.fast = lambda text: [whole] * (len(text) // 4)
    units.numbers(["ab cd ef"])
    assert all(units.joined(0, ta.np.array([units.known[u]]))[0].tolist() == ids for u, ids in want.items())

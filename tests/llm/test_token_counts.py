import pytest
from pyspark.sql import functions as F

from lavra.llm import token_counts as t

TEXTS = ["", None, "\n", "a\n\n b c\n", "one line", "é🙂ü\n漢字 and more\n\n\nend", "no break " * 2000, "x\ny" * 50, " \n  \n"]


@pytest.fixture(scope="module")
def ranks():
    return t.read_ranks()


def brute(text, encoding, lengths, rule):
    """Section of every token by looking at its characters one by one."""
    text = text or ""
    section, at = [], 0
    for ch in text:
        section.append(at)
        at += ch == "\n"
    n = (section[-1] + 1) if section else 1
    out = [0] * n
    raw, ends = [], 0
    owner = [i for i, ch in enumerate(text) for _ in ch.encode()]
    for i in encoding.encode_ordinary(text):
        chars = sorted(set(owner[ends:ends + int(lengths[i])]))
        ends += int(lengths[i])
        parts = [section[c] for c in chars]
        raw.append(parts)
        best = parts[0] if rule == "start" else max(sorted(set(parts)), key=lambda s: (parts.count(s), -s))
        out[best] += 1
    return out


@pytest.mark.parametrize("rule", ["majority", "start"])
def test_lines_match_brute_force(docs_of, small, ranks, rule):
    encoding, lengths = t._encoding(ranks)
    for docs in (docs_of(TEXTS), small["documents"].limit(40)):
        got = {}
        for r in t.count_tokens(docs, ranks, rule).collect():
            got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
        for r in docs.collect():
            mine = got[r.doc_id]
            assert [mine[i] for i in range(len(mine))] == brute(r.text, encoding, lengths, rule)


def test_given_sections_split_and_conservation(docs_of, ranks):
    docs = docs_of(["helloworld and more"]).withColumn("parts", F.expr(
        "array(named_struct('name','a','start',0,'end',7), named_struct('name','b','start',7,'end',19))"))
    out = t.count_tokens(docs, ranks, "split", "parts").collect()
    encoding, _ = t._encoding(ranks)
    assert [r.name for r in out] == ["a", "b"] and all(r.n_crossing == 1 for r in out)
    assert abs(sum(r.n_tokens for r in out) - len(encoding.encode_ordinary("helloworld and more"))) < 1e-9
    assert t.count_tokens(docs.limit(0), ranks).count() == 0
    with pytest.raises(ValueError):
        t.count_tokens(docs, ranks, "none")

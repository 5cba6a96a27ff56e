import random
import re

from lavra.llm.line_dedup import dedup_lines, later_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, min_words):
    """Lines covered by a run of min_words words that also occurs at an earlier position."""
    seq = {}
    for i, t in docs:
        seq[i] = [x for x in (t or "").split("\n") if WORD.search(x)]
    seen, out = {}, {}
    for i in sorted(seq):
        lines = seq[i]
        for p in range(len(lines)):
            for e in range(p + 1, len(lines) + 1):
                if sum(len(WORD.findall(x)) for x in lines[p:e]) >= min_words:
                    key = tuple(lines[p:e])
                    if seen.setdefault(key, (i, p)) < (i, p):
                        out.setdefault(i, set()).update(range(p, e))
    return out


def test_matches_brute_force(docs_of):
    rng = random.Random(3)
    pool = [" ".join(f"w{rng.randrange(6)}" for _ in range(rng.randrange(1, 5))) for _ in range(12)] + ["", "  "]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 25)))) for i in range(40)]
    docs += [(40, docs[3][1]), (41, None), (42, ""), (43, "a b c\n" * 30), (44, "x")]
    got = {r.doc_id: set(r.deleted) for r in later_copies(docs_of(docs), 6).collect()}
    assert got == brute(docs, 6)


def test_long_passage_goes_short_lines_stay(docs_of):
    passage = "\n".join(" ".join(f"p{k}{j}" for j in range(20)) for k in range(4))
    docs = docs_of([f"head one\n{passage}\ntail", f"other start\n\n{passage}\nfin", "head one\ntail", passage])
    out = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert out[0].text == f"head one\n{passage}\ntail" and out[1].text == "other start\n\nfin"
    assert out[2].text == "head one\ntail" and out[3].text == "" and out[1].n_chars == len("other start\n\nfin")
    assert out[1].node == "x" and out[1]._lr_n_deleted == 4
    kept = dedup_lines(docs, drop_emptied=True)
    assert {r.doc_id for r in kept.collect()} == {0, 1, 2}


def test_repeated_ids_nulls_and_empty(docs_of):
    text = " ".join(f"t{j}" for j in range(60))
    docs = docs_of([(5, text), (5, text), (None, text), (7, None)])
    out = sorted((str(r.doc_id), r.text) for r in dedup_lines(docs).collect())
    assert out == sorted([("5", text), ("5", text), ("None", ""), ("7", None)], key=lambda x: (x[0], str(x[1])))
    assert dedup_lines(docs.limit(0)).count() == 0

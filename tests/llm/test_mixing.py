import math

from lavra.llm import mixing as m


def _docs(spark, rows):
    return spark.createDataFrame([(i, " ".join(["w"] * n) if n is not None else None, "en", s, 0, "x")
                                  for i, (s, n) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, block string")


def test_exponent_meets_the_targets(spark):
    totals = spark.createDataFrame([("a", 8000), ("b", 1000), ("c", 500), ("d", 0), (None, 250)], "source string, tokens long")
    assert abs(m.fit_exponent(totals, max_repeats=4) - (1 - math.log(4) / math.log(32))) < 1e-6
    t = m.fit_exponent(totals, target_entropy=1.2, max_repeats=None)
    w = [x**t for x in (8000, 1000, 500, 250)]
    assert abs(-sum(x / sum(w) * math.log(x / sum(w)) for x in w) - 1.2) < 1e-5
    assert m.fit_exponent(totals, max_repeats=None) == 1.0 and m.fit_exponent(totals.limit(0), 1.0) in (0.0, 1.0)


def test_every_row_once_and_small_sources_again(spark):
    rows = [("big", 10)] * 400 + [("small", 10)] * 25 + [(None, 10)] * 25 + [("empty", None), ("empty", 0)]
    out = m.mix(_docs(spark, rows), max_repeats=4.0, blocks=16).collect()
    copies = {}
    for r in out:
        copies.setdefault(r.doc_id, []).append(r.copy)
    assert set(copies) == set(range(len(rows))) and all(sorted(c) == list(range(len(c))) for c in copies.values())
    assert all(len(copies[i]) == 1 for i in range(400)) and all(len(copies[i]) == 4 for i in range(400, 450))
    assert {len(copies[i]) for i in (450, 451)} == {1}


def test_budget_is_met_to_one_row(spark):
    rows = [("a", 7)] * 300 + [("b", 5)] * 100 + [("c", 3)] * 50
    total = 300 * 7 + 500 + 150
    for budget in (1000, total, 4001):
        out = m.mix(_docs(spark, rows), max_repeats=3.0, budget=budget, blocks=8).collect()
        by = {}
        weight = {}
        for r in out:
            by[r.source] = by.get(r.source, 0) + r.tokens
            weight[r.source] = r.weight
        assert abs(sum(weight.values()) - 1) < 1e-9
        for s, n in (("a", 7), ("b", 5), ("c", 3)):
            assert 0 <= round(budget * weight[s]) - by[s] < n
        seen = {}
        for r in out:  # one block of a pass at a time, a block in one place
            seen.setdefault((r.source, r.copy, r.place), set()).add(r.block)
        assert all(len(b) == 1 for b in seen.values())


def test_documents_keep_their_columns(spark):
    docs = _docs(spark, [("a", 5)] * 20 + [("b", 5)] * 4 + [("b", None)])
    out = m.mix_documents(docs, max_repeats=2.0, blocks=4)
    assert out.columns == docs.columns
    n = {r.doc_id: 0 for r in docs.collect()}
    for r in out.collect():
        n[r.doc_id] += 1
    assert all(n[i] == 1 for i in range(20)) and all(n[i] == 2 for i in range(20, 24)) and n[24] >= 1
    twice = docs.unionByName(docs.limit(1))
    assert m.mix_documents(twice, max_repeats=None).count() == 26
    assert m.mix_documents(docs.limit(0)).count() == 0


def _brute(rows, budget, blocks, order, max_repeats):
    """Emitted (doc_id, source, copy) from (doc_id, source, tokens, row_hash) rows, one row at a time."""
    totals = {}
    for r in rows:
        totals[r.source] = totals.get(r.source, 0) + r.tokens
    some = {s: n for s, n in totals.items() if n}
    top, low = max(some.values()), min(some.values())
    t = max(0.0, 1 - math.log(max_repeats) / math.log(top / low)) if top > low * max_repeats else 0.0
    raw = {s: (n / top) ** t for s, n in some.items()}
    out = []
    for s, n in totals.items():
        mine = sorted((r for r in rows if r.source == s), key=lambda r: (r.row_hash, r.doc_id))
        if not n:
            out += [(r.doc_id, s, 0) for r in mine]
            continue
        goal = round(top * raw[s] if budget is None else budget * raw[s] / sum(raw.values()))
        passes, left = divmod(goal, n)
        out += [(r.doc_id, s, c) for r in mine for c in range(passes)]
        upto, full = 0, left > 0
        for b in sorted(range(blocks), key=lambda b: (order[passes, b], b)):
            block = [r for r in mine if r.row_hash % blocks == b]
            if not full or not block:
                continue
            size = sum(r.tokens for r in block)
            if upto + size <= left:
                out += [(r.doc_id, s, passes) for r in block]
                upto += size
            else:
                for r in block:
                    upto += r.tokens
                    if upto <= left:
                        out.append((r.doc_id, s, passes))
                full = False
    return sorted(out, key=str)


def test_mixture_matches_brute_force_with_repeated_rows(spark):
    equal = [(0, "same text " * 2, "a")] * 7 + [(1, "one", "a")] * 3 + [(2, "x y z", "b")] * 5 + [(3, None, "b")] * 2
    rows = equal + [(10 + i, "w " * (1 + i % 5), "abc"[i % 3]) for i in range(60)] + [(0, "same text " * 2, None)] * 4
    docs = spark.createDataFrame([(i, t, "en", s, 0, "x") for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, block string").repartition(5)
    held = m.token_rows(docs, 8).collect()
    order = {(r.p, r.b): r.h for r in spark.range(8).selectExpr("explode(sequence(0, 40)) p", "cast(id as int) b").selectExpr(
        "p", "b", "xxhash64(0, p, b) h").collect()}
    for budget, repeats in ((None, 1.5), (None, 1.3), (3, 2.0), (30, 2.0), (97, 1.2), (400, 3.0), (1000, 2.0)):
        options = {"max_repeats": repeats, "budget": budget, "blocks": 8}
        want = _brute(held, budget, 8, order, repeats)
        got = sorted(((r.doc_id, r.source, r.copy) for r in m.mix(docs, **options).collect()), key=str)
        assert got == want, (budget, repeats)
        whole = sorted(((r.doc_id, r.source) for r in m.mix_documents(docs, **options).collect()), key=str)
        assert whole == sorted(((i, s) for i, s, _ in want), key=str), (budget, repeats)


def test_equal_rows_only(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5, "x")] * 7, "doc_id long, text string, lang string, source string, "
                                 "n_chars long, block string").repartition(3)
    for budget, n in ((3, 1), (9, 3), (12, 4), (30, 10), (2, 0)):
        assert m.mix(docs, budget=budget, blocks=1).count() == m.mix_documents(docs, budget=budget, blocks=1).count() == n

import random

import pytest

from lavra.llm import piece_codec as p


@pytest.fixture(scope="module")
def model():
    return p.read_model()


TEXTS = ["", None, " ", " " * 300, "a" * 500, "abc" * 200, "日本語のテキスト" * 40, "🙂 " * 100, "x  y   z" * 50,
         "\n\n\t" * 100, "theandthe" * 100, "hellothereworld" * 60 + " end", "=" * 333 + "-" * 200, "é" * 10, "\x00a\x01 b"]


def _check(rows, sp):
    for r in rows:
        assert r.token_ids == (None if r.text is None else sp.encode(r.text)), repr(r.text)[:80]
        assert r.decoded == r.text and r.node == "x"


@pytest.mark.parametrize("chunk,giant", [(64, 40), (17, 0)])
def test_parallel_scan_gives_the_library_s_ids(docs_of, small, model, monkeypatch, chunk, giant):
    monkeypatch.setattr(p, "CHUNK", chunk)
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("abet \n") for _ in range(1500)), TEXTS[5]]
    texts += [r.text for r in small["documents"].limit(8).collect()]
    rows = p.decode(p.encode(docs_of(texts), model, giant=giant), model).collect()
    assert len(rows) == len(texts)
    _check(rows, p._processor(model))


def test_whole_table_round_trip(docs_of, small, model):
    sp = p._processor(model)
    docs = small["documents"]
    rows = p.decode(p.encode(docs, model), model).collect()
    assert all(r.token_ids == sp.encode(r.text) and r.decoded == r.text for r in rows)
    assert p.encode(docs_of(["x"]).limit(0), model).count() == 0


def test_max_plus_product_is_associative(model):
    import numpy as np
    lat = p.Lattice(model)
    text = "the quick brownfoxes jumped over " * 6
    p_chunk, p.CHUNK = p.CHUNK, 19
    try:
        mats = []
        for n, left, body, right, final in p._cut(text, lat.longest):
            entries, exits, m = p._chunk_states(lat, left, body, right, n == 0, final)
            assert m.shape == (len(entries), len(exits))
            mats.append(m)
    finally:
        p.CHUNK = p_chunk
    a, b, c = (np.where(np.random.default_rng(i).random((4, 4)) < 0.5, 0, -np.inf) for i in range(3))
    assert np.array_equal(p._max_plus(p._max_plus(a, b), c), p._max_plus(a, p._max_plus(b, c)))

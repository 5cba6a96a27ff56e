import corpus_pipeline as cp

from lavra.llm import piece_codec
from lavra.llm.queries import QUERIES, SQL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_pass_documents_on(spark, small, tmp_path):
    docs, sizes = small["documents"], []
    for i, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert i == len(cp.STAGES) - 1 or out.columns == COLUMNS
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        sizes.append(docs.select("doc_id").distinct().count())
    n = small["documents"].count()
    assert n > sizes[0] > sizes[2] and sizes[1] <= sizes[0] and sizes[2] == sizes[3] == sizes[4] > 0.5 * n
    sp = piece_codec._processor(piece_codec.read_model())
    texts = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    assert all(r.token_ids == sp.encode(texts[r.doc_id]) for r in docs.collect())


def test_run_equals_the_stages_and_takes_empty_tables(spark, small, tmp_path):
    ran = cp.run(spark, "/root/testdata/sf0.001")
    assert ran.columns == ["doc_id", "source", "lang", "n_tokens", "token_ids"] and ran.count() > 0
    empty = str(tmp_path)
    for t, df in small.items():
        df.limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert cp.run(spark, empty).count() == 0


def test_every_operator_has_one_query():
    assert sorted(q.split("_")[0] for q in QUERIES) == sorted([f"op{n}" for n in range(1, 14)] + ["pipeline"])
    assert set(SQL) <= set(QUERIES) and cp.ORACLE_SQL is None

import io
import json
import os
import zipfile

from pyspark.sql import Observation
from pyspark.sql import functions as F

from lavra.plans import mining, permits, procurement, tenders
from lavra.sources.snapshots import read_snapshot
from lavra.streaming import stream_append_jsonl


def _bronze(spark, payloads):
    rows = [(p, "pncp", "m", "2024", "2024-01-01", "f", i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, procurement.BRONZE_SCHEMA)


def test_procurement_silver_edge_rows(spark):
    n = lambda key, obj, sphere="M", **kw: json.dumps(
        {"numeroControlePNCP": key, "objetoCompra": obj, "valorTotalEstimado": 1e6,
         "orgaoEntidade": {"esferaId": sphere}, "dataPublicacaoPncp": kw.get("ts", "2024-01-15T10:00:00")})
    payloads = [
        n("1", "Rede de ÁGUA"),                         # unicode case-insensitive → saneamento
        n("1", "pavimentação"),                         # repeated key: first copy wins
        n("2", "ponte e escola"),                       # two rules: first in rule order (social)
        json.dumps({"numeroControlePNCP": "3", "objetoCompra": None, "orgaoEntidade": None}),
        json.dumps({"numeroControlePNCP": "4", "objetoCompra": "obra"}),   # struct missing
        n(None, "drenagem"), n(None, "praça"),          # two null keys: one survives
        "{not json",                                    # malformed: quarantined
        n("5", "reforma", ts="2024-13-45"),             # bad timestamp → null
        n("6", "obra", sphere=None),                    # null sphere → left out of the report
    ]
    silver = procurement.silver_from_bronze(_bronze(spark, payloads))
    got = {r.numero_controle_pncp: (r.tipo_obra, r.orgao_esfera_id) for r in silver.collect()}
    assert got == {"1": ("saneamento", "M"), "2": ("equipamento social", "M"),
                   "3": ("construção geral", None), "4": ("construção geral", None),
                   None: ("drenagem", "M"), "5": ("construção geral", "M"), "6": ("construção geral", None)}
    ts = {r.numero_controle_pncp: r.dt_publicacao_pncp for r in silver.collect()}
    assert ts["5"] is None and ts["1"].year == 2024
    assert procurement.malformed_count(_bronze(spark, payloads)) == 1
    rep = {(r.tipo_obra, r.orgao_esfera_id): (r.qtd, r.valor_total_mi)
           for r in procurement.report(silver).collect()}
    assert rep == {("saneamento", "M"): (1, 1.0), ("equipamento social", "M"): (1, 1.0),
                   ("drenagem", "M"): (0, 1.0), ("construção geral", "M"): (1, 1.0)}


def _land(landing, cat, start, end, page, rows, total=1):
    d = os.path.join(landing, str(cat), f"{start}_{end}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"page_{page}.json"), "w") as fh:
        json.dump({"data": rows, "totalPaginas": total}, fh)


def test_a_landed_file_may_hold_several_pages(spark, tmp):
    folder, lake = f"{tmp}/landing/4/20240101_20240131", f"{tmp}/lake"
    os.makedirs(folder)

    def land(name, pages):
        with open(f"{folder}/{name}.json", "w") as fh:
            json.dump(pages, fh)

    def notice(x):
        return {"numeroControlePNCP": x, "objetoCompra": "obra"}

    def ingest(day):
        found = procurement.ingest(spark, f"{tmp}/landing", lake, [2024], ingest_date=day).collect()
        return next(r for r in found if r.category == "Concorrência Eletrônica")

    first = {"numeroPagina": 1, "data": [notice("a"), notice("b")], "totalPaginas": 3}
    third = {"numeroPagina": 3, "data": [notice("c")], "totalPaginas": 3}
    land("run_1", [first, {"numeroPagina": 2, "error": "HTTP 500"}, third])
    got = ingest("2024-02-01")
    assert (got.evaluated, got.found, got.with_event) == (3, 3, 1)
    assert procurement.read_ledger(spark, f"{lake}/_ledger", "procurement").count() == 0
    land("run_2", [{"numeroPagina": 2, "data": [notice("a"), notice("d")], "totalPaginas": 3}])
    ingest("2024-02-02")
    assert [r.key for r in procurement.read_ledger(spark, f"{lake}/_ledger", "procurement").collect()] == ["4:20240101:20240131"]
    rows = procurement.read_bronze(spark, lake).filter("dt_ingestao = '2024-02-02'").collect()
    assert sorted((r.source_file.rsplit("/", 1)[1], r.position) for r in rows) == [
        ("run_1.json#1", 0), ("run_1.json#1", 1), ("run_1.json#3", 0), ("run_2.json#2", 0), ("run_2.json#2", 1)]
    assert procurement.silver_from_bronze(procurement.read_bronze(spark, lake)).count() == 4


def test_replay_lands_many_pages_in_few_files(spark):
    from lavra.plans.driver_bronze import FILE_PAGES, replay_files
    pages = spark.range(1, 41).selectExpr("4 as category", "'20240101_20240131' as window", "cast(id as int) as page", "1 as run",
                                          "array(named_struct('objetoCompra', 'obra')) as data", "40L as totalPaginas", "cast(null as string) as error")
    files = {r.name: json.loads(r.text) for r in replay_files(pages, 1).collect()}
    assert sorted(files) == [f"4/20240101_20240131/run_1_part_{i}.json" for i in range(3)] and FILE_PAGES == 16
    assert [p["numeroPagina"] for _, f in sorted(files.items()) for p in f] == list(range(1, 41))
    assert replay_files(pages, 2).count() == 0


def test_procurement_ingest_commit_after_write(spark, tmp):
    landing, lake = f"{tmp}/landing", f"{tmp}/lake"
    _land(landing, 4, "20240101", "20240131", 1,
          [{"numeroControlePNCP": "a", "objetoCompra": "obra de ponte"},
           {"numeroControlePNCP": "b", "objetoCompra": "compra de papel"}])
    _land(landing, 6, "20240101", "20240107", 1, [{"numeroControlePNCP": "c", "objetoCompra": "reforma"}])
    os.makedirs(f"{landing}/8/20240101_20240131", exist_ok=True)
    with open(f"{landing}/8/20240101_20240131/page_1.error", "w") as fh:
        fh.write("HTTP 500")
    seen = Observation("seen")
    diag = {r.category: r for r in procurement.ingest(spark, landing, lake, [2024], ingest_date="2024-02-01", seen=seen).collect()}
    assert seen.get == {"pages": 2, "pages_failed": 0, "rows_seen": 3, "rows_kept": 2}
    assert diag["Concorrência Eletrônica"].evaluated == 2 and diag["Concorrência Eletrônica"].found == 1
    assert diag["Dispensa de Licitação"].with_event == 1
    assert procurement.read_bronze(spark, lake).count() == 2
    # second run: only answered windows are skipped; the failed one and those never landed stay pending
    diag2 = {r.category: r for r in procurement.ingest(spark, landing, lake, [2024], ingest_date="2024-02-02").collect()}
    assert diag2["Concorrência Eletrônica"].skipped == 1 and diag2["Concorrência Eletrônica"].windows == 11
    assert diag2["Dispensa de Licitação"].windows == 12
    assert diag2["Dispensa de Licitação"].skipped == 0 and diag2["Dispensa de Licitação"].with_event == 1
    assert procurement.read_bronze(spark, lake).count() == 2
    # a window landed later, and one whose second page comes later, still load
    _land(landing, 4, "20240201", "20240229", 1, [{"numeroControlePNCP": "d", "objetoCompra": "obra"}], total=2)
    _land(landing, 4, "20240301", "20240331", 1, [], total=0)
    procurement.ingest(spark, landing, lake, [2024])
    keys = {r.key for r in procurement.read_ledger(spark, f"{lake}/_ledger", "procurement").collect()}
    assert "4:20240201:20240229" not in keys and "4:20240301:20240331" in keys  # truly empty is an answer
    _land(landing, 4, "20240201", "20240229", 2, [{"numeroControlePNCP": "e", "objetoCompra": "obra"}], total=2)
    procurement.ingest(spark, landing, lake, [2024])
    keys = {r.key for r in procurement.read_ledger(spark, f"{lake}/_ledger", "procurement").collect()}
    assert "4:20240201:20240229" in keys
    assert {r.numero_controle_pncp for r in procurement.write_silver(spark, lake).collect()} == {"a", "c", "d", "e"}
    # nothing pending has landed: no new bronze file
    os.remove(f"{landing}/8/20240101_20240131/page_1.error")
    files = sorted(os.listdir(f"{lake}/bronze"))
    procurement.ingest(spark, landing, lake, [2024])
    assert sorted(os.listdir(f"{lake}/bronze")) == files


def _tender_zip(lines):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("licitacao.csv", ("\n".join(lines) + "\n").encode("latin-1"))
    return bytearray(buf.getvalue())


def test_tenders_end_to_end(spark):
    head = ";".join(f"h{i}" for i in range(21))

    def row(obj="Obras e servicos de engenharia", vl="1.234,56", qtd="2,5", dt="05/03/2023", name=" Ana\t"):
        cells = ["SP", "Pref", "1", "conc", obj, "desc", "item", qtd, "un", vl, "1.234,5", "un",
                 "1234.56", "12d", "un", "7", dt, "cnpj", name, "hab", "NA"]
        return ";".join(cells)
    lines = [head, row(), row(), row(obj="Outro"), row(dt="31/02/2023"), "a;b", row() + ";extra"]
    archives = spark.createDataFrame([("m.zip", "2023-03", _tender_zip(lines))], "path string, period string, content binary")
    bronze = tenders.bronze_from_archives(archives, "2024-01-01")
    silver = tenders.silver(bronze)
    rows = silver.collect()
    assert len(rows) == 2  # exact duplicate collapsed; other object, long and short(non-works) lines gone
    r = [x for x in rows if x.dt_edital is not None][0]
    assert (r.vl_unit_orcamento_lote, r.qtd_orcamento_lote, r.vl_unit_orcamento_item, r.qtd_orcamento_item,
            r.qtd_contratada, r.vl_proposta, r.nome_participante) == (1234.56, None, 123456.0, None, 2.5, None, "Ana")
    assert {x.dt_edital is None for x in rows} == {True, False}


def test_permits_silver(spark):
    raw = spark.createDataFrame(
        [("2023", "f", 1, "01/02/99", "A1", "P1", "nr1-3", "1.234,5", "3", " ", "2", None),
         ("2023", "f", 2, "1/2/2023", "A1", "P1", "C2", "10", None, None, None, "1 / 1 / 1"),
         ("2024", "g", 1, "01/02/68", "A1", "P1", None, "x", "", " ", None, None)],
        "ano_referencia string, file string, row_idx int, `aprovação` string, `alvará` string, processo string, "
        "categoria_de_uso string, `área_da_construção_m` string, numero_de_blocos string, "
        "numero_de_pavimentos string, numero_de_unidades string, b_locos_p_avimentos_u_nidades string")
    out = {r.ano_referencia: r for r in permits.silver(raw).collect()}
    assert len(out) == 2
    a, b = out["2023"], out["2024"]
    assert (a.uso_classificado, a.area_construcao_m2, a.blocos_pavimentos_unidades, a.dt_aprovacao.year) == \
        ("residencial", 1234.5, "3 / 2", 1999)
    assert (b.uso_classificado, b.area_construcao_m2, b.blocos_pavimentos_unidades, b.dt_aprovacao.year) == \
        ("outros", None, None, 2068)
    assert len(permits.silver(raw).columns) == 26


def test_mining_silver_and_reports(spark):
    attrs = spark.createDataFrame(
        [({"PROCESSO": "p1", "FID": "2", "NUMERO": "7.0", "ANO": "2001", "SUBS": "AREIA", "FASE": "LICENCIAMENTO",
           "AREA_HA": "10.5", "UF": "SP"}, 2, "a", 0),
         ({"PROCESSO": "p1", "FID": "1", "SUBS": "GRANITO", "FASE": "XYZ", "AREA_HA": "1", "UF": "SP"}, 1, "a", 1),
         ({"FID": "3", "SUBS": "SAIBRO", "FASE": "REQUERIMENTO DE LAVRA", "AREA_HA": "4", "UF": "SP"}, 3, "a", 2)],
        "attributes map<string,string>, fid bigint, source_file string, position int") \
        .withColumn("dt_ingestao", F.lit("2024-01-01"))
    geom = spark.createDataFrame(
        [("p1", 1.0, 2.0, "{}", "g", 0), ("p1", 9.0, 9.0, "{}", "g", 1), (None, 3.0, 4.0, "{}", "g", 2)],
        "processo string, lat double, lon double, geometry_raw string, source_file string, position int")
    s = mining.silver(attrs, geom)
    got = {r.processo: (r.tipo_agregado, r.fase_grupo, r.lat, r.numero) for r in s.collect()}
    assert got == {"p1": ("rocha_britada", "outros", 1.0, None), None: ("cascalho_saibro", "em_processo", 3.0, None)}
    cov = mining.coverage_report(s).collect()[0]
    assert cov.total == 2 and cov.pct_with == 100.0
    rep = {(r.tipo_agregado, r.fase_grupo): (r.qtd_processos, r.area_total_ha) for r in mining.report(s).collect()}
    assert rep == {("rocha_britada", "outros"): (1, 1.0), ("cascalho_saibro", "em_processo"): (0, 4.0)}


def test_stream_append_is_incremental(spark, tmp):
    src = f"{tmp}/src"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as fh:
        fh.write('{"k": 1}\n{"k": 2}\n')
    out = stream_append_jsonl(spark, src, "k bigint", "t", f"{tmp}/lake")
    assert sorted(r.k for r in out.collect()) == [1, 2]
    out = stream_append_jsonl(spark, src, "k bigint", "t", f"{tmp}/lake")
    assert out.count() == 2  # rerun: nothing new
    with open(f"{src}/b.json", "w") as fh:
        fh.write('{"k": 3}\n')
    out = stream_append_jsonl(spark, src, "k bigint", "t", f"{tmp}/lake")
    assert sorted(r.k for r in out.collect()) == [1, 2, 3]


def test_procurement_overwrite_mode_forgets_ledger(spark, tmp):
    landing, lake = f"{tmp}/landing", f"{tmp}/lake"
    _land(landing, 4, "20240101", "20240131", 1, [{"numeroControlePNCP": "a", "objetoCompra": "obra"}])
    procurement.ingest(spark, landing, lake, [2024], ingest_date="2024-02-01")
    again = {r.category: r for r in procurement.ingest(spark, landing, lake, [2024]).collect()}
    assert again["Concorrência Eletrônica"].windows == 11  # the answered one is skipped, the others never landed
    fresh = {r.category: r for r in procurement.ingest(spark, landing, lake, [2024], mode="overwrite").collect()}
    assert fresh["Concorrência Eletrônica"].windows == 12 and fresh["Concorrência Eletrônica"].found == 1
    assert procurement.read_bronze(spark, lake).count() == 1  # overwrite replaced the bronze


def test_stream_dedup_with_watermark(spark, tmp):
    from lavra.streaming import stream_distinct_keys
    src = f"{tmp}/ev"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as fh:
        fh.write('{"k": 1, "ts": "2024-01-01T00:00:00"}\n{"k": 1, "ts": "2024-01-01T00:10:00"}\n'
                 '{"k": 2, "ts": "2024-01-01T00:20:00"}\n')
    out = stream_distinct_keys(spark, src, "k bigint, ts timestamp", ["k"], f"{tmp}/lake",
                               event_time="ts", delay="1 hour")
    assert sorted(r.k for r in out.collect()) == [1, 2]


def test_jsonl_sink_keeps_nulls(spark, tmp):
    from lavra.sources import write_jsonl
    df = spark.createDataFrame([("x", None)], "a string, b string")
    write_jsonl(df, f"{tmp}/out")
    text = "".join(open(os.path.join(f"{tmp}/out", f)).read()
                   for f in os.listdir(f"{tmp}/out") if f.endswith(".json"))
    assert json.loads(text.strip()) == {"a": "x", "b": None}


def test_investment_sources_are_isolated(spark, tmp):
    from lavra import config
    from lavra.plans import investments
    names = [n for n, *_ in config.INVESTMENT_SOURCES]
    sep = config.INVESTMENT_SOURCES[0][2]
    with open(f"{tmp}/ok.csv", "w") as fh:
        fh.write(sep.join(["Valor ($)", "Nome"]) + "\n" + sep.join(["1.5", "NA"]) + "\n" + "2\n")
    ok, failed = investments.load_all(spark, {names[0]: f"{tmp}/ok.csv", names[1]: f"{tmp}/missing.csv"},
                                      "2024-01-01", f"{tmp}/lake")
    assert set(ok) == {names[0]} and set(failed) == {names[1]}
    rows = sorted((r.valor_s, r.nome) for r in read_snapshot(spark, ok[names[0]]).collect())
    assert rows == [(1.5, None), (2.0, None)]


def test_tender_ingest_batches_retries_and_silver(spark, tmp):
    from lavra.plans import tender_ingest as job
    landing, lake = f"{tmp}/landing", f"{tmp}/lake"
    os.makedirs(landing)

    def land(period, blob):
        with open(f"{landing}/licitacoes_{period}.zip", "wb") as fh:
            fh.write(bytes(blob))

    def lines(obj="Obras e servicos de engenharia", n=1):
        cells = ["SP", "Pref", "1", "conc", obj, "desc", "item", "2", "un", "1,5", "1,5", "un", "1", "2", "un", "7",
                 "05/03/2023", "cnpj", "Ana", "hab", "NA"]
        return [";".join(f"h{i}" for i in range(21))] + [";".join([*cells[:2], str(i), *cells[3:]]) for i in range(n)]

    for m in range(1, 6):
        land(f"2023-{m:02d}", _tender_zip(lines(n=m)))
    land("2023-06", b"broken")
    land("2023-07", _tender_zip(lines(obj="Outro")))
    first = {r.period: r for r in job.ingest(spark, landing, lake, [2023], "2023-08-01", 2, True).collect()}
    assert {p: r.status for p, r in first.items()} == {**{f"2023-{m:02d}": "ok" for m in range(1, 6)},
                                                       "2023-06": "failed", "2023-07": "failed"}
    assert [first[f"2023-{m:02d}"].batch_id for m in range(1, 6)] == [0, 0, 1, 1, 2]
    assert first["2023-06"].error.startswith("BadZipFile") and first["2023-07"].rows_seen == 1
    # the failed ones are tried again, the others skipped
    land("2023-06", _tender_zip(lines(n=9)))
    again = {r.period: r.status for r in job.ingest(spark, landing, lake, [2023], "2023-08-02", 2, False).collect()}
    assert again == {"2023-06": "ok", "2023-07": "ok"}
    assert job.ingest(spark, landing, lake, [2023], "2023-08-03").count() == 0
    assert spark.read.parquet(f"{lake}/bronze").count() == 15 + 9
    assert job.write_silver(spark, lake).count() == 24

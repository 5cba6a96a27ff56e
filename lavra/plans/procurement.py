"""Procurement notices: landed API pages → bronze → silver → summary.

Bronze keeps each notice as its JSON text plus lineage; silver flattens it
with a declared schema, parses timestamps, classifies the works type and
keeps the first copy of each control number; the summary counts notices
and adds estimated value per (works type, government sphere).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from .. import config
from ..functions import first_match_regex, lower_contains_any, parse_iso
from ..operators import (commit_keys, flatten_json, grouped_report, keep_first, pending,
                         read_ledger, reset_ledger, window_diagnostics, window_plan)
from ..sources.jsonl import missing_path, page_reader
from ..sources.snapshots import publish, read_snapshot

PAYLOAD_SCHEMA = """
numeroControlePNCP string, numeroCompra string, processo string, anoCompra bigint,
sequencialCompra bigint, objetoCompra string, modalidadeId bigint, modalidadeNome string,
modoDisputaId bigint, modoDisputaNome string, srp boolean, situacaoCompraId bigint,
situacaoCompraNome string, valorTotalEstimado double, valorTotalHomologado double,
dataPublicacaoPncp string, dataInclusao string, dataAtualizacao string,
dataAberturaProposta string, dataEncerramentoProposta string,
orgaoEntidade struct<cnpj: string, razaoSocial: string, poderId: string, esferaId: string>,
unidadeOrgao struct<codigoUnidade: string, nomeUnidade: string, codigoIbge: string,
                    municipioNome: string, ufSigla: string>,
amparoLegal struct<codigo: bigint, nome: string>, linkSistemaOrigem string, usuarioNome string
""".replace("\n", " ")

BRONZE_SCHEMA = ("payload string, fonte string, modalidade string, ano_referencia string, "
                 "dt_ingestao string, source_file string, position bigint")

# silver column ← payload path
SILVER_FIELDS = [
    ("numero_controle_pncp", "numeroControlePNCP"), ("numero_compra", "numeroCompra"),
    ("numero_processo", "processo"), ("ano_compra", "anoCompra"),
    ("sequencial_compra", "sequencialCompra"), ("objeto_compra", "objetoCompra"),
    ("modalidade_id", "modalidadeId"), ("modalidade_nome", "modalidadeNome"),
    ("modo_disputa_id", "modoDisputaId"), ("modo_disputa_nome", "modoDisputaNome"),
    ("sistema_registro_preco", "srp"), ("situacao_id", "situacaoCompraId"),
    ("situacao_nome", "situacaoCompraNome"), ("valor_estimado", "valorTotalEstimado"),
    ("valor_homologado", "valorTotalHomologado"), ("dt_publicacao_pncp", "dataPublicacaoPncp"),
    ("dt_inclusao", "dataInclusao"), ("dt_atualizacao", "dataAtualizacao"),
    ("dt_abertura_proposta", "dataAberturaProposta"),
    ("dt_encerramento_proposta", "dataEncerramentoProposta"),
    ("orgao_cnpj", "orgaoEntidade.cnpj"), ("orgao_razao_social", "orgaoEntidade.razaoSocial"),
    ("orgao_poder_id", "orgaoEntidade.poderId"), ("orgao_esfera_id", "orgaoEntidade.esferaId"),
    ("unidade_codigo", "unidadeOrgao.codigoUnidade"), ("unidade_nome", "unidadeOrgao.nomeUnidade"),
    ("municipio_ibge", "unidadeOrgao.codigoIbge"), ("municipio_nome", "unidadeOrgao.municipioNome"),
    ("uf", "unidadeOrgao.ufSigla"), ("amparo_legal_codigo", "amparoLegal.codigo"),
    ("amparo_legal_nome", "amparoLegal.nome"), ("link_sistema_origem", "linkSistemaOrigem"),
    ("sistema_origem", "usuarioNome"),
]
TIMESTAMP_COLUMNS = ["dt_publicacao_pncp", "dt_inclusao", "dt_atualizacao",
                     "dt_abertura_proposta", "dt_encerramento_proposta"]
LINEAGE = ["fonte", "modalidade", "ano_referencia", "dt_ingestao"]
BRONZE_ORDER = ["dt_ingestao", "source_file", "position", "payload"]


def is_works() -> Column:
    """The notice's object text holds a works keyword (lower-cased, plain substring)."""
    return lower_contains_any(F.get_json_object("payload", "$.objetoCompra"), config.WORKS_KEYWORDS)


def works_filter(bronze: DataFrame) -> DataFrame:
    """Keep works notices (``is_works``)."""
    return bronze.filter(is_works())


def silver_from_bronze(bronze: DataFrame) -> DataFrame:
    """Flatten, type, classify, keep the first copy of each control number.

    Malformed payloads are kept out of silver instead of failing the whole
    rebuild (count them with ``malformed_count``). They sort after every
    valid row of their key and are dropped after the window, so the JSON is
    parsed once: a filter before the window would be pushed down and parse
    every payload a second time.
    """
    flat = flatten_json(bronze, "payload", PAYLOAD_SCHEMA, SILVER_FIELDS,
                        keep=LINEAGE + ["source_file", "position", "payload"],
                        corrupt_flag="_malformed")
    typed = flat.withColumns({c: parse_iso(c) for c in TIMESTAMP_COLUMNS})
    typed = typed.withColumn("tipo_obra", first_match_regex("objeto_compra", config.WORKS_TYPE_RULES,
                                                           config.WORKS_TYPE_DEFAULT))
    first = keep_first(typed, ["numero_controle_pncp"], ["_malformed"] + BRONZE_ORDER)
    return first.filter(~F.col("_malformed")).drop("source_file", "position", "payload", "_malformed")


def malformed_count(bronze: DataFrame) -> int:
    flat = flatten_json(bronze, "payload", PAYLOAD_SCHEMA, [], corrupt_flag="_malformed")
    return flat.filter(F.col("_malformed")).count()


def report(silver: DataFrame) -> DataFrame:
    """Notices and estimated value (millions, 2 decimals) per works type and sphere."""
    return grouped_report(silver, ["tipo_obra", "orgao_esfera_id"], "numero_controle_pncp",
                          "valor_estimado", count_name="qtd", sum_name="valor_total_mi",
                          scale=1e6, digits=2, order=[F.desc("qtd")])


def categories(spark: SparkSession) -> DataFrame:
    rows = [(c, g, n) for c, g, n in config.PROCUREMENT_MODALITIES]
    return spark.createDataFrame(rows, "category int, granularity string, name string")


# landing/<category>/<start>_<end>/page_<n>.json, or the same as partition folders
# (category=…/window=…_…/page=<n>/part-….json); a failed call lands an envelope with
# ``error``, or a file ending in .error. A file that names no page may hold an array of
# envelopes, each with its numeroPagina: small pages need no file each
_WINDOW = r"/(?:category=)?(\d+)/(?:window=)?(\d{8})_(\d{8})/"
PAGE_SCHEMA = "data array<string>, totalPaginas bigint, error string, numeroPagina int"


def _window_key(path: Column) -> Column:
    parts = [F.regexp_extract(path, _WINDOW, g) for g in (1, 2, 3)]
    return F.when(parts[0] != "", F.concat_ws(":", *parts))


def landed_folders(spark: SparkSession, landing: str) -> DataFrame:
    """key, folder, n_errors of every landed window: a listing, no file is opened.

    An error file counts until its page is landed beside it.
    """
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.{json,error}").load(landing).select("path"))
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return spark.createDataFrame([], "key string, folder string, n_errors bigint")
    return (files.withColumn("key", _window_key(F.col("path"))).filter("key is not null")
            .groupBy("key", F.regexp_extract("path", r"^(.*?)" + _WINDOW[:-1], 0).alias("folder"))
            .agg(F.size(F.array_except(F.collect_set(F.regexp_extract("path", r"([^/]+)\.error$", 1)),
                                       F.array_append(F.collect_set(F.regexp_extract("path", r"([^/]+)\.json$", 1)),
                                                      F.lit("")))).cast("bigint").alias("n_errors")))


def landed_pages(spark: SparkSession, folders: list[str]) -> DataFrame:
    """One row per page of the given window folders: key, page, records as JSON text, total, error."""
    if not folders:
        return spark.createDataFrame([], "key string, page int, source_file string, data array<string>, totalPaginas bigint, error string")
    pages = (page_reader(spark, PAGE_SCHEMA).option("pathGlobFilter", "*.json")
             .option("recursiveFileLookup", "true").json(folders)
             .withColumn("source_file", F.col("_metadata.file_path")))
    named = F.regexp_extract("source_file", r"page[_=](\d+)", 1).try_cast("int")
    # the records of a file's pages are numbered from 0 in each page, so the page is part of what they come from
    source = F.when(named.isNull() & F.col("numeroPagina").isNotNull(), F.concat_ws("#", "source_file", "numeroPagina"))
    return pages.select(_window_key(F.col("source_file")).alias("key"), F.coalesce(named, "numeroPagina").alias("page"),
                        F.coalesce(source, "source_file").alias("source_file"), "data", "totalPaginas", "error")


STAGE = ("key string, page int, source_file string, totalPaginas bigint, error string, good boolean, rows_seen int, "
         "kept array<struct<position: int, payload: string>>")


def stage_pages(pages: DataFrame, path: str, seen: Observation | None = None) -> DataFrame:
    """Landed pages → their works records and counts, parsed once and stored; read back.

    ``seen`` counts pages, failed pages, records and works records while they are written.
    """
    records = F.transform("data", lambda x, i: F.struct(i.alias("position"), x.alias("payload")))
    kept = F.filter(records, lambda r: lower_contains_any(F.get_json_object(r["payload"], "$.objetoCompra"), config.WORKS_KEYWORDS))
    good = F.col("error").isNull() & F.col("data").isNotNull()
    staged = pages.select("key", "page", "source_file", "totalPaginas", "error", good.alias("good"),
                          F.coalesce(F.size("data"), F.lit(0)).alias("rows_seen"), F.coalesce(kept, F.array()).alias("kept"))
    if seen is not None:
        staged = staged.observe(seen, F.count(F.lit(1)).alias("pages"), F.count_if(~F.col("good")).alias("pages_failed"),
                                F.coalesce(F.sum("rows_seen"), F.lit(0)).alias("rows_seen"),
                                F.coalesce(F.sum(F.size("kept")), F.lit(0)).alias("rows_kept"))
    staged.write.mode("overwrite").parquet(path)
    return pages.sparkSession.read.schema(STAGE).parquet(path)


def landed_counts(staged: DataFrame) -> DataFrame:
    """Per window: pages landed of how many, failed pages not landed since, records seen and kept; no text is read."""
    good = F.col("good")
    return staged.groupBy("key").agg(
        F.size(F.collect_set(F.when(good, F.col("page")))).alias("n_pages"),
        F.coalesce(F.max(F.when(good, F.col("totalPaginas"))), F.lit(0)).alias("total"),
        F.size(F.array_except(F.collect_set(F.when(~good, F.coalesce("page", F.lit(-1)))),
                              F.collect_set(F.when(good, F.col("page"))))).alias("n_failed"),
        F.sum(F.col("rows_seen").cast("bigint")).alias("rows_seen"),
        F.sum(F.size("kept.position").cast("bigint")).alias("rows_kept"))


def ingest(spark: SparkSession, landing: str, lake: str, years: list[int],
           mode: str = "append", ingest_date: str | None = None, seen: Observation | None = None) -> DataFrame:
    """Incremental bronze load with commit-after-write; returns per-category diagnostics.

    A landed page is parsed once, where its works records are staged; bronze, the
    outcome of each window and ``seen`` (pages, pages_failed, rows_seen,
    rows_kept of this run) come from that. Windows in the ledger are skipped, and only the folders of pending windows
    are read. Their rows are appended to bronze (a failed or incomplete window
    keeps its partial rows and is retried; silver keeps the first copy). A
    window is committed, after the bronze write, only if it was answered in
    full: a landed page (which may be empty), no failed call, and every page
    from 1 to ``totalPaginas``. A window with nothing landed stays pending.
    Nothing is written where no pending window has landed anything.
    """
    ledger, bronze = f"{lake}/_ledger", f"{lake}/bronze"
    if mode == "overwrite":
        reset_ledger(spark, ledger, "procurement")
    year_df = spark.createDataFrame([(y,) for y in years], "year int")
    plan = window_plan(categories(spark), year_df)
    committed = read_ledger(spark, ledger, "procurement")
    # no .cache() here: cached data is matched by plan, and a plan over the
    # ledger path looks the same before and after the ledger changes
    todo = pending(plan, committed)
    # at most one folder per planned window
    landed = landed_folders(spark, landing).join(todo.select("key"), "key", "left_semi").collect()
    errors = spark.createDataFrame([(r["key"], r["n_errors"]) for r in landed], "key string, n_errors bigint")
    run = uuid.uuid4().hex
    pages = landed_pages(spark, [r["folder"] for r in landed])
    if landed or mode == "overwrite":
        pages = stage_pages(pages, f"{lake}/_stage/run={run}", seen)
        day = F.lit(ingest_date) if ingest_date else F.date_format(F.current_date(), "yyyy-MM-dd")
        new = (pages.filter("error is null").select("key", "source_file", F.explode("kept").alias("r"))
               .join(todo.select("key", "name", "start"), "key").select(
            F.col("r.payload").alias("payload"), F.lit("pncp").alias("fonte"), F.col("name").alias("modalidade"),
            F.substring("start", 1, 4).alias("ano_referencia"), day.alias("dt_ingestao"),
            "source_file", F.col("r.position").cast("bigint").alias("position")))
        new.write.mode("overwrite" if mode == "overwrite" else "append").parquet(bronze)
    else:
        pages = spark.createDataFrame([], STAGE)
    events = F.coalesce("n_errors", F.lit(0)) + F.coalesce("n_failed", F.lit(0))
    outcome = (plan.join(landed_counts(pages), "key", "left").join(errors, "key", "left")
               .join(todo.select("key", F.lit(False).alias("pending_flag")), "key", "left")
               .select("key", F.col("name").alias("category"), F.col("pending_flag").isNull().alias("skipped"),
                       events.alias("n_events"), F.coalesce("rows_seen", F.lit(0)).alias("rows_seen"),
                       F.coalesce("rows_kept", F.lit(0)).alias("rows_kept"),
                       ((F.coalesce("n_pages", F.lit(0)) > 0) & (events == 0)
                        & (F.col("n_pages") >= F.col("total"))).alias("complete")))
    if not landed:
        return window_diagnostics(outcome)
    # the run's outcome table (one row per window) is written once; the commit
    # and the diagnostics both read that snapshot, taken before the ledger grows
    run_path = f"{lake}/_outcomes/run={run}"
    outcome.write.mode("overwrite").parquet(run_path)
    snapshot = spark.read.schema(outcome.schema).parquet(run_path)
    commit_keys(snapshot.filter(~F.col("skipped") & F.col("complete")).select("key"), ledger, "procurement")
    return window_diagnostics(snapshot)


def read_bronze(spark: SparkSession, lake: str) -> DataFrame:
    """Bronze rows; none before the first ingest. Any other read error is raised."""
    try:
        return spark.read.schema(BRONZE_SCHEMA).parquet(f"{lake}/bronze")
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return spark.createDataFrame([], BRONZE_SCHEMA)


def write_silver(spark: SparkSession, lake: str) -> DataFrame:
    """Rebuild silver from all of bronze as the table's next version; returns it. Readers keep the last one till then."""
    path = f"{lake}/silver"
    publish(silver_from_bronze(read_bronze(spark, lake)), path)
    return read_snapshot(spark, path)

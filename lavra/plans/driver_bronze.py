"""Domain bronze tables derived from the driver's tables (so work grows with them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .tables import table

# Parameters of the derived bronze (not source-system values).
OBJECT_WORDS = ["pavimentação asfáltica", "obra de saneamento e ÁGUA", "reforma da escola",
                "ponte e viaduto", "habitação popular", "drenagem de córrego", "praça e parque",
                "construção de edifício"]
SPHERES = {"F": "F", "O": "M", "P": "E"}


def procurement_bronze(spark: SparkSession, d: str, works_only: bool = False) -> DataFrame:
    """Notice payloads from orders: one notice per order.

    Control number = the customer, so a customer's orders are copies and
    silver keeps the one first in bronze order (smallest order key); the
    object text is the priority plus a works phrase picked by the order key;
    the sphere comes from the order status; every 13th order has no
    ``orgaoEntidade`` (null sphere, left out of the summary).

    ``works_only`` applies the works keyword filter to the object text at
    landing time, before it is JSON-encoded (as a fetcher keeps only works
    notices) — the same rows ``works_filter`` keeps from the payloads.
    """
    from .. import config
    from ..operators import keyword_filter
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    word = F.element_at(F.array(*[F.lit(w) for w in OBJECT_WORDS]), (k % 8 + 1).cast("int"))
    o = o.withColumn("__obj", F.concat(F.col("o_orderpriority"), F.lit(" — "), word))
    if works_only:
        o = keyword_filter(o, "__obj", config.WORKS_KEYWORDS)
    sphere = F.create_map(*[x for kv in SPHERES.items() for x in map(F.lit, kv)])[F.col("o_orderstatus")]
    orgao = F.when(k % 13 != 0,
                   F.struct(F.concat(F.lit("cnpj-"), F.col("o_custkey").cast("string")).alias("cnpj"),
                            F.lit("orgao").alias("razaoSocial"), F.lit("E").alias("poderId"),
                            sphere.alias("esferaId")))
    payload = F.to_json(F.struct(
        F.concat(F.lit("pncp-"), F.col("o_custkey").cast("string")).alias("numeroControlePNCP"),
        k.cast("string").alias("numeroCompra"),
        F.col("__obj").alias("objetoCompra"),
        F.col("o_totalprice").alias("valorTotalEstimado"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("dataPublicacaoPncp"),
        orgao.alias("orgaoEntidade")))
    return o.select(payload.alias("payload"), F.lit("pncp").alias("fonte"),
                    F.lit("Pregão Eletrônico").alias("modalidade"),
                    F.year("o_orderdate").cast("string").alias("ano_referencia"),
                    F.lit("2024-01-01").alias("dt_ingestao"),
                    F.lit("orders").alias("source_file"),
                    k.alias("position"))


# Landed API pages derived from orders: order keys per page
PAGE_KEYS = 50_000
REPLAY_CATEGORY, EMPTY_CATEGORY = 4, 5


def landed_replay(spark: SparkSession, d: str) -> DataFrame:
    """Pages of monthly windows: category, window, page, run (when it lands), data, totalPaginas, error.

    A month's orders come in pages of PAGE_KEYS order keys. By month number since
    year 0, modulo 5: 0 lands in run 2 only; 1 lacks its last page in run 1, where it has
    several; 2 fails its first page in run 1; the others land whole in run 1. The
    second category answers every month with one empty page.
    """
    o = table(spark, d, "orders")
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    month = F.trunc(day, "MM")
    word = F.element_at(F.array(*[F.lit(w) for w in OBJECT_WORDS[:4]], F.lit("compra de papel")), (k % 5 + 1).cast("int"))
    notice = F.struct(F.concat(F.lit("pncp-"), k.cast("string")).alias("numeroControlePNCP"), word.alias("objetoCompra"))
    blocks = (o.groupBy(month.alias("m"), F.floor(k / PAGE_KEYS).alias("block"))
              .agg(F.array_sort(F.collect_list(notice)).alias("data")))
    # a month's pages, numbered in the order of their key blocks
    by_month = Window.partitionBy("m")
    paged = blocks.withColumns({"page": F.row_number().over(by_month.orderBy("block")),
                                "totalPaginas": F.count(F.lit(1)).over(by_month)})
    case = (F.year("m") * 12 + F.month("m")) % 5
    window = F.concat_ws("_", F.date_format("m", "yyyyMMdd"), F.date_format(F.last_day("m"), "yyyyMMdd"))
    last = F.col("page") == F.col("totalPaginas")
    late = (case == 0) | ((case == 1) & last & (F.col("page") > 1)) | ((case == 2) & (F.col("page") == 1))
    real = paged.select(F.lit(REPLAY_CATEGORY).alias("category"), window.alias("window"), "page",
                        F.when(late, 2).otherwise(1).alias("run"), "data", "totalPaginas",
                        F.lit(None).cast("string").alias("error"))
    failed = paged.filter((case == 2) & (F.col("page") == 1)).select(
        F.lit(REPLAY_CATEGORY).alias("category"), window.alias("window"), "page", F.lit(1).alias("run"),
        F.lit(None).cast(paged.schema["data"].dataType).alias("data"), F.lit(None).cast("bigint").alias("totalPaginas"),
        F.lit("HTTP 500").alias("error"))
    empty = paged.select("m").distinct().select(
        F.lit(EMPTY_CATEGORY).alias("category"), window.alias("window"), F.lit(1).alias("page"), F.lit(1).alias("run"),
        F.array().cast(paged.schema["data"].dataType).alias("data"), F.lit(0).cast("bigint").alias("totalPaginas"),
        F.lit(None).cast("string").alias("error"))
    return real.unionByName(failed).unionByName(empty)


# pages that a fetcher writes to one file; a page has some hundred records
FILE_PAGES = 16


def replay_files(pages: DataFrame, run: int) -> DataFrame:
    """name, text of the files that a run lands: FILE_PAGES pages of a window in each, as an array of envelopes.

    The run is part of the name, so that a page that failed in the first is not lost when it lands in the second.
    """
    envelope = F.to_json(F.struct(F.col("page").alias("numeroPagina"), "data", "totalPaginas", "error"))
    files = (pages.filter(F.col("run") == run).withColumn("text", envelope)
             .groupBy("category", "window", F.floor((F.col("page") - 1) / FILE_PAGES).alias("part"))
             .agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("texts")))
    name = F.concat_ws("/", F.col("category").cast("string"), "window",
                       F.concat(F.lit(f"run_{run}_part_"), F.col("part").cast("string"), F.lit(".json")))
    return files.select(name.alias("name"), F.concat(F.lit("["), F.array_join(F.transform("texts", lambda t: t["text"]), ","),
                                                     F.lit("]")).alias("text"))


# Mining claims derived from orders (attributes) and customers (geometry).
OTHER_SUBSTANCE = "OURO"
OTHER_PHASE = "DISPONIBILIDADE"


def mining_attributes(spark: SparkSession, d: str) -> DataFrame:
    """ESRI-like attribute rows: claim = customer (copies: one per order), FID = order.

    Every 50th customer's claims have no number (null claims match each other);
    substance and phase cycle through the source lists plus one value outside
    them; every 9th order is outside the state.
    """
    from .. import config
    o = table(spark, d, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    subs = F.array(*[F.lit(s) for s in config.MINING_SUBSTANCES + [OTHER_SUBSTANCE]])
    phases = F.array(*[F.lit(p) for vs, _ in config.MINING_PHASE_GROUPS for p in vs] + [F.lit(OTHER_PHASE)])
    n_subs = len(config.MINING_SUBSTANCES) + 1
    n_phases = sum(len(vs) for vs, _ in config.MINING_PHASE_GROUPS) + 1
    processo = F.when(c % 50 != 0, F.concat(F.lit("P"), c.cast("string")))
    attrs = F.create_map(
        F.lit("PROCESSO"), processo,
        F.lit("FID"), k.cast("string"),
        F.lit("NUMERO"), F.concat((k % 1000).cast("string"), F.lit(".0")),
        F.lit("ANO"), F.year("o_orderdate").cast("string"),
        F.lit("SUBS"), F.element_at(subs, (k % n_subs + 1).cast("int")),
        F.lit("FASE"), F.element_at(phases, (c % n_phases + 1).cast("int")),
        F.lit("AREA_HA"), F.col("o_totalprice").cast("string"),
        F.lit("UF"), F.when(k % 9 == 0, F.lit("MG")).otherwise(F.lit("SP")))
    return o.select(attrs.alias("attributes"), F.lit("orders").alias("source_file"),
                    k.alias("position"))


def mining_geometry(spark: SparkSession, d: str) -> DataFrame:
    """ESRI-like geometry rows from customers: a closed triangle, or no vertices every 11th."""
    cu = table(spark, d, "customer")
    c = F.col("c_custkey")
    x, y = F.col("c_acctbal"), F.col("c_nationkey").cast("double")
    ring = F.array(F.array(x, y), F.array(x + 1.0, y + 1.0), F.array(x, y))
    rings = F.when(c % 11 == 0, F.array(F.array().cast("array<array<double>>"))).otherwise(F.array(ring))
    return cu.select(F.create_map(F.lit("PROCESSO"), F.when(c % 50 != 0, F.concat(F.lit("P"), c.cast("string"))))
                     .alias("attributes"),
                     F.struct(rings.alias("rings")).alias("geometry"),
                     F.lit("customer").alias("source_file"), c.alias("position"))


def _br2(c):
    """``1,234.56`` → ``1.234,56`` (two decimals, Brazilian separators)."""
    return F.translate(F.format_number(c, 2), ",.", ".,")


def tender_lines(spark: SparkSession, d: str) -> DataFrame:
    """Monthly tender CSV lines (21 ``;`` fields) from lineitem, with their period.

    Every 31st order's lines carry an extra field (dropped), every 37th stop
    after five fields (null-padded), every 10th supplier name is quoted and
    holds a ``;``; a third of the lines are not works tenders.
    """
    li = table(spark, d, "lineitem")
    k = F.col("l_orderkey")
    s = F.col("l_suppkey").cast("string")
    entity = F.when(F.col("l_suppkey") % 10 == 0, F.concat(F.lit('"Ent'), s, F.lit(';X"'))) \
              .otherwise(F.concat(F.lit("Ent"), s))
    obj = F.when(F.col("l_linenumber") % 3 == 0, F.lit("Outro")).otherwise(F.lit("Obras e servicos de engenharia"))
    day = F.when(k % 29 == 0, F.lit("31/02/2023")).otherwise(F.date_format("l_shipdate", "d/M/yyyy"))
    proposal = F.when(F.col("l_linenumber") == 7, F.lit("NA")).otherwise(_br2(F.col("l_tax")))
    cells = [F.lit("SP"), entity, k.cast("string"), F.lit("conc"), obj, F.lit("desc"),
             F.col("l_partkey").cast("string"), F.replace(F.col("l_quantity").cast("decimal(10,1)").cast("string"), F.lit("."), F.lit(",")),
             F.lit("un"), _br2(F.col("l_extendedprice")), _br2(F.col("l_extendedprice")), F.lit("un"),
             F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
             F.col("l_discount").cast("decimal(4,2)").cast("string"), F.lit("un"),
             F.col("l_linenumber").cast("string"), day, F.lit("cnpj"),
             F.concat(F.lit(" Part"), s, F.lit("\t")), F.lit("hab"), proposal]
    line = (F.when(k % 31 == 0, F.concat_ws(";", *cells, F.lit("extra")))
             .when(k % 37 == 0, F.concat_ws(";", *cells[:5]))
             .otherwise(F.concat_ws(";", *cells)))
    return li.select(F.date_format("l_shipdate", "yyyy-MM").alias("period"), line.alias("line"))


# Permit workbooks derived from orders: one file per order year, headers drifting by year parity.
PERMIT_OLD_HEADER = ["Mês", "Alvará", "Processo", "Descrição", "Categoria de Uso",
                     "Área da Construção (m²)", "Aprovação", "Numero de Blocos",
                     "Numero de Pavimentos", "Numero de Unidades"]
PERMIT_NEW_HEADER = ["meses", "alvara", "processo", "descricao", "categoria_de_uso",
                     "area_da_construcao", "aprovacao", "B/Locos P/Avimentos U/Nidades"]
PERMIT_CATEGORIES = ["R2-01", "nr1-3", "C1", "comercial", "I2", "E1", "ZM"]


def permit_grid(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Grid rows ``(file, sheet, sheet_idx, row_idx, cells)`` and the ``file → ano`` map."""
    o = table(spark, d, "orders")
    y = F.year("o_orderdate")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    cat = F.element_at(F.array(*[F.lit(x) for x in PERMIT_CATEGORIES], F.lit(None).cast("string")),
                       (k % (len(PERMIT_CATEGORIES) + 1) + 1).cast("int"))
    day = (F.when(k % 23 == 0, F.lit("2023-05-01 00:00:00"))
            .when(k % 2 == 0, F.date_format("o_orderdate", "d/M/yyyy"))
            .otherwise(F.date_format("o_orderdate", "d/M/yy")))
    blocks = F.when(k % 3 == 0, F.lit(" ")).otherwise((k % 4).cast("string"))
    floors = F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise((k % 7).cast("string"))
    units = F.when(k % 2 == 0, F.lit("")).otherwise((c % 9).cast("string"))
    common = [F.month("o_orderdate").cast("string"), F.concat(F.lit("A-"), c.cast("string")),
              F.concat(F.lit("P-"), c.cast("string")), F.col("o_orderpriority"), cat,
              F.translate(F.format_number("o_totalprice", 2), ",.", ".,"), day]
    old = F.array(*common, blocks, floors, units)
    new = F.array(*common, F.concat_ws(" / ", F.coalesce(blocks, F.lit("")), F.coalesce(floors, F.lit("")),
                                       F.coalesce(units, F.lit(""))))
    data = o.select(y.cast("string").alias("file"), F.lit("Dados").alias("sheet"), F.lit(1).alias("sheet_idx"),
                    (k + 2).alias("row_idx"), F.when(y % 2 == 0, old).otherwise(new).alias("cells"))
    years = o.select(y.alias("y")).distinct()
    f = F.col("y").cast("string")
    title = years.select(f.alias("file"), F.lit("Dados").alias("sheet"), F.lit(1).alias("sheet_idx"),
                         F.lit(0).cast("long").alias("row_idx"),
                         F.array(F.concat(F.lit("Relatório "), f)).alias("cells"))
    header = years.select(f.alias("file"), F.lit("Dados").alias("sheet"), F.lit(1).alias("sheet_idx"),
                          F.lit(1).cast("long").alias("row_idx"),
                          F.when(F.col("y") % 2 == 0, F.array(*[F.lit(h) for h in PERMIT_OLD_HEADER]))
                           .otherwise(F.array(*[F.lit(h) for h in PERMIT_NEW_HEADER])).alias("cells"))
    cover = years.select(f.alias("file"), F.lit("Capa").alias("sheet"), F.lit(0).alias("sheet_idx"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("row_idx"),
                         F.array(F.lit("Prefeitura"), f).alias("cells"))
    grid = data.unionByName(title).unionByName(header).unionByName(cover)
    return grid, years.select(f.alias("file"), f.alias("ano"))

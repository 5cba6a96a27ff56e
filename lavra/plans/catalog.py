"""Queries registered for the driver: each operator run over the driver's tables.

Every query reads whole tables (or data Spark derives from them). Dirty or
null inputs the operators exist for are *derived* by fixed rules on keys
(``key % 7 = 0`` → null, …) so the DuckDB oracle can derive the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import config
from ..functions import (br_money, br_quantity, concat_skip_blank, extension, extract_optional_int,
                         first_match_regex, first_match_set, first_ring_centroid, nullable_int,
                         parse_dayfirst, parse_iso, parse_two_formats, snake_ascii,
                         snake_keep_accents, strip_unicode, url_basename, url_host)
from ..operators import (batch_ids, coalesce_variants, commit_keys, contiguous_watermark, coverage,
                         diagnosis, distinct_rows, eq_in_filter, flatten_json, grouped_report,
                         header_rows, keep_first, keyword_filter, latest_variant, monthly_periods, monthly_windows,
                         null_safe_join, override_merge, pending, pending_with_refresh,
                         pick_sheet, positional_rename, preview, project_or_null, read_drifting, read_ledger, reset_ledger, select_sources,
                         stale_commits, union_by_name, weekly_windows, window_diagnostics,
                         window_plan, with_lineage)
from ..session import scratch_path, use_utc
from ..sources import (extract_links, land_bytes, land_texts, list_layer, read_bytes, read_delimited, read_jsonl, read_quoted,
                       read_zip, route_by_extension, write_jsonl, write_zips)
from ..sources.zip_source import open_path
from .driver_bronze import OBJECT_WORDS
from .tables import table

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (not source-system values).
DOC_TERMS = ["license", "und", "que"]
PART_RULES = [("ring|bolt", "fastener"), ("red|blue", "colored"), ("widget|gizmo", "gadget")]
PART_TYPE_GROUPS = [(["ECONOMY", "STANDARD"], "basic"), (["SMALL", "MEDIUM", "LARGE"], "sized"),
                    (["PROMO"], "promo")]
GRID_HEADER_WORDS = ["the", "and", "of", "la", "de", "que", "und", "der"]
FAIL_VALUE = 250.0
AS_OF_YEAR = 1998


def _nullif_mod(c: str, m: int, value: Column | None = None) -> Column:
    """``value`` (default the column) except null when ``c % m = 0``."""
    return F.when(F.col(c) % m != 0, value if value is not None else F.col(c))


def _ntz(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


# ------------------------------------------------------------------ filters
def q_keyword_filter(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return keyword_filter(docs, "text", DOC_TERMS).select("doc_id", "lang", "source", "n_chars")


def q_eq_in_filter(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return eq_in_filter(orders, equals={"o_orderstatus": "F"},
                        isin={"o_orderpriority": ["1-URGENT", "2-HIGH"]},
                        between={"o_orderdate": (_ntz("1996-01-01 00:00:00"),
                                                 _ntz("1998-12-31 00:00:00"))}) \
        .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")


def works_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole document texts; by doc_id, some end with a procurement phrase."""
    docs = table(spark, d, "documents")
    phrase = F.get(F.array(*[F.lit(w) for w in OBJECT_WORDS]), (F.col("doc_id") % (len(OBJECT_WORDS) + 3)).cast("int"))
    return docs.withColumn("text", F.concat_ws(" ", "text", phrase))


def q_works_keyword_filter(spark: SparkSession, d: str) -> DataFrame:
    """The procurement keyword list itself, over every document text."""
    docs = works_documents(spark, d)
    return keyword_filter(docs, "text", config.WORKS_KEYWORDS).select("doc_id", "lang")


# ------------------------------------------------------------- projections
EVENT_PAYLOAD_SCHEMA = ("numero bigint, tipo string, valor double, data string, "
                        "dono struct<usuario: bigint, props: struct<k: bigint>>")


def event_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Nested JSON documents built from events; every 11th is not JSON at all."""
    ev = table(spark, d, "events")
    owner = F.when(F.col("event_id") % 7 != 0,
                   F.struct(F.col("user_id").alias("usuario"),
                            F.from_json("props", "k bigint").alias("props")))
    doc = F.to_json(F.struct(F.col("event_id").alias("numero"), F.col("event_type").alias("tipo"),
                             F.col("value").alias("valor"), F.col("ts").cast("string").alias("data"),
                             owner.alias("dono")))
    payload = F.when(F.col("event_id") % 11 == 0,
                     F.concat(F.lit("{broken "), F.col("event_id").cast("string"))).otherwise(doc)
    return ev.select("event_id", payload.alias("payload"))


def q_json_flatten(spark: SparkSession, d: str) -> DataFrame:
    flat = flatten_json(event_payloads(spark, d), "payload", EVENT_PAYLOAD_SCHEMA,
                        [("numero", "numero"), ("tipo", "tipo"), ("valor", "valor"),
                         ("usuario", "dono.usuario"), ("k", "dono.props.k")],
                        keep=["event_id"], corrupt_flag="corrupt")
    return flat


def q_rename_or_null(spark: SparkSession, d: str) -> DataFrame:
    sup = table(spark, d, "supplier")
    out = project_or_null(sup, [("fornecedor", "s_suppkey"), ("nome", "s_name"),
                                ("nacao", "s_nationkey"), ("saldo", "s_acctbal"),
                                ("telefone", "s_phone")])
    return with_lineage(out, fonte="supplier")


MESSY_NAMES = ["Código da Nação", "Nome  da Nação ($)", " Região/Área (m²) ",
               "Nação  Chave", "Área da Construção (m²)"]


def q_normalize_names(spark: SparkSession, d: str) -> DataFrame:
    sup = table(spark, d, "supplier")
    messy = sup.select(F.col("s_suppkey").alias(MESSY_NAMES[0]),
                       F.col("s_name").alias(MESSY_NAMES[1]),
                       F.col("s_nationkey").alias(MESSY_NAMES[2]),
                       F.col("s_suppkey").alias(MESSY_NAMES[3]),
                       F.col("s_name").alias(MESSY_NAMES[4]))
    names = [snake_ascii(n) for n in messy.columns[:3]] + \
            [snake_keep_accents(n) for n in messy.columns[3:]]
    return positional_rename(messy, names)


def q_coalesce_variants(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    even = orders.filter(F.col("o_orderkey") % 2 == 0).select(
        F.col("o_orderkey").alias("pedido"), F.col("o_totalprice").alias("valor"),
        F.col("o_orderdate").alias("data_pedido"))
    odd = orders.filter(F.col("o_orderkey") % 2 == 1).select(
        F.col("o_orderkey").alias("pedido"), F.col("o_totalprice").alias("valor_total"),
        F.col("o_orderstatus").alias("situacao"))
    both = union_by_name([even, odd])
    return both.select("pedido", coalesce_variants(both, ["valor", "valor_total"]).alias("valor"),
                       "data_pedido", "situacao")


def q_widened_union(spark: SparkSession, d: str) -> DataFrame:
    """Files of orders whose columns drift: a whole, a fractional and a text code, dates and timestamps, a column that comes later."""
    path, o, k = scratch_path(spark, "drifting"), table(spark, d, "orders"), F.col("o_orderkey")
    parts = [
        o.select(k.alias("pedido"), (k % 1000).cast("int").alias("codigo"), (k % 7).cast("int").alias("n"),
                 F.to_date("o_orderdate").alias("data")),
        o.select(k.alias("pedido"), ((k % 1000) / 2).alias("codigo"), (k * 3).alias("n"), F.col("o_orderdate").alias("data")),
        o.select(k.alias("pedido"), F.concat(F.lit("c"), k.cast("string")).alias("codigo"), F.col("o_totalprice").alias("n"),
                 F.col("o_orderdate").alias("data"), F.col("o_orderstatus").alias("novo"))]
    for i, part in enumerate(parts):
        part.filter(k % 3 == i).write.parquet(f"{path}/{i}")
    return read_drifting(spark, path)[0]


# ---------------------------------------------------------------- classify
def q_classify_regex(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    return part.select("p_partkey", first_match_regex("p_name", PART_RULES, "other").alias("cls"))


def q_classify_works(spark: SparkSession, d: str) -> DataFrame:
    """The works-type and land-use rule lists over every document text."""
    docs = works_documents(spark, d).select("doc_id", "text")
    return docs.select("doc_id",
                       first_match_regex("text", config.WORKS_TYPE_RULES,
                                         config.WORKS_TYPE_DEFAULT).alias("tipo_obra"),
                       first_match_regex("text", config.LAND_USE_RULES,
                                         config.LAND_USE_DEFAULT).alias("uso_classificado"))


def q_classify_set(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    substance = F.get(F.array(*[F.lit(s) for s in config.MINING_SUBSTANCES]),
                      (F.col("p_partkey") % (len(config.MINING_SUBSTANCES) + 1)).cast("int"))
    return part.select("p_partkey",
                       first_match_set("p_type", PART_TYPE_GROUPS, config.OTHER_GROUP).alias("grupo"),
                       first_match_set(substance, config.MINING_AGGREGATE_GROUPS,
                                       config.OTHER_GROUP).alias("tipo_agregado"))


# ------------------------------------------------------------------ parsing
def _br_text() -> Column:
    br = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    us = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    k = F.col("o_orderkey")
    return (F.when(k % 11 == 0, F.lit("12d")).when(k % 13 == 0, us)
             .when(k % 17 == 0, F.lit("NA")).otherwise(br))


def q_br_decimal_parse(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", _br_text().alias("txt"))
    return orders.select("o_orderkey", br_money("txt").alias("valor"),
                         br_quantity("txt").alias("qtd"))


def q_nullable_int(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    q = F.col("l_quantity").cast("string")
    txt = (F.when(F.col("l_linenumber") == 3, F.concat(q, F.lit("5")))
            .when(F.col("l_linenumber") == 5, F.concat(F.lit("x"), q)).otherwise(q))
    return li.select("l_orderkey", "l_linenumber", "l_quantity",
                     nullable_int(txt).alias("qtd_int"))


def q_iso_ts_parse(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    s = F.col("ts").cast("string")
    k = F.col("event_id")
    txt = (F.when(k % 17 == 0, F.lit("not a date")).when(k % 19 == 0, F.year("ts").cast("string"))
            .when(k % 23 == 0, F.substring(s, 1, 10)).otherwise(s))
    return ev.select("event_id", parse_iso(txt).alias("ts_parsed"))


def q_dayfirst_parse(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "d/M/yyyy")
    txt = (F.when(k % 29 == 0, F.lit("31/02/2023"))
            .when(k % 2 == 1, F.concat(day, F.lit(" 10:30:00"))).otherwise(day))
    return o.select("o_orderkey", parse_dayfirst(txt).alias("dt"))


def q_multi_date_parse(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    txt = (F.when(k % 29 == 0, F.lit("31/02/99"))
            .when(k % 2 == 1, F.date_format("o_orderdate", "d/M/yy"))
            .otherwise(F.date_format("o_orderdate", "d/M/yyyy")))
    return o.select("o_orderkey", parse_two_formats(txt).alias("dt"))


def q_strip_text(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    left = F.when(k % 3 == 0, F.lit("\t")).when(k % 3 == 1, F.lit(" ")).otherwise(F.lit("\u00a0"))
    right = F.when(k % 2 == 0, F.lit("  ")).otherwise(F.lit("\u3000"))
    return p.select("p_partkey", strip_unicode(F.concat(left, F.col("p_name"), right)).alias("nome"))


def q_concat_skip_blank(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    a = F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 4 == 1, F.lit("  ")) \
         .otherwise(F.col("p_brand"))
    b = F.when(k % 3 == 0, F.lit(" ")).otherwise(F.col("p_size").cast("string"))
    c = F.when(k % 7 == 0, F.lit("")).otherwise(F.col("p_type"))
    direct = F.when(k % 5 == 0, F.col("p_name"))
    return p.select("p_partkey",
                    F.coalesce(direct, concat_skip_blank(" / ", a, b, c)).alias("blocos"))


def q_centroid(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    pairs = F.transform(F.sequence(F.lit(0), (F.size("embedding") / 2).cast("int") - 1),
                        lambda i: F.array(F.get("embedding", i * 2).cast("double"),
                                          F.get("embedding", i * 2 + 1).cast("double")))
    k = F.col("vec_id")
    rings = (F.when(k % 10 == 0, F.array().cast("array<array<array<double>>>"))
              .when(k % 10 == 1, F.array(F.array().cast("array<array<double>>")))
              .otherwise(F.array(pairs)))
    lat, lon = first_ring_centroid(rings)
    return e.select("vec_id", lat.alias("lat"), lon.alias("lon"))


# ------------------------------------------------------------- dedup / join
def q_dedup_first(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").withColumn("k", _nullif_mod("l_orderkey", 7))
    first = keep_first(li, ["k"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                   "l_extendedprice", "l_orderkey", "l_shipdate"])
    return first.select("k", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def q_distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return distinct_rows(table(spark, d, "documents"), ["lang", "source"])


def q_left_join_nullsafe(spark: SparkSession, d: str) -> DataFrame:
    cust = table(spark, d, "customer").select("c_custkey", _nullif_mod("c_custkey", 7, F.col("c_nationkey")).alias("nk"))
    nat = table(spark, d, "nation").select(
        F.when(F.col("n_nationkey") != 3, F.col("n_nationkey")).alias("nk"), "n_name")
    cust = keep_first(cust, ["c_custkey"], ["nk"])
    nat = keep_first(nat, ["nk"], ["n_name"])
    return null_safe_join(cust, nat, ["nk"], "left").select("c_custkey", "nk", "n_name")


# --------------------------------------------------------- windows / ledger
def _order_years(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.year("o_orderdate").alias("year")).distinct()


def q_monthly_windows(spark: SparkSession, d: str) -> DataFrame:
    return monthly_windows(_order_years(spark, d))


def q_weekly_windows(spark: SparkSession, d: str) -> DataFrame:
    return weekly_windows(_order_years(spark, d))


PERIOD_URL = "https://landing.invalid/licitacoes_%s.zip"


def q_period_urls(spark: SparkSession, d: str) -> DataFrame:
    return monthly_periods(_order_years(spark, d), url_template=PERIOD_URL)


def q_url_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", url_basename("url").alias("base"), extension("url").alias("ext"),
                                           url_host("url").alias("host"))


def q_jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Customers with nulls through JSON lines: the rows read back, and how many fields each line holds."""
    path, k = scratch_path(spark, "jsonl"), F.col("c_custkey")
    write_jsonl(table(spark, d, "customer").select("c_custkey", F.when(k % 7 != 0, F.col("c_name")).alias("nome"),
                                                   F.when(k % 5 != 0, F.col("c_acctbal")).alias("saldo")), path)
    rows = read_jsonl(spark, path, "c_custkey bigint, nome string, saldo double")
    lines = spark.read.text(path).select(F.get_json_object("value", "$.c_custkey").cast("bigint").alias("c_custkey"),
                                         F.size(F.json_object_keys("value")).alias("n_fields"))
    return rows.join(lines, "c_custkey")


def q_landed_layer(spark: SparkSession, d: str) -> DataFrame:
    """Files of three types landed under one layer (and a decoy beside it), listed, routed, read and kept as bytes."""
    root, k = scratch_path(spark, "layers"), F.col("s_suppkey")
    ext = F.element_at(F.array(F.lit(".csv"), F.lit(".ZIP"), F.lit(".xlsx")), (k % 3 + 1).cast("int"))
    layer = F.when(k % 10 == 7, "bronze/raw_old/").otherwise("bronze/raw/")
    files = table(spark, d, "supplier").select(F.concat(layer, k.cast("string"), ext).alias("name"),
                                               F.concat_ws(";", k.cast("string"), "s_name").alias("text"))
    land_texts(files, root)
    routes = route_by_extension(list_layer(spark, root, "bronze/raw"), ["csv", "zip", "xlsx"])
    typed = union_by_name([f.select("path", F.lit(kind).alias("kind")) for kind, f in routes.items()])
    land_bytes(read_bytes(spark, f"{root}/bronze/raw"), f"{root}/kept")
    kept = spark.read.parquet(f"{root}/kept").join(typed, "path")
    return kept.select(url_basename("path").alias("name"), "kind", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def q_ledger_replay(spark: SparkSession, d: str) -> DataFrame:
    """Commits of order months by two pipelines, a reset of one, and its commits after that."""
    path, o = scratch_path(spark, "ledger"), table(spark, d, "orders")
    months = o.select(_months(o, "o_orderdate").alias("key")).distinct()
    third = months.filter(F.substring("key", 6, 2).cast("int") % 3 == 0)
    for keys, pipeline in ((months, "a"), (third, "b")):
        commit_keys(keys, path, pipeline)
    reset_ledger(spark, path, "a")
    commit_keys(third.filter("key < '1997'"), path, "a")
    return union_by_name([read_ledger(spark, path, p).select(F.lit(p).alias("pipeline"), "key") for p in ("a", "b")])


def q_sources_load(spark: SparkSession, d: str) -> DataFrame:
    """Two registered sources, one of them missing: what is loaded and what is reported."""
    from . import investments
    from ..sources.snapshots import read_snapshot
    path, lake = scratch_path(spark, "sources_csv"), scratch_path(spark, "sources_lake")
    table(spark, d, "customer").select("c_custkey", "c_name").write.option("header", "true").option("sep", ";").csv(path)
    names = [n for n, *_ in config.INVESTMENT_SOURCES[:2]]
    ok, failed = investments.load_all(spark, {names[0]: path, names[1]: f"{path}/none"}, "2024-01-01", lake)
    found = [read_snapshot(spark, p).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("fonte"), F.lit("ok").alias("status"), "n")
             for n, p in ok.items()]
    lost = [spark.range(1).select(F.lit(n).alias("fonte"), F.lit("failed").alias("status"), F.lit(0).cast("bigint").alias("n")) for n in failed]
    return union_by_name(found + lost)


def modality_catalog(spark: SparkSession) -> DataFrame:
    rows = [(c, g, n) for c, g, n in config.PROCUREMENT_MODALITIES]
    cat = spark.createDataFrame(rows, "category int, granularity string, name string")
    return cat


def q_window_plan(spark: SparkSession, d: str) -> DataFrame:
    return window_plan(modality_catalog(spark), _order_years(spark, d)) \
        .select("category", "name", "granularity", "year", "start", "end", "key")


def _months(df: DataFrame, c: str) -> Column:
    return F.date_format(c, "yyyy-MM")


def _ledger_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    planned = o.select(_months(o, "o_orderdate").alias("key")).distinct()
    committed = (li.filter(F.month("l_shipdate") % 3 == 0)
                   .select(_months(li, "l_shipdate").alias("key")).distinct())
    present = o.filter(F.col("o_orderstatus") == "F").select(_months(o, "o_orderdate").alias("key")).distinct()
    return planned, committed, present


def q_ledger_pending(spark: SparkSession, d: str) -> DataFrame:
    planned, committed, present = _ledger_inputs(spark, d)
    new = pending(planned, committed).withColumn("reason", F.lit("new"))
    stale = (stale_commits(committed, present).join(planned, "key", "left_semi")
             .withColumn("reason", F.lit("missing_data")))
    return new.unionByName(stale)


def q_refresh_current(spark: SparkSession, d: str) -> DataFrame:
    planned, committed, _ = _ledger_inputs(spark, d)
    return pending_with_refresh(planned, committed, F.substring("key", 1, 4).cast("int"), AS_OF_YEAR)


def q_source_selection(spark: SparkSession, d: str) -> DataFrame:
    # every customer requests a source: its region's name (every 5th) or its nation's
    region = table(spark, d, "region")
    nation = table(spark, d, "nation")
    cust = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    requested = (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
                     .join(region, nation.n_regionkey == region.r_regionkey)
                     .select(F.when(F.col("c_custkey") % 5 == 0, F.col("r_name"))
                              .otherwise(F.col("n_name")).alias("name")))
    return select_sources(requested, region.select(F.col("r_name").alias("name")))


def q_batch_ids(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    periods = o.groupBy(_months(o, "o_orderdate").alias("period")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n_kept"))
    return batch_ids(periods, ["period"], 6, F.col("n_kept") > 0) \
        .select("period", "n_kept", "seq", "batch_id")


def event_page_log(spark: SparkSession, d: str, page: int = 100) -> DataFrame:
    # a section per event type and user parity; sections of even users never fail
    ev = table(spark, d, "events")
    odd = F.col("user_id") % 2
    return (ev.groupBy(F.concat_ws(":", "event_type", odd.cast("string")).alias("section"),
                       F.floor(F.col("event_id") / page).alias("page"))
              .agg(F.min("event_id").alias("start_offset"),
                   (F.max("event_id") + 1).alias("end_offset"),
                   (F.count_if((F.col("value") > FAIL_VALUE) & (odd == 1)) == 0).alias("ok")))


def q_contiguous_watermark(spark: SparkSession, d: str) -> DataFrame:
    return contiguous_watermark(event_page_log(spark, d)).select(
        "section", "watermark", "first_failed_offset",
        (F.col("watermark") >= F.col("last_offset")).alias("complete"))


def event_outcomes(spark: SparkSession, d: str) -> DataFrame:
    # a category per event type and case: 0 as it is, 1 all skipped, 2 only failures, 3 nothing at all
    ev = table(spark, d, "events")
    case = F.col("event_id") % 4
    empty = F.col("kind") >= 2
    return (ev.groupBy(F.concat_ws(":", "event_type", case.cast("string")).alias("category"), case.alias("kind"),
                       F.to_date("ts").alias("day"))
              .agg(F.count_if(F.col("value") > FAIL_VALUE).alias("n_events"),
                   F.count(F.lit(1)).alias("rows_seen"),
                   F.count_if(F.get_json_object("props", "$.k").cast("int") < 50).alias("rows_kept"))
              .withColumns({"n_events": F.when(F.col("kind") == 3, 0).otherwise(F.col("n_events")),
                            "rows_seen": F.when(empty, 0).otherwise(F.col("rows_seen")),
                            "rows_kept": F.when(empty, 0).otherwise(F.col("rows_kept")),
                            "skipped": (F.dayofmonth("day") == 1) | (F.col("kind") == 1)}))


def q_outcome_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    diag = window_diagnostics(event_outcomes(spark, d))
    return diag.withColumn("diagnosis", diagnosis())


def link_table(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    m = F.month("o_orderdate")
    href = F.concat(F.lit(config.PERMIT_LINK_FRAGMENT + "_ano_"), F.year("o_orderdate").cast("string"),
                    F.when(m % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("_"), F.lpad(m.cast("string"), 2, "0"))),
                    F.lit(".xlsx"))
    links = o.select(href.alias("href"), F.col("o_orderkey").alias("pos"))
    return links.select("href", "pos",
                        F.regexp_extract("href", config.PERMIT_LINK_PATTERN, 1).alias("year"),
                        extract_optional_int("href", config.PERMIT_LINK_PATTERN, 2).alias("month"))


def q_latest_variant(spark: SparkSession, d: str) -> DataFrame:
    return latest_variant(link_table(spark, d), "year", "href", ["month", "pos"])


def q_override_merge(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    fixed = li.select(F.year("l_shipdate").cast("string").alias("year")).distinct() \
        .withColumn("href", F.concat(F.lit("https://fixed.example/"), F.col("year"), F.lit(".xls")))
    # links for odd years only, so that even years keep the fixed address
    recent = latest_variant(link_table(spark, d).filter(F.col("year").cast("int") % 2 == 1), "year", "href",
                            ["month", "pos"])
    return override_merge(fixed, recent, "year", "href")


def q_html_links(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").withColumn("host", url_host("url"))
    return extract_links(pages, "html", "host", keep=["page_id"])


def conversation_grid(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    return c.select((F.col("conv_id") % 50).alias("file"),
                    F.concat(F.lit("sheet_"), F.col("conv_id").cast("string")).alias("sheet"),
                    F.col("conv_id").alias("sheet_idx"), F.col("turn").alias("row_idx"),
                    F.split("text", " ").alias("cells"))


def q_pick_sheet(spark: SparkSession, d: str) -> DataFrame:
    return pick_sheet(conversation_grid(spark, d))


def q_header_row(spark: SparkSession, d: str) -> DataFrame:
    grid = conversation_grid(spark, d)
    chosen = pick_sheet(grid).select("file", "sheet_idx")
    return header_rows(grid.join(chosen, ["file", "sheet_idx"], "left_semi"), GRID_HEADER_WORDS)


# ------------------------------------------------------------------ reports
def q_report_class(spark: SparkSession, d: str) -> DataFrame:
    """Revenue per (part class, return flag), as the procurement summary does.

    Lineitem is pre-aggregated per (part, flag) before the join, so the join
    sees one row per part and flag instead of every line; a part holding a
    third of all lines is folded map-side by the partial aggregate.
    """
    li = table(spark, d, "lineitem")
    flag = F.when(F.col("l_orderkey") % 7 != 0, F.col("l_returnflag"))
    per_part = (li.groupBy("l_partkey", flag.alias("flag"))
                  .agg(F.count("l_orderkey").alias("n"),
                       F.sum(F.col("l_extendedprice").cast("decimal(38,6)")).alias("s")))
    part = table(spark, d, "part").select(
        "p_partkey", first_match_regex("p_name", PART_RULES, "other").alias("cls"))
    joined = per_part.join(part, per_part.l_partkey == part.p_partkey)
    return grouped_report(joined, ["cls", "flag"], "n", "s", count_name="qtd",
                          sum_name="valor_total_mi", scale=1e6, digits=2, pre_counted=True)


def q_report_round0(spark: SparkSession, d: str) -> DataFrame:
    """Balance per (segment, nation) rounded to units, mining-summary style."""
    c = table(spark, d, "customer")
    seg = F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment"))
    return grouped_report(c.withColumn("segment", seg), ["segment", "c_nationkey"], "c_custkey",
                          "c_acctbal", count_name="qtd_processos", sum_name="area_total",
                          digits=0)


def q_coverage(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").withColumn("lat", _nullif_mod("c_custkey", 7, F.col("c_acctbal")))
    return coverage(c, "lat")


def q_topn_preview(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return preview(o.select("o_orderkey", "o_totalprice"),
                   [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


# -------------------------------------------------------- files and streams
def _break_archives(landed: DataFrame, folder: str, broken: Column) -> None:
    """Cuts the chosen archives of a folder short, as a failed download leaves them."""
    def cut(batches):
        system, at = open_path(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{at}/{name}") as f:
                    start = f.read(20)
                with system.open_output_stream(f"{at}/{name}") as f:
                    f.write(start)
            yield batch
    landed.filter(broken).select("archive").mapInArrow(cut, "archive string").write.format("noop").mode("overwrite").save()


def q_zip_members(spark: SparkSession, d: str) -> DataFrame:
    """Archives landed from suppliers (two CSV members and one other; some broken, some with no CSV), by member."""
    k, folder = F.col("s_suppkey"), scratch_path(spark, "zip_members")
    key = k.cast("string")
    line = F.concat(F.concat_ws(";", key, "s_name", F.col("s_nationkey").cast("string")), F.lit("\n"))
    def file(name: Column, body: Column) -> Column:
        return F.struct(name.alias("member"), body.alias("body"))

    member = F.explode(F.when(k % 9 == 1, F.array(file(F.lit("readme.txt"), F.lit("x")))).otherwise(F.array(
        file(F.concat(key, F.lit("_data.csv")), line), file(F.concat(key, F.lit("_DATA.CSV")), F.concat(line, line)),
        file(F.concat(key, F.lit("_notes.txt")), F.lit("notes")))))
    rows = table(spark, d, "supplier").select(F.concat(F.lit("supplier_"), key, F.lit(".zip")).alias("archive"), member.alias("m"))
    landed = scratch_path(spark, "zip_listing")
    write_zips(rows.select("archive", "m.member", F.col("m.body").cast("binary").alias("content")), folder).write.parquet(landed)
    _break_archives(spark.read.parquet(landed), folder, F.regexp_extract("archive", r"(\d+)", 1).cast("long") % 9 == 0)
    members = read_zip(spark, folder, pattern=r"\.(csv|xlsx)$", rows="content")
    return members.select("archive", "member", F.length("content").alias("n_bytes"),
                          F.sha2("content", 256).alias("sha256"), "error")


def _supplier_lines(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    key, name, region = k.cast("string"), F.col("s_name"), F.col("s_nationkey").cast("string")
    line = (F.when(k % 5 == 0, F.concat_ws(";", key, name, region, F.lit("extra")))
             .when(k % 5 == 1, F.concat_ws(";", key, name))
             .when(k % 5 == 2, F.concat_ws(";", key, F.concat(F.lit('"'), name, F.lit(';x"')), region))
             .otherwise(F.concat_ws(";", key, name, region)))
    return supplier.select(line.alias("value"))


def q_csv_policy(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv_policy")
    _supplier_lines(table(spark, d, "supplier")).write.mode("overwrite").text(path)
    return read_delimited(spark, path, ["a", "b", "c"], sep=";", header=False)


def q_quoted_breaks(spark: SparkSession, d: str) -> DataFrame:
    """Whole document texts as a quoted CSV field, line breaks and all, read by splits."""
    path = scratch_path(spark, "quoted_breaks")
    quote = F.lit('"')
    text = F.concat(quote, F.replace("text", quote, F.lit('""')), quote)
    table(spark, d, "documents").select(F.concat_ws(";", F.col("doc_id").cast("string"), text, "lang").alias("value")).write.text(path)
    return read_quoted(spark, path, ["doc_id", "text", "lang"], charset="UTF-8", header=False, na_tokens=False)


def q_stream_append(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming import stream_append_jsonl
    src = scratch_path(spark, "stream_src")
    events = table(spark, d, "events")
    events.select("event_id", "event_type", "value").write.mode("overwrite").json(src)
    bronze = stream_append_jsonl(spark, src, "event_id bigint, event_type string, value double",
                                 pipeline="events", root=scratch_path(spark, "stream_lake"))
    return bronze.select("event_id", "event_type", "value")


def q_stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming import stream_distinct_keys
    src = scratch_path(spark, "dedup_src")
    table(spark, d, "events").select("event_id", "user_id", "ts").write.mode("overwrite").json(src)
    return stream_distinct_keys(spark, src, "event_id bigint, user_id bigint, ts timestamp",
                                ["user_id"], scratch_path(spark, "dedup_lake"))


def q_stream_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """The first event of each user by time, from files in any order, batch by batch."""
    from ..streaming import stream_keep_first
    src = scratch_path(spark, "keep_first_src")
    (table(spark, d, "events").select("event_id", "user_id", "event_type", "ts").repartition(4, F.xxhash64("event_id"))
     .write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(src))
    return stream_keep_first(spark, src, "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz", ["user_id"],
                             ["ts", "event_id"], scratch_path(spark, "keep_first_lake"), max_files_per_trigger=2)


PAGE_ROWS = 250


def event_claim_pages(spark: SparkSession, d: str) -> DataFrame:
    """section, page, text of feature pages made of events: even ones are claims, odd ones geometries."""
    k = F.col("event_id")
    user = F.concat(F.lit("P"), F.col("user_id").cast("string"))
    attrs = F.create_map(F.lit("PROCESSO"), user, F.lit("FID"), k.cast("string"), F.lit("AREA_HA"), F.col("value").cast("string"))
    rings = F.array(F.array(F.array(F.col("value"), (k % 90).cast("double"))))
    row = table(spark, d, "events").select(
        F.when(k % 2 == 0, "attributes").otherwise("geometry").alias("section"), F.floor(k / 2).alias("pos"),
        F.struct(attrs.alias("attributes"), F.struct(rings.alias("rings")).alias("geometry")).alias("feature"))
    page = row.groupBy("section", F.floor(F.col("pos") / PAGE_ROWS).cast("int").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.to_json("feature").alias("f")))).alias("rows"))
    text = F.concat(F.lit('{"features":['), F.array_join(F.transform("rows", lambda r: r["f"]), ","), F.lit("]}"))
    return page.select("section", "page", F.size("rows").alias("n"), text.alias("text"))


def q_paged_load_replay(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of the paged load: the first meets pages whose fetch failed, the second finds them landed."""
    from . import mining_ingest as job
    staged = scratch_path(spark, "claim_pages")
    event_claim_pages(spark, d).write.parquet(staged)
    pages, start = spark.read.parquet(staged), F.col("page") * PAGE_ROWS
    failed = F.col("page") % 11 == F.when(F.col("section") == "attributes", 3).otherwise(7)
    name = F.concat("section", F.lit("/page_"), start.cast("string"))
    good = F.concat(name, F.lit("_"), (start + F.col("n")).cast("string"), F.lit(".json"))
    landing, lake, seen = scratch_path(spark, "claims_landing"), scratch_path(spark, "claims_lake"), []
    for run in (1, 2):
        land = pages if run == 1 else pages.filter(failed)
        land_texts(land.select(F.when(failed & F.lit(run == 1), F.concat(name, F.lit(".error"))).otherwise(good).alias("name"), "text"), landing)
        marks = job.ingest(spark, landing, lake, f"2024-01-0{run}")
        for section, mark in marks.items():
            claim = F.col("attributes")["PROCESSO"] if section == "attributes" else F.col("processo")
            out = scratch_path(spark, "claims_seen")
            job.read_bronze(spark, lake, section).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(claim).alias("n_claims")).select(
                F.lit(section).alias("section"), F.lit(run).alias("run"), F.lit(mark).cast("bigint").alias("watermark"),
                "n_rows", "n_claims").write.parquet(out)
            seen.append(spark.read.parquet(out))
    return union_by_name(seen)


# ----------------------------------------------------------- flagship query
def q_procurement_report(spark: SparkSession, d: str) -> DataFrame:
    from .driver_bronze import procurement_bronze
    from .procurement import BRONZE_SCHEMA, report, silver_from_bronze
    # bronze is a stored layer: land the derived notices as a table in the
    # shared folder, then read it back like any bronze
    path = scratch_path(spark, "procurement_bronze")
    procurement_bronze(spark, d, works_only=True).write.mode("overwrite").parquet(path)
    return report(silver_from_bronze(spark.read.schema(BRONZE_SCHEMA).parquet(path)))


def q_ingest_replay(spark: SparkSession, d: str) -> DataFrame:
    """Two ingest runs over landed pages: which windows each run commits, and the rows bronze ends with."""
    from . import procurement
    from .driver_bronze import landed_replay, replay_files
    staged = scratch_path(spark, "replay_pages")
    landed_replay(spark, d).write.mode("overwrite").parquet(staged)
    pages = spark.read.parquet(staged)
    years = [r["y"] for r in pages.select(F.substring("window", 1, 4).cast("int").alias("y")).distinct().collect()]
    landing, lake = scratch_path(spark, "replay_landing"), scratch_path(spark, "replay_lake")
    done = []
    for run in (1, 2):
        land_texts(replay_files(pages, run), landing)
        procurement.ingest(spark, landing, lake, years, ingest_date=f"2024-01-0{run}").write.format("noop").mode(
            "overwrite").save()
        committed = scratch_path(spark, "replay_committed")  # the ledger as this run left it
        procurement.read_ledger(spark, f"{lake}/_ledger", "procurement").select("key").write.parquet(committed)
        done.append(spark.read.parquet(committed).withColumn(f"run_{run}", F.lit(True)))
    windows = pages.select(F.concat_ws(":", F.col("category").cast("string"), F.replace("window", F.lit("_"), F.lit(":")))
                           .alias("key")).distinct()
    # the window is read off a page's path once, not for each of its rows
    rows = (procurement.read_bronze(spark, lake).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
            .groupBy(procurement._window_key(F.col("source_file")).alias("key")).agg(F.sum("n").alias("n")))
    return (windows.join(done[0], "key", "left").join(done[1], "key", "left").join(rows, "key", "left")
            .select("key", *[F.coalesce(f"run_{r}", F.lit(False)).alias(f"committed_{r}") for r in (1, 2)],
                    F.coalesce("n", F.lit(0)).alias("bronze_rows")))


def _mining_silver(spark: SparkSession, d: str) -> DataFrame:
    from . import mining
    from .driver_bronze import mining_attributes, mining_geometry
    attrs = mining.attributes_rows(mining.source_filter(mining_attributes(spark, d)), "2024-01-01")
    geom = mining.geometry_rows(mining_geometry(spark, d), "2024-01-01")
    return mining.silver(attrs, geom)


def q_mining_report(spark: SparkSession, d: str) -> DataFrame:
    """Claims and area per aggregate type and phase group (source filter, keep-first, null-safe join)."""
    from . import mining
    return mining.report(_mining_silver(spark, d))


def q_mining_coverage(spark: SparkSession, d: str) -> DataFrame:
    from . import mining
    return mining.coverage_report(_mining_silver(spark, d))


def q_tenders_silver(spark: SparkSession, d: str) -> DataFrame:
    """Tender CSV lines → strict parse → works filter → typed, stripped, distinct silver."""
    from . import tenders
    from .driver_bronze import tender_lines
    # land the monthly CSV text in the shared folder as a fetcher would, about
    # one file per month under period=yyyy-MM (without the shuffle every task
    # would write a file into every month folder). REBALANCE lets AQE split a
    # month too big for one task and merge small ones.
    path = scratch_path(spark, "tender_csv")
    tender_lines(spark, d).hint("rebalance", "period").write.mode("overwrite").partitionBy("period").text(path)
    return tenders.silver(tenders.bronze_from_files(spark, path, "2024-01-01"))


def _permits_silver(spark: SparkSession, d: str) -> DataFrame:
    from . import permits
    from .driver_bronze import permit_grid
    # the grid is the landed input of the permits job: write it once as a table
    # in the shared folder, then run sheet choice, headers and records on it
    grid, years = permit_grid(spark, d)
    path = scratch_path(spark, "permit_grid")
    grid.write.mode("overwrite").parquet(path)
    landed = spark.read.parquet(path)
    years = landed.select("file").distinct().withColumn("ano", F.col("file"))
    return permits.silver(permits.records(landed, years, "2024-01-01"))


def q_permits_silver(spark: SparkSession, d: str) -> DataFrame:
    """Yearly grids → sheet → header → records → merged, typed, classified, keep-first silver."""
    return _permits_silver(spark, d).select(
        "ano_referencia", "mes", "alvara", "processo", "descricao", "categoria_de_uso",
        "area_construcao_m2", "dt_aprovacao", "blocos_pavimentos_unidades", "uso_classificado")


def q_permits_report(spark: SparkSession, d: str) -> DataFrame:
    from . import permits
    return permits.report(_permits_silver(spark, d))


def q_permits_refresh_replay(spark: SparkSession, d: str) -> DataFrame:
    """Three runs over yearly grids: a first load, a refresh that meets a new, a changed and a lost year, and a quiet one."""
    from . import permits_ingest as job
    from .driver_bronze import permit_grid
    from ..sources.files import delete_path
    landing, lake, staged = (scratch_path(spark, f"permits_{x}") for x in ("landing", "lake", "grid"))
    permit_grid(spark, d)[0].select("file", "sheet", "sheet_idx", F.col("row_idx").cast("bigint").alias("row_idx"), "cells").write.parquet(staged)
    grid = spark.read.parquet(staged)
    years = sorted(int(r["file"]) for r in grid.select("file").distinct().collect())  # one row per year
    first, second, last = years[0], years[1], years[-1]

    def land(year: int, rows: DataFrame) -> None:
        rows.filter(F.col("file") == str(year)).write.mode("overwrite").parquet(f"{landing}/ano={year}")

    runs = []
    for run in (1, 2, 3):
        if run == 1:
            for y in years[:-1]:
                land(y, grid)
        elif run == 2:
            land(last, grid)
            land(first, grid.filter("row_idx % 2 = 0 or row_idx < 3"))
            delete_path(spark, f"{lake}/bronze/ano={second}")
        report = job.ingest(spark, landing, lake, years, as_of=last if run > 1 else years[-2])
        n = spark.read.schema(f"{job.GRID_SCHEMA}, ano string").parquet(f"{lake}/bronze").groupBy(F.col("ano").alias("key")).agg(
            F.count(F.lit(1)).alias("n_rows"))
        out = scratch_path(spark, "permits_run")
        report.join(n, "key", "left").select(F.lit(run).alias("run"), "key", "status", "reason", "n_rows").write.parquet(out)
        runs.append(spark.read.parquet(out))
    return union_by_name(runs)


INVESTMENT_HEADERS = ["Município", "Valor Investido ($)", "R$ Milhões", "Setor  Econômico", "Código"]


def q_investments_silver(spark: SparkSession, d: str) -> DataFrame:
    """Land a source CSV (header per file) from customers, read it back with inferred
    types, fold the header names to ASCII snake case and add lineage."""
    from . import investments
    c = table(spark, d, "customer")
    src = c.select(F.col("c_name").alias(INVESTMENT_HEADERS[0]), F.col("c_acctbal").alias(INVESTMENT_HEADERS[1]),
                   (F.col("c_acctbal") / F.lit(1e6)).alias(INVESTMENT_HEADERS[2]),
                   F.col("c_mktsegment").alias(INVESTMENT_HEADERS[3]), F.col("c_custkey").alias(INVESTMENT_HEADERS[4]))
    path = scratch_path(spark, "investments_csv")
    src.write.mode("overwrite").option("header", "true").option("sep", ";").csv(path)
    name = config.INVESTMENT_SOURCES[0][0]
    return investments.silver_for(spark, name, path, "2024-01-01", charset="UTF-8")


def q_investments_zip_silver(spark: SparkSession, d: str) -> DataFrame:
    """A zipped source: archives of two members whose headers drift, merged by name, types inferred over all."""
    from . import investments
    k, folder = F.col("c_custkey"), scratch_path(spark, "investments_zip")
    fields = [F.col("c_name"), F.replace(F.format_string("%.2f", "c_acctbal"), F.lit(","), F.lit(".")),
              F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('\n"'))]
    old, new = ";".join([*INVESTMENT_HEADERS[:2], INVESTMENT_HEADERS[3]]), ";".join([*INVESTMENT_HEADERS[:2], *INVESTMENT_HEADERS[3:]])
    line = F.when(k % 2 == 0, F.concat_ws(";", *fields)).otherwise(F.concat_ws(";", *fields, k.cast("string")))
    rows = table(spark, d, "customer").select(
        F.concat(F.lit("part_"), F.floor(k / 500).cast("string"), F.lit(".zip")).alias("archive"),
        F.concat(F.lit("dados/v"), (k % 2).cast("string"), F.lit(".csv")).alias("member"), k.alias("k"), line.alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "\n")
    files = rows.groupBy("archive", "member").agg(text.alias("body"))  # a member: 250 customers
    head = F.when(F.col("member").endswith("0.csv"), F.lit(old)).otherwise(F.lit(new))
    files = files.select("archive", "member", F.concat(head, F.lit("\n"), "body", F.lit("\n")).cast("binary").alias("content"))
    write_zips(files, folder).write.format("noop").mode("overwrite").save()
    name = config.INVESTMENT_SOURCES[0][0]
    return investments.silver_for(spark, name, folder, "2024-01-01", charset="UTF-8", kind="zip")


QUERIES: dict[str, Query] = {
    "keyword_filter": q_keyword_filter,
    "works_keyword_filter": q_works_keyword_filter,
    "eq_in_filter": q_eq_in_filter,
    "json_flatten": q_json_flatten,
    "rename_or_null": q_rename_or_null,
    "normalize_names": q_normalize_names,
    "coalesce_variants": q_coalesce_variants,
    "widened_union": q_widened_union,
    "classify_regex": q_classify_regex,
    "classify_works": q_classify_works,
    "classify_set": q_classify_set,
    "br_decimal_parse": q_br_decimal_parse,
    "nullable_int": q_nullable_int,
    "iso_ts_parse": q_iso_ts_parse,
    "dayfirst_parse": q_dayfirst_parse,
    "multi_date_parse": q_multi_date_parse,
    "strip_text": q_strip_text,
    "concat_skip_blank": q_concat_skip_blank,
    "centroid": q_centroid,
    "dedup_first": q_dedup_first,
    "distinct_rows": q_distinct_rows,
    "left_join_nullsafe": q_left_join_nullsafe,
    "monthly_windows": q_monthly_windows,
    "weekly_windows": q_weekly_windows,
    "window_plan": q_window_plan,
    "period_urls": q_period_urls,
    "url_parts": q_url_parts,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "landed_layer": q_landed_layer,
    "ledger_replay": q_ledger_replay,
    "sources_load": q_sources_load,
    "ledger_pending": q_ledger_pending,
    "refresh_current": q_refresh_current,
    "source_selection": q_source_selection,
    "batch_ids": q_batch_ids,
    "contiguous_watermark": q_contiguous_watermark,
    "outcome_diagnostics": q_outcome_diagnostics,
    "latest_variant": q_latest_variant,
    "override_merge": q_override_merge,
    "html_links": q_html_links,
    "pick_sheet": q_pick_sheet,
    "header_row": q_header_row,
    "report_class": q_report_class,
    "report_round0": q_report_round0,
    "coverage": q_coverage,
    "topn_preview": q_topn_preview,
    "zip_members": q_zip_members,
    "csv_policy": q_csv_policy,
    "quoted_breaks": q_quoted_breaks,
    "stream_append": q_stream_append,
    "stream_dedup": q_stream_dedup,
    "stream_keep_first": q_stream_keep_first,
    "paged_load_replay": q_paged_load_replay,
    "procurement_report": q_procurement_report,
    "ingest_replay": q_ingest_replay,
    "mining_report": q_mining_report,
    "mining_coverage": q_mining_coverage,
    "tenders_silver": q_tenders_silver,
    "permits_silver": q_permits_silver,
    "permits_report": q_permits_report,
    "permits_refresh_replay": q_permits_refresh_replay,
    "investments_silver": q_investments_silver,
    "investments_zip_silver": q_investments_zip_silver,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return QUERIES[name](spark, sf_dir)

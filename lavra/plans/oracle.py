"""DuckDB SQL computing the same answers as the registered queries.

Written independently of the Spark code, from the operator semantics; the
tables are DuckDB views named after the driver's tables.
"""

from __future__ import annotations

from .. import config
from .catalog import (DOC_TERMS, FAIL_VALUE, GRID_HEADER_WORDS, PART_RULES, PART_TYPE_GROUPS,
                      AS_OF_YEAR)
from .driver_bronze import OBJECT_WORDS, OTHER_PHASE, OTHER_SUBSTANCE, PERMIT_CATEGORIES, SPHERES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _contains_any(expr: str, terms: list[str]) -> str:
    low = f"lower(coalesce({expr}, ''))"
    return "(" + " OR ".join(f"contains({low}, {_q(t)})" for t in terms) + ")"


def _regex_case(expr: str, rules: list[tuple[str, str]], default: str) -> str:
    text = f"coalesce({expr}, '')"
    whens = " ".join(f"WHEN regexp_matches({text}, {_q('(?i)' + p)}) THEN {_q(l)}" for p, l in rules)
    return f"CASE {whens} ELSE {_q(default)} END"


def _set_case(expr: str, groups, default: str) -> str:
    whens = " ".join(f"WHEN {expr} IN ({', '.join(_q(v) for v in vs)}) THEN {_q(l)}" for vs, l in groups)
    return f"CASE {whens} ELSE {_q(default)} END"


NUM_RE = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _to_double(expr: str) -> str:
    return f"CASE WHEN regexp_full_match({expr}, {_q(NUM_RE)}) THEN TRY_CAST(trim({expr}) AS DOUBLE) END"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, {_q('^' + SPACE + '+|' + SPACE + '+$')}, '', 'g')"


ISO_RE = r"\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?"

_BR_TEXT = """CASE WHEN o_orderkey % 11 = 0 THEN '12d'
                   WHEN o_orderkey % 13 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
                   WHEN o_orderkey % 17 = 0 THEN 'NA'
                   ELSE translate(format('{:,.2f}', o_totalprice), ',.', '.,') END"""

_LEDGER = """
planned AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS key FROM orders),
committed AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS key FROM lineitem
              WHERE month(l_shipdate) % 3 = 0),
present AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS key FROM orders WHERE o_orderstatus = 'F')
"""

_LINKS = f"""
links AS (
  SELECT href, o_orderkey AS pos,
         regexp_extract(href, {_q(config.PERMIT_LINK_PATTERN)}, 1) AS year,
         coalesce(TRY_CAST(nullif(regexp_extract(href, {_q(config.PERMIT_LINK_PATTERN)}, 2), '') AS INTEGER), 0) AS month
  FROM (SELECT o_orderkey,
               {_q(config.PERMIT_LINK_FRAGMENT + '_ano_')} || CAST(year(o_orderdate) AS VARCHAR)
               || CASE WHEN month(o_orderdate) % 4 = 0 THEN ''
                       ELSE '_' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') END
               || '.xlsx' AS href
        FROM orders)),
latest AS (
  SELECT year, href FROM links
  QUALIFY row_number() OVER (PARTITION BY year ORDER BY month DESC, pos DESC) = 1)
"""

_GRID = """
grid AS (SELECT conv_id % 50 AS file, 'sheet_' || CAST(conv_id AS VARCHAR) AS sheet,
                conv_id AS sheet_idx, turn AS row_idx, string_split(text, ' ') AS cells
         FROM conversations),
counts AS (SELECT file, sheet_idx, sheet, count(*) AS n_rows FROM grid GROUP BY ALL),
chosen AS (SELECT * FROM counts
           QUALIFY row_number() OVER (PARTITION BY file ORDER BY n_rows DESC, sheet_idx) = 1)
"""

_ORDER_YEARS = "(SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"

_MONTHLY = f"""
SELECT year, strftime(d, '%Y%m%d') AS start, strftime(last_day(d), '%Y%m%d') AS "end"
FROM {_ORDER_YEARS} y,
     LATERAL (SELECT unnest(generate_series(make_date(y.year, 1, 1)::TIMESTAMP,
                                            make_date(y.year, 12, 1)::TIMESTAMP, INTERVAL 1 MONTH)) AS d)
"""

_WEEKLY = f"""
SELECT year, strftime(d, '%Y%m%d') AS start,
       strftime(least(d + INTERVAL 6 DAY, make_date(year, 12, 31)::TIMESTAMP), '%Y%m%d') AS "end"
FROM {_ORDER_YEARS} y,
     LATERAL (SELECT unnest(generate_series(make_date(y.year, 1, 1)::TIMESTAMP,
                                            make_date(y.year, 12, 31)::TIMESTAMP, INTERVAL 7 DAY)) AS d)
"""

_MODALITIES = ", ".join(f"({c}, {_q(g)}, {_q(n)})" for c, g, n in config.PROCUREMENT_MODALITIES)

_PAGES = f"""
pages AS (SELECT event_type || ':' || (user_id % 2) AS section, floor(event_id / 100) AS page,
                 min(event_id) AS start_offset, max(event_id) + 1 AS end_offset,
                 count(*) FILTER (WHERE value > {FAIL_VALUE} AND user_id % 2 = 1) = 0 AS ok
          FROM events GROUP BY ALL)
"""

_WORKS_DOCS = ("(SELECT * REPLACE (concat_ws(' ', text, list_extract([" + ", ".join(_q(w) for w in OBJECT_WORDS)
               + f"], CAST(doc_id % {len(OBJECT_WORDS) + 3} + 1 AS INTEGER))) AS text) FROM documents)")
_SUBSTANCE = ("list_extract([" + ", ".join(_q(x) for x in config.MINING_SUBSTANCES)
              + f"], CAST(p_partkey % {len(config.MINING_SUBSTANCES) + 1} + 1 AS INTEGER))")
_OBJECT_WORD = "list_extract([" + ", ".join(_q(w) for w in OBJECT_WORDS) + "], CAST(o_orderkey % 8 + 1 AS INTEGER))"
_SPHERE = "CASE o_orderstatus " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in SPHERES.items()) + " END"

_SUBS_ALL = config.MINING_SUBSTANCES + [OTHER_SUBSTANCE]
_PHASES_ALL = [p for vs, _ in config.MINING_PHASE_GROUPS for p in vs] + [OTHER_PHASE]
_MINING_SILVER = f"""
a AS (SELECT CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE 'P' || CAST(o_custkey AS VARCHAR) END AS processo,
             o_orderkey AS fid,
             list_extract([{', '.join(_q(x) for x in _SUBS_ALL)}],
                          CAST(o_orderkey % {len(_SUBS_ALL)} + 1 AS INTEGER)) AS substancia,
             list_extract([{', '.join(_q(x) for x in _PHASES_ALL)}],
                          CAST(o_custkey % {len(_PHASES_ALL)} + 1 AS INTEGER)) AS fase,
             o_totalprice AS area_ha,
             CASE WHEN o_orderkey % 9 = 0 THEN 'MG' ELSE 'SP' END AS uf
      FROM orders),
f AS (SELECT * FROM a WHERE uf = {_q(config.MINING_STATE)}
        AND substancia IN ({', '.join(_q(x) for x in config.MINING_SUBSTANCES)})),
firsts AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY processo ORDER BY fid) = 1),
typed AS (SELECT *, {_set_case('fase', config.MINING_PHASE_GROUPS, config.OTHER_GROUP)} AS fase_grupo,
                 {_set_case('substancia', config.MINING_AGGREGATE_GROUPS, config.OTHER_GROUP)} AS tipo_agregado
          FROM firsts),
g AS (SELECT processo, lat FROM (
        SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE 'P' || CAST(c_custkey AS VARCHAR) END AS processo,
               c_custkey,
               CASE WHEN c_custkey % 11 = 0 THEN NULL
                    ELSE round_even((CAST(c_nationkey AS DOUBLE) + (c_nationkey + 1.0) + c_nationkey) / 3, 6)
               END AS lat
        FROM customer)
      QUALIFY row_number() OVER (PARTITION BY processo ORDER BY c_custkey) = 1),
s AS (SELECT t.*, g.lat FROM typed t LEFT JOIN g ON t.processo IS NOT DISTINCT FROM g.processo)
"""

_PERMITS_SILVER = rf"""
r AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS ano_referencia, o_orderkey + 2 AS row_idx,
         CAST(month(o_orderdate) AS VARCHAR) AS mes,
         'A-' || CAST(o_custkey AS VARCHAR) AS alvara, 'P-' || CAST(o_custkey AS VARCHAR) AS processo,
         o_orderpriority AS descricao,
         list_extract([{', '.join(_q(x) for x in PERMIT_CATEGORIES)}, NULL],
                      CAST(o_orderkey % {len(PERMIT_CATEGORIES) + 1} + 1 AS INTEGER)) AS categoria_de_uso,
         translate(format('{{:,.2f}}', o_totalprice), ',.', '.,') AS area_txt,
         CASE WHEN o_orderkey % 23 = 0 THEN '2023-05-01 00:00:00'
              WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%-d/%-m/%Y')
              ELSE strftime(o_orderdate, '%-d/%-m/%y') END AS apr_txt,
         CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE CAST(o_orderkey % 4 AS VARCHAR) END AS b,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 7 AS VARCHAR) END AS p,
         CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE CAST(o_custkey % 9 AS VARCHAR) END AS u,
         year(o_orderdate) % 2 = 0 AS old_layout
  FROM orders),
s AS (
  SELECT ano_referencia, row_idx, mes, alvara, processo, descricao, categoria_de_uso,
         {_to_double("replace(replace(area_txt, '.', ''), ',', '.')")} AS area_construcao_m2,
         coalesce(CASE WHEN regexp_full_match(apr_txt, '\d{{1,2}}/\d{{1,2}}/\d{{4}}')
                       THEN try_strptime(apr_txt, '%d/%m/%Y') END,
                  CASE WHEN regexp_full_match(apr_txt, '\d{{1,2}}/\d{{1,2}}/\d{{2}}')
                       THEN try_strptime(apr_txt, '%d/%m/%y') END) AS dt_aprovacao,
         CASE WHEN old_layout
              THEN nullif(concat_ws(' / ', CASE WHEN {_strip('b')} <> '' THEN b END,
                                           CASE WHEN {_strip('p')} <> '' THEN p END,
                                           CASE WHEN {_strip('u')} <> '' THEN u END), '')
              ELSE concat_ws(' / ', coalesce(b, ''), coalesce(p, ''), coalesce(u, '')) END
           AS blocos_pavimentos_unidades,
         {_regex_case('categoria_de_uso', config.LAND_USE_RULES, config.LAND_USE_DEFAULT)} AS uso_classificado
  FROM r),
firsts AS (SELECT * FROM s
           QUALIFY row_number() OVER (PARTITION BY alvara, processo, ano_referencia ORDER BY row_idx) = 1)
"""

SQL: dict[str, str] = {
    "keyword_filter": f"""
SELECT doc_id, lang, source, n_chars FROM documents WHERE {_contains_any('text', DOC_TERMS)}""",

    "works_keyword_filter": f"""
SELECT doc_id, lang FROM {_WORKS_DOCS} WHERE {_contains_any('text', config.WORKS_KEYWORDS)}""",

    "eq_in_filter": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'""",

    "json_flatten": """
SELECT event_id,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id END AS numero,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS tipo,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS valor,
       CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN NULL ELSE user_id END AS usuario,
       CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN NULL
            ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       event_id % 11 = 0 AS corrupt
FROM events""",

    "rename_or_null": """
SELECT s_suppkey AS fornecedor, s_name AS nome, s_nationkey AS nacao, s_acctbal AS saldo,
       CAST(NULL AS VARCHAR) AS telefone, 'supplier' AS fonte
FROM supplier""",

    "normalize_names": """
SELECT s_suppkey AS codigo_da_nacao, s_name AS nome__da_nacao_s, s_nationkey AS regiaoarea_m2,
       s_suppkey AS "nação_chave", s_name AS "área_da_construção_m"
FROM supplier""",

    "coalesce_variants": """
SELECT o_orderkey AS pedido, o_totalprice AS valor,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END AS data_pedido,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS situacao
FROM orders""",

    "classify_regex": f"SELECT p_partkey, {_regex_case('p_name', PART_RULES, 'other')} AS cls FROM part",

    "classify_works": f"""
SELECT doc_id, {_regex_case('text', config.WORKS_TYPE_RULES, config.WORKS_TYPE_DEFAULT)} AS tipo_obra,
       {_regex_case('text', config.LAND_USE_RULES, config.LAND_USE_DEFAULT)} AS uso_classificado
FROM {_WORKS_DOCS}""",

    "classify_set": f"""
SELECT p_partkey, {_set_case('p_type', PART_TYPE_GROUPS, config.OTHER_GROUP)} AS grupo,
       {_set_case(_SUBSTANCE, config.MINING_AGGREGATE_GROUPS, config.OTHER_GROUP)} AS tipo_agregado
FROM part""",

    "br_decimal_parse": f"""
SELECT o_orderkey, {_to_double("replace(replace(txt, '.', ''), ',', '.')")} AS valor,
       {_to_double("replace(txt, ',', '.')")} AS qtd
FROM (SELECT o_orderkey, {_BR_TEXT} AS txt FROM orders)""",

    "nullable_int": f"""
SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN d = floor(d) THEN CAST(d AS BIGINT) END AS qtd_int
FROM (SELECT *, {_to_double('txt')} AS d
      FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN CAST(l_quantity AS VARCHAR) || '5'
                           WHEN l_linenumber = 5 THEN 'x' || CAST(l_quantity AS VARCHAR)
                           ELSE CAST(l_quantity AS VARCHAR) END AS txt
            FROM lineitem))""",

    "iso_ts_parse": f"""
SELECT event_id, CASE WHEN regexp_full_match(txt, {_q(ISO_RE)}) THEN TRY_CAST(txt AS TIMESTAMP) END AS ts_parsed
FROM (SELECT event_id,
             CASE WHEN event_id % 17 = 0 THEN 'not a date'
                  WHEN event_id % 19 = 0 THEN CAST(year(ts) AS VARCHAR)
                  WHEN event_id % 23 = 0 THEN strftime(ts, '%Y-%m-%d')
                  ELSE CAST(ts AS VARCHAR) END AS txt
      FROM events)""",

    "dayfirst_parse": """
SELECT o_orderkey, try_strptime(txt, ['%d/%m/%Y', '%d/%m/%Y %H:%M:%S']) AS dt
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 29 = 0 THEN '31/02/2023'
                  WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%-d/%-m/%Y') || ' 10:30:00'
                  ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS txt
      FROM orders)""",

    "multi_date_parse": r"""
SELECT o_orderkey,
       coalesce(CASE WHEN regexp_full_match(txt, '\d{1,2}/\d{1,2}/\d{4}') THEN try_strptime(txt, '%d/%m/%Y') END,
                CASE WHEN regexp_full_match(txt, '\d{1,2}/\d{1,2}/\d{2}') THEN try_strptime(txt, '%d/%m/%y') END) AS dt
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 29 = 0 THEN '31/02/99'
                  WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%-d/%-m/%y')
                  ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS txt
      FROM orders)""",

    "strip_text": f"""
SELECT p_partkey, {_strip('padded')} AS nome
FROM (SELECT p_partkey,
             CASE p_partkey % 3 WHEN 0 THEN chr(9) WHEN 1 THEN ' ' ELSE chr(160) END
             || p_name || CASE p_partkey % 2 WHEN 0 THEN '  ' ELSE chr(12288) END AS padded
      FROM part)""",

    "concat_skip_blank": f"""
SELECT p_partkey,
       coalesce(CASE WHEN p_partkey % 5 = 0 THEN p_name END,
                nullif(concat_ws(' / ',
                    CASE WHEN {_strip('a')} <> '' THEN a END,
                    CASE WHEN {_strip('b')} <> '' THEN b END,
                    CASE WHEN {_strip('c')} <> '' THEN c END), '')) AS blocos
FROM (SELECT p_partkey, p_name,
             CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE p_brand END AS a,
             CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE CAST(p_size AS VARCHAR) END AS b,
             CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_type END AS c
      FROM part)""",

    "centroid": """
SELECT vec_id,
       CASE WHEN vec_id % 10 IN (0, 1) THEN NULL
            ELSE round_even(list_sum(list_transform(range(0, len(embedding) // 2),
                 lambda i: CAST(embedding[2 * i + 2] AS DOUBLE))) / (len(embedding) // 2), 6) END AS lat,
       CASE WHEN vec_id % 10 IN (0, 1) THEN NULL
            ELSE round_even(list_sum(list_transform(range(0, len(embedding) // 2),
                 lambda i: CAST(embedding[2 * i + 1] AS DOUBLE))) / (len(embedding) // 2), 6) END AS lon
FROM embeddings""",

    "dedup_first": """
SELECT k, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM (SELECT *, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey END AS k FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY k ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                                                   l_extendedprice, l_orderkey, l_shipdate) = 1""",

    "distinct_rows": "SELECT DISTINCT lang, source FROM documents",

    "left_join_nullsafe": """
SELECT c.c_custkey, c.nk, n.n_name
FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS nk FROM customer) c
LEFT JOIN (SELECT CASE WHEN n_nationkey = 3 THEN NULL ELSE n_nationkey END AS nk, n_name FROM nation) n
  ON c.nk IS NOT DISTINCT FROM n.nk""",

    "monthly_windows": _MONTHLY,

    "weekly_windows": _WEEKLY,

    "window_plan": f"""
WITH cat(category, granularity, name) AS (VALUES {_MODALITIES}),
w AS (SELECT *, 'monthly' AS granularity FROM ({_MONTHLY})
      UNION ALL SELECT *, 'weekly' AS granularity FROM ({_WEEKLY}))
SELECT category, name, granularity, year, start, "end",
       CAST(category AS VARCHAR) || ':' || start || ':' || "end" AS key
FROM cat JOIN w USING (granularity)""",

    "ledger_pending": f"""
WITH {_LEDGER}
SELECT key, 'new' AS reason FROM planned WHERE key NOT IN (SELECT key FROM committed)
UNION ALL
SELECT key, 'missing_data' AS reason FROM committed
WHERE key NOT IN (SELECT key FROM present) AND key IN (SELECT key FROM planned)""",

    "refresh_current": f"""
WITH {_LEDGER}
SELECT key FROM planned WHERE key NOT IN (SELECT key FROM committed)
UNION
SELECT key FROM planned WHERE CAST(substr(key, 1, 4) AS INTEGER) = {AS_OF_YEAR}""",

    "source_selection": """
WITH req AS (SELECT DISTINCT CASE WHEN c_custkey % 5 = 0 THEN r_name ELSE n_name END AS name
             FROM customer JOIN nation ON c_nationkey = n_nationkey
                           JOIN region ON n_regionkey = r_regionkey)
SELECT name, CASE WHEN name IN (SELECT r_name FROM region) THEN 'selected' ELSE 'unknown' END AS status
FROM req""",

    "batch_ids": """
SELECT period, n_kept, seq, CAST(floor((seq - 1) / 6) AS INTEGER) AS batch_id
FROM (SELECT period, n_kept, CAST(row_number() OVER (ORDER BY period) AS INTEGER) AS seq
      FROM (SELECT strftime(o_orderdate, '%Y-%m') AS period,
                   count(*) FILTER (WHERE o_orderstatus = 'F') AS n_kept
            FROM orders GROUP BY 1)
      WHERE n_kept > 0)""",

    "contiguous_watermark": f"""
WITH {_PAGES},
ff AS (SELECT section, min(CASE WHEN NOT ok THEN start_offset END) AS first_failed_offset
       FROM pages GROUP BY section),
tot AS (SELECT event_type || ':' || (user_id % 2) AS section, max(event_id) + 1 AS total FROM events GROUP BY 1),
wm AS (SELECT p.section,
              coalesce(max(CASE WHEN p.ok AND (ff.first_failed_offset IS NULL
                                                OR p.start_offset < ff.first_failed_offset)
                                THEN p.end_offset END), 0) AS watermark,
              max(ff.first_failed_offset) AS first_failed_offset
       FROM pages p JOIN ff USING (section) GROUP BY p.section)
SELECT wm.section, watermark, first_failed_offset, watermark >= total AS complete
FROM wm JOIN tot USING (section)""",

    "outcome_diagnostics": f"""
WITH o AS (
  SELECT event_type || ':' || (event_id % 4) AS category, event_id % 4 AS kind, CAST(ts AS DATE) AS day,
         count(*) FILTER (WHERE value > {FAIL_VALUE} AND event_id % 4 <> 3) AS n_events,
         count(*) FILTER (WHERE event_id % 4 < 2) AS rows_seen,
         count(*) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 AND event_id % 4 < 2) AS rows_kept
  FROM events GROUP BY ALL),
s AS (SELECT *, dayofmonth(day) = 1 OR kind = 1 AS skipped FROM o),
g AS (SELECT category,
             count(*) FILTER (WHERE NOT skipped) AS windows,
             count(*) FILTER (WHERE skipped) AS skipped,
             count(*) FILTER (WHERE NOT skipped AND n_events > 0) AS with_event,
             CAST(coalesce(sum(rows_seen) FILTER (WHERE NOT skipped), 0) AS BIGINT) AS evaluated,
             CAST(coalesce(sum(rows_kept) FILTER (WHERE NOT skipped), 0) AS BIGINT) AS found
      FROM s GROUP BY category)
SELECT *, CASE WHEN windows = 0 THEN 'nothing queried'
               WHEN evaluated = 0 AND with_event = 0 THEN 'no rows and no events: check one window by hand'
               WHEN evaluated = 0 AND with_event > 0 THEN 'every window failed: calls are failing'
               ELSE 'ok' END AS diagnosis
FROM g""",

    "latest_variant": f"WITH {_LINKS} SELECT year, href FROM latest",

    "override_merge": f"""
WITH {_LINKS},
fixed AS (SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) AS year FROM lineitem)
SELECT coalesce(f.year, r.year) AS year,
       coalesce(r.href, 'https://fixed.example/' || f.year || '.xls') AS href,
       CASE WHEN r.href IS NOT NULL THEN 'recent' ELSE 'fixed' END AS origin
FROM fixed f FULL OUTER JOIN (SELECT * FROM latest WHERE CAST(year AS INTEGER) % 2 = 1) r ON f.year = r.year""",

    "html_links": r"""
WITH x AS (SELECT page_id,
                  regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1) AS host,
                  regexp_extract_all(html, '<a\b[^>]*?\bhref="([^"]+)"', 1) AS links
           FROM pages)
SELECT page_id, CAST(i - 1 AS INTEGER) AS link_pos,
       CASE WHEN starts_with(links[i], '/') THEN host || links[i] ELSE links[i] END AS href
FROM x, LATERAL (SELECT unnest(generate_series(1, len(x.links))) AS i)""",

    "pick_sheet": f"WITH {_GRID} SELECT file, sheet_idx, sheet, n_rows FROM chosen",

    "header_row": f"""
WITH {_GRID},
rows AS (SELECT g.* FROM grid g SEMI JOIN chosen c ON g.file = c.file AND g.sheet_idx = c.sheet_idx)
SELECT file,
       coalesce(min(CASE WHEN len(list_intersect(
                     list_distinct(list_transform(list_filter(cells, lambda x: x IS NOT NULL),
                                                  lambda x: lower({_strip('x')}))),
                     [{', '.join(_q(w) for w in GRID_HEADER_WORDS)}])) >= 2
                    THEN row_idx END), 0) AS header_row
FROM rows GROUP BY file""",

    "report_class": f"""
SELECT cls, flag, CAST(count(l_orderkey) AS BIGINT) AS qtd,
       round_even(CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(38,6))), 0) AS DOUBLE) / 1e6, 2)
         AS valor_total_mi
FROM (SELECT l.*, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_returnflag END AS flag,
             {_regex_case('p_name', PART_RULES, 'other')} AS cls
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
WHERE cls IS NOT NULL AND flag IS NOT NULL
GROUP BY cls, flag""",

    "report_round0": """
SELECT segment, c_nationkey, count(c_custkey) AS qtd_processos,
       round_even(CAST(coalesce(sum(CAST(c_acctbal AS DECIMAL(38,6))), 0) AS DOUBLE), 0) AS area_total
FROM (SELECT *, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer)
WHERE segment IS NOT NULL AND c_nationkey IS NOT NULL
GROUP BY segment, c_nationkey""",

    "coverage": """
SELECT count(*) AS total, count(lat) AS with_value, count(*) - count(lat) AS without_value,
       CASE WHEN count(*) > 0 THEN round_even(CAST(count(lat) AS DOUBLE) * 100.0 / count(*), 1) END AS pct_with,
       CASE WHEN count(*) > 0 THEN round_even(CAST(count(*) - count(lat) AS DOUBLE) * 100.0 / count(*), 1) END
         AS pct_without
FROM (SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS lat FROM customer)""",

    "topn_preview": """
SELECT o_orderkey, o_totalprice, (SELECT greatest(count(*) - 10, 0) FROM orders) AS n_more
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",

    "zip_members": """
WITH s AS (SELECT s_suppkey % 9 AS c, CAST(s_suppkey AS VARCHAR) AS k,
                  CAST(s_suppkey AS VARCHAR) || ';' || s_name || ';' || CAST(s_nationkey AS VARCHAR) || chr(10) AS line
           FROM supplier),
m AS (SELECT k, k || '_data.csv' AS member, line AS body FROM s WHERE c > 1
      UNION ALL SELECT k, k || '_DATA.CSV', line || line FROM s WHERE c > 1)
SELECT 'supplier_' || k || '.zip' AS archive, member, CAST(strlen(body) AS INTEGER) AS n_bytes, sha256(body) AS sha256,
       CAST(NULL AS VARCHAR) AS error FROM m
UNION ALL
SELECT 'supplier_' || k || '.zip', NULL, NULL, NULL,
       CASE c WHEN 0 THEN 'BadZipFile: File is not a zip file' ELSE 'ValueError: no matching member' END
FROM s WHERE c < 2""",

    "csv_policy": """
SELECT CAST(s_suppkey AS VARCHAR) AS a,
       CASE WHEN s_suppkey % 5 = 2 THEN s_name || ';x' ELSE s_name END AS b,
       CASE WHEN s_suppkey % 5 = 1 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS c
FROM supplier WHERE s_suppkey % 5 <> 0""",

    "stream_append": "SELECT event_id, event_type, value FROM events",

    "stream_dedup": "SELECT DISTINCT user_id FROM events",

    "procurement_report": f"""
WITH notices AS (
  SELECT 'pncp-' || CAST(o_custkey AS VARCHAR) AS numero_controle_pncp, o_orderkey,
         o_orderpriority || ' — ' || {_OBJECT_WORD} AS objeto_compra,
         o_totalprice AS valor_estimado,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {_SPHERE} END AS orgao_esfera_id
  FROM orders),
kept AS (SELECT * FROM notices WHERE {_contains_any('objeto_compra', config.WORKS_KEYWORDS)}),
firsts AS (SELECT * FROM kept
           QUALIFY row_number() OVER (PARTITION BY numero_controle_pncp ORDER BY o_orderkey) = 1),
typed AS (SELECT *, {_regex_case('objeto_compra', config.WORKS_TYPE_RULES, config.WORKS_TYPE_DEFAULT)}
                    AS tipo_obra FROM firsts)
SELECT tipo_obra, orgao_esfera_id, count(numero_controle_pncp) AS qtd,
       round_even(CAST(coalesce(sum(CAST(valor_estimado AS DECIMAL(38,6))), 0) AS DOUBLE) / 1e6, 2)
         AS valor_total_mi
FROM typed WHERE orgao_esfera_id IS NOT NULL
GROUP BY tipo_obra, orgao_esfera_id""",

    "ingest_replay": """
WITH n AS (
  SELECT date_trunc('month', o_orderdate)::DATE AS m, o_orderkey // 50000 AS block, count(*) AS seen,
         count(*) FILTER (o_orderkey % 5 <> 4) AS kept
  FROM orders GROUP BY 1, 2),
p AS (
  SELECT *, row_number() OVER (PARTITION BY m ORDER BY block) AS page, count(*) OVER (PARTITION BY m) AS total,
         (year(m) * 12 + month(m)) % 5 AS c FROM n),
w AS (
  SELECT m, c, max(total) AS total, sum(kept) AS kept,
         -- rows of run 1 that a window left incomplete loads again in run 2
         sum(kept) FILTER ((c = 1 AND total > 1 AND page < total) OR (c = 2 AND page > 1)) AS again
  FROM p GROUP BY m, c),
k AS (SELECT *, strftime(m, '%Y%m%d') || ':' || strftime(last_day(m), '%Y%m%d') AS win FROM w)
SELECT '4:' || win AS key, (c IN (3, 4) OR (c = 1 AND total = 1)) AS committed_1, TRUE AS committed_2,
       CAST(kept + coalesce(again, 0) AS BIGINT) AS bronze_rows FROM k
UNION ALL SELECT '5:' || win, TRUE, TRUE, 0 FROM k""",
    "mining_report": f"""
WITH {_MINING_SILVER}
SELECT tipo_agregado, fase_grupo, count(processo) AS qtd_processos,
       round_even(CAST(coalesce(sum(CAST(area_ha AS DECIMAL(38,6))), 0) AS DOUBLE), 0) AS area_total_ha
FROM s GROUP BY tipo_agregado, fase_grupo""",

    "mining_coverage": f"""
WITH {_MINING_SILVER}
SELECT count(*) AS total, count(lat) AS with_value, count(*) - count(lat) AS without_value,
       CASE WHEN count(*) > 0 THEN round_even(CAST(count(lat) AS DOUBLE) * 100.0 / count(*), 1) END AS pct_with,
       CASE WHEN count(*) > 0 THEN round_even(CAST(count(*) - count(lat) AS DOUBLE) * 100.0 / count(*), 1) END
         AS pct_without
FROM s""",

    "tenders_silver": f"""
WITH l AS (
  SELECT *, CAST(l_suppkey AS VARCHAR) AS s,
         translate(format('{{:,.2f}}', l_extendedprice), ',.', '.,') AS br_price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS dec_price,
         translate(format('{{:,.2f}}', l_tax), ',.', '.,') AS br_tax,
         l_orderkey % 37 = 0 AS short
  FROM lineitem
  WHERE l_orderkey % 31 <> 0 AND l_linenumber % 3 <> 0)
SELECT DISTINCT
  'SP' AS municipio,
  CASE WHEN l_suppkey % 10 = 0 THEN 'Ent' || s || ';X' ELSE 'Ent' || s END AS entidade,
  CAST(l_orderkey AS VARCHAR) AS cod_licitacao, 'conc' AS modalidade,
  'Obras e servicos de engenharia' AS objeto,
  CASE WHEN NOT short THEN 'desc' END AS descricao_objeto,
  CASE WHEN NOT short THEN CAST(l_partkey AS VARCHAR) END AS produto_item,
  CASE WHEN NOT short THEN {_to_double("CAST(CAST(l_quantity AS DECIMAL(10,1)) AS VARCHAR)")} END AS qtd_contratada,
  CASE WHEN NOT short THEN 'un' END AS unidade_contratada,
  CASE WHEN NOT short THEN {_to_double("replace(replace(br_price, '.', ''), ',', '.')")} END AS vl_unit_orcamento_lote,
  CASE WHEN NOT short THEN {_to_double("replace(br_price, ',', '.')")} END AS qtd_orcamento_lote,
  CASE WHEN NOT short THEN 'un' END AS un_orcamento_lote,
  CASE WHEN NOT short THEN {_to_double("replace(replace(dec_price, '.', ''), ',', '.')")} END AS vl_unit_orcamento_item,
  CASE WHEN NOT short THEN {_to_double("CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR)")} END AS qtd_orcamento_item,
  CASE WHEN NOT short THEN 'un' END AS un_orcamento_item,
  CASE WHEN NOT short THEN CAST(l_linenumber AS VARCHAR) END AS num_edital,
  CASE WHEN NOT short AND l_orderkey % 29 <> 0
       THEN try_strptime(strftime(l_shipdate, '%-d/%-m/%Y'), '%d/%m/%Y') END AS dt_edital,
  CASE WHEN NOT short THEN 'cnpj' END AS cnpj_participante,
  CASE WHEN NOT short THEN 'Part' || s END AS nome_participante,
  CASE WHEN NOT short THEN 'hab' END AS resultado_habilitacao,
  CASE WHEN NOT short AND l_linenumber <> 7
       THEN {_to_double("replace(replace(br_tax, '.', ''), ',', '.')")} END AS vl_proposta,
  strftime(l_shipdate, '%Y-%m') AS periodo,
  TIMESTAMP '2024-01-01 00:00:00' AS dt_ingestao
FROM l""",

    "permits_silver": f"""
WITH {_PERMITS_SILVER}
SELECT ano_referencia, mes, alvara, processo, descricao, categoria_de_uso, area_construcao_m2,
       dt_aprovacao, blocos_pavimentos_unidades, uso_classificado
FROM firsts""",

    "permits_report": f"""
WITH {_PERMITS_SILVER}
SELECT uso_classificado, ano_referencia, count(alvara) AS qtd,
       round_even(CAST(coalesce(sum(CAST(area_construcao_m2 AS DECIMAL(38,6))), 0) AS DOUBLE) / 1e6, 2)
         AS area_total_km2
FROM firsts WHERE uso_classificado IS NOT NULL AND ano_referencia IS NOT NULL
GROUP BY uso_classificado, ano_referencia""",

    "investments_silver": f"""
SELECT c_name AS municipio, c_acctbal AS valor_investido_s, c_acctbal / 1e6 AS rs_milhoes,
       c_mktsegment AS setor__economico, c_custkey AS codigo,
       {_q(config.INVESTMENT_SOURCES[0][0])} AS fonte, '2024-01-01' AS dt_ingestao
FROM customer""",
    "investments_zip_silver": f"""
SELECT c_name AS municipio, c_acctbal AS valor_investido_s, c_mktsegment || chr(10) AS setor__economico,
       CASE WHEN c_custkey % 2 = 1 THEN c_custkey END AS codigo,
       {_q(config.INVESTMENT_SOURCES[0][0])} AS fonte, '2024-01-01' AS dt_ingestao
FROM customer""",
    "quoted_breaks": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang FROM documents""",
    "stream_keep_first": """
SELECT event_id, user_id, event_type, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
    "paged_load_replay": """
WITH p AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'attributes' ELSE 'geometry' END AS section, event_id // 2 AS pos,
                  user_id, (event_id // 2) // 250 AS page, CASE WHEN event_id % 2 = 0 THEN 3 ELSE 7 END AS bad FROM events),
w AS (SELECT section, count(*) AS total, coalesce(min(page) FILTER (page % 11 = bad) * 250, count(*)) AS first_bad FROM p GROUP BY section),
r AS (SELECT section, 1 AS run, first_bad AS watermark FROM w UNION ALL SELECT section, 2, total FROM w)
SELECT r.section, r.run, CAST(r.watermark AS BIGINT) AS watermark, count(p.pos) AS n_rows, count(DISTINCT p.user_id) AS n_claims
FROM r LEFT JOIN p ON p.section = r.section AND p.pos < r.watermark GROUP BY ALL""",
    "widened_union": """
SELECT o_orderkey AS pedido,
       CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey % 1000 AS VARCHAR) WHEN 1 THEN CAST((o_orderkey % 1000) / 2 AS VARCHAR)
            ELSE 'c' || CAST(o_orderkey AS VARCHAR) END AS codigo,
       CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey % 7 AS DOUBLE) WHEN 1 THEN CAST(o_orderkey * 3 AS DOUBLE)
            ELSE o_totalprice END AS n,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) ELSE o_orderdate END AS data,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderstatus END AS novo
FROM orders""",
    "period_urls": """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
m AS (SELECT year, printf('%04d-%02d', year, m) AS period FROM y, range(1, 13) AS r(m))
SELECT year, period, 'https://landing.invalid/licitacoes_' || period || '.zip' AS url FROM m""",
    "url_parts": r"""
SELECT page_id, url_decode(regexp_extract(url, '([^/?#]+)(?:[?#].*)?$', 1)) AS base,
       lower(regexp_extract(url, '\.([^./]+)$', 1)) AS ext,
       regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1) AS host FROM pages""",
    "jsonl_roundtrip": """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS nome, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS saldo,
       CAST(3 AS INTEGER) AS n_fields FROM customer""",
    "landed_layer": """
WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS k, s_suppkey % 3 AS e, CAST(s_suppkey AS VARCHAR) || ';' || s_name AS body
           FROM supplier WHERE s_suppkey % 10 <> 7)
SELECT k || ['.csv', '.ZIP', '.xlsx'][e + 1] AS name, ['csv', 'zip', 'xlsx'][e + 1] AS kind,
       CAST(strlen(body) AS BIGINT) AS n_bytes, sha256(body) AS sha256 FROM s""",
    "ledger_replay": """
WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS key FROM orders),
t AS (SELECT key FROM m WHERE CAST(substr(key, 6, 2) AS INTEGER) % 3 = 0)
SELECT 'a' AS pipeline, key FROM t WHERE key < '1997' UNION ALL SELECT 'b', key FROM t""",
    "sources_load": f"""
SELECT {_q(config.INVESTMENT_SOURCES[0][0])} AS fonte, 'ok' AS status, count(*) AS n FROM customer
UNION ALL SELECT {_q(config.INVESTMENT_SOURCES[1][0])}, 'failed', 0""",
    "permits_refresh_replay": """
WITH o AS (SELECT year(o_orderdate) AS y, o_orderkey + 2 AS row_idx FROM orders),
ys AS (SELECT y, min(y) OVER () AS first, max(y) OVER () AS last FROM (SELECT DISTINCT y FROM o)),
n AS (SELECT y, count(*) + 5 AS whole, count(*) FILTER (row_idx % 2 = 0 OR row_idx < 3) + 5 AS half FROM o GROUP BY y),
r AS (
  SELECT 1 AS run, y, CASE WHEN y = last THEN 'not landed' ELSE 'new' END AS status,
         CASE WHEN y < last THEN 'not committed' END AS reason, CASE WHEN y < last THEN whole END AS n_rows FROM ys JOIN n USING (y)
  UNION ALL
  SELECT 2, y, CASE WHEN y = last THEN 'new' WHEN y = first THEN 'changed' ELSE 'same' END,
         CASE WHEN y = last THEN 'not committed' WHEN y = first THEN 'changed' WHEN y = first + 1 THEN 'bronze gone' END,
         CASE WHEN y = first THEN half ELSE whole END FROM ys JOIN n USING (y)
  UNION ALL
  SELECT 3, y, 'same', CASE WHEN y = last THEN 'current year' END, CASE WHEN y = first THEN half ELSE whole END FROM ys JOIN n USING (y))
SELECT CAST(run AS INTEGER) AS run, CAST(y AS VARCHAR) AS key, status, reason, n_rows FROM r""",
}

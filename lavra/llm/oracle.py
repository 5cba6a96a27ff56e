"""DuckDB SQL of the operators' queries, where SQL can express them on whole tables.

The other operators are held to brute-force versions in ``tests/llm``: they
use hashes, models or iterations that SQL has no words for.
"""

from __future__ import annotations

from lavra.llm import quality_rules as q
from lavra.llm import secret_scan as s
from lavra.llm import url_filters as u
from lavra.llm.common import LANGUAGES, OTHER


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _quality_sql() -> str:
    limit, level = q.MAX_FALSE_REJECTION / len(q.RULES), q.DELTA / (len(q.RULES) * (len(LANGUAGES) + 1))
    langs = ", ".join(_quoted(x) for x in LANGUAGES)

    def rejects(r: q.Rule, cutoff: str) -> str:
        return f"({r.feature} {'>=' if r.above else '<='} {cutoff})"

    cuts = ", ".join(f"({_quoted(r.name)}, {i}, {c}::DOUBLE)" for r in q.RULES for i, c in enumerate(r.cutoffs))
    hit = "CASE rule " + " ".join(f"WHEN {_quoted(r.name)} THEN {rejects(r, 'cutoff')}" for r in q.RULES) + " END"
    term = (f"exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({limit}) + (n - i) * ln(1 - {limit}))")
    picked = ", ".join(f"max(cutoff) FILTER (rule = {_quoted(r.name)}) AS cut_{r.name}" for r in q.RULES)
    first = "CASE WHEN base_failed THEN 'base' " + " ".join(
        f"WHEN {rejects(r, f'cut_{r.name}')} THEN {_quoted(r.name)}" for r in q.RULES) + " END"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN lang IN ({langs}) THEN lang ELSE '{OTHER}' END AS stratum,
         coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (
  SELECT rid, i, array_to_string(ws[i:i + {q.WINDOW - 1}], ' ') AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {q.WINDOW - 2})) AS i FROM w WHERE len(ws) >= {q.WINDOW})),
rep AS (
  SELECT rid, count(DISTINCT i + o) AS n
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM win), range(0, {q.WINDOW}) AS r(o)
  WHERE c > 1 GROUP BY rid),
f AS (
  SELECT w.rid, doc_id, stratum, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '{q.SYMBOLS}'))::BIGINT AS n_symbols, len(ls) AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)),
g AS (
  SELECT *, (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words) AS base_failed,
         n_symbols / greatest(n_words, 1)::DOUBLE AS symbols_per_word,
         n_repeat_words / greatest(n_words, 1)::DOUBLE AS repeat_share,
         n_dup_lines / greatest(n_lines, 1)::DOUBLE AS dup_line_share,
         word_chars / greatest(n_words, 1)::DOUBLE AS mean_word_chars FROM f),
good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(coalesce(quality, 0)) = 1),
held AS (SELECT * FROM g WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
c AS (
  SELECT stratum, rule, i AS place, cutoff, count(*) AS n, count(*) FILTER ({hit}) AS k
  FROM held, (VALUES {cuts}) AS v(rule, i, cutoff) GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k >= n * {limit} THEN FALSE
            ELSE list_sum(list_transform(range(0, k + 1), lambda i: {term})) <= {level} END AS ok FROM c),
passed AS (
  SELECT *, bool_and(ok) OVER (PARTITION BY stratum, rule ORDER BY place) AS so_far FROM tested),
best AS (
  SELECT stratum, rule, arg_max(cutoff, place) AS cutoff FROM passed WHERE so_far GROUP BY stratum, rule),
cut AS (SELECT stratum, {picked} FROM best GROUP BY stratum),
judged AS (SELECT g.*, {first} AS rejected_by FROM g LEFT JOIN cut USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       rejected_by IS NULL AS kept, stratum, rejected_by FROM judged"""


def _url_sql() -> str:
    def fits(r: u.UrlRule) -> str:
        return f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"

    rules = sorted(u.RULES, key=lambda r: (-len(r.text), r.verdict != "allow"))
    name = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in rules) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in rules) + " END"
    # the tables' pages hold no canonical or refresh links, so a component is the spellings of one URL
    return rf"""
WITH a AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{u._UP}', '{u._LOW}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') AS path,
         array_to_string(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1, 's'), '&'),
             lambda x: x <> '' AND NOT regexp_matches(x, '^{u.TRACKING}(?:=|$)')), '&') AS query FROM a),
j AS (
  SELECT page_id, host, path, {name} AS rule, {verdict} AS own,
         CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '')
              || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS key FROM p),
k AS (SELECT key, CASE WHEN bool_or(own = 'allow') THEN 'allow' ELSE 'block' END AS inherited
      FROM j WHERE key IS NOT NULL AND own IS NOT NULL GROUP BY key)
SELECT page_id, host, path, rule, coalesce(own, inherited, '{u.DEFAULT}') AS verdict,
       CASE WHEN rule IS NOT NULL THEN 'rule' WHEN inherited IS NOT NULL THEN 'alias' ELSE 'default' END AS via
FROM j LEFT JOIN k USING (key)"""


def _secret_sql() -> str:
    parts = "\n  UNION ALL ".join(
        f"SELECT rid, {rank} AS rank, '{r.kind}' AS kind, {r.min_chars} AS least, t, "
        f"regexp_extract_all(t, {_quoted(r.pattern)}, 0) AS ms, regexp_extract_all(t, {_quoted(r.pattern)}, {r.group}) AS gs, "
        f"regexp_split_to_array(t, {_quoted(r.pattern)}) AS ps FROM d WHERE regexp_matches(t, {_quoted(r.pattern)})"
        for rank, r in enumerate(s.RULES))
    base = ", ".join(_quoted(r.kind) for r in s.BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in s.BASE_RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  {parts}),
e AS (SELECT rid, rank, kind, least, unnest(range(1, len(ms) + 1)) AS i, ms, gs, ps FROM m),
x AS (
  SELECT rid, rank, kind, length(gs[i]) >= least AS fits,
         list_sum(list_transform(ps[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(ms[1:i - 1],
             lambda y: length(y))), 0) AS st, length(ms[i]) AS ln FROM e),
y AS (SELECT rid, rank, kind, st::BIGINT AS st, (st + ln)::BIGINT AS en FROM x WHERE fits),
z AS (
  SELECT rid, {counts},
         string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, rank, en) AS spans,
         string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, rank, en) FILTER (kind IN ({base})) AS base
  FROM y GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in s.BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN z USING (rid)"""


SQL: dict[str, str] = {
    "op1_quality_rules": _quality_sql(),
    "op4_url_filters": _url_sql(),
    "op9_secret_scans": _secret_sql(),
}

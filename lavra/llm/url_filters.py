"""URL filters with redirect equivalence.

Rules name a host (with all its subdomains) and a path prefix, and block or
allow; the longest fitting rule decides, an allow winning a tie. URLs that
lead to one another are aliases: a canonical link or a meta refresh in a
page's HTML, rows of an optional redirect table, and spellings of one URL that
differ in scheme, fragment, tracking parameters or a closing slash only. The
connected components of these links are found by distributed star rounds. A
URL without a rule of its own takes its component's decision: allow if a rule
allows any member (explicit allow takes precedence), else block if a rule
blocks any member, whether or not that member was crawled, else the default.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule, no aliases and the default verdict; null HTML has no links; relative
links are resolved against the page; repeated rows are judged alike; only
page_id, url and html are read; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import store
from lavra.llm.graph import connected_components


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (UrlRule("net", "/", "block"), UrlRule("example.net", "/en/", "allow"),
         UrlRule("example.com", "/de/", "block"), UrlRule("org", "/fr/", "allow"))
DEFAULT = "allow"
# query parameters that tell where a visitor came from, not what is shown
TRACKING = r"(?:utm_[A-Za-z0-9_]*|ref|fbclid|gclid)"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(df: DataFrame, url: str, prefix: str = "") -> DataFrame:
    """Adds {prefix}host, {prefix}path and {prefix}key, one spelling for a URL's aliases by form.

    The key is host, path without closing slash and query without tracking; null without a host.
    Step by step, so that no expression is written out several times in the plan.
    """
    after, query = f"{prefix}after", f"{prefix}query"
    at = F.instr(url, "://")
    df = df.withColumn(after, F.when(at > 0, F.substring(url, at + 3, F.length(url))))
    df = df.withColumns({
        f"{prefix}host": F.coalesce(F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), _UP, _LOW), F.lit("")),
        f"{prefix}path": F.coalesce(F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit("")),
        query: F.regexp_extract(after, r"(?s)^[^?#]*\?([^#]*)", 1)})
    df = df.withColumn(query, F.array_join(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(?:=|$)")), "&"))
    return df.withColumn(f"{prefix}key", F.when(F.col(f"{prefix}host") != "", F.concat(
        f"{prefix}host", F.regexp_replace(f"{prefix}path", "/+$", ""),
        F.when(F.col(query) != "", F.concat(F.lit("?"), F.col(query))).otherwise("")))).drop(after, query)


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule] = RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null."""
    pick = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        pick = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(pick)
    return pick


def _resolved(links: DataFrame) -> DataFrame:
    """to_url: absolute form of the column link found on the page url (with its host and path)."""
    df = links.withColumns({"link": F.btrim(F.replace("link", F.lit("&amp;"), F.lit("&"))),
                            "scheme": F.regexp_extract("url", r"(?s)^(.*?)://", 1),
                            "folder": F.regexp_extract("path", r"(?s)^(?:.*/)?", 0)})
    df = df.withColumn("base", F.concat(F.col("scheme"), F.lit("://"), F.col("host")))
    link = F.col("link")
    to = (F.when(link == "", None)
          .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
          .when(link.startswith("//"), F.concat(F.col("scheme"), F.lit(":"), link))
          .when(link.startswith("/"), F.concat("base", "link"))
          .when(link.rlike(r"^(?:#|[A-Za-z][A-Za-z0-9+.-]*:)"), None)
          .when(link.startswith("?"), F.concat("base", "path", "link"))
          .otherwise(F.concat(F.col("base"), F.when(F.col("folder") == "", "/").otherwise(F.col("folder")), link)))
    return df.withColumn("to_url", to)


def page_links(pages: DataFrame) -> DataFrame:
    """from_url, to_url of canonical links and meta refreshes in the pages' HTML."""
    tag = F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0)))
    tags = (pages.filter(F.col("html").rlike(r"(?i)<[^>]*(?:canonical|http-equiv)") & F.col("url").isNotNull())
            .select("url", tag.alias("tag")).filter(F.col("tag").rlike(r"(?i)canonical|refresh")))
    value = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*))"""
    for name in ("rel", "href", "http-equiv", "content"):
        pattern = rf"(?is)\s{name}{value}"
        tags = tags.withColumn(name, F.concat(*[F.regexp_extract("tag", pattern, g) for g in (1, 2, 3)]))
    canonical = F.when(F.col("tag").rlike("(?i)^<link") & F.col("rel").rlike(r"(?i)(^|\s)canonical(\s|$)"),
                       F.col("href"))
    refresh = F.when(F.col("tag").rlike("(?i)^<meta") & (F.lower("http-equiv") == "refresh"),
                     F.regexp_extract("content", r"""(?is)url\s*=\s*['"]?([^'"]*)""", 1))
    links = tags.withColumn("link", F.coalesce(canonical, refresh)).filter("link is not null")
    return (_resolved(with_parts(links, "url")).filter("to_url is not null")
            .select(F.col("url").alias("from_url"), "to_url"))


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule] = RULES, redirects: DataFrame | None = None,
               default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict, via (rule, alias or default) of every row."""
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    links = store(with_parts(with_parts(links, "from_url", "f_"), "to_url", "t_"), "links")
    aliases = connected_components(links.select(F.col("f_key").alias("src"), F.col("t_key").alias("dst")))
    judged = with_parts(pages.select("page_id", "url"), "url").withColumn(
        "r", rule_of(F.col("host"), F.col("path"), rules))
    judged = store(judged.select("page_id", "host", "path", "key", "r.rule", "r.verdict"), "judged")
    # decisions of every URL that is seen, crawled or only linked to, one row per key and verdict
    linked = links.select(F.explode(F.array(*[F.struct(
        F.col(f"{p}key").alias("key"), rule_of(F.col(f"{p}host"), F.col(f"{p}path"), rules)["verdict"].alias("verdict"))
        for p in ("f_", "t_")])).alias("x")).select("x.*")
    decided = (judged.select("key", "verdict").unionByName(linked)
               .filter("key is not null and verdict is not null").distinct()
               .join(aliases, F.col("key") == F.col("node"), "left")
               .groupBy(F.coalesce("component", "key").alias("component"))
               .agg(F.when(F.bool_or(F.col("verdict") == "allow"), "allow").otherwise("block").alias("inherited")))
    own = judged.filter("rule is not null").select(
        "page_id", "host", "path", "rule", "verdict", F.lit("rule").alias("via"))
    rest = (judged.filter("rule is null").drop("rule", "verdict")
            .join(aliases, F.col("key") == F.col("node"), "left")
            .withColumn("component", F.coalesce("component", "key")).join(decided, "component", "left")
            .select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                    F.coalesce("inherited", F.lit(default)).alias("verdict"),
                    F.when(F.col("inherited").isNull(), "default").otherwise("alias").alias("via")))
    return own.unionByName(rest)

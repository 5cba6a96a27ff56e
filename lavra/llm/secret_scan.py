"""Secret scans with an incremental blob ledger (native DataFrame functions only).

Every version of a text is content-addressed by the SHA-256 of its UTF-8
bytes. A ledger holds the (blob, rule, rule version) pairs that have been
scanned and the findings of each blob. A scan reads only pairs the ledger
lacks: known blobs with known rule versions are not matched again, and one
blob is scanned once however many paths hold it. Findings are joined back to
all paths.

Matches are found leftmost and non-overlapping per rule. Their positions come
from the pieces between the matches: piece and match lengths alternate, and a
running sum over a blob's own matches gives code-point offsets.

Defined cases: a null text is an empty text, which has no findings; identical
texts have identical spans; repeated rows give repeated rows; equal starts are
ordered by rule, then end; only the path and text columns are read, so extra
columns don't matter; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lavra.llm.common import store


@dataclass(frozen=True)
class SecretRule:
    """A pattern; a match counts if its group has at least min_chars code points."""

    kind: str
    pattern: str
    group: int
    min_chars: int
    version: int = 1
    hint: str | None = None  # cheap pattern that every match contains


BASE_RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               2, 8),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 16),
    SecretRule("hex", r"[0-9a-f]{32,}", 0, 32),  # a longest run of 32 or more, as [0-9a-f]+ finds it
)
EXTRA_RULES = (
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    SecretRule("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
)
RULES = BASE_RULES + EXTRA_RULES

LEDGER_SCHEMA = "blob string, rules array<string>, found array<struct<start:bigint,rule:string,end:bigint>>"


def rule_key(r: SecretRule) -> str:
    return f"{r.kind}@{r.version}"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_blobs(blobs: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """blob, rule, start, end for (blob, text, seen): rules in seen are not matched again."""
    parts = []
    for r in rules:
        due = (~F.array_contains("seen", rule_key(r))) & F.col("text").rlike(r.pattern)
        parts.append(F.when(due, F.struct(
            F.lit(rule_key(r)).alias("rule"), F.lit(r.min_chars).alias("min_chars"),
            F.transform(F.split("text", r.pattern), F.char_length).alias("gaps"),
            F.transform(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)), F.char_length).alias("lens"),
            F.transform(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group)), F.char_length).alias("held"))))
    hit = blobs.select("blob", F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("h"))
    each = hit.select("blob", F.col("h.rule").alias("rule"), F.col("h.min_chars").alias("min_chars"),
                      F.posexplode(F.arrays_zip(F.col("h.lens").alias("len"), F.col("h.held").alias("held"),
                                                F.slice("h.gaps", 1, F.size("h.lens")).alias("gap"))))
    before = W.partitionBy("blob", "rule").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (each.select("blob", "rule", "pos", "min_chars", F.col("col.len").alias("len"),
                        F.col("col.held").alias("held"), F.col("col.gap").alias("gap"))
            .withColumn("end", F.sum((F.col("gap") + F.col("len")).cast("long")).over(before))
            .filter("held >= min_chars")
            .select("blob", "rule", (F.col("end") - F.col("len")).alias("start"), "end"))


def scan_incremental(docs: DataFrame, ledger: DataFrame, rules: Sequence[SecretRule] = RULES,
                     path: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scan what the ledger lacks. Returns (versions, ledger rows to append).

    versions: one row per input row, the path and its blob. Ledger rows: per
    blob newly scanned for some rules, those rules and what they found. A blob
    with nothing found has a row too, which is what later runs skip.
    """
    versions = docs.select(F.col(path).alias("path"), blob_id(F.col(text)).alias("blob"))
    seen = (ledger.select("blob", F.explode("rules").alias("rule"))
            .groupBy("blob").agg(F.collect_set("rule").alias("seen")))
    wanted = F.array(*[F.lit(rule_key(r)) for r in rules])
    none = F.array().cast("array<string>")
    unseen = (docs.select(blob_id(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
              .dropDuplicates(["blob"])
              .join(seen, "blob", "left")
              .withColumn("seen", F.coalesce("seen", none))
              .filter(F.size(F.array_except(wanted, F.col("seen"))) > 0))
    # a possible match keeps a blob's text; the others only leave their ledger row
    found = (scan_blobs(unseen, rules).groupBy("blob")
             .agg(F.array_sort(F.collect_list(F.struct("start", "rule", "end"))).alias("found")))
    scanned = (versions.select("blob").distinct().join(seen, "blob", "left")
               .select("blob", F.array_except(wanted, F.coalesce("seen", none)).alias("rules"))
               .filter(F.size("rules") > 0))
    entries = (scanned.join(found, "blob", "left")
               .select("blob", "rules", F.coalesce("found", F.array().cast(
                   "array<struct<start:bigint,rule:string,end:bigint>>")).alias("found")))
    return versions, entries


def findings(versions: DataFrame, ledger: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """path, blob and spans (array of start, kind, end in rule order) of every version."""
    current = {rule_key(r): i for i, r in enumerate(rules)}
    kinds = {rule_key(r): r.kind for r in rules}
    order = F.create_map(*[F.lit(x) for kv in current.items() for x in kv])
    kind = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    live = (ledger.filter(F.size("found") > 0).select("blob", F.explode("found").alias("f"))
            .filter(F.col("f.rule").isin(*current))
            .groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(
                F.col("f.start").alias("start"), order[F.col("f.rule")].alias("rank"),
                F.col("f.end").alias("end"), kind[F.col("f.rule")].alias("kind")))).alias("spans")))
    return versions.join(live, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast(
            "array<struct<start:bigint,rank:int,end:bigint,kind:string>>")).alias("spans"))


def secret_scan(docs: DataFrame, ledger: DataFrame | None = None,
                rules: Sequence[SecretRule] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings of every row, ledger with this scan's rows). The ledger rows are stored in the shared folder."""
    ledger = empty_ledger(docs.sparkSession) if ledger is None else ledger
    versions, entries = scan_incremental(docs, ledger, rules)
    ledger = ledger.unionByName(store(entries, "ledger"))
    return findings(versions, ledger, rules), ledger


def spans_text(spans: Column, kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:end`` joined by commas, of the kinds given (None: all)."""
    own = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

"""Mixing sources to target weights: temperature, then budgeted block permutations.

Token shares p of the sources are raised to an exponent t and normalised:
w ~ p^t. t = 1 keeps the shares, t = 0 makes all sources equal. The exponent
is bisected so that the weights' entropy meets a target, or no source is
repeated more often than a limit. Each bisection round evaluates a grid of
exponents in one aggregation over the sources' totals; the driver sees one
number per exponent, never the sources.

The weights are realised over blocks: a source's rows are hashed into
``blocks`` blocks, and every pass over the source takes its blocks in an order
drawn for that pass. A source's budget is its weight times the total budget;
full passes take every block, the last pass takes blocks in order until the
budget is met and cuts the last block row by row. Windows run over a source's
blocks (at most ``blocks`` rows) or one block's different rows, and the number of
blocks follows the number of rows, so a source with a third of all rows is
spread over as many tasks as it has blocks.

With budget None the total is the smallest one in which the source that gains
least is read exactly once, so that no row is left out and the others repeat.

Defined cases: null or blank texts have no tokens and are emitted with every
full pass; a null source is a source of its own, as is the empty name; ties
and repeated rows are ordered by hash, then copy number, each row emitted as
often as its block is; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lavra.llm.common import store, words

BLOCKS = 256
ROWS = 1_000_000  # rows of a block, of which one per source is cut row by row
GRID = 17
ROUNDS = 6
MAX_REPEATS = 2.0


def token_rows(docs: DataFrame, blocks: int = BLOCKS, seed: int = 0) -> DataFrame:
    """doc_id, source, tokens (words) and block of every row, without the text."""
    return docs.select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("tokens"),
        row_hash(seed).alias("row_hash")).withColumn("block", F.pmod("row_hash", F.lit(blocks)).cast("int"))


def row_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.xxhash64("text"))


def _curve(totals: DataFrame, grid: list[float]) -> list[tuple[float, float, float]]:
    """(t, entropy of the weights, most passes of a source relative to the fewest) on a grid."""
    top = totals.filter("tokens > 0").agg(F.log(F.max("tokens")).alias("hi"), F.log(F.min("tokens")).alias("lo")).first()
    if top is None or top["hi"] is None:
        return [(t, 0.0, 1.0) for t in grid]
    terms = (totals.filter("tokens > 0").select((F.log("tokens") - F.lit(top["hi"])).alias("lp"))
             .select("lp", F.explode(F.array(*[F.lit(float(t)) for t in grid])).alias("t"))
             .groupBy("t").agg(F.sum(F.exp(F.col("t") * F.col("lp"))).alias("z"),
                               F.sum(F.exp(F.col("t") * F.col("lp")) * F.col("t") * F.col("lp")).alias("m")))
    rows = {r["t"]: (r["z"], r["m"]) for r in terms.collect()}  # one row per exponent of the grid
    return [(t, math.log(rows[t][0]) - rows[t][1] / rows[t][0], math.exp((1 - t) * (top["hi"] - top["lo"])))
            for t in grid]


def fit_exponent(totals: DataFrame, target_entropy: float | None = None,
                 max_repeats: float | None = MAX_REPEATS) -> float:
    """The exponent in [0, 1] that meets the target: the largest t with at least that entropy
    (in nats), or the smallest t at which no source passes more than max_repeats times as often
    as the one that passes least. Both given: the larger t, so that the repetition limit holds.
    """
    def bisect(ok: Callable[[tuple], bool], smallest: bool) -> float:
        lo, hi = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [lo + (hi - lo) * i / (GRID - 1) for i in range(GRID)]
            good = [ok(c) for c in _curve(totals, grid)]
            if smallest:  # ok from some t on
                i = next((i for i, g in enumerate(good) if g), GRID - 1)
                lo, hi = grid[max(0, i - 1)], grid[i]
            else:  # ok up to some t
                i = max((i for i, g in enumerate(good) if g), default=0)
                lo, hi = grid[i], grid[min(GRID - 1, i + 1)]
            if hi - lo < 1e-9:
                break
        return hi if smallest else lo

    found = []
    if target_entropy is not None:
        found.append(bisect(lambda c: c[1] >= target_entropy, smallest=False))
    if max_repeats is not None:
        found.append(bisect(lambda c: c[2] <= max_repeats * (1 + 1e-12), smallest=True))
    return max(found, default=1.0)


def plan_blocks(rows: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
                budget: int | None = None, seed: int = 0) -> DataFrame:
    """source, block, full passes, how the last pass takes the block, and its order there.

    ``rest`` is null if the last pass leaves the block out, a token count if the block is cut
    to so many tokens, and -1 if it is taken whole.
    """
    per_block = store(rows.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens")), "blocks")
    totals = store(per_block.groupBy("source").agg(F.sum("block_tokens").alias("tokens")), "sources")
    t = fit_exponent(totals, target_entropy, max_repeats)
    some = totals.filter("tokens > 0")
    z = some.agg(F.max("tokens").alias("top"), F.sum("tokens").alias("all")).first()
    top = float(z["top"] or 1)
    weight = F.pow(F.col("tokens") / F.lit(top), F.lit(t))
    norm = some.agg(F.sum(weight).alias("z")).first()["z"] or 1.0
    if budget is None:  # the largest source, which gains least, is read once
        quota = F.lit(top) * weight
    else:
        quota = F.lit(float(budget)) * weight / F.lit(norm)
    goals = totals.select(
        "source", "tokens", (F.when(F.col("tokens") > 0, weight / F.lit(norm)).otherwise(0.0)).alias("weight"),
        F.when(F.col("tokens") > 0, F.round(quota)).otherwise(0).cast("long").alias("goal"))
    goals = goals.withColumns({
        "passes": F.when(F.col("tokens") > 0, F.floor(F.col("goal") / F.col("tokens"))).otherwise(1).cast("int"),
        "left": F.when(F.col("tokens") > 0, F.col("goal") % F.col("tokens")).otherwise(0)})
    per_block = per_block.join(goals.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # a source's blocks, at most BLOCKS rows, in the order drawn for the last pass
    order = W.partitionBy("source").orderBy(
        F.xxhash64(F.lit(seed), F.col("passes"), F.col("block")), "block")
    run = F.sum("block_tokens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (per_block.withColumn("_upto", run)
            .withColumn("rest", F.when(F.col("_upto") <= F.col("left"), F.when(F.col("left") > 0, F.lit(-1)))
                        .when(F.col("_upto") - F.col("block_tokens") < F.col("left"),
                              F.col("left") - F.col("_upto") + F.col("block_tokens")).cast("long"))
            .select(F.col("source").alias("_source"), F.col("block").alias("_block"), "weight", "passes", "rest"))


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
        budget: int | None = None, blocks: int | None = None, seed: int = 0) -> DataFrame:
    """doc_id, source, tokens, block, weight, copy, place for every emitted copy of a row.

    copy counts the passes from 0; within a source and copy, blocks come in the order of place.
    blocks: None for one per ROWS rows, BLOCKS at least.
    """
    blocks = blocks or max(BLOCKS, -(-docs.count() // ROWS))
    rows = store(token_rows(docs, blocks, seed), "mix-rows")
    plan = store(plan_blocks(rows, target_entropy, max_repeats, budget, seed), "mix-plan")
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    columns = ["doc_id", "source", "tokens", "block", "weight", "row_hash"]
    full = placed.filter("passes > 0").select(*columns, F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("copy"))
    last = placed.filter("rest = -1").select(*columns, F.col("passes").alias("copy"))
    # only cut blocks, at most one per source, need a running sum; equal rows are one row of it
    equal = placed.filter("rest > 0").groupBy(*columns, "passes", "rest").agg(F.count(F.lit(1)).alias("m"))
    before = F.coalesce(F.sum(F.col("tokens") * F.col("m")).over(
        W.partitionBy("source", "block").orderBy("row_hash", "doc_id", "tokens").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    room = F.col("rest") - F.col("before")
    fits = F.when(F.col("tokens") > 0, F.least("m", F.floor(room / F.greatest("tokens", F.lit(1))))).otherwise(F.col("m"))
    cut = (equal.withColumn("before", before).filter("before <= rest").withColumn("fits", fits).filter("fits > 0")
           .select(*columns, F.col("passes").alias("copy"), F.explode(F.sequence(F.lit(1), F.col("fits"))).alias("_fit")).drop("_fit"))
    return (full.unionByName(last).unionByName(cut)
            .withColumn("place", F.xxhash64(F.lit(seed), F.col("copy"), F.col("block"))))


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with _mx_k: the number, from 0, of each row among those of equal keys.

    A key's rows are numbered where they lie and offset by what the tasks before hold, so a key of
    any size needs no task of its own.
    """
    rows = store(rows.withColumn("_mx_id", F.monotonically_increasing_id()), "mix-partly")
    rows = rows.withColumn("_mx_task", F.shiftright("_mx_id", 33))
    held = rows.groupBy(*keys, "_mx_task").agg(F.count(F.lit(1)).alias("_mx_n"))
    offset = F.coalesce(F.sum("_mx_n").over(
        W.partitionBy(*keys).orderBy("_mx_task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    at = held.select(*[F.col(k).alias(f"{k}_at") for k in keys], F.col("_mx_task").alias("_mx_task_at"), offset.alias("_mx_offset"))
    same = F.col("_mx_task") == F.col("_mx_task_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_at"))
    here = F.row_number().over(W.partitionBy(*keys, "_mx_task").orderBy("_mx_id")) - 1
    return rows.withColumn("_mx_here", here).join(at, same).withColumn("_mx_k", F.col("_mx_here") + F.col("_mx_offset"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as many times as the mixture emits it; the same columns.

    Copies meet their texts by doc_id, source and row hash, so the join is spread evenly. Of m equal
    rows that are emitted e times, each comes e // m times and the first e % m of them once more.
    """
    seed = options.get("seed", 0)
    keys = ["doc_id", "source", "row_hash"]
    emitted = mix(docs, **options).groupBy(*keys).agg(F.count(F.lit(1)).alias("_mx_emitted"))
    held = token_rows(docs, 1, seed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_mx_rows"))
    named = {k: f"_mx_{k}" for k in keys}
    same = [F.col(f"_mx_{k}").eqNullSafe(F.col(k)) for k in keys]
    counts = emitted.withColumnsRenamed(named).join(held, same[0] & same[1] & same[2]).select(
        *named.values(), F.floor(F.col("_mx_emitted") / F.col("_mx_rows")).cast("int").alias("_mx_each"),
        (F.col("_mx_emitted") % F.col("_mx_rows")).alias("_mx_more"))
    joined = docs.join(counts, F.col("doc_id").eqNullSafe(F.col("_mx_doc_id")) & F.col("source").eqNullSafe(F.col("_mx_source"))
                       & (row_hash(seed) == F.col("_mx_row_hash")))
    own = [F.col(f"`{c}`") for c in docs.columns]
    whole = joined.filter("_mx_more = 0").withColumn("_mx_copy", F.explode(F.sequence(F.lit(1), F.col("_mx_each"))))
    # equal rows that the mixture cut among them: one group per source at most
    partly = _numbered(joined.filter("_mx_more > 0"), list(named.values())).withColumn(
        "_mx_times", F.col("_mx_each") + (F.col("_mx_k") < F.col("_mx_more")).cast("int")).filter("_mx_times > 0")
    partly = partly.withColumn("_mx_copy", F.explode(F.sequence(F.lit(1), F.col("_mx_times"))))
    return whole.select(*own).unionByName(partly.select(*own))

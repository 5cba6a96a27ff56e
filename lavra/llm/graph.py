"""Distributed connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
    return (both.join(least, "src").filter(F.col("dst") > F.col("src"))
            .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("src").agg(F.min("dst").alias("m"))
    near = (edges.join(least, "src").filter(F.col("dst") != F.col("m"))
            .select(F.col("dst").alias("src"), F.col("m").alias("dst")))
    return near.unionByName(least.select("src", F.col("m").alias("dst"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of an edge list src, dst.

    Both steps pre-aggregate a node's neighbours to their smallest before a
    shuffle; a hub's edges are joined with one row and can be split. The edge
    list of each round is stored in the shared folder; rounds end when it no
    longer changes. Null ends and self loops are dropped; nodes without any
    other edge are not listed.
    """
    state = store(edges.filter("src is not null and dst is not null and src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    last = mark(state)
    while last[0]:
        state = store(_small_star(_large_star(state)), "edges")
        now = mark(state)
        if now == last:
            break
        last = now
    roots = state.select(F.col("dst").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return state.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)

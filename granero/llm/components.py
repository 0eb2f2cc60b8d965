"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.llm.common import put_aside


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _towards_minimum(links: DataFrame, both_ways: bool) -> DataFrame:
    """One star step: every node's neighbours (all larger ones, or all smaller ones and itself) point to its least one.

    The minima are combined before the shuffle and stored, so the join back may split a node with very many links.
    """
    around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else links
    least = put_aside(around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    joined = around.join(least, "u")
    if both_ways:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return put_aside(moved.filter("u <> v").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for links (u, v): the least node reachable. Nodes without links are not listed.

    Large-star and small-star steps alternate until nothing changes; every step is linear in the links and stored.
    """
    step = put_aside(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                     "links")
    before = _fingerprint(step)
    while True:
        step = _towards_minimum(_towards_minimum(step, True), False)
        now = _fingerprint(step)
        if now == before:
            break
        before = now
    return step.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        step.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

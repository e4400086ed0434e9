"""Connected components of a link table, by alternating stars, all in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged


def _least(edges: DataFrame, name: str) -> DataFrame:
    """Each node's least neighbour or itself; a written table, so a hub's links can be split among tasks."""
    return staged(edges.groupBy("u").agg(F.min("v").alias("m"))
                  .select("u", F.least("u", "m").alias("m")), name)


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both, "large-star"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down, "small-star")
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every linked node: the least node of its component. ``links`` has ``u, v``.

    Large and small star operations in turn (both keep components) until the links
    are stars around least nodes; every round is a written table.
    """
    def tidy(e):
        return staged(e.where("u <> v").distinct(), "stars")

    def print_of(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = tidy(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    before = print_of(edges)
    while before[0]:
        edges = tidy(_small(tidy(_large(edges))))
        after = print_of(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())

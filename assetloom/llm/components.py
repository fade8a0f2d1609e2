"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assetloom.session import materialize


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b); the component is its smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours to its
    smallest one, then its smaller neighbours likewise. Stars of any size shrink in
    a step or two, and a step is a minimum per node and a join, so a hub with very many
    neighbours is aggregated before the shuffle and never collected. Each round is written,
    which cuts the lineage.
    """
    now = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .where("a < b").distinct(), name)
    mark = _mark(now)
    while mark[0]:
        now = materialize(_small(_large(now)), name)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Edges a < b: every node u joins its larger neighbours to min(neighbours, u)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (edges.select(F.col("a").alias("u"), F.col("b").alias("v")).join(least, "u")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct())


def _small(edges: DataFrame) -> DataFrame:
    """Every node u joins its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
    own = least.select(F.col("m").alias("a"), F.col("u").alias("b"))
    rest = (edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b"))
    return own.unionByName(rest).distinct()

"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import remove, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: every node hands its larger (``large``) or smaller neighbours to its least neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.where(F.col("b") < F.col("a"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        out = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def _is_star(edges: DataFrame) -> bool:
    """Every node has one edge down and no centre has one: the centres are the least ids."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")) \
        .union(edges.select(F.col("b").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    node = ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    bad = F.max(((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).cast("int"))
    return not node.agg(bad.alias("bad")).first().bad


def components(edges: DataFrame, path: str) -> DataFrame:
    """(id, component): each node of the edges (a, b) with the least id it can reach.

    Each round joins the edges with per-node minima (hot nodes are pre-aggregated, and the
    skewed side of the join can be split) and is written to ``path``; rounds stop when every
    component is a star around its least id, after about log(nodes) of them. Null ends and self loops
    are ignored; an empty table gives no rows. Only one flag per round reaches the driver.
    """
    spark = edges.sparkSession
    now, k = edges.select("a", "b").where(F.col("a") != F.col("b")), 0
    while True:
        large = stage(_star(now, True), f"{path}/large-{k}")
        now = stage(_star(large, False), f"{path}/small-{k}")
        remove(spark, f"{path}/large-{k}")
        if k:
            remove(spark, f"{path}/small-{k - 1}")
        if _is_star(now):
            break
        k += 1
    star = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return star.union(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())

"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _stars(edges: DataFrame) -> DataFrame:
    """``u, v, m`` for both directions of every edge; m is the smallest of u and its neighbours.

    The smallest neighbour is an aggregation joined back, so the neighbours of
    a node never meet in one task.
    """
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest node around u."""
    return _stars(edges).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v")


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` (its smallest node) for every node that has an edge ``u, v``.

    The edges end up as stars round the smallest node of each component; the
    number of rounds grows with the logarithm of the longest path.  Each round
    is written to the shared folder, so a lost executor costs its tasks only.
    """
    proper = edges.select("u", "v").where("u <> v")
    now = materialize(_small_star(proper).distinct(), label)
    while not _is_stars(now):
        now = materialize(_small_star(_large_star(now).where("u <> v")).distinct(), label)
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one centre and no centre hangs on another node."""
    roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    both = roles.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return both.where("hangs > 1 or (hangs > 0 and holds > 0)").limit(1).count() == 0

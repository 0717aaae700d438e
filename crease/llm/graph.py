"""Connected components of an undirected graph as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.session import materialize, splittable


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has an edge; component: smallest node.

    ``edges`` has columns ``a`` and ``b`` (long, not null; direction, loops and
    repeats don't matter; no rows give no rows).  Alternates the large-star and
    small-star steps (Kiveris et al., "Connected components in MapReduce and
    beyond"): every step keeps at most as many edges as before, and the edges
    end as stars around the smallest node of each component.  Every round is
    written to the shared checkpoint folder, so a lost executor costs at most a
    round.  Raises when ``max_rounds`` do not suffice (rounds grow with the
    logarithm of the longest path).
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
                    .distinct(), "edges")
    for _ in range(max_rounds):
        # large star: each greater neighbour of x hangs on the least of x and its neighbours
        both = e.select(F.col("v").alias("x"), F.col("u").alias("y")).union(
            e.select(F.col("u").alias("x"), F.col("v").alias("y")))
        # the centre of a star has all its leaves: a hot key of the joins, which AQE can split
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = (both.where("y > x").join(splittable(least, "x"), "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
                 .where("u <> v").distinct())
        large = materialize(large, "large-star")
        # small star: the lesser neighbours of v, and v, hang on the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = materialize(
            large.join(splittable(low, "v"), "v").select(F.explode(F.array("u", "v")).alias("v"), F.col("m").alias("u"))
            .where("u <> v").distinct(), "small-star")
        # stars around least nodes: nobody is both a centre and a leaf, and a leaf has one centre
        state = small.agg(F.count("*").alias("n"), F.countDistinct("v").alias("leaves")).first()
        tangled = state["n"] != state["leaves"] or small.select("v").join(
            small.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count() > 0
        e = small
        if not tangled:
            leaf = e.select(F.col("v").alias("node"), F.col("u").alias("component"))
            return leaf.union(e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

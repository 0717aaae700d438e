"""Regression trees as relations (M7, M8): a node table that rows walk down.

A tree is a table ``node, feature, threshold, left, right, prediction`` (and ``level``,
see :func:`with_levels`): a row at an inner node goes left when ``features[feature]``
is at most the threshold, else right; a leaf has ``left`` -1.  It may be stated
(:func:`stated_tree`), have its leaves' predictions averaged from labelled rows
(:func:`leaf_means`), or come from a fitted MLlib model (``overs.tree_dump``).

Rows walk down in two ways that give the same.  The top of a tree (``TOP`` levels, at most
``2 ** (TOP + 1) - 1`` nodes) is one map value that every row looks into, so a small tree costs a
projection and no join.  Below it, rows meet one level at a time in an equi-join on the
node they stand at.  A level's nodes are broadcast when they measure small; beyond
that a node where many rows stand is a hot key that AQE can split.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.session import materialize, splittable

TOP = 5                # levels that are walked inside one value
NODE = ["node", "feature", "threshold", "left", "right", "prediction"]


def stated_tree(rows: DataFrame, splits: Iterable[tuple[int, int, int, int]], features: str = "features") -> DataFrame:
    """A node table from stated splits (node, feature, left, right): each threshold is the mean of
    its feature over ``rows``, to 6 places.  Nodes without a split are leaves; predictions are NULL.

    One aggregate over the rows; no rows: NULL thresholds, and every row goes right.
    """
    splits = list(splits)
    used = sorted({f for _, f, _, _ in splits})
    means = rows.agg(*[F.round(F.avg(F.col(features)[f]), 6).alias(f"_m{f}") for f in used])
    inner = {n for n, _, _, _ in splits}
    leaves = sorted({c for _, _, a, b in splits for c in (a, b)} - inner) or [0]

    def struct(node, feature, threshold, left, right):
        values = (F.lit(node), F.lit(feature).cast("int"), threshold, F.lit(left), F.lit(right), F.lit(None).cast("double"))
        return F.struct(*[v.alias(n) for v, n in zip(values, NODE, strict=True)])

    nodes = [struct(n, f, F.col(f"_m{f}"), a, b) for n, f, a, b in splits]
    nodes += [struct(n, None, F.lit(None).cast("double"), -1, -1) for n in leaves]
    return means.select(F.inline(F.array(*nodes)))


def with_levels(nodes: DataFrame, depth: int) -> DataFrame:
    """The node table with ``level``, the steps from the root (node 0); nodes that no step reaches are left out."""
    link = nodes.select(F.col("node").alias("_parent"), "left", "right").where("left >= 0")
    links = link.select("_parent", F.explode(F.array("left", "right")).alias("node"))
    at = nodes.where("node = 0").select("node", F.lit(0).alias("level"))
    found = at
    for level in range(1, depth + 1):
        at = links.join(at.select(F.col("node").alias("_parent")), "_parent", "left_semi").select("node", F.lit(level).alias("level"))
        found = found.union(at)
    return nodes.join(found, "node")


def _below(features: Column, step: Column) -> Column:
    """The child that a row goes to from an inner node; a NULL feature goes right."""
    return F.when(F.get(features, step["feature"]) <= step["threshold"], step["left"]).otherwise(step["right"])


def descend(rows: DataFrame, nodes: DataFrame, depth: int, features: str = "features", leaf: str = "leaf",
            prediction: str = "prediction", top: int = TOP) -> DataFrame:
    """``rows`` with the node each ends at after at most ``depth`` steps, and that node's prediction.

    ``nodes`` has a ``level`` (:func:`with_levels`) when the tree is deeper than ``top``.
    A row without features (NULL) goes right everywhere.
    """
    value = F.struct(*[F.col(c) for c in NODE[1:]])
    within = nodes.where(F.col("level") <= top) if depth > top else nodes
    held = within.select(F.map_from_entries(F.collect_list(F.struct(F.col("node"), value)))).scalar()
    x = rows.withColumn("_top", held).withColumn("_at", F.lit(0))
    for _ in range(min(depth, top)):
        x = x.withColumn("_step", F.try_element_at("_top", "_at"))
        x = x.withColumn("_at", F.when(F.col("_step.left") >= 0, _below(F.col(features), F.col("_step"))).otherwise(F.col("_at")))
    x = x.drop("_step")
    if depth <= top:
        return (x.withColumn(prediction, F.try_element_at("_top", "_at")["prediction"])
                .withColumnRenamed("_at", leaf).drop("_top"))
    x = x.drop("_top")
    for level in range(top, depth):
        step = nodes.where((F.col("level") == level) & (F.col("left") >= 0)).select(F.col("node").alias("_at"), value.alias("_step"))
        x = x.join(splittable(step, "_at"), "_at", "left")
        x = x.withColumn("_at", F.when(F.col("_step").isNotNull(), _below(F.col(features), F.col("_step"))).otherwise(F.col("_at")))
        x = x.drop("_step")
    ends = nodes.select(F.col("node").alias("_at"), F.col("prediction").alias(prediction))
    return x.join(splittable(ends, "_at"), "_at", "left").withColumnRenamed("_at", leaf).select(
        *rows.columns, leaf, prediction)


def leaf_means(nodes: DataFrame, rows: DataFrame, label: str, depth: int, features: str = "features") -> DataFrame:
    """The node table with the mean label of the rows that end at each leaf; a leaf that no row
    reaches, and every inner node, has the mean of all rows.

    The rows are combined by leaf before the shuffle, however many end at one.
    """
    at = descend(rows.select(features, F.col(label).alias("_label")), nodes, depth, features, leaf="node", prediction="_p")
    means = at.groupBy("node").agg(F.avg("_label").alias("_mean"))
    overall = rows.agg(F.avg(label)).scalar()
    others = [c for c in nodes.columns if c != "prediction"]
    return nodes.drop("prediction").join(means, "node", "left").select(*others, F.coalesce("_mean", overall).alias("prediction"))


def leaf_counts(nodes: DataFrame, rows: DataFrame, values: list[str], depth: int, features: str = "features") -> DataFrame:
    """How often each combination of ``values`` occurs among the rows that end at a leaf, and its share
    there: ``leaf, <values>, n, share``.  The leaf's distribution, as counts; a leaf that no
    row reaches has that of all rows.

    The counts are written once (at most a row per leaf and combination): all that follows, the
    counts of all rows too, reads them, and the rows walk down once.
    """
    at = descend(rows.select(features, *values), nodes, depth, features)
    counts = materialize(at.groupBy("leaf", *values).agg(F.count("*").alias("n")), "leaf-counts")
    unseen = nodes.where("left < 0").select(F.col("node").alias("leaf")).join(counts, "leaf", "left_anti")
    every = counts.groupBy(*values).agg(F.sum("n").alias("n")).withColumn("_all", F.lit(True))
    counts = counts.union(unseen.withColumn("_all", F.lit(True)).join(every, "_all").select("leaf", *values, "n"))
    total = counts.groupBy("leaf").agg(F.sum("n").alias("_all"))
    return counts.join(total, "leaf").select("leaf", *values, "n", (F.col("n") / F.col("_all")).alias("share"))

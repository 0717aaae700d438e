"""Over-level features, regression trees and batch scoring of over plans.

The reference walks a match over by over on the driver, looking up three
player profiles and calling ``predict`` once per over.  Here an *over plan*
(match, innings, over, striker, non_striker, bowler) is a table: profiles are
joined on, the trees score all overs in one ``transform``, and the innings
rules (wicket discount, all out, chase passed) are running aggregates.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crease.fixed import BAT_PROFILE_COLS, BOWL_PROFILE_COLS, OVERS, TREE_BINS, TREE_DEPTH
from crease.functions import flatten_features, unit_hash, wicket_discount
from crease.operators.careers import profile_means
from crease.operators.growing import GrownTree, grow_trees
from crease.operators.innings import innings_cutoff, over_of, scorecard
from crease.session import splittable

# Slices of the hashes by which a stated number of overs is picked.
TRAIN_SLICES = 1 << 16
# Share of matches that no fit sees.
HELD_OUT = 0.2

PLAN_KEYS = ["match_id", "innings", "over"]


def bowling_schedule(lineups: DataFrame, overs: int = OVERS, keys: list[str] | None = None,
                     order: str = "bowling") -> DataFrame:
    """Bowler of every over: order[over mod len(order)]."""
    keys = keys or ["match_id", "innings"]
    o = F.explode(F.sequence(F.lit(0), F.lit(overs - 1))).alias("over")
    x = lineups.select(*keys, order, o)
    return x.select(*keys, "over", F.element_at(
        F.col(order), (F.pmod(F.col("over"), F.size(order)) + 1).cast("int")).alias("bowler"))


def over_plan(strikes: DataFrame, schedule: DataFrame, order: str = "ball_no") -> DataFrame:
    """Pair at the crease on the first ball of each over, with that over's bowler."""
    first = strikes.filter(F.pmod(F.col(order) - 1, F.lit(6)) == 0).select(
        "match_id", "innings", over_of(order).alias("over"), "striker", "non_striker")
    return first.join(schedule, PLAN_KEYS, "left")


def _profile(prof: DataFrame, key: str, cols: list[str], prefix: str) -> DataFrame:
    return splittable(prof.select(F.col(prof.columns[0]).alias(key),
                                  *[F.col(c).alias(f"{prefix}{c}") for c in cols]), key)


def over_features(plan: DataFrame, bat_prof: DataFrame, bowl_prof: DataFrame,
                  bat_cols: list[str] = BAT_PROFILE_COLS,
                  bowl_cols: list[str] = BOWL_PROFILE_COLS) -> DataFrame:
    """Profile look-up for striker, non-striker and bowler of every over (J5 + A8).

    A player without a profile takes the column means of the profile table
    (each table's means read as one struct-valued scalar subquery).  Adds the 5 + 5 + 4 profile
    columns and ``features``: [over] + striker + non-striker + bowler, 15 doubles
    (F6).  The first column of each profile table is its player key.
    """
    from crease.operators.outcomes import one_row
    x = (plan
         .join(_profile(bat_prof, "striker", bat_cols, "s_"), "striker", "left")
         .join(_profile(bat_prof, "non_striker", bat_cols, "ns_"), "non_striker", "left")
         .join(_profile(bowl_prof, "bowler", bowl_cols, "b_"), "bowler", "left")
         .withColumn("_bat_mean", one_row(profile_means(bat_prof, bat_cols), bat_cols))
         .withColumn("_bowl_mean", one_row(profile_means(bowl_prof, bowl_cols), bowl_cols)))
    filled = {f"{p}{c}": F.coalesce(F.col(f"{p}{c}"), F.col("_bat_mean")[c])
              for p in ("s_", "ns_") for c in bat_cols}
    filled.update({f"b_{c}": F.coalesce(F.col(f"b_{c}"), F.col("_bowl_mean")[c])
                   for c in bowl_cols})
    x = x.withColumns(filled).drop("_bat_mean", "_bowl_mean")
    feats = flatten_features(
        F.array(F.col("over").cast("double")),
        F.array(*[F.col(f"s_{c}") for c in bat_cols]),
        F.array(*[F.col(f"ns_{c}") for c in bat_cols]),
        F.array(*[F.col(f"b_{c}") for c in bowl_cols]))
    return x.withColumn("features", feats)


def labeled_features(df: DataFrame, label: str, features: str = "features") -> DataFrame:
    """(label, features vector) for MLlib (M6); the array column becomes a vector."""
    return df.select(F.col(label).cast("double").alias("label"),
                     array_to_vector(F.col(features)).alias("features"))


def fit_over_models(train: DataFrame, runs: str = "total_runs", wickets: str = "total_wickets",
                    features: str = "features", depth: int = TREE_DEPTH, bins: int = TREE_BINS
                    ) -> tuple[GrownTree, GrownTree]:
    """Regression trees of runs and of wickets per over (M7); variance impurity.

    Both are grown on all rows of ``train``, whatever its order (:func:`crease.operators.growing.grow_trees`).
    """
    r, w = grow_trees(train, [runs, wickets], features, depth, bins)
    return r, w


def held_out(match: str = "match_id", share: float = HELD_OUT) -> Column:
    """Whether a match is kept from the fit, by a hash of its key."""
    return unit_hash(F.lit("held out"), match) < share


def training_rows(labelled: DataFrame, rows: int | None = None, share: float = HELD_OUT) -> DataFrame:
    """All overs of matches that are not held out; with ``rows`` at most so many, those whose keys hash lowest.

    For these a count per slice of the hashes finds the slice that holds the last of them: all overs below
    it are taken where they lie, and only that slice is put in order, so no task meets
    the lowest ``rows`` of every partition.
    """
    x = labelled.where(~held_out(share=share))
    if rows is None:
        return x
    x = x.withColumn("_hash", unit_hash(F.lit("training"), *PLAN_KEYS))
    x = x.withColumn("_slice", F.floor(F.col("_hash") * TRAIN_SLICES))
    upto = F.sum("_n").over(Window.orderBy("_slice"))                # a row per slice at most
    last = (x.groupBy("_slice").agg(F.count("*").alias("_n")).withColumn("_upto", upto)
            .where(F.col("_upto") >= rows).orderBy("_slice").first())
    if last is not None:
        of = x.where(F.col("_slice") == last["_slice"]).orderBy("_hash", *PLAN_KEYS)
        x = x.where(F.col("_slice") < last["_slice"]).union(of.limit(rows - (last["_upto"] - last["_n"])))
    return x.drop("_hash", "_slice")


def tree_dump(model: GrownTree | DecisionTreeRegressionModel, path: str) -> DataFrame:
    """Nodes of a fitted tree, one row each (M7): id, prediction, rows of the fit that reached it,
    gain, children (-1 in a leaf), and for an inner node its feature and threshold.

    An MLlib model is saved under ``path`` (in the shared folder) and its node table read back.
    """
    if isinstance(model, GrownTree):
        return model.nodes().drop("level")
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    inner = F.col("leftChild") >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("id").alias("node"), "prediction", F.col("rawCount").alias("rows"), F.when(inner, F.col("gain")).alias("gain"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"))


def predict_overs(feats: DataFrame, runs_model: GrownTree, wickets_model: GrownTree) -> DataFrame:
    """Expected runs and wickets of every over (M8)."""
    return wickets_model.transform(runs_model.transform(feats, "features", "pred_runs"), "features", "pred_wickets")


def score_overs(pred: DataFrame) -> DataFrame:
    """Score of every match from predicted overs (M8 with F3, W3, A12).

    Each over: ``pred_runs`` and ``pred_wickets`` rounded half-even, then the runs
    after wickets (F3).  An innings ends when wickets reach 10 (that over's runs
    still count), after its 20 overs, or, for the chase, when its total passes the
    first innings.
    """
    x = pred.withColumns({"_runs0": F.bround("pred_runs", 0), "over_wickets": F.bround("pred_wickets", 0).cast("long")})
    x = x.withColumn("over_runs", wicket_discount("_runs0", "over_wickets").cast("long"))
    # an innings ends with over OVERS - 1 (numbered from 0), so plain windows hold few rows
    kept = innings_cutoff(x.where(F.col("over") < OVERS), order="over", runs="over_runs", wickets="over_wickets",
                          last=OVERS - 1, bounded=True)
    return scorecard(kept, runs="over_runs", wickets="over_wickets", unit="overs")

"""Trees grown on all rows, against MLlib's trees and plain Python."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from crease.operators import growing as G
from crease.operators import overs as OV

from conftest import SF001


def table(spark, n, seed=3):
    r = np.random.default_rng(seed)
    x = r.random((n, 5))
    x[:, 1] = np.floor(x[:, 1] * 20)
    x[:, 2] = np.where(x[:, 2] < 0.5, 0.0, np.round(x[:, 2], 2))       # one value for half of the rows
    x[:, 4] = 3.0
    y = np.floor(10 * x[:, 0] + x[:, 1] * (x[:, 2] > 0.7) + 2 * r.normal(size=n))
    w = (r.random(n) < 0.3).astype(float)
    rows = [(i, a.tolist(), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, w, strict=True))]
    return x, spark.createDataFrame(rows, "i int, features array<double>, y double, w double").repartition(3).localCheckpoint()


@pytest.mark.parametrize("local", [400, 100_000])
def test_grown_trees_are_those_of_mllib(spark, tmp_path, local):
    """Node for node, with the top grown from histograms and cells below, or all in one cell."""
    _, df = table(spark, 2500)
    for m, label in zip(G.grow_trees(df, ["y", "w"], "features", 30, 40, local_rows=local), "yw", strict=True):
        ml = DecisionTreeRegressor(impurity="variance", maxDepth=30, maxBins=40, seed=1, labelCol=label, featuresCol="v").fit(
            df.withColumn("v", array_to_vector("features")))
        got, want = OV.tree_dump(m, ""), OV.tree_dump(ml, str(tmp_path / label))
        assert got.dtypes == want.dtypes and sorted(got.collect(), key=lambda r: r.node) == sorted(want.collect(), key=lambda r: r.node)
        assert (m.numNodes, m.depth) == (ml.numNodes, ml.depth)
        model = {r.i: r.prediction for r in ml.transform(df.withColumn("v", array_to_vector("features"))).collect()}
        assert {r.i: r.p for r in m.transform(df, "features", "p").collect()} == model


def test_thresholds_come_from_all_rows(spark, monkeypatch):
    """MLlib takes them from 10,000 rows; here ranges of values are put in order by several tasks."""
    monkeypatch.setattr(G, "RANGE_VALUES", 3000)
    x, df = table(spark, 24_000)
    got = G.candidates(df, "features", 5, 40, len(x))
    for f in range(5):
        values, n = np.unique(x[:, f], return_counts=True)
        want, upto, target = [], n[0], len(x) / 40
        for i in range(1, len(values)):
            before, upto = upto, upto + n[i]
            if len(values) <= 40 or abs(before - target) < abs(upto - target):
                want.append((values[i - 1] + values[i]) / 2)
                target += len(x) / 40
        assert got[f].tolist() == want


def test_rows_without_features_go_right(spark):
    _, df = table(spark, 600)
    m, = G.grow_trees(df, ["y"], "features", 30, 40, local_rows=100)
    odd = spark.createDataFrame([(1, None), (2, [float("nan")] * 5), (3, [1e9] * 5)], "i int, features array<double>")
    got = {r.i: r.p for r in m.transform(odd, "features", "p").collect()}
    assert got[1] == got[2] == got[3] and m.transform(odd.limit(0), "features", "p").count() == 0
    with pytest.raises(ValueError, match="rows"):
        G.grow_trees(df.limit(0), ["y"], "features", 30, 40)


def test_one_row_and_equal_rows_are_one_leaf(spark):
    for rows in ([([1.0, 2.0], 3.0)], [([1.0, 2.0], 3.0), ([1.0, 2.0], 5.0)] * 200):
        m, = G.grow_trees(spark.createDataFrame(rows, "features array<double>, y double"), ["y"], "features", 30, 40, local_rows=10)
        node, = m.nodes().collect()
        assert (node.node, node.left, node.rows, m.numNodes, m.depth) == (0, -1, len(rows), 1, 0)
        assert node.prediction == sum(y for _, y in rows) / len(rows)


def test_no_over_is_left_out_of_the_fit(spark):
    """All overs of the matches that are not held out, beyond 100,000 too."""
    x = spark.range(130_000).selectExpr("id AS match_id", "1 AS innings", "0 AS over")
    assert OV.training_rows(x).count() == x.where(~OV.held_out()).count() > 100_000


def test_fitted_trees_have_seen_every_over(spark):
    from crease.plans import catalog as C
    from crease.plans import standins as V
    overs = C._labelled(V.Tables(spark, SF001)).where("not held_out").count()
    roots = C.QUERIES["tree_dump"](spark, SF001).where("node = 0").select("model", "rows").collect()
    assert {(r.model, r.rows) for r in roots} == {("runs", overs), ("wickets", overs)}
    assert C.QUERIES["tree_checks"](spark, SF001).first()[1:] == (0, 0)
    leaves = C.QUERIES["tree_dump"](spark, SF001).where("left < 0").groupBy("model").agg(F.sum("rows").alias("n")).collect()
    assert {r.n for r in leaves} == {overs}


def test_scores_are_of_the_walked_trees(spark):
    """Scoring needs keys and features only; overs meet their cell's nodes, or walk the node tables: the same scores."""
    from crease.plans import catalog as C
    from crease.plans import standins as V
    got = C.QUERIES["score_fitted"](spark, SF001)
    want = OV.score_overs(C._walked(V.Tables(spark, SF001)).select(*OV.PLAN_KEYS, "pred_runs", "pred_wickets")).withColumn("held_out", OV.held_out())
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())

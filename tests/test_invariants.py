"""Invariants on the stand-in tables (random or iterative operators have no SQL oracle)."""

import numpy as np
import re

import pytest
from pyspark.sql import functions as F

from crease.operators import clusters as CL
from crease.operators import innings as IN
from crease.operators import matchups as M
from crease.operators import overs as OV
from crease.plans import catalog as C
from crease.plans import standins as V

from conftest import SF001, SF01


def test_odds_ascending_and_bounded(spark):
    p = C._probs(V.Tables(spark, SF01), 9)
    cums = [F.col(c) for c in ["c0", "c1", "c2", "c3", "c4", "c6"]]
    bad = p.filter(~((cums[0] > 0) & (cums[0] < cums[1]) & (cums[1] < cums[2]) & (cums[2] < cums[3])
                     & (cums[3] < cums[4]) & (cums[4] < cums[5]) & (cums[5] <= 1)
                     & (F.col("survive") > 0) & (F.col("survive") < 1)))
    assert p.count() > 0 and bad.count() == 0


def test_single_aggregate_equals_join_form(spark):
    b = V.ball_events(V.Tables(spark, SF001))
    a, j = M.matchup_counts(b), M.multiway_join(b)
    assert a.exceptAll(j.select(*a.columns)).count() == 0 and a.count() == j.count()


def test_assignment_is_nearest_centre(spark):
    t = V.Tables(spark, SF001)
    cen = C._centres(t)
    got = {r.vec_id: (r.cluster, r.distance) for r in
           CL.assign_clusters(t.embeddings, cen, vec="embedding", keep=["vec_id"]).collect()}
    centres = sorted((r.cluster, np.array(r.center, dtype=np.float64)) for r in cen.collect())
    for r in t.embeddings.collect():
        x = np.array(r.embedding, dtype=np.float64)
        d = [float(((x - c) ** 2).sum()) for _, c in centres]
        k = int(np.argmin(d))
        assert got[r.vec_id][0] == centres[k][0]
        assert got[r.vec_id][1] == pytest.approx(d[k], rel=1e-9)


def test_fitted_clusters_cover_every_player_once(spark):
    t = V.Tables(spark, SF001)
    pts = C._bat_points(t)
    centres = CL.centres_table(CL.fit_clusters(pts, 4, seed=1))
    a = CL.assign_clusters(pts, centres, keep=["Player"])
    assert a.count() == pts.count() == a.select("Player").distinct().count()
    assert {r.cluster for r in a.collect()} <= {0, 1, 2, 3}


def test_elbow_curve_shape(spark):
    pts = C._bat_points(V.Tables(spark, SF01))
    curve = {r.k: r.cost for r in CL.elbow_curve(pts, range(2, 6), 0.5).collect()}
    assert sorted(curve) == [2, 3, 4, 5] and all(v > 0 for v in curve.values())
    assert len(set(curve.values())) == 4 and curve[5] < curve[2]
    with pytest.raises(ValueError, match="fewer than k"):
        CL.elbow_curve(pts, [5], 0.001)


def test_fit_does_not_depend_on_the_shuffle_setting(spark):
    pts = C._bat_points(V.Tables(spark, SF01))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("8", "31"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append([list(c) for c in CL.fit_clusters(pts, 4).clusterCenters()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_trees_predict_inside_label_range_and_scores_repeat(spark):
    t = V.Tables(spark, SF001)
    pred = C._predicted(t).persist()
    lab = C._cut(t)
    tot = C.IN.over_totals(lab).agg(F.min("total_runs"), F.max("total_runs"),
                                    F.min("total_wickets"), F.max("total_wickets")).first()
    pr = pred.agg(F.min("pred_runs"), F.max("pred_runs"), F.min("pred_wickets"), F.max("pred_wickets")).first()
    assert tot[0] <= pr[0] and pr[1] <= tot[1] and tot[2] <= pr[2] and pr[3] <= tot[3]
    scores = OV.score_overs(pred)
    assert scores.exceptAll(OV.score_overs(pred)).count() == 0
    assert all(0 <= r.wickets_1 <= 10 and 0 <= r.wickets_2 <= 10 and r.overs_1 <= 20 for r in scores.collect())
    pred.unpersist()


def test_training_rows_are_bounded_and_hold_matches_out(spark):
    x = spark.range(2000).selectExpr("id % 500 AS match_id", "1 AS innings", "CAST(id / 500 AS INT) AS over")
    got = OV.training_rows(x, rows=100)
    assert got.count() == 100 and got.where(OV.held_out()).count() == 0
    share = x.where(OV.held_out()).select("match_id").distinct().count() / 500
    assert 0.1 < share < 0.3 and OV.training_rows(x).count() == x.where(~OV.held_out()).count()


def test_training_rows_are_those_whose_keys_hash_lowest(spark):
    x = spark.range(3000).selectExpr("id % 500 AS match_id", "1 AS innings", "CAST(id / 500 AS INT) AS over", "id")
    h = C.OV.unit_hash(F.lit("training"), *OV.PLAN_KEYS)
    order = [r.id for r in x.where(~OV.held_out()).orderBy(h, *OV.PLAN_KEYS).collect()]
    for n in (1, 700, len(order) - 1, len(order), len(order) + 1):
        assert sorted(r.id for r in OV.training_rows(x, rows=n).collect()) == sorted(order[:n])
    assert OV.training_rows(x.limit(0), rows=5).count() == 0
    none = x.withColumns({k: F.lit(None).cast("int") for k in OV.PLAN_KEYS})       # one key for all: any of them
    assert OV.training_rows(none, rows=5).count() in (0, 5)


def test_training_rows_meet_in_one_slice_only(spark):
    """No task orders the lowest ``rows`` of every partition: only the rows of the last slice are put in order."""
    x = spark.range(4000).selectExpr("id AS match_id", "1 AS innings", "0 AS over")
    got = OV.training_rows(x.repartition(8), rows=1000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    limits = [int(n) for n in re.findall(r"GlobalLimit (\d+)", plan)]
    assert got.count() == 1000 and max(limits, default=0) <= 5


def test_model_queries_order_the_events_once(spark, tmp_path, monkeypatch):
    """The ball log is written once; the cut, the falls and the balls read that."""
    from crease import session
    written = []
    monkeypatch.setattr(session, "materialize", lambda df, name, f=session.materialize: (written.append(name), f(df, name))[1])
    rows = C._strikes_written(V.Tables(spark, SF001))
    assert written == ["ball-log", "strikes"]
    assert rows.exceptAll(C._strikes_cut(V.Tables(spark, SF001)).select(*rows.columns)).count() == 0


def test_all_matches_are_scored(spark):
    rows = C.QUERIES["score_predicted"](spark, SF001).collect()
    matches = C._predicted(V.Tables(spark, SF001)).select("match_id", OV.held_out().alias("h")).distinct().collect()
    assert {(r.match_id, r.held_out) for r in rows} == {(r.match_id, r.h) for r in matches}
    assert len(rows) == len(matches) > sum(r.held_out for r in rows) > 0


def test_tree_dump_holds_the_tree(spark):
    rows = C.QUERIES["tree_dump"](spark, SF001).collect()
    _, rm, wm = C._fitted(V.Tables(spark, SF001))
    assert len(rows) == rm.numNodes + wm.numNodes
    assert all((r.left < 0) == (r.feature is None) for r in rows)


def test_empty_inputs(spark):
    e = spark.createDataFrame([], "batsman string, bowler string, runs int, wicket boolean")
    assert M.matchup_probs(M.matchup_counts(e)).count() == 0
    pri = M.global_priors(M.matchup_probs(M.matchup_counts(e))).first()
    assert pri.c0 is None and pri.survive is None


def test_sample_independent_of_partitioning(spark):
    b = V.Tables(spark, SF001).customer
    key = ["c_custkey"]
    a = CL.sample_rows(b.repartition(3), 0.25, 1, key)
    c = CL.sample_rows(b.repartition(7, "c_nationkey").sortWithinPartitions("c_name"), 0.25, 1, key)
    assert a.count() > 0 and a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
    assert CL.sample_rows(b, 0.25, 2, key).exceptAll(a).count() > 0


def test_csv_columns_follow_the_header(spark, tmp_path):
    from crease.sources import files as FS
    (tmp_path / "a.csv").write_text("Runs,Player,Inns\n10,7,3\n")
    r = FS.csv_scan(spark, str(tmp_path / "a.csv"), "Player string, Runs int, Inns int").first()
    assert (r.Player, r.Runs, r.Inns) == ("7", 10, 3)
    with pytest.raises(ValueError, match="lacks"):
        FS.csv_scan(spark, str(tmp_path / "a.csv"), "Player string, HS int")


def test_csv_malformed_cell_stops_a_narrow_read(spark, tmp_path):
    from crease.sources import files as FS
    (tmp_path / "b.csv").write_text("Player,Runs\nx,ten\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        FS.csv_scan(spark, str(tmp_path / "b.csv"), "Player string, Runs int").select("Player").collect()


def test_innings_ends_after_twenty_overs(spark):
    from crease.operators import innings as IN
    log = spark.range(1, 151).selectExpr("1 AS match_id", "1 AS innings", "id AS ball_no", "1 AS runs", "false AS wicket")
    kept = IN.innings_cutoff(log)
    assert kept.count() == 120 and kept.agg({"ball_no": "max"}).first()[0] == 120


def test_null_feature_raises_and_is_listed(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "Player string, x double")
    assert [r.Player for r in CL.invalid_rows(df, ["x"], ["Player"]).collect()] == ["b"]
    with pytest.raises(Exception):
        CL.assemble_features(df, ["x"]).collect()
    assert CL.assemble_features(df, ["x"], handle_invalid="skip").count() == 1


def _random_log(spark, null_match=True):
    import random
    r = random.Random(4)
    rows = []
    for m in [None, *range(9)] if null_match else range(9):
        for inn in (1, 2):
            n = 400 if m == 3 else r.choice([0, 1, 6, 50, 119, 121, 150])       # some go on after their 120 balls
            rows += [(m, inn, b, r.choice([0, 1, 2, 3, 4, 6]), r.choice([False] * 11 + [True, None])) for b in range(1, n + 1)]
    r.shuffle(rows)
    log = spark.createDataFrame(rows, "match_id int, innings int, ball_no long, runs int, wicket boolean")
    order = [(m, inn, [100 * m + 20 * inn + k for k in range(11)]) for m in range(8) for inn in (1, 2)]      # match 8 has no line-up
    return log, spark.createDataFrame(order, "match_id int, innings int, batting array<int>")


def test_bounded_strikes_equal_those_in_chunks(spark):
    log, lineups = _random_log(spark)
    want = IN.strike_reconstruct(log, lineups, cut=True).collect()
    got = IN.strike_reconstruct(log, lineups, cut=True, bounded=True)
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(got.collect(), key=key) == sorted(want, key=key) and len(want) > 200 and got.columns == log.columns + ["striker", "non_striker"]
    with pytest.raises(ValueError):
        IN.strike_reconstruct(log, lineups, bounded=True)


def test_bounded_passes_compute_their_rows_once(spark):
    """A target by a join, and falls by another, computed the rows (predictions, ordered events) again for each."""
    seen = spark.sparkContext.accumulator(0)

    def met(x):
        seen.add(1)
        return x

    log, lineups = _random_log(spark, null_match=False)
    log = log.cache()
    watched = log.withColumn("runs", F.udf(met, "int")("runs"))
    IN.strike_reconstruct(watched, lineups, cut=True, bounded=True).collect()
    assert seen.value == log.where("ball_no <= 120").count()
    seen.value = 0
    overs = log.where("ball_no <= 20").select("match_id", "innings", (F.col("ball_no") - 1).cast("int").alias("over"), "runs")
    pred = overs.withColumns({"pred_runs": F.udf(met, "int")("runs").cast("double"), "pred_wickets": F.lit(0.4)})
    OV.score_overs(pred.drop("runs")).collect()
    assert seen.value == overs.count()


def test_a_null_match_has_no_target_in_bounded_form(spark):
    rows = [(m, inn, o, 10, 0) for m in (None, 1) for inn in (1, 2) for o in range(4)]
    df = spark.createDataFrame(rows, "match_id int, innings int, over int, r int, w int")
    kept = IN.innings_cutoff(df, order="over", runs="r", wickets="w", bounded=True)
    assert {(x.match_id, x.innings): x["count"] for x in kept.groupBy("match_id", "innings").count().collect()} == {(None, 1): 4, (None, 2): 1, (1, 1): 4, (1, 2): 4}


def test_profiles_join_the_balls_once(spark, monkeypatch, tmp_path):
    suppliers = spark.createDataFrame([(i, 0, float(i - 2)) for i in range(6)], "s_suppkey long, s_nationkey int, s_acctbal double")
    suppliers.write.parquet(str(tmp_path / "supplier.parquet"))
    rows = [(i % 7, i % 6, f"Brand#{i % 3 + 1}", i % 5, i % 4 == 0, False) for i in range(90)] + [(None, 3, "Brand#2", 1, False, True), (1, None, None, 2, None, None)]
    balls = spark.createDataFrame(rows, "match_id long, batsman long, bowler string, runs_by_batsman int, wicket boolean, same_player_out boolean")
    calls = []
    monkeypatch.setattr(V, "balls", lambda t: calls.append(t) or balls)
    t = V.Tables(spark, str(tmp_path))
    bat, bowl = C._profiles_written(t)
    assert len(calls) == 1 and bat.count() == 4
    for got, want in ((bat, C._bat_prof(t)), (bowl, C._bowl_prof(t))):
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

"""Hand-made fixtures for each rule of the reference that had to be decided."""

import random

import pytest
from pyspark.sql import functions as F

from crease.functions import outcome_pick, wicket_discount
from crease.operators import careers as CR
from crease.operators import innings as IN
from crease.operators import matchups as M
from crease.operators import outcomes as OC
from crease.operators import overs as OV

PAIR_SCHEMA = "batsman string, bowler string, runs int, wicket boolean"


def test_counts_fives_nulls_and_null_keys(spark):
    rows = [("a", "x", 5, False), ("a", "x", 0, False), ("a", "x", None, True),
            ("a", "x", 6, False), (None, "x", 1, False)]
    c = M.matchup_counts(spark.createDataFrame(rows, PAIR_SCHEMA)).collect()
    assert len(c) == 1
    r = c[0]
    assert (r.n0, r.n1, r.n6, r.w, r.balls) == (1, 0, 1, 1, 3)   # the 5 counts as a ball
    assert M.multiway_join(spark.createDataFrame(rows, PAIR_SCHEMA)).collect()[0] == r


def test_threshold_is_strict(spark):
    rows = [("a", "x", 0, False)] * 9 + [("b", "x", 0, False)] * 10
    p = M.matchup_probs(M.matchup_counts(spark.createDataFrame(rows, PAIR_SCHEMA)), 9)
    assert [r.batsman for r in p.collect()] == ["b"]


def test_probabilities_smoothed_and_cumulative(spark):
    rows = [("b", "x", 1, False)] * 4 + [("b", "x", 4, True)] * 6
    r = M.matchup_probs(M.matchup_counts(spark.createDataFrame(rows, PAIR_SCHEMA)), 9).first()
    assert r.c0 == pytest.approx(1 / 16)
    assert r.c1 == pytest.approx(6 / 16)
    assert r.c4 == pytest.approx(1 / 16 + 5 / 16 + 1 / 16 + 1 / 16 + 7 / 16)
    assert r.c6 == pytest.approx(r.c4 + 1 / 16)
    assert r.survive == pytest.approx(1 - 7 / 11)


@pytest.mark.parametrize("u,runs", [(0.0, 0), (0.1, 0), (0.10001, 1), (0.55, 3),
                                    (0.85, 6), (0.95, 0), (1.0, 0)])
def test_outcome_pick_strict_and_wrap(spark, u, runs):
    cums = [0.1, 0.3, 0.4, 0.6, 0.8, 0.9]   # u equal to a value does not pass it
    df = spark.createDataFrame([tuple(cums) + (u,)], "c0 double, c1 double, c2 double, "
                                                     "c3 double, c4 double, c6 double, u double")
    got = df.select(outcome_pick([F.col(c) for c in ["c0", "c1", "c2", "c3", "c4", "c6"]], "u")).first()[0]
    assert got == runs


@pytest.mark.parametrize("runs,w,out", [(3, 3, 2.0), (15, 5, 2.0), (9, 1, 8.0), (7, 0, 7.0),
                                        (6, 6, 0.0), (9, 3, 4.0), (1, 3, 0.0), (5, 3, 2.0)])
def test_wicket_discount_half_even(spark, runs, w, out):
    df = spark.createDataFrame([(runs, w)], "r long, w long")
    assert df.select(wicket_discount("r", "w")).first()[0] == out


def test_batting_career_rules(spark):
    seasons = spark.createDataFrame([
        ("p", 2000, 2, 10, 8, 5.0, 0, None),       # BF = 0: the ratio is NULL, skipped
        ("p", 1999, 3, 30, 20, 10.0, 15, 200.0),
        ("p", 2001, 9, 99, 99, 11.0, 9, 100.0),     # hold-out season
        ("p", None, 9, 99, 99, 11.0, 9, 100.0),     # NULL year drops out too
        ("q", 2000, 1, 0, 0, 0.0, 0, None)],
        "Player string, Year int, Inns long, Runs long, HS long, Ave double, BF long, SR double")
    debuts = spark.createDataFrame([("p", 1, 6, 6, 6.0, 3, 200.0)],
                                   "Player string, Inns long, Runs long, HS long, Ave double, BF long, SR double")
    got = {r.Player: r for r in CR.batting_career(seasons, debuts, 2001).collect()}
    p, q = got["p"], got["q"]
    assert p.Inns == 6 and p.HS == 20 and p.BF == 18
    assert p.Runs == pytest.approx(30 / 15 + 6 / 3)        # sum of per-season Runs/BF
    assert p.Ave == pytest.approx((5 + 10 + 6) / 3)
    assert p.SR == pytest.approx(200.0)                     # mean skips NULL
    assert q.Runs == 0.0 and q.SR is None


def test_bowling_career_zero_innings(spark):
    seasons = spark.createDataFrame([("p", 2000, 0, 0, 0, None, None, None)],
                                    "Player string, Year int, Inns long, Runs long, Wkts long, "
                                    "Ave double, Econ double, SR double")
    debuts = spark.createDataFrame([("p", 2, 40, 4, 10.0, 8.0, 6.0)],
                                   "Player string, Inns long, Runs long, Wkts long, Ave double, "
                                   "Econ double, SR double")
    r = CR.bowling_career(seasons, debuts, 2018).first()
    assert r.Runs == pytest.approx(20.0) and r.Wkts == pytest.approx(2.0) and r.Inns == 2


def _probs_fixture(spark):
    rows = []
    # pairs with more than 9 balls: (a1,x1) (a2,x1) (a1,x2)
    for b, w, n in [("a1", "x1", 10), ("a2", "x1", 12), ("a1", "x2", 14), ("z", "x1", 11)]:
        rows += [(b, w, (i * 3) % 7 if (i * 3) % 7 != 5 else 0, i % 5 == 0) for i in range(n)]
    return M.matchup_probs(M.matchup_counts(spark.createDataFrame(rows, PAIR_SCHEMA)), 9)


def test_batch_outcomes_tiers_and_pool_mean(spark):
    probs = _probs_fixture(spark)
    bat_cl = spark.createDataFrame([("a1", 0), ("a2", 0), ("a3", 0), ("a4", 1)], "Player string, Cluster int")
    bowl_cl = spark.createDataFrame([("x1", 0), ("x2", 0), ("x3", 1)], "Player string, Cluster int")
    req = spark.createDataFrame([
        (1, "a1", "x1", 0.5),   # pair
        (2, "a3", "x1", 0.5),   # cluster: a1,a2 v x1
        (3, "a1", "x3", 0.5),   # cluster: a1 v nobody in x3's cluster, a-cluster v x3: none -> empty pool
        (4, "zz", "x1", 0.5),   # unknown batsman
        (5, "a3", "x1", 0.5)],  # duplicate request kept
        "request_id int, batsman string, bowler string, u double")
    out = {r.request_id: r for r in OC.batch_outcomes(req, probs, bat_cl, bowl_cl).collect()}
    assert len(out) == 5
    assert [out[i].tier for i in range(1, 6)] == ["pair", "cluster", "prior", "prior", "cluster"]
    p = {(r.batsman, r.bowler): r for r in probs.collect()}
    pool = [p[("a1", "x1")], p[("a2", "x1")]]          # direct union-all form
    assert out[2].survive == pytest.approx(sum(r.survive for r in pool) / 2)
    pri = M.global_priors(probs).first()
    assert out[3].survive == pytest.approx(pri.survive)
    assert out[1].survive == pytest.approx(p[("a1", "x1")].survive)


def test_cluster_pool_equals_union_all(spark):
    probs = _probs_fixture(spark)
    bat_cl = spark.createDataFrame([("a1", 0), ("a2", 0), ("a3", 0)], "Player string, Cluster int")
    bowl_cl = spark.createDataFrame([("x1", 0), ("x2", 0)], "Player string, Cluster int")
    req = spark.createDataFrame([("a1", "x1", 0.1), ("a3", "x2", 0.2)], "batsman string, bowler string, u double")
    got = {(r.batsman, r.bowler): r for r in OC.cluster_pool(req, probs, bat_cl, bowl_cl).collect()}
    p = {(r.batsman, r.bowler): r for r in probs.collect()}
    members_a = {"a1", "a2", "a3"}
    members_w = {"x1", "x2"}
    for (b, w), r in got.items():
        pool = [p[(b2, w)] for b2 in members_a if (b2, w) in p] + [p[(b, w2)] for w2 in members_w if (b, w2) in p]
        assert r.pool_n == len(pool)
        assert r.pool_c2 == pytest.approx(sum(x.c2 for x in pool) / len(pool))


def _simulate(balls, order):
    """Ball-by-ball loop of the crease rules, the way the reference walks an innings."""
    slots, strike, w, out = [order[0], order[1]], 0, 0, []
    for i, (r, wk) in enumerate(balls):
        out.append((slots[strike], slots[1 - strike]))
        if wk:
            w += 1
            slots[strike] = order[w + 1] if w + 1 < len(order) else None
        elif r % 2 == 1:
            strike = 1 - strike
        if (i + 1) % 6 == 0:
            strike = 1 - strike
    return out


def test_strike_reconstruct_matches_loop(spark):
    rnd = random.Random(3)
    order = [f"p{i}" for i in range(1, 12)]
    rows, expect = [], {}
    for m in range(40):
        for inn in (1, 2):
            balls = []
            for _ in range(rnd.randint(5, 130)):
                wk = rnd.random() < 0.08
                balls.append((0 if wk else rnd.choice([0, 1, 2, 3, 4, 6]), wk))
                if sum(b[1] for b in balls) >= 10:
                    break
            for i, ((r, wk), (s, ns)) in enumerate(zip(balls, _simulate(balls, order))):
                rows.append((m, inn, i + 1, r, wk))
                expect[(m, inn, i + 1)] = (s, ns)
    log = spark.createDataFrame(rows, "match_id long, innings int, ball_no long, runs int, wicket boolean")
    lu = spark.createDataFrame([(m, inn, order) for m in range(40) for inn in (1, 2)],
                               "match_id long, innings int, batting array<string>")
    got = {(r.match_id, r.innings, r.ball_no): (r.striker, r.non_striker)
           for r in IN.strike_reconstruct(log, lu).collect()}
    assert got == expect


def test_innings_cutoff_tenth_wicket_and_chase(spark):
    inn1 = [(1, 1, i, 1, False) for i in range(1, 5)]                  # 4 runs
    inn1 += [(1, 1, 4 + i, 0, True) for i in range(1, 11)]            # 10 wickets
    inn1 += [(1, 1, 15, 6, False)]                                     # after all out: dropped
    inn2 = [(1, 2, 1, 4, False), (1, 2, 2, 1, False), (1, 2, 3, 6, False)]  # passes 4 on ball 2
    tie = [(2, 1, 1, 2, False), (2, 2, 1, 2, False)]
    log = spark.createDataFrame(inn1 + inn2 + tie,
                                "match_id long, innings int, ball_no long, runs int, wicket boolean")
    kept = IN.innings_cutoff(log)
    keys = {(r.match_id, r.innings, r.ball_no) for r in kept.collect()}
    assert (1, 1, 14) in keys and (1, 1, 15) not in keys
    assert (1, 2, 2) in keys and (1, 2, 3) not in keys
    card = {r.match_id: r for r in IN.scorecard(kept).collect()}
    assert (card[1].runs_1, card[1].wickets_1, card[1].runs_2, card[1].winner) == (4, 10, 5, "Team 2")
    assert card[2].winner == "Team 1"   # a tie goes to team 1


def test_dismissal_points_brute_force(spark):
    rnd = random.Random(5)
    rows = [(m, 1, b, i, 0.6 + 0.4 * rnd.random()) for m in range(5) for b in (0, 1) for i in range(1, 30)]
    log = spark.createDataFrame(rows, "match_id long, innings int, batsman int, ball_no long, p_survive double")
    got = {(r.match_id, r.batsman): r.out_ball for r in IN.dismissal_points(log).collect()}
    exp = {}
    for m in range(5):
        for b in (0, 1):
            prod = 1.0
            for (mm, _, bb, i, p) in rows:
                if (mm, bb) == (m, b):
                    prod *= p
                    if prod <= 0.3:
                        exp[(m, b)] = i
                        break
    assert got == exp


def test_bowling_schedule_wraps(spark):
    from crease.sources.files import lineup_table
    lu = lineup_table(spark, [(1, 1, ["a"] * 11, ["x", "y", "z"])])
    got = [r.bowler for r in OV.bowling_schedule(lu).orderBy("over").collect()]
    assert got == ["x", "y", "z"] * 6 + ["x", "y"]


def test_profile_zero_denominators(spark):
    rows = [("a", "x", 4, False, 1), ("a", "x", 6, False, 2)]
    df = spark.createDataFrame(rows, "batsman string, bowler string, runs int, wicket boolean, match_id int")
    bp = CR.batting_profile(df).first()
    assert bp.innings_per_dismissal == 0.0 and bp.runs_per_innings == 5.0
    assert bp.sixes_per_ball == 0.5 and bp.strike_rate == 500.0
    wp = CR.bowling_profile(df).first()
    assert wp.runs_per_wicket == 0.0 and wp.economy == 30.0


def test_csv_scan_null_and_failfast(spark, tmp_path):
    from crease.sources.files import csv_scan
    good = tmp_path / "good.csv"
    good.write_text("Player,Runs,Ave\r\nA,10,-\r\nB,-,2.5\r\n")
    rows = csv_scan(spark, str(good), "Player string, Runs int, Ave double").collect()
    assert [tuple(r) for r in rows] == [("A", 10, None), ("B", None, 2.5)]
    bad = tmp_path / "bad.csv"
    bad.write_text("Player,Runs,Ave\nA,ten,1.0\n")
    with pytest.raises(Exception):
        csv_scan(spark, str(bad), "Player string, Runs int, Ave double").collect()


def test_page_rows_two_rows_per_player(spark):
    from crease.sources.pages import link_rows, pair_rows, url_catalog
    html = ('<ul><li><a href="/p/1">65*</a></li><li><a href="/t/1">(CSK)</a></li>'
            '<li><a href="/p/2">12.5</a></li><li><a href="/t/2">(SRH)</a></li>'
            '<li class="x"><a id="y" href="/p/3" rel="z">7</a></li></ul>')
    pages = spark.createDataFrame([(1, "http://stats.example.org/en/2016/averages\n", html)],
                                  "page_id long, url string, html string")
    rows = link_rows(pages)
    assert [(r.pos, r.href, r.text) for r in rows.orderBy("pos").collect()][:2] == \
        [(0, "/p/1", "65*"), (1, "/t/1", "(CSK)")]
    cat = url_catalog(pages).first()
    assert (cat.host, cat.lang, cat.season, cat.url.endswith("averages")) == \
        ("stats.example.org", "en", 2016, True)
    got = [tuple(r) for r in pair_rows(pages).orderBy("pair").collect()]
    assert got == [(1, 0, "65*", None, "CSK", 2016), (1, 1, "12.5", 12.5, "SRH", 2016),
                   (1, 2, "7", 7.0, None, 2016)]      # a stat row without its team row is kept


def test_csv_quoted_cells_and_append(spark, tmp_path):
    from crease.sources.files import csv_append, csv_scan
    src = tmp_path / "quoted.csv"
    src.write_text('"Player Name","Runs/Wickets","Economy"\n"A Ashish","22","9.2"\n"B, C","-","6.5"\n')
    schema = "player_name string, runs_per_wicket double, economy double"
    names = {"player_name": "Player Name", "runs_per_wicket": "Runs/Wickets", "economy": "Economy"}
    rows = csv_scan(spark, str(src), schema, names).collect()
    assert [tuple(r) for r in rows] == [("A Ashish", 22.0, 9.2), ("B, C", None, 6.5)]
    out = str(tmp_path / "out")
    df = csv_scan(spark, str(src), schema, names)
    csv_append(df, out)
    csv_append(df, out)
    assert csv_scan(spark, out, schema).count() == 4     # each file keeps its own header line


def test_fused_cut_equals_cut_then_strike(spark):
    rnd = random.Random(11)
    rows = []
    for m in range(30):
        for inn in (1, 2):
            for i in range(1, rnd.randint(20, 140)):        # runs on past all-out and past the chase
                wk = rnd.random() < 0.12
                rows.append((m, inn, i, 0 if wk else rnd.choice([0, 1, 2, 3, 4, 6]), wk))
    log = spark.createDataFrame(rows, "match_id long, innings int, ball_no long, runs int, wicket boolean")
    lu = spark.createDataFrame([(m, inn, [f"p{i}" for i in range(11)]) for m in range(30) for inn in (1, 2)],
                               "match_id long, innings int, batting array<string>")
    fused = IN.strike_reconstruct(log, lu, cut=True)
    two_step = IN.strike_reconstruct(IN.innings_cutoff(log), lu)
    a, b = {tuple(r) for r in fused.collect()}, {tuple(r) for r in two_step.collect()}
    assert a == b and len(a) < len(rows)


def test_url_list_file(spark, tmp_path):
    from crease.sources.pages import read_url_list, url_catalog
    f = tmp_path / "urls.txt"
    f.write_text("http://stats.example.org/league-2018/averages/bowling.html?id=1\r\n"
                 "http://stats.example.org/league-2017/averages/bowling.html?id=2\n\n")
    cat = url_catalog(read_url_list(spark, str(f)))
    got = sorted((r.url[-4:], r.host, r.season) for r in cat.collect())
    assert got == [("id=1", "stats.example.org", 2018), ("id=2", "stats.example.org", 2017)]


def test_unit_hash_range_and_spread(spark):
    from crease.functions import unit_hash
    df = spark.range(20000).select(unit_hash(F.lit(20), "id").alias("x"))
    r = df.agg(F.min("x"), F.max("x"), F.avg("x"), F.count_if(F.col("x") < 0.5).alias("low")).first()
    assert 0 <= r[0] and r[1] < 1
    assert abs(r[2] - 0.5) < 0.01 and abs(r["low"] / 20000 - 0.5) < 0.02
    again = spark.range(20000).select(unit_hash(F.lit(20), "id").alias("x"))
    assert df.exceptAll(again).count() == 0                      # the same number every time


def test_table_page(spark):
    from crease.sources.pages import header_cells, html_rows, name_cells, table_pairs
    html = ("<table><tr><th>Player</th><th>Runs</th></tr>\n<tr class='a'><td><b>A One</b></td><td> 65 </td></tr>"
            "<TR><td colspan=2>(CSK)</td></TR><tr><td>B Two</td><td>7</td></tr></table>")
    pages = spark.createDataFrame([(1, "http://x.org/2016/averages", html), (2, "http://x.org/none", None)],
                                  "page_id long, url string, html string")
    rows = html_rows(pages).orderBy("pos")
    assert [(r.page_id, r.pos, r.cells) for r in rows.collect()] == [
        (1, 0, ["A One", "65"]), (1, 1, ["(CSK)"]), (1, 2, ["B Two", "7"])]
    assert header_cells(pages).where("page_id = 1").first().header == ["Player", "Runs"]
    assert tuple(name_cells(rows, ["Player", "Runs"]).where("pos = 1").first()) == (1, 1, "(CSK)", None)
    pairs = table_pairs(pages, ["Player", "Runs"])
    assert [tuple(r) for r in pairs.orderBy("pair").collect()] == [
        (1, 0, "A One", "65", "CSK", 2016), (1, 1, "B Two", "7", None, 2016)]
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_csv_overwrite_replaces(spark, tmp_path):
    from crease.sources.files import csv_overwrite, csv_scan
    out = str(tmp_path / "o")
    csv_overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), out)
    csv_overwrite(spark.createDataFrame([(3, "c")], "k int, v string"), out)
    assert [tuple(r) for r in csv_scan(spark, out, "k int, v string").collect()] == [(3, "c")]


def test_holdout_only_player_has_no_career(spark):
    seasons = spark.createDataFrame([("h", 2001, 3, 30, 20, 10.0, 15, 200.0),
                                     ("k", 2000, 1, 5, 5, 5.0, 5, 100.0)],
                                    "Player string, Year int, Inns long, Runs long, HS long, Ave double, BF long, SR double")
    debuts = spark.createDataFrame([], "Player string, Inns long, Runs long, HS long, Ave double, BF long, SR double")
    assert [r.Player for r in CR.batting_career(seasons, debuts, 2001).collect()] == ["k"]


def test_bounded_cutoff_equals_chunked(spark):
    rnd = random.Random(23)
    rows = [(m, inn, o, rnd.randint(0, 14), rnd.choice([0, 0, 1, 2, 4]))
            for m in range(40) for inn in (1, 2) for o in range(20)]
    df = spark.createDataFrame(rows, "match_id long, innings int, over int, r int, w int")
    a = IN.innings_cutoff(df, order="over", runs="r", wickets="w", bounded=True)
    b = IN.innings_cutoff(df, order="over", runs="r", wickets="w", chunk=F.lit(0))
    assert {tuple(x) for x in a.collect()} == {tuple(x) for x in b.collect()}
    assert a.count() < len(rows)


def test_bowling_columns_matched_by_name(spark):
    # debutant columns in another order than the season table: matched by name (Q6)
    seasons = spark.createDataFrame([("p", 2000, 2, 40, 4, 10.0, 6.0, 12.0)],
                                    "Player string, Year int, Inns long, Runs long, Wkts long, "
                                    "Ave double, Econ double, SR double")
    debuts = spark.createDataFrame([(9.0, 2, 8.0, 20, 1, "p", 7.0)],
                                   "SR double, Wkts long, Econ double, Runs long, Inns long, Player string, "
                                   "Ave double")
    r = CR.bowling_career(seasons, debuts, 2018).first()
    assert r.Inns == 3 and r.Runs == pytest.approx(20 + 20) and r.Wkts == pytest.approx(2 + 2)
    assert r.Econ == pytest.approx(7.0) and r.SR == pytest.approx(10.5) and r.Ave == pytest.approx(8.5)


def test_rows_per_pair_counts_every_row(spark):
    rows = [("a", "x", 0, False), ("a", "x", None, False), ("a", "x", 4, True)]
    r = M.pair_rows_count(spark.createDataFrame(rows, PAIR_SCHEMA)).first()
    assert r.rows == 3                                   # Q7: all rows, not the zeros


def test_survival_prior_not_clamped(spark):
    rows = [("a", "x", 1, False)] * 40 + [("b", "x", 2, False)] * 40
    pri = M.global_priors(M.matchup_probs(M.matchup_counts(spark.createDataFrame(rows, PAIR_SCHEMA)))).first()
    assert pri.survive == pytest.approx((1 - 1 / 41) * 1.05) and pri.survive > 1


def test_optional_feature_scaling(spark):
    import statistics
    from crease.operators.clusters import assemble_features
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(1, 30)], "a double, b double")
    raw = [r.features[1] for r in assemble_features(df, ["a", "b"]).collect()]
    scaled = [r.features[1] for r in assemble_features(df, ["a", "b"], scale=True).collect()]
    assert raw[-1] == 29.0 * 29.0                        # unscaled by default (Q14)
    assert statistics.stdev(scaled) == pytest.approx(1.0)


def test_schema_and_partition_report(spark):
    from crease.sources.files import profile_partitions, repartition_rows, schema_report
    df = spark.createDataFrame([(i, f"p{i % 7}") for i in range(100)], "id long, player string")
    rep = [tuple(r) for r in schema_report(df).orderBy("position").collect()]
    assert rep == [(0, "id", "bigint", True), (1, "player", "string", True)]
    parts = profile_partitions(repartition_rows(df, 5, ["player"])).collect()
    assert sum(r.rows for r in parts) == 100 and len(parts) <= 5


def test_materialize_cuts_lineage_in_checkpoint_folder(spark):
    from crease.session import ensure_checkpoint_dir, materialize
    df = spark.range(1000).select((F.col("id") * 3).alias("x"), F.array(F.col("id")).alias("a"))
    m = materialize(df.filter("x % 2 = 0"), "test")
    assert m.count() == 500 and m.exceptAll(df.filter("x % 2 = 0")).count() == 0
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert ensure_checkpoint_dir(spark).rstrip("/").split(":")[-1] in plan and "Range" not in plan

"""Registered queries: one per operator of the inventory, with its DuckDB oracle.

Every query reads the parquet tables of one scale-factor folder (through the
stand-in views) and returns a lazy DataFrame.  Doubles are rounded to 6 places
in the outermost select only, here and in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.fixed import BAT_CLUSTERS as BAT_K, BOWL_CLUSTERS as BOWL_K
from crease.fixed import BAT_FEATURES, BAT_PROFILE_COLS, BAT_SEASON_COLS, BOWL_FEATURES, BOWL_PROFILE_COLS
from crease.fixed import ELBOW_FRACTION, ELBOW_KS, KMEANS_ROUNDS, KMEANS_SEED, OVERS, PAIR_THRESHOLD
from crease.plans import oracle as O
from crease.plans import standins as V
from crease.operators import matchups as M
from crease.session import splittable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, views: list[str] | tuple = ()):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = O.with_views(sql, list(views))
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (outermost select only)."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


CUMS = ["c0", "c1", "c2", "c3", "c4", "c6"]
PROB_COLS = ["batsman", "bowler", "balls", "w", *CUMS, "survive"]

# --------------------------------------------------------------------------- matchups


@register("matchup_counts", """
SELECT batsman, bowler, n0, n1, n2, n3, n4, n6, w, balls FROM counts""", ["counts"])
def q_matchup_counts(spark, d):
    return M.matchup_counts(V.ball_events(V.Tables(spark, d)))


@register("multiway_join", """
SELECT batsman, bowler, n0, n1, n2, n3, n4, n6, w, balls FROM counts""", ["counts"])
def q_multiway_join(spark, d):
    return M.multiway_join(V.ball_events(V.Tables(spark, d)))


@register("pair_rows_count", """
SELECT batsman, bowler, count(*) AS rows FROM ball_events
WHERE batsman IS NOT NULL AND bowler IS NOT NULL GROUP BY batsman, bowler""", ["ball_events"])
def q_pair_rows_count(spark, d):
    return M.pair_rows_count(V.ball_events(V.Tables(spark, d)))


@register("threshold_filter", """
SELECT batsman, bowler, n0, n1, n2, n3, n4, n6, w, balls FROM counts WHERE balls > 20""", ["counts"])
def q_threshold_filter(spark, d):
    return M.threshold_filter(M.matchup_counts(V.ball_events(V.Tables(spark, d))), 20)


@register("matchup_probs", f"""
SELECT batsman, bowler, balls, w, {O.round_cols([*CUMS, "survive"])} FROM probs""", ["probs"])
def q_matchup_probs(spark, d):
    return rounded(M.matchup_probs(M.matchup_counts(V.ball_events(V.Tables(spark, d))), PAIR_THRESHOLD))


@register("global_priors", f"SELECT {O.round_cols([*CUMS, 'survive'])} FROM priors", ["priors"])
def q_global_priors(spark, d):
    counts = M.matchup_counts(V.ball_events(V.Tables(spark, d)))
    return rounded(M.global_priors(M.matchup_probs(counts, PAIR_THRESHOLD)))



# --------------------------------------------------------------------------- careers

from crease.operators import careers as CR  # noqa: E402

BAT_CAREER_COLS = ["Player", "Inns", "Runs", "HS", "Ave", "BF", "SR"]
BOWL_CAREER_COLS = ["Player", "Inns", "Runs", "Wkts", "Ave", "Econ", "SR"]


def _bat_career(t: V.Tables) -> DataFrame:
    return CR.batting_career(V.season_bat(t), V.debut_bat(t), V.HOLDOUT_YEAR)


def _bowl_career(t: V.Tables) -> DataFrame:
    return CR.bowling_career(V.season_bowl(t), V.debut_bowl(t), V.HOLDOUT_YEAR)


@register("batting_career", f"""
SELECT Player, Inns, round(Runs, 6) AS Runs, HS, {O.round_cols(["Ave"])}, BF, {O.round_cols(["SR"])}
FROM bat_career""", ["bat_career"])
def q_batting_career(spark, d):
    return rounded(_bat_career(V.Tables(spark, d)))


@register("bowling_career", f"""
SELECT Player, Inns, {O.round_cols(["Runs", "Wkts", "Ave", "Econ", "SR"])} FROM bowl_career""",
          ["bowl_career"])
def q_bowling_career(spark, d):
    return rounded(_bowl_career(V.Tables(spark, d)))


@register("project_columns", f"""
SELECT Player, Inns, Runs, HS, {O.round_cols(["Ave"])}, BF, {O.round_cols(["SR"])} FROM season_bat""",
          ["season_bat"])
def q_project_columns(spark, d):
    return rounded(CR.project_columns(V.season_bat(V.Tables(spark, d)), drop=["Year"]))


@register("rename_columns", "SELECT match_id, batsman, bowler, runs, wicket FROM ball_events",
          ["ball_events"])
def q_rename_columns(spark, d):
    return V.ball_events(V.Tables(spark, d))


@register("season_filter", f"""
SELECT Player, Year, Inns, Runs, HS, BF, {O.round_cols(["Ave", "SR"])} FROM season_bat
WHERE Year <> 2001""", ["season_bat"])
def q_season_filter(spark, d):
    return rounded(CR.season_filter(V.season_bat(V.Tables(spark, d)), V.HOLDOUT_YEAR))


@register("ratio_columns", """
SELECT Player, Year, round(CAST(Runs AS DOUBLE) / nullif(BF, 0), 6) AS runs_per_ball,
       round(CAST(Runs AS DOUBLE) / nullif(Inns, 0), 6) AS runs_per_innings
FROM season_bat""", ["season_bat"])
def q_ratio_columns(spark, d):
    s = CR.ratio_columns(V.season_bat(V.Tables(spark, d)),
                         {"runs_per_ball": ("Runs", "BF"), "runs_per_innings": ("Runs", "Inns")})
    return rounded(s.select("Player", "Year", "runs_per_ball", "runs_per_innings"))


@register("cast_features", f"""
SELECT Player, {O.round_cols(["Inns_d", "Runs", "HS_d", "Ave", "BF_d", "SR"])} FROM (
  SELECT Player, CAST(Inns AS DOUBLE) AS Inns_d, Runs, CAST(HS AS DOUBLE) AS HS_d, Ave,
         CAST(BF AS DOUBLE) AS BF_d, SR FROM bat_career) c""", ["bat_career"])
def q_cast_features(spark, d):
    c = CR.cast_features(_bat_career(V.Tables(spark, d)), ["Inns", "Runs", "HS", "Ave", "BF", "SR"])
    return rounded(c.withColumnsRenamed({"Inns": "Inns_d", "HS": "HS_d", "BF": "BF_d"}))


@register("fill_zero", """
SELECT Player, Year, round(coalesce(Ave, 0), 6) AS Ave, round(coalesce(SR, 0), 6) AS SR
FROM season_bat""", ["season_bat"])
def q_fill_zero(spark, d):
    s = V.season_bat(V.Tables(spark, d)).select("Player", "Year", "Ave", "SR")
    return rounded(CR.fill_zero(s, ["Ave", "SR"]))


@register("append_debutants", f"""
SELECT Player, Inns, Runs, HS, BF, {O.round_cols(["Ave", "SR"])} FROM (
  SELECT Player, Inns, Runs, HS, Ave, BF, SR FROM season_bat
  UNION ALL SELECT Player, Inns, Runs, HS, Ave, BF, SR FROM debut_bat) u""",
          ["season_bat", "debut_bat"])
def q_append_debutants(spark, d):
    t = V.Tables(spark, d)
    cols = BAT_SEASON_COLS
    return rounded(CR.append_debutants(V.season_bat(t).select(*cols), V.debut_bat(t).select(*cols)))


@register("preview", f"""
SELECT Player, Inns, round(Runs, 6) AS Runs, HS, {O.round_cols(["Ave"])}, BF, {O.round_cols(["SR"])}
FROM bat_career ORDER BY Player LIMIT 20""", ["bat_career"])
def q_preview(spark, d):
    from crease.sources.files import preview
    return rounded(preview(_bat_career(V.Tables(spark, d)), ["Player"], 20))


# --------------------------------------------------------------------------- outcomes

from crease.operators import outcomes as OC  # noqa: E402

REQ_COLS = ["request_id", "line", "batsman", "bowler", "u"]


# Stand-in pairs have many balls; this threshold leaves enough of them without odds
# of their own that a batch reaches all three tiers.
TIER_THRESHOLD = 24


def _probs(t: V.Tables, threshold: int = PAIR_THRESHOLD) -> DataFrame:
    return M.matchup_probs(M.matchup_counts(V.ball_events(t)), threshold)


@register("pair_lookup", f"""
SELECT r.request_id, r.line, r.batsman, r.bowler, r.u,
       {", ".join(f"round(p.{c}, 6) AS {c}" for c in [*CUMS, "survive"])},
       p.batsman IS NOT NULL AS pair_found
FROM requests r LEFT JOIN probs p ON r.batsman = p.batsman AND r.bowler = p.bowler""",
          ["requests", "probs"])
def q_pair_lookup(spark, d):
    t = V.Tables(spark, d)
    return rounded(OC.pair_lookup(V.requests(t), _probs(t)))


@register("known_players", """
SELECT * FROM requests WHERE batsman IN (SELECT Player FROM bat_clusters)
AND bowler IN (SELECT Player FROM bowl_clusters)""", ["requests", "bat_clusters", "bowl_clusters"])
def q_known_players(spark, d):
    t = V.Tables(spark, d)
    return OC.known_players(V.requests(t), V.bat_clusters(t), V.bowl_clusters(t))


@register("unknown_players", """
SELECT DISTINCT CAST(batsman AS VARCHAR) AS player, 'bat' AS side FROM requests
WHERE batsman NOT IN (SELECT Player FROM bat_clusters)
UNION ALL
SELECT DISTINCT bowler AS player, 'bowl' AS side FROM requests
WHERE bowler NOT IN (SELECT Player FROM bowl_clusters)""", ["requests", "bat_clusters", "bowl_clusters"])
def q_unknown_players(spark, d):
    t = V.Tables(spark, d)
    return OC.unknown_players(V.requests(t), V.bat_clusters(t), V.bowl_clusters(t))


@register("cluster_pool", f"""
SELECT r.request_id, r.line, r.batsman, r.bowler, r.u, k.bat_cluster, k.bowl_cluster,
       coalesce(pm.n, 0) AS pool_n,
       {", ".join(f"round(pm.{c}, 6) AS pool_{c}" for c in [*CUMS, "survive"])}
FROM requests r JOIN known_pairs k ON r.batsman = k.batsman AND r.bowler = k.bowler
LEFT JOIN pool_means pm ON r.batsman = pm.batsman AND r.bowler = pm.bowler""",
          ["requests", "known_pairs", "pool_means"])
def q_cluster_pool(spark, d):
    t = V.Tables(spark, d)
    return rounded(OC.cluster_pool(V.requests(t), _probs(t), V.bat_clusters(t), V.bowl_clusters(t)))


@register("outcome_pick", f"""
SELECT r.request_id, r.line, r.batsman, r.bowler, r.u, {O.pick_sql("p.", "r.u")} AS runs
FROM requests r JOIN probs p ON r.batsman = p.batsman AND r.bowler = p.bowler""",
          ["requests", "probs"])
def q_outcome_pick(spark, d):
    from crease.functions import outcome_pick
    t = V.Tables(spark, d)
    j = V.requests(t).join(splittable(_probs(t), *M.PAIR), M.PAIR)
    return j.select(*REQ_COLS, outcome_pick([F.col(c) for c in CUMS], "u").alias("runs"))


def _batch_sql(probs: str, pools: str, priors: str) -> str:
    return f"""
SELECT request_id, line, batsman, bowler, u, tier, {O.pick_sql("")} AS runs,
       round(survive, 6) AS survive
FROM (SELECT r.request_id, r.line, r.batsman, r.bowler, r.u,
             CASE WHEN p.batsman IS NOT NULL THEN 'pair' WHEN pm.n > 0 THEN 'cluster' ELSE 'prior' END AS tier,
             {", ".join(f"CASE WHEN p.batsman IS NOT NULL THEN p.{c} WHEN pm.n > 0 THEN pm.{c} ELSE g.{c} END AS {c}"
                        for c in [*CUMS, "survive"])}
      FROM requests r
      LEFT JOIN {probs} p ON r.batsman = p.batsman AND r.bowler = p.bowler
      LEFT JOIN {pools} pm ON r.batsman = pm.batsman AND r.bowler = pm.bowler
      CROSS JOIN {priors} g) x"""


@register("batch_outcomes", _batch_sql("probs", "pool_means", "priors"), ["requests", "probs", "pool_means", "priors"])
def q_batch_outcomes(spark, d):
    t = V.Tables(spark, d)
    return rounded(OC.batch_outcomes(V.requests(t), _probs(t), V.bat_clusters(t), V.bowl_clusters(t)))


@register("batch_outcomes_tiers", _batch_sql("probs24", "pool_means24", "priors24"),
          ["requests", "probs24", "pool_means24", "priors24"])
def q_batch_outcomes_tiers(spark, d):
    """The flagship at ``TIER_THRESHOLD``: requests fall on all three tiers."""
    t = V.Tables(spark, d)
    return rounded(OC.batch_outcomes(V.requests(t), _probs(t, TIER_THRESHOLD), V.bat_clusters(t), V.bowl_clusters(t)))


@register("cluster_sizes", """
SELECT Cluster, count(*) AS players FROM bat_clusters GROUP BY Cluster""", ["bat_clusters"])
def q_cluster_sizes(spark, d):
    from crease.operators.clusters import cluster_sizes
    return cluster_sizes(V.bat_clusters(V.Tables(spark, d)))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Outcome of every ball request with the pair -> cluster -> prior fallback."""
    return q_batch_outcomes(spark, d)


# --------------------------------------------------------------------------- innings

from crease.operators import innings as IN  # noqa: E402
from crease.operators import overs as OV  # noqa: E402
from crease.operators import trees as TR  # noqa: E402
from crease.operators import winshare as WS  # noqa: E402

LOG_COLS = ["match_id", "innings", "ball_no", "batsman", "runs", "wicket"]


def _cut(t: V.Tables) -> DataFrame:
    return IN.innings_cutoff(V.ball_log(t))


@register("ball_log", "SELECT match_id, innings, ball_no, batsman, runs, wicket, "
          "round(p_survive, 6) AS p_survive FROM ball_log", ["ball_log"])
def q_ball_log(spark, d):
    return rounded(V.ball_log(V.Tables(spark, d)))


@register("innings_cutoff", "SELECT match_id, innings, ball_no, batsman, runs, wicket FROM cut_log",
          ["cut_log"])
def q_innings_cutoff(spark, d):
    return _cut(V.Tables(spark, d)).select(*LOG_COLS)


@register("dismissal_points", """
SELECT match_id, innings, batsman, min(ball_no) AS out_ball, round(arg_min(surv, ball_no), 6) AS survival
FROM (SELECT *, product(p_survive) OVER (PARTITION BY match_id, innings, batsman ORDER BY ball_no
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS surv
      FROM ball_log) s
WHERE surv <= 0.3 GROUP BY match_id, innings, batsman""", ["ball_log"])
def q_dismissal_points(spark, d):
    return rounded(IN.dismissal_points(V.ball_log(V.Tables(spark, d))))


@register("strike_reconstruct", """
SELECT match_id, innings, ball_no, runs, wicket, striker, non_striker FROM strikes""", ["strikes"])
def q_strike_reconstruct(spark, d):
    return _strikes_cut(V.Tables(spark, d)).select(
        "match_id", "innings", "ball_no", "runs", "wicket", "striker", "non_striker")


@register("batting_positions", """
SELECT match_id, innings, CAST(unnest(range(1, len(batting) + 1)) AS INTEGER) AS position,
       unnest(batting) AS player FROM lineups""", ["lineups"])
def q_batting_positions(spark, d):
    return IN.batting_positions(V.lineups(V.Tables(spark, d)))


@register("bowling_schedule", "SELECT match_id, innings, over, bowler FROM schedule", ["schedule"])
def q_bowling_schedule(spark, d):
    return OV.bowling_schedule(V.lineups(V.Tables(spark, d)))


@register("over_totals", """
SELECT match_id, innings, CAST((ball_no - 1) // 6 AS INTEGER) AS over,
       CAST(sum(runs) AS BIGINT) AS total_runs, count(*) FILTER (WHERE wicket) AS total_wickets,
       count(*) AS balls
FROM cut_log GROUP BY 1, 2, 3""", ["cut_log"])
def q_over_totals(spark, d):
    return IN.over_totals(_cut(V.Tables(spark, d)))


@register("scorecard", """
SELECT match_id, runs_1, wickets_1, balls_1, runs_2, wickets_2, balls_2,
       CASE WHEN runs_2 > runs_1 THEN 'Team 2' ELSE 'Team 1' END AS winner
FROM (SELECT match_id,
             CAST(coalesce(sum(runs) FILTER (WHERE innings = 1), 0) AS BIGINT) AS runs_1,
             CAST(least(coalesce(sum(CAST(wicket AS BIGINT)) FILTER (WHERE innings = 1), 0), 10) AS BIGINT) AS wickets_1,
             count(*) FILTER (WHERE innings = 1) AS balls_1,
             CAST(coalesce(sum(runs) FILTER (WHERE innings = 2), 0) AS BIGINT) AS runs_2,
             CAST(least(coalesce(sum(CAST(wicket AS BIGINT)) FILTER (WHERE innings = 2), 0), 10) AS BIGINT) AS wickets_2,
             count(*) FILTER (WHERE innings = 2) AS balls_2
      FROM cut_log GROUP BY match_id) s""", ["cut_log"])
def q_scorecard(spark, d):
    return IN.scorecard(_cut(V.Tables(spark, d)))


# --------------------------------------------------------------------------- profiles and overs

BAT_P = BAT_PROFILE_COLS
BOWL_P = BOWL_PROFILE_COLS


def _bat_prof(t: V.Tables, balls: DataFrame | None = None) -> DataFrame:
    known = V.bat_clusters(t).select(F.col("Player").alias("batsman"))
    return CR.batting_profile(V.ball_events(t) if balls is None else balls).join(known, "batsman", "left_semi")


def _bowl_prof(t: V.Tables, balls: DataFrame | None = None) -> DataFrame:
    return CR.bowling_profile(V.ball_events(t) if balls is None else balls).filter(F.col("bowler") != V.UNKNOWN_BRAND)


@register("batting_profile", f"SELECT batsman, {O.round_cols(BAT_P)} FROM bat_profile", ["bat_profile"])
def q_batting_profile(spark, d):
    return rounded(CR.batting_profile(V.ball_events(V.Tables(spark, d))))


@register("bowling_profile", f"SELECT bowler, {O.round_cols(BOWL_P)} FROM bowl_profile", ["bowl_profile"])
def q_bowling_profile(spark, d):
    return rounded(CR.bowling_profile(V.ball_events(V.Tables(spark, d))))


@register("profile_means", f"""
SELECT {", ".join(f"round(avg({c}), 6) AS {c}" for c in BAT_P)} FROM bat_profile_known""",
          ["bat_profile_known"])
def q_profile_means(spark, d):
    return rounded(CR.profile_means(_bat_prof(V.Tables(spark, d)), BAT_P))


def _strikes_cut(t: V.Tables) -> DataFrame:
    return IN.strike_reconstruct(V.ball_log(t), V.lineups(t), cut=True)


def _strikes_written(t: V.Tables) -> DataFrame:
    """The cut strike log, written once, from the ball log written once; the cut, the falls of wickets
    and the balls are windows of one pass over it."""
    from crease.session import materialize
    log = materialize(V.ball_log(t).select("match_id", "innings", "ball_no", "runs", "wicket"), "ball-log")
    return materialize(IN.strike_reconstruct(log, V.lineups(t), cut=True, bounded=True), "strikes")


def _profiles_written(t: V.Tables) -> list[DataFrame]:
    """Batting and bowling profiles, each written once, from the balls written once: the log is joined with its bowlers for both."""
    from crease.session import at_once, materialize
    balls = materialize(V.ball_events(t), "balls")
    return at_once(lambda: materialize(_bat_prof(t, balls), "bat-profile"), lambda: materialize(_bowl_prof(t, balls), "bowl-profile"))


def _plan(t: V.Tables, strikes: DataFrame | None = None) -> DataFrame:
    strikes = _strikes_cut(t) if strikes is None else strikes
    return OV.over_plan(strikes, OV.bowling_schedule(V.lineups(t)))


def _features(t: V.Tables, strikes: DataFrame | None = None, profiles: list[DataFrame] | None = None) -> DataFrame:
    """Over features; the profiles, which striker, non-striker and the means read, are written once."""
    return OV.over_features(_plan(t, strikes), *(_profiles_written(t) if profiles is None else profiles))


FEATURE_COLS = [f"s_{c}" for c in BAT_P] + [f"ns_{c}" for c in BAT_P] + [f"b_{c}" for c in BOWL_P]


O.view("over_feats", f"""
SELECT p.match_id, p.innings, p.over, p.striker, p.non_striker, p.bowler,
       {", ".join(f"coalesce(s.{c}, m.{c}) AS s_{c}" for c in BAT_P)},
       {", ".join(f"coalesce(ns.{c}, m.{c}) AS ns_{c}" for c in BAT_P)},
       {", ".join(f"coalesce(b.{c}, mb.{c}) AS b_{c}" for c in BOWL_P)}
FROM plan p
LEFT JOIN bat_profile_known s ON p.striker = s.batsman
LEFT JOIN bat_profile_known ns ON p.non_striker = ns.batsman
LEFT JOIN bowl_profile_known b ON p.bowler = b.bowler
CROSS JOIN (SELECT {", ".join(f"avg({c}) AS {c}" for c in BAT_P)} FROM bat_profile_known) m
CROSS JOIN (SELECT {", ".join(f"avg({c}) AS {c}" for c in BOWL_P)} FROM bowl_profile_known) mb""",
       ["plan", "bat_profile_known", "bowl_profile_known"])


@register("over_features", f"""
SELECT match_id, innings, over, striker, non_striker, bowler, {O.round_cols(FEATURE_COLS)} FROM over_feats""", ["over_feats"])
def q_over_features(spark, d):
    f = _features(V.Tables(spark, d))
    return rounded(f.select("match_id", "innings", "over", "striker", "non_striker", "bowler",
                            *FEATURE_COLS))


@register("wicket_discount", """
SELECT match_id, innings, over, total_runs, total_wickets,
       CASE WHEN total_wickets <> 0
            THEN round_even(CAST(total_runs AS DOUBLE) / 6 * (6 - total_wickets), 0)
            ELSE CAST(total_runs AS DOUBLE) END AS runs_after
FROM (SELECT match_id, innings, CAST((ball_no - 1) // 6 AS INTEGER) AS over,
             CAST(sum(runs) AS BIGINT) AS total_runs, count(*) FILTER (WHERE wicket) AS total_wickets
      FROM cut_log GROUP BY 1, 2, 3) o""", ["cut_log"])
def q_wicket_discount(spark, d):
    from crease.functions import wicket_discount
    o = IN.over_totals(_cut(V.Tables(spark, d)))
    return o.select("match_id", "innings", "over", "total_runs", "total_wickets",
                    wicket_discount("total_runs", "total_wickets").alias("runs_after"))


def _train(t: V.Tables) -> DataFrame:
    return _features(t).join(IN.over_totals(_cut(t)), OV.PLAN_KEYS)


def _vector_columns(vec, n: int) -> list:
    """A feature vector as n rounded scalar columns f00.. (one value per cell)."""
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(vec)
    return [F.round(arr[i], 6).alias(f"f{i:02d}") for i in range(n)]


def _sql_columns(exprs: list[str]) -> str:
    return ", ".join(f"round({e}, 6) AS f{i:02d}" for i, e in enumerate(exprs))


@register("labeled_features", f"""
SELECT CAST(t.total_runs AS DOUBLE) AS label,
       {_sql_columns(["CAST(f.over AS DOUBLE)"] + [f"f.{c}" for c in FEATURE_COLS])}
FROM over_feats f
JOIN (SELECT match_id, innings, CAST((ball_no - 1) // 6 AS INTEGER) AS over, sum(runs) AS total_runs
      FROM cut_log GROUP BY 1, 2, 3) t
  ON f.match_id = t.match_id AND f.innings = t.innings AND f.over = t.over""",
          ["over_feats", "cut_log"])
def q_labeled_features(spark, d):
    lf = OV.labeled_features(_train(V.Tables(spark, d)), "total_runs")
    return lf.select("label", *_vector_columns(F.col("features"), 15))


_FITS: dict[tuple[str, str], tuple] = {}


def _fitted(t: V.Tables):
    """Over features and the two trees fitted on the overs of matches that are not held out.

    The features, with the totals of the over, are written as parquet to the shared checkpoint
    folder, so the passes before them run once; the trees are grown on all these overs.
    The model queries of a session share one fit.
    """
    from crease.session import ensure_checkpoint_dir
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _FITS:
        ensure_checkpoint_dir(t.spark)
        labelled = _labelled(t)
        _FITS[key] = (labelled.drop("total_runs", "total_wickets", "balls", "held_out"), *OV.fit_over_models(OV.training_rows(labelled)))
    return _FITS[key]


def _predicted(t: V.Tables) -> DataFrame:
    """Expected runs and wickets of every over of the plan."""
    feats, rm, wm = _fitted(t)
    return OV.predict_overs(feats, rm, wm)


def _score_views(name: str, source: str, deps: list[str]) -> None:
    """Views of kept overs for ``source`` rows (match_id, innings, over, r, w), rounded predictions."""
    O.view(f"{name}_scored", f"""
SELECT match_id, innings, over, w,
       CAST(CASE WHEN w <> 0 THEN round_even(r / 6 * (6 - w), 0) ELSE r END AS BIGINT) AS runs
FROM ({source}) o WHERE over < 20""", deps)
    O.view(f"{name}_running", f"""
SELECT *, coalesce(sum(w) OVER earlier, 0) AS w_before, coalesce(sum(runs) OVER earlier, 0) AS r_before
FROM {name}_scored
WINDOW earlier AS (PARTITION BY match_id, innings ORDER BY over ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
           [f"{name}_scored"])
    O.view(f"{name}_kept", f"""
SELECT x.* FROM (SELECT * FROM {name}_running WHERE w_before < 10) x
LEFT JOIN (SELECT match_id, sum(runs) AS target FROM {name}_running WHERE w_before < 10 AND innings = 1
           GROUP BY match_id) f ON x.match_id = f.match_id
WHERE x.innings = 1 OR x.r_before <= coalesce(f.target, 0)""", [f"{name}_running"])


def _score_sql(name: str, more: str = "") -> str:
    return f"""
SELECT match_id, runs_1, wickets_1, overs_1, runs_2, wickets_2, overs_2,
       CASE WHEN runs_2 > runs_1 THEN 'Team 2' ELSE 'Team 1' END AS winner{more}
FROM (SELECT match_id,
             CAST(coalesce(sum(runs) FILTER (WHERE innings = 1), 0) AS BIGINT) AS runs_1,
             CAST(least(coalesce(sum(w) FILTER (WHERE innings = 1), 0), 10) AS BIGINT) AS wickets_1,
             count(*) FILTER (WHERE innings = 1) AS overs_1,
             CAST(coalesce(sum(runs) FILTER (WHERE innings = 2), 0) AS BIGINT) AS runs_2,
             CAST(least(coalesce(sum(w) FILTER (WHERE innings = 2), 0), 10) AS BIGINT) AS wickets_2,
             count(*) FILTER (WHERE innings = 2) AS overs_2
      FROM {name}_kept GROUP BY match_id) s"""


_score_views("log", """SELECT match_id, innings, CAST((ball_no - 1) // 6 AS INTEGER) AS over,
             CAST(sum(runs) AS DOUBLE) AS r, count(*) FILTER (WHERE wicket) AS w
      FROM ball_log GROUP BY 1, 2, 3""", ["ball_log"])


# A stated tree of three levels: over, then the striker's strike rate or the bowler's economy, then
# (for the free hitters) the non-striker's runs per innings.  (node, feature, left, right)
SPLITS = [(0, 0, 1, 2), (1, 2, 3, 4), (2, 12, 5, 6), (4, 6, 7, 8)]
SPLIT_DEPTH = 3
HELD_OUT_SQL = f"""CAST('0x' || substr(md5('held out|' || CAST(match_id AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0
       < {OV.HELD_OUT}"""

O.view("tree_rows", f"""
SELECT f.match_id, f.innings, f.over, f.striker, f.non_striker, f.bowler, t.runs, t.wickets, {HELD_OUT_SQL.replace("match_id", "f.match_id")} AS held_out,
       [CAST(f.over AS DOUBLE), {", ".join(f"f.{c}" for c in FEATURE_COLS)}] AS feats
FROM over_feats f
JOIN (SELECT match_id, innings, CAST((ball_no - 1) // 6 AS INTEGER) AS over, sum(runs) AS runs,
             count(*) FILTER (WHERE wicket) AS wickets FROM cut_log GROUP BY 1, 2, 3) t
  ON f.match_id = t.match_id AND f.innings = t.innings AND f.over = t.over""", ["over_feats", "cut_log"], kept=True)

O.view("tree_splits", " UNION ALL ".join(
    f"SELECT {n} AS node, {f} AS feature, (SELECT round(avg(feats[{f + 1}]), 6) FROM tree_rows WHERE NOT held_out) AS threshold, "
    f"{a} AS l, {b} AS r" for n, f, a, b in SPLITS), ["tree_rows"], kept=True)

O.view("tree_walk", """
SELECT match_id, innings, over, feats, 0 AS node FROM tree_rows
UNION ALL
SELECT w.match_id, w.innings, w.over, w.feats, CASE WHEN w.feats[s.feature + 1] <= s.threshold THEN s.l ELSE s.r END
FROM tree_walk w JOIN tree_splits s ON s.node = w.node""", ["tree_splits"], recursive=True)

O.view("tree_leaves", """
SELECT t.*, w.node FROM tree_rows t JOIN tree_walk w ON t.match_id = w.match_id AND t.innings = w.innings AND t.over = w.over
WHERE w.node NOT IN (SELECT node FROM tree_splits)""", ["tree_walk"], kept=True)

O.view("tree_nodes", """
SELECT n.node, s.feature, s.threshold, coalesce(s.l, -1) AS l, coalesce(s.r, -1) AS r,
       coalesce(m.runs, (SELECT avg(runs) FROM tree_rows WHERE NOT held_out)) AS pred_runs,
       coalesce(m.wickets, (SELECT avg(wickets) FROM tree_rows WHERE NOT held_out)) AS pred_wickets
FROM (SELECT 0 AS node UNION SELECT l FROM tree_splits UNION SELECT r FROM tree_splits) n
LEFT JOIN tree_splits s ON s.node = n.node
LEFT JOIN (SELECT node, avg(runs) AS runs, avg(wickets) AS wickets FROM tree_leaves WHERE NOT held_out GROUP BY node) m
  ON m.node = n.node""", ["tree_leaves"], kept=True)

O.view("tree_preds", """
SELECT l.match_id, l.innings, l.over, l.striker, l.non_striker, l.bowler, l.held_out, l.node, n.pred_runs, n.pred_wickets
FROM tree_leaves l JOIN tree_nodes n ON n.node = l.node""", ["tree_nodes"])

_score_views("tree", "SELECT match_id, innings, over, round_even(pred_runs, 0) AS r, CAST(round_even(pred_wickets, 0) AS BIGINT) AS w "
             "FROM tree_preds", ["tree_preds"])


def _labelled(t: V.Tables) -> DataFrame:
    """Over features with the totals of the over and whether its match is held out, written once."""
    from crease.session import at_once, ensure_checkpoint_dir, materialize
    ensure_checkpoint_dir(t.spark)
    strikes, profiles = at_once(lambda: _strikes_written(t), lambda: _profiles_written(t))
    feats = _features(t, strikes, profiles).join(IN.over_totals(strikes), OV.PLAN_KEYS)
    return materialize(feats.withColumn("held_out", OV.held_out()), "labelled-overs")


def _stated(overs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stated tree as two node tables, with the mean runs and the mean wickets of each leaf's overs."""
    seen = overs.where("not held_out")
    nodes = TR.stated_tree(seen, SPLITS)
    return TR.leaf_means(nodes, seen, "total_runs", SPLIT_DEPTH), TR.leaf_means(nodes, seen, "total_wickets", SPLIT_DEPTH)


def _stated_predictions(overs: DataFrame) -> DataFrame:
    """Every over with its prediction from the stated tree; the held-out matches' overs had no part in it."""
    runs, wickets = _stated(overs)
    x = TR.descend(overs, runs, SPLIT_DEPTH, prediction="pred_runs")
    return TR.descend(x.drop("leaf"), wickets, SPLIT_DEPTH, prediction="pred_wickets")


@register("tree_nodes", f"""
SELECT node, CAST(feature AS INTEGER) AS feature, {O.round_cols(["threshold"])}, CAST(l AS INTEGER) AS "left", CAST(r AS INTEGER) AS "right",
       {O.round_cols(["pred_runs", "pred_wickets"])} FROM tree_nodes""", ["tree_nodes"])
def q_tree_nodes(spark, d):
    """The stated tree: thresholds are feature means, leaves the mean runs and wickets of their overs."""
    runs, wickets = _stated(_labelled(V.Tables(spark, d)))
    both = runs.withColumnRenamed("prediction", "pred_runs").join(
        wickets.select("node", F.col("prediction").alias("pred_wickets")), "node")
    return rounded(both.select("node", "feature", "threshold", "left", "right", "pred_runs", "pred_wickets"))


@register("over_predictions", f"""
SELECT match_id, innings, over, striker, non_striker, bowler, {O.round_cols(["pred_runs", "pred_wickets"])}, node AS leaf, held_out
FROM tree_preds""", ["tree_preds"])
def q_over_predictions(spark, d):
    """Expected runs and wickets of every over, and the leaf it ends at, from the stated tree."""
    p = _stated_predictions(_labelled(V.Tables(spark, d)))
    return rounded(p.select(*OV.PLAN_KEYS, "striker", "non_striker", "bowler", "pred_runs", "pred_wickets", "leaf", "held_out"))


@register("score_predicted", _score_sql("tree", ", " + HELD_OUT_SQL + " AS held_out"), ["tree_kept"])
def q_score_predicted(spark, d):
    """Scores of all matches from the stated tree; ``held_out``: its leaves have not seen the match."""
    p = _stated_predictions(_labelled(V.Tables(spark, d))).select(*OV.PLAN_KEYS, "pred_runs", "pred_wickets")
    return OV.score_overs(p).withColumn("held_out", OV.held_out())


def _fitted_nodes(t: V.Tables) -> tuple[DataFrame, DataFrame, int]:
    """Node tables of both fitted trees, with levels, and the greater depth."""
    from crease.session import materialize
    _, rm, wm = _fitted(t)
    depth = max(rm.depth, wm.depth)
    runs, wickets = (materialize(m.nodes().select(*TR.NODE, "level"), "nodes") for m in (rm, wm))
    return runs, wickets, depth


def _walked(t: V.Tables) -> DataFrame:
    """Predictions of every over by walking the fitted trees' node tables."""
    runs, wickets, depth = _fitted_nodes(t)
    x = TR.descend(_fitted(t)[0], runs, depth, prediction="pred_runs").drop("leaf")
    return TR.descend(x, wickets, depth, prediction="pred_wickets")


@register("over_predictions_fitted")
def q_over_predictions_fitted(spark, d):
    """As ``over_predictions`` with the fitted trees, whose node tables are walked."""
    p = _walked(V.Tables(spark, d))
    return p.select(*OV.PLAN_KEYS, "striker", "non_striker", "bowler", "pred_runs", "pred_wickets", OV.held_out().alias("held_out"))


@register("tree_checks", "SELECT count(*) AS overs, CAST(0 AS BIGINT) AS runs_differ, CAST(0 AS BIGINT) AS wickets_differ FROM plan", ["plan"])
def q_tree_checks(spark, d):
    """Of the fitted trees (M7): overs, and overs where walking the node tables gives another
    prediction of runs or of wickets than the models do."""
    t = V.Tables(spark, d)
    model = _predicted(t).select(*OV.PLAN_KEYS, F.col("pred_runs").alias("r"), F.col("pred_wickets").alias("w"))
    both = _walked(t).join(model, OV.PLAN_KEYS, "left")
    differ = lambda a, b: F.count_if(~F.col(a).eqNullSafe(F.col(b)))
    return both.agg(F.count("*").alias("overs"), differ("pred_runs", "r").alias("runs_differ"),
                    differ("pred_wickets", "w").alias("wickets_differ"))


@register("score_fitted")
def q_score_fitted(spark, d):
    """Scores of all matches from the fitted trees' predictions; ``held_out``: the fit has not seen the match."""
    feats, rm, wm = _fitted(V.Tables(spark, d))
    p = OV.predict_overs(feats.select(*OV.PLAN_KEYS, "features"), rm, wm)
    return OV.score_overs(p.drop("features")).withColumn("held_out", OV.held_out())


@register("score_overs", _score_sql("log"), ["log_kept"])
def q_score_overs(spark, d):
    """Scores from given over predictions: the over totals of the uncut log."""
    o = IN.over_totals(V.ball_log(V.Tables(spark, d)))
    return OV.score_overs(o.select(*OV.PLAN_KEYS, F.col("total_runs").cast("double").alias("pred_runs"),
                                   F.col("total_wickets").cast("double").alias("pred_wickets")))


# the distribution of an over at each leaf, folded over by over, in SQL by innings
O.view("leaf_share", """
SELECT node, CAST(CASE WHEN wickets <> 0 THEN round_even(CAST(runs AS DOUBLE) / 6 * (6 - wickets), 0) ELSE runs END AS BIGINT) AS r,
       wickets AS w, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY node) AS share
FROM tree_leaves WHERE NOT held_out GROUP BY node, runs, wickets""", ["tree_leaves"], kept=True)

O.view("innings_leaves", """
SELECT match_id, innings, node, row_number() OVER (PARTITION BY match_id, innings ORDER BY over) AS k
FROM tree_leaves WHERE over < 20""", ["tree_leaves"], kept=True)

O.view("innings_p0", """
SELECT DISTINCT match_id, innings, CAST(0 AS BIGINT) AS r, CAST(0 AS BIGINT) AS w, CAST(1 AS DOUBLE) AS p
FROM innings_leaves""", ["innings_leaves"], kept=True)

for _k in range(1, OVERS + 1):
    O.view(f"innings_p{_k}", f"""
SELECT match_id, innings, r, w, sum(p) AS p FROM (
  SELECT s.match_id, s.innings, s.r + CASE WHEN s.w < 10 THEN d.r ELSE 0 END AS r,
         least(s.w + CASE WHEN s.w < 10 THEN d.w ELSE 0 END, 10) AS w, s.p * d.share AS p
  FROM innings_p{_k - 1} s JOIN innings_leaves l ON l.match_id = s.match_id AND l.innings = s.innings AND l.k = {_k}
  JOIN leaf_share d ON d.node = l.node
  UNION ALL
  SELECT s.* FROM innings_p{_k - 1} s LEFT JOIN innings_leaves l ON l.match_id = s.match_id AND l.innings = s.innings AND l.k = {_k}
  WHERE l.k IS NULL) x GROUP BY match_id, innings, r, w""", [f"innings_p{_k - 1}", "leaf_share"], kept=True)

O.view("totals_p", f"SELECT match_id, innings, r, sum(p) AS p FROM innings_p{OVERS} GROUP BY match_id, innings, r", [f"innings_p{OVERS}"], kept=True)


@register("win_share", """
SELECT m.match_id, round(coalesce(e.e1, 0), 6) AS expected_1, round(coalesce(e.e2, 0), 6) AS expected_2,
       round(sum(CASE WHEN a.r > b.r THEN a.p * b.p ELSE 0 END), 6) AS win_1,
       round(sum(CASE WHEN a.r = b.r THEN a.p * b.p ELSE 0 END), 6) AS tie,
       round(sum(CASE WHEN a.r < b.r THEN a.p * b.p ELSE 0 END), 6) AS win_2
FROM (SELECT DISTINCT match_id FROM innings_leaves) m
JOIN (SELECT match_id, sum(r * p) FILTER (WHERE innings = 1) AS e1, sum(r * p) FILTER (WHERE innings = 2) AS e2
      FROM totals_p GROUP BY match_id) e ON e.match_id = m.match_id
JOIN (SELECT match_id, r, p FROM totals_p WHERE innings = 1 UNION ALL
      SELECT match_id, 0, 1 FROM totals_p GROUP BY match_id HAVING count(*) FILTER (WHERE innings = 1) = 0) a ON a.match_id = m.match_id
JOIN (SELECT match_id, r, p FROM totals_p WHERE innings = 2 UNION ALL
      SELECT match_id, 0, 1 FROM totals_p GROUP BY match_id HAVING count(*) FILTER (WHERE innings = 2) = 0) b ON b.match_id = m.match_id
GROUP BY m.match_id, e.e1, e.e2""", ["totals_p"])
def q_win_share(spark, d):
    """Win share and expected totals of every match, from the runs and wickets at the leaves of the stated tree."""
    from crease.session import materialize
    overs = _labelled(V.Tables(spark, d))
    seen = overs.where("not held_out")
    nodes = materialize(TR.stated_tree(seen, SPLITS), "nodes")
    dist = WS.over_distribution(TR.leaf_counts(nodes, seen, ["total_runs", "total_wickets"], SPLIT_DEPTH))
    leaves = TR.descend(overs, nodes, SPLIT_DEPTH).select(*OV.PLAN_KEYS, "leaf")
    return rounded(WS.win_share(leaves, dist))


# --------------------------------------------------------------------------- pages

from crease.sources import pages as PG  # noqa: E402
from crease.sources import files as FS  # noqa: E402

_ITEM = PG.ITEM_RE.replace("'", "''")


@register("url_catalog", f"""
SELECT page_id, regexp_replace(url, '{PG.TRAIL_RE}', '') AS url, regexp_extract(regexp_replace(url, '{PG.TRAIL_RE}', ''), '{PG.HOST_RE}', 1) AS host,
       regexp_extract(regexp_replace(url, '{PG.TRAIL_RE}', ''), '{PG.LANG_RE}', 1) AS lang,
       TRY_CAST(nullif(regexp_extract(regexp_replace(url, '{PG.TRAIL_RE}', ''), '{PG.SEASON_RE}', 1), '') AS INTEGER) AS season
FROM pages""")
def q_url_catalog(spark, d):
    return PG.url_catalog(V.Tables(spark, d).pages)


@register("html_rows", f"""
SELECT page_id, CAST(unnest(range(0, len(hrefs))) AS INTEGER) AS pos, unnest(hrefs) AS href,
       unnest(texts) AS text
FROM (SELECT page_id, regexp_extract_all(html, '{_ITEM}', 1) AS hrefs,
             regexp_extract_all(html, '{_ITEM}', 2) AS texts FROM pages) p""")
def q_html_rows(spark, d):
    """Every link item of a page with its target and text."""
    return PG.link_rows(V.Tables(spark, d).pages)


# The pages hold no tables: their list items stand in for rows, the links in them for cells.
LIST_ROW_RE, LIST_CELL_RE = r"<li[^>]*>(.*?)</li>", r"<a [^>]*>([^<]*)</a>"


@register("table_rows", f"""
SELECT page_id, CAST(unnest(range(0, len(rows))) AS INTEGER) AS pos, unnest(rows) AS cells
FROM (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '{LIST_ROW_RE}', 1),
             lambda r: array_to_string(list_transform(regexp_extract_all(r, '{LIST_CELL_RE}', 1), lambda c: trim(c)), '|')),
             lambda r: r <> '') AS rows FROM pages) p""")
def q_table_rows(spark, d):
    """Rows of a page as lists of cells (S3), joined by ``|``."""
    rows = PG.html_rows(V.Tables(spark, d).pages, LIST_ROW_RE, LIST_CELL_RE)
    return rows.select("page_id", "pos", F.array_join("cells", "|").alias("cells"))


O.view("items", f"""
SELECT page_id, CAST(unnest(range(0, len(hrefs))) AS INTEGER) AS pos, unnest(texts) AS text
FROM (SELECT page_id, regexp_extract_all(html, '{_ITEM}', 1) AS hrefs,
             regexp_extract_all(html, '{_ITEM}', 2) AS texts FROM pages) p""")


@register("pair_rows", f"""
SELECT s.page_id, s.pair, s.text AS stat, TRY_CAST(s.text AS DOUBLE) AS stat_value,
       translate(t.text, '()', '') AS team, c.season
FROM (SELECT page_id, pos // 2 AS pair, text FROM items WHERE pos % 2 = 0) s
LEFT JOIN (SELECT page_id, pos // 2 AS pair, text FROM items WHERE pos % 2 = 1) t
  ON s.page_id = t.page_id AND s.pair = t.pair
LEFT JOIN (SELECT page_id, TRY_CAST(nullif(regexp_extract(regexp_replace(url, '{PG.TRAIL_RE}', ''), '{PG.SEASON_RE}', 1), '') AS INTEGER)
                  AS season FROM pages) c ON s.page_id = c.page_id""", ["items"])
def q_pair_rows(spark, d):
    return PG.pair_rows(V.Tables(spark, d).pages)


_SEEN = f"regexp_replace(html, '<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'gis')"


@register("element_rows", f"""
SELECT page_id, element, 'body' AS section, CAST(unnest(range(0, len(rows))) AS INTEGER) AS pos, unnest(rows) AS cells
FROM (SELECT page_id, element, list_filter(list_transform(regexp_extract_all(content, '(?is)<li\\b[^>]*>(.*?)</li', 1),
             lambda r: array_to_string(list_transform(regexp_extract_all(r, '(?is)<a\\b[^>]*>(.*?)</a', 1),
                                                      lambda c: trim(regexp_replace(c, '<[^>]*>', '', 'g'))), '|')), lambda r: r <> '') AS rows
      FROM (SELECT page_id, CAST(unnest(range(0, len(lists))) AS INTEGER) AS element, unnest(lists) AS content
            FROM (SELECT page_id, regexp_extract_all({_SEEN}, '(?is)<ul\\b[^>]*>(.*?)</ul\\s*>', 1) AS lists FROM pages) l) e) r""")
def q_element_rows(spark, d):
    """Rows of the lists of a page (S3): an element's items, and the links in an item for cells."""
    rows = PG.element_rows(V.Tables(spark, d).pages, tag="ul", row_tag="li", cell_tags=("a",))
    return rows.withColumn("cells", F.array_join("cells", "|"))


@register("classed_elements", f"""
SELECT page_id, CAST(n AS INTEGER) AS element, trim(regexp_replace(said, '<[^>]*>', '', 'g')) AS text
FROM (SELECT page_id, unnest(range(0, len(tags))) AS n, unnest(tags) AS tag, unnest(said) AS said
      FROM (SELECT page_id, regexp_extract_all({_SEEN}, '(?is)<div\\b([^>]*)>.*?</div\\s*>', 1) AS tags,
                   regexp_extract_all({_SEEN}, '(?is)<div\\b[^>]*>(.*?)</div\\s*>', 1) AS said FROM pages) p) e
WHERE regexp_matches(tag, 'class="([^"]* )?ad( [^"]*)?"')""")
def q_classed_elements(spark, d):
    """The boxes of a page that have a class, with what they say."""
    boxes = PG.elements(V.Tables(spark, d).pages, "div", classed="ad")
    return boxes.select("page_id", "element", PG.element_text().alias("text"))


# --------------------------------------------------------------------------- files

CUSTOMER_SCHEMA = ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                   "c_mktsegment string")


def _customer_csv(spark, d, append: bool) -> DataFrame:
    from crease.session import scratch_path
    cust = V.Tables(spark, d).customer
    path = scratch_path(spark, "csv")
    if append:
        FS.csv_append(cust, path)
        FS.csv_append(cust, path)
    else:
        FS.csv_overwrite(cust, path)
    return FS.csv_scan(spark, path, CUSTOMER_SCHEMA)


@register("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, d):
    return _customer_csv(spark, d, append=False)


@register("csv_append", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def q_csv_append(spark, d):
    return _customer_csv(spark, d, append=True)


@register("csv_append_once", "SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 2 = 0")
def q_csv_append_once(spark, d):
    """Two batches, the first of them appended again by a repeated job: each counts once."""
    from crease.session import scratch_path
    cust, path = V.Tables(spark, d).customer, scratch_path(spark, "batches")
    even = cust.where("c_custkey % 2 = 0")
    for batch, rows in (("all", cust), ("even", even), ("all", cust)):
        FS.csv_append_batch(rows, path, batch)
    return FS.csv_scan_batches(spark, path, CUSTOMER_SCHEMA)


@register("ordered_rows", """
SELECT event_id, event_type, row_number() OVER (ORDER BY event_type, value DESC, event_id) AS position FROM events""")
def q_ordered_rows(spark, d):
    """All events in order of type, falling value and id, numbered throughout (O1)."""
    ev = V.Tables(spark, d).events.select("event_id", "event_type", "value")
    return FS.ordered_rows(ev, ["event_type", F.col("value").desc(), "event_id"]).drop("value")


@register("ordered_groups", """
SELECT batsman, bowler, balls, row_number() OVER (ORDER BY batsman, bowler) AS position FROM counts""", ["counts"])
def q_ordered_groups(spark, d):
    """Pair counts in key order (O1), as a group-by of the reference gives them."""
    pairs = M.matchup_counts(V.ball_events(V.Tables(spark, d))).select("batsman", "bowler", "balls")
    return FS.ordered_rows(pairs, ["batsman", "bowler"])


@register("season_list", f"""
SELECT position, url, 2018 - position AS season FROM (
  SELECT row_number() OVER (ORDER BY page_id) - 1 AS position, regexp_replace(url, '{PG.TRAIL_RE}', '') AS url FROM pages) p
WHERE url <> ''""")
def q_season_list(spark, d):
    """The pages' URLs as a list in files, read back with the season of each from its place."""
    from crease.session import scratch_path
    path = scratch_path(spark, "urls")
    urls = V.Tables(spark, d).pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    urls.repartitionByRange(4, "page_id").sortWithinPartitions("page_id").select("url").write.text(path)
    return PG.season_list(spark, path)


@register("dense_ordinal", """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE user_id IS NOT NULL""")
def q_dense_ordinal(spark, d):
    """Position of every event in its user's history, by ranges instead of chunks of time."""
    from crease.operators.running import dense_ordinal
    ev = V.Tables(spark, d).events.select("user_id", "ts", "event_id")
    return dense_ordinal(ev, ["user_id"], ["ts", "event_id"]).drop("ts")


@register("repartition_rows", "SELECT * FROM ball_events", ["ball_events"])
def q_repartition_rows(spark, d):
    return FS.repartition_rows(V.ball_events(V.Tables(spark, d)), 5, ["batsman", "bowler"])


@register("profile_partitions", """
SELECT count(*) AS rows, 5 AS partitions FROM ball_events""", ["ball_events"])
def q_profile_partitions(spark, d):
    """Rows of all partitions, and how many hold any (rows are dealt to 5 in turn)."""
    p = FS.profile_partitions(FS.repartition_rows(V.ball_events(V.Tables(spark, d)), 5))
    return p.agg(F.sum("rows").alias("rows"), F.count("*").cast("int").alias("partitions"))


@register("schema_report", """
SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS name,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                        WHEN 'VARCHAR' THEN 'string' ELSE column_type END AS type,
       true AS nullable
FROM (DESCRIBE SELECT * FROM customer) d""")
def q_schema_report(spark, d):
    return FS.schema_report(V.Tables(spark, d).customer)


# --------------------------------------------------------------------------- clusters

from crease.operators import clusters as CL  # noqa: E402

O.view("centres", """
SELECT e.label AS cluster, e.embedding AS center FROM embeddings e
JOIN (SELECT label, min(vec_id) AS vid FROM embeddings GROUP BY label) m ON e.vec_id = m.vid""")

O.view("dists", """
SELECT p.vec_id, c.cluster,
       list_sum(list_transform(range(1, len(p.embedding) + 1),
                               lambda i: (CAST(p.embedding[i] AS DOUBLE) - CAST(c.center[i] AS DOUBLE))
                                       * (CAST(p.embedding[i] AS DOUBLE) - CAST(c.center[i] AS DOUBLE)))) AS d
FROM embeddings p CROSS JOIN centres c""", ["centres"])

O.view("nearest", """
SELECT vec_id, cluster, d FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS rk FROM dists) r
WHERE rk = 1""", ["dists"])


def _centres(t: V.Tables) -> DataFrame:
    """Fixed centres: the lowest-id point of each label."""
    e = t.embeddings
    first = e.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    return e.join(first, ["label", "vec_id"]).select(
        F.col("label").cast("int").alias("cluster"), F.col("embedding").alias("center"))


@register("assign_clusters", "SELECT vec_id, cluster, round(d, 6) AS distance FROM nearest",
          ["nearest"])
def q_assign_clusters(spark, d):
    t = V.Tables(spark, d)
    return rounded(CL.assign_clusters(t.embeddings, _centres(t), vec="embedding", keep=["vec_id"]))


@register("kmeans_cost", "SELECT round(sum(d), 6) AS cost FROM nearest", ["nearest"])
def q_kmeans_cost(spark, d):
    t = V.Tables(spark, d)
    return rounded(CL.kmeans_cost(t.embeddings, _centres(t), vec="embedding"))


def _bat_points(t: V.Tables) -> DataFrame:
    c = CR.cast_features(_bat_career(t), BAT_FEATURES)
    return CL.assemble_features(c, BAT_FEATURES).select("Player", "features")


@register("assemble_features", f"""
SELECT Player, {_sql_columns(["Runs", "CAST(HS AS DOUBLE)", "Ave", "CAST(BF AS DOUBLE)", "SR"])}
FROM bat_career
WHERE Runs IS NOT NULL AND HS IS NOT NULL AND Ave IS NOT NULL AND BF IS NOT NULL AND SR IS NOT NULL""",
          ["bat_career"])
def q_assemble_features(spark, d):
    p = _bat_points(V.Tables(spark, d))
    return p.select("Player", *_vector_columns(F.col("features"), len(BAT_FEATURES)))


@register("sample_rows", f"""
SELECT * FROM customer
WHERE CAST('0x' || substr(md5('{KMEANS_SEED}|' || CAST(c_custkey AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0
      < {ELBOW_FRACTION}""")
def q_sample_rows(spark, d):
    return CL.sample_rows(V.Tables(spark, d).customer, ELBOW_FRACTION, KMEANS_SEED, ["c_custkey"])


# ---- K-means rounds from stated start points, in whole numbers, in both engines


def _kmeans_views(name: str, source: str, deps: list[str], features: list[str], ks, sampled: bool = False) -> None:
    """Views ``<name>_points`` (Player, v), the start and each round's centres ``<name>_c<round>`` (k, id, v)."""
    steps = ", ".join(f"CAST(floor(CAST({c} AS DOUBLE) * {CL.GRID} + 0.5) AS BIGINT)" for c in features)
    given = " AND ".join(f"{c} IS NOT NULL" for c in features)
    O.view(f"{name}_points", f"SELECT Player, [{steps}] AS v FROM {source} WHERE {given}", deps, kept=True)
    draw = f"CAST('0x' || substr(md5('{KMEANS_SEED}|' || CAST(Player AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0"
    O.view(f"{name}_fit", f"SELECT Player, v FROM {name}_points" + f" WHERE {draw} < {ELBOW_FRACTION}" * sampled, [f"{name}_points"], kept=True)
    O.view(f"{name}_c0", f"""
SELECT k, id, v FROM (SELECT CAST(row_number() OVER (ORDER BY {draw}, Player) - 1 AS INTEGER) AS id, v FROM {name}_fit) s
JOIN (SELECT unnest({list(ks)}) AS k) n ON id < k""", [f"{name}_fit"], kept=True)
    for r in range(KMEANS_ROUNDS):
        O.view(f"{name}_c{r + 1}", f"""
SELECT c.k, c.id, coalesce(m.v, c.v) AS v FROM {name}_c{r} c LEFT JOIN (
  SELECT k, id, list(x ORDER BY i) AS v FROM (
    SELECT k, id, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM (
      SELECT k, id, unnest(range(1, {len(features) + 1})) AS i, unnest(v) AS x FROM ({_near_sql(f"{name}_fit", f"{name}_c{r}")}) a) u
    GROUP BY k, id, i) f GROUP BY k, id) m ON m.k = c.k AND m.id = c.id""", [f"{name}_c{r}"], kept=True)


def _near_sql(points: str, centres: str) -> str:
    """(k, Player, v, id, d): each point's nearest centre of each k."""
    d = "list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - c.v[i]) * (p.v[i] - c.v[i])))"
    return f"""SELECT k, Player, v, near['id'] AS id, near['d'] AS d FROM (
        SELECT c.k, p.Player, any_value(p.v) AS v, min({{'d': {d}, 'id': c.id}}) AS near
        FROM {points} p CROSS JOIN {centres} c GROUP BY c.k, p.Player) n"""


_LAST = f"c{KMEANS_ROUNDS}"
_kmeans_views("batk", "bat_career", ["bat_career"], BAT_FEATURES, [BAT_K])
_kmeans_views("bowlk", "bowl_career", ["bowl_career"], BOWL_FEATURES, [BOWL_K])
_kmeans_views("bate", "bat_career", ["bat_career"], BAT_FEATURES, ELBOW_KS, sampled=True)
_kmeans_views("bowle", "bowl_career", ["bowl_career"], BOWL_FEATURES, ELBOW_KS, sampled=True)
_kmeans_views("profk", "(SELECT bowler AS Player, * FROM bowl_profile)", ["bowl_profile"], BOWL_P, [BOWL_K])


def _bat_grid(t: V.Tables) -> DataFrame:
    from crease.session import materialize
    return materialize(CL.on_grid(_bat_career(t), BAT_FEATURES), "bat-points")


def _bowl_grid(t: V.Tables) -> DataFrame:
    from crease.session import materialize
    return materialize(CL.on_grid(_bowl_career(t), BOWL_FEATURES), "bowl-points")


@register("fit_clusters", f"""
SELECT CAST(id AS INTEGER) AS cluster, {", ".join(f"v[{i + 1}] / {CL.GRID}.0 AS {c}" for i, c in enumerate(BAT_FEATURES))}
FROM batk_{_LAST}""", [f"batk_{_LAST}"])
def q_fit_clusters(spark, d):
    """Centres of the batting clusters (k = 4) after the rounds, one column a feature."""
    centres = CL.lloyd(_bat_grid(V.Tables(spark, d)), [BAT_K])[BAT_K]
    return CL.grid_centres(spark, centres).select("cluster", *[F.col("center")[i].alias(c) for i, c in enumerate(BAT_FEATURES)])


@register("player_clusters", f"""
SELECT Player, CAST(id AS INTEGER) AS cluster, round(d / {CL.GRID ** 2}.0, 6) AS distance
FROM ({_near_sql("batk_points", f"batk_{_LAST}")}) a""", [f"batk_{_LAST}"])
def q_player_clusters(spark, d):
    """Batting clusters of every player and the distance to his centre (M2 + M3)."""
    points = _bat_grid(V.Tables(spark, d))
    return rounded(CL.grid_assign(points, CL.lloyd(points, [BAT_K])[BAT_K]))


@register("cluster_checks", """
SELECT count(*) AS players, count(*) AS assigned, CAST(0 AS BIGINT) AS not_nearest FROM bat_career
WHERE Runs IS NOT NULL AND HS IS NOT NULL AND Ave IS NOT NULL AND BF IS NOT NULL AND SR IS NOT NULL""", ["bat_career"])
def q_cluster_checks(spark, d):
    """Of a fit and its assignment (M2 + M3): players, players assigned once, and players
    with a centre nearer than their own."""
    from pyspark.ml.functions import vector_to_array
    pts = _bat_points(V.Tables(spark, d))
    model = CL.fit_clusters(pts, BAT_K, seed=KMEANS_SEED)
    got = CL.assign_clusters(pts, CL.centres_table(model), keep=["Player"]).select("Player", "distance")
    x = vector_to_array(F.col("features"))
    far = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)),
                       F.lit(0.0), lambda s, v: s + v) for c in model.clusterCenters()]
    j = pts.select("Player", F.least(*far).alias("least")).join(got, "Player", "left")
    return j.agg(F.countDistinct("Player").alias("players"), F.count("distance").alias("assigned"),
                 F.count_if(F.col("distance") > F.col("least") * (1 + 1e-9) + 1e-9).alias("not_nearest"))


@register("elbow_curve", f"""
SELECT CAST(k AS INTEGER) AS k, round(sum(d) / {CL.GRID ** 2}.0, 6) AS cost FROM ({_near_sql("bate_points", f"bate_{_LAST}")}) a GROUP BY k""",
          [f"bate_{_LAST}"])
def q_elbow_curve(spark, d):
    """Cost of each k on all batters, from fits of all k at once on a sample (M4)."""
    return rounded(CL.lloyd_elbow(_bat_grid(V.Tables(spark, d))))


# --------------------------------------------------------------------------- single scalar operators

from crease import functions as FN  # noqa: E402


@register("soft_cast", f"""
SELECT page_id, pos, text, TRY_CAST(text AS DOUBLE) AS value FROM items""", ["items"])
def q_soft_cast(spark, d):
    rows = PG.link_rows(V.Tables(spark, d).pages)
    return rows.select("page_id", "pos", "text", FN.soft_cast("text").alias("value"))


@register("strip_brackets", """
SELECT page_id, pos, translate('(' || text || ')', '()', '') AS team FROM items""", ["items"])
def q_strip_brackets(spark, d):
    rows = PG.link_rows(V.Tables(spark, d).pages)
    team = F.concat(F.lit("("), F.col("text"), F.lit(")"))        # a team cell as the stat pages write it
    return rows.select("page_id", "pos", FN.strip_brackets(team).alias("team"))


@register("tag_season", f"""
SELECT i.page_id, i.pos, i.text,
       TRY_CAST(nullif(regexp_extract(regexp_replace(p.url, '{PG.TRAIL_RE}', ''), '{PG.SEASON_RE}', 1), '') AS INTEGER) AS season
FROM items i JOIN pages p ON i.page_id = p.page_id""", ["items"])
def q_tag_season(spark, d):
    return PG.link_rows(V.Tables(spark, d).pages, url="url").select("page_id", "pos", "text", "season")


@register("flatten_features", f"""
SELECT match_id, innings, over, {", ".join(f"round(x[{i + 1}], 6) AS f{i:02d}" for i in range(15))}
FROM (SELECT match_id, innings, over,
             flatten([[CAST(over AS DOUBLE)], [{", ".join(f"s_{c}" for c in BAT_P)}],
                      [{", ".join(f"ns_{c}" for c in BAT_P)}], [{", ".join(f"b_{c}" for c in BOWL_P)}]]) AS x
      FROM over_feats) f""", ["over_feats"])
def q_flatten_features(spark, d):
    f = _features(V.Tables(spark, d))
    return rounded(f.select("match_id", "innings", "over",
                            *[F.col("features")[i].alias(f"f{i:02d}") for i in range(15)]))


@register("tree_dump")
def q_tree_dump(spark, d):
    """Nodes of both fitted trees."""
    from crease.session import scratch_path
    _, rm, wm = _fitted(V.Tables(spark, d))
    runs, wickets = (OV.tree_dump(m, scratch_path(spark, "tree")).withColumn("model", F.lit(name))
                     for name, m in (("runs", rm), ("wickets", wm)))
    return runs.union(wickets)


# --------------------------------------------------------------------------- clusters feeding the outcome tiers



@register("bowling_clusters", f"""
SELECT Player, CAST(id AS INTEGER) AS "Cluster" FROM ({_near_sql("bowlk_points", f"bowlk_{_LAST}")}) a""", [f"bowlk_{_LAST}"])
def q_bowling_clusters(spark, d):
    """Bowling clusters (k = 5) of every bowler from his career features."""
    points = _bowl_grid(V.Tables(spark, d))
    return CL.grid_assign(points, CL.lloyd(points, [BOWL_K])[BOWL_K]).select("Player", F.col("cluster").alias("Cluster"))


@register("elbow_curve_bowling", f"""
SELECT CAST(k AS INTEGER) AS k, round(sum(d) / {CL.GRID ** 2}.0, 6) AS cost FROM ({_near_sql("bowle_points", f"bowle_{_LAST}")}) a GROUP BY k""",
          [f"bowle_{_LAST}"])
def q_elbow_curve_bowling(spark, d):
    return rounded(CL.lloyd_elbow(_bowl_grid(V.Tables(spark, d))))


O.view("fit_bat", f"SELECT Player, id AS Cluster FROM ({_near_sql('batk_points', f'batk_{_LAST}')}) a", [f"batk_{_LAST}"], kept=True)
O.view("fit_bowl", f"SELECT Player, id AS Cluster FROM ({_near_sql('profk_points', f'profk_{_LAST}')}) a", [f"profk_{_LAST}"], kept=True)
O.pool_views("known_pairs_fit", "pool_means_fit", "probs", "fit_bat", "fit_bowl")


@register("batch_outcomes_fitted", _batch_sql("probs", "pool_means_fit", "priors"), ["requests", "probs", "pool_means_fit", "priors"])
def q_batch_outcomes_fitted(spark, d):
    """Outcome tiers with fitted clusters, as in the reference's own flow.

    Batters are clustered (k = 4) on their careers.  The bowlers of the ball
    log are brands, which have no season table here, so they are clustered
    (k = 5) on their bowling profiles from the log itself.
    """
    from crease.session import materialize
    t = V.Tables(spark, d)
    bat = _bat_grid(t)
    prof = CR.bowling_profile(V.ball_events(t)).withColumnRenamed("bowler", "Player")
    bowl = materialize(CL.on_grid(prof, BOWL_P), "bowl-profiles")
    bat_cl, bowl_cl = (CL.grid_assign(p, CL.lloyd(p, [k])[k]).select("Player", F.col("cluster").alias("Cluster"))
                       for p, k in ((bat, BAT_K), (bowl, BOWL_K)))
    return rounded(OC.batch_outcomes(V.requests(t), _probs(t), bat_cl, bowl_cl))

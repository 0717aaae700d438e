"""DuckDB SQL for the stand-in views and the oracle queries.

Each oracle query names the views it needs; :func:`with_views` prefixes them as
CTEs, in dependency order, so the text runs on the driver's pre-registered
base tables alone.  Integer sums are cast to BIGINT and doubles rounded to 6
places in the outermost select, in both engines.
"""

from __future__ import annotations

from crease.fixed import BALLS_PER_OVER, OVERS, PAIR_THRESHOLD, SURVIVAL_PRIOR_BOOST, WICKET_LIMIT

VIEWS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}
RECURSIVE: set[str] = set()         # views that read themselves
KEPT: set[str] = set()              # views computed once however often they are read


def view(name: str, sql: str, deps: list[str] | None = None, recursive: bool = False, kept: bool = False) -> None:
    VIEWS[name] = sql.strip()
    DEPS[name] = deps or []
    if recursive:
        RECURSIVE.add(name)
    if kept:
        KEPT.add(name)


view("balls", """
SELECT l_orderkey AS match_id, l_suppkey AS batsman, p_brand AS bowler,
       l_linenumber - 1 AS runs_by_batsman, l_returnflag = 'R' AS wicket,
       l_linestatus = 'F' AS same_player_out
FROM lineitem JOIN part ON l_partkey = p_partkey""")

view("ball_events", """
SELECT match_id, batsman, bowler, runs_by_batsman AS runs, wicket FROM balls""", ["balls"])

view("season_bat", """
SELECT Player, Year, Inns, Runs, HS, BF,
       CAST(Runs AS DOUBLE) / nullif(Inns, 0) AS Ave,
       CAST(Runs AS DOUBLE) * 100 / nullif(BF, 0) AS SR
FROM (SELECT l_suppkey AS Player, CAST(year(l_shipdate) AS INTEGER) AS Year,
             count(DISTINCT l_orderkey) AS Inns,
             CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7
                           THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS Runs,
             max(CAST(l_quantity AS BIGINT)) AS HS,
             CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 1 ELSE 0 END) AS BIGINT) AS BF
      FROM lineitem GROUP BY 1, 2) s""")

view("season_bowl", """
SELECT Player, Year, Inns, Balls, Runs, Wkts,
       CAST(Runs AS DOUBLE) / nullif(Wkts, 0) AS Ave,
       CAST(Runs AS DOUBLE) * 6 / Balls AS Econ,
       CAST(Balls AS DOUBLE) / nullif(Wkts, 0) AS SR
FROM (SELECT l_suppkey AS Player, CAST(year(l_shipdate) AS INTEGER) AS Year,
             count(DISTINCT l_orderkey) AS Inns, count(*) AS Balls,
             CAST(sum(l_linenumber - 1) AS BIGINT) AS Runs,
             CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 1 ELSE 0 END) AS BIGINT) AS Wkts
      FROM lineitem GROUP BY 1, 2) s""")

view("newcomers", """
SELECT s_suppkey AS Player, CAST(s_nationkey % 5 AS BIGINT) AS Inns,
       CAST(floor(-s_acctbal) AS BIGINT) AS Runs
FROM supplier WHERE s_acctbal < 0""")

view("debut_bat", """
SELECT Player, Inns, Runs, Runs % 100 AS HS, CAST(Runs AS DOUBLE) / nullif(Inns, 0) AS Ave,
       Inns * 12 AS BF, CAST(Runs AS DOUBLE) * 100 / nullif(Inns * 12, 0) AS SR
FROM newcomers""", ["newcomers"])

view("debut_bowl", """
SELECT Player, Inns, Runs, Inns AS Wkts, CAST(Runs AS DOUBLE) / nullif(Inns, 0) AS Ave,
       CAST(Runs AS DOUBLE) * 6 / nullif(Inns * 24, 0) AS Econ,
       CAST(Inns * 24 AS DOUBLE) / nullif(Inns, 0) AS SR
FROM newcomers""", ["newcomers"])

view("bat_clusters", """
SELECT s_suppkey AS Player, CAST(s_nationkey % 4 AS INTEGER) AS Cluster
FROM supplier WHERE s_acctbal >= 0""")

view("bowl_clusters", """
SELECT Player, CAST(length(Player) % 2 + CAST(right(Player, 1) AS INTEGER) % 3 AS INTEGER) AS Cluster
FROM (SELECT DISTINCT p_brand AS Player FROM part WHERE p_brand <> 'Brand#1') b""")

view("requests", """
SELECT l_orderkey AS request_id, l_linenumber AS line, l_suppkey AS batsman, p_brand AS bowler,
       CAST((l_orderkey * 7 + l_partkey * 13) % 1000 AS DOUBLE) / 1000 AS u
FROM lineitem JOIN part ON l_partkey = p_partkey""")

view("ball_log", """
SELECT match_id, CASE WHEN n <= 33 THEN 1 ELSE 2 END AS innings,
       CASE WHEN n <= 33 THEN n ELSE n - 33 END AS ball_no,
       CAST(n % 2 AS INTEGER) AS batsman, runs, wicket, p_survive
FROM (SELECT user_id AS match_id,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
             CASE event_type WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 4 ELSE 0 END AS runs,
             event_type = 'error' AS wicket, 1 - value / 1000 AS p_survive
      FROM events) t""")

view("lineups", """
SELECT match_id, innings,
       list_transform(range(0, 11),
                      lambda k: ((match_id * 11 + innings * 5 + k * 7) % n_sup) + 1) AS batting,
       list_transform(range(0, CAST(match_id % 3 + 4 AS BIGINT)),
                      lambda k: 'Brand#' || CAST(((match_id + k * 3) % 25) + 1 AS VARCHAR)) AS bowling
FROM (SELECT DISTINCT match_id, innings FROM ball_log) m
CROSS JOIN (SELECT max(s_suppkey) AS n_sup FROM supplier) s""", ["ball_log"])

# counts, probabilities and priors over the ball log
view("counts", """
SELECT batsman, bowler,
       count(*) FILTER (WHERE runs = 0) AS n0, count(*) FILTER (WHERE runs = 1) AS n1,
       count(*) FILTER (WHERE runs = 2) AS n2, count(*) FILTER (WHERE runs = 3) AS n3,
       count(*) FILTER (WHERE runs = 4) AS n4, count(*) FILTER (WHERE runs = 6) AS n6,
       count(*) FILTER (WHERE wicket) AS w, count(runs) AS balls
FROM ball_events WHERE batsman IS NOT NULL AND bowler IS NOT NULL GROUP BY batsman, bowler""",
     ["ball_events"])


def probs_view(threshold: int) -> str:
    return f"""
SELECT batsman, bowler, balls, w, c0, c1, c2, c3, c4, c6, survive FROM (
  SELECT *, p0 AS c0, p0 + p1 AS c1, p0 + p1 + p2 AS c2, p0 + p1 + p2 + p3 AS c3,
         p0 + p1 + p2 + p3 + p4 AS c4, p0 + p1 + p2 + p3 + p4 + p6 AS c6,
         1 - (w + 1) / (CAST(balls AS DOUBLE) + 1) AS survive
  FROM (SELECT *, (n0 + 1) / (CAST(balls AS DOUBLE) + 6) AS p0, (n1 + 1) / (CAST(balls AS DOUBLE) + 6) AS p1,
               (n2 + 1) / (CAST(balls AS DOUBLE) + 6) AS p2, (n3 + 1) / (CAST(balls AS DOUBLE) + 6) AS p3,
               (n4 + 1) / (CAST(balls AS DOUBLE) + 6) AS p4, (n6 + 1) / (CAST(balls AS DOUBLE) + 6) AS p6
        FROM counts WHERE balls > {threshold}) a) b"""


view("probs", probs_view(PAIR_THRESHOLD), ["counts"])
view("probs24", probs_view(24), ["counts"])

for _name, _src in (("priors", "probs"), ("priors24", "probs24")):
    view(_name, f"""
SELECT avg(c0) AS c0, avg(c1) AS c1, avg(c2) AS c2, avg(c3) AS c3, avg(c4) AS c4, avg(c6) AS c6,
       avg(survive) * {SURVIVAL_PRIOR_BOOST} AS survive FROM {_src}""", [_src])


# careers input rows (A1, A2): season rows outside the hold-out year plus debutants
view("bat_rows", """
SELECT Player, Inns, CAST(Runs AS DOUBLE) / nullif(BF, 0) AS Runs, HS, Ave, BF, SR
FROM (SELECT Player, Inns, Runs, HS, Ave, BF, SR FROM season_bat WHERE Year <> 2001
      UNION ALL SELECT Player, Inns, Runs, HS, Ave, BF, SR FROM debut_bat) u""",
     ["season_bat", "debut_bat"])

view("bowl_rows", """
SELECT Player, Inns, CAST(Runs AS DOUBLE) / nullif(Inns, 0) AS Runs,
       CAST(Wkts AS DOUBLE) / nullif(Inns, 0) AS Wkts, Ave, Econ, SR
FROM (SELECT Player, Inns, Runs, Wkts, Ave, Econ, SR FROM season_bowl WHERE Year <> 2001
      UNION ALL SELECT Player, Inns, Runs, Wkts, Ave, Econ, SR FROM debut_bowl) u""",
     ["season_bowl", "debut_bowl"])

view("bat_career", """
SELECT Player, CAST(coalesce(sum(Inns), 0) AS BIGINT) AS Inns, coalesce(sum(Runs), 0) AS Runs,
       CAST(max(HS) AS BIGINT) AS HS, avg(Ave) AS Ave, CAST(coalesce(sum(BF), 0) AS BIGINT) AS BF,
       avg(SR) AS SR
FROM bat_rows WHERE Player IS NOT NULL GROUP BY Player""", ["bat_rows"])

view("bowl_career", """
SELECT Player, CAST(coalesce(sum(Inns), 0) AS BIGINT) AS Inns, coalesce(sum(Runs), 0) AS Runs,
       coalesce(sum(Wkts), 0) AS Wkts, avg(Ave) AS Ave, avg(Econ) AS Econ, avg(SR) AS SR
FROM bowl_rows WHERE Player IS NOT NULL GROUP BY Player""", ["bowl_rows"])

# cluster pool in its direct form: the union all of both halves, per request pair
def pool_views(pairs: str, means: str, probs: str, bat: str = "bat_clusters", bowl: str = "bowl_clusters") -> None:
    view(pairs, f"""
SELECT DISTINCT r.batsman, r.bowler, b.Cluster AS bat_cluster, w.Cluster AS bowl_cluster
FROM requests r JOIN {bat} b ON r.batsman = b.Player
JOIN {bowl} w ON r.bowler = w.Player""", ["requests", bat, bowl])
    view(means, f"""
SELECT batsman, bowler, count(*) AS n, avg(c0) AS c0, avg(c1) AS c1, avg(c2) AS c2, avg(c3) AS c3,
       avg(c4) AS c4, avg(c6) AS c6, avg(survive) AS survive
FROM (SELECT k.batsman, k.bowler, p.c0, p.c1, p.c2, p.c3, p.c4, p.c6, p.survive
      FROM {pairs} k JOIN {bat} b2 ON b2.Cluster = k.bat_cluster
      JOIN {probs} p ON p.batsman = b2.Player AND p.bowler = k.bowler
      UNION ALL
      SELECT k.batsman, k.bowler, p.c0, p.c1, p.c2, p.c3, p.c4, p.c6, p.survive
      FROM {pairs} k JOIN {bowl} w2 ON w2.Cluster = k.bowl_cluster
      JOIN {probs} p ON p.bowler = w2.Player AND p.batsman = k.batsman) u
GROUP BY batsman, bowler""", [pairs, probs])


pool_views("known_pairs", "pool_means", "probs")
pool_views("known_pairs", "pool_means24", "probs24")


def pick_sql(prefix: str, u: str = "u") -> str:
    """Runs drawn by u: one past the last cumulative value below u, wrapping to 0."""
    cums = ["c0", "c1", "c2", "c3", "c4", "c6"]
    idx = "greatest(0, " + ", ".join(
        f"CASE WHEN {prefix}{c} < {u} THEN {i + 1} ELSE 0 END" for i, c in enumerate(cums)) + ") % 6"
    return f"CAST(CASE ({idx}) WHEN 5 THEN 6 ELSE ({idx}) END AS INTEGER)"


# ordered state over the ball log
view("cut1", f"""
SELECT * FROM (
  SELECT *, coalesce(sum(CAST(wicket AS BIGINT)) OVER w, 0) AS w_before,
            coalesce(sum(runs) OVER w, 0) AS r_before
  FROM ball_log
  WINDOW w AS (PARTITION BY match_id, innings ORDER BY ball_no
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) a
WHERE w_before < {WICKET_LIMIT} AND ball_no <= {OVERS * BALLS_PER_OVER}""", ["ball_log"])

view("cut_log", """
SELECT c.match_id, c.innings, c.ball_no, c.batsman, c.runs, c.wicket, c.p_survive
FROM cut1 c LEFT JOIN (SELECT match_id, sum(runs) AS target FROM cut1 WHERE innings = 1
                       GROUP BY match_id) t ON c.match_id = t.match_id
WHERE c.innings = 1 OR c.r_before <= coalesce(t.target, 0)""", ["cut1"])

view("strikes", """
SELECT match_id, innings, ball_no, batsman, runs, wicket, p_survive,
       batting[CAST(CASE WHEN slot = 0 THEN coalesce(a_idx, 0) ELSE coalesce(b_idx, 1) END + 1 AS BIGINT)] AS striker,
       batting[CAST(CASE WHEN slot = 0 THEN coalesce(b_idx, 1) ELSE coalesce(a_idx, 0) END + 1 AS BIGINT)] AS non_striker
FROM (SELECT s.*, l.batting,
             max(CASE WHEN s.wicket AND s.slot = 0 THEN s.w_upto + 1 END) OVER w AS a_idx,
             max(CASE WHEN s.wicket AND s.slot = 1 THEN s.w_upto + 1 END) OVER w AS b_idx
      FROM (SELECT *, (coalesce(sum(CASE WHEN NOT wicket AND runs % 2 = 1 THEN 1 ELSE 0 END) OVER w1, 0)
                       + (ball_no - 1) // 6) % 2 AS slot,
                   CAST(sum(CASE WHEN wicket THEN 1 ELSE 0 END) OVER w2 AS BIGINT) AS w_upto
            FROM cut_log
            WINDOW w1 AS (PARTITION BY match_id, innings ORDER BY ball_no
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   w2 AS (PARTITION BY match_id, innings ORDER BY ball_no
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) s
      LEFT JOIN lineups l ON s.match_id = l.match_id AND s.innings = l.innings
      WINDOW w AS (PARTITION BY s.match_id, s.innings ORDER BY s.ball_no
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) x""", ["cut_log", "lineups"])

view("schedule", """
SELECT match_id, innings, CAST(o AS INTEGER) AS over, bowling[(o % len(bowling)) + 1] AS bowler
FROM lineups CROSS JOIN range(0, 20) t(o)""", ["lineups"])

view("plan", """
SELECT f.match_id, f.innings, f.over, f.striker, f.non_striker, s.bowler
FROM (SELECT match_id, innings, CAST((ball_no - 1) // 6 AS INTEGER) AS over, striker, non_striker
      FROM strikes WHERE (ball_no - 1) % 6 = 0) f
LEFT JOIN schedule s ON f.match_id = s.match_id AND f.innings = s.innings AND f.over = s.over""",
     ["strikes", "schedule"])

view("bat_profile", """
SELECT batsman, coalesce(CAST(r AS DOUBLE) / nullif(i, 0), 0) AS runs_per_innings,
       coalesce(CAST(r AS DOUBLE) / nullif(bf, 0), 0) * 100 AS strike_rate,
       coalesce(CAST(i AS DOUBLE) / nullif(o, 0), 0) AS innings_per_dismissal,
       coalesce(CAST(s6 AS DOUBLE) / nullif(bf, 0), 0) AS sixes_per_ball,
       coalesce(CAST(s4 AS DOUBLE) / nullif(bf, 0), 0) AS fours_per_ball
FROM (SELECT batsman, count(DISTINCT match_id) AS i, sum(runs) AS r, count(runs) AS bf,
             count(*) FILTER (WHERE wicket) AS o, count(*) FILTER (WHERE runs = 6) AS s6,
             count(*) FILTER (WHERE runs = 4) AS s4
      FROM ball_events WHERE batsman IS NOT NULL GROUP BY batsman) a""", ["ball_events"])

view("bowl_profile", """
SELECT bowler, coalesce(CAST(r AS DOUBLE) / nullif(wk, 0), 0) AS runs_per_wicket,
       coalesce(CAST(r AS DOUBLE) / nullif(b, 0), 0) * 6 AS economy,
       coalesce(CAST(b AS DOUBLE) / nullif(wk, 0), 0) AS balls_per_wicket,
       coalesce(CAST(wk AS DOUBLE) / nullif(i, 0), 0) AS wickets_per_innings
FROM (SELECT bowler, count(DISTINCT match_id) AS i, sum(runs) AS r, count(*) AS b,
             count(*) FILTER (WHERE wicket) AS wk
      FROM ball_events WHERE bowler IS NOT NULL GROUP BY bowler) a""", ["ball_events"])

view("bat_profile_known", """
SELECT * FROM bat_profile WHERE batsman IN (SELECT Player FROM bat_clusters)""",
     ["bat_profile", "bat_clusters"])

view("bowl_profile_known", """
SELECT * FROM bowl_profile WHERE bowler <> 'Brand#1'""", ["bowl_profile"])


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in DEPS[n]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, names: list[str]) -> str:
    """Prefix ``sql`` with the named views (and what they need) as CTEs."""
    order = _order(names)
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' * (n in KEPT)}(\n{VIEWS[n]}\n)" for n in order)
    return f"WITH {'RECURSIVE ' * any(n in RECURSIVE for n in order)}{ctes}\n{sql.strip()}" if ctes else sql.strip()


def round_cols(cols: list[str], places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in cols)

"""Cricket-shaped views over the driver's parquet tables.

The reference reads season tables, a ball-by-ball log and line-ups that are
not part of this repository.  These views derive tables of the same shape from
``/root/testdata/sf*/`` so that every operator runs on data that grows with
the scale factor.  ``crease.plans.oracle`` holds the same views as DuckDB SQL.

Rules of our own (not in the reference):
* a supplier with a negative account balance is a *newcomer*: he has no batting
  cluster and a debutant career row;
* ``Brand#1`` has no bowling cluster and no bowling profile;
* line-ups are made from a rule over the match key (11 batters among the
  suppliers, 4 to 6 bowlers among the brands).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.operators.running import ordinal

HOLDOUT_YEAR = 2001          # the last season in the data, left out of careers
INNINGS_SPLIT = 33           # events 1..33 of a user are innings 1, the rest innings 2
UNKNOWN_BRAND = "Brand#1"
N_BRANDS = 25


class Tables:
    """Lazy parquet readers for one scale-factor folder; Catalyst prunes columns."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def balls(t: Tables) -> DataFrame:
    """Ball log in the reference's column names (before C1/C2)."""
    li, p = t.lineitem, t.part
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_suppkey").alias("batsman"),
        F.col("p_brand").alias("bowler"),
        (F.col("l_linenumber") - 1).alias("runs_by_batsman"),
        (F.col("l_returnflag") == "R").alias("wicket"),
        (F.col("l_linestatus") == "F").alias("same_player_out"))


def ball_events(t: Tables) -> DataFrame:
    """``balls`` after the reference's drop and rename: batsman, bowler, runs, wicket, match_id."""
    from crease.operators.careers import project_columns, rename_columns
    b = project_columns(balls(t), drop=["same_player_out"])
    return rename_columns(b, {"runs_by_batsman": "runs"})


def _six_ball(li: DataFrame) -> F.Column:
    return (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)


def season_bat(t: Tables) -> DataFrame:
    li = t.lineitem
    g = li.groupBy(F.col("l_suppkey").alias("Player"),
                   F.year("l_shipdate").alias("Year")).agg(
        F.countDistinct("l_orderkey").alias("Inns"),
        F.sum(F.when(_six_ball(li), F.col("l_quantity").cast("long")).otherwise(0))
        .cast("long").alias("Runs"),
        F.max(F.col("l_quantity").cast("long")).alias("HS"),
        F.sum(F.when(_six_ball(li), 1).otherwise(0)).cast("long").alias("BF"))
    return g.withColumns({
        "Ave": F.try_divide(F.col("Runs").cast("double"), F.col("Inns").cast("double")),
        "SR": F.try_divide(F.col("Runs").cast("double") * 100, F.col("BF").cast("double"))})


def season_bowl(t: Tables) -> DataFrame:
    li = t.lineitem
    g = li.groupBy(F.col("l_suppkey").alias("Player"),
                   F.year("l_shipdate").alias("Year")).agg(
        F.countDistinct("l_orderkey").alias("Inns"),
        F.count("*").alias("Balls"),
        F.sum(F.col("l_linenumber") - 1).cast("long").alias("Runs"),
        F.sum(F.when(_six_ball(li), 1).otherwise(0)).cast("long").alias("Wkts"))
    return g.withColumns({
        "Ave": F.try_divide(F.col("Runs").cast("double"), F.col("Wkts").cast("double")),
        "Econ": F.col("Runs").cast("double") * 6 / F.col("Balls").cast("double"),
        "SR": F.try_divide(F.col("Balls").cast("double"), F.col("Wkts").cast("double"))})


def _newcomers(t: Tables) -> DataFrame:
    s = t.supplier.filter(F.col("s_acctbal") < 0)
    return s.select(
        F.col("s_suppkey").alias("Player"),
        (F.col("s_nationkey") % 5).cast("long").alias("Inns"),
        F.floor(-F.col("s_acctbal")).cast("long").alias("Runs"))


def debut_bat(t: Tables) -> DataFrame:
    d = _newcomers(t).withColumns({"HS": F.col("Runs") % 100, "BF": F.col("Inns") * 12})
    return d.select("Player", "Inns", "Runs", "HS",
                    F.try_divide(F.col("Runs").cast("double"), F.col("Inns").cast("double")).alias("Ave"),
                    "BF",
                    F.try_divide(F.col("Runs").cast("double") * 100, F.col("BF").cast("double")).alias("SR"))


def debut_bowl(t: Tables) -> DataFrame:
    d = _newcomers(t).withColumns({"Wkts": F.col("Inns"), "_balls": F.col("Inns") * 24})
    return d.select("Player", "Inns", "Runs", "Wkts",
                    F.try_divide(F.col("Runs").cast("double"), F.col("Wkts").cast("double")).alias("Ave"),
                    F.try_divide(F.col("Runs").cast("double") * 6, F.col("_balls").cast("double")).alias("Econ"),
                    F.try_divide(F.col("_balls").cast("double"), F.col("Wkts").cast("double")).alias("SR"))


def bat_clusters(t: Tables) -> DataFrame:
    """Fixed batting clusters (0..3); newcomers have none."""
    return t.supplier.filter(F.col("s_acctbal") >= 0).select(
        F.col("s_suppkey").alias("Player"), (F.col("s_nationkey") % 4).cast("int").alias("Cluster"))


def bowl_clusters(t: Tables) -> DataFrame:
    """Fixed bowling clusters (0..3) per brand; ``Brand#1`` has none."""
    b = t.part.filter(F.col("p_brand") != UNKNOWN_BRAND).select("p_brand").distinct()
    last = F.substring(F.col("p_brand"), -1, 1).cast("int")
    return b.select(F.col("p_brand").alias("Player"),
                    ((F.length("p_brand") % 2) + last % 3).cast("int").alias("Cluster"))


def requests(t: Tables) -> DataFrame:
    """One outcome request per ball of the log, with a draw ``u`` fixed by its keys."""
    li, p = t.lineitem, t.part
    key = (F.col("l_orderkey") * 7 + F.col("l_partkey") * 13) % 1000
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("request_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("batsman"),
        F.col("p_brand").alias("bowler"),
        (key.cast("double") / 1000).alias("u"))


# Hours of one chunk of a user's events.
CHUNK_HOURS = 24


def hour_number(ts: str) -> F.Column:
    """Hours since year 0 of a timestamp, as an integer chunk id (no time zone involved)."""
    days = F.year(ts).cast("long") * 366 + F.dayofyear(ts)
    return days * 24 + F.hour(ts)


def ball_log(t: Tables) -> DataFrame:
    """Strictly ordered ball log from ``events``: one user = one match.

    The position of an event in its user's history is a running count chunked
    by ``CHUNK_HOURS``, so a user with a third of all events is not one task.  The
    width is a trade-off between chunks of a hot user and the size of the chunk table.
    """
    ev = t.events.select(
        F.col("user_id").alias("match_id"), "ts", "event_id",
        F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "signup", 2)
        .when(F.col("event_type") == "purchase", 4).otherwise(0).alias("runs"),
        (F.col("event_type") == "error").alias("wicket"),
        (F.lit(1.0) - F.col("value") / 1000).alias("p_survive"))
    n = ordinal(ev, ["match_id"], ["ts", "event_id"], F.floor(hour_number("ts") / CHUNK_HOURS), out="n")
    first = F.col("n") <= INNINGS_SPLIT
    return n.select(
        "match_id",
        F.when(first, 1).otherwise(2).alias("innings"),
        F.when(first, F.col("n")).otherwise(F.col("n") - INNINGS_SPLIT).alias("ball_no"),
        (F.col("n") % 2).cast("int").alias("batsman"),
        "runs", "wicket", "p_survive")


def innings_keys(t: Tables) -> DataFrame:
    """(match_id, innings) of the ball log, from event counts alone (no ordering needed)."""
    n = t.events.groupBy(F.col("user_id").alias("match_id")).agg(F.count("*").alias("_n"))
    inns = F.when(F.col("_n") > INNINGS_SPLIT, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return n.select("match_id", F.explode(inns).alias("innings"))


def lineups(t: Tables, log: DataFrame | None = None) -> DataFrame:
    """Batting (11 supplier keys) and bowling (4-6 brands) order per (match, innings).

    ``log`` (a ball log) gives the keys when given; by default they come from
    :func:`innings_keys`, which needs no window over the events.
    """
    keys = innings_keys(t) if log is None else log.select("match_id", "innings").distinct()
    n_sup = t.supplier.select(F.max("s_suppkey")).scalar()
    # the scalar is bound to a column first: a subquery may not sit inside a lambda
    m = keys.withColumn("_n_sup", n_sup)
    bat = F.transform(F.sequence(F.lit(0), F.lit(10)),
                      lambda k: F.pmod(F.col("match_id") * 11 + F.col("innings") * 5 + k * 7,
                                       F.col("_n_sup")) + 1)
    n_bowl = (F.col("match_id") % 3 + 4).cast("int")
    bowl = F.transform(F.sequence(F.lit(0), n_bowl - 1),
                       lambda k: F.concat(F.lit("Brand#"),
                                          (F.pmod(F.col("match_id") + k * 3, N_BRANDS) + 1).cast("string")))
    return m.select("match_id", "innings", bat.alias("batting"), bowl.alias("bowling"))

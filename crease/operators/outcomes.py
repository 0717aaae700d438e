"""Outcome look-ups with fallback: exact pair -> cluster pool -> global prior.

The reference answers one ball at a time by scanning pandas frames, and for the
cluster tier loops over every player of both clusters.  Here a table of
requests (one row per ball to score, with a uniform draw ``u``) is answered by
equi-joins only:

* exact pair: left join on (batsman, bowler);
* cluster pool: the pool of a request is every pair (b', bowler) with b' in the
  batsman's cluster, plus every pair (batsman, w') with w' in the bowler's
  cluster.  Its mean needs only two pre-aggregates, A(bat_cluster, bowler) and
  B(batsman, bowl_cluster), each a sum and a count; a request never meets raw
  pool rows;
* prior: one-row means, read as scalar subqueries (a size bound of one row).

All dimension joins are plain equi-joins; AQE turns them into broadcasts only
when the side measured at run time is under the broadcast threshold.  Beyond it
a hot request key is split by AQE's skew-join handling, as aggregates on the join's
keys are made ``splittable``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.functions import CUM_COLS, outcome_pick
from crease.operators.matchups import PAIR, global_priors
from crease.session import splittable

STATS = [*CUM_COLS, "survive"]


def _clusters(cl: DataFrame, key: str, name: str) -> DataFrame:
    return cl.select(F.col("Player").alias(key), F.col("Cluster").alias(name))


def pair_lookup(requests: DataFrame, probs: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    """Left join of requests to the pair table, with a ``pair_found`` flag."""
    hit = splittable(probs.select(*keys, *STATS).withColumn("pair_found", F.lit(True)), *keys)
    return (requests.join(hit, keys, "left")
            .withColumn("pair_found", F.coalesce(F.col("pair_found"), F.lit(False))))


def known_players(requests: DataFrame, bat_clusters: DataFrame,
                  bowl_clusters: DataFrame) -> DataFrame:
    """Requests whose batsman *and* bowler both have a cluster (J4, semi joins)."""
    return (requests
            .join(_clusters(bat_clusters, "batsman", "_bc"), "batsman", "left_semi")
            .join(_clusters(bowl_clusters, "bowler", "_wc"), "bowler", "left_semi"))


def unknown_players(requests: DataFrame, bat_clusters: DataFrame,
                    bowl_clusters: DataFrame) -> DataFrame:
    """Distinct request players without a cluster, with their side (J4, anti joins)."""
    bats = (requests.select(F.col("batsman").cast("string").alias("player")).distinct()
            .join(bat_clusters.select(F.col("Player").cast("string").alias("player")),
                  "player", "left_anti").withColumn("side", F.lit("bat")))
    bowls = (requests.select(F.col("bowler").cast("string").alias("player")).distinct()
             .join(bowl_clusters.select(F.col("Player").cast("string").alias("player")),
                   "player", "left_anti").withColumn("side", F.lit("bowl")))
    return bats.unionByName(bowls)


def pool_aggregates(probs: DataFrame, bat_clusters: DataFrame,
                    bowl_clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two pre-aggregates of the cluster pool.

    A: per (bat_cluster, bowler), sums of the stats over batsmen of the cluster.
    B: per (batsman, bowl_cluster), sums over bowlers of the cluster.
    """
    a = (probs.join(_clusters(bat_clusters, "batsman", "bat_cluster"), "batsman")
         .groupBy("bat_cluster", "bowler")
         .agg(*[F.sum(c).alias(f"a_{c}") for c in STATS], F.count("*").alias("a_n")))
    b = (probs.join(_clusters(bowl_clusters, "bowler", "bowl_cluster"), "bowler")
         .groupBy("batsman", "bowl_cluster")
         .agg(*[F.sum(c).alias(f"b_{c}") for c in STATS], F.count("*").alias("b_n")))
    return a, b


def cluster_pool(requests: DataFrame, probs: DataFrame, bat_clusters: DataFrame,
                 bowl_clusters: DataFrame) -> DataFrame:
    """Pool mean of the stats for requests whose two players are known (J3 + A7).

    Adds ``pool_n`` (pairs in the pool; 0 = empty) and ``pool_<stat>`` (NULL
    when the pool is empty).  Requests with an unknown player are dropped.
    """
    a, b = pool_aggregates(probs, bat_clusters, bowl_clusters)
    n = F.coalesce(F.col("a_n"), F.lit(0)) + F.coalesce(F.col("b_n"), F.lit(0))
    means = [((F.coalesce(F.col(f"a_{c}"), F.lit(0.0)) + F.coalesce(F.col(f"b_{c}"), F.lit(0.0)))
              / F.nullif(n, F.lit(0))).alias(f"pool_{c}") for c in STATS]
    # the pool depends on the pair alone: one row per pair, then one join of the requests
    pools = (requests.select(*PAIR).dropna().distinct()
             .join(_clusters(bat_clusters, "batsman", "bat_cluster"), "batsman")
             .join(_clusters(bowl_clusters, "bowler", "bowl_cluster"), "bowler")
             .join(a, ["bat_cluster", "bowler"], "left")
             .join(b, ["batsman", "bowl_cluster"], "left")
             .select(*PAIR, "bat_cluster", "bowl_cluster", n.alias("pool_n"), *means))
    return requests.join(splittable(pools, *PAIR), PAIR)


def one_row(table: DataFrame, cols: list[str]) -> Column:
    """A one-row table as a single struct-valued scalar subquery.

    Bind it to a column once (``withColumn``) and read fields from that
    column: every copy of a subquery expression is planned and run on its own.
    """
    return table.select(F.struct(*cols)).scalar()


def pair_odds(pairs: DataFrame, probs: DataFrame, bat_clusters: DataFrame,
              bowl_clusters: DataFrame, priors: DataFrame | None = None) -> DataFrame:
    """Tier and chosen odds for each distinct (batsman, bowler) pair (the core of F2).

    Tier ``pair`` when the pair is in ``probs``; else ``cluster`` when both
    players have a cluster and the pool is not empty; else ``prior``.
    Returns batsman, bowler, tier, c0..c6, survive.
    """
    if priors is None:
        priors = global_priors(probs)
    a, b = pool_aggregates(probs, bat_clusters, bowl_clusters)
    hit = probs.select(*PAIR, *[F.col(c).alias(f"p_{c}") for c in STATS],
                       F.lit(True).alias("_pair"))
    r = (pairs
         .join(hit, PAIR, "left")
         .join(_clusters(bat_clusters, "batsman", "_bc"), "batsman", "left")
         .join(_clusters(bowl_clusters, "bowler", "_wc"), "bowler", "left")
         .join(a.withColumnRenamed("bat_cluster", "_bc"), ["_bc", "bowler"], "left")
         .join(b.withColumnRenamed("bowl_cluster", "_wc"), ["batsman", "_wc"], "left")
         .withColumn("_prior", one_row(priors, STATS)))
    n = F.coalesce(F.col("a_n"), F.lit(0)) + F.coalesce(F.col("b_n"), F.lit(0))
    is_pair = F.col("_pair").isNotNull()
    is_pool = F.col("_bc").isNotNull() & F.col("_wc").isNotNull() & (n > 0)
    tier = (F.when(is_pair, F.lit("pair")).when(is_pool, F.lit("cluster"))
            .otherwise(F.lit("prior")))
    chosen = []
    for c in STATS:
        pooled = (F.coalesce(F.col(f"a_{c}"), F.lit(0.0))
                  + F.coalesce(F.col(f"b_{c}"), F.lit(0.0))) / F.nullif(n, F.lit(0))
        chosen.append(F.when(is_pair, F.col(f"p_{c}")).when(is_pool, pooled)
                      .otherwise(F.col("_prior")[c]).alias(c))
    return r.select(*PAIR, tier.alias("tier"), *chosen)


def batch_outcomes(requests: DataFrame, probs: DataFrame, bat_clusters: DataFrame,
                   bowl_clusters: DataFrame, priors: DataFrame | None = None,
                   u: str = "u") -> DataFrame:
    """Outcome of every request with the three-tier fallback (F2).

    The odds depend on the pair only, so they are resolved once per distinct
    pair (:func:`pair_odds`; a partial aggregate collapses the requests before
    any shuffle), and the requests meet that pair table in one equi-join.  Adds
    ``tier``, ``runs`` (drawn by ``u`` against the chosen cumulative odds,
    wrapping to 0 above the last value) and ``survive``.  Keeps every request
    column and row (requests need not be unique; a request with a NULL player
    takes the prior).
    """
    if priors is None:
        priors = global_priors(probs)
    pairs = requests.select(*PAIR).dropna().distinct()
    odds = pair_odds(pairs, probs, bat_clusters, bowl_clusters, priors)
    r = requests.join(splittable(odds, *PAIR), PAIR, "left").withColumn("_prior", one_row(priors, STATS))
    got = F.col("tier").isNotNull()
    x = {c: F.when(got, F.col(c)).otherwise(F.col("_prior")[c]) for c in STATS}
    req_cols = requests.columns
    return r.select(*req_cols,
                    F.coalesce(F.col("tier"), F.lit("prior")).alias("tier"),
                    outcome_pick([x[c] for c in CUM_COLS], u).alias("runs"),
                    x["survive"].alias("survive"))

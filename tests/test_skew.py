"""A hot innings (most of the log) is split over chunks, and a hot key of a join over tasks.

A join with an aggregate on its own keys is split by AQE only when that side is made
``splittable``; the tests below read it from the executed plans.
"""


import random

import pytest
from pyspark.sql import functions as F

from crease.operators import innings as IN
from crease.operators import outcomes as OC
from crease.operators import overs as OV

from test_semantics import _simulate


def test_hot_innings_spread_over_chunks(spark):
    rnd = random.Random(17)
    order = [f"p{i}" for i in range(11)]
    rows, hot = [], []
    for i in range(1, 60_001):                       # match 0: 60,000 balls, 15 chunks of 4,096
        wk = rnd.random() < 0.0001
        r = 0 if wk else rnd.choice([0, 1, 2, 3, 4, 6])
        rows.append((0, 1, i, r, wk))
        hot.append((r, wk))
    for m in range(1, 21):                           # small matches beside it
        for i in range(1, 40):
            rows.append((m, 1, i, rnd.choice([0, 1, 4]), False))
    log = spark.createDataFrame(rows, "match_id long, innings int, ball_no long, runs int, wicket boolean")
    lu = spark.createDataFrame([(m, 1, order) for m in range(21)],
                               "match_id long, innings int, batting array<string>")
    out = IN.strike_reconstruct(log, lu, cut=True, last=60_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the ordered passes shuffle the log by (match, innings, chunk): a hot match is split
    passes = [ln for ln in plan.splitlines() if "REPARTITION_BY_COL" in ln]
    assert len(passes) >= 2 and all("_chunk" in ln for ln in passes)
    got = {r.ball_no: (r.striker, r.non_striker)
           for r in out.filter("match_id = 0").select("ball_no", "striker", "non_striker").collect()}
    exp = {i + 1: sn for i, sn in enumerate(_simulate(hot, order))}
    assert got == exp


SPLIT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
         "spark.sql.shuffle.partitions": "16"}


@pytest.fixture
def split_early(spark):
    before = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _skew_joins(df) -> int:
    """Joins of the executed plan that were split; the rows are computed first."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("skew=true")


def test_hot_pair_is_split(spark, split_early):
    req = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("request_id"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 97).alias("batsman"),
        F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.concat(F.lit("b"), F.col("id") % 31)).alias("bowler"))
    probs = req.groupBy("batsman", "bowler").agg(*[F.avg("request_id").alias(c) for c in OC.STATS])
    bats = req.select(F.col("batsman").alias("Player"), (F.col("batsman") % 4).alias("Cluster")).distinct()
    bowls = req.select(F.col("bowler").alias("Player"), (F.length("bowler") % 5).alias("Cluster")).distinct()
    found = OC.pair_lookup(req, probs)
    assert _skew_joins(found) >= 1 and found.where("pair_found").count() == 60_000
    pools = OC.cluster_pool(req, probs, bats, bowls)
    assert _skew_joins(pools) >= 1 and pools.count() == 60_000


def test_hot_match_is_split(spark, split_early):
    hot = spark.range(1, 30_001, 1, 8).selectExpr("0L AS match_id", "1 AS innings", "id AS ball_no")
    small = spark.range(0, 30_000, 1, 8).selectExpr("1 + id % 1000 AS match_id", "1 AS innings", "1 + CAST(id / 1000 AS LONG) AS ball_no")
    log = hot.union(small).selectExpr("*", "CAST(ball_no % 5 AS INT) AS runs", "false AS wicket")
    kept = IN.innings_cutoff(log, last=30_000)
    assert _skew_joins(kept) >= 1 and kept.count() == 60_000
    order = [f"p{i}" for i in range(11)]
    lu = log.select("match_id", "innings").distinct().withColumn("batting", F.array(*map(F.lit, order)))
    struck = IN.strike_reconstruct(log, lu)
    assert _skew_joins(struck) >= 1 and struck.where("striker is not null").count() == 60_000


def test_hot_player_is_split(spark, split_early):
    plan = spark.range(0, 60_000, 1, 8).selectExpr(
        "id AS match_id", "1 AS innings", "CAST(id % 20 AS INT) AS over", "IF(id % 2 = 0, 0, id % 97) AS striker",
        "id % 89 AS non_striker", "concat('b', id % 31) AS bowler")
    bat = plan.groupBy(F.col("striker").alias("batsman")).agg(F.avg("over").alias("x"))
    bowl = plan.groupBy("bowler").agg(F.avg("over").alias("y"))
    f = OV.over_features(plan, bat, bowl, ["x"], ["y"])
    assert _skew_joins(f) >= 1 and f.count() == 60_000

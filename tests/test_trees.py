"""Trees as relations, rounds of K-means from stated points, and win shares, against plain Python."""

import itertools
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from crease.functions import wicket_discount
from crease.operators import clusters as CL
from crease.operators import overs as OV
from crease.operators import trees as TR
from crease.operators import winshare as WS

NODES = "node int, feature int, threshold double, left int, right int, prediction double"


def grow(r, depth, nodes, node=0):
    """A random tree below ``node`` as rows; ids in the order of growth."""
    if depth == 0 or (node and r.random() < 0.2):
        nodes[node] = (node, None, None, -1, -1, r.random())
        return
    nodes[node] = None
    left = len(nodes)
    nodes[left] = None
    right = len(nodes)
    nodes[right] = None
    nodes[node] = (node, r.randrange(3), round(r.random(), 2), left, right, 0.0)
    grow(r, depth - 1, nodes, left)
    grow(r, depth - 1, nodes, right)


def walk(nodes, x):
    at = nodes[0]
    while at[3] >= 0:
        v = None if x is None else x[at[1]]
        at = nodes[at[3] if v is not None and v <= at[2] else at[4]]
    return at[0], at[5]


@pytest.mark.parametrize("depth,top", [(0, 5), (1, 1), (3, 5), (7, 2), (7, 5), (7, 1)])
def test_descent_equals_a_walk(spark, depth, top):
    r = random.Random(depth)
    nodes: dict = {}
    grow(r, depth, nodes)
    rows = [(i, [round(r.random(), 2) for _ in range(3)]) for i in range(300)] + [(900, None), (901, [None, 0.5, 0.1])]
    df = spark.createDataFrame(rows, "i int, features array<double>")
    table = TR.with_levels(spark.createDataFrame(list(nodes.values()), NODES), depth)
    got = {x.i: (x.leaf, x.prediction) for x in TR.descend(df, table, depth, top=top).collect()}
    assert got == {i: walk(nodes, x) for i, x in rows}
    assert table.count() == len(nodes) and TR.descend(df.limit(0), table, depth, top=top).count() == 0


def test_walking_a_fitted_tree_equals_the_model(spark, tmp_path):
    r = np.random.default_rng(3)
    rows = [(i, x.tolist(), float(10 * x[0] + 5 * (x[1] > 0.5) + r.normal())) for i, x in enumerate(r.random((800, 4)))]
    df = spark.createDataFrame(rows, "i int, features array<double>, y double")
    model = DecisionTreeRegressor(maxDepth=12, maxBins=40, seed=1, labelCol="y", featuresCol="v").fit(df.withColumn("v", array_to_vector("features")))
    assert model.depth > TR.TOP                     # below the top, rows meet levels in joins
    nodes = TR.with_levels(OV.tree_dump(model, str(tmp_path / "t")).select(*TR.NODE), model.depth)
    got = {x.i: x.prediction for x in TR.descend(df, nodes, model.depth).collect()}
    want = {x.i: x.prediction for x in model.transform(df.withColumn("v", array_to_vector("features"))).collect()}
    assert got == want


def test_stated_tree_has_means(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0], 2), (2, [3.0, 7.0], 4), (3, [3.0, 1.0], 6)], "i int, features array<double>, y int")
    nodes = TR.stated_tree(df, [(0, 0, 1, 2), (2, 1, 3, 4)])
    by = {n.node: n for n in nodes.collect()}
    assert by[0].threshold == round(7 / 3, 6) and by[2].threshold == round(13 / 3, 6) and by[1].left == -1 and len(by) == 5
    fitted = {n.node: n.prediction for n in TR.leaf_means(nodes, df, "y", 2).collect()}
    assert fitted == {0: 4.0, 1: 2.0, 2: 4.0, 3: 6.0, 4: 4.0}
    # a leaf that no labelled row reaches has the mean, and the counts, of all
    some = df.where("i < 3")
    assert {n.node: n.prediction for n in TR.leaf_means(nodes, some, "y", 2).collect()}[3] == 3.0
    counts = TR.leaf_counts(nodes, some, ["y"], 2).collect()
    assert sorted((c.leaf, c.y, c.n, c.share) for c in counts) == [(1, 2, 1, 1.0), (3, 2, 1, 0.5), (3, 4, 1, 0.5), (4, 4, 1, 1.0)]
    none = df.limit(0)
    assert {x.leaf for x in TR.descend(df, TR.stated_tree(none, [(0, 0, 1, 2)]), 1).collect()} == {2}


# ---- win share

def plain_share(innings, dist):
    """Chances by going through every course of both innings; {leaf: {(r, w): share}}."""
    totals = []
    for leaves in innings:
        chance: dict = {}
        for course in itertools.product(*[dist[leaf].items() for leaf in leaves]):
            p, runs, out = 1.0, 0, 0
            for (r, w), share in course:
                p *= share
                if out < 10:
                    runs, out = runs + r, min(10, out + w)
            chance[runs] = chance.get(runs, 0) + p
        totals.append(chance or {0: 1.0})
    a, b = totals
    part = lambda f: sum(p * q for r, p in a.items() for s, q in b.items() if f(r, s))
    return [sum(r * p for r, p in a.items()), sum(r * p for r, p in b.items()),
            part(lambda r, s: r > s), part(lambda r, s: r == s), part(lambda r, s: r < s)]


def test_leaf_counts_walk_the_rows_once(spark):
    """Shares, unseen leaves and the counts of all rows come from counts that are written once."""
    seen = spark.sparkContext.accumulator(0)

    def met(y):
        seen.add(1)
        return y

    df = spark.createDataFrame([(i, [float(i % 3)], i % 4) for i in range(60)], "i int, features array<double>, y int")
    rows = df.withColumn("y", F.udf(met, "int")("y"))
    nodes = spark.createDataFrame([(0, 0, 0.5, 1, 2, None), (1, None, None, -1, -1, None), (2, 0, 9.0, 3, 4, None),
                                   (3, None, None, -1, -1, None), (4, None, None, -1, -1, None)], NODES)
    got = {(c.leaf, c.y): (c.n, c.share) for c in TR.leaf_counts(nodes, rows, ["y"], 2).collect()}
    assert seen.value == 60
    assert got == {(leaf, y): (n, 0.25) for leaf, n in ((1, 5), (3, 10), (4, 15)) for y in range(4)}


def test_pairs_of_a_win_share_are_dealt_out(spark):
    """Few short rows, long work each: they stay in as many partitions as the session shuffles to."""
    dist = spark.createDataFrame([(0, 1, 0, 0.5), (0, 2, 0, 0.5), (1, 3, 0, 1.0)], "leaf int, r long, w long, share double")
    rows = [(m, i + 1, o, (m >> (3 * i + o)) & 1) for m in range(64) for i in range(2) for o in range(3)]
    shares = WS.win_share(spark.createDataFrame(rows, "match_id int, innings int, over int, leaf int"), dist)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    plan = shares._jdf.queryExecution().executedPlan().toString()
    assert f", {n}), REPARTITION_BY_NUM" in plan and shares.count() == 64


def test_win_share_equals_every_course(spark):
    r = random.Random(2)
    dist = {}
    for leaf in range(3):
        n = [(r.randrange(0, 7), r.choice([0, 0, 1, 4, 6])) for _ in range(3)]
        weights = {k: n.count(k) / len(n) for k in n}
        dist[leaf] = weights
    table = spark.createDataFrame([(leaf, a, b, s) for leaf, d in dist.items() for (a, b), s in d.items()], "leaf int, r long, w long, share double")
    matches = {m: [[r.randrange(3) for _ in range(r.randrange(1, 6))], [r.randrange(3) for _ in range(r.randrange(0, 6))]] for m in range(12)}
    rows = [(m, i + 1, o, leaf) for m, two in matches.items() for i, one in enumerate(two) for o, leaf in enumerate(one)]
    rows += [(99, 2, 3, 1), (99, 1, 25, 0)]                        # no first innings: overs from 20 on don't count
    leaves = spark.createDataFrame(rows, "match_id int, innings int, over int, leaf int")
    got = {x.match_id: list(x)[1:] for x in WS.win_share(leaves, table).collect()}
    assert set(got) == {*matches, 99}
    for m, want in {**{m: plain_share(two, dist) for m, two in matches.items()}, 99: plain_share([[], [1]], dist)}.items():
        assert got[m] == pytest.approx(want, abs=1e-9) and sum(got[m][2:]) == pytest.approx(1)
    assert WS.win_share(leaves.limit(0), table).count() == 0


def test_over_distribution_takes_wickets_off(spark):
    counts = spark.createDataFrame([(1, 12, 0, 0.25), (1, 9, 1, 0.25), (1, 8, 1, 0.5)], "leaf int, total_runs int, total_wickets int, share double")
    got = {(x.r, x.w): x.share for x in WS.over_distribution(counts).collect()}
    assert got == {(12, 0): 0.25, (8, 1): 0.25, (7, 1): 0.5}
    assert counts.select(wicket_discount("total_runs", "total_wickets").alias("x")).first().x == 12.0


# ---- rounds of K-means

def plain_lloyd(points, order, k, rounds):
    centres = [list(points[p]) for p in order[:k]]
    for _ in range(rounds):
        near = {p: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))[1] for p, v in points.items()}
        for i in range(len(centres)):
            mine = [points[p] for p, c in near.items() if c == i]
            if mine:
                centres[i] = [sum(x) // len(mine) for x in zip(*mine)]
    return centres


def test_rounds_equal_plain_rounds_for_all_k(spark):
    r = random.Random(9)
    rows = [(i, *(r.choice([0.0, 50.0, 90.0]) + r.random() * 8 - 4 for _ in range(3))) for i in range(120)] + [(500, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "Player int, a double, b double, c double")
    points = CL.on_grid(df, ["a", "b", "c"])
    held = {p.Player: p.v for p in points.collect()}
    assert len(held) == 120 and all(abs(held[i][0] / CL.GRID - a) <= 0.5 / CL.GRID for i, a, _, _ in rows[:120])
    order = [p.Player for p in points.orderBy(CL.unit_hash(F.lit(1), "Player"), "Player").collect()]
    sets = CL.lloyd(points, range(2, 6), rounds=4)
    assert sets == {k: plain_lloyd(held, order, k, 4) for k in range(2, 6)}
    # neither the order of rows nor the partitions matter
    assert CL.lloyd(points.orderBy(F.desc("Player")).repartition(7), range(2, 6), rounds=4) == sets
    at = {x.Player: x for x in CL.grid_assign(points, sets[4]).collect()}
    for p, v in held.items():
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in sets[4]]
        assert at[p].cluster == d.index(min(d)) and at[p].distance == min(d) / CL.GRID ** 2
    cost = {x.k: x.cost for x in CL.grid_costs(points, sets).collect()}
    assert cost[4] == pytest.approx(sum(x.distance for x in at.values()))


def test_rounds_with_few_or_equal_points(spark):
    two = CL.on_grid(spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 1.0)], "Player int, a double"), ["a"])
    assert CL.lloyd(two, [2, 5]) == {2: [[CL.GRID]] * 2, 5: [[CL.GRID]] * 3}
    assert {x.cluster for x in CL.grid_assign(two, [[CL.GRID]] * 2).collect()} == {0}       # ties: the smaller id
    none = two.limit(0)
    assert CL.lloyd(none, [2]) == {2: []} and CL.lloyd_elbow(none, [2, 3]).count() == 0


def test_partitions_of_a_fit_follow_its_rows(spark):
    assert [CL.fit_partitions(n, 100) for n in (0, 1, 800, 801, 10**6)] == [8, 8, 8, 9, 10_000]
    points = spark.range(500).withColumnRenamed("id", "Player")
    assert CL.placed(points).rdd.getNumPartitions() == 8 and CL.placed(points, "Player", 3).rdd.getNumPartitions() == 3

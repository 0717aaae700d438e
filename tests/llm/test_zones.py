"""Zone-map clustering against plain rounds over all vectors, and against DuckDB."""

import hashlib
import itertools
import math

import duckdb
import numpy as np
from conftest import SF001, SF01
from pyspark.sql import functions as F

from crease.llm import queries, zones


def plain(rows, k=zones.CENTROIDS, rounds=zones.ROUNDS):
    """rows (vec_id, list) -> sorted result rows, in Python integers."""
    kept = [(i, [math.floor(64 * float(x)) for x in e]) for i, e in rows
            if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) and abs(math.floor(64 * x)) <= zones.LIMIT for x in e)]
    if not any(i is not None for i, _ in kept):
        return []
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), i, np.array(v, "<i4").tobytes(), v) for i, v in kept if i is not None)
    centroids = [v for *_, v in start[:k]]
    for r in range(rounds + 1):
        to = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]
        if r == rounds:
            break
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, to) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    sums = [sum(d for d, c in to if c == j) for j in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums), names[c]) for (i, _), (d, c) in zip(kept, to)), key=str)


def test_clusters_equal_plain_rounds(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = sorted(map(tuple, queries.op13_zone_clusters(spark, SF001).collect()), key=str)
    assert got == plain(rows) and len(got) == len(rows)


def test_clusters_equal_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF01}/embeddings.parquet'")
    assert sorted(map(tuple, queries.op13_zone_clusters(spark, SF01).collect())) == sorted(con.execute(zones.ORACLE_SQL).fetchall())


def test_odd_vectors(spark):
    r = np.random.default_rng(5)
    some = [(i, (r.integers(-3, 4, 64) / 64).tolist()) for i in range(40)]
    far = [x * 1e5 for x in some[0][1]]
    odd = [(100, None), (101, []), (102, [0.5] * 63), (103, [0.5] * 65), (104, [None] + [0.5] * 63), (105, [float("nan")] + [0.5] * 63),
           (106, [float("inf")] + [0.5] * 63), (107, [1e30] + [0.0] * 63), (None, [0.25] * 64), (5, [0.25] * 64), (5, [0.25] * 64), (108, far)]
    same = [(200 + i, [0.125] * 64) for i in range(600)]                # more equal vectors than a block holds
    rows = some + odd + same
    df = spark.createDataFrame([(*x, "c", "k") for x in rows], "vec_id long, embedding array<double>, cluster string, key string").repartition(3)
    got = sorted(map(tuple, zones.cluster(df).collect()), key=str)
    assert got == plain(rows) and len(got) == 40 + 5 + 600 - 1
    assert zones.cluster(df.limit(0)).count() == 0 and zones.cluster(df.where("vec_id is null")).count() == 0
    few = df.where("vec_id < 4")
    assert sorted(map(tuple, zones.cluster(few).collect()), key=str) == plain(some[:4])


def test_candidates_hold_every_nearest_centroid():
    r = np.random.default_rng(2)
    for scale in (2, 40, 1 << 24):
        c = r.integers(-scale, scale, (16, 64))
        for _ in range(30):
            v = (c[r.integers(16)] + r.integers(-scale // 2, scale // 2 + 1, (20, 64))).astype(np.int32)
            among = zones.candidates(v.min(axis=0), v.max(axis=0), c)
            best, d = zones.nearest(v, c, among)
            all_d = ((v.astype(np.int64)[:, None] - c) ** 2).sum(axis=2)
            assert (d == all_d.min(axis=1)).all() and (best == all_d.argmin(axis=1)).all()


def test_boxes_rule_centroids_out():
    c = np.zeros((3, 64), np.int64)
    c[1], c[2] = 100, 3
    v = np.full((5, 64), 1, np.int32)
    assert zones.candidates(v.min(axis=0), v.max(axis=0), c).tolist() == [0]


def test_hilbert_places_are_a_walk_over_all_cells():
    """In two and three axes every cell has one place, and neighbours on the curve share a side."""
    for axes, bits in ((2, 4), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        key = zones.hilbert_index(cells, bits)
        order = np.lexsort(key.T[::-1])
        assert len(np.unique(key, axis=0)) == len(cells)
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_blocks_hold_every_vector_within_its_box(spark):
    whole = zones.whole_vectors(spark.read.parquet(f"{SF01}/embeddings.parquet"))
    ids = []
    for z in zones.zone_maps(whole.select("vec_id", "v"), -40, 40).collect():
        v = np.frombuffer(z.v, "<i4").reshape(-1, 64)
        assert len(z.ids) == len(v) <= zones.BLOCK
        assert (np.frombuffer(z.lo, "<i4") == v.min(axis=0)).all() and (np.frombuffer(z.hi, "<i4") == v.max(axis=0)).all()
        ids += z.ids
    assert sorted(ids) == sorted(r.vec_id for r in whole.select(F.col("vec_id")).collect())

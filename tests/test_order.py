"""Total order, line places, appends that count once, ordinals of uneven logs."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from crease.operators.running import dense_ordinal, levels_for
from crease.sources import files as FS
from crease.sources import pages as PG


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_places_equal_a_sort(uncoalesced):
    spark, r = uncoalesced, random.Random(1)
    rows = [(r.choice([None, *"abc"]), r.choice([None, *range(50)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, position int").repartition(5)
    got = FS.ordered_rows(df, ["k", F.col("v").desc()], "place")
    rows_got = sorted(got.collect(), key=lambda x: x.place)
    assert [x.place for x in rows_got] == list(range(1, 3001))
    key = lambda k, v: (k is not None, k or "", v is None, -(v or 0))
    assert [key(x.k, x.v) for x in rows_got] == sorted(key(k, v) for k, v, _ in rows)
    assert "SinglePartition" not in got._jdf.queryExecution().toString()
    assert FS.ordered_rows(df.limit(0), ["k"]).count() == 0


def test_a_hot_key_and_equal_rows_are_spread(uncoalesced):
    df = uncoalesced.range(20_000).select(F.when(F.col("id") < 15_000, 7).otherwise(F.col("id")).alias("k"))
    got = FS.ordered_rows(df, ["k"])
    sizes = [pq.ParquetFile(f.replace("file://", "")).metadata.num_rows for f in got.select("k").inputFiles()]
    assert sum(sizes) == 20_000 and len(sizes) == 4 and max(sizes) < 9000
    assert got.agg(F.countDistinct("position")).first()[0] == 20_000


def test_a_user_with_all_events_in_an_instant(uncoalesced):
    """Uneven logs: one user's events lie within one second, and no task holds them all."""
    ev = uncoalesced.range(120_000).select(
        F.when(F.col("id") < 100_000, 1).otherwise(F.col("id") % 500).alias("user_id"),
        F.timestamp_seconds(F.when(F.col("id") < 100_000, F.col("id") % 3).otherwise(F.col("id"))).alias("ts"), F.col("id").alias("event_id"))
    ev = ev.union(ev.limit(1).select(F.lit(None).cast("long"), "ts", "event_id"))
    got = dense_ordinal(ev, ["user_id"], ["ts", "event_id"])
    sizes = [pq.ParquetFile(f.replace("file://", "")).metadata.num_rows for f in got.select("ts").inputFiles()]
    assert len(sizes) >= 4 and max(sizes) < 60_000
    rows = got.where("user_id in (1, 77)").collect()
    for user in (1, 77):
        mine = sorted((x.ts, x.event_id, x.n) for x in rows if x.user_id == user)
        assert [n for *_, n in mine] == list(range(1, len(mine) + 1)) and len(mine) > 30
    assert got.where("user_id is null").count() == 0


def test_levels_hold_every_window_small():
    assert [levels_for(n, 10, 10) for n in (0, 100, 101, 1000, 1001, 10**6)] == [1, 1, 2, 2, 3, 5]


def test_lines_have_their_place_over_files_and_splits(spark, tmp_path):
    r, lines = random.Random(3), []
    for name in ("a.txt", "b.txt", "c.txt"):
        part = [f"http://x.org/{name}/{i}" + "y" * r.randrange(60) + "  " for i in range(r.randrange(200, 400))]
        part[7] = ""
        (tmp_path / name).write_text("\n".join(part) + "\n")
        lines += part
    (tmp_path / "d.txt").write_text("")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        got = FS.text_lines(spark, str(tmp_path)).collect()
        seasons = PG.season_list(spark, str(tmp_path), 2018).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [x.value for x in sorted(got, key=lambda x: x.position)] == lines and {x.position for x in got} == set(range(len(lines)))
    assert {(x.position, x.url, x.season) for x in seasons} == {(i, u.rstrip(), 2018 - i) for i, u in enumerate(lines) if u}


SCHEMA = "a int, b string"


def test_a_repeated_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = spark.createDataFrame([(1, "x"), (2, None)], SCHEMA), spark.createDataFrame([(3, "z")], SCHEMA)
    assert FS.csv_scan_batches(spark, path, SCHEMA).count() == 0
    assert FS.csv_append_batch(one, path, "day/1") and FS.csv_append_batch(two, path, "day 2")
    assert not FS.csv_append_batch(one, path, "day/1")
    assert sorted(map(tuple, FS.csv_scan_batches(spark, path, SCHEMA).collect()), key=str) == [(1, "x"), (2, None), (3, "z")]


def test_a_batch_that_failed_halfway_counts_for_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "x")], SCHEMA)
    FS.csv_append_batch(one, path, "a")
    # files written, manifest not
    one.write.option("header", "true").csv(f"{path}/parts/left-behind")
    # and a manifest entry whose writing was cut off
    (tmp_path / "t" / "manifest" / "cut" / "_temporary").mkdir(parents=True)
    assert FS.csv_scan_batches(spark, path, SCHEMA).count() == 1
    bad = one.withColumn("a", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        FS.csv_append_batch(bad, path, "b")
    assert FS.csv_scan_batches(spark, path, SCHEMA).count() == 1
    assert FS.csv_append_batch(one, path, "b") and FS.csv_scan_batches(spark, path, SCHEMA).count() == 2
    assert FS.csv_append_batch(one.limit(0), path, "none") and FS.csv_scan_batches(spark, path, SCHEMA).count() == 2

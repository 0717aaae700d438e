"""Chunked running aggregates equal plain windows, also when groups span many chunks."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from crease.operators.running import Running, ordinal, running_aggregates


def _data(spark, n=400, groups=3, seed=7):
    rnd = random.Random(seed)
    rows = []
    # one hot group holds most rows
    for i in range(n):
        g = 0 if i < n * 0.7 else rnd.randrange(1, groups)
        rows.append((g, i, rnd.randint(0, 6), rnd.choice([None, 1.0, 2.0, 0.5]), rnd.random() * 0.5 + 0.5))
    return spark.createDataFrame(rows, "g int, o int, v int, m double, p double")


def test_chunked_matches_window(spark):
    df = _data(spark)
    specs = [Running("s_in", "sum", "v", True), Running("s_ex", "sum", "v", False),
             Running("mx_ex", "max", "m", False), Running("pr", "product", "p", True)]
    got = running_aggregates(df, ["g"], ["o"], F.floor(F.col("o") / 7), specs)
    w = Window.partitionBy("g").orderBy("o")
    inc = w.rowsBetween(Window.unboundedPreceding, 0)
    exc = w.rowsBetween(Window.unboundedPreceding, -1)
    exp = df.select("g", "o",
                    F.coalesce(F.sum("v").over(inc), F.lit(0)).alias("s_in"),
                    F.coalesce(F.sum("v").over(exc), F.lit(0)).alias("s_ex"),
                    F.max("m").over(exc).alias("mx_ex"),
                    F.product("p").over(inc).alias("pr"))
    a = {(r.g, r.o): (r.s_in, r.s_ex, r.mx_ex, round(r.pr, 12)) for r in got.collect()}
    b = {(r.g, r.o): (r.s_in, r.s_ex, r.mx_ex, round(r.pr, 12)) for r in exp.collect()}
    assert a == b


def test_ordinal_is_row_number(spark):
    df = _data(spark)
    got = ordinal(df, ["g"], ["o"], F.floor(F.col("o") / 5), out="n")
    exp = df.select("g", "o", F.row_number().over(Window.partitionBy("g").orderBy("o")).alias("n"))
    assert {(r.g, r.o, r.n) for r in got.collect()} == {(r.g, r.o, r.n) for r in exp.collect()}


def test_null_keys_dropped(spark):
    df = spark.createDataFrame([(None, 1, 1), (1, 1, 2)], "g int, o int, v int")
    got = running_aggregates(df, ["g"], ["o"], F.lit(0), [Running("s", "sum", "v")])
    assert [(r.g, r.s) for r in got.collect()] == [(1, 2)]


def test_two_level_chunks_match_window(spark):
    df = _data(spark, n=600)
    specs = [Running("s_ex", "sum", "v", False), Running("mx", "max", "m", True),
             Running("pr", "product", "p", False)]
    w = Window.partitionBy("g").orderBy("o")
    exp = df.select("g", "o",
                    F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s_ex"),
                    F.max("m").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("mx"),
                    F.coalesce(F.product("p").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                               F.lit(1.0)).alias("pr"))
    b = {(r.g, r.o): (r.s_ex, r.mx, round(r.pr, 12)) for r in exp.collect()}
    for levels in (1, 2, 3):
        got = running_aggregates(df, ["g"], ["o"], F.floor(F.col("o") / 4), specs, levels=levels, fanout=3)
        a = {(r.g, r.o): (r.s_ex, r.mx, round(r.pr, 12)) for r in got.collect()}
        assert a == b, levels


def test_property_chunked_equals_window(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    row = st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 9)))

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(rows=st.lists(row, min_size=1, max_size=60), width=st.integers(1, 9),
           levels=st.integers(1, 2), inclusive=st.booleans())
    def check(rows, width, levels, inclusive):
        data = [(g, i, v) for i, (g, v) in enumerate(rows)]
        df = spark.createDataFrame(data, "g int, o int, v int")
        got = running_aggregates(df, ["g"], ["o"], F.floor(F.col("o") / width),
                                 [Running("s", "sum", "v", inclusive), Running("m", "max", "v", inclusive)],
                                 levels=levels, fanout=2)
        res = {(r.g, r.o): (r.s, r.m) for r in got.collect()}
        for g in {d[0] for d in data}:
            seen = []
            for (gg, o, v) in data:
                if gg != g:
                    continue
                frame = seen + [v] if inclusive else list(seen)
                vals = [x for x in frame if x is not None]
                assert res[(g, o)] == (sum(vals), max(vals) if vals else None)
                seen.append(v)

    check()

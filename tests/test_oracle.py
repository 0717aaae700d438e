"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

from crease.plans import catalog as C
from crease.plans.compare import compare

from conftest import SF01

SQL_KEYS = sorted(C.ORACLES)
ROWS_ONLY = sorted(set(C.QUERIES) - set(C.ORACLES))
SLOW = {"over_predictions_fitted", "score_fitted"}


def test_every_query_has_a_callable():
    assert set(C.ORACLES) <= set(C.QUERIES)
    assert len(C.QUERIES) >= 50


@pytest.mark.parametrize("name", SQL_KEYS)
def test_query_matches_oracle(spark, duck01, name):
    r = compare(C.QUERIES[name](spark, SF01), duck01, C.ORACLES[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", [n for n in ROWS_ONLY if n not in SLOW])
def test_rows_only_query_runs(spark, name):
    assert C.QUERIES[name](spark, SF01).count() >= 0

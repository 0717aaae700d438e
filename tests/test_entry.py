"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_with_stable_schema(spark):
    se = _entry_module()
    a, b = se.entry(spark), se.entry(spark)
    assert a.schema == b.schema
    assert [f.name for f in a.schema.fields] == ["request_id", "line", "batsman", "bowler", "u",
                                                "tier", "runs", "survive"]
    assert a.count() > 0


def test_queries_and_oracles(spark):
    se = _entry_module()
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q) and len(o) >= 50
    for name, sql in o.items():
        assert "WITH" in sql or "SELECT" in sql, name
        assert "/root/testdata" not in sql, name        # base tables only, as pre-registered views

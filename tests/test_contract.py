import functools

import duckdb
import pytest

import __spark_entry__ as contract
from ringwatch.plans import oracle, queries
from ringwatch.plans.queries import QUERIES

TABLES = "events lineitem documents".split()


def test_every_query_has_a_statement():
    assert set(oracle.SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(autouse=True, scope="module")
def one_detection():
    """The queries over the same detection share one run of it here."""
    original = queries._detection
    queries._detection = functools.cache(original)
    yield
    queries._detection = original


def plain(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_statement(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    columns = ", ".join(f'"{c}"' for c in found.columns)
    wanted = con.execute(f"SELECT {columns} FROM ({oracle.SQL[name]})").fetchall()
    rows = [tuple(map(plain, r)) for r in found.collect()]
    assert sorted(rows, key=str) == sorted((tuple(map(plain, r)) for r in wanted), key=str)


@pytest.mark.parametrize("name", ["degrees", "star_hubs", "interaction_edges", "topic_records"])
def test_event_filters_reach_the_scan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert "PushedFilters: [In(event_type, [click,error,view])" in plan


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["degrees", "star_hubs", "batch_summary", "ego_density", "interaction_edges"])
def test_plans_stay_in_the_jvm_and_never_cross(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan

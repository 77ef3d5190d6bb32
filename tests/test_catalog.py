"""Every registered query against its SQL twin, and the shape of its plan."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in check.TABLES.split():
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, sf_dir, db, name):
    df = queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in oracle_sql():
        cursor = db.execute(oracle_sql()[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert check.type_notes(df, cursor) == ""
        assert check.rows(df.columns, df.collect()) == check.rows(names, cursor.fetchall())


def test_entry(spark, sf_dir):
    assert entry(spark).count() == 17


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_pass_runs_once_per_page(spark, sf_dir):
    for name in ("book_record", "quarantine", "extract_reviews", "listing_links"):
        plan = plan_of(queries()[name](spark, sf_dir))
        assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan


def test_groups_are_cut_before_the_shuffle(spark, sf_dir):
    assert plan_of(queries()["review_quota"](spark, sf_dir)).count("WindowGroupLimit") == 4
    assert "TakeOrderedAndProject" in plan_of(queries()["popular_topk"](spark, sf_dir))


def test_scans_are_pruned(spark, sf_dir):
    plan = plan_of(queries()["saved_users_of"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan
    assert "LessThan(l_shipdate,1998-01-01T00:00)" in plan

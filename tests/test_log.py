"""The keyed log against a dictionary, and the phrase index against a double loop."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bookpipe.operators.validate import titles_holding
from bookpipe.schema import REVIEW
from bookpipe.sinks.log import KeyedLog

SCHEMA = "isbn string, text string, rating int, user string, seq int"


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names}


def held(log):
    return sorted(map(tuple, log.read().collect()), key=repr)


def test_log_keeps_the_last_row(spark, tmp_path):
    path = str(tmp_path / "log")
    log, want = KeyedLog(spark, path, REVIEW, buckets=4), {}
    assert held(log) == []
    for step in range(6):
        rows = [(f"b{(step * i) % 7}", f"{step}-{i}", i % 6, f"u{i % 3}", i) for i in range(9)]
        before = files(path)
        log.append(spark.createDataFrame(rows, SCHEMA), ("seq",), name=f"n{step}")
        log.append(spark.createDataFrame(rows[:1], SCHEMA), ("seq",), name=f"n{step}")  # finished already
        after = files(path)
        assert before.items() <= after.items()  # no file that was there is rewritten
        for isbn, text, rating, user, _ in rows:
            want[isbn, user] = (isbn, text, rating, user)
        if step in (2, 4):
            merged = log.compact(least_rows=3 if step == 2 else 1)
            assert merged and (step == 2 or log.compact() == [])
            assert after.items() <= files(path).items()
        assert held(KeyedLog(spark, path, REVIEW, buckets=4)) == sorted(want.values(), key=repr)
    with pytest.raises(ValueError):
        KeyedLog(spark, path, REVIEW, buckets=5)
    with pytest.raises(ValueError):
        log.append(spark.createDataFrame([], SCHEMA), ())


def test_unfinished_batch_does_not_count(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), REVIEW)
    log.append(spark.createDataFrame([("a", "1", 1, "x", 1)], SCHEMA), ("seq",), name="one")
    rows = spark.createDataFrame([("a", "2", 2, "x", 0)], SCHEMA).select(*REVIEW.names, F.lit(0).alias("_bucket"))
    rows.write.parquet(str(tmp_path / "log" / "delta" / "batch=two"))  # written, not committed
    assert held(log) == [("a", "1", 1, "x")]
    log.append(spark.createDataFrame([("a", "3", 3, "x", 0)], SCHEMA), ("seq",), name="two")
    assert held(log) == [("a", "3", 3, "x")]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.one_of(st.none(), st.text("ab c%.", max_size=8)), max_size=12),
    st.lists(st.one_of(st.none(), st.text("ab c%.", max_size=6)), max_size=8),
)
def test_phrases(spark, titles, phrases):
    df = spark.createDataFrame(list(enumerate(titles)), "k long, t string")
    banned = spark.createDataFrame([(p,) for p in phrases], "p string")
    got = {r.k for r in titles_holding(df, "k", "t", banned, "p").collect()}
    assert got == {i for i, t in enumerate(titles) if t is not None and any(p and p in t for p in phrases)}


def test_very_many_phrases(spark):
    """100,000 phrases from a table: an equality join, no nested loop and no pattern of them all."""
    titles = spark.range(5000).select("id", F.concat(F.lit("volume no "), F.col("id") * 37, F.lit(" of a series")).alias("t"))
    phrases = spark.range(100_000).select(F.concat(F.lit("no "), F.col("id") * 2, F.lit(" of")).alias("p"))
    found = titles_holding(titles, "id", "t", phrases, "p")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "RLIKE" not in plan.upper()
    assert {r.id for r in found.collect()} == {i for i in range(5000) if i * 37 % 2 == 0 and i * 37 // 2 < 100_000}

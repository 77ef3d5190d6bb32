"""The review quota against a plain reading of its rules."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bookpipe.operators import ranking
from bookpipe.operators.reviews import fill_reviews, nest_reviews

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
# Few books and users, one book much hotter than the others.
keys = st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.sampled_from("uvwxyz"))
SCHEMA = "isbn string, user string, page_no int, pos int, text string, rating int"


def candidates(spark, rows, parts=3):
    data = [(isbn, user, i // 4, i % 4, f"t{i}", i % 6) for i, (isbn, user) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(parts), data


def plain_reading(data, saved, n, dedup_first=False):
    """One book after the other, page by page, as a person would do it."""
    want = set()
    for book in {row[0] for row in data}:
        known = [user for isbn, user in saved if isbn == book]
        quota, taken = max(n - len(known), 0), []
        for _, user, page_no, pos, text, _ in sorted((r for r in data if r[0] == book), key=lambda r: r[2:4]):
            if user in known or (dedup_first and user in {t[0] for t in taken}):
                continue
            taken.append((user, page_no, pos, text))
        want |= {(book, *row, place) for place, row in enumerate(taken[:quota], 1)}
    return want


def found(df):
    return {(r.isbn, r.user, r.page_no, r.pos, r.text, r.position) for r in df.collect()}


@settings(**SETTINGS)
@given(st.lists(keys, max_size=40), st.lists(keys, max_size=8), st.integers(0, 7), st.booleans(), st.integers(1, 9))
def test_quota(spark, rows, saved, n, dedup_first, parts):
    df, data = candidates(spark, rows, parts)
    kept = spark.createDataFrame(saved, "isbn string, user string")
    got = fill_reviews(df, kept, n, dedup_first=dedup_first)
    assert found(got) == plain_reading(data, saved, n, dedup_first)


def test_quota_beyond_the_group_limit(spark, monkeypatch):
    monkeypatch.setattr(ranking, "GROUP_LIMIT", 2)
    df, data = candidates(spark, [("hot", u) for u in "uvwxyz" * 9] + [("a", "u")] * 3)
    saved = [("hot", "u"), ("hot", "u")]
    got = fill_reviews(df, spark.createDataFrame(saved, "isbn string, user string"), 30)
    assert found(got) == plain_reading(data, saved, 30)


@settings(**SETTINGS)
@given(st.lists(keys, max_size=30), st.integers(1, 4), st.integers(0, 3))
def test_runs_are_resumable(spark, rows, n, more):
    df, _ = candidates(spark, rows)
    none = spark.createDataFrame([], "isbn string, user string")
    first = [(r.isbn, r.user) for r in fill_reviews(df, none, n, dedup_first=True).collect()]
    saved = spark.createDataFrame(first, "isbn string, user string")
    assert fill_reviews(df, saved, n, dedup_first=True).count() == 0 or max(Counter(r for r, _ in first).values()) < n
    grown = [(r.isbn, r.user) for r in fill_reviews(df, saved, n + more, dedup_first=True).collect()]
    assert not set(grown) & set(first)
    totals = Counter(isbn for isbn, _ in first + grown)
    assert all(total <= n + more for total in totals.values())


@pytest.mark.parametrize("n", [3])
def test_nesting_keeps_order(spark, n):
    df, data = candidates(spark, [("hot", u) for u in "zyxw"] + [("a", "u")])
    none = spark.createDataFrame([], "isbn string, user string")
    nested = {r.isbn: [x.user for x in r.reviews] for r in nest_reviews(fill_reviews(df, none, n)).collect()}
    assert nested == {"hot": ["z", "y", "x"], "a": ["u"]}

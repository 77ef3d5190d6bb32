from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pages import SITE, listing_page, url
from pyspark.sql import functions as F

from bookpipe.operators import ranking as R
from bookpipe.operators.counts import work_target
from bookpipe.operators.listing import frontier, listing_links, pages_needed, unsatisfied_links

SETTINGS = dict(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def skewed(spark, n=3000):
    """A third of all rows under one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.expr("pmod(hash(id), 1000)").alias("v"), "id"
    )


@pytest.mark.parametrize("n", [0, 1, 7])
def test_top_per_group_forms_agree(spark, monkeypatch, n):
    df = skewed(spark)
    small = {tuple(r) for r in R.top_per_group(df, ["k"], ["v", "id"], n, "pos").collect()}
    monkeypatch.setattr(R, "GROUP_LIMIT", -1)
    large = {tuple(r) for r in R.top_per_group(df, ["k"], ["v", "id"], n, "pos", slices=4).collect()}
    want, groups = set(), defaultdict(list)
    for r in df.collect():
        groups[r.k].append((r.v, r.id))
    for k, rows in groups.items():
        want |= {(k, v, i, p) for p, (v, i) in enumerate(sorted(rows)[:n], 1)}
    assert small == large == want


@pytest.mark.parametrize("k", [0, 1, 10, 5000])
def test_first_k_forms_agree(spark, k):
    df = skewed(spark).repartition(7)
    rows = sorted((r.k, r.v, r.id) for r in df.collect())
    want = {(*row, i) for i, row in enumerate(rows[:k], 1)}
    for small in (10_000, -1):
        got = R.first_k(df, ["k", "v", "id"], k, small=small)
        assert {tuple(r) for r in got.collect()} == want


def test_global_rank_descending(spark):
    got = R.global_rank(spark.range(100).repartition(5), [F.desc("id")]).collect()
    assert {(r.id, r["rank"]) for r in got} == {(i, 100 - i) for i in range(100)}


@settings(**SETTINGS)
@given(st.dictionaries(st.tuples(st.integers(0, 2), st.integers(-5, 40)), st.integers(0, 5), min_size=1))
def test_total_before(spark, cells):
    df = spark.createDataFrame([(b, p, v) for (b, p), v in cells.items()], "b int, p int, v int")
    got = {(r.b, r.p): r.before for r in R.total_before(df, "v", "p", ["b"]).collect()}
    for (b, p), before in got.items():
        earlier = [v for (c, q), v in cells.items() if c == b and q < p]
        assert before == (sum(earlier) if earlier else None)
    assert set(got) == set(cells)


def test_pages_needed(spark):
    counts = spark.createDataFrame([(1, 5), (2, 0), (3, 5), (4, 5)], "page_no int, n_new int")
    needed = lambda k: sorted(r.page_no for r in pages_needed(counts, k).collect())
    assert needed(0) == [1] and needed(5) == [1] and needed(6) == [1, 2, 3] and needed(100) == [1, 2, 3, 4]


def test_frontier_keeps_order_and_repeats(spark):
    links = spark.createDataFrame([(1, 0, "b"), (1, 1, "a"), (2, 0, "b"), (2, 1, "c")], "page_no int, pos int, url string")
    done = spark.createDataFrame([("a",), ("a",)], "url string")
    for small in (100, -1):
        got = frontier(links, done, 2, small=small).orderBy("rank").collect()
        assert [(r.url, r["rank"]) for r in got] == [("b", 1), ("b", 2)]


@pytest.mark.parametrize("k", [0, 1, 3, 9, 99])
def test_listing_is_read_in_slices(spark, k):
    rows = [(p, f"{SITE}/s?page={p}", listing_page([2 * p, 2 * p + 1])) for p in range(10, 18)]
    listing = spark.createDataFrame(rows, "page_no long, url string, html string")
    done = spark.createDataFrame([(url(20),), (url(21),), (url(22),)], "url string")
    got = unsatisfied_links(listing, done, k, first_slice=1)
    whole = sorted((r.page_no, r.pos, r.url) for r in frontier(listing_links(listing), done, 10**6).collect())
    read = sorted((r.page_no, r.pos, r.url) for r in got.collect())
    assert read == whole[: len(read)] and len(read) >= min(k, len(whole))
    assert unsatisfied_links(listing.limit(0), done, k).count() == 0


@pytest.mark.parametrize("need, target", [(0, 0), (19, 19), (20, 21), (100, 105)])
def test_work_target(need, target):
    assert work_target(7, 7 + need) == target
    assert work_target(9, 7) == 0


def test_total_before_on_sparse_positions(spark):
    """Positions far apart: no task has over twice the rows of the median one."""
    df = spark.range(40_000).select((F.col("id") * 10**14).alias("p"), (F.col("id") % 7).alias("v"))
    df = df.withColumn("size", F.lit(1))
    got = R.total_before(df, "v", "p").orderBy("p").select("v", "before").collect()
    total = 0
    for i, r in enumerate(got):
        assert r.before == (total if i else None)
        total += r.v
    spread = df.repartitionByRange("p").withColumn("at", F.spark_partition_id()).groupBy("at").count().collect()
    sizes = sorted(r["count"] for r in spread)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    plan = R.total_before(df, "v", "p")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan or "_total" in plan  # only one row a range may meet in one task

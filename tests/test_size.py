"""What only larger tables show."""

from decimal import Decimal

from pyspark.sql import functions as F

from bookpipe.operators.blocks import Layout, collect, steps
from bookpipe.operators.joins import members, without
from bookpipe.operators.validate import titles_holding
from bookpipe.plans.catalog import QUERIES
from bookpipe.plans.increment import pages_of
from bookpipe.session import spread
from bookpipe.sources.pages import latest


def test_sparse_pages_beyond_bigint(spark, tmp_path):
    """Page numbers 10^15 apart stay exact where a bigint would not hold them."""
    rows = [(key, 4) for key in (2, 20_000, 30_000, 40_000)]
    spark.createDataFrame(rows, "p_partkey bigint, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    got = QUERIES["listing_pages_sparse"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [(Decimal(2 * 10**15), 4), (Decimal(2 * 10**19), 4)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pieces_of_titles_stay_off_the_driver(spark, tmp_path):
    """Small files of titles make many pieces; phrases of all lengths are found through their longest ones."""
    rows = [(i, f"very long title no {i} of all") for i in range(300)] + [(300, None), (301, "x")]
    spark.createDataFrame(rows, "key bigint, title string").write.parquet(str(tmp_path / "titles"))
    listed = ["no 7 ", "no 123 ", "title no 255 of", "x", "tit", "absent", "", None]
    spark.createDataFrame([(p,) for p in listed], "phrase string").write.parquet(str(tmp_path / "phrases"))
    for wanted in (listed, listed[:4]):
        phrases = spark.read.parquet(str(tmp_path / "phrases")).where(F.col("phrase").isin([p for p in wanted if p is not None]))
        found = titles_holding(spark.read.parquet(str(tmp_path / "titles")), "key", "title", phrases, "phrase")
        assert "Broadcast" not in plan_of(found)
        expected = [k for k, title in rows if title and any(p and p in title for p in wanted)]
        assert sorted(r.key for r in found.collect()) == expected


def test_pages_stay_off_the_driver(spark, tmp_path):
    """Pages made of the columns of a small file are not broadcast, nor are unbounded keys of them."""
    spark.range(50).write.parquet(str(tmp_path / "keys"))
    key = spark.read.parquet(str(tmp_path / "keys"))
    pages = key.select(F.col("id").alias("page_no"), F.col("id").alias("page_id"), F.col("id").cast("string").alias("url"), F.lit("<p>").alias("html"))
    found = (
        latest(pages, ["page_no"]),
        pages_of(pages, pages.select("url"), "url", ["url"], bound=100, broadcast_rows=10),
        without(pages, pages, "url"),
        members(pages, pages, "url"),
    )
    for df in found:
        assert "Broadcast" not in plan_of(df)
    assert [df.count() for df in found] == [50, 50, 0, 50]


def test_tasks_that_parse_have_few_pages(spark):
    assert spread(spark.range(100), "id", rows=5).rdd.getNumPartitions() == 20


def test_pages_of_one_build_are_walked_once():
    layout = Layout([("title", steps('//span[@id="productTitle"]'), None, None), ("link", steps("//a"), "href", None)])
    pages = [f'<script>if (a < {i}) "<b>"</script><a href="/{i}">x</a><span id="productTitle">T {i}</span>' for i in range(20)]
    assert [collect(page, layout) for page in pages] == [{"title": [f"T {i}"], "link": [f"/{i}"]} for i in range(20)]
    assert len(layout.plans) == 1

"""Rows that no join needs stay out of its shuffle."""

from pyspark.sql import functions as F

from bookpipe.config import RunConfig
from bookpipe.operators.joins import likely
from bookpipe.plans.increment import bodies_of, run_increment
from bookpipe.sinks.stores import FileStore
from tests.pages import book_page, listing_page, review, review_page

KEYS = "book_url string, page_no bigint, page_id bigint"


def shuffled_rows(df):
    """Rows that the widest shuffle of a plan has written."""
    df.collect()
    plan, most = df._jdf.queryExecution().executedPlan(), 0
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName() == "ShuffleQueryStageExec":
            waiting.append(node.plan())
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return most


def test_likely_keeps_all_keys_and_few_others(spark):
    rows = spark.range(50_000).select(F.concat(F.lit("b"), "id").alias("book_url"), (F.col("id") % 7).alias("page_no"), F.lit("x").alias("html"))
    odd = spark.createDataFrame([(None, 1, "n"), (None, 1, "n"), ("b7", None, "n"), ("b0", 0, "again")], "book_url string, page_no bigint, html string")
    rows = rows.unionByName(odd)
    keys = rows.where("cast(substr(book_url, 2) as int) % 10 = 0").select("book_url", "page_no")
    keys = keys.unionByName(keys).unionByName(odd.where("book_url is null").select("book_url", "page_no"))
    on = ["book_url", "page_no"]
    near = likely(rows, keys, on)
    assert near.columns == rows.columns
    wanted = rows.join(keys.distinct(), on)
    assert wanted.exceptAll(near.select(*wanted.columns)).count() == 0
    assert 5_001 <= near.count() < 5_100
    assert sorted(near.join(keys.distinct(), on).collect()) == sorted(wanted.collect())
    assert likely(rows, keys.limit(0), on).count() == 0


def test_bodies_that_are_not_wanted_are_not_dealt(spark):
    pages = spark.range(20_000).select(
        F.concat(F.lit("b"), "id").alias("book_url"), F.lit(1).cast("bigint").alias("page_no"), F.col("id").alias("page_id"), F.lit("<p>").alias("html")
    )
    twice = pages.unionByName(pages)
    wanted = spark.createDataFrame([(f"b{i}", 1, i, f"isbn{i}") for i in range(0, 20_000, 100)], KEYS + ", isbn string")
    got = bodies_of(twice, wanted, small=False)
    assert shuffled_rows(got) < 1_000
    assert sorted(got.select("page_id", "isbn").collect()) == sorted(bodies_of(twice, wanted, small=True).select("page_id", "isbn").collect())


def test_large_and_small_targets_store_the_same(spark, tmp_path):
    rows = [("listing", 1, None, 0, "https://shop.example/s?page=1", listing_page(range(1, 6), True))]
    rows += [("book", None, None, n, f"https://shop.example/dp/{n}/", book_page(n)) for n in range(1, 6)]
    for n in range(1, 6):
        for page in (1, 2, 3):
            html = review_page([review(f"u{n}-{page}-{i}") for i in range(2)], page < 3)
            rows.append(("review", page, f"https://shop.example/dp/{n}/", n * 10 + page, f"https://shop.example/r/{n}/{page}", html))
    rows += [rows[-1], ("review", None, None, 99, None, "<p>"), ("review", 1, None, 98, None, "<p>")]
    pages = spark.createDataFrame(rows, "kind string, page_no bigint, book_url string, page_id bigint, url string, html string")
    got = []
    for bound in (0, 200_000):
        run = run_increment(pages, FileStore(spark, str(tmp_path / f"s{bound}")), RunConfig(5, 5), broadcast_rows=bound)
        got.append(sorted(run.reviews.collect()))
    assert got[0] == got[1] and len(got[0]) == 25

"""One commit for two stores, kept counts, reading by buckets and by the pager."""

import re

import pytest
from pages import book_page, listing_page, review, review_page, url

from bookpipe.config import RunConfig
from bookpipe.operators.counts import reviews_per_book
from bookpipe.operators.reviews import read_review_pages, reviews_of
from bookpipe.plans.increment import due_books, run_and_publish
from bookpipe.schema import CAPTURE
from bookpipe.sinks.ledger import Ledger
from bookpipe.sinks.stores import FileStore, TableStore
from bookpipe.sources.pages import Captures, read_captures, write_captures


def shop(spark, books=3, pages=4, each=10, last=None):
    """Books with review pages of ``each`` reviews; the pager of page ``last`` has no next one."""
    rows = [("listing", 1, None, 1, "https://shop.example/s?page=1", listing_page(range(1, books + 1)))]
    for n in range(1, books + 1):
        rows.append(("book", None, None, n * 100, url(n), book_page(n, title=f"Book {n}")))
        for p in range(1, pages + 1):
            html = review_page([review(f"u{p}-{i}", f"text {n}") for i in range(each)], more=p != (last or pages))
            rows.append(("review", p, url(n), n * 100 + p, f"{url(n)}reviews/{p}", html))
    return spark.createDataFrame(rows, CAPTURE)


def stored(store):
    return sorted((r.isbn, r.user, r.text) for r in store.reviews().collect())


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"))
    assert not ledger.exists() and ledger.batches() == []
    ledger.open(["old"])
    ledger.open(["other"])  # it is there already
    for name in ("b.1", "a", "b.1"):
        ledger.commit(name)
    assert ledger.batches() == ["old", "b.1", "a"]
    ledger.withdraw("b.1")
    ledger.commit("b.1")
    assert ledger.batches() == ["old", "a", "b.1"]


def test_stop_between_two_stores(spark, tmp_path, monkeypatch):
    """A run that stops between the stores is repeated without naming its batch; both hold each row once."""
    pages, config = shop(spark), RunConfig(3, 4)
    raw, tables = FileStore(spark, str(tmp_path / "s")), TableStore(spark, "stop_books", "stop_reviews", "stop_rejects")
    stage = TableStore.stage

    def fail(self, *args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(TableStore, "stage", fail)
    with pytest.raises(RuntimeError):
        run_and_publish(pages, raw, tables, config)
    assert raw.attributes().count() == raw.reviews().count() == 0 and len(raw.batches()) == 1
    monkeypatch.setattr(TableStore, "stage", stage)
    run_and_publish(pages, raw, tables, config)
    assert len(raw.batches()) == 1  # the same name again
    for store in (raw, tables, FileStore(spark, str(tmp_path / "s"))):
        assert store.attributes().count() == 3 and len(stored(store)) == len(set(stored(store))) == 12
    again = run_and_publish(pages, raw, tables, config)
    assert again.reviews.count() == 0 and len(stored(raw)) == len(stored(tables)) == 12


def test_counts_are_kept(spark, tmp_path):
    """Counts add up over batches and equal a recount; the plan of a batch does not read stored reviews for them."""
    pages = shop(spark)
    raw, tables = FileStore(spark, str(tmp_path / "s")), TableStore(spark, "kept_books", "kept_reviews", "kept_rejects")
    for n in (2, 5, 9):
        run_and_publish(pages, raw, tables, RunConfig(3, n))
    for store in (raw, tables):
        for mode in ("rows", "users"):
            recount = reviews_per_book(store.reviews(), mode, store.attributes())
            assert sorted(store.counts(mode).collect()) == sorted(recount.collect())
            assert {r.n for r in store.counts(mode).collect()} == {9}
    plan = due_books(Captures.of(pages), raw, RunConfig(3, 12)).counts._jdf.queryExecution().executedPlan().toString()
    assert "review_counts" in plan and "book_reviews" not in plan


def test_store_of_earlier_runs(spark, tmp_path):
    """A store written before counts and a ledger were kept is counted from its rows, and all of it counts."""
    store = FileStore(spark, str(tmp_path / "s"))
    run_and_publish(shop(spark), store, config=RunConfig(3, 4), batch="b1")
    for name in ("_ledger", "review_counts"):
        (tmp_path / "s" / name).rename(tmp_path / f"old-{name}")
    bare = FileStore(spark, str(tmp_path / "s"))
    assert {r.n for r in bare.counts().collect()} == {4}
    again = run_and_publish(shop(spark), bare, config=RunConfig(3, 4))
    assert again.reviews.count() == 0 and len(stored(bare)) == 12


def test_pages_by_bucket(spark, tmp_path):
    """Laid-out captures give the same run, and the scans of book and review pages take the wanted buckets only."""
    pages, config = shop(spark), RunConfig(2, 4)
    path = str(tmp_path / "captures")
    write_captures(pages, path)
    laid = read_captures(spark, path)
    one, two = FileStore(spark, str(tmp_path / "a")), FileStore(spark, str(tmp_path / "b"))
    run_and_publish(pages, one, config=config)
    run_and_publish(laid, two, config=config)
    assert stored(one) == stored(two) and len(stored(one)) == 8
    from bookpipe.operators.joins import narrow
    from bookpipe.plans.increment import PAGE, in_buckets, pages_of

    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    due = spark.createDataFrame([(url(1), 1)], "url string, rank bigint")
    books = Captures.of(laid).books
    wanted, on = in_buckets(Captures.of(laid).reviews, due.withColumnRenamed("url", "book_url"), "book_url")
    for df in (pages_of(books, due, "url", ["url"], 1), narrow(Captures.of(laid).reviews.select(*PAGE, *on[1:]), wanted, on, 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"PartitionFilters: \[(.*?)PushedFilters", plan)
        assert scans and all("dynamicpru" in scan and "bucket" in scan and "kind" in scan for scan in scans), plan


def test_reading_follows_the_pager(spark, tmp_path, monkeypatch):
    """Twenty reviews take two pages of ten, and a book that has ended is not read again."""
    from bookpipe.plans import increment

    read = []

    def counting(pages, profile, keep):
        found = read_review_pages(pages, profile, keep).cache()
        read.extend((r.isbn[-1], r.page_no) for r in found.select("isbn", "page_no").collect())
        return found

    monkeypatch.setattr(increment, "read_review_pages", counting)
    config = RunConfig(1, 20, reviews_per_page=10, follow_pager=True)
    store = FileStore(spark, str(tmp_path / "s"))
    run_and_publish(shop(spark, books=1, pages=6), store, config=config)
    assert len(stored(store)) == 20 and sorted(read) == [("1", 1), ("1", 2)]
    # The second page of these has no next one, whatever has landed after it.
    read.clear()
    other, short = FileStore(spark, str(tmp_path / "t")), shop(spark, books=1, pages=6, each=7, last=2)
    run_and_publish(short, other, config=config)
    assert len(stored(other)) == 14 and sorted(read) == [("1", 1), ("1", 2)]
    read.clear()
    run_and_publish(short, other, config=config)
    assert read == [] and len(stored(other)) == 14
    # Another capture of a page opens the book again.
    newer = short.where("kind = 'review' and page_no = 2").selectExpr("kind", "page_no", "book_url", "page_id + 50 as page_id", "url", "html")
    run_and_publish(short.unionByName(newer), other, config=config)
    assert sorted(read) == [("1", 1), ("1", 2)]


def test_positions_on_a_page(spark):
    rows = reviews_of(read_review_pages(shop(spark, books=1, pages=2).where("kind = 'review'"), keep=("page_no",)), keep=("page_no",))
    assert sorted((r.page_no, r.pos) for r in rows.collect()) == [(p, i) for p in (1, 2) for i in range(10)]

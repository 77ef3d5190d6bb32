"""Captures over several batches, in any order, against one run over all of them."""

import itertools

import pytest
from pages import book_page, captures, review, url

from bookpipe.config import RunConfig
from bookpipe.plans.increment import run_and_publish
from bookpipe.sinks.stores import FileStore, TableStore
from bookpipe.streaming.increment import run_increment_stream

CONFIG = RunConfig(6, 5, ("Player's Handbook",))


def stored(store):
    return sorted((r.isbn, r.user, r.text) for r in store.reviews().collect())


def titles(store):
    return sorted((r.isbn, r.title, r.book_url) for r in store.attributes().collect())


def counted(store):
    return sorted(map(tuple, store.counts().collect()))


@pytest.fixture(scope="module")
def shop(spark):
    """Eight books on three listing pages; one is banned, one never captured, two URLs are one book."""
    listing = [[1, 2, 3], [4, 5, 1], [6, 7, 8]]
    books = {n: book_page(n, title=f"Book {n}") for n in (1, 3, 4, 6, 7, 8)}
    books[2] = book_page(2, title="Player's Handbook 2")
    books[5] = book_page(5, isbn="978-4", title="Book 4 again")
    reviews = {n: [[review(f"user{p}-{i}", f"text {n}") for i in range(3)] for p in range(4)] for n in range(1, 9)}
    reviews[3][0] = [review(None), review("bob", None), review("ann", "first"), review("ann", "again")]
    df = captures(spark, listing, books, reviews)
    new = captures(spark, [[1, 2, 3]], {3: book_page(3, title="Book 3, second edition")}, {4: [[review("new", "newer page")]]})
    df = df.unionByName(new.where("kind <> 'listing'").withColumn("page_id", new.page_id + 1000))
    df.cache().count()
    return df


@pytest.fixture(scope="module")
def whole(spark, shop, tmp_path_factory):
    store = FileStore(spark, str(tmp_path_factory.mktemp("whole")))
    run_and_publish(shop, store, config=CONFIG)
    assert len(stored(store)) > 10
    return stored(store), titles(store)


def parts(shop):
    """Listing, books, and review pages in two halves, odd pages apart from even ones."""
    return {
        "listing": shop.where("kind = 'listing'"),
        "books": shop.where("kind = 'book'"),
        "odd": shop.where("kind = 'review' and page_no % 2 = 1"),
        "even": shop.where("kind = 'review' and page_no % 2 = 0"),
    }


ORDERS = [
    ("even", "odd", "books", "listing"),
    ("books", "even", "listing", "odd"),
]


@pytest.mark.parametrize("order", ORDERS)
def test_any_order_of_landing(spark, tmp_path, shop, whole, order):
    landing, store, seen = str(tmp_path / "landing"), FileStore(spark, str(tmp_path / "s")), []
    for name in order:
        parts(shop)[name].coalesce(1).write.mode("append").parquet(landing)
    run_increment_stream(
        spark, landing, str(tmp_path / "cp"), store, config=CONFIG, files_per_batch=1, report=lambda i, p: seen.append((i, p))
    ).awaitTermination()
    assert [i for i, _ in seen] == [0, 1, 2, 3]
    assert (stored(store), titles(store)) == whole
    per_book = {}
    for isbn, _, _ in whole[0]:
        per_book[isbn] = per_book.get(isbn, 0) + 1
    assert counted(store) == sorted(per_book.items())


def test_listing_pages_one_by_one(spark, tmp_path, shop, whole):
    """Later listing pages land first: books that are no longer among the first leave the stores again."""
    landing, cp = str(tmp_path / "landing"), str(tmp_path / "cp")
    raw, tables = FileStore(spark, str(tmp_path / "s")), TableStore(spark, "one_books", "one_reviews", "one_rejects")
    others = shop.where("kind <> 'listing'").coalesce(1)
    for rows in (others, *(shop.where(f"kind = 'listing' and page_no = {n}").coalesce(1) for n in (3, 2, 1))):
        rows.write.mode("append").parquet(landing)
        run_increment_stream(spark, landing, cp, raw, tables, config=CONFIG).awaitTermination()
        assert titles(raw) == titles(tables)
    assert titles(raw) == whole[1] and stored(raw) == whole[0]
    assert url(8) not in {u for *_, u in titles(raw)}


def test_failed_batch_is_repeated(spark, tmp_path, shop, whole, monkeypatch):
    landing, cp = str(tmp_path / "landing"), str(tmp_path / "cp")
    raw, tables = FileStore(spark, str(tmp_path / "s")), TableStore(spark, "again_books", "again_reviews", "again_rejects")
    shop.coalesce(1).write.parquet(landing)
    calls = itertools.count()
    stage = TableStore.stage

    def fail_once(self, *args):
        if next(calls) == 0:
            raise RuntimeError("stopped between the stores")
        stage(self, *args)

    monkeypatch.setattr(TableStore, "stage", fail_once)
    with pytest.raises(Exception, match="stopped between"):
        run_increment_stream(spark, landing, cp, raw, tables, config=CONFIG).awaitTermination()
    assert stored(raw) == [] and titles(raw) == []  # the raw rows are there, but not finished
    run_increment_stream(spark, landing, cp, raw, tables, config=CONFIG).awaitTermination()
    assert stored(raw) == whole[0] and titles(raw) == titles(tables) == whole[1]


def test_larger_quota_tops_up(spark, tmp_path, shop):
    """Other parameters on the same checkpoint are another run over all that has landed."""
    landing, cp = str(tmp_path / "landing"), str(tmp_path / "cp")
    store, whole = FileStore(spark, str(tmp_path / "s")), FileStore(spark, str(tmp_path / "w"))
    more = RunConfig(6, 8, ("Player's Handbook",))
    named = parts(shop)
    for name in ("books", "listing", "even"):
        named[name].coalesce(1).write.mode("append").parquet(landing)
    run_increment_stream(spark, landing, cp, store, config=CONFIG).awaitTermination()
    before = stored(store)
    named["odd"].coalesce(1).write.mode("append").parquet(landing)
    run_increment_stream(spark, landing, cp, store, config=more).awaitTermination()
    assert set(before) <= set(stored(store))
    run_and_publish(shop, whole, config=more)
    assert titles(store) == titles(whole)
    per_book = lambda s: {isbn: len(list(g)) for isbn, g in itertools.groupby(stored(s), key=lambda r: r[0])}
    assert per_book(store) == per_book(whole)

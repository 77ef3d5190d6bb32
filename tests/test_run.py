import pytest
from pages import book_page, bullet, captures, review, url

from bookpipe.__main__ import main
from bookpipe.config import RunConfig
from bookpipe.operators.books import extract_books
from bookpipe.plans.increment import run_and_publish, run_increment
from bookpipe.sinks.stores import FileStore, TableStore
from bookpipe.streaming.increment import run_increment_stream


def many_reviews(n, pages=3, each=4, salt=""):
    return [[review(f"user{salt}-{p}-{i}", f"text {n}") for i in range(each)] for p in range(pages)]


@pytest.fixture(scope="module")
def shop(spark):
    """Ten books on three listing pages; some must be set aside."""
    listing = [[1, 2, 3, 4], [5, 6, 1], [7, 8, 9, 10]]
    books = {n: book_page(n, title=f"Book {n}") for n in range(1, 11)}
    books[2] = book_page(2, title="Player's Handbook 2")
    books[3] = book_page(3, language="english")
    books[4] = book_page(4, publisher="Press, May 2021")
    books[5] = book_page(5, pages="1,024 pages")
    del books[6]
    reviews = {n: many_reviews(n) for n in range(1, 11)}
    reviews[7][0] = [review("ann", "a"), review(None), review("bob", None), review("ann", "b", "bad")]
    df = captures(spark, listing, books, reviews).repartition(3)
    df.cache().count()
    return df


def stored(store):
    return sorted((r.isbn, r.user, r.text) for r in store.reviews().collect())


def run(shop, store, books, reviews, **more):
    config = RunConfig(books, reviews, ("Player's Handbook",), **more)
    return run_and_publish(shop, store, config=config)


def test_whole_run(spark, tmp_path, shop):
    store = FileStore(spark, str(tmp_path / "s"))
    got = run(shop, store, 10, 5)
    # Book 1 is listed twice: the target of 10 URLs ends before book 10.
    assert got.progress == (10, 4, 4) and got.progress.remaining == 2
    assert {(r.url, r.field, r.reason) for r in got.quarantine.collect()} == {
        (url(2), "title", "banned phrase"),
        (url(3), "language", "not English"),
        (url(4), "date", "no bracketed date"),
        (url(5), "pages", "not a number"),
        (url(6), "page", "not captured"),
    }
    books = {r.isbn: r for r in store.attributes().collect()}
    assert set(books) == {f"ISBN-13-978-{n}" for n in (1, 7, 8, 9)}
    one = books["ISBN-13-978-1"]
    assert (one.book_url, one.date, one.pages, one.best_seller_rank, one.review_rating, one.review_count) == (
        url(1), "May 3 2021", 304, 1234, 4.4, 12345,
    )
    per_book = {r.isbn: r["count"] for r in store.reviews().groupBy("isbn").count().collect()}
    # One user's two reviews fill two places, and the keyed store keeps the last.
    assert per_book == {"ISBN-13-978-1": 5, "ISBN-13-978-7": 4, "ISBN-13-978-8": 5, "ISBN-13-978-9": 5}
    seven = {(r.user, r.text, r.rating) for r in store.reviews().where("isbn like '%-7'").collect()}
    assert ("ann", "b", None) in seven and ("bob", None, 4) not in seven


def test_rerun_adds_nothing_and_tops_up(spark, tmp_path, shop):
    store = FileStore(spark, str(tmp_path / "s"))
    run(shop, store, 3, 5, dedup_first=True)
    before = stored(store)
    assert len(before) == 5  # of the first three books, only the first is valid
    again = run(shop, store, 1, 5, dedup_first=True)
    assert again.progress.target == 0 and again.reviews.count() == 0 and stored(store) == before
    more = run(shop, store, 1, 8, dedup_first=True)
    after = stored(store)
    assert more.attributes.count() == 0 and set(before) < set(after)
    assert len([r for r in after if r[0] == "ISBN-13-978-1"]) == 8


def test_quota_counts_what_is_saved(spark, tmp_path, shop):
    store = FileStore(spark, str(tmp_path / "s"))
    for n in (2, 5, 50):
        run(shop, store, 10, n)
        counts = [r["count"] for r in store.reviews().groupBy("isbn").count().collect()]
        assert max(counts) == min(n, 12)


def test_forms_agree(spark, tmp_path, shop):
    config = RunConfig(10, 5, ("Player's Handbook",))
    store = FileStore(spark, str(tmp_path / "s"))
    small = run_increment(shop, store, config)
    large = run_increment(shop.repartition(7, "page_id"), store, config, broadcast_rows=-1)
    sliced = run_increment(shop, store, config, pages_first=1)  # books fill up in the second reading
    for other in (large, sliced):
        for a, b in zip(small[:3], other[:3]):
            assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_reading_stops_at_the_quota(spark, tmp_path):
    """Pages beyond the quota are not parsed; books that are short are read on."""
    pages = {n: [[review(f"u{p}")] for p in range(6)] for n in (1, 2)}
    pages[2][:4] = [[review(None)]] * 4  # nothing usable on the first four pages
    df = captures(spark, [[1, 2]], {1: book_page(1), 2: book_page(2)}, pages)
    store = FileStore(spark, str(tmp_path / "s"))
    run_and_publish(df, store, config=RunConfig(2, 2))
    assert [(i[-1], u) for i, u, _ in stored(store)] == [("1", "u0"), ("1", "u1"), ("2", "u4"), ("2", "u5")]
    run_and_publish(df, store, config=RunConfig(2, 3))
    assert len([1 for i, _, _ in stored(store) if i.endswith("1")]) == 3


def test_two_stores(spark, tmp_path, shop):
    raw, tables = FileStore(spark, str(tmp_path / "s")), TableStore(spark, "r_books", "r_reviews")
    config = RunConfig(10, 5)
    run_and_publish(shop, raw, tables, config)
    # The relation has no key, so both reviews of one user stay.
    assert tables.reviews().count() == raw.reviews().count() + 1
    assert tables.attributes().count() == raw.attributes().count()
    # Five books were set aside, so the next run reaches one more; then there is none.
    again = run_and_publish(shop, raw, tables, config)
    assert again.attributes.count() == 1 and again.reviews.count() == 5
    last = run_and_publish(shop, raw, tables, config)
    assert last.attributes.count() == 0 and last.reviews.count() == 0


def test_strict_run_stops(spark, tmp_path, shop):
    with pytest.raises(Exception, match="no bracketed date"):
        run(shop, FileStore(spark, str(tmp_path / "s")), 10, 5, on_error="fail")


def test_one_book_under_two_urls(spark, tmp_path):
    df = captures(
        spark,
        [[1, 2]],
        {1: book_page(1, isbn="978-x"), 2: book_page(2, isbn="978-x")},
        {1: [[review("ann", "first"), review("bob")]], 2: [[review("ann", "second"), review("cy")]]},
    )
    store = FileStore(spark, str(tmp_path / "s"))
    got = run_and_publish(df, store, config=RunConfig(2, 5))
    assert got.attributes.count() == 1 and got.attributes.first().book_url == url(1)
    assert [(u, t) for _, u, t in stored(store)] == [("ann", "first"), ("bob", "fine"), ("cy", "fine")]


def test_newest_capture_counts(spark, tmp_path):
    old = captures(spark, [[1]], {1: book_page(1, title="Old")}, {1: [[review("ann", "old")]]})
    new = captures(spark, [[1]], {1: book_page(1, title="New")}, {1: [[review("ann", "new")]]})
    both = old.unionByName(new.withColumn("page_id", new.page_id + 100))
    store = FileStore(spark, str(tmp_path / "s"))
    run_and_publish(both, store, config=RunConfig(1, 5))
    assert store.attributes().first().title == "New" and stored(store) == [("ISBN-13-978-1", "ann", "new")]


def test_rejects(spark):
    cases = {
        "title": book_page(1, title_tag=False),
        "page": book_page(1, bullets=""),
        "bullets": book_page(1, bullets="<li>x</li>"),
        "isbn": book_page(1, bullets=bullet("Language :", "English")),
        "language": book_page(1, bullets=bullet("ISBN-13 :", "1")),
        "page ": book_page(1, products=False),
    }
    rows = [(i, name, html) for i, (name, html) in enumerate(cases.items())]
    good, bad = extract_books(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert good.count() == 0
    assert {r.url: r.field for r in bad.collect()} == {name: name.strip() for name in cases}


def test_stream_equals_batch(spark, tmp_path, shop):
    config = RunConfig(10, 5, ("Player's Handbook",))
    whole = FileStore(spark, str(tmp_path / "whole"))
    run_and_publish(shop, whole, config=config)

    landing = str(tmp_path / "landing")
    store = FileStore(spark, str(tmp_path / "stream"))
    shop.coalesce(1).write.mode("append").parquet(landing)

    seen = []

    def drain():
        run_increment_stream(
            spark, landing, str(tmp_path / "cp"), store, config=config, report=lambda i, p: seen.append((i, p.target, p.accepted))
        ).awaitTermination()

    drain()
    assert stored(store) == stored(whole)
    assert seen == [(0, 10, 4)]
    drain()  # nothing has landed: nothing happens
    assert stored(store) == stored(whole)
    shop.coalesce(1).write.mode("append").parquet(landing)
    drain()  # the same pages again: under-reviewed books are revisited, nothing is added
    assert set(stored(store)) >= set(stored(whole))


def test_repeated_batch_replaces_itself(spark, tmp_path, shop):
    store = FileStore(spark, str(tmp_path / "s"))
    config = RunConfig(10, 5)
    run_and_publish(shop, store, config=config, batch="b1")
    first = stored(store)
    run_and_publish(shop, store, config=config, batch="b1")
    assert stored(store) == first and store.attributes().count() == 4 + 1


def test_command_line(spark, tmp_path, shop, capsys):
    landing = str(tmp_path / "landing")
    shop.write.parquet(landing)
    main(["10", "5", "--captures", landing, "--store", str(tmp_path / "s"), "--banned", "Player's Handbook"])
    assert "target 10, accepted 4, rejected 4, remaining 2" in capsys.readouterr().out


def test_config_is_checked():
    with pytest.raises(ValueError):
        RunConfig(banned_titles="one phrase")
    with pytest.raises(ValueError):
        RunConfig(count_mode="x")
    with pytest.raises(ValueError):
        RunConfig(num_books=-1)

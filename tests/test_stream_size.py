"""What a stream writes of its captures, and the rows it has for a repeated or odd capture."""

from bookpipe.config import RunConfig
from bookpipe.sinks.stores import FileStore
from bookpipe.streaming import increment
from tests.pages import book_page, listing_page, review, review_page


def test_landed_pages_are_small_files_and_small_splits(spark, tmp_path, monkeypatch):
    rows = [("listing", 1, None, 0, "https://shop.example/s?page=1", listing_page(range(1, 4), True))]
    rows += [("book", None, None, n, f"https://shop.example/dp/{n}/", book_page(n)) for n in range(1, 4)]
    rows += [
        ("review", page, f"https://shop.example/dp/{n}/", n * 10 + page, f"https://shop.example/r/{n}/{page}", review_page([review(f"u{n}-{page}")], page < 2))
        for n in range(1, 4)
        for page in (1, 2)
    ]
    rows += [rows[-1], ("review", None, None, None, None, None)]
    landing, checkpoint, splits, work = str(tmp_path / "landing"), str(tmp_path / "state"), [], increment.work_batch
    schema = "kind string, page_no bigint, book_url string, page_id bigint, url string, html string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(landing)

    def seen(archive, state, stores, captures, *rest):
        splits.append(captures.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
        return work(archive, state, stores, captures, *rest)

    monkeypatch.setattr(increment, "work_batch", seen)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    store = FileStore(spark, str(tmp_path / "store"))
    increment.run_increment_stream(spark, landing, checkpoint, store, config=RunConfig(3, 2)).awaitTermination()
    assert splits == ["16m"] and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    files = list((tmp_path / "state" / "captures" / "landed").rglob("*.parquet"))
    assert files and all(".zstd." in file.name for file in files)
    assert sorted(r.user for r in store.reviews().collect()) == [f"u{n}-{page}" for n in range(1, 4) for page in (1, 2)]

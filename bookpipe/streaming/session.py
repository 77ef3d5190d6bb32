"""One run whose captures land over many batches, in any order.

The state of a session is a folder of tables, each with one partition for each batch:

* ``landed``: the captures, laid out by kind and bucket of their book, so that a batch
  reads only the buckets of books it has something to do for (one table a checkpoint,
  shared by the sessions on it);
* ``links``, ``books``, ``read``: what listing, book and review pages have said. A page is
  parsed once: a book page when the book is listed, a review page when its book is valid
  and wants reviews from it. Until then it waits in ``landed``;
* ``frontier``, ``published``: the books of the run after each batch, and what the stores
  hold of each, as a digest.

Work target, satisfied books and saved rows are those of the first batch: the session is
one run. What it stores is a function of all captures that have landed, so their order
does not matter. A page that comes late may change what a book should have had, or which
books are listed first; then the batch stores the book anew and voids what an earlier
batch has stored of it. Books that nothing new concerns are not looked at.

A batch that is repeated after a failure replaces its own partitions and rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.config import RunConfig
from bookpipe.operators.books import parse_books
from bookpipe.operators.counts import orphans, satisfied_urls, work_target
from bookpipe.operators.joins import BROADCAST_ROWS, dealt, members, unseen, without
from bookpipe.operators.listing import links_of, read_listing_pages
from bookpipe.operators.ranking import first_k, one_per_key
from bookpipe.operators.validate import split_by_verdict
from bookpipe.plans.increment import DueBooks, Progress, follow_one_ledger, missing_reviews, one_row_a_page, pages_of
from bookpipe.profile import SHOP, SiteProfile
from bookpipe.schema import BOOK, CAPTURE, QUARANTINE, conform, nullable
from bookpipe.session import checkpointed
from bookpipe.sinks.stores import Store
from bookpipe.sources.pages import Captures, laid_out
from bookpipe.sources.raw_tree import path_exists

BATCH_NO = "batch_no"
LANDED = T.StructType([*CAPTURE.fields, T.StructField("bucket", T.IntegerType())])


def fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


LONG, TEXT = T.LongType(), T.StringType()
LINK = fields(page_no=LONG, page_id=LONG, pos=T.IntegerType(), url=TEXT)
VERDICT = fields(field=TEXT, reason=TEXT, hard=T.BooleanType())
PARSED = T.StructType([*nullable(BOOK).fields, *fields(page_id=LONG, url=TEXT, verdict=VERDICT).fields])
REVIEWS = T.ArrayType(fields(user=TEXT, text=TEXT, stars=TEXT))
READ = fields(book_url=TEXT, page_no=LONG, page_id=LONG, reviews=REVIEWS, more=T.BooleanType())
FRONTIER = fields(url=TEXT, rank=LONG)
PUBLISHED = fields(isbn=TEXT, mark=TEXT)
OUTCOME = fields(isbn=TEXT, text=TEXT, rating=T.IntegerType(), user=TEXT, position=LONG)
GOAL = fields(target=LONG, first=T.IntegerType())


class SessionState:
    """Tables of a session, by batch."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, name: str, rows: DataFrame, batch: int, by: Sequence[str] = ()) -> None:
        """What a batch adds to a table; a repeated batch replaces it."""
        # Pages of one site are much alike: zstd makes far less of them than the default.
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(f"{self.path}/{name}/{BATCH_NO}={batch}")

    def get(self, name: str, schema: T.StructType, first: int = 0, last: int | None = None) -> DataFrame:
        """Rows of the batches ``first`` to ``last`` with ``batch_no``."""
        columns = T.StructType([*schema.fields, T.StructField(BATCH_NO, T.IntegerType())])
        if not path_exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], columns)
        rows = self.spark.read.schema(columns).parquet(f"{self.path}/{name}")
        rows = rows.where(F.col(BATCH_NO) >= first)
        return rows if last is None else rows.where(F.col(BATCH_NO) <= last)

    def goal(self) -> tuple[int, int] | None:
        """The work target and the first batch of the session, once they are fixed."""
        if not path_exists(self.spark, f"{self.path}/goal/_SUCCESS"):
            return None
        return tuple(self.spark.read.schema(GOAL).parquet(f"{self.path}/goal").first())

    def start(self, satisfied: DataFrame, target: int, batch: int) -> None:
        """Fix what holds for the whole session, as its first batch has found it."""
        satisfied.select(F.col("book_url").alias("url")).distinct().write.mode("overwrite").parquet(f"{self.path}/satisfied")
        self.spark.createDataFrame([(target, batch)], GOAL).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/goal")

    def satisfied(self) -> DataFrame:
        return self.spark.read.schema(fields(url=TEXT)).parquet(f"{self.path}/satisfied")


def session_name(place: str, config: RunConfig) -> str:
    """Names a session's batches in the stores: other places and other parameters make other sessions."""
    return f"stream-{hashlib.sha256(repr((place, config)).encode()).hexdigest()[:12]}"


def mark_of(rows: DataFrame, names: Sequence[str]) -> Column:
    """A digest of a group of rows, whatever their order."""
    return F.concat_ws("-", F.count("*").cast("string"), F.sum(F.xxhash64(*names).cast("decimal(38,0)")).cast("string"))


def work_batch(
    archive: SessionState,
    state: SessionState,
    stores: Sequence[Store],
    captures: DataFrame,
    batch: int,
    name: str,
    config: RunConfig = RunConfig(),
    profile: SiteProfile = SHOP,
) -> Progress:
    """Work what a batch has brought, and publish what it changes."""
    if config.sort_by != "listing":
        raise ValueError("a stream takes books in the order they are listed in")
    ledger = follow_one_ledger(stores)
    store, own, label = stores[-1], f"{name}-*", f"{name}-{batch:012d}"
    archive.put("landed", laid_out(captures), batch, by=("kind", "bucket"))

    attributes, counts = store.attributes(own), store.counts(config.count_mode, own)
    if state.goal() is None:
        known = checkpointed(satisfied_urls(counts, attributes, config.num_reviews))
        state.start(known, work_target(known.count(), config.num_books, config.surplus), batch)
    target, first = state.goal()
    satisfied = state.satisfied()
    landed = Captures.of(archive.get("landed", LANDED, last=batch).drop(BATCH_NO))
    # To a session that starts, all that has landed under its checkpoint is new.
    fresh = landed if batch == first else Captures.of(archive.get("landed", LANDED, first=batch, last=batch).drop(BATCH_NO))

    before = state.get("frontier", FRONTIER, first=batch - 1, last=batch - 1).drop(BATCH_NO)
    frontier = _frontier(state, landed, fresh, satisfied, target, batch, profile)
    parsed, rejected_now = _books(state, landed, frontier, target, batch, config, profile)

    # Books that something new concerns: their pages, their place in the listing, or another URL of the same book.
    moved = before.join(frontier, "url", "full").where(before["rank"].isNull() | frontier["rank"].isNull()).select("url")
    news = fresh.books.select(F.col("book_url").alias("url")).unionByName(fresh.reviews.select(F.col("book_url").alias("url")))
    every = state.get("books", PARSED, last=batch).drop(BATCH_NO)
    touched = members(every.select("url", "isbn"), news.unionByName(moved), "url").select("isbn")
    doubled = every.groupBy("isbn").agg(F.count_distinct("url").alias("_urls")).where("_urls > 1").select("isbn")
    touched = checkpointed(touched.unionByName(doubled).where("isbn is not null").distinct())

    valid, _ = split_by_verdict(parsed, config.on_error)
    books_now, reviews_now = _outcome(state, store, landed, members(valid, touched, "isbn"), touched, target, batch, own, config, profile)
    changed = _changes(state, books_now, reviews_now, touched, batch)
    rejects = rejected_now if batch != first else rejected_now.unionByName(orphans(counts, attributes, config.num_reviews))
    rejects = checkpointed(conform(rejects, QUARANTINE))
    if not (changed.isEmpty() and rejects.isEmpty()):
        replaced = changed.where("_stored is not null").select("isbn", F.format_string(f"{name}-%012d", "_stored").alias("void"))
        books_out, reviews_out = checkpointed(members(books_now, changed, "isbn")), checkpointed(members(reviews_now, changed, "isbn"))
        if ledger is not None:
            ledger.withdraw(label)
        for each in stores:
            each.stage(books_out, reviews_out, label)
            each.reject(rejects, label)
            each.void(replaced, label)
        if ledger is not None:
            ledger.commit(label)
    outcome = parsed.agg(F.count_if(F.col("verdict").isNull()), F.count_if(F.col("verdict").isNotNull())).first()
    return Progress(target, *outcome)


def _outcome(
    state: SessionState,
    store: Store,
    landed: Captures,
    valid: DataFrame,
    touched: DataFrame,
    target: int,
    batch: int,
    own: str,
    config: RunConfig,
    profile: SiteProfile,
) -> tuple[DataFrame, DataFrame]:
    """What the stores should hold of the touched books: attributes, and reviews with their places."""
    read = state.get("read", READ, last=batch - 1).drop(BATCH_NO)
    if touched.isEmpty():
        state.put("read", read.limit(0), batch)
        spark = state.spark
        return spark.createDataFrame([], nullable(BOOK)), spark.createDataFrame([], OUTCOME)
    attributes, counts = store.attributes(own), store.counts(config.count_mode, own)
    due = DueBooks(valid, attributes, valid.limit(0), Progress(target, 0, 0), store.reviews(own), counts)
    reading = missing_reviews(landed.reviews, due, config, profile, known=read)
    state.put("read", read.limit(0) if reading.pages is None else reading.pages.select(*READ.names), batch)
    books = checkpointed(conform(unseen(valid, attributes, "isbn", ["rank"]), BOOK))
    return books, checkpointed(reading.reviews.select(*OUTCOME.names))


def _frontier(
    state: SessionState, landed: Captures, fresh: Captures, satisfied: DataFrame, target: int, batch: int, profile: SiteProfile
) -> DataFrame:
    """The first listed books that were not satisfied, by all listing pages so far."""
    listed = read_listing_pages(fresh.listing, profile, keep=("page_no", "page_id"))
    listed = one_per_key(listed, ["page_no", "page_id"], [F.xxhash64("links")])
    state.put("links", links_of(listed, keep=("page_no", "page_id")), batch)
    newest = landed.listing.groupBy("page_no").agg(F.max("page_id").alias("page_id"))
    links = state.get("links", LINK, last=batch).drop(BATCH_NO)
    # The same capture may land in several batches.
    links = links.join(dealt(newest), ["page_no", "page_id"], "left_semi").distinct()
    first = first_k(without(links, satisfied, "url"), ["page_no", "pos", "url"], target)
    state.put("frontier", first.groupBy("url").agg(F.min("rank").alias("rank")), batch)
    return state.get("frontier", FRONTIER, first=batch, last=batch).drop(BATCH_NO)


def _books(
    state: SessionState, landed: Captures, frontier: DataFrame, target: int, batch: int, config: RunConfig, profile: SiteProfile
) -> tuple[DataFrame, DataFrame]:
    """The newest page of each listed book as parsed, with its rank; and what this batch has set aside."""
    known = state.get("books", PARSED, last=batch - 1).drop(BATCH_NO)
    pages = landed.books.withColumn("url", F.col("book_url")).drop("book_url", "page_no")
    wanted = pages.select("url", "page_id").groupBy("url").agg(F.max("page_id").alias("page_id"))
    wanted = wanted.join(dealt(known.select("url", "page_id")), ["url", "page_id"], "left_anti")
    new = members(frontier, wanted, "url")
    bodies = pages_of(pages, new.select("url"), "url", ["url"], target, BROADCAST_ROWS)
    rows = one_row_a_page(parse_books(bodies, config, profile))
    state.put("books", rows.select(*PARSED.names), batch)
    now = state.get("books", PARSED, first=batch, last=batch).drop(BATCH_NO)
    newest = known.unionByName(now).join(dealt(frontier), "url")
    newest = one_per_key(newest, ["url"], [F.desc("page_id")])
    _, rejected = split_by_verdict(now)
    return checkpointed(newest), rejected


def _changes(state: SessionState, books: DataFrame, reviews: DataFrame, touched: DataFrame, batch: int) -> DataFrame:
    """(isbn, _stored): books whose rows are other than the stores hold, with the batch that stored them."""
    parts = []
    for rows, mark in ((books, "_books"), (reviews, "_reviews")):
        parts.append(rows.groupBy("isbn").agg(mark_of(rows, rows.columns).alias(mark)))
    marked = touched.join(parts[0], "isbn", "left").join(parts[1], "isbn", "left")
    now = marked.select("isbn", F.nullif(F.concat_ws("/", "_books", "_reviews"), F.lit("")).alias("mark"))
    log = state.get("published", PUBLISHED, last=batch - 1)
    held = log.groupBy("isbn").agg(F.max(F.struct(BATCH_NO, "mark")).alias("_held"))
    compared = now.join(held, "isbn", "left").where(~F.col("mark").eqNullSafe(F.col("_held.mark")))
    changed = checkpointed(
        compared.select("isbn", "mark", F.when(F.col("_held.mark").isNotNull(), F.col(f"_held.{BATCH_NO}")).alias("_stored"))
    )
    state.put("published", changed.select("isbn", "mark"), batch)
    return changed

"""One incremental run over captured pages."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bookpipe.config import RunConfig
from bookpipe.functions.urls import normalize_url
from bookpipe.operators.books import parse_books
from bookpipe.operators.counts import orphans, satisfied_urls, work_target
from bookpipe.operators.joins import BROADCAST_ROWS, dealt, dealt_to_pages, likely, members, narrow, unseen, with_saved_count, without
from bookpipe.operators.listing import all_links, unsatisfied_links
from bookpipe.operators.ranking import first_k, one_per_key, top_per_group
from bookpipe.operators.reviews import fill_reviews, read_review_pages, reviews_of, up_to_last
from bookpipe.operators.validate import split_by_verdict
from bookpipe.profile import SHOP, SiteProfile
from bookpipe.schema import BOOK, QUARANTINE, conform
from bookpipe.session import checkpointed
from bookpipe.sinks.ledger import Ledger
from bookpipe.sinks.stores import Store
from bookpipe.sources.pages import Captures, in_buckets, latest


class Progress(NamedTuple):
    """Books in the work target, and what became of them."""

    target: int
    accepted: int
    rejected: int

    @property
    def remaining(self) -> int:
        return self.target - self.accepted - self.rejected


class Increment(NamedTuple):
    """What a run adds."""

    attributes: DataFrame
    reviews: DataFrame
    quarantine: DataFrame
    progress: Progress
    exhausted: DataFrame


class DueBooks(NamedTuple):
    """The books of a run: valid ones, set-aside ones, and what is saved so far."""

    valid: DataFrame
    attributes: DataFrame
    quarantine: DataFrame
    progress: Progress
    saved: DataFrame
    counts: DataFrame


def due_books(
    captures: Captures,
    store: Store,
    config: RunConfig = RunConfig(),
    profile: SiteProfile = SHOP,
    batch: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DueBooks:
    """The frontier, parsed and judged.

    Only pages of frontier books are parsed. What later steps share is written to
    the shared folder on the way: satisfied books, links, the frontier and the
    parsed books, all without page bodies.
    """
    attributes, saved = store.attributes(batch), store.reviews(batch)

    counts = store.counts(config.count_mode, batch)
    satisfied = checkpointed(satisfied_urls(counts, attributes, config.num_reviews))
    target = work_target(satisfied.count(), config.num_books, config.surplus)

    listing = latest(captures.listing, ["page_no"])
    landed = captures.books.withColumn("url", normalize_url(F.col("url")))
    done = satisfied.withColumnRenamed("book_url", "url")
    if config.sort_by == "reviews":
        listed = most_reviewed_links(all_links(listing, done, profile), landed, target, profile)
    else:
        listed = first_k(unsatisfied_links(listing, done, target, profile), ["page_no", "pos"], target)
    # A book listed twice is worked once, at its first place.
    books_due = checkpointed(listed.groupBy("url").agg(F.min("rank").alias("rank")))

    pages = pages_of(landed, books_due, "url", ["url"], target, broadcast_rows)
    seen = Observation("books")
    parsed = checkpointed(
        one_row_a_page(parse_books(pages, config, profile, keep=("rank",))).observe(
            seen,
            F.count_if(F.col("verdict").isNull()).alias("accepted"),
            F.count_if(F.col("verdict").isNotNull()).alias("rejected"),
        )
    )
    good, rejected = split_by_verdict(parsed, config.on_error)
    absent = books_due.join(dealt(parsed.select("url")), "url", "left_anti").select(
        F.lit(None).cast("bigint").alias("page_id"),
        "url",
        F.lit("page").alias("field"),
        F.lit("not captured").alias("reason"),
    )

    unknown = orphans(counts, attributes, config.num_reviews)
    outcome = seen.get
    return DueBooks(
        good,
        conform(unseen(good, attributes, "isbn", ["rank"]), BOOK),
        conform(rejected.unionByName(unknown).unionByName(absent), QUARANTINE),
        Progress(target, outcome["accepted"], outcome["rejected"]),
        saved,
        counts,
    )


def most_reviewed_links(links: DataFrame, books: DataFrame, k: int, profile: SiteProfile = SHOP) -> DataFrame:
    """The first ``k`` links by what the newest captured page of their book says of its reviews.

    Every captured page of a listed book is parsed for that, since any may be the first;
    books without a page, or without a count on it, come last, in the order of the listing.
    """
    wanted = members(books.select("url", "page_id"), links, "url").groupBy("url").agg(F.max("page_id").alias("page_id"))
    bodies = books.join(dealt_to_pages(wanted), ["url", "page_id"])
    said = one_row_a_page(parse_books(bodies, profile=profile)).select("url", "review_count")
    counted = checkpointed(links.join(dealt(said), "url", "left"))
    return first_k(counted, [F.desc_nulls_last("review_count"), "page_no", "pos"], k).drop("review_count")


def one_row_a_page(parsed: DataFrame) -> DataFrame:
    """One of several captures with one id, by what they say: the same in every attempt."""
    return one_per_key(parsed, ["url", "page_id"], [F.xxhash64(*(c for c in parsed.columns if c not in ("url", "page_id")))])


def run_increment(
    captures: Captures | DataFrame,
    store: Store,
    config: RunConfig = RunConfig(),
    profile: SiteProfile = SHOP,
    batch: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    pages_first: int | None = None,
) -> Increment:
    """The books and reviews that are still missing, nothing else."""
    captures = captures if isinstance(captures, Captures) else Captures.of(captures)
    due = due_books(captures, store, config, profile, batch, broadcast_rows)
    review_pages = captures.reviews.withColumn("book_url", normalize_url(F.col("book_url")))
    reading = missing_reviews(review_pages, due, config, profile, broadcast_rows, pages_first, store.exhausted(batch))
    kept = reading.reviews.select("isbn", "text", "rating", "user", "position")
    return Increment(due.attributes, kept, due.quarantine, due.progress, reading.exhausted)


def pages_of(
    pages: DataFrame,
    books: DataFrame,
    on: str,
    page_key: Sequence[str],
    bound: int,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The newest captures of the pages of the given books, with the books' columns.

    Which pages are wanted is worked out on keys alone. Of few books it is broadcast
    (one row a book, as ``page_key`` is its page), and page bodies stay where they are;
    else bodies move once, by a key that holds their page id, so that a book with very
    many pages is spread evenly. A capture that has landed twice comes twice: repeats
    are taken out after parsing, on narrow rows.
    """
    books, keys = in_buckets(pages, books, on)
    wanted = pages.select(*page_key, "page_id", *keys[1:])
    near = wanted.join(F.broadcast(books.select(*keys)), keys, "left_semi") if bound <= broadcast_rows else wanted
    few = bound <= broadcast_rows
    newest = near.groupBy(*page_key, *keys[1:]).agg(F.max("page_id").alias("page_id")).join(books if few else dealt(books), keys)
    return pages.join(F.broadcast(newest) if few else dealt_to_pages(newest), [*page_key, "page_id", *keys[1:]])


PAGE = ("book_url", "page_no", "page_id")


def page_marks(keys: DataFrame) -> DataFrame:
    """``(book_url, pages, mark)``: which captures of review pages a book has."""
    return keys.groupBy("book_url").agg(
        F.count("*").alias("pages"), F.sum(F.xxhash64("page_no", "page_id").cast("decimal(38,0)")).alias("mark")
    )


def bodies_of(pages: DataFrame, wanted: DataFrame, small: bool) -> DataFrame:
    """The given captures of review pages. Of many, only bodies that are likely to be wanted are dealt."""
    wanted, on = in_buckets(pages, wanted, "book_url")
    if small:
        return pages.join(F.broadcast(wanted), [*PAGE, *on[1:]])
    return likely(pages, wanted, PAGE).join(dealt_to_pages(wanted), [*PAGE, *on[1:]])


class Reading(NamedTuple):
    """New reviews of a run, the books of which nothing is left to read, and the pages that were read."""

    reviews: DataFrame
    exhausted: DataFrame
    pages: DataFrame | None


def missing_reviews(
    pages: DataFrame,
    due: DueBooks,
    config: RunConfig = RunConfig(),
    profile: SiteProfile = SHOP,
    broadcast_rows: int = BROADCAST_ROWS,
    pages_first: int | None = None,
    exhausted: DataFrame | None = None,
    known: DataFrame | None = None,
) -> Reading:
    """The new reviews of the given books, without reading what is not needed.

    Pages are read in rounds. The first reads as many pages of each book as hold the
    reviews it wants; each later one reads on in books that are still short, by what
    their pages have yielded, so a book with very many pages costs no more than others
    once its quota is met. With ``follow_pager`` a book ends at the first page without a
    next one. ``exhausted`` names books that an earlier run has read to the end: they
    are not read again unless other captures of their pages are there. ``known`` holds
    pages as they were read before (``(book_url, page_no, page_id, reviews, more)``), in
    whatever order; of a full book, pages that come before its last review are then read.
    """
    n, bound = config.num_reviews, due.progress.target
    first = max(pages_first or -(-n // config.reviews_per_page), 1)
    books = due.valid.select("book_url", "isbn", "rank")
    saved = narrow(due.saved.select("isbn", "user"), books, "isbn", bound, broadcast_rows)
    counts = narrow(due.counts, books, "isbn", bound, broadcast_rows)
    page_key, order = ["book_url", "page_no"], ("rank", "page_no", "pos")
    wanted, on = in_buckets(pages, books, "book_url")
    near = pages.select(*PAGE, *on[1:])
    near = narrow(near, wanted, on, bound, broadcast_rows) if bound <= broadcast_rows else likely(near, wanted, on)
    keys = near.groupBy(*page_key).agg(F.max("page_id").alias("page_id"))
    if exhausted is not None:
        old = exhausted.select("book_url", "pages", "mark").distinct()
        keys = without(keys, page_marks(keys).join(dealt(old), ["book_url", "pages", "mark"], "left_semi"), "book_url")
    keys = checkpointed(keys.join(dealt(books), "book_url"))

    def read(wanted: DataFrame, small: bool) -> DataFrame:
        # A capture may land twice: one of equal ones is taken after parsing, on narrow rows, by what it says.
        rows = read_review_pages(bodies_of(pages, wanted, small), profile, keep=("isbn", "rank", *PAGE))
        return one_per_key(rows, ["rank", *PAGE], [F.xxhash64("reviews", "more")])

    if known is None or known.isEmpty():
        head = checkpointed(top_per_group(keys, ["isbn"], ["rank", "page_no"], first, "_place").drop("_place"))
        found, read_now = None, []
    else:
        head, found, read_now = None, checkpointed(known.select(*PAGE, "reviews", "more").join(dealt(keys), list(PAGE))), []
    open_books, parts, small = books.select("isbn").distinct(), [], bound * first <= broadcast_rows
    while True:
        if head is not None:
            more = checkpointed(read(head, small))
            read_now.append(more)
            found = more if found is None else checkpointed(found.unionByName(more))
        visited = up_to_last(found) if config.follow_pager else found
        reviews = reviews_of(visited, keep=("isbn", "rank", "page_no"))
        filled = checkpointed(fill_reviews(reviews, saved, n, order, counts, config.dedup_first, visit="rank"))
        got = filled.groupBy("isbn").agg(F.count("*").alias("got"), F.max(F.struct("rank", "page_no")).alias("_upto"))
        seen = found.groupBy("isbn").agg(F.count("*").alias("_read"))
        state = open_books.join(dealt(seen), "isbn", "left").join(dealt(got), "isbn", "left").fillna(0, ["got", "_read"])
        state = with_saved_count(state, counts).withColumn("_lack", n - F.col("saved") - F.col("got"))
        left = keys.join(dealt(state), "isbn").join(dealt(found.select(*page_key)), page_key, "left_anti")
        left = left.where((F.col("_lack") > 0) | (F.struct("rank", "page_no") < F.col("_upto")))
        if config.follow_pager:
            ends = found.where(~F.col("more")).groupBy("book_url").agg(F.min("page_no").alias("_end"))
            left = left.join(dealt(ends), "book_url", "left").where("_end is null or page_no < _end").drop("_end")
        # What a book lacks, at the yield of its pages so far; four times as many pages as before at most.
        wish = F.ceil(F.col("_lack") * F.col("_read") / F.greatest("got", F.lit(1)))
        wish = F.when((F.col("_read") == 0) | (F.col("_lack") <= 0), F.lit(first)).otherwise(
            F.least(F.greatest(wish, F.lit(1)), 4 * F.col("_read"))
        )
        short = checkpointed(left.groupBy("isbn").agg(F.max(wish).cast("int").alias("_wish")))
        widest = short.agg(F.max("_wish")).first()[0]
        if widest is None:
            parts.append(filled)
            break
        parts.append(without(filled, short, "isbn"))
        ahead = top_per_group(members(left.select(*keys.columns), short, "isbn"), ["isbn"], ["rank", "page_no"], widest, "_place")
        head = checkpointed(ahead.join(dealt(short), "isbn").where("_place <= _wish").select(*keys.columns))
        found, open_books, small = members(found, short, "isbn"), short.select("isbn"), False
    new = reduce(DataFrame.unionByName, parts)
    got = new.groupBy("isbn").agg(F.count("*").alias("got"))
    lacking = with_saved_count(books.join(dealt(got), "isbn", "left").fillna(0, ["got"]), counts)
    ended = lacking.where(F.col("got") < n - F.col("saved"))
    marks = page_marks(members(keys, ended, "book_url").select(*PAGE))
    return Reading(new, marks, reduce(DataFrame.unionByName, read_now) if read_now else None)


def follow_one_ledger(stores: Sequence[Store]) -> Ledger | None:
    """Let all stores of a run go by the ledger of the first one that has any."""
    ledger = next((store.ledger for store in stores if store.ledger is not None), None)
    if ledger is not None:
        ledger.open(sorted({batch for store in stores for batch in store.batches()}))
        for store in stores:
            store.ledger = ledger
    return ledger


def batch_of(captures: Captures, config: RunConfig, ledger: Ledger | None) -> str:
    """A name that the same run gets again when it is repeated after a failure.

    It stands for the pages (by their keys; bodies are not read), the parameters and
    what was finished before: an unfinished attempt changes none of them.
    """
    keys = ("page_no", "book_url", "page_id", "url")
    marks = []
    for pages in captures:
        named = [F.col(c).cast("string") if c in pages.columns else F.lit(None).cast("string") for c in keys]
        total = pages.agg(F.count("*"), F.sum(F.xxhash64(*named).cast("decimal(38,0)"))).first()
        marks.append(tuple(map(str, total)))
    done = [] if ledger is None else ledger.batches()
    return f"run-{hashlib.sha256(repr((marks, config, done)).encode()).hexdigest()[:32]}"


def publish(increment: Increment, stores: Sequence[Store], batch: str | None = None) -> Increment:
    """The same rows and rejects to every store; returns the increment as written.

    The rows are fixed before the first store changes what counts as saved, and
    they count in no store until all stores have them.
    """
    batch = batch or f"run-{uuid.uuid4().hex}"
    ledger = follow_one_ledger(stores)
    fixed = increment._replace(
        attributes=checkpointed(increment.attributes),
        reviews=checkpointed(increment.reviews),
        quarantine=checkpointed(increment.quarantine),
        exhausted=checkpointed(increment.exhausted),
    )
    if ledger is not None:
        ledger.withdraw(batch)
    for store in stores:
        store.stage(fixed.attributes, fixed.reviews, batch)
        store.reject(fixed.quarantine, batch)
        store.mark(fixed.exhausted, batch)
    if ledger is not None:
        ledger.commit(batch)
    return fixed


def run_and_publish(
    captures: Captures | DataFrame,
    raw: Store,
    relational: Store | None = None,
    config: RunConfig = RunConfig(),
    profile: SiteProfile = SHOP,
    batch: str | None = None,
) -> Increment:
    """A whole run: saved state from the relational store if there is one.

    A run that failed and is repeated on the same pages finds the name of its batch
    again and replaces what it had written.
    """
    captures = captures if isinstance(captures, Captures) else Captures.of(captures)
    stores = [raw] if relational is None else [raw, relational]
    ledger = follow_one_ledger(stores)
    batch = batch or batch_of(captures, config, ledger)
    increment = run_increment(captures, stores[-1], config, profile, batch)
    return publish(increment, stores, batch)

"""Repeated runs as captures land."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bookpipe.config import RunConfig
from bookpipe.operators.reviews import fill_reviews
from bookpipe.plans.increment import Progress
from bookpipe.profile import SHOP, SiteProfile
from bookpipe.schema import CAPTURE, nullable
from bookpipe.sinks.stores import Store
from bookpipe.streaming.session import SessionState, session_name, work_batch

# Bytes of a split where they are at Spark's default, and then for landed pages, which are several times larger once read.
DEFAULT_SPLIT, PAGES_SPLIT = str(128 << 20), "16m"


def run_increment_stream(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    raw: Store,
    relational: Store | None = None,
    config: RunConfig = RunConfig(),
    profile: SiteProfile = SHOP,
    files_per_batch: int | None = None,
    report: Callable[[int, Progress], None] | None = None,
) -> StreamingQuery:
    """Work every capture file that has landed since the last call, then stop.

    All calls with one checkpoint are one run, over all captures that have landed: a
    book's listing entry, its own page and its review pages may land in any batches and
    in any order, and the stores end up with the rows of one run over all of them (see
    :mod:`bookpipe.streaming.session`, whose tables lie below the checkpoint). Other
    parameters or another checkpoint make another run, which tops up what is stored. A
    batch that is repeated after a failure has the same id and replaces what it wrote.
    ``report`` is told the progress of each batch (P7).
    """
    name = session_name(checkpoint, config)
    archive = SessionState(spark, f"{checkpoint.rstrip('/')}/captures")
    state = SessionState(spark, f"{checkpoint.rstrip('/')}/{name}")
    stores = [raw] if relational is None else [raw, relational]

    def work(captures: DataFrame, batch_id: int) -> None:
        # The stream has a session of its own. A split of pages that is small as a file is sorted by bucket in memory.
        conf, split = captures.sparkSession.conf, "spark.sql.files.maxPartitionBytes"
        if conf.get(split).rstrip("Bb") == DEFAULT_SPLIT:
            conf.set(split, PAGES_SPLIT)
        progress = work_batch(archive, state, stores, captures, batch_id, name, config, profile)
        if report is not None:
            report(batch_id, progress)

    source = spark.readStream.schema(nullable(CAPTURE))
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    return (
        source.parquet(landing)
        .writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def fill_reviews_stream(
    reviews: DataFrame, store: Store, num_reviews: int, order: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Keep the first ``num_reviews`` reviews of each book of a review stream.

    ``reviews`` is a stream of ``(isbn, user, text, rating)`` and the ``order``
    columns. The quota is refilled against the store in every batch (J3, J5, O1).
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        name = f"stream-{batch_id:012d}"
        new = fill_reviews(batch, store.reviews(name), num_reviews, order)
        store.write(store.attributes().limit(0), new, name)

    return (
        reviews.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Token counts of a corpus from its exact length histogram.

Documents are counted by encoded length, a table that is bounded by the longest
document however many documents there are. Suffix sums over it answer, for a limit
of any length, how many documents are at least as long and how many tokens are left
when each document is cut there; the running share answers quantiles.

Cases: null and empty texts have length 0. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookpipe.llm import bpe
from bookpipe.llm.common import shared_path

#: Lengths to a block; sums run over blocks, then within each.
BLOCK = 1_024


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs) from a table with column n_tokens."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """For each occurring length: what is at or above it, and totals cut there.

    n_docs; docs_at_least, tokens_at_least (documents of this length or more);
    truncated_tokens (the corpus total if every document keeps at most n_tokens);
    total_docs, total_tokens; quantile (share of documents no longer than this).
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocks = counts.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK))
    sums = blocks.groupBy("_block").agg(F.sum("n_docs").alias("_docs"), F.sum(tokens).alias("_tokens"))
    after = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sums = sums.select(
        "_block",
        F.coalesce(F.sum("_docs").over(after), F.lit(0)).alias("_docs_after"),
        F.coalesce(F.sum("_tokens").over(after), F.lit(0)).alias("_tokens_after"),
        F.sum("_docs").over(everything).alias("total_docs"),
        F.sum("_tokens").over(everything).alias("total_tokens"),
    )
    within = Window.partitionBy("_block").orderBy(F.desc("n_tokens"))
    at_least = blocks.join(sums, "_block").select(
        "n_tokens",
        "n_docs",
        (F.col("_docs_after") + F.sum("n_docs").over(within)).alias("docs_at_least"),
        (F.col("_tokens_after") + F.sum(tokens).over(within)).alias("tokens_at_least"),
        "total_docs",
        "total_tokens",
    )
    cut = F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    shorter = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    return at_least.withColumn("truncated_tokens", cut).withColumn("quantile", shorter / F.col("total_docs"))


def at_limit(sums: DataFrame, limit: int) -> DataFrame:
    """One row: documents and tokens kept whole or cut at any ``limit``, seen or not."""
    over = F.col("n_tokens") > limit
    return sums.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0)).alias("docs_cut"),
        F.coalesce(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("tokens"),
    )


def token_counts(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """The sums of :func:`suffix_sums`; the histogram is written once, so texts are encoded once."""
    ids = bpe.encode(docs.select(text), ranks_path, pattern, text=text, out="_encoded")
    path = shared_path(docs.sparkSession, "lengths")
    histogram(ids.select(F.floor(F.octet_length("_encoded") / 4).cast("bigint").alias("n_tokens"))).write.parquet(path)
    return suffix_sums(docs.sparkSession.read.parquet(path))

"""Keyed upsert without MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.operators.ranking import one_per_key
from bookpipe.schema import nullable
from bookpipe.session import checkpointed
from bookpipe.sources.raw_tree import path_exists

BUCKET = "isbn_bucket"


def last_write(batch: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Of rows with the same key, the one that arrived last."""
    return one_per_key(batch, keys, [F.desc(c) for c in arrival])


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    columns = T.StructType([*nullable(schema).fields, T.StructField(BUCKET, T.IntegerType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(path)


def upsert(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = ("isbn", "user"),
    arrival: Sequence[str] = (),
    buckets: int = 256,
) -> None:
    """Rows of ``batch`` replace stored rows with the same key.

    The store is partitioned by a bucket of the first key, and only buckets the
    batch touches are read and rewritten. The merged rows are checkpointed before
    anything is replaced, so an interrupted job can be repeated. A rebalance
    before the write splits an oversized bucket over several tasks. ``arrival``
    orders the rows of one key. The bucket count is recorded beside the store;
    another count is refused, since it would look for stored rows elsewhere.
    """
    if not arrival:
        raise ValueError("arrival must order the rows of one key")
    layout = f"{path.rstrip('/')}.layout"
    if path_exists(spark, layout):
        stored = spark.read.schema("buckets int").parquet(layout).first()[0]
        if stored != buckets:
            raise ValueError(f"the store has {stored} buckets, not {buckets}")
    else:
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(layout)
    new = last_write(batch, keys, arrival)
    new = checkpointed(new.select(*schema.names).withColumn(BUCKET, bucket_of(keys[0], buckets)))
    touched = [row[0] for row in new.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
    if not touched:
        return
    old = read_bucketed(spark, path, schema).where(F.col(BUCKET).isin(touched))
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    merged = checkpointed(kept.unionByName(new))
    (
        merged.hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )

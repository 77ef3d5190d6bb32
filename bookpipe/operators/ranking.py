"""Ordered selection without gathering anything unbounded in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.session import checkpointed

# A sorted prefix up to this many rows may pass through one task.
SMALL_PREFIX = 10_000
# Up to this n, Spark cuts groups to n rows before the shuffle by itself.
GROUP_LIMIT = 1_000


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    n: int,
    position: str,
    spread_by: Sequence[str] = (),
    slices: int = 64,
) -> DataFrame:
    """The first ``n`` rows of each group with their position, 1-based.

    For small ``n`` the bound is pushed below the shuffle (WindowGroupLimit), so
    a hot group sends at most ``n`` rows per input split. For larger ``n`` the
    group is first cut to ``n`` rows in each of ``slices`` slices.
    """
    if n > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(*(spread_by or order)), F.lit(slices)).cast("int")
        sliced = Window.partitionBy(*keys, "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", part)
            .withColumn("_rn", F.row_number().over(sliced))
            .where(F.col("_rn") <= n)
            .drop("_slice", "_rn")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= n)
    return ranked.withColumn(position, F.col(position).cast("bigint"))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    return top_per_group(df, keys, order, 1, "_first").drop("_first")


def global_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """1-based rank over the whole table; ``order`` must be total.

    A range-partitioned sort numbers the rows inside each partition, and the
    partition sizes (one row per partition) give each partition its offset. The
    sorted rows are written once so that both passes see the same partitions.
    """
    placed = checkpointed(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + within + 1)
        .drop("_at", "_part", "_before")
    )


def first_k(
    df: DataFrame,
    order: Sequence[str | Column],
    k: int,
    name: str = "rank",
    small: int = SMALL_PREFIX,
) -> DataFrame:
    """O2: the first ``k`` rows of a totally ordered table, with their rank."""
    if k <= small:
        return (
            df.orderBy(*order)
            .limit(k)
            .withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
        )
    return global_rank(df, order, name).where(F.col(name) <= k)


def _running(n_keys: int, value: int):
    """Running sums within a sorted partition, by key: what stood before each row, and whether anything did."""

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carry = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = len(batch)
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(n_keys)), strict=True)) or [()] * rows
            new = np.array([last is None or keys[0] != last] + [a != b for a, b in zip(keys[1:], keys, strict=False)])
            values = batch.column(value).to_numpy(zero_copy_only=False).astype("int64")
            total = np.cumsum(values) - values
            starts = np.maximum.accumulate(np.where(new, np.arange(rows), -1))
            within = np.where(starts < 0, total + carry, total - total[np.maximum(starts, 0)])
            last, carry = keys[-1], int(within[-1] + values[-1])
            arrays = [*batch.columns, pa.array([part] * rows, pa.int32()), pa.array(within, pa.int64()), pa.array(new)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "_part", "_within", "_new"])

    return running


def total_before(df: DataFrame, value: str, position: str, by: Sequence[str] = (), name: str = "before") -> DataFrame:
    """Sum of the integer ``value`` over all earlier positions; NULL at the first one.

    ``position`` is unique within ``by`` and may have any gaps. The rows are sorted in
    ranges of about equal size and summed within each; what stands before a range is the
    sum of earlier ranges, one row for each key and range. So neither a key with very many
    rows nor positions far apart put more than a range into one task.
    """
    placed = df.withColumn("_value", F.coalesce(F.col(value).cast("bigint"), F.lit(0))).select(*by, "_value", *(c for c in df.columns if c not in by))
    ranges = placed.repartitionByRange(*by, position).sortWithinPartitions(*by, position)
    fields = [*ranges.schema.fields, *(T.StructField(n, t) for n, t in (("_part", T.IntegerType()), ("_within", T.LongType()), ("_new", T.BooleanType())))]
    summed = checkpointed(ranges.mapInArrow(_running(len(by), len(by)), T.StructType(fields)))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        summed.groupBy(*by, "_part")
        .agg(F.sum("_value").alias("_total"))
        .select(
            *(F.col(c).alias(f"_of_{i}") for i, c in enumerate(by)),
            F.col("_part").alias("_range"),
            F.sum("_total").over(earlier).alias("_ranges_before"),
        )
    )
    none = F.col("_new") & F.col("_ranges_before").isNull()
    total = F.col("_within") + F.coalesce("_ranges_before", F.lit(0))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(by)] + [F.col("_part") == F.col("_range")]
    joined = summed.join(totals, reduce(Column.__and__, same))
    return joined.withColumn(name, F.when(~none, total)).select(*df.columns, name)

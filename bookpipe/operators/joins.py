"""Membership joins (J1-J6): all equi-joins, none collects keys on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.operators.ranking import one_per_key

# Key tables proven to have at most this many rows may be broadcast.
BROADCAST_ROWS = 200_000
# A table of bits for keys beyond that: rows, a bound that keys do not change, and 64-bit words of a row.
SLOTS, WORDS = 1 << 17, 16


def keys_of(saved: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The distinct keys of a store.

    Duplicates are combined before the shuffle, so a key repeated over a third of
    the store costs one row per input split; the join then reuses the layout.
    """
    return saved.select(*([on] if isinstance(on, str) else on)).distinct()


def dealt(keys: DataFrame) -> DataFrame:
    """Keys to join where a shuffle deals them, never through the driver.

    Spark's size checks start from compressed files: millions of keys, or of pages made
    of them, may pass for 10 MB. Few keys are broadcast by name (:func:`narrow`).
    """
    return keys.hint("merge")


def dealt_to_pages(keys: DataFrame) -> DataFrame:
    """The same for different keys that are joined to page bodies, which then need no sort."""
    return keys.hint("shuffle_hash")


def without(df: DataFrame, saved: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not saved; duplicates among them are kept."""
    return df.join(dealt(keys_of(saved, on)), on, "left_anti")


def members(df: DataFrame, store: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in the store."""
    return df.join(dealt(keys_of(store, on)), on, "left_semi")


def unseen(df: DataFrame, saved: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key that is not saved yet, the first in ``order``."""
    return one_per_key(without(df, saved, key), [key], order)


def narrow(
    df: DataFrame, keys: DataFrame, on: str | Sequence[str], bound: int, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Drop rows that cannot join ``keys`` where that is free of a shuffle.

    ``bound`` is a proven maximum of the rows in ``keys``. Above ``limit`` the
    table is returned as it is, and the join that follows does the filtering.
    """
    if bound > limit:
        return df
    return df.join(F.broadcast(keys.select(*([on] if isinstance(on, str) else on))), on, "left_semi")


def likely(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key is among ``keys``, and a few others; for a shuffle that most rows do not need.

    Each key sets a bit by its hash in a table of at most SLOTS rows, which is broadcast however many keys there are.
    Of 12 million keys about one in eleven bits is set. An exact join must follow.
    """
    key = F.xxhash64(*([on] if isinstance(on, str) else on))
    slot, word, bit = key.bitwiseAND(F.lit(SLOTS - 1)), F.shiftright(key, 17).bitwiseAND(F.lit(WORDS - 1)), F.shiftright(key, 21).bitwiseAND(F.lit(63)).cast("int")
    set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    words = [F.coalesce(F.bit_or(F.when(F.col("_word") == i, set_bit)), F.lit(0).cast("bigint")) for i in range(WORDS)]
    table = keys.select(slot.alias("_slot"), word.alias("_word"), bit.alias("_bit")).groupBy("_slot").agg(F.array(*words).alias("_bits"))
    held = F.call_function("shiftright", F.get("_bits", F.col("_word").cast("int")), F.col("_bit")).bitwiseAND(F.lit(1)) == 1
    marked = df.withColumns({"_slot": slot, "_word": word, "_bit": bit})
    return marked.join(F.broadcast(table), "_slot").where(held).select(*df.columns)


def with_saved_count(books: DataFrame, counts: DataFrame) -> DataFrame:
    """The number of saved reviews of each book, 0 where there is none."""
    return books.join(dealt(counts.select("isbn", F.col("n").alias("saved"))), "isbn", "left").withColumn(
        "saved", F.coalesce("saved", F.lit(0))
    )

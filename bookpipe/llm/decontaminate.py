"""Benchmark decontamination: item-sized windows matched by SimHash, then exactly.

Words are runs of letters and digits in lower case; shingles are five words (items of
fewer words are one shingle). A window of a document has as many words as a benchmark
item and matches it if the weighted Jaccard similarity of their shingles (sum of
minima over sum of maxima of counts) is at least ``PERCENT`` / 100.

1. A window that matches shares shingles with the item. A bit table of all item
   shingles, sized by their number, is tested inside the scan, so that only documents with a
   possible hit go on, and at each true hit an item-sized window is laid so that the
   shared shingle stands at its place in the item.
2. Each different window text gets a SimHash over its words. Fingerprints are cut into
   ``BLOCKS`` blocks; two within ``RADIUS`` bits agree in some block up to
   ``RADIUS // BLOCKS`` bits. Items are listed under all block values within that
   distance, so the join on blocks finds every pair within the radius.
3. Pairs within the radius are verified exactly.

At similarity 0.8 of five-word shingles two windows differ in a word or two; a window
that differs in one word of 15 is expected 8 bits away, well inside the radius. The radius
misses some windows just above the bound: with the longest change at one end that still
reaches 0.8, and random hashes, 13 of 8,000 pairs were over 15 bits apart (one changed
word: none of 2,826).

Built-in expressions only. (Arrays made by lambdas are exploded by the outer forms: for
the others the optimizer infers a filter again and again.) Item shingles meet documents by joins of what passed the
bit table; equal windows and equal items are compared once.

Each step is written and read again: the driver holds small plans then, none of them
with the bit table in it, and joins know the sizes of what they read.

Cases: null and empty texts match nothing, nor do items without words. Documents
shorter than an item are compared whole. Repeated rows are reported once per doc_id and
text; rows without doc_id are reported with a null one. Extra columns do not matter.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookpipe.llm.common import text_or_empty, written

SHINGLE = 5
PERCENT = 80
RADIUS = 15
BLOCKS = 8
BITS = 64
#: Bits tested for a shingle, and 64-bit words of the largest bit table.
PROBES = 4
MOST_WORDS = 1 << 16


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingle_hashes(hashes: str, size: int) -> Column:
    """Hashes of runs of ``size`` word hashes, by place."""
    heads = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - size + 1, F.lit(0)))
    return F.transform(heads, lambda x, i: F.xxhash64(x, *(F.get(hashes, i + k) for k in range(1, size))))


def items_of(benchmark: DataFrame) -> DataFrame:
    """One row per different item: item (the least id), words, n_words, size (of shingles)."""
    listed = benchmark.select("item_id", words(text_or_empty()).alias("words")).where(F.size("words") > 0)
    unique = listed.groupBy("words").agg(F.min("item_id").alias("item"))
    return unique.select(
        "item", "words", F.size("words").alias("n_words"), F.least(F.size("words"), F.lit(SHINGLE)).alias("size")
    )


def members(benchmark: DataFrame, items: DataFrame) -> DataFrame:
    """(item, item_id): which items share a text."""
    listed = benchmark.select("item_id", words(text_or_empty()).alias("words")).where(F.size("words") > 0)
    return listed.join(items.select("item", "words"), "words").select("item", "item_id").distinct()


def item_shingles(items: DataFrame, size: int) -> DataFrame:
    """(h, item, place, n_words) of the shingles of items with this shingle size."""
    hashed = items.where(F.col("size") == size).withColumn("_h", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.select("item", "n_words", F.posexplode_outer(shingle_hashes("_h", size)).alias("place", "h"))


def probes(h: Column, words_: int) -> list[tuple[Column, Column]]:
    """PROBES places in a bit table of so many 64-bit words: word and bit."""
    low, high = h.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32)
    places = [(low + high * k).bitwiseAND(F.lit(64 * words_ - 1)) for k in range(PROBES)]
    return [(F.shiftrightunsigned(p, 6).cast("int"), p.bitwiseAND(F.lit(63)).cast("int")) for p in places]


class BitTable(NamedTuple):
    """One row with an array of 64-bit words in which the probes of all shingles are set, and the number of words."""

    row: DataFrame
    words: int

    def among(self, table: Column, shingles: Column) -> Column:
        """Those of ``shingles`` (structs with h) whose probes are all set; ``table`` is the row's array."""

        def holds(bits: Column, h: Column) -> Column:
            tests = [F.call_function("shiftright", F.get(bits, w), b).bitwiseAND(F.lit(1)) == 1 for w, b in probes(h, self.words)]
            return reduce(Column.__and__, tests)

        # The table is named once, so that it is looked up where it is tested and no row carries it.
        return F.get(F.transform(F.array(table), lambda bits: F.filter(shingles, lambda s: holds(bits, s["h"]))), F.lit(0))


def bit_table(shingles: DataFrame) -> BitTable | None:
    """The table of all shingles: 64 bits a shingle let one other in 300,000 pass.

    It goes to the tasks whole, so it is no larger than its shingles need, and beyond MOST_WORDS
    there is none: then all shingles of the documents meet those of the items.
    """
    n = shingles.select("h").distinct().count()
    words_ = 1 << max(n - 1, 63).bit_length()
    if words_ > MOST_WORDS:
        return None
    places = F.explode(F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in probes(F.col("h"), words_)])).alias("_p")
    bits = shingles.select(places).groupBy("_p.w").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_p.b"))).alias("v"))
    table = [0] * words_
    for row in bits.collect():  # at most MOST_WORDS rows
        table[row["w"]] = row["v"]
    return BitTable(shingles.sparkSession.createDataFrame([(table,)], "bits array<bigint>"), words_)


def hits(docs: DataFrame, shingles: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_key, words, start, n) of windows around shingles shared with an item."""
    table = bit_table(shingles)
    hashed = docs.select("doc_id", text_or_empty().alias("text"))
    hashed = hashed.withColumn("words", words(F.col("text"))).withColumn("_h", F.transform("words", lambda w: F.xxhash64(w)))
    listed = hashed.withColumn("_s", F.transform(shingle_hashes("_h", size), lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    few = listed
    if table is not None:
        few = listed.select("*", table.row.scalar().alias("_bits")).select("doc_id", "text", "words", table.among(F.col("_bits"), F.col("_s")).alias("_s"))
    # Rows without hits go after the explode: a filter before it would compute the lambdas' inputs anew for each word.
    rows = few.select("doc_id", F.xxhash64("text").alias("text_key"), "words", F.explode_outer("_s").alias("_s")).where("_s is not null")
    found = rows.select("doc_id", "text_key", "words", F.col("_s.h").alias("h"), F.col("_s.at").alias("at")).join(shingles, "h")
    last = F.greatest(F.size("words") - F.col("n_words"), F.lit(0))
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("place"), last))
    return found.select("doc_id", "text_key", "n_words", start.alias("start"), F.array_join(F.slice("words", start + 1, F.col("n_words")), " ").alias("window"))


def simhash(texts: DataFrame, key: str, window: Column) -> DataFrame:
    """(key, hash): sign of each bit's sum over the words' hashes.

    Two sums of 32 bits share one long, so that 64 bits take 32 sums.
    """
    each = texts.select(key, F.explode(window).alias("_w")).select(key, F.xxhash64("_w").alias("_h"))
    half = BITS // 2
    sums = [F.expr(f"sum((shiftrightunsigned(_h, {j}) & 1L) + shiftleft(shiftrightunsigned(_h, {j + half}) & 1L, 32)) as _s{j}") for j in range(half)]
    summed = each.groupBy(key).agg(F.count("*").alias("_n"), *sums)
    totals = [(j, f"(_s{j} & {(1 << 32) - 1}L)") for j in range(half)] + [(j + half, f"shiftrightunsigned(_s{j}, 32)") for j in range(half)]
    return summed.select(key, F.expr(" | ".join(f"if({total} * 2 > _n, shiftleft(1L, {place}), 0L)" for place, total in totals)).alias("hash"))


def blocks(hashed: DataFrame, near: bool) -> DataFrame:
    """``hashed`` with block and value of each fingerprint, and all values a bit away if ``near``."""
    width = BITS // BLOCKS
    flips = [0, *(1 << b for b in range(width))] if near else [0]
    each = hashed.select("*", F.explode(F.lit(list(range(BLOCKS)))).alias("block"))
    each = each.select("*", F.explode(F.lit(flips)).alias("_flip"))
    value = F.expr(f"(shiftrightunsigned(hash, {width} * block) & {(1 << width) - 1}L) ^ cast(_flip as bigint)")
    return each.withColumn("value", value).drop("_flip")


def within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(wid, item) pairs of equal length with fingerprints at most RADIUS bits apart."""
    left = blocks(windows.select("wid", "n_words", "hash"), False).withColumnRenamed("hash", "_hw")
    right = blocks(items.select("item", "n_words", "hash"), True).withColumnRenamed("hash", "_hi")
    pairs = left.join(right, ["n_words", "block", "value"])
    return pairs.where(F.bit_count(F.col("_hw").bitwiseXOR(F.col("_hi"))) <= RADIUS).select("wid", "item").distinct()


def shingle_counts(texts: DataFrame, key: str) -> DataFrame:
    """(key, shingle, count, total) from (key, words)."""
    size = F.least(F.size("words"), F.lit(SHINGLE))
    total = F.size("words") - size + 1
    runs = F.transform(F.sequence(F.lit(1), total), lambda i: F.array_join(F.slice("words", i, size), " "))
    each = texts.select(key, total.alias("total"), F.explode_outer(runs).alias("shingle"))
    return each.groupBy(key, "total", "shingle").agg(F.count("*").alias("count"))


def verified(pairs: DataFrame, windows: DataFrame, items: DataFrame) -> DataFrame:
    """(wid, item, similarity) of the pairs that reach the bound."""
    mine = shingle_counts(windows.join(pairs.select("wid").distinct(), "wid", "left_semi"), "wid")
    theirs = shingle_counts(items, "item").withColumnsRenamed({"total": "_total", "count": "_count"})
    both = pairs.join(mine, "wid").join(theirs, ["item", "shingle"])
    least = F.sum(F.least("count", "_count"))
    summed = both.groupBy("wid", "item").agg(least.alias("_both"), F.first("total").alias("_a"), F.first("_total").alias("_b"))
    most = F.col("_a") + F.col("_b") - F.col("_both")
    return summed.where(F.col("_both") * 100 >= most * PERCENT).select("wid", "item", (F.col("_both") / most).alias("similarity"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, start, similarity: the best window of each document and item."""
    spark = docs.sparkSession
    items = written(spark, "items", items_of(benchmark))
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most SHINGLE values
    empty = spark.createDataFrame([], "doc_id bigint, text_key bigint, n_words int, start int, window string")
    found = [hits(docs, written(spark, "item-shingles", item_shingles(items, size)), size) for size in sorted(sizes)]
    laid = written(spark, "windows", reduce(DataFrame.unionByName, found, empty).distinct())
    laid = laid.withColumn("wid", F.md5(F.col("window").cast("binary")))
    windows = laid.groupBy("wid", "n_words").agg(F.first("window").alias("window")).withColumn("words", F.split("window", " "))
    windows = written(spark, "hashed-windows", windows.join(simhash(windows, "wid", F.col("words")), "wid").select("wid", "n_words", "words", "hash"))
    known = items.join(simhash(items, "item", F.col("words")), "item")
    pairs = written(spark, "pairs", within_radius(windows, known))
    matches = verified(pairs, windows.select("wid", "words").dropDuplicates(["wid"]), items.select("item", "words"))
    matches = written(spark, "matches", matches)
    best = (
        laid.join(matches, "wid")
        .groupBy("doc_id", "text_key", "item")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("_s"))).alias("_best"))
    )
    out = best.join(members(benchmark, items), "item")
    return out.select("doc_id", "text_key", "item_id", (-F.col("_best._s")).alias("start"), F.col("_best.similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    bad = written(docs.sparkSession, "leaks", bad)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_or_empty()) == F.col("_key"))
    return docs.join(bad, same, "left_anti")

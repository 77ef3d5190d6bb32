"""Document fingerprints: a Merkle tree over paragraphs and sections.

Sections are parted by empty lines, paragraphs by line ends. A paragraph's node is
the SHA-256 of its text, a section's that of its paragraphs' nodes, the root's that of
its sections' nodes. Splitting loses nothing, so equal roots mean equal texts, and
where roots differ the differing branches lead to the edits. Below the paragraphs,
runs of words have short hashes. Runs are cut by content, after a word that ends in one of
``ENDS``, or at ``RUN`` words: an edit changes the runs around it, and those after it are cut
as before. The likeness of two fingerprints is the Dice coefficient of their sets of runs;
what equal branches hold is common to both.

Built-in expressions only, one row per document throughout.

Cases: null counts as empty. The empty text has one section with one empty paragraph;
likeness of two texts without words is 1 if they are equal, else 0. Rows of one doc_id
follow each other in the order of a text hash; rows without doc_id come last. A single
row is followed by itself. Extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookpipe.llm.common import text_or_empty

#: Most words of a run, and the characters that end one, as of a pattern: ASCII marks and two letters.
#: About one word in six ends so.
RUN, ENDS = 16, r"!-/:-@\[-`{-~gy"
#: Ranges of doc_id in which neighbours are looked up, for each shuffle partition, and at most.
RANGES, MOST_RANGES = 4, 65_536


def paragraphs(text: Column) -> Column:
    """Nodes of a text's paragraphs, by section."""
    return F.transform(F.split(text, "\n\n"), lambda s: F.transform(F.split(s, "\n"), lambda p: F.sha2(p, 256)))


def section_nodes(tree: Column) -> Column:
    return F.transform(tree, lambda s: F.sha2(F.array_join(s, ""), 256))


def root(tree: Column) -> Column:
    return F.sha2(F.array_join(section_nodes(tree), ""), 256)


def runs(text: Column) -> Column:
    """Distinct hashes of runs of words that do not cross a line end."""
    run = f"(?:[^ \\n]*[^ \\n{ENDS}] ){{0,{RUN - 1}}}[^ \\n]+ ?"
    found = F.regexp_extract_all(text, F.lit(run), F.lit(0))
    return F.array_distinct(F.transform(found, lambda r: F.xxhash64(r)))


def likeness(root_a: Column, runs_a: Column, root_b: Column, runs_b: Column) -> Column:
    size = F.size(runs_a) + F.size(runs_b)
    dice = F.when(size > 0, 2.0 * F.size(F.array_intersect(runs_a, runs_b)) / size).otherwise(F.lit(0.0))
    return F.when(root_a == root_b, F.lit(1.0)).otherwise(dice)


def differing_sections(tree_a: Column, tree_b: Column) -> Column:
    """0-based places of the sections at which two trees differ, found from their nodes."""
    pairs = F.arrays_zip(section_nodes(tree_a).alias("a"), section_nodes(tree_b).alias("b"))
    places = F.transform(pairs, lambda p, i: F.when(p["a"].eqNullSafe(p["b"]), F.lit(-1)).otherwise(i))
    return F.filter(places, lambda i: i >= 0)


def differing_paragraphs(tree_a: Column, tree_b: Column) -> Column:
    """(section, paragraph) places at which two trees differ; equal sections are not entered."""

    def inside(section: Column) -> Column:
        pairs = F.arrays_zip(F.get(tree_a, section).alias("a"), F.get(tree_b, section).alias("b"))
        places = F.transform(pairs, lambda p, i: F.when(p["a"].eqNullSafe(p["b"]), F.lit(-1)).otherwise(i))
        return F.transform(F.filter(places, lambda i: i >= 0), lambda i: F.struct(section.alias("section"), i.alias("paragraph")))

    return F.flatten(F.transform(differing_sections(tree_a, tree_b), inside))


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with tree, fingerprint (the root) and runs."""
    own = text_or_empty(text)
    out = docs.withColumn("tree", paragraphs(own))
    return out.withColumn("fingerprint", root(F.col("tree"))).withColumn("runs", runs(own))


def range_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below ``doc_id``, looked up in two steps; -1 without id."""
    if not bounds:
        return F.when(doc_id.isNull(), F.lit(-1)).otherwise(F.lit(0))
    width = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    firsts = F.array(*[F.lit(p[0]) for p in parts])
    inner = F.array(*[F.array(*[F.lit(b) for b in p]) for p in parts])
    part = F.size(F.filter(firsts, lambda b: b <= doc_id))
    within = F.size(F.filter(F.get(inner, part - 1), lambda b: b <= doc_id))
    place = F.when(part > 0, (part - 1) * width + within).otherwise(F.lit(0))
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(place)


def next_documents(rows: DataFrame, carried: list[str]) -> DataFrame:
    """``rows`` (doc_id, _tie, ...) with ``next``: the carried columns of the row that follows.

    Rows follow in descending doc_id, then _tie; the first follows the last. Ranges of
    doc_id hold about equally many rows and are ordered each by itself; the first row
    of each range also stands at the end of the range before it.
    """
    spark = rows.sparkSession
    n = min(MOST_RANGES, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / n for i in range(1, n)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 10 * n)).first()[0] or []
    placed = rows.withColumn("_range", range_of(F.col("doc_id"), sorted(set(found))))
    # The first row of each range: one row per range, at most MOST_RANGES.
    first = placed.groupBy("_range").agg(F.max(F.struct("doc_id", F.bitwise_not("_tie").alias("t"))).alias("m")).collect()
    ranges = sorted((r["_range"] for r in first), reverse=True)
    heads = {r["_range"]: (r["m"]["doc_id"], ~r["m"]["t"]) for r in first}
    wanted = [(r, *heads[ranges[(i + 1) % len(ranges)]]) for i, r in enumerate(ranges)]
    guests = spark.createDataFrame(wanted, "_to int, _id bigint, _t bigint")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t"))
    guests = rows.join(F.broadcast(guests), same).dropDuplicates(["_to"])
    guests = guests.withColumn("_range", F.col("_to")).drop("_to", "_id", "_t").withColumn("_guest", F.lit(True))
    order = Window.partitionBy("_range").orderBy("_guest", F.desc_nulls_last("doc_id"), "_tie")
    both = placed.withColumn("_guest", F.lit(False)).unionByName(guests)
    return both.withColumn("next", F.lead(F.struct(*carried)).over(order)).where(~F.col("_guest")).drop("_guest", "_range")


def edits(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and against the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("_tie", F.xxhash64("text"))
    known = fingerprint(texts).drop("tree")
    pairs = next_documents(known, ["text", "fingerprint", "runs"]).withColumn("n_chars", F.char_length("text").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut)
    edited = pairs.withColumn("_edited", F.concat(kept, F.substring(F.col("next.text"), F.lit(1), cut)))
    both = edited.withColumn("edited_fingerprint", root(paragraphs(F.col("_edited")))).withColumn("_edited_runs", runs(F.col("_edited")))
    here = (F.col("fingerprint"), F.col("runs"))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(*here, F.col("edited_fingerprint"), F.col("_edited_runs")).alias("near_edited"),
        likeness(*here, F.col("next.fingerprint"), F.col("next.runs")).alias("near_next"),
    )

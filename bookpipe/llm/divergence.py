"""How far the word use of each source is from the other sources of its language.

A term is a run of letters A-Z, a-z and characters beyond ASCII. One ``bytes.translate``
lowers A-Z and blanks every separator, ``bytes.split`` gives the terms, and a Counter per
document gives its frequencies. Tasks add them up per language, source and term, in tables
of bounded size, and pass on (lang, source, term, docs, n): how many documents hold the
term, and how often it occurs.

A language keeps the V terms that at least ``LEAST_DOCS`` of its documents hold. In every
group (a source within a language, with or without terms) and in the language as a whole a
kept term has p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), N being the sum of the
group's counts of kept terms. Two values differ by f = floor((p - q)^2 / (p + q)).

* ``pair``: for each other source of the language, f summed over all kept terms, all ranks.
* ``term``: kept terms that occur in the group with p above the language's q, by f, the
  first ``TOP``.

All arithmetic is in whole numbers. Counts stay sparse until the end: one row for a kept
term and a source it occurs in. The terms of a language are dealt by hash into portions
of bounded size, and each portion compares blocks of ``SOURCES`` sources with all sources
in numpy. So no language, term or source is one task's work; the list of a language's
sources is one row, and the square of its length is the size of the result.

Cases: null text, lang and source are empty strings. A language without kept terms has
only pairs, of value 0; a language with one source has no pairs. Repeated rows count as
often as they occur. Very long texts are split piece by piece. Extra columns are ignored,
whatever their names. No rows give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookpipe.llm.common import shared_path, ship

LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
#: Terms a task holds before it passes its counts on.
HELD = 750_000
#: Bytes of a text that are split at a time.
PIECE = 1 << 20
#: Entries (term and source) of a portion, and sources compared with all others at a time.
PORTION, SOURCES = 32_768, 128
#: Cells of one dense block of terms by sources.
CELLS = 1 << 20

#: Each byte's term character: A-Z lowered, the rest of ASCII but a-z blank.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
COUNTED = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("n", pa.int64())]
)


def frequencies(text: bytes) -> Counter[bytes]:
    """The terms of one document, with how often each occurs."""
    clean, counter, at = text.translate(LETTERS), Counter(), 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE) if len(clean) - at > PIECE else -1
        end = len(clean) if end < 0 else end
        counter.update(clean[at:end].split())
        at = end
    return counter


def _counted(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
    columns: list[list] = [[], [], [], [], []]
    for (lang, source), (docs, more) in held.items():
        columns[0] += [lang] * len(docs)
        columns[1] += [source] * len(docs)
        columns[2] += docs.keys()
        columns[3] += docs.values()
        columns[4] += [n + more[term] for term, n in docs.items()]
    terms = pa.array(columns[2], pa.binary()).cast(pa.string())
    return pa.record_batch([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), terms, *map(pa.array, columns[3:], [pa.int64()] * 2)], schema=COUNTED)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = {}, 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (lang, source) not in held:
                held[lang, source] = Counter(), Counter()
            docs, more = held[lang, source]
            found, before = frequencies(text), len(docs)
            docs.update(found.keys())
            for term, n in found.items():
                if n > 1:
                    more[term] += n - 1
            size += len(docs) - before
            if size >= HELD:
                yield _counted(held)
                held, size = {}, 0
    if size:
        yield _counted(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, docs, n) over whole texts, in parts that are to be added up."""
    ship(docs.sparkSession)
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    texts = docs.select(*columns).withColumn("text", F.col("text").cast("binary"))
    return texts.mapInArrow(_count, "lang string, source string, term string, docs bigint, n bigint")


def kept_terms(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, source, n, total, first): kept terms in each source, and in all; one row of a term is its first.

    One shuffle by term serves sums and windows: tasks have combined their counts before it.
    """
    summed = (
        counts.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    )
    term = Window.partitionBy("lang", "term").orderBy("source")
    whole = term.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = summed.select(
        "lang",
        "term",
        "source",
        "n",
        F.sum("docs").over(whole).alias("_docs"),
        F.sum("n").over(whole).alias("total"),
        (F.row_number().over(term) == 1).alias("first"),
    )
    return rows.where(F.col("_docs") >= least).drop("_docs")


def groups_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, sources, terms, total, entries): each language's sources with their N, in order."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    each = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("n"),
        F.count_if("first").alias("_terms"),
        F.sum(F.when(F.col("first"), F.col("total"))).alias("_total"),
        F.count("*").alias("_entries"),
    )
    groups = docs.select(*names).distinct().join(each, ["lang", "source"], "left")
    return groups.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n")))).alias("sources"),
        *(F.coalesce(F.sum(f"_{c}"), F.lit(0)).alias(c) for c in ("terms", "total", "entries")),
    )


def shares(counts: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 terms)), exactly, beyond 64 bits."""
    top, below = counts + 2, np.broadcast_to(np.asarray(total) + 2 * terms, counts.shape)
    if int(below.max(initial=1)) < (1 << 63) // SCALE:
        return 1 + SCALE * top // below
    # Long division by decimal digits: a remainder is below the divisor, and ten of them fit into 64 bits.
    whole, rest = np.divmod(top, below)
    for _ in range(9):
        digit, rest = np.divmod(rest * 10, below)
        whole = whole * 10 + digit
    return 1 + whole


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)): at most about SCALE^2, which fits into 64 bits."""
    return (p - q) ** 2 // (p + q)


def _compare(top: int):
    def compare(rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        """Of one portion and one block of sources: sums of pairs and the first terms of each source."""
        if not len(rows) or not len(groups):
            return pd.DataFrame({"lang": [], "source": [], "part": [], "item": [], "value": []})
        group, block = groups.iloc[0], int(groups["block"].iloc[0])
        names = [entry["source"] for entry in group["sources"]]
        totals = np.array([entry["n"] for entry in group["sources"]], dtype="int64")
        place = {name: i for i, name in enumerate(names)}
        mine = range(block * SOURCES, min(len(names), (block + 1) * SOURCES))
        sums = np.zeros((len(mine), len(names)), dtype="int64")
        best: list[list[tuple[int, str]]] = [[] for _ in mine]
        step = max(1, CELLS // len(names))
        row, terms = pd.factorize(rows["term"])
        column = rows["source"].map(place).to_numpy()
        all_counts = np.zeros(len(terms), dtype="int64")
        all_counts[row] = rows["total"]
        order = np.argsort(row, kind="stable")
        for at in range(0, len(terms), step):
            own = order[slice(*np.searchsorted(row[order], [at, at + step]))]
            counts = np.zeros((min(step, len(terms) - at), len(names)), dtype="int64")
            counts[row[own] - at, column[own]] = rows["n"].to_numpy()[own]
            p = shares(counts, totals, int(group["terms"]))
            q = shares(all_counts[at : at + step], int(group["total"]), int(group["terms"]))
            for k, i in enumerate(mine):
                sums[k] += differences(p, p[:, i : i + 1]).sum(axis=0)
                own = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
                found = [(-int(v), terms[at + j]) for j, v in zip(own, differences(p[own, i], q[own]), strict=True)]
                best[k] = sorted(best[k] + found)[:top]
        out = [
            (names[i], "pair", names[j], int(sums[k, j])) for k, i in enumerate(mine) for j in range(len(names)) if j != i
        ]
        out += [(names[i], "term", term, -value) for k, i in enumerate(mine) for value, term in best[k]]
        made = pd.DataFrame(out, columns=["source", "part", "item", "value"])
        return made.assign(lang=group["lang"])[["lang", "source", "part", "item", "value"]]

    return compare


def _ranked(rows: DataFrame, top: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def _portions(entries: Column, terms: Column) -> Column:
    """How many portions a language's terms are dealt into."""
    return F.greatest(F.lit(1), F.ceil(F.greatest(entries, terms) / PORTION)).cast("bigint")


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank, as the module describes."""
    spark = docs.sparkSession
    path = shared_path(spark, "terms")
    kept_terms(term_counts(docs), least).write.parquet(path)
    kept = spark.read.parquet(path)
    groups = groups_of(docs, kept)
    path = shared_path(spark, "groups")
    groups.withColumn("portions", _portions(F.col("entries"), F.col("terms"))).write.parquet(path)
    groups = spark.read.parquet(path)

    blocks = F.floor((F.size("sources") - 1) / SOURCES)
    # One number a language goes to its terms, not the list of its sources.
    dealt = kept.join(groups.select("lang", "portions", F.size("sources").alias("_sources")), "lang")
    dealt = dealt.withColumn("portion", F.pmod(F.xxhash64("term"), "portions"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_sources") - 1) / SOURCES))))
    mine = groups.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("portions") - 1)))
    mine = mine.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks)))
    keys = ["lang", "portion", "block"]
    compared = (
        dealt.select(*keys, "term", "total", "source", "n")
        .groupBy(*keys)
        .cogroup(mine.select(*keys, "sources", "terms", "total").groupBy(*keys))
        .applyInPandas(_compare(top), "lang string, source string, part string, item string, value bigint")
    )
    path = shared_path(spark, "compared")
    compared.write.parquet(path)
    compared = spark.read.parquet(path)

    pairs = compared.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    # Languages without kept terms have no portion with rows.
    bare = groups.where("terms = 0").select("lang", F.col("sources.source").alias("_all"))
    bare = bare.select("lang", F.explode("_all").alias("source"), "_all")
    bare = bare.select("lang", "source", F.lit("pair").alias("part"), F.explode("_all").alias("item"), F.lit(0).cast("bigint").alias("value"))
    pairs = pairs.unionByName(bare.where("item != source"))
    terms = compared.where("part = 'term'")
    return _ranked(pairs, None).unionByName(_ranked(terms, top))

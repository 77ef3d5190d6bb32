"""Validation: rejects, hard failures, quarantine (V1-V9)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookpipe.functions import book_fields as B

# Up to this many phrases a chain of substring tests is the fastest form.
FEW_PHRASES = 32


def banned(title: Column, phrases: Sequence[str] | None) -> Column:
    """V3: does the title hold any of the phrases? Case-sensitive."""
    if phrases is None or len(phrases) == 0:
        return F.lit(False)
    if isinstance(phrases, str):
        raise ValueError("expected a list of phrases")
    if len(phrases) <= FEW_PHRASES:
        return reduce(lambda a, b: a | b, (title.contains(p) for p in phrases))
    return title.rlike("|".join(rf"\Q{p}\E" if r"\E" not in p else re.escape(p) for p in phrases))


#: Shortest piece that phrases of its length or more are looked up by; longer phrases have longer pieces.
GRAM = 4


def grams(text: Column, size: int) -> Column:
    """The different runs of ``size`` characters of a text."""
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - size + 1, F.lit(1)))
    runs = F.transform(starts, lambda i: F.substr(text, i, F.lit(size)))
    return F.when(F.char_length(text) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def titles_holding(titles: DataFrame, key: str, title: str, phrases: DataFrame, phrase: str) -> DataFrame:
    """V3 for any number of phrases: the keys of titles that hold one, each once.

    An index on pieces of 4, 8, 16 ... characters, the largest that a phrase holds (whole phrases
    where they are shorter): pieces of one short length would meet ever more titles as both
    tables grow. A phrase stands under the piece of it that the fewest titles have, titles meet it
    by an equality join on their pieces, and only those are searched. ``key`` is unique. A piece
    that most titles have is a phrase's key only if all its pieces are as frequent.

    Titles and pieces are dealt by a shuffle: their estimates come from the size of files, and
    all pieces of a small table of titles would go through the driver.
    """
    listed = phrases.select(F.col(phrase).alias("_phrase")).where("_phrase is not null and _phrase != ''").distinct()
    length = F.char_length("_phrase")
    listed = listed.withColumn("_size", F.when(length < GRAM, length).otherwise(F.pow(F.lit(2), F.floor(F.log2(length + 0.5))).cast("int")))
    named = titles.select(F.col(key).alias("_key"), F.col(title).alias("_title")).where("_title is not null")
    # Pieces of each size that some phrase has: few, as they double.
    sizes = sorted(r["_size"] for r in listed.select("_size").distinct().collect())
    if not sizes:
        return titles.select(key).limit(0)
    pieces = F.flatten(F.array(*(grams(F.col("_title"), size) for size in sizes)))
    held = named.select("_key", F.explode(pieces).alias("_gram"))
    counted = held.groupBy("_gram").agg(F.count("*").alias("_n"))
    own = reduce(lambda rest, size: F.when(F.col("_size") == size, grams(F.col("_phrase"), size)).otherwise(rest), sizes, F.array().cast("array<string>"))
    spelled = listed.select("_phrase", F.explode(own).alias("_gram")).join(counted.hint("merge"), "_gram", "left")
    rarest = spelled.groupBy("_phrase").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_gram")).alias("_by"))
    index = rarest.where("_by._n > 0").select("_phrase", F.col("_by._gram").alias("_gram"))
    # Titles move once for each phrase that they may hold, not for each piece.
    met = held.hint("merge").join(index, "_gram").select("_key", "_phrase")
    found = met.join(named.hint("merge"), "_key").where(F.contains("_title", "_phrase"))
    return found.select(F.col("_key").alias(key)).distinct()


def rule(failed: Column, field: str, reason: str, hard: bool = False) -> Column:
    verdict = F.struct(F.lit(field).alias("field"), F.lit(reason).alias("reason"), F.lit(hard).alias("hard"))
    return F.when(failed, verdict)


def first_failure(*rules: Column) -> Column:
    """V9: the first failing rule is the reason; NULL where all pass."""
    return F.coalesce(*rules)


def all_failures(**rules: Column) -> Column:
    """V8: every failing rule, as an array of names."""
    names = F.array(*(F.when(failed, F.lit(name)) for name, failed in rules.items()))
    return F.filter(names, lambda name: name.isNotNull())


def book_verdict(blocks: Column, banned_titles: Sequence[str] = (), language: str = "English") -> Column:
    """V1-V5 and the hard parse rules, in the order they apply to a page.

    ``hard`` marks what a strict run aborts on.
    """
    bullets, products, title = blocks["bullets"], blocks["products"], blocks["title"]
    tongue = B.language(bullets)
    value_missing = F.exists(bullets, lambda b: b["value"].isNull())
    named_without_value = lambda label: F.exists(
        bullets, lambda b: b["label"].contains(label) & b["value"].isNull()
    )
    return first_failure(
        rule(title.isNull(), "title", "missing", hard=True),
        rule(banned(title, banned_titles), "title", "banned phrase"),
        rule(F.size(bullets) == 0, "page", "no detail bullets", hard=True),
        rule(F.exists(bullets, lambda b: b["label"].isNull()), "bullets", "bullet without label", hard=True),
        rule(named_without_value(B.ISBN_LABEL), "isbn", "no value", hard=True),
        rule(B.labelled(bullets, B.ISBN_LABEL).isNull(), "isbn", "missing"),
        rule(named_without_value(B.LANGUAGE_LABEL), "language", "no value", hard=True),
        rule(tongue.isNull() | (tongue != language), "language", f"not {language}"),
        rule(B.bad_dates(bullets), "date", "no bracketed date", hard=True),
        rule(value_missing, "bullets", "bullet without value", hard=True),
        rule(B.bad_pages(bullets), "pages", "not a number", hard=True),
        rule(F.size(products) == 0, "page", "no product blocks", hard=True),
    )


def split_by_verdict(df: DataFrame, on_error: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantine rows) of a table with a ``verdict`` column."""
    verdict = F.col("verdict")
    good = df.where(verdict.isNull())
    if on_error == "fail":
        message = F.concat_ws(" ", "url", verdict["field"], verdict["reason"])
        stop = F.when(verdict["hard"], F.raise_error(message).cast("boolean")).otherwise(verdict.isNull())
        good = df.where(stop)
    bad = df.where(verdict.isNotNull()).select(
        "page_id", "url", verdict["field"].alias("field"), verdict["reason"].alias("reason")
    )
    return good.drop("verdict"), bad

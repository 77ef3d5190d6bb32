"""Book value parsers (X7-X18) over the blocks of a book page.

``bullets`` is ``array<struct<label, value>>``, ``products`` is
``array<struct<rank, rating, count>>``, both in page order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookpipe.functions.text import (
    INTEGER,
    drop_last,
    first_word,
    joined,
    last_match,
    last_value,
    soft_double,
    soft_int,
)

# Bullet labels, and the formats a price is taken for, best first.
ISBN_LABEL = "ISBN-13"
LANGUAGE_LABEL = "Language"
DATE_LABEL = "Publisher"
PAGES_WORD = "pages"
FORMATS = ("Paperback", "Mass Market Paperback", "Hardcover")

IN_BRACKETS = r"(?s)\(([^(]*)\)\z"


def labelled(bullets: Column, label: str) -> Column:
    return last_match(bullets, lambda b: b["label"].contains(label))


def isbn(bullets: Column) -> Column:
    """Label without its last two characters, ``-``, value."""
    bullet = labelled(bullets, ISBN_LABEL)
    return F.concat(drop_last(bullet["label"], 2), F.lit("-"), bullet["value"])


def language(bullets: Column) -> Column:
    """X9."""
    return labelled(bullets, LANGUAGE_LABEL)["value"]


def authors(names: Column) -> Column:
    """Comma-joined, empty if there is none."""
    return joined(names, ",")


def description(parts: Column) -> Column:
    """X11: the parts run together, empty if there is none."""
    return joined(parts)


def has_date(value: Column) -> Column:
    return F.coalesce(F.regexp_like(value, F.lit(IN_BRACKETS)), F.lit(False))


def date(bullets: Column) -> Column:
    """What stands in the closing brackets, without commas."""
    value = labelled(bullets, DATE_LABEL)["value"]
    inside = F.translate(F.regexp_extract(value, IN_BRACKETS, 1), ",", "")
    return F.when(has_date(value), inside)


def pub_date(date_text: Column) -> Column:
    """The publication date as a DATE, NULL where the text is not one."""
    return F.try_to_date(date_text, "MMMM d yyyy")


def bad_dates(bullets: Column) -> Column:
    """Hard rule of X12: every publisher bullet must end in a bracketed date."""
    return F.exists(bullets, lambda b: b["label"].contains(DATE_LABEL) & ~has_date(b["value"]))


def pages(bullets: Column) -> Column:
    """Leading number of the last value that mentions pages."""
    bullet = last_match(bullets, lambda b: b["value"].contains(PAGES_WORD))
    return soft_int(first_word(bullet["value"]))


def bad_pages(bullets: Column) -> Column:
    """Hard rule of X13: every value that mentions pages must start with a number."""
    return F.exists(
        bullets,
        lambda b: b["value"].contains(PAGES_WORD) & ~first_word(b["value"]).rlike(INTEGER),
    )


def price(formats_text: Column) -> Column:
    """The line after the best offered format, from its ``$`` on."""
    lines = F.split(formats_text, "\n")
    place = F.coalesce(*(F.nullif(F.array_position(lines, name), F.lit(0)) for name in FORMATS))
    offer = F.try_element_at(lines, (place + 1).cast("int"))
    dollar = F.instr(offer, "$")
    return F.when(dollar > 0, soft_double(F.substring(offer, dollar + 1, F.length(offer))))


def rank_of(text: Column) -> Column:
    number = F.regexp_extract(text, r"(?s)^[^#]*#([^ ]*) ", 1)
    return soft_int(F.translate(number, ",", ""))


def rating_of(text: Column) -> Column:
    return soft_double(F.left(text, F.lit(3)))


def count_of(text: Column) -> Column:
    return soft_int(F.translate(first_word(text), ",", ""))


def best_seller_rank(products: Column) -> Column:
    """Between the first ``#`` and the next space."""
    return last_value(products, lambda p: rank_of(p["rank"]))


def review_rating(products: Column) -> Column:
    """The first three characters, so a bare ``5`` is not read."""
    return last_value(products, lambda p: rating_of(p["rating"]))


def review_count(products: Column) -> Column:
    """The first word, without thousands commas."""
    return last_value(products, lambda p: count_of(p["count"]))

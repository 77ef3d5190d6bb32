"""Shared parsing rules.

Soft parse: what cannot be read becomes NULL. Last match: of several candidates
in page order, the last one that succeeds is the value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of numbers the parsers accept.
INTEGER = r"^\s*[+-]?\d+(_\d+)*\s*$"
DECIMAL = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"


def soft_int(text: Column) -> Column:
    return F.when(text.rlike(INTEGER), F.trim(F.translate(text, "_", "")).try_cast("int"))


def soft_double(text: Column) -> Column:
    return F.when(text.rlike(DECIMAL), F.trim(text).try_cast("double"))


def last_match(items: Column, keep: Callable[[Column], Column]) -> Column:
    """The last element that satisfies ``keep``, NULL if none does."""
    return F.try_element_at(F.filter(items, keep), F.lit(-1))


def last_value(items: Column, parse: Callable[[Column], Column]) -> Column:
    """The last successfully parsed value over ``items``."""
    return last_match(F.transform(items, parse), lambda value: value.isNotNull())


def first_word(text: Column) -> Column:
    return F.substring_index(text, " ", 1)


def drop_last(text: Column, n: int) -> Column:
    return F.left(text, F.length(text) - F.lit(n))


def joined(items: Column, separator: str = "") -> Column:
    """Ordered concatenation; the empty string when there is nothing."""
    return F.array_join(F.coalesce(items, F.array().cast("array<string>")), separator)

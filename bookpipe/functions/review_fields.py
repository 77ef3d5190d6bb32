"""Review value parsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookpipe.functions.text import soft_double

# Fixed value: how a star rating is written; more text may follow.
STARS = r"(?s)^([^ ]*) out of 5 stars( .*)?\z"


def star_rating(text: Column) -> Column:
    """Whole stars, truncated; NULL for any other wording."""
    stars = soft_double(F.regexp_extract(text, STARS, 1))
    return stars.try_cast("int")

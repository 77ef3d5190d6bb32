"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_url(url: Column) -> Column:
    """Cut at the first ``ref=``, wherever it stands."""
    return F.substring_index(url, "ref=", 1)


def absolute_url(href: Column, page_url: Column) -> Column:
    """A link as a browser reports it: resolved against the page it is on."""
    scheme = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    origin = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    slash = F.when(folder.endswith("/"), F.lit("")).otherwise(F.lit("/"))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(folder, slash, href))
    )


def record_id(book_url: Column) -> Column:
    """An id that a retried task gives again; ``F.uuid()`` would not."""
    return F.md5(book_url)

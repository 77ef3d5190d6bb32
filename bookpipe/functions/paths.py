"""Keys from the paths of a raw store."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folder and file names of the raw store layout.
ROOT = "raw_data"
REVIEWS = "reviews"
ATTRIBUTES_FILE = "data.json"


def isbn_of_path(path: Column) -> Column:
    """The folder below ``raw_data``, wherever that root is."""
    return F.regexp_extract(path, rf"(?:^|/){ROOT}/([^/]+)/", 1)


def user_of_path(path: Column) -> Column:
    """The file name without its extension."""
    name = F.substring_index(path, "/", -1)
    return F.when(name.endswith(".json"), F.left(name, F.length(name) - 5)).otherwise("")


def is_review_path(path: Column) -> Column:
    return path.rlike(rf"/{REVIEWS}/[^/]+\.json$")


def image_key(isbn: Column) -> Column:
    """Where the cover of a book belongs."""
    return F.concat(F.lit(f"{ROOT}/"), isbn, F.lit("/"), isbn, F.lit(".jpg"))

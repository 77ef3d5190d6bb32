"""Record schemas and the schema contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BOOK = T.StructType(
    [
        T.StructField("title", T.StringType(), False),
        T.StructField("isbn", T.StringType(), False),
        T.StructField("uuid", T.StringType(), False),
        T.StructField("author", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("pages", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("best_seller_rank", T.IntegerType()),
        T.StructField("review_rating", T.DoubleType()),
        T.StructField("review_count", T.IntegerType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("book_url", T.StringType(), False),
    ]
)

REVIEW = T.StructType(
    [
        T.StructField("isbn", T.StringType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("rating", T.IntegerType()),
        T.StructField("user", T.StringType(), False),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# A landed capture: ``kind`` is listing, book or review. Listing and review pages
# carry their place in the sequence they were captured from; a review page also
# carries the URL of the book it belongs to.
CAPTURE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("book_url", T.StringType()),
        *PAGE.fields,
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def nullable(schema: T.StructType) -> T.StructType:
    """The same schema without NOT NULL, as file sources deliver it."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in contract order and type; a missing column is an error."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    return df.to(nullable(schema))

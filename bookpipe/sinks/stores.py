"""Stores behind one protocol (E4, E5): files, catalog tables, JDBC tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.functions.paths import image_key, isbn_of_path
from bookpipe.operators.counts import distinct_isbns, reviews_per_book
from bookpipe.schema import BOOK, QUARANTINE, REVIEW, conform, nullable
from bookpipe.session import checkpointed
from bookpipe.sinks.ledger import FOLDER, Ledger, other_batch
from bookpipe.sinks.upsert import last_write
from bookpipe.sources.raw_tree import list_names, list_store, path_exists, read_raw_attributes, read_raw_reviews
from bookpipe.sources.tables import read_table, table_or_empty

# Names of the two relations.
ATTRIBUTES = "book_attributes"
REVIEWS = "book_reviews"
# Ours: rejected pages, the covers to fetch, what each batch adds to the counts of its books,
# books whose review pages are read to the end, and what later batches have replaced.
REJECTS = "quarantine"
IMAGES = "image_manifest"
COUNTS = "review_counts"
ENDED = "exhausted"
VOIDED = "voided"
BATCH = "batch"
END = T.StructType([T.StructField("book_url", T.StringType()), T.StructField("pages", T.LongType()), T.StructField("mark", T.DecimalType(38, 0))])
VOID = T.StructType([T.StructField("isbn", T.StringType()), T.StructField("void", T.StringType())])
COUNT = T.StructType([T.StructField("isbn", T.StringType()), T.StructField("n", T.LongType()), T.StructField("users", T.LongType())])
MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in ("isbn", "image_url", "target_key", "status")])


class Store(Protocol):
    """Saved state and its sink, all as DataFrames.

    ``batch`` names one run. Reading with it leaves out what an earlier, failed
    attempt of the same run has written, and writing replaces that. ``stage`` and
    ``reject`` put rows down, and ``write`` stages a batch and finishes it.
    """

    ledger: Ledger | None

    def attributes(self, batch: str | None = None) -> DataFrame: ...

    def reviews(self, batch: str | None = None) -> DataFrame: ...

    def counts(self, mode: str = "rows", batch: str | None = None) -> DataFrame: ...

    def batches(self) -> list[str]: ...

    def stage(self, attributes: DataFrame, reviews: DataFrame, batch: str) -> None: ...

    def write(self, attributes: DataFrame, reviews: DataFrame, batch: str) -> None: ...

    def reject(self, quarantine: DataFrame, batch: str) -> None: ...

    def void(self, replaced: DataFrame, batch: str) -> None: ...

    def exhausted(self, batch: str | None = None) -> DataFrame | None: ...

    def mark(self, exhausted: DataFrame, batch: str) -> None: ...


def standing(rows: DataFrame, voided: DataFrame) -> DataFrame:
    """Stored rows without those that a later batch has replaced: whole books of a batch."""
    gone = voided.select("isbn", F.col("void").alias(BATCH)).distinct()
    return rows.join(gone, ["isbn", BATCH], "left_anti")


def count_delta(reviews: DataFrame) -> DataFrame:
    """A1 of one batch: ``(isbn, n, users)``, rows and distinct reviewers."""
    return reviews.where(F.col("isbn").isNotNull()).groupBy("isbn").agg(F.count("*").alias("n"), F.count_distinct("user").alias("users"))


def counts_of(deltas: DataFrame, mode: str, attributes: DataFrame) -> DataFrame:
    """A1 over all batches: the deltas added up, narrow rows per book and batch.

    A run adds no reviewer that is saved already, so distinct reviewers add up too.
    """
    total = deltas.groupBy("isbn").agg(F.sum("n" if mode == "rows" else "users").alias("n"))
    if mode == "rows":
        return total
    return distinct_isbns(attributes).join(total, "isbn", "left").withColumn("n", F.coalesce("n", F.lit(0)))


class FileStore:
    """Parquet or JSON files, one folder per run.

    Runs only add keys that are not saved, so nothing stored is rewritten; a
    repeated run replaces its own folder. ``tree`` may name an existing
    one-file-per-record JSON tree whose records count as saved.
    """

    def __init__(self, spark: SparkSession, root: str, format: str = "parquet", tree: str | None = None) -> None:
        if format not in ("parquet", "json"):
            raise ValueError(f"unknown format {format!r}")
        self.spark, self.root, self.format, self.tree = spark, root.rstrip("/"), format, tree
        self.ledger: Ledger | None = Ledger(spark, f"{self.root}/{FOLDER}")

    def _read(self, name: str, schema: T.StructType, batch: str | None) -> DataFrame:
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], nullable(schema))
        columns = T.StructType([*nullable(schema).fields, T.StructField(BATCH, T.StringType())])
        rows = self.spark.read.schema(columns).format(self.format).load(path)
        rows = rows.where(other_batch(BATCH, batch) if self.ledger is None else self.ledger.finished(BATCH, batch))
        if schema is not VOID and "isbn" in schema.names and path_exists(self.spark, f"{self.root}/{VOIDED}"):
            rows = standing(rows, self._read(VOIDED, VOID, batch))
        return rows.drop(BATCH)

    def attributes(self, batch: str | None = None) -> DataFrame:
        rows = self._read(ATTRIBUTES, BOOK, batch)
        return rows.unionByName(read_raw_attributes(self.spark, self.tree)) if self.tree else rows

    def reviews(self, batch: str | None = None) -> DataFrame:
        rows = self._read(REVIEWS, REVIEW, batch)
        return rows.unionByName(read_raw_reviews(self.spark, self.tree)) if self.tree else rows

    def counts(self, mode: str = "rows", batch: str | None = None) -> DataFrame:
        """A1, from what each batch has added; the reviews themselves are not read (those of a tree are)."""
        if path_exists(self.spark, f"{self.root}/{REVIEWS}") and not path_exists(self.spark, f"{self.root}/{COUNTS}"):
            return reviews_per_book(self.reviews(batch), mode, self.attributes(batch))  # stored before counts were kept
        deltas = self._read(COUNTS, COUNT, batch)
        if self.tree:
            deltas = deltas.unionByName(count_delta(read_raw_reviews(self.spark, self.tree)))
        return counts_of(deltas, mode, self.attributes(batch))

    def batches(self) -> list[str]:
        """Names of all batches that have a folder."""
        names = list_names(self.spark, f"{self.root}/{REVIEWS}")
        return [name.split("=", 1)[1] for name in names if name.startswith(f"{BATCH}=")]

    def stage(self, attributes: DataFrame, reviews: DataFrame, batch: str) -> None:
        # The store is keyed by (isbn, user): of one user's repeats, the last stays.
        keyed = last_write(reviews, ["isbn", "user"], ["position"])
        for name, rows, schema in ((ATTRIBUTES, attributes, BOOK), (REVIEWS, keyed, REVIEW)):
            target = f"{self.root}/{name}/{BATCH}={batch}"
            conform(rows, schema).write.mode("overwrite").format(self.format).save(target)
        mine = self.spark.read.schema(nullable(REVIEW)).format(self.format).load(f"{self.root}/{REVIEWS}/{BATCH}={batch}")
        count_delta(mine).write.mode("overwrite").format(self.format).save(f"{self.root}/{COUNTS}/{BATCH}={batch}")
        covers = image_manifest(attributes, landed_images(self.spark, self.tree))
        covers.write.mode("overwrite").format(self.format).save(f"{self.root}/{IMAGES}/{BATCH}={batch}")

    def write(self, attributes: DataFrame, reviews: DataFrame, batch: str) -> None:
        self.stage(attributes, reviews, batch)
        if self.ledger is not None and self.ledger.exists():
            self.ledger.commit(batch)

    def reject(self, quarantine: DataFrame, batch: str) -> None:
        target = f"{self.root}/{REJECTS}/{BATCH}={batch}"
        conform(quarantine, QUARANTINE).write.mode("overwrite").format(self.format).save(target)

    def quarantine(self, batch: str | None = None) -> DataFrame:
        return self._read(REJECTS, QUARANTINE, batch)

    def void(self, replaced: DataFrame, batch: str) -> None:
        """Rows of ``(isbn, void)``: what batch ``void`` has stored of a book counts no longer once this batch is finished."""
        conform(replaced, VOID).write.mode("overwrite").format(self.format).save(f"{self.root}/{VOIDED}/{BATCH}={batch}")

    def mark(self, exhausted: DataFrame, batch: str) -> None:
        target = f"{self.root}/{ENDED}/{BATCH}={batch}"
        conform(exhausted, END).write.mode("overwrite").format(self.format).save(target)

    def exhausted(self, batch: str | None = None) -> DataFrame | None:
        """The books that runs have read to the end, with the pages they had then; none if no run has."""
        return self._read(ENDED, END, batch) if path_exists(self.spark, f"{self.root}/{ENDED}") else None

    def images(self) -> DataFrame:
        """The covers of stored books, those not landed by now to be fetched.

        A status holds for the moment of reading: covers that have landed since a
        batch was written are found by the listing of the tree, nothing is rewritten.
        """
        return image_manifest(self._read(IMAGES, MANIFEST, None).select("isbn", "image_url"), landed_images(self.spark, self.tree))


class TableStore:
    """Tables of the session catalog (W3, W4), partitioned by run.

    A repeated run replaces its own rows; reading with its name leaves them out, so
    that it finds the state its first attempt found. ``covers`` may name a tree that
    covers land in.
    """

    def __init__(
        self,
        spark: SparkSession,
        attributes: str = ATTRIBUTES,
        reviews: str = REVIEWS,
        rejects: str = REJECTS,
        ledger: Ledger | None = None,
        covers: str | None = None,
    ) -> None:
        self.spark, self.names, self.rejects = spark, (attributes, reviews), rejects
        self.ledger, self.covers = ledger, covers
        self.sums, self.ended, self.voided = (f"{reviews}_{kind}" for kind in ("counts", "exhausted", "voided"))

    def _exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def _read(self, name: str, schema: T.StructType, batch: str | None) -> DataFrame:
        if not self._exists(name):
            return table_or_empty(self.spark, name, schema)
        rows = read_table(self.spark, name)
        if BATCH in rows.columns:
            rows = rows.where(other_batch(BATCH, batch) if self.ledger is None else self.ledger.finished(BATCH, batch))
            rows = self._standing(rows, schema, batch)
        return rows.select(*schema.names)

    def _standing(self, rows: DataFrame, schema: T.StructType, batch: str | None) -> DataFrame:
        if schema is VOID or "isbn" not in schema.names or not self._exists(self.voided):
            return rows
        return standing(rows, self._read(self.voided, VOID, batch))

    def attributes(self, batch: str | None = None) -> DataFrame:
        return self._read(self.names[0], BOOK, batch)

    def reviews(self, batch: str | None = None) -> DataFrame:
        return self._read(self.names[1], REVIEW, batch)

    def counts(self, mode: str = "rows", batch: str | None = None) -> DataFrame:
        """A1, from what each batch has added; the reviews themselves are not read."""
        if self._exists(self.names[1]) and not self._exists(self.sums):
            return reviews_per_book(self.reviews(batch), mode, self.attributes(batch))  # stored before counts were kept
        return counts_of(self._read(self.sums, COUNT, batch), mode, self.attributes(batch))

    def quarantine(self, batch: str | None = None) -> DataFrame:
        return self._read(self.rejects, QUARANTINE, batch)

    def void(self, replaced: DataFrame, batch: str) -> None:
        """Rows of ``(isbn, void)``: what batch ``void`` has stored of a book counts no longer once this batch is finished."""
        self.replace(self.voided, conform(replaced, VOID), batch)

    def mark(self, exhausted: DataFrame, batch: str) -> None:
        self.replace(self.ended, conform(exhausted, END), batch)

    def exhausted(self, batch: str | None = None) -> DataFrame | None:
        """The books that runs have read to the end, with the pages they had then; none if no run has."""
        return self._read(self.ended, END, batch) if self._exists(self.ended) else None

    def images(self) -> DataFrame:
        """The covers of stored books, those not landed by now to be fetched."""
        return image_manifest(self.attributes().select("isbn", "image_url"), landed_images(self.spark, self.covers))

    def batches(self) -> list[str]:
        """Names of all batches that have rows: one for each partition."""
        if not self._exists(self.names[1]):
            return []
        if BATCH not in read_table(self.spark, self.names[1]).columns:
            return []
        return sorted(r[0].split("=", 1)[1] for r in self.spark.sql(f"show partitions {self.names[1]}").collect())

    def stage(self, attributes: DataFrame, reviews: DataFrame, batch: str) -> None:
        self.replace(self.names[0], conform(attributes, BOOK), batch)
        kept = checkpointed(conform(reviews, REVIEW))
        self.replace(self.names[1], kept, batch)
        self.replace(self.sums, conform(count_delta(kept), COUNT), batch)

    def write(self, attributes: DataFrame, reviews: DataFrame, batch: str) -> None:
        self.stage(attributes, reviews, batch)
        if self.ledger is not None and self.ledger.exists():
            self.ledger.commit(batch)

    def reject(self, quarantine: DataFrame, batch: str) -> None:
        self.replace(self.rejects, conform(quarantine, QUARANTINE), batch)

    def replace(self, name: str, rows: DataFrame, batch: str) -> None:
        """Put ``rows`` in the place of what this run has written; other runs' rows stay."""
        if not self._exists(name):
            rows.withColumn(BATCH, F.lit(batch)).write.partitionBy(BATCH).saveAsTable(name)
            return
        fixed = checkpointed(rows)  # they may come from this very table
        columns = ", ".join(f"`{c}`" for c in fixed.columns)
        self.spark.sql(
            f"insert overwrite table {name} partition ({BATCH} = :batch) select {columns} from {{rows}}",
            args={"batch": batch},
            rows=fixed,
        )


class JdbcStore(TableStore):
    """Tables of a database over JDBC, with a column for the run.

    ``predicates`` split a read into one task each; without them a table would
    come through a single connection, so they are required. JDBC cannot replace
    rows: a repeated run adds what its first attempt has not written.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str],
        predicates: Sequence[str],
        attributes: str = ATTRIBUTES,
        reviews: str = REVIEWS,
        rejects: str = REJECTS,
        ledger: Ledger | None = None,
    ) -> None:
        super().__init__(spark, attributes, reviews, rejects, ledger)
        if not predicates:
            raise ValueError("predicates must split the table into parts")
        self.url, self.properties, self.predicates = url, dict(properties), list(predicates)

    def _exists(self, name: str) -> bool:
        """Whether the database lists the table, in any case of letters."""
        drivers, properties = self.spark._jvm.java.sql.DriverManager, self.spark._jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, value)
        connection = drivers.getConnection(self.url, properties)
        try:
            plain = name.rsplit(".", 1)[-1]
            for spelling in {plain, plain.lower(), plain.upper()}:
                if connection.getMetaData().getTables(None, None, spelling, None).next():
                    return True
            return False
        finally:
            connection.close()

    def _read(self, name: str, schema: T.StructType, batch: str | None) -> DataFrame:
        if not self._exists(name):
            return self.spark.createDataFrame([], nullable(schema))
        rows = self.spark.read.jdbc(self.url, name, predicates=self.predicates, properties=self.properties)
        rows = rows.where(other_batch(BATCH, batch) if self.ledger is None else self.ledger.finished(BATCH, batch))
        return conform(self._standing(rows, schema, batch), schema)

    def batches(self) -> list[str]:
        if not self._exists(self.names[1]):
            return []
        rows = self.spark.read.jdbc(self.url, self.names[1], predicates=self.predicates, properties=self.properties)
        return sorted(r[0] for r in rows.select(BATCH).distinct().collect())

    def replace(self, name: str, rows: DataFrame, batch: str) -> None:
        if not self._exists(name):
            rows.withColumn(BATCH, F.lit(batch)).write.jdbc(self.url, name, properties=self.properties)
            return
        there = self.spark.read.jdbc(self.url, name, predicates=self.predicates, properties=self.properties)
        there = there.where(F.col(BATCH) == batch).select(*rows.columns)
        new = rows.exceptAll(there).withColumn(BATCH, F.lit(batch))
        new.write.mode("append").jdbc(self.url, name, properties=self.properties)


def landed_images(spark: SparkSession, tree: str | None) -> DataFrame:
    """Isbns whose cover the raw tree holds already."""
    if tree is None or not path_exists(spark, tree):
        return spark.createDataFrame([], "isbn string")
    return list_store(spark, tree, "*.jpg").select(isbn_of_path(F.col("path")).alias("isbn"))


def saved_state(raw: Store, relational: Store | None = None) -> Store:
    """The store whose content counts as saved."""
    return raw if relational is None else relational


def image_manifest(attributes: DataFrame, landed: DataFrame) -> DataFrame:
    """``(isbn, image_url, target_key, status)`` for each book.

    ``landed`` holds the isbns whose cover is stored already. Fetching is left to
    whoever works the list; a failed fetch leaves its book ``missing``.
    """
    have = landed.select("isbn").distinct().withColumn("_landed", F.lit(True))
    status = (
        F.when(F.col("_landed"), "landed").when(F.col("image_url").isNull(), "no url").otherwise("missing")
    )
    return attributes.join(have, "isbn", "left").select(
        "isbn", "image_url", image_key(F.col("isbn")).alias("target_key"), status.alias("status")
    )

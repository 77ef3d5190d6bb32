"""The one-file-per-record JSON tree (S2-S4): read, never written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.functions.paths import ATTRIBUTES_FILE, is_review_path, isbn_of_path, user_of_path
from bookpipe.schema import BOOK, QUARANTINE, REVIEW, conform, nullable


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = hadoop_path(spark, path)
    return files.exists(place)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, in order; none if it is not there."""
    files, place = hadoop_path(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []


def read_raw_attributes(spark: SparkSession, root: str) -> DataFrame:
    """Every ``<isbn>/data.json`` below ``root``.

    The lookup is recursive rather than by a glob, so that Spark lists the
    folders of many books as a job.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], nullable(BOOK))
    files = (
        spark.read.schema(nullable(BOOK))
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", ATTRIBUTES_FILE)
        .json(root)
    )
    return files.where(~is_review_path(F.col("_metadata.file_path")))


def read_raw_reviews(spark: SparkSession, root: str) -> DataFrame:
    """S3: every ``<isbn>/reviews/<user>.json`` below ``root``."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], nullable(REVIEW))
    files = (
        spark.read.schema(nullable(REVIEW))
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .json(root)
    )
    return files.where(is_review_path(F.col("_metadata.file_path")))


def list_store(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``(path, modificationTime, length)``; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return files.select("path", "modificationTime", "length")


def store_keys(paths: DataFrame) -> DataFrame:
    """``(isbn, user)`` of each path; ``user`` is NULL for non-reviews."""
    path = F.col("path")
    return paths.select(
        isbn_of_path(path).alias("isbn"), F.when(is_review_path(path), user_of_path(path)).alias("user")
    )


CORRUPT = "_corrupt_record"
FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("modified", T.TimestampType())])


class TreeIndex:
    """A record tree read once: a table of its files, and tables of what they hold.

    Each :meth:`sync` lists the tree, finds the files that are not in the table with their
    time of change, and appends what they hold; Spark opens no file that is older than the
    oldest of them. A file that has changed is read
    again, and its newest content counts. A file that holds no record as it should goes to
    :meth:`unreadable` with its text, and no record is made of it. A sync that is repeated
    after a failure replaces what it had written.
    """

    def __init__(self, spark: SparkSession, root: str, path: str) -> None:
        self.spark, self.root, self.path = spark, root, path.rstrip("/")

    def _syncs(self) -> list[int]:
        """Numbers of finished syncs: those whose table of files, written last, is whole."""
        names = list_names(self.spark, f"{self.path}/files")
        numbers = [int(name.split("=", 1)[1]) for name in names if name.startswith("sync=")]
        return [n for n in sorted(numbers) if path_exists(self.spark, f"{self.path}/files/sync={n}/_SUCCESS")]

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        columns = T.StructType([*nullable(schema).fields, T.StructField("sync", T.IntegerType())])
        done = self._syncs()
        if not done:
            return self.spark.createDataFrame([], columns)
        rows = self.spark.read.schema(columns).parquet(f"{self.path}/{name}")
        return rows.where(F.col("sync").isin(done))

    def new_files(self) -> DataFrame:
        """``(path, modified)`` of record files that no sync has read in this state."""
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], FILE)
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        listed = files.load(self.root).select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified"))
        return listed.join(self._table("files", FILE).drop("sync"), ["path", "modified"], "left_anti")

    def _read(self, schema: T.StructType, since: str | None) -> DataFrame:
        """Records of files changed since then, with their path and the text of unreadable ones."""
        columns = T.StructType([*nullable(schema).fields, T.StructField(CORRUPT, T.StringType())])
        read = self.spark.read.schema(columns).option("columnNameOfCorruptRecord", CORRUPT)
        read = read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        if since is not None:
            read = read.option("modifiedAfter", since).option("timeZone", "UTC")
        return read.json(self.root).withColumn("path", F.col("_metadata.file_path"))

    def sync(self) -> int:
        """Read what is new; returns how many files that were."""
        new = self.new_files().persist()
        try:
            n = new.count()
            if not n:
                return 0
            done = self._syncs()
            sync = (done[-1] if done else -1) + 1
            # Nothing that is new is older than this; of files as old, only new ones are kept.
            first = F.date_format(F.to_utc_timestamp(F.min("modified"), F.current_timezone()) - F.expr("interval 1 second"), "yyyy-MM-dd'T'HH:mm:ss")
            since = new.agg(first).first()[0]
            for name, schema, review in (("attributes", BOOK, False), ("reviews", REVIEW, True)):
                rows = self._read(schema, since if done else None)
                rows = rows.where(is_review_path(F.col("path")) == review).join(new.select("path"), "path", "left_semi")
                rows = rows.select(*schema.names, CORRUPT, "path")
                rows.write.mode("overwrite").parquet(f"{self.path}/{name}/sync={sync}")
            new.write.mode("overwrite").parquet(f"{self.path}/files/sync={sync}")
            return n
        finally:
            new.unpersist()

    def _newest(self, name: str, schema: T.StructType) -> DataFrame:
        columns = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType()), T.StructField("path", T.StringType())])
        rows = self._table(name, columns)
        last = F.max("sync").over(Window.partitionBy("path"))
        return rows.withColumn("_last", last).where("sync = _last").drop("_last", "sync")

    def attributes(self) -> DataFrame:
        """S2."""
        return self._newest("attributes", BOOK).where(F.col(CORRUPT).isNull()).select(*BOOK.names)

    def reviews(self) -> DataFrame:
        """S3."""
        return self._newest("reviews", REVIEW).where(F.col(CORRUPT).isNull()).select(*REVIEW.names)

    def unreadable(self) -> DataFrame:
        """V8: quarantine rows of files that hold no record as it should be."""
        both = [self._newest(name, schema) for name, schema in (("attributes", BOOK), ("reviews", REVIEW))]
        rows = both[0].select("path", CORRUPT).unionByName(both[1].select("path", CORRUPT)).where(F.col(CORRUPT).isNotNull())
        reason = F.concat(F.lit("not a record: "), F.substring(CORRUPT, 1, 200))
        return conform(
            rows.select(F.lit(None).cast("bigint").alias("page_id"), F.col("path").alias("url"), F.lit("record").alias("field"), reason.alias("reason")),
            QUARANTINE,
        )

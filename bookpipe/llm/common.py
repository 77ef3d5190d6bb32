"""What the operators share: tables, shared folders, code on the workers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import inspect
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.session import shared_dir

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder."""
    path = shared_path(spark, name)
    rows.write.parquet(path)
    return spark.read.parquet(path)


#: Documents go to Python in small batches, since texts may be long. Only defaults are replaced.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m"),
}


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per Spark context, as --py-files would.

    Also lowers the session's Arrow batch sizes where they are at their defaults.
    """
    for key, (default, small) in BATCHES.items():
        if spark.conf.get(key, default).rstrip("Bb") == default.rstrip("b"):
            spark.conf.set(key, small)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "bookpipe_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def release() -> None:
    """Give back memory that is free inside a worker: workers are reused, and what one batch took adds to the next."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def releasing(work: Callable) -> Callable:
    """``work`` of a task, a generator or not, that gives back memory when it ends: an idle worker holds on to the rest."""

    @functools.wraps(work)
    def stream(*args):
        try:
            yield from work(*args)
        finally:
            release()

    @functools.wraps(work)
    def call(*args):
        try:
            return work(*args)
        finally:
            release()

    return stream if inspect.isgeneratorfunction(work) else call


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def digest128(column: Column) -> Column:
    """128 bits that stand for a text, as binary."""
    return F.unhex(F.md5(column.cast("binary")))

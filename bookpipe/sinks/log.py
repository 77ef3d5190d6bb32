"""Keyed upsert as a log (W2): batches are appended, the newest row of a key is found on reading.

A store is a folder with ``delta/batch=<name>`` for each batch and ``base/gen=<n>/bucket=<b>``
for what compactions have merged; its ledger names the finished ones in order. A batch writes
its own rows and touches no file that is there. Reading takes the newest row of each key from
the deltas and, of the base, the rows whose keys no delta holds. A compaction merges the
deltas into the base for the buckets that have gathered enough, and leaves other buckets as
they are; readers go on with the files they know until the ledger names the new ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.operators.ranking import one_per_key
from bookpipe.schema import nullable
from bookpipe.session import checkpointed
from bookpipe.sinks.ledger import FOLDER, Ledger
from bookpipe.sinks.upsert import last_write
from bookpipe.sources.raw_tree import list_names, path_exists

BUCKETS = 256
SEQ, BUCKET, BATCH = "_seq", "_bucket", "batch"


class Contents(NamedTuple):
    """What the ledger names: batches in order, and for each bucket its merged files and up to which batch."""

    batches: dict[str, int]
    bases: dict[int, int]
    merged: dict[int, int]


class KeyedLog:
    """Rows of ``schema``, one for each value of ``keys``, the last written."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = ("isbn", "user"), buckets: int = BUCKETS
    ) -> None:
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), nullable(schema), list(keys)
        self.ledger = Ledger(spark, f"{self.path}/{FOLDER}")
        layout = f"{self.path}/layout"
        if path_exists(spark, f"{layout}/_SUCCESS"):
            stored = spark.read.schema("buckets int").parquet(layout).first()[0]
            if stored != buckets:
                raise ValueError(f"the store has {stored} buckets, not {buckets}")
        else:
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(layout)
            self.ledger.open()
        self.buckets = buckets

    def _bucket(self) -> Column:
        return F.pmod(F.hash(self.keys[0]), F.lit(self.buckets))

    def contents(self) -> Contents:
        batches, bases, merged = {}, {}, {}
        for seq, entry in enumerate(self.ledger.batches()):
            kind, name = entry.split("-", 1)
            if kind == "delta":
                batches[name] = seq
                continue
            gen, upto = map(int, name.split("-"))
            for folder in list_names(self.spark, f"{self.path}/base/gen={gen}"):
                if folder.startswith(f"{BUCKET}="):
                    bucket = int(folder.split("=", 1)[1])
                    bases[bucket], merged[bucket] = gen, upto
        return Contents(batches, bases, merged)

    def append(self, rows: DataFrame, arrival: Sequence[str], name: str | None = None) -> None:
        """The last row of each key of a batch, in arrival order; a batch that is finished is not written again."""
        if not arrival:
            raise ValueError("arrival must order the rows of one key")
        name = name or uuid.uuid4().hex
        if f"delta-{name}" in self.ledger.batches():
            return
        new = last_write(rows, self.keys, arrival).select(*self.schema.names)
        new.withColumn(BUCKET, self._bucket()).write.mode("overwrite").parquet(f"{self.path}/delta/{BATCH}={name}")
        self.ledger.commit(f"delta-{name}")

    def _deltas(self, contents: Contents) -> DataFrame:
        """Rows of batches that their bucket's base does not hold yet, with their place in the ledger."""
        least = min(contents.merged.values(), default=-1) if len(contents.merged) == self.buckets else -1
        later = {name: seq for name, seq in contents.batches.items() if seq > least}
        columns = T.StructType([*self.schema.fields, *(T.StructField(n, t) for n, t in ((BUCKET, T.IntegerType()), (BATCH, T.StringType())))])
        if not later:
            return self.spark.createDataFrame([], columns).withColumn(SEQ, F.lit(0))
        rows = self.spark.read.schema(columns).parquet(f"{self.path}/delta").where(F.col(BATCH).isin(list(later)))
        place = F.create_map(*(F.lit(x) for item in later.items() for x in item))
        rows = rows.withColumn(SEQ, place[F.col(BATCH)])
        if contents.merged:
            upto = F.create_map(*(F.lit(x) for item in contents.merged.items() for x in item))
            rows = rows.where(F.col(SEQ) > F.coalesce(upto[F.col(BUCKET)], F.lit(-1)))
        return rows

    def _bases(self, contents: Contents, buckets: Sequence[int] | None = None) -> DataFrame:
        columns = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        wanted = [b for b in contents.bases if buckets is None or b in buckets]
        if not wanted:
            return self.spark.createDataFrame([], columns)
        parts = [f"{self.path}/base/gen={contents.bases[b]}/{BUCKET}={b}" for b in wanted]
        read = self.spark.read.schema(T.StructType([*columns.fields, T.StructField("gen", T.IntegerType())]))
        return read.option("basePath", f"{self.path}/base").parquet(*parts).drop("gen")

    def read(self) -> DataFrame:
        """The newest row of each key."""
        contents = self.contents()
        newest = one_per_key(self._deltas(contents), self.keys, [F.desc(SEQ)]).drop(SEQ, BATCH)
        kept = self._bases(contents).join(newest.select(*self.keys), self.keys, "left_anti")
        return kept.unionByName(newest).select(*self.schema.names)

    def compact(self, least_rows: int = 1) -> list[int]:
        """Merge the deltas of buckets that have gathered ``least_rows`` rows; returns those buckets."""
        contents = self.contents()
        deltas = self._deltas(contents)
        sizes = deltas.groupBy(BUCKET).count().where(F.col("count") >= least_rows)
        chosen = sorted(r[BUCKET] for r in sizes.select(BUCKET).collect())  # at most ``buckets`` numbers
        if not chosen:
            return []
        newest = one_per_key(deltas.where(F.col(BUCKET).isin(chosen)), self.keys, [F.desc(SEQ)]).drop(SEQ, BATCH)
        kept = self._bases(contents, chosen).join(newest.select(*self.keys), self.keys, "left_anti")
        gens = [int(name.split("=", 1)[1]) for name in list_names(self.spark, f"{self.path}/base")]
        gen, upto = max(gens, default=0) + 1, max(contents.batches.values())
        merged = checkpointed(kept.unionByName(newest))
        # A rebalance splits an oversized bucket over several tasks.
        merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/base/gen={gen}")
        self.ledger.commit(f"base-{gen}-{upto}")
        return chosen

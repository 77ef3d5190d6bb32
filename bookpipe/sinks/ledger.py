"""Which batches are finished: one commit for all stores that a run writes.

A run writes its rows to every store under the name of its batch and then adds that
name to the ledger, in one rename. Readers leave out the rows of batches that the
ledger does not name, so a run that stops between two stores has stored nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from bookpipe.sources.raw_tree import hadoop_path, list_names, path_exists

FOLDER = "_ledger"


def same_batch(name: str, batch: str | None) -> bool:
    """Whether ``batch`` means this one; ``start*`` means all whose names start so."""
    return batch is not None and (name.startswith(batch[:-1]) if batch.endswith("*") else name == batch)


def other_batch(column: str, batch: str | None) -> Column:
    if batch is None:
        return F.lit(True)
    return ~F.col(column).startswith(batch[:-1]) if batch.endswith("*") else F.col(column) != batch


class Ledger:
    """A folder with one empty file for each finished batch, named by place and batch.

    A store without the folder has been written by direct calls only; all its batches
    count. Runs on one store follow one another: the ledger has one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def _entries(self) -> list[str]:
        return [name for name in list_names(self.spark, self.path) if not name.startswith(".")]

    def batches(self) -> list[str]:
        """Names of finished batches, the oldest first: as many as there were runs."""
        return [name.split(".", 1)[1] for name in self._entries()]

    def open(self, known: Iterable[str] = ()) -> None:
        """Start the ledger if there is none; batches stored so far count as finished."""
        if not self.exists():
            files, place = hadoop_path(self.spark, self.path)
            files.mkdirs(place)
            for batch in known:
                self.commit(batch)

    def commit(self, batch: str) -> None:
        entries = self._entries()
        if any(name.split(".", 1)[1] == batch for name in entries):
            return
        number = int(entries[-1].split(".", 1)[0]) + 1 if entries else 0
        files, draft = hadoop_path(self.spark, f"{self.path}/.{uuid.uuid4().hex}")
        files.create(draft).close()
        if not files.rename(draft, hadoop_path(self.spark, f"{self.path}/{number:012d}.{batch}")[1]):
            raise RuntimeError(f"could not commit batch {batch}")

    def withdraw(self, batch: str) -> None:
        """Before a finished batch is written anew, it counts as unfinished."""
        for name in self._entries():
            if name.split(".", 1)[1] == batch:
                files, place = hadoop_path(self.spark, f"{self.path}/{name}")
                files.delete(place, False)

    def finished(self, column: str, without: str | None = None) -> Column:
        """Whether a row is of a finished batch other than ``without``; a filter on a partition column."""
        if not self.exists():
            return other_batch(column, without)
        return F.col(column).isin([b for b in self.batches() if not same_batch(b, without)])

"""Token ids in Parquet files from which single documents or metadata can be read.

One row per document in ascending ``doc_id`` order: ``doc_id, part, part_start,
n_tokens, ids``. Ids are a list column in dictionary encoding (one vocabulary is a
small dictionary), bit-packed; the other columns are delta-encoded (writer version
2). Row groups and pages are small, and their column indexes carry the bounds of
``doc_id``: a reader that asks for some documents fetches their pages only, one that
asks for metadata never touches the ids. ``part`` is the write task and
``part_start`` counts ids before the document in it; starts in the whole corpus are
the sums of earlier parts, one row per part, added on reading.

Cases: null and empty texts hold the end id alone. Rows without doc_id come first.
Equal doc_ids are ordered by text. Extra columns are not written.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from bookpipe.llm.common import ship, text_or_empty

END_ID = 1
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
#: Parts of words in each of a worker's two generations of remembered ids.
MEMO_PARTS = 400_000
#: Latin letters below U+0180, but not the dotted capital I (two characters in lower case), then ASCII marks.
LATIN = "^(?P<a>[A-Za-zªµºÀ-ÖØ-öø-įı-ſ]+)(?P<b>[" + re.escape(string.punctuation) + "]*)$"


def byte_chars() -> list[str]:
    """The character of each byte in byte-level BPE: itself if printable, else the next one from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


BYTE_CHARS = byte_chars()


class WordEncoder:
    """Encodes by a tokenizers file, each different word of a batch once.

    The tokenizer drops white space, so a text's ids are those of its space-separated
    words, one after another; a special token in a text is one word or part of one. Latin
    letters below U+0180 are in normal form and a run of them is one pre-token, as is a run
    of ASCII marks after it, so the parts of such words go straight to the file's BPE model,
    in the byte-level alphabet; all other words go through the tokenizer. That holds for
    files whose normaliser lowers letters and whose specials hold marks: others, found out
    on loading, take the tokenizer for all words.

    Words are split and numbered in Arrow, parts of words are remembered in two generations
    of MEMO_PARTS: when the newer is full it becomes the older, from which parts in use move
    on. Nothing grows with the corpus.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.latin = LATIN if self._shortcut_holds() else "^$"

    def _shortcut_holds(self) -> bool:
        """Whether parts of words encode as the words do, on words of each kind of part."""
        samples = ["Word", "straße", "ÉTÉ", "don't", "end.", "x!?", "A,", "ÿ...", "the\"", "ŉ-"]
        specials = [added.content for added in self.tokenizer.get_added_tokens_decoder().values()]
        if any(re.fullmatch(LATIN, special) for special in specials):
            return False
        for word in samples:
            found = re.fullmatch(LATIN, word)
            if found and self._whole([word])[0] != b"".join(map(self._model, filter(None, (found[1].lower(), found[2])))):
                return False
        return True

    def _whole(self, words: list[str]) -> list[bytes]:
        return [array("I", found.ids).tobytes() for found in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _model(self, part: str) -> bytes:
        mapped = part if part.isascii() else "".join(map(BYTE_CHARS.__getitem__, part.encode()))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()

    def _remembered(self, parts: list[str], encode) -> list[bytes]:
        """Ids of different parts; ``encode`` makes those of new ones."""
        out = [self.memo.get(part) for part in parts]
        missing = [i for i, ids in enumerate(out) if ids is None]
        if len(self.memo) + len(missing) > MEMO_PARTS:
            self.older, self.memo = self.memo, {}
        new = []
        for i in missing:
            known = self.older.get(parts[i])
            if known is None:
                new.append(i)
            else:
                out[i] = self.memo[parts[i]] = known
        for i, ids in zip(new, encode([parts[i] for i in new]), strict=True):
            out[i] = self.memo[parts[i]] = ids
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and how many each text has."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        parts = pc.extract_regex(words, self.latin)
        plain = pc.is_valid(parts)
        first = pc.utf8_lower(pc.struct_field(parts, "a"))
        second = pc.struct_field(parts, "b")
        if not pc.any(plain).as_py():
            first = second = pa.nulls(len(words), pa.string())
        listed = pa.concat_arrays([first.cast(pa.string()), second.cast(pa.string())]).dictionary_encode()
        pieces = self._remembered(listed.dictionary.to_pylist(), lambda new: list(map(self._model, new)))
        others = pc.filter(words, pc.invert(plain))
        # A blank keeps whole words apart from parts of the same letters.
        pieces += self._remembered([" " + word for word in others.to_pylist()], lambda new: self._whole([word[1:] for word in new]))
        pieces.append(b"")
        sizes = np.fromiter(map(len, pieces), dtype="int64", count=len(pieces)) // 4
        pool, starts = np.frombuffer(b"".join(pieces), dtype="<i4"), np.cumsum(sizes) - sizes
        # Each word is two pieces: its parts, or the whole word and nothing.
        at = listed.indices.fill_null(len(pieces) - 1).to_numpy().astype("int64").reshape(2, -1)
        rest = ~plain.to_numpy(zero_copy_only=False)
        at[0, rest] = len(listed.dictionary) + np.arange(len(others))
        chosen = at[:, coded.indices.to_numpy()].T.ravel()
        lengths = sizes[chosen]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ids = pool[np.arange(before[-1]) + np.repeat(starts[chosen] - before[:-1], lengths)]
        return ids, np.diff(before[2 * split.offsets.to_numpy().astype("int64")])


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


ENCODED = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
)


def _encode_part(tokenizer_path: str, end_id: int):
    def encode_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at, part = word_encoder(tokenizer_path), 0, TaskContext.get().partitionId()
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            found, sizes = encode(batch.column(1))
            ends = np.cumsum(sizes + 1)
            ids = np.full(ends[-1], end_id, dtype="int32")
            inner = np.ones(len(ids), dtype=bool)
            inner[ends - 1] = False
            ids[inner] = found
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype("int32"), ids)
            starts = at + ends - sizes - 1
            at += int(ends[-1])
            columns = [batch.column(0), pa.array([part] * rows, pa.int32()), pa.array(starts), pa.array(sizes + 1), lists]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, ENCODED, strict=True)], schema=ENCODED)

    return encode_part


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write the files, one per range of doc_id."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    tie = F.xxhash64("text")
    placed = texts.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    rows = placed.mapInArrow(
        _encode_part(tokenizer_path, end_id), "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"
    )
    (
        rows.write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.dictionary.page.size", 1 << 20)
        .parquet(path)
    )


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens of every document; ids are not read."""
    return _with_start(spark.read.parquet(path).select("doc_id", "part", "part_start", "n_tokens"))


def tokens(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document or of some."""
    files = spark.read.parquet(path)
    parts = _part_starts(files)
    if doc_ids is not None:
        files = files.where(F.col("doc_id").isin(list(doc_ids)))
    return _with_start(files, parts)


def _part_starts(files: DataFrame) -> DataFrame:
    """Ids before each part: one row per write task."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    return sums.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))


def _with_start(files: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    parts = _part_starts(files) if parts is None else parts
    # One row for each write task: as bounded as the number of tasks itself.
    joined = files.join(F.broadcast(parts), "part")
    return joined.withColumn("start", F.col("_before") + F.col("part_start")).drop("_before", "part", "part_start")


@F.pandas_udf(LongType())
def ids_crc32(ids: pd.Series) -> pd.Series:
    import zlib

    return ids.map(lambda x: zlib.crc32(x.astype("<u4").tobytes()))


def token_digests(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write, read back, and give doc_id, start, n_tokens, ids_crc32 of each row."""
    write(docs, path, tokenizer_path, end_id)
    back = tokens(docs.sparkSession, path)
    return back.select("doc_id", F.col("start").cast("bigint").alias("start"), "n_tokens", ids_crc32("ids").alias("ids_crc32"))

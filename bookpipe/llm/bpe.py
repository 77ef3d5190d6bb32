"""Byte-level BPE of whole documents by overlapping chunks, and back.

A document of up to ``chunk`` characters is encoded in one call. A longer one is
cut into overlapping chunks that are pre-tokenised in parallel. Two neighbours
resynchronise at the first place of their overlap that both take as a boundary
between pre-tokens; there the document is cut, the pieces are encoded in parallel
and their ids are joined in order. Pre-tokens are matched from left to right and
look ahead by one run of white space at most, so from a common boundary on both
chunks go on alike. Only boundaries after a character that is not white space
count, since a cut there leaves the match before it as it is.

Cases: null or empty text gives no ids. A document with a seam where nothing
resynchronises (a run without boundary longer than the overlap) is encoded whole.
Equal long texts are encoded once. Other columns pass through; existing columns of
the output's name are replaced. Repeated rows stay repeated.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookpipe.llm.common import digest128, release, ship, text_or_empty

CHUNK = 65_536
OVERLAP = 1_024


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def to_bytes(ids: list[int]) -> bytes:
    import numpy as np

    return np.asarray(ids, dtype="<u4").tobytes()


def boundaries(text: str, pattern: str, low: int, high: int) -> list[int]:
    """Reliable boundaries between pre-tokens in ``low..high``; matching starts at 0."""
    found, last = [], len(text)
    for match in regex.finditer(pattern, text):
        end = match.end()
        if end >= last or end > high:
            break
        if end >= low and not text[end - 1].isspace():
            found.append(end)
    return found


def _encode_texts(ranks_path: str, pattern: str):
    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        code = encoding(ranks_path, pattern)
        for texts in batches:
            yield texts.map(lambda text: to_bytes(code.encode_ordinary(text)))
            release()

    return encode


def decode(ids_column: str, ranks_path: str, pattern: str):
    """The bytes that an id column stands for; null stays null."""

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        code = encoding(ranks_path, pattern)
        for ids in batches:
            yield ids.map(lambda raw: None if raw is None else code.decode_bytes(np.frombuffer(raw, dtype="<u4").tolist()))
            release()

    return decoded(F.col(ids_column))


def _cut(chunk: int, overlap: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["_key"], batch["_text"], strict=True):
                starts = range(0, len(text), chunk)
                yield pd.DataFrame(
                    {
                        "_key": [key] * len(starts),
                        "_no": list(range(len(starts))),
                        "_text": [text[at : at + chunk + overlap] for at in starts],
                    }
                )

    return cut


def _pretokenise(chunk: int, overlap: int, pattern: str):
    def pretokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            heads, tails = [], []
            for text in batch["_text"]:
                places = boundaries(text, pattern, 1, chunk + overlap)
                heads.append([p for p in places if p <= overlap])
                tails.append([p - chunk for p in places if p > chunk])
            yield batch.assign(_head=heads, _tail=tails)

    return pretokenise


def _join_ids(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("_no")
    return pd.DataFrame({"_key": group["_key"].iloc[:1].values, "_ids": [b"".join(group["_piece"])]})


def encode_long(texts: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(_key, _ids) for each different text of (_key, _text), longer than a chunk."""
    chunks = texts.mapInPandas(_cut(chunk, overlap), "_key binary, _no int, _text string")
    chunks = chunks.dropDuplicates(["_key", "_no"])
    marked = chunks.mapInPandas(
        _pretokenise(chunk, overlap, pattern),
        "_key binary, _no int, _text string, _head array<int>, _tail array<int>",
    )
    order = Window.partitionBy("_key").orderBy("_no")
    both = F.array_min(F.array_intersect("_tail", F.lead("_head").over(order)))
    cut = (
        marked.withColumn("_end", both)
        .withColumn("_last", F.lead("_no").over(order).isNull())
        .withColumn("_start", F.lag("_end").over(order))
        .withColumn("_torn", F.max(F.col("_end").isNull() & ~F.col("_last")).over(Window.partitionBy("_key")))
    )
    # What belongs to a chunk: from the cut before it to the cut after it; in a torn text, its own characters.
    own = (
        F.when(F.col("_torn"), F.substring("_text", F.lit(1), F.lit(chunk)))
        .when(F.col("_last"), F.substring("_text", F.coalesce("_start", F.lit(0)) + 1, F.char_length("_text")))
        .otherwise(F.substring("_text", F.coalesce("_start", F.lit(0)) + 1, F.lit(chunk) + F.col("_end") - F.coalesce("_start", F.lit(0))))
    )
    pieces = cut.select("_key", "_no", "_torn", own.alias("_own"))
    encode = _encode_texts(ranks_path, pattern)
    whole = (
        pieces.where("_torn")
        .groupBy("_key")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_no", "_own"))), lambda p: p["_own"]), "").alias("_own"))
        .select("_key", encode("_own").alias("_ids"))
    )
    stitched = (
        pieces.where(~F.col("_torn"))
        .select("_key", "_no", encode("_own").alias("_piece"))
        .groupBy("_key")
        .applyInPandas(_join_ids, "_key binary, _ids binary")
    )
    return stitched.unionByName(whole)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    out: str = "ids",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` with ``out``: ids as little-endian unsigned 32-bit integers."""
    ship(docs.sparkSession)
    docs = docs.drop(out) if out != text else docs
    long = F.char_length(text_or_empty(text)) > chunk
    short = docs.where(~long).withColumn(out, _encode_texts(ranks_path, pattern)(text_or_empty(text)))
    keyed = docs.where(long).withColumn("_key", digest128(F.col(text)))
    ids = encode_long(keyed.select("_key", F.col(text).alias("_text")), ranks_path, pattern, chunk, overlap)
    joined = keyed.join(ids.withColumnRenamed("_ids", out), "_key").drop("_key")
    return short.unionByName(joined)


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row."""
    ids = encode(docs.select("doc_id", "text"), ranks_path, pattern, out="_encoded").select("doc_id", "_encoded")
    return ids.withColumn("_decoded", decode("_encoded", ranks_path, pattern)).select(
        "doc_id",
        F.floor(F.octet_length("_encoded") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("_encoded", 256).alias("ids_sha256"),
        F.sha2("_decoded", 256).alias("decoded_sha256"),
    )

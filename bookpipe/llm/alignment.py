"""Which tokens of one tokenizer stand for the same bytes as which tokens of another.

A is a byte-level BPE file, B a sentencepiece model. Both encode a blank and the text. A
token covers bytes; where tokens of both end together, the text falls into groups. Tokens
are linked if their bytes overlap, and loosely linked if they share a group:

* token-byte matrices in compressed rows, A and B: row i of the product A B^T (by
  Gustavson's rows) holds the tokens of B that token i overlaps, with the shared bytes;
* token-group matrices: their product holds the pairs within a group.

Both tokenizers start anew where a blank follows a character that is no white space: A's
pattern has no match across such a place, and no piece of B has a blank after another
character (checked when the model is loaded; otherwise texts are not cut). So texts are cut
there into units, each different unit of a chunk of documents is encoded and linked once,
and documents are sums: the product of the documents-by-units matrix and the units-by-pairs
matrix gives how often a document links each pair of ids.

``digests`` counts, for each pair of ids, the documents that hold it linked. A chunk of
documents becomes one row of a table, in packed arrays. Its pairs of ids go out as rows
with their numbers of documents, are summed over the corpus, and come back to the chunk.
The best count of each id of A is one row for each entry of A's vocabulary.

Cases: a text that is null or empty, or whose tokens' bytes are not those of the blank and
the text in A or in B (a text that holds U+2581), has no tokens: zeros, no groups, and it
links nothing. Texts longer than a chunk are taken piece by piece; a text in which some
unit fails is encoded whole, to see whether the whole fails too. Repeated rows count as
documents of their own. Extra columns are ignored, whatever their names. No rows give none.
"""

from __future__ import annotations

import hashlib
import os
import re
import string
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.llm.common import shared_path, ship, text_or_empty
from bookpipe.llm.packing import pack, pack_ids, unpack, unpack_ids
from bookpipe.llm.sparse import Csr, one_each, product, runs, summed, transposed
from bookpipe.llm.token_files import BYTE_CHARS

#: Characters and documents of a chunk; a longer text is a chunk of its own, in pieces of this size.
CHUNK, CHUNK_ROWS = 4_000_000, 8_192
#: Where both tokenizers start anew, and what shows that a text has such a blank after white space.
CUT, DOUBTFUL = re.compile(r"(?<=\S)(?= )"), re.compile(r"\s ")
#: A blank with Latin letters, then ASCII marks: at most two pre-tokens of A.
PLAIN = "^(?P<a> [A-Za-zªµºÀ-ÖØ-öø-ſ]+)(?P<b>[" + re.escape(string.punctuation) + "]*)$"
BLANK = "▁"
SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")


class Units(NamedTuple):
    """Tokens, groups and links of each unit."""

    sums: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    links: Csr
    right: np.ndarray


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text here
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {char: bytes([byte]) for byte, char in enumerate(BYTE_CHARS)}
        names = sorted((i, name) for name, i in self.a.get_vocab(with_added_tokens=True).items())
        self.a_bytes = [b""] * (names[-1][0] + 1)
        for i, name in names:
            self.a_bytes[i] = b"".join(byte_of.get(char, char.encode()) for char in name)
        self.b_bytes, self.cuts = [], True
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.b_bytes.append(piece.replace(BLANK, " ").encode())
                self.cuts &= BLANK not in piece.lstrip(BLANK)
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), dtype="int64") for x in (self.a_bytes, self.b_bytes))
        # Whether the file is of the kind that PLAIN is for: no normaliser, and parts that encode as they do within a text.
        samples = [" word", " Été,", " x!?", " don.", " µ(", " Straße...", " a$", " of'"]
        self.plain = True
        self.plain = self.a.normalizer is None and self.encode_a(samples) == self._whole(samples)
        self.written = [f"{i}{mark}" for x, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for mark in marks for i in range(len(x))]

    def cut(self, text: str) -> list[str]:
        """The units of a text, which starts with a blank."""
        if not self.cuts:
            return [text]
        if DOUBTFUL.search(text):
            return CUT.split(text)
        return [f" {word}" for word in text[1:].split(" ")]

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return self.encode_a(units), self.b.encode([unit[1:] for unit in units], num_threads=1)

    def _whole(self, units: list[str]) -> list[list[int]]:
        return [found.ids for found in self.a.encode_batch_fast(units, add_special_tokens=False)]

    def _part(self, part: str) -> list[int]:
        mapped = part.replace(" ", BYTE_CHARS[32]) if part.isascii() else "".join(map(BYTE_CHARS.__getitem__, part.encode()))
        return [token.id for token in self.a.model.tokenize(mapped)]

    def encode_a(self, units: list[str]) -> list[list[int]]:
        """Ids of A. A blank with letters and a run of marks are pre-tokens: they go straight to the model, each once."""
        if not self.plain:
            return self._whole(units)
        parts = pc.extract_regex(pa.array(units, pa.string()), PLAIN)
        others = np.flatnonzero(~pc.is_valid(parts).to_numpy(zero_copy_only=False)).tolist()
        coded = pa.concat_arrays([pc.struct_field(parts, name).cast(pa.string()) for name in ("a", "b")]).dictionary_encode()
        pieces = list(map(self._part, coded.dictionary.to_pylist())) + [[]]
        at = coded.indices.fill_null(len(pieces) - 1).to_numpy().reshape(2, -1).tolist()
        out = [pieces[i] + pieces[j] for i, j in zip(*at, strict=True)]
        for i, ids in zip(others, self._whole([units[i] for i in others]), strict=True):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers, and how many each list has."""
    sizes = np.fromiter(map(len, lists), dtype="int64", count=len(lists))
    return np.fromiter((x for one in lists for x in one), dtype="int64", count=int(sizes.sum())), sizes


def groups_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each token of A and of B, from the bytes each covers, and the number of groups."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends), len(ends)


def overlaps(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Csr:
    """Tokens of A by tokens of B: the bytes they share."""
    return product(runs(a_sizes), transposed(runs(b_sizes)))


def shared(a_groups: np.ndarray, b_groups: np.ndarray, n: int) -> Csr:
    """Tokens of A by tokens of B: one for each pair within a group."""
    return product(one_each(a_groups, n), transposed(one_each(b_groups, n)))


def align_units(units: list[str], codes: Tokenizers) -> Units:
    """Each unit linked on its own; units whose tokens do not give their bytes back have none."""
    a, b = codes.encode(units)
    raw = [unit.encode() for unit in units]
    right = np.ones(len(units), dtype=bool)
    for lists, table in ((a, codes.a_bytes), (b, codes.b_bytes)):
        right &= np.array([b"".join(map(table.__getitem__, ids)) == text for ids, text in zip(lists, raw, strict=True)], dtype=bool)
    (a_ids, a_n), (b_ids, b_n) = (flat([x if ok else [] for x, ok in zip(lists, right, strict=True)]) for lists in (a, b))
    a_sizes, b_sizes = codes.a_sizes[a_ids], codes.b_sizes[b_ids]
    a_groups, b_groups, n = groups_of(a_sizes, b_sizes)
    found = overlaps(a_sizes, b_sizes)
    a_unit = np.repeat(np.arange(len(units)), a_n)

    key = (a_ids[found.row_of()] << 32) | b_ids[found.columns]
    pairs, local = np.unique(key, return_inverse=True)
    links = summed(a_unit[found.row_of()], local, np.ones(len(local), dtype="int64"), len(units), len(pairs))
    group_unit = a_unit[np.searchsorted(a_groups, np.arange(n))] if n else np.zeros(0, dtype="int64")
    # Row sums of the product of both group matrices: the tokens of B in the group of each token of A.
    partners = np.bincount(b_groups, minlength=n)[a_groups]
    sums = np.stack(
        [
            a_n,
            b_n,
            np.bincount(group_unit, minlength=len(units)),
            links.row_sums(),
            np.bincount(a_unit, weights=partners, minlength=len(units)).astype("int64"),
        ]
    ).astype("int64")
    return Units(sums, _written(a_ids, b_ids, a_groups, b_groups, a_n + b_n, codes), pairs, links, right)


def _written(a_ids, b_ids, a_groups, b_groups, sizes: np.ndarray, codes: Tokenizers) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each unit."""
    n_a, n_b, ends = len(codes.a_bytes), len(codes.b_bytes), np.zeros(1, dtype=bool)
    a_last = np.concatenate([a_groups[1:] != a_groups[:-1], ~ends])[: len(a_ids)]
    b_last = np.concatenate([b_groups[1:] != b_groups[:-1], ~ends])[: len(b_ids)]
    order = np.empty(len(a_ids) + len(b_ids), dtype="int64")
    order[np.arange(len(a_ids)) + np.searchsorted(b_groups, a_groups)] = a_ids + a_last * n_a
    order[np.arange(len(b_ids)) + np.searchsorted(a_groups, b_groups, side="right")] = 2 * n_a + b_ids + b_last * n_b
    marks = list(map(codes.written.__getitem__, order.tolist()))
    bounds = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    return ["".join(marks[low:high])[:-1] for low, high in zip(bounds, bounds[1:], strict=False)]


class Documents(NamedTuple):
    """Of each document: sums, digest of groups, and its links as documents by pairs of ids."""

    sums: np.ndarray
    digests: list[str]
    pairs: np.ndarray
    links: Csr


def _align(texts: list[list[str]], codes: Tokenizers) -> tuple[np.ndarray, list[list[str]], np.ndarray, np.ndarray, Csr]:
    """Sums, written groups, rightness, pairs and links of documents that are given as units."""
    sizes = np.fromiter(map(len, texts), dtype="int64", count=len(texts))
    coded = pa.array([unit for text in texts for unit in text], pa.string()).dictionary_encode()
    units = align_units(coded.dictionary.to_pylist(), codes)
    at, owner = coded.indices.to_numpy(zero_copy_only=False).astype("int64"), np.repeat(np.arange(len(texts)), sizes)
    held = summed(owner, at, np.ones(len(at), dtype="int64"), len(texts), len(coded.dictionary))
    sums = np.stack([np.bincount(owner, weights=part[at], minlength=len(texts)) for part in units.sums]).astype("int64")
    right = np.bincount(owner, weights=~units.right[at], minlength=len(texts)) == 0
    bounds, names = np.concatenate([[0], np.cumsum(sizes)]).tolist(), at.tolist()
    written = [[units.groups[i] for i in names[low:high]] for low, high in zip(bounds, bounds[1:], strict=False)]
    return sums, written, right, units.pairs, product(held, units.links)


def _pieces(text: str, chunk: int) -> Iterator[str]:
    """A text cut where both tokenizers start anew, into pieces of a chunk or little more."""
    at = 0
    while len(text) - at > chunk:
        found = CUT.search(text, at + chunk)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def align_long(text: str, codes: Tokenizers, chunk: int = CHUNK) -> Documents:
    """One text, in pieces where it is long; a text with a unit that fails, whole."""
    digest, sums, keys, times, some = hashlib.sha256(), np.zeros((len(SUMS), 1), dtype="int64"), [], [], False
    for piece in _pieces(text, chunk) if codes.cuts else [text]:
        part, written, right, pairs, links = _align([codes.cut(piece)], codes)
        if not right[0]:
            part, written, right, pairs, links = _align([[text]], codes)
            if not right[0]:
                nothing = np.zeros(0, dtype="int64")
                return Documents(np.zeros_like(sums), [""], nothing, Csr(np.zeros(2, dtype="int64"), nothing, nothing, 0))
            digest = hashlib.sha256(";".join(written[0]).encode())
            sums, keys, times = part, [pairs[links.columns]], [links.values]
            break
        digest.update(((";" if some else "") + ";".join(written[0])).encode())
        sums, some = sums + part, True
        keys.append(pairs[links.columns])
        times.append(links.values)
    pairs, local = np.unique(np.concatenate(keys), return_inverse=True)
    links = summed(np.zeros(len(local), dtype="int64"), local, np.concatenate(times), 1, len(pairs))
    return Documents(sums, [digest.hexdigest()], pairs, links)


def align_texts(texts: list[str], codes: Tokenizers, chunk: int = CHUNK) -> Documents:
    """All texts of a chunk."""
    there = [i for i, text in enumerate(texts) if text]
    short = [i for i in there if len(texts[i]) <= chunk]
    found, written, right, pairs, links = _align([codes.cut(" " + texts[i]) for i in short], codes)
    sums, digests = np.zeros((len(SUMS), len(texts)), dtype="int64"), [""] * len(texts)
    own = [i for i, ok in zip(short, right, strict=True) if ok]
    sums[:, own] = found[:, right]
    for i, text, ok in zip(short, written, right, strict=True):
        if ok:
            digests[i] = hashlib.sha256(";".join(text).encode()).hexdigest()
    kept = right[links.row_of()]
    rows, keys, times = [np.array(short, dtype="int64")[links.row_of()[kept]]], [pairs[links.columns[kept]]], [links.values[kept]]
    for i in sorted(set(there) - set(own)):
        one = align_long(" " + texts[i], codes, chunk)
        sums[:, i : i + 1], digests[i] = one.sums, one.digests[0]
        rows.append(np.full(len(one.links.columns), i))
        keys.append(one.pairs[one.links.columns])
        times.append(one.links.values)
    pairs, local = np.unique(np.concatenate(keys), return_inverse=True)
    links = summed(np.concatenate(rows).astype("int64"), local, np.concatenate(times), len(texts), len(pairs))
    return Documents(sums, digests, pairs, links)


def chunked(batches: Iterator[pa.RecordBatch], chunk: int = CHUNK) -> Iterator[tuple[list, list[str]]]:
    """(doc_ids, texts) of up to ``chunk`` characters, or of one longer text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if texts and (size + len(text) > chunk or len(texts) == CHUNK_ROWS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


ROW = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.binary()), ("groups_sha256", pa.list_(pa.string()))]
    + [(name, pa.binary()) for name in ("sums", "entries", "steps", "times")]
    + [("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))]
)
ROW_DDL = (
    "chunk bigint, doc_id binary, groups_sha256 array<string>, sums binary, entries binary, steps binary, "
    "times binary, pairs array<bigint>, docs array<int>"
)


def _chunk_rows(a_path: str, b_path: str, chunk: int):
    def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, part = tokenizers(a_path, b_path), TaskContext.get().partitionId()
        for n, (ids, texts) in enumerate(chunked(batches, chunk)):
            made = align_texts(texts, codes, chunk)
            columns, first = made.links.columns, made.links.bounds[:-1]
            steps = np.diff(columns, prepend=0)  # columns ascend within a document
            filled = first[first < made.links.bounds[1:]]
            steps[filled] = columns[filled]
            row = {
                "chunk": (part << 32) + n,
                "doc_id": pack_ids(ids),
                "groups_sha256": made.digests,
                "sums": pack(made.sums.ravel()),
                "entries": pack(np.diff(made.links.bounds)),
                "steps": pack(steps),
                "times": pack(made.links.values),
                "pairs": made.pairs,
                "docs": np.bincount(columns, minlength=len(made.pairs)),
            }
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in ROW], schema=ROW)

    return chunk_rows


def _finish(replies: pd.DataFrame, chunks: pd.DataFrame) -> pd.DataFrame:
    """The documents of a chunk, from what came back for its pairs."""
    out, replies = [], replies.sort_values("pair")
    docs, best = replies["docs"].to_numpy(dtype="int64"), replies["best"].to_numpy(dtype=bool)
    for row in chunks.itertuples():
        entries, steps = unpack(row.entries), unpack(row.steps)
        # Within a document columns are sums of steps: take off what all documents before it have summed up to.
        ends = np.cumsum(entries)
        total = np.concatenate([[0], np.cumsum(steps)])
        columns = total[1:] - np.repeat(total[ends - entries], entries)
        links = Csr(np.concatenate([[0], ends]), columns, unpack(row.times), len(docs))
        sums = unpack(row.sums).reshape(len(SUMS), -1)
        out.append(
            pd.DataFrame(
                {
                    "doc_id": unpack_ids(row.doc_id),
                    **dict(zip(SUMS, sums, strict=True)),
                    "n_best": links._replace(values=links.values * best[columns]).row_sums(),
                    "count_sum": links._replace(values=links.values * docs[columns]).row_sums(),
                    "groups_sha256": list(row.groups_sha256),
                }
            )
        )
    return pd.concat(out)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, docs, best): the documents that hold each pair of ids linked, and whether no pair of its A id has more."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("_p")).select("_p.pairs", "_p.docs")
    totals = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("docs"))
    totals = totals.withColumn("_a", F.shiftright("pair", 32))
    # One row for each entry of A's vocabulary at most.
    most = totals.groupBy("_a").agg(F.max("docs").alias("_most"))
    return totals.join(F.broadcast(most), "_a").select("pair", "docs", (F.col("docs") == F.col("_most")).alias("best"))


def digests(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256 of each row.

    ``n_shared`` counts the pairs of tokens within a group.
    """
    spark = docs.sparkSession
    ship(spark)
    path = shared_path(spark, "aligned")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    texts.mapInArrow(_chunk_rows(a_path, b_path, chunk), ROW_DDL).write.option("compression", "zstd").parquet(path)
    chunks = spark.read.parquet(path)
    path = shared_path(spark, "pairs")
    pair_counts(chunks).write.option("compression", "zstd").parquet(path)
    counts = spark.read.parquet(path)
    asked = chunks.select(F.col("chunk").alias("_chunk"), F.explode("pairs").alias("pair"))
    replies = asked.join(counts, "pair").select("_chunk", "pair", "docs", "best")
    rows = chunks.drop("pairs", "docs")
    counted = ", ".join(f"{name} bigint" for name in (*SUMS, "n_best", "count_sum"))
    return (
        replies.groupBy("_chunk")
        .cogroup(rows.groupBy("chunk"))
        .applyInPandas(_finish, f"doc_id bigint, {counted}, groups_sha256 string")
    )


def _link_rows(a_path: str, b_path: str, kind: str):
    def link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = tokenizers(a_path, b_path)
        for ids, texts in chunked(batches):
            for doc_id, text in zip(ids, texts, strict=True):
                if not text:
                    continue
                (a,), (b,) = codes.encode([" " + text])
                joined = [b"".join(map(table.__getitem__, x)) for table, x in ((codes.a_bytes, a), (codes.b_bytes, b))]
                if any(x != b" " + text.encode() for x in joined):
                    continue
                a, b = np.array(a, dtype="int64"), np.array(b, dtype="int64")
                if kind == "overlap":
                    found = overlaps(codes.a_sizes[a], codes.b_sizes[b])
                else:
                    found = shared(*groups_of(codes.a_sizes[a], codes.b_sizes[b]))
                rows = found.row_of()
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array([doc_id] * len(rows), pa.int64()), "a_at": rows, "a_id": a[rows], "b_at": found.columns, "b_id": b[found.columns], "n": found.values}
                )

    return link_rows


def links(docs: DataFrame, a_path: str, b_path: str, kind: str = "overlap") -> DataFrame:
    """doc_id, a_at, a_id, b_at, b_id, n of every link: ``overlap`` with the shared bytes, or ``group``."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(_link_rows(a_path, b_path, kind), "doc_id bigint, a_at bigint, a_id bigint, b_at bigint, b_id bigint, n bigint")

"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

The words of a text (ASCII lower case, split at ASCII white space) give its set of
distinct word shingles. Two permutations of the integers below 2^32 make all
signature coordinates: the first scatters a shingle, and the second, shifted
circularly by k, orders the scattered values for coordinate k. Coordinates are banded;
sets that agree on a whole band are candidates.

Texts with the same words are one node, so copies never meet each other. In a bucket
every node is compared with one pivot, another one in each band, and confirmed links
are joined into components. What a bucket still holds of different components is then
compared across them: in small buckets after a filter on sizes and on one bit of each
coordinate, in large ones by products of membership matrices over pairs of blocks,
which give links only. So every candidate pair is either confirmed on full sets,
refuted, or already connected, without emitting the pairs within a group.

With 30 bands of 5 coordinates a pair at similarity 0.8 is no candidate with
probability 7e-6; the bit filter is set 5 standard deviations away from it.

Cases: null, empty and blank texts have no shingles and link with nothing; texts with
fewer words than a shingle have one, the whole sequence. Rows without doc_id are
linked with nothing, have no component and are kept. Repeated rows are copies; with
the same doc_id all are reported alike. Extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.llm.common import releasing, shared_path, ship, text_or_empty, written
from bookpipe.llm.components import components

BANDS = 30
ROWS = 5
BITS = BANDS * ROWS
#: Differing bits at similarity 0.8: a tenth on average, plus five deviations.
MOST_BITS = int(BITS * 0.1 + 5 * (BITS * 0.1 * 0.9) ** 0.5)
#: Texts hashed at once: several arrays of eight bytes for each of theirs, in each worker.
BLOCK_BYTES = 1 << 18
#: Open buckets of up to so many nodes are compared by a join, larger ones by pairs of blocks.
SMALL = 48
BLOCK_NODES = 256

U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUES = mix64(np.arange(1, 257, dtype="uint64") * U(0x9E3779B97F4A7C15))
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
STEP = U(0x100000001B3)


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the white-space-separated words of a byte string."""
    raw = np.frombuffer(data, dtype="uint8")
    blank = BLANK[raw]
    first = ~blank
    first[1:] &= blank[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, dtype="uint64")
    place = np.arange(len(raw)) - starts[np.maximum(np.cumsum(first) - 1, 0)]
    place[blank] = 0
    place = np.maximum(place, 0)
    powers = np.full(int(place.max()) + 1, STEP, dtype="uint64")
    powers[0] = 1
    powers = np.cumprod(powers, dtype="uint64")
    values = np.where(blank, U(0), BYTE_VALUES[raw] * powers[place])
    return mix64(np.add.reduceat(values, starts))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a sequence of word hashes."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, U(size), dtype="uint64")
    for i in range(size):
        total = mix64(total * U(0x9E3779B97F4A7C15) + words[i : len(words) - size + 1 + i])
    return np.unique(total)


def blocks(texts: list[str]) -> Iterator[list[bytes]]:
    """Lower-cased texts in runs of about BLOCK_BYTES."""
    block, size = [], 0
    for text in texts:
        data = text.encode().lower()
        block.append(data)
        size += len(data)
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def sets_of(block: list[bytes], size: int) -> tuple[list[bytes | None], list[np.ndarray]]:
    """Node (a digest of the words) and shingle set of each text."""
    words = [data.split() for data in block]
    nodes = [hashlib.md5(b" ".join(w), usedforsecurity=False).digest() if w else None for w in words]
    if len(block) == 1:  # perhaps a very long text: hash it by runs of words
        runs = [word_hashes(b" ".join(words[0][i : i + 100_000])) for i in range(0, len(words[0]), 100_000)]
        return nodes, [shingle_set(np.concatenate(runs) if runs else np.zeros(0, dtype="uint64"), size)]
    hashes, at, sets = word_hashes(b" ".join(block)), 0, []
    for own in words:
        sets.append(shingle_set(hashes[at : at + len(own)], size))
        at += len(own)
    return nodes, sets


def scatter32(x: np.ndarray) -> np.ndarray:
    """A permutation of the integers below 2^32, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return x


def order32(x: np.ndarray) -> np.ndarray:
    """Another permutation of the integers below 2^32, in place."""
    for shift, factor in ((15, 0x2C1B3C6D), (12, 0x297A2D39)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(15)
    return x


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, BITS) minima; sets must not be empty."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    scattered = scatter32((np.concatenate(sets) >> U(32)).astype("uint32"))
    out = np.empty((BITS, len(sets)), dtype="uint32")
    for k in range(BITS):
        out[k] = np.minimum.reduceat(order32(scattered + np.uint32(k)), starts)
    return out.T


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """(sets, BANDS) hashes of whole bands."""
    bands = signature.reshape(len(signature), BANDS, ROWS).astype("uint64")
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype="uint64"), bands.shape[:2])
    for r in range(ROWS):
        total = mix64(total * U(0x9E3779B97F4A7C15) + bands[:, :, r])
    return total.view("int64")


def _sign(size: int):
    @releasing
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = 0
            for block in blocks(batch["text"].tolist()):
                nodes, sets = sets_of(block, size)
                counts = np.array([len(s) for s in sets], dtype="int64")
                full = np.flatnonzero(counts)
                bands, bits = [np.zeros(0, dtype="int64")] * len(block), [None] * len(block)
                if len(full):
                    signature = signatures([sets[i] for i in full])
                    packed = np.packbits((signature & 1).astype("uint8"), axis=1)
                    packed = np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view("int64")
                    for i, b, p in zip(full, band_hashes(signature), packed, strict=True):
                        bands[i], bits[i] = b, p
                part = batch.iloc[at : at + len(block)]
                at += len(block)
                yield pd.DataFrame(
                    {"doc_id": part["doc_id"].values, "text_key": part["text_key"].values, "node": nodes, "n_shingles": counts, "bands": bands, "bits": bits}
                )

    return sign


def _sets(size: int):
    @releasing
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in blocks(batch["text"].tolist()):
                nodes, sets = sets_of(block, size)
                yield pd.DataFrame({"node": nodes, "shingles": [s.view("int64") for s in sets]})

    return make


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and a hash of the text that tells rows of one doc_id apart."""
    return docs.select("doc_id", text_or_empty().alias("text")).withColumn("text_key", F.xxhash64("text"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes with 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_sb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("_sa", "_sb"))
    union = F.size("_sa") + F.size("_sb") - common
    return joined.where(common * 100 >= union * percent).select("a", "b")


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def candidate_sets(docs: DataFrame, signed: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of every node in ``nodes``, from one document of each."""
    wanted = nodes.distinct()
    first = signed.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("_first"))
    reps = first.join(wanted, "node").select("_first.*")
    texts = keyed(docs).join(reps, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
    path = shared_path(docs.sparkSession, "shingle-sets")
    texts.mapInPandas(_sets(size), "node binary, shingles array<bigint>").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept of each row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links of at least ``percent`` reach.
    """
    spark = docs.sparkSession
    ship(spark)
    path = shared_path(spark, "signatures")
    keyed(docs).mapInPandas(
        _sign(size), "doc_id bigint, text_key bigint, node binary, n_shingles bigint, bands array<bigint>, bits array<bigint>"
    ).write.parquet(path)
    everything = spark.read.parquet(path)
    signed = everything.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    buckets = signed.select(F.explode("bands").alias("band"), "node", "n_shingles").distinct()
    pivots = (
        buckets.groupBy("band")
        .agg(F.count("*").alias("_n"), F.min(F.struct(F.xxhash64("band", "node").alias("h"), "node", "n_shingles")).alias("_p"))
        .where("_n > 1")
        .select("band", F.col("_p.node").alias("_pivot"), F.col("_p.n_shingles").alias("_size"))
    )
    shared_path_ = shared_path(spark, "buckets")
    buckets.join(pivots, "band").write.parquet(shared_path_)
    shared = spark.read.parquet(shared_path_)

    stars = shared.where((F.col("node") != F.col("_pivot")) & _near_size("n_shingles", "_size", percent))
    stars = stars.select(F.least("node", "_pivot").alias("a"), F.greatest("node", "_pivot").alias("b")).distinct()
    stars = written(spark, "pairs", stars)
    links = written(spark, "links", confirmed(stars, candidate_sets(docs, signed, nodes_of(stars), size), percent))
    roots = components(links)
    # Across the components that a bucket still holds.
    rest = shared.select("band", "node", "n_shingles").join(roots, "node", "left")
    rest = rest.select("band", "node", "n_shingles", F.coalesce("root", "node").alias("root"))
    held = rest.groupBy("band").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.count("*").alias("_n"))
    rest = written(spark, "open", rest.join(held.where("_low <> _high").select("band", "_n"), "band"))
    more = _pairs_across(rest.where(F.col("_n") <= SMALL), signed, percent).join(stars, ["a", "b"], "left_anti")
    more = written(spark, "pairs", more)
    large = rest.where(F.col("_n") > SMALL)
    sets = candidate_sets(docs, signed, nodes_of(more).unionByName(large.select("node")), size)
    found = confirmed(more, sets, percent).unionByName(_links_in_blocks(large, sets, percent))
    roots = components(links.unionByName(written(spark, "links", found)))
    heads = signed.groupBy("node").agg(F.min("doc_id").alias("_own")).join(roots, "node", "left")
    least = heads.groupBy("root").agg(F.min("_own").alias("_least")).where("root is not null")
    names = heads.join(least, "root", "left").select("node", F.coalesce("_least", "_own").alias("_name"))
    out = everything.select("doc_id", "text_key", "node", "n_shingles").join(names, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("_name", "doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "text_key", "n_shingles", "component_id", kept.alias("kept"))


def _near_size(x: str, y: str, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _pairs_across(rest: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a bucket's nodes in different components, near enough in size and bits."""
    rest = rest.join(signed.select("node", "bits").dropDuplicates(["node"]), "node")
    x = rest.select("band", F.col("node").alias("a"), F.col("root").alias("_ra"), F.col("n_shingles").alias("_na"), F.col("bits").alias("_ba"))
    y = rest.select("band", F.col("node").alias("b"), F.col("root").alias("_rb"), F.col("n_shingles").alias("_nb"), F.col("bits").alias("_bb"))
    differing = sum((F.bit_count(F.col("_ba")[i].bitwiseXOR(F.col("_bb")[i])) for i in range((BITS + 63) // 64)), F.lit(0))
    across = (F.col("a") < F.col("b")) & (F.col("_ra") != F.col("_rb")) & _near_size("_na", "_nb", percent) & (differing <= MOST_BITS)
    return x.join(y, "band").where(across).select("a", "b").distinct()


def block_links(roots: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between different roots, one for each pair of roots.

    The nodes outside the most frequent root are compared with all, by products of
    membership matrices over runs of shingles that more than one node holds.
    """
    names, root, counts = np.unique(roots, return_inverse=True, return_counts=True)
    rows = np.flatnonzero(root != counts.argmax())
    if not len(rows):
        return []
    lengths = np.array([len(s) for s in sets])
    shingles, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), lengths)
    common = np.bincount(place)[place] > 1
    _, place = np.unique(place[common], return_inverse=True)
    owner, both = owner[common], np.zeros((len(rows), len(sets)), dtype="float32")
    for low in range(0, int(place.max(initial=-1)) + 1, 8_192):
        here = (place >= low) & (place < low + 8_192)
        member = np.zeros((len(sets), 8_192), dtype="float32")
        member[owner[here], place[here] - low] = 1
        both += member[rows] @ member.T
    union = lengths[rows][:, None] + lengths[None, :] - both
    linked = (both * 100 >= union * percent) & (root[rows][:, None] != root[None, :])
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for i, j in zip(*np.nonzero(linked), strict=True):
        pair = sorted((root[rows[i]], root[j]))
        found.setdefault((pair[0], pair[1]), (int(rows[i]), int(j)))
    return list(found.values())


def _links_in_blocks(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components in large buckets, without emitting their pairs.

    A bucket is cut into blocks of about BLOCK_NODES nodes, and each pair of blocks is a
    group of its own, so no group grows with the bucket.
    """
    cut = F.ceil(F.col("_n") / BLOCK_NODES).cast("int")
    blocked = rest.withColumn("_cut", cut).withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_cut")).cast("int"))
    pairs = blocked.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_cut") - 1)))
    placed = pairs.select("band", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "node", "root").join(sets, "node")

    @releasing
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        nodes = group["node"].tolist()
        roots = np.array([r.hex() for r in map(bytes, group["root"])])
        links = block_links(roots, group["shingles"].tolist(), percent)
        return pd.DataFrame({"a": [nodes[i] for i, _ in links], "b": [nodes[j] for _, j in links]}, columns=["a", "b"])

    return placed.groupBy("band", "_i", "_j").applyInPandas(lambda group: compare(group), "a binary, b binary")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, unchanged; one of repeated rows."""
    kept = near_duplicates(docs, size, percent).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text_key")).distinct()
    key = F.xxhash64(text_or_empty())
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_text_key"))
    stay = docs.join(kept, same, "left_semi").withColumn("_key", key)
    without_id = stay.where(F.col("doc_id").isNull())
    return stay.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "_key"]).unionByName(without_id).drop("_key")

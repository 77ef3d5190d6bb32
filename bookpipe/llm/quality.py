"""Text quality from an interpolated modified Kneser-Ney model of trusted text.

The model is over whole-character 6-grams, backed by 5-grams and 4-grams. Counts of all
trusted text grow with it and are never in one place: they are a table sharded by the
hash of the three characters before the last, so that a gram, its shorter grams and their
contexts meet in one shard. What no 4-gram has seen has the probability of its character's
class after three classes (40 classes, at most 40^4 entries), times the character's share
in its class.

Documents are taken in chunks. A chunk's distinct grams, each with the documents that hold
it, go to their shards, meet the counts there and come back as one sum per document; text
does not move. The ``HOT`` most frequent grams, which would weigh on single shards, are
scored in the chunk. Trusted documents are scored without the counts of their own fold,
so that having been counted is no advantage. The perplexity of a document is the
exponential of its mean negative log probability per character.

A document is kept if its perplexity is at most the bound of its language and length:
by how much the logarithm may exceed the median of trusted documents in that language
grows for short texts with sqrt(1 + ``SHORT`` / characters), and is the ``QUANTILE`` of
what trusted documents exceed it by, so measured. Languages without trusted documents
take median and quantile over all trusted documents.

Cases: null or empty texts have perplexity 1 and are kept; so is everything if no
text is trusted. A doc_id labelled more than once is trusted if all its labels say
so. Null languages form one group. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookpipe.llm.common import digest128, release, releasing, shared_path, ship, text_or_empty

CLASSES = 40
ORDER = 4
SIZE = CLASSES**ORDER
QUANTILE = 0.995
#: A text of so many characters may vary by the root of two times as much as an endless one.
SHORT = 200
PIECE = 1 << 20
#: Longest grams of whole characters; orders 5 and 4 back them.
LONGEST = 6
#: Trusted texts are scored by the counts of the other folds, all other texts by all counts.
FOLDS = 4
VARIANTS = FOLDS + 1
#: So many most frequent grams are scored without a shuffle; no other has a larger share of all grams than 1 / HOT.
HOT = 262_144
#: Grams are told apart by how often they occur in steps of the fourth root of two.
LEVELS = 256
#: Characters and documents scored at a time.
CHUNK, CHUNK_ROWS = 1_500_000, 4_096
SHARD_CHARS, LEAST_SHARDS, MOST_SHARDS = 3_000_000, 8, 1 << 20
#: Sums that a task holds before it passes them on.
HELD_SUMS = 4_000_000
#: Trusted ids that may be broadcast.
MOST_SENT = 2_000_000
MASK, POINTS = (1 << 21) - 1, 0x110000
POSTED = ["shard", "chunk", "grams", "held", "docs", "times", "folds", "keys", "trusted", "sums", "sizes"]


@lru_cache(maxsize=1)
def class_of() -> np.ndarray:
    """Class of each code point below 2^16; what is above counts as a symbol.

    0 text boundary, 1 blank, 2 line break, 3 digit, 4-29 a-z, 30-34 other letters,
    35 sentence marks, 36 A-Z, 37 quotes, hyphen and brackets, 38 other, 39 bar.
    """
    table = np.full(1 << 16, 38, dtype="int64")
    for point in range(1 << 16):
        char = chr(point)
        if char in "\n\r":
            table[point] = 2
        elif char.isspace():
            table[point] = 1
        elif char.isdigit():
            table[point] = 3
        elif "a" <= char <= "z":
            table[point] = 4 + point - ord("a")
        elif "A" <= char <= "Z":
            table[point] = 36
        elif char.isalpha():
            table[point] = 30 + point % 5
        elif char in ".,;:?!":
            table[point] = 35
        elif char in "'\"()-[]":
            table[point] = 37
        elif char == "|":
            table[point] = 39
    return table


def grams(text: str) -> Iterator[np.ndarray]:
    """4-grams of a text with its boundaries, as numbers, piece by piece."""
    before = np.zeros(ORDER - 1, dtype="int64")
    for at in range(0, len(text) + 1, PIECE):
        points = np.frombuffer(text[at : at + PIECE].encode("utf-32-le"), dtype="<u4")
        classes = class_of()[np.minimum(points, (1 << 16) - 1)]
        ends = [np.zeros(1, dtype="int64")] if at + PIECE > len(text) else []
        seen = np.concatenate([before, classes, *ends])
        before = seen[-(ORDER - 1) :]
        if len(seen) >= ORDER:
            yield ((seen[:-3] * CLASSES + seen[1:-2]) * CLASSES + seen[2:-1]) * CLASSES + seen[3:]


@releasing
def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts, waiting, size = np.zeros(SIZE, dtype="int64"), [], 0
    for batch in batches:
        for text in batch["text"]:
            for found in grams(text):
                waiting.append(found)
                size += len(found)
                if size >= PIECE:
                    counts += np.bincount(np.concatenate(waiting), minlength=SIZE)
                    waiting, size = [], 0
    if waiting:
        counts += np.bincount(np.concatenate(waiting), minlength=SIZE)
    seen = np.flatnonzero(counts)
    yield pd.DataFrame({"gram": seen, "n": counts[seen]})


def count_grams(texts: DataFrame) -> DataFrame:
    """(gram, n) over all texts: at most SIZE rows."""
    ship(texts.sparkSession)
    return texts.select(text_or_empty().alias("text")).mapInPandas(_count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: np.ndarray) -> np.ndarray:
    """Log probability of every 4-gram's last class given the three before it."""
    levels = [counts]
    for _ in range(ORDER - 1):  # how many different classes stand before a shorter gram
        levels.append((levels[-1].reshape(CLASSES, -1) > 0).sum(axis=0))
    lower = np.full(1, 1.0 / CLASSES)
    for level in reversed(levels):
        n1, n2, n3, n4 = (float((level == k).sum()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        steps = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        steps = [min(max(d, 0.05), k - 0.05) for k, d in enumerate(steps, 1)]
        parts = level.reshape(-1, max(lower.size, CLASSES))  # one for each first class: the driver holds a single part's numbers
        out = np.empty(parts.shape, dtype="float32" if level is counts else "float64")
        for part, to in zip(parts, out, strict=True):
            table = part.reshape(-1, CLASSES).astype("float64")
            discount = np.select([table == 0, table == 1, table == 2], [0.0, steps[0], steps[1]], steps[2])
            total = table.sum(axis=1, keepdims=True)
            seen = np.maximum(total, 1.0)
            gamma = np.where(total > 0, discount.sum(axis=1, keepdims=True) / seen, 1.0)
            below = lower.reshape(-1, min(lower.size, CLASSES))
            now = ((table - discount) / seen + gamma * below).ravel()
            to[:] = np.log(now) if level is counts else now
        lower = out.ravel()
    return lower


def fit(trusted: DataFrame) -> np.ndarray | None:
    """The table of log probabilities, or None without trusted text."""
    rows = count_grams(trusted).toArrow()  # at most SIZE rows
    if not rows.num_rows:
        return None
    counts = np.zeros(SIZE, dtype="int64")
    counts[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    del rows
    release()
    return kneser_ney(counts)


def mixed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of numbers."""
    h = high.astype("uint64") * np.uint64(0x9E3779B97F4A7C15) + low.astype("uint64")
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole-character 6-grams of texts with their boundaries: (first three, last three, text)."""
    pad, sizes = np.zeros(LONGEST - 1, dtype="int64"), np.array([len(text) + 1 for text in texts], dtype="int64")
    ends = np.cumsum(sizes)
    high, low = np.empty((2, int(sizes.sum())), dtype="int64")
    for text, size, end in zip(texts, sizes, ends, strict=True):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype("int64")
        seen = np.concatenate([pad, points, pad[:1]])
        three = (seen[:-2] << 42) | (seen[1:-1] << 21) | seen[2:]
        high[end - size : end] = three[:-3]
        low[end - size : end] = three[3:]
    return high, low, np.repeat(np.arange(len(texts), dtype="int32"), sizes)


def by_gram(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of grams, equal ones together and ascending, and which of them begin another gram."""
    bits = np.uint64(len(high).bit_length())
    key = mixed(high, low) << bits
    key |= np.arange(len(high), dtype="uint64")
    key.sort()  # much faster than to sort places by keys
    place = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype("int64")
    key >>= bits
    new = np.r_[True, key[1:] != key[:-1]][: len(key)]
    del key
    other = np.zeros(len(new), dtype=bool)
    for half in (high, low):
        sorted_half = half[place]
        other[1:] |= sorted_half[1:] != sorted_half[:-1]
    if (other[1:] & ~new[1:]).any():  # different grams of one hash
        place = np.lexsort((low, high))
        new = np.r_[True, (high[place][1:] != high[place][:-1]) | (low[place][1:] != low[place][:-1])]
    return place, new


def keys(high: np.ndarray, low: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of (gram, its context) of orders 6, 5 and 4."""
    out = []
    for mask in (-1, (1 << 42) - 1, (1 << 21) - 1):
        out.append((mixed(high & mask, low), mixed(high & mask, ~(low >> 21))))
    return out


def shard_of(high: np.ndarray, low: np.ndarray, shards: int) -> np.ndarray:
    """All grams of orders 4 to 6 that share the last three characters of their context share a shard."""
    return (mixed(high & MASK, low >> 21) % np.uint64(shards)).astype("int64")


def _small(values: np.ndarray) -> bytes:
    """Unsigned numbers as bytes: their width, their count, and their bytes by place, compressed."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    planes = np.ascontiguousarray(values.astype(f"<u{width}").view("u1").reshape(-1, width).T)
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _large(raw: bytes) -> np.ndarray:
    width, n = raw[0], int.from_bytes(raw[1:9], "little")
    planes = np.frombuffer(pa.decompress(raw[9:], width * n, codec="zstd", asbytes=True), dtype="u1").reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype("int64")


def _characters(high: np.ndarray, low: np.ndarray) -> bytes:
    return _small(np.concatenate([(half >> by) & MASK for half in (high, low) for by in (42, 21, 0)]))


def _packed(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    c = _large(raw).reshape(LONGEST, -1)
    return (c[0] << 42) | (c[1] << 21) | c[2], (c[3] << 42) | (c[4] << 21) | c[5]


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of batches, in frames of at most CHUNK_ROWS texts and CHUNK characters (a longer text makes its own)."""
    for batch in batches:
        ends = batch["text"].str.len().to_numpy(dtype="int64").cumsum()
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
            stop = min(stop, start + CHUNK_ROWS)
            yield batch.iloc[start:stop]
            start = stop
            release()


@releasing
def _count_sharded(shards: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for chunk in _chunks(batches):
        high, low, owner = packed(chunk["text"].tolist())
        place, new = by_gram(high, low)
        folds = chunk["_fold"].to_numpy(dtype="int64")[owner[place]]
        counts = np.bincount((np.cumsum(new) - 1) * FOLDS + folds, minlength=int(new.sum()) * FOLDS).reshape(-1, FOLDS)
        first = place[new]
        high, low = high[first], low[first]
        del place, new, folds, owner, first
        yield _by_shard(shards, high, low, lambda p, counts=counts: {"n": _small(counts[p].ravel())})


def _by_shard(shards: int, high: np.ndarray, low: np.ndarray, rest) -> pd.DataFrame:
    shard = shard_of(high, low, shards)
    # Grams of one context lie together, which compresses them.
    order = np.lexsort(((low & MASK) << 42 | high >> 21, (high & MASK) << 42 | low >> 21, shard))
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    rows = []
    for places in np.split(order, cuts) if len(order) else []:
        rows.append({"shard": int(shard[places[0]]), "grams": _characters(high[places], low[places]), **rest(places)})
    return pd.DataFrame(rows)


def _table(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of ``values`` of each key."""
    order = np.argsort(key, kind="stable")
    key, values = key[order], values[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype="int64")
    return key[starts], np.add.reduceat(values, starts, axis=0) if len(starts) else values


class Shard:
    """Counts of one shard's grams of orders 6, 5 and 4, for each fold left out and for all text."""

    def __init__(self, high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> None:
        """``counts``: of each distinct 6-gram in each variant; lower orders count what stands before them."""
        self.levels = []
        for order, (gram, context) in enumerate(keys(high, low)):
            if order:
                last = self.levels[-1][1] > 0
                # Each longer gram that occurs counts once for the gram without its first character.
                _, first = np.unique(self.before, return_index=True)
                names, sums = _table(gram[first], last[np.searchsorted(self.levels[-1][0], self.before[first])].astype("int64"))
            else:
                names, sums = _table(gram, counts)
            _, first = np.unique(gram, return_index=True)
            of = context[first]  # in the order of ``names``, both sorted by gram
            held = np.concatenate([sums, sums == 1, sums == 2, sums > 2], axis=1).astype("int64")
            self.levels.append((names, sums, *_table(of, held)))
            self.before = gram

    def counts_of_counts(self) -> list[int]:
        return [int((sums[:, -1] == k).sum()) for _, sums, *_ in self.levels for k in (1, 2, 3, 4)]

    def logs(self, high: np.ndarray, low: np.ndarray, base: np.ndarray, steps: list[list[float]]) -> np.ndarray:
        """Log probability of each gram's last character in each variant."""
        p = np.repeat(base[:, None], VARIANTS, axis=1)
        for (names, sums, contexts, held), (gram, context), step in reversed(list(zip(self.levels, keys(high, low), steps, strict=True))):
            if not len(names):
                continue
            at = np.minimum(np.searchsorted(names, gram), len(names) - 1)
            n = np.where((names[at] == gram)[:, None], sums[at], 0)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            own = np.where((contexts[at] == context)[:, None], held[at], 0)
            total, ones, twos, more = np.split(own, 4, axis=1)
            discount = np.select([n == 0, n == 1, n == 2], [0.0, step[0], step[1]], step[2])
            seen = np.maximum(total, 1)
            gamma = np.where(total > 0, (step[0] * ones + step[1] * twos + step[2] * more) / seen, 1.0)
            p = (n - discount) / seen + gamma * p
        return np.log(p)


def discounts(n1: float, n2: float, n3: float, n4: float) -> list[float]:
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    steps = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(steps, 1)]


@releasing
def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """One row of a shard's distinct grams, with their counts by fold."""
    high, low = (np.concatenate(x) for x in zip(*map(_packed, rows["grams"]), strict=True))
    release()
    key = mixed(high, low)
    _, counts = _table(key, np.concatenate([_large(x) for x in rows["n"]]).reshape(-1, FOLDS))
    _, first = np.unique(key, return_index=True)
    high, low = high[first], low[first]
    made = Shard(high, low, variants(counts)).counts_of_counts() + np.bincount(_level(counts), minlength=LEVELS).tolist()
    return pd.DataFrame([{"shard": rows["shard"].iloc[0], "grams": _characters(high, low), "n": _small(counts.ravel()), "made": made}])


def _level(counts: np.ndarray) -> np.ndarray:
    """How often grams occur, in steps of the fourth root of two."""
    return np.minimum(4 * np.log2(np.maximum(counts.sum(axis=1), 1)), LEVELS - 1).astype("int64")


def variants(counts: np.ndarray) -> np.ndarray:
    """Counts without each fold, then of all text."""
    total = counts.sum(axis=1, keepdims=True)
    return np.concatenate([total - counts, total], axis=1)


def _shard(row: NamedTuple) -> Shard:
    return Shard(*_packed(row.grams), variants(_large(row.n).reshape(-1, FOLDS)))


class Base(NamedTuple):
    """Probability of a character after three others by their classes: what no longer gram has seen."""

    logs: np.ndarray
    #: Share of each code point in its class.
    share: np.ndarray

    def of(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        point = [high & MASK, low >> 42, (low >> 21) & MASK, low & MASK]
        a, b, c, d = (class_of()[np.minimum(x, (1 << 16) - 1)] for x in point)
        a, b, c, d = (np.where(x == 0, 0, k) for x, k in zip(point, (a, b, c, d), strict=True))
        return np.exp(self.logs[((a * CLASSES + b) * CLASSES + c) * CLASSES + d].astype("float64")) * self.share[point[3]]


def fit_base(trusted: DataFrame) -> Base:
    @releasing
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(POINTS, dtype="int64")
        for batch in batches:
            for chunk in _chunks(batch[["text"]].iloc[i : i + 200] for i in range(0, len(batch), 200)):
                points = np.frombuffer("".join(chunk["text"]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
                found = np.bincount(points)
                counts[: len(found)] += found
        seen = np.flatnonzero(counts)
        yield pd.DataFrame({"point": seen, "n": counts[seen]})

    rows = trusted.select(text_or_empty().alias("text")).mapInPandas(count, "point int, n bigint").groupBy("point").agg(F.sum("n").alias("n")).toArrow()
    share = _shares(rows["point"].to_numpy(), rows["n"].to_numpy())  # at most one row for each code point
    del rows
    logs = fit(trusted)
    release()
    return Base(np.full(SIZE, -np.log(CLASSES), dtype="float32") if logs is None else logs, share)


def _shares(points: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Share of each code point in its class."""
    counts = np.zeros(POINTS)
    counts[points] = n
    kind = class_of()[np.minimum(np.arange(POINTS), (1 << 16) - 1)]
    kind[0] = 0
    kinds = np.bincount(kind[counts > 0], minlength=CLASSES) + 1.0  # Witten and Bell: one more kind than seen
    return (counts + (kinds / np.maximum(np.bincount(kind, minlength=CLASSES), 1))[kind]) / (np.bincount(kind, counts, CLASSES) + kinds)[kind]


class Model(NamedTuple):
    """Counts by shard as a written table, and what every worker holds."""

    #: shard, grams, n.
    counts: DataFrame
    shards: int
    base: Base
    steps: list[list[float]]
    #: Hashes of the HOT most frequent grams, sorted, and their log probabilities in each variant.
    hot: np.ndarray
    hot_logs: np.ndarray


def fit_grams(trusted: DataFrame, shards: int) -> Model:
    """The model of trusted texts (text, _fold)."""
    spark = trusted.sparkSession
    ship(spark)
    base = fit_base(trusted)
    path = shared_path(spark, "grams")
    found = trusted.select("text", "_fold").mapInPandas(partial(_count_sharded, shards), "shard int, grams binary, n binary")
    found.groupBy("shard").applyInPandas(lambda rows: _merge(rows), "shard int, grams binary, n binary, made array<bigint>").write.parquet(path)
    counts = spark.read.parquet(path)
    sums = counts.select(F.posexplode("made").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()  # 12 + LEVELS rows
    made = np.zeros(12 + LEVELS, dtype="int64")
    for row in sums:
        made[row["at"]] = row["n"]
    steps = [discounts(*map(float, row)) for row in made[:12].reshape(3, 4)]
    # The lowest level that may hold one of the HOT most frequent grams.
    least = LEVELS - 1 - int(np.searchsorted(np.cumsum(made[:11:-1]), HOT))
    sent = spark.sparkContext.broadcast(base)

    @releasing
    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                parts = _large(row.n).reshape(-1, FOLDS)
                n, high_enough = parts.sum(axis=1), _level(parts) >= least
                top = np.argsort(-n, kind="stable")[:HOT]
                top = top[high_enough[top] & (n[top] > 1)]
                if not len(top):
                    continue
                high, low = (x[top] for x in _packed(row.grams))
                logs = _shard(row).logs(high, low, sent.value.of(high, low), steps)
                yield pd.DataFrame({"key": mixed(high, low).astype("int64"), "n": n[top], "logs": list(logs)})

    rows = counts.select("grams", "n").mapInPandas(frequent, "key bigint, n bigint, logs array<double>")
    rows = rows.orderBy(F.desc("n"), "key").limit(HOT).toArrow()  # at most HOT rows
    hot = rows["key"].to_numpy().astype("int64").astype("uint64")
    logs = rows["logs"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, VARIANTS)
    order = np.argsort(hot)
    hot, logs = hot[order], logs[order]
    del rows
    release()
    return Model(counts.select("shard", "grams", "n"), shards, base, steps, hot, logs)


@releasing
def _post(model: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What documents hold, by shard; the most frequent grams are scored at once."""
    shards, sent = model
    task, number = TaskContext.get().partitionId(), 0
    for chunk in _chunks(batches):
        hot, hot_logs = sent.value
        chunk = chunk.sort_values("_fold", kind="stable")  # runs of folds take next to no place
        high, low, owner = packed(chunk["text"].tolist())
        fold, sizes = chunk["_fold"].to_numpy(dtype="int64"), np.bincount(owner, minlength=len(chunk))
        place, new = by_gram(high, low)
        owner = owner[place]
        pairs = np.flatnonzero(new | np.r_[True, owner[1:] != owner[:-1]])
        times, doc = np.diff(np.r_[pairs, len(owner)]), owner[pairs]
        starts = np.flatnonzero(new[pairs])
        held = np.diff(np.r_[starts, len(pairs)])
        first = place[pairs[starts]]
        high, low = high[first], low[first]
        del place, new, owner, pairs, starts
        sums = np.zeros(len(chunk))
        is_hot = np.zeros(len(high), dtype=bool)
        if len(hot):
            names = mixed(high, low)
            at = np.minimum(np.searchsorted(hot, names), len(hot) - 1)
            is_hot = hot[at] == names
            mine = np.repeat(is_hot, held)
            sums += np.bincount(doc[mine], times[mine] * hot_logs[np.repeat(at[is_hot], held[is_hot]), fold[doc[mine]]], len(chunk))
        number += 1
        name = f"{task}-{number}"
        ids = b"".join(chunk["_key"])
        meta = {"shard": crc32(name.encode()) % shards, "chunk": name, "keys": ids, "trusted": chunk["_trusted"].to_numpy(dtype="u1").tobytes(), "sums": sums.tobytes(), "folds": fold.astype("u1").tobytes()}
        meta["sizes"] = sizes.astype("<i8").tobytes()
        yield pd.DataFrame([meta]).reindex(columns=POSTED)
        cold = np.flatnonzero(~is_hot)
        begin = np.r_[0, np.cumsum(held)]

        def rest(p, cold=cold, begin=begin, held=held, doc=doc, times=times, name=name, fold=fold):
            these = cold[p]
            n = held[these]
            at = np.repeat(begin[these] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            return {"chunk": name, "held": _small(n), "docs": _small(doc[at]), "times": _small(times[at]), "folds": fold.astype("u1").tobytes()}

        if len(cold):
            yield _by_shard(shards, high[cold], low[cold], rest).reindex(columns=POSTED)


@releasing
def _score_shard(model: tuple, posted: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Sums of log probabilities of one shard's grams, for each document of each chunk."""
    steps, sent = model
    release()
    none = np.zeros(0, dtype="int64")
    known = next((_shard(row) for row in counts.itertuples()), None) or Shard(none, none, np.zeros((0, VARIANTS), dtype="int64"))
    out = [(r.chunk, r.sums, r.keys, r.trusted, r.sizes) for r in posted.itertuples() if r.keys is not None]
    posted = posted[posted["keys"].isna()]
    if len(posted):
        high, low = (np.concatenate(x) for x in zip(*map(_packed, posted["grams"]), strict=True))
        _, first, place = np.unique(mixed(high, low), return_index=True, return_inverse=True)
        logs = known.logs(high[first], low[first], sent.value.of(high[first], low[first]), steps)
        begin = 0
        for row in posted.itertuples():
            folds, doc, held = np.frombuffer(row.folds, dtype="u1"), _large(row.docs), _large(row.held)
            each = logs[np.repeat(place[begin : begin + len(held)], held), folds[doc]] * _large(row.times)
            out.append((row.chunk, np.bincount(doc, each, len(folds)).tobytes(), None, None, None))
            begin += len(held)
    return pd.DataFrame(out, columns=["chunk", "sums", "keys", "trusted", "sizes"])


SCORED = ["chunk", "sums", "keys", "trusted", "sizes"]


@releasing
def _add_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the shards of a task added up by chunk before they are shuffled, HELD_SUMS numbers at a time."""
    held: dict[str, np.ndarray] = {}

    def flush() -> pd.DataFrame:
        rows = [(chunk, sums.tobytes(), None, None, None) for chunk, sums in held.items()]
        held.clear()
        return pd.DataFrame(rows, columns=SCORED)

    for batch in batches:
        whole = batch["keys"].notna()
        if whole.any():
            yield batch[whole]
        for chunk, raw in zip(batch["chunk"][~whole], batch["sums"][~whole], strict=True):
            sums = np.frombuffer(raw)
            if chunk in held:
                held[chunk] += sums
            else:
                held[chunk] = sums.copy()
        if sum(map(len, held.values())) > HELD_SUMS:
            yield flush()
    yield flush()


@releasing
def _score_chunk(rows: pd.DataFrame) -> pd.DataFrame:
    sums = np.sum([np.frombuffer(x) for x in sorted(rows["sums"])], axis=0)
    row = rows[rows["keys"].notna()].iloc[0]
    sizes = np.frombuffer(row["sizes"], dtype="<i8")
    keys = [row["keys"][i : i + 16] for i in range(0, len(row["keys"]), 16)]
    known = pd.DataFrame({"_key": keys, "_trusted": np.frombuffer(row["trusted"], dtype="u1").astype(bool), "perplexity": np.exp(-sums / sizes)})
    return known.assign(perplexity=known["perplexity"].where(sizes > 1, 1.0))


def perplexities(marked: DataFrame) -> DataFrame:
    """(_key, _trusted, perplexity) of texts (text, _key, _trusted, _fold), as a written table."""
    spark = marked.sparkSession
    ship(spark)
    size = marked.agg(F.sum(F.length("text"))).first()[0] or 0
    model = fit_grams(marked.where("_trusted"), int(min(max(LEAST_SHARDS, size // SHARD_CHARS), MOST_SHARDS)))
    hot = spark.sparkContext.broadcast((model.hot, model.hot_logs))
    base = spark.sparkContext.broadcast(model.base)
    fields = "shard int, chunk string, grams binary, held binary, docs binary, times binary, folds binary, keys binary, trusted binary, sums binary, sizes binary"
    posted = marked.select("text", "_key", "_trusted", "_fold").mapInPandas(partial(_post, (model.shards, hot)), fields)
    steps = model.steps
    pairs = posted.groupBy("shard").cogroup(model.counts.groupBy("shard"))
    partly = pairs.applyInPandas(lambda a, b: _score_shard((steps, base), a, b), "chunk string, sums binary, keys binary, trusted binary, sizes binary")
    partly = partly.mapInPandas(_add_sums, "chunk string, sums binary, keys binary, trusted binary, sizes binary")
    path = shared_path(spark, "perplexity")
    whole = partly.groupBy("chunk").applyInPandas(lambda rows: _score_chunk(rows), "_key binary, _trusted boolean, perplexity double")
    whole.groupBy("_key", "_trusted").agg(F.min("perplexity").alias("perplexity")).write.parquet(path)
    return spark.read.parquet(path)


def marks(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``docs`` with _key, _trusted, _spread and _fold; copies of a text share a fold.

    Up to MOST_SENT trusted ids are sent to the texts; more of them move the texts.
    """
    known = trusted.withColumn("_known", F.lit(True))
    if trusted.count() <= MOST_SENT:
        known = F.broadcast(known)
    out = docs.join(known, "doc_id", "left").withColumn("_trusted", F.coalesce("_known", F.lit(False))).drop("_known")
    fold = F.pmod(F.xxhash64(text_or_empty()), F.lit(FOLDS)).cast("int")
    out = out.withColumn("_key", digest128(text_or_empty())).withColumn("_spread", spread(text_or_empty()))
    return out.withColumn("_fold", F.when(F.col("_trusted"), fold).otherwise(F.lit(FOLDS)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_q")).where("_q = 1").select("doc_id")


def spread(text: Column) -> Column:
    """How much wider than for an endless text the logarithm of perplexity may vary."""
    return F.sqrt(1.0 + F.lit(SHORT) / (F.length(text) + 1.0))


def thresholds(scored: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(_lang, _middle, _excess): of each language with trusted documents, and of all (_lang null).

    A text's bound is exp(_middle + _excess * spread).
    """
    known = scored.where("_trusted").select(F.coalesce("lang", F.lit("")).alias("_lang"), F.log("perplexity").alias("_log"), "_spread")
    both = known.unionByName(known.withColumn("_lang", F.lit(None).cast("string")))
    middles = both.groupBy("_lang").agg(F.percentile_approx("_log", 0.5, 10_000).alias("_middle"))
    over = both.join(middles.withColumnRenamed("_lang", "_of"), F.col("_lang").eqNullSafe(F.col("_of"))).select("_lang", "_middle", ((F.col("_log") - F.col("_middle")) / F.col("_spread")).alias("_over"))
    return over.groupBy("_lang", "_middle").agg(F.percentile_approx("_over", quantile, 10_000).alias("_excess"))


class Judge(NamedTuple):
    """What a corpus and its labels teach: the model and the bound of each language."""

    #: _key, _trusted, perplexity of every text, as a written table.
    perplexities: DataFrame
    #: doc_id, lang, perplexity, _spread of every document.
    scored: DataFrame
    bounds: DataFrame
    #: (_middle, _excess) for languages without trusted documents; nulls if there are none at all.
    overall: tuple[float | None, float | None]

    def verdict(self, scored: DataFrame) -> DataFrame:
        """``scored`` (lang, perplexity, _spread, ...) with threshold and kept."""
        out = scored.withColumn("_lang", F.coalesce("lang", F.lit(""))).join(self.bounds, "_lang", "left")
        middle, excess = (F.coalesce(c, F.lit(x).cast("double")) for c, x in zip(("_middle", "_excess"), self.overall, strict=True))
        out = out.withColumn("threshold", F.exp(middle + excess * F.col("_spread")))
        fits = F.col("perplexity") <= F.col("threshold") * (1 + 1e-9)
        return out.withColumn("kept", F.coalesce(fits | (F.col("perplexity") == 1), F.lit(True))).drop("_lang", "_middle", "_excess", "_spread")


def learn(docs: DataFrame, labels: DataFrame) -> Judge:
    marked = marks(docs.select("doc_id", "lang", text_or_empty().alias("text")), trusted_ids(labels))
    known = perplexities(marked)
    scored = marked.drop("text", "_fold").join(known, ["_key", "_trusted"])
    found = thresholds(scored).collect()  # a row for each language
    overall = next(((r["_middle"], r["_excess"]) for r in found if r["_lang"] is None), (None, None))
    bounds = docs.sparkSession.createDataFrame([tuple(r) for r in found if r["_lang"] is not None], "_lang string, _middle double, _excess double")
    return Judge(known, scored, bounds, overall)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept of each row."""
    known = learn(docs, labels)
    return known.verdict(known.scored).select("doc_id", "lang", "perplexity", "threshold", "kept")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` of good quality, unchanged."""
    known = learn(docs, labels)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "lang", text_or_empty().alias("text"))
    scored = marks(rows, trusted_ids(labels)).drop("text").join(known.perplexities, ["_key", "_trusted"])
    return known.verdict(scored).where("kept").select("_row.*")

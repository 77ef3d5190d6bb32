"""Log-probabilities of texts from a word bigram model, as a weighted backoff automaton.

Tokens are runs of what is not ASCII white space, with A-Z lowered, and an end. A training
text counts its pairs of neighbours, from a start to its end. The model interpolates, with
the three discounts of modified Kneser-Ney smoothing (D of a count of 1, 2, more):

    p(b | a) = (n(a, b) - D) / n(a) + gamma(a) p(b),     p(b) = (c(b) - D') / N + gamma' / (V + 1)

so that an unknown token has gamma' / (V + 1) and the probabilities of all tokens and one
unknown add up to 1. As an automaton: every token that training text holds is a state, with
an arc for each token seen after it, of weight log10 p(b | a), and a failure arc of weight
log10 gamma(a) to the root, which has an arc for each token. A text is read once from left
to right; the state is the token before, and a token without an arc takes the failure arc.

The model grows with the corpus and is never in one place. Documents are coded in chunks,
one row of a table each: numbers of words by frequency in the chunk, and the words' 64-bit
hashes. A chunk sends its distinct pairs, with how often training text holds them, to shards
by the hash of the first token: 40 bits stand for the second token among those after the
first. A shard adds up the counts of all chunks and answers each with the counts of its
pairs and of the tokens before them. So a chunk gets all states and arcs that its texts can
meet, builds that part of the automaton and reads its texts. Pairs travel once, in packed
arrays, counts come back, and no text is shuffled.

The number of shards follows the corpus. A token with more than half a shard's share of all
words is split by its second tokens over several shards, in proportion; there are at most 4
such tokens a shard (from heavy hitters of each batch, which no token of that share can
escape), and MOST_SHARDS bounds what a task needs to know of them; beyond MOST_SHARDS *
SHARD_CHARS characters shards grow. Two hashes of 64 bits may meet: among 10^9 different
tokens with probability 0.03.

Cases: a null or empty text is its end alone. A null doc_id counts as the text '' for
whether it is held out. Texts longer than PIECE characters are cut at white space; a piece
starts in the state of the word before it, and their sums are added up. Repeated rows are
counted and scored as often as they occur. Without training text N and V are 0 and both
scores are 0. Extra columns are ignored, whatever their names. No rows give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookpipe.llm.common import shared_path, ship, text_or_empty
from bookpipe.llm.packing import pack, pack_ids, unpack, unpack_ids

FOLDS, HELD_OUT = 7, 2
#: Bytes of a chunk; characters of a piece, which is cut from a longer text.
CHUNK, PIECE = 4_000_000, 1_000_000
SHARD_CHARS, LEAST_SHARDS, MOST_SHARDS = 12_000_000, 48, 1 << 18
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Names of start and end, which no word can have.
START, END = b" start", b" end"
LOW40 = np.uint64((1 << 40) - 1)
BLANKS = b" \t\n\v\f\r"


def hash_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype="uint64", count=len(words))


START_HASH, END_HASH = hash_of([START, END])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


# ---- texts to pieces ----

PIECES = "doc_id bigint, weight bigint, copies bigint, key bigint, before binary, last boolean, text binary"
CUT = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "weight", "copies", "key")]
    + [("before", pa.binary()), ("last", pa.bool_()), ("text", pa.binary())]
)


def _cut(piece: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, weight, copies, key, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                at, before, last = 0, None, False
                while not last:
                    end = at + piece
                    while end < len(text) and text[end] not in BLANKS:
                        end += 1
                    part, last = text[at:end], end >= len(text)
                    row = (doc_id, weight, copies, key, before, last, part)
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, CUT, strict=True)], schema=CUT)
                    words = part.translate(LOWER).split()
                    before, at = (words[-1] if words else before), end

    return cut


def pieces(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """(doc_id, weight, copies, key, before, last, text): texts as they are, or long ones in pieces.

    ``weight`` is how often a row trains. ``key`` tells the rows of one long text; equal
    long rows become one, with their number in ``copies``.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    trains = (~held_out(F.col("doc_id"))).cast("bigint")
    one, none = F.lit(1).cast("bigint"), F.lit(None)
    long = F.char_length("text") > piece
    short = rows.where(~long).select(
        "doc_id", trains.alias("weight"), one.alias("copies"), none.cast("bigint").alias("key"),
        none.cast("binary").alias("before"), F.lit(True).alias("last"), F.col("text").cast("binary").alias("text"),
    )
    equal = rows.where(long).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    whole = equal.select("doc_id", (trains * F.col("copies")).alias("weight"), "copies", F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text"))
    return short.unionByName(whole.mapInArrow(_cut(piece), PIECES))


# ---- tokens that are split over shards ----


def _heavy(shards: int):
    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counter: Counter[bytes] = Counter()
            for before, last, text in zip(*(batch.column(i).to_pylist() for i in (4, 5, 6)), strict=True):
                counter.update(text.translate(LOWER).split())
                counter[START] += before is None
                counter[END] += last
            total = counter.total()
            found = [(word, n) for word, n in counter.items() if 4 * shards * n >= total]
            hashes = hash_of([word for word, _ in found]).astype("int64").tolist()
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array([*hashes, None], pa.int64()), "n": pa.array([*(n for _, n in found), total], pa.int64())}
            )

    return heavy


class Layout(NamedTuple):
    """The shards, and the hashes (ascending) and parts of the tokens that are split."""

    shards: int
    hot: np.ndarray
    parts: np.ndarray

    def shard_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The shard of pairs of token hashes."""
        at = np.minimum(np.searchsorted(self.hot, first), max(len(self.hot) - 1, 0))
        part = np.zeros(len(first), dtype="uint64")
        if len(self.hot):
            split = np.where(self.hot[at] == first, self.parts[at], 1).astype("uint64")
            part = (second >> np.uint64(20)) % split
        return (mixed(first + part * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.shards)).astype("int64")

    def is_hot(self, first: np.ndarray) -> np.ndarray:
        return np.isin(first, self.hot)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit numbers, well mixed."""
    h = h.astype("uint64")
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def layout(texts: DataFrame, shard_chars: int = SHARD_CHARS, least: int = LEAST_SHARDS) -> Layout:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(max(least, -(-size // shard_chars)), MOST_SHARDS)
    path = shared_path(texts.sparkSession, "heavy")
    counted = texts.mapInArrow(_heavy(shards), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted.write.parquet(path)
    counted = texts.sparkSession.read.parquet(path)
    total = counted.where("word is null").first()
    if total is None:
        return Layout(shards, np.zeros(0, dtype="uint64"), np.zeros(0, dtype="int64"))
    rows = counted.where((F.col("word").isNotNull()) & (F.col("n") * (4 * shards) >= total["n"])).toPandas()  # at most 4 a shard
    hot = rows["word"].to_numpy(dtype="int64").astype("uint64")
    parts = np.ceil(rows["n"].to_numpy(dtype="float64") * 2 * shards / total["n"]).astype("int64")
    # The start is always listed, since its count is that of the end.
    known = hot != START_HASH
    start = parts[~known].max(initial=1)
    hot, parts = np.append(hot[known], START_HASH), np.append(parts[known], start)
    order = np.argsort(hot)
    return Layout(shards, hot[order], parts[order])


# ---- chunks ----

CHUNKS = pa.schema(
    [("chunk", pa.int64())]
    + [(name, pa.binary()) for name in ("doc_id", "key", "copies", "weights", "sizes", "tokens", "words")]
)
CHUNKS_DDL = "chunk bigint, " + ", ".join(f"{field.name} binary" for field in CHUNKS if field.name != "chunk")


def _code(rows: list[tuple], number: int) -> pa.RecordBatch:
    """One chunk: pieces as numbers of words, each piece with the token before it."""
    listed: list[bytes] = []
    sizes = []
    for _, _, _, _, before, last, text in rows:
        had = len(listed)
        listed.append(START if before is None else before)
        listed += text.translate(LOWER).split()
        if last:
            listed.append(END)
        sizes.append(len(listed) - had)
    coded = pa.array(listed, pa.binary()).dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False).astype("int64")
    order = np.argsort(-np.bincount(at), kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    hashes = hash_of(coded.dictionary.to_pylist())[order]
    doc_ids, weights, copies, keys = (list(x) for x in list(zip(*rows, strict=True))[:4])
    row = {
        "chunk": number,
        "doc_id": pack_ids(doc_ids),
        "key": pack_ids(keys),
        "copies": pack(np.array(copies)),
        "weights": pack(np.array(weights)),
        "sizes": pack(np.array(sizes)),
        "tokens": pack(place[at]),
        "words": hashes.astype("<u8").tobytes(),
    }
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in CHUNKS], schema=CHUNKS)


def _code_chunks(chunk: int):
    def code_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if rows and size + len(row[-1]) > chunk:
                    yield _code(rows, number)
                    number, rows, size = number + 1, [], 0
                rows.append(row)
                size += len(row[-1])
        if rows:
            yield _code(rows, number)

    return code_chunks


class Pairs(NamedTuple):
    """The distinct pairs of a chunk in the order of shards, and its texts."""

    words: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    first: np.ndarray
    second: np.ndarray
    shard: np.ndarray
    trained: np.ndarray
    #: Tokens before others in the order of shards: their numbers and shards, and how many pairs each has there.
    contexts: np.ndarray
    context_shard: np.ndarray
    followers: np.ndarray


def pairs_of(row, plan: Layout) -> Pairs:
    words = np.frombuffer(row.words, dtype="<u8").astype("uint64")
    tokens, sizes, weights = unpack(row.tokens), unpack(row.sizes), unpack(row.weights)
    inner = np.ones(len(tokens), dtype=bool)
    inner[np.cumsum(sizes) - 1] = False  # the last token of a piece has none after it
    here = np.flatnonzero(inner)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    key, where = np.unique(tokens[here] * len(words) + tokens[here + 1], return_inverse=True)
    trained = np.bincount(where, weights=weights[owner[here]], minlength=len(key)).astype("int64")
    first, second = np.divmod(key, len(words))
    # A word that ends a piece still needs its own count: it is asked for without a pair.
    alone = np.setdiff1d(np.flatnonzero(words != END_HASH), first)
    shard = plan.shard_of(words[first], words[second])
    order = np.lexsort((words[second] & LOW40, words[first], shard))
    first, second, shard, trained = first[order], second[order], shard[order], trained[order]
    start = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (first[1:] != first[:-1])])) if len(first) else np.zeros(0, dtype="int64")
    contexts = np.concatenate([first[start], alone])
    context_shard = np.concatenate([shard[start], plan.shard_of(words[alone], np.zeros(len(alone), dtype="uint64"))])
    followers = np.concatenate([np.diff(np.append(start, len(first))), np.zeros(len(alone), dtype="int64")])
    order = np.argsort(context_shard, kind="stable")  # pairs stay in order, as those without come last
    return Pairs(words, tokens, sizes, first, second, shard, trained, contexts[order], context_shard[order], followers[order])


def _spans(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of ascending shards."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
    return zip(shard[cuts[:-1]].tolist() if len(shard) else [], cuts[:-1].tolist(), cuts[1:].tolist(), strict=False)


POSTS = pa.schema([("shard", pa.int32()), ("chunk", pa.int64())] + [(name, pa.binary()) for name in ("contexts", "followers", "seconds", "trained")])
POSTS_DDL = "shard int, chunk bigint, contexts binary, followers binary, seconds binary, trained binary"


def _post(plan: Layout):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pandas().itertuples():
                p = pairs_of(row, plan)
                seconds = (p.words[p.second] & LOW40).astype("<u8").view("u1").reshape(-1, 8)[:, :5]
                ends = np.concatenate([[0], np.cumsum(p.followers)])
                columns: list[list] = [[] for _ in POSTS]
                for shard, low, high in _spans(p.context_shard):
                    own = slice(ends[low], ends[high])
                    values = (
                        shard,
                        row.chunk,
                        p.words[p.contexts[low:high]].astype("<u8").tobytes(),
                        pack(p.followers[low:high]),
                        seconds[own].tobytes(),
                        pack(p.trained[own]),
                    )
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, POSTS, strict=True)], schema=POSTS)

    return post


# ---- shards ----

#: Row of a shard's own figures among the answers to chunks.
FIGURES = -1
ANSWERS_DDL = "chunk bigint, shard int, n binary, total binary, ones binary, twos binary, more binary"


def _classes(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _answer(plan: Layout):
    def answer(posts: pd.DataFrame) -> pd.DataFrame:
        """Counts of one shard, as answers to the chunks that ask."""
        names = [np.frombuffer(raw, dtype="<u8").astype("uint64") for raw in posts["contexts"]]
        followers = [unpack(raw) for raw in posts["followers"]]
        wide = [np.frombuffer(raw, dtype="u1").reshape(-1, 5) for raw in posts["seconds"]]
        seconds = np.zeros((sum(map(len, wide)), 8), dtype="u1")
        seconds[:, :5] = np.concatenate(wide)
        known, context = np.unique(np.concatenate(names), return_inverse=True)
        key = (np.repeat(context, np.concatenate(followers)) << 40) | seconds.view("<u8").ravel().astype("int64")
        key, pair = np.unique(key, return_inverse=True)
        n = np.bincount(pair, weights=np.concatenate([unpack(raw) for raw in posts["trained"]]), minlength=len(key)).astype("int64")
        of = key >> 40

        def per_context(weights: np.ndarray) -> np.ndarray:
            return np.bincount(of, weights=weights, minlength=len(known)).astype("int64")

        held = [per_context(w) for w in (n, n == 1, n == 2, n > 2)]
        rows, contexts_at, pairs_at = [], 0, 0
        for chunk, shard, own, size in zip(posts["chunk"], posts["shard"], names, followers, strict=True):
            mine = context[contexts_at : contexts_at + len(own)]
            asked = pair[pairs_at : pairs_at + int(size.sum())]
            contexts_at, pairs_at = contexts_at + len(own), pairs_at + len(asked)
            rows.append((chunk, shard, pack(n[asked]), *(pack(x[mine]) for x in held)))
        hot = plan.is_hot(known)
        whole = held[0][~hot]
        figures = np.array([*_classes(n), *_classes(whole), whole.sum(), (whole > 0).sum(), (whole > 2).sum(), (n > 2).sum()])
        split = [known[hot].view("int64"), *(x[hot] for x in held)]
        rows.append((FIGURES, int(posts["shard"].iloc[0]), pack(figures), *([np.stack(split).astype("<i8").tobytes()] + [b""] * 3)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWERS_DDL.split(", ")])

    return answer


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and more, from how many counts are 1 to 4."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    steps = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate(steps, 1))])


class Model(NamedTuple):
    """What every chunk knows of the whole model: its sizes, discounts and split tokens."""

    tokens: int
    vocabulary: int
    pair_steps: np.ndarray
    token_steps: np.ndarray
    spare: float
    split: dict[int, tuple[int, int, int, int]]

    def token_probability(self, c: np.ndarray) -> np.ndarray:
        rest = self.spare / (self.vocabulary + 1)
        return (c - self.token_steps[np.minimum(c, 3)]) / max(self.tokens, 1) + rest


def _add_figures(rows: pd.DataFrame) -> pd.DataFrame:
    figures = sum(unpack(raw) for raw in rows["n"])
    split = _add_split([np.frombuffer(raw, dtype="<i8").reshape(5, -1) for raw in rows["total"]])
    return pd.DataFrame([(pack(figures), split.astype("<i8").tobytes())], columns=["n", "total"])


def _add_split(parts: list[np.ndarray]) -> np.ndarray:
    """Counts of tokens that several shards hold parts of."""
    every = np.concatenate(parts, axis=1)
    names, of = np.unique(every[0], return_inverse=True)
    sums = [np.bincount(of, weights=row, minlength=len(names)).astype("int64") for row in every[1:]]
    return np.stack([names, *sums]).astype("int64")


def model_of(answers: DataFrame) -> Model:
    """Figures of all shards, added up; split tokens are at most 4 a shard."""
    parts = answers.where(F.col("chunk") == FIGURES).groupBy(F.pmod("shard", F.lit(64)).alias("_part")).applyInPandas(_add_figures, "n binary, total binary")
    rows = parts.toPandas()
    if not len(rows):
        return Model(0, 0, discounts(0, 0, 0, 0), discounts(0, 0, 0, 0), 1.0, {})
    figures = sum(unpack(bytes(raw)) for raw in rows["n"])
    split = _add_split([np.frombuffer(bytes(raw), dtype="<i8").reshape(5, -1) for raw in rows["total"]])
    totals = split[1]
    starts = int(totals[split[0].view("uint64") == START_HASH].sum())  # as many as ends
    once = np.array(figures[4:8]) + np.array(_classes(totals[split[0].view("uint64") != START_HASH])) + np.array(_classes(np.array([starts])))
    others = totals[split[0].view("uint64") != START_HASH]
    tokens = int(figures[8] + others.sum() + starts)
    vocabulary = int(figures[9] + (others > 0).sum() + (starts > 0))
    more = int(figures[10] + (others > 2).sum() + (starts > 2))
    steps = discounts(*once)
    spare = float(steps[1] * once[0] + steps[2] * once[1] + steps[3] * more) / tokens if tokens else 1.0
    known = dict(zip(split[0].view("uint64").tolist(), map(tuple, split[1:].T.tolist()), strict=True))
    return Model(tokens, vocabulary, discounts(*figures[:4]), steps, spare, known)


# ---- the automaton ----


class Automaton:
    """States are tokens, by number; ``width`` numbers a token's arcs apart from others'."""

    def __init__(self, arcs: dict[int, float], failures: list[float], root: list[float]) -> None:
        self.arcs, self.failures, self.root, self.width = arcs, failures, root, len(root)

    def read(self, tokens: list[int]) -> float:
        """The weight of the path from the state of the first token over all others."""
        arc, failures, root, width = self.arcs.get, self.failures, self.root, self.width
        total, state = 0.0, tokens[0]
        for token in tokens[1:]:
            weight = arc(state * width + token)
            total += failures[state] + root[token] if weight is None else weight
            state = token
        return total


def automaton(p: Pairs, model: Model, n: np.ndarray, held: list[np.ndarray]) -> tuple[Automaton, np.ndarray]:
    """The part of the model that a chunk can meet, and the counts of its tokens.

    ``n`` counts its pairs, ``held`` its contexts: all, and followers seen once, twice, more often.
    """
    width = len(p.words)
    own = np.zeros((4, width), dtype="int64")
    own[:, p.contexts] = np.stack(held)
    for i in np.flatnonzero(np.isin(p.words, np.array(list(model.split), dtype="uint64"))).tolist():
        own[:, i] = model.split[int(p.words[i])]
    counts = own[0].copy()
    start, end = (np.flatnonzero(p.words == h) for h in (START_HASH, END_HASH))
    counts[end] = model.split[int(START_HASH)][0] if int(START_HASH) in model.split else 0
    counts[start] = 0  # a start is no token
    below = model.token_probability(counts)
    total = np.maximum(own[0], 1)
    gamma = np.where(own[0] > 0, (own[1:] * model.pair_steps[1:, None]).sum(axis=0) / total, 1.0)
    seen = np.flatnonzero(n)
    a, b = p.first[seen], p.second[seen]
    weight = np.log10((n[seen] - model.pair_steps[np.minimum(n[seen], 3)]) / total[a] + gamma[a] * below[b])
    arcs = dict(zip((a * width + b).tolist(), weight.tolist(), strict=True))
    return Automaton(arcs, np.log10(gamma).tolist(), np.log10(below).tolist()), counts


def _read(plan: Layout, model: Model):
    def read(answers: pd.DataFrame, chunks: pd.DataFrame) -> pd.DataFrame:
        """Both scores of the pieces of a chunk."""
        out = []
        answers = answers.sort_values("shard")
        for row in chunks.itertuples():
            p = pairs_of(row, plan)
            n, *held = (np.concatenate([unpack(raw) for raw in answers[c]]) for c in ("n", "total", "ones", "twos", "more"))
            machine, counts = automaton(p, model, n, held)
            owner = np.repeat(np.arange(len(p.sizes)), p.sizes)
            ends = np.cumsum(p.sizes)
            scored = np.ones(len(p.tokens), dtype=bool)
            scored[ends - p.sizes] = False  # the state a piece starts in
            base = np.where(scored, np.log10((counts + 1) / (model.tokens + model.vocabulary + 1))[p.tokens], 0.0)
            numbers = p.tokens.tolist()
            spans = zip((ends - p.sizes).tolist(), ends.tolist(), strict=True)
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": unpack_ids(row.doc_id),
                        "key": unpack_ids(row.key),
                        "copies": unpack(row.copies),
                        "n_tokens": p.sizes - 1,
                        "n_known": np.bincount(owner, weights=scored & (counts > 0)[p.tokens], minlength=len(p.sizes)).astype("int64"),
                        "base_score": np.bincount(owner, weights=base, minlength=len(p.sizes)),
                        "score": [machine.read(numbers[low:high]) for low, high in spans],
                    }
                )
            )
        return pd.concat(out)

    return read


SCORED = "doc_id bigint, key bigint, copies bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def scores(
    docs: DataFrame, chunk: int = CHUNK, piece: int = PIECE, shard_chars: int = SHARD_CHARS, shards: int = LEAST_SHARDS
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row."""
    spark = docs.sparkSession
    ship(spark)
    texts = pieces(docs, piece)
    plan = layout(texts, shard_chars, shards)
    path = shared_path(spark, "coded")
    texts.mapInArrow(_code_chunks(chunk), CHUNKS_DDL).write.option("compression", "zstd").parquet(path)
    chunks = spark.read.parquet(path)
    path = shared_path(spark, "answers")
    posts = chunks.select("chunk", "weights", "sizes", "tokens", "words").mapInArrow(_post(plan), POSTS_DDL)
    posts.groupBy("shard").applyInPandas(_answer(plan), ANSWERS_DDL).write.option("compression", "zstd").parquet(path)
    answers = spark.read.parquet(path)
    model = model_of(answers)
    replies = answers.where(F.col("chunk") != FIGURES).withColumnRenamed("chunk", "_chunk")
    path = shared_path(spark, "scored")
    read = replies.groupBy("_chunk").cogroup(chunks.groupBy("chunk")).applyInPandas(_read(plan, model), SCORED)
    read.write.parquet(path)
    scored = spark.read.parquet(path)
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    long = scored.where("key is not null").groupBy("doc_id", "key", "copies").agg(*sums)
    long = long.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    columns = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    both = scored.where("key is null").select(*columns).unionByName(long.select(*columns))
    return both.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )

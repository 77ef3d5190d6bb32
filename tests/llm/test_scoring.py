"""Scores against a plain count of all pairs, and the model's probabilities adding up to one."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bookpipe.llm import queries, scoring

SCHEMA = "doc_id bigint, text string, lang string, n_tokens string, key string, copies string, word string, chunk string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def steps(counts):
    n = [sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    d = [1 - 2 * y * n[1] / n[0] if n[0] else 0.5, 2 - 3 * y * n[2] / n[1] if n[1] else 1.0, 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return [0.0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))]


class Plain:
    """The same model from plain counters."""

    def __init__(self, rows):
        self.c, self.n = Counter(), defaultdict(Counter)
        for doc_id, text in rows:
            if not held(doc_id):
                own = tokens(text)
                self.c.update(own)
                for a, b in zip(["start of text", *own], own, strict=False):
                    self.n[a][b] += 1
        self.total, self.kinds = sum(self.c.values()), len(self.c)
        self.low = steps(self.c.values())
        self.high = steps([n for after in self.n.values() for n in after.values()])
        self.spare = sum(self.low[min(n, 3)] for n in self.c.values()) / self.total if self.total else 1.0

    def token(self, b):
        c = self.c[b]
        return (c - self.low[min(c, 3)]) / max(self.total, 1) + self.spare / (self.kinds + 1)

    def pair(self, a, b):
        after = self.n.get(a)
        if not after:
            return self.token(b)
        all_ = sum(after.values())
        gamma = sum(self.high[min(n, 3)] for n in after.values()) / all_
        n = after.get(b, 0)
        return (n - self.high[min(n, 3)]) / all_ + gamma * self.token(b)

    def row(self, doc_id, text):
        own = tokens(text)
        base = sum(math.log10((self.c[b] + 1) / (self.total + self.kinds + 1)) for b in own)
        score = sum(math.log10(self.pair(a, b)) for a, b in zip(["start of text", *own], own, strict=False))
        return (doc_id, held(doc_id), len(own), sum(self.c[b] > 0 for b in own), self.total, round(base, 6), round(score, 6))


def got(rows):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    return Counter(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in (r[n] for n in names)) for r in rows)


def wanted(rows):
    model = Plain(rows)
    return Counter(tuple(v + 0.0 if isinstance(v, float) else v for v in model.row(*r)) for r in rows)


LONG = " ".join(["the"] * 3000 + [f"word{i % 97}" for i in range(4000)]) + "\n\t "
ROWS = [
    (1, "plain words of some text here\nand a second line\n\nnew section"),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, LONG),
    (5, LONG),
    (6, "The the THE the a the b"),
    (6, "The the THE the a the b"),
    (None, "no id here but some text"),
    (7, "ÄÖ äö é \x1c \x85  x no-break\xa0space \x00 nul"),
    (8, "...   \t 123\r\n\x0b\x0cx"),
    (2**60 + 1, "a very large number"),
    (9, "x" * 5000),
] + [(i, f"the word{i % 5} the word{i % 3} and the end") for i in range(10, 80)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", "x", "x", "x", "x", "x") for r in rows], SCHEMA)


@pytest.mark.parametrize("chunk,piece,chars,shards", [(scoring.CHUNK, scoring.PIECE, scoring.SHARD_CHARS, 48), (900, 500, 4000, 1), (300, 6000, 1000, 7)])
def test_scores_on_small_cases(spark, chunk, piece, chars, shards):
    rows = scoring.scores(frame(spark, ROWS), chunk, piece, chars, shards).collect()
    assert got(rows) == wanted(ROWS)


def test_scores_of_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op11_lm_scoring(spark, sf_dir).collect()
    assert got(found) == wanted(rows)
    for part in (True, False):  # better than the base on texts that it has not seen, too
        assert sum(r.score for r in found if r.held_out is part) > sum(r.base_score for r in found if r.held_out is part)


def test_without_training_text_or_rows(spark):
    kept = [i for i in range(100) if held(i)][:3]
    rows = [(i, "some words") for i in kept]
    assert got(scoring.scores(frame(spark, rows)).collect()) == wanted(rows)
    assert scoring.scores(frame(spark, ROWS).limit(0)).count() == 0


def test_probabilities_add_up():
    model = Plain(ROWS)
    for a in [*list(model.n)[:20], "never seen"]:
        known = sum(model.pair(a, b) for b in model.c)
        assert math.isclose(known + model.pair(a, "an unknown word"), 1.0, rel_tol=1e-9)


def test_shards_of_split_tokens():
    """Pairs of a split token go to several shards, those of others to one."""
    seconds = scoring.mixed(np.arange(1, 2000, dtype="uint64"))
    plan = scoring.Layout(64, np.array([7], dtype="uint64"), np.array([40]))
    assert len(set(plan.shard_of(np.full(1999, 7, dtype="uint64"), seconds).tolist())) > 20
    assert len(set(plan.shard_of(np.full(1999, 8, dtype="uint64"), seconds).tolist())) == 1

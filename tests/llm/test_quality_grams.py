"""Quality by counts of whole characters: sharded, without a cap, and junk goes."""

import collections
import math
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest

from bookpipe.llm import common, quality

LABELS = "doc_id bigint, quality int, toxic int"
DOCS = "doc_id bigint, text string, lang string"


def sentences(letters: str, seed: int, n: int = 60) -> str:
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list(letters), k)) for k in (2, 3, 4, 5)]
    return " ".join(words[i] for i in rng.integers(0, 4, n))


def test_letters_of_one_class_are_told_apart(spark):
    signs = "".join(map(chr, range(0x4E00, 0x4E0F)))
    other = "".join(chr(ord(c) + 500) for c in signs)  # the same classes
    assert [quality.class_of()[ord(c)] for c in signs] == [quality.class_of()[ord(c)] for c in other]
    good = [(i, sentences(signs, 1 + i % 2, 60 + i), "zh") for i in range(20)]
    swap = str.maketrans(signs, other)
    docs = spark.createDataFrame([*good, *((100 + i, t.translate(swap), "zh") for i, t, _ in good)], DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in good], LABELS)
    kept = {r.doc_id for r in quality.scores(docs, labels).where("kept").collect()}
    assert kept and max(kept) < 100 and len(kept) >= 19


def test_repeated_words_go(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    junk = [(-1 - i, f"{word} " * n, "en") for i, word in enumerate(("And", "The", "Onable", "Enti")) for n in (400,)]
    both = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(junk, DOCS))
    got = quality.scores(both, labels)
    assert got.where("doc_id < 0 and kept").count() == 0
    good = got.join(labels.where("quality = 1"), "doc_id", "left_semi")
    assert good.where("not kept").count() <= 0.01 * good.count() + 1


def test_probabilities_sum_to_one_and_counts_grow(spark):
    texts = [sentences("abcdefghijé中\U0001f600", i) for i in range(12)]
    rows = spark.createDataFrame([(t, i % quality.FOLDS) for i, t in enumerate(texts)], "text string, _fold int")
    few, all_of = (quality.fit_grams(r, 3) for r in (rows.limit(3), rows))
    held = {}
    for row in all_of.counts.collect():
        high, low = quality._packed(row.grams)
        held.update(zip(zip(high.tolist(), low.tolist()), quality._large(row.n).reshape(-1, quality.FOLDS).sum(axis=1).tolist()))
    want = collections.Counter()
    for t in texts:
        high, low, _ = quality.packed([t])
        want.update(zip(high.tolist(), low.tolist()))
    assert held == dict(want)
    assert len(held) > sum(len(quality._large(r.n)) // quality.FOLDS for r in few.counts.collect())
    shards = {r.shard: quality._shard(r) for r in all_of.counts.collect()}
    points = np.arange(quality.POINTS)
    for text in (texts[0][:5], "zzzzz", texts[0][:2] + "qqq", "qq" + texts[0][3:6]):
        a = [ord(c) for c in text]
        high = np.full(len(points), a[0] << 42 | a[1] << 21 | a[2])
        low = (a[3] << 42 | a[4] << 21) | points
        shard = shards.get(int(quality.shard_of(high[:1], low[:1], 3)[0]))
        assert np.allclose(np.exp(shard.logs(high, low, all_of.base.of(high, low), all_of.steps)).sum(axis=0), 1, atol=1e-3)


def test_bounds_of_untrusted_languages_and_short_texts(spark):
    rows = [("en", 2.0 + 0.01 * (i % 10), 3000, True) for i in range(900)] + [("de", 12.0, 8, True)] * 3
    rows += [("it", 4.0, 3000, False), ("it", 2.05, 3000, False), ("de", 4.0, 3000, False), ("de", 11.9, 8, False), ("en", 2.2, 3000, False)]
    schema = "lang string, perplexity double, n int, _trusted boolean"
    scored = spark.createDataFrame(rows, schema).withColumn("_spread", quality.spread(quality.F.expr("repeat('x', n)")))
    found = {r._lang: (r._middle, r._excess) for r in quality.thresholds(scored).collect()}
    bounds = spark.createDataFrame([(k, *v) for k, v in found.items() if k], "_lang string, _middle double, _excess double")
    judge = quality.Judge(scored, scored, bounds, found[None])
    got = [(r.lang, r.perplexity, r.kept) for r in judge.verdict(scored).where("not _trusted").collect()]
    assert sorted(got) == [("de", 4.0, True), ("de", 11.9, True), ("en", 2.2, False), ("it", 2.05, True), ("it", 4.0, False)]


@pytest.mark.parametrize("hot", [0, 20])
def test_shards_chunks_and_frequent_grams_give_the_same(spark, monkeypatch, hot):
    texts = [sentences("abcdefghij", i, 20 + i) for i in range(10)] + ["", "abc"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS).coalesce(1)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], LABELS)
    marked = quality.marks(docs, quality.trusted_ids(labels)).cache()
    model = quality.fit_grams(marked.where("_trusted"), 1)
    shard = quality._shard(model.counts.first())
    want = {}
    for r in marked.collect():
        high, low, _ = quality.packed([r.text])
        want[bytes(r._key)] = math.exp(-shard.logs(high, low, model.base.of(high, low), model.steps)[:, r._fold].mean()) if r.text else 1.0
    monkeypatch.setattr(quality, "HOT", hot)
    monkeypatch.setattr(quality, "LEAST_SHARDS", 5)
    got = {bytes(r._key): r.perplexity for r in quality.perplexities(marked).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


@pytest.mark.parametrize("clash", [False, True])
def test_places_by_gram_even_if_hashes_clash(monkeypatch, clash):
    high, low, _ = quality.packed(["abcabcabc", "", "abcabd"])
    if clash:
        monkeypatch.setattr(quality, "mixed", lambda high, low: (low % 3).astype("uint64"))
    place, new = quality.by_gram(high, low)
    groups = [g.tolist() for g in np.split(place, np.flatnonzero(new)[1:])]
    want = collections.defaultdict(list)
    for at, gram in enumerate(zip(high.tolist(), low.tolist())):
        want[gram].append(at)
    assert sorted(groups) == sorted(want.values())


def test_posted_rows_hold_folds_as_runs(monkeypatch):
    """Folds go to every shard with every chunk: in any order they are the larger part of small rows."""
    task = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 7))
    monkeypatch.setattr(quality, "TaskContext", task)
    texts = [sentences("abcdefghij", i, 5 + i) for i in range(40)]
    chunk = pd.DataFrame({"text": texts, "_key": [bytes([i]) * 16 for i in range(40)], "_trusted": [i % 3 > 0 for i in range(40)], "_fold": [i * 7 % 5 for i in range(40)]})
    none = SimpleNamespace(value=(np.zeros(0, dtype="uint64"), np.zeros((0, quality.VARIANTS))))
    rows = pd.concat(quality._post((5, none), iter([chunk])))
    whole, parts = rows[rows["keys"].notna()].iloc[0], rows[rows["keys"].isna()]
    for folds in (whole["folds"], *parts["folds"]):
        assert list(folds) == sorted(i * 7 % 5 for i in range(40))
    ids = [whole["keys"][i] for i in range(0, len(whole["keys"]), 16)]
    assert [i * 7 % 5 for i in ids] == list(whole["folds"]) and [i % 3 > 0 for i in ids] == [bool(x) for x in whole["trusted"]]
    assert np.frombuffer(whole["sizes"], dtype="<i8").tolist() == [len(texts[i]) + 1 for i in ids]
    assert sum(int(quality._large(x).sum()) for x in parts["times"]) == sum(len(t) + 1 for t in texts)


def test_memory_is_given_back_when_a_task_ends(monkeypatch):
    said = []
    monkeypatch.setattr(common, "release", lambda: said.append("released"))
    call, stream = common.releasing(said.append), common.releasing(quality._add_sums.__wrapped__)
    call("worked")
    assert said == ["worked", "released"]
    list(stream(iter([])))
    assert said[2:] == ["released"]
    for work in (quality._count, quality._count_sharded, quality._merge, quality._post, quality._score_shard, quality._add_sums, quality._score_chunk):
        assert hasattr(work, "__wrapped__"), work

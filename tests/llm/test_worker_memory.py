"""What a stage has taken is given back when its tasks end and when a model is learnt."""

import pandas as pd

from bookpipe.llm import common, language_id, minhash


def texts(n: int) -> pd.DataFrame:
    words = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(n)]
    return pd.DataFrame({"doc_id": range(n), "text_key": range(n), "text": words})


def test_near_duplicates_give_memory_back(monkeypatch):
    said = []
    monkeypatch.setattr(common, "release", lambda: said.append("released"))
    for work in (minhash._sign(4), minhash._sets(4)):
        said.clear()
        assert sum(map(len, work(iter([texts(5), texts(3)])))) == 8
        assert said == ["released"]


def test_small_blocks_give_the_same(monkeypatch):
    batch, got = texts(30), []
    for size in (1 << 20, 1 << 18, 1_000, 1):
        monkeypatch.setattr(minhash, "BLOCK_BYTES", size)
        rows = pd.concat(minhash._sign(4)(iter([batch])))
        got.append([(r.doc_id, r.node, r.n_shingles, r.bands.tolist(), r.bits.tolist()) for r in rows.itertuples()])
    assert all(rows == got[0] for rows in got[1:])


def test_the_driver_gives_memory_back_after_learning(spark, monkeypatch):
    said = []
    monkeypatch.setattr(language_id, "release", lambda: said.append("released"))
    docs = spark.createDataFrame([(1, "some words here", "en"), (2, "und andere dort", "de")], "doc_id bigint, text string, lang string")
    assert language_id.fit(docs).languages == ["de", "en"]
    assert said == ["released"]

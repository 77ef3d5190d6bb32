"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from bookpipe.llm import bpe, decontaminate, fingerprints, html_text, language_id, minhash, quality, sharding, token_counts, token_files
from bookpipe.llm.queries import PATTERN, RANKS, WORDS

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, ids string, text_key string, size string, tree string, kept string"
ITEM = "the quick brown fox jumps over the lazy dog while seven other animals look on from afar"
LONG = "word " * 30_000 + "end"
ROWS = [
    (1, "plain words of some text here\nand a second line\n\nnew section", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, LONG, "en"),
    (5, f"before it, {ITEM.upper()}! after", "fr"),
    (5, f"before it, {ITEM.upper()}! after", "fr"),
    (6, f"before it, {ITEM.upper()}! after", "fr"),
    (None, "no id here but some text", "de"),
    (7, "...   \t 123", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "s", None, "w", "i", "k", "z", "t", "y") for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe(docs, none):
    code = bpe.encoding(RANKS, PATTERN)
    for chunk, overlap in ((bpe.CHUNK, bpe.OVERLAP), (40, 8), (40, 2)):
        got = bpe.encode(docs, RANKS, PATTERN, chunk=chunk, overlap=overlap)
        assert set(got.columns) == set(docs.columns)
        pairs = collections.Counter((r.text, bytes(r.ids)) for r in got.collect())
        assert pairs == collections.Counter((t, bpe.to_bytes(code.encode_ordinary(t or ""))) for _, t, _ in ROWS)
    rows = bpe.round_trip_digests(docs, RANKS, PATTERN).collect()
    want = collections.Counter((d, hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in ROWS)
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in rows) == want
    assert bpe.encode(none, RANKS, PATTERN).count() == 0


def test_token_counts(docs, none):
    code = bpe.encoding(RANKS, PATTERN)
    lengths = [len(code.encode_ordinary(t or "")) for _, t, _ in ROWS]
    sums = token_counts.token_counts(docs, RANKS, PATTERN)
    for r in sums.collect():
        assert r.docs_at_least == sum(n >= r.n_tokens for n in lengths)
        assert r.tokens_at_least == sum(n for n in lengths if n >= r.n_tokens)
        assert r.truncated_tokens == sum(min(n, r.n_tokens) for n in lengths)
        assert r.total_tokens == sum(lengths) and r.quantile == sum(n <= r.n_tokens for n in lengths) / len(lengths)
    assert token_counts.at_limit(sums, 9).first().tokens == sum(min(n, 9) for n in lengths)
    assert token_counts.token_counts(none, RANKS, PATTERN).count() == 0


def test_token_files(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    code, path = Tokenizer.from_file(WORDS), str(tmp_path / "t")
    rows = token_files.token_digests(docs, path, WORDS).orderBy("start").collect()
    at, want = 0, collections.Counter()
    for d, t, _ in sorted(ROWS, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array(code.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want[d, at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    assert collections.Counter(tuple(r) for r in rows) == want
    some = token_files.tokens(spark, path, [5]).collect()
    assert len(some) == 2 and {len(r.ids) for r in some} == {r.n_tokens for r in some}
    plan = token_files.metadata(spark, path)._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1]
    assert token_files.token_digests(none, str(tmp_path / "e"), WORDS).count() == 0


def test_word_encoder_equals_the_tokenizer(monkeypatch):
    """The library as it is: special tokens in a text are found."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORDS)
    assert len(plain.encode("see <|endoftext|> here", add_special_tokens=False).ids) == 3
    texts = [
        "(ab)... x##! it's. l'eau, \u0130a!! a1%% <|endoftext|> e\u0301.. \x1c.a \u00aa\u00ba!!",
        "  ",
        "",
        "Eau eau, EAU% %% \u4e2d\u6587\u3002 a\u00a0b",
        LONG,
        "see <|endoftext|> here a<|startoftext|>b <|ENDOFTEXT|> <|endoftext|>",
        "\u0130stanbul \u0149 \u017f \u00aa \u00df \u00c9\u00c0 \u01c5 \u0133 \u212b x\ty\n\nz\r \u0085 end",
    ]
    for parts in (500_000, 3):
        monkeypatch.setattr(token_files, "MEMO_PARTS", parts)
        encode = token_files.WordEncoder(WORDS)
        assert encode.latin == token_files.LATIN
        for group in (texts, texts[:1], texts[3:], texts):
            ids, sizes = encode(pa.array(group))
            got = [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
            assert got == [plain.encode(t, add_special_tokens=False).ids for t in group]


def test_language(spark, docs, none):
    rows = [(i, "the of and with this from that" if i % 2 else "der die das und mit ist ein", "en" if i % 2 else "de") for i in range(80)]
    taught = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(taught)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r for r in language_id.predict(docs.where("doc_id is not null"), model).collect()}
    assert [got[i].lang_pred for i in (2, 3, 7)] == ["und"] * 3 and got[7].rejected and got[7].score == 0
    assert got[4].lang_pred in ("de", "en") and 0 < got[4].score <= 1
    assert language_id.held_out_predictions(none).count() == 0
    assert {r.lang_pred for r in language_id.predict(docs, language_id.train([])).collect()} == {"und"}
    kept = language_id.accepted(docs)
    assert kept.columns == docs.columns and kept.where("text is null or text = ''").count() == 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.scores(docs, labels).collect()
    assert len(got) == len(ROWS) and all(r.perplexity >= 1 for r in got)
    assert {r.doc_id for r in got if r.perplexity == 1} == {2, 3} and all(r.kept for r in got if r.doc_id in (1, 2, 3))
    assert quality.scores(docs, labels.limit(0)).where("kept").count() == len(ROWS)
    assert quality.scores(none, labels).count() == 0
    assert quality.accepted(docs, labels).columns == docs.columns


def test_quality_model_by_brute_force():
    text, size = "abc abd abc, Abe 12 abc.\n", quality.CLASSES
    counts = np.bincount(np.concatenate(list(quality.grams(text))), minlength=quality.SIZE)
    table = np.exp(quality.kneser_ney(counts).astype("float64"))
    assert np.allclose(table.reshape(-1, size).sum(axis=1), 1, atol=1e-4)
    classes = [0, 0, 0, *(int(quality.class_of()[ord(c)]) for c in text), 0]
    grams = collections.Counter(tuple(classes[i : i + 4]) for i in range(len(classes) - 3))

    def probability(gram, held):
        if not gram:
            return 1 / size
        n = [sum(c == k for c in held.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        steps = [1 - 2 * y * n[1] / n[0] if n[0] else 0.5, 2 - 3 * y * n[2] / n[1] if n[1] else 1.0, 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
        steps = [min(max(d, 0.05), k - 0.05) for k, d in enumerate(steps, 1)]
        after = {g: c for g, c in held.items() if g[:-1] == gram[:-1]}
        below = collections.Counter(g[1:] for g in held)
        rest = probability(gram[1:], below)
        if not after:
            return rest
        total = sum(after.values())
        gamma = sum(steps[min(c, 3) - 1] for c in after.values()) / total
        own = held.get(gram, 0)
        return (own - steps[min(own, 3) - 1] if own else 0) / total + gamma * rest

    for gram in [*list(grams)[:12], (4, 5, 6, 7), (9, 9, 9, 9)]:
        key = ((gram[0] * size + gram[1]) * size + gram[2]) * size + gram[3]
        assert table[key] == pytest.approx(probability(gram, dict(grams)), rel=1e-4)


def test_minhash(docs, none):
    got = minhash.near_duplicates(docs, 4, 80).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [by[i][0].component_id for i in (1, 2, 3, 4)] == [1, 2, 3, 4]
    assert {r.component_id for i in (5, 6) for r in by[i]} == {5} and not by[6][0].kept
    assert by[None][0].component_id is None and by[None][0].kept
    assert by[2][0].n_shingles == by[3][0].n_shingles == 0 and by[7][0].n_shingles == 1
    assert by[4][0].n_shingles == 2
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == 7
    assert minhash.near_duplicates(none).count() == 0


def test_minhash_components_by_brute_force(spark, monkeypatch):
    import random

    monkeypatch.setattr(minhash, "SMALL", 3)
    monkeypatch.setattr(minhash, "BLOCK_NODES", 5)
    rng, rows = random.Random(3), []
    for i in range(90):
        words = [f"w{k}" for k in range(60)]
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"z{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in (t.split() for _, t in rows)]
    parent = list(range(90))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(90):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: find(i) for i in range(90)}


def test_decontamination(spark, docs, none):
    changed = ITEM.replace("afar", "there")
    benchmark = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None), (4, ""), (5, "second line"), (6, changed)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(docs, benchmark).collect()}
    assert got.pop((1, 5)) == 1
    assert set(got) == {(d, i) for d in (5, 6) for i in (1, 2, 6)}
    assert got[5, 1] == 1 and got[5, 6] == pytest.approx(12 / 14)
    clean = decontaminate.clean(docs, benchmark)
    assert clean.columns == docs.columns and clean.where("doc_id in (1, 5, 6)").count() == 0 and clean.count() == 5
    assert decontaminate.leaks(none, benchmark).count() == 0 and decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


def test_fingerprints(spark, docs, none):
    rows = fingerprints.edits(docs).collect()
    order = sorted((r for r in ROWS if r[0] is not None), key=lambda r: -r[0]) + [r for r in ROWS if r[0] is None]
    want = collections.Counter()
    for (d, t, _), (_, n, _) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        k = len(t) // 3
        want[d, len(t), hashlib.sha256((t[: len(t) - k] + n[:k]).encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert len({r.fingerprint for r in rows}) == 6
    assert fingerprints.edits(none).count() == 0
    one = fingerprints.edits(docs.where("doc_id = 1")).first()
    assert one.near_next == 1


def test_differing_branches(spark):
    a, b = "one\ntwo\n\nthree\nfour\n\nfive", "one\ntwo\n\nthree\nFOUR\n\nfive\nsix"
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(a, b)], "a string, b string").select(
        fingerprints.differing_paragraphs(fingerprints.paragraphs(F.col("a")), fingerprints.paragraphs(F.col("b"))).alias("d")
    )
    assert [tuple(x) for x in rows.first().d] == [(1, 1), (2, 1)]


def test_sharding(spark, docs, none, tmp_path):
    path = str(tmp_path / "map")
    rows = sharding.place(docs, path, shards=3, slots=64).collect()
    assert len(rows) == len(ROWS) and {r.law for r in rows} == {"bytes"}
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    sizes = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in ROWS)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == sizes
    version, shard_of = sharding.read_map(spark, path)
    weights = {s: 10 for s in range(64)}
    edited = sharding.rebalance(shard_of, weights, 4)
    assert {s for s, (a, b) in enumerate(zip(shard_of, edited, strict=True)) if a != b} and edited.count(3) == 16
    sharding.store_map(spark, path, version + 1, edited)
    assert {r.map_version for r in sharding.place(docs, path, shards=3, slots=64).collect()} == {1}
    assert sharding.read_map(spark, path, 0)[1] == shard_of
    assert sharding.place(none, str(tmp_path / "none")).count() == 0


def test_wide_groups_are_split(spark, tmp_path):
    rows = [(i, "same text" * 20) for i in range(400)] + [(i, f"text {i}" * 20) for i in range(400, 800)]
    got = sharding.place(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path / "wide")).collect()
    loads = collections.Counter()
    for r in got:
        loads[r.shard] += r.size
    assert len(loads) == 8 and max(loads.values()) - min(loads.values()) < 400


def test_pages(spark):
    def page(body, end="</body></html>"):
        return f'<html><head><title>T</title></head><body><nav><a>menu</a></nav><div class="cookie notice">ok?</div><article><h1>Head</h1>{body}</article><div id="comments">nice</div><footer>f</footer>{end}'

    rows = [
        (1, "http://a.example/1", page("<p>One &amp; <b>bo</b>ld</p><script>var t='</p>';</script><p>two&nbsp;&lt;x")),
        (2, "http://a.example/2", page("<p>Three<br>four</p><form>send</form><!-- no -->", "")),
        (3, "http://a.example/3", page("<p title='a > b'>five</p><div class=ad>buy</div>")),
        (4, "http://b.example/", None),
        (5, None, ""),
        (6, "no url", "just text"),
        (6, "no url", "just text"),
        (7, "http://c.example/", "<p>" * 3_000 + "deep" + "<div>" * 3_000 + " x<"),
    ]
    pages = spark.createDataFrame([(*r, "t", "n") for r in rows], "page_id bigint, url string, html string, text string, n_chars string")
    got = html_text.extract(pages).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert by[1] == "Head One & bold two <x" and by[2] == "Head Three four" and by[3] == "Head five"
    assert by[4] == by[5] == "" and by[6] == "just text" and by[7] == "deep x<"
    assert html_text.extract(pages.limit(0)).count() == 0
    assert re.fullmatch("/html/body/article", html_text.slots(html_text.token_classes(pages.where("page_id < 4"))).first()["_slot"])

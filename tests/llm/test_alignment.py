"""Token alignment against a plain double loop, and its sparse products against dense ones."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bookpipe.llm import alignment, queries
from bookpipe.llm.packing import pack, unpack
from bookpipe.llm.sparse import Csr, product, summed, transposed
from bookpipe.llm.token_files import byte_chars

SCHEMA = "doc_id bigint, text string, lang string, a_at string, pairs string, chunk string, docs string, sums string"
TEXTS = [
    "plain words of some text here\nand a second line\n\nnew section",
    None,
    "",
    " ",
    "  two  blanks   and\n one after a line, \t tabs\r\n and trailing  ",
    "ünïcödé ﬁ 漢字かな混じり文 🙂🙂 naïve",
    "a▁b is not the same bytes",
    "▁",
    "see <|endoftext|> and <s> </s> <unk> <0x41> here",
    "\x00 nul   no-break   wide \x85 next",
    "wordwithoutanyblank" * 40,
    "repeat repeat repeat repeat",
    "repeat repeat repeat repeat",
    "don't can't we'll 12345 67,890.12 !!! ... ---",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(queries.BYTES)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    of = {c: b for b, c in enumerate(byte_chars())}

    def tokens(text):
        """(id, first byte, last byte + 1) of both, or None."""
        if not text:
            return None
        whole, out = (" " + text).encode(), []
        names = [(i, bytes(of[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
        pieces = []
        for i in model.encode(text):
            p = model.id_to_piece(i)
            pieces.append((i, bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()))
        for found in (names, pieces):
            if b"".join(raw for _, raw in found) != whole:
                return None
            at, spans = 0, []
            for i, raw in found:
                spans.append((i, at, at + len(raw)))
                at += len(raw)
            out.append(spans)
        return out

    return tokens


def brute(texts, tokens):
    made, held = [], Counter()
    for text in texts:
        found = tokens(text)
        if found is None:
            made.append(None)
            continue
        a, b = found
        links, low = [], 0
        for i, (_, start, end) in enumerate(a):
            while b[low][2] <= start:
                low += 1
            j = low
            while j < len(b) and b[j][1] < end:
                links.append((i, j, min(end, b[j][2]) - max(start, b[j][1])))
                j += 1
        common = sorted({x[2] for x in a} & {x[2] for x in b})
        groups = [[[], []] for _ in common]
        for side, spans in enumerate((a, b)):
            g = 0
            for i, _, end in spans:
                while end > common[g]:
                    g += 1
                groups[g][side].append(i)
        made.append((a, b, groups, links))
        held.update({(a[i][0], b[j][0]) for i, j, _ in links})
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    rows = []
    for one in made:
        if one is None:
            rows.append((0, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = one
        ids = [(a[i][0], b[j][0]) for i, j, _ in links]
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append(
            (len(a), len(b), len(groups), len(links), sum(len(x) * len(y) for x, y in groups),
             sum(held[p] == most[p[0]] for p in ids), sum(held[p] for p in ids), hashlib.sha256(written.encode()).hexdigest())
        )
    return rows, made


def digests(rows):
    return Counter(
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_shared, r.n_best, r.count_sum, r.groups_sha256) for r in rows
    )


def frame(spark, texts):
    return spark.createDataFrame([(i if i != 3 else None, t, "en", "x", "x", "x", "x", "x") for i, t in enumerate(texts)], SCHEMA)


def wanted(texts, tokens):
    return Counter((i if i != 3 else None, *row) for i, row in enumerate(brute(texts, tokens)[0]))


@pytest.mark.parametrize("chunk", [alignment.CHUNK, 12, 60])
def test_digests_on_small_cases(spark, plain, chunk):
    got = digests(alignment.digests(frame(spark, TEXTS), queries.BYTES, queries.PIECES, chunk).collect())
    assert got == wanted(TEXTS, plain)


@pytest.mark.parametrize("chunk", [1, 12, 60, 10_000])
def test_texts_in_pieces(plain, chunk):
    codes = alignment.tokenizers(queries.BYTES, queries.PIECES)
    made = alignment.align_texts([t or "" for t in TEXTS], codes, chunk)
    rows, found = brute(TEXTS, plain)
    assert [tuple(map(int, made.sums[:, i])) for i in range(len(TEXTS))] == [r[:5] for r in rows]
    assert made.digests == [r[-1] for r in rows]
    for i, one in enumerate(found):
        own = slice(made.links.bounds[i], made.links.bounds[i + 1])
        got = Counter(dict(zip(made.pairs[made.links.columns[own]].tolist(), made.links.values[own].tolist(), strict=True)))
        want = Counter((one[0][a][0] << 32) + one[1][b][0] for a, b, _ in one[3]) if one else Counter()
        assert got == want


def test_digests_of_whole_table(spark, plain, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *row) for r, row in zip(rows, brute([r.text for r in rows], plain)[0], strict=True))
    assert digests(queries.op13_alignment(spark, sf_dir).collect()) == want


@pytest.mark.parametrize("kind", ["overlap", "group"])
def test_links(spark, plain, kind):
    got = Counter(map(tuple, alignment.links(frame(spark, TEXTS), queries.BYTES, queries.PIECES, kind).collect()))
    want = Counter()
    for i, one in enumerate(brute(TEXTS, plain)[1]):
        if one is None:
            continue
        a, b, groups, links = one
        if kind == "group":
            links, x, y = [], 0, 0
            for mine, theirs in groups:
                links += [(x + k, y + m, 1) for k in range(len(mine)) for m in range(len(theirs))]
                x, y = x + len(mine), y + len(theirs)
        want.update((i if i != 3 else None, k, a[k][0], m, b[m][0], n) for k, m, n in links)
    assert got == want


def test_no_rows(spark):
    none = frame(spark, TEXTS).limit(0)
    assert alignment.digests(none, queries.BYTES, queries.PIECES).count() == 0
    assert alignment.links(none, queries.BYTES, queries.PIECES).count() == 0


def dense(m: Csr) -> np.ndarray:
    out = np.zeros((m.height, m.width), dtype="int64")
    np.add.at(out, (m.row_of(), m.columns), m.values)
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 6), st.integers(1, 6), st.integers(1, 6), st.integers(1, 9), st.data())
def test_products(height, inner, width, block, data):
    def matrix(rows, columns):
        cells = data.draw(st.lists(st.tuples(st.integers(0, max(rows - 1, 0)), st.integers(0, columns - 1), st.integers(-3, 3)), max_size=12 if rows else 0))
        x = np.array(cells, dtype="int64").reshape(-1, 3)
        return summed(x[:, 0], x[:, 1], x[:, 2], rows, columns)

    a, b = matrix(height, inner), matrix(inner, width)
    assert (dense(product(a, b, block)) == dense(a) @ dense(b)).all()
    assert (dense(transposed(a)) == dense(a).T).all()
    assert (a.row_sums() == dense(a).sum(axis=1)).all()


@given(st.lists(st.integers(0, 2**62), max_size=20))
def test_packing(values):
    assert unpack(pack(np.array(values, dtype="int64"))).tolist() == values

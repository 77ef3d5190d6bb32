"""Fingerprints and likeness against plain code, and what one word put into a text does to it."""

import hashlib
import re
import string

from pyspark.sql import functions as F

from bookpipe.llm import fingerprints as fp


MARKS = string.punctuation + "gy"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_root(text):
    return sha("".join(sha("".join(sha(p) for p in s.split("\n"))) for s in text.split("\n\n")))


def plain_runs(text):
    """Words in order, cut after those that end a run, at RUN words and at line ends."""
    out = set()
    for line in text.split("\n"):
        run = []
        for word in re.findall(r"[^ ]+ ?", line):
            run.append(word)
            bare = word.rstrip(" ")
            if bare[-1] in MARKS or len(run) == fp.RUN:
                out.add("".join(run))
                run = []
        if run:
            out.add("".join(run))
    return out


def dice(a, b):
    if a == b:
        return 1.0
    x, y = plain_runs(a), plain_runs(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def test_whole_table_against_plain_code(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    following = {rows[i][0]: rows[(i + 1) % len(rows)][1] for i in range(len(rows))}
    got = {r.doc_id: r for r in fp.edits(docs).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[doc_id][:cut]
        r = got[doc_id]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint, r.edited_sha256) == (
            len(text), plain_root(text), plain_root(edited), sha(edited),
        )
        assert abs(r.near_next - dice(text, following[doc_id])) < 1e-9
        assert abs(r.near_edited - dice(text, edited)) < 1e-9


def test_one_word_changes_little(spark, sf_dir):
    """A word put before a text, or into its middle, leaves most of its runs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null")
    words = F.split("text", " ")
    half = F.floor(F.size(words) / 2).cast("int")
    for edited in (
        F.concat(F.lit("zebra "), F.col("text")),
        F.array_join(F.concat(F.slice(words, F.lit(1), half), F.array(F.lit("word")), F.slice(words, half + 1, F.size(words))), " "),
    ):
        both = docs.where(F.size(words) >= 100).select(
            fp.likeness(fp.root(fp.paragraphs(F.col("text"))), fp.runs(F.col("text")), fp.root(fp.paragraphs(edited)), fp.runs(edited)).alias("near")
        )
        least, mean, n = both.agg(F.min("near"), F.mean("near"), F.count("*")).first()
        assert n > 50 and mean > 0.9 and least > 0.2, (least, mean)

"""The registered queries: each operator over its whole table, with its digests."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bookpipe.llm import alignment, bpe, decontaminate, divergence, fingerprints, html_text, language_id, minhash, quality, scoring, sharding, token_counts, token_files
from bookpipe.llm.common import shared_path, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN

#: Every item-sized window that sets a shared shingle at its place in the item, compared exactly.
LEAKS_SQL = r"""
with item as (
  select item_id, ws, len(ws) n, least(len(ws), 5) k from (
    select item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') ws from benchmark) where len(ws) > 0),
doc as (
  select distinct doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') ws from documents),
ish as (
  select item_id, n, k, p, array_to_string(ws[p + 1:p + k], ' ') s
  from (select *, unnest(range(n - k + 1)) p from item)),
ic as (select item_id, s, count(*) c, any_value(n - k + 1) total from ish group by item_id, s),
dsh as (
  select doc_id, ws, p, k, array_to_string(ws[p + 1:p + k], ' ') s
  from (select doc_id, ws, k, unnest(range(len(ws) - k + 1)) p from doc, (select distinct k from item) where len(ws) >= k)),
win as (
  select distinct doc_id, item_id, d.k, least(n, len(ws)) n, ws[st + 1:st + n] w, st from (
    select d.*, item_id, n, greatest(0, least(d.p - i.p, greatest(len(ws) - n, 0))) st
    from dsh d join ish i on d.s = i.s and d.k = i.k) d),
wc as (
  select doc_id, item_id, st, s, count(*) c, any_value(len(w) - k + 1) total from (
    select doc_id, item_id, st, w, k, array_to_string(w[p + 1:p + k], ' ') s
    from (select *, unnest(range(len(w) - k + 1)) p from win))
  group by doc_id, item_id, st, s),
sim as (
  select wc.doc_id, wc.item_id, st, sum(least(wc.c, ic.c)) b, any_value(wc.total) x, any_value(ic.total) y
  from wc join ic on wc.item_id = ic.item_id and wc.s = ic.s group by wc.doc_id, wc.item_id, st),
best as (
  select doc_id, item_id, st, b / (x + y - b) similarity,
    row_number() over (partition by doc_id, item_id order by b / (x + y - b) desc, st) r
  from sim where 100 * b >= 80 * (x + y - b))
select doc_id, item_id, cast(st as integer) as start, similarity from best where r = 1
"""

#: Terms, kept terms and both parts of the audit, in whole numbers of 128 bits.
DIVERGENCE_SQL = r"""
with doc as (
  select row_number() over () id, coalesce(lang, '') lang, coalesce(source, '') source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') ws
  from documents),
occ as (select id, lang, source, unnest(ws) term from doc),
kept as (select lang, term, count(*)::hugeint total from occ group by lang, term having count(distinct id) >= 10),
cnt as (
  select o.lang, o.source, o.term, count(*)::hugeint c
  from occ o join kept k on o.lang = k.lang and o.term = k.term group by o.lang, o.source, o.term),
grp as (
  select g.lang, g.source, coalesce(n, 0)::hugeint n, coalesce(v, 0)::hugeint v, coalesce(ln, 0)::hugeint ln
  from (select distinct lang, source from doc) g
  left join (select lang, source, sum(c) n from cnt group by lang, source) s on g.lang = s.lang and g.source = s.source
  left join (select lang, count(*) v, sum(total) ln from kept group by lang) l on g.lang = l.lang),
share as (
  select g.lang, g.source, k.term, coalesce(c, 0) c,
    1 + (1000000000 * (coalesce(c, 0) + 2)) // (g.n + 2 * g.v) p,
    1 + (1000000000 * (k.total + 2)) // (g.ln + 2 * g.v) q
  from grp g join kept k on g.lang = k.lang
  left join cnt on cnt.lang = g.lang and cnt.source = g.source and cnt.term = k.term),
pair as (
  select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) value
  from share a join share b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source),
part as (
  select a.lang, a.source, 'pair' part, b.source item, coalesce(value, 0)::hugeint value
  from grp a join grp b on a.lang = b.lang and a.source <> b.source
  left join pair on pair.lang = a.lang and pair.source = a.source and pair.item = b.source
  union all
  select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from share where c > 0 and p > q)
select * from (
  select lang, source, part, item, value::bigint as value,
    cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from part)
where part = 'pair' or rank <= 10
"""


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.held_out_predictions(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"), shared_path(spark, "tokens"), WORDS)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), shared_path(spark, "slot-map"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80).drop("text_key")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(table(spark, sf_dir, "documents"), BYTES, PIECES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_language_id,
        op3_token_files,
        op4_byte_bpe,
        op5_merkle_fingerprints,
        op6_quality,
        op7_sharding,
        op8_minhash,
        op9_html_text,
        op10_token_counts,
        op11_lm_scoring,
        op12_source_divergence,
        op13_alignment,
    )
}
SQL: dict[str, str] = {"op1_decontamination": LEAKS_SQL, "op12_source_divergence": DIVERGENCE_SQL}

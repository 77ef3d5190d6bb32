"""Registered queries: each operator over whole tables, with its SQL twin.

``@query(name, sql)`` registers a function of (spark, folder of tables). The SQL
computes the same rows on the same tables in another engine; a query without SQL
has no twin that could express it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.__main__ import arguments, config_of
from bookpipe.config import RunConfig
from bookpipe.functions import book_fields as B
from bookpipe.functions.paths import isbn_of_path, user_of_path
from bookpipe.functions.records import book_url_of, from_json_records, to_json_records
from bookpipe.functions.review_fields import star_rating
from bookpipe.functions.text import joined
from bookpipe.functions.urls import normalize_url, record_id
from bookpipe.operators import counts as C
from bookpipe.operators import listing as L
from bookpipe.operators import validate as V
from bookpipe.operators.blocks import extract_blocks
from bookpipe.operators.books import parse_books
from bookpipe.operators.joins import members, unseen, with_saved_count, without
from bookpipe.operators.ranking import global_rank
from bookpipe.operators.reviews import complete_reviews, extract_reviews, fill_reviews, nest_reviews, read_review_pages, reviews_of
from bookpipe.plans import derived_pages as P
from bookpipe.plans.flagship import ARRIVAL, flagship, line_reviews
from bookpipe.plans.increment import due_books, run_and_publish, run_increment
from bookpipe.profile import ARTICLES, SHOP
from bookpipe.schema import BOOK, REVIEW, conform
from bookpipe.session import PAGES_A_TASK, shared_dir, spread
from bookpipe.sinks.log import KeyedLog
from bookpipe.sinks.stores import FileStore, TableStore, image_manifest
from bookpipe.sinks.upsert import last_write, read_bucketed, upsert
from bookpipe.sources.pages import Captures, read_pages
from bookpipe.sources.tables import read_table, saved_isbns, saved_users
from bookpipe.streaming.increment import fill_reviews_stream, run_increment_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        QUERIES[name] = make
        if sql is not None:
            SQL[name] = sql
        return make

    return register


def bullet(label: str, value: Column) -> Column:
    return F.struct(F.lit(label).alias("label"), value.cast("string").alias("value"))


def saved_lines(spark: SparkSession, d: str) -> DataFrame:
    return line_reviews(P.table(spark, d, "lineitem")).where("is_saved").drop("is_saved")


def fresh_lines(spark: SparkSession, d: str) -> DataFrame:
    return line_reviews(P.table(spark, d, "lineitem")).where("not is_saved").drop("is_saved")


def all_lines(spark: SparkSession, d: str) -> DataFrame:
    return line_reviews(P.table(spark, d, "lineitem")).drop("is_saved")


# SQL shared by several twins: saved and new reviews, and the quota over them.
SQL_SAVED = "select l_partkey isbn, l_suppkey usr from lineitem where l_shipdate < timestamp '1998-01-01 00:00:00'"
SQL_FRESH = (
    "select l_partkey isbn, l_suppkey usr, l_quantity rating, l_orderkey, l_linenumber "
    "from lineitem where l_shipdate >= timestamp '1998-01-01 00:00:00'"
)
SQL_QUOTA = f"""
with saved as ({SQL_SAVED}), fresh as ({SQL_FRESH}),
saved_cnt as (select isbn, count(*) n from saved group by isbn),
cand as (select f.isbn, f.usr, f.rating,
    row_number() over (partition by f.isbn order by f.l_orderkey, f.l_linenumber, f.usr, f.rating) pos,
    greatest(16 - coalesce(sc.n, 0), 0) quota
  from fresh f left join saved_cnt sc on sc.isbn = f.isbn
  where not exists (select 1 from saved s where s.isbn = f.isbn and s.usr = f.usr)),
filled as (select isbn, usr, rating, pos from cand where pos <= quota)
"""


# ---- whole runs -----------------------------------------------------------


@query(
    "flagship_next_increment",
    f"""
with saved as ({SQL_SAVED}),
saved_cnt as (select isbn, count(*) n from saved group by isbn),
done as (select isbn from saved_cnt where n >= 12),
want as (select cast(floor(0.75 * count(*)) as bigint) num_books from part),
need as (select greatest((select num_books from want) - count(*), 0) d from done),
tgt as (select d + cast(floor(d * 0.05) as bigint) k from need),
fresh as ({SQL_FRESH}),
pop as (select l_partkey isbn, count(*) pop from lineitem group by l_partkey),
frontier as (select isbn, row_number() over (order by pop desc, isbn) rk from pop
             where isbn not in (select isbn from done)),
pick as (select isbn, rk from frontier where rk <= (select k from tgt)),
valid as (select pick.isbn, pick.rk from pick join part p on p.p_partkey = pick.isbn
          where p.p_name not like '%gizmo%' and p.p_type <> 'PROMO'),
cand as (select v.isbn, v.rk, f.usr, f.rating,
    row_number() over (partition by v.isbn order by f.l_orderkey, f.l_linenumber, f.usr, f.rating) pos,
    greatest(12 - coalesce(sc.n, 0), 0) quota
  from valid v join fresh f on f.isbn = v.isbn left join saved_cnt sc on sc.isbn = v.isbn
  where not exists (select 1 from saved s where s.isbn = f.isbn and s.usr = f.usr))
select isbn, rk, usr, rating, pos from cand where pos <= quota
""",
)
def flagship_next_increment(spark: SparkSession, d: str) -> DataFrame:
    """P1 P2 J1 J3 J5 O1 V3."""
    return flagship(P.table(spark, d, "part"), P.table(spark, d, "lineitem"))


SQL_RUN = f"""
with saved as ({SQL_SAVED}), fresh as ({SQL_FRESH}),
saved_cnt as (select isbn, count(*) n from saved group by isbn),
done as (select isbn from saved_cnt join part on p_partkey = isbn where n >= 12),
want as (select cast(floor(0.75 * count(*)) as bigint) num_books from part),
need as (select greatest((select num_books from want) - count(*), 0) d from done),
tgt as (select d + cast(floor(d * 0.05) as bigint) k from need),
frontier as (select p_partkey isbn, row_number() over (order by p_partkey) rk from part
             where p_partkey not in (select isbn from done)),
pick as (select p.* from frontier f join part p on p.p_partkey = f.isbn where rk <= (select k from tgt)),
judged as (select p_partkey isbn, case
    when p_name like '%gizmo%' then 'title: banned phrase'
    when p_type = 'PROMO' then 'language: not English'
    when p_type = 'ECONOMY' and p_size > 40 then 'pages: not a number' end verdict from pick),
cand as (select v.isbn, f.usr, f.rating, f.l_returnflag, f.l_orderkey, f.l_linenumber,
    row_number() over (partition by v.isbn order by f.l_orderkey, f.l_linenumber, f.usr, f.rating) pos,
    greatest(12 - coalesce(sc.n, 0), 0) quota
  from judged v
  join (select l_partkey isbn, l_suppkey usr, l_quantity rating, l_returnflag, l_orderkey, l_linenumber
        from lineitem where l_shipdate >= timestamp '1998-01-01 00:00:00') f on f.isbn = v.isbn
  left join saved_cnt sc on sc.isbn = v.isbn
  where v.verdict is null and not exists (select 1 from saved s where s.isbn = f.isbn and s.usr = f.usr))
"""


def run_config(spark: SparkSession, d: str) -> RunConfig:
    return RunConfig(
        num_books=int(0.75 * P.table(spark, d, "part").count()), num_reviews=12, banned_titles=("gizmo",)
    )


@query(
    "run_increment_reviews",
    SQL_RUN
    + """
select 'ISBN-13-978-' || isbn as isbn, 'user-' || usr as "user", pos as position,
  'Lot ' || l_linenumber || chr(10) || 'of order ' || l_orderkey as "text",
  case when l_returnflag = 'R' then null else cast(floor(rating / 10) as integer) end as rating
from cand where pos <= quota
""",
)
def run_increment_reviews(spark: SparkSession, d: str) -> DataFrame:
    """A whole run from pages to new reviews."""
    run = run_increment(P.captures(spark, d), P.SavedLines(spark, d), run_config(spark, d))
    return run.reviews.select("isbn", "user", "position", "text", "rating")


@query("repeated_captures", SQL["run_increment_reviews"])
def repeated_captures(spark: SparkSession, d: str) -> DataFrame:
    """Every capture has landed twice; the run is the same."""
    captures = Captures(*(pages.unionByName(pages) for pages in P.captures(spark, d)))
    run = run_increment(captures, P.SavedLines(spark, d), run_config(spark, d))
    return run.reviews.select("isbn", "user", "position", "text", "rating")


@query(
    "run_increment_quarantine",
    SQL_RUN
    + """
select 'https://shop.example/dp/' || isbn || '/' as url, split_part(verdict, ': ', 1) as field,
  split_part(verdict, ': ', 2) as reason
from judged where verdict is not null
""",
)
def run_increment_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """The books a run sets aside."""
    due = due_books(P.captures(spark, d), P.SavedLines(spark, d), run_config(spark, d))
    return due.quarantine.select("url", "field", "reason")


@query(
    "progress",
    SQL_RUN
    + """
select (select k from tgt) as target, count(*) filter (verdict is null) as accepted,
  count(*) filter (verdict is not null) as rejected, (select k from tgt) - count(*) as remaining
from judged
""",
)
def progress(spark: SparkSession, d: str) -> DataFrame:
    """The gauge of a run."""
    p = due_books(P.captures(spark, d), P.SavedLines(spark, d), run_config(spark, d)).progress
    row = (p.target, p.accepted, p.rejected, p.remaining)
    return spark.createDataFrame([row], "target bigint, accepted bigint, rejected bigint, remaining bigint")


# ---- pages to values ------------------------------------------------------


@query("url_normalize", "select page_id, split_part(url, 'ref=', 1) as url from pages")
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    """S1 X2."""
    pages = read_pages(spark, f"{d}/pages.parquet")
    return pages.select("page_id", normalize_url(F.col("url")).alias("url"))


@query(
    "listing_links",
    """
with found as (select page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) hrefs from pages),
one as (select page_id, url, hrefs, unnest(generate_series(1, len(hrefs))) i from found)
select page_id as page_no, cast(i - 1 as integer) as pos,
  split_part(regexp_extract(url, '^(https?://[^/?#]*)', 1) || replace(hrefs[i], '&amp;', '&'), 'ref=', 1) as url
from one
""",
)
def listing_links(spark: SparkSession, d: str) -> DataFrame:
    """X0 X1 X2 U1."""
    pages = spread(read_pages(spark, f"{d}/pages.parquet"), "page_id")
    return L.listing_links(pages.withColumnRenamed("page_id", "page_no"), ARTICLES)


@query(
    "page_title",
    """
with raw as (select page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') t from pages),
quotes as (select page_id, regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&#(x27|39);?', '''', 'g') t from raw),
angles as (select page_id, regexp_replace(regexp_replace(t, '&lt;?', '<', 'g'), '&gt;?', '>', 'g') t from quotes)
select page_id, trim(regexp_replace(regexp_replace(t, '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) as title from angles
""",
)
def page_title(spark: SparkSession, d: str) -> DataFrame:
    """X0 X7."""
    pages = spread(read_pages(spark, f"{d}/pages.parquet"), "page_id")
    return pages.select("page_id", extract_blocks("html", ARTICLES.book)["title"].alias("title"))


@query(
    "authors_join",
    """
select page_id, replace(array_to_string(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1), ','),
  '&amp;', '&') as author from pages
""",
)
def authors_join(spark: SparkSession, d: str) -> DataFrame:
    """X0 X10 A6."""
    pages = spread(read_pages(spark, f"{d}/pages.parquet"), "page_id")
    return pages.select("page_id", B.authors(extract_blocks("html", ARTICLES.book)["authors"]).alias("author"))


@query("description_concat", "select doc_id, replace(text, chr(10), '') as description from documents")
def description_concat(spark: SparkSession, d: str) -> DataFrame:
    """X11 A6."""
    docs = P.table(spark, d, "documents")
    return docs.select("doc_id", B.description(F.split("text", "\n")).alias("description"))


@query(
    "bullets_long",
    """
with lines as (select doc_id, string_split(text, chr(10)) l from documents),
one as (select doc_id, l, unnest(generate_series(1, len(l))) i from lines)
select doc_id, cast(i - 1 as integer) as pos, 'Line ' || (i - 1) as label,
  trim(regexp_replace(l[i], '\\s+', ' ', 'g')) as value from one
""",
)
def bullets_long(spark: SparkSession, d: str) -> DataFrame:
    """Each text line becomes one detail bullet of a page."""
    docs = spread(P.table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    escaped = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    items = F.transform(
        F.split(escaped, "\n"),
        lambda line, i: F.concat(
            F.lit("<li><span><span>Line "), i.cast("string"), F.lit("</span><span>"), line, F.lit("</span></span>")
        ),
    )
    page = F.concat(F.lit('<div id="detailBullets_feature_div"><ul>'), joined(items), F.lit("</ul></div>"))
    blocks = docs.select("doc_id", extract_blocks(page, {"bullets": SHOP.book["bullets"]})["bullets"].alias("b"))
    return blocks.select("doc_id", F.posexplode("b").alias("pos", "bullet")).select("doc_id", "pos", "bullet.*")


@query(
    "next_page_flags",
    """
select l_orderkey, l_linenumber, l_suppkey, l_partkey,
  cast(l_linestatus = 'F' as integer) as has_next, cast(l_returnflag = 'R' as integer) as listing_next from lineitem
""",
)
def next_page_flags(spark: SparkSession, d: str) -> DataFrame:
    """X3 X4, on pager item lists."""
    lines = P.table(spark, d, "lineitem")
    pager = F.array(F.lit("a-disabled"), F.when(F.col("l_linestatus") == "F", "a-last").otherwise("a-disabled a-last"))
    strip = F.array(F.lit("true"), F.when(F.col("l_returnflag") != "R", "true"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
        L.has_next_review_page(pager).cast("int").alias("has_next"),
        L.has_next(strip).cast("int").alias("listing_next"),
    )


@query(
    "listing_has_next",
    """
select p_partkey as page_no, 1 as n_links, cast(p_size >= 10 as integer) as has_next from part
""",
)
def listing_has_next(spark: SparkSession, d: str) -> DataFrame:
    """X0 X1 X3 on shop listing pages."""
    pages = P.listing_pages(P.table(spark, d, "part"))
    return L.listing_blocks(pages).select(
        "page_no", F.size("links").alias("n_links"), F.col("has_next").cast("int").alias("has_next")
    )


@query(
    "isbn_lastmatch",
    """
select p_partkey, case when p_size % 2 = 0 then 'ISBN-13-979-' else 'ISBN-13-978-' end || p_partkey as isbn
from part where p_type <> 'SMALL'
union all select p_partkey, null from part where p_type = 'SMALL'
""",
)
def isbn_lastmatch(spark: SparkSession, d: str) -> DataFrame:
    """A second ISBN-13 bullet overrides the first; SMALL parts have none."""
    key, none = F.col("p_partkey").cast("string"), F.lit("0")
    first = F.when(F.col("p_type") != "SMALL", bullet("ISBN-13 :", F.concat(F.lit("978-"), key))).otherwise(
        bullet("ISBN-10 :", none)
    )
    second = F.when(
        (F.col("p_type") != "SMALL") & (F.col("p_size") % 2 == 0), bullet("ISBN-13 :", F.concat(F.lit("979-"), key))
    ).otherwise(bullet("Language :", none))
    bullets = F.array(bullet("Publisher :", F.col("p_brand")), first, second)
    return P.table(spark, d, "part").select("p_partkey", B.isbn(bullets).alias("isbn"))


@query("language_gate", "select doc_id, 'English' as language from documents where lang = 'en'")
def language_gate(spark: SparkSession, d: str) -> DataFrame:
    """X9 V5."""
    tongue = (
        F.when(F.col("lang") == "en", "English").when(F.col("lang") == "de", "German").otherwise(F.lower(F.lit("English")))
    )
    bullets = F.array(bullet("Publisher :", F.col("source")), bullet("Language :", tongue))
    docs = P.table(spark, d, "documents").select("doc_id", B.language(bullets).alias("language"))
    return docs.where(F.col("language") == "English")


@query(
    "pub_date",
    """
select o_orderkey, case when o_orderstatus = 'P' then null else strftime(o_orderdate, '%B %-d %Y') end as date,
  case when o_orderstatus = 'P' then null else strftime(o_orderdate, '%Y-%m-%d') end as pub_date,
  cast(o_orderstatus = 'P' as integer) as bad from orders
""",
)
def pub_date(spark: SparkSession, d: str) -> DataFrame:
    """Orders of status P have no bracketed date."""
    day = F.date_format("o_orderdate", "MMMM d, yyyy")
    tail = F.when(F.col("o_orderstatus") == "P", day).otherwise(F.concat(F.lit("("), day, F.lit(")")))
    bullets = F.array(bullet("Publisher :", F.concat("o_orderpriority", F.lit(" (US); 1st "), tail)))
    orders = P.table(spark, d, "orders").select("o_orderkey", bullets.alias("b"))
    date = B.date(F.col("b"))
    return orders.select(
        "o_orderkey",
        date.alias("date"),
        B.pub_date(date).cast("string").alias("pub_date"),
        B.bad_dates(F.col("b")).cast("int").alias("bad"),
    )


@query(
    "pages_count",
    """
select p_partkey, case when p_type = 'PROMO' then null else p_size end as pages,
  cast(p_type = 'PROMO' as integer) as bad from part
""",
)
def pages_count(spark: SparkSession, d: str) -> DataFrame:
    """PROMO parts write a number that cannot be read."""
    size = F.when(F.col("p_type") == "PROMO", "1,024").otherwise(F.col("p_size").cast("string"))
    bullets = F.array(bullet("Paperback :", F.concat(size, F.lit(" pages"))), bullet("Language :", F.lit("English")))
    return P.table(spark, d, "part").select(
        "p_partkey", B.pages(bullets).alias("pages"), B.bad_pages(bullets).cast("int").alias("bad")
    )


@query(
    "price_by_format",
    """
select p_partkey, case
  when p_type in ('ECONOMY', 'STANDARD') then cast(printf('%.2f', p_retailprice) as double)
  when p_type = 'MEDIUM' then cast(printf('%.2f', p_retailprice / 2) as double)
  when p_type = 'LARGE' then 7.25 end as price from part
""",
)
def price_by_format(spark: SparkSession, d: str) -> DataFrame:
    """Formats by priority, thousands commas and absent formats unreadable."""
    full, half = F.format_string("%.2f", "p_retailprice"), F.format_string("%.2f", F.col("p_retailprice") / 2)
    kind = F.col("p_type")
    text = (
        F.when(kind == "ECONOMY", F.concat(F.lit("Hardcover\n$1.00\nPaperback\nfrom $"), full))
        .when(kind == "STANDARD", F.concat(F.lit("Kindle\n$2.00\nHardcover\n$"), full))
        .when(kind == "MEDIUM", F.concat(F.lit("Hardcover\n$3\nMass Market Paperback\n$"), half, F.lit("\nx")))
        .when(kind == "LARGE", F.lit("Paperback\n$7.25"))
        .when(kind == "PROMO", F.lit("Paperback\n$1,024.00"))
        .otherwise(F.lit("Audiobook\n$5.00\nPaperback bundle\n$6.00"))
    )
    return P.table(spark, d, "part").select("p_partkey", B.price(text).alias("price"))


def products(*rows: tuple[Column | None, Column | None, Column | None]) -> Column:
    names = ("rank", "rating", "count")
    none = F.lit(None).cast("string")
    return F.array(
        *(F.struct(*((none if c is None else c.cast("string")).alias(n) for n, c in zip(names, row))) for row in rows)
    )


@query("bestseller_rank", "select p_partkey, cast(p_partkey + 1 as integer) as best_seller_rank from part")
def bestseller_rank(spark: SparkSession, d: str) -> DataFrame:
    """The last block has no space after the rank and does not count."""
    rank = F.concat(F.lit("Best Sellers Rank: #"), F.format_number(F.col("p_partkey") + 1, 0), F.lit(" in Books (#9)"))
    blocks = products((F.lit("#7 in Toys"), None, None), (rank, None, None), (F.lit("#12"), None, None))
    return P.table(spark, d, "part").select("p_partkey", B.best_seller_rank(blocks).alias("best_seller_rank"))


@query("avg_rating", "select p_partkey, cast(printf('%.1f', p_size / 10) as double) as review_rating from part")
def avg_rating(spark: SparkSession, d: str) -> DataFrame:
    """``5 out`` is not read, so the block before it counts."""
    rating = F.concat(F.format_string("%.1f", F.col("p_size") / 10), F.lit(" out of 5 stars"))
    blocks = products((None, F.lit("1.0 out"), None), (None, rating, None), (None, F.lit("5 out of 5"), None))
    return P.table(spark, d, "part").select("p_partkey", B.review_rating(blocks).alias("review_rating"))


@query("review_count", "select p_partkey, cast(p_partkey * 37 as integer) as review_count from part")
def review_count(spark: SparkSession, d: str) -> DataFrame:
    """X17."""
    count = F.concat(F.format_number(F.col("p_partkey") * 37, 0), F.lit(" ratings"))
    blocks = products((None, None, count), (None, None, F.lit("no ratings")))
    return P.table(spark, d, "part").select("p_partkey", B.review_count(blocks).alias("review_count"))


@query(
    "star_rating",
    """
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case l_returnflag when 'R' then null else cast(floor(l_quantity / 10) as integer) end as rating from lineitem
""",
)
def star_rating_query(spark: SparkSession, d: str) -> DataFrame:
    """Truncated, with other wordings unreadable."""
    stars = F.format_string("%.1f", F.col("l_quantity") / 10)
    text = (
        F.when(F.col("l_returnflag") == "R", F.concat(stars, F.lit(" out of 10 stars")))
        .when(F.col("l_returnflag") == "A", F.concat(stars, F.lit(" out of 5 stars, verified")))
        .otherwise(F.concat(stars, F.lit(" out of 5 stars")))
    )
    text = F.when(F.col("l_returnflag") == "A", F.replace(text, F.lit(", "), F.lit(" "))).otherwise(text)
    return P.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", star_rating(text).alias("rating")
    )


@query("record_id", "select page_id, md5(url) as uuid from pages")
def record_id_query(spark: SparkSession, d: str) -> DataFrame:
    """X19."""
    return read_pages(spark, f"{d}/pages.parquet").select("page_id", record_id(F.col("url")).alias("uuid"))


SQL_VERDICT = """case when p_name like '%gizmo%' then 'title: banned phrase'
    when p_type = 'PROMO' then 'language: not English'
    when p_type = 'ECONOMY' and p_size > 40 then 'pages: not a number' end"""


@query(
    "book_record",
    f"""
select p_name as title, 'ISBN-13-978-' || p_partkey as isbn, md5('https://shop.example/dp/' || p_partkey || '/') as uuid,
  p_brand || ',Second & Co' as author, 'About ' || p_name || '.More.' as description,
  'May ' || (1 + p_size % 28) || ' 2021' as date, p_size * 10 as pages,
  cast(printf('%.2f', p_retailprice) as double) as price, cast(p_partkey + 1 as integer) as best_seller_rank,
  cast(printf('%.1f', p_size / 10) as double) as review_rating, cast(p_partkey * 37 as integer) as review_count,
  'https://shop.example/img/' || p_partkey || '.jpg' as image_url,
  'https://shop.example/dp/' || p_partkey || '/' as book_url
from part where ({SQL_VERDICT}) is null
""",
)
def book_record(spark: SparkSession, d: str) -> DataFrame:
    """X0 X5-X20 V1-V5 V9 on shop book pages."""
    pages = P.book_pages(P.table(spark, d, "part"))
    good, _ = V.split_by_verdict(parse_books(pages, RunConfig(banned_titles=("gizmo",))))
    return good.select(*BOOK.names)


@query(
    "quarantine",
    f"""
with judged as (select p_partkey, {SQL_VERDICT} as verdict from part)
select p_partkey as page_id, 'https://shop.example/dp/' || p_partkey || '/' as url,
  split_part(verdict, ': ', 1) as field, split_part(verdict, ': ', 2) as reason
from judged where verdict is not null
""",
)
def quarantine(spark: SparkSession, d: str) -> DataFrame:
    """V1 V8 V9: why book pages are set aside."""
    pages = P.book_pages(P.table(spark, d, "part"))
    _, bad = V.split_by_verdict(parse_books(pages, RunConfig(banned_titles=("gizmo",))))
    return bad


@query(
    "pages_not_initialised",
    """
with judged as (select p_partkey, case when p_name like '%gizmo%' then 'page: no detail bullets'
    when p_type = 'PROMO' then 'language: not English'
    when p_type = 'ECONOMY' and p_size > 40 then 'pages: not a number' end as verdict from part)
select p_partkey as page_id, split_part(verdict, ': ', 1) as field, split_part(verdict, ': ', 2) as reason
from judged where verdict is not null
""",
)
def pages_not_initialised(spark: SparkSession, d: str) -> DataFrame:
    """V1: pages of some books have lost their bullets."""
    bare = F.when(F.col("html").contains("gizmo"), F.replace("html", F.lit("detailBullets_feature_div"), F.lit("lost")))
    pages = P.book_pages(P.table(spark, d, "part")).withColumn("html", F.coalesce(bare, "html"))
    _, bad = V.split_by_verdict(parse_books(pages))
    return bad.select("page_id", "field", "reason")


@query(
    "extract_reviews",
    """
select l_partkey as isbn, ((l_orderkey * 8 + l_linenumber) * 10000000 + l_suppkey) * 100 + cast(l_quantity as bigint) as page_no, 0 as pos,
  'user-' || l_suppkey as "user", 'Lot ' || l_linenumber || chr(10) || 'of order ' || l_orderkey as "text",
  case when l_returnflag = 'R' then null else cast(floor(l_quantity / 10) as integer) end as rating
from lineitem
""",
)
def extract_reviews_query(spark: SparkSession, d: str) -> DataFrame:
    """X0 X21-X24 V6 on shop review pages."""
    lines = spread(P.table(spark, d, "lineitem"), "l_orderkey", rows=PAGES_A_TASK)
    pages = P.review_pages(lines).withColumn("isbn", F.regexp_extract("book_url", r"/dp/(\d+)/", 1).cast("bigint"))
    return extract_reviews(pages)


@query(
    "reviews_by_position",
    """
with placed as (select *, row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey, l_quantity) - 1 as plc,
  count(*) over (partition by l_partkey) as n from lineitem)
select 'https://shop.example/dp/' || l_partkey || '/' as book_url, plc // 10 + 1 as page_no, cast(plc % 10 as integer) as pos,
  'user-' || l_suppkey as "user", 'Lot ' || l_linenumber || chr(10) || 'of order ' || l_orderkey as "text",
  cast(floor(l_quantity / 10) as integer) as rating, plc // 10 < (n - 1) // 10 as more from placed
""",
)
def reviews_by_position(spark: SparkSession, d: str) -> DataFrame:
    """Pages of ten reviews, each with its position, and what the pager says."""
    keep = ("book_url", "page_no")
    pages = read_review_pages(P.full_review_pages(P.table(spark, d, "lineitem")), keep=keep)
    return reviews_of(pages, keep=(*keep, "more"))


SQL_PAGED = """
with want as (select count(*) // 2 n from part),
tgt as (select n + cast(floor(n * 0.05) as bigint) k from want),
pick as (select *, row_number() over (order by p_partkey) rk from part qualify rk <= (select k from tgt)),
valid as (select * from pick where ({verdict}) is null),
placed as (select l_partkey as isbn, l_suppkey as usr, l_orderkey, l_linenumber, l_quantity,
    row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey, l_quantity) pos
  from lineitem join valid on p_partkey = l_partkey)
"""


def paged_config(spark: SparkSession, d: str, n: int = 20) -> RunConfig:
    return RunConfig(P.table(spark, d, "part").count() // 2, n, ("gizmo",), reviews_per_page=P.PAGE_SIZE, follow_pager=True)


# ---- records and store keys -----------------------------------------------


@query(
    "book_json",
    """
select p_partkey, 'https://shop.example/dp/' || p_partkey || '/' as book_url, p_name as title,
  cast(null as varchar) as author, p_retailprice as price,
  '{"isbn":"ISBN-13-978-' || p_partkey || '","title":"' || p_name || '","author":null,"pages":' || p_size || '}' as record
from part
""",
)
def book_json(spark: SparkSession, d: str) -> DataFrame:
    """Encode, decode, look up."""
    part = P.table(spark, d, "part")
    key = F.col("p_partkey")
    short = F.struct(
        P.isbn(key).alias("isbn"),
        F.col("p_name").alias("title"),
        F.lit(None).cast("string").alias("author"),
        F.col("p_size").alias("pages"),
    )
    books = part.select(
        key.cast("string").alias("uuid"),
        P.isbn(key).alias("isbn"),
        F.col("p_name").alias("title"),
        F.lit(None).cast("string").alias("author"),
        F.col("p_retailprice").alias("price"),
        P.book_url(key).alias("book_url"),
        F.to_json(short, {"ignoreNullFields": "false"}).alias("description"),
    )
    encoded = to_json_records(books)
    decoded = from_json_records(encoded.withColumn("value", F.col("value")), BOOK)
    with_url = encoded.select(book_url_of(F.col("value")).alias("looked_up"), F.from_json("value", BOOK).alias("r"))
    assert decoded.schema.names == BOOK.names
    return with_url.select(
        F.col("r.uuid").cast("bigint").alias("p_partkey"),
        F.col("looked_up").alias("book_url"),
        "r.title",
        "r.author",
        "r.price",
        F.col("r.description").alias("record"),
    )


@query(
    "store_paths",
    """
select l_orderkey, l_linenumber, 'ISBN-13-978-' || l_partkey as isbn, 'json user ' || l_suppkey as "user" from lineitem
""",
)
def store_paths(spark: SparkSession, d: str) -> DataFrame:
    """Under a root prefix, with a user name that holds ``json``."""
    path = F.concat(
        F.lit("s3a://store/some/prefix/raw_data/"),
        P.isbn(F.col("l_partkey")),
        F.lit("/reviews/json user "),
        F.col("l_suppkey").cast("string"),
        F.lit(".json"),
    )
    return P.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", isbn_of_path(path).alias("isbn"), user_of_path(path).alias("user")
    )


@query(
    "image_manifest",
    """
select cast(d.doc_id as varchar) as isbn,
  case when lang = 'es' then null else 'https://shop.example/img/' || d.doc_id || '.jpg' end as image_url,
  'raw_data/' || d.doc_id || '/' || d.doc_id || '.jpg' as target_key,
  case when l.doc_id is not null then 'landed' when lang = 'es' then 'no url' else 'missing' end as status
from documents d left join (select distinct doc_id from labels) l on l.doc_id = d.doc_id
""",
)
def image_manifest_query(spark: SparkSession, d: str) -> DataFrame:
    """Documents are books, labelled ones have their cover."""
    key = F.col("doc_id").cast("string")
    url = F.when(F.col("lang") != "es", F.concat(F.lit(f"{P.SITE}/img/"), key, F.lit(".jpg")))
    books = P.table(spark, d, "documents").select(key.alias("isbn"), url.alias("image_url"))
    return image_manifest(books, P.table(spark, d, "labels").select(key.alias("isbn")))


# ---- validation -----------------------------------------------------------


@query(
    "banned_titles",
    "select p_partkey, p_name from part where p_name not like '%gizmo%' and p_name not like '%blue%'",
)
def banned_titles(spark: SparkSession, d: str) -> DataFrame:
    """V3: substring match, case-sensitive."""
    part = P.table(spark, d, "part").select("p_partkey", "p_name")
    return part.where(~V.banned(F.col("p_name"), ["gizmo", "blue", "Red"]))


@query(
    "banned_titles_many",
    """
select p_partkey, p_name from part
where not exists (select 1 from generate_series(11, 50) g(i) where contains(p_name || ' no ' || p_size, 'no ' || i))
""",
)
def banned_titles_many(spark: SparkSession, d: str) -> DataFrame:
    """V3 with a long phrase list."""
    title = F.concat_ws(" no ", "p_name", F.col("p_size").cast("string"))
    kept = P.table(spark, d, "part").where(~V.banned(title, [f"no {i}" for i in range(11, 51)]))
    return kept.select("p_partkey", "p_name")


@query(
    "banned_titles_table",
    """
with phrases as (select distinct 'no ' || (l_orderkey * 7 + l_linenumber) || ' ' as phrase from lineitem),
titles as (select p_partkey, p_name || ' no ' || (p_partkey * 3 + p_size) || ' of ' || p_brand as title from part)
select p_partkey, title from titles where not exists (select 1 from phrases where contains(title, phrase))
""",
)
def banned_titles_table(spark: SparkSession, d: str) -> DataFrame:
    """V3: phrases from a table, as many as there are lines."""
    lines = P.table(spark, d, "lineitem")
    phrases = lines.select(F.concat(F.lit("no "), (F.col("l_orderkey") * 7 + F.col("l_linenumber")).cast("string"), F.lit(" ")).alias("phrase"))
    title = F.concat("p_name", F.lit(" no "), (F.col("p_partkey") * 3 + F.col("p_size")).cast("string"), F.lit(" of "), "p_brand")
    titles = P.table(spark, d, "part").select("p_partkey", title.alias("title"))
    return without(titles, V.titles_holding(titles, "p_partkey", "title", phrases, "phrase"), "p_partkey")


@query(
    "reject_reason",
    """
select p_partkey, case
  when nullif(p_type, 'SMALL') is null then 'title'
  when p_name like '%gizmo%' then 'banned'
  when p_size = 7 then 'isbn'
  when p_type <> 'LARGE' then 'language' end as reject_reason from part
""",
)
def reject_reason(spark: SparkSession, d: str) -> DataFrame:
    """V2 V4 V5 V9: the first failing rule."""
    title = F.nullif(F.col("p_type"), F.lit("SMALL"))
    verdict = V.first_failure(
        V.rule(title.isNull(), "title", "missing"),
        V.rule(V.banned(F.col("p_name"), ["gizmo"]), "banned", "phrase"),
        V.rule(F.nullif(F.col("p_size"), F.lit(7)).isNull(), "isbn", "missing"),
        V.rule(F.col("p_type") != "LARGE", "language", "other"),
    )
    return P.table(spark, d, "part").select("p_partkey", verdict["field"].alias("reject_reason"))


@query(
    "all_reject_reasons",
    """
select p_partkey, concat_ws(',', case when p_type = 'SMALL' then 'title' end,
  case when p_name like '%gizmo%' then 'banned' end, case when p_size = 7 then 'isbn' end) as reasons from part
""",
)
def all_reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    """V8: every failing rule."""
    reasons = V.all_failures(
        title=F.col("p_type") == "SMALL", banned=V.banned(F.col("p_name"), ["gizmo"]), isbn=F.col("p_size") == 7
    )
    return P.table(spark, d, "part").select("p_partkey", F.array_join(reasons, ",").alias("reasons"))


@query(
    "review_required",
    """
select conv_id, turn, role as "user", text from conversations
where role <> 'system' and not (role = 'assistant' and turn = 1) and text is not null
""",
)
def review_required(spark: SparkSession, d: str) -> DataFrame:
    """V6: system turns lose their user, first answers their text."""
    rows = P.table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.nullif(F.col("role"), F.lit("system")).alias("user"),
        F.when((F.col("role") != "assistant") | (F.col("turn") != 1), F.col("text")).alias("text"),
    )
    return complete_reviews(rows)


# ---- counts, joins --------------------------------------------------------


@query("reviews_per_book_rows", "select l_partkey as isbn, count(*) as n from lineitem group by l_partkey")
def reviews_per_book_rows(spark: SparkSession, d: str) -> DataFrame:
    """A1."""
    return C.reviews_per_book(all_lines(spark, d), "rows")


@query(
    "reviews_per_book_users",
    f"""
select p_partkey as isbn, count(distinct usr) as n from part left join ({SQL_SAVED}) s on s.isbn = p_partkey
group by p_partkey
""",
)
def reviews_per_book_users(spark: SparkSession, d: str) -> DataFrame:
    """A1 by distinct user, with books that have none."""
    isbns = P.table(spark, d, "part").select(F.col("p_partkey").alias("isbn"))
    return C.reviews_per_book(saved_lines(spark, d), "users", isbns)


def part_books(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey")
    return P.table(spark, d, "part").select(key.alias("isbn"), P.book_url(key).alias("book_url"))


@query(
    "satisfied_books_rows",
    f"""
select isbn, 'https://shop.example/dp/' || isbn || '/' as book_url, count(*) as n
from ({SQL_SAVED}) s join part on p_partkey = isbn group by isbn having count(*) >= 12
""",
)
def satisfied_books_rows(spark: SparkSession, d: str) -> DataFrame:
    """A3 J4 O6."""
    urls = C.satisfied_urls(C.reviews_per_book(saved_lines(spark, d)), part_books(spark, d), 12)
    return C.by_popularity(urls)


@query(
    "satisfied_books_users",
    f"""
select isbn, 'https://shop.example/dp/' || isbn || '/' as book_url, count(distinct usr) as n
from ({SQL_SAVED}) s join part on p_partkey = isbn group by isbn having count(distinct usr) >= 12
""",
)
def satisfied_books_users(spark: SparkSession, d: str) -> DataFrame:
    """A3 J4 O6 by distinct user."""
    counts = C.reviews_per_book(saved_lines(spark, d), "users", part_books(spark, d))
    return C.by_popularity(C.satisfied_urls(counts, part_books(spark, d), 12))


@query(
    "orphan_lookup",
    """
select cast(null as bigint) as page_id, cast(null as varchar) as url, 'isbn' as field,
  'reviews without attributes: ' || l_partkey as reason
from lineitem left join part on p_partkey = l_partkey and p_type <> 'SMALL'
group by l_partkey having count(p_partkey) = 0 and count(*) >= 20
""",
)
def orphan_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Satisfied books whose attributes are missing."""
    books = P.table(spark, d, "part").where("p_type <> 'SMALL'")
    books = books.select(F.col("p_partkey").alias("isbn"), P.book_url(F.col("p_partkey")).alias("book_url"))
    counts = C.reviews_per_book(all_lines(spark, d))
    return C.orphans(counts, books, 20)


@query("distinct_isbns", "select distinct l_partkey as isbn from lineitem")
def distinct_isbns(spark: SparkSession, d: str) -> DataFrame:
    """A2 U3 S7."""
    return C.distinct_isbns(all_lines(spark, d))


@query(
    "saved_users_of",
    f"select isbn, usr as \"user\" from ({SQL_SAVED}) s where isbn in (select p_partkey from part where p_type = 'PROMO')",
)
def saved_users_of(spark: SparkSession, d: str) -> DataFrame:
    """The reviewers of many books in one join."""
    isbns = P.table(spark, d, "part").where("p_type = 'PROMO'").select(F.col("p_partkey").alias("isbn"))
    return saved_users(saved_lines(spark, d), isbns)


@query(
    "new_attributes",
    """
select isbn, doc_id, n_chars from (select source || '-' || (n_chars // 10) as isbn, doc_id, n_chars,
    row_number() over (partition by source || '-' || (n_chars // 10) order by doc_id) rn
  from documents where source || '-' || (n_chars // 10) not in
    (select source || '-' || (n_chars // 10) from documents join labels using (doc_id))) t where rn = 1
""",
)
def new_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Keys not saved yet, one row each; labelled documents are the saved ones."""
    docs = P.table(spark, d, "documents").select(
        F.concat_ws("-", "source", F.expr("n_chars div 10").cast("string")).alias("isbn"), "doc_id", "n_chars"
    )
    saved = members(docs, P.table(spark, d, "labels"), "doc_id")
    return unseen(docs, saved, "isbn", ["doc_id"])


@query(
    "store_membership",
    f"select p_partkey as isbn, p_name from part where p_partkey in (select isbn from ({SQL_SAVED}) s)",
)
def store_membership(spark: SparkSession, d: str) -> DataFrame:
    """J6."""
    books = P.table(spark, d, "part").select(F.col("p_partkey").alias("isbn"), "p_name")
    return members(books, saved_lines(spark, d), "isbn")


@query(
    "new_reviews",
    f"""
with saved as ({SQL_SAVED})
select isbn, usr as "user", rating, l_orderkey, l_linenumber from ({SQL_FRESH}) f
where not exists (select 1 from saved s where s.isbn = f.isbn and s.usr = f.usr)
""",
)
def new_reviews(spark: SparkSession, d: str) -> DataFrame:
    """J3 V7."""
    return without(fresh_lines(spark, d), saved_lines(spark, d), ["isbn", "user"])


@query(
    "saved_counts",
    f"""
select p_partkey as isbn, count(usr) as saved from part left join ({SQL_SAVED}) s on s.isbn = p_partkey
group by p_partkey
""",
)
def saved_counts(spark: SparkSession, d: str) -> DataFrame:
    """J5."""
    books = P.table(spark, d, "part").select(F.col("p_partkey").alias("isbn"))
    return with_saved_count(books, C.reviews_per_book(saved_lines(spark, d)))


# ---- order, quota, frontier -----------------------------------------------


@query("review_quota", SQL_QUOTA + 'select isbn, usr as "user", rating, pos as position from filled')
def review_quota(spark: SparkSession, d: str) -> DataFrame:
    """J3 J5 O1 P5."""
    filled = fill_reviews(fresh_lines(spark, d), saved_lines(spark, d), 16, ARRIVAL)
    return filled.select("isbn", "user", "rating", "position")


@query(
    "review_quota_distinct_users",
    f"""
with saved as ({SQL_SAVED}), fresh as ({SQL_FRESH}),
saved_cnt as (select isbn, count(*) n from saved group by isbn),
once as (select *, row_number() over (partition by isbn, usr order by l_orderkey, l_linenumber, rating) nth from fresh),
cand as (select f.isbn, f.usr, f.rating,
    row_number() over (partition by f.isbn order by f.l_orderkey, f.l_linenumber, f.usr, f.rating) pos,
    greatest(16 - coalesce(sc.n, 0), 0) quota
  from once f left join saved_cnt sc on sc.isbn = f.isbn
  where nth = 1 and not exists (select 1 from saved s where s.isbn = f.isbn and s.usr = f.usr))
select isbn, usr as "user", rating, pos as position from cand where pos <= quota
""",
)
def review_quota_distinct_users(spark: SparkSession, d: str) -> DataFrame:
    """O1 with each user counted once."""
    filled = fill_reviews(fresh_lines(spark, d), saved_lines(spark, d), 16, ARRIVAL, dedup_first=True)
    return filled.select("isbn", "user", "rating", "position")


@query(
    "nested_books",
    SQL_QUOTA
    + """
select isbn, count(*) as n_reviews, string_agg(usr || ':' || cast(rating as integer), ',' order by pos) as reviews
from filled group by isbn
""",
)
def nested_books(spark: SparkSession, d: str) -> DataFrame:
    """A5: a book's new reviews in order, written out as text to compare."""
    nested = nest_reviews(review_quota(spark, d))
    items = F.transform(
        "reviews", lambda r: F.concat_ws(":", r["user"].cast("string"), r["rating"].cast("int").cast("string"))
    )
    return nested.select("isbn", F.size("reviews").cast("bigint").alias("n_reviews"), F.array_join(items, ",").alias("reviews"))


@query(
    "listing_pages_needed",
    """
with counted as (select page_id as page_no, len(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) as n_new from pages),
running as (select page_no, n_new,
  sum(n_new) over (order by page_no rows between unbounded preceding and 1 preceding) as before from counted)
select page_no, cast(n_new as integer) as n_new from running where before is null or before < 500
""",
)
def listing_pages_needed(spark: SparkSession, d: str) -> DataFrame:
    """O3: listing pages to read for 500 links."""
    pages = spread(read_pages(spark, f"{d}/pages.parquet"), "page_id")
    links = F.regexp_count("html", F.lit('<li><a href="[^"]*">'))
    counted = pages.select(F.col("page_id").alias("page_no"), links.alias("n_new"))
    return L.pages_needed(counted, 500)


@query(
    "listing_pages_sparse",
    """
with running as (select p_partkey as page_no, p_size as n_new,
  sum(p_size) over (order by p_partkey rows between unbounded preceding and 1 preceding) as before from part)
select page_no * 1000000000000000 as page_no, cast(n_new as integer) as n_new from running
where before is null or before < (select sum(p_size) // 2 from part)
""",
)
def listing_pages_sparse(spark: SparkSession, d: str) -> DataFrame:
    """O3: pages to read for half of all links, with page numbers 10^15 apart."""
    part = P.table(spark, d, "part")
    ends = part.agg(F.floor(F.sum("p_size") / 2).alias("half"), F.max(F.abs("p_partkey")).alias("last")).first()
    # Numbers that far apart leave the range of a bigint with some 9,000 pages.
    kind = "bigint" if (ends["last"] or 0) * 10**15 < 2**63 else "decimal(38,0)"
    number = F.col("p_partkey").cast(kind) * F.lit(10**15).cast("bigint" if kind == "bigint" else "decimal(16,0)")
    counted = part.select(number.cast(kind).alias("page_no"), F.col("p_size").cast("int").alias("n_new"))
    return L.pages_needed(counted, ends["half"])


@query(
    "review_pages_needed",
    """
with running as (select conv_id as isbn, turn as page_no, length(text) as n_new,
  sum(length(text)) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as before
  from conversations)
select isbn, page_no, n_new from running where before is null or before < 600
""",
)
def review_pages_needed(spark: SparkSession, d: str) -> DataFrame:
    """Turns of each conversation to read for 600 characters."""
    turns = P.table(spark, d, "conversations").select(
        F.col("conv_id").alias("isbn"), F.col("turn").alias("page_no"), F.length("text").cast("bigint").alias("n_new")
    )
    return L.pages_needed(turns, 600, by=["isbn"])


@query(
    "popular_topk",
    """
select l_partkey as isbn, count(*) as review_count, row_number() over (order by count(*) desc, l_partkey) as rank
from lineitem group by l_partkey qualify rank <= 100
""",
)
def popular_topk(spark: SparkSession, d: str) -> DataFrame:
    """A top-100 report."""
    counts = C.reviews_per_book(all_lines(spark, d)).withColumnRenamed("n", "review_count")
    return L.most_reviewed(counts, 100)


@query(
    "frontier",
    f"""
with done as (select isbn from ({SQL_SAVED}) s group by isbn having count(*) >= 12)
select l_orderkey as page_no, l_linenumber as pos, l_partkey as url, l_suppkey,
  row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey) as rank
from lineitem where l_partkey not in (select isbn from done)
qualify rank <= (select count(*) // 2 from lineitem)
""",
)
def frontier_query(spark: SparkSession, d: str) -> DataFrame:
    """The first half as many links as there are lines; repeats are kept."""
    saved = saved_lines(spark, d)
    done = C.satisfied_books(C.reviews_per_book(saved), 12).withColumnRenamed("isbn", "url")
    lines = P.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("page_no"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("url"), "l_suppkey"
    )
    return L.frontier(lines, done, lines.count() // 2, order=["page_no", "pos", "url", "l_suppkey"])


@query(
    "remaining_work",
    "select p_partkey as isbn, count(*) over () - row_number() over (order by p_size desc, p_partkey) as remaining from part",
)
def remaining_work(spark: SparkSession, d: str) -> DataFrame:
    """Books left after each one, in work order."""
    ranked = global_rank(P.table(spark, d, "part").select("p_partkey", "p_size"), [F.desc("p_size"), "p_partkey"])
    total = ranked.agg(F.max("rank")).scalar()
    return ranked.select(F.col("p_partkey").alias("isbn"), (total - F.col("rank")).alias("remaining"))


@query(
    "work_target",
    f"""
with done as (select isbn from ({SQL_SAVED}) s group by isbn having count(*) >= 12),
want as (select cast(floor(0.75 * count(*)) as bigint) num_books from part),
need as (select num_books, (select count(*) from done) satisfied from want)
select num_books, satisfied, greatest(num_books - satisfied, 0) as missing,
  greatest(num_books - satisfied, 0) + cast(floor(greatest(num_books - satisfied, 0) * 0.05) as bigint) as target
from need
""",
)
def work_target(spark: SparkSession, d: str) -> DataFrame:
    """P1 A4."""
    done = C.satisfied_books(C.reviews_per_book(saved_lines(spark, d)), 12)
    want = P.table(spark, d, "part").agg(F.floor(0.75 * F.count("*")).cast("bigint").alias("num_books"))
    return C.work_target_row(done, want)


# ---- sinks ----------------------------------------------------------------

SQL_LAST = """
select isbn, "user", rating, l_orderkey, l_linenumber from (
  select l_partkey as isbn, l_suppkey as "user", l_quantity as rating, l_orderkey, l_linenumber,
    row_number() over (partition by l_partkey, l_suppkey order by l_orderkey desc, l_linenumber desc, l_quantity desc) rn
  from lineitem) t where rn = 1
"""


@query("upsert_last_write", SQL_LAST)
def upsert_last_write(spark: SparkSession, d: str) -> DataFrame:
    """W2a."""
    return last_write(all_lines(spark, d), ["isbn", "user"], ["l_orderkey", "l_linenumber", "rating"])


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def review_rows(lines: DataFrame) -> DataFrame:
    return lines.select(
        P.isbn(F.col("isbn")).alias("isbn"),
        F.concat_ws(" ", F.lit("order"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("text"),
        F.col("rating").cast("int").alias("rating"),
        F.concat(F.lit("user-"), F.col("user").cast("string")).alias("user"),
        "l_orderkey",
        "l_linenumber",
    )


@query(
    "upsert_store",
    """
select 'ISBN-13-978-' || isbn as isbn, 'order ' || l_orderkey || ' ' || l_linenumber as text,
  cast(rating as integer) as rating, 'user-' || usr as "user" from (
  select l_partkey isbn, l_suppkey usr, l_quantity rating, l_orderkey, l_linenumber,
    row_number() over (partition by l_partkey, l_suppkey order by l_shipdate >= timestamp '1998-01-01 00:00:00' desc,
      l_orderkey desc, l_linenumber desc, l_quantity desc) rn
  from lineitem) t where rn = 1
""",
)
def upsert_store(spark: SparkSession, d: str) -> DataFrame:
    """Saved lines are stored, then later lines upserted over them."""
    log = KeyedLog(spark, scratch(spark, "upsert"), REVIEW)
    for lines in (saved_lines(spark, d), fresh_lines(spark, d)):
        log.append(review_rows(lines), ("l_orderkey", "l_linenumber", "rating"))
    return log.read()


@query("upsert_store_compacted", SQL["upsert_store"])
def upsert_store_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The same rows after saved lines were merged into the base of their buckets."""
    log = KeyedLog(spark, scratch(spark, "merged"), REVIEW)
    log.append(review_rows(saved_lines(spark, d)), ("l_orderkey", "l_linenumber", "rating"))
    log.compact()
    log.append(review_rows(fresh_lines(spark, d)), ("l_orderkey", "l_linenumber", "rating"))
    return log.read()


@query("upsert_by_bucket", SQL["upsert_store"])
def upsert_by_bucket(spark: SparkSession, d: str) -> DataFrame:
    """The other form, which rewrites the buckets that a batch touches."""
    path = scratch(spark, "buckets")
    for lines in (saved_lines(spark, d), fresh_lines(spark, d)):
        upsert(spark, review_rows(lines), path, REVIEW, arrival=("l_orderkey", "l_linenumber", "rating"), buckets=8)
    return read_bucketed(spark, path, REVIEW).select(*REVIEW.names)


@query(
    "store_round_trip",
    """
select 'ISBN-13-978-' || isbn as isbn, 'order ' || l_orderkey || ' ' || l_linenumber as text,
  cast(rating as integer) as rating, 'user-' || usr as "user" from (
  select l_partkey isbn, l_suppkey usr, l_quantity rating, l_orderkey, l_linenumber,
    row_number() over (partition by l_partkey, l_suppkey order by l_orderkey desc, l_linenumber desc, l_quantity desc) rn
  from lineitem) t where rn = 1
""",
)
def store_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Records written by one run are the next run's saved state."""
    store = FileStore(spark, scratch(spark, "store"))
    lines = review_rows(all_lines(spark, d))
    place = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000 + F.col("rating")
    books = P.SavedLines(spark, d).attributes().select(
        *(F.col(f.name) if f.name in ("isbn", "title", "book_url") else F.lit(None).cast(f.dataType).alias(f.name) for f in BOOK)
    )
    store.write(books, lines.withColumn("position", place), "run-1")
    return members(store.reviews(), store.attributes(), "isbn")


def table_store(spark: SparkSession) -> TableStore:
    """A store of new catalog tables."""
    mark = uuid.uuid4().hex
    return TableStore(spark, *(f"{kind}_{mark}" for kind in ("books", "reviews", "rejects")))


@query("table_store_isbns", "select 'ISBN-13-978-' || p_partkey as isbn from part")
def table_store_isbns(spark: SparkSession, d: str) -> DataFrame:
    """A missing table reads as empty; a second run adds only what is not saved."""
    store = table_store(spark)
    books = P.SavedLines(spark, d).attributes().select(
        *(F.col(f.name) if f.name in ("isbn", "title", "book_url") else F.lit(None).cast(f.dataType).alias(f.name) for f in BOOK)
    )
    none = spark.createDataFrame([], REVIEW)
    for batch in ("run-1", "run-2"):
        store.write(unseen(books, store.attributes(batch), "isbn", ["isbn"]), none, batch)
    return saved_isbns(read_table(spark, store.names[0]))


@query(
    "table_store_reviews",
    """
select 'ISBN-13-978-' || l_partkey as isbn, 'order ' || l_orderkey || ' ' || l_linenumber as text,
  cast(l_quantity as integer) as rating, 'user-' || l_suppkey as "user" from lineitem
""",
)
def table_store_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews of two runs in one table; the second run is repeated and replaces its rows."""
    store = table_store(spark)
    none = spark.createDataFrame([], "struct<{}>".format(", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in BOOK)))
    runs = (("run-1", saved_lines(spark, d)), ("run-2", fresh_lines(spark, d)), ("run-2", fresh_lines(spark, d)))
    for batch, lines in runs:
        store.write(none, review_rows(lines), batch)
    return store.reviews()


@query(
    "conformed_reviews",
    """
select 'ISBN-13-978-' || l_partkey as isbn, l_returnflag as text, cast(l_linenumber % 6 as integer) as rating,
  'user-' || l_suppkey as "user" from lineitem
""",
)
def conformed_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Columns in another order, of a narrower type, beside others, brought to the contract."""
    rows = P.table(spark, d, "lineitem").select(
        F.concat(F.lit("user-"), F.col("l_suppkey").cast("string")).alias("user"),
        (F.col("l_linenumber") % 6).cast("smallint").alias("rating"),
        "l_orderkey",
        F.col("l_returnflag").alias("text"),
        P.isbn(F.col("l_partkey")).alias("isbn"),
    )
    return conform(rows, REVIEW)


@query(
    "stream_increment",
    """
with placed as (select l_partkey isbn, l_suppkey usr, l_quantity rating, l_orderkey, l_linenumber,
    row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey, l_quantity) pos from lineitem),
kept as (select *, row_number() over (partition by isbn, usr order by pos desc) rn from placed where pos <= 16)
select 'ISBN-13-978-' || isbn as isbn, 'order ' || l_orderkey || ' ' || l_linenumber as text,
  cast(rating as integer) as rating, 'user-' || usr as "user" from kept where rn = 1
""",
)
def stream_increment(spark: SparkSession, d: str) -> DataFrame:
    """A stream over the line files, refilling quotas batch by batch."""
    schema = P.table(spark, d, "lineitem").schema
    # A stream source takes a folder or a pattern; this one fits one file or a folder.
    lines = spark.readStream.schema(schema).parquet(f"{d}/lineitem[.]parquet")
    reviews = review_rows(line_reviews(lines)).withColumn("supplier", F.regexp_extract("user", r"(\d+)$", 1).cast("bigint"))
    store = FileStore(spark, scratch(spark, "stream"))
    order = ["l_orderkey", "l_linenumber", "supplier", "rating"]
    fill_reviews_stream(reviews, store, 16, order, scratch(spark, "stream-state")).awaitTermination()
    return store.reviews()


SQL_FIRST_RUN = f"""
with want as (select count(*) // 2 n from part),
tgt as (select n + cast(floor(n * 0.05) as bigint) k from want),
pick as (select *, row_number() over (order by p_partkey) rk from part qualify rk <= (select k from tgt)),
valid as (select * from pick where ({SQL_VERDICT}) is null)
"""


def first_run_config(spark: SparkSession, d: str) -> RunConfig:
    return RunConfig(P.table(spark, d, "part").count() // 2, 4, ("gizmo",))


@query(
    "first_run_attributes",
    SQL_FIRST_RUN
    + """
select 'ISBN-13-978-' || p_partkey as isbn, p_name as title, p_size * 10 as pages,
  cast(printf('%.2f', p_retailprice) as double) as price, 'https://shop.example/dp/' || p_partkey || '/' as book_url
from valid
""",
)
def first_run_attributes(spark: SparkSession, d: str) -> DataFrame:
    """A run into two empty stores, read back from the JSON one."""
    parquet, json = (FileStore(spark, scratch(spark, "first"), kind) for kind in ("parquet", "json"))
    run_and_publish(P.all_captures(spark, d), parquet, json, first_run_config(spark, d))
    return json.attributes().select("isbn", "title", "pages", "price", "book_url")


@query("repeated_batch_two_stores", SQL["first_run_attributes"])
def repeated_batch_two_stores(spark: SparkSession, d: str) -> DataFrame:
    """One batch is worked twice, with a raw and a relational store; the raw one is read back."""
    raw, mark = FileStore(spark, scratch(spark, "twice")), uuid.uuid4().hex
    tables = TableStore(spark, *(f"{kind}_{mark}" for kind in ("books", "reviews", "rejects")))
    for _ in range(2):
        run_and_publish(P.all_captures(spark, d), raw, tables, first_run_config(spark, d), batch="b0")
    both = members(raw.attributes(), tables.attributes(), "isbn")
    return both.select("isbn", "title", "pages", "price", "book_url")


@query(
    "run_increment_stream",
    SQL_FIRST_RUN
    + """
, placed as (select l_partkey as isbn, l_suppkey as usr, l_orderkey, l_linenumber,
    row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey, l_quantity) pos
  from lineitem join valid on p_partkey = l_partkey),
kept as (select *, row_number() over (partition by isbn, usr order by pos desc) rn from placed where pos <= 4)
select 'ISBN-13-978-' || isbn as isbn, 'user-' || usr as "user",
  'Lot ' || l_linenumber || chr(10) || 'of order ' || l_orderkey as text from kept where rn = 1
""",
)
def run_increment_stream_query(spark: SparkSession, d: str) -> DataFrame:
    """The same run over a stream of landed captures."""
    landing, store = scratch(spark, "landing"), FileStore(spark, scratch(spark, "streamed"))
    P.landed(P.all_captures(spark, d)).write.option("compression", "zstd").parquet(landing)
    state = scratch(spark, "stream-state")
    run_increment_stream(spark, landing, state, store, config=first_run_config(spark, d)).awaitTermination()
    return store.reviews().select("isbn", "user", "text")


@query(
    "run_follows_pager",
    SQL_PAGED.format(verdict=SQL_VERDICT)
    + """
select 'ISBN-13-978-' || isbn as isbn, 'user-' || usr as "user", pos as position,
  'Lot ' || l_linenumber || chr(10) || 'of order ' || l_orderkey as "text" from placed where pos <= 20
""",
)
def run_follows_pager(spark: SparkSession, d: str) -> DataFrame:
    """A run that reads pages of ten until it has its reviews or the pager ends."""
    run = run_increment(P.paged_captures(spark, d), FileStore(spark, scratch(spark, "paged")), paged_config(spark, d))
    return run.reviews.select("isbn", "user", "position", "text")


@query(
    "exhausted_books",
    SQL_PAGED.format(verdict=SQL_VERDICT)
    + """
select 'https://shop.example/dp/' || isbn || '/' as book_url, (count(*) - 1) // 10 + 1 as pages
from placed group by isbn having count(*) < 20
""",
)
def exhausted_books(spark: SparkSession, d: str) -> DataFrame:
    """The books that a run marks as read to the end."""
    store = FileStore(spark, scratch(spark, "ended"))
    run_and_publish(P.paged_captures(spark, d), store, config=paged_config(spark, d))
    return store.exhausted().select("book_url", "pages")


@query(
    "counts_kept_by_batch",
    """
select 'ISBN-13-978-' || l_partkey as isbn, count(distinct l_suppkey) as n from lineitem group by l_partkey
""",
)
def counts_kept_by_batch(spark: SparkSession, d: str) -> DataFrame:
    """A1: three batches, the second written twice; counts come from what each has added, reviews are not read."""
    store = FileStore(spark, scratch(spark, "counted"))
    lines = review_rows(all_lines(spark, d)).withColumn("position", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    none = spark.createDataFrame([], "struct<{}>".format(", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in BOOK)))
    for part in (0, 1, 1, 2):
        name = f"run-{part}"
        new = without(lines.where(F.col("l_orderkey") % 3 == part), store.reviews(name), ["isbn", "user"])
        store.write(none, new, name)
    return store.counts("rows")


SQL_STREAMED = SQL["run_increment_stream"]


@query("stream_in_any_order", SQL_STREAMED)
def stream_in_any_order(spark: SparkSession, d: str) -> DataFrame:
    """Captures land in four pieces, review pages before their books and listing pages last, one piece a batch.

    A piece is one file, or of many pages as many as there are cores, so that no task writes it alone.
    """
    landing, store = scratch(spark, "landing"), FileStore(spark, scratch(spark, "pieces"))
    pages = P.landed(P.all_captures(spark, d))
    files = max(1, min(P.table(spark, d, "lineitem").count() // 1_000_000, spark.sparkContext.defaultParallelism))
    review = F.col("kind") == "review"
    for part in (review & (F.col("page_id") % 2 == 1), review & (F.col("page_id") % 2 == 0), F.col("kind") == "book", F.col("kind") == "listing"):
        pages.where(part).coalesce(files).write.mode("append").option("compression", "zstd").parquet(landing)
    state = scratch(spark, "pieces-state")
    run_increment_stream(
        spark, landing, state, store, config=first_run_config(spark, d), files_per_batch=files
    ).awaitTermination()
    return store.reviews().select("isbn", "user", "text")


class StoppedStore(FileStore):
    """A store that cannot be written, as when a job is lost between two stores."""

    def stage(self, attributes: DataFrame, reviews: DataFrame, batch: str) -> None:
        raise RuntimeError("stopped between the stores")


@query("retried_run_two_stores", SQL_STREAMED)
def retried_run_two_stores(spark: SparkSession, d: str) -> DataFrame:
    """A run is lost between its stores and repeated without a name; the reviews of both stores are those of one run."""
    raw, other = FileStore(spark, scratch(spark, "raw")), scratch(spark, "relational")
    pages, config = P.all_captures(spark, d), first_run_config(spark, d)
    try:
        run_and_publish(pages, raw, StoppedStore(spark, other), config)
    except RuntimeError:
        if not raw.reviews().isEmpty():
            raise
    relational = FileStore(spark, other)
    run_and_publish(pages, raw, relational, config)
    both = raw.reviews().select("isbn", "user", "text")
    return members(both, relational.reviews(), ["isbn", "user"])


@query(
    "landed_covers",
    """
select 'ISBN-13-978-' || p_partkey as isbn, 'https://shop.example/img/' || p_partkey || '.jpg' as image_url,
  case when p_size % 2 = 0 then 'landed' else 'missing' end as status from part
""",
)
def landed_covers(spark: SparkSession, d: str) -> DataFrame:
    """Covers that land after a run are found when the manifest is read; nothing is rewritten."""
    part = P.table(spark, d, "part")
    have = part.where("p_size % 2 = 0").select(P.isbn(F.col("p_partkey")).alias("isbn"))
    covers = part.select(
        P.isbn(F.col("p_partkey")).alias("isbn"),
        F.concat(F.lit(f"{P.SITE}/img/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("image_url"),
    )
    path = scratch(spark, "covers")
    image_manifest(covers, have.limit(0)).write.parquet(path)  # as a run writes it, before any has landed
    written = spark.read.parquet(path)
    return image_manifest(written.select("isbn", "image_url"), have).select("isbn", "image_url", "status")


@query(
    "run_most_reviewed",
    SQL_RUN.replace("row_number() over (order by p_partkey) rk from part", "row_number() over (order by p_partkey desc) rk from part")
    + """
select 'https://shop.example/dp/' || isbn || '/' as url, coalesce(verdict, 'due') as verdict from judged
""",
)
def run_most_reviewed(spark: SparkSession, d: str) -> DataFrame:
    """A run over the most reviewed of the listed books; pages of parts have more reviews the higher their key."""
    due = due_books(P.captures(spark, d), P.SavedLines(spark, d), replace(run_config(spark, d), sort_by="reviews"))
    bad = due.quarantine.select("url", F.concat_ws(": ", "field", "reason").alias("verdict"))
    return due.valid.select(F.col("book_url").alias("url"), F.lit("due").alias("verdict")).unionByName(bad)


@query("run_by_arguments", SQL["run_increment_quarantine"])
def run_by_arguments(spark: SparkSession, d: str) -> DataFrame:
    """A run's parameters as the command line gives them."""
    wanted = run_config(spark, d)
    line = [str(wanted.num_books), str(wanted.num_reviews), "--captures", d, "--store", d, "--banned", "gizmo"]
    due = due_books(P.captures(spark, d), P.SavedLines(spark, d), config_of(arguments(line)))
    return due.quarantine.select("url", "field", "reason")

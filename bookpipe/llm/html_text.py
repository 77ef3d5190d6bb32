"""Main text of web pages by equivalence classes of template tokens.

A page's tokens are its container elements, each told apart by its path of containers
(``html/body/article``), and its short blocks of text. Pages of one host share a template:
tokens with the same occurrence vector (how often each stands in each of the host's pages)
form an equivalence class. A vector is not gathered but summed as a hash over pages, which
combines before the shuffle, so a host of any size costs one row per token and task.
A class is valid if its tokens stand once in each page that has them, in at least half of
the host's pages. Paths nest valid classes into the host's template. What lies between
template tokens are slots; the slot taken is the deepest template token, outside parts
that are no article (menus, headers, footers, asides, adverts, forms, scripts ...),
whose element holds all text, outside such parts, of the article: of the host's article or
main element if that has at least ``SHARE`` of the text, or else of the page. Its text is then
extracted from each page, again without such parts, and without blocks of up to ``WORDS``
words of valid classes: what at least half of a host's pages say, if it has ``PAGES`` of them.

Cases: null or empty html gives an empty text. Pages whose url has no host form one
group. Where a host has no such slot, or a page lacks its host's slot, the article, or
else all text outside the parts named, is taken; where that leaves nothing of one of
these, its parts named so by class or id only are taken too, and where nothing is left at
all, blocks of the template. Names match as class or id tokens or as their parts between
hyphens and underscores (but not after ``has``, ``no`` and the like), and never on html,
body, main and article. Tags that never close, attributes with
unpaired quotes and pages that break off are read in one pass, in linear time.
Repeated rows stay repeated; other columns pass through.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookpipe.llm.common import shared_path, ship, text_or_empty

SHARE = 0.9
#: Pages of one host go to its template in portions of so many.
PORTION = 1_000
#: Hosts whose templates may be sent to all pages.
SENT_HOSTS = 50_000
#: Words of a block that may be of a template, and pages that show a host's blocks.
WORDS, PAGES = 30, 4
#: What paths of blocks start with.
BLOCK = "\u00b6"
#: Paths of elements nested deeper end here.
DEEPEST = 64

# Element names and words of class and id attributes.
CONTAINERS = frozenset("html head body main article section div nav header footer aside form figure table td blockquote title h1 h2 h3 h4 h5 h6".split())
NO_ARTICLE = frozenset("head title nav header footer aside form button select option textarea label script style noscript iframe svg template dialog menu object canvas".split())
NO_ARTICLE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup comment comments reply replies disqus related share sharing social widget pagination pager".split()
)
#: Before a name, these say that something else has such a part.
RELATING = frozenset("has have no non not with without is hide show".split())
#: What holds a page's text is not judged by names.
FRAME = frozenset("html body main article".split())
RAW = frozenset("script style noscript iframe textarea template".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strong strike sub sup time tt u var wbr big label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/><]*+)(?P<attrs>[^<>\"']*+(?:\"[^\"<]*+\"[^<>\"']*+|'[^'<]*+'[^<>\"']*+)*+>|[^<>]*+>?)",
    re.DOTALL,
)
NAMED = re.compile(r"\b(class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
PARTED = re.compile(r"[-_]+")
RAW_END = {name: re.compile(rf"</{name}", re.IGNORECASE) for name in RAW}


class Part(NamedTuple):
    """An element of the page that is open."""

    name: str
    path: str
    #: Inside a part that is no article.
    outside: bool
    #: Inside an element that is no article whatever its names.
    hidden: bool


def names_no_article(value: str) -> bool:
    """Whether a class or id attribute names a part that is no article."""
    for token in value.split():
        if token in NO_ARTICLE_WORDS:
            return True
        parts = PARTED.split(token)
        if len(parts) > 1 and RELATING.isdisjoint(parts) and not NO_ARTICLE_WORDS.isdisjoint(parts):
            return True
    return False


def describe(name: str, attrs: str) -> tuple[str, bool]:
    """An element's step in a path, and whether it is no part of an article."""
    step, outside = name, name in NO_ARTICLE
    if "=" in attrs:
        for _, *values in NAMED.findall(attrs):
            value = "".join(values).strip().lower()
            step += "." + "-".join(value.split())
            outside = outside or (name not in FRAME and names_no_article(value))
    return step, outside


def walk(page: str) -> Iterator[tuple[str, str, Part]]:
    """("open", "", part) for each container, ("text", characters, part), ("gap", "", part)."""
    part = Part("", "", False, False)
    stack, open_names, at = [part], {}, 0
    while (found := TAG.search(page, at)) is not None:
        if found.start() > at:
            yield "text", page[at : found.start()], stack[-1]
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            if open_names.get(name):
                while True:
                    gone = stack.pop()
                    open_names[gone.name] -= 1
                    if gone.name == name:
                        break
        else:
            attrs = found["attrs"]
            step, outside = describe(name, attrs)
            if name == "p" and stack[-1].name == "p":
                open_names["p"] -= 1
                stack.pop()
            if name in RAW:
                end = RAW_END[name].search(page, at)
                at = end.start() if end else len(page)
            elif name not in VOID and not attrs.endswith("/>") and (name in CONTAINERS or outside):
                above = stack[-1]
                path = f"{above.path}/{step}" if len(stack) <= DEEPEST else above.path
                part = Part(name, path, outside or above.outside, name in NO_ARTICLE or above.hidden)
                stack.append(part)
                open_names[name] = open_names.get(name, 0) + 1
                yield "open", "", part
        if name not in INLINE:
            yield "gap", "", stack[-1]
    if at < len(page):
        yield "text", page[at:], stack[-1]


def block_mark(text: str) -> str | None:
    """The token of a block of text, if it is short enough to be of a template."""
    words = text.split()
    if not words or len(words) > WORDS:
        return None
    return f"{BLOCK}{hashlib.blake2b(' '.join(words).encode('utf-8', 'surrogatepass'), digest_size=8).hexdigest()}"


def tokens(page: str) -> dict[str, tuple[int, bool, int]]:
    """Path of each token: its count, whether it is outside, characters of article text in it."""
    counts: dict[str, int] = {"": 1}
    sizes: dict[str, int] = {}
    outside = {"": False}
    blocks: dict[str, int] = {}
    block: list[str] = []

    def end_block() -> None:
        mark = block_mark(html.unescape("".join(block))) if block else None
        if mark is not None:
            blocks[mark] = blocks.get(mark, 0) + 1
        block.clear()

    for kind, text, part in walk(page):
        if kind == "open":
            counts[part.path] = counts.get(part.path, 0) + 1
            outside[part.path] = part.outside
        elif kind == "gap":
            end_block()
        elif not part.outside:
            block.append(text)
            size = len("".join(text.split()))
            if size:
                sizes[part.path] = sizes.get(part.path, 0) + size
    end_block()
    total = dict.fromkeys(counts, 0)
    for path, size in sizes.items():
        while True:
            if path in total:
                total[path] += size
            if not path:
                break
            path = path.rpartition("/")[0]
    found = {p: (n, outside[p], total[p]) for p, n in counts.items()}
    return found | {mark: (n, False, 0) for mark, n in blocks.items()}


def slot_text(page: str, slot: str | None, template: frozenset[str] = frozenset()) -> str:
    """Text of the slot, or of the article, or of all; each without what is outside, unless that leaves nothing."""
    kept: list[list[str]] = [[] for _ in range(6)]
    block: list[list[str]] = [[] for _ in range(6)]

    def end_block() -> None:
        for pieces, texts in zip(block, kept, strict=True):
            if pieces:
                joined = " ".join(html.unescape("".join(pieces)).split())
                if joined and not (template and block_mark(joined) in template):
                    texts.append(joined)
                pieces.clear()

    for kind, text, part in walk(page):
        if kind != "text":
            if kind == "gap":
                end_block()
            continue
        inside = slot is not None and (part.path == slot or part.path.startswith(slot + "/"))
        for k, here in enumerate((inside, "/article" in part.path or "/main" in part.path, True)):
            if here:
                if not part.outside:
                    block[k].append(text)
                if not part.hidden:
                    block[k + 3].append(text)
    end_block()
    for k in (0, 3, 1, 4, 2, 5):  # each filtered, then unfiltered
        if kept[k]:
            return " ".join(kept[k])
    return slot_text(page, slot) if template else ""


def _list_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for host, mark, page in zip(batch["_host"], batch["_mark"], batch["_html"], strict=True):
            rows += [(host, path, mark, n, out, size) for path, (n, out, size) in tokens(page).items()]
        yield pd.DataFrame(rows, columns=["_host", "path", "_mark", "n", "outside", "size"])


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = zip(batch["_html"], batch["_slot"], batch["_blocks"], strict=True)
        found = [slot_text(page, slot, frozenset(() if blocks is None else blocks)) for page, slot, blocks in rows]
        yield batch.drop(columns=["_html", "_slot", "_blocks"]).assign(text=found, n_chars=np.array([len(t) for t in found], dtype="int64"))


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


def token_classes(pages: DataFrame) -> DataFrame:
    """(host, path, class, support, total, pages, outside, size, whole) of every token of every host.

    ``class`` is the hash of the token's occurrence vector over the host's pages.
    """
    mark = F.xxhash64("page_id", "url", "html")
    listed = pages.select(host_of(F.col("url")).alias("_host"), mark.alias("_mark"), text_or_empty("html").alias("_html"))
    each = listed.mapInPandas(_list_tokens, "_host string, path string, _mark bigint, n bigint, outside boolean, size bigint")
    place = F.xxhash64("_mark", "n").cast("decimal(38,0)")
    summed = each.groupBy("_host", "path").agg(
        F.sum(place).alias("_class"),
        F.count("*").alias("support"),
        F.sum("n").alias("total"),
        F.max("outside").alias("outside"),
        F.sum("size").alias("size"),
    )
    roots = summed.where("path = ''").select("_host", F.col("support").alias("pages"), F.col("size").alias("whole"))
    return summed.join(roots, "_host").withColumnRenamed("_class", "class")


def is_block() -> Column:
    return F.col("path").startswith(BLOCK)


def template_blocks(classes: DataFrame) -> DataFrame:
    """(host, blocks): the blocks of text that stand once on at least half of a host's pages.

    At most twice as many as a page has blocks.
    """
    shared = (F.col("support") == F.col("total")) & (F.col("support") * 2 >= F.col("pages")) & (F.col("pages") >= PAGES)
    return classes.where(is_block() & shared).groupBy("_host").agg(F.collect_list("path").alias("_blocks"))


def slots(classes: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, slot): the slot of the main text of each host that has one."""
    classes = classes.where(~is_block())
    valid = classes.groupBy("_host", "class").agg(F.max("support").alias("_s"), F.max("total").alias("_t"), F.max("pages").alias("_p"))
    valid = valid.where((F.col("_s") == F.col("_t")) & (F.col("_s") * 2 >= F.col("_p"))).select("_host", "class")
    held = classes.join(valid, ["_host", "class"]).where(~F.col("outside") & (F.col("path") != "") & (F.col("size") > 0))
    # What the slot must hold: all of the article or main element with most of the host's text, or else all text.
    article = F.when(F.col("path").rlike(r"/(article|main)(\.[^/]*)?$") & (F.col("size") >= F.col("whole") * share), F.col("size"))
    needed = held.groupBy("_host").agg(F.coalesce(F.max(article), F.max("whole")).alias("_needed"))
    held = held.join(needed, "_host").where("size >= _needed")
    depth = F.size(F.split("path", "/"))
    return held.groupBy("_host").agg(F.max(F.struct(depth.alias("d"), F.col("path").alias("p")))["p"].alias("_slot"))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html, ...) without html, with text and n_chars."""
    ship(pages.sparkSession)
    spark, path = pages.sparkSession, shared_path(pages.sparkSession, "classes")
    token_classes(pages.select("page_id", "url", "html")).write.parquet(path)  # pages are walked once for all that follows
    classes = spark.read.parquet(path)
    sizes = classes.where("path = ''").select("_host", "pages")
    known = sizes.join(slots(classes), "_host", "left").join(template_blocks(classes), "_host", "left")
    known = known.where("_slot is not null or _blocks is not null")
    placed = pages.drop("text", "n_chars").withColumn("_host", host_of(F.col("url")))
    if sizes.count() <= SENT_HOSTS:
        joined = placed.join(F.broadcast(known.drop("pages")), "_host", "left").drop("_host")
    else:
        # A host may hold a third of all pages: its template is repeated, one row for each portion of its pages.
        parts = F.ceil(F.col("pages") / PORTION).cast("bigint")
        known = known.withColumn("_portion", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("pages")
        dealt = F.pmod(F.xxhash64("page_id", "url", "html"), F.col("_parts"))
        # One row for every PORTION pages at most.
        placed = placed.join(F.broadcast(sizes.where(F.col("pages") > PORTION).select("_host", parts.alias("_parts"))), "_host", "left")
        placed = placed.withColumn("_portion", F.coalesce(dealt, F.lit(0).cast("bigint"))).drop("_parts")
        joined = placed.join(known, ["_host", "_portion"], "left").drop("_host", "_portion")
    rest = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    ready = joined.select(*rest, text_or_empty("html").alias("_html"), "_slot", "_blocks")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema if f.name in rest)
    return ready.mapInPandas(_extract, f"{fields}, text string, n_chars bigint")


def main_texts(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"))

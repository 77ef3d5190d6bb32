"""Page HTML to structured blocks, one Arrow-batched pass per page.

The only Python in the data path. It turns one page into the strings its profile
selects and nothing else; every value is parsed afterwards by Column expressions.
"""

from __future__ import annotations

import re
import sys
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.profile import Blocks, Every, Group

# Executors need no installed copy: the functions below travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# HTML's element classes as the HTML standard has them.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style")}
# An opening tag ends these open elements, up to the nearest of the containers.
ENDS = {
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr",)),
    "th": (("td", "th"), ("tr",)),
}
PARAGRAPH = (("p",), ("table",))  # any other block ends an open paragraph
LINE = "\x00"
MISSING = object()
# Builds of pages, and tags as written, that a task keeps; and the most tags of a page that is kept.
KEPT, LONGEST = 4_096, 4_096
# Tags in which no "<" or ">" is hidden, as nearly all are; and scripts or styles that such tags open.
PLAIN_ATTRIBUTES = r"""(?:\s+[\w:-]+(?:="[^"<>]*")?)*\s*"""
PLAIN = re.compile(rf"(/?)([a-zA-Z][\w:-]*)({PLAIN_ATTRIBUTES}/?)", re.A)
PLAIN_RAW = re.compile(rf"(<(script|style){PLAIN_ATTRIBUTES}>).*?(?=</\2[\s/>])", re.S | re.I | re.A)

# A comment, or a tag with its name and attributes; quoted values may hold ">", unquoted ones quotes.
TOKEN = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)"""
    r"""((?:[^"'>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+|["'])*+)>)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")

STEP = re.compile(r'(//|/)([\w-]+|\*)(?:\[@([\w-]+)(?:="([^"]*)")?\])?')


def steps(selector: str) -> list[tuple[bool, str, str | None, str | None]]:
    """``//div[@id="x"]/ul`` as (direct child?, tag, attribute, value) steps."""
    path = selector.removeprefix(".")
    found = list(STEP.finditer(path))
    if not found or "".join(m.group(0) for m in found) != path:
        raise ValueError(f"unsupported selector {selector!r}")
    return [(m.group(1) == "/", m.group(2), m.group(3), m.group(4)) for m in found]


def fits(stack: list, at: int, root: int, path: list, k: int) -> bool:
    """Does open element ``at`` satisfy step ``k``, and its ancestors the rest?"""
    direct, tag, attr, value = path[k]
    entry = stack[at]
    if tag != entry[0] and tag != "*":
        return False
    if attr is not None:
        raw = entry[1]
        if type(raw) is str and value is not None and value not in raw and "&" not in raw:
            return False
        found = attributes_of(entry).get(attr, MISSING)
        if found is MISSING or (value is not None and found != value):
            return False
    if k == 0:
        return not direct or at == root + 1
    if path[k][0]:
        return at - 1 > root and fits(stack, at - 1, root, path, k - 1)
    return any(fits(stack, up, root, path, k - 1) for up in range(at - 1, root, -1))


def attributes_of(entry: list) -> dict:
    """Attributes of an open element, read from its tag the first time."""
    if type(entry[1]) is str:
        attrs: dict = {}
        for name, quoted, single, bare in ATTRIBUTE.findall(entry[1]):
            attrs.setdefault(name.lower(), unescape(quoted or single or bare))
        entry[1] = attrs
    return entry[1]


class Fields(list):
    """The values of one group, a list for each field."""


def visible(pieces: list[str]) -> str:
    """Text as a reader sees it: one line per block, runs of blanks as one."""
    lines = (" ".join(line.split()) for line in "".join(pieces).split(LINE))
    return "\n".join(line for line in lines if line)


class Layout:
    """What to collect, indexed for the walk: built once per task."""

    def __init__(self, spec: list) -> None:
        self.names = [name for name, *_ in spec]
        entries = [(name, path, attr, fields and by_last_tag(fields)) for name, path, attr, fields in spec]
        self.at_tag = by_last_tag([(entry[1], entry) for entry in entries])
        # What selectors test: attribute -> the values that they compare with.
        self.tested: dict[str, set] = {}
        for _, path, _, fields in spec:
            for _, _, attr, value in [*path, *(step for inner, _ in fields or () for step in inner)]:
                if attr is not None:
                    self.tested.setdefault(attr, set()).add(value)
        self.plain: dict[str, tuple] = {}  # what stands between "<" and ">" -> the plain tag
        self.marks: dict[tuple, tuple] = {}  # a tag as written -> what selectors can see of it
        self.plans: dict[tuple, dict] = {}  # the tags of a page, as selectors see them -> what to collect from it

    def mark(self, token: tuple) -> tuple:
        """A tag without what no selector asks for: equal marks are walked alike."""
        slash, tag, attributes = token
        if tag is None or slash:
            seen = (slash, tag and tag.lower())
        else:
            attrs = attributes_of([tag, attributes])
            held = ((a, attrs[a] if attrs[a] in values else MISSING) for a, values in self.tested.items() if a in attrs)
            seen = (tag.lower(), *held)
        if len(self.marks) >= KEPT:
            self.marks.clear()
        self.marks[token] = seen
        return seen

    def plan(self, tokens: list[tuple]) -> dict:
        """What to collect from a page of these tags; worked out once for pages of one build."""
        marks = self.marks
        key = tuple([marks.get(token) or self.mark(token) for token in tokens])
        plan = self.plans.get(key)
        if plan is None:
            plan = Collector(self).read(tokens)
            if len(key) <= LONGEST:
                if len(self.plans) >= KEPT:
                    self.plans.clear()
                self.plans[key] = plan
        return plan


def by_last_tag(pairs: list) -> dict:
    """``(path, what)`` pairs as tag -> [(position, path, what, value)]; "*" fits any tag.

    ``value`` is what the attributes of the last step must hold, if it tests any.
    """
    numbered = [(i, path, what, path[-1][3] or "") for i, (path, what) in enumerate(pairs)]
    tags = {path[-1][1] for path, _ in pairs} | {"*"}
    found = {tag: [entry for entry in numbered if entry[1][-1][1] in (tag, "*")] for tag in tags}
    found["#"] = numbered  # all of them, for their number
    return found


def may_be_raw(html: str) -> bool:
    lower = html.lower()
    return any(f"<{tag}" in lower for tag in RAW)


def plain_tokens(html: str, plain: dict[str, tuple]) -> tuple[list[str], list[tuple]] | None:
    """As :func:`tokens_of`, for pages of plain tags alone: these are cut at each "<"."""
    raw, scripts = may_be_raw(html), 0
    if raw:
        html, scripts = PLAIN_RAW.subn(r"\1", html)
    first, *rest = html.split("<")
    cut = [piece.partition(">") for piece in rest]
    tokens = []
    for head, shut, _ in cut:
        token = plain.get(head)
        if token is None:
            found = PLAIN.fullmatch(head)
            if found is None:
                return None
            if len(plain) >= KEPT:
                plain.clear()
            token = plain[head] = found.groups()
        if not shut:
            return None
        tokens.append(token)
    if raw and sum(not slash and tag.lower() in RAW for slash, tag, _ in tokens) != scripts:
        return None
    return [first, *(text for _, _, text in cut)], tokens


def tokens_of(html: str) -> tuple[list[str], list[tuple]]:
    """The texts of a page, and between each two of them a tag as (slash, name, attributes); a comment has no name."""
    # No tag ends after the last ">"; a comment may run on to the end.
    last = len(html) if html.rfind("<!--") > html.rfind("-->") else html.rfind(">") + 1
    if not may_be_raw(html):
        parts = TOKEN.split(html[:last])
        parts[-1] += html[last:]
        return parts[::4], list(zip(parts[1::4], parts[2::4], parts[3::4], strict=True))
    at, size, texts, tokens = 0, len(html), [], []
    while at < size:
        for token in TOKEN.finditer(html, at, last):
            texts.append(html[at : token.start()])
            at = token.end()
            tokens.append(token.groups())
            slash, tag, _ = tokens[-1]
            if tag is not None and not slash and tag.lower() in RAW:  # its content is not markup
                shut = RAW[tag.lower()].search(html, at)
                at = size if shut is None else shut.start()
                break
        else:
            break
    texts.append(html[at:])
    return texts, tokens


class Collector:
    """Finds what to collect from one page while its tags stream by.

    A value of an attribute is noted as (place of the tag, attribute), a text as the places
    of its pieces and the ends of lines between them.
    """

    def __init__(self, layout: Layout) -> None:
        self.layout = layout
        self.stack: list = []  # [tag, attributes, [(slot list, position, text start)], groups opened]
        self.pieces: list = []
        self.place = 0  # of the tag at hand
        self.reading = 0  # how many open elements want their text
        self.found = {name: [] for name in layout.names}
        self.groups: list = []  # (stack index, fields by tag, values per field)
        self.open: dict[str, int] = {}  # open elements by tag

    def read(self, tokens: list[tuple]) -> dict:
        stack = self.stack
        for self.place, (slash, tag, attributes) in enumerate(tokens):
            if self.reading:
                self.pieces.append(self.place)
            if tag is None:
                continue
            tag = tag.lower()
            if not slash:
                self.start(tag, attributes)
            elif stack and stack[-1][0] == tag and not stack[-1][2] and not stack[-1][3]:
                stack.pop()  # what nearly all end tags come to
                self.open[tag] -= 1
                if self.reading and tag in BLOCK:
                    self.pieces.append(LINE)
            else:
                self.end(tag)
        if self.reading:
            self.pieces.append(len(tokens))
        self.close_to(0)
        return self.found

    def start(self, tag: str, attributes: str) -> None:
        layout, stack = self.layout, self.stack
        if tag in BLOCK:
            if stack and (tag in ENDS or stack[-1][0] not in BLOCK or stack[-1][0] == "p"):
                self.imply_ends(tag)
            if self.reading:
                self.pieces.append(LINE)
        elif tag == "br" and self.reading:
            self.pieces.append(LINE)
        entry = [tag, attributes, None, 0]
        stack.append(entry)
        self.open[tag] = self.open.get(tag, 0) + 1
        top = len(stack) - 1
        for root, fields, values in self.groups:
            for i, path, attr, value in fields.get(tag) or fields["*"]:
                if value in attributes or "&" in attributes:
                    if fits(stack, top, root, path, len(path) - 1):
                        self.take(entry, values[i], attr)
        for _, path, (name, _, attr, fields), value in layout.at_tag.get(tag) or layout.at_tag["*"]:
            if value not in attributes and "&" not in attributes:
                continue
            if not fits(stack, top, -1, path, len(path) - 1):
                continue
            if fields is None:
                self.take(entry, self.found[name], attr)
            else:
                values = Fields([] for _ in fields["#"])
                self.found[name].append(values)
                self.groups.append((top, fields, values))
                entry[3] += 1
        if tag in VOID:
            self.close_to(top)

    def end(self, tag: str) -> None:
        stack = self.stack
        if not self.open.get(tag):
            return
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] == tag:
                self.close_to(at)
                return
            if tag not in BLOCK and stack[at][0] in BLOCK:
                return

    def take(self, entry: list, slots: list, attr: str | None) -> None:
        if attr is not None:
            slots.append((self.place, attr))
            return
        slots.append([])
        entry[2] = entry[2] or []
        entry[2].append((slots, len(slots) - 1, len(self.pieces)))
        self.reading += 1

    def imply_ends(self, tag: str) -> None:
        ended, containers = ENDS.get(tag, PARAGRAPH)
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.stack[at][0]
            if name in ended:
                self.close_to(at)
                return
            if name in containers or (ended is PARAGRAPH[0] and name in BLOCK):
                return

    def close_to(self, at: int) -> None:
        stack = self.stack
        while len(stack) > at:
            tag, _, texts, groups = stack.pop()
            self.open[tag] -= 1
            if texts:
                for slots, position, start in texts:
                    slots[position] = self.pieces[start:]
                self.reading -= len(texts)
                if not self.reading:
                    self.pieces.clear()
            if groups:
                del self.groups[-groups:]
            if self.reading and tag in BLOCK:
                self.pieces.append(LINE)


def collect(html: str | None, layout: Layout) -> dict:
    """The selected values of one page; pages of one build are walked once."""
    texts, tokens = plain_tokens(html or "", layout.plain) or tokens_of(html or "")
    read: dict = {}  # attributes of the tags that are asked for them

    def value(wish: tuple | list) -> str | None:
        if type(wish) is list:
            return visible([LINE if piece is LINE else unescape(texts[piece]) for piece in wish])
        place, attr = wish
        if place not in read:
            read[place] = attributes_of(["", tokens[place][2]])
        return read[place].get(attr)

    def values(wishes: list) -> list:
        # The values of a group are lists themselves, one a field.
        return [[[value(w) for w in field] for field in wish] if type(wish) is Fields else value(wish) for wish in wishes]

    return {name: values(wishes) for name, wishes in layout.plan(tokens).items()}


def nth(values: list, n: int):
    return values[n] if n < len(values) else None


def extract_blocks(html: Column | str, blocks: Blocks) -> Column:
    """A struct column with one field per entry of ``blocks``.

    ``Pick`` gives a string, ``Every`` an array of strings, ``Group`` an array of
    structs. A page that lacks an element gives NULL or an empty array.
    """
    spec, arrow, spark = [], [], []
    for name, want in blocks.items():
        if isinstance(want, Group):
            spec.append((name, steps(want.selector), None, [(steps(f.selector), f.attr) for f in want.fields.values()]))
            arrow.append((name, pa.list_(pa.struct([(f, pa.string()) for f in want.fields]))))
            inner = T.StructType([T.StructField(f, T.StringType()) for f in want.fields])
            spark.append(T.StructField(name, T.ArrayType(inner)))
        else:
            spec.append((name, steps(want.selector), want.attr, None))
            every = isinstance(want, Every)
            arrow.append((name, pa.list_(pa.string()) if every else pa.string()))
            spark.append(T.StructField(name, T.ArrayType(T.StringType()) if every else T.StringType()))
    # Plain values only from here on: the closure must not need this package.
    shapes = []
    for name, want in blocks.items():
        group = [(f, pick.nth) for f, pick in want.fields.items()] if isinstance(want, Group) else None
        shapes.append((name, group, None if isinstance(want, (Every, Group)) else want.nth))
    arrow_type, layout = pa.struct(arrow), Layout(spec)

    def shape(found: dict) -> dict:
        row = {}
        for name, group, n in shapes:
            if group is not None:
                row[name] = [
                    {f: nth(values[i], place) for i, (f, place) in enumerate(group)} for values in found[name]
                ]
            else:
                row[name] = found[name] if n is None else nth(found[name], n)
        return row

    def parse(pages: pa.Array) -> pa.Array:
        return pa.array([shape(collect(page, layout)) for page in pages.to_pylist()], type=arrow_type)

    # Declared non-deterministic so that the optimizer keeps one evaluation per
    # page: it would otherwise copy the call into every filter on its result.
    udf = F.arrow_udf(parse, returnType=T.StructType(spark)).asNondeterministic()
    return udf(F.col(html) if isinstance(html, str) else html)

"""Main text of web pages by wrapper induction.

1. ``induce``: pages of one host are folded into one wrapper tree. A page's block
   elements are aligned with the wrapper by simple tree matching (labels: tag, class,
   role; a matching keeps order and may not cross). Matched nodes merge, the others
   are added; equal neighbours (paragraphs, list items, bare divisions) fold into one
   repeated node. Each node keeps hashes of the texts that all pages have in it: over at
   least ``TEMPLATE_PAGES`` pages these are constant, all other text of the node varies.
   Each task folds the pages that stream by, and the partial wrappers of a host are folded
   again, in two steps. Folding sees every page; a wrapper is as large as the layouts
   differ, and its texts only get fewer, so it does not grow as there are pages.
2. ``extract``: a page is aligned with the wrapper of its host by the same matching.
   Constant texts are template, all others content, unless nothing in that wrapper
   varies (copies of one page are no evidence). Repeated nodes inside an article are content.

Some slots vary by page and are no content all the same: navigation, headers, footers,
asides, forms, adverts, notices, comments. They are told by tag, role or by a class or id
that consists of nothing but such words (``BOILER_TAGS``, ``BOILER_WORDS``, ``PART_WORDS``):
``ad-slot`` is an advert, ``side-effects`` is not. If there is an ``article`` or ``main``
element, content lies inside it.

Elements nested deeper than ``MAX_DEPTH`` are no nodes of their own: their text, in its place
and in its own blocks, belongs to the node at that depth (left out if they are boilerplate).

Scripts, styles, comments and markup are no text. Character references are decoded,
white space inside a block is one space, blocks are joined by a line feed.

A null or empty page gives an empty text. A null or odd URL is the host ``""``.
Repeated rows are pages of their own. Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_type, map_batches, source
from tidelog.session import settle

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output q rp "
    "rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: An open element of the key's kind ends where one of the value's begins.
CLOSES = {
    "p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option"},
}
BOILER_TAGS = frozenset(
    "nav header footer aside form script style noscript template iframe button select textarea input svg canvas "
    "object dialog menu head title".split()
)
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar side aside widget footer header masthead cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments "
    "disqus replies reply share sharing social related recommended recommendations pagination pager toolbar".split()
)
#: Words that only say which part of such a thing an element is.
PART_WORDS = frozenset(
    "area article bar block blog body bottom box btn button buttons cell col column container content desktop entry fixed "
    "footer form global group head header heading icons inline inner item items left link links list main mobile news outer "
    "page panel post posts primary reader region right row secondary section site slot sticky story text thread title top "
    "unit user web wrap wrapper zone".split()
)
BOILER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar".split()
)


#: Levels of a tree; functions over trees recurse, some with three frames a level.
MAX_DEPTH = 150


class Node:
    """An element of a page or of a wrapper: label, children, and the text directly in it."""

    __slots__ = ("boiler", "common", "kids", "label", "many", "pages", "tag", "text", "varies")

    def __init__(self, tag: str, label: str, boiler: bool):
        self.tag, self.label, self.boiler = tag, label, boiler
        self.kids: list[Node] = []
        self.text: list = []  # of a page: strings and children in order
        self.common: set[int] = set()  # of a wrapper: hashes of the texts that all pages have here
        self.varies = self.many = False
        self.pages = 1


def _label(tag: str, rest: str) -> tuple[str, bool]:
    """Label and whether it names boilerplate."""
    if not rest.strip():
        return tag, tag in BOILER_TAGS
    got = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)}
    names = sorted(set(re.sub(r"\d+", "#", got.get("class", "").lower()).split()))
    role = got.get("role", "").lower()
    given = f"{got.get('class', '')} {got.get('id', '')}".split()
    named = [set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())) for name in given]
    hidden = "hidden" in got or got.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", got.get("style", ""))
    boiler = tag in BOILER_TAGS or role in BOILER_ROLES or bool(hidden)
    if tag not in ("html", "body", "article", "main"):
        boiler |= any(words & BOILER_WORDS and words <= BOILER_WORDS | PART_WORDS for words in named)
    elif tag == "article":
        own = {"comment", "comments", "reply", "ad", "advert", "related"}
        boiler |= any(words & own and words <= own | PART_WORDS | {"article"} for words in named)
    return ".".join([tag, *names, *([f"@{role}"] if role else [])]), boiler


def parse(page: str) -> Node:
    """A page as a tree of at most ``MAX_DEPTH`` levels; never fails, whatever the markup."""
    root = Node("#", "#", False)
    stack, at, end = [root], 0, len(page)
    opened = Counter()  # tags on the stack
    solid: list[int] = []  # where the stack holds elements that are not inline

    def split(node: Node) -> None:
        """A block ends in a node that stands for all levels below it."""
        edge = Node("#", "#", False)
        node.kids.append(edge)
        node.text.append(edge)

    def shut(k: int) -> None:
        for node in stack[k:]:
            opened[node.tag] -= 1
        while solid and solid[-1] >= k:
            if solid[-1] > MAX_DEPTH:
                split(stack[solid[-1]])
            solid.pop()
        del stack[k:]

    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            stack[-1].text.append(page[at:])
            break
        if m.start() > at:
            stack[-1].text.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag]:
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                shut(k)
            continue
        if tag not in INLINE:
            # A block ends an open paragraph (and what is open inside it), items end items.
            last = stack[solid[-1]].tag if solid else None
            if last in CLOSES and (CLOSES[last] is None or tag in CLOSES[last]):
                shut(solid[-1])
        label, boiler = _label(tag, m[3])
        node = Node(tag, label, boiler)
        # A header inside the article holds its title.
        if tag == "header" and boiler and label == "header" and (opened["article"] or opened["main"]):
            node.boiler = False
        holds = tag not in RAW and tag not in VOID and not m[3].rstrip().endswith("/")
        if holds and len(stack) > MAX_DEPTH:
            if tag not in INLINE:
                split(stack[-1])
            if not node.boiler:
                node.text, node.kids = stack[-1].text, stack[-1].kids
        else:
            stack[-1].kids.append(node)
            stack[-1].text.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
        elif holds:
            if tag not in INLINE:
                solid.append(len(stack))
            opened[tag] += 1
            stack.append(node)
    return root


def _blocks(node: Node) -> list[Node]:
    """Block children, also those inside inline elements."""
    out: list[Node] = []
    for kid in node.kids:
        if kid.tag in INLINE and not kid.boiler:
            out += _blocks(kid)
        else:
            out.append(kid)
    return out


def _own_text(node: Node) -> str:
    parts = []
    for x in node.text:
        if isinstance(x, str):
            parts.append(x)
        elif x.tag in INLINE and not x.boiler:
            parts.append(_own_text(x))
        else:
            parts.append(" ")
    return "".join(parts)


def _print(text: str) -> int:
    text = SPACE.sub(" ", text).strip()
    return xxhash.xxh64_intdigest(text) >> 1 if text else 0


def skeleton(node: Node) -> Node:
    """The wrapper of one page: blocks, equal neighbours folded."""
    out = Node(node.tag, node.label, node.boiler)
    mark = _print(_own_text(node))
    out.common = {mark} if mark else set()
    if node.tag not in RAW:
        for kid in _blocks(node):
            _append(out, skeleton(kid))
    return out


def _append(parent: Node, kid: Node) -> None:
    """A further child; neighbours of one page that are alike become one node with the texts of both."""
    last = parent.kids[-1] if parent.kids else None
    if last is None or last.label != kid.label:
        parent.kids.append(kid)
        return
    last.varies |= kid.varies
    last.common |= kid.common
    last.many = True
    both = Node("", "", False)
    for own in _aligned(last.kids, kid.kids):
        x, y = own
        if x is not None and y is not None:
            one = Node("", "", False)
            one.kids.append(x)
            _append(one, y)
            x = one.kids[0]
        _append(both, x if x is not None else y)
    last.kids = both.kids


def _aligned(a: list[Node], b: list[Node]) -> Iterator[tuple[Node | None, Node | None]]:
    """Both forests in order, matched nodes together."""
    i = j = 0
    for x, y in [*match(a, b), (len(a), len(b))]:
        yield from ((n, None) for n in a[i:x])
        yield from ((None, n) for n in b[j:y])
        if x < len(a):
            yield a[x], b[y]
        i, j = x + 1, y + 1


def match(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Simple tree matching of two forests: pairs of equal labels, in order, of most weight."""
    if [x.label for x in a] == [x.label for x in b]:
        return [(i, i) for i in range(len(a))]
    weight = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            here = weight[i][j] + 1 + _alike(x, y) if x.label == y.label else 0
            weight[i + 1][j + 1] = max(weight[i][j + 1], weight[i + 1][j], here)
    out, i, j = [], len(a), len(b)
    while i and j:
        if weight[i][j] == weight[i - 1][j]:
            i -= 1
        elif weight[i][j] == weight[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def _alike(x: Node, y: Node) -> int:
    """Nodes that match below two matched ones."""
    return sum(1 + _alike(x.kids[i], y.kids[j]) for i, j in match(x.kids, y.kids))


def merge(wrapper: Node, other: Node) -> None:
    """Fold the wrapper of other pages into this one."""
    wrapper.pages += other.pages
    _meet(wrapper, other)


def _meet(one: Node, two: Node) -> None:
    """Texts that both have stay common; children are aligned."""
    one.varies |= two.varies or one.common != two.common
    one.many |= two.many
    one.common &= two.common
    kids: list[Node] = []
    for x, y in _aligned(one.kids, two.kids):
        if x is not None and y is not None:
            merge(x, y)
        kid = x if x is not None else y
        if kids and kids[-1].label == kid.label:
            # Neighbours from different pages: how many have both is not known.
            kids[-1].pages = max(kids[-1].pages, kid.pages)
            _meet(kids[-1], kid)
            kids[-1].many = True
        else:
            kids.append(kid)
    one.kids = kids


def dump(node: Node) -> list:
    return [node.label, int(node.boiler), sorted(node.common), int(node.varies), int(node.many), node.pages, [dump(k) for k in node.kids]]


def load(data: list) -> Node:
    node = Node(re.match(r"[^.@]*", data[0])[0], data[0], bool(data[1]))
    node.common, node.varies, node.many, node.pages = set(data[2]), bool(data[3]), bool(data[4]), data[5]
    node.kids = [load(k) for k in data[6]]
    return node


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#\s]*)", url or "")
    return m[1].rpartition("@")[2].lower() if m else ""


HOSTED = "host string, part int, wrapper string"
#: Pages that must agree on a text before it is template.
TEMPLATE_PAGES = 5
#: Partial wrappers of a host are folded in so many groups first.
PARTS = 64


def induce(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from all pages."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Node] = {}
        part = 0
        for batch in batches:
            for url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, host = skeleton(parse(page or "")), host_of(url)
                part = (part * 31 + len(page or "")) % PARTS
                if host in known:
                    merge(known[host], own)
                else:
                    known[host] = own
        rows = [(h, part, json.dumps(dump(w))) for h, w in known.items()]
        yield _rows(rows, HOSTED)

    def again(key, table):
        whole = None
        for text in sorted(table["wrapper"].to_pylist()):
            other = load(json.loads(text))
            if whole is None:
                whole = other
            else:
                merge(whole, other)
        return pa.Table.from_batches([_rows([(key[0].as_py(), 0, json.dumps(dump(whole)))], HOSTED)])

    some = pages.select(F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(fold, HOSTED)
    fewer = some.groupBy("host", "part").applyInArrow(again, HOSTED)
    return fewer.groupBy("host").applyInArrow(again, HOSTED).select("host", "wrapper")


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = arrow_type(ddl)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def _article(node: Node) -> bool:
    return not node.boiler and (node.tag in ("article", "main") or node.label.endswith("@main"))


def _has_article(node: Node) -> bool:
    return not node.boiler and (_article(node) or any(_has_article(k) for k in node.kids))


def _any_varies(node: Node) -> bool:
    """Whether some slot that is no boilerplate differs between the pages of the host."""
    return not node.boiler and (node.varies or any(_any_varies(k) for k in node.kids))


def extract_text(page: str, wrapper: Node | None) -> str:
    """The text of a page's content slots."""
    root, blocks, run = parse(page), [], []
    inside_only = _has_article(root)
    evidence = wrapper is not None and _any_varies(wrapper)

    def flush() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(run))).strip()
        run.clear()
        if text:
            blocks.append(text)

    def walk(node: Node, slot: Node | None, inside: bool) -> None:
        inside = inside or not inside_only or _article(node)
        constant = evidence and slot is not None and slot.pages >= TEMPLATE_PAGES and slot.common
        # Inside an article several paragraphs may share a sentence with those of other pages.
        template = constant and not (slot.many and inside_only) and _print(_own_text(node)) in slot.common
        emit = inside and not template
        own = _blocks(node)
        slots: dict[int, Node] = {}
        if slot is not None:
            # Equal neighbours of the page stand for one node of the wrapper.
            runs: list[list[Node]] = []
            for kid in own:
                if runs and runs[-1][0].label == kid.label:
                    runs[-1].append(kid)
                else:
                    runs.append([kid])
            for i, j in match([r[0] for r in runs], slot.kids):
                slots.update({id(kid): slot.kids[j] for kid in runs[i]})

        def pour(part: Node) -> None:
            for x in part.text:
                if isinstance(x, str):
                    if emit:
                        run.append(x)
                elif x.tag in INLINE and not x.boiler:
                    if x.tag == "br":
                        run.append(" ")
                    pour(x)
                elif x.tag in INLINE or x.boiler or x.tag in RAW:
                    if x.tag not in INLINE:
                        flush()
                else:
                    flush()
                    walk(x, slots.get(id(x)), inside)
                    flush()

        pour(node)

    walk(root, wrapper, False)
    flush()
    return "\n".join(blocks)


@lru_cache(maxsize=256)
def _loaded(text: str) -> Node:
    return load(json.loads(text))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    wrappers = settle(induce(pages), "wrappers")
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#\s]*@)?([^/?#\s@]*)", 1)), F.lit(""))
    picked = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"), host.alias("host"),
    )
    # Wrappers are sent to all executors only as far as Spark's own size check allows;
    # else both sides are shuffled, and a large host is split there.
    met = picked.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper")

    def run(batch: pa.RecordBatch):
        texts = [
            extract_text(page or "", _loaded(w) if w else None)
            for page, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        ]
        return [batch.column(0), batch.column(1), texts]

    return map_batches(met, run, "page_id long, url string, text string")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(source(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

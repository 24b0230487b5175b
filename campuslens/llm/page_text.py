"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into text blocks. A linear classifier on a block's element path, names and link share
gives the cost of calling it content and of calling it boilerplate; these are the capacities to the
two terminals. Smoothness edges join neighbouring blocks and consecutive blocks under one parent,
stronger the closer they are in the element tree. The minimum cut is the labelling of least total
cost. Pages are independent, so the operator is a map; a block whose own preference outweighs all
its edges is settled beforehand, which never changes the cut."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements that begin and end a block (fixed values).
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details
dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html
iframe label legend li main menu nav ol option p pre search section select summary table tbody td
template tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is not text of the page (fixed values).
SKIP_TAGS = frozenset("""annotation annotation-xml audio button canvas head iframe noscript option
script select style svg template textarea title video""".split())
#: Elements whose content is not markup (fixed values).
RAW_TAGS = frozenset("iframe noscript script style template textarea title".split())
#: Raw elements that are read as absent where their end tag is missing; the others run to the end.
_OPTIONAL = frozenset("iframe noscript template".split())
FOREIGN = frozenset(("svg", "math"))
#: Start tags that close an open element of the same kind.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_P_ENDERS = BLOCK_TAGS - {"button", "label", "option", "body", "html"}
_SCOPE = frozenset("ul ol table dl article section main div body html td th".split())

#: Weights of elements on a block's path, content above zero. A navigation or side element settles
#: all its blocks, more than all other weights and edges of a usual page together can outweigh;
#: the rest only leans, about as much as one or two edges to neighbours.
SETTLED = -400
TAG_WEIGHT = {"article": 60, "main": 40, "p": 12, "h1": 10, "h2": 8, "h3": 8, "blockquote": 8,
              "pre": 8, "address": -10, "li": -4}
TAG_WEIGHT |= dict.fromkeys("nav aside footer form header menu dialog search".split(), SETTLED)
#: Words of class, id and role values that name boilerplate.
BOILERPLATE = frozenset("""ad ads advert adverts advertisement banner breadcrumb breadcrumbs
comment comments consent cookie cookies disqus footer masthead menu modal nav navbar navigation
newsletter notice notices popup promo promoted promotion recommended related replies reply
share sharing sidebar signup sponsor sponsored subscribe subscription toolbar widget
contentinfo complementary alert alerts disclaimer header""".split())
#: Words that may stand beside them in one name: "sidebar__inner" is a side bar, "has-sidebar" and
#: "social-history" are not.
BESIDE = frozenset("""area article articles bar block body bottom box btn button buttons card cards
container content entry form global google group gdpr inner item items js left link links list
main media message navs outer overlay page pages panel posts post primary right row secondary
section site slot social stories story text top unit wrap wrapper""".split())
CONTENT_NAMES = frozenset("article content entry main post story body text".split())
NAMED_CONTENT = 40
#: Text without any element of its own, on a page without article or main.
BARE = 12
#: The article's own prose, whose names say nothing about its role on the page.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
BIAS = -6
LINK_WEIGHT = -30
LENGTH_WEIGHT = 6
SMOOTH = 8

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)>",
    re.S | re.I)
_RAW_EDGE = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW_TAGS}
_ATTR = re.compile(r"(class|id|role|aria-label|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPACE = re.compile(r"\s+")


def name_kind(token: str) -> int:
    """-1 for one class, id or role that names boilerplate, 1 for content, 0 for neither. It names
    boilerplate as a whole only, not by one word among others."""
    words = {w.lower() for w in _NAMES.findall(token) if len(w) > 1}
    if words & BOILERPLATE:
        return -1 if words <= BOILERPLATE | BESIDE else 0
    return 1 if words & CONTENT_NAMES else 0


class Element:
    __slots__ = ("tag", "parent", "depth", "own", "named", "under", "skip", "link", "article", "side",
                 "main", "foreign", "holds", "length", "total")

    def __init__(self, tag: str, parent: Element | None, attrs: str = ""):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.link = tag == "a" or bool(parent and parent.link)
        inside = bool(parent and parent.article)
        self.article = tag in ("article", "main") or inside
        self.main = self if tag in ("article", "main") else parent and parent.main
        # the drawing or formula around it, but for page content inside a drawing
        self.foreign = (self if tag in FOREIGN else
                        None if tag == "foreignobject" else parent and parent.foreign)
        self.skip = tag in SKIP_TAGS or bool(parent and parent.skip)
        self.own = TAG_WEIGHT.get(tag, 0)
        if tag == "header" and inside:
            self.own = 0  # the head of an article holds its title
        self.side = self.own == SETTLED or bool(parent and parent.side)
        self.holds = False
        self.length, self.total = 0, None
        self.named = False
        if attrs and tag not in ("body", "html"):
            kinds = set()
            for m in _ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name == "hidden" or name == "style":
                    self.skip |= name == "hidden" or bool(_HIDDEN.search(value))
                elif name != "aria-label":
                    for token in value.split():
                        if not (inside and "header" in token.lower()):
                            kinds.add(name_kind(token))
            self.named = -1 in kinds and not (inside and tag in PROSE)
            if 1 in kinds:
                self.own += NAMED_CONTENT
        self.under = self.named or bool(parent and parent.under)

    def weight(self) -> int:
        """Sum over the path; a name does not count on what holds the page's main element."""
        path, at = [], self
        while at and at.total is None:
            path.append(at)
            at = at.parent
        total = at.total if at else 0
        for e in reversed(path):
            total += e.own + (SETTLED if e.named and not e.holds else 0)
            e.total = total
        return total


class Block:
    __slots__ = ("text", "element", "links", "bare")

    def __init__(self, text: str, element: Element, links: int):
        self.text, self.element, self.links = text, element, links
        self.bare = False

    def preference(self) -> int:
        """Cost of the boilerplate label less the cost of the content label."""
        share = self.links / max(1, len(self.text))
        return (BIAS + self.element.weight() + BARE * self.bare + round(LINK_WEIGHT * share)
                + round(LENGTH_WEIGHT * min(1.0, len(self.text) / 200)))


def blocks_of(html: str) -> list[Block]:
    """Text blocks in page order: character references decoded, runs of white space one space."""
    here = Element("#root", None)
    out: list[Block] = []
    parts: list[str] = []
    owner, links = here, 0

    def text(raw: str) -> None:
        nonlocal owner, links
        if here.skip or not raw:
            return
        raw = unescape(raw)
        if here.link:
            links += len(raw.strip())
        if not any(not p.isspace() for p in parts) and not raw.isspace():
            owner = here
        parts.append(raw)

    def flush() -> None:
        nonlocal links
        joined = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if joined:
            at = owner
            while at.parent and at.tag not in BLOCK_TAGS:
                at = at.parent
            out.append(Block(joined, at, links))
        links = 0

    def close(tags: frozenset | set) -> bool:
        nonlocal here
        at = here
        while at.parent and at.tag not in tags:
            if at.tag in _SCOPE and "p" not in tags and not tags & _SCOPE:
                return False
            at = at.parent
        if at.parent:
            here = at.parent
        return bool(at.parent)

    def raw_end(tag: str, at: int) -> int | None:
        """Where the raw element that starts before ``at`` ends; None if it counts as absent."""
        edge = None
        if (tag, "end") not in missing:
            edge = _RAW_EDGE[tag].search(html, at)
            while edge and not edge[1] and tag not in _OPTIONAL:
                edge = _RAW_EDGE[tag].search(html, edge.end())  # start tags are content here
            if not edge:
                missing.add((tag, "end"))
        if edge and edge[1]:
            return edge.end()
        return None if tag in _OPTIONAL else len(html)

    last, mains, missing = 0, [], set()
    while m := _TOKEN.search(html, last):
        text(html[last:m.start()])
        last = m.end()
        tag = m["tag"]
        if not tag:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if tag == "br":
            text(" ")
            continue
        closed = (m["attrs"] or "").endswith("/")
        if tag in RAW_TAGS:
            if not m["end"]:
                if tag in ("title", "iframe", "textarea") and not here.foreign:
                    flush()
                last = raw_end(tag, last) or last
            continue
        if tag in BLOCK_TAGS:
            flush()
            if here.foreign:  # a block ends an unclosed drawing or formula
                here = here.foreign.parent
        if m["end"]:
            at = here
            while at.parent and at.tag != tag:
                at = at.parent
            if at.parent:
                here = at.parent
        else:
            if tag in _P_ENDERS:
                at = here
                while at.parent and at.tag not in _SCOPE and at.tag != "p":
                    at = at.parent
                if at.tag == "p":
                    here = at.parent
            if tag in CLOSES and tag != "p":
                close(CLOSES[tag])
            if tag not in VOID_TAGS and not closed:
                here = Element(tag, here, m["attrs"] or "")
                if tag in ("article", "main"):
                    mains.append(here)
    text(html[last:])
    flush()
    settle_main(out, mains)
    return out


def settle_main(blocks: list[Block], mains: list[Element]) -> None:
    """Marks the path of the article or main element with most text of its own, outside of side
    elements and, if there is such a one, of names of boilerplate; on a page without any, the text
    that no element owns."""
    for block in blocks:
        if block.element.main:
            block.element.main.length += len(block.text)
        elif not mains:
            block.bare = block.element.tag in ("#root", "body", "html")
    open_ = [e for e in mains if not e.side and not e.skip]
    open_ = [e for e in open_ if not e.under] or open_
    at = max(open_, key=lambda e: e.length).parent if open_ else None
    while at:
        at.holds = True
        at = at.parent


def _distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges_of(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """(i, j, weight): neighbours, and consecutive blocks under one parent."""
    out, latest = [], {}
    for j, block in enumerate(blocks):
        pairs = {j - 1} if j else set()
        key = id(block.element.parent)
        if key in latest:
            pairs.add(latest[key])
        latest[key] = j
        for i in pairs:
            near = _distance(blocks[i].element, block.element)
            out.append((i, j, max(1, 2 * SMOOTH // (1 + near))))
    return out


def min_cut(preference: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels (True: content) of least cost, where label True forgoes -preference and an edge costs
    its weight when its ends differ. Shortest augmenting paths on the blocks that are not settled by
    their own preference; on ties blocks that the source cannot reach are boilerplate."""
    n = len(preference)
    around: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, w in edges:
        if i != j:
            around[i][j] = around[i].get(j, 0) + w
            around[j][i] = around[j].get(i, 0) + w
    label: list[bool | None] = [None] * n
    pull = list(preference)
    free = {i: sum(around[i].values()) for i in range(n)}
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or (abs(pull[i]) <= free[i]):
            continue
        label[i] = pull[i] > 0
        for j, w in around[i].items():
            if label[j] is None:
                pull[j] += w if label[i] else -w
                free[j] -= w
                queue.append(j)
    open_ = [i for i in range(n) if label[i] is None]
    if not open_:
        return [bool(x) for x in label]
    spare = {i: {j: w for j, w in around[i].items() if label[j] is None} for i in open_}
    out = {i: max(0, pull[i]) for i in open_}   # from the source
    sink = {i: max(0, -pull[i]) for i in open_}  # to the sink

    def reach() -> tuple[dict[int, int | None], int | None]:
        before: dict[int, int | None] = {i: None for i in open_ if out[i] > 0}
        todo = deque(before)
        while todo:
            i = todo.popleft()
            if sink[i] > 0:
                return before, i
            for j, w in spare[i].items():
                if w > 0 and j not in before:
                    before[j] = i
                    todo.append(j)
        return before, None

    while True:
        before, end = reach()
        if end is None:
            break
        path, i = [end], end
        while (i := before[i]) is not None:
            path.append(i)
        path.reverse()
        flow = min([out[path[0]], sink[end]] + [spare[a][b] for a, b in zip(path, path[1:])])
        out[path[0]] -= flow
        sink[end] -= flow
        for a, b in zip(path, path[1:]):
            spare[a][b] -= flow
            spare[b][a] += flow
    for i in open_:
        label[i] = i in before
    return [bool(x) for x in label]


def main_text(html: str) -> str:
    blocks = blocks_of(html)
    keep = min_cut([b.preference() for b in blocks], edges_of(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract_pages(pages: DataFrame, keep: list[str] | None = None, html_col: str = "html"
                  ) -> DataFrame:
    """``keep`` columns (default: page_id, url) with text (empty if a page has none) and n_chars.

    Null html is empty; unclosed elements and truncated pages are read as far as they go; every row
    is judged on its own, repeated ones too; columns not kept are ignored. An empty table gives an
    empty result. A page is read whole, however long, in time and memory linear in it; on ties of
    the cut a block is boilerplate."""
    keep = ["page_id", "url"] if keep is None else keep
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html_col).cast("string"))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h.as_py() or "") for h in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()),
                     pa.array(map(len, texts), pa.int64())], [*keep, "text", "n_chars"])

    return rows.mapInArrow(run, schema)

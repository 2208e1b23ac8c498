"""HTML main-text extraction by tree scoring (operator 7).

Each page is parsed into a small tree. Every block with text of its own is a
paragraph; it passes points for its length and its commas to its ancestors
(the parent all of them, each further ancestor half of what the one below it
got). A container's points are discounted by its link density. The
container with the most points is kept, with those of its siblings that look
like part of the same article; page furniture (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments) is left
out before scoring. Nothing else is dropped or cut.

A class or id names furniture only as a whole: ``sidebar``, ``sidebar-left``
and ``cookie-notice`` do, ``with-sidebar`` and ``related-work`` don't. An element
that holds the page's only article or its main part is no furniture whatever
its name. Where the page marks no article or main part at all, an element that
holds most of the page's paragraph points is none either, unless it is named
after reader comments or adverts. A page of which the names leave nothing is
read without them. Within an article or main part only adverts, comments, forms,
menus and the like are furniture: its header, footer, notices and lists of
links are its own text.

One page is one row, so the work is a map over the table's partitions; a task
holds one Arrow batch and one page's tree at a time. Reading a page takes time
in proportion to its length, however deep its elements are nested.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import columns_of

# Element names of the HTML standard and usual names of page furniture.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary
table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
FURNITURE_TAGS = frozenset("""head nav aside footer form button select option textarea script style noscript template iframe
object embed applet svg canvas map audio video dialog menu title noembed noframes""".split())
FURNITURE_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar
toolbar""".split())
FURNITURE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor
sponsored sponsors promo promos promotion sidebar sidebars aside nav navbar navigation menu menus topbar toolbar breadcrumb
breadcrumbs pagination pager header masthead footer footnav copyright cookie cookies consent gdpr notice notices notification
alert popup modal overlay newsletter subscribe subscription signup login register comment comments commentlist disqus respond
reply replies share sharing social related recommended recommendations trending widget widgets skip hidden""".split())
#: Names of readers' comments, which may well be longer than the article.
COMMENT_NAMES = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Names of adverts, which may be longer than a short article.
ADVERT_NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor
sponsored sponsors promo promos promotion""".split())
#: Names that say furniture about the page's parts, not about an article's.
PAGE_NAMES = frozenset("header masthead footer copyright notice notices notification alert".split())
#: What may stand beside a furniture name in one class or id: places, boxes and their number.
QUALIFIERS = frozenset("""left right top bottom upper lower main site page global primary secondary mobile desktop inner outer
wrap wrapper container box bar block area section panel slot unit zone row column list item items link links button buttons
btn icon icons form title text body x posts articles stories message bookmark trail""".split())
_CONTENT = frozenset(("article", "main"))
#: An open element that a start tag closes, and where the search for it ends.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"),
           "tfoot": ("tbody", "tr", "td", "th")}
_SCOPE = frozenset("ul ol dl table article main section div body html aside nav header footer form blockquote".split())
_LEAVES_P = BLOCKS - {"body", "html", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "legend"}

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([/!?][^>]*)>)", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+|\d+")
_NO_DISPLAY = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "skip", "points", "text", "links", "anchors", "content", "names", "named")

    def __init__(self, tag: str, parent: "Node | None", skip: bool = False, names: str = "", named: frozenset = frozenset()):
        self.tag, self.parent, self.skip, self.names, self.named = tag, parent, skip, names, named
        self.children: list = []  # nodes and strings
        self.points = 0.0
        self.text = self.links = self.anchors = 0
        self.content = tag in _CONTENT or (parent is not None and parent.content)


def _furniture_names(tokens: list[str], ignored: frozenset) -> frozenset:
    """The furniture names among class names and ids that say nothing else."""
    out: set[str] = set()
    for token in tokens:
        parts = _NAME.findall(token)
        own = {x for x in parts if x in FURNITURE_NAMES and x not in ignored}
        if own and all(x in own or x in QUALIFIERS or x.isdigit() for x in parts):
            out |= own
    return frozenset(out)


def _furniture(tag: str, attributes: str, parent: Node) -> tuple[bool, str, frozenset]:
    """Whether an element is page furniture, its class names, and the
    furniture names among them and its id."""
    none: frozenset = frozenset()
    if tag in FURNITURE_TAGS and not (tag == "footer" and parent.content):
        return True, "", none
    if tag == "header" and not parent.content:
        return True, "", none
    if not attributes.strip(" /"):
        return False, "", none
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = found.get("class", "")
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _NO_DISPLAY.search(found.get("style", "")):
        return True, names, none
    if tag in ("body", "html", "article", "main"):
        return False, names, none
    role = found.get("role", "").lower()
    if role in FURNITURE_ROLES and not (parent.content and role in ("alert", "banner", "contentinfo")):
        return True, names, none
    heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6", "p")
    ignored = PAGE_NAMES if parent.content else frozenset(("header",)) if heading else none
    return False, names, _furniture_names(f"{names} {found.get('id', '')}".lower().split(), ignored)


def parse(page: str) -> Node:
    root = Node("html", None)
    top, at, n = root, 0, len(page)
    # How many elements of each name are open, all in all and (inline ones)
    # since the nearest open block: what isn't open isn't searched for.
    opened: Counter = Counter()
    inline: list[Counter] = [Counter()]

    def leave(node: Node, upto: Node) -> None:
        while node is not upto:
            opened[node.tag] -= 1
            if node.tag in BLOCKS:
                inline.pop()
            else:
                inline[-1][node.tag] -= 1
            node = node.parent

    def close_upto(names, start: Node) -> Node:
        if not any(opened[x] for x in names):
            return start
        node = start
        while node.parent is not None:
            if node.tag in names:
                return node.parent
            if node.tag in _SCOPE:
                return start
            node = node.parent
        return start

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            top.children.append(page[at:lt])
        if lt == n:
            break
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            top.children.append("<")
            at = lt + 1
            continue
        at = m.end()
        tag = m[2].lower() if m[2] else ""
        if not tag:
            continue
        if m[1]:
            # An inline end tag doesn't close blocks.
            if (opened if tag in BLOCKS else inline[-1])[tag] > 0:
                node = top
                while node.tag != tag:
                    node = node.parent
                leave(top, node.parent)
                top = node.parent
            continue
        if tag == "html":
            continue
        for names_closed in (("p",) if tag in _LEAVES_P else (), _CLOSES.get(tag, ())):
            if names_closed:
                upto = close_upto(names_closed, top)
                leave(top, upto)
                top = upto
        skip, names, named = _furniture(tag, m[3] or "", top)
        node = Node(tag, top, skip, names, named)
        top.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and (tag in BLOCKS or not (m[3] or "").endswith("/")):
            top = node
            opened[tag] += 1
            if tag in BLOCKS:
                inline.append(Counter())
            else:
                inline[-1][tag] += 1
    return root


def _blocks(node: Node) -> list[str]:
    """The texts of the blocks below a node in page order."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        if run:
            raw = "".join(run)
            text = " ".join((_html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(text)
            run.clear()

    stack: list = [(node, False)]
    while stack:
        x, done = stack.pop()
        if isinstance(x, str):
            run.append(x)
        elif done:
            end()
        elif not x.skip:
            if x.tag in BLOCKS:
                end()
                stack.append((x, True))
            elif x.tag == "br":
                run.append(" ")
            stack.extend((c, False) for c in reversed(x.children))
    end()
    return out


def _points(length: int, commas: int) -> float:
    return min(3.0, length / 100) + commas + length / 1000


def _skip_named(root: Node) -> bool:
    """Leaves out the elements named as furniture, but for those that hold the
    page's article by all other signs. Whether there are any."""
    order, stack = [], [(root, False)]
    while stack:
        node, in_link = stack.pop()
        if node.skip:
            continue
        in_link = in_link or node.tag == "a"
        order.append((node, in_link))
        stack.extend((c, in_link) for c in node.children if not isinstance(c, str))
    if not any(n.named for n, _ in order):
        return False
    points, mains, articles = {}, {}, {}
    for node, in_link in reversed(order):
        texts = [] if in_link else [c for c in node.children if isinstance(c, str) and c.strip()]
        below = [c for c in node.children if not isinstance(c, str) and not c.skip]
        points[node] = (_points(sum(len(c.strip()) for c in texts), sum(c.count(",") for c in texts)) if texts else 0.0) + sum(points[c] for c in below)
        mains[node] = (node.tag == "main") + sum(mains[c] for c in below)
        articles[node] = (node.tag == "article") + sum(articles[c] for c in below)
    any_skipped = False
    for node, _ in order:
        if node.named:
            marked = articles[root] or mains[root]
            holds = mains[node] > 0 or not node.named & COMMENT_NAMES and (
                articles[node] == articles[root] == 1
                or not marked and not node.named & ADVERT_NAMES and points[node] > points[root] / 2)
            node.skip = not holds
            any_skipped |= node.skip
    return any_skipped


_PARAGRAPHS = frozenset("p pre blockquote li td dd h1 h2 h3 h4 h5 h6".split())


def _score(root: Node) -> list[Node]:
    """Points of all containers; text, link text and number of links of all nodes."""
    order: list[Node] = []
    given: dict[Node, float] = {}  # a paragraph's own points, for its parent
    stack = [(root, False, root)]
    while stack:
        node, in_link, block = stack.pop()
        if node.skip:
            continue
        order.append(node)
        in_link = in_link or node.tag == "a"
        if node.tag in BLOCKS:
            block = node
        own, commas = 0, 0
        for c in node.children:
            if isinstance(c, str):
                if c.strip():
                    own += len(c.strip())
                    commas += c.count(",")
            else:
                stack.append((c, in_link, block))
        node.text, node.links, node.anchors = own, own if in_link else 0, int(node.tag == "a")
        if own and not in_link:
            # The nearest block is the paragraph; loose text counts for its container.
            if block.parent is None or block.tag not in _PARAGRAPHS:
                block.points += _points(own, commas)
            else:
                given[block] = given.get(block, 0.0) + _points(own, commas)
    for node in reversed(order):
        up = node.parent
        if up is not None:
            up.text += node.text
            up.links += node.links
            up.anchors += node.anchors
            up.points += given.get(node, 0.0) + node.points / 2
    return order


def _density(node: Node) -> float:
    return node.links / node.text if node.text else 0.0


def _is_menu(node: Node) -> bool:
    """A list or box of links outside an article."""
    return (not node.content and node.anchors >= 3 and node.tag in ("ul", "ol", "div", "section", "table", "dl")
            and _density(node) > 0.66)


def main_text(page: str | None) -> str:
    """The article's text: its blocks joined by line feeds, empty if none."""
    if not page:
        return ""
    root = parse(page)
    text = ""
    if _skip_named(root):
        text = _article(root)
        if not text:
            root = parse(page)
    return text or _article(root)


def _article(root: Node) -> str:
    """The blocks of the best container and of the siblings like it."""
    order = _score(root)
    containers = [n for n in order if n.points > 0 and n.tag in BLOCKS]
    if not containers:
        return ""
    for n in order:
        if n.text and _is_menu(n):
            n.skip = True
    best = max(containers, key=lambda n: n.points * (1 - _density(n)))
    node = best
    while node is not None:  # the whole of an explicit article
        if node.tag in _CONTENT:
            best = node
        node = node.parent
    if best.parent is None or best.tag in ("body", "html"):
        return "\n".join(_blocks(best))
    least, out = 0.2 * best.points * (1 - _density(best)), []
    for s in best.parent.children:
        if s is best:
            out += _blocks(s)
        elif not isinstance(s, str) and not s.skip and best.tag not in _CONTENT:
            paragraph = s.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "ul", "ol", "table", "figure")
            alike = bool(s.names) and s.names == best.names
            if s.text and _density(s) < 0.25 and (paragraph or alike or s.points * (1 - _density(s)) >= least):
                out += _blocks(s)
        elif not isinstance(s, str) and not s.skip and s.tag == best.tag and s.points * (1 - _density(s)) >= least:
            out += _blocks(s)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    A null or empty page and one without any text give an empty text; repeated
    rows are extracted one by one; other columns are ignored.
    """
    own = columns_of(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "page_id": b.column(0), "url": b.column(1), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")

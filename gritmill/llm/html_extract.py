"""HTML extraction by composite text density.

For every node of the DOM: characters per tag, adjusted for links; a node's
density sum adds the densities of its children. The subtree with the largest
sum is the text, widened along its path to the body while the nodes there stay
above the threshold, the smallest density on that path.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, read

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
HINT = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video select option button label head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Never part of the text.
SKIP = RAW | frozenset("nav footer aside form fieldset menu dialog".split())
#: Words in class, id or role that mark what surrounds an article.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs"
    " sidebar sidebars aside footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login"
    " comment comments commentlist disqus reply replies respond share sharing social related recommended widget widgets toolbar pagination pager search searchbox skip toc"
    " contentinfo complementary".split()
)
MAIN = ("article", "main")
#: Words that begin a class of readers' comments.
READERS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: What may stand in head; all else ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dd dt".split())
SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LIMITS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table", "tbody", "thead"), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}


class Node:
    __slots__ = ("tag", "hint", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "total", "cut", "holds_main")

    def __init__(self, tag: str, hint: str, parent: Node | None):
        self.tag, self.hint, self.parent, self.parts = tag, hint, parent, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.cut = self.holds_main = False


def parse(source: str) -> Node:
    """A forgiving DOM: void tags, implied ends of p, li, table cells; raw elements keep no text."""
    root = Node("#root", "", None)
    at, node, low = 0, root, None
    text = lambda a, b: node.parts.append(entities.unescape(source[a:b])) if b > a else None
    while m := TOKEN.search(source, at):
        if node.tag == "head" and source[at : m.start()].strip():
            node = node.parent
        text(at, m.start())
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, attributes = name.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            up = node
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
            continue
        if node.tag == "head" and tag not in IN_HEAD:
            node = node.parent
        if tag in CLOSES_P:
            up = node
            while up.tag in INLINE:  # an open b or span does not keep a paragraph open
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in SAME:
            up = node
            while up is not None and up.tag not in SAME[tag] and up.tag not in LIMITS[tag]:
                up = up.parent
            if up is not None and up.tag in SAME[tag]:
                node = up.parent
        hint = " ".join(a or b or c for a, b, c in HINT.findall(attributes)).lower() if attributes else ""
        child = Node(tag, hint, node)
        node.parts.append(child)
        if tag in RAW and not attributes.rstrip().endswith("/"):
            if tag == "head":
                node = child
                continue
            if low is None:
                low = source.lower()
            end = low.find(f"</{tag}", at)
            at = len(source) if end < 0 else end
            close = source.find(">", at)
            at = len(source) if close < 0 else close + 1
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            node = child
    if node.tag == "head" and source[at:].strip():
        node = node.parent
    text(at, len(source))
    return root


def _order(root: Node) -> list[Node]:
    """Parents before children."""
    out = [root]
    for n in out:
        out.extend(x for x in n.parts if isinstance(x, Node))
    return out


def _readers(n: Node) -> bool:
    """Whether a node's class marks readers' comments; comments-open and the like only tell the page's state."""
    words = (re.split(r"[^a-z0-9]+", token) for token in n.hint.split())
    return any(not READERS.isdisjoint(w[:1]) and not {"open", "closed"} & set(w) for w in words)


def _wrappers(nodes: list[Node], marked: set[Node]) -> set[Node]:
    """The marked node that holds most of the text outside the others, and what it lies in; none if there is no such.

    A node with an AROUND word as a whole class needs four times the rest, one with such a word inside a class
    (has-sidebar) or a form more than the rest. Readers' comments are no wrapper.
    """
    own, hidden = {}, set()
    for n in nodes:
        if n.parent in hidden or (n.parent is not None and n.tag in SKIP and n.tag != "form") or (n in marked and _readers(n)):
            hidden.add(n)
    for n in reversed(nodes):
        own[n] = sum(len("".join(x.split())) if isinstance(x, str) else 0 if x in marked or x in hidden else own[x] for x in n.parts)
    best = max((n for n in nodes if n in marked and n not in hidden), key=own.get, default=None)
    if best is None or own[best] <= (1 if AROUND.isdisjoint(best.hint.split()) else 4) * own[nodes[0]]:
        return set()
    out = set()
    while best is not None:
        out.add(best)
        best = best.parent
    return out


def _measure(root: Node) -> list[Node]:
    nodes = _order(root)
    readers = {n for n in nodes if n.tag == "article" and _readers(n) and not any(isinstance(x, Node) and x.tag == "h1" for x in _order(n))}
    for n in reversed(nodes):
        n.holds_main = (n.tag in MAIN and n not in readers) or any(isinstance(x, Node) and x.holds_main for x in n.parts)
    marked = {n for n in nodes if not n.holds_main and n.tag not in ("html", "body") and (n.tag == "form" or n.hint and not AROUND.isdisjoint(re.split(r"[^a-z0-9]+", n.hint)))}
    wrappers = _wrappers(nodes, marked) if marked and not root.holds_main else set()
    for n in nodes:
        inside = n.parent is not None and n.parent.cut
        around = n in marked and n not in wrappers
        page_header = n.tag == "header" and not _within(n, MAIN)
        n.cut = inside or (n.tag in SKIP and n.tag != "form") or around or page_header
    for n in reversed(nodes):
        if n.cut:
            continue
        for x in n.parts:
            if isinstance(x, str):
                n.chars += len("".join(x.split()))
            elif not x.cut:
                n.chars, n.tags = n.chars + x.chars, n.tags + x.tags + 1
                n.link_chars, n.link_tags = n.link_chars + x.link_chars, n.link_tags + x.link_tags
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.link_tags + 1
    return nodes


def _within(n: Node, tags: tuple[str, ...]) -> bool:
    while n is not None and n.tag not in tags:
        n = n.parent
    return n is not None


def _densities(nodes: list[Node], body: Node) -> None:
    """Composite density: characters per tag, on a logarithm whose base grows with the links' share."""
    share = body.link_chars / max(1, body.chars)
    for n in nodes:
        if n.cut or not n.chars:
            continue
        c, lc, t, lt = n.chars, n.link_chars, max(1, n.tags), n.link_tags
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        ratio = (c / max(1, lc)) * (t / max(1, lt))
        n.density = c / t * (math.log(max(ratio, 1.0) + 1e-9) / math.log(max(base, 1.0) + 1.0) + (0.0 if lc == c else 1e-6))
    for n in nodes:
        n.total = sum(x.density for x in n.parts if isinstance(x, Node))
        if any(isinstance(x, str) and x.strip() for x in n.parts):
            n.total = max(n.total, n.density)


def main_subtree(root: Node) -> Node:
    nodes = _measure(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    _densities(nodes, body)
    best = max((n for n in nodes if not n.cut and _under(n, body)), key=lambda n: n.total, default=body)
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min((n.density for n in path if n.density > 0), default=0.0)
    for n in path[1:]:
        # Up to a container, and on while what stands beside it is as dense as the path.
        beside = [x for x in n.parts if isinstance(x, Node) and x is not best and not x.cut and x.chars]
        container = best.tag not in INLINE and best.tag not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "pre", "blockquote")
        dense = sum(x.chars for x in beside if x.density >= threshold and x.link_chars < 0.5 * x.chars)
        if container and dense < 0.2 * max(1, best.chars) and not any(x.tag in ("h1", "h2") for x in beside):
            break
        best = n
    return best


def _under(n: Node, body: Node) -> bool:
    while n is not None and n is not body:
        n = n.parent
    return n is not None


def text_of(node: Node) -> str:
    out: list[str] = []
    stack: list[object] = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.cut or x is node:
            inline = x.tag in INLINE
            if not inline:
                out.append(" ")
                stack.append(" ")
            stack.extend(reversed(x.parts))
    return " ".join("".join(out).split())


def main_text(source: str | None) -> str:
    """The article of a page; "" for null, empty or textless pages."""
    if not source or not source.strip():
        return ""
    return text_of(main_subtree(parse(source)))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text): one row per input row; a map, nothing is shuffled.

    Null and empty pages have an empty text. Unclosed and broken markup is
    closed at the end of the page. Each row stands for itself, also when rows
    repeat. An empty table gives no rows.
    """
    pages = pick(pages, page_id=id_col, url=url_col, html=html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return pages.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")


def op7_html_extraction(spark, sf_dir):
    return extract_text(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))

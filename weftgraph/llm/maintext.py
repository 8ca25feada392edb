"""Main text of web pages by composite text density.

A page becomes a tree of elements; what never is article text (scripts, forms, navigation, asides, elements
that say in a class, id or role that they are adverts, notices, menus or reader comments) is left out of
it. A class or id alone removes no element around the page's largest article (or main, if there is none),
and not so much of it, or of a page without one, that less than ``LEAST`` of the characters outside links are
left: then the largest such elements stay, with others of the same words. For every node, the density is its characters per tag, lowered by the share of characters and tags in
links. A node's density sum is that of its children. The node with the greatest sum is the core of the
page, and the smallest density between core and body is the threshold. If the core lies in an ``article``
element, the outermost one is the text, with the outermost articles beside it that reach the threshold; if
not, the outermost ``main`` around the core is. Without either, beside the core, every node around it that
reaches the threshold gives the subtree with its own greatest sum.

Text is joined per block, in page order; white space inside a block is one space. Null and empty pages give
an empty text, plain text without tags is one block, unclosed elements end with their parent, unknown
character references stay as they are. A page is read as a whole in time in proportion to its length.
Repeated rows give equal texts. Other columns are carried along; one named like the result gives way to it.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftgraph.llm.words import attach

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
WORDS = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

# Fixed values of HTML: elements without content, with raw content, and what a start tag closes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr caption ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
KEEPS_P = set("a abbr audio b bdi bdo big br button canvas cite code data del dfn em font i img input ins kbd "
              "label map mark meter nobr noscript object output picture progress q ruby s samp script select small "
              "span strike strong style sub sup svg template textarea time tt u var video wbr".split())

#: Elements that are never article text.
OUT_TAGS = set(
    "head script style noscript template iframe object embed svg canvas math audio video form button select "
    "input textarea nav footer aside menu dialog noembed noframes title".split()
)
OUT_ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar "
    "status".split()
)
#: Words of a class or id that tell the same.
OUT_WORDS = set(
    "ad ads adsense advert adverts advertisement advertising adslot sponsor sponsored promo promotion promoted nav "
    "navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices banner popup modal overlay newsletter subscribe subscription signup "
    "share sharing social related recommended recommendations comment comments commentlist respond disqus reply "
    "replies pagination pager widget skip hidden".split()
)
OUT_PARTS = ("advert", "cookie", "sidebar", "breadcrumb", "newsletter", "commentlist", "comments")
#: Share of the characters outside links that classes and ids leave of an article or page.
LEAST = 0.25
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


class Node:
    __slots__ = ("tag", "parent", "kids", "out", "named", "chars", "links", "tags", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: "Node | None", out: bool):
        self.tag, self.parent, self.out = tag, parent, out
        self.named: frozenset[str] = frozenset()
        self.kids: list[Node | str] = []
        self.chars = self.links = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def left_out(tag: str, attributes: str, parent: Node) -> bool:
    """Whether an element and all below it are no article text."""
    if tag in OUT_TAGS:
        return True
    if tag == "header":
        node: Node | None = parent
        while node and node.tag not in ("article", "main"):
            node = node.parent
        if node is None:
            return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and OUT_ROLES & set(value.lower().split()):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def telling(tag: str, attributes: str) -> frozenset[str]:
    """Words of an element's class and id that tell that it is no article text."""
    if not attributes or tag in ("html", "body", "article", "main"):
        return frozenset()
    found: set[str] = set()
    for name, value in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            words = WORDS.findall(CAMEL.sub(" ", html.unescape(value.strip("\"'"))).lower())
            found.update(w for w in words if w in OUT_WORDS or any(p in w for p in OUT_PARTS))
    return frozenset(found)


def parse(page: str) -> Node:
    """The tree of a page; text is in the lists of children, references still in place."""
    root = Node("html", None, False)
    node, at, size = root, 0, len(page)
    open_tags: dict[str, int] = {}

    def close(to: Node) -> Node:
        nonlocal node
        while node is not to:
            open_tags[node.tag] -= 1
            node = node.parent
        return to

    while at < size:
        found = TOKEN.search(page, at)
        text = page[at : found.start() if found else size]
        if text:
            node.kids.append(text)
        if not found:
            break
        at = found.end()
        slash, name, attributes = found.groups()
        if name is None:
            continue
        tag = name.lower()
        if slash:
            if tag == "br":
                node.kids.append(" ")
            if open_tags.get(tag):
                to = node
                while to.tag != tag:
                    to = to.parent
                node = close(to.parent)
            elif tag == "p":
                node.kids.append(Node("p", node, node.out))
            continue
        if tag in ("html", "body") and (tag == "html" or open_tags.get("body")):
            continue
        if tag == "body" and open_tags.get("head"):
            to = node
            while to.tag != "head":
                to = to.parent
            node = close(to.parent)
        if tag not in KEEPS_P and open_tags.get("p"):
            to = node
            while to.tag != "p" and to.tag in KEEPS_P:
                to = to.parent
            if to.tag == "p":
                node = close(to.parent)
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            last, to = None, node
            while to is not root and to.tag not in stops:
                if to.tag in ends:
                    last = to
                to = to.parent
            if last is not None:
                node = close(last.parent)
        if tag in VOID:
            if tag == "br":
                node.kids.append(" ")
            elif tag == "hr":
                node.kids.append(Node("hr", node, False))
            continue
        kid = Node(tag, node, node.out or left_out(tag, attributes, node))
        if not kid.out:
            kid.named = telling(tag, attributes)
        node.kids.append(kid)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else size
            after = page.find(">", at)
            at = size if after < 0 else after + 1
            continue
        if attributes.endswith("/") and tag in ("svg", "path"):
            continue
        node = kid
        open_tags[tag] = open_tags.get(tag, 0) + 1
    return root


def preorder(root: Node) -> list[Node]:
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(k for k in reversed(node.kids) if isinstance(k, Node) and not k.out)
    return found


def judge_names(root: Node) -> None:
    """Leaves out the elements whose names tell so, but for those that hold the text itself."""
    nodes = preorder(root)
    if not any(n.named for n in nodes):
        return
    linked, own = {id(None): False}, {}
    for node in nodes:
        linked[id(node)] = node.tag == "a" or linked[id(node.parent)]
        texts = () if linked[id(node)] else (k for k in node.kids if isinstance(k, str))
        own[id(node)] = sum(len("".join(k.split())) for k in texts)
    whole = dict(own)
    for node in reversed(nodes):
        if node.parent is not None:
            whole[id(node.parent)] += whole[id(node)]

    def look(top: Node) -> tuple[int, list[Node]]:
        """The characters below an element outside named ones, and the first named ones."""
        seen, named, stack = 0, [], [top]
        while stack:
            node = stack.pop()
            seen += own[id(node)]
            for kid in node.kids:
                if isinstance(kid, Node) and not kid.out:
                    (named if kid.named else stack).append(kid)
        return seen, named

    scope, outside = root, look(root)[0]
    for tag in ("article", "main"):
        top = max((n for n in nodes if n.tag == tag), key=lambda n: whole[id(n)], default=None)
        if top is None or not whole[id(top)]:
            continue
        around = [n for n in _upwards(top) if n.named]
        if around and whole[id(top)] <= outside:
            continue
        for node in around:
            node.named = frozenset()
        scope = top
        break
    seen, named = look(scope)
    heap: list[tuple[int, int, Node]] = []
    waiting: dict[frozenset[str], list[Node]] = {}
    kept: set[frozenset[str]] = set()
    count = 0
    while True:
        while named:
            node = named.pop()
            if node.named in kept:
                node.named = frozenset()
                more, below = look(node)
                seen += more
                named += below
            else:
                count += 1
                heapq.heappush(heap, (-whole[id(node)], count, node))
                waiting.setdefault(node.named, []).append(node)
        while heap and not heap[0][2].named:
            heapq.heappop(heap)
        if not heap or not heap[0][0] or seen >= LEAST * whole[id(scope)]:
            break
        words = heap[0][2].named
        kept.add(words)
        named = waiting.pop(words)
    for node in nodes:
        node.out = node.out or bool(node.named)


def weigh(nodes: list[Node], body: Node) -> None:
    """Characters, tags, link shares and densities of every node, from the leaves up."""
    for node in nodes:
        node.chars = sum(len("".join(k.split())) for k in node.kids if isinstance(k, str))
    for node in reversed(nodes):
        if node.tag == "a":
            node.links, node.link_tags = node.chars, node.link_tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.links += node.links
            up.tags += node.tags + 1
            up.link_tags += node.link_tags
    body_share = body.links / max(body.chars, 1)
    for node in nodes:
        chars, links = node.chars, node.links
        if not chars:
            continue
        tags, plain = max(node.tags, 1), max(chars - links, 1)
        base = math.log(chars / plain * links + body_share * chars + math.e)
        ratio = chars / max(links, 1) * (tags / max(node.link_tags, 1))
        node.density = chars / tags * max(math.log(ratio) / math.log(base) if base > 1 else math.log(ratio), 0.0)
    for node in nodes:
        kids = [k for k in node.kids if isinstance(k, Node) and not k.out]
        node.total = sum(k.density for k in kids) if kids else node.density


def content(root: Node) -> set[int]:
    """The chosen subtrees, as identities of their top nodes."""
    judge_names(root)
    nodes = preorder(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    weigh(nodes, body)
    inside = preorder(body)
    best: dict[int, Node] = {}
    for node in reversed(inside):
        top = node
        for kid in node.kids:
            if isinstance(kid, Node) and not kid.out and best[id(kid)].total > top.total:
                top = best[id(kid)]
        best[id(node)] = top
    core = best[id(body)]
    threshold, node = core.density, core
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    # Pages that mark their articles say where the less dense parts of each end.
    marked = [n for n in _upwards(core) if n.tag == "article"]
    if marked:
        chosen, stack = {id(marked[-1])}, [body]
        while stack:
            node = stack.pop()
            if node.tag != "article":
                stack.extend(k for k in node.kids if isinstance(k, Node) and not k.out)
            elif node.density >= threshold and node.chars:
                chosen.add(id(node))
        return chosen
    marked = [n for n in _upwards(core) if n.tag == "main"]
    if marked:
        return {id(marked[-1])}
    chosen = {id(core)}
    stack = [core.parent] if core is not body and core.parent is not body else []
    while stack:
        node = stack.pop()
        if node.density >= threshold and node.chars:
            chosen.add(id(best[id(node)]))
            stack.extend(k for k in node.kids if isinstance(k, Node) and not k.out)
    return chosen


def _upwards(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def main_text(page: str | None) -> str:
    root = parse(page or "")
    chosen = content(root)
    out: list[str] = []
    here: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(here)).split())
        if text:
            out.append(text)
        here.clear()

    stack: list[tuple[Node | str | None, bool, bool]] = [(root, False, False)]
    while stack:
        item, inside, heading = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if inside and not heading:
                here.append(item)
        elif not item.out:
            inside = inside or id(item) in chosen
            # In the header of an article only its headings are text.
            heading = (heading or item.tag == "header") and item.tag not in HEADINGS
            if item.tag in BLOCK:
                flush()
                stack.append((None, False, False))
            stack.extend((k, inside, heading) for k in reversed(item.kids))
    flush()
    return "\n\n".join(out)


def extract(pages: DataFrame, column: str = "html", result: str = "text") -> DataFrame:
    """``pages`` with the main text of every page."""

    def make(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([main_text(page) for page in texts.to_pylist()], pa.string())]

    return attach(pages, column, [T.StructField(result, T.StringType())], lambda: make)

"""Main text of web pages by composite text density.

A page becomes a tree. Elements that are no part of an article by their name, role or class (menus, forms, adverts,
notices, comments) are cut off. Every remaining node gets its composite text density, characters a tag, adjusted by
how many of them are links against the whole body; a node's density sum adds up its children's densities. The node of
the largest sum lies in the article; the least density on its path to the body is the threshold that other subtrees
beside the path need to count as well, if they hold paragraphs or the like; headings there count anyway, being too
short to be dense. Where the largest sum lies in an ``article`` or ``main``, or most of its text does, the choice is widened
to all of that element, so a dense part doesn't stand for the whole, and to the other outermost ones that reach the threshold;
an ``article`` elsewhere changes nothing. Lists of links in it that don't reach the threshold go, but not those under a heading.

Cases: null and empty pages give an empty text; a page without elements is its own text; tags left open end where
HTML lets them; unknown character references stay as they are; white space is what Python's ``str.split`` takes for
it; very long pages are read whole; repeated rows are read each on its own; columns named ``text`` or ``n_chars`` are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import text_slices
from tickloom.session import ship

ship(__name__)

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Parts of a compound name: by signs between them, or by capitals.
PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")

#: Elements without content, and those whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
HEAD = frozenset("title meta link style script base noscript template".split())
#: Elements that start a block of text; an open paragraph ends where one starts.
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Of them, those that may hold a whole article.
CONTAINERS = BLOCK - frozenset("p h1 h2 h3 h4 h5 h6 hgroup pre blockquote li dt dd br hr address summary figcaption figure legend option optgroup".split())
#: A start tag ends an open element of these names, up to one of the scope.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody"), ("table",)), "tfoot": (("thead", "tbody"), ("table",)),
    "option": (("option",), ("select",)),
}
KEEP = frozenset("html body article main".split())
OTHER = frozenset(
    "head script style noscript template nav footer aside form button select textarea input label iframe svg canvas object embed dialog menu title search".split()
)
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Elements that mark an article, and those that hold text by their name.
MARKED = ("article", "main")
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hgroup section".split())
LISTS = frozenset("ul ol dl".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words of a class or id that name something beside an article.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "footer cookie cookies consent notice notices popup modal overlay newsletter subscribe signup login share sharing social related recommended "
    "recommendations comment comments disqus reply replies respond responses discussion widget toolbar pagination pager skip".split()
)
#: Parts of a layout's name that say what is beside the element, not what it is.
LAYOUT_WORDS = frozenset("no has with without hide enabled disabled".split())
#: Headings of link lists that are no part of an article.
LIST_TITLES = OTHER_WORDS | frozenset("more tags topics popular latest trending links".split())
#: Of them, those that sections of an article have as well.
VAGUE_WORDS = frozenset("notice notices related reply replies respond share sharing social promotion widget skip".split())
#: Words that name the top of a site, unless within an article.
TOP_WORDS = frozenset("header masthead banner topbar".split())


class Node:
    __slots__ = ("chars", "children", "density", "doubt", "link_chars", "link_tags", "name", "other", "parent", "parts", "sum", "tags")

    def __init__(self, name: str, parent: Node | None, other: bool = False):
        self.name, self.parent, self.other, self.doubt = name, parent, other, 0
        self.parts: list[str | Node] = []  # texts and elements in page order
        self.children: list[Node] = []


def is_other(name: str, attributes: str, within: bool) -> tuple[bool, int]:
    """Whether an element is no part of an article; ``within``: it stands inside one. Then what its class and id say:
    0 nothing, 1 that it may be something else, 2 that it is, unless most of the page is in it.
    """
    if name in KEEP:
        return False, 0
    if name in OTHER or (name == "header" and not within):
        return True, 0
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False, 0
    tokens = set()
    for key, *values in ATTRIBUTE.findall(attributes):
        key, given = key.lower(), "".join(values)
        value = given.lower()
        if key in ("class", "id"):
            tokens.update(given.split())
        elif key == "role" and value in OTHER_ROLES or key == "aria-hidden" and value == "true":
            return True, 0
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True, 0
    if "hidden" in ATTRIBUTE.sub(" ", attributes).lower().split():
        return True, 0
    named = OTHER_WORDS if within else OTHER_WORDS | TOP_WORDS
    doubt = 0
    for token in tokens:
        words = [w.lower() for w in PART.findall(token)]
        layout = not LAYOUT_WORDS.isdisjoint(words)
        # A name's last word says what it is: leftSidebar, user-responses.
        if token.lower() in named - VAGUE_WORDS or words and not layout and words[-1] in named - VAGUE_WORDS:
            return False, 2
        doubt |= any(w in named for w in words)
    return False, int(doubt)


def settle(nodes: list[Node], body: Node) -> None:
    """Cut what class or id name as something else, by density where that is in doubt; never most of the page."""
    for node in nodes:
        if not node.doubt or any(a.other for a in ancestors(node, body)):
            continue
        most = node.sum > 0 and 2 * node.chars > body.chars and not any(n.name in MARKED for n in ancestors(node, body))
        dense = node.doubt == 1 and node.density >= body.density and 3 * node.link_chars < node.chars
        node.other = not (most or dense)


def tree(page: str) -> Node:
    """The elements of a page under one root."""
    root = at = Node("", None)
    open_names: dict[str, int] = {}
    raw = ""
    end = 0

    def leave(node: Node) -> Node:
        """End the elements down to ``node``; what is open then."""
        nonlocal at
        while True:
            open_names[at.name] -= 1
            done, at = at, at.parent
            if done is node:
                return at

    def nearest(names: tuple[str, ...], scope: tuple[str, ...]) -> Node | None:
        node = at
        while node.parent is not None and node.name not in scope:
            if node.name in names:
                return node
            node = node.parent
        return None

    for m in MARKUP.finditer(page):
        closing, name = m[1], m[2]
        if raw:
            if not (closing and name and name.lower() == raw):
                continue
            raw = ""
            leave(at)
            end = m.end()
            continue
        if m.start() > end:
            text = page[end : m.start()]
            if open_names.get("head") and at.name == "head" and not text.isspace():
                leave(nearest(("head",), ()))
            at.parts.append(html.unescape(text) if "&" in text else text)
        end = m.end()
        if not name:
            continue
        name = name.lower()
        if closing:
            if open_names.get(name):
                leave(nearest((name,), ()))
            if name in BLOCK:
                at.parts.append("\n")
            continue
        if open_names.get("head") and name not in HEAD and name != "head":
            leave(nearest(("head",), ()))
        if name in BLOCK and name != "br" and open_names.get("p"):
            found = nearest(("p",), ("td", "th", "table", "button", "article", "div", "section", "li", "main", "aside"))
            if found:
                leave(found)
        if name in ENDS and open_names.get(name) or name in ("dt", "dd", "td", "th", "tbody", "tfoot"):
            found = nearest(*ENDS[name])
            if found:
                leave(found)
        if name in BLOCK:
            at.parts.append("\n")
        if name in ("html", "body") and open_names.get(name):
            continue
        within = bool(open_names.get("article") or open_names.get("main"))
        other, doubt = is_other(name, m[3], within)
        node = Node(name, at, other)
        node.doubt = doubt
        at.parts.append(node)
        at.children.append(node)
        if name in VOID or m[3].endswith("/") and name not in BLOCK and name not in RAW and name != "a":
            continue
        at = node
        open_names[name] = open_names.get(name, 0) + 1
        raw = name if name in RAW else ""
    if not raw and end < len(page):
        at.parts.append(html.unescape(page[end:]))
    return root


def in_order(root: Node) -> list[Node]:
    """Nodes that may be content, parents before children."""
    out, left = [], [root]
    while left:
        node = left.pop()
        out.append(node)
        left += [c for c in reversed(node.children) if not c.other]
    return out


def text_of(node: Node) -> str:
    """All text under a node in page order, white space as it is, a line end around blocks."""
    out: list[str] = []
    left: list[str | Node] = [node]
    while left:
        x = left.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.other:
            left += reversed(x.parts)
    return "".join(out)


def measure(nodes: list[Node], body: Node) -> None:
    """Densities and density sums of all nodes, children before parents."""
    for node in reversed(nodes):
        kids = [c for c in node.children if not c.other]
        node.chars = sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str)) + sum(c.chars for c in kids)
        node.tags = sum(c.tags + 1 for c in kids)
        link = node.name == "a"
        node.link_chars = node.chars if link else sum(c.link_chars for c in kids)
        node.link_tags = node.tags + 1 if link else sum(c.link_tags for c in kids)
    body_links = body.link_chars / max(1, body.chars)
    for node in reversed(nodes):
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, max(1, node.link_tags)
        if c:
            base = math.log(c / max(1, c - lc) * lc + body_links * c + math.e)
            node.density = c / t * math.log(max(1.0, c / max(1, lc) * t / lt)) / math.log(base) if base > 1 else c / t * math.log(max(1.0, c / max(1, lc) * t / lt))
        else:
            node.density = 0.0
        node.sum = sum(k.density for k in node.children if not k.other)


def densest(nodes: list[Node]) -> Node:
    """The container of the largest density sum, the outer and earlier of equals; a single paragraph is none."""
    return max((n for n in nodes if n is nodes[0] or n.name in CONTAINERS), key=lambda n: n.sum)


def main_text(page: str | None) -> str:
    """The text of a page's article, blocks joined by one space."""
    if not page:
        return ""
    root = tree(page)
    nodes = in_order(root)
    body = next((n for n in nodes if n.name == "body"), root)
    nodes = in_order(body)
    measure(nodes, body)
    if any(n.doubt for n in nodes):
        settle(nodes, body)
        nodes = in_order(body)
        measure(nodes, body)
    best = densest(nodes)
    marked = [n for n in nodes if n.name in MARKED and n.chars]
    if marked and not any(n.name in MARKED for n in [best, *ancestors(best, body)]):
        inside = [n for n in marked if best in ancestors(n, body) or n is best]
        outer = [n for n in inside if not any(a.name in MARKED for a in ancestors(n, body))]
        if 2 * sum(n.chars - n.link_chars for n in outer) > best.chars - best.link_chars:
            best = max(inside, key=lambda n: n.sum)
    path = [best, *ancestors(best, body)]
    threshold = min(n.density for n in path)
    whole = [n for n in path if n.name in MARKED]
    if whole:
        outer = [n for n in nodes if n.name in MARKED and not any(a.name in MARKED for a in ancestors(n, body))]
        parts = [n for n in outer if n is whole[-1] or n.density >= threshold]
        for node in (n for part in parts for n in in_order(part)[1:]):
            node.other = is_link_list(node) and node.density < threshold and not titled(node)
        return " ".join(x for n in parts if (x := " ".join(text_of(n).split())))
    while best is not body and best.parent not in (None, body) and any(isinstance(x, str) and not x.isspace() for x in best.parent.parts):
        best = best.parent
    path = ancestors(best, body)
    picked = {id(best)}
    for node in path:
        for c in node.children:
            if c.other or c in path or c is best:
                continue
            if c.density >= threshold and (c.sum or c.name in TEXTUAL) or heads(c, node is not body):
                picked.add(id(c))
    parts = [n for n in nodes if id(n) in picked]
    return " ".join(x for n in parts if (x := " ".join(text_of(n).split())))


def is_link_list(node: Node) -> bool:
    """Whether most of a block's text are several links."""
    several = sum(c.name == "a" or c.link_tags > 0 for c in node.children if not c.other) > 1 or node.link_tags > 3
    return (node.name in CONTAINERS or node.name in LISTS) and several and 2 * node.link_chars > node.chars


def titled(node: Node) -> bool:
    """Whether a block is under a heading of the article, or begins with one."""

    def is_title(found: Node | None) -> bool:
        return found is not None and found.name in HEADINGS and LIST_TITLES.isdisjoint(re.findall(r"\w+", text_of(found).lower()))

    inside = [c for c in node.children if not c.other and c.chars]
    before = None
    for c in node.parent.children if node.parent else []:
        if c is node:
            break
        if not c.other and c.chars:
            before = c
    only = node.parent is not None and sum(not c.other and c.chars > 0 for c in node.parent.children) == 1
    return is_title(inside[0] if inside else None) or is_title(before) or (only and node.parent.name not in (*MARKED, "body", "") and titled(node.parent))


def heads(node: Node, within: bool) -> bool:
    """Whether a node beside the path is a heading, or, ``within`` the article, holds nothing but headings."""
    if node.name in HEADINGS or not within:
        return node.name in HEADINGS and node.chars > 0
    kids = [c for c in node.children if not c.other and c.chars]
    return bool(kids) and sum(c.chars for c in kids) == node.chars and all(heads(c, True) for c in kids)


def ancestors(node: Node, body: Node) -> list[Node]:
    out = []
    while node is not body and node.parent is not None:
        node = node.parent
        out.append(node)
    return out


def extract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "html"):
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        columns = [*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of ``html``."""
    pages = pages.drop("text", "n_chars")
    fields = [*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    out = pages.mapInArrow(extract_rows, T.StructType(fields))
    return out.select(*[F.col(c) for c in out.columns if c != "html"])

"""Main text of web pages by composite text density.

A page becomes a tree of elements. Each element has its characters, tags, link characters and link tags below it; its
composite density is its characters per tag, lowered by the share of links (Sun, Song and Liao 2011, "DOM based
content extraction via text density"). The element with the largest sum of its children's densities is the core; the
smallest density on the way from it up to the body is the threshold. Every block beside that way whose density reaches
the threshold belongs to the text; so do headings beside it, and paragraphs and the like inside elements on the way,
unless they are mostly links. All elements on the way reach the threshold by its definition, so where one of them is an
article or main element, that is taken whole.

Names tell how much an element's density weighs. What its tag, or all of a class, id or role, names as page furniture
weighs nothing, unless it holds most of the page's text and there is little beside it; what a part of a name only
hints at weighs half, and goes only if links make up most of it or its density stays under the threshold.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafloom.llm import common

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z0-9]+")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "template", "svg", "math", "object", "canvas", "audio", "video"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "legend", "li", "main", "menu", "nav", "ol",
    "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "html", "head",
}
#: A start tag closes these open elements (up to the nearest of the second set).
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: An open paragraph is not ended from inside these, and a tag that marks up text ends nothing beyond these.
_P_LIMIT = {"article", "table", "td", "th", "button", "div", "section", "blockquote", "body"}
_BOUNDARY = {"article", "td", "th", "table", "body"}
_ENDS_P = _BLOCK - {"br", "body", "html", "head", "option", "legend", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "summary"}
_FURNITURE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "search", "fieldset", "datalist", "label", "input", "head"}
_FURNITURE_WORDS = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar",
    "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "masthead", "topbar", "toolbar", "comment", "comments", "disqus",
    "respond", "replies", "reply", "reactions", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "pagination",
    "pager", "widget", "copyright", "disclaimer", "form", "search", "skip", "hidden", "tracking", "contentinfo", "complementary", "paywall",
}
_READERS_WORDS = {"comment", "comments", "disqus", "respond", "replies", "reply", "reactions"}
#: Words that say where or in what a thing stands: beside a furniture word they leave its meaning as it is.
_PLAIN_WORDS = {
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "entry", "fixed", "global", "group",
    "icon", "icons", "inline", "inner", "item", "items", "js", "label", "left", "link", "links", "list", "local", "main", "mobile", "module", "outer", "page",
    "panel", "post", "posts", "primary", "region", "right", "row", "secondary", "section", "site", "slot", "sticky", "story", "stories", "text", "the", "thread",
    "title", "top", "unit", "upper", "lower", "user", "wrap", "wrapper",
}
#: A word of a class, id or role behind one of these does not name the element itself.
_ABOUT = {"has", "no", "with", "without"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
#: Elements that hold text by their nature.
_TEXTS = {"p", "ul", "ol", "dl", "blockquote", "pre", "table", "figure"}
#: Marks of an element: text, a hint of furniture, furniture by name, readers' words, and what is not shown.
TEXT, HINT, FURNITURE, READERS, UNSEEN = range(5)


class Node:
    """An element: its tag, parent, children (elements and texts in order), mark, and density figures."""

    __slots__ = ("tag", "parent", "parts", "mark", "within", "p", "own", "chars", "tags", "link_chars", "link_tags", "free", "under", "density", "total")

    def __init__(self, tag: str, parent: Node | None, mark: int = TEXT):
        self.tag, self.parent, self.parts, self.mark = tag, parent, [], mark
        self.within = tag in ("article", "main") or parent is not None and parent.within  # an article or main element
        self.p = self if tag == "p" else None if parent is None or tag in _P_LIMIT else parent.p  # the open paragraph
        self.own = self.chars = self.tags = self.link_chars = self.link_tags = self.free = self.under = 0
        self.density = self.total = 0.0


def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag, values with character references decoded; the first of a name counts."""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def _mark(tag: str, attrs: str, within: bool) -> int:
    """What an element's tag and names say of it; ``within`` tells whether it is inside an article or main element."""
    by_tag = FURNITURE if tag in _FURNITURE_TAGS or tag == "header" and not within else TEXT
    if tag in ("body", "html", "article", "main") or not attrs.strip():
        return by_tag
    a = attributes(attrs)
    if a.get("aria-hidden", "").lower() == "true" or "hidden" in attrs.lower().split() or re.search(r"display\s*:\s*none", a.get("style", "")):
        return UNSEEN
    found = by_tag
    for name in (x for k in ("class", "id", "role") for x in a.get(k, "").lower().split()):
        words = _WORD.findall(name)
        # has-sidebar, no-sidebar and with-comments tell of the layout around a text
        words = words[: next((i for i, w in enumerate(words) if w in _ABOUT), len(words))]
        named = [w for w in words if w in _FURNITURE_WORDS or w == "header" and not within]
        if not named:
            continue
        if any(w not in named and w not in _PLAIN_WORDS and not w.isdigit() for w in words):
            found = max(found, HINT)
        else:
            found = max(found, READERS if _READERS_WORDS & set(named) else FURNITURE)
    return found


class _Open:
    """The open elements: the innermost one, and how many of a tag are open in all and since the last boundary."""

    def __init__(self, root: Node):
        self.here, self.all, self.scopes = root, Counter([root.tag]), [Counter([root.tag])]

    def push(self, node: Node) -> None:
        self.here = node
        self.all[node.tag] += 1
        if node.tag in _BOUNDARY:
            self.scopes.append(Counter())
        self.scopes[-1][node.tag] += 1

    def pop(self) -> None:
        tag = self.here.tag
        self.all[tag] -= 1
        self.scopes[-1][tag] -= 1
        if tag in _BOUNDARY:
            self.scopes.pop()
        self.here = self.here.parent

    def close_to(self, node: Node) -> None:
        while self.here is not node.parent:
            self.pop()

    def close(self, tags: set[str], limit: set[str]) -> None:
        """Ends the open elements of these tags up to the nearest of ``limit``."""
        while any(self.all[t] for t in tags):
            x = self.here
            while x is not None and x.tag not in tags:
                if x.tag in limit:
                    return
                x = x.parent
            if x is None or x.parent is None:
                return
            self.close_to(x)

    def end(self, tag: str) -> None:
        """An end tag: a tag that is not open is passed over, and one that marks up text ends nothing beyond its cell."""
        if tag in ("body", "html") or not (self.all if tag in _BLOCK else self.scopes[-1])[tag]:
            return
        x = self.here
        while x.tag != tag:
            x = x.parent
        if x.parent is not None:
            self.close_to(x)


def parse(page: str) -> Node:
    """The element tree of a page without comments, scripts and styles, in time proportional to its length."""
    root = Node("html", None)
    tree, at, lower = _Open(root), 0, None
    never: set[str] = set()  # tags of which no end is left
    scan = _TOKEN.scanner(page)
    while True:
        m = scan.search()
        end = m.start() if m else len(page)
        if end > at:
            tree.here.parts.append(page[at:end])
        if not m:
            return root
        at = m.end()
        close, start, attrs = m.group(1), m.group(2), m.group(3)
        if close:
            tree.end(close.lower())
        elif start:
            tag = start.lower()
            if tag in _RAW and not attrs.endswith("/"):
                if lower is None:
                    lower = page.lower()
                    if len(lower) != len(page):  # a letter whose lower case is longer
                        lower = re.sub("[A-Z]", lambda c: c.group().lower(), page)
                stop = -1 if tag in never else lower.find(f"</{tag}", at)
                if stop < 0:
                    never.add(tag)
                    # an element that holds markup of its own and never ends is taken as its start tag alone
                    if tag not in ("script", "style", "textarea", "title"):
                        continue
                at = len(page) if stop < 0 else (lower.find(">", stop) + 1 or len(page))
                scan = _TOKEN.scanner(page, at)
                continue
            if tag in _ENDS_P and tree.here.p is not None:
                tree.close_to(tree.here.p)
            if tag in _CLOSES:
                tree.close(*_CLOSES[tag])
            if tag in ("html", "body") and tree.all[tag]:
                continue
            node = Node(tag, tree.here, _mark(tag, attrs, tree.here.within))
            tree.here.parts.append(node)
            if tag not in _VOID:
                tree.push(node)


def _up(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


def blocks(node: Node, leave: Callable[[Node], bool] | None = None) -> list[str]:
    """Texts of the blocks in page order: references decoded, white space as one space, trimmed, none empty.

    Elements that ``leave`` names are left out.
    """
    out: list[str] = []
    buffer: list[str] = []

    def flush():
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append(text)

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            buffer.append(x)
        elif leave is not None and leave(x):
            buffer.append(" ")
        else:
            block = x.tag in _BLOCK
            if block:
                flush()
                todo.append(None)
            todo.extend(reversed(x.parts))
    flush()
    return out


def _order(root: Node) -> list[Node]:
    """All elements in page order, each with the number of its own texts' characters."""
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        x.own = sum(len(html.unescape(" ".join(p.split()))) for p in x.parts if isinstance(p, str))
        todo.extend(p for p in reversed(x.parts) if isinstance(p, Node))
    return order


def _restore(order: list[Node], body: Node) -> None:
    """Takes the marks off furniture that holds most of the page's unlinked text with little beside it.

    A form or a marked wrapper around a whole article is such an element; readers' words must be all that there is.
    """
    for x in reversed(order):
        x.free += 0 if x.tag == "a" else x.own
        if x.parent is not None:
            x.parent.free += 0 if x.tag == "a" else x.free
            x.parent.under += x.free if x.mark >= FURNITURE else x.under  # unlinked text in the outermost marks
    rest = body.free - body.under
    covered: set[Node] = set()
    for x in order:
        if x.parent in covered:
            covered.add(x)
        elif x.mark >= FURNITURE:
            least = {FURNITURE: x.free > 4 * rest, READERS: not rest, UNSEEN: False}[x.mark]
            if least and 2 * x.free > body.free:
                x.mark = TEXT
                rest += x.free - x.under
            else:
                covered.add(x)


def measure(order: list[Node]) -> None:
    """Fills the density figures of all elements, children first; furniture weighs nothing in itself or above it."""
    for x in reversed(order):
        x.chars += x.own
        if x.tag == "a":
            x.link_chars = x.chars
        if x.parent is not None and x.mark < FURNITURE:
            x.parent.chars += x.chars
            x.parent.tags += x.tags + 1
            x.parent.link_chars += x.link_chars
            x.parent.link_tags += x.link_tags + (x.tag == "a")


def density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Composite text density; ``share`` is the body's share of link characters."""
    if not chars:
        return 0.0
    tags, links = max(tags, 1), max(link_tags, 1)
    linked, other = max(link_chars, 1), max(chars - link_chars, 1)
    base = math.log(chars / other * linked + share * chars + math.e)
    value = max(chars / linked * tags / links, 1.0)
    return chars / tags * math.log(value + 1) / math.log(base + 1e-9)


def _densities(order: list[Node], body: Node) -> None:
    share = body.link_chars / max(body.chars, 1)
    for x in order:
        if x.mark < FURNITURE:
            x.density = density(x.chars, x.tags, x.link_chars, x.link_tags, share) * (0.5 if x.mark == HINT else 1.0)
            if x.parent is not None:
                x.parent.total += x.density


def _left(x: Node) -> bool:
    """Whether an element inside the main text is none of it: furniture, or a hint of it that is mostly links."""
    return x.mark >= FURNITURE or x.mark == HINT and 2 * x.link_chars > x.chars


def main_nodes(root: Node) -> list[Node]:
    """The elements that hold the main text, in page order, none inside another."""
    order = _order(root)
    body = next((x for x in order if x.tag == "body"), root)
    _restore(order, body)
    measure(order)
    _densities(order, body)
    inside, first = [], order.index(body)
    hidden: set[Node] = set()
    for x in order[first:]:
        if x is not body and x.parent.tag == "html" and x.parent is body.parent:
            break  # behind the body
        if x.parent in hidden or x.mark >= FURNITURE:
            hidden.add(x)
        else:
            inside.append(x)
    core = max(inside, key=lambda x: x.total, default=body)
    if not core.total:
        return [body]
    path = []
    for x in _up(core):
        path.append(x)
        if x is body:
            break
    threshold = min(x.density for x in path)
    whole = next((x for x in path if x.tag in ("article", "main")), None)
    articles = [p for p in core.parts if isinstance(p, Node) and p.tag in ("article", "main")]
    if whole is None and len(articles) == 1 and articles[0].density >= threshold:
        whole = articles[0]
    if whole is not None:
        return [whole]
    if core is body:
        return [body]
    chosen, todo, way = [], [body], set(path)
    while todo:
        x = todo.pop()
        if x is core:
            chosen.append(x)
        elif x in way:
            todo.extend(p for p in reversed(x.parts) if isinstance(p, Node) and not _left(p))
        elif x.tag in _BLOCK and (x.density >= threshold or 2 * x.link_chars <= x.chars and (x.tag in _HEADINGS or x.tag in _TEXTS and x.parent is not body)):
            chosen.append(x)
    return chosen


def extract(page: str | None) -> str:
    """The main text of a page; empty for null, empty and text-free pages."""
    if not page:
        return ""
    return " ".join(t for n in main_nodes(parse(page)) for t in blocks(n, _left))


def plain_text(page: str | None) -> str:
    """All visible text of a page, a line for each block."""
    return "\n".join(blocks(parse(page))) if page else ""


def main_text(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of each page in ``into``, replacing a column of that name.

    Null and empty pages give an empty text; texts are whole whatever the page's length; repeated rows stay repeated;
    an empty table gives an empty table.
    """

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return column.map(extract).astype(object)

    return pages.withColumn(into, run(F.col(html_col)))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page and its number of code points."""
    pages = common.table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

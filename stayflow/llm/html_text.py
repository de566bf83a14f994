"""Main text of web pages by tree scoring.

The page is read into a tree.  Every paragraph gives points for its length and commas to its parent and
half of them to its grandparent; a container's points are discounted by the share of its text that
stands in links.  The best container is kept (or the article it lies in) together with those siblings
that score well or hold plain text, and their text is joined in page order.

Parts that are never main text are left out first: navigation, page headers and footers, asides, forms,
scripts, styles, and parts whose class, id or role names adverts, notices, comments and the like.  Such
a name is not believed of a part with the article or nearly all plain text, except for comments.

Edge cases: a null or empty page gives the empty text.  Unclosed, stray and crossed tags are read as
browsers do for the common cases; comments and declarations are dropped; text without any tag is main
text.  Pages of any length are read whole; the work grows
with their length whatever their tags.  Repeated rows give repeated results.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_MARKUP = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Names of HTML elements, and words that class and id names commonly use.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = RAW | set(
    "head nav footer aside form noscript template iframe object svg canvas select button input dialog menu "
    "audio video map datalist fieldset label".split()
)
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
PARAGRAPH = {"p", "pre", "td", "blockquote", "li", "dd", "figcaption"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = BLOCK - {"br", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}}
SAME |= {"th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
HOLDERS = set("article aside blockquote body details div dl fieldset figure footer form header html main nav ol section table td th ul".split())
UNLIKELY = set(
    "ad ads adbox adslot advert adverts advertisement adsense sponsor sponsored promo promotion banner sidebar "
    "sidebars nav navbar navigation menu menus breadcrumb breadcrumbs cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
    "widget toolbar skip pagination pager masthead footer login search outbrain taboola disclaimer alert".split()
)
COMMENTS = set("comment comments disqus replies respond commentlist discussion".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())


# facts about a subtree, as bits
_FACTS = {"main": 1, "article": 2, "h1": 4}


class Node:
    """An element.  ``scope`` is the nearest holder around it (or itself), whose ``open`` counts open tags inside."""

    __slots__ = ("tag", "names", "role", "hidden", "parent", "parts", "points", "text", "links", "facts", "scope", "open")

    def __init__(self, tag: str, parent, attributes: str = ""):
        self.tag, self.parent, self.parts = tag, parent, []
        self.names, self.role, self.points, self.text, self.links, self.facts = set(), "", 0.0, 0, 0, 0
        holds = parent is None or tag in HOLDERS
        self.scope, self.open = (self, {}) if holds else (parent.scope, None)
        self.hidden = bool(attributes) and _HIDDEN.search(attributes) is not None
        for kind, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
            value = next((v for v in values if v), "")
            if kind.lower() == "role":
                self.role = value.strip().lower()
            else:
                self.names |= {w.lower() for w in _NAME.findall(value)}


class _Ends:
    """Where tags end.  What has been found to be missing from the rest of a page is not looked for again."""

    def __init__(self, page: str):
        self.page, self.last, self.missing, self.quoted = page, page.rfind(">"), set(), True

    def of(self, at: int) -> int:
        """Position after the ``>`` that ends a tag whose attributes begin at ``at``; 0 if there is none.

        A ``>`` in quotes ends nothing, unless a quote is never closed.
        """
        page, start = self.page, at
        while self.quoted and at <= self.last:
            at = _UNQUOTED.match(page, at).end()
            if at >= len(page):
                break
            mark = page[at]
            if mark == ">":
                return at + 1
            close = -1 if mark in self.missing else page.find(mark, at + 1)
            if close < 0:
                self.missing.add(mark)
            at = max(close, at) + 1
        if start > self.last:
            return 0
        self.quoted = False  # no tag of the rest ends outside its quotes
        return page.find(">", start) + 1


def parse(page: str) -> Node:
    """The tree of a page; text parts are strings with references decoded."""
    root = Node("html", None)
    now, at, size, ends = root, 0, len(page), _Ends(page)
    opened: dict[str, int] = {}  # open tags of the whole page

    def leave(to: Node) -> Node:
        node = now
        while node is not to:
            opened[node.tag] -= 1
            if node.open is None:
                node.scope.open[node.tag] -= 1
            node = node.parent
        return to

    text_from = 0
    while True:
        found = _MARKUP.search(page, at)
        if found is None:
            break
        start = found.start()
        if found[2] is None:
            if found[0] == "<!--":
                end = page.find("-->", found.end())
                end = size if end < 0 else end + 3
            else:
                end = page.find(">", start) + 1 if start < ends.last else 0
        else:
            end = ends.of(found.end())
        if not end:  # no tag: part of the text
            at = found.end()
            continue
        if start > text_from:
            now.parts.append(html.unescape(page[text_from:start]))
        at = text_from = end
        if found[2] is None:
            continue
        tag, closing, attributes = found[2].lower(), bool(found[1]), page[found.end() : end - 1]
        if closing:
            if opened.get(tag):
                now = leave(_closed(now, tag))
            continue
        if tag == "html":
            continue
        if now.tag == "head" and tag in ("body", "div", "p", "article", "main", "section", "nav", "header"):
            now = leave(now.parent)
        now = leave(_open_before(now, tag))
        node = Node(tag, now, attributes)
        now.parts.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            raw = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
            at = text_from = raw.end() if raw else size
            continue
        if not attributes.rstrip().endswith("/") or tag in BLOCK:
            now = node
            opened[tag] = opened.get(tag, 0) + 1
            if node.open is None:
                node.scope.open[tag] = node.scope.open.get(tag, 0) + 1
    if text_from < size:
        now.parts.append(html.unescape(page[text_from:]))
    return root


def _closed(now: Node, tag: str) -> Node:
    """The node that is open after an end tag."""
    if tag not in BLOCK and not now.scope.open.get(tag) and now.scope.tag != tag:
        return now  # an inline end tag does not reach out of the holder that it stands in
    node = now
    while node.parent is not None and node.tag != tag:
        if tag not in BLOCK and node.tag in HOLDERS:
            return now
        node = node.parent
    return node.parent if node.tag == tag and node.parent is not None else now


def _open_before(now: Node, tag: str) -> Node:
    """Close what the start of ``tag`` ends: an open paragraph, or an item of the same list."""
    if tag in CLOSES_P or tag in SAME:
        ends = SAME.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        if now.scope.tag not in ends and not any(now.scope.open.get(e) for e in ends):
            return now
        node = now
        while node is not None and (node.tag not in HOLDERS or node.tag in ends):
            if node.tag in ends:
                return node.parent
            node = node.parent
    return now


def _measure(node: Node) -> None:
    """Characters of text and of link text below each node, and what it holds (children before parents)."""
    order, stack = [], [node]
    while stack:
        n = stack.pop()
        order.append(n)
        stack.extend(p for p in n.parts if isinstance(p, Node))
    for n in reversed(order):
        for part in n.parts:
            if isinstance(part, Node):
                n.text += part.text
                n.links += part.text if part.tag == "a" else part.links
                n.facts |= part.facts | _FACTS.get(part.tag, 0)
            else:
                n.text += len(part.strip())


def _prune(root: Node) -> None:
    """Take out what is never main text."""
    _measure(root)
    plain = root.text - root.links
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        kept = []
        for part in node.parts:
            if isinstance(part, Node):
                if _boilerplate(part, inside, plain):
                    kept.append(" ")
                    continue
                stack.append((part, inside or part.tag in ("article", "main")))
            kept.append(part)
        node.parts = kept


def _boilerplate(node: Node, inside: bool, plain: int) -> bool:
    if node.tag in DROPPED or node.hidden:
        return True
    if node.tag in ("body", "html"):
        return False
    if node.tag == "header" or node.role in ROLES:
        return not (inside and node.tag == "header")
    if node.names & COMMENTS:
        return node.tag != "main" and not node.facts & _FACTS["main"]
    unlikely = node.names & UNLIKELY or ("header" in node.names and not inside)
    if not unlikely or node.tag == "main":
        return False
    # inline parts are words of their sentence, and an article's paragraphs and headings its text, whatever their names
    if node.tag not in BLOCK or (inside and (node.tag in PARAGRAPH or node.tag in HEADING)):
        return False
    # a name that would take nearly all plain text, or the article, is the layout's
    return 5 * (node.text - node.links) <= 4 * plain and not node.facts


def _density(node: Node) -> float:
    return node.links / node.text if node.text else 0.0


def _score(root: Node) -> list[Node]:
    """Give points for every paragraph; the containers that got any."""
    scored: list[Node] = []

    def give(node: Node | None, points: float) -> None:
        if node is not None:
            if not node.points:
                scored.append(node)
                if node.tag in ("article", "main"):
                    node.points += 25.0
            node.points += points

    # every piece of text belongs to the nearest block around it
    blocks, texts, stack = [], [], [(root, 0)]
    blocks.append(root)
    texts.append([])
    while stack:
        node, owner = stack.pop()
        for part in reversed(node.parts):
            if isinstance(part, str):
                texts[owner].append(part)
            elif _is_block(part):
                blocks.append(part)
                texts.append([])
                stack.append((part, len(blocks) - 1))
            else:
                stack.append((part, owner))
    for node, own in zip(blocks, map("".join, texts)):
        length = len(own.strip())
        if not length:
            continue
        points = 1.0 + own.count(",") + min(length / 100.0, 3.0)
        if node.tag in PARAGRAPH:
            give(node.parent, points)
            give(node.parent.parent if node.parent else None, points / 2)
        elif node.tag in HOLDERS and node.tag != "html":
            give(node, points)  # text that stands in a container without a paragraph
            give(node.parent, points / 2)
        elif node.tag in HEADING:
            give(node.parent, 0.5)
    return scored


def _is_block(part) -> bool:
    return isinstance(part, Node) and part.tag in BLOCK and part.tag != "br"


def _text_of(node: Node) -> str:
    """Text below a node, blocks set apart by spaces."""
    out: list[str] = []
    stack: list = [node]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.tag in BLOCK:
            stack.extend([" ", *reversed(part.parts), " "])
        else:
            stack.extend(reversed(part.parts))
    return "".join(out)


def main_text(page: str | None) -> str:
    """Main text of a page: white space runs become one space, blocks are joined by one space."""
    if not page:
        return ""
    root = parse(page)
    _prune(root)
    stack = [root]
    while stack:  # measured anew without the parts that are gone
        node = stack.pop()
        node.text = node.links = 0
        stack.extend(p for p in node.parts if isinstance(p, Node))
    _measure(root)
    scored = [n for n in _score(root) if n.text]
    if not scored:
        return " ".join(_text_of(root).split())
    best = max(scored, key=lambda n: n.points * (1.0 - _density(n)))
    top, node = best, best
    while node is not None:
        if node.tag in ("article", "main"):
            top = node
            break
        node = node.parent
    parent = top.parent
    if parent is None:
        return " ".join(_text_of(top).split())
    enough = max(10.0, 0.2 * best.points * (1.0 - _density(best)))
    keep = [p for p in parent.parts if p is top or (isinstance(p, Node) and _joins(p, top, enough))]
    return " ".join(" ".join(_text_of(p) for p in keep).split())


def _joins(node: Node, top: Node, enough: float) -> bool:
    """Whether a sibling of the best container belongs to the main text."""
    if not node.text:
        return False
    if node.points and node.points * (1.0 - _density(node)) >= enough:
        return True
    if top.tag in ("article", "main"):
        return False
    return (node.tag in PARAGRAPH or node.tag in HEADING) and _density(node) < 0.25


def extract(page: Column | str) -> Column:
    """Column of the main text of a column of pages; never null."""

    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return texts(page)

"""Main text of web pages by tree scoring.

A page becomes a tree of elements.  Parts that are no article by their tag, role or
name are left out.  Every paragraph earns points for its length and its commas, less
its share of link text, and passes them to its ancestors: all to the container it
stands in, half of that one step further up, and so on.  The container with the most
points, discounted by its own share of link text, is kept, and its siblings that are
nearly as good.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, prepare

#: Elements by what they do.  Those of RAW hold text, no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
PARAGRAPHS = frozenset("p pre li dt dd td th caption figcaption address summary h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset(
    "html body article main section div header footer aside nav form fieldset blockquote center figure "
    "details ul ol dl menu table tbody thead tfoot tr dialog hgroup search".split())
BLOCKS = PARAGRAPHS | CONTAINERS
LISTS = frozenset("ul ol dl table div section p".split())
#: An open element of the first kind is closed by a start of the second,
#: unless one of the third stands between.
_SCOPE = frozenset("table td th caption button object ul ol dl blockquote div section article".split())
CLOSED_BY = {
    "li": ({"li"}, frozenset(("ul", "ol", "menu"))),
    "dt": ({"dt", "dd"}, frozenset(("dl",))), "dd": ({"dt", "dd"}, frozenset(("dl",))),
    "td": ({"td", "th"}, frozenset(("table", "tr"))), "th": ({"td", "th"}, frozenset(("table", "tr"))),
    "tr": ({"tr"}, frozenset(("table",))), "option": ({"option"}, frozenset(("select",))),
    "body": ({"head"}, frozenset()),
}
#: What is never part of an article, by tag, by role and by the words of
#: class and identifier; a layout word takes the meaning from the names beside it.
DROPPED = frozenset(
    "head title script style noscript template iframe object embed canvas svg audio video map nav aside "
    "footer form button select textarea input datalist dialog menu noembed noframes".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
    "toolbar".split())
COMMENTS = frozenset("comment comments commentlist disqus respond replies".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe signup sidebar widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs "
    "footer header masthead topbar toolbar pagination pager share sharing social related recommended "
    "recommendations login search copyright".split())
LAYOUT = frozenset("with has no without".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_TAG = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_END = re.compile(r"[^>]*>")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_COMMAS = re.compile("[,、，،]")

#: Points of a paragraph besides those for commas: one, and one for so many characters,
#: up to a limit.
CHARS_A_POINT, MOST_LENGTH_POINTS = 100, 3.0
#: A sibling stays with this share of the best container's points.
SIBLING_SHARE = 0.2
#: A paragraph beside it, or a part with the same tag and classes, stays below this
#: share of link text.
MOST_LINKED = 0.25
#: A list of so many links and such a share of link text is a menu.
MENU_LINKS, MENU_SHARE = 3, 0.9


class Node:
    __slots__ = ("tag", "parent", "kids", "drop", "soft", "article", "inside", "name", "first", "last", "points")

    def __init__(self, tag: str, parent: "Node | None"):
        self.tag, self.parent = tag, parent
        self.kids: list[Node | str] = []
        self.drop = self.soft = False  # out in any case; out unless an article is inside
        self.article = tag in ("article", "main")
        self.inside = parent is not None and (parent.article or parent.inside)
        self.name = ""  # its classes
        self.first = self.last = 0  # the blocks below, as a range
        self.points = 0.0


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("text" | "start" | "end", text or tag, attributes) in page order."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], {}
            return
        if lt > at:
            yield "text", page[at:lt], {}
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2)
            at = n if end < 0 else end + 3
            continue
        closing = page.startswith("</", lt)
        tag = _TAG.match(page, lt + 1 + closing)
        if not tag:
            if closing or page[lt + 1:lt + 2] in ("!", "?"):  # a declaration, or no tag at all
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                yield "text", "<", {}
                at = lt + 1
            continue
        name, at, attributes = tag.group().lower(), tag.end(), {}
        while m := _ATTRIBUTE.match(page, at):
            attributes.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
            at = m.end()
        end = _END.match(page, at)
        at = end.end() if end else n
        if closing:
            yield "end", name, {}
            continue
        yield "start", name, attributes
        if name in RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            at = stop.start() if stop else n  # the text in it is no part of an article


def judge(node: Node, attributes: dict[str, str]) -> None:
    """Mark what is no article by its tag, role or names."""
    tag, inside, node.name = node.tag, node.inside, attributes.get("class", "")
    if ("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
            or _HIDDEN.search(attributes.get("style", ""))):
        node.drop = tag not in ("html", "body")
    if tag in DROPPED or tag == "header" and not inside:
        if tag in ("form", "header"):
            node.soft = True
        else:
            node.drop = True
    if attributes.get("role", "").lower() in DROPPED_ROLES:
        node.soft = True
    if tag in ("html", "body", "main"):
        node.soft = False
        return
    names = {w.lower() for w in _NAME.findall(
        node.name + " " + attributes.get("id", ""))}
    if names & COMMENTS and not names & LAYOUT:
        node.drop = True
    elif names & DROPPED_NAMES and not names & LAYOUT:
        found = names & DROPPED_NAMES
        if found == {"header"} and (inside or tag in HEADINGS):
            return
        node.soft = tag != "article"


def tree(page: str) -> Node:
    """Elements of a page; ends that are missing or crossed are mended."""
    root = Node("#page", None)
    stack, open_tags = [root], Counter()

    def pop_to(k: int) -> None:
        while len(stack) > k:
            open_tags[stack.pop().tag] -= 1

    def close(tags: set[str], stop: frozenset[str]) -> None:
        """Close the innermost open element of ``tags`` that no ``stop`` shields."""
        if not any(open_tags[t] for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                pop_to(k)
                return
            if stack[k].tag in stop:
                return

    for kind, value, attributes in tokens(page):
        if kind == "text":
            stack[-1].kids.append(value)
        elif kind == "end":
            if not open_tags[value]:
                continue
            inline = value not in BLOCKS
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == value:
                    pop_to(k)
                    break
                if inline and stack[k].tag in BLOCKS:
                    break  # an inline end does not close blocks that began later
        else:
            if value in CLOSED_BY:
                close(*CLOSED_BY[value])
            if value in BLOCKS:
                close({"p"}, _SCOPE)
                if value in HEADINGS and stack[-1].tag in HEADINGS:
                    pop_to(len(stack) - 1)
            node = Node(value, stack[-1])
            judge(node, attributes)
            stack[-1].kids.append(node)
            if value not in VOID:
                stack.append(node)
                open_tags[value] += 1
    return root


class Page:
    """Blocks of text in page order, and the tree over them."""

    def __init__(self, page: str):
        self.root = tree(page)
        self._mark_articles()
        self.texts: list[str] = []
        self.holders: list[Node] = []  # the block element that a text stands in
        self.linked: list[int] = []
        self.links: list[int] = []
        self._cut()
        size = [len(t) for t in self.texts]
        self.size, self.link_size, self.link_count = (
            np.concatenate([[0], np.cumsum(np.array(x, np.int64))]) for x in (size, self.linked, self.links))

    def _mark_articles(self) -> None:
        """A soft mark falls where an article stands inside."""
        order, todo = [], [self.root]
        while todo:
            node = todo.pop()
            order.append(node)
            todo += [k for k in node.kids if not isinstance(k, str)]
        holds: set[int] = set()
        for node in reversed(order):
            own = id(node) in holds
            if node.soft and not own:
                node.drop = True
            if (own or node.article) and not node.drop and node.parent is not None:
                holds.add(id(node.parent))

    def _cut(self) -> None:
        parts: list[str] = []
        linked = links = breaks = 0
        holder = self.root

        def flush() -> None:
            nonlocal linked, links
            text = " ".join("".join(parts).split())
            if text:
                self.texts.append(text)
                self.holders.append(holder)
                self.linked.append(min(linked, len(text)))
                self.links.append(links)
            parts.clear()
            linked = links = 0

        # (node, its next child, the block element around, links around)
        todo = [(self.root, iter(self.root.kids), self.root, 0)]
        while todo:
            node, kids, block, depth = todo[-1]
            for kid in kids:
                if isinstance(kid, str):
                    text = entities.unescape(kid)
                    if text.strip():
                        breaks = 0
                    parts.append(text)
                    if depth:
                        linked += len(" ".join(text.split()))
                    continue
                if kid.drop:
                    kid.first = kid.last = len(self.texts)
                    continue
                if kid.tag == "br":
                    breaks += 1
                    parts.append("\n")
                    if breaks == 2:  # an empty line ends a block
                        flush()
                    continue
                if kid.tag in VOID:
                    if kid.tag == "hr":
                        flush()
                    continue
                own = block
                if kid.tag in BLOCKS:
                    flush()
                    holder = own = kid
                    breaks = 0
                elif kid.tag == "a":
                    links += 1
                kid.first = len(self.texts)
                todo.append((kid, iter(kid.kids), own, depth + (kid.tag == "a")))
                break
            else:
                todo.pop()
                if node.tag in BLOCKS or node is self.root:
                    flush()
                    holder = todo[-1][2] if todo else self.root
                node.last = len(self.texts)

    def link_share(self, node: Node) -> float:
        size = self.size[node.last] - self.size[node.first]
        return float(self.link_size[node.last] - self.link_size[node.first]) / size if size else 0.0

    def containers(self) -> list[Node]:
        """Block elements that hold text, parents first, with their points."""
        order, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if node.drop or node.last == node.first and node is not self.root:
                continue
            if node.tag in CONTAINERS or node is self.root:
                order.append(node)
            todo += [k for k in reversed(node.kids) if not isinstance(k, str)]
        for text, holder, linked in zip(self.texts, self.holders, self.linked):
            points = 1 + min(len(text) / CHARS_A_POINT, MOST_LENGTH_POINTS) + len(_COMMAS.findall(text))
            points *= 1 - linked / len(text)
            self._above(holder).points += points
        for node in reversed(order):
            up = self._above(node.parent)
            if up is not None:
                up.points += node.points / 2
        return order

    def _above(self, node: Node | None) -> Node | None:
        """The container that an element is or stands in."""
        while node is not None and node.tag not in CONTAINERS and node is not self.root:
            node = node.parent
        return node

    def main_text(self) -> str:
        order = self.containers()
        scores = [n.points * (1 - self.link_share(n)) for n in order]
        if not scores or max(scores) <= 0:
            return ""
        best = order[int(np.argmax(scores))]  # ties: the outermost, then the first
        score = max(scores)
        node, inside = best, None
        while node is not None:  # an article is kept whole
            if node.article and (inside is None or node.tag == "article"):
                inside = node
            node = node.parent
        best = inside or best
        kept = np.zeros(len(self.texts), bool)
        kept[best.first:best.last] = True
        around = best.parent
        if around is not None:
            of = dict(zip(map(id, order), scores))
            for kid in around.kids:
                if kid is best or isinstance(kid, str) or kid.drop:
                    continue
                alike = kid.tag == best.tag and kid.name == best.name and (kid.name or kid.tag == "section")
                if kid.tag in HEADINGS or of.get(id(kid), 0.0) >= SIBLING_SHARE * score or (
                        (alike or kid.tag in PARAGRAPHS) and self.link_share(kid) < MOST_LINKED):
                    kept[kid.first:kid.last] = True
        todo = [k for k in (around or best).kids if not isinstance(k, str)]
        while todo:
            node = todo.pop()
            if node.drop or node.first == node.last:
                continue
            if (node.tag in LISTS and self.link_count[node.last] - self.link_count[node.first] >= MENU_LINKS
                    and self.link_share(node) >= MENU_SHARE):
                kept[node.first:node.last] = False
                continue
            todo += [k for k in node.kids if not isinstance(k, str)]
        return "\n\n".join(t for t, k in zip(self.texts, kept.tolist()) if k)


def main_text(page: str | None) -> str:
    """The main text of a page; an empty one if there is none.

    Character references are decoded; white space of any kind (line breaks, breaks
    by ``br`` and no-break spaces too) becomes one space inside a block, two ``br`` in
    a row or an ``hr`` start another block.  Blocks follow in page order, with an
    empty line between.  Text without markup is one block."""
    return Page(page).main_text() if page else ""


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """The struct ``_row`` (all columns), ``text`` (never null) and ``n_chars`` (its
    code points) of every whole page.

    A null or empty page has an empty text.  Repeated pages are read each for itself.
    An empty table gives an empty result; columns of any name are carried inside
    ``_row``.  Nothing is shuffled; a task holds the trees of one page at a time."""
    prepare(pages.sparkSession)

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in column], pa.string())

    return (pages.select(packed(pages), texts(F.col(f"`{html}`")).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))

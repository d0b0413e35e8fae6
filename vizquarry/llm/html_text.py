"""Main text of web pages by tree scoring.

Each page becomes a tree. Parts that never hold the article (menus, forms, scripts ...) are cut off; a class or id name
cuts no wrapper of the article. Every paragraph
scores a point, a point for each comma and up to three for its length, discounted by the share of its text that stands
in links; its parent receives the points, its grandparent half of them, and each ancestor above a third of what the
one below got. The container with the most points after its own link discount is the article, or the article element
around it; siblings that aren't cut and aren't mostly links are kept with it. Inside the article a class or id cuts only what it names
outright, or what has links or controls besides.

Defined results: a null, empty or unparsable html gives an empty text; white space inside a block becomes one
space, blocks are joined by one \\n in page order; ties go to the container that comes first; repeated rows give
repeated results; an empty table gives an empty result; columns other than the three named are not read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame, functions as F

# Element names and the words in class and id names that mark what is not the article.
CUT_TAGS = frozenset(
    "head title script style noscript template iframe svg canvas object embed video audio map nav header footer aside "
    "form button select option textarea input label fieldset dialog menu".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html "
    "li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH_TAGS = frozenset("p pre blockquote td dd li h2 h3 h4 h5 h6 figcaption".split())
WHOLE_TAGS = frozenset("html body article main".split())
CUT_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner comment comments disqus "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices popup modal "
    "overlay footer masthead topbar share sharing social related newsletter subscribe signup login pagination pager "
    "widget skip toolbar".split()
)
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Marks of what readers write, which may be longer than the article.
COMMENT_WORDS = frozenset("comment comments disqus".split())
#: Words that need no second sign inside the article.
SURE_WORDS = COMMENT_WORDS | frozenset("ad ads advert advertisement adverts advertising sponsor sponsored".split())
#: Controls that may stand in a sentence.
INLINE_CONTROLS = frozenset("button label".split())
#: What an element with controls of its own holds.
CONTROLS = frozenset("form button input select textarea nav".split())
#: What a head holds; anything else ends it.
HEAD_TAGS = frozenset("head title meta link script style noscript template base basefont bgsound noframes".split())
#: An element that is still open is closed when one of these begins.
CLOSED_BY = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}
#: How far up an implied end reaches.
SCOPES = frozenset("html body table ul ol dl article section div main td th blockquote".split())
_WORDS = re.compile(r"[a-z]+")
_COMMAS = re.compile(r"[,،、，]")


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "named", "sure", "score", "scored", "length", "linked", "order")

    def __init__(self, tag: str, parent: Node | None, cut: bool, order: int):
        self.tag, self.parent, self.cut, self.order = tag, parent, cut, order
        self.parts: list = []
        self.named: set = set()
        #: The names alone tell; otherwise they need a second sign inside an article.
        self.sure = False
        self.score, self.scored, self.length, self.linked = 0.0, False, 0, 0


def names(tag: str, attributes: list) -> set:
    """The words in class and id that say that the element is no part of the article."""
    if tag in WHOLE_TAGS and tag != "article":
        return set()
    found = {w for name, value in attributes if name in ("class", "id") for w in _WORDS.findall((value or "").lower())}
    return found & (COMMENT_WORDS if tag == "article" else CUT_WORDS)


def only_named(attributes: list) -> bool:
    """Does a class or id consist of such words alone, or name an advert or a reader's comment?"""
    for name, value in attributes:
        if name in ("class", "id"):
            for word in (value or "").lower().split():
                parts = set(_WORDS.findall(word))
                if parts and (parts <= CUT_WORDS or parts & SURE_WORDS):
                    return True
    return False


def marked(tag: str, attributes: list) -> bool:
    """Does the element say itself, other than by a name, that it is no part of the article?"""
    if tag in CUT_TAGS:
        return True
    if tag in WHOLE_TAGS:
        return False
    for name, value in attributes:
        value = (value or "").lower()
        if name == "role" and value in CUT_ROLES or name == "aria-hidden" and value == "true":
            return True
        if name == "hidden" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


class Tree(HTMLParser):
    """Nodes in page order; unclosed and stray tags are mended as browsers do, roughly."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", None, False, 0)
        self.nodes = [self.root]

    def _close(self, tags: tuple, scopes=SCOPES) -> None:
        node = self.at
        while node.parent is not None:
            if node.tag in tags:
                self.at = node.parent
                return
            if node.tag in scopes:
                return
            node = node.parent

    def parse_html_declaration(self, i):
        """A marked section that the library doesn't know is a bogus comment, as in browsers."""
        try:
            k = super().parse_html_declaration(i)
        except AssertionError:
            k = -1
        if k < 0 and self.rawdata.startswith("<![", i):
            k = self.rawdata.find(">", i) + 1 or len(self.rawdata)
        return k

    def _end_head(self, anywhere: bool) -> None:
        node = self.at
        while anywhere and node.parent is not None and node.tag != "head":
            node = node.parent
        if node.tag == "head":
            self.at = node.parent

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD_TAGS:
            self._end_head(tag == "body")
        if tag in BLOCK_TAGS:
            self._close(("p",))
        if tag in CLOSED_BY:
            self._close(CLOSED_BY[tag], SCOPES - {"td", "th"})
        node = Node(tag, self.at, self.at.cut or marked(tag, attrs), len(self.nodes))
        if not node.cut:
            node.named, node.sure = names(tag, attrs), only_named(attrs)
        self.at.parts.append(node)
        self.nodes.append(node)
        if tag not in VOID_TAGS:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        if self.at.tag == "head" and data.strip():
            self._end_head(False)
        if not self.at.cut or self.at.tag in INLINE_CONTROLS and not self.at.parent.cut:
            self.at.parts.append(data)


def parse(html: str) -> list[Node]:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree.nodes


def measure(nodes: list[Node]) -> None:
    """Text and linked text of every node; nodes are in page order, so children come after parents."""
    for node in reversed(nodes):
        own = sum(len(x) for x in node.parts if isinstance(x, str))
        node.length += own
        node.linked = node.length if node.tag == "a" else node.linked
        if node.parent is not None and not node.cut:
            node.parent.length += node.length
            node.parent.linked += node.linked


def density(node: Node) -> float:
    return min(1.0, node.linked / node.length) if node.length else 0.0


def inner_text(node: Node) -> str:
    found, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            found.append(x)
        elif not x.cut:
            todo.extend(reversed(x.parts))
    return "".join(found)


def is_paragraph(node: Node) -> bool:
    if node.tag in PARAGRAPH_TAGS:
        return True
    blocks = any(not isinstance(x, str) and x.tag in BLOCK_TAGS for x in node.parts)
    own = any(isinstance(x, str) and x.strip() for x in node.parts)
    return own and (node.tag in ("div", "section") and not blocks or node.tag in ("article", "main", "body", ""))


def paragraph_points(node: Node) -> float:
    if node.cut or not node.length or not is_paragraph(node):
        return 0.0
    text = " ".join(inner_text(node).split())
    return (1 + len(_COMMAS.findall(text)) + min(len(text) / 100, 3)) * (1 - density(node)) if text else 0.0


def spare_words(nodes: list[Node]) -> None:
    """A control of plain text inside a sentence is part of it."""
    for x in nodes[1:]:
        if x.tag in INLINE_CONTROLS and x.cut and not x.parent.cut and x.parts and all(isinstance(p, str) for p in x.parts):
            if any(isinstance(p, str) and p.strip() for p in x.parent.parts):
                x.cut = False


def cut_named(nodes: list[Node]) -> None:
    """Cut what its name marks, but not a wrapper of the article.

    That is an element with the main element and, where no article or main element has paragraphs outside named elements,
    one with over three quarters of the page's paragraph points, comments aside, or with an article element.
    """
    measure(nodes)
    named, commented = [False] * len(nodes), [False] * len(nodes)
    for x in nodes[1:]:
        named[x.order] = bool(x.named) or named[x.parent.order]
        commented[x.order] = not COMMENT_WORDS.isdisjoint(x.named) or commented[x.parent.order]
    inside = [False] * len(nodes)
    for x in nodes[1:]:
        inside[x.order] = x.tag in ("article", "main") or inside[x.parent.order]
    outside = any(inside[x.order] and not named[x.order] and paragraph_points(x) for x in nodes)
    points = [0.0 if commented[x.order] else paragraph_points(x) for x in nodes]
    several = [int(p > 0) for p in points]
    holds = [x.tag == "main" or x.tag == "article" and not outside and not commented[x.order] for x in nodes]
    for x in reversed(nodes[1:]):
        if not x.cut:
            points[x.parent.order] += points[x.order]
            several[x.parent.order] += several[x.order]
            holds[x.parent.order] |= holds[x.order] and bool(x.length)
    plain = any(x.tag == "article" and not x.named and not x.cut for x in nodes)
    controls = [x.tag in CONTROLS for x in nodes]
    for x in reversed(nodes[1:]):
        controls[x.parent.order] |= controls[x.order]
    for x in nodes[1:]:
        if x.tag == "article":  # a reader's comment, unless the page has no other article
            x.cut = x.cut or x.parent.cut or bool(x.named) and plain
            continue
        # Inside the article a name that may as well be a topic's needs a second sign: links or controls.
        if x.named and inside[x.order] and not x.sure and density(x) < 0.25 and not controls[x.order]:
            x.cut = x.cut or x.parent.cut
            continue
        wraps = holds[x.order] or not outside and several[x.order] > 1 and 4 * points[x.order] > 3 * points[0]
        x.cut = x.cut or x.parent.cut or bool(x.named) and not wraps
    for x in nodes:
        x.length = x.linked = 0


def best_container(nodes: list[Node]) -> Node | None:
    for node in nodes:
        points = paragraph_points(node)
        if node.cut or not points and not (node.length and is_paragraph(node) and inner_text(node).strip()):
            continue
        above, share = (node.parent, 1.0) if node.parent is not None and node.tag not in ("article", "main", "body") else (node, 1.0)
        level = 0
        while above is not None and points * share > 1e-3:
            above.score += points * share
            above.scored = True
            above, level = above.parent, level + 1
            share = share / 2 if level == 1 else share / 3
    scored = [n for n in nodes if n.scored and not n.cut]
    if not scored:
        return None
    best = max(scored, key=lambda n: (n.score * (1 - density(n)), -n.order))
    around = best
    while around is not None and around.tag not in ("article", "main"):
        around = around.parent
    return around or best


def kept_siblings(best: Node) -> list[Node]:
    """The best container with the siblings that belong to it, in page order.

    Beside an article these are other articles that aren't readers' comments, and paragraphs. Beside any other container it is whatever isn't
    cut and isn't mostly links: how short it is decides nothing.
    """
    if best.parent is None or best.tag == "main":
        return [best]
    kept = []
    for x in best.parent.parts:
        if x is best:
            kept.append(x)
        elif not isinstance(x, str) and not x.cut and x.length and inner_text(x).strip():
            if best.tag != "article" or x.tag == "p":
                belongs = density(x) < 0.33
            else:
                belongs = x.tag == "article" and not x.named and density(x) < 0.5
            if belongs:
                kept.append(x)
    return kept


def blocks(nodes: list[Node]) -> list[str]:
    found: list[str] = []
    held: list[str] = []

    def flush():
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            found.append(text)

    for top in nodes:
        flush()
        todo: list = [top]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                held.append(x)
            elif not x.cut:
                if x.tag == "br":
                    held.append(" ")
                elif x.tag in BLOCK_TAGS:
                    flush()
                    todo.append(None)
                todo.extend(reversed(x.parts))
    flush()
    return found


def main_text(html: str | None) -> str:
    if not html:
        return ""
    nodes = parse(html)
    spare_words(nodes)
    if any(x.named for x in nodes):
        cut_named(nodes)
    return article(nodes)


def article(nodes: list[Node]) -> str:
    measure(nodes)
    best = best_container(nodes)
    return "\n".join(blocks(kept_siblings(best))) if best is not None else ""


def _extracted(batches):
    import pyarrow as pa

    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and its code points for every page: one pass, no shuffle."""
    read = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    return read.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")

"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsight.llm.blocks import blocks, texts_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that never hold main text.
OUTSIDE = frozenset(
    "head script style noscript template button select option textarea iframe "
    "object embed svg math canvas audio video map dialog menu input label".split()
)
#: Elements around the main text, unless the article is in them (an author left them open, say).
AROUND = frozenset("nav footer aside form".split())
#: What may stand in a head; any other element ends it.
IN_HEAD = frozenset("title base basefont bgsound link meta style script noscript template".split())
#: Elements that a start tag of the same group closes, and what bounds the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words in class, id or role that mark what is not main text.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|"
    r"popup|modal|overlay|newsletter|subscribe|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|aside|"
    r"footer|masthead|site-?header|page-?header|comments?|comment-?list|disqus|replies|respond|"
    r"share|sharing|social\w*|related|recommend\w*|widget\w*|pager|pagination|toolbar|login|signup|"
    r"search\w*|complementary|contentinfo|alert\w*|disclaimer|copyright|skip\w*|tags?|legal)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Those of them that mark what readers wrote: however long, it is no main text.
COMMENTS = re.compile(
    r"(?:^|[\s_-])(?:comments?|comment-?list|disqus|replies|respond)(?:$|[\s_-])", re.IGNORECASE
)
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = (
        "tag", "parent", "children", "outside", "link", "chars", "tags", "link_chars", "link_tags",
        "density", "total", "marked", "plain", "cores", "title", "loose",
    )

    def __init__(self, tag: str, parent: Node | None, outside: bool):
        self.tag, self.parent, self.outside = tag, parent, outside
        #: None, or why the node may be left out: "around", "name" or "comments".
        self.marked: str | None = None
        self.link = tag == "a" or (parent is not None and parent.link)
        self.children: list[Node | str] = []


class Tree(HTMLParser):
    """A forgiving tree: void and block rules close what authors leave open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("#root", None, False)
        self.opened: Counter[str] = Counter()

    def _up(self, node: Node) -> None:
        """Close elements until ``node`` is the innermost open one."""
        while self.here is not node:
            self.opened[self.here.tag] -= 1
            self.here = self.here.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self.opened[tag]:
            return
        if tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCK:
            self._close_until("p", {"table", "td", "th", "button", "article", "section", "div", "li"})
        if tag in CLOSES:
            names, bounds = CLOSES[tag]
            node = self.here
            while node.parent is not None and node.tag not in bounds:
                if node.tag in names:
                    self._up(node.parent)
                node = node.parent
        outside = self.here.outside or tag in OUTSIDE or _hidden(tag, attrs)
        node = Node(tag, self.here, outside)
        node.marked = _marked(tag, attrs)
        if tag in AROUND or (tag == "header" and not self.opened["article"] and not self.opened["main"]):
            node.marked = "around"
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node
            self.opened[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in VOID or not self.opened[tag]:
            return
        node = self.here
        while node.parent is not None:
            if node.tag == tag:
                self._up(node.parent)
                return
            if node.tag in ("td", "th", "article", "section", "body") and tag not in BLOCK:
                return
            node = node.parent

    def handle_data(self, data):
        if self.here.tag == "head" and not data.isspace():
            self._end_head()
        if not self.here.outside:
            self.here.children.append(data)

    def _end_head(self) -> None:
        """The end tag of a head may be left out."""
        if self.opened["head"]:
            node = self.here
            while node.tag != "head":
                node = node.parent
            self._up(node.parent)

    def _close_until(self, tag, bounds):
        if not self.opened[tag]:
            return
        node = self.here
        while node.parent is not None and node.tag not in bounds:
            if node.tag == tag:
                self._up(node.parent)
                return
            node = node.parent


def _marked(tag: str, attrs) -> str | None:
    if tag in ("html", "body", "main"):
        return None
    values = [value for name, value in attrs if name in ("class", "id", "role") and value]
    if any(COMMENTS.search(v) for v in values):
        return "comments"
    return "name" if tag != "article" and any(MARKS.search(v) for v in values) else None


def _hidden(tag: str, attrs) -> bool:
    if tag in ("html", "body", "article", "main"):
        return False
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and value and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return True
    return False


def _post_order(root: Node) -> list[Node]:
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, Node) and not c.outside]
    return order[::-1]


def leave_out(root: Node) -> None:
    """Marked subtrees are outside, unless the article is in them.

    The article shows by its elements, ``article`` or ``main`` outside of comments: a marked
    subtree stays if it holds all of them, and goes if some are elsewhere. On a page without
    them it stays if it holds most of the text that is not in links; a form or nav only then,
    as it may be left open. What is marked as comments goes, however long, unless it is the
    wrapper of the article: it holds the first heading, marked comments of its own, or almost
    all text of the page.
    """
    order = _post_order(root)
    for n in order:
        kids = [c for c in n.children if isinstance(c, Node) and not c.outside]
        own = 0 if n.link else sum(len(SPACE.sub(" ", c).strip()) for c in n.children if isinstance(c, str))
        n.plain = own + sum(k.plain for k in kids)
        # Text that is in no marked subtree.
        n.loose = 0 if n.marked else own + sum(k.loose for k in kids)
        n.title = n.tag == "h1" or any(k.title for k in kids)
        n.cores = sum(k.cores for k in kids) + (n.tag in ("article", "main") and not n.marked)
        if n.marked == "comments":
            inner = any(k.marked == "comments" for k in _post_order(n)[:-1])
            if not n.title and not inner:
                n.cores = 0
    for n in order:
        if not n.marked or n is root:
            continue
        if n.cores:
            n.outside = n.cores < root.cores
        elif root.cores or (n.marked == "around" and n.tag not in ("nav", "form")):
            n.outside = True
        elif n.marked == "comments":
            n.outside = 2 * n.plain <= root.plain or root.loose > 0 and not n.title
        else:
            n.outside = 2 * n.plain <= root.plain


def measure(root: Node) -> list[Node]:
    """Composite text density of every node, and the sum of its children's.

    Density is characters per tag, damped by the share of link characters and link tags and
    by how that share compares with the whole page.
    """
    order = _post_order(root)
    for n in order:
        text = sum(len(SPACE.sub(" ", c).strip()) for c in n.children if isinstance(c, str))
        kids = [c for c in n.children if isinstance(c, Node) and not c.outside]
        n.chars = text + sum(k.chars for k in kids)
        n.tags = len(kids) + sum(k.tags for k in kids)
        n.link_chars = n.chars if n.link else sum(k.link_chars for k in kids)
        n.link_tags = sum(k.link_tags + k.link for k in kids)
    share = root.link_chars / max(1, root.chars)
    for n in order:
        n.density = _density(n, share)
        n.total = sum(k.density for k in n.children if isinstance(k, Node) and not k.outside)
    return order


def _density(n: Node, share: float) -> float:
    if not n.chars:
        return 0.0
    tags, link_chars, link_tags = max(1, n.tags), max(1, n.link_chars), max(1, n.link_tags)
    plain = max(1, n.chars - n.link_chars)
    base = math.log(n.chars / plain * n.link_chars + share * n.chars + math.e)
    value = n.chars / link_chars * tags / link_tags
    return n.chars / tags * (math.log(value) / math.log(base) if base > 1.0 + 1e-9 and value > 1 else 0.0)


def select(root: Node) -> list[Node]:
    """The subtree of the largest density sum, and what beside its path to the body is dense.

    The threshold is the least density on the path from that subtree up to the body. A
    neighbour of the path counts if its density reaches the threshold, or if it is a heading.
    """
    order = measure(root)
    if not root.chars:
        return []
    best = max(order, key=lambda n: (n.total, n.chars))
    if best.total == 0:
        best = root
    path, node = [], best
    while node is not None and node.tag not in ("body", "html", "#root"):
        path.append(node)
        node = node.parent
    least = min((n.density for n in path), default=0.0)
    chosen, inner = {id(best)}, best
    while inner.parent is not None and inner.tag not in ("body", "html", "#root"):
        for c in inner.parent.children:
            if isinstance(c, Node) and not c.outside and c is not inner:
                heading = c.tag in ("h1", "h2", "h3", "header", "hgroup")
                if c.chars and (heading or (least > 0 and c.density >= least)):
                    chosen.add(id(c))
        inner = inner.parent
    return [n for n in order if id(n) in chosen]


def lines(node: Node, out: list[str], part: list[str]) -> None:
    """Text of the subtree, one entry per block, in page order."""

    def flush():
        text = SPACE.sub(" ", "".join(part)).strip()
        if text:
            out.append(text)
        part.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is flush:
            flush()
        elif isinstance(x, str):
            part.append(x)
        elif not x.outside:
            if x.tag == "br":
                part.append(" ")
                continue
            block = x.tag in BLOCK
            if block:
                flush()
                todo.append(flush)
            todo += reversed(x.children)
    if node.tag in BLOCK or node.tag == "#root":
        flush()


def main_text(html: str) -> str:
    """The article of a page: blocks joined by line feeds, empty if there is none."""
    if not html or html.isspace():
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    leave_out(tree.root)
    out: list[str] = []
    part: list[str] = []
    for node in select(tree.root):
        lines(node, out, part)
    rest = SPACE.sub(" ", "".join(part)).strip()
    return "\n".join([*out, rest] if rest else out)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Main text of every page: the ``keep`` columns, ``text`` and ``n_chars`` (code points).

    The whole page is parsed. A null or empty page and one without text give an empty text.
    Repeated rows and null keys stay; an empty table gives no rows; other columns are ignored.
    """
    rows = pages.select(*keep, F.col(html).alias("html"))
    out = rows.drop("html").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "html"):
            found = [main_text(h) for h in texts_of(block.column(len(keep))).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *block.columns[: len(keep)],
                    pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                names=out.fieldNames(),
            )

    return rows.mapInArrow(run, out)

"""Main text of web pages by composite text density.

A page is parsed into a tree. The density of a node is its characters per tag, lowered where much of
it is link text (log-scaled ratios, as in the published composite text density). The density sum
of a node is the sum of its children's densities. The least density on the path from body to the node
with the greatest density sum is the threshold. The page is walked from body: of the topmost nodes beside that path whose
density reaches the threshold, the subtree of the greatest sum is content as well, and what lies beside it is judged in the same
way. All of these are kept in page order. A node of the greatest sum within an article or main stands for
the whole of it, and then content beside it is what other articles reach the threshold of its path. Elements that are never content by their meaning (navigation, headers of
the page, footers, asides, forms, scripts, styles, and blocks with a class, id or role that says notice, advert,
comments and the like, whole or as its last part) are left out before any density is taken. A block that only its class, id
or role marks is left to the density if it holds an article, a main or an h1, or else most of the page's text outside links
while no article or main, nor for comments an h1, stands elsewhere.

NULL or empty html gives an empty text. Broken markup is read leniently: unclosed elements end with
their parent, stray end tags are ignored, a bare "<" is text. Long pages and repeated rows need no special care;
the tree is walked with explicit stacks, so depth is no limit. Only the named columns are read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# HTML elements by their meaning.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp template".split())
HIDDEN = frozenset(
    "head script style textarea title noscript iframe noframes xmp template nav footer aside form button select option "
    "input label svg math canvas object audio video menu dialog map".split()
)
BLOCK = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"br", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html", "summary", "legend"} | {"nav", "footer", "aside", "form", "menu"}
# An element that starts ends an open one of these, searched upwards as far as the second set.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Words of class, id or role that mark a block as something else than the article.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead comment comments respond disqus reply replies "
    "commentlist commentform share sharing social related recommended newsletter subscribe subscription signup popup modal notice alert toolbar widget "
    "pagination pager login search complementary contentinfo".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies disqus".split())

TOKEN = re.compile(
    r"<!--(?:.*?)(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    # A quote that is never closed: the tag ends at the next bracket.
    r"|<(?P<open_end>/?)(?P<open_name>[a-zA-Z][^\s/>]*)(?P<open_rest>[^>]*)>|<[!?/][^>]*>",
    re.S,
)
# A name and its value, so that words of values are never names.
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
# Parts of a class name before which the last one says something else, and parts that only say where or how a block stands.
NOT_ITSELF = frozenset("has no with without not hide show is".split())
PLACES = frozenset("area box container wrapper wrap inner outer list block section left right top bottom primary secondary".split())
PARTS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("name", "children", "skip", "mark", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, name: str, skip: bool = False, mark: str = ""):
        self.name, self.skip, self.mark = name, skip, mark
        self.children: list[Node | str] = []


def _says(token: str) -> str:
    """The word by which a class, an id or a role marks a block, or ''."""
    if token in ASIDE_WORDS:
        return token
    parts = PARTS.findall(token)
    while parts and parts[-1] in PLACES:
        parts.pop()
    if not parts or parts[-1] not in ASIDE_WORDS or not NOT_ITSELF.isdisjoint(parts[:-1]):
        return ""
    return parts[-1]


def _aside(name: str, rest: str) -> tuple[bool, str]:
    """Whether an element is never content, and the mark that its class, id or role gives it, "comment" or "aside"."""
    if name in HIDDEN:
        return True, ""
    if not rest or rest.isspace() or name in ("html", "body", "main"):
        return False, ""
    said = set()
    for key, a, b, c in ATTRIBUTE.findall(rest):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True, ""
        if key in ("class", "id", "role"):
            said.update(filter(None, map(_says, value.split())))
    if said & COMMENT_WORDS:
        return False, "comment"
    return False, "aside" if said and name != "article" else ""


def _settle(root: Node) -> None:
    """Skip the marked blocks, but those that hold what a page is read for."""
    order, todo = [], [(root, None, False)]
    while todo:
        node, parent, link = todo.pop()
        order.append((node, parent))
        link = link or node.name == "a"
        node.chars = 0 if link else sum(len(c.strip()) for c in node.children if isinstance(c, str))
        # For now these count articles and mains, and first headings.
        node.tags, node.link_tags = int(node.name == "main" or node.name == "article" and not node.mark), int(node.name == "h1")
        todo.extend((c, node, link) for c in node.children if isinstance(c, Node) and not c.skip)
    for node, parent in reversed(order):
        if parent:
            parent.chars += node.chars
            parent.tags += node.tags
            parent.link_tags += node.link_tags
    for node, _ in order:
        if node.mark and not node.tags and not node.link_tags:
            elsewhere = root.tags or node.mark == "comment" and root.link_tags
            node.skip = bool(elsewhere) or node.chars * 2 <= root.chars


def parse(page: str) -> Node:
    """The tree of a page; text is kept undecoded."""
    root = Node("html")
    stack = [root]
    at, marked = 0, False
    while m := TOKEN.search(page, at):
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        name, rest = m["name"] or m["open_name"], m["rest"] or m["open_rest"] or ""
        if name is None:
            continue
        name = name.lower()
        if m["end"] or m["open_end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if name not in BLOCK and stack[i].name in BLOCK:  # an inline end tag does not end a block
                    break
            continue
        if name == "html":
            continue
        if name in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    del stack[i:]
                    break
                if stack[i].name in BLOCK or stack[i].name == "button":
                    break
        if name in SIBLINGS:
            ends, stop = SIBLINGS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ends:
                    del stack[i:]
                if i >= len(stack):
                    continue
                if stack[i].name in stop:
                    break
        site_header = name == "header" and not any(n.name in ("article", "main") for n in stack)
        skip, mark = _aside(name, rest)
        node = Node(name, site_header or skip, mark)
        marked = marked or bool(mark)
        stack[-1].children.append(node)
        if name in VOID or rest.endswith("/") and name not in BLOCK:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append(node)
    if at < len(page):
        stack[-1].children.append(page[at:])
    if marked:
        _settle(root)
    return root


def _measure(body: Node) -> list[Node]:
    """Set the counts, densities and sums of all kept nodes; returns them, parents first."""
    order, todo = [], [(body, None)]
    while todo:
        node, parent = todo.pop()
        order.append((node, parent))
        node.chars, node.tags, node.link_chars, node.link_tags, node.sum = 0, 0, 0, 0, 0.0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child.strip())
            elif not child.skip:
                todo.append((child, node))
    for node, parent in reversed(order):
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if parent:
            parent.chars += node.chars
            parent.tags += node.tags + 1
            parent.link_chars += node.link_chars
            parent.link_tags += node.link_tags
    ratio = body.link_chars / max(body.chars, 1)
    for node, parent in order:
        chars, tags, linked, links = node.chars, max(node.tags, 1), node.link_chars, max(node.link_tags, 1)
        base = math.log(chars / max(chars - linked, 1) * linked + ratio * chars + math.e)
        inner = (chars / max(linked, 1)) * (tags / links)
        node.density = chars / tags * math.log(max(inner, 1.0)) / math.log(max(base, 1.0) + 1.0) if chars else 0.0
        if parent:
            parent.sum += node.density
    return [node for node, _ in order]


def _texts(node: Node) -> str:
    """Text in page order: decoded, white space and block borders as one blank."""
    out: list[str] = []
    todo: list[Node | str] = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(entities.unescape(item) if "&" in item else item)
        elif not item.skip:
            border = item.name in BLOCK
            if border:
                out.append(" ")
                todo.append(" ")
            todo.extend(reversed(item.children))
        elif item.name not in ("input", "svg", "button", "label"):
            out.append(" ")
    return " ".join("".join(out).split())


def _upwards(node: Node, top: Node, parents: dict[int, Node]) -> list[Node]:
    """The node, its parent and so on up to ``top``."""
    path = [node]
    while node is not top:
        node = parents[id(node)]
        path.append(node)
    return path


def _contents(path: list[Node], nodes: list[Node], parents: dict[int, Node]) -> list[Node]:
    """The content nodes in page order; none lies in another. ``path`` leads from the first of them up to body, ``nodes`` has parents first."""
    top, body, threshold = path[0], path[-1], min(n.density for n in path)
    best: dict[int, Node] = {}  # of every node the one of the greatest sum below it, or itself
    for node in reversed(nodes):
        mine = best.setdefault(id(node), node)
        if node.sum >= mine.sum:
            mine = best[id(node)] = node
        if node is not body and mine.sum > best.setdefault(id(parents[id(node)]), mine).sum:
            best[id(parents[id(node)])] = mine
    kept, todo = [], [body]
    opened, whole = {id(n) for n in path}, {id(top)}
    while todo:
        node = todo.pop()
        if id(node) not in opened and node.chars and node.density >= threshold:
            found = best[id(node)]
            whole.add(id(found))
            opened.update(id(n) for n in _upwards(found, node, parents))
        if id(node) in whole:
            kept.append(node)
        else:
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.skip)
    return kept


def _articles(outer: Node, nodes: list[Node], path: list[Node]) -> list[Node]:
    """The article or main of the content, and in page order the others outside it as dense as the sparsest node on its path from body."""
    threshold = min(n.density for n in path)
    kept, todo = [], [path[-1]]
    while todo:
        node = todo.pop()
        if node is outer or node.name in ("article", "main") and node not in path and node.chars and node.density >= threshold:
            kept.append(node)
        else:
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.skip)
    return kept


def main_text(page: str | None) -> str:
    """The text of the content node of a page."""
    if not page:
        return ""
    root = parse(page)
    body = next((c for c in root.children if isinstance(c, Node) and c.name == "body"), root)
    nodes = _measure(body)
    top = max(nodes, key=lambda n: n.sum)
    if not top.chars:
        return _texts(body)
    parents = {id(c): n for n in nodes for c in n.children if isinstance(c, Node)}
    path, outer = _upwards(top, body, parents), None
    # A content node that is itself one block of an article stands for the whole article.
    for node in path[:-1]:
        if node.name in ("article", "main"):
            outer = node
    if outer:
        return " ".join(filter(None, map(_texts, _articles(outer, nodes, _upwards(outer, body, parents)))))
    return " ".join(filter(None, map(_texts, _contents(path, nodes, parents))))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, text and n_chars (code points) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(html_col).to_pylist()]
            added = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *added], names=[*keep, "text", "n_chars"])

    kept = pages.select(*keep, html_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*keep).schema)
    return kept.mapInArrow(run, f"{fields}, text string, n_chars bigint")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return extract(read(spark, sf_dir, "pages"))

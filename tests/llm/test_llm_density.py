"""Composite text density against a recursive computation over the standard library's parser, and pages of several articles."""

import math
import random
from html.parser import HTMLParser

import pytest

from recordloom.llm import html


class Tree(HTMLParser):
    """(name, children) of well-formed pages."""

    def __init__(self, page):
        super().__init__()
        self.stack = [["root", []]]
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        node = [tag, []]
        self.stack[-1][1].append(node)
        self.stack.append(node)

    def handle_endtag(self, tag):
        assert self.stack.pop()[0] == tag

    def handle_data(self, data):
        self.stack[-1][1].append(data)


def counts(node, link=False):
    """chars, tags, link chars, link tags of a node."""
    chars = sum(len(c.strip()) for c in node[1] if isinstance(c, str))
    tags = linked = links = 0
    for child in node[1]:
        if not isinstance(child, str):
            c, t, lc, lt = counts(child)
            chars, tags, linked, links = chars + c, tags + t + 1, linked + lc, links + lt
    return (chars, tags, chars, tags + 1) if node[0] == "a" else (chars, tags, linked, links)


def slow_text(page):
    body = next(c for c in Tree(page).stack[0][1][0][1] if not isinstance(c, str) and c[0] == "body")
    total = counts(body)
    ratio = total[2] / max(total[0], 1)

    def density(node):
        chars, tags, linked, links = counts(node)
        if not chars:
            return 0.0
        tags, links = max(tags, 1), max(links, 1)
        base = math.log(chars / max(chars - linked, 1) * linked + ratio * chars + math.e)
        return chars / tags * math.log(max(chars / max(linked, 1) * tags / links, 1)) / math.log(max(base, 1) + 1)

    def nodes(node):
        return [c for c in node[1] if not isinstance(c, str)]

    def total_density(node):
        return sum(map(density, nodes(node)))

    def below(node):
        return [node] + [d for c in nodes(node) for d in below(c)]

    def path(node, target):
        if node is target:
            return [node]
        for child in nodes(node):
            if found := path(child, target):
                return [node, *found]
        return []

    top = max(below(body), key=total_density)
    opened = path(body, top)
    threshold = min(map(density, opened))
    whole = [top]

    def kept(node):
        if all(node is not n for n in opened) and counts(node)[0] and density(node) >= threshold:
            best = max(below(node), key=total_density)
            whole.append(best)
            opened.extend(path(node, best))
        if any(node is n for n in whole):
            return [node]
        return [k for c in nodes(node) for k in kept(c)]

    def text(node):
        inner = "".join(c if isinstance(c, str) else text(c) for c in node[1])
        return f" {inner} " if node[0] in html.BLOCK else inner

    return " ".join(" ".join(text(k).split()) for k in kept(body))


def random_page(seed):
    rng = random.Random(seed)

    def words(n):
        return " ".join("abcdefghij"[: rng.randint(1, 10)] for _ in range(n))

    def block(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            return f"<p>{words(rng.randint(3, 60))}</p>"
        if kind < 0.45:
            return "<ul>" + "".join(f"<li><a>{words(rng.randint(1, 4))}</a></li>" for _ in range(rng.randint(1, 8))) + "</ul>"
        return "<div>" + "".join(block(depth - 1) for _ in range(rng.randint(1, 5))) + "</div>"

    return "<html><body>" + "".join(block(3) for _ in range(4)) + "</body></html>"


@pytest.mark.parametrize("seed", range(60))
def test_equals_recursion(seed):
    page = random_page(seed)
    assert html.main_text(page) == slow_text(page)


LONG = "<p>" + "Words of an article that go on for a while and say a thing or two. " * 4 + "</p>"
PLAIN = " ".join(("Words of an article that go on for a while and say a thing or two. " * 4).split())


def test_several_articles():
    page = f"<body><div><article>{LONG * 3}</article><article>{LONG * 2}</article></div><p>small</p></body>"
    assert html.main_text(page) == " ".join([PLAIN] * 5)
    teasers = "".join("<article><a href=x>Read this next</a></article>" for _ in range(3))
    assert html.main_text(f"<body><article>{LONG * 3}</article><div>{teasers}</div></body>") == " ".join([PLAIN] * 3)


@pytest.mark.parametrize("tag", ['<a title="it>', "<a title='it>", '</b x="y>', '<b class="c'])
def test_quotes_that_are_never_closed(tag):
    assert html.main_text(f"<body><p>before {tag} after and more words</p></body>").replace(">", "").split()[0] == "before"
    if tag.endswith(">"):
        assert html.main_text(f"<body><p>before {tag} after</p></body>") == "before after"


def test_odd_rows(spark):
    """Repeated rows, NULL, and columns named like the added ones."""
    rows = [(1, "u", "<p>one</p>", "t", 5), (1, "u", "<p>one</p>", "t", 5), (2, None, None, None, None), (None, "v", "", "t", 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    out = html.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted([(1, "u", "one", 3), (1, "u", "one", 3), (2, None, "", 0), (None, "v", "", 0)], key=repr)
    assert html.extract(df.limit(0)).count() == 0

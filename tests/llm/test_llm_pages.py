"""Articles that the first block alone, an attribute's value or a part of a class name used to lose."""

import pytest

from recordloom.llm import html

LINKS = "<div><ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(20)) + "</ul></div>"


def paragraphs(name, n=10):
    return [f"{name} paragraph {i} has enough words to be read as running text, a comma and a full stop." for i in range(n)]


def block(texts):
    return "<div>" + "".join(f"<p>{t}</p>" for t in texts) + "</div>"


@pytest.mark.parametrize("sizes", [(10, 10), (10, 4), (4, 10), (3, 10, 7)])
def test_article_over_sibling_blocks(sizes):
    parts = [paragraphs(f"Block {k}", n) for k, n in enumerate(sizes)]
    page = f"<html><body>{LINKS}" + LINKS.join(block(p) for p in parts) + f"{LINKS}</body></html>"
    assert html.main_text(page) == " ".join(" ".join(p) for p in parts)


def test_article_over_nested_blocks():
    first, second = paragraphs("First"), paragraphs("Second", 6)
    page = f"<body>{LINKS}<div><div>{block(first)}</div><section><div>{block(second)}</div></section></div>{LINKS}</body>"
    assert html.main_text(page) == " ".join(first + second)


def test_an_article_stands_for_itself():
    texts = paragraphs("Inner")
    page = f"<body>{block(paragraphs('Outer', 3))}<article>{block(texts[:5])}{block(texts[5:])}</article></body>"
    assert html.main_text(page) == " ".join(texts)


@pytest.mark.parametrize("attribute", [
    'style="overflow:hidden"', "title='the hidden valley'", 'title="a > b hidden = x"', "data-hidden", 'data-id="sidebar"', "data-class=comments", 'aria-hidden="false"', "x-hidden=hidden",
])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_words_of_values_hide_nothing(attribute, tag):
    texts = paragraphs("Inner")
    page = f"<body>{LINKS}<{tag} {attribute}>" + "".join(f"<p>{t}</p>" for t in texts) + f"</{tag}></body>"
    assert html.main_text(page) == " ".join(texts)


@pytest.mark.parametrize("attribute", ["hidden", "HIDDEN=''", 'class="x" hidden', "hidden='hidden'", "aria-hidden=true", 'style="a:b" aria-hidden = "True"'])
def test_hidden_elements_go(attribute):
    texts = paragraphs("Inner")
    page = f"<body>{LINKS}{block(texts)}<div {attribute}>{block(paragraphs('Secret', 20))}</div></body>"
    assert html.main_text(page) == " ".join(texts)


@pytest.mark.parametrize("name", ["post has-sidebar", "no-sidebar", "entry-content comments-open", "search-result", "login-guide", "related-work", "layout-with-sidebar-left"])
@pytest.mark.parametrize("tag", ["div", "section", "article"])
def test_parts_of_class_names_hide_nothing(name, tag):
    texts = paragraphs("Inner")
    page = f"<body>{LINKS}<{tag} class='{name}'>" + "".join(f"<p>{t}</p>" for t in texts) + f"</{tag}></body>"
    assert html.main_text(page) == " ".join(texts)
    short = f"<body>{block(paragraphs('Other', 20))}<{tag} class='{name}'>" + "".join(f"<p>{t}</p>" for t in texts) + f"</{tag}></body>"
    assert not [n for n in html.parse(short).children[0].children if n.skip]


@pytest.mark.parametrize("mark", [
    "class=sidebar", "id='comments'", "role=navigation", "class='x cookie-notice'", "class=site-footer", "class='ad-container'", "class='sidebar-left'", "id=comments-area", "class=ad2",
])
def test_marked_blocks_go(mark):
    texts = paragraphs("Inner")
    page = f"<body><div {mark}>{block(paragraphs('Noise', 9))}</div><article>{block(texts)}</article><div {mark}>Noise</div></body>"
    assert html.main_text(page) == " ".join(texts)
    assert html.main_text(page.replace("article", "div")) == " ".join(texts)


def test_marked_blocks_with_the_article_are_left_to_density():
    texts = paragraphs("Inner")
    for inner in (block(texts), f"<article>{block(texts)}</article>", f"<main>{block(texts)}</main>"):
        assert html.main_text(f"<body>{LINKS}<div class=banner>{inner}</div></body>") == " ".join(texts)
    assert html.main_text(f"<body>{LINKS}<div id=sidebar><h1>Title</h1><p>Text of it, short but plain.</p></div><p>x</p></body>").startswith("Title")


def test_long_comments_are_no_content():
    texts, said = paragraphs("Inner"), paragraphs("Reader", 40)
    page = f"<body><article>{block(texts)}</article><div id=comments><article class=comment>{block(said)}</article></div></body>"
    assert html.main_text(page) == " ".join(texts)


def test_a_short_article_beside_a_long_advert():
    page = f"<body><div class=ad>{block(paragraphs('Advert', 30))}</div><article><h1>Title</h1><p>Short text.</p></article></body>"
    assert html.main_text(page) == "Title Short text."

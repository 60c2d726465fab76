import html
import itertools
import math
import re

import pytest

from stayvalue.llm import html_text
from stayvalue.llm.html_pages import labelled_pages

TEXT = "The quick fox, it was said, had jumped over the lazy dog many times before. Nobody knew why."


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return html_text.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def article(page):
    """The blocks of the one article of the table's pages."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    texts = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_pages_of_the_table(spark, read, model):
    pages = read("pages")
    rows = html_text.extract(pages, model).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(rows) == pages.count()
    for row in rows:
        assert row.text == article(row.html)
        assert row.n_chars == len(row.text)


def test_labelled_layouts(model):
    for page in labelled_pages():
        nodes = html_text.parse(page, labelled=True)
        found = [odds > 0 for odds in html_text.marginals(nodes, model)]
        truth = html_text.labels(nodes)
        assert all(f == bool(t) for n, f, t in zip(nodes, found, truth) if n.parts)


def test_other_designs(model):
    page = f"""<html><body><div id="cookie-banner">We use cookies. {TEXT}</div><div class="main-content">
    <h1>A &amp; B</h1><p>{TEXT}<br>x&nbsp;&lt;b&gt;</p><script>var a = "</p><p>{TEXT}</p>";</script><p>{TEXT}</p></div>
    <div class="sidebar"><p>{TEXT}</p></div><div id="comments"><div class="comment"><p>{TEXT}</p></div></div>
    <footer>{TEXT}</footer></body></html>"""
    assert html_text.main_text(page, model) == f"A & B\n\n{TEXT} x <b>\n\n{TEXT}"
    page = f"""<body><header><a href="/">Site</a> News</header><aside><p>{TEXT}</p></aside><article><h1>T</h1>
    <p>{TEXT}<form><label>Mail</label><input></form><aside>{TEXT}</aside><p>{TEXT}</article>
    <section class="comments"><article><p>{TEXT}</p></article></section>"""
    assert html_text.main_text(page, model) == f"T\n\n{TEXT}\n\n{TEXT}"


@pytest.mark.parametrize(
    ("page", "text"),
    [(None, ""), ("", ""), ("  ", ""), ("just text", "just text"), ("<", "<"), ("<p", "<p"), ("<!-- x", ""),
     ("<script>x", ""), ("</div></p>", ""), ("<p title='>'>" + TEXT, TEXT), ("<p>" + TEXT + "<p a=\"b>", TEXT),
     ("<ul><li><a>x</a><li><a>y</a></ul><p>" + TEXT, TEXT)],
)
def test_broken_pages(model, page, text):
    assert html_text.main_text(page, model) == text


def test_long_broken_pages_take_linear_time(model):
    for page in ("<" * 50_000, "<div>" * 3_000, "<p a='" * 3_000, "<script>" * 3_000, "a<b " * 20_000):
        html_text.main_text(page, model)


def test_marginals_are_exact(model):
    nodes = html_text.parse(f"<div><nav><p>{TEXT}</p></nav><p>{TEXT}</p><ul><li>a.</li></ul></div>")
    total, content = 0.0, [0.0] * len(nodes)
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        if labels[0]:
            continue
        weight = 1.0
        for node, label in zip(nodes[1:], labels[1:]):
            chance = model.chance(nodes[node.parent].tag, node.tag)[labels[node.parent]]
            own = sum(model.signs.get(s, 0.0) for s in html_text.features(node))
            weight *= (chance * math.exp(own)) if label else 1 - chance
        total += weight
        for i, label in enumerate(labels):
            content[i] += weight * label
    for odds, p in list(zip(html_text.marginals(nodes, model), content))[1:]:
        assert 1 / (1 + math.exp(-odds)) == pytest.approx(p / total, rel=1e-6)


def test_odd_rows(spark, model):
    rows = [(1, "u", None), (1, "u", None), (None, None, "x"), (2, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    assert sorted(r.text for r in html_text.extract(pages, model).collect()) == ["", "", "", "x"]
    assert html_text.extract(pages.limit(0), model).collect() == []
    alone = html_text.train(pages.limit(0))
    assert html_text.main_text(f"<article><p>{TEXT}</p></article>", alone) == TEXT


def test_held_out_pages(read):
    """Trained on one half of the marked pages, judged by the text blocks of the other half."""
    pages = read("pages")
    model = html_text.train(pages.filter("page_id % 2 = 0"))
    right = total = 0
    for row in pages.filter("page_id % 2 = 1").collect():
        nodes = html_text.parse(row.html)
        truth = html_text.labels(nodes)
        if truth is None:
            continue
        for node, label, odds in zip(nodes, truth, html_text.marginals(nodes, model)):
            if node.parts:
                total += 1
                right += bool(label) == (odds > 0)
    assert total > 400 and right / total > 0.98


def test_corpus_outweighs_the_layouts():
    assert html_text.TRAIN_WEIGHTS[1] > html_text.TRAIN_WEIGHTS[0]


@pytest.mark.parametrize("attributes", ['data-y="0"', 'href="/s?x=1&y=2"', "title='a y=0 class=ad'", "y=0", "y"])
def test_only_layouts_carry_labels(attributes):
    nodes = html_text.parse(f"<article {attributes}><p>{TEXT}</p></article>")
    assert all(node.label is None for node in nodes)
    assert not any(node.words for node in nodes)
    assert html_text.labels(nodes)[-1] == 1


def test_attributes():
    nodes = html_text.parse("<div CLASS = 'one twoThree' data-id=\"x\" id=four disabled role=\"five\"/>text</div>")
    assert nodes[2].words == {"one", "two", "three", "four", "five"}


def test_fragments_keep_their_loose_text(model):
    assert html_text.main_text(f"{TEXT}<p>{TEXT}</p>{TEXT}", model) == "\n\n".join([TEXT] * 3)
    assert html_text.main_text(f"<h1>T</h1>{TEXT}<br>{TEXT}", model) == f"T\n\n{TEXT} {TEXT}"
    assert html_text.main_text(f"Intro. {TEXT}<div class='ad'>{TEXT}</div><p>{TEXT}</p>tail.", model) == (
        f"Intro. {TEXT}\n\n{TEXT}\n\ntail."
    )
    nodes = html_text.parse(f"<html><body><p>{TEXT}</p></body></html>")
    assert all(node.tag != html_text.IMPLIED for node in nodes)

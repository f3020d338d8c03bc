"""Broken and very long pages: the same blocks as by plain matching, in linear time."""

import random
import time

import pytest

from tessera.llm import op6_html as op


class Never(op.Unclosed):
    def has(self, at):
        return False


def plain(page, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(op, "Unclosed", Never)
        return op.parse(page)


def test_random_markup_gives_the_same_blocks(monkeypatch):
    rng = random.Random(3)
    bits = ["<p>", "</p>", "<div class='a b'>", "</div>", "<", ">", "\"", "'", " x", "<a b=\"1\" ", "<a b='", "<!--", "-->", "<!", "<br>", "<li>", "<ul>",
            "</ul>", "<td", "&amp;", "<script>", "</script>", "=", "/", "</", "<b", "text ", "<tr><td>", "<b\"<p>"]
    for _ in range(4000):
        page = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 25)))
        assert op.parse(page) == plain(page, monkeypatch), page


@pytest.mark.parametrize("bit, end", [
    ('<a b="1" ', ""), ('<a b="1" ', "<p x='"), ("<a", ""), ("<!", ""), ('<a b="', ">"), ("<a b='\"", "\"'>"), ("</div x ", "'>"), ("<a '", ""), ("<", ">"),
    ("<div>", "</p>" * 100_000), ("<li>", ""), ("<p>", "</div>"), ("</p>", "")])
def test_hundred_thousand_pieces(bit, end):
    page = bit * 100_000 + end + "<p>text"
    start = time.perf_counter()
    op.parse(page)
    assert time.perf_counter() - start < 8


def test_training_takes_different_pages(spark):
    article = "<html><body><nav>menu {0}</nav><article><p>Long text of the article {0}, with many words in it.</p></article></body></html>"
    rows = [(i, f"u{i}", article.format(i % 40)) for i in range(200)] + [(900, "x", None), (901, "y", ""), (902, "z", "<article>" + "x" * 60_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    given = []
    real = op.fit
    op.fit = lambda texts: given.append(texts) or real(texts)
    try:
        op.train(pages)
        op.train(pages, 7)
        op.train(pages.limit(0))
    finally:
        op.fit = real
    assert [len(set(t)) for t in given] == [40, 7, 0] and [len(t) for t in given] == [40, 7, 0]
    assert given[1] == given[0][:7]

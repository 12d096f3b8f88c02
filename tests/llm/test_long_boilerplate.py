"""Boilerplate as long as paragraphs, comment threads of third parties, long attributes."""

import pytest
from helpers import prose

from jobstrata.llm import html_tree, labelled_pages


@pytest.fixture(scope="module")
def model():
    return html_tree.fit(labelled_pages.pages())


ARTICLE = ["First " + prose(40, 1) + ".", "Second " + prose(90, 2) + ".", "Third " + prose(12, 3) + "."]


def _page(extra, article="<article>%s</article>"):
    inside = article % "".join(f"<p>{p}</p>" for p in ARTICLE)
    return f"<html><body><nav><a href='/'>Home</a> <a href='/x'>More</a></nav>{inside}{extra}</body></html>"


@pytest.mark.parametrize("words", [5, 20, 40, 64, 80, 127, 200, 300])
@pytest.mark.parametrize("box", ["footer", "aside", 'div class="ad"', 'div id="disqus_thread"', 'div class="cookie-notice"',
                                 'section class="comments"', "div class='sidebar'"])
def test_boilerplate_goes_however_long(model, box, words):
    name = box.split()[0]
    for inner in ("%s", "<p>%s</p>", "<div><p>%s</p></div>"):
        extra = f"<{box}>{inner % (prose(words, words) + '.')}</{name}>"
        assert html_tree.main_text(_page(extra), model) == "\n\n".join(ARTICLE), (box, words, inner)


@pytest.mark.parametrize("words", [5, 40, 127, 300])
def test_article_stays_however_long_its_paragraphs(model, words):
    more = "Long " + prose(words, words) + "."
    for opening in ("<main>%s</main>", "<div class='article-body'>%s</div>", "<div id='content'>%s</div>"):
        got = html_tree.main_text(_page("<footer>Legal notice</footer>", opening.replace("%s", "%s" + f"<p>{more}</p>")), model)
        assert got == "\n\n".join([*ARTICLE, more])


@pytest.mark.parametrize("size", [1_000, 30_000, 300_000])
def test_long_attributes_never_leak(model, size):
    title = ("a > b " * size)[:size]
    page = _page("").replace("<p>First", f"<p title=\"{title}\" data-x='{title}'>First")
    assert html_tree.main_text(page, model) == "\n\n".join(ARTICLE)
    assert html_tree.main_text(page.replace("<p title=", "<p title='"), model).endswith(ARTICLE[2])


def test_many_unclosed_quotes_take_little_time(model):
    import time

    start = time.perf_counter()
    html_tree.main_text("<p class=\"x>" * 50_000, model)
    html_tree.main_text("<p it's>" * 50_000 + "<a href='", model)
    assert time.perf_counter() - start < 20

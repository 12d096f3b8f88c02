import datetime
import hashlib
import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from jobstrata.llm import dom, html_tree, labelled_pages, url_lists, warc_index

PAGE_SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def model():
    return html_tree.fit(labelled_pages.pages())


# ---- pages ----


def _kept(html, model):
    return html_tree.main_text(html, model)


def test_labelled_pages_held_out(model):
    wrong = total = 0
    for page in labelled_pages.pages(120, seed=99):
        nodes, state = html_tree._labels(page)
        for node, want, p in zip(nodes, state, model.marginals(nodes)):
            if node.name == "#text":
                total, wrong = total + 1, wrong + ((p >= 0.5) != want)
    assert total > 1500 and wrong <= 0.01 * total


def test_marginals_agree_with_enumeration(model):
    from itertools import product
    from math import exp

    nodes = dom.parse("<div class='ad'><p>Buy now.</p></div><article><p>Some text</p></article>")
    seen = [model.potential(n) for n in nodes]
    total, on = 0.0, [0.0] * len(nodes)
    for state in product((0, 1), repeat=len(nodes)):
        weight = exp(model.root * state[0] + sum(s * v for s, v in zip(state, seen)))
        for k in range(1, len(nodes)):
            weight *= model.pair[nodes[k].name == "#text"][state[nodes[k].parent]][state[k]]
        total += weight
        on = [o + weight * s for o, s in zip(on, state)]
    assert model.marginals(nodes) == pytest.approx([o / total for o in on])


def test_article_without_the_rest(model):
    html = ("<html><head><title>T</title><style>p{}</style></head><body><header>Site name</header><nav><ul><li><a href=/>Home"
            "</a><li><a href=/b>B</a></ul></nav><div class='cookie-notice'>We use cookies on this site. Do you agree?</div>"
            "<article><h1>A &amp; B</h1><p><b>One&nbsp; two\n three.<br><p>Four <i>fi</i>ve &lt;x&gt;</p><ul><li>six<li>seven</ul>"
            "<script>var t='</p>';</script></article><aside class=sidebar>More stories like this one.</aside>"
            "<div class='comments'><p>I read this with joy. Thank you for it.</p></div><form><input><button>Send</button></form>"
            "<footer>&copy; 2024</footer></body></html>")
    assert _kept(html, model) == "A & B\n\nOne two three.\n\nFour five <x>\n\nsix\n\nseven"


def test_broken_pages(model):
    assert _kept(None, model) == _kept("", model) == _kept("<br><hr><!-- x", model) == ""
    assert _kept("only text & more", model) == "only text & more"
    texts = lambda html: [n.text for n in dom.parse(html) if n.name == "#text"]
    assert texts("<p>I came.<p>I saw.</i></p></div>I won.") == ["I came.", "I saw.", "I won."]
    assert texts("<ul><li>a<li>b<ul><li>c</ul>d</ul><table><tr><td>e<td>f<tr><td>g</table>") == list("abcdefg")
    assert _kept("<article><p>1 < 2 and <3</p><p title=\"a>b\">x</p><p cut='", model) == "1 < 2 and <3\n\nx"
    for hostile in ("<b>" * 30_000 + "x", "<li>" * 30_000 + "x", "<div>" * 30_000 + "x", "<a \"" * 30_000, "</p>" * 30_000):
        _kept(hostile, model)


def test_pages_table(spark, model):
    rows = [(1, "u", "<article><p>x y</p></article>"), (1, "u", "<article><p>x y</p></article>"), (2, None, None), (None, "v", "")]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA).withColumn("text", F.lit("clash"))
    got = html_tree.extract(pages, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == [(0, "", 0), (1, "x y", 3), (1, "x y", 3), (2, "", 0)]
    assert html_tree.extract(pages.limit(0), model).count() == 0


# ---- archives ----


def test_url_keys():
    assert warc_index.url_key("https://user@WWW.Example.com:8080/a b?q#f") == "com,example,www:8080)/a%20b?q"
    assert warc_index.url_key(None) == "-" and warc_index.url_key("no url") == ")no%20url"
    ids = [-5, 0, 3, 2**62]
    keys = [warc_index.capture_key("http://a/", i) for i in ids]
    assert keys == sorted(keys)


def test_archives_and_index(spark):
    dice = random.Random(0)
    big = "".join(dice.choice("abc<>\r\né") for _ in range(1500))
    rows = [(k, f"http://h{k % 7}.example.com/p{k % 40}", big + str(k % 50) if k % 3 else "small" * (k % 4)) for k in range(400)]
    rows += [(400, None, None), (401, "http://x/", ""), (402, "http://x/", "é" * 500), (403, "http://x/", "é" * 500),
             (404, "http://y/\r\n z", "é" * 499), (405, "http://y/", "é" * 499), (7, "http://h0.example.com/p7", rows[7][2])]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA).withColumn("key", F.lit("clash")).repartition(5)
    records = warc_index.write_archives(pages, warc_index.new_path(spark, "warc"))
    index = warc_index.write_index(records, warc_index.new_path(spark, "index"), block_lines=8)
    got = warc_index.look_up(warc_index.keys_of(pages), index, with_payload=True).collect()
    largest = {}
    for page, _, html in rows:
        largest[html] = max(page, largest.get(html, page))
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 1000 and largest[html] != page
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
                     largest[html] if again else None, b"" if again else data))
    order = lambda x: (x[0], x[3])
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)
    one = spark.createDataFrame([(warc_index.capture_key(rows[5][1], 5),), ("zzz",), ("",)], "key string")
    assert [r.page_id for r in warc_index.look_up(one, index).collect()] == [5]


def test_no_pages(spark):
    pages = spark.createDataFrame([], PAGE_SCHEMA)
    records, index = warc_index.archive(pages)
    assert records.count() == 0 and warc_index.look_up(warc_index.keys_of(pages), index).count() == 0


def test_pages_without_id(spark):
    rows = [(None, "u", "x" * 2000), (3, "u", "x" * 2000), (None, "u", "y" * 2000), (None, "w", "y" * 2000)]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA)
    _, index = warc_index.archive(pages)
    got = warc_index.look_up(warc_index.keys_of(pages), index).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got) == [
        (0, "response", 0), (0, "response", 0), (0, "revisit", 3), (3, "response", 0)]


# ---- lists ----


def _day(k):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=k)


def test_list_agrees_with_brute_force(spark):
    dice = random.Random(1)
    hosts = ["a.example.com", "example.com", "b.org", "x.b.org", "c.net", "deep.er.c.net"]
    captures = [(k, f"http{'s' * (k % 2)}://{dice.choice(hosts)}{dice.choice(['', ':80'])}/{dice.choice(['', 'en', 'en/x', 'fr?q'])}",
                 _day(dice.randint(0, 400))) for k in range(300)]
    captures += [(1, captures[1][1], captures[1][2]), (900, None, _day(3)), (901, "http://b.org/", None), (902, "nonsense", _day(3)),
                 (903, "http://u:p@B.ORG./en", _day(30))]
    changes = [(dice.choice([*hosts, "com", "b.org/en", "c.net/fr"]), _day(dice.randint(0, 400)), dice.random() < 0.6,
                dice.choice("xyz")) for _ in range(60)]
    changes += [(None, _day(1), True, "n"), ("b.org", None, True, "n"), ("b.org", _day(20), True, "p"), ("b.org", _day(20), False, "p")]
    table = spark.createDataFrame(captures, "page_id long, url string, fetched_on date").withColumn("category", F.lit("clash"))
    lists = spark.createDataFrame(changes, "pattern string, changed_on date, listed boolean, category string")
    history = {}
    for pattern, day, listed, category in changes:
        if pattern and day:
            history.setdefault(pattern, {}).setdefault(day, []).append((listed, category))

    def brute(url, day):
        import re

        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::\d+)?(?:/([^/?#]*))?", url or "")
        if not m or day is None:
            return []
        labels, out = m[1].lower().rstrip(".").split("."), []
        for k in range(len(labels)):
            for p in [".".join(labels[k:])] + ([".".join(labels[k:]) + "/" + m[2]] if m[2] else []):
                days = sorted(history.get(p, {}))
                at = bisect_right(days, day) - 1
                if at >= 0 and any(x for x, _ in history[p][days[at]]):
                    out.append((p, min(c for x, c in history[p][days[at]] if x)))
        return sorted(set(out), key=lambda x: (-len(x[0]), x[0]))

    got = url_lists.judge(table, lists).collect()
    assert len(got) == len(captures)
    for r in got:
        want = brute(r.url, r.fetched_on)
        assert (r.blocked, r.n_entries) == (bool(want), len(want))
        assert (r.pattern, r.category) == (want[0] if want else (None, None))
    kept = url_lists.keep(table, lists)
    assert sorted(r.page_id for r in kept.collect()) == sorted(p for p, u, d in captures if not brute(u, d))
    assert not any(r.blocked for r in url_lists.judge(table, lists.limit(0)).collect())
    assert url_lists.judge(table.limit(0), lists).count() == 0

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import DOC_SCHEMA, awkward_documents, empty_documents
from pyspark.sql import functions as F

from jobstrata.llm import queries, variant_trie


def _count(rows, least=7, every=31):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % every == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1:]
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= 2}


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def _brute(rows):
    words = _count(rows)
    near = {w: [x for x in words if abs(len(x) - len(w)) <= 1 and _near(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def _run(frame):
    got = [tuple(r) for r in variant_trie.variants(frame).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


def _text(dice, words, n):
    return " ".join(dice.choice(words) if dice.random() < 0.5 else words[0] for _ in range(n))


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "ab\u00e9\u00ff\u00d7A"])
def test_variants_agree_with_brute_force(spark, letters):
    dice = random.Random(len(letters))
    base = ["".join(dice.choice(letters) for _ in range(dice.randint(6, 13))) for _ in range(60)]
    rows = [(k, _text(dice, base, 60)) for k in range(40)]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOC_SCHEMA).repartition(3)
    want = _brute(rows)
    assert _run(frame) == want and any(r[4] for r in want)


def test_chains_of_forms_end_at_their_root(spark):
    rows = [(0, " ".join(["mountain"] * 3000 + ["mountains"] * 250 + ["mountainso"] * 20 + ["mountainsol"] * 2 + ["Mountain\u00e9"] * 9))]
    frame = spark.createDataFrame([(i, t, "", "", 1) for i, t in rows], DOC_SCHEMA)
    want = _brute(rows)
    assert _run(frame) == want
    assert {(w, r) for w, _, r, *_ in want} >= {("mountainsol", "mountain"), ("mountain", "mountain")}


def test_awkward_rows(spark):
    long = "".join(random.Random(3).choice("xyz") for _ in range(30_000))
    alike = long[:20_000] + "q" + long[20_001:]
    extra = [(k, t, None, None, None) for k in (40, 41, None) for t in (
        long, alike, long[:-1], "q" + long, "a" * 700, "a" * 701, "a" * 140, "a" * 139 + "b", "b" + "a" * 139, "\u00c0bcdefg \u00e0bcdefg ABCDEFG")]
    frame = awkward_documents(spark, extra).withColumns({"word": F.lit("clash"), "n": F.lit(1), "node": F.lit(2)})
    got, want = _run(frame), _brute([(r.doc_id, r.text) for r in frame.collect()])
    assert got == want
    assert any(len(w) > 20_000 and n for w, _, _, _, n, _ in want)


def test_empty_tables(spark):
    assert variant_trie.variants(empty_documents(spark)).count() == 0
    one = spark.createDataFrame([(1, "alonealone alonealone", "", "", 1)], DOC_SCHEMA)
    assert _run(one) == _brute([(1, "alonealone alonealone")])


def test_query_on_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    words = _count(rows)
    slots = {}  # words by what is left when a letter goes, as a faster check of a whole table than all pairs
    for w in words:
        for k in range(len(w) + 1):
            slots.setdefault((w[:k], w[k + 1:], len(w)), set()).add(w)
            slots.setdefault((w[:k], w[k:], len(w) + 1), set()).add(w)
    near = {w: set() for w in words}
    for group in slots.values():
        for w in group:
            near[w] |= {x for x in group if x != w and _near(w, x)}
    got = {r.word: r for r in queries.op13_spelling_variants(spark, folder).collect()}
    assert {w: (r.n, r.n_near) for w, r in got.items()} == {w: (n, len(near[w])) for w, n in words.items()}
    for w, r in got.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        want = best if best and words[best] >= 10 * words[w] else None
        assert (r.form, r.form_n) == (want, words.get(want))

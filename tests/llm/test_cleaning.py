import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import DOC_SCHEMA, awkward_documents, empty_documents, prose
from helpers import tokens as _tokens
from pyspark.sql import functions as F

from jobstrata.llm import decontaminate, secret_forest

# ---- benchmark ----


def _brute(doc, item):
    """Most matching tokens of a contaminating stretch over all alignments that share a masked window."""
    a, b, best = _tokens(doc), _tokens(item), 0
    if len(b) < decontaminate.LEAST:  # short items: the whole sequence, or nothing else
        whole = a == b if len(b) < 3 else any(a[k:k + len(b)] == b for k in range(len(a)))
        return len(b) if b and whole else 0
    need = min(decontaminate.NEED, -(-4 * len(b) // 5))
    for shift in range(-len(b), len(a) + 1):
        same = [a[j + shift] == b[j] for j in range(max(0, -shift), min(len(b), len(a) - shift))]
        hit = any(all(same[k + j] for j, bit in enumerate(m) if bit == "1")
                  for m in decontaminate.MASKS for k in range(len(same) - len(m) + 1))
        if not hit or sum(same) < need:
            continue
        for start in range(len(same)):
            for stop in range(start + 1, len(same) + 1):
                matched = sum(same[start:stop])
                if matched >= need and 5 * matched >= 4 * (stop - start):
                    best = max(best, matched)
    return best


def test_overlaps_agree_with_brute_force(spark):
    dice = random.Random(3)
    items = [(k, prose(dice.randint(5, 40), 100 + k)) for k in range(12)] + [(50, None), (None, prose(20, 5)), (51, ""), (0, prose(15, 77))]
    docs = []
    for k in range(40):
        words = _tokens(items[k % 12][1])
        for _ in range(k % 5):
            words[dice.randrange(len(words))] = "changed"
        cut = words[:dice.randint(3, len(words))] if k % 3 == 0 else words
        docs.append((100 + k, prose(30, k) + ", " + "; ".join(cut).title() + ". " + prose(30, k + 1), "en", "s", 1))
    table = awkward_documents(spark, docs).where("doc_id <> 8 or doc_id is null").withColumn("items", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (2_000_000, 60):
        got = decontaminate.flag(table, bench, block_tokens=size).collect()
        assert len(got) == table.count()
        for r in got:
            found = [(i, m) for i, t in items if (m := _brute(r.text, t))]
            assert (r.contaminated, r["items"]) == (bool(found), sorted({i for i, _ in found if i is not None}))
            assert r.n_matched == max((m for _, m in found), default=0)
    kept = decontaminate.clean(table, bench)
    assert kept.columns == table.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if not r.contaminated)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = awkward_documents(spark)
    assert not any(r.contaminated for r in decontaminate.flag(docs, bench).collect())
    some = spark.createDataFrame([(1, prose(20, 1))], "item_id long, text string")
    assert decontaminate.flag(empty_documents(spark), some).count() == 0


def test_long_texts_keep_their_tokens_together(spark):
    text = prose(300, 1)
    h = next(decontaminate.tokens([text]))[0]
    import jobstrata.llm.quality_ftrl as ftrl

    parts = [p for p in decontaminate.tokens([text])]
    assert len(parts) == 1 and len(h) == len(_tokens(text))
    held = ftrl.blocks.__defaults__
    try:
        ftrl.blocks.__defaults__ = (200,)
        again = list(decontaminate.tokens(["a b", text, None, "c"]))
        assert any(np.array_equal(x[0], h) for x in again)
    finally:
        ftrl.blocks.__defaults__ = held


# ---- secrets ----

SECRETS = ['token = "%s"', "password=%s", "%s"]


def _value(dice, kind):
    if kind == 2:
        return "AKIA" + "".join(dice.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    return "".join(dice.choice("0123456789abcdef") for _ in range((40, 18)[kind]))


@pytest.fixture(scope="module")
def planted(spark):
    dice, rows, secret = random.Random(5), [], {}
    for k in range(240):
        text = [prose(20, k)]
        if k % 3 == 0:
            value = _value(dice, k % 9 // 3)
            secret[k] = value
            text.append(SECRETS[k % 9 // 3] % value)
        if k % 4 == 0:
            text.append("".join(dice.choice("0123456789") for _ in range(16)))
        if k % 5 == 0:
            text.append("".join(dice.choice(["STONE", "RIVER", "MARKET"]) for _ in range(4)) + "!!")
        dice.shuffle(text)
        rows.append((k, " ".join(text) + " " + prose(10, k + 1), "en", f"src/{k}", 1))
    return spark.createDataFrame(rows, DOC_SCHEMA), secret


def test_forest_finds_planted_secrets(spark, planted):
    docs, secret = planted
    found, forest, words = secret_forest.train(docs.where("doc_id % 2 = 0"))
    assert forest and len(words) <= 400
    test = docs.where("doc_id % 2 = 1")
    judged = secret_forest.judge(secret_forest.findings(test), forest, words).collect()
    caught = {(r.doc_id, r.value) for r in judged if r.is_secret}
    assert caught == {(k, v) for k, v in secret.items() if k % 2}
    out = secret_forest.redact(test, forest, words)
    assert out.columns == test.columns
    before = {r.doc_id: r.text for r in test.collect()}
    for r in out.collect():
        value = secret.get(r.doc_id)
        assert r.text == (before[r.doc_id].replace(value, secret_forest.REPLACEMENT) if value else before[r.doc_id])


def test_scan_of_awkward_rows(spark, planted):
    docs, secret = planted
    _, forest, words = secret_forest.train(docs)
    key = 'a password="%s" b' % "0af93bc1d2e4f56789"
    rows = awkward_documents(spark, [(40, key, None, None, None), (40, key, None, None, None), (41, "0af93bc1d2e4f5 " * 3, "", "", 1)])
    clash = rows.withColumn("_hits", F.lit(1)).withColumn("own_0", F.lit(2)).withColumn("score", F.lit(3))
    out = secret_forest.redact(clash, forest, words)
    assert out.columns == clash.columns and out.count() == clash.count()
    texts = Counter((r.doc_id, r.text) for r in out.collect())
    want = Counter((r.doc_id, r.text) for r in clash.where("doc_id is null or doc_id not in (40, 41)").collect())
    assert not want - texts
    assert texts[40, 'a password="<SECRET>" b'] == 2
    nth = [(r.nth, r.value) for r in secret_forest.findings(rows).where("doc_id = 41").orderBy("nth").collect()]
    assert nth == [(k, "0af93bc1d2e4f5") for k in range(3)]


def test_scan_without_findings(spark):
    _, forest, words = secret_forest.train(empty_documents(spark))
    assert forest == [] and words == []
    docs = awkward_documents(spark)
    assert Counter(secret_forest.redact(docs, forest, words).collect()) == Counter(docs.collect())


def test_scan_runs_without_python(spark, planted):
    docs, _ = planted
    _, forest, words = secret_forest.train(docs)
    plan = secret_forest.redact(docs, forest, words)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("BatchEvalPython|ArrowEvalPython|MapIn|Pandas", plan)

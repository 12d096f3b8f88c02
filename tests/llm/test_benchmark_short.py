"""Items that spaced seeds cannot tell: short ones, scripts without blanks, items without id."""

import random

from helpers import DOC_SCHEMA, prose

from jobstrata.llm import decontaminate

JAPANESE = "\u3053\u306e\u6587\u306f\u8a13\u7df4\u7528\u306e\u8cc7\u6599\u306b\u542b\u307e\u308c\u3066\u306f\u306a\u3089\u306a\u3044\u8a66\u9a13\u554f\u984c\u3067\u3059\u3002"
ITEMS = [(1, "The answer is forty two."), (2, JAPANESE), (3, "yes"), (4, "not known"), (5, "Stands twice here"), (6, "stands, twice: HERE"),
         (None, "an item without any number at all is still one of them, is it not so"), (7, "la \u201cr\u00e9ponse\u201d est \u00abnon\u00bb")]


def _flags(spark, texts):
    docs = spark.createDataFrame([(k, t, "", "", 1) for k, t in enumerate(texts)], DOC_SCHEMA)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    return {r.doc_id: (r.contaminated, r["items"]) for r in decontaminate.flag(docs, bench).collect()}


def test_short_items_and_scripts_without_blanks(spark):
    got = _flags(spark, [
        prose(9, 1) + " the ANSWER, is: forty-two " + prose(9, 2), prose(9, 3) + JAPANESE + prose(4, 2), "yes", "Yes!", "yes it is",
        "not known", "it is not known here", "it stands twice here.", prose(3, 1) + " " + ITEMS[6][1], "la r\u00e9ponse est non",
        "the answer is forty three", JAPANESE[:9], None, ""])
    assert got == {0: (True, [1]), 1: (True, [2]), 2: (True, [3]), 3: (True, [3]), 4: (False, []), 5: (True, [4]), 6: (False, []),
                   7: (True, [5, 6]), 8: (True, []), 9: (True, [7]), 10: (False, []), 11: (False, []), 12: (False, []), 13: (False, [])}


def test_short_items_agree_with_brute_force(spark):
    dice = random.Random(2)
    words = ["a", "b", "c", "d"]
    items = [(k, " ".join(dice.choice(words) for _ in range(dice.randint(1, 7)))) for k in range(30)]
    texts = [" ".join(dice.choice(words) for _ in range(dice.randint(0, 12))) for _ in range(200)]
    docs = spark.createDataFrame([(k, t, "", "", 1) for k, t in enumerate(texts)], DOC_SCHEMA)
    got = {r.doc_id: r["items"] for r in decontaminate.flag(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    for k, t in enumerate(texts):
        w = t.split()
        want = [i for i, x in items if (n := len(x.split())) and any(w[p:p + n] == x.split() for p in range(len(w))) and (n > 2 or n == len(w))]
        assert got[k] == want


def test_one_text_in_many_steps(spark, monkeypatch):
    parts = list(decontaminate.tokens([prose(50, 1) + " the answer is forty two " + prose(50, 2)]))
    items = decontaminate.Items([i for i, _ in ITEMS], [t for _, t in ITEMS])
    for step in (7, 1 << 20):
        monkeypatch.setattr(decontaminate, "_STEP", step)
        assert {(t, k, n) for h, o in parts for t, k, n in items.whole_items(h, o)} == {(0, 0, 5)}

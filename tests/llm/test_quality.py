import re
from collections import Counter

import numpy as np
from helpers import awkward_documents, empty_documents, prose
from pyspark.sql import functions as F

from jobstrata.llm import quality_ftrl, quality_rules, shares


def _brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, repeat = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
            n < 50 or 100 * repeat > 50 * n)


def test_statistics_agree_with_brute_force(spark):
    extra = [(20, "a b c a b c a b", "", "", 1), (21, "x\ny\nx\n\n x\nx", "", "", 1), (22, "a a a a", "", "", 1),
             (23, "a|b <c> #d *e $f %g &h\x0bi\x0cj", "", "", 1), (24, "a b c x a b c", "", "", 1)]
    docs = awkward_documents(spark, extra).withColumn("n_words", F.lit(-1)).withColumn("rule", F.lit("x"))
    got = quality_rules.judge(quality_rules.statistics(docs), []).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == _brute(r.text)
        assert r.kept == (not r.base_failed)


def _labelled(spark, n=300):
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        text = prose(80, k)
        rows.append((k, " ".join(w + "***" for w in text.split()) if bad else text, "en", "s", 1))
        labels.append((k, int(not bad)))
    labels += [(0, None), (None, 0), (1, 0), (1, 1), (2, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), \
        spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_are_learned_pruned_and_applied(spark):
    docs, labels = _labelled(spark)
    counted = quality_rules.statistics(docs)
    rules = quality_rules.learn(counted, labels)
    assert 1 <= len(rules) <= 2 and all(rule for rule in rules)
    judged = {r.doc_id: r for r in quality_rules.judge(counted, rules).collect()}
    assert all(judged[k].kept == (k % 4 != 0) for k in judged)
    kept = quality_rules.filter_documents(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [k for k in range(300) if k % 4]


def test_rules_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = awkward_documents(spark)
    assert quality_rules.learn(quality_rules.statistics(docs), none) == []
    assert quality_rules.filter_documents(empty_documents(spark), none).count() == 0
    clash = docs.withColumnsRenamed({"lang": "kept"}).withColumn("_ws", F.lit(1)).withColumn("base_failed", F.lit(None))
    kept = quality_rules.filter_documents(clash, none)
    assert kept.columns == clash.columns
    assert Counter(r.doc_id for r in kept.collect())[1] == 2


def test_labels_meet_documents_without_a_shuffle_of_texts(spark, monkeypatch):
    docs, labels = _labelled(spark)
    seen, count = [], quality_rules.statistics
    monkeypatch.setattr(quality_rules, "statistics", lambda df, *a: seen.append(df) or count(df, *a))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for more labels than Spark would broadcast
    try:
        kept = sorted(r.doc_id for r in quality_rules.filter_documents(docs, labels).collect())
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in seen]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert kept == [k for k in range(300) if k % 4]
    assert len(plans) == 2 and not any(re.search("SortMergeJoin|ShuffledHashJoin", p) for p in plans)


def test_rows_that_may_hold_an_id(spark, monkeypatch):
    rows = spark.createDataFrame([(k if k % 10 else None, f"t{k}") for k in range(-500, 500)] * 2, "id long, text string")
    ids = spark.createDataFrame([(k,) for k in range(-500, 2000, 3)] * 2 + [(None,)], "id long")
    want = sorted(tuple(r) for r in rows.join(ids, "id", "left_semi").collect())
    assert sorted(tuple(r) for r in shares.may_hold(rows, ids, "id").collect()) == want
    assert shares.may_hold(rows, ids.where("false"), "id").count() == 0
    assert shares.may_hold(rows, ids.select(F.col("id").cast("int")), "id").count() == rows.where("id is not null").count()
    monkeypatch.setattr(shares, "BITS", 64)  # a full bitmap: nothing is missed
    assert shares.may_hold(rows, ids, "id").count() == rows.where("id is not null").count()


def test_rules_run_without_python(spark):
    docs, _ = _labelled(spark, 20)
    plan = quality_rules.statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan.split("LocalTableScan")[0])


def test_classifier_on_held_out_rows(spark):
    docs, labels = _labelled(spark)
    weights = quality_ftrl.fit(quality_ftrl.training_rows(docs, labels, 10_000), shards=2)
    scored = quality_ftrl.score(docs.withColumn("score", F.lit("clash")), weights).collect()
    held = [r for r in scored if (__import__("zlib").crc32(str(r.doc_id).encode()) % 3) == 1]
    assert len(held) > 50
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 != 0) for r in held]) > 0.95


def test_classifier_on_awkward_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = awkward_documents(spark)
    weights = quality_ftrl.fit(quality_ftrl.training_rows(docs, none, 100))
    assert not weights.any()
    got = quality_ftrl.score(docs, weights).collect()
    assert len(got) == docs.count() and all(r.score == 0.5 for r in got)
    assert quality_ftrl.score(empty_documents(spark), weights).count() == 0


def test_blocks_do_not_change_scores():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=1 << quality_ftrl.BITS)
    texts = [prose(400, 1), None, "", prose(3, 2), " ", prose(1000, 3)]
    whole, count = quality_ftrl.sums(texts, weights)
    for size in (50, 333, 5000):
        part, n = quality_ftrl.sums(texts, weights, size)
        assert np.allclose(whole, part) and (count == n).all()

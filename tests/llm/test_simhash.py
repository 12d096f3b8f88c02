import re

import numpy as np
import xxhash
from helpers import awkward_documents, empty_documents, prose
from pyspark.sql import functions as F

from jobstrata.llm import components, simhash_bk


def _brute_fingerprint(text):
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else \
        [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_classes(values, radius=3):
    parent = list(range(len(values)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    array = np.array(values, np.uint64)
    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array[k + 1:] ^ array[k]) <= radius) + k + 1:
            a, b = find(k), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]


def test_near_duplicates_agree_with_brute_force(spark):
    text = prose(700, 9)
    near = [(30 + k, text + f" end{k}", "en", "a", 1) for k in range(6)]
    docs = awkward_documents(spark, near)
    rows = simhash_bk.near_duplicates(docs).withColumn("fingerprint", simhash_bk.hexadecimal("fp")).collect()
    by_id = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert r.fingerprint == f"{_brute_fingerprint(by_id[r.doc_id]):016x}"
    ids = sorted(by_id, key=lambda i: (i is None, i or 0))
    found = _brute_classes([_brute_fingerprint(by_id[i]) for i in ids])
    want = {i: ids[k] for i, k in zip(ids, found)}
    assert len(rows) == docs.count()
    assert all(r.component_id == want[r.doc_id] for r in rows)


def test_small_shards_lose_no_link(spark):
    rng = np.random.default_rng(0)
    base, values = int(rng.integers(1 << 62)), set()
    for _ in range(500):
        value = base if rng.random() < 0.7 else int(rng.integers(1 << 62))
        for b in rng.integers(0, 64, rng.integers(0, 7)):
            value ^= 1 << int(b)
        values.add(value & ((1 << 64) - 1))
    values |= {base ^ m for m in range(16)}
    values = sorted(values)
    roots = _brute_classes(values)
    want = {}
    for k, root in enumerate(roots):
        want.setdefault(root, set()).add(values[k])
    want = {frozenset(v) for v in want.values() if len(v) > 1}
    table = spark.createDataFrame([(simhash_bk._signed(v),) for v in values], "fp long")
    for rows in (100_000, 60):
        got = {}
        for r in components.classes(simhash_bk.links(table, 3, rows)).collect():
            got.setdefault(r.root, {r.root & (1 << 64) - 1}).add(r.node & (1 << 64) - 1)
        assert {frozenset(v) for v in got.values()} == want


def test_classes_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5), (7, 6)]
    got = {r.node: r.root for r in components.classes(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(1, 201)) and all(got[k] == 1000 for k in range(1001, 1300))
    assert components.classes(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each(spark):
    docs = awkward_documents(spark)
    kept = simhash_bk.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 10 not in ids  # copies, also in capitals
    assert [i for i in (3, 4, 5) if i in ids] == [3]  # texts without a word are one group
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    assert sorted(r.doc_id for r in simhash_bk.one_of_each(unique).collect()) == [1, 3, 6, 7, 8, 9]
    assert simhash_bk.one_of_each(empty_documents(spark)).count() == 0
    clash = docs.withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    assert simhash_bk.near_duplicates(clash).count() == docs.count()

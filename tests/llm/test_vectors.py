import math
import random
from collections import Counter

import numpy as np
import pytest

from jobstrata.llm import lloyd_codes as lc

SCHEMA = "vec_id long, embedding array<float>, label int"


def _vectors(n, seed, width=32, spread=1.0):
    dice = random.Random(seed)
    return [[float(np.float32(dice.gauss(0, spread) + (k % 5))) for _ in range(width)] for k in range(n)]


def _brute(rows, parts=lc.PARTS, entries=lc.ENTRIES, rounds=lc.ROUNDS):
    """Plain Lloyd: every part against every entry in every round."""
    kept = [(i, [math.floor(256 * x) for x in v], t) for i, v, t in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    first = sorted((k for k in range(len(kept)) if kept[k][0] is not None), key=lambda k: (kept[k][0], kept[k][1]))[:entries]
    books = [[list(cut[k][p]) for k in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
                for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    out = [(i, bytes(k for _, k in f), sum(d for d, _ in f), t) for (i, _, t), f in zip(kept, assign())]
    sums = Counter()
    for _, _, e, t in out:
        sums[t] += e
    return sorted(((i, c, e, sums[t]) for i, c, e, t in out), key=repr), ",".join(str(x) for b in books for e in b for x in e)


def _run(frame, **options):
    coded, books = lc.code_vectors(frame, **options)
    rows = lc.with_label_errors(coded).collect()
    return sorted(((r.vec_id, bytes(r.code), r.error, r.label_error) for r in rows), key=repr), lc.books_text(books)


@pytest.mark.parametrize("n,entries,rounds", [(300, 64, 2), (300, 8, 5), (40, 64, 2), (1, 64, 2)])
def test_codes_agree_with_plain_lloyd(spark, n, entries, rounds):
    rows = [(k * 7 % 1009, v, k % 4 or None) for k, v in enumerate(_vectors(n, 1))]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert _run(frame, entries=entries, rounds=rounds) == _brute(rows, entries=entries, rounds=rounds)


def test_awkward_rows(spark):
    good = _vectors(90, 2, 16, 0.004)  # many ties: parts of one component, few distinct values
    rows = [(k, v, k % 3) for k, v in enumerate(good)]
    rows += [(5, good[7], 1), (5, good[7], 1), (None, good[9], None), (None, good[11], None), (200, [0.0] * 16, None)]
    bad = [(1000, None, 1), (1001, [None] + good[0][1:], 1), (1002, [math.nan] + good[0][1:], 1),
           (1003, [math.inf] + good[0][1:], None), (1004, good[0][:-1] + [-math.inf], 2)]
    frame = spark.createDataFrame(rows + bad, SCHEMA)
    assert _run(frame) == _brute(rows)
    odd = spark.createDataFrame(rows + [(300, [], 1), (301, [1.0] * 5, 1)], SCHEMA)
    coded, _ = lc.code_vectors(odd)
    assert {r.vec_id for r in coded.where("code is null and error is null").collect()} == {300, 301}
    assert coded.count() == len(rows) + 2


def test_other_columns_stay_and_empty_tables_work(spark):
    from pyspark.sql import functions as F

    rows = [(k, v, 1) for k, v in enumerate(_vectors(20, 3, 16))]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"code": F.lit("clash"), "n": F.lit(2), "v": F.lit(1), "dist": F.lit(1), "label_error": F.lit(2), "a.b": F.lit(3)})
    coded, _ = lc.code_vectors(frame)
    assert set(coded.columns) == {"vec_id", "label", "n", "v", "dist", "label_error", "a.b", "code", "error"} and lc.with_label_errors(coded).count() == coded.count() == 20
    for none in (spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, None, 2), (2, [], 1)], SCHEMA)):
        coded, books = lc.code_vectors(none)
        assert coded.where("code is not null").count() == 0 and not books.size
        assert lc.with_label_errors(coded).count() == coded.count()
    assert lc.books_sha256(books) == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_too_large_components_raise(spark):
    frame = spark.createDataFrame([(1, [1e30] * 16, 1)], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        lc.code_vectors(frame)


def test_active_entries_equal_a_full_scan():
    dice = np.random.default_rng(4)
    for _ in range(200):
        part, book = dice.integers(-4, 5, (50, 2)), dice.integers(-4, 5, (6, 2))
        code, dist = lc.nearest(part, book)
        new = book.copy()
        moved = dice.random(6) < 0.4
        new[moved] += dice.integers(-2, 3, (moved.sum(), 2))
        lc.reassign(part, code, dist, new, (new != book).any(axis=1))
        want = lc.nearest(part, new)
        assert (code == want[0]).all() and (dist == want[1]).all()


def test_one_label_with_most_rows(spark):
    rows = [(k, v, 1 if k % 3 else k) for k, v in enumerate(_vectors(200, 5, 16))]
    assert _run(spark.createDataFrame(rows, SCHEMA)) == _brute(rows)

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobstrata.checks import REGISTRY
from jobstrata.operators import dedupe, geo, labelling, metrics, neardup, numbering, unify, upserts

FACTS = "job_id string, job_title string, is_expired boolean, last_seen_id bigint"


def test_first_seen(spark):
    rows = [("a", "1", 3), ("a", "1", 2), ("b", "1", 5), ("a", "", 1), ("a", None, 1), ("a", "0", 1), ("a", "2", 4)]
    df = spark.createDataFrame(rows, "platform string, job_id string, seq int")
    for parts in (1, 7):
        got = dedupe.first_seen(df.repartition(parts), ["platform", "job_id"], ["seq"], id_column="job_id")
        assert sorted(map(tuple, got.collect())) == [("a", "1", 2), ("a", "2", 4), ("b", "1", 5)]


def test_first_seen_prunes_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"))
    plan = dedupe.first_seen(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_needs_label_and_fill(spark):
    df = spark.createDataFrame([("1", None), ("2", ""), ("3", "Data Analyst"), ("4", None)], "job_id string, label string")
    loaded = spark.createDataFrame([("4",)], "job_id string")
    open_rows = dedupe.needs_label(df, loaded)
    assert {r.job_id for r in open_rows.collect()} == {"1", "2"}
    labels = spark.createDataFrame([(1, "Data Engineer"), (3, "Data Scientist")], "job_id bigint, job_label string")
    got = {r.job_id: r.label for r in labelling.fill_label(df, labels).collect()}
    assert got == {"1": "Data Engineer", "2": "None", "3": "Data Scientist", "4": "None"}


def test_numbering_with_a_hot_leading_key(spark):
    rows = [(1 if i % 3 else i, i) for i in range(2000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v int").repartition(9)
    got = [(r.k, r.v) for r in sorted(numbering.number_rows(df, ["k", "v"]).collect(), key=lambda r: r.row_no)]
    assert got == sorted(rows)
    assert numbering.number_rows(df.limit(0), ["k"]).count() == 0


def test_batches_and_fallbacks(spark):
    df = spark.createDataFrame([(i, f"j{i}", "Data Engineer" if i % 2 else "x") for i in range(65)],
                               "seq int, job_id string, job_title string")
    requests = labelling.chunk(df, ["seq"])
    assert [r["count"] for r in requests.groupBy("batch_id").count().orderBy("batch_id").collect()] == [30, 30, 5]
    broken = lambda d: labelling.rule_labeller(d).filter("job_id <> 'j3'")
    nothing = lambda d: labelling.rule_labeller(d).limit(0)
    got = {r.job_id: r.job_label for r in labelling.label_with_fallbacks(requests, [nothing, broken]).collect()}
    assert got["j3"] == "No Ouput" and got["j29"] == "No Ouput" and got["j31"] == "Data Engineer" and got["j64"] == "None"


def test_replies(spark):
    texts = ['{"jobs":[{"job_id":7,"job_label":"None"},{"job_id":"x","job_label":"Data Analyst"}]}',
             '{"jobs":[{"job_id":7,"job_label":"Chef"}]}', "oops", None]
    df = spark.createDataFrame([(t,) for t in texts], "reply string")
    got = [r[0] for r in df.select(labelling.decode_reply(F.col("reply"))).collect()]
    assert [tuple(j) for j in got[0]] == [("7", "None"), ("x", "Data Analyst")] and got[1:] == [None] * 3
    req = spark.createDataFrame([(0, 0, "1", "Kỹ sư")], "batch_id int, batch_pos int, job_id string, job_title string")
    assert labelling.encode_batches(req).first().request == '[{"job_id":"1","job_title":"Kỹ sư"}]'


# ---- near-duplicates ---------------------------------------------------------------------------


def brute_force(texts, threshold=0.75, n=3):
    """Kept positions by the definition, with dense vectors."""
    grams = [[t[i:i + n] for i in range(len(t) - n + 1)] for t in texts]
    vocabulary = {g: i for i, g in enumerate(sorted({g for gs in grams for g in gs}))}
    m = np.zeros((len(texts), max(len(vocabulary), 1)))
    for r, gs in enumerate(grams):
        for g in gs:
            m[r, vocabulary[g]] += 1
    m *= np.log((1 + len(texts)) / (1 + (m > 0).sum(0))) + 1
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    s = m @ m.T
    key, drop = set(), set()
    for i in range(len(texts)):  # the sequential rule, as an independent statement of the result
        for u in np.where(s[i] > threshold)[0]:
            if i != u and u not in key:
                key.add(i)
                drop.add(int(u))
    return set(range(len(texts))) - drop, s


def made_up(seed, size, words=12):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(words)]
    out = []
    for _ in range(size):
        if out and rng.random() < 0.5:
            t = list(rng.choice(out))
            for _ in range(rng.randint(0, 3)):
                if t:
                    t[rng.randrange(len(t))] = rng.choice("abcdefgh ")
            out.append(" ".join("".join(t).split()))
        else:
            out.append(" ".join(rng.sample(base, rng.randint(1, 4))))
    return out + ["ab", "ab", "", "x"]


def kept(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, v string").repartition(3)
    return {r.seq for r in neardup.drop_near_duplicates(df, row="seq", text="v", **kw).collect()}


@pytest.mark.parametrize("seed,size", [(1, 60), (2, 150), (3, 300)])
def test_near_duplicates_match_brute_force(spark, seed, size):
    texts = made_up(seed, size)
    want, s = brute_force(texts)
    assert np.abs(s - 0.75).min() > 1e-7
    assert kept(spark, texts) == want


def test_near_duplicates_with_split_lists(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LIST_SPLIT", 7)
    monkeypatch.setattr(neardup, "GRID_SPLIT", 5)
    texts = made_up(5, 200)
    assert kept(spark, texts) == brute_force(texts)[0]


def test_hot_group_of_copies(spark):
    texts = [f"data analyst company {i % 7}" for i in range(400)] + made_up(6, 100)
    assert kept(spark, texts) == brute_force(texts)[0]


def test_chain_drops_both_later_rows(spark):
    rng = random.Random(0)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = ["".join(rng.choice(letters) for _ in range(20)) for _ in range(30)]
    a = "abcdefghijklmnopqrst"
    texts = [a, a[3:] + "XYZ", a[6:] + "XYZUVW"] + noise
    _, s = brute_force([t.lower() for t in texts])
    assert s[0, 1] > 0.75 and s[1, 2] > 0.75 and s[0, 2] < 0.75
    assert kept(spark, texts) == set(range(len(texts))) - {1, 2}


def test_short_equal_texts_are_kept(spark):
    assert kept(spark, ["ab", "ab", "abcd", "abcd"]) == {0, 1, 2}


def test_all_pairs_match_brute_force(spark):
    texts = [t for t in dict.fromkeys(made_up(8, 120)) if len(t) >= 3]
    _, s = brute_force(texts)
    want = {(a, b) for a, b in zip(*np.where(np.triu(s, 1) > 0.75))}
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, v string")
    got = {(r.a, r.b) for r in neardup.similar_rows(df, row="seq", text="v").collect()}
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3])
def test_all_pairs_with_a_joined_vocabulary(spark, monkeypatch, n):
    monkeypatch.setattr(neardup, "VOCABULARY", 5)
    texts = [t for t in dict.fromkeys(made_up(9, 80)) if len(t) >= n]
    _, s = brute_force(texts, n=n)
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, v string")
    got = {(r.a, r.b): r.similarity for r in neardup.similar_rows(df, row="seq", text="v", n=n).collect()}
    assert set(got) == {(a, b) for a, b in zip(*np.where(np.triu(s, 1) > 0.75))}
    assert all(abs(s[p] - x) < 1e-9 for p, x in got.items())
    assert kept(spark, texts, n=n) == brute_force(texts, n=n)[0]


def test_similar_rows_with_their_copies_give_every_pair(spark):
    texts = [t for t in made_up(10, 90) if len(t) >= 3]
    _, s = brute_force(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, v string")
    first = {r[0]: r[1] for r in neardup.copies_of(df, row="seq", text="v").select("row", "first").collect()}
    alike = {(r.a, r.b) for r in neardup.similar_rows(df, row="seq", text="v").collect()}
    got = {(a, b) for a in first for b in first if a < b and (
        first[a] == first[b] or tuple(sorted((first[a], first[b]))) in alike)}
    assert got == {(a, b) for a, b in zip(*np.where(np.triu(s, 1) > 0.75))}


def test_grams_outside_the_basic_plane(spark):
    df = spark.createDataFrame([("a😀bç",), ("ab",), (None,)], "v string")
    assert [r[0] for r in df.select(neardup.char_grams(F.col("v"))).collect()] == [["a😀b", "😀bç"], [], None]


# ---- set operations ----------------------------------------------------------------------------


def test_union_sites(spark):
    one = spark.createDataFrame([(1, "t")], "jobId int, title string")
    other = spark.createDataFrame([("2", "u", "z")], "id string, name string, extra string")
    bad = spark.createDataFrame([("3",)], "id string")
    columns = {"one": ["jobId", "title"], "other": ["id", "name"]}
    got = unify.union_sites([("one", one), ("new", other), ("new", bad)], columns=columns, on_missing="skip")
    assert sorted(map(tuple, got.collect())) == [("1", "t", "one"), ("2", "u", "new")]
    with pytest.raises(ValueError):
        unify.union_sites([("new", bad)], columns=columns, on_missing="raise")


def test_explode_skills(spark):
    df = spark.createDataFrame([("1", ["a", None, "b"]), ("2", []), ("3", None)], "job_id string, skills array<string>")
    assert sorted(map(tuple, unify.explode_skills(df).collect())) == [("1", "a"), ("1", "b")]


# ---- upserts -----------------------------------------------------------------------------------


def dim(spark, rows):
    return spark.createDataFrame(rows, "emp_id bigint, emp_raw string, emp_cleaned string")


def test_insert_only_upsert_is_idempotent(spark):
    batch = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("d",)], "emp_raw string")
    once = upserts.upsert_dim(dim(spark, [(4, "a", "A")]), batch, key="emp_raw", surrogate="emp_id", columns=["emp_raw"])
    assert sorted(map(tuple, once.collect())) == [(4, "a", "A"), (5, "b", None), (6, "d", None)]
    twice = upserts.upsert_dim(once, batch, key="emp_raw", surrogate="emp_id", columns=["emp_raw"])
    assert sorted(twice.collect()) == sorted(once.collect())


def test_full_upsert(spark):
    batch = spark.createDataFrame([("a", "new"), ("b", None)], "emp_raw string, emp_cleaned string")
    args = {"key": "emp_raw", "surrogate": "emp_id", "columns": ["emp_cleaned"]}
    got = upserts.upsert_dim(dim(spark, [(1, "a", "A"), (2, "c", "C")]), batch, **args)
    assert sorted(map(tuple, got.collect())) == [(1, "a", "new"), (2, "c", "C"), (3, "b", None)]
    with pytest.raises(ValueError):
        upserts.upsert_dim(dim(spark, []), batch.unionByName(batch), **args)
    with pytest.raises(ValueError):
        upserts.upsert_dim(dim(spark, []), batch.limit(0), **args)
    with pytest.raises(ValueError):
        upserts.upsert_dim(dim(spark, []), batch, key="emp_raw", surrogate="emp_id", columns=[])


def test_fact_merge(spark):
    facts = spark.createDataFrame([("1", "old", False, 1), ("2", "two", False, 1)], FACTS)
    batch = spark.createDataFrame([("1", "changed", True, 9), ("3", "three", False, 9)], FACTS)
    once = upserts.merge_facts(facts, batch)
    assert sorted(map(tuple, once.collect())) == [("1", "old", True, 9), ("2", "two", False, 1), ("3", "three", False, 9)]
    assert sorted(upserts.merge_facts(once, batch).collect()) == sorted(once.collect())
    assert upserts.merge_facts(facts, batch.limit(0)) is facts
    with pytest.raises(ValueError):
        upserts.merge_facts(facts, batch.unionByName(batch))


def test_bridge_and_expiry(spark):
    bridge = spark.createDataFrame([(1, "a")], "skill_id bigint, job_id string")
    batch = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a")], "skill_id bigint, job_id string")
    assert list(map(tuple, upserts.new_bridge_rows(bridge, batch).collect())) == [(2, "a")]
    facts = spark.createDataFrame([("1", "t", False, 1), ("2", "t", True, 2), ("3", "t", True, 7)], FACTS)
    days = spark.createDataFrame([(1, "2026-02-09"), (2, "2026-02-10")], "date_id bigint, d string").select(
        "date_id", F.col("d").cast("date").alias("actual_date"))
    got = {r.job_id: r.is_expired for r in upserts.mark_expired(facts, days, "2026-02-10").collect()}
    assert got == {"1": True, "2": False, "3": True}


# ---- the rest ----------------------------------------------------------------------------------


def test_nearest_place_matches_brute_force(spark):
    rng = random.Random(3)
    towns = [(f"c{i}", f"p{i % 5}", rng.uniform(-89, 89), rng.uniform(-180, 180)) for i in range(60)]
    towns += [("Hanoi", "Ha Noi", 21.03, 105.85), ("Fiji", "F", -17.0, 179.9), ("Pole", "P", 89.9, 0.0)]
    spots = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(200)]
    spots += [(900, 21.0, 105.8), (901, -17.0, -179.9), (902, 89.0, 180.0), (903, None, 1.0)] + [(1000 + i, 10.0, 20.0) for i in range(50)]

    def unit(la, lo):
        la, lo = np.radians(la), np.radians(lo)
        return np.array([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)])

    want = {i: None if la is None else min(towns, key=lambda c: ((unit(la, lo) - unit(c[2], c[3])) ** 2).sum())[0]
            for i, la, lo in spots}
    got = geo.nearest_place(spark.createDataFrame(spots, "id int, lat double, lon double"),
                            spark.createDataFrame(towns, "city string, admin1 string, lat double, lon double"))
    assert {r.id: r.city for r in got.collect()} == want


@pytest.mark.parametrize("kind", ["spread", "cluster", "line"])
def test_few_places_are_compared_with_each_spot(spark, kind):
    rng = random.Random(5)
    if kind == "spread":
        at = [(rng.uniform(-89, 89), rng.uniform(-180, 180)) for _ in range(3000)]
    elif kind == "cluster":  # a dense region far from most spots, and coordinates that repeat
        at = [(10 + rng.gauss(0, 0.05), 106 + rng.gauss(0, 0.05)) for _ in range(2500)] + [(10.0, 106.0)] * 500
    else:
        at = [(0.0, -179 + k * 0.1) for k in range(3000)]
    spots = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(150)] + [(500 + i, 10.0 + i / 1e4, 106.0) for i in range(50)]

    def unit(la, lo):
        la, lo = np.radians(la), np.radians(lo)
        return np.array([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)]).T

    places = unit(*np.array(at).T)
    points = unit(np.array([s[1] for s in spots]), np.array([s[2] for s in spots]))
    least = ((points[:, None, :] - places[None]) ** 2).sum(2).min(1)
    frame = spark.createDataFrame(spots, "id int, lat double, lon double")
    towns = spark.createDataFrame([(f"c{i:05}", "p", *x) for i, x in enumerate(at)], "city string, admin1 string, lat double, lon double")
    got = {r.id: int(r.city[1:]) for r in geo.nearest_place(frame, towns).collect()}
    for k, s in enumerate(spots):
        assert abs(((points[k] - places[got[s[0]]]) ** 2).sum() - least[k]) < 1e-12
    one = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "spot int, x double, y double, z double")
    unique = spark.createDataFrame(sorted({tuple(map(float, p)) for p in places}), "gx double, gy double, gz double")
    per_spot = [r["count"] for r in geo.near_candidates(one, unique).groupBy("spot").count().collect()]
    assert len(per_spot) == len(spots) and sum(per_spot) / len(per_spot) < 150


def test_nearest_place_of_nothing(spark):
    spots = spark.createDataFrame([(1, 1.0, 2.0), (2, None, None)], "id int, lat double, lon double")
    none = spark.createDataFrame([], "city string, admin1 string, lat double, lon double")
    assert [r.city for r in geo.nearest_place(spots, none).collect()] == [None, None]
    assert geo.nearest_place(spots.limit(0), none).count() == 0


def test_metrics(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "a")], "id int, v string")
    seen, observed = metrics.counted(df, "rows_seen")
    assert seen.filter("id > 1").count() == 2 and observed.get["rows"] == 3
    assert metrics.null_counts(df, ["v"]).first().asDict() == {"n_rows": 3, "v_nulls": 1}
    assert [tuple(r) for r in metrics.value_counts(df.dropna(), "v").collect()] == [("a", 2)]


def test_replies_keep_the_row_count(spark):
    requests = spark.createDataFrame([(1, "a", "t"), (1, "b", "t"), (2, "c", "t"), (3, "d", "t")],
                                     "batch_id int, job_id string, job_title string")
    reply = lambda rows: spark.createDataFrame(rows, "batch_id int, job_id string, job_label string")
    twice = reply([(1, "a", "x"), (1, "a", "y"), (2, "c", "z"), (2, "c", "z"), (3, "d", "w"), (3, "other", "w"), (9, "q", "w")])
    good = labelling.complete_batches(requests, twice)
    assert [tuple(r) for r in good.collect()] == [(2, "c", "z")]
    sent = []

    def first(df):
        sent.append(sorted(r.job_id for r in df.collect()))
        return twice

    def second(df):
        sent.append(sorted(r.job_id for r in df.collect()))
        return df.filter("batch_id = 1").selectExpr("batch_id", "job_id", "'second' as job_label")

    got = labelling.label_with_fallbacks(requests, [first, second], failed="none").collect()
    assert sorted((r.job_id, r.job_label) for r in got) == [("a", "second"), ("b", "second"), ("c", "z"), ("d", "none")]
    assert sent == [["a", "b", "c", "d"], ["a", "b", "d"]]
    unknown = labelling.label_with_fallbacks(requests, [lambda df: twice], failed="none", labels=["x"])
    assert {r.job_label for r in unknown.collect()} == {"none"}


def test_repeated_dimension_value_raises(spark):
    from jobstrata.operators import lookups

    dim = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "name string, id int")
    rows = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(Exception, match="more than once"):  # found by the aggregate that feeds the join
        lookups.attach_key(rows, dim, value="v", dim_value="name", surrogate="id").collect()


def _common(size):
    """Texts of few words, so that nearly every two of them share most of their grams."""
    rng = random.Random(7)
    return [(k, " ".join(rng.choice(["data", "date", "team", "tame", "meat"]) for _ in range(rng.randint(2, 9)))) for k in range(size)]


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_common_grams_are_multiplied_not_joined(spark, monkeypatch, kind):
    rows = _common(120)
    df = spark.createDataFrame([(k if kind == "bigint" else f"{k:05d}", v) for k, v in rows], f"seq {kind}, v string")
    kept = {r.seq for r in neardup.drop_near_duplicates(df, row="seq", text="v", threshold=0.9).collect()}
    monkeypatch.setattr(neardup, "JOINED", 0)  # always joined
    assert kept == {r.seq for r in neardup.drop_near_duplicates(df, row="seq", text="v", threshold=0.9).collect()}
    monkeypatch.setattr(neardup, "JOINED", 200)
    monkeypatch.setattr(neardup, "BLOCK_CELLS", 300)  # blocks of few rows
    monkeypatch.setattr(neardup, "_prefix_pairs", None)
    assert kept == {r.seq for r in neardup.drop_near_duplicates(df, row="seq", text="v", threshold=0.9).collect()}


def test_grams_are_counted_per_text(spark):
    texts = ["abcabcab", "", None, "ab", "é😀é😀é😀", "aaaa  aaaa"]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(texts)], "k int, v string").coalesce(1)
    got = {r[0]: None if r[1] is None else sorted(map(tuple, r[1])) for r in df.select("k", neardup.gram_counts(neardup.char_grams(F.col("v")))).collect()}
    want = {k: None if v is None else sorted(Counter(v[i:i + 3] for i in range(len(v) - 2)).items()) for k, v in enumerate(texts)}
    assert got == want


def test_gram_totals_of_texts_in_several_rows(spark, tmp_path):
    """Rows of one id are one text; those without id are one as well."""
    rows = [(1, "abcd"), (2, "abcabc"), (2, "bcd"), (None, "abc"), (None, "abc"), (3, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.gram: (r.n_uses, r.n_texts) for r in REGISTRY["character_grams"][0](spark, str(tmp_path)).collect()}
    assert got == {"abc": (5, 3), "bcd": (2, 2), "bca": (1, 1), "cab": (1, 1)}


def _words(size, seed=3):
    """Texts of many words drawn from a small stock, some of them copies with a word changed."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    out = []
    for _ in range(size):
        words = rng.choice(out).split() if out and rng.random() < 0.4 else [rng.choice(stock) for _ in range(rng.randint(3, 200))]
        words[rng.randrange(len(words))] = rng.choice(stock)
        out.append(" ".join(words))
    return out


def test_near_duplicates_store_little_beside_the_texts(spark, monkeypatch):
    from pathlib import Path

    texts, sizes, real = _words(400), [], neardup.materialise

    def stored(df, name="stage"):
        out = real(df, name)
        sizes.append(sum(Path(f.removeprefix("file://")).stat().st_size for f in out.inputFiles()))
        return out

    monkeypatch.setattr(neardup, "materialise", stored)
    assert kept(spark, texts) == brute_force(texts)[0]
    assert sum(sizes) < 12 * sum(len(t) for t in texts)  # 36 times when weights and joined prefixes were stored


@pytest.mark.parametrize("joined", [0, 10 ** 9])  # always joined, always multiplied
def test_near_duplicates_after_few_witnesses(spark, monkeypatch, joined):
    for name, value in (("FIRST", 3), ("HUBS", 3), ("PORTION", 1), ("BLOCK_TERMS", 3000), ("JOINED", joined)):
        monkeypatch.setattr(neardup, name, value)
    texts = _words(150) + ["ab", "ab", "", "x"]
    assert kept(spark, texts) == brute_force(texts)[0]


def test_products_of_sketches_are_no_less_than_those_of_vectors():
    rng = np.random.default_rng(5)
    n_terms = 5000
    weights = type("Held", (), {"value": (np.arange(0, n_terms, 50), np.arange(1, 101), np.linspace(9, 1, 100))})

    def block(n):
        terms = [np.unique(rng.choice(n_terms, size=rng.integers(1, 300), p=np.arange(1, n_terms + 1) / (n_terms * (n_terms + 1) / 2))) for _ in range(n)]
        tf = [rng.integers(1, 9, len(t)) for t in terms]
        raw = [neardup._weighed(t, f, weights)[1] for t, f in zip(terms, tf)]
        columns = [range(n), [len(t) for t in terms], [float(np.sqrt((r * r).sum())) for r in raw], np.concatenate(terms), np.concatenate(tf)]
        dense = np.zeros((n, n_terms))
        for k, (t, r) in enumerate(zip(terms, raw)):
            dense[k, t] = r / np.sqrt((r * r).sum())
        return neardup._Block([pa.array(c) for c in columns], weights, n_terms), dense

    (a, u), (b, v) = block(70), block(90)
    assert (a.sketch @ b.sketch.T >= u @ v.T - neardup.ROUNDED).all()
    a.look_up()
    for j in range(90):
        found = a.similar(np.arange(70), b, j, 0.2)
        assert (found is None) == ((u @ v[j]).max() <= 0.2) and (found is None or u[found] @ v[j] > 0.2)

"""One run over all kinds of landed files, and what it leaves behind."""

import json
import os

import pytest
from pyspark.sql import functions as F
from test_stages import CAREERJET, DETAIL_123, JOB123, RESPONSES, RUN, STUDENT_DETAIL, STUDENTJOB

from jobstrata import schemas
from jobstrata.operators import lookups
from jobstrata.plans import collect, load
from jobstrata.sources import pages
from jobstrata.sources.tables import TableStore
from jobstrata.streaming.incremental import Landed, run_landed

TOWNS = [("HCMC", "Ho Chi Minh", 10.82, 106.63), ("Hanoi", "Ha Noi", 21.0, 105.8)]


def _write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def _lines(rows):
    return "\n".join(json.dumps(r, ensure_ascii=False) for r in rows)


@pytest.fixture
def landed(spark, tmp_path):
    _write(tmp_path / "vietnamworks", "1.json", _lines([{"page_no": 1, "data": RESPONSES["vietnamworks"]}]))
    for k, job in enumerate(RESPONSES["careerviet"]):  # a pretty-printed body a file
        _write(tmp_path / "careerviet", f"{k}.json", json.dumps({"page_no": 1, "data": [job]}, indent=2, ensure_ascii=False))
    _write(tmp_path / "listings", "1.json", _lines([
        {"platform": "job123", "page_no": 1, "html": JOB123}, {"platform": "careerjet", "page_no": 1, "html": CAREERJET},
        {"platform": "studentjob", "page_no": 1, "html": STUDENTJOB}]))
    cards = spark.createDataFrame([("studentjob", 1, STUDENTJOB), ("job123", 1, JOB123)], "platform string, page_no bigint, html string")
    ids = {r.platform: r.job_id for r in pages.cards_to_postings(pages.find_cards(cards)).where("job_link is not null").collect()}
    _write(tmp_path / "details", "1.json", _lines([
        {"platform": "studentjob", "job_id": ids["studentjob"], "status": 200, "html": STUDENT_DETAIL},
        {"platform": "job123", "job_id": ids["job123"], "status": 200, "html": DETAIL_123},
        {"platform": "job123", "job_id": "gone", "status": 404}]))
    where = {n: str(tmp_path / n) for n in ("vietnamworks", "careerviet", "listings", "details")}
    return ids, Landed({"vietnamworks": where["vietnamworks"]}, {"careerviet": where["careerviet"]}, where["listings"], where["details"])


def _files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_one_run_over_all_kinds_of_files(spark, landed, tmp_path):
    ids, sources = landed
    store, towns = TableStore(spark, str(tmp_path / "star")), spark.createDataFrame(TOWNS, schemas.GAZETTEER)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = _files(shared)
    ran = run_landed(spark, sources, store, str(tmp_path / "progress"), run_ts=RUN, gazetteer=towns)
    # four files, one micro-batch for each of the three posting sources
    assert ran.batches == 3 and ran.loaded.facts == store.read("fact_job_postings").count()
    facts = {r.job_id: r for r in store.read("fact_job_postings").collect()}
    assert {"cv1", "12", ids["studentjob"], ids["job123"]} <= set(facts) and "cv3" not in facts
    days = {r.date_id: str(r.actual_date) for r in store.read("date_dim").collect()}
    places = {r.location_id: r.location_name for r in store.read("location_dim").collect()}
    student = facts[ids["studentjob"]]
    assert (days[student.created_on_id], places[student.location_id]) == ("2026-02-05", "Ho Chi Minh")
    skills = {r.skill_raw for r in store.read("fact_skill").where(F.col("job_id") == ids["studentjob"]).join(
        store.read("skill_dim"), "skill_id").collect()}
    assert "Python" in skills
    # nothing of the run's own stays: no scratch table, one generation a table, nothing aside
    assert _files(shared) == before
    for name in (*schemas.DIMENSIONS, "fact_skill"):
        assert len([n for n in os.listdir(tmp_path / "star" / name) if n.startswith("g=")]) == 1
    assert sorted(n for n in os.listdir(tmp_path / "star" / "fact_job_postings") if not n.startswith(".")) == ["rows"]
    again = run_landed(spark, sources, store, str(tmp_path / "progress"), run_ts=RUN, gazetteer=towns)
    assert again == (0, None) and {r.job_id: r for r in store.read("fact_job_postings").collect()} == facts


def test_a_detail_page_may_land_before_its_posting(spark, landed, tmp_path):
    ids, sources = landed
    store, towns = TableStore(spark, str(tmp_path / "star")), spark.createDataFrame(TOWNS, schemas.GAZETTEER)
    progress = str(tmp_path / "progress")
    assert run_landed(spark, Landed(details=sources.details), store, progress, run_ts=RUN).batches == 0
    run_landed(spark, Landed(listings=sources.listings, details=sources.details), store, progress, run_ts=RUN, gazetteer=towns)
    assert ids["studentjob"] in {r.job_id for r in store.read("fact_job_postings").collect()}


def test_a_broken_body_stops_the_run_or_is_skipped(spark, tmp_path):
    _write(tmp_path / "careerviet", "a.json", json.dumps({"page_no": 1, "data": RESPONSES["careerviet"]}, indent=1)[:-9])
    sources, store = Landed(bodies={"careerviet": str(tmp_path / "careerviet")}), TableStore(spark, str(tmp_path / "star"))
    with pytest.raises(Exception):
        run_landed(spark, sources, store, str(tmp_path / "p"), run_ts=RUN)
    assert run_landed(spark, sources, store, str(tmp_path / "q"), run_ts=RUN, on_broken="skip").loaded is None


# ---- order of arrival -----------------------------------------------------------------------------


def test_repeated_page_numbers_give_the_same_rows_however_they_lie(spark):
    rows = [("s", f"file{k % 3}", 1, 0, f"{k % 5 + 1}", f"Data Engineer {k}", None, f"e{k}", None, f"l{k}", None, None) for k in range(60)]
    rows += [("s", None, 1, 0, str(k % 5 + 1), f"Data Analyst {k}", None, None, None, None, None, None) for k in range(40)]
    raw = spark.createDataFrame(rows, schemas.POSTING_RAW)
    none = spark.createDataFrame([], "job_id string")
    got = []
    for parts in (1, 7):
        for df in (raw, raw.orderBy(F.desc("job_title"))):
            got.append(sorted(map(tuple, collect.collect(df.repartition(parts), none).master.collect())))
    assert all(g == got[0] for g in got) and len(got[0]) == 5
    assert [r[0] for r in got[0]] == list(range(5))


# ---- facts by part --------------------------------------------------------------------------------


def _postings(spark, ids, label="Data Engineer", day="2026-02-03"):
    rows = [(k, str(i), f"title {i}", day, f"employer {i}", "Hà Nội", label, f"https://x/{i}") for k, i in enumerate(ids)]
    return spark.createDataFrame(rows, "seq long, job_id string, job_title string, date_view string, emp_raw string, "
                                       "location_name string, label_name string, job_link string")


def test_only_the_parts_of_a_batch_are_rewritten(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    skills = spark.createDataFrame([(str(i), "SQL") for i in range(300)], schemas.JOB_SKILL)
    load.load(store, load.prepare(_postings(spark, range(200)), skills, run_ts=RUN), run_ts=RUN)
    rows = f"{tmp_path}/fact_job_postings/rows"
    before = _files(rows)
    batch = _postings(spark, [7, 250])
    met = {r[0] for r in batch.select(store.part_of("fact_job_postings")).collect()}
    later = "2026-02-12 02:00:00"
    load.load(store, load.prepare(batch, skills, run_ts=later), run_ts=later)
    after = _files(rows)
    touched = {f"part={p}" for p in met}
    assert {f for f in before if os.path.basename(os.path.dirname(f)) not in touched} == {
        f for f in after if os.path.basename(os.path.dirname(f)) not in touched}
    assert before - after and after - before
    load.load(store, load.prepare(batch, skills, run_ts=later), run_ts=later)
    assert _files(rows) == after, "a repeated run rewrites nothing"
    facts = load.current_facts(store, later[:10])
    assert facts.count() == 201
    assert {r.job_id for r in facts.where("not is_expired").collect()} == {"7", "250"}
    plan = store.read_met("fact_job_postings", batch)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part#" in plan


def test_a_run_that_died_while_parts_were_put_in_place_is_finished_later(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    one = spark.createDataFrame([(str(i), "t", False, "l", 1, 1, 1, 1, 1) for i in range(50)], schemas.FACT_POSTINGS)
    store.replace_parts("fact_job_postings", one)
    put, store._put_in_place = store._put_in_place, lambda name: None
    store.replace_parts("fact_job_postings", one.withColumn("job_title", F.lit("new")))
    store._put_in_place = put
    rows = TableStore(spark, str(tmp_path)).read("fact_job_postings").collect()
    assert len(rows) == 50 and {r.job_title for r in rows} == {"new"}
    store.replace("fact_job_postings", one.limit(3))
    assert store.read("fact_job_postings").count() == 3


def test_counts_are_taken_before_the_repairs(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first = _postings(spark, range(10))
    second = _postings(spark, range(10, 14), label=None)
    skills = spark.createDataFrame([("1", "SQL"), ("1", None), ("12", " Spark "), ("99", "none")], schemas.JOB_SKILL)
    got = load.load(store, load.prepare(first.unionByName(second.withColumn("seq", F.col("seq") + 10)), skills, run_ts=RUN), run_ts=RUN)
    assert got == load.Loaded(facts=14, null_labels=4, null_employers=0, null_places=0, null_days=0, skills=3, null_skills=1)
    assert {r.label_id for r in store.read("fact_job_postings").where("job_id = '12'").collect()} == {5}


def test_a_repeated_key_is_found_in_the_join_itself(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    dim = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "id long, name string")
    out = lookups.attach_key(df, dim, value="v", dim_value="name", surrogate="id")
    assert sorted(map(tuple, out.collect()), key=repr) == [("a", 1), ("b", None), (None, None)]
    twice = dim.unionByName(spark.createDataFrame([(4, "a")], "id long, name string"))
    with pytest.raises(Exception, match="more than once"):
        lookups.attach_key(df, twice, value="v", dim_value="name", surrogate="id").collect()

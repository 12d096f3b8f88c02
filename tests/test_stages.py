"""Landed files to star schema on small hand-written inputs."""

import json

import pytest
from pyspark.sql import functions as F

from jobstrata import schemas
from jobstrata.operators import geo
from jobstrata.plans import collect, load, marts
from jobstrata.plans.requests import request_list
from jobstrata.sources import handoff, html, pages, payloads
from jobstrata.sources.tables import TableStore

RUN = "2026-02-10 02:00:00"

JOB123 = """<html><body>
<div class="job__list-item js-item-job flex" data-time="2026-02-01 08:00:00">
  <h2 class="job__list-item-title"><a href="/viec-lam/1"> Data <b>Analyst</b> </a></h2>
  <div class="job__list-item-company text-collapse">ACME</div><div class="address"><label>Hà Nội</label></div></div>
<div class="job__list-item js-item-job flex"><h2 class="job__list-item-title">Marketing</h2></div>
</body></html>"""
CAREERJET = """<ul><li><article class="job clicky"><h2><a href="https://www.careerjet.vn/j/9">SQL Developer</a></h2>
<p class="company">Beta</p><ul class="location"><li>Đà Nẵng<li>Cần Thơ</ul>
<span class="badge badge-r badge-s badge-icon">3 ngày trước</span></article></li></ul>"""
STUDENTJOB = """<div class="single-job-items"><div class="job-tittle job-tittle2"><a href="/nop-don/1">x</a>
<a href="/viec-lam/ai-engineer-1"><h2 class="h4">AI Engineer</h2></a></div><li class="mb-1"><a>Gamma</a></li></div>"""
STUDENT_DETAIL = """<ul><li><div class="summary-content"><span class="content">Full/part</span></div></li>
<li><div class="summary-content"><span class="content">05/02/2026</span></div></li>
<li class="no-border map-full"><input value="10.8"><input value="106.7"></li></ul>
<div class="col-main-content"><p>Python and <i>PyTorch</i></p><br>C++ is a plus</div>"""
DETAIL_123 = """<div class="content-collapse"><p>SQL, Power BI</div><div class="content-collapse"> Excel </div>"""

RESPONSES = {
    "careerviet": [{"job_id": "cv1", "job_title": "Data Engineer", "date_view": "2026-02-03", "emp_name": "Delta",
                    "location_name": ["Hà Nội", "Hồ Chí Minh"], "job_link": "https://careerviet.vn/en/cv1"},
                   {"job_id": "cv1", "job_title": "Data Engineer again", "job_link": "https://careerviet.vn/en/x"},
                   {"job_id": "cv2", "job_title": "", "job_link": "https://careerviet.vn/en/cv2"},
                   {"job_id": "cv3", "job_title": "Data Expert", "date_view": "2025-01-01", "emp_name": "Old",
                    "location_name": "Paris", "job_link": "https://careerviet.vn/en/cv3"}],
    "vietnamworks": [{"jobId": 11, "jobTitle": "Data Engineer", "createdOn": "2026-02-04T09:00:00+07:00",
                      "companyName": "Delta", "jobUrl": "https://v/11", "skills": [{"skillName": "Spark "}],
                      "workingLocations": [{"cityNameVI": "Huế"}, {"cityNameVI": "Hà Nội"}]},
                     {"jobId": 12, "jobTitle": "Head of Data Governance", "createdOn": "2026-02-04T09:00:00+07:00",
                      "companyName": "Eps", "jobUrl": "https://v/12", "skills": [], "workingLocations": []}],
    "monster": [{"jobId": 21, "title": "Data Scientist", "createdAt": 1770000000000, "applyUrl": "https://m/21",
                 "itSkills": [{"text": "Python"}, {"text": "SQL"}], "locations": [{"city": "Hanoi"}, {"city": "x"}],
                 "company": {"name": "Zeta"}}],
    "topdev": [{"title": "AI Architect", "detail_url": "https://topdev.vn/1", "published": {"date": "03-02-2026"},
                "company": {"display_name": "Eta", "addresses": {"address_short_region_list": "Hồ Chí Minh"}},
                "skills_arr": ["Python", None]}],
    "itviec": [{"title": " BI Analyst, data ", "url": "https://ITviec.com/1 ", "company": "Theta", "location": "Ha Noi",
                "age_text": "Posted\n5 hours ago", "tags": ["SQL", "+1"], "tooltip": "Tableau, SQL"}],
}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landed")
    parts = []
    for platform, jobs in RESPONSES.items():
        folder = base / platform
        folder.mkdir()
        lines = [json.dumps({"page_no": 1, "data": jobs}, ensure_ascii=False), "[]", '{"page_no": 2}', "broken"]
        (folder / "1.json").write_text("\n".join(lines), encoding="utf-8")
        parts.append(payloads.read_platform(spark, str(folder), platform, F.lit(RUN).cast("timestamp"),
                                            on_broken="skip"))
    listing = spark.createDataFrame([("job123", 1, JOB123), ("careerjet", 1, CAREERJET), ("studentjob", 1, STUDENTJOB),
                                     ("unknown", 1, JOB123)], "platform string, page_no bigint, html string")
    cards = pages.cards_to_postings(pages.find_cards(listing, on_unknown="skip"))
    return [*parts, cards]


def test_payloads(spark, raw):
    rows = {r.job_id: r for df in raw[:-1] for r in df.filter("pos = 0").collect()}
    assert rows["cv1"].location_raw == ["Hà Nội", "Hồ Chí Minh"]
    assert (rows["11"].location_raw, rows["11"].skills) == (["Hà Nội"], ["Spark "])
    assert (rows["21"].location_raw, rows["21"].emp_name, rows["21"].skills) == (["Hanoi"], "Zeta", ["Python", "SQL"])
    top = next(r for r in rows.values() if r.platform == "topdev")
    assert (top.created_on, top.emp_name, top.location_raw) == ("03-02-2026", "Eta", ["Hồ Chí Minh"])
    card = next(r for r in rows.values() if r.platform == "itviec")
    assert (card.job_title, card.created_on, card.skills) == ("BI Analyst, data", "2026-02-09", ["SQL", "Tableau"])


def test_cards(spark, raw):
    rows = {(r.platform, r.pos): r for r in raw[-1].collect()}
    first = rows["job123", 0]
    assert (first.job_title, first.emp_name, first.location_raw, first.job_link, first.created_on) == (
        "DataAnalyst", "ACME", ["Hà Nội"], "https://123job.vn/viec-lam/1", "2026-02-01 08:00:00")
    bare = rows["job123", 1]
    assert bare.job_link is None and bare.created_on is None and bare.job_title == "Marketing"
    jet = rows["careerjet", 0]
    assert jet.location_raw == ["Đà NẵngCần Thơ"] and jet.created_on == "3 ngày trước"
    student = rows["studentjob", 0]
    assert student.job_link == "https://studentjob.vn/viec-lam/ai-engineer-1" and student.location_raw is None
    assert set(k[0] for k in rows) == {"job123", "careerjet", "studentjob"}


def test_html_corner_cases():
    root = html.parse('<p>a<p>b<br>c</p><div CLASS="x y" id=k>d &amp; e<img src="i"></div></b><span data-q>f')
    assert [e.text() for e in root.find_all("p")] == ["a", "bc"]
    assert root.find("div.x.y[id=\"k\"]").text() == "d & e" and root.find("div.x.z") is None
    assert root.find("[data-q]").text() == "f" and html.parse(None).text() == ""


def details(spark):
    rows = [("studentjob", "s1", 200, STUDENT_DETAIL), ("job123", "j1", 200, DETAIL_123), ("job123", "j2", 404, None),
            ("job123", "j3", 500, None), ("job123", "j4", None, None), ("nowhere", "n", 200, "x")]
    return pages.fetched_details(spark.createDataFrame(rows, "platform string, job_id string, status int, html string"), on_unknown="skip")


def test_details(spark):
    got = {r.job_id: r for r in details(spark).collect()}
    assert set(got) == {"s1", "j1", "j3"}
    assert got["j1"].job_desc == "SQL, Power BIExcel" and got["j3"].job_desc == ""
    assert got["s1"].coordinates == ["10.8", "106.7"]
    towns = spark.createDataFrame([("HCMC", "Ho Chi Minh", 10.82, 106.63), ("Hanoi", "Ha Noi", 21.0, 105.8)], schemas.GAZETTEER)
    postings = spark.createDataFrame([("s1", None, None), ("z", "d", ["p"])],
                                     "job_id string, created_on string, location_raw array<string>")
    rich = {r.job_id: r for r in geo.enrich_from_detail(postings, details(spark).filter("job_id = 's1'"), towns).collect()}
    assert (rich["s1"].created_on, rich["s1"].location_raw) == ("05/02/2026", ["Ho Chi Minh"])
    assert (rich["z"].created_on, rich["z"].location_raw) == ("d", ["p"])


def state(store):
    return {name: sorted(map(tuple, store.read(name).collect()), key=repr) for name in store.tables}


def test_collect_and_load(spark, raw, tmp_path):
    everything = raw[0]
    for part in raw[1:]:
        everything = everything.unionByName(part)
    store = TableStore(spark, str(tmp_path / "star"))
    link_id = raw[-1].filter("platform = 'careerjet'").first().job_id
    info = spark.createDataFrame([("careerviet", "cv1", "Python, SQL and C++"), ("careerjet", link_id, "SQL")],
                                 "platform string, job_id string, job_desc string")
    master, skills = collect.collect(everything, store.known_ids(), details=info)
    rows = {r.job_id: r for r in master.collect()}
    titles = [r.job_title for r in sorted(rows.values(), key=lambda r: r.seq)]
    assert titles == ["Data Engineer", "Data Expert", "Data Engineer", "Head of Data Governance", "Data Scientist",
                      "DataAnalyst", "SQL Developer", "AI Engineer", "AI Architect", "BI Analyst, data"]
    assert [r.label_name for r in sorted(rows.values(), key=lambda r: r.seq)] == [
        "Data Engineer", "None", "Data Engineer", "Other Data Job", "Data Scientist", "Data Analyst", "Data Engineer",
        "Data Scientist", "Data Scientist", "Data Analyst"]
    assert {r.skill_raw for r in skills.filter("job_id = 'cv1'").collect()} == {"Python", "SQL", "C++"}

    path = str(tmp_path / "handoff")
    handoff.write(master, f"{path}/m")
    handoff.write(skills, f"{path}/s")
    master, skills = handoff.read_pair(spark, f"{path}/m", f"{path}/s", master_schema=master.schema)
    ready = load.prepare(master, skills, run_ts=RUN)
    load.load(store, ready, run_ts=RUN)
    facts = {r.job_id: r for r in store.read("fact_job_postings").collect()}
    assert "11" not in facts, "same title and employer as the earlier posting of another site"
    assert "cv3" not in facts, "older than sixty days"
    assert facts["cv1"].job_link == "https://careerviet.vn/vi/cv1" and not facts["cv1"].is_expired
    tables = {name: store.read(name) for name in store.tables}
    places = {r.location_id: r.location_name for r in tables["location_dim"].collect()}
    assert places[facts["cv1"].location_id] == "Ha Noi, Ho Chi Minh"
    labels = {r.label_id: r.label_name for r in tables["label_dim"].collect()}
    assert labels[5] == "None" and labels[facts["12"].label_id] == "Other Data Job"
    bridge = {r.job_id for r in tables["fact_skill"].collect()}
    assert bridge <= set(facts)

    before = state(store)
    load.load(store, load.prepare(master, skills, run_ts=RUN), run_ts=RUN)
    assert state(store) == before, "repeating a run changes nothing"

    demand = {(r.label_name, r.skill): r.n_jobs for r in marts.skill_demand(tables, 5).collect()}
    assert demand["Data Engineer", "SQL"] == 2
    assert marts.volume_trend(tables).first().n == len(facts)
    assert marts.active_employers(tables, 1).count() == 1
    assert marts.uncleaned_skills(tables).count() == tables["skill_dim"].count()

    later = "2026-02-12 02:00:00"
    load.load(store, load.prepare(master.filter("job_id = 'cv1'"), skills, run_ts=later), run_ts=later)
    expired = {r.job_id: r.is_expired for r in load.current_facts(store, later[:10]).collect()}
    assert not expired["cv1"] and all(v for k, v in expired.items() if k != "cv1")


def test_handoff_without_files(spark, tmp_path):
    master, skills = handoff.read_pair(spark, str(tmp_path / "no"), str(tmp_path / "none"))
    assert master.isEmpty() and skills.isEmpty() and master.columns[0] == "job_id"
    handoff.write(skills, str(tmp_path / "s"))
    assert handoff.read_pair(spark, str(tmp_path / "no"), str(tmp_path / "s"))[1].isEmpty()


def test_store_ignores_unfinished_writes(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), {"fact_skill": schemas.FACT_SKILL})
    rows = spark.createDataFrame([(1, "a")], schemas.FACT_SKILL)
    store.append("fact_skill", rows)
    (tmp_path / "fact_skill" / "g=1" / "s=0").mkdir(parents=True)
    store.append("fact_skill", spark.createDataFrame([(2, "b")], schemas.FACT_SKILL))
    assert sorted(r.skill_id for r in store.read("fact_skill").collect()) == [1, 2]
    store.compact("fact_skill")
    assert sorted(r.skill_id for r in store.read("fact_skill").collect()) == [1, 2]
    store.replace("fact_skill", rows)
    assert [r.skill_id for r in store.read("fact_skill").collect()] == [1]


def test_requests(spark):
    words = spark.createDataFrame([("data analyst",), ("sql",)], "keyword string")
    templates = {"one": ("https://one.example/find", {"q": "{keyword}", "page": "{page_num}"}, 10),
                 "two": ("https://two.example/jobs", {"s": "{keyword}"}, 1)}
    got = request_list(words, templates)
    assert got.count() == 2 * (10 + 1)
    one = got.filter("platform = 'one' and page_num = 3 and keyword = 'sql'").first()
    assert one.params == {"q": "sql", "page": "3"} and one.url == "https://one.example/find"


def test_new_files_are_loaded_once(spark, tmp_path):
    from jobstrata.streaming.incremental import load_new_payloads

    landed, store = tmp_path / "cv", TableStore(spark, str(tmp_path / "star"))
    landed.mkdir()

    def land(name, job_id, title):
        job = {"job_id": job_id, "job_title": title, "date_view": "2026-02-03", "emp_name": job_id,
               "location_name": "Hà Nội", "job_link": f"https://careerviet.vn/en/{job_id}"}
        (landed / name).write_text(json.dumps({"page_no": 1, "data": [job]}, ensure_ascii=False), encoding="utf-8")

    land("1.json", "first", "Data Engineer")
    for _ in range(2):
        load_new_payloads(spark, {"careerviet": str(landed)}, store, str(tmp_path / "progress"), run_ts=RUN)
        assert {r.job_id for r in store.read("fact_job_postings").collect()} == {"first"}
    land("2.json", "second", "Senior SQL Developer")
    load_new_payloads(spark, {"careerviet": str(landed)}, store, str(tmp_path / "progress"), run_ts=RUN)
    assert {r.job_id for r in store.read("fact_job_postings").collect()} == {"first", "second"}


def test_sites_loaded_together_or_at_once_agree(spark, tmp_path):
    from jobstrata.plans import collect, load
    from jobstrata.streaming.incremental import load_new_payloads

    job = {"job_id": "a", "job_title": "Data Engineer", "date_view": "2026-02-03", "emp_name": "Acme Data",
           "location_name": "Hà Nội", "job_link": "https://careerviet.vn/en/a"}
    other = {"jobId": 7, "jobTitle": "Data Engineer", "createdOn": "2026-02-03", "companyName": "Acme Data",
             "jobUrl": "https://v.example/7", "skills": [], "workingLocations": []}
    landed = {}
    for site, one in (("careerviet", job), ("vietnamworks", other)):
        (tmp_path / site).mkdir()
        (tmp_path / site / "1.json").write_text(json.dumps({"page_no": 1, "data": [one]}, ensure_ascii=False), encoding="utf-8")
        landed[site] = str(tmp_path / site)
    step, whole = (TableStore(spark, str(tmp_path / n)) for n in ("step", "whole"))
    load_new_payloads(spark, landed, step, str(tmp_path / "progress"), run_ts=RUN)
    now = F.lit(RUN).cast("timestamp")
    raw = payloads.read_platform(spark, landed["careerviet"], "careerviet", now).unionByName(
        payloads.read_platform(spark, landed["vietnamworks"], "vietnamworks", now))
    done = collect.collect(raw, whole.known_ids())
    load.load(whole, load.prepare(done.master, done.skills, run_ts=RUN), run_ts=RUN)
    got, want = ({r.job_id for r in s.read("fact_job_postings").collect()} for s in (step, whole))
    assert got == want == {"a"}


def test_broken_bodies_are_counted_not_lost(spark, tmp_path):
    one = {"data": [{"job_id": "1", "job_title": "t"}]}
    bodies, lines = tmp_path / "bodies", tmp_path / "lines"
    bodies.mkdir(), lines.mkdir()
    (bodies / "a.json").write_text(json.dumps(one, indent=2))
    (bodies / "b.json").write_text(json.dumps(one)[:20])
    (lines / "a.json").write_text(json.dumps(one) + "\n" + json.dumps(one)[:20] + "\n")
    for folder, layout in ((bodies, "bodies"), (lines, "lines")):
        read = payloads.read_bodies(spark, str(folder), "careerviet", layout)
        assert [r.n_broken for r in payloads.broken_bodies(read).collect()] == [1]
        assert payloads.read_responses(spark, str(folder), "careerviet", layout, on_broken="skip").count() == 1
        with pytest.raises(Exception, match="unreadable response"):
            payloads.read_responses(spark, str(folder), "careerviet", layout).collect()


def test_one_detail_per_posting(spark):
    from jobstrata.operators.unify import first_detail

    rows = [("s", "1", "b", 2), ("s", "1", "a", 3), ("s", "1", "c", None), ("t", "1", "z", None), ("t", "1", "y", None)]
    got = first_detail(spark.createDataFrame(rows, "platform string, job_id string, job_desc string, fetched_at int"))
    assert sorted(tuple(r) for r in got.collect()) == [("s", "1", "b"), ("t", "1", "y")]


def test_pages_of_unknown_sites(spark):
    listing = spark.createDataFrame([("nowhere", 1, "<p>")], "platform string, page_no long, html string")
    assert pages.unknown_sites(listing, {}).first().n_pages == 1
    assert pages.find_cards(listing, on_unknown="skip").count() == 0
    with pytest.raises(Exception, match="no settings"):
        pages.find_cards(listing).collect()


def test_markup_that_is_never_closed():
    from jobstrata.sources import html

    deep = html.parse("<li><b>" * 3000 + "x")
    assert deep.text() == "x" and len(deep.find_all("li")) == 3000
    flat = html.parse("<ul><li>a<li>b<li>c</ul><table><tr><td>d<td>e<tr><td>f</table>")
    assert [e.text() for e in flat.find_all("li")] == ["a", "b", "c"]
    assert [e.text() for e in flat.find_all("tr")] == ["de", "f"]
    assert html.parse("<p>x<script>var a = 1;</script><style>p{}</style>y</p>").text() == "xy"


def _fits_by_looking_up(e, steps):
    """The definition: the last step fits, and the others fit ancestors, nearest last."""
    from jobstrata.sources.html import _fits_step

    if not _fits_step(e, steps[-1]):
        return False
    left, up = len(steps) - 1, e.parent
    while left and up is not None:
        left -= _fits_step(up, steps[left - 1])
        up = up.parent
    return left == 0


def test_selectors_in_one_pass_agree_with_looking_up(spark):
    import random

    from jobstrata.sources.html import _parse

    dice = random.Random(4)
    selectors = [".a", "div .a", ".a .b", "div .a p", ".b div .a .b", "[x]", ".a [x] p"]
    for _ in range(150):
        page = "".join(dice.choice(["<div>", '<div class="a">', '<p class="b a" x=1>', '<div class="b">', "</div>", "</p>", "t", '<b x="2">', "</b>"])
                       for _ in range(dice.randint(1, 60)))
        root = html.parse(page)
        everything = [e for _, e, which in root.hits([]) if which is not None]
        for card in [root, *dice.sample(everything, min(3, len(everything)))]:
            below = [e for _, e, which in card.hits([]) if which is not None]
            for sel in selectors:
                want = [e for e in below if _fits_by_looking_up(e, _parse(sel))]
                assert [id(e) for e in card.find_all(sel)] == [id(e) for e in want]
                assert card.find(sel) is (want[0] if want else None)
        for card, has in root.cards(".a", {"p": "p", "b": ".a .b", "x": "[x]"}):
            assert {k: id(e) for k, e in has.items()} == {
                k: id(card.find(q)) for k, q in (("p", "p"), ("b", ".a .b"), ("x", "[x]")) if card.find(q) is not None}


def test_deep_pages_take_time_in_proportion_to_their_size():
    import time

    def seconds(n):
        root = html.parse('<div class="a"><div class="c">' * n)
        start = time.perf_counter()
        assert len(root.find_all(".b .a")) == 0 and len(root.cards(".a", {"c": ".a .c", "d": ".b .d"})) == n
        return time.perf_counter() - start

    seconds(500)
    assert seconds(20_000) < 40 * max(seconds(2_000), 0.005)


def test_bodies_are_saved_one_to_a_file(spark, tmp_path):
    """Files lie in folders of their own, without checksum files; what is read back does not depend on the formatting."""
    bodies = [(n, json.dumps({"data": [{"job_id": f"é{n}", "job_title": "t"}]}, indent=2, ensure_ascii=False)) for n in range(25)]
    df = spark.createDataFrame([*bodies, (None, '{"data": []}')], "page_no bigint, body string")
    for _ in range(2):  # a repeated task changes nothing
        assert payloads.write_bodies(df, str(tmp_path / "landed"), per_folder=10) == 26
    files = [p for p in (tmp_path / "landed").rglob("*") if p.is_file()]
    assert len(files) == 26 and {p.parent.name for p in files} == {"pages-0", "pages-1", "pages-2", "pages-none"}
    rows = payloads.read_responses(spark, f"{tmp_path}/landed/*", "careerviet", "bodies").select("job.job_id").collect()
    assert sorted(r[0] for r in rows) == sorted(f"é{n}" for n in range(25))

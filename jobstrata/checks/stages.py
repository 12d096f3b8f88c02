"""Both batch stages on the test tables, compared as rows with names in place of ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata import schemas
from jobstrata.checks.base import Tables, query
from jobstrata.checks.postings import _TITLE, _similar_sql
from jobstrata.checks.texts import _has, _rules
from jobstrata.functions import links
from jobstrata.operators import unify
from jobstrata.plans import collect, load
from jobstrata.schemas import POSTING_RAW
from jobstrata.session import new_path
from jobstrata.sources.tables import TableStore
from jobstrata.streaming.incremental import Landed, run_landed

MUST, POSITIVE, NEGATIVE = ["ring", "gear", "bolt", "widget", "rod"], ["small", "red", "old", "hot", "cold"], ["old"]
RULES = {"redring": "Data Analyst", "hot": "Data Engineer", "small": "Data Scientist"}
WORDS = collect.Dictionaries(MUST, POSITIVE, NEGATIVE, RULES, ("Brand",))
RUN = "2024-03-01 02:00:00"

_RAW_DAY = "DATE '2024-02-28' - CAST(p_partkey % 90 AS INTEGER)"
_COLLECTED = f"""c AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size, coalesce({_rules("replace(lower(p_name), ' ', '')", RULES)}, 'None') AS label_name,
         row_number() OVER (ORDER BY CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 END, p_partkey) - 1 AS seq
  FROM part WHERE p_partkey <> 0 AND {_has('p_name', MUST)} AND {_has('p_name', POSITIVE)} AND NOT {_has('p_name', NEGATIVE)})"""


def _raw(t: Tables):
    """Parts as postings of two sites, each listed twice to exercise first-seen."""
    key = F.col("p_partkey").cast("string")
    fields = {
        "platform": F.when(F.col("p_size") % 2 == 0, "careerviet").otherwise("topdev"), "source": F.lit("part"), "page_no": F.col("p_partkey"),
        "pos": F.lit(0), "job_id": key, "job_title": F.col("p_name"),
        "created_on": F.date_format(F.expr("date_sub(date'2024-02-28', cast(p_partkey % 90 as int))"), "yyyy-MM-dd"),
        "emp_name": F.col("p_brand"), "location_raw": F.array(F.concat(F.lit("Hà Nội, "), "p_type")),
        "job_link": F.concat(F.lit("https://careerviet.vn/en/"), key), "skills": F.array("p_type", "p_brand"),
        "job_desc": F.lit(None)}
    once = t.part.select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in POSTING_RAW])
    again = once.withColumn("pos", F.lit(1)).withColumn("created_on", F.lit("2024-02-28"))
    return unify.union_all([again, once])


def _collected(t: Tables):
    none_loaded = t.spark.createDataFrame([], "job_id string")
    return collect.collect(_raw(t), none_loaded, words=WORDS)


@query(f"""WITH {_COLLECTED} SELECT seq, CAST(p_partkey AS VARCHAR) AS job_id, p_name AS job_title,
             strftime({_RAW_DAY}, '%Y-%m-%d') AS date_view, p_brand AS emp_raw, 'Hà Nội, ' || p_type AS location_name,
             label_name, 'https://careerviet.vn/en/' || p_partkey AS job_link FROM c""")
def collected_master(t: Tables):
    return _collected(t).master


def _loaded(t: Tables):
    done = _collected(t)
    store = TableStore(t.spark, new_path(t.spark, "star"))
    load.load(store, load.prepare(done.master, done.skills, run_ts=RUN), run_ts=RUN)
    return store


_KEPT = _similar_sql("c", "seq", _TITLE, f""", k AS (SELECT * FROM c WHERE seq NOT IN (SELECT b FROM s)
                     AND {_RAW_DAY} > DATE '2024-03-01' - 60)""").replace("WITH t AS", f"WITH {_COLLECTED}, t AS", 1)


@query(_KEPT + f""" SELECT CAST(p_partkey AS VARCHAR) AS job_id, p_name AS job_title, p_brand AS emp_raw, label_name,
             'Ha Noi' AS location_name, strftime({_RAW_DAY}, '%Y-%m-%d') AS created_on,
             '2024-03-01' AS last_seen, false AS is_expired, 'https://careerviet.vn/vi/' || p_partkey AS job_link FROM k""")
def loaded_postings(t: Tables):
    store = _loaded(t)
    days = store.read("date_dim")
    created = days.select(F.col("date_id").alias("created_on_id"), F.date_format("actual_date", "yyyy-MM-dd").alias("created_on"))
    seen = days.select(F.col("date_id").alias("last_seen_id"), F.date_format("actual_date", "yyyy-MM-dd").alias("last_seen"))
    return (store.read("fact_job_postings").join(created, "created_on_id").join(seen, "last_seen_id")
            .join(store.read("emp_dim"), "emp_id").join(store.read("label_dim"), "label_id")
            .join(store.read("location_dim"), "location_id")
            .select("job_id", "job_title", "emp_raw", "label_name", "location_name", "created_on", "last_seen",
                    "is_expired", "job_link"))


@query(_KEPT + """ SELECT CAST(p_partkey AS VARCHAR) AS job_id, p_type AS skill_raw FROM k
                   UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_brand FROM k""")
def loaded_skills(t: Tables):
    store = _loaded(t)
    return store.read("fact_skill").join(store.read("skill_dim"), "skill_id").select("job_id", "skill_raw")


# ---- what a load met before its repairs --------------------------------------------------------


@query(_KEPT + """, e AS (SELECT p_partkey, unnest([p_type, CASE WHEN p_size % 5 > 0 THEN p_brand END]) AS skill FROM k)
           SELECT count(*) AS facts, count(*) FILTER (p_size % 7 = 0 OR label_name = 'None') AS null_labels, CAST(0 AS BIGINT) AS null_employers,
             CAST(0 AS BIGINT) AS null_places, CAST(0 AS BIGINT) AS null_days, (SELECT count(*) FROM e) AS skills,
             (SELECT count(*) FROM e WHERE skill IS NULL) AS null_skills FROM k""")
def counts_of_a_load(t: Tables):
    done = _collected(t)
    size = t.part.select(F.col("p_partkey").cast("string").alias("job_id"), "p_size", "p_brand")
    master = done.master.join(size, "job_id").withColumn("label_name", F.when(F.col("p_size") % 7 > 0, F.col("label_name")))
    lost = (F.col("p_size") % 5 == 0) & (F.col("skill_raw") == F.col("p_brand"))
    skills = done.skills.join(size, "job_id").withColumn("skill_raw", F.when(~lost, F.col("skill_raw"))).select("job_id", "skill_raw")
    store = TableStore(t.spark, new_path(t.spark, "star"))
    counts = load.load(store, load.prepare(master.select(*done.master.columns), skills, run_ts=RUN), run_ts=RUN)
    return t.spark.createDataFrame([counts], ", ".join(f"{c} bigint" for c in counts._fields))


# ---- listing and detail pages of a site, as one scheduled run -----------------------------------

_SITE = "https://studentjob.vn"
_CARDS = f"""c AS (SELECT *, coalesce({_rules("replace(lower(p_name), ' ', '')", RULES)}, 'None') AS label_name,
                     row_number() OVER (ORDER BY p_partkey) - 1 AS seq
              FROM part WHERE {_has('p_name', MUST)} AND {_has('p_name', POSITIVE)} AND NOT {_has('p_name', NEGATIVE)})"""


def _landed_pages(t: Tables) -> Landed:
    """Parts as cards of listing pages of fifty, and a detail page each with a day, a spot on the map and a description."""
    href = F.concat(F.lit("/viec-lam/"), F.col("p_partkey").cast("string"))
    card = F.concat(F.lit('<div class="single-job-items"><div class="job-tittle job-tittle2"><a href="/x">x</a><a href="'), href,
                    F.lit('"><h2 class="h4">'), "p_name", F.lit('</h2></a></div><li class="mb-1"><a>'), "p_brand", F.lit("</a></li></div>"))
    cards = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", card.alias("card")))), lambda x: x["card"])
    listing = t.part.groupBy(F.floor(F.col("p_partkey") / 50).alias("page_no")).agg(F.array_join(cards, "").alias("html")).select(
        F.lit("studentjob").alias("platform"), "page_no", "html")
    day = F.date_format(F.expr("date_sub(date'2024-02-28', cast(p_partkey % 90 as int))"), "dd/MM/yyyy")
    even = F.col("p_partkey") % 2 == 0
    page = F.concat(F.lit('<li><div class="summary-content"><span class="content">'), day, F.lit(
        '</span></div></li><li class="no-border map-full"><input value="'), F.when(even, "21.1").otherwise("10.7"), F.lit(
        '"><input value="'), F.when(even, "105.7").otherwise("106.8"), F.lit('"></li><div class="col-main-content">needs '),
        "p_brand", F.lit(" and more</div>"))
    details = t.part.select(F.lit("studentjob").alias("platform"), links.card_id(F.concat(F.lit(_SITE), href)).alias("job_id"),
                            F.lit(200).alias("status"), page.alias("html"))
    where = [new_path(t.spark, n) for n in ("listings", "details")]
    for rows, path in zip((listing, details), where):
        rows.write.json(path)
    return Landed(listings=where[0], details=where[1])


@query(_KEPT.replace(_COLLECTED, _CARDS) + f""" SELECT '{_SITE}/viec-lam/' || p_partkey AS job_link, p_name AS job_title,
             p_brand AS emp_raw, label_name, CASE WHEN p_partkey % 2 = 0 THEN 'Ha Noi' ELSE 'Ho Chi Minh' END AS location_name,
             strftime({_RAW_DAY}, '%Y-%m-%d') AS created_on, 'Brand' AS skills FROM k""")
def landed_pages_loaded(t: Tables):
    """A site whose listing tells neither day nor place: both come from the detail page, in the same run."""
    towns = t.spark.createDataFrame([("Hanoi", "Ha Noi", 21.03, 105.85), ("Saigon", "Ho Chi Minh", 10.82, 106.63)], schemas.GAZETTEER)
    store = TableStore(t.spark, new_path(t.spark, "star"))
    words = collect.Dictionaries(MUST, POSITIVE, NEGATIVE, RULES, ("Brand",))
    run_landed(t.spark, _landed_pages(t), store, new_path(t.spark, "progress"), run_ts=RUN, gazetteer=towns, words=words)
    days = store.read("date_dim").select(F.col("date_id").alias("created_on_id"), F.date_format("actual_date", "yyyy-MM-dd").alias("created_on"))
    skills = store.read("fact_skill").join(store.read("skill_dim"), "skill_id").groupBy("job_id").agg(
        F.array_join(F.array_sort(F.collect_set("skill_raw")), ",").alias("skills"))
    return (store.read("fact_job_postings").join(days, "created_on_id").join(store.read("emp_dim"), "emp_id")
            .join(store.read("label_dim"), "label_id").join(store.read("location_dim"), "location_id").join(skills, "job_id")
            .select("job_link", "job_title", "emp_raw", "label_name", "location_name", "created_on", "skills"))

"""Market and monitoring reports, and the flagship from raw texts to role demand."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata.checks.base import Tables, query
from jobstrata.checks.texts import TERMS, TERMS_SQL, TEXT_RULES, _has, _rules
from jobstrata.functions import text
from jobstrata.operators import dedupe, metrics, relevance, unify
from jobstrata.plans import marts

_FOUND = f"""SELECT label_name, skill_raw, doc_id FROM (
  SELECT doc_id, {_rules("replace(lower(text), ' ', '')", TEXT_RULES)} AS label_name,
         unnest({TERMS_SQL.format(c='text')}) AS skill_raw
  FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY source, md5(text) ORDER BY doc_id) AS r FROM documents
        WHERE {_has('text', ['the', 'les', 'und', 'el'])} AND {_has('text', ['that', 'que', 'nicht', 'la', 'und'])}
          AND NOT {_has('text', ['buy now', 'www'])})
  WHERE r = 1) WHERE label_name IS NOT NULL"""


def _job_skills(t: Tables):
    kept = relevance.keep_relevant(t.documents, "text", must_have=["the", "les", "und", "el"],
                                   positive=["that", "que", "nicht", "la", "und"], negative=["buy now", "www"])
    # role and skills come before the shuffle of the first-seen step, so the texts stay where they are read
    found = kept.select("doc_id", "source", F.md5("text").alias("job_id"),
                        text.rule_label(F.col("text"), TEXT_RULES).alias("label_name"),
                        text.extract_terms(F.col("text"), TERMS).alias("skills"))
    roles = dedupe.first_seen(found, ["source", "job_id"], ["doc_id"], id_column="job_id")
    return unify.explode_skills(roles.dropna(subset=["label_name"]), keep=["doc_id", "label_name"])


@query(f"""SELECT label_name, skill_raw, n_jobs, CAST(r AS INTEGER) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY label_name ORDER BY n_jobs DESC, skill_raw) AS r FROM (
               SELECT label_name, skill_raw, count(DISTINCT doc_id) AS n_jobs FROM ({_FOUND}) GROUP BY ALL)) WHERE r <= 5""")
def role_skill_demand(t: Tables):
    return marts.top_skills(_job_skills(t), 5, job="doc_id")


@query(f"""SELECT lang AS label_name, skill_raw, n_jobs, CAST(r AS INTEGER) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_jobs DESC, skill_raw) AS r FROM (
               SELECT lang, skill_raw, count(DISTINCT doc_id) AS n_jobs FROM (
                 SELECT lang, doc_id, unnest({TERMS_SQL.format(c='text')}) AS skill_raw FROM documents) GROUP BY ALL))
           WHERE r <= 3""")
def skills_per_language(t: Tables):
    rows = t.documents.select("doc_id", F.col("lang").alias("label_name"), text.extract_terms(F.col("text"), TERMS).alias("skills"))
    return marts.top_skills(unify.explode_skills(rows, keep=["doc_id", "label_name"]), 3, job="doc_id")


@query("""SELECT r_name AS label_name, p_brand AS skill, n_jobs, CAST(r AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY r_name ORDER BY n_jobs DESC, p_brand) AS r FROM (
              SELECT r_name, p_brand, count(DISTINCT l_orderkey) AS n_jobs
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                   JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
                   JOIN part ON l_partkey = p_partkey GROUP BY ALL)) WHERE r <= 10""")
def star_skill_demand(t: Tables):
    nations = t.nation.select("n_nationkey", "n_regionkey")
    jobs = (t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_orderkey").alias("job_id"), F.col("n_regionkey").cast("bigint").alias("label_id")))
    tables = {
        "fact_job_postings": jobs,
        "label_dim": t.region.select(F.col("r_regionkey").cast("bigint").alias("label_id"), F.col("r_name").alias("label_name")),
        "fact_skill": t.lineitem.select(F.col("l_partkey").alias("skill_id"), F.col("l_orderkey").alias("job_id")),
        "skill_dim": t.part.select(F.col("p_partkey").alias("skill_id"), F.lit("x").alias("skill_raw"),
                                   F.col("p_brand").alias("skill_cleaned"))}
    return marts.skill_demand(tables, 10)


@query("""SELECT strftime(m, '%Y-%m-%d') AS month, n, lag(n) OVER (ORDER BY m) AS previous, n - lag(n) OVER (ORDER BY m) AS change
          FROM (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)""")
def monthly_volume(t: Tables):
    return marts.monthly_volume(t.orders, "o_orderdate").withColumn("month", F.date_format("month", "yyyy-MM-dd"))


@query("""SELECT o_custkey AS emp_id, c_name AS employer, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
          GROUP BY ALL ORDER BY n DESC, o_custkey LIMIT 20""")
def most_active_employers(t: Tables):
    tables = {"fact_job_postings": t.orders.select(F.col("o_custkey").alias("emp_id")),
              "emp_dim": t.customer.select(F.col("c_custkey").alias("emp_id"), F.col("c_name").alias("emp_raw"),
                                           F.lit(None).cast("string").alias("emp_cleaned"))}
    return marts.active_employers(tables, 20)


def _labelled(t: Tables):
    label = text.rule_label(F.col("text"), TEXT_RULES)
    return t.documents.select("doc_id", F.coalesce(label, F.lit("None")).alias("label_name"))


_LABELLED = f"""SELECT doc_id, coalesce({_rules("replace(lower(text), ' ', '')", TEXT_RULES)}, 'None') AS label_name FROM documents"""


@query(f"""SELECT count(*) AS n_passed, count(*) FILTER (WHERE label_name <> 'None') AS n_relevant,
                  round(count(*) FILTER (WHERE label_name <> 'None') / count(*), 6) AS accuracy FROM ({_LABELLED})""")
def filter_accuracy(t: Tables):
    return marts.filter_accuracy(_labelled(t))


@query(f"SELECT doc_id, label_name FROM ({_LABELLED}) WHERE label_name = 'None'")
def filter_misses(t: Tables):
    return marts.filter_misses(_labelled(t))


@query("""SELECT p_partkey AS skill_id, p_name AS skill_raw FROM part WHERE p_size > 25 AND p_partkey IN (SELECT l_partkey FROM lineitem)""")
def uncleaned_skills(t: Tables):
    tables = {"fact_skill": t.lineitem.select(F.col("l_partkey").alias("skill_id"), F.col("l_orderkey").alias("job_id")),
              "skill_dim": t.part.select(F.col("p_partkey").alias("skill_id"), F.col("p_name").alias("skill_raw"),
                                         F.when(F.col("p_size") <= 25, F.col("p_brand")).alias("skill_cleaned"))}
    return marts.uncleaned_skills(tables).select("skill_id", "skill_raw")


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1")
def value_counts(t: Tables):
    return metrics.value_counts(t.lineitem, "l_suppkey")

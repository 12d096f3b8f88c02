"""Dimensions, key lookups, fact merge, skill bridge, expiry, null repairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata.checks.base import Tables, query
from jobstrata.functions import text
from jobstrata.operators import lookups, metrics, unify, upserts
from jobstrata.operators.numbering import number_rows
from jobstrata.plans import load
from jobstrata.session import materialise, new_path
from jobstrata.sources.tables import TableStore

_CUT = "DATE '1999-01-01'"


@query("""SELECT name, CASE WHEN c_custkey IS NOT NULL THEN c_custkey + 1
                 ELSE (SELECT max(c_custkey) + 1 FROM customer) + row_number() OVER (PARTITION BY c_custkey IS NULL ORDER BY name)
                 END AS emp_id
          FROM (SELECT c_name AS name, c_custkey FROM customer UNION ALL SELECT s_name, NULL FROM supplier)""")
def dimension_new_members(t: Tables):
    dim = t.customer.select((F.col("c_custkey") + 1).alias("emp_id"), F.col("c_name").alias("name"))
    batch = t.customer.select(F.col("c_name").alias("name")).unionByName(t.supplier.select(F.col("s_name").alias("name")))
    batch = batch.unionByName(batch).unionByName(t.region.select(F.lit(None).cast("string").alias("name")))
    return upserts.upsert_dim(dim, batch, key="name", surrogate="emp_id", columns=["name"]).select("name", "emp_id")


@query("""WITH known AS (SELECT s_suppkey + 1 AS emp_id, s_name AS name, CAST(NULL AS DOUBLE) AS balance FROM supplier),
               batch AS (SELECT s_name AS name, s_acctbal AS balance FROM supplier WHERE s_nationkey < 12
                         UNION ALL SELECT c_name, c_acctbal FROM customer)
          SELECT emp_id, k.name, CASE WHEN b.name IS NOT NULL THEN b.balance ELSE k.balance END AS balance
          FROM known k LEFT JOIN batch b ON k.name = b.name UNION ALL
          SELECT (SELECT max(emp_id) FROM known) + row_number() OVER (ORDER BY b.name), b.name, b.balance
          FROM batch b WHERE b.name NOT IN (SELECT name FROM known)""")
def dimension_full_upsert(t: Tables):
    dim = t.supplier.select((F.col("s_suppkey") + 1).alias("emp_id"), F.col("s_name").alias("name"),
                            F.lit(None).cast("double").alias("balance"))
    batch = t.supplier.filter("s_nationkey < 12").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    batch = batch.unionByName(t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")))
    return upserts.upsert_dim(dim, batch, key="name", surrogate="emp_id", columns=["name", "balance"])


def _facts(t: Tables):
    """Earlier orders as loaded facts, later ones and a refreshed share of the earlier as the batch."""
    day = F.col("o_orderdate").cast("date")
    rows = t.orders.select(F.col("o_orderkey").alias("job_id"), F.col("o_orderpriority").alias("job_title"),
                           (F.col("o_orderstatus") == "F").alias("is_expired"), F.col("o_custkey").alias("last_seen_id"),
                           day.alias("day"))
    old = rows.filter(F.col("day") < F.lit("1999-01-01").cast("date")).drop("day")
    fresh = rows.filter((F.col("day") >= F.lit("1998-06-01").cast("date"))).select(
        "job_id", F.lit("changed").alias("job_title"), F.lit(False).alias("is_expired"),
        (F.col("last_seen_id") + 100000).alias("last_seen_id"))
    return old, fresh


_MERGED = f"""SELECT o_orderkey AS job_id, CASE WHEN d < {_CUT} THEN o_orderpriority ELSE 'changed' END AS job_title,
                CASE WHEN d >= DATE '1998-06-01' THEN false ELSE o_orderstatus = 'F' END AS is_expired,
                CASE WHEN d >= DATE '1998-06-01' THEN o_custkey + 100000 ELSE o_custkey END AS last_seen_id
              FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)"""


@query(_MERGED)
def fact_merge(t: Tables):
    return upserts.merge_facts(*_facts(t))


@query(_MERGED)
def fact_merge_repeated(t: Tables):
    old, fresh = _facts(t)
    once = materialise(upserts.merge_facts(old, fresh), "merged")
    return upserts.merge_facts(once, fresh)


_BRIDGE = "SELECT DISTINCT l_partkey AS skill_id, l_orderkey AS job_id FROM lineitem"


@query(_BRIDGE + " WHERE l_returnflag <> 'A' EXCEPT " + _BRIDGE + " WHERE l_returnflag = 'A'")
def bridge_new_rows(t: Tables):
    rows = t.lineitem.select(F.col("l_partkey").alias("skill_id"), F.col("l_orderkey").alias("job_id"), "l_returnflag")
    return upserts.new_bridge_rows(rows.filter("l_returnflag = 'A'"), rows.filter("l_returnflag <> 'A'"))


@query(_BRIDGE)
def bridge_repeated_load(t: Tables):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("skill_id", T.LongType()), T.StructField("job_id", T.LongType())])
    store = TableStore(t.spark, new_path(t.spark, "store"), {"fact_skill": schema})
    rows = t.lineitem.select(F.col("l_partkey").alias("skill_id"), F.col("l_orderkey").alias("job_id"), "l_returnflag")
    for batch in (rows.filter("l_returnflag = 'A'"), rows, rows):
        store.append("fact_skill", upserts.new_bridge_rows(store.read("fact_skill"), batch))
    return store.read("fact_skill")


@query(f"""SELECT o_orderkey AS job_id, CAST(o_orderdate AS DATE) < {_CUT} AS is_expired FROM orders""")
def expiry_flags(t: Tables):
    days = unify.distinct_values(t.orders.select(F.col("o_orderdate").cast("date").alias("actual_date")), ["actual_date"])
    dim = materialise(number_rows(days, ["actual_date"], "date_id"), "dates")
    facts = (t.orders.select(F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").cast("date").alias("actual_date"),
                             F.lit(False).alias("is_expired")).join(dim, "actual_date")
             .select("job_id", "is_expired", F.col("date_id").alias("last_seen_id")))
    return upserts.mark_expired(facts, dim, "1999-01-01").select("job_id", "is_expired")


_DAYS = "SELECT d, row_number() OVER (ORDER BY d) AS id FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


@query(f"""WITH days AS ({_DAYS}), labels AS (SELECT p, row_number() OVER (ORDER BY p) + 10 AS id FROM
              (SELECT DISTINCT o_orderpriority AS p FROM orders WHERE o_orderpriority <> '5-LOW'))
           SELECT CAST(o_orderkey AS VARCHAR) AS job_id, c.c_custkey AS emp_id, n.n_nationkey AS location_id,
                  coalesce(l.id, 5) AS label_id, d1.id AS created_on_id, d2.id AS last_seen_id
           FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_acctbal > 0
                LEFT JOIN nation n ON n.n_nationkey = o.o_custkey % 30
                LEFT JOIN labels l ON l.p = o.o_orderpriority
                LEFT JOIN days d1 ON d1.d = CAST(o.o_orderdate AS DATE)
                JOIN days d2 ON d2.d = CAST(o.o_orderdate AS DATE) + 1""")
def fact_keys(t: Tables):
    day = F.col("o_orderdate").cast("date")
    days = unify.distinct_values(t.orders.select(day.alias("actual_date")), ["actual_date"])
    priorities = unify.distinct_values(t.orders.filter("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderpriority").alias("label_name")), ["label_name"])
    dims = {"date_dim": number_rows(days, ["actual_date"], "date_id"),
            "label_dim": number_rows(priorities, ["label_name"], "label_id", start=11),
            "emp_dim": t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("emp_id"), F.col("c_name").alias("emp_raw")),
            "location_dim": t.nation.select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("location_name"))}
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    postings = t.orders.select(
        F.col("o_orderkey").cast("string").alias("job_id"), F.lit("t").alias("job_title"), F.lit(False).alias("is_expired"),
        F.lit("l").alias("job_link"), day.alias("date_view"), F.date_add(day, 1).alias("last_seen"), name.alias("emp_raw"),
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % 30).cast("string")).alias("location_name"),
        F.col("o_orderpriority").alias("label_name"))
    return lookups.posting_keys(postings, dims).select("job_id", "emp_id", "location_id", "label_id", "created_on_id",
                                                       "last_seen_id")


@query("""SELECT s.s_suppkey AS skill_id, CAST(l.l_orderkey AS VARCHAR) AS job_id FROM lineitem l
          LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_acctbal > 0""")
def skill_ids(t: Tables):
    dim = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("skill_id"), F.col("s_name").alias("skill_raw"))
    skills = t.lineitem.select(F.col("l_orderkey").cast("string").alias("job_id"), F.concat(
        F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("skill_raw"))
    return lookups.skill_keys(skills, dim)


@query("""SELECT count(*) AS n_rows, count(*) FILTER (WHERE l.doc_id IS NULL) AS quality_nulls,
                 count(*) FILTER (WHERE d.lang = 'en') AS lang_nulls FROM documents d LEFT JOIN labels l USING (doc_id)""")
def null_counts(t: Tables):
    joined = t.documents.join(t.labels, "doc_id", "left").withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")))
    return metrics.null_counts(joined, ["quality", "lang"])


@query("""SELECT d.doc_id, coalesce(l.quality, 5) AS label_id FROM documents d LEFT JOIN labels l USING (doc_id)""")
def default_label_key(t: Tables):
    return t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", lookups.default_key("quality", 5).alias("label_id"))


@query("""SELECT p_partkey, p_type AS skill FROM part WHERE p_type <> 'PROMO'""")
def null_skills_dropped(t: Tables):
    skill = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    seen, observed = metrics.counted(t.part.select("p_partkey", skill.alias("skill")), "before")
    return seen.dropna(subset=["skill"])


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderpriority AS label_name, '1999-06-30' AS last_seen,
                 false AS is_expired FROM orders""")
def constant_columns(t: Tables):
    return t.orders.select(F.col("o_orderkey").cast("string").alias("job_id"), "o_orderpriority").withColumnsRenamed(
        {"o_orderpriority": "label_name"}).transform(load.seen_now, "1999-06-30 00:00:00").withColumn(
        "last_seen", F.date_format("last_seen", "yyyy-MM-dd"))

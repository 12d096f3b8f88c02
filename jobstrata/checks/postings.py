"""Set operations, first-seen rows, labels and near-duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata.checks.base import Tables, query
from jobstrata.functions import text
from jobstrata.operators import dedupe, labelling, neardup, numbering, unify
from jobstrata.session import materialise

_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_linestatus"]


@query(f"""SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
             SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_orderkey ORDER BY {', '.join(_LINE_ORDER)}) AS r
             FROM lineitem WHERE l_orderkey <> 0) WHERE r = 1""")
def first_seen_per_platform(t: Tables):
    return dedupe.first_seen(t.lineitem, ["l_returnflag", "l_orderkey"], _LINE_ORDER, id_column="l_orderkey").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'
          AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def needs_label(t: Tables):
    rows = t.orders.withColumn("label", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    loaded = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return dedupe.needs_label(rows, loaded, job_id="o_custkey").select("o_orderkey")


@query("""SELECT conv_id, turn, (n - 1) // 30 AS batch_id, CAST((n - 1) % 30 AS INTEGER) AS batch_pos
          FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS n FROM conversations)""")
def label_batches(t: Tables):
    return labelling.chunk(t.conversations.select("conv_id", "turn"), ["conv_id", "turn"])


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
             row_number() OVER (ORDER BY {', '.join(_LINE_ORDER)}, l_returnflag) AS seq FROM lineitem""")
def table_wide_numbers(t: Tables):
    return numbering.number_rows(t.lineitem, [*_LINE_ORDER, "l_returnflag"], "seq").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "seq")


def _requests(t: Tables):
    rows = t.conversations.select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("job_id"),
                                  F.concat("role", F.lit(" "), F.length("text")).alias("job_title"))
    return labelling.chunk(rows, ["conv_id", "turn"])


_REQ = """r AS (SELECT conv_id || '-' || turn AS job_id, role, length(text) AS len, conv_id, turn,
                       (row_number() OVER (ORDER BY conv_id, turn) - 1) // 30 AS batch_id FROM conversations)"""


@query(f"""WITH {_REQ} SELECT batch_id, '[' || string_agg('{{"job_id":"' || job_id || '","job_title":"' || role || ' ' || len
                              || '"}}', ',' ORDER BY conv_id, turn) || ']' AS request FROM r GROUP BY batch_id""")
def batch_requests(t: Tables):
    return labelling.encode_batches(_requests(t))


@query(f"""WITH {_REQ} SELECT job_id, batch_id FROM r WHERE batch_id NOT IN (SELECT batch_id FROM r WHERE len % 50 = 7)""")
def complete_batches(t: Tables):
    requests = _requests(t).withColumn("len", F.substring_index("job_title", " ", -1).cast("int"))
    replies = requests.filter("len % 50 <> 7").select("batch_id", "job_id")
    return labelling.complete_batches(requests, replies).select("job_id", "batch_id")


@query(f"""WITH {_REQ}, broken AS (SELECT DISTINCT batch_id FROM r WHERE len % 50 = 7),
                worse AS (SELECT DISTINCT batch_id FROM r WHERE len % 40 = 3)
           SELECT job_id, CASE WHEN batch_id NOT IN (SELECT batch_id FROM broken) THEN 'first'
                  WHEN batch_id NOT IN (SELECT batch_id FROM worse) THEN role ELSE 'No Ouput' END AS job_label FROM r""")
def label_fallbacks(t: Tables):
    requests = _requests(t).select("batch_id", "job_id", "job_title")
    size = F.substring_index("job_title", " ", -1).cast("int")
    first = lambda df: df.filter(size % 50 != 7).select("batch_id", "job_id", F.lit("first").alias("job_label"))
    second = lambda df: df.filter(size % 40 != 3).select(
        "batch_id", "job_id", F.substring_index("job_title", " ", 1).alias("job_label"))
    return labelling.label_with_fallbacks(requests, [first, second]).select("job_id", "job_label")


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_type = 'PROMO' THEN NULL
                 ELSE CAST(p_partkey AS VARCHAR) || '=' || CASE WHEN p_type = 'SMALL' THEN 'Data Engineer' ELSE 'None' END
                 END AS parsed FROM part""")
def label_replies(t: Tables):
    label = (F.when(F.col("p_type") == "SMALL", "Data Engineer").when(F.col("p_type") == "PROMO", "Chef")
             .otherwise("None"))
    reply = F.to_json(F.struct(F.array(F.struct(F.col("p_partkey").alias("job_id"), label.alias("job_label"))).alias("jobs")))
    reply = F.when(F.col("p_size") % 5 == 0, F.substring(reply, 1, 20)).otherwise(reply)
    one = F.get(labelling.decode_reply(reply), F.lit(0))
    return t.part.select("p_partkey", F.concat_ws("=", one["job_id"], one["job_label"]).alias("parsed")).withColumn(
        "parsed", F.when(F.col("parsed") != "", F.col("parsed")))


@query("""SELECT d.doc_id, coalesce('q' || l.quality, CASE WHEN d.lang <> 'en' THEN d.lang END, 'None') AS label
          FROM documents d LEFT JOIN labels l USING (doc_id)""")
def filled_labels(t: Tables):
    rows = t.documents.select("doc_id", F.when(F.col("lang") != "en", F.col("lang")).otherwise("").alias("label"))
    given = t.labels.select(F.col("doc_id").alias("job_id"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("job_label"))
    return labelling.fill_label(rows, given, job_id="doc_id").select("doc_id", "label")


# ---- near-duplicates ---------------------------------------------------------------------------


def _similar_sql(table: str, row: str, body: str, tail: str) -> str:
    return f"""WITH t AS (SELECT {row} AS r, regexp_replace(lower({body}), '\\s\\s+', ' ', 'g') AS x FROM {table}),
      g AS (SELECT r, substring(x, i, 3) AS gram, count(*) AS tf
            FROM (SELECT r, x, unnest(range(1, length(x) - 1)) AS i FROM t WHERE length(x) >= 3) GROUP BY ALL),
      d AS (SELECT gram, ln((1.0 + (SELECT count(*) FROM t)) / (1.0 + count(*))) + 1.0 AS idf FROM g GROUP BY gram),
      w AS (SELECT r, gram, tf * idf AS w FROM g JOIN d USING (gram)),
      v AS (SELECT r, gram, w / sqrt(sum(w * w) OVER (PARTITION BY r)) AS w FROM w),
      s AS (SELECT a.r AS a, b.r AS b, sum(a.w * b.w) AS similarity FROM v a JOIN v b ON a.gram = b.gram AND a.r < b.r
            GROUP BY ALL HAVING sum(a.w * b.w) > 0.75) {tail}"""


_TITLE = "replace(lower(p_name), ' ', '') || ' ' || replace(lower(p_brand), ' ', '')"


def _titled(t: Tables):
    return t.part.select("p_partkey", "p_type", text.compare_key(F.col("p_name"), F.col("p_brand")).alias("compare"))


@query(_similar_sql("part", "p_partkey", _TITLE, "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT b FROM s)"))
def near_duplicates_dropped(t: Tables):
    return neardup.drop_near_duplicates(_titled(t), row="p_partkey", text="compare").select("p_partkey")


@query(_similar_sql("documents", "doc_id", "text", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT b FROM s)"))
def near_duplicate_texts_dropped(t: Tables):
    return neardup.drop_near_duplicates(t.documents.select("doc_id", "text"), row="doc_id", text="text").select("doc_id")


@query(_similar_sql("part", "p_partkey", _TITLE, """,
      f AS (SELECT min(r) AS r FROM t GROUP BY x)
      SELECT a, b, round(similarity, 6) AS similarity FROM s WHERE a IN (SELECT r FROM f) AND b IN (SELECT r FROM f)"""))
def similar_pairs(t: Tables):
    pairs = neardup.similar_rows(_titled(t), row="p_partkey", text="compare")
    return pairs.select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("""SELECT gram, count(*) AS n_uses, count(DISTINCT doc_id) AS n_texts FROM (
            SELECT doc_id, substring(x, unnest(range(1, length(x) - 1)), 3) AS gram
            FROM (SELECT doc_id, regexp_replace(lower(text), '\\s\\s+', ' ', 'g') AS x FROM documents) WHERE length(x) >= 3)
          GROUP BY gram""")
def character_grams(t: Tables):
    docs = t.documents.select("doc_id", "text")
    several = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("_id"))
    several, same = materialise(several, "several"), F.col("doc_id").eqNullSafe(F.col("_id"))

    def grams(df):
        # the outer form keeps Spark from making the grams a second time to test them for emptiness
        counted = neardup.gram_counts(neardup.char_grams(neardup.comparable(F.col("text"))))
        return df.select("doc_id", F.explode_outer(counted).alias("x")).select("doc_id", "x.*").filter("gram is not null")

    # only the grams of texts in several rows must meet before they are counted
    parts = grams(docs.join(several, same, "left_semi")).groupBy("doc_id", "gram").agg(F.sum("tf").alias("tf"))
    per_text = grams(docs.join(several, same, "left_anti")).unionByName(parts)
    return per_text.groupBy("gram").agg(F.sum("tf").alias("n_uses"), F.count(F.lit(1)).alias("n_texts"))


@query(_similar_sql("part", "p_partkey", _TITLE, """,
      f AS (SELECT min(r) AS r FROM t GROUP BY x)
      SELECT r AS p_partkey, count(*) AS n_grams, round(max(w), 6) AS heaviest, round(sum(w), 6) AS total
      FROM v WHERE r IN (SELECT r FROM f) GROUP BY r"""))
def text_weights(t: Tables):
    reps = neardup.earliest_copies(_titled(t), "p_partkey", "compare")
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x["w"])
    return neardup.weighted_terms(reps, t.part.count()).select(
        F.col("row").alias("p_partkey"), F.size("v").cast("bigint").alias("n_grams"),
        F.round(F.array_max("v.w"), 6).alias("heaviest"), F.round(total, 6).alias("total"))


@query(_similar_sql("part", "p_partkey", _TITLE, """
      SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey FROM lineitem
      WHERE l_partkey IN (SELECT p_partkey FROM part) AND l_partkey NOT IN (SELECT b FROM s)"""))
def skills_of_survivors(t: Tables):
    kept = neardup.drop_near_duplicates(_titled(t), row="p_partkey", text="compare").select(F.col("p_partkey").alias("l_partkey"))
    return dedupe.only_in(t.lineitem, kept, "l_partkey").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")


# ---- set operations ----------------------------------------------------------------------------


_SITES = {"customer": ["c_custkey", "c_name", "c_nationkey"], "supplier": ["s_suppkey", "s_name", "s_nationkey"],
          "other": ["id", "name", "nation"]}


@query("""SELECT 'customer' AS platform, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation
          FROM customer UNION ALL
          SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier UNION ALL
          SELECT 'unknown', CAST(r_regionkey AS VARCHAR), r_name, NULL FROM region""")
def sites_in_one_layout(t: Tables):
    unknown = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit(None).alias("nation"))
    return unify.union_sites([("customer", t.customer), ("supplier", t.supplier), ("unknown", unknown)], columns=_SITES)


@query("""SELECT 'nation' AS platform, count(*) AS n_rows FROM nation UNION ALL SELECT 'region', count(*) FROM region""")
def rows_of_sites_without_a_layout(t: Tables):
    frames = [("customer", t.customer), ("region", t.region), ("nation", t.nation)]
    return t.spark.createDataFrame(sorted(unify.left_out(frames, columns=_SITES).items()), "platform string, n_rows bigint")


@query("""SELECT p_partkey AS job_id, p_type AS skill_raw FROM part UNION ALL
          SELECT p_partkey, p_brand FROM part UNION ALL SELECT p_partkey, p_type FROM part WHERE p_size > 25""")
def skill_lists_together(t: Tables):
    one = lambda df, c: df.select(F.col("p_partkey").alias("job_id"), F.col(c).alias("skill_raw"))
    return unify.union_all([one(t.part, "p_type"), one(t.part, "p_brand"), one(t.part.filter("p_size > 25"), "p_type")])


@query("""SELECT conv_id, turn, role FROM conversations""")
def result_pages_joined(t: Tables):
    page = F.struct("turn", "role")
    nested = t.conversations.select("conv_id", F.array(F.array(page), F.array().cast("array<struct<turn: bigint, role: string>>")).alias("pages"))
    return unify.explode_pages(nested, "pages", ["conv_id"]).select("conv_id", "entry.turn", "entry.role")


@query("""SELECT DISTINCT strftime(d, '%Y-%m-%d') AS actual_date FROM (SELECT o_orderdate AS d FROM orders UNION ALL
          SELECT l_shipdate FROM lineitem) WHERE d IS NOT NULL""")
def distinct_dates_of_two_columns(t: Tables):
    both = t.orders.select(F.col("o_orderdate").cast("date").alias("date_view"), F.lit(None).cast("date").alias("last_seen")).unionByName(
        t.lineitem.select(F.lit(None).cast("date").alias("date_view"), F.col("l_shipdate").cast("date").alias("last_seen")))
    return unify.distinct_values(both, ["date_view", "last_seen"], "actual_date").select(
        F.date_format("actual_date", "yyyy-MM-dd").alias("actual_date"))


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def ids_not_loaded(t: Tables):
    loaded = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return dedupe.not_in(t.customer, loaded, "c_custkey").select("c_custkey")


@query("""SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def rows_of_surviving_ids(t: Tables):
    kept = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return dedupe.only_in(t.orders, kept, "o_custkey").select("o_orderkey")


@query("""SELECT p_partkey, CASE WHEN p_type = split_part(p_name, ' ', 1) THEN p_type ELSE p_type || '|' || p_brand END AS found
          FROM part""")
def ordered_distinct_in_list(t: Tables):
    listed = F.array("p_type", "p_brand", "p_type", "p_brand")
    return t.part.select("p_partkey", F.array_join(text.distinct_in_order(listed), "|").alias("found"))

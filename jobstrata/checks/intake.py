"""Landed payloads and pages, hand-off files and the table store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata import schemas
from jobstrata.checks.base import Tables, query
from jobstrata.operators import geo
from jobstrata.session import new_path
from jobstrata.sources import handoff, pages, payloads
from jobstrata.sources.tables import TableStore

PAGE = 100  # postings per made-up response; keys are unique, so groups stay this small


def responses(df: DataFrame, key: str, job: Column) -> DataFrame:
    """Rows of a test table packed into response bodies, ``PAGE`` neighbouring keys each."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), job.alias("job"))))
    body = F.to_json(F.struct(F.transform(entries, lambda e: e["job"]).alias("data")))
    return (df.groupBy(F.expr(f"{key} div {PAGE}").alias("page_no"))
            .agg(body.alias("body")))


def _flat(df: DataFrame) -> DataFrame:
    return df.select("platform", "page_no", "pos", "job_id", "job_title", "created_on", "emp_name",
                     F.array_join("location_raw", "|").alias("location"), "job_link",
                     F.array_join("skills", "|").alias("skills"))


_POS = "CAST(row_number() OVER (PARTITION BY {k} // 100 ORDER BY {k}) - 1 AS INTEGER) AS pos"


@query(f"""SELECT 'careerviet' AS platform, o_orderkey // 100 AS page_no, {_POS.format(k='o_orderkey')},
             CAST(o_orderkey AS VARCHAR) AS job_id, o_orderpriority AS job_title,
             strftime(o_orderdate, '%Y-%m-%d') AS created_on, 'C' || o_custkey AS emp_name,
             CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus || '|X' ELSE o_orderstatus END AS location,
             'https://careerviet.vn/en/' || o_orderkey AS job_link, CAST(NULL AS VARCHAR) AS skills FROM orders""")
def json_files_to_postings(t: Tables):
    place = F.when(F.col("o_custkey") % 2 == 0, F.to_json(F.array("o_orderstatus", F.lit("X")))).otherwise(F.col("o_orderstatus"))
    job = F.struct(F.col("o_orderkey").alias("job_id"), F.col("o_orderpriority").alias("job_title"),
                   F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_view"),
                   F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("emp_name"),
                   place.alias("location_name"),
                   F.concat(F.lit("https://careerviet.vn/en/"), F.col("o_orderkey").cast("string")).alias("job_link"))
    packed = responses(t.orders, "o_orderkey", job)
    line = F.concat(F.lit('{"page_no":'), F.col("page_no").cast("string"), F.lit(","), F.expr("substring(body, 2)"))
    landed = new_path(t.spark, "landed")
    packed.select(line.alias("value")).write.text(landed)
    return _flat(payloads.read_platform(t.spark, landed, "careerviet", F.lit(None)))


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderpriority AS job_title, {_POS.format(k='o_orderkey')}
           FROM orders""")
def json_whole_bodies(t: Tables):
    """Responses saved one to a file, in any formatting."""
    job = F.struct(F.col("o_orderkey").alias("job_id"), F.col("o_orderpriority").alias("job_title"))
    packed = responses(t.orders, "o_orderkey", job).withColumn("body", F.regexp_replace("body", "[{]", "{\n  "))
    landed = new_path(t.spark, "landed")
    payloads.write_bodies(packed, landed)
    return payloads.read_responses(t.spark, f"{landed}/*", "careerviet", "bodies").select("job.job_id", "job.job_title", "pos")


@query("""SELECT count(*) AS n_bodies, count(*) FILTER (WHERE page_no % 3 = 0) AS n_broken
          FROM (SELECT DISTINCT o_orderkey // 100 AS page_no FROM orders)""")
def broken_bodies_counted(t: Tables):
    """Every third response is cut off; none may vanish uncounted."""
    packed = responses(t.orders, "o_orderkey", F.struct(F.col("o_orderkey").alias("job_id")))
    cut = F.when(F.col("page_no") % 3 == 0, F.expr("left(body, length(body) - 3)")).otherwise(F.col("body"))
    landed = new_path(t.spark, "landed")
    packed.select(cut.alias("value")).write.text(landed)
    bodies = payloads.read_bodies(t.spark, landed, "careerviet").select("file", "broken")
    return bodies.groupBy("file").agg(F.count(F.lit(1)).alias("n")).join(payloads.broken_bodies(bodies), "file", "left").agg(
        F.sum("n").alias("n_bodies"), F.coalesce(F.sum("n_broken"), F.lit(0)).alias("n_broken"))


@query(f"""SELECT 'vietnamworks' AS platform, p_partkey // 100 AS page_no, {_POS.format(k='p_partkey')},
             CAST(p_partkey AS VARCHAR) AS job_id, p_name AS job_title, '2024-01-02T03:04:05+07:00' AS created_on,
             p_brand AS emp_name, p_type AS location, 'https://v.example/' || p_partkey AS job_link,
             CASE WHEN p_size % 4 <> 0 THEN p_brand || '|' || p_type END AS skills FROM part""")
def nested_skills_last_city(t: Tables):
    named = lambda c: F.struct(F.col(c).alias("skillName"))
    city = lambda c: F.struct(F.col(c).alias("cityNameVI"))
    job = F.struct(F.col("p_partkey").alias("jobId"), F.col("p_name").alias("jobTitle"),
                   F.lit("2024-01-02T03:04:05+07:00").alias("createdOn"), F.col("p_brand").alias("companyName"),
                   F.concat(F.lit("https://v.example/"), F.col("p_partkey").cast("string")).alias("jobUrl"),
                   F.when(F.col("p_size") % 4 != 0, F.array(named("p_brand"), named("p_type"))).alias("skills"),
                   F.array(city("p_name"), city("p_type")).alias("workingLocations"))
    return _flat(payloads.flatten_vietnamworks(
        payloads.parse_responses(responses(t.part, "p_partkey", job), "vietnamworks")))


@query(f"""SELECT 'monster' AS platform, c_custkey // 100 AS page_no, {_POS.format(k='c_custkey')},
             CAST(c_custkey AS VARCHAR) AS job_id, c_name AS job_title, CAST(1700000000000 + c_custkey AS VARCHAR) AS created_on,
             c_mktsegment AS emp_name, 'N' || c_nationkey AS location, 'https://m.example/' || c_custkey AS job_link,
             CASE WHEN c_nationkey % 4 <> 0 THEN c_mktsegment || '|' || c_name ELSE '' END AS skills FROM customer""")
def nested_skills_first_city(t: Tables):
    said = lambda c: F.struct(F.col(c).alias("text"))
    city = lambda c: F.struct(c.alias("city"))
    job = F.struct(F.col("c_custkey").alias("jobId"), F.col("c_name").alias("title"),
                   (F.lit(1700000000000) + F.col("c_custkey")).alias("createdAt"),
                   F.concat(F.lit("https://m.example/"), F.col("c_custkey").cast("string")).alias("applyUrl"),
                   F.when(F.col("c_nationkey") % 4 != 0, F.array(said("c_mktsegment"), said("c_name"))).alias("itSkills"),
                   F.array(city(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))), city(F.col("c_name"))).alias("locations"),
                   F.struct(F.col("c_mktsegment").alias("name")).alias("company"))
    return _flat(payloads.flatten_monster(
        payloads.parse_responses(responses(t.customer, "c_custkey", job), "monster")))


@query(f"""SELECT 'topdev' AS platform, page_id // 100 AS page_no, {_POS.format(k='page_id')},
             md5(url) AS job_id, 'T' || page_id AS job_title, '03-02-2024' AS created_on,
             split_part(url, '/', 3) AS emp_name, split_part(url, '/', 4) AS location, url AS job_link,
             'T' || page_id || '|' || split_part(url, '/', 4) AS skills FROM pages""")
def nested_company_and_date(t: Tables):
    host, folder = F.split_part("url", F.lit("/"), F.lit(3)), F.split_part("url", F.lit("/"), F.lit(4))
    title = F.concat(F.lit("T"), F.col("page_id").cast("string"))
    job = F.struct(title.alias("title"), F.col("url").alias("detail_url"),
                   F.struct(F.lit("03-02-2024").alias("date")).alias("published"),
                   F.struct(host.alias("display_name"),
                            F.struct(folder.alias("address_short_region_list")).alias("addresses")).alias("company"),
                   F.array(title, folder).alias("skills_arr"))
    return _flat(payloads.flatten_topdev(payloads.parse_responses(responses(t.pages, "page_id", job), "topdev")))


@query(f"""SELECT 'itviec' AS platform, event_id // 100 AS page_no, {_POS.format(k='event_id')},
             md5('https://itviec.example/' || event_id) AS job_id, event_type AS job_title,
             strftime(DATE '2024-02-01' - CAST(user_id AS INTEGER), '%Y-%m-%d') AS created_on,
             'U' || user_id AS emp_name, event_type AS location, 'https://ITviec.example/' || event_id AS job_link,
             'U' || user_id || '|' || event_type AS skills FROM events""")
def card_records(t: Tables):
    user = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    job = F.struct(F.concat(F.lit(" "), "event_type", F.lit("\n")).alias("title"),
                   F.concat(F.lit("https://ITviec.example/"), F.col("event_id").cast("string")).alias("url"),
                   F.concat(user, F.lit(" ")).alias("company"), F.concat(F.lit("\t"), "event_type").alias("location"),
                   F.concat(F.lit("Posted\n"), F.col("user_id").cast("string"), F.lit(" days ago")).alias("age_text"),
                   F.array(F.col("event_type"), F.lit("+2")).alias("tags"),
                   F.concat(user, F.lit(", "), "event_type").alias("tooltip"))
    return _flat(payloads.flatten_itviec(
        payloads.parse_responses(responses(t.events, "event_id", job), "itviec"),
        F.lit("2024-02-01 02:00:00").cast("timestamp")))


@query("SELECT event_id, CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_fields(t: Tables):
    return t.events.select("event_id", payloads.json_field(F.col("props"), "k", "bigint").alias("k"))


_CLEAN = "regexp_replace({x}, '&amp;?', '&', 'g')"
_NAV = {"nav": {"domain": "https://nav.example", "container": "nav li", "job_title": "a", "job_link": "a[href]",
                "emp_name": "span.company"}}


@query(f"""SELECT page_id AS page_no, CAST(i - 1 AS INTEGER) AS pos, titles[i] AS job_title, CAST(NULL AS VARCHAR) AS emp_name,
             'https://nav.example' || hrefs[i] AS job_link, md5('https://nav.example' || hrefs[i]) AS job_id
           FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS titles,
                        regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
                        unnest(range(1, 1 + len(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)))) AS i
                 FROM (SELECT page_id, {_CLEAN.format(x='html')} AS html FROM pages))""")
def page_cards(t: Tables):
    landed = t.pages.select(F.lit("nav").alias("platform"), F.col("page_id").alias("page_no"), "html")
    return pages.cards_to_postings(pages.find_cards(landed, _NAV), _NAV).select(
        "page_no", "pos", "job_title", "emp_name", "job_link", "job_id")


def _tag_text(fragment: str) -> str:
    pieces = f"regexp_split_to_array({fragment}, '<[^>]*>')"
    clean = _CLEAN.format(x="p").replace("regexp_replace(", "regexp_replace(", 1)
    return (f"array_to_string(list_transform({pieces}, lambda p: trim(replace({clean}, '&quot;', '\"'), "
            f"E' \\t\\n\\r')), '')")


_WHOLE = {"doc": {"domain": "https://doc.example", "container": "html", "job_title": "h1", "created_on_attr": "lang",
                  "job_desc": "div.ad"}}


@query(f"""SELECT page_id AS page_no, {_tag_text("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS job_title,
             regexp_extract(html, '<html lang="([a-z]*)"', 1) AS created_on,
             {_tag_text('''regexp_extract(html, '<div class="ad">(.*?)</div>', 1, 's')''')} AS job_desc FROM pages""")
def card_attribute_date(t: Tables):
    landed = t.pages.select(F.lit("doc").alias("platform"), F.col("page_id").alias("page_no"), "html")
    return pages.find_cards(landed, _WHOLE).select("page_no", "job_title", "created_on", "job_desc")


_STATUS = "CASE page_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 500 WHEN 2 THEN NULL ELSE 200 END"


@query(f"""SELECT CAST(page_id AS VARCHAR) AS job_id, md5(CASE WHEN s = 200 THEN d ELSE '' END) AS desc_md5
           FROM (SELECT page_id, {_STATUS} AS s,
                        {_tag_text("regexp_extract(html, '<article>(.*)</article>', 1, 's')")} AS d FROM pages)
           WHERE s IS NOT NULL AND s <> 404""")
def page_descriptions(t: Tables):
    code = F.col("page_id") % 10
    status = F.when(code == 0, 404).when(code == 1, 500).when(code > 2, 200)
    fetched = t.pages.select(F.lit("doc").alias("platform"), F.col("page_id").cast("string").alias("job_id"),
                             status.alias("status"), "html")
    return pages.fetched_details(fetched, {"doc": {"job_desc": "article"}}).select(
        "job_id", F.md5("job_desc").alias("desc_md5"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS job_id, c_name || E'\\n"quoted", ' || c_mktsegment AS job_title, '2024-01-01' AS date_view,
                 c_mktsegment AS emp_raw, 'Hà Nội' AS location_name, CAST(NULL AS VARCHAR) AS label_name,
                 'https://x.example' AS job_link, c_name AS skill_raw FROM customer""")
def csv_handoff(t: Tables):
    base = new_path(t.spark, "handoff")
    columns = {"job_id": F.col("c_custkey").cast("string"), "job_title": F.concat("c_name", F.lit('\n"quoted", '), "c_mktsegment"),
               "date_view": F.lit("2024-01-01"), "emp_raw": F.col("c_mktsegment"), "location_name": F.lit("Hà Nội"),
               "label_name": F.lit(None), "job_link": F.lit("https://x.example")}
    handoff.write(t.customer.select(*[v.cast("string").alias(k) for k, v in columns.items()]), f"{base}/master", "csv")
    handoff.write(t.customer.select(F.col("c_custkey").cast("string").alias("job_id"), F.col("c_name").alias("skill_raw")),
                  f"{base}/skills", "csv")
    back, skills = handoff.read_pair(t.spark, f"{base}/master", f"{base}/skills", fmt="csv")
    _, none = handoff.read_pair(t.spark, f"{base}/master", f"{base}/missing", fmt="csv")
    return back.join(skills.unionByName(none), "job_id").select(*columns, "skill_raw")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CAST(o_custkey AS BIGINT) AS emp_id FROM orders""")
def table_store(t: Tables):
    store = TableStore(t.spark, new_path(t.spark, "store"), {
        "facts": T.StructType([T.StructField("job_id", schemas.STR), T.StructField("emp_id", schemas.LONG)])})
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("job_id"), F.col("o_custkey").alias("emp_id"),
                           F.col("o_orderstatus").alias("s"))
    store.replace("facts", rows.filter("s <> 'O'"))
    store.replace("facts", rows.filter("s = 'F'"))
    store.append("facts", rows.filter("s = 'O'"))
    store.append("facts", rows.filter("s = 'P'"))
    return store.read("facts")


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS job_id FROM orders")
def loaded_ids(t: Tables):
    store = TableStore(t.spark, new_path(t.spark, "store"), {
        "fact_job_postings": T.StructType([T.StructField("job_id", schemas.STR)])})
    none_yet = store.known_ids()
    store.replace("fact_job_postings", t.orders.select(F.col("o_custkey").cast("string").alias("job_id")))
    return store.known_ids().unionByName(none_yet)


_UNIT = "[cos(radians({a})) * cos(radians({o})), cos(radians({a})) * sin(radians({o})), sin(radians({a}))]"


@query(f"""WITH p AS (SELECT vec_id, {_UNIT.format(a='CAST(embedding[1] AS DOUBLE) * 80', o='CAST(embedding[2] AS DOUBLE) * 170')} AS v
                      FROM embeddings),
                g AS (SELECT s_suppkey, {_UNIT.format(a='(CAST(s_suppkey * 37 % 140 AS DOUBLE) - 70)', o='(CAST(s_suppkey * 91 % 340 AS DOUBLE) - 170)')} AS v
                      FROM supplier),
                d AS (SELECT vec_id, s_suppkey, row_number() OVER (PARTITION BY vec_id ORDER BY
                        pow(p.v[1] - g.v[1], 2) + pow(p.v[2] - g.v[2], 2) + pow(p.v[3] - g.v[3], 2), s_suppkey) AS r FROM p, g)
           SELECT vec_id, s_suppkey AS city FROM d WHERE r = 1""")
def nearest_place(t: Tables):
    spots = t.embeddings.select("vec_id", (F.col("embedding")[0].cast("double") * 80).alias("lat"),
                                (F.col("embedding")[1].cast("double") * 170).alias("lon"))
    places = t.supplier.select(F.col("s_suppkey").alias("city"), F.col("s_nationkey").alias("admin1"),
                               ((F.col("s_suppkey") * 37 % 140).cast("double") - 70).alias("lat"),
                               ((F.col("s_suppkey") * 91 % 340).cast("double") - 170).alias("lon"))
    return geo.nearest_place(spots, places).select("vec_id", "city")

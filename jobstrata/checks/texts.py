"""Text, keyword, link and date functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata.checks.base import Tables, query
from jobstrata.functions import dates, links, text
from jobstrata.operators import relevance, unify
from jobstrata.plans.requests import request_list

# Words of the test tables in place of job words.
MUST, POSITIVE, NEGATIVE = ["ring", "gear", "bolt", "widget"], ["small", "red", "old", "hot"], ["old"]
TITLE_RULES = {"hotring": "Hot", "ring": "Ring", "largegear": "Large", "gear": "Gear", "coldwid": "Cold"}
TERMS = ["the", "that", "of", "and", "les", "que", "dans", "und", "nicht", "para", "los"]
LETTERS = ("àâäçéèêëîïôöùûüßáíóúñÀÂÄÇÉÈÊËÎÏÔÖÙÛÜÁÍÓÚÑ", "aaaceeeeiioouuusaiounAAACEEEEIIOOUUUAIOUN")
PLACES = ["the of", "les", "und", "que la", "erthe"]
TEXT_RULES = {"thatthe": "first", "ofthe": "second", "lesque": "third", "derund": "fourth", "queel": "fifth",
              "the": "sixth"}

_BOUND = "(^|[^\\p{L}\\p{N}_])(%s)([^\\p{L}\\p{N}_]|$)"
_has = lambda col, words: f"regexp_matches({col}, '{_BOUND % '|'.join(words)}', 'i')"
_quoted = lambda words: ", ".join(f"'{w}'" for w in words)
_rules = lambda col, rules: ("CASE regexp_extract(%s, '%s') %s END" % (
    col, "|".join(rules), " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.items())))
TERMS_SQL = ("list_sort(list_distinct(list_filter(regexp_split_to_array({c}, '[^\\p{{L}}\\p{{N}}_]+'), "
             "lambda x: lower(x) IN (" + _quoted(TERMS) + "))))")


@query(f"""SELECT p_partkey, p_name FROM part
           WHERE {_has('p_name', MUST)} AND {_has('p_name', POSITIVE)} AND NOT {_has('p_name', NEGATIVE)}""")
def relevance_filter(t: Tables):
    return relevance.keep_relevant(t.part, "p_name", must_have=MUST, positive=POSITIVE,
                                   negative=NEGATIVE).select("p_partkey", "p_name")


@query(f"""SELECT doc_id FROM documents
           WHERE {_has('text', ['the', 'les', 'und'])} AND {_has('text', ['that', 'que', 'nicht'])}
             AND NOT {_has('text', ['http', 'www'])}""")
def relevance_filter_whole_texts(t: Tables):
    return relevance.keep_relevant(t.documents, "text", must_have=["the", "les", "und"],
                                   positive=["that", "que", "nicht"], negative=["http", "www"]).select("doc_id")


@query("""SELECT p_partkey, regexp_replace(p_type || 'x' || upper(p_brand[1:1]) || lower(p_brand[2:3]) || p_type,
                 '([a-z])([A-Z])', '\\1 \\2', 'g') AS spaced FROM part""")
def camel_case_split(t: Tables):
    joined = F.concat("p_type", F.lit("x"), F.upper(F.substring("p_brand", 1, 1)),
                      F.lower(F.substring("p_brand", 2, 2)), "p_type")
    return t.part.select("p_partkey", text.split_camel_case(joined).alias("spaced"))


@query("""SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'PROMO') THEN lower(p_type) ELSE 'other' END
          AS platform FROM part""")
def platform_names(t: Tables):
    messy = F.concat(F.lit(" "), F.substring("p_type", 1, 2), F.lit(" "), F.expr("substring(p_type, 3)"), F.lit(" "))
    return t.part.select("p_partkey", text.platform_key(messy, ["economy", "small", "promo"]).alias("platform"))


@query(f"""SELECT source AS platform, doc_id FROM documents WHERE source IN ('src1', 'src7')""")
def keep_platforms(t: Tables):
    return relevance.only_platform(t.documents, "src1", "src7", column="source").select(
        F.col("source").alias("platform"), "doc_id")


@query("""SELECT source AS platform, doc_id FROM documents WHERE source <> 'src7'""")
def other_platforms(t: Tables):
    return relevance.except_platform(t.documents, "src7", column="source").select(
        F.col("source").alias("platform"), "doc_id")


@query("""SELECT p_partkey, p_type FROM part WHERE p_type <> 'PROMO'
          AND regexp_matches(p_type, '^(SMALL|LARGE|MEDIUM)$')""")
def empty_titles_dropped(t: Tables):
    blanked = t.part.withColumn("title", F.when(F.col("p_type") != "PROMO", F.col("p_type")).otherwise(""))
    return relevance.keep_relevant(blanked, "title", must_have=["small", "large", "medium"],
                                   positive=["small", "large", "medium"], negative=["promo"]).select("p_partkey", "p_type")


@query(f"""SELECT p_partkey, {_rules("replace(lower(p_name), ' ', '')", TITLE_RULES)} AS label FROM part""")
def title_rule_label(t: Tables):
    return t.part.select("p_partkey", text.rule_label(F.col("p_name"), TITLE_RULES).alias("label"))


@query(f"""SELECT doc_id, {_rules("replace(lower(text), ' ', '')", TEXT_RULES)} AS label FROM documents""")
def text_rule_label(t: Tables):
    return t.documents.select("doc_id", text.rule_label(F.col("text"), TEXT_RULES).alias("label"))


@query("""SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Data Scientist' WHEN 'SMALL' THEN 'Other Data Job'
          WHEN 'MEDIUM' THEN 'Data Analyst' WHEN 'STANDARD' THEN 'Data Engineer' ELSE 'None' END AS job_label FROM part""")
def role_rules(t: Tables):
    titles = {"ECONOMY": "AI Engineer - ", "SMALL": "Head of Data, ", "MEDIUM": "Business Analyst (SQL) ",
              "STANDARD": "Database Administrator ", "PROMO": "Business Analyst ", "LARGE": "Java Developer "}
    lead = F.create_map(*[F.lit(x) for p in titles.items() for x in p])
    title = F.concat(lead[F.col("p_type")], "p_name")
    return t.part.select("p_partkey", text.role_by_title(title).alias("job_label"))


@query(f"SELECT doc_id, array_to_string({TERMS_SQL.format(c='text')}, '|') AS skills FROM documents")
def skill_extraction(t: Tables):
    return t.documents.select("doc_id", F.array_join(text.extract_terms(F.col("text"), TERMS), "|").alias("skills"))


@query("""SELECT p_partkey, 'Brand#' AS with_edges, CASE WHEN p_size % 2 = 0 THEN 'Brand#' ELSE '' END AS standalone
          FROM part""")
def skill_symbol_edges(t: Tables):
    spaced = F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit(" Brand# x"))).otherwise(F.col("p_brand"))
    return t.part.select(
        "p_partkey", F.array_join(text.extract_terms(spaced, ["Brand#"], edges_only=True), "|").alias("with_edges"),
        F.array_join(text.extract_terms(spaced, ["Brand#"]), "|").alias("standalone"))


@query(f"SELECT doc_id, unnest({TERMS_SQL.format(c='text')}) AS skill_raw FROM documents")
def skill_rows(t: Tables):
    return unify.explode_skills(t.documents.withColumn("skills", text.extract_terms(F.col("text"), TERMS)),
                                keep=["doc_id"])


@query(f"""SELECT doc_id, md5(trim(translate(text, '{LETTERS[0]}', '{LETTERS[1]}'), E' \\t\\n\\r')) AS plain_md5
           FROM documents""")
def accent_removal(t: Tables):
    return t.documents.select("doc_id", F.md5(text.remove_accents(F.col("text"), LETTERS)).alias("plain_md5"))


@query(f"""SELECT doc_id, coalesce(nullif(array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i), ', '), ''),
                  'Other') AS place
           FROM (SELECT doc_id, regexp_extract_all(translate(text, '{LETTERS[0]}', '{LETTERS[1]}'),
                 '(?i){"|".join(p.replace(" ", "[[:space:]]?") for p in PLACES)}') AS f FROM documents)""")
def location_names(t: Tables):
    return t.documents.select("doc_id", text.normalise_location(F.col("text"), PLACES, letters=LETTERS).alias("place"))


@query("""SELECT p_partkey, p_name || ', ' || p_type AS place FROM part""")
def place_list_text(t: Tables):
    return t.part.select("p_partkey", text.join_places(F.array("p_name", "p_type")).alias("place"))


@query("SELECT p_partkey, p_name || '  ' || p_type AS name FROM part")
def whitespace_strip(t: Tables):
    padded = F.concat(F.lit("\t  "), "p_name", F.lit("  "), "p_type", F.lit(" \n "))
    return t.part.select("p_partkey", text.strip(padded).alias("name"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN p_name || '|' || p_type
                 ELSE p_name END AS items FROM part""")
def literal_lists(t: Tables):
    raw = (F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("["), "p_name"))
           .when(F.col("p_size") % 3 == 1, F.concat(F.lit("['"), "p_name", F.lit("', \""), "p_type", F.lit("\"]")))
           .otherwise(F.col("p_name")))
    return t.part.select("p_partkey", F.array_join(text.parse_literal_list(raw), "|").alias("items"))


@query("""SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN NULL ELSE p_type END AS value
          FROM part""")
def missing_markers(t: Tables):
    marked = F.when(F.col("p_type") == "PROMO", "None").when(F.col("p_type") == "SMALL", "N/A").otherwise(F.col("p_type"))
    return t.part.select("p_partkey", text.missing_to_null(marked).alias("value"))


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct([p_brand, p_type, p_name])), '|') AS skills
          FROM part""")
def tags_with_tooltip(t: Tables):
    tip = F.concat("p_name", F.lit(" , "), "p_type", F.lit(",+"), F.col("p_size").cast("string"))
    tags = F.array(F.col("p_brand"), F.col("p_type"), F.lit("+3"))
    return t.part.select("p_partkey", F.array_join(text.merge_tags(tags, tip), "|").alias("skills"))


@query("""SELECT p_partkey, replace(lower(p_name), ' ', '') || ' ' || replace(lower(p_brand), ' ', '') AS compare_text
          FROM part""")
def compare_texts(t: Tables):
    return t.part.select("p_partkey", text.compare_key(F.col("p_name"), F.col("p_brand")).alias("compare_text"))


@query("""SELECT page_id, CASE WHEN page_id % 4 = 3 THEN NULL WHEN href LIKE 'http%' THEN href
                 ELSE 'https://site.example' || href END AS job_link
          FROM (SELECT page_id, CASE WHEN url LIKE 'https%' THEN regexp_replace(url, '^https?://[^/]*', '') ELSE url END
                AS href FROM pages)""")
def absolute_links(t: Tables):
    href = F.when(F.col("url").startswith("https"), F.regexp_replace("url", "^https?://[^/]*", "")).otherwise(F.col("url"))
    href = F.when(F.col("page_id") % 4 != 3, href)
    return t.pages.select("page_id", links.absolute_link(href, "https://site.example").alias("job_link"))


@query("""SELECT page_id, md5(coalesce(CASE WHEN page_id % 4 <> 3 THEN url END, 'None')) AS card_id,
                 md5(lower(trim('  ' || upper(url) || ' '))) AS url_id FROM pages""")
def link_ids(t: Tables):
    return t.pages.select("page_id", links.card_id(F.when(F.col("page_id") % 4 != 3, F.col("url"))).alias("card_id"),
                          links.url_id(F.concat(F.lit("  "), F.upper("url"), F.lit(" "))).alias("url_id"))


@query("""SELECT page_id, replace(url, 'https://m.', 'https://w.') AS job_link FROM pages
          WHERE url NOT LIKE 'http:%'""")
def locale_rewrite(t: Tables):
    link = F.when(~F.col("url").startswith("http:"), F.col("url"))
    return (t.pages.select("page_id", links.rewrite_locale(link, "https://m.", "https://w.").alias("job_link"))
            .dropna(subset=["job_link"]))


@query("""SELECT s.platform, k.keyword, CAST(p.n AS INTEGER) AS page_num,
                 s.url || '?' || s.a || '=' || k.keyword || '&' || s.b || '=' || CAST(p.n AS VARCHAR) AS request
          FROM (SELECT DISTINCT p_name AS keyword FROM part) k,
               (VALUES ('one', 'https://one.example/find', 'q', 'page', 2), ('two', 'https://two.example/jobs', 's', 'p', 3))
               s(platform, url, a, b, pages),
               range(1, 4) p(n) WHERE p.n <= s.pages""")
def crawl_requests(t: Tables):
    templates = {"one": ("https://one.example/find", {"q": "{keyword}", "page": "{page_num}"}, 2),
                 "two": ("https://two.example/jobs", {"s": "{keyword}", "p": "{page_num}"}, 3)}
    words = t.part.select(F.col("p_name").alias("keyword")).distinct()
    pair = lambda e: F.concat(e["key"], F.lit("="), e["value"])
    return request_list(words, templates=templates).select(
        "platform", "keyword", "page_num",
        F.concat("url", F.lit("?"), F.array_join(F.transform(F.map_entries("params"), pair), "&")).alias("request"))


_RUN = "2024-02-01 02:00:00"


@query(f"""SELECT event_id, strftime(CAST(CASE event_type
              WHEN 'click' THEN TIMESTAMP '{_RUN}' - to_hours(CAST(user_id AS INTEGER))
              WHEN 'view' THEN TIMESTAMP '{_RUN}' - to_days(CAST(user_id AS INTEGER))
              WHEN 'signup' THEN TIMESTAMP '{_RUN}' - to_minutes(CAST(user_id AS INTEGER))
              ELSE TIMESTAMP '{_RUN}' END AS DATE), '%Y-%m-%d') AS posted FROM events""")
def card_age_dates(t: Tables):
    unit = F.create_map(*[F.lit(x) for x in ("click", " Hours ago", "view", "\ndays ago", "signup", " minutes ago",
                                             "purchase", " weeks", "error", "")])
    said = F.concat(F.lit("Posted "), F.col("user_id").cast("string"), unit[F.col("event_type")])
    day = dates.age_to_date(said, F.lit(_RUN).cast("timestamp"))
    return t.events.select("event_id", F.date_format(day, "yyyy-MM-dd").alias("posted"))


@query("""SELECT event_id, strftime(CASE event_type
              WHEN 'click' THEN date_trunc('second', ts) WHEN 'view' THEN date_trunc('millisecond', ts)
              WHEN 'signup' THEN date_trunc('second', ts)
              WHEN 'purchase' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) - INTERVAL 7 HOUR
              ELSE TIMESTAMP '1990-10-10' END, '%Y-%m-%d %H:%M:%S.%f') AS posted,
            strftime(CAST(CASE event_type
              WHEN 'click' THEN date_trunc('second', ts) WHEN 'view' THEN date_trunc('millisecond', ts)
              WHEN 'signup' THEN date_trunc('second', ts)
              WHEN 'purchase' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) - INTERVAL 7 HOUR
              ELSE TIMESTAMP '1990-10-10' END + INTERVAL 7 HOUR AS DATE), '%Y-%m-%d') AS local_day FROM events""")
def posting_dates(t: Tables):
    ts = F.col("ts").cast("timestamp")
    said = (F.when(F.col("event_type") == "click", F.unix_seconds(ts).cast("string"))
            .when(F.col("event_type") == "view", F.unix_millis(ts).cast("string"))
            .when(F.col("event_type") == "signup", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(F.col("event_type") == "purchase",
                  F.when(F.col("user_id") % 2 == 0, F.date_format(ts, "dd/MM/yyyy")).otherwise(F.date_format(ts, "yyyy-MM-dd")))
            .otherwise(F.lit("None")))
    link = F.when(F.col("user_id") % 2 == 0, "https://topdev.vn/x").otherwise("https://x.example")
    got = dates.posting_timestamp_or_default(said, link, F.lit(_RUN).cast("timestamp"))
    return t.events.select("event_id", F.date_format(got, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("posted"),
                           F.date_format(dates.local_date(got), "yyyy-MM-dd").alias("local_day"))


@query(f"""SELECT event_id, strftime(CASE event_type
              WHEN 'click' THEN TIMESTAMP '{_RUN}' - to_hours(CAST(user_id AS INTEGER))
              WHEN 'view' THEN TIMESTAMP '{_RUN}' - to_days(CAST(user_id AS INTEGER))
              WHEN 'signup' THEN TIMESTAMP '{_RUN}' - to_minutes(CAST(user_id AS INTEGER))
              WHEN 'purchase' THEN TIMESTAMP '{_RUN}' - to_days(CAST(7 * user_id AS INTEGER))
              ELSE TIMESTAMP '{_RUN}' - INTERVAL 1 DAY END, '%Y-%m-%d %H:%M:%S') AS posted FROM events""")
def relative_dates(t: Tables):
    unit = F.create_map(*[F.lit(x) for x in ("click", " giờ trước", "view", " ngày trước", "signup", " minutes ago",
                                             "purchase", " weeks ago")])
    said = F.when(F.col("event_type") == "error", F.lit("Hôm qua")).otherwise(
        F.concat(F.col("user_id").cast("string"), F.try_element_at(unit, F.col("event_type"))))
    got = dates.relative_timestamp(said, F.lit(_RUN).cast("timestamp"))
    return t.events.select("event_id", F.date_format(got, "yyyy-MM-dd HH:mm:ss").alias("posted"))


@query("""SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE strftime(ts, '%d/%m/%Y') END AS created_on
          FROM events""")
def detail_dates(t: Tables):
    day = F.date_format("ts", "dd/MM/yyyy")
    texts = F.array(F.col("event_type"), F.lit("a/b"), F.when(F.col("user_id") % 3 != 0, day).otherwise(F.lit("n/a, soon")),
                    F.lit("01/01/2000 x"), F.when(F.col("user_id") % 3 != 0, F.lit("09/09/1999")))
    return t.events.select("event_id", dates.first_slash_date(texts).alias("created_on"))


@query("""SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1999-06-30' - 60""")
def age_filter(t: Tables):
    recent = dates.is_recent(F.col("o_orderdate").cast("date"), F.lit("1999-06-30").cast("date"))
    return t.orders.filter(recent).select("o_orderkey")

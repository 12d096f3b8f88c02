"""The registered queries of the numbered operators, and the SQL some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.llm import (
    bpe_duckdb,
    decontaminate,
    html_tree,
    labelled_pages,
    lloyd_codes,
    quality_ftrl,
    quality_rules,
    radix_spans,
    secret_forest,
    simhash_bk,
    token_planes,
    url_lists,
    variant_trie,
    warc_index,
)
from jobstrata.session import materialise, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (_table(spark, folder, t) for t in ("documents", "labels"))
    counted = materialise(quality_rules.statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    judged = quality_rules.judge(counted, quality_rules.learn(counted, labels))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "rule")


@query
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (_table(spark, folder, t) for t in ("documents", "labels"))
    weights = quality_ftrl.fit(quality_ftrl.training_rows(docs, labels, max_rows=20_000))
    scored = quality_ftrl.score(docs.select("doc_id", "text"), weights)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_bk.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash_bk.hexadecimal("fp").alias("fingerprint"), "component_id")


@query
def op5_token_id_output(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return token_planes.read(token_planes.write(docs, public_tokenizers.path("word_bpe_49k.json")))


@query
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return bpe_duckdb.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = (_table(spark, folder, t) for t in ("documents", "benchmark"))
    return decontaminate.flag(docs.select("doc_id", "text"), benchmark).drop("text")


def _captures(pages: DataFrame) -> DataFrame:
    """Pages carry no fetch day; the query gives each one a day of 2024 by its id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(366)).cast(
        "int")).alias("fetched_on"))


def _list_changes(captures: DataFrame) -> DataFrame:
    """A dated list made from the hosts of the pages: some hosts are listed, taken off and listed again, and of the parent
    domains some first path segments."""
    hosts = captures.select(url_lists.host(F.col("url")).alias("h"), "page_id").where("h is not null").groupBy("h").agg(
        F.min("page_id").alias("m")).where("length(h) % 3 = 0")
    on = F.expr("date_add(date '2024-01-01', cast(pmod(m, 200) as int))")
    listed = hosts.select(F.col("h").alias("pattern"), F.explode(F.array(
        F.struct(on.alias("d"), F.lit(True).alias("listed")),
        F.struct(F.date_add(on, F.expr("cast(40 + pmod(m, 50) as int)")).alias("d"), F.lit(False).alias("listed")),
        F.struct(F.date_add(on, F.expr("cast(110 + pmod(m, 30) as int)")).alias("d"), F.lit(True).alias("listed")))).alias("x"))
    hosts_part = listed.select("pattern", F.col("x.d").alias("changed_on"), F.col("x.listed").alias("listed"),
                               F.lit("host").alias("category"))
    domain = F.regexp_extract(url_lists.host(F.col("url")), r"([^.]+\.[^.]+)$", 1)
    segment = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    parts = captures.select(F.concat(domain, F.lit("/"), segment).alias("pattern"), F.length(domain).alias("n"),
                            F.length(segment).alias("k"), "page_id").where("n > 0 and k > 0").groupBy("pattern").agg(
        F.min("page_id").alias("m")).where("length(pattern) % 4 = 0")
    return hosts_part.unionByName(parts.select(
        "pattern", F.expr("date_add(date '2024-03-01', cast(pmod(m, 100) as int))").alias("changed_on"),
        F.lit(True).alias("listed"), F.lit("path").alias("category")))


@query
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    captures = _captures(_table(spark, folder, "pages"))
    changes = materialise(_list_changes(captures), "list_changes")
    return url_lists.judge(captures, changes)


ORACLE["op6_url_filters"] = r"""
WITH captures AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS DATE) AS fetched_on,
         nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '') AS h,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS segment
  FROM pages),
hosts AS (SELECT h, min(page_id) AS m FROM captures WHERE h IS NOT NULL GROUP BY h HAVING length(h) % 3 = 0),
parts AS (
  SELECT regexp_extract(h, '([^.]+\.[^.]+)$', 1) || '/' || segment AS pattern, min(page_id) AS m
  FROM captures WHERE segment <> '' AND regexp_extract(h, '([^.]+\.[^.]+)$', 1) <> '' GROUP BY 1),
changes AS (
  SELECT h AS pattern, CAST(DATE '2024-01-01' + CAST(m % 200 AS INTEGER) AS DATE) AS changed_on, true AS listed,
         'host' AS category FROM hosts
  UNION ALL SELECT h, CAST(DATE '2024-01-01' + CAST(m % 200 + 40 + m % 50 AS INTEGER) AS DATE), false, 'host' FROM hosts
  UNION ALL SELECT h, CAST(DATE '2024-01-01' + CAST(m % 200 + 110 + m % 30 AS INTEGER) AS DATE), true, 'host' FROM hosts
  UNION ALL SELECT pattern, CAST(DATE '2024-03-01' + CAST(m % 100 AS INTEGER) AS DATE), true, 'path' FROM parts
  WHERE length(pattern) % 4 = 0),
asked AS (SELECT DISTINCT url, fetched_on, h, segment FROM captures WHERE h IS NOT NULL),
domains AS (
  SELECT url, fetched_on, segment, array_to_string((string_split(h, '.'))[k:], '.') AS d
  FROM (SELECT *, unnest(range(1, len(string_split(h, '.')) + 1)) AS k FROM asked)),
offered AS (
  SELECT url, fetched_on, d AS pattern FROM domains
  UNION ALL SELECT url, fetched_on, d || '/' || segment FROM domains WHERE segment <> ''),
last_change AS (
  SELECT o.url, o.fetched_on, o.pattern, max(c.changed_on) AS changed_on
  FROM offered o JOIN changes c ON c.pattern = o.pattern AND c.changed_on <= o.fetched_on GROUP BY ALL),
in_force AS (
  SELECT l.url, l.fetched_on, l.pattern, min(c.category) AS category
  FROM last_change l JOIN changes c ON c.pattern = l.pattern AND c.changed_on = l.changed_on AND c.listed GROUP BY ALL),
best AS (
  SELECT url, fetched_on, count(*) AS n, arg_min(pattern, (-length(pattern), pattern)) AS pattern,
         arg_min(category, (-length(pattern), pattern)) AS category
  FROM in_force GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched_on, b.n IS NOT NULL AS blocked, coalesce(b.n, 0) AS n_entries, b.pattern, b.category
FROM captures c LEFT JOIN best b ON b.url = c.url AND b.fetched_on = c.fetched_on
"""


@query
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    records, index = warc_index.archive(pages)
    return warc_index.look_up(warc_index.keys_of(pages), index, records=records)


ORACLE["op9_warc"] = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
known AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM payloads)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM known
"""


@query
def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    model = html_tree.fit(labelled_pages.pages())
    return html_tree.extract(_table(spark, folder, "pages").select("page_id", "url", "html"), model)


@query
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found, forest, words = secret_forest.train(_table(spark, folder, "documents"))
    return secret_forest.judge(found, forest, words).select("doc_id", "nth", "value", "score", "is_secret")


@query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = lloyd_codes.code_vectors(_table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
    return lloyd_codes.with_label_errors(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(lloyd_codes.books_sha256(books)).alias("codebooks_sha256"))


ORACLE["op11_vector_codes"] = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, label, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS x
  FROM kept, range(16) AS t(p)),
seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM kept QUALIFY k < 64),
b0 AS (SELECT p, k, x AS e FROM parts JOIN seeds USING (vec_id)),
a0 AS (
  SELECT vec_id, p, any_value(x) AS x, arg_min(k, d * 64 + k) AS k FROM (
    SELECT vec_id, p, x, k, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i]))) AS d
    FROM parts JOIN b0 USING (p)) GROUP BY vec_id, p),
m0 AS (
  SELECT p, k, list(m ORDER BY i) AS e FROM (
    SELECT p, k, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
    FROM a0, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY p, k, i) GROUP BY p, k),
b1 AS (SELECT p, k, coalesce(m0.e, b0.e) AS e FROM b0 LEFT JOIN m0 USING (p, k)),
a1 AS (
  SELECT vec_id, p, any_value(x) AS x, arg_min(k, d * 64 + k) AS k FROM (
    SELECT vec_id, p, x, k, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i]))) AS d
    FROM parts JOIN b1 USING (p)) GROUP BY vec_id, p),
m1 AS (
  SELECT p, k, list(m ORDER BY i) AS e FROM (
    SELECT p, k, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
    FROM a1, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY p, k, i) GROUP BY p, k),
b2 AS (SELECT p, k, coalesce(m1.e, b1.e) AS e FROM b1 LEFT JOIN m1 USING (p, k)),
a2 AS (
  SELECT vec_id, p, arg_min(k, d * 64 + k) AS k, min(d) AS d FROM (
    SELECT vec_id, p, k, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i]))) AS d
    FROM parts JOIN b2 USING (p)) GROUP BY vec_id, p),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a2 GROUP BY vec_id),
by_label AS (
  SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id) JOIN by_label ON kept.label IS NOT DISTINCT FROM by_label.label,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b2)
"""


@query
def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = radix_spans.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["begin"]))
    return cleaned.select("doc_id", (F.octet_length("kept") + gone).alias("n_bytes"), gone.alias("n_removed"),
                          F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op12_suffix_dedup"] = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 49, 0))) AS p FROM docs)),
firsts AS (SELECT s, min(doc_id) AS earliest FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
repeats AS (SELECT doc_id, p FROM windows JOIN firsts USING (s) WHERE earliest < doc_id),
runs AS (
  SELECT doc_id, min(p) AS b, max(p) + 50 AS e
  FROM (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
        FROM (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS fresh
              FROM repeats))
  GROUP BY doc_id, run),
kept AS (  -- what lies before each run and behind the last one
  SELECT doc_id, string_agg(substr(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY b) AS h
  FROM (SELECT doc_id, h, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS b, b AS e FROM runs JOIN docs USING (doc_id)
        UNION ALL SELECT doc_id, any_value(h), max(e), any_value(n) FROM runs JOIN docs USING (doc_id) GROUP BY doc_id)
  GROUP BY doc_id),
gone AS (SELECT doc_id, CAST(sum(e - b) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, docs.h))) AS kept_sha256
FROM docs LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variant_trie.variants(_table(spark, folder, "documents").select("doc_id", "text")).select(
        "word", "form", "root", "n", "n_near", "form_n")


ORACLE["op13_spelling_variants"] = """
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM (SELECT unnest(range(256)) AS i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents)
  WHERE length(r) >= 7 GROUP BY ALL),
hexed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda j: CAST('0x' || substr(h, 2 * j + 1, 2) AS BIGINT))),
      lambda acc, byte: xor(acc >> 8, t[(xor(acc, byte) & 255) + 1]))) AS crc
  FROM hexed, crc),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT CASE WHEN crc % 31 = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, times
        FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
gaps AS (SELECT word, left(word, i - 1) || ' ' || substr(word, i + 1) AS gap, left(word, i - 1) || substr(word, i + 1) AS less FROM places),
shorter AS (SELECT DISTINCT g.word, w.word AS near FROM gaps g JOIN words w ON w.word = g.less),
near AS (
  SELECT word, near FROM shorter UNION SELECT near, word FROM shorter
  UNION SELECT a.word, b.word FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.word <> b.word),
best AS (
  SELECT near.word, count(*) AS n_near, max(w.n) AS most, min(w.word) FILTER (w.n = m.most) AS near
  FROM near JOIN words w ON w.word = near.near
  JOIN (SELECT near.word, max(n) AS most FROM near JOIN words ON words.word = near.near GROUP BY near.word) m ON m.word = near.word
  GROUP BY near.word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 10 * w.n THEN b.near END AS form,
         CASE WHEN b.most >= 10 * w.n THEN b.most END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, word AS here, 0 AS steps FROM forms
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN forms f ON f.word = c.here WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

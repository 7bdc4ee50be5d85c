"""Queries over joins, merges, upserts and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import hashing, merge
from provlake.operators import dedupe, summaries
from provlake.plans.discovery import table


def team_summary(spark, d):
    orders = table(spark, d, "orders")
    lines = table(spark, d, "lineitem").select("l_orderkey").join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    base = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    out = summaries.with_counts(base, "c_custkey",
        {"n_orders": orders.select(F.col("o_custkey").alias("c_custkey")), "n_lines": lines.select(F.col("o_custkey").alias("c_custkey"))})
    return out.withColumn("status", summaries.pipeline_status(F.col("n_lines") > 50, F.col("n_lines") > 20, F.col("n_orders") > 0))


def _merged(spark, d):
    a = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("a"))
    b = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.nullif(F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)/", 1), F.lit("")).alias("b"))
    return a.join(b, "id", "full").withColumn("m", merge.merge_field("a", "b"))


def merge_fields(spark, d):
    return _merged(spark, d).select("id", F.col("m.value").alias("value"), F.col("m.source").alias("source"), F.col("m.status").alias("status"))


def merge_rollup(spark, d):
    m = _merged(spark, d).withColumn("n", merge.merge_field("b", F.lit(None).cast("string")))
    return m.select("id", merge.rollup_status("m.status", "n.status").alias("status"))


def no_text_skip(spark, d):
    return dedupe.drop_checked(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id", "toxic = 1")


def dedupe_two_keys(spark, d):
    e = table(spark, d, "events").withColumn("k1", F.concat_ws(":", "event_type", F.col("user_id").cast("string"))).withColumn("k2",
        F.concat(F.lit("u"), F.col("user_id").cast("string")))
    old = e.where("event_id % 10 = 0")
    known = dedupe.existing_keys(old, F.col("k1"), F.when(F.col("user_id") % 5 == 0, F.col("k2")))
    return dedupe.skip_known(e.where("event_id % 10 <> 0"), known, ["k1", "k2"]).select("event_id", "k1", "k2")


def reuse_or_fetch(spark, d):
    lines = table(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return dedupe.reuse_or_fetch(table(spark, d, "orders").select("o_orderkey", "o_custkey"), lines, "o_orderkey")


def manifest_merge(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    return dedupe.append_new(p.where("p_partkey % 3 = 0"), p.where("p_partkey % 2 = 0"), ["p_partkey"])


def check_upsert(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return dedupe.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id", "event_id").select("user_id", "event_type", "position")


def chunk_slice(spark, d):
    return dedupe.chunk(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 5, 10)


def presence_histogram(spark, d):
    e = table(spark, d, "events").select("user_id",
        F.when(F.col("event_type") == "click", " has_text ").when(F.col("event_type") == "view", "NO_TEXT").when(F.col("event_type") == "purchase",
        "  ").otherwise(F.col("event_type")).alias("presence"))
    return summaries.presence_histogram(e, "user_id", "presence")


def failure_classify(spark, d):
    e = table(spark, d, "events")
    kind = F.when(F.col("event_id") % 4 == 0, "FileNotFoundError").when(F.col("event_id") % 4 == 1, "ValueError").otherwise("RuntimeError")
    note = F.when(F.col("event_id") % 3 == 0, "OCR_TEXT_EMPTY: nothing").otherwise("other")
    return e.select("event_id", merge.classify_error(kind, note).alias("error_code"))


def outcome_counters(spark, d):
    f = failure_classify(spark, d).join(table(spark, d, "events").select("event_id", "event_type"), "event_id")
    return f.groupBy("event_type").agg(F.count_if(F.col("error_code") == "OCR_FAILED").alias("failed"),
        F.count_if(F.col("error_code") != "OCR_FAILED").alias("success"), F.count_if(F.col("error_code") == "OCR_TEXT_EMPTY").alias("no_text"))


def process_batch(spark, d):
    """Manifest without checked images, OCR text joined, fields merged, first row of each product, statuses."""
    rows = dedupe.drop_checked(table(spark, d, "documents").select("doc_id", "lang", "source"), table(spark, d, "labels"), "doc_id", "toxic = 1")
    ocr = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)/", 1).alias("ocr_lang"))
    m = rows.join(ocr, "doc_id", "left").withColumn("m", merge.merge_field("lang", "ocr_lang"))
    m = m.select("doc_id", hashing.source_record_id("source", F.col("lang"), F.lit("")).alias("record"), F.col("m.value").alias("value"),
        F.col("m.source").alias("value_source"), F.col("m.status").alias("validation_status"))
    return dedupe.first_wins(m, "record", "doc_id").withColumn("parse_status", merge.parse_status("value"))


_SIDES = """WITH s AS (SELECT coalesce(d.doc_id, p.page_id) AS id, d.lang AS a, nullif(regexp_extract(p.url, '^[a-z]+://[^/]+/([a-z]+)/', 1), '') AS b FROM documents d FULL JOIN pages p ON p.page_id = d.doc_id),
    m AS (SELECT id, a, b, coalesce(a, b) AS value, CASE WHEN a IS NULL AND b IS NULL THEN 'NOT_FOUND' WHEN b IS NULL THEN 'DOM' WHEN a IS NULL THEN 'OCR' WHEN a = b THEN 'DOM_AND_OCR' ELSE 'DOM' END AS source,
        CASE WHEN a IS NULL AND b IS NULL THEN 'FIELD_NOT_FOUND' WHEN a <> b THEN 'REVIEW_REQUIRED' ELSE 'MATCHED' END AS status FROM s)"""
_ERROR = "CASE WHEN event_id % 4 = 0 THEN 'IMAGE_NOT_FOUND' WHEN event_id % 3 = 0 THEN 'OCR_TEXT_EMPTY' WHEN event_id % 4 = 1 THEN 'INVALID_INPUT' ELSE 'OCR_FAILED' END"

def text_check_map(spark, d):
    """The last check of each image path, which is what later stages look up."""
    e = table(spark, d, "events").select("event_id", F.concat(F.lit("img/"), (F.col("user_id") % 40).cast("string")).alias("image_path"),
        F.col("event_type").alias("status"))
    return dedupe.last_wins(e, "image_path", "event_id").select("image_path", "status")


QUERIES = [
    (text_check_map, "SELECT 'img/' || (user_id % 40) AS image_path, arg_max(event_type, event_id) AS status FROM events GROUP BY 1"),
    (team_summary, """SELECT c_custkey, c_mktsegment, coalesce(o.n, 0) AS n_orders, coalesce(l.n, 0) AS n_lines, CASE WHEN l.n > 50 THEN 'ACCEPTED' WHEN l.n > 20 THEN 'OCR_DONE' WHEN o.n > 0 THEN 'CRAWLED' ELSE 'IN_PROGRESS' END AS status
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey
        LEFT JOIN (SELECT o_custkey, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) l ON l.o_custkey = c_custkey"""),
    (merge_fields, f"{_SIDES} SELECT id, value, source, status FROM m"),
    (merge_rollup, f"{_SIDES} SELECT id, CASE WHEN status = 'REVIEW_REQUIRED' THEN status WHEN status = 'FIELD_NOT_FOUND' AND b IS NULL THEN 'FIELD_NOT_FOUND' ELSE 'MATCHED' END AS status FROM m"),
    (no_text_skip, "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)"),
    (dedupe_two_keys, """WITH e AS (SELECT event_id, user_id, event_type || ':' || user_id AS k1, 'u' || user_id AS k2 FROM events), o AS (SELECT * FROM e WHERE event_id % 10 = 0),
        k AS (SELECT k1 AS key FROM o UNION SELECT k2 FROM o WHERE user_id % 5 = 0)
        SELECT event_id, k1, k2 FROM e WHERE event_id % 10 <> 0 AND NOT EXISTS (SELECT 1 FROM k WHERE key = k1) AND NOT EXISTS (SELECT 1 FROM k WHERE key = k2)"""),
    (reuse_or_fetch, "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49) THEN 'REUSE' ELSE 'FETCH' END AS action FROM orders"),
    (manifest_merge, "SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 2 = 0"),
    (check_upsert, """WITH r AS (SELECT user_id, event_id, event_type, event_id % 2 AS src FROM events)
        SELECT DISTINCT user_id, first_value(event_type) OVER (PARTITION BY user_id ORDER BY src DESC, event_id DESC) AS event_type, first_value(event_id) OVER (PARTITION BY user_id ORDER BY src, event_id) AS position FROM r"""),
    (chunk_slice, "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn > 5 AND rn <= 15"),
    (presence_histogram, """SELECT user_id, count(*) FILTER (event_type = 'click') AS has_text, count(*) FILTER (event_type = 'view') AS no_text, count(*) FILTER (upper(event_type) = 'UNKNOWN') AS unknown, count(*) FILTER (event_type <> 'purchase') AS total FROM events GROUP BY 1"""),
    (failure_classify, f"SELECT event_id, {_ERROR} AS error_code FROM events"),
    (outcome_counters, f"SELECT event_type, count(*) FILTER (c = 'OCR_FAILED') AS failed, count(*) FILTER (c <> 'OCR_FAILED') AS success, count(*) FILTER (c = 'OCR_TEXT_EMPTY') AS no_text FROM (SELECT event_type, {_ERROR} AS c FROM events) GROUP BY 1"),
    (process_batch, """WITH r AS (SELECT d.doc_id, d.lang, d.source, nullif(regexp_extract(p.url, '^[a-z]+://[^/]+/([a-z]+)/', 1), '') AS b FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id
            WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)),
        m AS (SELECT doc_id, concat_ws(':', source, lang) AS record, coalesce(lang, b) AS value, CASE WHEN lang IS NULL AND b IS NULL THEN 'NOT_FOUND' WHEN b IS NULL THEN 'DOM' WHEN lang IS NULL THEN 'OCR' WHEN lang = b THEN 'DOM_AND_OCR' ELSE 'DOM' END AS value_source,
            CASE WHEN lang IS NULL AND b IS NULL THEN 'FIELD_NOT_FOUND' WHEN lang <> b THEN 'REVIEW_REQUIRED' ELSE 'MATCHED' END AS validation_status FROM r)
        SELECT *, CASE WHEN value IS NULL THEN 'FIELD_PARSE_FAILED' ELSE 'COMPLETED' END AS parse_status FROM m QUALIFY row_number() OVER (PARTITION BY record ORDER BY doc_id) = 1"""),
]

"""Queries through files: sinks write to the shared folder, sources read it back, and SQL computes the same from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.operators import bundles, dedupe, intake, metadata
from provlake.plans.discovery import table
from provlake.sources import readers
from provlake.sources.shared import fresh_path

_MARKS = 'a "b", c\nd'
_KIND = "CASE WHEN n_nationkey % 3 = 0 THEN '[1, 2]' WHEN n_nationkey % 3 = 1 THEN '{\"nation\": \"' || n_name || '\", \"status\": \"ACCEPTED\"}' ELSE '{broken' END"


def flat_round_trip(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("batch_id"), F.concat("c_name", F.lit(_MARKS)).alias("note"), "c_mktsegment")
    path = fresh_path(spark, "flat")
    readers.write_flat(c, path)
    return readers.read_flat(spark, path, ["batch_id", "note", "c_mktsegment"]).select("batch_id", "note", "c_mktsegment")


def batch_files(spark, d):
    """One folder for each batch; the folder's name comes back as a column."""
    o = table(spark, d, "orders").select(F.concat(F.lit("b-"), "o_orderstatus").alias("batch"), F.col("o_orderkey").cast("string").alias("key"))
    root = fresh_path(spark, "batches")
    o.write.partitionBy("batch").option("header", True).csv(root)
    rows = readers.read_batches(spark, f"{root}/*", ["key"])
    return rows.select(F.regexp_replace("batch_path", "^batch=", "").alias("batch_id"), "key")


def failure_log(spark, d):
    """Failures of two commands, appended to one file one after the other."""
    e = table(spark, d, "events").where("event_type = 'error'")
    crawl = e.where("event_id % 2 = 0").select(F.col("event_id").cast("string").alias("product_id"), F.lit("CRAWL").alias("step"),
        F.lit(None).cast("string").alias("image_path"))
    ocr = e.where("event_id % 2 = 1").select(F.col("event_id").cast("string").alias("product_id"), F.lit("OCR").alias("step"),
        F.concat(F.lit("img/"), "user_id").alias("image_path"))
    path = fresh_path(spark, "failures")
    readers.write_flat(crawl, path)
    readers.write_flat(ocr, path, mode="append")
    return readers.read_flat(spark, path, ["product_id", "step", "image_path"]).select("product_id", "step", "image_path")


def failures_union(spark, d):
    """Failure tables of different columns as one."""
    e = table(spark, d, "events").where("event_type = 'error'")
    return dedupe.failures(e.where("event_id % 2 = 0").select("event_id", "value"),
        e.where("event_id % 2 = 1").select("event_id", F.col("user_id").cast("string").alias("user_id")))


def _json_files(spark, d):
    n = table(spark, d, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("batch"), F.expr(_KIND.replace("\\", "\\\\")).alias("value"))
    root = fresh_path(spark, "json")
    n.write.partitionBy("batch").text(root)
    return root


def _folder():
    return F.regexp_extract("path", "batch=([0-9]+)", 1).cast("int").alias("n_nationkey")


def json_strict(spark, d):
    return readers.read_json_strict(spark, f"{_json_files(spark, d)}/*").select(_folder(), "error")


def json_lenient(spark, d):
    rows = readers.read_json_lenient(spark, f"{_json_files(spark, d)}/*")
    return rows.select(_folder(), F.get_json_object("payload", "$.nation").alias("nation"), (F.trim("payload") == "{}").alias("empty"))


def file_digests(spark, d):
    return readers.file_hashes(spark, f"{_json_files(spark, d)}/*").select(_folder(), "size", "sha256")


def nested_scan(spark, d):
    """Crawl results as JSON documents, one folder for each status, and their rows again."""
    items = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    o = table(spark, d, "lineitem").groupBy("l_orderkey").agg(items.alias("items"), F.max("l_linestatus").alias("status"))
    path = fresh_path(spark, "nested")
    readers.write_nested(o, path, partition="status")
    rows = readers.read_nested(spark, path, "l_orderkey long, items array<struct<l_linenumber:int,l_partkey:long>>, status string", lines=True)
    return rows.select("l_orderkey", "status", F.explode("items").alias("i")).select("l_orderkey", "status", F.col("i.l_linenumber").alias("line"),
        F.col("i.l_partkey").alias("part"))


def _accepted(spark, d):
    n = table(spark, d, "nation")
    root = fresh_path(spark, "accepted")
    n.select(F.concat(F.lit("b"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("batch"),
        F.col("n_name").alias("value")).write.partitionBy("batch").text(root)
    fs, _ = readers._fs(spark, root)
    make = spark._jvm.org.apache.hadoop.fs.Path
    for r in n.where("n_nationkey % 2 = 0").select("n_nationkey").collect():  # 13 of the 25 nations
        stream = fs.create(make(f"{root}/batch=b{r.n_nationkey:03d}/manifest.json"))
        stream.write(b"{}")
        stream.close()
    return root


def batch_listing(spark, d):
    """Folders by name, descending; those with an 1 in their name."""
    rows = readers.list_batches(spark, _accepted(spark, d), contains="1")
    return dedupe.numbered(rows.withColumn("_all", F.lit(0)).withColumn("_down", -F.regexp_extract("batch_id", "([0-9]+)", 1).cast("int")), "_all",
        "_down", "place").select("batch_id", "place")


def accepted_listing(spark, d):
    return readers.accepted_batches(spark, _accepted(spark, d))


def url_list(spark, d):
    """A list of addresses with comments and blanks: first of each product, in order of the list."""
    p = table(spark, d, "pages").coalesce(1).sortWithinPartitions("page_id")
    path = fresh_path(spark, "urls")
    line = F.when(F.col("page_id") % 5 == 0, F.lit("# note")).when(F.col("page_id") % 7 == 0,
        F.lit("  ")).otherwise(F.concat(F.lit("https://www.shop.example/goods/"), (F.col("page_id") % 40).cast("string")))
    p.select(line.alias("value")).write.text(path)
    rules = readers.UrlRules(goods_path="/goods/", second_path="/none/", second_host="none.example", host="www.shop.example", domain="example")
    return readers.read_urls(spark, path, rules).select("url", "product_id")


def manifest_commit(spark, d):
    """Discovery manifests: derived, written beside, renamed once, read again."""
    e = table(spark, d, "events")
    runs = table(spark, d, "customer").select(F.col("c_custkey").alias("batch_id"), F.col("c_mktsegment").alias("source_mode"))
    found = e.select(F.col("user_id").alias("batch_id"), F.col("event_type").alias("item"), F.lit("NO_NEW").alias("stop_reason"),
        F.col("ts").alias("ended_at"), (F.col("value") > 45).alias("failed"))
    path = fresh_path(spark, "manifests")
    readers.commit_folder(intake.lifecycle(runs, found), path, "json")
    m = readers.read_nested(spark, path,
        "batch_id long, source_mode string, status string, discovered_count long, duplicate_count long, stop_reason string", lines=True)
    return m.select("batch_id", "source_mode", "status", "discovered_count", "duplicate_count", "stop_reason")


def layout_folders(spark, d):
    """The layout of each region's root, created twice: which of its folders are there."""
    base = fresh_path(spark, "layout")
    there = []
    for r in table(spark, d, "region").select("r_name").collect():  # one root for each
        for _ in range(2):
            readers.create_layout(spark, f"{base}/{r.r_name}")
        fs, _ = readers._fs(spark, base)
        there += [(r.r_name, n, fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{r.r_name}/{n}"))) for n in readers.LAYOUT]
    return spark.createDataFrame(there, "region string, folder string, present boolean")


def bundle_submit(spark, d):
    """A batch of five files goes to accepted in one rename; its files and artifacts, read again."""
    r = table(spark, d, "region")
    source, root = fresh_path(spark, "submit"), fresh_path(spark, "inbox")
    r.select(F.concat("r_name", F.lit(".csv")).alias("name"), F.col("r_name").alias("value")).write.partitionBy("name").text(source)
    files = readers.file_hashes(spark, f"{source}/*").select("path", F.regexp_extract("path", "name=([^/]+)", 1).alias("name"))
    report = r.agg(F.lit("b-ann-1").alias("batch_id"), F.lit("ann").alias("member"), F.lit("ACCEPTED").alias("status"), F.count("*").alias("row_count"))
    target = bundles.submit(spark, files, root, "b-ann-1", report)
    return readers.file_hashes(spark, f"{target}/*").where("name like '%.csv'").select("name", "size", "sha256")


def migration_scan(spark, d):
    r = table(spark, d, "nation")
    name = F.concat(F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), F.lit("_"), "n_name",
        F.when(F.col("n_nationkey") % 2 == 0, ".up.sql").otherwise(".down.sql"))
    return metadata.found_migrations(r.select(name.alias("name"), F.sha2("n_name", 256).alias("sha256")))


def compaction(spark, d):
    """Small JSON files to one Parquet table, with its rows and an order-free check."""
    path, out = fresh_path(spark, "small"), fresh_path(spark, "compact")
    table(spark, d, "events").select("event_id", "user_id", "event_type").repartition(16).write.json(path)
    readers.compact(spark, path, "event_id long, user_id long, event_type string", out)
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


_ERR = "SELECT event_id, user_id, value FROM events WHERE event_type = 'error'"
QUERIES = [
    (flat_round_trip, "SELECT CAST(c_custkey AS VARCHAR) AS batch_id, c_name || 'a \"b\", c' || chr(10) || 'd' AS note, c_mktsegment FROM customer"),
    (batch_files, "SELECT 'b-' || o_orderstatus AS batch_id, CAST(o_orderkey AS VARCHAR) AS key FROM orders"),
    (failure_log, "SELECT CAST(event_id AS VARCHAR) AS product_id, CASE WHEN event_id % 2 = 0 THEN 'CRAWL' ELSE 'OCR' END AS step, CASE WHEN event_id % 2 = 1 THEN 'img/' || user_id END AS image_path FROM events WHERE event_type = 'error'"),
    (failures_union, f"SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value END AS value, CASE WHEN event_id % 2 = 1 THEN CAST(user_id AS VARCHAR) END AS user_id FROM ({_ERR})"),
    (json_strict, "SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, CASE WHEN n_nationkey % 3 <> 1 THEN 'INVALID_JSON' END AS error FROM nation"),
    (json_lenient, "SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, CASE WHEN n_nationkey % 3 = 1 THEN n_name END AS nation, n_nationkey % 3 <> 1 AS empty FROM nation"),
    (file_digests, f"SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, CAST(strlen(v) AS BIGINT) AS size, sha256(v) AS sha256 FROM (SELECT n_nationkey, {_KIND} || chr(10) AS v FROM nation)"),
    (nested_scan, "SELECT l_orderkey, max(l_linestatus) OVER (PARTITION BY l_orderkey) AS status, CAST(l_linenumber AS INTEGER) AS line, l_partkey AS part FROM lineitem"),
    (batch_listing, "SELECT b AS batch_id, CAST(row_number() OVER (ORDER BY b DESC) AS INTEGER) AS place FROM (SELECT 'batch=b' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS b FROM nation) WHERE contains(b, '1')"),
    (accepted_listing, "SELECT 'batch=b' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS batch_id FROM nation WHERE n_nationkey % 2 = 0"),
    (url_list, "SELECT 'https://www.shop.example/goods/' || k AS url, CAST(k AS VARCHAR) AS product_id FROM (SELECT DISTINCT page_id % 40 AS k FROM pages WHERE page_id % 5 <> 0 AND page_id % 7 <> 0)"),
    (manifest_commit, """WITH f AS (SELECT user_id, count(DISTINCT event_type) AS n, count(*) AS a, bool_or(value > 45) AS bad FROM events GROUP BY 1)
        SELECT c_custkey AS batch_id, c_mktsegment AS source_mode, CASE WHEN n IS NULL THEN 'RUNNING' WHEN bad THEN 'FAILED' ELSE 'COMPLETED' END AS status,
        coalesce(n, 0) AS discovered_count, coalesce(a - n, 0) AS duplicate_count, CASE WHEN n IS NOT NULL THEN 'NO_NEW' END AS stop_reason FROM customer LEFT JOIN f ON user_id = c_custkey"""),
    (layout_folders, f"SELECT r_name AS region, unnest([{', '.join(repr(n) for n in readers.LAYOUT)}]) AS folder, true AS present FROM region"),
    (bundle_submit, "SELECT r_name || '.csv' AS name, CAST(strlen(r_name) + 1 AS BIGINT) AS size, sha256(r_name || chr(10)) AS sha256 FROM region"),
    (migration_scan, "SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS version, lpad(CAST(n_nationkey AS VARCHAR), 4, '0') || '_' || n_name || '.up.sql' AS name, sha256(n_name) AS checksum FROM nation WHERE n_nationkey % 2 = 0"),
    (compaction, "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1"),
]

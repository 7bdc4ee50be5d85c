"""Queries over discovery batches with their failures, and over partitions that are written one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions.urls import UrlRules
from provlake.operators import discovery
from provlake.plans.discovery import table
from provlake.sources import partitions
from provlake.sources.shared import fresh_path, written

_LINE = """CASE event_id % 7 WHEN 0 THEN '# note' WHEN 1 THEN '   ' WHEN 2 THEN concat(' https://www.shop.example/goods/', event_id % 40, '?x=1') WHEN 3 THEN concat('https://else.where/goods/', event_id % 40)
    WHEN 4 THEN 'https://www.shop.example/about' ELSE concat('https://www.shop.example/goods/', user_id % 9) END"""
_USER = "CASE WHEN user_id % 5 = 0 AND event_id % 7 IN (2, 3, 4, 5, 6) THEN user_id + 1000 WHEN user_id % 11 = 0 THEN user_id + CASE WHEN event_id % 7 IN (3, 4) THEN 1000 ELSE 0 END ELSE user_id END"


def _lists(spark, d):
    """A batch for each user; some users' good or bad lines belong to batches of their own."""
    lines = table(spark, d, "events").selectExpr(f"{_USER} AS batch_id", "event_id AS position", f"{_LINE} AS line")
    batches = lines.select("batch_id", F.concat(F.lit("lists/"), "batch_id").alias("requested_url")).distinct()
    return discovery.discover_url_lists(batches, lines, UrlRules())


def url_list_products(spark, d):
    return _lists(spark, d).products


def url_list_failures(spark, d):
    return _lists(spark, d).failures.groupBy("batch_id", "requested_url", "error_code").agg(F.count("*").alias("n"))


def url_list_manifests(spark, d):
    return _lists(spark, d).manifests.drop("requested_url")


def visit_manifests(spark, d):
    """Customers as visits, their orders as what was found; some visits time out, some fail."""
    c = table(spark, d, "customer").selectExpr("c_custkey AS batch_id", "concat('s/', c_custkey) AS requested_url",
        "CASE c_custkey % 8 WHEN 3 THEN 'TIMEOUT' WHEN 5 THEN 'ERROR' ELSE 'OK' END AS fetch")
    o = table(spark, d, "orders").selectExpr("o_custkey AS batch_id", "'NO_NEW_PRODUCTS' AS stop_reason",
        "cast(o_orderkey AS string) AS original_product_id", "o_orderkey AS discovery_order", "concat('u/', o_orderkey) AS product_url",
        "o_custkey % 3 AS duplicates")
    out = discovery.discover_visits(c, o)
    codes = out.failures.select("batch_id", "error_code")
    return out.manifests.join(codes, "batch_id", "left").drop("requested_url")


def partition_overwrite(spark, d):
    """A table by brand: all partitions written, then those of the brands whose number is divisible by three written anew, and read through the registry."""
    p = table(spark, d, "part").selectExpr("p_brand", "p_partkey", "p_size")
    path, log = fresh_path(spark, "partitioned"), partitions.registry(spark, fresh_path(spark, "registry"))
    number = F.substring_index("p_brand", "#", -1).cast("int")
    keys = lambda rows, name: rows.select(F.lit(name).alias("set_name"), F.col("p_brand").alias("key"))
    partitions.overwrite(p, path, "p_brand")
    partitions.register(log, keys(p, "collection_batches"))
    again = p.where(number % 3 == 0)
    partitions.overwrite(again.where("p_size > 10").withColumn("p_size", F.col("p_size") * 2), path, "p_brand")
    partitions.register(log, keys(again, "gold_dataset_versions").unionByName(keys(again, "collection_batches")))
    wanted = written(partitions.keys_of(log, "collection_batches"))
    return partitions.of_partitions(spark, path, "p_brand", wanted, "key <> 'Brand#2'").select("p_brand", "p_partkey", "p_size")


_L = f"""
    l AS (SELECT {_USER} AS batch_id, event_id, trim({_LINE}) AS u FROM events),
    a AS (SELECT *, nullif(regexp_extract(u, '/goods/([0-9]+)', 1), '') AS id FROM l WHERE u <> '' AND NOT starts_with(u, '#')),
    k AS (SELECT *, id IS NOT NULL AND contains(u, 'shop.example') AS good FROM a QUALIFY id IS NULL OR row_number() OVER (PARTITION BY batch_id, id ORDER BY event_id) = 1),
    p AS (SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY event_id) AS discovery_order, id AS original_product_id, 'https://www.shop.example/goods/' || id AS product_url FROM k WHERE good),
    b AS (SELECT DISTINCT batch_id FROM l),
    w AS (SELECT batch_id, u AS requested_url, 'INVALID_PRODUCT_URL' AS error_code FROM k WHERE NOT good),
    f AS (SELECT * FROM w UNION ALL SELECT batch_id, 'lists/' || batch_id, 'PRODUCT_LINK_NOT_FOUND' FROM b WHERE batch_id NOT IN (SELECT batch_id FROM k))"""

QUERIES = [
    (url_list_products, f"WITH {_L} SELECT batch_id, CAST(discovery_order AS INTEGER) AS discovery_order, original_product_id, product_url FROM p"),
    (url_list_failures, f"WITH {_L} SELECT batch_id, requested_url, error_code, count(*) AS n FROM f GROUP BY ALL"),
    (url_list_manifests, f"""WITH {_L}, m AS (SELECT batch_id, (SELECT count(*) FROM p WHERE p.batch_id = b.batch_id) AS discovered_count, (SELECT count(*) FROM f WHERE f.batch_id = b.batch_id) AS failure_count,
        (SELECT count(*) FROM a WHERE a.batch_id = b.batch_id) - (SELECT count(*) FROM k WHERE k.batch_id = b.batch_id) AS duplicate_count FROM b)
        SELECT *, CASE WHEN discovered_count = 0 THEN 'FAILED' WHEN failure_count > 0 THEN 'PARTIAL_FAILED' ELSE 'COMPLETED' END AS status FROM m"""),
    (visit_manifests, """WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
        v AS (SELECT c_custkey AS batch_id, CASE c_custkey % 8 WHEN 3 THEN 'DISCOVERY_PAGE_TIMEOUT' WHEN 5 THEN 'DISCOVERY_PAGE_FETCH_FAILED' ELSE CASE WHEN n IS NULL THEN 'PRODUCT_LINK_NOT_FOUND' END END AS error_code, n FROM customer LEFT JOIN o ON o_custkey = c_custkey)
        SELECT batch_id, CASE WHEN error_code IS NULL THEN n ELSE 0 END AS discovered_count, CASE WHEN error_code IS NULL THEN 0 ELSE 1 END AS failure_count, CASE WHEN error_code IS NULL THEN batch_id % 3 ELSE 0 END AS duplicate_count,
        CASE WHEN error_code IS NULL THEN 'NO_NEW_PRODUCTS' END AS stop_reason, CASE WHEN error_code IS NULL THEN 'COMPLETED' ELSE 'FAILED' END AS status, error_code FROM v"""),
    (partition_overwrite, """WITH p AS (SELECT *, CAST(string_split(p_brand, '#')[2] AS INT) % 3 = 0 AS again FROM part)
        SELECT p_brand, p_partkey, CASE WHEN again THEN p_size * 2 ELSE p_size END AS p_size FROM p WHERE p_brand <> 'Brand#2' AND (NOT again OR p_size > 10)"""),
]

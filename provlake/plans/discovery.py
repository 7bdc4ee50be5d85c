"""Queries over links and discovery rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.functions import urls
from provlake.operators import dedupe, images
from provlake.sources.html import Images, Links

#: The driver's pages stand in for products: /<language>/<number> is the product path.
RULES = urls.UrlRules(goods_path="/en/", second_path="/fr/", second_host="store.example", host="www.example.com", domain="example.")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _pages(spark, d):
    return table(spark, d, "pages").withColumn("pid", urls.product_id("url", RULES))


def url_canonicalize(spark, d):
    return _pages(spark, d).select("page_id", F.col("pid").alias("product_id"), urls.canonical_url("url", RULES).alias("canonical_url"))


def url_dedupe_first(spark, d):
    return dedupe.first_wins(_pages(spark, d), "pid", "page_id", keep_null_keys=True).select("page_id", F.col("pid").alias("product_id"))


def url_duplicate_count(spark, d):
    p = _pages(spark, d)
    return p.agg(F.count("*").alias("usable"), F.count_distinct("pid").alias("unique_ids"),
        F.greatest(F.lit(0).cast("long"), F.count("pid") - F.count_distinct("pid")).alias("duplicates"))


def search_url_encode(spark, d):
    return table(spark, d, "part").select("p_partkey", urls.search_url("p_name").alias("url"))


def page_links(spark, d):
    p = table(spark, d, "pages")
    return p.lateralJoin(Links(F.col("html").outer(), F.lit(""))).select("page_id", "position", "href")


def page_images(spark, d):
    """The driver's pages have no images: each gets one at the end of its body."""
    image = F.concat(F.lit('<img src="/i/'), F.col("page_id").cast("string"), F.lit('.png" alt="last"></body>'))
    p = table(spark, d, "pages").withColumn("html", F.replace("html", F.lit("</body>"), image))
    return p.lateralJoin(Images(F.col("html").outer())).select("page_id", "position", "src", "alt")


def discovery_order_cap(spark, d):
    p = dedupe.first_wins(_pages(spark, d).where("pid is not null").withColumn("host", F.expr("parse_url(url, 'HOST')")), ["host", "pid"], "page_id")
    return dedupe.numbered(p, "host", "page_id", cap=20).select("host", "page_id", "pid", "discovery_order")


def scroll_stop(spark, d):
    e = table(spark, d, "events").select(F.to_date("ts").cast("string").alias("batch"), F.hour("ts").alias("round"), "user_id")
    return dedupe.scroll_stop(e, "batch", "round", "user_id", 60, 3)


def category_inputs(spark, d):
    p = table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 3 != 0, F.col("page_id").cast("string")).alias("code"),
        F.when(F.col("page_id") % 2 == 0, F.col("url")).alias("u"))
    return p.select("page_id", urls.category_input_ok("code", "u").alias("ok"), urls.category_url("code").alias("category_url"))


def image_candidates(spark, d):
    e = table(spark, d, "events")
    made = e.select(
        F.col("user_id").alias("page_id"),
        F.col("event_id").alias("position"),
        F.concat(F.lit("https://img.example/"), "event_type", F.lit("/"), (F.col("event_id") % 50).cast("string"),
            F.when(F.col("event_id") % 7 == 0, "/detail.jpg#x").otherwise("/a.jpg")).alias("src"),
        F.when(F.col("event_id") % 11 == 0, "logo").alias("alt"), F.lit(None).cast("string").alias("class_name"), F.lit(None).cast("string").alias("dom_path"),
        (F.col("event_id") % 1000).alias("width"), (F.col("event_id") % 1300).alias("height"),
    )
    return images.candidates(made).select("page_id", "position", "source_url", "sequence")


_PID = """coalesce(nullif(regexp_extract(url, '(?i)/fr/([0-9]+)', 1), ''), nullif(regexp_extract(url, '(?i)/en/([0-9]+)', 1), ''))"""
_SCROLL = """
    WITH c AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch, hour(ts) AS round, user_id FROM events),
    f AS (SELECT batch, user_id, min(round) AS first FROM c GROUP BY ALL),
    r AS (SELECT DISTINCT batch, round FROM c),
    n AS (SELECT r.batch, r.round, count(f.user_id) AS new FROM r LEFT JOIN f ON f.batch = r.batch AND f.first = r.round GROUP BY ALL),
    k AS (SELECT *, sum(new) OVER w AS cum, sum(CASE WHEN new > 0 THEN 1 ELSE 0 END) OVER w AS island FROM n WINDOW w AS (PARTITION BY batch ORDER BY round)),
    s AS (SELECT *, sum(CASE WHEN new = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY batch, island ORDER BY round) AS streak FROM k),
    t AS (SELECT *, CASE WHEN cum >= 60 THEN 'MAX_PRODUCTS_REACHED' WHEN streak >= 3 THEN 'NO_NEW_PRODUCTS' END AS reason FROM s),
    e AS (SELECT batch, coalesce(min(round) FILTER (reason IS NOT NULL), max(round)) AS stop_round, coalesce(arg_min(reason, round) FILTER (reason IS NOT NULL), 'SCROLL_LIMIT_REACHED') AS stop_reason FROM t GROUP BY batch)
    SELECT e.batch, stop_round, stop_reason, least(count(DISTINCT c.user_id), 60) AS discovered, count(*) FILTER (f.first < c.round) AS duplicates
    FROM e JOIN c ON c.batch = e.batch AND c.round <= e.stop_round JOIN f ON f.batch = c.batch AND f.user_id = c.user_id GROUP BY ALL"""

QUERIES = [
    (url_canonicalize, f"""SELECT page_id, {_PID} AS product_id, CASE WHEN regexp_matches(url, '(?i)/fr/[0-9]') THEN 'https://store.example/fr/' || regexp_extract(url, '(?i)/fr/([0-9]+)', 1)
        WHEN regexp_matches(url, '(?i)/en/[0-9]') THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/en/' || regexp_extract(url, '(?i)/en/([0-9]+)', 1) END AS canonical_url FROM pages"""),
    (url_dedupe_first, f"""SELECT page_id, product_id FROM (SELECT page_id, {_PID} AS product_id, row_number() OVER (PARTITION BY {_PID} ORDER BY page_id) AS rn FROM pages) WHERE rn = 1 OR product_id IS NULL"""),
    (url_duplicate_count, f"SELECT count(*) AS usable, count(DISTINCT {_PID}) AS unique_ids, greatest(0, count({_PID}) - count(DISTINCT {_PID})) AS duplicates FROM pages"),
    (search_url_encode, "SELECT p_partkey, 'https://www.shop.example/search?sword=' || replace(url_encode(p_name), '+', '%20') AS url FROM part"),
    (page_links, """SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS position, replace(unnest(l), '&amp;', '&') AS href FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1) AS l FROM pages)"""),
    (page_images, "SELECT page_id, 0 AS position, '/i/' || page_id || '.png' AS src, 'last' AS alt FROM pages WHERE contains(html, '</body>')"),
    (discovery_order_cap, f"""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, {_PID} AS pid FROM pages),
        f AS (SELECT *, row_number() OVER (PARTITION BY host, pid ORDER BY page_id) AS k FROM p WHERE pid IS NOT NULL),
        o AS (SELECT host, page_id, pid, row_number() OVER (PARTITION BY host ORDER BY page_id) AS discovery_order FROM f WHERE k = 1) SELECT * FROM o WHERE discovery_order <= 20"""),
    (scroll_stop, _SCROLL),
    (category_inputs, """SELECT page_id, (page_id % 3 = 0) <> (page_id % 2 <> 0) AS ok, CASE WHEN page_id % 3 <> 0 THEN 'https://www.shop.example/categories/' || page_id END AS category_url FROM pages"""),
    (image_candidates, """WITH i AS (SELECT user_id AS page_id, event_id AS position, 'https://img.example/' || event_type || '/' || (event_id % 50) || CASE WHEN event_id % 7 = 0 THEN '/detail.jpg' ELSE '/a.jpg' END AS source_url,
            CASE WHEN event_id % 11 = 0 THEN 'logo' ELSE '' END AS alt, event_id % 1000 AS w, event_id % 1300 AS h FROM events),
        k AS (SELECT *, regexp_matches(source_url, 'detail') OR (h >= 900 AND w >= 700) AS pref FROM i
            WHERE NOT (alt = 'logo' OR regexp_matches(lower(source_url), 'review|banner|icon|logo|thumb|recommend|related|sns|share|badge|cart|coupon|member|profile') OR (w < 200 AND h < 200) OR (w > 800 AND h < 120) OR (w <= 160 AND h <= 200)
                OR (regexp_matches(lower(source_url), 'main|hero|cover|recent') AND NOT regexp_matches(source_url, 'detail')))),
        u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY page_id, source_url ORDER BY position) = 1),
        r AS (SELECT *, bool_or(pref) OVER (PARTITION BY page_id) AS any_pref, row_number() OVER (PARTITION BY page_id, pref ORDER BY position) AS rn FROM u)
        SELECT page_id, position, source_url, row_number() OVER (PARTITION BY page_id ORDER BY position) AS sequence FROM r WHERE (any_pref AND pref) OR (NOT any_pref AND rn <= 5)"""),
]

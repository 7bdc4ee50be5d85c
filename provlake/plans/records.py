"""Queries over records: row filters, adapters, image decisions, registration, contracts of nested rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import extract, hashing, merge, urls
from provlake.operators import bundles, dedupe, emission, images, intake, lineage, metadata, publish, summaries
from provlake.operators.contracts import Contract, Rule, issue_rows
from provlake.plans.discovery import table

PEOPLE = ("ann", "bo", "cy")


def _batch(k, n=5):
    """b-<k % n>-<member>"""
    return F.concat_ws("-", F.lit("b"), (F.col(k) % n).cast("string"), F.element_at(F.array(*map(F.lit, (*PEOPLE, "who"))), (F.col(k) % 4 + 1).cast("int")))


def classify_rows(spark, d):
    e = table(spark, d, "events")
    own = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, "b-1").otherwise("b-2")
    rows = e.select("event_id", own.alias("batch_id"),
        F.when(F.col("event_id") % 7 == 0, " ").otherwise(F.concat(F.lit("img/"), (F.col("event_id") % 50).cast("string"))).alias("image_path"))
    checked = table(spark, d, "nation").select(F.concat(F.lit("img/"), "n_nationkey").alias("image_path"))
    return intake.classify_rows(rows, F.lit("b-1"), checked).select("event_id", "action")


def classify_counters(spark, d):
    return summaries.outcome_counters(classify_rows(spark, d).withColumn("batch", F.col("event_id") % 10), "batch", "action",
        {"new": ["CHECK"], "skipped_existing": ["SKIP_EXISTING"]})


def ocr_rows(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", _batch("o_orderkey").alias("batch_id"))
    return intake.ocr_rows(rows, F.lit("ann"), F.when(F.col("o_orderkey") % 2 == 0, F.lit("b-2-cy"))).select("o_orderkey", "mine")


def member_batches(spark, d):
    b = table(spark, d, "orders").select(_batch("o_orderkey").alias("batch_id")).distinct()
    return intake.of_member(b, "ann").withColumn("filter", F.lit("ann")).unionAll(intake.of_member(b, "member-name").withColumn("filter", F.lit("none")))


def platform_ready(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", _batch("o_orderkey").alias("batch_id"))
    return intake.platform_ready(o.select("batch_id").distinct(), o.where("o_orderkey % 5 <> 3"), PEOPLE)


def submission_summaries(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("batch_id"))
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("batch_id"), "o_orderstatus")
    counts = {"open_orders": o.where("o_orderstatus = 'O'"), "filled": o.where("o_orderstatus = 'F'")}
    status = lambda n, s: c.where(f"batch_id % {n} = 0").select("batch_id", F.lit(s).alias("status"))
    return intake.submission_summary(c, "batch_id", counts, status(5, "ACCEPTED"), status(3, "REJECTED"), ["open_orders", "filled"])


def legacy_products(spark, d):
    p = table(spark, d, "part")
    rows = p.select(F.col("p_partkey").cast("string").alias("original_product_id"),
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("product_name_raw"),
        F.when(F.col("p_partkey") % 3 == 0, " ").otherwise(F.col("p_brand")).alias("storage_type"),
                    F.when(F.col("p_partkey") % 5 == 0, "n/a").otherwise((F.col("p_size") / 64).cast("string")).alias("ocr_confidence"),
                        F.col("p_type").alias("shade"))
    a = intake.adapt_products(rows, "run-1", "2026-01-01", "b-ann")
    return a.select("record_id", "source_record_id", "product_name_raw", "storage_type", "ocr_confidence", "bad_confidence",
        F.element_at("extra", "shade").alias("shade"), F.length("content_hash").alias("hash_chars"))


def ocr_blocks(spark, d):
    """Block texts, mean confidence and safe indexing of results whose arrays differ in length."""
    parts = F.array_sort(F.collect_list(F.struct("l_linenumber",
        F.concat(F.lit(" "), "l_returnflag", F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.col("l_linestatus"))).alias("t"),
        F.col("l_quantity").cast("double").alias("q"))))
    o = table(spark, d, "lineitem").groupBy("l_orderkey").agg(parts.alias("x"))
    box = F.array(F.array(F.lit(0.0), F.lit(1.5)), F.array(F.lit(2.0), F.lit(3.0)))
    o = o.select("l_orderkey", F.transform("x", lambda v: v["t"]).alias("texts"), F.transform(F.slice("x", 1, 2), lambda v: v["q"]).alias("scores"),
        F.array(box).alias("polygons"))
    b = emission.blocks("texts", "scores", "polygons")
    return o.select("l_orderkey", F.size(b).alias("n"), emission.joined_text(b).alias("text"), emission.mean_confidence(b).alias("mean_confidence"),
        F.size(F.filter(b, lambda v: v["polygon"].isNotNull())).alias("n_polygons"))


def content_names(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("product_id"), F.col("event_id").alias("position"),
        F.sha2(F.concat_ws(":", "event_type", (F.col("event_id") % 4).cast("string")), 256).alias("sha256"))
    return images.renamed_by_content(e).select("product_id", "position", "sequence", "local_name")


def intake_runs(spark, d):
    n = table(spark, d, "orders")
    return n.select("o_orderkey", hashing.intake_run_id(_batch("o_orderkey"), F.sha2("o_orderpriority", 256)).alias("run_id"),
        hashing.json_path(F.array(F.lit("rows"), F.col("o_orderkey").cast("string"), F.lit("id"))).alias("path"))


def suggested_batches(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", bundles.suggested_batch_id(F.lit("ann"), F.col("ts"), 2).alias("batch_id"),
        bundles.accepted_uris(F.concat(F.lit("b-"), "event_id"))["products"].alias("uri"))


def discovery_labels(spark, d):
    e = table(spark, d, "events")
    mode = F.when(F.col("event_type") == "click", "search").when(F.col("event_type") == "view", "URL_LIST").when(F.col("event_type") == "error",
        " ").otherwise(F.col("event_type"))
    return e.select("event_id", summaries.discovery_label(mode,
        F.when(F.col("event_id") % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit("v"), "user_id"))).alias("label"))


def log_progress(spark, d):
    """Finished items by the log of a step."""
    e = table(spark, d, "events")
    word = F.when(F.col("event_type") == "error", "FAILED: ").when(F.col("event_type") == "click", "OK: ").otherwise("note OK: ")
    logs = e.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id",
        F.concat(word, "event_type").alias("t")))), lambda v: v["t"]), "\n").alias("log"), F.count("*").alias("total"))
    done = summaries.progress_events("collect", "log")
    found = summaries.progress_events("discover", F.concat(F.lit("start\nDiscovered="), F.col("total").cast("string"), F.lit(" items")))
    return logs.select("user_id", done.alias("done"), found.alias("discovered"), summaries.progress_percent(done, "total").alias("percent"))


def product_urls(spark, d):
    """Requested address, id and canonical address as one value; category codes of addresses; link texts."""
    p = table(spark, d, "part").select("p_partkey",
        F.concat(F.lit("https://www.shop.example/goods/"), "p_partkey", F.when(F.col("p_size") % 2 == 0, "?a=b#c").otherwise("")).alias("url"), "p_name")
    rules = urls.UrlRules(goods_path="/goods/", second_path="/none/", second_host="none.example", host="www.shop.example", domain="example",
        categories_path="/categories/")
    u = urls.product_url("url", rules)
    code = urls.category_code(F.concat(F.lit("https://www.shop.example/categories/"), (F.col("p_partkey") % 900).cast("string"), F.lit("?page=2")), rules)
    return p.select("p_partkey", u["product_id"].alias("product_id"), (u["requested_url"] == F.col("url")).alias("as_asked"), code.alias("code"),
        urls.preview_text(F.when(F.col("p_partkey") % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "p_name"))).alias("preview"))


def residues(spark, d):
    """Remains of a label, placeholders, and the first value that is filled."""
    k = F.col("p_partkey") % 5
    p = table(spark, d, "part").withColumn("v",
        F.when(k == 0, "정 보").when(k == 1, "상품설명 및 상품이미지 참조").when(k == 2, "또는 기타").when(k == 3, "").otherwise(F.col("p_name")))
    return p.select("p_partkey", extract.is_residue(F.col("v")).alias("residue"), extract.is_placeholder(F.col("v")).alias("placeholder"),
        extract.first_filled(F.when(k == 2, F.lit("")).otherwise(F.col("v")), "p_brand").alias("filled"))


def same_meaning(spark, d):
    """Two texts of a field compared: normalized, contained, or with the same key words and numbers."""
    k, n = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    p = table(spark, d, "part").withColumn("a", F.concat(F.lit("냉장 "), n, F.lit("℃ 보관하세요")))
    p = p.withColumn("b", F.when(k == 0, F.concat(F.lit("즉시 냉장/"), n, F.lit("도"))).when(k == 1, F.concat(n, F.lit(" 이하 냉장 보관"))).when(k == 2,
        F.lit("")).otherwise(F.concat(F.lit("냉동 "), n)))
    m = merge.merge_field("a", "b")
    return p.select("p_partkey", merge.comparable("a").alias("text"), merge.same_meaning("a", "b").alias("same"), m["source"].alias("source"),
        m["status"].alias("status"))


def image_sizes(spark, d):
    p = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 3000 + 1).cast("int").alias("w"), (F.col("p_size") * 40).cast("int").alias("h"))
    s = images.scaled("w", "h", 1600)
    return p.select("p_partkey", s["width"].alias("width"), s["height"].alias("height"))


def text_presence(spark, d):
    """Image scores decide first; the undecided ones by the text of a first pass."""
    e = table(spark, d, "events")
    img = e.select("event_id", F.when(F.col("event_id") % 9 != 0, F.col("event_id") % 20 / 100.0).alias("score"))
    pre = e.where("event_id % 4 <> 0").select("event_id", (F.col("event_id") % 3).cast("int").alias("n_blocks"),
        F.when(F.col("event_id") % 5 != 0, "text").alias("text"), (F.col("event_id") % 10 / 10.0).alias("confidence"))
    return images.text_presence(img, pre, "event_id").select("event_id", "text_presence", "detect_method", "notes")


def relative_images(spark, d):
    """Addresses of images as seen from their page."""
    k = F.col("page_id") % 5
    src = F.when(k == 0, "a/b.jpg").when(k == 1, "/c/../d.jpg?x=1").when(k == 2, "//cdn.example/e.jpg#f").when(k == 3,
        "../up.jpg").otherwise("data:image/png;base64,AA")
    return table(spark, d, "pages").select("page_id",
        urls.image_url(src, F.concat(F.lit("https://h.example/p/q/"), F.col("page_id").cast("string"), F.lit("?z"))).alias("url"))


def image_elements(spark, d):
    """Image elements of pages, one for each document, with position and address."""
    from provlake.sources.html import Images

    doc = table(spark, d, "documents").select("doc_id",
        F.concat(F.lit("<html><body><div class='g'><img src='/i/"), F.col("doc_id").cast("string"),
        F.lit(".jpg' alt='one'></div><p>x</p><img data-src='b.png' width='10'></body></html>")).alias("html"))
    return doc.lateralJoin(Images(F.col("html").outer())).select("doc_id", "position", "src", "alt", "dom_path", "width")


def page_probe(spark, d):
    """Title, value of a label in a definition list, and body text of a page."""
    from provlake.sources.html import page_udf

    n = table(spark, d, "part").select("p_partkey",
        F.concat(F.lit("<html><head><title>T | site</title></head><body><h1>"), "p_name", F.lit("</h1><dl><dt>중량</dt><dd>"),
        F.col("p_size").cast("string"), F.lit("g</dd></dl></body></html>")).alias("html"))
    return n.select("p_partkey", page_udf(["용량", "중량"])("html").alias("r")).select("p_partkey", "r.title", "r.value", "r.text")


def ancestor_artifacts(spark, d):
    c = table(spark, d, "conversations")
    key = lambda t: F.concat_ws("-", F.col("conv_id").cast("string"), t.cast("string"))
    edges = c.where("turn > 0").select(key(F.col("turn") - 1).alias("parent"), key(F.col("turn")).alias("child"), F.col("role").alias("relation"))
    made = c.where("role = 'user'").select(key(F.col("turn")).alias("artifact_id"), F.length("text").alias("chars"))
    found = lineage.ancestors(spark, edges, edges.select(F.col("child").alias("root")))
    return lineage.ancestor_artifacts(found, made).select("root", "ancestor", "depth", "chars")


def _manifests(spark, d):
    n = table(spark, d, "nation").withColumn("batch_id", F.concat(F.lit("b-ann-"), "n_nationkey"))
    status = F.when(F.col("n_nationkey") % 4 == 0, "REJECTED").otherwise("ACCEPTED")
    body = F.to_json(F.struct(F.when(F.col("n_nationkey") % 7 == 0, "bo").otherwise("ann").alias("member"), status.alias("status"),
        F.col("n_regionkey").cast("int").alias("row_count"), F.lit("1.0.0").alias("schema_version")))
    raw = n.select("n_nationkey", "batch_id", F.when(F.col("n_nationkey") % 5 == 0, "[]").otherwise(body).alias("payload"))
    return bundles.accepted_manifests(raw.withColumns({"sha256": F.sha2("payload", 256), "size": F.length("payload").cast("long")}))


def accepted_manifests(spark, d):
    return _manifests(spark, d).select("batch_id", "member", "issue", "row_count", "schema_version")


def register_accepted(spark, d):
    """Rows of the tables that registration adds, first and when it is repeated."""
    m = _manifests(spark, d)
    files = m.select("batch_id", F.explode(F.array(*[F.struct(F.lit(n).alias("logical_name"), F.lit(f"{n}.{x}").alias("path"), c.alias("sha256"),
        F.col("size")) for n, x, c in (("manifest", "json", F.col("checksum")),
        ("products", "csv", F.sha2("batch_id", 256)))])).alias("f")).select("batch_id", "f.*")
    none = m.where("false").select(F.lit("").alias("run_id"))
    new = bundles.register_accepted(m, files, none)
    again = bundles.register_accepted(m, files, new["runs"])
    count = lambda t, name, call: t.agg(F.count("*").alias("n")).select(F.lit(call).alias("call"), F.lit(name).alias("added"), "n")
    out = [count(t, name, call) for call, tables in (("first", new), ("again", again)) for name, t in tables.items()]
    out.append(count(bundles.manifest_artifact(new["artifacts"]), "manifest_artifact", "first"))
    return dedupe.failures(*out)


def run_triggers(spark, d):
    r = table(spark, d, "nation").select(F.col("n_name").alias("run_id"))
    return metadata.with_trigger(r, "sensor", "logs/runs")


NESTED = Contract("order_lines", [
    Rule("o_orderkey", minimum=1), Rule("o_totalprice", type="integer"),
    Rule("buyer", fields=(Rule("c_name", min_length=1), Rule("c_acctbal", minimum=0))),
    Rule("lines", items=Rule("", fields=(Rule("l_linenumber", maximum=6), Rule("l_returnflag", enum=("A", "N"))))),
], closed=False)


def nested_contract(spark, d):
    """Types, structs inside rows, and elements of arrays, with paths down to the value."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber",
        "l_returnflag"))).alias("lines"))
    buyer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.struct("c_name", "c_acctbal").alias("buyer"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey",
        F.when(F.col("o_orderkey") % 2 == 0,
        F.col("o_totalprice").cast("long").cast("string")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"))
    return issue_rows(o.join(buyer, "o_custkey").join(lines, "o_orderkey"), NESTED, ["o_orderkey"])


def expiry_axes(spark, d):
    """Expiration texts with tags, units and bases as value, unit and basis."""
    k = F.col("p_partkey") % 6
    n = F.col("p_size").cast("string")
    text = F.when(k == 0, F.concat(F.lit("<b>제조일로부터</b>&nbsp;"), n, F.lit(" 일"))).when(k == 1,
        F.concat(F.lit("packed: "), n, F.lit(" months"))).when(k == 2, F.concat(F.lit("수령 후 "), n, F.lit("시간"))).when(k == 3,
        F.concat(n, F.lit(".5 weeks"))).when(k == 4, F.lit("see package")).otherwise(F.lit(" "))
    p = table(spark, d, "part").select("p_partkey", publish.clean_text(text).alias("text"), publish.expiration_parts(text).alias("e"),
        publish.storage_enum(F.when(k < 3, "room_temperature").otherwise("frozen?")).alias("storage"))
    return p.select("p_partkey", "text", F.col("e.value").alias("value"), F.col("e.unit").alias("unit"), F.col("e.basis").alias("basis"), "storage")


_MEM = "CASE {0} % 4 WHEN 0 THEN 'ann' WHEN 1 THEN 'bo' WHEN 2 THEN 'cy' ELSE 'who' END"
_B = "'b-' || ({0} % 5) || '-' || " + _MEM
_BO = _B.format("o_orderkey")
_CLASSIFY = """SELECT event_id, CASE WHEN event_id % 50 < 25 THEN 'SKIP_EXISTING' ELSE 'CHECK' END AS action FROM events WHERE event_id % 7 <> 0 AND event_id % 3 <> 2"""
_K = "p_partkey % 5"
_MAN = """SELECT n_nationkey AS k, 'b-ann-' || n_nationkey AS batch_id, CASE WHEN n_nationkey % 5 = 0 THEN 'ACCEPTED_MANIFEST_INVALID' WHEN n_nationkey % 7 = 0 THEN 'ACCEPTED_MANIFEST_INVALID' WHEN n_nationkey % 4 = 0 THEN 'NOT_ACCEPTED' END AS issue, n_regionkey FROM nation"""

QUERIES = [
    (classify_rows, _CLASSIFY),
    (classify_counters, f"SELECT event_id % 10 AS batch, count(*) FILTER (action = 'CHECK') AS new, count(*) FILTER (action <> 'CHECK') AS skipped_existing FROM ({_CLASSIFY}) GROUP BY 1"),
    (ocr_rows, f"SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN {_BO} = 'b-2-cy' ELSE o_orderkey % 4 = 0 END AS mine FROM orders"),
    (member_batches, f"WITH b AS (SELECT DISTINCT {_BO} AS batch_id FROM orders) SELECT batch_id, 'ann' AS filter FROM b WHERE contains(batch_id, 'ann') UNION ALL SELECT batch_id, 'none' FROM b"),
    (platform_ready, f"SELECT DISTINCT {_BO} AS batch_id, {_MEM.format('o_orderkey')} AS owner FROM orders WHERE o_orderkey % 4 <> 3 AND o_orderkey % 5 <> 3"),
    (submission_summaries, """WITH n AS (SELECT c_custkey AS batch_id, count(*) FILTER (o_orderstatus = 'O') AS open_orders, count(*) FILTER (o_orderstatus = 'F') AS filled FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
        SELECT *, CASE WHEN batch_id % 5 = 0 THEN 'ACCEPTED' WHEN batch_id % 3 = 0 THEN 'REJECTED' WHEN open_orders > 0 AND filled > 0 THEN 'READY' ELSE 'INCOMPLETE' END AS status FROM n"""),
    (legacy_products, """SELECT 'b-ann:SHOP:' || p_partkey AS record_id, 'SHOP:' || p_partkey AS source_record_id, p_name AS product_name_raw, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS storage_type,
        CASE WHEN p_partkey % 5 <> 0 THEN p_size / 64.0::DOUBLE END AS ocr_confidence, p_partkey % 5 = 0 AS bad_confidence, p_type AS shade, 64 AS hash_chars FROM part"""),
    (ocr_blocks, """WITH x AS (SELECT l_orderkey, l_linenumber, l_returnflag || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_linestatus END AS t, CAST(l_quantity AS DOUBLE) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_linestatus END, l_quantity) AS k FROM lineitem)
        SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n, string_agg(t, chr(10) ORDER BY k) AS text, avg(q) FILTER (k <= 2) AS mean_confidence, 1 AS n_polygons FROM x GROUP BY 1"""),
    (content_names, """WITH e AS (SELECT user_id, event_id, sha256(event_type || ':' || (event_id % 4)) AS h FROM events), f AS (SELECT user_id, h, min(event_id) AS event_id FROM e GROUP BY 1, 2),
        s AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS n FROM f) SELECT user_id AS product_id, event_id AS position, n AS sequence, user_id || '_' || CASE WHEN n < 10 THEN '0' ELSE '' END || n || '_' || left(h, 12) || '.jpg' AS local_name FROM s"""),
    (intake_runs, f"SELECT o_orderkey, 'collection-intake:' || {_BO} || ':' || left(sha256(o_orderpriority), 16) AS run_id, '$.rows[' || o_orderkey || '].id' AS path FROM orders"),
    (suggested_batches, "SELECT event_id, strftime(CAST(ts AS TIMESTAMP) + INTERVAL 9 HOUR, '%Y%m%d') || '-ann-002' AS batch_id, 'inbox/accepted/b-' || event_id || '/products.csv' AS uri FROM events"),
    (discovery_labels, """SELECT event_id, CASE event_type WHEN 'error' THEN '-' ELSE CASE event_type WHEN 'click' THEN 'search' WHEN 'view' THEN 'URL list' ELSE upper(event_type) END || CASE WHEN event_id % 4 <> 0 THEN ': v' || user_id ELSE '' END END AS label FROM events"""),
    (log_progress, """WITH n AS (SELECT user_id, count(*) FILTER (event_type IN ('error', 'click')) AS k, count(*) AS t FROM events GROUP BY 1) SELECT user_id, CAST(k AS INTEGER) AS done, CAST(t AS INTEGER) AS discovered, CAST(round_even(100.0 * k / t, 0) AS INTEGER) AS percent FROM n"""),
    (product_urls, "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS product_id, true AS as_asked, CAST(p_partkey % 900 AS VARCHAR) AS code, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS preview FROM part"),
    (residues, f"SELECT p_partkey, {_K} IN (0, 2) AS residue, {_K} = 1 AS placeholder, CASE {_K} WHEN 0 THEN '정 보' WHEN 1 THEN '상품설명 및 상품이미지 참조' WHEN 4 THEN p_name ELSE p_brand END AS filled FROM part"),
    (same_meaning, "SELECT p_partkey, '냉장' || p_size || '도보관' AS text, p_partkey % 4 < 2 AS same, CASE WHEN p_partkey % 4 < 2 THEN 'DOM_AND_OCR' ELSE 'DOM' END AS source, CASE WHEN p_partkey % 4 <> 3 THEN 'MATCHED' ELSE 'REVIEW_REQUIRED' END AS status FROM part"),
    (image_sizes, """WITH s AS (SELECT p_partkey, p_partkey % 3000 + 1 AS w, p_size * 40 AS h, greatest(p_partkey % 3000 + 1, p_size * 40) AS m FROM part)
        SELECT p_partkey, CAST(CASE WHEN m <= 1600 THEN w ELSE greatest(1, (w * 1600) // m) END AS INTEGER) AS width, CAST(CASE WHEN m <= 1600 THEN h ELSE greatest(1, (h * 1600) // m) END AS INTEGER) AS height FROM s"""),
    (text_presence, """WITH e AS (SELECT event_id, event_id % 9 = 0 AS missing, event_id % 20 AS s, event_id % 4 <> 0 AS pre, event_id % 3 AS n, event_id % 5 <> 0 AS t, event_id % 10 AS c FROM events)
        SELECT event_id, CASE WHEN missing THEN 'UNKNOWN' WHEN s < 4 THEN 'NO_TEXT' WHEN s > 12 THEN 'HAS_TEXT' WHEN NOT pre THEN 'UNKNOWN' WHEN n >= 2 AND c >= 5 THEN 'HAS_TEXT' WHEN n = 0 OR NOT t THEN 'NO_TEXT' WHEN c >= 5 THEN 'HAS_TEXT' ELSE 'UNKNOWN' END AS text_presence,
        CASE WHEN NOT missing AND s BETWEEN 4 AND 12 AND pre THEN 'PREPASS' ELSE 'HEURISTIC' END AS detect_method, CASE WHEN missing THEN 'image missing' WHEN s BETWEEN 4 AND 12 AND NOT pre THEN 'undecided' END AS notes FROM e"""),
    (relative_images, "SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'https://h.example/p/q/a/b.jpg' WHEN 1 THEN 'https://h.example/d.jpg?x=1' WHEN 2 THEN 'https://cdn.example/e.jpg' WHEN 3 THEN 'https://h.example/p/up.jpg' END AS url FROM pages"),
    (image_elements, "SELECT doc_id, 0 AS position, '/i/' || doc_id || '.jpg' AS src, 'one' AS alt, 'html>body>div>img' AS dom_path, NULL AS width FROM documents UNION ALL SELECT doc_id, 1, 'b.png', NULL, 'html>body>img', '10' FROM documents"),
    (page_probe, "SELECT p_partkey, p_name AS title, p_size || 'g' AS value, p_name || chr(10) || '중량' || chr(10) || p_size || 'g' AS text FROM part"),
    (ancestor_artifacts, """SELECT a.conv_id || '-' || a.turn AS root, b.conv_id || '-' || b.turn AS ancestor, CAST(a.turn - b.turn AS INTEGER) AS depth, CAST(length(b.text) AS INTEGER) AS chars FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn < a.turn WHERE b.role = 'user'"""),
    (accepted_manifests, f"SELECT batch_id, CASE WHEN k % 5 <> 0 THEN CASE WHEN k % 7 = 0 THEN 'bo' ELSE 'ann' END END AS member, issue, CASE WHEN k % 5 <> 0 THEN n_regionkey ELSE 0 END AS row_count, CASE WHEN k % 5 <> 0 THEN '1.0.0' END AS schema_version FROM ({_MAN})"),
    (register_accepted, f"WITH g AS (SELECT count(*) AS n FROM ({_MAN}) WHERE issue IS NULL) SELECT 'first' AS call, unnest(['runs', 'steps', 'artifacts', 'edges', 'manifest_artifact']) AS added, unnest([n, n, 2 * n, n, n]) AS n FROM g UNION ALL SELECT 'again', unnest(['runs', 'steps', 'artifacts', 'edges']), 0"),
    (run_triggers, "SELECT n_name AS run_id, 'sensor' AS trigger, 'logs/runs/' || n_name || '.log' AS log_path FROM nation"),
    (nested_contract, """WITH o AS (SELECT * FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)), l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag) - 1 AS i FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
        SELECT o_orderkey, '$.o_orderkey' AS path, 'MINIMUM' AS code FROM o WHERE o_orderkey < 1 UNION ALL SELECT o_orderkey, '$.o_totalprice', 'TYPE' FROM o WHERE o_orderkey % 2 <> 0
        UNION ALL SELECT o_orderkey, '$.buyer.c_acctbal', 'MINIMUM' FROM o WHERE c_acctbal < 0 UNION ALL SELECT l_orderkey, '$.lines[' || i || '].l_linenumber', 'MAXIMUM' FROM l WHERE l_linenumber > 6
        UNION ALL SELECT l_orderkey, '$.lines[' || i || '].l_returnflag', 'ENUM' FROM l WHERE l_returnflag NOT IN ('A', 'N')"""),
    (expiry_axes, """WITH p AS (SELECT p_partkey, p_partkey % 6 AS k, p_size AS s FROM part) SELECT p_partkey, CASE k WHEN 0 THEN '제조일로부터 ' || s || ' 일' WHEN 1 THEN 'packed: ' || s || ' months' WHEN 2 THEN '수령 후 ' || s || '시간' WHEN 3 THEN s || '.5 weeks' WHEN 4 THEN 'see package' END AS text,
        CASE WHEN k < 3 THEN CAST(s AS DOUBLE) WHEN k = 3 THEN s + 0.5::DOUBLE END AS value, CASE k WHEN 0 THEN 'DAY' WHEN 1 THEN 'MONTH' WHEN 2 THEN 'HOUR' WHEN 3 THEN 'WEEK' END AS unit,
        CASE k WHEN 0 THEN 'MANUFACTURE' WHEN 1 THEN 'PACKAGING' WHEN 2 THEN 'RECEIPT' WHEN 3 THEN 'UNKNOWN' WHEN 4 THEN 'PACKAGING' END AS basis, CASE WHEN k < 3 THEN 'ROOM' ELSE 'UNKNOWN' END AS storage FROM p"""),
]

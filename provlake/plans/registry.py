"""Queries over contracts, hashes, runs, lineage and published rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import hashing, text
from provlake.operators import bundles, contracts, emission, intake, lineage, metadata, publish, summaries
from provlake.operators.contracts import Contract, Rule
from provlake.plans.discovery import table
from provlake.streaming.sensor import new_batches

#: Values by row, in words that Spark and the SQL read alike.
VERSION = "CASE o_orderkey % 8 WHEN 0 THEN '1.0.0' WHEN 1 THEN concat(o_custkey % 3, '.', o_orderkey % 7) WHEN 2 THEN '' WHEN 3 THEN 'x.1' WHEN 5 THEN '1' WHEN 6 THEN concat('0.9.', o_custkey) WHEN 7 THEN '1.b' END"
BATCH = """CASE o_orderkey % 6 WHEN 0 THEN concat('2026-ann-', o_custkey) WHEN 1 THEN concat('2026-annie-', o_custkey) WHEN 2 THEN '-bad' WHEN 3 THEN concat(o_custkey, '-bo-002')
    WHEN 4 THEN 'a--ann' ELSE '20260801-ann-002' END"""
MEMBER = "CASE o_custkey % 4 WHEN 0 THEN 'b o' WHEN 1 THEN '' WHEN 2 THEN 'bo' ELSE 'ann' END"
FILES = "concat(" + ", ".join(f"CASE WHEN o_custkey % {i + 2} = 0 THEN '{n},' ELSE '' END" for i, n in enumerate(intake.REQUIRED_FILES)) + ")"
_SECONDS = "yyyy-MM-dd HH:mm:ss"
STATES = ("PENDING", "RUNNING", "SUCCEEDED", "FAILED", "RUNNING")


def version_gate(spark, d):
    v = table(spark, d, "orders").selectExpr("o_orderkey AS id", f"{VERSION} AS v")
    return v.select("id", hashing.version_issue("v").alias("issue"), hashing.schema_version("v")["major"].alias("major"))


def _order_contract() -> Contract:
    rules = [Rule("o_orderkey", minimum=1), Rule("o_custkey", maximum=1400), Rule("o_orderstatus", enum=("O", "F")),
        Rule("o_totalprice", minimum=1000, maximum=400000), Rule("o_orderpriority", pattern="^[1-4]", min_length=6)]
    return Contract("orders", rules, closed=False)


def contract_issues(spark, d):
    return contracts.issue_rows(table(spark, d, "orders"), _order_contract(), ["o_orderkey"])


def content_hash(spark, d):
    return table(spark, d, "nation").select("n_nationkey", hashing.content_hash(["n_nationkey", "n_name", "n_regionkey"]).alias("content_hash"))


def bundle_checksum(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("name"),
        F.sha2(F.col("o_orderstatus"), 256).alias("sha256"))
    return hashing.bundle_checksum(o, ["o_custkey"])


def submission_nest(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag")
    n = intake.nest(table(spark, d, "orders").select("o_orderkey"), lines, "o_orderkey", "l_linenumber", ["l_returnflag"])
    return n.select("o_orderkey", F.size("products").alias("n"), F.array_join(F.transform("products", lambda p: p["l_returnflag"]), "").alias("flags"))


def required_files(spark, d):
    f = table(spark, d, "orders").selectExpr("o_orderkey AS id", f"{FILES} AS files")
    return f.select("id", F.array_join(F.array_sort(intake.missing_files(text.id_list("files"))), ",").alias("missing"))


def member_ownership(spark, d):
    b = table(spark, d, "orders").selectExpr("o_orderkey AS id", f"{BATCH} AS batch", f"{MEMBER} AS member")
    return b.select("id", intake.owned_by("batch", "member").alias("owned"), intake.owner("batch", ["bo", "ann"]).alias("owner"),
        intake.identity_error("batch", "member").alias("error"))


def submit_decision(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", intake.decide(
        F.when(F.col("o_orderkey") % 7 == 0, "INVALID_MEMBER"),
            F.when(F.col("o_orderkey") % 5 == 0, F.array(F.lit("products.csv"))).otherwise(F.array().cast("array<string>")), F.lit(0),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")), F.lit("F")).alias("decision"))


def run_upsert(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("run_id"), "event_id", F.col("event_type").alias("code"))
    first = e.groupBy("run_id").agg(F.min_by("code", "event_id").alias("code"))
    new = e.groupBy("run_id").agg(F.max_by("code", "event_id").alias("code"))
    return metadata.insert_or_return(first.where(F.col("run_id").cast("long") % 2 == 0), new, "run_id", ["code"])


def quality_upsert(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "event_id", F.col("event_id").alias("quality_id"), F.round("value", 4).alias("value"))
    return metadata.keep_first_id(e, ["user_id", "event_type"], "event_id", "quality_id").select("user_id", "event_type", "quality_id", "value")


def artifact_register(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    old = e.where("event_id % 4 = 0").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    new = e.where("event_id % 4 <> 0").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    return metadata.insert_missing(old.select("event_id", "user_id", "event_type"), new.select("event_id", "user_id", "event_type"), ["user_id", "event_type"])


def artifact_uuid5(spark, d):
    return table(spark, d, "nation").select("n_nationkey",
        hashing.artifact_id(F.lit("run"), "n_name", F.col("n_regionkey").cast("string")).alias("artifact_id"))


def _states(spark, d):
    state = F.element_at(F.array(*map(F.lit, STATES)), (F.col("event_id") % len(STATES) + 1).cast("int"))
    return table(spark, d, "events").select("user_id", "event_id", "ts", state.alias("status"))


def status_transitions(spark, d):
    return metadata.checked_transitions(_states(spark, d), "user_id", "event_id", "status").select("user_id", "event_id", "status", "previous", "valid")


def run_states(spark, d):
    s = metadata.current_state(_states(spark, d), "user_id", "event_id", "status", "ts")
    return s.select("user_id", "status", F.date_format("started_at", _SECONDS).alias("started_at"), F.date_format("finished_at", _SECONDS).alias("finished_at"))


def _edges(spark, d):
    c = table(spark, d, "conversations")
    key = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    return c.where("turn > 0").select(key(F.col("turn") - 1).alias("parent"), key(F.col("turn")).alias("child"), F.col("role").alias("relation"))


def lineage_ancestors(spark, d):
    e = _edges(spark, d)
    return lineage.ancestors(spark, e, e.select(F.col("child").alias("root")))


def lineage_cycle(spark, d):
    e = _edges(spark, d)
    proposed = e.select(F.col("child").alias("parent"),
        F.col("parent").alias("child")).unionAll(e.select("parent", F.concat("child", F.lit("x")).alias("child")))
    return lineage.would_cycle(spark, e, proposed)


def run_snapshot(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    s = metadata.snapshot(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", orders=(o, ["o_orderkey", "o_orderstatus"]))
    return s.select("o_custkey", F.size("orders").alias("n"), F.array_join(F.transform("orders", lambda v: v["o_orderstatus"]), "").alias("statuses"))


def recent_runs(spark, d):
    return metadata.recent(table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", _SECONDS).alias("placed")), "placed", "o_orderkey", 50)


def sensor_new(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("batch_id"), "event_type")
    return new_batches(e.where("event_type = 'click'"), e.where("event_type = 'purchase' AND batch_id % 3 = 0").distinct())


def progress_events(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.regexp_count("text", F.lit("(?m)^(The|In|And) ")).alias("done"),
        summaries.progress_percent(F.col("doc_id") % 300, F.when(F.col("doc_id") % 4 != 0, F.lit(200))).alias("percent"))


def csv_profile(spark, d):
    e = table(spark, d, "events").select("user_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).otherwise(" ").alias("schema_version"))
    return summaries.csv_profile(e, "user_id")


def migrations(spark, d):
    n = table(spark, d, "nation")
    found = n.select(F.col("n_name").alias("version"), F.sha2("n_name", 256).alias("checksum"))
    applied = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("version"),
        F.when(F.col("n_nationkey") % 6 == 0, "old").otherwise(F.sha2("n_name", 256)).alias("checksum"))
    return metadata.migrations_to_apply(found, applied)


def reconcile_tiers(spark, d):
    p = table(spark, d, "part")
    products = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 4 == 0, F.col("p_partkey")).alias("code"), "p_name", "p_brand")
    reference = p.where("p_partkey % 6 <> 1").select(F.col("p_partkey").alias("reference_id"),
        F.when(F.col("p_partkey") % 8 == 0, F.col("p_partkey")).alias("code"),
        F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, "s").otherwise("")).alias("p_name"), "p_brand")
    return publish.reconcile(products, reference, "code", "p_name", "p_brand").select("product_id", "reference_id", "match_type", "distance", "review_status")


_RULES = {"quantity": "l_quantity <= 45", "discount": "l_discount < 0.09", "tax": "l_tax > 0"}


def quality_pass_rate(spark, d):
    lines = table(spark, d, "lineitem").withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    r = publish.pass_rates(lines, {n: F.expr(c) for n, c in _RULES.items()}, "k")
    return r.select("rule", "checked", "failed", "pass_rate", F.array_join(F.transform("sample", lambda v: v.cast("string")), ",").alias("sample"))


def quarantine_split(spark, d):
    q = publish.quarantine(table(spark, d, "lineitem"), {n: F.expr(c) for n, c in _RULES.items()})
    return q.groupBy("outcome", "reason").agg(F.count("*").alias("n"))


def gold_publish(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("external_product_id"), F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") > 25, "AUTO_APPROVED").otherwise("REVIEW_REQUIRED").alias("review_status"))
    return publish.publish(p, ["external_product_id", "product_name", "review_status"], "v1")


def validate_batches(spark, d):
    """Suppliers as batches, their parts' lines as files."""
    s = table(spark, d, "supplier").select(F.concat_ws("-", F.lit("b"), F.col("s_suppkey").cast("string"),
        F.when(F.col("s_suppkey") % 3 == 0, "bo").otherwise("ann")).alias("batch_id"), "s_suppkey")
    batches = s.select("batch_id", F.lit("ann").alias("member"))
    names = F.explode(F.array(*map(F.lit, intake.REQUIRED_FILES)))
    files = s.select("batch_id", "s_suppkey",
        names.alias("name")).where((F.col("s_suppkey") % 7 != 0) | (F.col("name") != "products.csv")).select("batch_id", "name",
        F.sha2("name", 256).alias("sha256"))
    issues = s.where("s_suppkey % 5 = 0").select("batch_id")
    accepted = s.where("s_suppkey % 4 = 0").select("batch_id", F.lit("other").alias("bundle_checksum"))
    return bundles.validate_batches(batches, files, issues, accepted).drop("bundle_checksum")


def emission_outcomes(spark, d):
    e = table(spark, d, "events")
    rows = e.select(
        F.lit("b").alias("batch_id"), F.col("event_id").alias("position"), F.lit("S").alias("site"), F.col("user_id").cast("string").alias("pid"),
        F.when(F.col("event_id") % 4 != 0, "i.jpg").alias("image_path"), F.sha2((F.col("event_id") % 3).cast("string"), 256).alias("digest"),
        F.when(F.col("event_id") % 5 < 3, "유통기한 3일").otherwise("none").alias("gate_text"), F.when(F.col("event_id") % 7 != 0, "유통기한 3일").alias("ocr_text"),
        F.when(F.col("event_id") % 2 == 0, "3일").alias("expiration_dom"), F.lit(None).cast("string").alias("storage_dom"),
    )
    known = e.where("user_id % 9 = 0").select(F.concat(F.lit("S:"), F.col("user_id").cast("string"), F.lit(":"),
        F.sha2(F.lit("1"), 256)).alias("key")).distinct()
    known = known.unionAll(e.where("user_id % 11 = 0").select(F.concat(F.lit("S:"), F.col("user_id").cast("string")).alias("key")).distinct())
    return emission.emit(rows, known).select("position", "outcome")


_EDGE = "SELECT conv_id || '-' || (turn - 1) AS parent, conv_id || '-' || turn AS child, role AS relation FROM conversations WHERE turn > 0"
_STATE = "['PENDING', 'RUNNING', 'SUCCEEDED', 'FAILED', 'RUNNING'][event_id % 5 + 1]"
_H = "sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('run:' || n_name || ':' || n_regionkey))"
_FLAT = " UNION ALL ".join(f"SELECT '{n}' AS rule, l_orderkey * 10 + l_linenumber AS k, {c} AS ok FROM lineitem" for n, c in _RULES.items())

QUERIES = [
    (version_gate, f"""WITH v AS (SELECT id, v, string_split(coalesce(v, ''), '.') AS p FROM (SELECT o_orderkey AS id, {VERSION} AS v FROM orders)),
        m AS (SELECT id, v, TRY_CAST(p[1] AS INTEGER) AS a, TRY_CAST(coalesce(p[2], '0') AS INTEGER) AS b FROM v)
        SELECT id, CASE WHEN coalesce(trim(v), '') = '' THEN 'MISSING_SCHEMA_VERSION' WHEN a IS NULL OR b IS NULL THEN 'INVALID_SCHEMA_VERSION' WHEN a <> 1 THEN 'UNSUPPORTED_SCHEMA_VERSION' END AS issue, CASE WHEN coalesce(trim(v), '') <> '' AND b IS NOT NULL THEN a END AS major FROM m"""),
    (contract_issues, """SELECT o_orderkey, '$.o_custkey' AS path, 'MAXIMUM' AS code FROM orders WHERE o_custkey > 1400
        UNION ALL SELECT o_orderkey, '$.o_orderstatus', 'ENUM' FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
        UNION ALL SELECT o_orderkey, '$.o_totalprice', 'MINIMUM' FROM orders WHERE o_totalprice < 1000 UNION ALL SELECT o_orderkey, '$.o_totalprice', 'MAXIMUM' FROM orders WHERE o_totalprice > 400000
        UNION ALL SELECT o_orderkey, '$.o_orderkey', 'MINIMUM' FROM orders WHERE o_orderkey < 1
        UNION ALL SELECT o_orderkey, '$.o_orderpriority', 'PATTERN' FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-4]') UNION ALL SELECT o_orderkey, '$.o_orderpriority', 'MIN_LENGTH' FROM orders WHERE length(o_orderpriority) < 6"""),
    (content_hash, "SELECT n_nationkey, sha256(CAST(to_json({'n_name': n_name, 'n_nationkey': n_nationkey, 'n_regionkey': n_regionkey}) AS VARCHAR)) AS content_hash FROM nation"),
    (bundle_checksum, "SELECT o_custkey, sha256(string_agg(lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || chr(0) || sha256(o_orderstatus) || chr(10), '' ORDER BY o_orderkey)) AS bundle_checksum FROM orders GROUP BY 1"),
    (submission_nest, "SELECT o_orderkey, CAST(count(l_orderkey) AS INTEGER) AS n, coalesce(string_agg(l_returnflag, '' ORDER BY l_linenumber, l_returnflag), '') AS flags FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"),
    (required_files, f"""WITH f AS (SELECT o_orderkey AS id, {FILES} AS files FROM orders), r AS (SELECT unnest(['discovered_products.csv', 'crawled_products.csv', 'image_text_check.csv', 'products.csv']) AS name)
        SELECT id, coalesce(string_agg(name, ',' ORDER BY name) FILTER (NOT list_contains(string_split(files, ','), name)), '') AS missing FROM f, r GROUP BY 1"""),
    (member_ownership, f"""WITH b AS (SELECT *, list_filter(string_split(batch, '-'), lambda x: x <> '') AS p FROM (SELECT o_orderkey AS id, {BATCH} AS batch, {MEMBER} AS member FROM orders))
        SELECT id, member <> '' AND list_contains(p, member) AS owned, CASE WHEN list_contains(p, 'bo') THEN 'bo' WHEN list_contains(p, 'ann') THEN 'ann' END AS owner,
        CASE WHEN NOT regexp_matches(batch, '^[A-Za-z0-9][A-Za-z0-9_-]*$') THEN 'INVALID_BATCH_ID' WHEN NOT regexp_matches(member, '^[A-Za-z0-9_]+$') THEN 'INVALID_MEMBER' WHEN NOT list_contains(p, member) THEN 'BATCH_MEMBER_MISMATCH' END AS error FROM b"""),
    (submit_decision, "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 THEN 'REJECTED' WHEN o_orderkey % 3 = 0 AND o_orderstatus <> 'F' THEN 'CONFLICT' WHEN o_orderkey % 3 = 0 THEN 'DUPLICATE' ELSE 'ACCEPTED' END AS decision FROM orders"),
    (run_upsert, """WITH r AS (SELECT CAST(user_id AS VARCHAR) AS run_id, user_id, arg_min(event_type, event_id) AS a, arg_max(event_type, event_id) AS b FROM events GROUP BY user_id)
        SELECT run_id, b AS code, CASE WHEN user_id % 2 <> 0 THEN 'INSERTED' WHEN a = b THEN 'RETURNED' ELSE 'CONFLICT' END AS outcome FROM r"""),
    (quality_upsert, "SELECT user_id, event_type, min(event_id) AS quality_id, round(arg_max(value, event_id), 4) AS value FROM events GROUP BY 1, 2"),
    (artifact_register, """WITH o AS (SELECT min(event_id) AS event_id, user_id, event_type FROM events WHERE event_id % 4 = 0 GROUP BY 2, 3), n AS (SELECT min(event_id) AS event_id, user_id, event_type FROM events WHERE event_id % 4 <> 0 GROUP BY 2, 3)
        SELECT * FROM o UNION ALL SELECT * FROM n WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM o)"""),
    (artifact_uuid5, f"""SELECT n_nationkey, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || '89ab'[(strpos('0123456789abcdef', h[17]) - 1) % 4 + 1] || h[18:20] || '-' || h[21:32] AS artifact_id FROM (SELECT n_nationkey, {_H} AS h FROM nation)"""),
    (status_transitions, f"""WITH s AS (SELECT user_id, event_id, {_STATE} AS status FROM events), p AS (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM s)
        SELECT *, CASE WHEN previous IS NULL THEN status = 'PENDING' ELSE status = previous OR (previous = 'PENDING' AND status IN ('RUNNING', 'CANCELLED')) OR (previous = 'RUNNING' AND status IN ('SUCCEEDED', 'FAILED', 'PARTIAL', 'CANCELLED')) END AS valid FROM p"""),
    (run_states, f"""WITH s AS (SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, {_STATE} AS status FROM events)
        SELECT user_id, arg_max(status, event_id) AS status, min(ts) FILTER (status = 'RUNNING') AS started_at, min(ts) FILTER (status IN ('SUCCEEDED', 'FAILED')) AS finished_at FROM s GROUP BY 1"""),
    (lineage_ancestors, f"""WITH RECURSIVE e AS ({_EDGE}), up(root, ancestor, child, relation, depth) AS (SELECT child, parent, child, relation, 1 FROM e
        UNION ALL SELECT u.root, e.parent, e.child, e.relation, u.depth + 1 FROM up u JOIN e ON e.child = u.ancestor) SELECT DISTINCT root, ancestor, child, relation, depth FROM up"""),
    (lineage_cycle, f"WITH e AS ({_EDGE}) SELECT child AS parent, parent AS child, true AS rejected FROM e UNION ALL SELECT parent, child || 'x', false FROM e"),
    (run_snapshot, "SELECT c_custkey AS o_custkey, CAST(count(o_orderkey) AS INTEGER) AS n, coalesce(string_agg(o_orderstatus, '' ORDER BY o_orderkey), '') AS statuses FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1"),
    (recent_runs, "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed FROM orders ORDER BY placed DESC, o_orderkey LIMIT 50"),
    (sensor_new, "SELECT batch_id, 'accepted:' || batch_id AS run_key FROM (SELECT user_id AS batch_id FROM events WHERE event_type = 'click' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase' AND user_id % 3 = 0)"),
    (progress_events, r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '(?m)^(The|In|And) ')) AS INTEGER) AS done, CASE WHEN doc_id % 4 <> 0 THEN CAST(least(100, round_even(100 * (doc_id % 300) / 200, 0)) AS INTEGER) END AS percent FROM documents"""),
    (csv_profile, "SELECT user_id, count(*) AS row_count, coalesce(string_agg(DISTINCT event_type, ',' ORDER BY event_type) FILTER (event_id % 3 <> 0), '') AS schema_versions FROM events GROUP BY 1"),
    (migrations, "SELECT n_name AS version, sha256(n_name) AS checksum, CASE WHEN n_nationkey % 2 <> 0 THEN 'APPLY' WHEN n_nationkey % 6 = 0 THEN 'CHECKSUM_CHANGED' ELSE 'SKIP' END AS action FROM nation"),
    (reconcile_tiers, """WITH p AS (SELECT p_partkey AS product_id, CASE WHEN p_partkey % 4 = 0 THEN p_partkey END AS code, lower(p_name) AS n, p_brand AS g FROM part WHERE p_partkey % 2 = 0),
        r AS (SELECT p_partkey AS reference_id, CASE WHEN p_partkey % 8 = 0 THEN p_partkey END AS code, lower(p_name || CASE WHEN p_partkey % 3 = 0 THEN 's' ELSE '' END) AS n, p_brand AS g FROM part WHERE p_partkey % 6 <> 1),
        m AS (SELECT product_id, reference_id, 1 AS tier, 0 AS dist FROM p JOIN r ON p.code = r.code UNION ALL SELECT product_id, reference_id, 2, 0 FROM p JOIN r ON p.n = r.n AND p.g = r.g
            UNION ALL SELECT product_id, reference_id, 3, levenshtein(p.n, r.n) FROM p JOIN r ON p.g = r.g WHERE levenshtein(p.n, r.n) <= 3),
        b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY tier, dist, reference_id) = 1)
        SELECT p.product_id, reference_id, CASE tier WHEN 1 THEN 'CODE' WHEN 2 THEN 'NAME' WHEN 3 THEN 'FUZZY' ELSE 'NONE' END AS match_type, CAST(dist AS INTEGER) AS distance, CASE WHEN tier <= 2 THEN 'AUTO_APPROVED' ELSE 'REVIEW_REQUIRED' END AS review_status FROM p LEFT JOIN b USING (product_id)"""),
    (quality_pass_rate, f"""WITH f AS ({_FLAT}) SELECT rule, count(*) AS checked, count(*) FILTER (NOT ok) AS failed, round(avg(CAST(ok AS INTEGER)), 6) AS pass_rate,
        array_to_string(list_sort(list(k ORDER BY k) FILTER (NOT ok))[1:5], ',') AS sample FROM f GROUP BY 1"""),
    (quarantine_split, "SELECT CASE WHEN reason IS NULL THEN 'ACCEPTED' ELSE 'QUARANTINED' END AS outcome, reason, count(*) AS n FROM (SELECT CASE WHEN NOT l_quantity <= 45 THEN 'quantity' WHEN NOT l_discount < 0.09 THEN 'discount' WHEN NOT l_tax > 0 THEN 'tax' END AS reason FROM lineitem) GROUP BY 1, 2"),
    (validate_batches, """WITH s AS (SELECT s_suppkey AS k, 'b-' || s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN '-bo' ELSE '-ann' END AS batch_id FROM supplier)
        SELECT batch_id, 'ann' AS member, CASE WHEN k % 3 = 0 THEN 'BATCH_MEMBER_MISMATCH' END AS identity_error, CASE WHEN k % 7 = 0 THEN 'products.csv' ELSE '' END AS missing, CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS n_issues,
        CASE WHEN k % 3 = 0 OR k % 7 = 0 OR k % 5 = 0 THEN 'REJECTED' WHEN k % 4 = 0 THEN 'CONFLICT' ELSE 'ACCEPTED' END AS decision FROM s"""),
    (emission_outcomes, """WITH r AS (SELECT event_id AS p, user_id AS u, event_id % 4 <> 0 AS img, event_id % 3 AS c, event_id % 5 < 3 AS gate, event_id % 7 <> 0 AS ocr, event_id % 2 = 0 AS dom FROM events),
        f AS (SELECT *, img AND u % 9 = 0 AND c = 1 AS old, img AND gate AND NOT ocr AS failed FROM r),
        g AS (SELECT *, img AND NOT old AND coalesce(sum(CASE WHEN img AND NOT old AND NOT failed THEN 1 ELSE 0 END) OVER (PARTITION BY u, c ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS first FROM f),
        h AS (SELECT *, NOT img OR (first AND NOT gate AND dom) AS page FROM g),
        k AS (SELECT *, page AND u % 11 <> 0 AND coalesce(sum(CASE WHEN page THEN 1 ELSE 0 END) OVER (PARTITION BY u ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS page_ok FROM h)
        SELECT p AS position, CASE WHEN first AND failed THEN 'FAILED' WHEN first AND gate THEN 'IMAGE' WHEN page_ok THEN 'DOM_ONLY' WHEN first THEN 'RAW_ONLY' ELSE 'SKIPPED' END AS outcome FROM k"""),
    (gold_publish, "SELECT 'v1' AS dataset_version, p_partkey AS external_product_id, p_name AS product_name, 'AUTO_APPROVED' AS review_status FROM part WHERE p_size > 25"),
]

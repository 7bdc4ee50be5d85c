"""Queries over hashes of nested payloads, and over what registration writes: ids, contents and edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import hashing
from provlake.operators import bundles
from provlake.plans.discovery import table
from provlake.sources.shared import spread, written

#: A payload with keys in no order, hashes at several depths, escapes and nested lists, and its canonical form.
_PAYLOAD = r"""concat('{"z": [1, {"content_hash": "x", "b": "', o_orderpriority, '", "a": null, "c": {}}], "content_hash" : "y", "é": {"é": true, "A": ', o_custkey, ', "a": -0.5}, "t":"q\\"\\u00e9\\n/", "":', o_orderkey % 3, '}')"""
_CANONICAL = r"""concat('{"":', o_orderkey % 3, ',"t":"q\"é\n/","z":[1,{"a":null,"b":"', o_orderpriority, '","c":{}}],"é":{"A":', o_custkey, ',"a":-0.5,"é":true}}')"""


def canonical_hashes(spark, d):
    """Hashes of nested payloads whose keys, blanks and escapes differ from the canonical form; null for what is no object."""
    o = spread(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")).withColumn("payload", F.expr(_PAYLOAD))
    payload = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("["), "payload", F.lit("]"))).when(F.col("o_orderkey") % 13 == 0,
        F.left("payload", F.length("payload") - 1)).otherwise(F.col("payload"))
    return o.select("o_orderkey", hashing.open_content_hash(payload).alias("content_hash"))


def _raw(spark, d):
    """Orders as accepted manifests: sealed, sealed wrongly, without a hash, of another member, not accepted, or no JSON."""
    o = spread(table(spark, d, "orders").select("o_orderkey", "o_custkey")).withColumn("batch_id", F.concat(F.lit("b-ann-"), "o_orderkey"))
    member, status = F.when(F.col("o_orderkey") % 7 == 0, "bo").otherwise("ann"), F.when(F.col("o_orderkey") % 6 == 1, "REJECTED").otherwise("ACCEPTED")
    fields = [F.lit("p1").alias("parser_version"), member.alias("member"),
        F.struct(F.lit("x").alias("content_hash"), F.col("o_custkey").alias("k")).alias("nested"), F.col("o_custkey").alias("row_count"),
        status.alias("status")]
    body = F.to_json(F.struct(*fields))
    digest = F.when(F.col("o_orderkey") % 5 == 2, F.sha2(F.lit("other"), 256)).otherwise(hashing.open_content_hash(body))
    sealed = F.concat(F.lit('{"content_hash":"'), digest, F.lit('",'), F.substring(body, F.lit(2), F.length(body)))
    payload = F.when(F.col("o_orderkey") % 9 == 4, "null").when(F.col("o_orderkey") % 5 == 3, body).otherwise(sealed)
    raw = o.select("batch_id", payload.alias("payload"))
    return raw.withColumns({"sha256": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})


def manifest_issues(spark, d):
    return bundles.accepted_manifests(_raw(spark, d)).select("batch_id", "member", "issue", "row_count", "artifact_id", "checksum")


def _registered(spark, d):
    m = written(bundles.accepted_manifests(_raw(spark, d)), "manifests")  # each table below is made from it more than once
    file = lambda n, x, c: F.struct(F.lit(n).alias("logical_name"), F.concat(F.lit("accepted/"), "batch_id", F.lit(f"/{n}.{x}")).alias("path"),
        c.alias("sha256"), F.col("size"))
    files = m.select("batch_id", F.explode(F.array(file("manifest", "json", F.col("checksum")),
        file("products", "csv", F.sha2("batch_id", 256)))).alias("f")).select("batch_id", "f.*")
    known = m.where("row_count % 4 = 1").select(hashing.intake_run_id("batch_id", "checksum").alias("run_id"))  # registered before
    return bundles.register_accepted(m, files, known)


def registered_runs(spark, d):
    t = _registered(spark, d)
    steps = t["steps"].select("run_id", "step_id", F.col("name").alias("step"))
    return t["runs"].join(steps, "run_id").select("run_id", "batch_id", "status", "step_id", "step")


def registered_artifacts(spark, d):
    """Each new artifact with the manifest that it is bundled in."""
    t = _registered(spark, d)
    edges = t["edges"].select(F.col("parent").alias("artifact_id"), F.col("child").alias("bundled_in"))
    return t["artifacts"].join(edges, "artifact_id", "left").select("artifact_id", "run_id", "batch_id", "logical_name", "path", "format", "size",
        "checksum", "bundled_in")


def _uuid(name: str) -> str:
    h = f"sha1(unhex('{hashing.URL_NAMESPACE}') || encode({name}))"
    return f"(SELECT h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || '89ab'[(strpos('0123456789abcdef', h[17]) - 1) % 4 + 1] || h[18:20] || '-' || h[21:32] FROM (SELECT {h} AS h))"


_M = f"""
    o AS (SELECT o_orderkey AS k, o_custkey AS c, 'b-ann-' || o_orderkey AS batch_id, CASE WHEN o_orderkey % 7 = 0 THEN 'bo' ELSE 'ann' END AS member, CASE WHEN o_orderkey % 6 = 1 THEN 'REJECTED' ELSE 'ACCEPTED' END AS status FROM orders),
    b AS (SELECT *, '{{"parser_version":"p1","member":"' || member || '","nested":{{"content_hash":"x","k":' || c || '}},"row_count":' || c || ',"status":"' || status || '"}}' AS body,
        '{{"member":"' || member || '","nested":{{"k":' || c || '}},"parser_version":"p1","row_count":' || c || ',"status":"' || status || '"}}' AS canonical FROM o),
    p AS (SELECT *, CASE WHEN k % 9 = 4 THEN 'null' WHEN k % 5 = 3 THEN body ELSE '{{"content_hash":"' || CASE WHEN k % 5 = 2 THEN sha256('other') ELSE sha256(canonical) END || '",' || body[2:] END AS payload FROM b),
    m AS (
        SELECT *, sha256(payload) AS checksum, CAST(strlen(payload) AS BIGINT) AS size, CASE WHEN k % 9 = 4 OR k % 7 = 0 THEN 'ACCEPTED_MANIFEST_INVALID' WHEN k % 5 = 2 THEN 'CONTENT_HASH_MISMATCH'
            WHEN k % 6 = 1 THEN 'NOT_ACCEPTED' END AS issue FROM p),
    r AS (SELECT *, 'collection-intake:' || batch_id || ':' || checksum[1:16] AS run_id FROM m WHERE issue IS NULL AND c % 4 <> 1),
    a AS (
        SELECT run_id, batch_id, logical_name, 'accepted/' || batch_id || '/' || logical_name || '.' || lower(format) AS path, format, size, digest AS checksum,
            {_uuid("run_id || ':' || logical_name || ':' || digest")} AS artifact_id, {_uuid("run_id || ':manifest:' || manifest")} AS bundled_in
        FROM (SELECT *, checksum AS manifest, unnest(['manifest', 'products']) AS logical_name, unnest(['JSON', 'CSV']) AS format, unnest([checksum, sha256(batch_id)]) AS digest FROM r))"""

QUERIES = [
    (canonical_hashes, f"SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 THEN sha256({_CANONICAL}) END AS content_hash FROM orders"),
    (manifest_issues, f"""WITH {_M} SELECT batch_id, CASE WHEN k % 9 <> 4 THEN member END AS member, issue, CASE WHEN k % 9 = 4 THEN 0 ELSE c END AS row_count,
        {_uuid("'collection_submission:' || batch_id || ':' || checksum")} AS artifact_id, checksum FROM m"""),
    (registered_runs, f"""WITH {_M} SELECT run_id, batch_id, 'SUCCEEDED' AS status, {_uuid("run_id || ':register'")} AS step_id, 'register' AS step FROM r"""),
    (registered_artifacts, f"WITH {_M} SELECT artifact_id, run_id, batch_id, logical_name, path, format, size, checksum, CASE WHEN logical_name <> 'manifest' THEN bundled_in END AS bundled_in FROM a"),
]

"""Queries over the metadata store: orders as runs that two calls create and three move on, their lines as artifacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.operators.store import MetadataStore
from provlake.plans.discovery import table
from provlake.sources.shared import fresh_path

_RUN = ("o_orderstatus AS pipeline", "cast(o_custkey AS string) AS batch_id", "'v1' AS code_version", "'ann' AS member")


def _created(spark, d):
    """A store with two calls of create_runs: two thirds of the orders, then all, some of them changed.  The second call's outcome."""
    store = MetadataStore(spark, fresh_path(spark, "store"))
    o = table(spark, d, "orders").selectExpr("o_orderkey", "cast(o_orderkey AS string) AS run_id", *_RUN)
    store.create_runs(o.where("o_orderkey % 3 <> 0").withColumn("trigger", F.lit("sensor")))
    return store, o, store.create_runs(o.withColumn("trigger", F.expr("if(o_orderkey % 10 = 1, 'manual', 'sensor')")))


def store_create(spark, d):
    return _created(spark, d)[2].select("run_id", "trigger", "outcome")


def store_runs(spark, d):
    """Three calls of transitions, the middle one against the state machine for odd orders, and the state that results."""
    store, o, _ = _created(spark, d)
    at = lambda n: o.selectExpr("run_id", f"'2026-01-0{n}' AS at", "o_orderkey")
    store.transition_runs(at(1).where("o_orderkey % 2 = 0").withColumn("status", F.lit("RUNNING")))
    done = store.transition_runs(at(2).withColumn("status", F.lit("SUCCEEDED")).unionByName(at(3).withColumn("status", F.lit("FAILED"))))
    invalid = done.where("outcome = 'INVALID'").groupBy("run_id").agg(F.count("*").alias("invalid"))
    store.transition_runs(at(4).where("o_orderkey % 5 = 0").withColumn("status", F.lit("CANCELLED")))
    runs = store.runs().join(invalid, "run_id", "left")
    return runs.select("run_id", "trigger", "status", "started_at", "finished_at", F.coalesce("invalid", F.lit(0)).alias("invalid"))


def store_quality(spark, d):
    """The same rule recorded twice for each line's artifact of a supplier, and artifacts that take another's id or key."""
    store = MetadataStore(spark, fresh_path(spark, "store"))
    p = table(spark, d, "part").selectExpr("cast(p_partkey AS string) AS artifact_id", "p_brand AS run_id", "'s' AS step", "1 AS attempt",
        "p_name AS logical_name", "cast(p_partkey AS string) AS checksum", "p_type AS uri", "cast(p_size AS bigint) AS size")
    store.register_artifacts(p)
    other = p.withColumn("artifact_id", F.expr("if(size % 2 = 0, concat('x', artifact_id), artifact_id)")).withColumn("checksum",
        F.expr("if(size % 3 = 0, concat('y', checksum), checksum)"))
    again = store.register_artifacts(other).select(F.col("checksum"), "artifact_id", "outcome")
    rule = lambda tag, value: p.selectExpr("run_id", "artifact_id", "'R' AS rule", f"concat('{tag}-', artifact_id) AS result_id",
        f"{value} > 9 AS passed", f"double({value}) AS value")
    store.record_quality(rule("a", "size"))
    store.record_quality(rule("b", "size + 1").where("value < 30"))
    now = store.quality().select(F.col("artifact_id").alias("own"), "result_id", "passed", "value")
    return again.join(now, F.ltrim("artifact_id", F.lit("x")) == F.col("own")).drop("own")


QUERIES = [
    (store_create, """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CASE WHEN o_orderkey % 10 = 1 THEN 'manual' ELSE 'sensor' END AS trigger,
        CASE WHEN o_orderkey % 3 = 0 THEN 'INSERTED' WHEN o_orderkey % 10 = 1 THEN 'CONFLICT' ELSE 'RETURNED' END AS outcome FROM orders"""),
    (store_runs, """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CASE WHEN o_orderkey % 10 = 1 AND o_orderkey % 3 = 0 THEN 'manual' ELSE 'sensor' END AS trigger,
        CASE WHEN o_orderkey % 2 = 0 THEN 'SUCCEEDED' WHEN o_orderkey % 5 = 0 THEN 'CANCELLED' ELSE 'PENDING' END AS status,
        CASE WHEN o_orderkey % 2 = 0 THEN '2026-01-01' END AS started_at, CASE WHEN o_orderkey % 2 = 0 THEN '2026-01-02' WHEN o_orderkey % 5 = 0 THEN '2026-01-04' END AS finished_at,
        CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS invalid FROM orders"""),
    (store_quality, """SELECT CASE WHEN p_size % 3 = 0 THEN 'y' ELSE '' END || p_partkey AS checksum, CASE WHEN p_size % 2 = 0 THEN 'x' ELSE '' END || p_partkey AS artifact_id,
        CASE WHEN p_size % 6 = 0 THEN 'INSERTED' WHEN p_size % 2 = 0 OR p_size % 3 = 0 THEN 'CONFLICT' ELSE 'RETURNED' END AS outcome, 'a-' || p_partkey AS result_id,
        CASE WHEN p_size + 1 < 30 THEN p_size + 1 ELSE p_size END > 9 AS passed, CAST(CASE WHEN p_size + 1 < 30 THEN p_size + 1 ELSE p_size END AS DOUBLE) AS value FROM part"""),
]

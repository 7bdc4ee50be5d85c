"""Queries over gold bundles: published through failures, published again, read back with their checksums verified."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.operators import gold
from provlake.plans.discovery import table
from provlake.sources.shared import fresh_path

STEPS = ("check", "data", "csv", "quality", "manifest")
_RULES = {"PRICE": "p_retailprice < 1000", "SIZE": "p_size <> 30"}
_COLUMNS = ("external_product_id", "product_name", "storage_type", "confidence", "review_status")


class _Stopped(RuntimeError):
    pass


def _stop_at(name):
    def step(now):
        if now == name:
            raise _Stopped(name)

    return step


def _published(spark, d):
    """The root of a store with version v1 of the parts; attempts that stop before each step come first, and the same rows once more last."""
    root = fresh_path(spark, "gold")
    p = table(spark, d, "part")
    rows = p.selectExpr(
        "*", "concat('P-', if(p_partkey % 50 = 0, p_partkey + 1, p_partkey)) AS external_product_id", "p_name AS product_name",
        "if(p_size % 2 = 0, 'ROOM', 'FROZEN') AS storage_type", "p_size / 64 AS confidence",
            "if(p_size > 15, 'AUTO_APPROVED', 'REVIEW_REQUIRED') AS review_status",
    )
    inputs = p.select(F.concat(F.lit("type-"), "p_type").alias("artifact_id"), F.sha2("p_type", 256).alias("checksum")).distinct()
    rules = {n: F.expr(e) for n, e in _RULES.items()}
    publish = lambda step: gold.publish_bundle(rows, root, "v1", "external_product_id", _COLUMNS, rules, inputs, "2026-01-01T00:00:00Z",
        step=step)
    for name in STEPS:
        try:
            publish(_stop_at(name))
        except _Stopped:
            if gold.versions(spark, root):
                raise AssertionError(f"a bundle that stopped at {name} is there") from None
    statuses = [publish(lambda _: None).status for _ in range(2)]
    if statuses != ["PUBLISHED", "DUPLICATE"] or gold.sweep(spark, root, "v1") != 3:
        raise AssertionError(f"published as {statuses}")
    return root


def gold_bundle(spark, d):
    return gold.read_bundle(spark, _published(spark, d), "v1")


def gold_summary(spark, d):
    """What became of the rows, from the bundle's own summary."""
    root = _published(spark, d)
    files = f"{root}/freshness_profiles/v1/data-*/quality_summary.json"
    s = spark.read.schema("outcomes map<string, bigint>").option("multiLine", True).json(files)
    return s.select(F.explode("outcomes").alias("outcome", "n"))


_TAGGED = f"""
    p AS (SELECT *, 'P-' || CASE WHEN p_partkey % 50 = 0 THEN p_partkey + 1 ELSE p_partkey END AS external_product_id FROM part),
    t AS (
        SELECT *, CASE WHEN p_size <= 15 THEN 'NOT_APPROVED' WHEN NOT {_RULES["PRICE"]} THEN 'PRICE' WHEN NOT {_RULES["SIZE"]} THEN 'SIZE'
            WHEN count(*) OVER (PARTITION BY external_product_id) > 1 THEN 'DUPLICATE_KEY' ELSE 'PUBLISHED' END AS outcome FROM p)"""

QUERIES = [
    (gold_bundle, f"""WITH {_TAGGED} SELECT 'v1' AS dataset_version, external_product_id, p_name AS product_name, CASE WHEN p_size % 2 = 0 THEN 'ROOM' ELSE 'FROZEN' END AS storage_type,
        p_size / 64 AS confidence, 'AUTO_APPROVED' AS review_status FROM t WHERE outcome = 'PUBLISHED'"""),
    (gold_summary, f"WITH {_TAGGED} SELECT outcome, count(*) AS n FROM t GROUP BY outcome"),
]

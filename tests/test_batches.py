"""Discovery states, dynamic partitions and submission documents on small tables with the odd cases."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from provlake.operators import discovery, documents, schemas, submission
from provlake.sources import partitions


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_url_lists_of_every_state(spark):
    lines = [
        ("full", 1, " https://www.shop.example/goods/1?a "), ("full", 2, "/goods/2"), ("full", 3, "https://www.shop.example/goods/1"), ("full", 4, "# c"), ("full", 5, ""), ("full", 6, None),
        ("part", 1, "https://www.shop.example/goods/7"), ("part", 2, "nothing"), ("part", 3, "nothing"), ("bad", 1, "https://other.place/goods/7"), ("blank", 1, "  "), ("unknown", 1, "/goods/1"),
    ]
    batches = spark.createDataFrame([(b, f"f/{b}") for b in ("full", "part", "bad", "blank", "none")], "batch_id string, requested_url string")
    d = discovery.discover_url_lists(batches, spark.createDataFrame(lines, "batch_id string, position int, line string"))
    assert rows(d.manifests, "batch_id", "discovered_count", "failure_count", "duplicate_count", "status") == [
        ("bad", 0, 1, 0, "FAILED"), ("blank", 0, 1, 0, "FAILED"), ("full", 2, 0, 1, "COMPLETED"), ("none", 0, 1, 0, "FAILED"), ("part", 1, 2, 0, "PARTIAL_FAILED"),
    ]
    assert rows(d.products, "batch_id", "discovery_order", "original_product_id") == [("full", 1, "1"), ("full", 2, "2"), ("part", 1, "7")]
    assert rows(d.failures, "batch_id", "error_code", "requested_url")[1:4] == [("blank", "PRODUCT_LINK_NOT_FOUND", "f/blank"), ("none", "PRODUCT_LINK_NOT_FOUND", "f/none"), ("part", "INVALID_PRODUCT_URL", "nothing")]


def test_visits_of_every_state(spark):
    visits = spark.createDataFrame([("a", "u", "OK"), ("b", "u", "OK"), ("c", "u", "TIMEOUT"), ("d", "u", "ERROR")], "batch_id string, requested_url string, fetch string")
    found = spark.createDataFrame([("a", "LIMIT", "1", 1, "p", 4), ("c", "LIMIT", "1", 1, "p", 4)], "batch_id string, stop_reason string, original_product_id string, discovery_order int, product_url string, duplicates long")
    d = discovery.discover_visits(visits, found)
    assert rows(d.manifests, "batch_id", "discovered_count", "duplicate_count", "stop_reason", "status") == [("a", 1, 4, "LIMIT", "COMPLETED"), ("b", 0, 0, None, "FAILED"), ("c", 0, 0, None, "FAILED"), ("d", 0, 0, None, "FAILED")]
    assert rows(d.failures, "batch_id", "error_code") == [("b", "PRODUCT_LINK_NOT_FOUND"), ("c", "DISCOVERY_PAGE_TIMEOUT"), ("d", "DISCOVERY_PAGE_FETCH_FAILED")]


def test_only_written_partitions_change_and_others_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(40).selectExpr("id", "concat('b', id % 4) as batch_id")
    partitions.overwrite(first, path, "batch_id")
    files = lambda: {f.relative_to(path): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    was = files()
    partitions.overwrite(first.where("batch_id in ('b1', 'b3') and id < 20").withColumn("id", -F.col("id")), path, "batch_id")
    now = files()
    kept = {f for f in was if f in now and was[f] == now[f]}
    assert {f.parts[0] for f in kept} == {"batch_id=b0", "batch_id=b2"} and len(kept) == 2
    assert {f.parts[0] for f in now if f not in kept} == {"batch_id=b1", "batch_id=b3"}
    log = partitions.registry(spark, str(tmp_path / "r"))
    keys = spark.createDataFrame([("s", "b0"), ("s", "b0"), ("s", "b1"), ("t", "b0"), ("s", None)], "set_name string, key string")
    assert rows(partitions.register(log, keys), "set_name", "key", "added") == [("s", "b0", True), ("s", "b1", True), ("t", "b0", True)]
    again = spark.createDataFrame([("s", "b1"), ("s", "b2")], "set_name string, key string")
    assert rows(partitions.register(log, again), "set_name", "key", "added") == [("s", "b1", False), ("s", "b2", True)]
    some = partitions.of_partitions(spark, path, "batch_id", partitions.keys_of(log, "s"), "since = 2")
    assert rows(some, "id") == [(i,) for i in sorted(range(2, 40, 4), key=repr)] or {r.id for r in some.collect()} == set(range(2, 40, 4))
    assert "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString().lower()


@pytest.fixture(scope="module")
def nodes():
    return {n: schemas.compile_document(d) for n, d in documents.documents().items()}


def test_submission_documents(spark, tmp_path, nodes):
    batches = [(b, "ann", "READY", f"{b}/p.csv", None, None) for b in ("20260801-ann-001", "Brand#1 %2", "empty")]
    b = spark.createDataFrame(batches, "batch_id string, member string, status string, products_csv_uri string, failures_csv_uri string, discovery_dir_uri string")
    data = [("20260801-ann-001", 2, "20", "두부 \"x\"\n", "u", "0.00001"), ("20260801-ann-001", 1, "3", "a", "u", "bad"), ("20260801-ann-001", 10, "4", "b", "u", "1"), ("Brand#1 %2", 1, "5", "c", "u", None)]
    r = spark.createDataFrame(data, "batch_id string, position int, original_product_id string, product_name_raw string, product_url string, ocr_confidence string")
    path = str(tmp_path / "s")
    submission.write_submissions(submission.seal_submissions(b, r, "run", "2026-01-01"), path)
    docs = submission.read_submissions(spark, path)
    got = {x.batch_id: json.loads(x.payload) for x in docs.collect()}
    assert {k: [(p["original_product_id"], p["ocr_confidence"]) for p in v["products"]] for k, v in got.items()} == {"20260801-ann-001": [("3", None), ("20", 1e-05), ("4", 1.0)], "Brand#1 %2": [("5", None)], "empty": []}
    assert got["20260801-ann-001"]["products"][1]["product_name_raw"] == "두부 \"x\"" and got["empty"]["row_count"] == 0
    assert submission.verify_submissions(docs, nodes).where("size(issues) > 0").count() == 0
    changed = submission.verify_submissions(docs.withColumn("payload", F.replace("payload", F.lit('"original_product_id":"20"'), F.lit('"original_product_id":""'))), nodes)
    found = {x.batch_id: [(i.code, i.path) for i in x.issues] for x in changed.collect()}
    assert found["20260801-ann-001"] == [("SCHEMA_VALIDATION_FAILED", "$.products[1].original_product_id"), ("CHECKSUM_MISMATCH", "$.content_hash"), ("CHECKSUM_MISMATCH", "$.products[1].content_hash")]
    assert found["empty"] == [] and found["Brand#1 %2"] == []
    with pytest.raises(Exception, match="(?i)already exists"):
        submission.write_submissions(submission.seal_submissions(b, r, "run", "2026-01-01"), path)

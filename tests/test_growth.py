"""What keeps tasks, memory and files in bounds when the tables grow."""

import hashlib
import json
import re
import tracemalloc

from pyspark.sql import functions as F

from provlake.functions import hashing
from provlake.operators import discovery, documents, publish, reconcile, schemas, submission
from provlake.plans import catalog, matching

DATA = "/root/testdata/sf0.001"


def test_contract_documents_do_not_share_one_task(spark):
    """The parts are one small file; their payloads were all checked by the task that reads it."""
    assert catalog.queries()["contract_documents"](spark, DATA).rdd.getNumPartitions() >= 4


def _submissions(spark, n):
    rows = spark.range(n).selectExpr("'b' AS batch_id", "id AS position", "cast(id AS string) AS original_product_id", "concat('né ', id, '/') AS product_name_raw",
        "'u' AS product_url", "cast(id / 7 AS string) AS ocr_confidence")
    batches = spark.sql("SELECT 'b' AS batch_id, 'ann' AS member, 'READY' AS status, 'p.csv' AS products_csv_uri, CAST(null AS string) AS failures_csv_uri, "
        "CAST(null AS string) AS discovery_dir_uri UNION ALL SELECT 'none', 'ann', 'READY', 'é.csv', null, null")
    return submission.seal_submissions(batches, rows, "run", "2026-01-01T00:00:00Z")


def test_products_do_not_carry_their_document(spark):
    """Verification shuffled the whole document once for each of its products: bytes with the square of a batch."""
    nodes = {n: schemas.compile_document(x) for n, x in documents.documents().items()}
    changed = F.regexp_replace("payload", '"product_name_raw":"[^,]*,', '"product_name_raw":"x",')
    docs = _submissions(spark, 30).withColumn("payload", changed)
    docs = docs.unionByName(docs)  # a document that comes twice has its issues once in each row
    out = submission.verify_submissions(spark.createDataFrame(docs.collect(), docs.schema), nodes)
    assert sorted((r.batch_id, len(r.issues)) for r in out.collect()) == [("b", 31), ("b", 31), ("none", 0), ("none", 0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    carried = re.search(r"Generate posexplode.*\), \[([^\]]*)\], (?:true|false), \[", plan)[1]
    assert "_key" in carried and "payload" not in carried


def test_a_long_list_is_hashed_in_pieces():
    """The worker held a second tree of a document, its whole canonical text and that text's bytes."""
    doc = {"products": [{"a": "x" * 100, "i": i} for i in range(1000)]}
    pieces = list(hashing._canonical_pieces(doc))
    assert "".join(pieces) == hashing.canonical_json(doc) and max(map(len, pieces)) < 200


def test_hashes_in_pieces_are_those_of_the_whole_text(spark):
    values = [{}, {"a": []}, {"b": [{"content_hash": 1, "é": " "}, [], 1.50], "a": {"x": [], "content_hash": {}}}, {"content_hash": [1]}, {"": None}]
    texts = [*map(json.dumps, values), '{"a": NaN}', '{"a": "\\ud800"}', "[1]", "", None, '{"a": 1, "a": [2]}']
    want = [hashlib.sha256(hashing.canonical_json(v).encode()).hexdigest() for v in values] + [None] * 5 + [hashlib.sha256(b'{"a":[2]}').hexdigest()]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(hashing.open_content_hash("t")).collect()] == want


def test_hashed_and_matched_rows_do_not_share_one_task(spark):
    for name in ("canonical_hashes", "page_fields", "disclosure_literal", "manifest_issues"):
        assert catalog.queries()[name](spark, DATA).rdd.getNumPartitions() >= 4, name


def test_registered_tables_hash_each_manifest_once(spark):
    for name in ("registered_runs", "registered_artifacts"):
        plan = catalog.queries()[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
        assert "ArrowEvalPython" not in plan, name


def test_fuzzy_names_are_compared_once(spark, monkeypatch):
    """Products and references of one name were compared pair by pair: rows with the square of a name's copies."""
    products = spark.range(300).selectExpr("id AS product_id", "CAST(null AS bigint) AS code", "'green tea' AS name", "'g' AS brand")
    reference = spark.range(300).selectExpr("id + 10 AS reference_id", "CAST(null AS bigint) AS code", "'green teas' AS name", "'g' AS brand")
    given, pieces = [], publish._pieces
    monkeypatch.setattr(publish, "_pieces", lambda names, ref, *more: given.append((names, ref)) or pieces(names, ref, *more))
    found = publish.reconcile(products, reference, "code", "name", "brand").collect()
    assert {(r.reference_id, r.match_type, r.distance) for r in found} == {(10, "FUZZY", 1)} and len(found) == 300
    assert [t.count() for t in given[0]] == [1, 1]


def test_list_manifests_count_without_sorting_lines(spark):
    """Each manifest came from windows and seven joins over all lines, several of them sorted in one task."""
    batches = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "batch_id long, requested_url string")
    ok, bad = "https://www.shop.example/goods/5", "https://www.shop.example/about"
    lines = spark.createDataFrame([(1, 1, ok), (1, 2, f" {ok}?x=1"), (1, 3, bad), (1, 4, bad), (1, 5, "# n"), (3, 1, "https://else.where/goods/5"), (3, 2, ok), (9, 1, ok)],
        "batch_id long, position long, line string")
    found = discovery.discover_url_lists(batches, lines)
    got = sorted((r.batch_id, r.requested_url, r.discovered_count, r.failure_count, r.duplicate_count, r.status) for r in found.manifests.collect())
    assert got == [(1, "a", 1, 2, 1, "PARTIAL_FAILED"), (2, "b", 0, 2, 0, "FAILED"), (2, "c", 0, 2, 0, "FAILED"), (3, "d", 0, 1, 1, "FAILED")]
    plan = found.manifests._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number") == 0 and plan.count("Join") <= 3


def test_names_and_their_sets_do_not_share_one_task(spark):
    products, reference = matching._tables(spark, DATA)
    assert len(products.inputFiles()) >= 4 and len(reference.inputFiles()) >= 4
    names = spark.range(40).coalesce(1).selectExpr("concat('a', id) AS name", "array(struct(id AS rank, concat('a', id) AS word, 5L AS weight)) AS words", "5L AS weight")
    assert reconcile.heavy_sets(names, 600).rdd.getNumPartitions() >= 4


def test_a_long_text_is_hashed_without_its_tree(monkeypatch):
    """A worker held a document of 200 MB as some gigabytes of Python objects."""
    doc = {"products": [{"content_hash": "h", "name": f"né {i}", "list": [1, None, 0.50], **{f"k{j}": f"value {j} of {i}" for j in range(12)}} for i in range(5000)], "a": {"b": []}}
    text = json.dumps(doc, ensure_ascii=False, indent=1)
    tracemalloc.start()
    got = hashing._open_hash(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * len(text) and got == hashlib.sha256(hashing.canonical_json(doc).encode()).hexdigest()
    texts = ["{}", ' { "b" : [ ] , "a":{} }\n', '{"content_hash": NaN}', '{"a": [1, [2, {"content_hash": 3}]], "B": "é"}', '{"a": [1,]}', '{"a": 1,}', '{"a" 1}', "{a: 1}", "{", "[1]", '{"a": [NaN]}',
        '{"a": NaN, "a": 2}', '{"a": ["\\ud800"]}', '{"a": 1} x', '{"\\u0061": [01]}', '{"\\u0061": 1e400}', "1", " ", '{"a": [1 2]}', '{"a": {"a": 1, "a": [2]}}', '{"a": [}', '{"content_hash": 1, "z": [], "z": [1]}', '{"a": "\n"}']
    whole = [hashing._open_hash(t) for t in texts]
    monkeypatch.setattr(hashing, "LONG", 1)
    assert [hashing._open_hash(t) for t in texts] == whole and None in whole

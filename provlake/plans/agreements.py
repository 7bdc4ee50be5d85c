"""Queries over the contract documents: every part as a payload of each of the seven contracts, broken by its number."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from provlake.operators import documents, schemas
from provlake.plans.discovery import table
from provlake.sources.shared import fresh_path, spread

_META = {
    "schema_version": "1.0.0", "run_id": "run", "batch_id": "b-1", "record_id": "rec", "source": "?", "source_record_id": "s-1", "source_uri": None,
    "content_hash": "0" * 64, "parser_version": "p1", "created_at": "2026-01-01T00:00:00Z",
}
#: A valid payload of each contract.  NAME and SHARE stand for values of the row.
PAYLOADS = {
    "collection_submission": {**_META, "source": "SITE_COLLECTION", "member": "ann", "status": "READY", "row_count": 2,
        "artifacts": {"products_csv_uri": "p.csv", "failures_csv_uri": None}, "products": [
        {**_META, "source": "x", "original_product_id": "1", "product_name_raw": "NAME", "product_url": "u", "ocr_confidence": "SHARE"},
        {**_META, "source": "x", "original_product_id": "2", "product_name_raw": "NAME", "product_url": "u", "shade": "red"}]},
    "site_raw_product": {**_META, "source": "SITE", "original_product_id": "1", "product_name_raw": "NAME", "product_url": "u",
        "detail_image_urls": ["a", "b"], "shade": "red"},
    "agency_raw_record": {**_META, "source": "AGENCY", "document_id": "d", "page_number": 3, "food_name_raw": "NAME", "raw_text": ""},
    "normalized_freshness": {**_META, "source": "SITE", "food_name_normalized": "NAME", "storage_type": "ROOM", "expiration_value": 3.5,
        "expiration_unit": "DAY", "expiration_basis": None},
    "reconciled_freshness": {**_META, "source": "RECONCILER", "site_record_id": "1", "review_status": "APPROVED", "match_type": "NAME",
        "confidence": "SHARE", "rule_id": "R", "rule_version": "1", "selected_source": "NONE"},
    "gold_freshness": {**_META, "source": "GOLD", "dataset_version": "v", "external_product_id": "1", "food_mapping_key": "k", "product_name": "NAME",
        "storage_type": "ROOM", "selected_source": "SITE", "confidence": "SHARE", "review_status": "APPROVED"},
    "ocr_record": {"schema_version": "1.0", "source_site": "SHOP", "original_product_id": "1", "product_name": "NAME", "product_url": "u",
        "ocr_raw_text": "", "parser_version": "p", "ocr_confidence": "SHARE"},
}
#: Changes of the JSON text (what is replaced, by what), taken in turn by the part's number; the first leaves it as it is.
CHANGES = [
    ("", ""), ('"parser_version": "p', '"parser_versions": "p'), ('"schema_version": "1', '"schema_version": "2'),
        ('"schema_version": "1.0', '"schema_version": "one'), ('"schema_version": ', '"schema_versions": '),
    ('"1"', "1"), ('"NAME"', '""'), ('"ROOM"', '"room"'), ("[", "[null, "), ('"page_number": 3', '"page_number": 0.5'), ('"p.csv"', "[]"), ("{", "[{"),
]


def contract_documents(spark, d):
    """Payloads with the issues that the documents, written as files and read again, find in them."""
    folder = fresh_path(spark, "contracts")
    documents.write_documents(spark, folder)
    nodes = schemas.read_documents(spark, folder)
    each = F.explode(F.create_map(*[F.lit(x) for n, p in PAYLOADS.items() for x in (n, json.dumps(p))])).alias("contract", "payload")
    rows = spread(table(spark, d, "part").select("p_partkey", "p_name", "p_size")).select("p_partkey", "p_name", "p_size", each)
    changes = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in CHANGES])
    rows = rows.withColumn("c", changes[(F.col("p_partkey") % len(CHANGES)).cast("int")])
    changed = F.when(F.col("c.a") == "", F.col("payload")).otherwise(F.replace("payload", F.col("c.a"), F.col("c.b")))
    filled = F.replace(F.replace(changed, F.lit("NAME"), F.col("p_name")), F.lit('"SHARE"'), (F.col("p_size") / 40).cast("string"))
    return schemas.issue_rows(rows.withColumn("payload", filled), nodes, ["p_partkey", "contract"], check_hash=False)


def _expected() -> str:
    """The issues of each contract and change, as rows (contract, change, code, path, keyword, size above which they arise)."""
    rows: list[tuple] = []
    schema = lambda c, n, path, keyword, above=-1: rows.append((c, n, "SCHEMA_VALIDATION_FAILED", path, keyword, above))
    closed = ("collection_submission", "normalized_freshness", "reconciled_freshness", "gold_freshness")
    share = {"reconciled_freshness": "$.confidence", "gold_freshness": "$.confidence", "ocr_record": "$.ocr_confidence"}
    products = [f"$.products[{i}]" for i in (0, 1)]
    for c in PAYLOADS:
        inside = products if c == "collection_submission" else []
        for n in range(len(CHANGES)):
            if c in share and n not in (2, 11):
                schema(c, n, share[c], "maximum", 40)
        for n in (1, 4):
            schema(c, n, "$", "required")
            for p in inside:
                schema(c, n, p, "required")
            if c in closed:
                schema(c, n, "$", "additionalProperties")
        rows.append((c, 2, "UNSUPPORTED_SCHEMA_VERSION", "$.schema_version", None, -1))
        rows.append((c, 3, "INVALID_SCHEMA_VERSION", "$.schema_version", None, -1))
        for p in ["$", *inside]:
            schema(c, 3, f"{p}.schema_version", "const")
        rows.append((c, 4, "MISSING_SCHEMA_VERSION", "$.schema_version", None, -1))
        rows.append((c, 11, "INVALID_PAYLOAD", "$", None, -1))
    texts = {"collection_submission": ["$.products[0].original_product_id"], "reconciled_freshness": ["$.site_record_id", "$.rule_version"],
        "gold_freshness": ["$.external_product_id"], "site_raw_product": ["$.original_product_id"], "ocr_record": ["$.original_product_id"]}
    for c, paths in texts.items():
        for p in paths:
            schema(c, 5, p, "type")
    for c, p in {"normalized_freshness": "$.food_name_normalized", "gold_freshness": "$.product_name", "reconciled_freshness": "$.match_type",
        "ocr_record": "$.product_name"}.items():
        schema(c, 6, p, "minLength")
    for p in products:
        schema("collection_submission", 6, f"{p}.product_name_raw", "minLength")
    for c in ("normalized_freshness", "gold_freshness"):
        schema(c, 7, "$.storage_type", "enum")
    schema("collection_submission", 8, "$.products[0]", "type")
    schema("site_raw_product", 8, "$.detail_image_urls[0]", "type")
    schema("agency_raw_record", 9, "$.page_number", "type")
    schema("agency_raw_record", 9, "$.page_number", "minimum")
    schema("collection_submission", 10, "$.artifacts.products_csv_uri", "type")
    value = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else f"'{x}'"
    return ", ".join(f"({', '.join(map(value, r))})" for r in rows)


QUERIES = [
    (contract_documents, f"""SELECT p_partkey, contract, code, path, keyword FROM part JOIN (VALUES {_expected()}) AS e (contract, change, code, path, keyword, above)
        ON change = p_partkey % {len(CHANGES)} AND p_size > above"""),
]

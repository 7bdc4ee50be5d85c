import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from provlake.functions import extract, hashing, merge, text, urls


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def one(spark, value, f):
    return values(spark, [(value,)], "x string", f(F.col("x")).alias("r"))[0][0]


@pytest.mark.parametrize(
    ("url", "pid", "canonical"),
    [
        ("https://www.shop.example/goods/77?ref=a#b", "77", "https://www.shop.example/goods/77"),
        ("/goods/12", "12", "https://www.shop.example/goods/12"),
        ("HTTP://m.shop.example/GOODS/5", "5", "http://m.shop.example/goods/5"),
        ("https://other.test/goods/5", "5", None),
        ("https://x.test/window-products/store/9?NaPm=1", "9", "https://store.example/window-products/store/9"),
        ("https://www.shop.example/categories/910", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_product_urls(spark, url, pid, canonical):
    assert values(spark, [(url,)], "u string", urls.product_id("u"), urls.canonical_url("u")) == [(pid, canonical)]


def test_url_builders(spark):
    assert one(spark, " 두부 a/b ", urls.search_url).endswith("sword=%EB%91%90%EB%B6%80%20a/b")
    assert one(spark, "  ", urls.search_url) is None
    assert one(spark, "910", urls.category_url).endswith("/910")
    assert one(spark, "9x", urls.category_url) is None
    assert one(spark, "https://a.example/categories/42?x", urls.category_code) == "42"
    assert one(spark, "https://a.example/i.jpg#f", urls.image_url) == "https://a.example/i.jpg"
    assert one(spark, "data:image/png;base64,xx", urls.image_url) is None


def test_strip_and_lines(spark):
    assert one(spark, " 　 a  b \t", text.ustrip) == "a  b"
    assert one(spark, " 　", text.blank_to_null) is None
    assert one(spark, "a  b\x0b\r\nc", text.page_lines) == ["a", "b", "c"]
    assert one(spark, "a | \rb\x0bc", text.label_lines) == ["a", "b c"]
    assert one(spark, "3.9", text.optional_int) == 3
    assert one(spark, "x", text.optional_double) is None


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("소비기한 2026-01-01", "2026-01-01"),
        ("・소비기한\n10일", "10일"),
        ("안내 소비기한 3일", None),
        ("소비기한\n상품설명 및 상품이미지 참조\n유통기한 : 5일", "5일"),
        ("소비기한", None),
        ("소비기한(또는 유통기한)정보\n2일", "2일"),
        ("", None),
        (None, None),
    ],
)
def test_expiration(spark, page, want):
    assert one(spark, page, extract.expiration_info) == want


def test_storage_order_differs(spark):
    x = "냉동 또는 냉장"
    assert one(spark, x, extract.storage_type) == "REFRIGERATED"
    assert one(spark, x, lambda c: extract.storage_type(c, frozen_first=True)) == "FROZEN"
    assert one(spark, None, extract.storage_type) == "UNKNOWN"


def test_gate_removes_plain_spaces_only(spark):
    assert one(spark, "소비 기한", extract.has_keywords) is True
    assert one(spark, "소비\t기한", extract.has_keywords) is False


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        ("냉장", None, ("냉장", "DOM", "MATCHED")),
        (None, "냉장", ("냉장", "OCR", "MATCHED")),
        ("냉장 보관", "냉장보관하세요", ("냉장 보관", "DOM_AND_OCR", "MATCHED")),
        ("10℃ 냉장", "냉장 10도", ("10℃ 냉장", "DOM_AND_OCR", "MATCHED")),
        ("냉장", "냉동", ("냉장", "DOM", "REVIEW_REQUIRED")),
        (" ", "", (None, "NOT_FOUND", "FIELD_NOT_FOUND")),
    ],
)
def test_merge(spark, a, b, want):
    got = values(spark, [(a, b)], "a string, b string", merge.merge_field("a", "b").alias("m"))[0][0]
    assert tuple(got) == want


def test_rollup(spark):
    rows = [("MATCHED", "REVIEW_REQUIRED"), ("FIELD_NOT_FOUND", "FIELD_NOT_FOUND"), ("MATCHED", "FIELD_NOT_FOUND")]
    assert [r[0] for r in values(spark, rows, "a string, b string", merge.rollup_status("a", "b"))] == ["REVIEW_REQUIRED", "FIELD_NOT_FOUND", "MATCHED"]


def test_hashes(spark):
    assert one(spark, "run:a:b", hashing.uuid5) == str(uuid.uuid5(uuid.NAMESPACE_URL, "run:a:b"))
    body = '{"b":1,"content_hash":"x","a":[{"content_hash":1,"c":"é"}]}'
    want = hashlib.sha256('{"a":[{"c":"é"}],"b":1}'.encode()).hexdigest()
    assert one(spark, body, hashing.open_content_hash) == want
    assert one(spark, "[1]", hashing.open_content_hash) is None
    with pytest.raises(ValueError, match="finite"):
        hashing.canonical_json({"a": float("nan")})


def test_versions(spark):
    rows = [("1.2.3",), ("2",), ("",), ("a.b",), (None,)]
    got = [r[0] for r in values(spark, rows, "v string", hashing.version_issue("v"))]
    assert got == [None, "UNSUPPORTED_SCHEMA_VERSION", "MISSING_SCHEMA_VERSION", "INVALID_SCHEMA_VERSION", "MISSING_SCHEMA_VERSION"]

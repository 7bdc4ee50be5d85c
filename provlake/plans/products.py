"""Queries over whole product rows: events as image and page rows, merged field by field."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.operators import emission
from provlake.plans.discovery import table

#: Expressions that Spark and the SQL read alike.
_EXP_OCR = "CASE event_id % 4 WHEN 1 THEN '3일' WHEN 2 THEN '제조일로부터 3일' WHEN 3 THEN '5일' END"
_STORE_OCR = "CASE event_id % 5 WHEN 0 THEN '냉동 보관' WHEN 1 THEN '냉장 보관하세요' END"
_FOOD_OCR = "CASE WHEN event_id % 3 = 0 THEN '과자' END"
_EXP_DOM = "CASE WHEN event_id % 2 = 0 THEN '3일' END"
_STORE_DOM = "CASE WHEN event_id % 11 = 0 THEN '냉장 보관' END"
_TYPE_DOM = "CASE WHEN user_id % 7 = 0 THEN 'ROOM_TEMPERATURE' WHEN user_id % 7 = 1 THEN '' END"
_NAME = "CASE WHEN user_id % 10 = 3 THEN '냉동 만두' WHEN user_id % 10 <> 4 THEN concat('상품 ', user_id) END"


def product_records(spark, d):
    e = table(spark, d, "events")
    lines = f"concat_ws('\\n', concat('식품유형: ', {_FOOD_OCR}), concat('소비기한: ', {_EXP_OCR}), concat('보관방법: ', {_STORE_OCR}), '기타 문구')"
    rows = e.selectExpr(
        "'b' AS batch_id", "event_id AS position", "'S' AS site", "cast(user_id AS string) AS pid",
            "CASE WHEN event_id % 4 <> 0 THEN 'i.jpg' END AS image_path",
        "sha2(cast(event_id % 3 AS string), 256) AS digest", "CASE WHEN event_id % 5 < 3 THEN '유통기한 3일' ELSE 'none' END AS gate_text",
            f"CASE WHEN event_id % 7 <> 0 THEN {lines} END AS ocr_text",
        f"{_EXP_DOM} AS expiration_dom", f"{_STORE_DOM} AS storage_dom", f"{_TYPE_DOM} AS storage_type_dom", f"{_NAME} AS product_name",
            "event_type AS food_name_candidate",
        "concat('u/', user_id) AS product_url", "cast(null AS string) AS sales_unit_raw", "cast(value AS string) AS weight_raw",
            "cast(event_id % 9 AS string) AS quantity_raw",
        "cast(event_id % 100 AS double) / 100 AS ocr_confidence", "'c1' AS crawl_collected_at", "'o1' AS ocr_collected_at",
    )
    return emission.product_records(emission.emit(rows, rows.where("false").select(F.lit("").alias("key")))).drop("weight_raw")


_RECORDS = f"""
    WITH r AS (SELECT *, event_id AS p, user_id AS u, event_id % 4 <> 0 AS img, event_id % 3 AS c, event_id % 5 < 3 AS gate, event_id % 7 <> 0 AS ocr, event_id % 2 = 0 OR event_id % 11 = 0 AS dom FROM events),
    f AS (SELECT *, img AND gate AND NOT ocr AS failed FROM r),
    g AS (SELECT *, img AND coalesce(sum(CASE WHEN img AND NOT failed THEN 1 ELSE 0 END) OVER (PARTITION BY u, c ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS first FROM f),
    h AS (SELECT *, NOT img OR (first AND NOT gate AND dom) AS page FROM g),
    k AS (SELECT *, page AND coalesce(sum(CASE WHEN page THEN 1 ELSE 0 END) OVER (PARTITION BY u ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS page_ok FROM h),
    o AS (SELECT *, first AND NOT failed AND gate AS image FROM k WHERE (first AND NOT failed AND gate) OR (page_ok AND NOT (first AND failed) AND NOT (first AND gate))),
    v AS (SELECT *, CASE WHEN image THEN {_FOOD_OCR} END AS ft, {_EXP_DOM} AS ed, CASE WHEN image THEN {_EXP_OCR} END AS eo, {_STORE_DOM} AS sd, CASE WHEN image THEN {_STORE_OCR} END AS so, {_TYPE_DOM} AS td, {_NAME} AS name FROM o),
    m AS (SELECT *, coalesce(ed, eo) AS e, coalesce(sd, so) AS s, ed IS NOT NULL AND eo = '5일' AS e_bad, sd IS NOT NULL AND so = '냉동 보관' AS s_bad,
        CASE WHEN ed IS NULL AND eo IS NULL THEN 'NOT_FOUND' WHEN eo IS NULL THEN 'DOM' WHEN ed IS NULL THEN 'OCR' WHEN eo = '5일' THEN 'DOM' ELSE 'DOM_AND_OCR' END AS es,
        CASE WHEN sd IS NULL AND so IS NULL THEN 'NOT_FOUND' WHEN so IS NULL THEN 'DOM' WHEN sd IS NULL THEN 'OCR' WHEN so = '냉동 보관' THEN 'DOM' ELSE 'DOM_AND_OCR' END AS ss FROM v)
    SELECT 'b' AS batch_id, 'S' AS source_site, CAST(u AS VARCHAR) AS original_product_id, name AS product_name_raw, event_type AS food_name_candidate, 'u/' || u AS product_url, CAST(NULL AS VARCHAR) AS sales_unit_raw,
        CAST(p % 9 AS VARCHAR) AS quantity_raw, ft AS food_type_raw, CASE WHEN ft IS NULL THEN 'NOT_FOUND' ELSE 'OCR' END AS food_type_source, e AS expiration_info_raw, es AS expiration_source,
        s AS storage_method_raw, ss AS storage_source,
        CASE WHEN td <> '' THEN td WHEN image AND (contains(coalesce(s, ''), '냉동') OR contains(coalesce(name, ''), '냉동')) THEN 'FROZEN' WHEN image AND contains(coalesce(s, ''), '냉장') THEN 'REFRIGERATED' ELSE 'UNKNOWN' END AS storage_type,
        CASE WHEN image THEN CAST(p % 100 AS DOUBLE) / 100 END AS ocr_confidence, 'c1' AS crawl_collected_at, CASE WHEN image THEN 'o1' END AS ocr_collected_at, '0.1.0' AS parser_version,
        CASE WHEN e_bad OR s_bad THEN 'REVIEW_REQUIRED' WHEN ft IS NULL AND e IS NULL AND s IS NULL THEN 'FIELD_NOT_FOUND' ELSE 'MATCHED' END AS validation_status,
        CASE WHEN coalesce(e, s, CASE WHEN image THEN ft ELSE name END) IS NOT NULL THEN 'COMPLETED' ELSE 'FIELD_PARSE_FAILED' END AS parse_status,
        'S:' || u || CASE WHEN image THEN ':' || sha256(CAST(c AS VARCHAR))[1:12] ELSE '' END AS source_record_id, CASE WHEN image THEN sha256(CAST(c AS VARCHAR)) END AS image_sha256 FROM m"""

QUERIES = [(product_records, _RECORDS)]

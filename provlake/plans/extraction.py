"""Queries over text: blanks, lines, labelled values, keywords, names."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import extract, text
from provlake.operators import publish
from provlake.plans.discovery import table
from provlake.sources.shared import spread

#: Names by row, in words that Spark and the SQL read alike.
STORED_NAME = """CASE p_partkey % 9 WHEN 0 THEN concat(p_name, ' 냉장') WHEN 1 THEN concat('Frozen ', p_name) WHEN 2 THEN concat(p_name, ' REFRIGERATED / frozen') WHEN 3 THEN concat('[실온] ', p_name, ' 냉동')
    WHEN 4 THEN concat(p_name, ' Room Temperature') WHEN 5 THEN concat('상온', p_name) WHEN 6 THEN concat(p_name, '냉동 냉장') WHEN 7 THEN p_name END"""


def blank_to_null(spark, d):
    return table(spark, d, "documents").select("doc_id", text.blank_to_null(F.regexp_extract("text", "\n([^\n]*)$", 1)).alias("last_line"),
        text.optional_double(F.regexp_extract("text", "([0-9]+[.][0-9]+)", 1)).alias("number"))


def lines_explode(spark, d):
    lines = F.filter(F.transform(F.split("text", "\n"), lambda v: F.regexp_replace(F.trim(v), " +", " ")), lambda v: v != "")
    return table(spark, d, "documents").select("doc_id", F.posexplode(lines).alias("pos", "line"))


def labelled_text(spark, d):
    return table(spark, d, "documents").select("doc_id", extract.labelled_text("text", ("The", "And the", "In")).alias("value"))


def _page_texts(spark, d):
    """Invented page texts with a number of the part in them."""
    k, n = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit("소비기한 2026-01-"), n, F.lit("\n보관방법 : 냉장 보관")))
        .when(k == 1, F.concat(F.lit("・소비기한\n제조일로부터 "), n, F.lit("일\n보관안내 실온")))
        .when(k == 2, F.concat(F.lit("식품의 유형 | 두부\n품질유지기한: "), n, F.lit("개월\r\n보존 및 유통온도\n-18℃ 이하")))
        .when(k == 3, "")
        .otherwise(F.concat(F.lit("판매단위\n"), n, F.lit("팩\n중량/용량\n300g\n"), n, F.lit("개입")))
    )
    return spread(table(spark, d, "part").select("p_partkey", "p_size")).withColumn("text", text)


def page_fields(spark, d):
    return _page_texts(spark, d).select("p_partkey", *extract.page_fields("text", F.lit("두부 300g")))


def disclosure_value(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", extract.disclosure_value("text", ("the", "und", "que")).alias("value"))


def disclosure_literal(spark, d):
    return _page_texts(spark, d).select("p_partkey", extract.disclosure_fields("text").alias("f")).select("p_partkey", "f.*")


def keyword_gate(spark, d):
    return table(spark, d, "documents").select("doc_id", extract.has_keywords("text", ("the and", "trash", "und die")).alias("hit"))


def storage_types(spark, d):
    n = table(spark, d, "part").selectExpr("p_partkey AS id", f"{STORED_NAME} AS name")
    return n.select("id", extract.storage_type("name").alias("crawl"), extract.storage_type("name", frozen_first=True).alias("ocr"))


def name_candidate(spark, d):
    k = F.col("p_partkey") % 3
    name = F.when(k == 0, F.concat(F.lit("[마을] 국내산 "), "p_name", F.lit(" "), "p_size", F.lit("g (냉장)"))).when(k == 1,
        F.concat(F.lit("한우 "), "p_name", F.lit(" 1.5kg"))).otherwise(F.concat(F.lit(" - "), "p_name", F.lit(" /")))
    return table(spark, d, "part").select("p_partkey", extract.food_name(name).alias("candidate"), extract.weight_in(name).alias("weight"))


def part_name_candidate(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", extract.food_name(F.concat(F.lit("[x] "), "p_name", F.lit(" 12 kg"))).alias("candidate"))


def silver_normalize(spark, d):
    k, n = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    text = F.when(k == 0, F.concat(F.lit("제조일로부터 "), n, F.lit("일"))).when(k == 1, F.concat(n, F.lit(" months from packaging"))).when(k == 2,
        F.concat(F.lit("<b>수령</b> 후&nbsp;"), n, F.lit("시간"))).when(k == 3, "unknown")
    e = table(spark, d, "part").select("p_partkey", publish.clean_text(text).alias("text"), publish.expiration_parts(text).alias("p"))
    return e.select("p_partkey", "text", F.col("p.value").alias("value"), F.col("p.unit").alias("unit"), F.col("p.basis").alias("basis"))


_LABELS = """
    WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda v: trim(regexp_replace(v, '\\s+', ' ', 'g'))), lambda v: v <> '') AS lines FROM documents),
    x AS (SELECT doc_id, i, lines[i] AS line, lines[i + 1] AS nxt FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM l)),
    j AS (SELECT * FROM (VALUES (1, 'And the', 'Andthe', '(?i)And\\s*the'), (2, 'The', 'The', '(?i)The'), (3, 'In', 'In', '(?i)In')) AS t(k, label, tight, pat)),
    c AS (SELECT doc_id, i, k, ltrim(trim(ltrim(trim(regexp_replace(line, pat, '')), ' |:：・·'))) AS rest, nxt FROM x, j
        WHERE strpos(regexp_replace(line, '\\s+', '', 'g'), tight) > 0
        AND left(regexp_replace(line, '\\s+', '', 'g'), strpos(regexp_replace(line, '\\s+', '', 'g'), tight) - 1) IN ('', '・', '-', '·')),
    v AS (SELECT doc_id, i, k, coalesce(nullif(rest, ''), nxt) AS value FROM c)
    SELECT d.doc_id, value FROM documents d LEFT JOIN (SELECT doc_id, value FROM v WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i, k) = 1) USING (doc_id)"""
_DISCLOSURE = """
    WITH l AS (SELECT conv_id, turn, list_filter(list_transform(string_split(text, chr(10)), lambda v: trim(regexp_replace(v, '\\s+', ' ', 'g'), ' |:：')), lambda v: v <> '') AS lines FROM conversations),
    x AS (SELECT conv_id, turn, i, lines[i] AS line, lines[i + 1] AS nxt FROM (SELECT conv_id, turn, lines, unnest(generate_series(1, len(lines))) AS i FROM l)),
    j AS (SELECT * FROM (VALUES (1, 'the'), (2, 'und'), (3, 'que')) AS t(k, label)),
    v AS (SELECT conv_id, turn, i, k, coalesce(nullif(trim(regexp_replace(line, '(?i)' || label, ''), ' |:：'), ''), nxt) AS value FROM x, j WHERE contains(regexp_replace(line, '\\s+', '', 'g'), label))
    SELECT c.conv_id, c.turn, value FROM conversations c LEFT JOIN (SELECT * FROM v WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY i, k) = 1) USING (conv_id, turn)"""

QUERIES = [
    (blank_to_null, r"""SELECT doc_id, nullif(trim(regexp_extract(text, '\n([^\n]*)$', 1)), '') AS last_line, TRY_CAST(nullif(regexp_extract(text, '([0-9]+[.][0-9]+)', 1), '') AS DOUBLE) AS number FROM documents"""),
    (lines_explode, """SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS line FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda v: regexp_replace(trim(v), ' +', ' ', 'g')), lambda v: v <> '') AS l FROM documents)"""),
    (labelled_text, _LABELS),
    (page_fields, """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '2026-01-' || p_size WHEN 1 THEN '제조일로부터 ' || p_size || '일' WHEN 2 THEN p_size || '개월' END AS expiration_info_dom,
        CASE p_partkey % 5 WHEN 0 THEN '냉장 보관' WHEN 1 THEN '실온' END AS storage_method_dom, CASE p_partkey % 5 WHEN 0 THEN 'REFRIGERATED' WHEN 1 THEN 'ROOM_TEMPERATURE' ELSE 'UNKNOWN' END AS storage_type_dom, '두부' AS food_name_candidate, '300g' AS weight_raw,
        CASE WHEN p_partkey % 5 = 4 THEN p_size || '개입' END AS quantity_raw, CASE WHEN p_partkey % 5 = 4 THEN p_size || '팩' END AS sales_unit_raw FROM part"""),
    (disclosure_value, _DISCLOSURE),
    (disclosure_literal, """SELECT p_partkey, CASE WHEN p_partkey % 5 = 2 THEN '두부' END AS food_type_raw, CASE p_partkey % 5 WHEN 0 THEN '2026-01-' || p_size WHEN 1 THEN '・' WHEN 2 THEN p_size || '개월' END AS expiration_info_raw,
        CASE p_partkey % 5 WHEN 0 THEN '냉장 보관' WHEN 2 THEN '-18℃ 이하' END AS storage_method_raw, p_partkey % 5 < 3 AS has_any_value FROM part"""),
    (keyword_gate, "SELECT doc_id, contains(replace(text, ' ', ''), 'theand') OR contains(replace(text, ' ', ''), 'trash') OR contains(replace(text, ' ', ''), 'unddie') AS hit FROM documents"),
    (storage_types, f"""WITH n AS (SELECT id, lower(coalesce(name, '')) AS t FROM (SELECT p_partkey AS id, {STORED_NAME} AS name FROM part)),
        m AS (SELECT id, contains(t, '냉장') OR contains(t, 'refrigerat') AS c, contains(t, '냉동') OR contains(t, 'frozen') AS f, contains(t, '상온') OR contains(t, '실온') OR contains(t, 'room temperature') AS r FROM n)
        SELECT id, CASE WHEN c THEN 'REFRIGERATED' WHEN f THEN 'FROZEN' WHEN r THEN 'ROOM_TEMPERATURE' ELSE 'UNKNOWN' END AS crawl, CASE WHEN f THEN 'FROZEN' WHEN c THEN 'REFRIGERATED' WHEN r THEN 'ROOM_TEMPERATURE' ELSE 'UNKNOWN' END AS ocr FROM m"""),
    (name_candidate, "SELECT p_partkey, p_name AS candidate, CASE p_partkey % 3 WHEN 0 THEN p_size || 'g' WHEN 1 THEN '1.5kg' END AS weight FROM part"),
    (part_name_candidate, "SELECT p_partkey, trim(p_name, ' -/') AS candidate FROM part"),
    (silver_normalize, """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '제조일로부터 ' || p_size || '일' WHEN 1 THEN p_size || ' months from packaging' WHEN 2 THEN '수령 후 ' || p_size || '시간' WHEN 3 THEN 'unknown' END AS text,
        CASE WHEN p_partkey % 5 < 3 THEN CAST(p_size AS DOUBLE) END AS value, CASE p_partkey % 5 WHEN 0 THEN 'DAY' WHEN 1 THEN 'MONTH' WHEN 2 THEN 'HOUR' END AS unit, CASE p_partkey % 5 WHEN 0 THEN 'MANUFACTURE' WHEN 1 THEN 'PACKAGING' WHEN 2 THEN 'RECEIPT' END AS basis FROM part"""),
]

"""Queries over reconciliation in tiers: parts as products, and the same parts with other names, codes and storage as the reference."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.operators import reconcile
from provlake.plans.discovery import table
from provlake.sources.shared import spread, written

LEAST = 600
APPROVE = 0.9
#: Expressions that Spark and the SQL read alike; tail: the words that make a part's name its own.
_PART = {
    "brand": "CASE WHEN p_partkey % 3 = 0 THEN 'brand 11' ELSE lower(replace(p_brand, '#', ' ')) END",
    "sort": "lower(p_type)",
    "tail": "concat('n', p_size, ' k', p_partkey % 211)",
    "storage": "CASE p_size % 3 WHEN 0 THEN 'ROOM' WHEN 1 THEN 'COLD' ELSE 'FROZEN' END",
}
_REFERENCE_NAME = """CASE p_partkey % 7 WHEN 0 THEN reverse(concat(p_name, tail)) WHEN 1 THEN concat(brand, ' ', p_name, ' ', sort, ' ', tail)
    WHEN 2 THEN concat(brand, ' {note}', p_name, ' ', sort, ' ', tail) WHEN 3 THEN concat(p_name, ' ', sort, ' ', tail) WHEN 4 THEN concat(brand, ' ', p_name, ' other ', tail)
    WHEN 5 THEN concat(p_name, ' ', tail) ELSE concat(brand, ' grand ', sort, ' ', tail) END"""


def _tables(spark, d):
    """A third of all parts has one brand."""
    p = spread(table(spark, d, "part")).selectExpr("*", *[f"{e} AS {n}" for n, e in _PART.items()])
    name = "concat('<b>', upper(brand), '</b> ', p_name, ' ', sort, ' ', tail)"
    products = p.selectExpr("p_partkey AS product_id", f"{name} AS name", "if(p_partkey % 5 = 0, p_partkey, null) AS code", "p_type AS category",
        "if(p_size % 9 = 0, null, storage) AS storage", "p_size AS days")
    reference = p.selectExpr(
        "p_partkey AS reference_id", f"{_REFERENCE_NAME.format(note='[spare] ')} AS name", "if(p_partkey % 2 = 0, p_partkey, null) AS code",
            "p_type AS category",
        "if(p_partkey % 11 = 0, 'JAR', storage) AS storage", "if(p_size % 4 = 0, p_size + 1, p_size) AS days",
    )
    ready = lambda rows: written(reconcile.standardized(rows).withColumn("code", F.col("code").cast("string")))
    return ready(products), ready(reference)


def reconcile_match(spark, d):
    products, reference = _tables(spark, d)
    return reconcile.match(products, reference, LEAST, keep=written)


def reconcile_evidence(spark, d):
    products, reference = _tables(spark, d)
    matches = reconcile.match(products, reference, LEAST, keep=written)
    return reconcile.resolve(products, reference, matches, ["storage", "days"], APPROVE)


def reconcile_review(spark, d):
    return reconcile.review_queue(reconcile_evidence(spark, d))


_MATCH_SQL = f"""
    parts AS (SELECT *, {", ".join(f"{e} AS {n}" for n, e in _PART.items())} FROM part),
    products AS (
        SELECT p_partkey AS product_id, concat(brand, ' ', p_name, ' ', sort, ' ', tail) AS name, CASE WHEN p_partkey % 5 = 0 THEN p_partkey END AS code, p_type AS category,
            CASE WHEN p_size % 9 <> 0 THEN storage END AS storage, p_size AS days FROM parts),
    reference AS (
        SELECT p_partkey AS reference_id, CASE WHEN p_partkey % 2 = 0 THEN p_partkey END AS code, p_type AS category, CASE WHEN p_partkey % 11 = 0 THEN 'JAR' ELSE storage END AS storage,
            CASE WHEN p_size % 4 = 0 THEN p_size + 1 ELSE p_size END AS days, {_REFERENCE_NAME.format(note="")} AS name
        FROM parts),
    names AS (SELECT DISTINCT name FROM reference),
    counts AS (SELECT word, count(*) AS n FROM (SELECT DISTINCT name, unnest(string_split(name, ' ')) AS word FROM names) GROUP BY word),
    own AS (SELECT DISTINCT name, unnest(string_split(name, ' ')) AS word FROM (SELECT name FROM products UNION SELECT name FROM reference)),
    weighed AS (
        SELECT name, word, CAST(floor(1000 * ln(1 + (SELECT count(*) FROM names) / (1 + coalesce(n, 0)))) AS BIGINT) + 1 AS weight
        FROM own LEFT JOIN counts USING (word)),
    sums AS (SELECT name, sum(weight) AS weight, count(*) AS words FROM weighed GROUP BY name),
    met AS (
        SELECT a.name, b.name AS other, sum(a.weight) AS weight, count(*) AS words FROM weighed a JOIN weighed b USING (word)
        WHERE a.name IN (SELECT name FROM products) AND b.name IN (SELECT name FROM reference) GROUP BY ALL),
    near AS (
        SELECT met.name, other, met.words, x.words AS n_words, y.words AS r_words, floor(1000 * y.weight / x.weight) AS covered,
            floor(1000 * met.weight / (x.weight + y.weight - met.weight)) AS similarity
        FROM met JOIN sums x ON x.name = met.name JOIN sums y ON y.name = other),
    found AS (
        SELECT product_id, reference_id, 1 AS tier, 1000 AS s FROM products JOIN reference USING (code)
        UNION ALL SELECT product_id, reference_id, 2, 950 FROM products JOIN reference USING (name)
        UNION ALL SELECT product_id, reference_id, 3, covered FROM products p JOIN near USING (name) JOIN reference r ON r.name = other AND r.category = p.category AND r.storage = p.storage
            WHERE near.words = r_words
        UNION ALL SELECT product_id, reference_id, 4, similarity FROM products JOIN near USING (name) JOIN reference r ON r.name = other WHERE similarity >= {LEAST}),
    best AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY tier, s DESC, reference_id) = 1),
    matched AS (
        SELECT product_id, reference_id, CASE tier WHEN 1 THEN 'CODE' WHEN 2 THEN 'NAME' WHEN 3 THEN 'CONDITIONAL' WHEN 4 THEN 'FUZZY' ELSE 'NONE' END AS match_type,
            coalesce(s, 0) / 1000 AS confidence
        FROM products LEFT JOIN best USING (product_id))"""

_EVIDENCE_SQL = f"""{_MATCH_SQL},
    fields AS (
        SELECT m.*, f.* FROM matched m JOIN products p USING (product_id) LEFT JOIN reference r USING (reference_id),
            LATERAL (VALUES ('storage', p.storage, r.storage), ('days', CAST(p.days AS VARCHAR), CAST(r.days AS VARCHAR))) AS f (field, a, b)),
    ruled AS (
        SELECT *, CASE WHEN a IS NULL AND b IS NULL THEN 'R01_NO_VALUE' WHEN b IS NULL THEN 'R02_NO_REFERENCE' WHEN a = b THEN 'R03_AGREEMENT'
            WHEN match_type IN ('CODE', 'NAME') THEN 'R04_CERTAIN_REFERENCE' WHEN a IS NULL THEN 'R05_FILL_GAP' ELSE 'R06_CONFLICT' END AS rule_id FROM fields),
    evidence AS (
        SELECT product_id, reference_id, field, a AS original_value, b AS reference_value, CASE WHEN rule_id[3] IN ('4', '5') THEN b ELSE a END AS chosen_value,
            CASE rule_id[3] WHEN '1' THEN 'NONE' WHEN '4' THEN 'REFERENCE' WHEN '5' THEN 'REFERENCE' ELSE 'ORIGINAL' END AS selected_source, rule_id, '1.0.0' AS rule_version,
            match_type, confidence, CASE WHEN rule_id[3] IN ('1', '6') OR (b IS NOT NULL AND confidence < {APPROVE}) THEN 'REVIEW_REQUIRED' ELSE 'APPROVED' END AS review_status
        FROM ruled)"""

QUERIES = [
    (reconcile_match, f"WITH {_MATCH_SQL} SELECT * FROM matched"),
    (reconcile_evidence, f"WITH {_EVIDENCE_SQL} SELECT * FROM evidence"),
    (reconcile_review, f"""WITH {_EVIDENCE_SQL} SELECT product_id, any_value(reference_id) AS reference_id, any_value(match_type) AS match_type, min(confidence) AS confidence,
        string_agg(field, ',' ORDER BY field) AS fields FROM evidence WHERE review_status = 'REVIEW_REQUIRED' GROUP BY product_id"""),
]

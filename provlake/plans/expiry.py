"""Queries over shelf lives of several sentences and of spoiled text."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.operators import publish
from provlake.plans.discovery import table

#: Texts by row, in words that Spark and the SQL read alike; n is the part's size, from 1 to 50.
_TEXT = """CASE p_partkey % 8 WHEN 0 THEN concat('제조일로부터 ', p_size, '일. 개봉 후 3일 이내') WHEN 1 THEN concat('Keep frozen.\\n', p_size, ' months from packaging') WHEN 2 THEN concat('제 조 일 로부터 ', p_size, ' 개월; 실온')
    WHEN 3 THEN concat('수령 후 ', p_size, 'O시간') WHEN 4 THEN concat('<li>', p_size, ' days</li><li>', p_size + p_partkey % 3, ' days</li>') WHEN 5 THEN concat(p_size, ' . 5 weeks after receipt') WHEN 6 THEN p_name END"""


def expiry_choices(spark, d):
    p = table(spark, d, "part").selectExpr("p_partkey", f"{_TEXT} AS text")
    return p.select("p_partkey", publish.expiration_choice("text").alias("c")).select("p_partkey", "c.*")


def expiry_sentences(spark, d):
    p = table(spark, d, "part").selectExpr("p_partkey", f"{_TEXT} AS text")
    return p.select("p_partkey", F.posexplode(publish.expiration_sentences("text")).alias("i", "e")).select("p_partkey", "i", "e.*")


_K = "p_partkey % 8"
QUERIES = [
    (expiry_choices, f"""SELECT p_partkey, CASE {_K} WHEN 3 THEN p_size * 10.0::DOUBLE WHEN 5 THEN p_size + 0.5::DOUBLE ELSE CASE WHEN {_K} < 5 THEN CAST(p_size AS DOUBLE) END END AS value,
        CASE {_K} WHEN 0 THEN 'DAY' WHEN 1 THEN 'MONTH' WHEN 2 THEN 'MONTH' WHEN 3 THEN 'HOUR' WHEN 4 THEN 'DAY' WHEN 5 THEN 'WEEK' END AS unit,
        CASE {_K} WHEN 0 THEN 'MANUFACTURE' WHEN 1 THEN 'PACKAGING' WHEN 2 THEN 'MANUFACTURE' WHEN 3 THEN 'RECEIPT' WHEN 4 THEN 'UNKNOWN' WHEN 5 THEN 'RECEIPT' END AS basis,
        CASE {_K} WHEN 1 THEN 'FROZEN' WHEN 2 THEN 'ROOM' END AS storage, {_K} = 4 AND p_partkey % 3 <> 0 AS conflict FROM part"""),
    (expiry_sentences, f"""SELECT p_partkey, 0 AS i, CASE {_K} WHEN 3 THEN p_size * 10.0::DOUBLE WHEN 5 THEN p_size + 0.5::DOUBLE WHEN 1 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS value,
        CASE {_K} WHEN 0 THEN 'DAY' WHEN 2 THEN 'MONTH' WHEN 3 THEN 'HOUR' WHEN 4 THEN 'DAY' WHEN 5 THEN 'WEEK' END AS unit,
        CASE {_K} WHEN 0 THEN 'MANUFACTURE' WHEN 2 THEN 'MANUFACTURE' WHEN 3 THEN 'RECEIPT' WHEN 4 THEN 'UNKNOWN' WHEN 5 THEN 'RECEIPT' END AS basis, CASE {_K} WHEN 1 THEN 'FROZEN' END AS storage FROM part WHERE {_K} < 6
        UNION ALL SELECT p_partkey, 1, CASE {_K} WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN CAST(p_size AS DOUBLE) WHEN 4 THEN CAST(p_size + p_partkey % 3 AS DOUBLE) END, CASE {_K} WHEN 0 THEN 'DAY' WHEN 1 THEN 'MONTH' WHEN 4 THEN 'DAY' END,
        CASE {_K} WHEN 0 THEN 'OPENING' WHEN 1 THEN 'PACKAGING' WHEN 4 THEN 'UNKNOWN' END, CASE {_K} WHEN 2 THEN 'ROOM' END FROM part WHERE {_K} IN (0, 1, 2, 4)"""),
]

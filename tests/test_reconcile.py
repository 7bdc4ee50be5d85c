"""Reconciliation in tiers against all pairs in plain Python, and the resolver's choices."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from provlake.operators import reconcile
from provlake.plans import matching

rnd = random.Random(5)
WORDS = [f"w{i}" for i in range(60)]
P_SCHEMA = "product_id int, name string, code string, category string, storage string, days int"


def name():
    own = rnd.sample(WORDS, rnd.randrange(1, 6))
    return " ".join([*(["hot", "brand"] if rnd.random() < 0.4 else []), *own])


def rows_of(n):
    out = []
    for i in range(n):
        out.append((i, rnd.choice([None, *[name() for _ in range(30)]]), rnd.choice([None] * 5 + [f"c{rnd.randrange(40)}"]), rnd.choice([None, "x", "y"]), rnd.choice([None, "ROOM", "COLD"]), rnd.choice([None, 3, 4])))
    return out


PRODUCTS, REFERENCE = rows_of(250), rows_of(250)
PRODUCTS += [(7, "repeated id", None, "x", "ROOM", 1), (7, REFERENCE[9][1], None, None, None, 1)]
REFERENCE += [(900 + i, r[1], None, r[3], r[4], 5) for i, r in enumerate(PRODUCTS[:40]) if r[1]]
REFERENCE += [(500 + i, " ".join(r[1].split()[1:]) or None, None, r[3], r[4], 5) for i, r in enumerate(PRODUCTS[40:120]) if r[1]]


@pytest.fixture(scope="module")
def tables(spark):
    p = spark.createDataFrame(PRODUCTS, P_SCHEMA)
    return p, spark.createDataFrame(REFERENCE, P_SCHEMA.replace("product_id", "reference_id"))


def weigher():
    names = {r[1] for r in REFERENCE if r[1]}
    n = Counter(w for x in names for w in set(x.split()))
    return lambda w: math.floor(1000 * math.log(1 + len(names) / (1 + n[w]))) + 1


def expected(least):
    weight = weigher()
    sums = lambda ws: sum(map(weight, ws))
    best = {}
    for p in PRODUCTS:
        found = []
        own = set((p[1] or "").split())
        for r in REFERENCE:
            other = set((r[1] or "").split())
            if p[2] and p[2] == r[2]:
                found.append((1, -1000, r[0]))
            if not own or not other:
                continue
            if p[1] == r[1]:
                found.append((2, -950, r[0]))
            if p[3] and p[3] == r[3] and p[4] and p[4] == r[4] and other <= own:
                found.append((3, -(1000 * sums(other) // sums(own)), r[0]))
            if (s := 1000 * sums(own & other) // sums(own | other)) >= least:
                found.append((4, -s, r[0]))
        best[p[0]] = min([*found, best.get(p[0], (5, 0, None))], key=lambda x: (x[0], x[1], x[2] if x[2] is not None else -1))
    kinds = ["", "CODE", "NAME", "CONDITIONAL", "FUZZY", "NONE"]
    return {k: (r, kinds[t], -s / 1000) for k, (t, s, r) in best.items()}


@pytest.mark.parametrize("least", [300, 600, 900])
def test_match_equals_all_pairs(tables, least):
    got = {r.product_id: (r.reference_id, r.match_type, r.confidence) for r in reconcile.match(*tables, least=least).collect()}
    want = expected(least)
    assert got == want
    assert {k for _, k, _ in want.values()} >= {"CODE", "NAME", "CONDITIONAL", "NONE"}


def test_all_tiers_and_sources_in_the_query(spark):
    e = matching.reconcile_evidence(spark, "/root/testdata/sf0.001")
    assert {r.match_type for r in e.select("match_type").distinct().collect()} == {"CODE", "NAME", "CONDITIONAL", "FUZZY", "NONE"}
    assert {r.rule_id[:3] for r in e.select("rule_id").distinct().collect()} >= {"R02", "R03", "R04", "R06"}
    assert e.where("chosen_value is null and selected_source <> 'NONE'").count() == 0


def test_standard_name(spark):
    df = spark.createDataFrame([("<b>[새벽] Big  Apple</b>&nbsp;(1.5kg)",), ("  ",), (None,), ("[only]",), ("사과-배",)], "n string")
    assert [r[0] for r in df.select(reconcile.standard_name("n")).collect()] == ["big apple 1 5kg", None, None, None, "사과 배"]


def test_no_rows(spark, tables):
    p, r = tables
    assert reconcile.match(p.where("false"), r, 600).count() == 0
    none = reconcile.match(p, r.where("false"), 600)
    assert {x.match_type for x in none.collect()} == {"NONE"}


def test_a_hot_word_is_in_no_prefix(spark):
    """A word that a third of all names hold does not join: candidates stay far below the pairs of those names."""
    n = 3000
    names = spark.range(n).selectExpr("concat('hot k', id, ' m', id % 50, ' z', id % 7) as name")
    total = names.agg(F.count("*").alias("_total"))
    own = reconcile.weighed(names, reconcile.word_weights(names), total).cache()
    keys = reconcile.prefixes(own, 600)
    assert keys.where("key = 'hot'").count() == 0
    assert keys.groupBy("key").count().agg(F.sum(F.col("count") ** 2)).first()[0] < n * n / 20
    assert reconcile.similar_names(own, own, 600).where("name = other").count() == n


def test_resolver_follows_the_first_rule(spark):
    p = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, "a"), (5, None)], "product_id int, v string")
    r = spark.createDataFrame([(10, "b"), (11, "b"), (12, "a")], "reference_id int, v string")
    m = spark.createDataFrame([(1, 10, "CODE", 1.0), (2, 11, "FUZZY", 0.7), (3, 12, "NAME", 0.95), (4, 10, "FUZZY", 0.95), (5, None, "NONE", 0.0)], "product_id int, reference_id int, match_type string, confidence double")
    got = {x.product_id: (x.chosen_value, x.selected_source, x.rule_id[:3], x.review_status) for x in reconcile.resolve(p, r, m, ["v"], 0.9).collect()}
    assert got == {
        1: ("b", "REFERENCE", "R04", "APPROVED"), 2: ("b", "REFERENCE", "R05", "REVIEW_REQUIRED"), 3: ("a", "ORIGINAL", "R03", "APPROVED"),
        4: ("a", "ORIGINAL", "R06", "REVIEW_REQUIRED"), 5: (None, "NONE", "R01", "REVIEW_REQUIRED"),
    }


def test_short_names_are_not_compared_pair_by_pair(spark, tables, monkeypatch):
    """Names of a small vocabulary were compared with all names of their prefix words: rows with the square of the names."""
    given, similar = [], reconcile.similar_names
    monkeypatch.setattr(reconcile, "similar_names", lambda a, b, least: given.append((a, b)) or similar(a, b, least))
    assert reconcile.match(*tables, least=300).count() == len({p[0] for p in PRODUCTS})
    assert all(0 in (a.count(), b.count()) for a, b in given)


@pytest.mark.parametrize("short", [0, 3, 10])
def test_sets_of_words_and_long_names_equal_all_pairs(tables, monkeypatch, short):
    monkeypatch.setattr(reconcile, "SHORT", short, raising=False)
    assert {r.product_id: (r.reference_id, r.match_type, r.confidence) for r in reconcile.match(*tables, least=400).collect()} == expected(400)

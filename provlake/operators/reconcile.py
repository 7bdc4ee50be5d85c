"""Matching products with a reference in tiers, and choosing each field's value with the evidence kept.

Tiers, tried in this order; a product that one tier matches takes no part in the later ones:

* CODE: the same explicit code.
* NAME: the same standard name.
* CONDITIONAL: the same category and storage, and all words of the reference's name in the product's.
* FUZZY: names whose words, weighted by rarity, have a Jaccard similarity of at least `least`.
* NONE: no reference.

Words are weighted by their inverse frequency in the reference's distinct names, in whole numbers, so sums do not depend on their
order.  The best fuzzy reference of a name of at most SHORT words comes without comparing names: each name is dealt under every set of
its words that weighs `least` of it.  Names that are similar enough meet under the words they share, and a set needs to know only
the least reference_id of the names that hold it, by their weight: rows grow with the names, not with their pairs.

Longer names, whose sets are too many, come from a prefix filter: a name's words stand in order of rarity, and its prefix is the fewest
first words without which the rest weighs less than `least` of the name.  Two names that are similar enough share a word of both
prefixes, so the join is on prefix words only, and a word that a third of all names hold (a brand) is in hardly any prefix.  A
pair is kept at its first common word alone, so no pair is found twice.  Names are compared once, however many rows have them.

Null or empty name: no NAME, CONDITIONAL or FUZZY match.  Null code, category or storage: matches nothing.  Ties: the least
reference_id.  Rows with the same product id share one match, the best of theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provlake.functions.text import col
from provlake.operators.publish import clean_text
from provlake.sources.shared import spread

CERTAIN = {"CODE": 1000, "NAME": 950}
#: Words of a name all of whose heavy sets of words are listed: 1,024 at most.
SHORT = 10


def standard_name(x: str | Column) -> Column:
    """Lower case, without tags and [notes]; other characters than letters and digits are blanks.  Null if nothing is left."""
    t = F.regexp_replace(F.lower(clean_text(x)), r"\[[^\]]*\]", " ")
    return F.nullif(F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " ")), F.lit(""))


def word_weights(names: DataFrame) -> DataFrame:
    """(word, weight) of the words of distinct names (name); the weight of a word in n of N names is 1000 ln(1 + N / (1 + n)), rounded down, plus 1."""
    words = names.select(F.explode(F.array_distinct(F.split("name", " "))).alias("word"))
    total = names.agg(F.count("*").alias("_total"))  # one row
    return words.groupBy("word").agg(F.count("*").alias("_n")).crossJoin(F.broadcast(total)).select("word",
        _weight(F.col("_total"), F.col("_n")).alias("weight"))


def _weight(total: Column, n: Column) -> Column:
    return F.floor(1000 * F.ln(1 + total / (1 + n))).cast("long") + 1


def weighed(names: DataFrame, weights: DataFrame, total: DataFrame) -> DataFrame:
    """(name, words, weight): distinct words, the rarest first, and their sum.  Words without a weight weigh as words of no name."""
    words = names.select("name", F.explode(F.array_distinct(F.split("name", " "))).alias("word"))
    known = words.join(weights, "word", "left").crossJoin(F.broadcast(total))
    known = known.withColumn("weight", F.coalesce("weight", _weight(F.col("_total"), F.lit(0))))
    entry = F.struct((-F.col("weight")).alias("rank"), "word", "weight")
    return known.groupBy("name").agg(F.array_sort(F.collect_list(entry)).alias("words"), F.sum("weight").alias("weight"))


def prefixes(names: DataFrame, least: int) -> DataFrame:
    """names (name, words, weight), once for each prefix word: key, and `rest`, what it and the words after it weigh."""
    step = F.struct(F.col("weight").alias("rest"), F.array().cast("array<struct<key:string,rest:bigint>>").alias("keys"))
    add = lambda at, w: F.struct(
        (at["rest"] - w["weight"]).alias("rest"),
        F.when(1000 * at["rest"] >= least * F.col("weight"),
            F.concat(at["keys"], F.array(F.struct(w["word"].alias("key"), at["rest"].alias("rest"))))).otherwise(at["keys"]).alias("keys"),
    )
    keys = F.aggregate("words", step, add)["keys"]
    return names.select("*", F.explode(keys).alias("_k")).select(*names.columns, "_k.key", "_k.rest")


def similar_names(left: DataFrame, right: DataFrame, least: int) -> DataFrame:
    """(name, other, similarity) of weighed names whose weighted Jaccard similarity is at least `least` thousandths."""
    a = prefixes(left, least)
    b = prefixes(right, least).select(*[F.col(c).alias(f"r_{c}") for c in ("name", "words", "weight", "key", "rest")])
    enough = F.least("rest", "r_rest") * 1000 >= least * F.greatest("weight", "r_weight")
    pairs = a.join(b, (F.col("key") == F.col("r_key")) & enough)
    held = F.transform("r_words", lambda w: w["word"])
    pairs = pairs.select("name", "r_name", "key", "weight", "r_weight", F.filter("words", lambda w: F.array_contains(held, w["word"])).alias("common"))
    both = F.aggregate("common", F.lit(0).cast("long"), lambda n, w: n + w["weight"])
    pairs = pairs.where(F.element_at("common", 1)["word"] == F.col("key")).withColumn("both", both)
    share = _share(F.col("both"), F.col("weight"), F.col("r_weight"))
    return pairs.select("name", F.col("r_name").alias("other"), share.alias("similarity")).where(F.col("similarity") >= least)


def _share(both: Column, weight: Column, r_weight: Column) -> Column:
    return F.floor(1000 * both / (weight + r_weight - both))


def heavy_sets(names: DataFrame, least: int) -> DataFrame:
    """names (name, words, weight), once for each set of its words that weighs at least `least` thousandths of it: key, the words in their order, and `both`, their weight."""
    start = F.array(F.struct(F.lit(0).cast("long").alias("gone"), F.lit("").alias("key")))
    kept = lambda w: lambda s: F.struct(s["gone"].alias("gone"), F.concat(s["key"], F.lit(" "), w["word"]).alias("key"))
    gone = lambda w: lambda s: F.struct((s["gone"] + w["weight"]).alias("gone"), s["key"].alias("key"))
    light = lambda s: 1000 * s["gone"] <= (1000 - least) * F.col("weight")
    sets = F.aggregate("words", start, lambda at, w: F.concat(F.transform(at, kept(w)), F.filter(F.transform(at, gone(w)), light)))
    each = spread(names).select("*", F.explode(sets).alias("_s")).where("_s.key <> ''")
    return each.select(*names.columns, "_s.key", (F.col("weight") - F.col("_s.gone")).alias("both"))


def most_similar(left: DataFrame, right: DataFrame, least: int) -> DataFrame:
    """(name, similarity, reference_id) of weighed names, those of right with a reference_id: the most similar one; of equals the least id.

    The words that two names share are a set of both.  Under any other set of both they count as less similar than they are, so the most similar row
    of a name is right.  Of the names under a set, one that weighs as much as another or more and has a greater id is never taken.
    """
    held = heavy_sets(right.where(F.size("words") <= SHORT), least).groupBy("key", F.col("weight").alias("r_weight")).agg(F.min("reference_id").alias("reference_id"))
    lighter = Window.partitionBy("key").orderBy("r_weight").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_id", F.min("reference_id").over(lighter)).where("_id is null or reference_id < _id").drop("_id")
    met = heavy_sets(left.where(F.size("words") <= SHORT), least).select("name", "weight", "key", "both").join(held, "key")
    met = met.select("name", _share(F.col("both"), F.col("weight"), F.col("r_weight")).alias("similarity"), "reference_id").where(F.col("similarity") >= least)
    long = lambda d: d.where(F.size("words") > SHORT)
    named = [similar_names(x, y, least) for x, y in ((long(left), right), (left.where(F.size("words") <= SHORT), long(right)))]
    ids = right.select(F.col("name").alias("other"), "reference_id")
    for found in named:
        met = met.unionByName(found.join(ids, "other").select("name", "similarity", "reference_id"))
    first = F.min_by(F.struct("similarity", "reference_id"), F.struct(-F.col("similarity"), "reference_id"))
    return met.groupBy("name").agg(first.alias("m")).select("name", "m.*")


def contained_names(products: DataFrame, reference: DataFrame) -> DataFrame:
    """(product_id, reference_id, similarity): same category and storage, the reference's words all in the product's.

    Both hold words and weight.  The join is on the reference's rarest word, so a large category does not meet itself.
    """
    r = reference.select("reference_id", F.col("category").alias("r_category"), F.col("storage").alias("r_storage"),
        F.transform("words", lambda w: w["word"]).alias("r_words"), F.col("weight").alias("r_weight"), F.col("words")[0]["word"].alias("r_key"))
    p = products.select("product_id", "category", "storage", F.transform("words", lambda w: w["word"]).alias("own"), "weight").withColumn("key",
        F.explode("own"))
    on = (p["category"] == r["r_category"]) & (p["storage"] == r["r_storage"]) & (p["key"] == r["r_key"])
    pairs = p.join(r, on).where(F.size(F.array_except("r_words", "own")) == 0)
    return pairs.select("product_id", "reference_id", F.floor(1000 * F.col("r_weight") / F.col("weight")).alias("similarity"))


def _best(pairs: DataFrame, tier: str) -> DataFrame:
    """The most similar reference of each product; of equals the one with the least id."""
    first = F.min_by(F.struct("reference_id", F.lit(tier).alias("match_type"), F.col("similarity").cast("long").alias("similarity")),
        F.struct(-F.col("similarity"), "reference_id"))
    return pairs.groupBy("product_id").agg(first.alias("m")).select("product_id", "m.*")


def match(products: DataFrame, reference: DataFrame, least: int, certain: Mapping[str, int] = CERTAIN,
    keep: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """(product_id, reference_id, match_type, confidence) of every product; NONE has no reference and confidence 0.

    Both tables: name (a standard name), code, category, storage, and product_id or reference_id.  least: thousandths.  keep: how tables that are read
    several times are kept (written to the shared folder, say).  The threshold has no default: it is for the data's owner to set.
    """
    cols = ("name", "code", "category", "storage")
    p, r = products.select("product_id", *cols), reference.select("reference_id", *cols)
    first = lambda c: r.groupBy(c).agg(F.min("reference_id").alias("reference_id"))  # noqa: E731  rows of one code or name do not meet pair by pair
    tier = lambda d, t: _best(d.select("product_id", "reference_id", F.lit(certain[t]).alias("similarity")), t)
    by_code = keep(tier(p.join(first("code"), "code"), "CODE"))
    p = p.join(by_code.select("product_id"), "product_id", "left_anti")
    by_name = keep(tier(p.join(first("name"), "name"), "NAME"))
    p = keep(p.join(by_name.select("product_id"), "product_id", "left_anti").where("name is not null"))

    known = r.where("name is not null").select("name").distinct()
    total = known.agg(F.count("*").alias("_total"))
    weights = keep(word_weights(known))
    right = keep(weighed(known, weights, total))
    left = keep(weighed(p.select("name").distinct(), weights, total))
    inside = keep(_best(contained_names(p.join(left, "name"), r.join(right, "name")), "CONDITIONAL"))
    p = p.join(inside.select("product_id"), "product_id", "left_anti")
    best = keep(most_similar(left.join(p.select("name").distinct(), "name", "left_semi"), right.join(first("name"), "name"), least))
    fuzzy = _best(p.join(best, "name").select("product_id", "reference_id", "similarity"), "FUZZY")

    found = by_code.unionByName(by_name).unionByName(inside).unionByName(fuzzy)
    out = products.select("product_id").distinct().join(found, "product_id", "left")
    return out.select("product_id", "reference_id", F.coalesce("match_type", F.lit("NONE")).alias("match_type"),
        (F.coalesce("similarity", F.lit(0)) / 1000).alias("confidence"))


@dataclass(frozen=True)
class Rule:
    """Which value is chosen where the condition holds.  It may read original, reference, match_type and confidence."""

    rule_id: str
    condition: Callable[[Column, Column], Column] = field(repr=False)
    choice: str  # ORIGINAL, REFERENCE or NONE
    review: bool = False


def _matched(*tiers: str) -> Column:
    return F.col("match_type").isin(*tiers)


RULES = (
    Rule("R01_NO_VALUE", lambda a, b: a.isNull() & b.isNull(), "NONE", review=True),
    Rule("R02_NO_REFERENCE", lambda a, b: b.isNull(), "ORIGINAL"),
    Rule("R03_AGREEMENT", lambda a, b: a == b, "ORIGINAL"),
    Rule("R04_CERTAIN_REFERENCE", lambda a, b: _matched("CODE", "NAME"), "REFERENCE"),
    Rule("R05_FILL_GAP", lambda a, b: a.isNull(), "REFERENCE"),
    Rule("R06_CONFLICT", lambda a, b: F.lit(True), "ORIGINAL", review=True),
)


def resolve(products: DataFrame, reference: DataFrame, matches: DataFrame, fields: Sequence[str], approve: float, rules: Sequence[Rule] = RULES,
    version: str = "1.0.0") -> DataFrame:
    """One row for each product row and field: original, reference and chosen value, where it is from, rule, match, confidence, review status.

    The first rule whose condition holds decides.  A choice is APPROVED unless its rule asks for a review or a value taken from or beside a
    reference has a confidence below `approve`.  Values are text.
    """
    own = products.select("product_id", *[F.col(f).cast("string").alias(f"o_{f}") for f in fields])
    ref = reference.select("reference_id", *[F.col(f).cast("string").alias(f"r_{f}") for f in fields])
    rows = own.join(matches, "product_id", "left").join(ref, "reference_id", "left")
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"o_{f}").alias("original_value"), F.col(f"r_{f}").alias("reference_value"))
        for f in fields]))
    rows = rows.select("product_id", "reference_id", "match_type", "confidence", each.alias("_f")).select("product_id", "reference_id", "_f.*",
        "match_type", "confidence")
    a, b = F.col("original_value"), F.col("reference_value")
    decided = F.coalesce(*[F.when(F.coalesce(r.condition(a, b), F.lit(False)),
        F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.choice).alias("choice"), F.lit(r.review).alias("review"))) for r in rules])
    rows = rows.withColumn("_d", decided)
    chosen = F.when(F.col("_d.choice") == "ORIGINAL", a).when(F.col("_d.choice") == "REFERENCE", b)
    doubtful = F.col("_d.review") | (b.isNotNull() & (F.col("confidence") < approve))
    status = F.when(F.coalesce(doubtful, F.lit(True)), "REVIEW_REQUIRED").otherwise("APPROVED")
    evidence = [chosen.alias("chosen_value"), F.col("_d.choice").alias("selected_source"), F.col("_d.rule_id").alias("rule_id"),
        F.lit(version).alias("rule_version")]
    return rows.select("product_id", "reference_id", "field", "original_value", "reference_value", *evidence, "match_type", "confidence",
        status.alias("review_status"))


def review_queue(evidence: DataFrame) -> DataFrame:
    """Each product with the fields that need a person, the least confident first inside a product's row."""
    todo = evidence.where("review_status = 'REVIEW_REQUIRED'")
    fields = F.array_join(F.array_sort(F.collect_set("field")), ",")
    return todo.groupBy("product_id").agg(F.any_value("reference_id").alias("reference_id"), F.any_value("match_type").alias("match_type"),
        F.min("confidence").alias("confidence"), fields.alias("fields"))


def standardized(rows: DataFrame, name: str = "name") -> DataFrame:
    """rows with `name` made standard, as `match` takes it."""
    return rows.withColumn(name, standard_name(name))

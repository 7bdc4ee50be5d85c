"""From raw fields to published rows: normalize, reconcile, check quality, publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from provlake.functions.text import col, collapse_ws

# Words of units, bases and storage in expiration texts.
UNIT_WORDS = {"HOUR": "시간|hours?", "DAY": "일|days?", "WEEK": "주|weeks?", "MONTH": "개월|months?", "YEAR": "년|years?"}
BASIS_WORDS = {"MANUFACTURE": "제조|manufactur", "PACKAGING": "포장|packag|packed", "RECEIPT": "수령|receipt|received"}
STORAGE_MAP = {"ROOM_TEMPERATURE": "ROOM", "ROOM": "ROOM", "REFRIGERATED": "REFRIGERATED", "FROZEN": "FROZEN"}


def clean_text(x: str | Column) -> Column:
    """Without tags, entities for blanks and control characters; white space collapsed."""
    t = F.regexp_replace(col(x), "<[^>]*>", " ")
    t = F.regexp_replace(F.replace(t, F.lit("&nbsp;"), F.lit(" ")), r"[\x00-\x08\x0b-\x1f\x7f]", " ")
    return F.nullif(collapse_ws(t), F.lit(""))


def storage_enum(x: str | Column) -> Column:
    out = F.lit("UNKNOWN")
    for a, b in STORAGE_MAP.items():
        out = F.when(F.upper(col(x)) == a, b).otherwise(out)
    return out


def expiration_parts(x: str | Column, bases: Mapping[str, str] = BASIS_WORDS) -> Column:
    """struct(value, unit, basis) of the first number with a unit."""
    t = F.lower(F.coalesce(clean_text(x), F.lit("")))
    words = "|".join(UNIT_WORDS.values())
    number = F.regexp_extract(t, f"([0-9]+(?:\\.[0-9]+)?)\\s*(?:{words})", 1).try_cast("double")
    word = F.regexp_extract(t, f"[0-9]+(?:\\.[0-9]+)?\\s*({words})", 1)
    unit = F.coalesce(*[F.when(word.rlike(f"^(?:{w})$"), u) for u, w in UNIT_WORDS.items()])
    basis = F.coalesce(*[F.when(t.rlike(w), b) for b, w in bases.items()], F.when(number.isNotNull(), "UNKNOWN"))
    return F.struct(number.alias("value"), unit.alias("unit"), basis.alias("basis"))


# Words of what a shelf life after opening counts from, and of storage in a sentence.
OPENING_WORDS = {"OPENING": "개봉|opening|opened"}
STORAGE_WORDS = {"FROZEN": "냉동|frozen", "REFRIGERATED": "냉장|refrigerat", "ROOM": "실온|상온|room temp"}
#: What ends a sentence: a mark before a blank or the end, a line, a bullet.  A point inside a number ends none.
SENTENCE_END = r"(?<=[.!?;。])(?=\s|$)|[\n\r•·※]+"


def without_noise(x: str | Column) -> Column:
    """Text as image recognition often spoils it, mended: letters for digits beside digits, blanks inside words of Hangul, wide forms of digits.

    Hangul words are joined only where single syllables stand alone one after another, three or more of them.
    """
    t = F.translate(col(x), "０１２３４５６７８９．", "0123456789.")
    for letter, digit in (("[OoＯ]", "0"), ("[lI|]", "1")):
        t = F.regexp_replace(t, rf"(?<=[0-9]){letter}(?=[0-9\s가-힣])|{letter}(?=[0-9])", digit)
    t = F.regexp_replace(t, r"(?<![가-힣])([가-힣]) ([가-힣]) ([가-힣])(?![가-힣])", "$1$2$3")
    return F.regexp_replace(t, r"([0-9])\s+\.\s*(?=[0-9])", "$1.")


def expiration_sentences(x: str | Column) -> Column:
    """array of struct(value, unit, basis, storage), one for each sentence that says something of shelf life or storage, in order."""
    sentences = F.split(without_noise(F.coalesce(clean_lines(x), F.lit(""))), SENTENCE_END)

    def one(s: Column) -> Column:
        e, low = expiration_parts(s, BASIS_WORDS | OPENING_WORDS), F.lower(s)
        storage = F.coalesce(*[F.when(low.rlike(w), k) for k, w in STORAGE_WORDS.items()])
        return F.struct(e["value"].alias("value"), e["unit"].alias("unit"), e["basis"].alias("basis"), storage.alias("storage"))

    return F.filter(F.transform(sentences, one), lambda e: e["value"].isNotNull() | e["storage"].isNotNull())


def expiration_choice(x: str | Column) -> Column:
    """struct(value, unit, basis, storage, conflict) of a whole text.

    The first sentence with a value and a basis other than opening or unknown, else the first with a value.  storage: of that sentence, else the first that is named.
    conflict: another sentence gives another value for the same basis.
    """
    found = F.transform(F.array(expiration_sentences(x)), lambda all_: _chosen(all_))
    return found[0]


def _chosen(found: Column) -> Column:
    valued = F.filter(found, lambda e: e["value"].isNotNull())
    firm = F.filter(valued, lambda e: ~e["basis"].isin("OPENING", "UNKNOWN"))
    best = F.coalesce(F.get(firm, F.lit(0)), F.get(valued, F.lit(0)))
    storage = F.coalesce(best["storage"], F.get(F.filter(found, lambda e: e["storage"].isNotNull()), F.lit(0))["storage"])
    other = F.exists(valued, lambda e: (e["basis"] == best["basis"]) & ~((e["value"] == best["value"]) & (e["unit"] == best["unit"])))
    return F.struct(best["value"].alias("value"), best["unit"].alias("unit"), best["basis"].alias("basis"), storage.alias("storage"),
        F.coalesce(other, F.lit(False)).alias("conflict"))


def clean_lines(x: str | Column) -> Column:
    """Without tags, entities for blanks and control characters; line ends, also those of tags, stay."""
    t = F.regexp_replace(F.regexp_replace(col(x), "(?i)<(br|p|li|/p|/li|/tr)[^>]*>", "\n"), "<[^>]*>", " ")
    return F.regexp_replace(F.replace(t, F.lit("&nbsp;"), F.lit(" ")), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")


def _pieces(names: DataFrame, ref: DataFrame, d: int) -> DataFrame:
    """Pairs of a product's name (_n, _g) and a reference (_name) of one group that may differ by at most d edits.

    A name cut into d + 1 pieces keeps one of them whole after d edits, moved by at most d places: the join is on group, length,
    piece number and piece, so no pair within d edits is lost and a large group does not meet itself.
    """
    i, n = F.col("_i"), F.col("_len")
    start = F.floor(i * n / (d + 1)).cast("int")
    size = F.floor((i + 1) * n / (d + 1)).cast("int") - start
    each = F.explode(F.sequence(F.lit(0), F.lit(d))).alias("_i")
    r = ref.select("*", F.length("_name").alias("_len"), each).withColumn("_piece", F.substr("_name", start + 1, size))
    own = F.length("_n")
    q = names.select("_n", "_g", F.explode(F.sequence(F.greatest(F.lit(0), own - d), own + d)).alias("_len"))
    q = q.select("*", each).select("*", F.explode(F.sequence(F.lit(-d), F.lit(d))).alias("_by"))
    q = q.where((start + F.col("_by") >= 0) & (start + F.col("_by") + size <= own)).withColumn("_piece", F.substr("_n", start + F.col("_by") + 1, size))
    return q.drop("_by").distinct().join(r, (F.col("_g") == F.col("_group")) & (q["_len"] == r["_len"]) & (q["_i"] == r["_i"]) & (q["_piece"] == r["_piece"]))


def reconcile(products: DataFrame, reference: DataFrame, code: str, name: str, group: str, max_distance: int = 3, rule_version: str = "1.0.0") -> DataFrame:
    """products with their best reference row: CODE, then NAME, then FUZZY inside the group, else NONE.

    Tiers are equi-joins; fuzzy names are compared only inside a group and if they share a piece, each name of a group once.  Fuzzy matches are always for review.
    reference: (code, name, group, reference_id).  Ties: the least reference_id.
    """
    ref = reference.select(F.col(code).alias("_code"), F.lower(F.col(name)).alias("_name"), F.col(group).alias("_group"), F.col("reference_id"))
    codes = ref.groupBy("_code").agg(F.min("reference_id").alias("reference_id"))
    ref = ref.groupBy("_name", "_group").agg(F.min("reference_id").alias("reference_id"))  # rows of one name are one candidate
    p = products.withColumn("_n", F.lower(F.col(name)))
    pick = lambda d, t: d.groupBy("product_id").agg(F.min_by(F.struct("reference_id", F.lit(t).alias("match_type"), "distance"),
        F.struct("distance", "reference_id")).alias("_m"))
    exact = pick(p.join(codes, p[code] == codes["_code"]).withColumn("distance", F.lit(0)), "CODE")
    rest = p.join(exact.select("product_id"), "product_id", "left_anti")
    named = pick(rest.join(ref, (rest["_n"] == ref["_name"]) & (rest[group] == ref["_group"])).withColumn("distance", F.lit(0)), "NAME")
    rest = rest.join(named.select("product_id"), "product_id", "left_anti")
    names = rest.select("_n", F.col(group).alias("_g")).distinct()
    near = _pieces(names, ref, max_distance).withColumn("distance", F.levenshtein("_n", "_name", max_distance)).where("distance >= 0")
    near = near.groupBy(F.col("_n").alias("_own"), "_g").agg(F.min(F.struct("distance", "reference_id")).alias("_near"))
    near = rest.join(near, (rest["_n"] == near["_own"]) & (rest[group] == near["_g"])).select("product_id", "_near.*")
    found = exact.unionByName(named).unionByName(pick(near, "FUZZY"))
    out = products.join(found, "product_id", "left")
    kind = F.coalesce("_m.match_type", F.lit("NONE"))
    return out.select(*products.columns, F.col("_m.reference_id").alias("reference_id"), kind.alias("match_type"),
        F.col("_m.distance").alias("distance"),
        F.when(kind.isin("CODE", "NAME"), "AUTO_APPROVED").otherwise("REVIEW_REQUIRED").alias("review_status"), F.lit(rule_version).alias("rule_version"))


def pass_rates(rows: DataFrame, rules: Mapping[str, Column], key: str, samples: int = 5) -> DataFrame:
    """One row for each rule: checked, failed, pass_rate, and the least keys that fail (a sample, at most `samples`)."""
    flat = rows.select(F.col(key).alias("_k"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(c, F.lit(False)).alias("ok")) for n,
        c in rules.items()])).alias("r")).select("_k", "r.*")
    sums = flat.groupBy("rule").agg(F.count("*").alias("checked"), F.count_if(~F.col("ok")).alias("failed"),
        F.round(F.avg(F.col("ok").cast("int")), 6).alias("pass_rate"))
    bad = flat.where(~F.col("ok")).withColumn("_rn", F.row_number().over(W.partitionBy("rule").orderBy("_k"))).where(F.col("_rn") <= samples)
    few = bad.groupBy("rule").agg(F.array_sort(F.collect_list("_k")).alias("sample"))
    return sums.join(few, "rule", "left").withColumn("sample", F.coalesce("sample", F.array().cast(few.schema["sample"].dataType)))


def quarantine(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rows with `outcome` (ACCEPTED or QUARANTINED) and the first broken rule."""
    reason = F.coalesce(*[F.when(~F.coalesce(c, F.lit(False)), n) for n, c in rules.items()])
    return rows.withColumn("reason", reason).withColumn("outcome", F.when(reason.isNull(), "ACCEPTED").otherwise("QUARANTINED"))


def publish(rows: DataFrame, columns: Sequence[str], version: str, approved: Sequence[str] = ("AUTO_APPROVED", "APPROVED")) -> DataFrame:
    """Approved rows only, minimal columns, stamped with the dataset version."""
    return rows.where(F.col("review_status").isin(*approved)).select(F.lit(version).alias("dataset_version"), *columns)


def publish_manifest(published: DataFrame) -> DataFrame:
    """One row for each version: rows and an order-free checksum."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(published.columns)]
    return published.groupBy("dataset_version").agg(F.count("*").alias("row_count"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("checksum"))

"""PII: fixed patterns, and contextual extraction bootstrapped from them, in DataFrame operations only.

Base spans: email, ip, card and phone by regular expressions and checks.  Patterns are written with possessive
quantifiers and look-behinds so that no text, however long, makes them backtrack; they match the same spans.

Bootstrapping.  Every word with a digit or an at-sign is an instance; the two words before it are its
lexical pattern.  Instances that a base pattern matches are seeds of their kind.  On the graph of patterns and instances
  score(pattern, kind)  = sum of its instances' scores / (its distinct instances + 1)
  score(instance, kind) = 1 - product over its patterns of (1 - score(pattern, kind)), seeds stay 1
is repeated ROUNDS times with aggregations and joins over written tables, over all patterns.  Patterns with at least SUPPORT distinct
sure instances of a kind (seeds, or scored CONFIDENT or more before) and a score of CONFIDENT or more then extract the other instances that look like identifiers, as spans
of kind `found`, unless a base span is there.  A pattern reads at most CONTEXT characters before the instance; longer words there are cut on their left.

Edges are distinct (pattern, instance) pairs, counted by partial aggregation, so a pattern that a third of all
rows hold is split like any other.  Null text: empty.  Repeated rows: each row gets its own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.llm.common import KEY, join_key, keyed, written

KINDS = ("email", "ip", "card", "phone", "found")
ROUNDS = 3
SUPPORT = 3
CONFIDENT = 0.75
MIN_DIGITS = 4
CONTEXT = 64
#: Matches whose places are summed one by one; blocks of them are summed as wholes.
BLOCK = 64
_LOCAL = "[A-Za-z0-9._%+-]"
# The base patterns.
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:(?<![0-9])|\G)[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_BLANK = r"\x20\x09-\x0D"
INSTANCE = rf"\+[0-9][ ().0-9-]+[0-9]|(?<![^{_BLANK}])[^{_BLANK}]*[0-9@][^{_BLANK}]*+"
_SPAN = "array<struct<a:int,k:int,b:int>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    d = lambda i: F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
    step = lambda acc, i: acc + F.when(i % 2 == 0, d(i)).otherwise(F.when(d(i) > 4, 2 * d(i) - 9).otherwise(2 * d(i)))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _valid(kind: int, m: Column) -> Column:
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        return m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == 2:
        return F.length(_digits(m)).between(14, 19) & _luhn(_digits(m))
    return F.length(_digits(m)).between(10, 15)


def _placed(found: Column, gaps: Column) -> Column:
    """Matches and the text between them -> array of (start, match); code points.

    Lengths are summed in blocks of BLOCK matches and inside each, so a text of many matches takes time in proportion to them, not to their square.
    """
    none = F.array().cast("array<struct<a:int,m:string>>")
    zero = F.lit(0)

    def of(v: Column) -> Column:  # both arrays are computed once
        size, gap, match = F.size(v["found"]), lambda i: F.get(v["gaps"], i), lambda i: F.get(v["found"], i)
        length = lambda i: F.length(gap(i)) + F.length(match(i))
        ends = lambda j: F.sequence(j * BLOCK, F.least((j + 1) * BLOCK, size) - 1)
        numbers = F.sequence(zero, F.floor((size - 1) / BLOCK).cast("int"))
        sizes = F.transform(numbers, lambda j: F.aggregate(ends(j), zero, lambda s, i: s + length(i)))

        def block(j: Column, at: Column) -> Column:
            entry = lambda acc, i: F.struct((acc["at"] + F.length(gap(i))).alias("a"), match(i).alias("m"))
            step = lambda acc, i: F.struct((acc["at"] + length(i)).alias("at"), F.concat(acc["out"], F.array(entry(acc, i))).alias("out"))
            return F.aggregate(ends(j), F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

        before = lambda sums, j: F.aggregate(F.slice(sums, 1, j), zero, lambda s, x: s + x)
        return F.transform(F.array(sizes), lambda sums: F.flatten(F.transform(numbers, lambda j: block(j, before(sums, j)))))[0]

    both = F.array(F.struct(found.alias("found"), gaps.alias("gaps")))
    return F.when(F.size(found) > 0, F.transform(both, of)[0]).otherwise(none)


def _spans(df: DataFrame, text: str) -> DataFrame:
    """df with _base: all base spans in order of start and kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    able = [F.contains(t, F.lit("@")), t.rlike(r"[0-9]\.[0-9]"), t.rlike(r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"), t.rlike(r"\+[0-9]")]
    for k, (pattern, may) in enumerate(zip((EMAIL, IP, CARD, PHONE), able, strict=True)):
        df = df.withColumn(f"_m{k}", F.when(may, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))))

    def of_kind(k: int, pattern: str) -> Column:
        m = F.col(f"_m{k}")
        placed = F.filter(_placed(m, F.split(t, pattern, -1)), lambda v: _valid(k, v["m"]))
        spans = F.transform(placed, lambda v: F.struct(v["a"].alias("a"), F.lit(k).alias("k"), (v["a"] + F.length(v["m"])).alias("b")))
        return F.when(F.size(m) > 0, spans).otherwise(F.array().cast(_SPAN))

    parts = [of_kind(k, p) for k, p in enumerate((EMAIL, IP, CARD, PHONE))]
    return df.withColumn("_base", F.array_sort(F.concat(*parts))).drop("_m0", "_m1", "_m2", "_m3")


def instances(docs: DataFrame) -> DataFrame:
    """(doc_id, _th, a, b, pattern, instance, kind): words with digits or an at-sign, and the words before them."""
    t = F.coalesce("text", F.lit(""))
    src = keyed(docs).where(t.rlike("[0-9@]")).withColumn("_m", F.regexp_extract_all(t, F.lit(INSTANCE), F.lit(0))).withColumn("_g", F.split(t, INSTANCE, -1))
    before = F.transform(F.slice("_g", 1, F.size("_m")), lambda g: F.right(g, F.lit(CONTEXT)))
    rows = src.where(F.size("_m") > 0).select(*KEY,
        F.posexplode(F.arrays_zip(_placed(F.col("_m"), F.col("_g")).alias("p"), before.alias("g"))).alias("_i", "x"))
    core = F.regexp_extract("x.p.m", r"^[^A-Za-z0-9+]*+(.*?)[^A-Za-z0-9]*+$", 1)
    words = F.filter(F.split(F.lower("x.g"), rf"[{_BLANK}]+"), lambda w: w != "")
    rows = rows.select(*KEY, "x.p.a", "x.p.m", core.alias("instance"),
        F.array_join(F.slice(F.concat(F.array(F.lit(""), F.lit("")), words), -2, 2), " ").alias("pattern"))
    a = F.col("a") + F.position("instance", "m") - 1
    kind = F.when(F.col("instance").rlike(f"^{_LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++$"), 0)
    for k, p in ((1, r"^[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++$"), (2, r"^[0-9](?:[ -]?[0-9])++$"), (3, rf"^{PHONE}$")):
        kind = kind.when(F.col("instance").rlike(p) & _valid(k, F.col("instance")), k)
    return rows.where(F.length("instance") > 0).select(*KEY, a.cast("int").alias("a"), (a + F.length("instance")).cast("int").alias("b"), "pattern",
        F.lower("instance").alias("instance"), kind.cast("int").alias("kind"))


def score_patterns(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """(pattern, kind, score, seeds) of patterns with at least `support` distinct instances of the kind that are sure.

    Sure are the base instances and, from the second round on, those that earlier patterns score at `confident` or above: a pattern
    without any base instance can be learned from what others have found.  All patterns are scored in every round.
    """
    edges = found.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    edges = written(written(edges).join(written(sizes), "pattern"))
    known = edges.where("kind is not null").select("instance", "kind", F.lit(1.0).alias("score")).distinct()
    scores = known = written(known)
    for last in [False] * (rounds - 1) + [True]:
        sums = edges.select("pattern", "n", "instance").join(scores, "instance")
        patterns = written(sums.groupBy("pattern", "kind").agg((F.sum("score") / (F.max("n") + 1)).alias("score"),
            F.count_if(F.col("score") >= confident).alias("seeds")))
        if last:
            return patterns.where(F.col("seeds") >= support)
        again = edges.where("kind is null").select("pattern", "instance").join(patterns, "pattern").groupBy("instance",
            "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("score")))))).alias("score"))
        scores = written(known.unionAll(again))
    return patterns


def personal_data(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """One row per document: counts of base spans, their digest, and all spans."""
    found = written(instances(docs))
    good = written(score_patterns(found, rounds, support, confident).where(F.col("score") >= confident).select("pattern").distinct())
    new = found.where("kind is null").where(F.contains("instance", F.lit("@")) | (F.length(_digits(F.col("instance"))) >= MIN_DIGITS)).join(good,
        "pattern", "left_semi")
    new = written(new.groupBy(*KEY).agg(F.collect_set(F.struct("a", F.lit(4).alias("k"), "b")).alias("_new")))
    both = join_key(_spans(keyed(docs), "text"), new)
    free = lambda v: ~F.exists("_base", lambda x: (x["a"] < v["b"]) & (v["a"] < x["b"]))
    every = F.array_sort(F.concat("_base", F.coalesce(F.filter("_new", free), F.array().cast(_SPAN))))
    names = F.array(*map(F.lit, KINDS))
    show = lambda xs: F.array_join(F.transform(xs, lambda v: F.concat_ws(":", F.element_at(names, v["k"] + 1), v["a"], v["b"])), ",")
    count = lambda k: F.size(F.filter("_base", lambda v: v["k"] == k)).cast("long")
    return both.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)], F.sha2(show(F.col("_base")), 256).alias("base_sha256"),
        show(every).alias("spans"))

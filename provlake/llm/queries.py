"""One query for each text operator, over its whole table with production parameters, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm import boilerplate, bpe, chains, decontamination, language, manifest, mixing, periodic, personal, repetition, secrets, simhash, suffixes
from provlake.llm.common import words_of


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_documents(spark, sf_dir)).drop("kept", "removed")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_quality(_documents(spark, sf_dir))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("items")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(_documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    n_lines, n_dropped = boilerplate.count_names(docs)
    out = boilerplate.drop_boilerplate(docs)
    return out.select("doc_id", F.col(n_lines).alias("n_lines"), F.col(n_dropped).alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_language(_documents(spark, sf_dir))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_documents(spark, sf_dir)).drop("found")


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_documents(spark, sf_dir))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_documents(spark, sf_dir))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.fuzzy_passages(_documents(spark, sf_dir))


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; of every tenth document by its id's crc32, the words from `a` on are the `p` words there, over and over."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    n = F.size("w").cast("long")
    a = F.when(n > 0, g % n).cast("int")
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.when(h % 10 == 0, words_of(F.col("text"))).alias("w"), g.alias("g"))
    own = own.withColumn("a", a).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    left = F.size("w") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return own.select("doc_id", F.when(F.size("w") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic.periodic_runs(_with_planted_periods(_documents(spark, sf_dir)))
    runs = runs.withColumn("best", periodic.strongest(F.col("runs")))
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli")
    digests = [F.sha2(periodic.run_lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")]
    return runs.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), *best, exponent, *digests)


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).drop("rounds", "pieces")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, manifest.leaf_digest([lower if c == "text" else F.col(c) for c in manifest.COLUMNS]))
    out = manifest.proofs(docs, carry={"tampered": tampered})
    now = manifest.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    out = out.select("doc_id", "leaf", "subroot", "root", manifest.siblings_digest(F.col("path")).alias("proof_sha256"), now.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup, op2_quality_rules, op3_benchmark_decontamination, op4_pii, op5_line_dedup, op6_language_id, op7_secret_scans, op8_bpe_encoding,
        op9_simhash_near_dedup, op10_substring_dedup, op11_periodic_runs, op12_source_mix, op13_merkle_manifest,
    )
}

_ITEM_WORDS = r"list_filter(string_split_regex(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

#: Levels that the Merkle SQL writes out: groups of up to 16 ** 5 rows.
_SQL_LEVELS = 5


def _tree_sql(t: str, leaves: str) -> str:
    """CTEs of a tree over leaves (g, r, h): t_k the nodes of level k, t_steps what each leaf folds with, t_top the roots."""
    out = [f"{t}_0 AS (SELECT g, r, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves})"]
    for k in range(_SQL_LEVELS):
        around = f"string_agg(h, '') OVER (PARTITION BY g, r // 16 ORDER BY r ROWS BETWEEN"
        out.append(
            f"{t}_s{k} AS (SELECT g, r, n > 1 AS up, CASE WHEN n > 1 THEN coalesce({around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS pre, "
            f"CASE WHEN n > 1 THEN coalesce({around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS post FROM {t}_{k})"
        )
        h = "CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END"
        out.append(f"{t}_{k + 1} AS (SELECT g, r // 16 AS r, {h} AS h, (any_value(n) + 15) // 16 AS n FROM {t}_{k} GROUP BY g, r // 16)")
    cols = ", ".join(f"s{k}.up AS up{k}, s{k}.pre AS pre{k}, s{k}.post AS post{k}" for k in range(_SQL_LEVELS))
    joins = " ".join(f"JOIN {t}_s{k} s{k} ON s{k}.g = x.g AND s{k}.r = x.r // {16**k}" for k in range(_SQL_LEVELS))
    out.append(f"{t}_steps AS (SELECT x.g, x.r, {cols} FROM {t}_0 x {joins})")
    out.append(f"{t}_top AS (SELECT g, h FROM {t}_{_SQL_LEVELS})")
    return ",\n        ".join(out)


def _merkle_sql() -> str:
    def leaf(text: str) -> str:
        values = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return "sha256(" + " || ".join(f"coalesce(CAST(octet_length(encode({v})) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"

    crc_of = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    folds, at = [], "coalesce(l.tampered, l.h)"
    for t, alias in (("docs", "d"), ("tops", "s")):
        for k in range(_SQL_LEVELS):
            name = f"{t}_f{k}"
            folds.append((name, f"CASE WHEN {alias}.up{k} THEN sha256({alias}.pre{k} || {at} || {alias}.post{k}) ELSE {at} END"))
            at = name
    siblings = " || ".join(f"{a}.pre{k} || {a}.post{k}" for a in ("d", "s") for k in range(_SQL_LEVELS))
    return f"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(CAST(x AS BIGINT), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS tab),
        leaves AS (
            SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, {leaf("text")} AS h,
                CASE WHEN xor({crc_of}, 4294967295) % 5 = 0 THEN {leaf(low)} END AS tampered
            FROM documents, crc),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS r FROM leaves),
        {_tree_sql("docs", "ranked")},
        heads AS (SELECT 0 AS g, g AS r, h FROM docs_top),
        {_tree_sql("tops", "heads")}
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, verified FROM (SELECT l.doc_id, l.h AS leaf, heads.h AS subroot, tops_top.h AS root, sha256({siblings}) AS proof_sha256,
            {", ".join(f"{e} AS {n}" for n, e in folds[:-1])}, {folds[-1][1]} AS folded_root, folded_root = tops_top.h AS verified
        FROM ranked l JOIN docs_steps d ON d.g = l.g AND d.r = l.r JOIN heads ON heads.r = l.g JOIN tops_steps s ON s.r = l.g, tops_top)"""


ORACLES: dict[str, str] = {
    "op3_benchmark_decontamination": f"""
        WITH d AS (SELECT doc_id, {_ITEM_WORDS.format("text")} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_ITEM_WORDS.format("text")} AS w FROM benchmark),
        wins AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
            FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM wins),
        runs AS (
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
            FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
        hits AS (SELECT doc_id, i, n, item_id FROM runs JOIN wins USING (n, s)),
        spots AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
        ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN ids USING (doc_id)""",
    "op5_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
            FROM documents WHERE text IS NOT NULL),
        totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
        bad AS (
            SELECT source, line FROM (
                SELECT source, trim(line) AS line, count(DISTINCT doc_id) AS n FROM l WHERE trim(line) <> '' GROUP BY ALL)
            JOIN totals USING (source) WHERE n > {boilerplate.RATIO} * pages),
        m AS (SELECT l.*, bad.line IS NOT NULL AS gone FROM l LEFT JOIN bad ON bad.source = l.source AND bad.line = trim(l.line))
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN (
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS kept
            FROM m GROUP BY doc_id) USING (doc_id)""",
    "op12_source_mix": f"""
        WITH d AS (
            SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
                md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(md5(text), '-')) AS mark
            FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS words, count(*) AS n FROM d GROUP BY source),
        ranks AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM s),
        w AS (SELECT *, list_extract([3.0::DOUBLE, 1.0, 2.0], CAST(number % 3 + 1 AS INT)) AS weight FROM ranks),
        levels AS (
            SELECT *, row_number() OVER o AS k,
                (1.5::DOUBLE * sum(words) OVER () - 2 * coalesce(sum(words) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM w WINDOW o AS (ORDER BY 2 * words / weight, number)),
        chosen AS (SELECT arg_min(level, k) AS level FROM levels WHERE level <= 2 * words / weight),
        t AS (SELECT w.*, least(2.0::DOUBLE * words, coalesce(level, 0) * weight) AS target FROM w, chosen),
        total AS (SELECT CAST(floor(1.5::DOUBLE * sum(words) / {mixing.BLOCK} + 0.5) AS BIGINT) AS seats FROM s),
        won AS (
            SELECT number, count(*) AS blocks FROM (
                SELECT number, row_number() OVER (ORDER BY round(target / (2 * i + 1), 6) DESC, number) AS turn
                FROM (SELECT number, target, unnest(generate_series(0, CAST(ceil(target / {mixing.BLOCK}) AS BIGINT) + 2)) AS i FROM t WHERE target > 0))
            WHERE turn <= (SELECT seats FROM total) GROUP BY number),
        p AS (
            SELECT d.*, t.number, t.words AS n_words, t.target, coalesce(blocks, 0) AS blocks,
                CAST('0x' || substr(mark, 1, 8) AS BIGINT) % CAST(ceil(sqrt(n)) AS BIGINT) AS shard
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN won USING (number)),
        sh AS (SELECT number, shard, CAST(sum(size) AS BIGINT) AS words, any_value(n_words) AS n_words, any_value(blocks) AS blocks FROM p GROUP BY number, shard),
        quotas AS (
            SELECT number, shard, count(*) AS quota FROM (
                SELECT number, shard, blocks, row_number() OVER (PARTITION BY number ORDER BY CAST(words AS DOUBLE) / (2 * i + 1) DESC, shard) AS turn
                FROM (SELECT *, unnest(generate_series(0, CAST(ceil(words * blocks / n_words) AS BIGINT) + 3)) AS i FROM sh WHERE words > 0))
            WHERE turn <= blocks GROUP BY number, shard),
        line AS (
            SELECT p.*, sh.words, least(coalesce(quota, 0) * {mixing.BLOCK}, 2 * sh.words) AS due, greatest(sh.words, 1) AS length,
                CAST(coalesce(sum(size) OVER (PARTITION BY number, shard ORDER BY mark ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a
            FROM p JOIN sh USING (number, shard) LEFT JOIN quotas USING (number, shard)),
        cut AS (
            SELECT *, due // length AS rounds, due % length AS rest, {mixing.BLOCK} * (CAST('0x' || substr(md5('{mixing.SEED}:' || number || ':' || shard), 1, 8) AS BIGINT)
                % ((length + {mixing.BLOCK} - 1) // {mixing.BLOCK})) AS start
            FROM line)
        SELECT doc_id, size, n_words AS source_size, target,
            CAST(rounds * size + greatest(0, least(a + size, start + rest) - greatest(a, start)) + greatest(0, least(a + size, start + rest - length) - a) AS BIGINT) AS taken
        FROM cut""",
    "op13_merkle_manifest": _merkle_sql(),
}

"""Batch intake: identity, required files, sealing, the decision to accept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions.hashing import HASH_FIELD, content_hash
from provlake.operators import summaries
from provlake.functions.text import blank_to_null, col, optional_double, tokens

# Identity patterns, required files, columns whose blank means null.
BATCH_PATTERN = "^[A-Za-z0-9][A-Za-z0-9_-]{0,127}$"
MEMBER_PATTERN = "^[A-Za-z0-9_]{1,64}$"
REQUIRED_FILES = ("discovered_products.csv", "crawled_products.csv", "image_text_check.csv", "products.csv")
OPTIONAL_TEXT = (
    "food_name_candidate", "sales_unit_raw", "weight_raw", "quantity_raw", "food_type_raw", "food_type_source", "expiration_info_raw",
    "expiration_source", "storage_method_raw", "storage_source", "storage_type", "crawl_collected_at", "ocr_collected_at",
    "validation_status", "parse_status", "image_sha256",
)


def owned_by(batch: str | Column, member: str | Column) -> Column:
    """The member is one of the batch id's parts; a blank member owns nothing."""
    return (F.coalesce(col(member), F.lit("")) != "") & F.array_contains(tokens(batch), col(member))


def owner(batch: str | Column, members: Sequence[str]) -> Column:
    """The first of the configured members that is a part of the batch id."""
    parts = tokens(batch)
    return F.coalesce(*[F.when(F.array_contains(parts, F.lit(m)), F.lit(m)) for m in members])


def identity_error(batch: str | Column, member: str | Column) -> Column:
    return (
        F.when(~F.coalesce(col(batch).rlike(BATCH_PATTERN), F.lit(False)), "INVALID_BATCH_ID")
        .when(~F.coalesce(col(member).rlike(MEMBER_PATTERN), F.lit(False)), "INVALID_MEMBER")
        .when(~owned_by(batch, member), "BATCH_MEMBER_MISMATCH")
    )


def missing_files(files: Column, required: Sequence[str] = REQUIRED_FILES) -> Column:
    return F.array_except(F.array(*map(F.lit, required)), files)


def adapt_products(rows: DataFrame, run_id: str, created_at: str, fallback_batch: str, default_site: str = "SHOP") -> DataFrame:
    """Legacy product rows -> sealed contract rows.  Unknown columns go to `extra`; bad numbers are null and counted in `bad_confidence`."""
    have = set(rows.columns)
    text = lambda c: blank_to_null(c) if c in have else F.lit(None).cast("string")
    pid, site = F.coalesce(text("original_product_id"), F.lit("")), F.coalesce(text("source_site"), F.lit(default_site))
    batch = F.coalesce(text("batch_id"), F.lit(fallback_batch))
    record = F.coalesce(text("source_record_id"), F.concat_ws(":", site, pid))
    url = F.coalesce(text("product_url"), F.lit(""))
    known = {"schema_version", "batch_id", "source_site", "original_product_id", "product_name_raw", "product_url", "parser_version",
        "source_record_id", "ocr_confidence", *OPTIONAL_TEXT}
    extra = [c for c in rows.columns if c not in known]
    confidence = optional_double("ocr_confidence") if "ocr_confidence" in have else F.lit(None).cast("double")
    bad = confidence.isNull() & text("ocr_confidence").isNotNull()
    out = rows.select(
        F.lit("1.0.0").alias("schema_version"), F.lit(run_id).alias("run_id"), batch.alias("batch_id"), F.concat_ws(":", batch, record).alias("record_id"),
        site.alias("source"), record.alias("source_record_id"), F.nullif(url, F.lit("")).alias("source_uri"),
            F.coalesce(text("parser_version"), F.lit("0.0.0")).alias("parser_version"),
        F.lit(created_at).alias("created_at"), pid.alias("original_product_id"),
            F.coalesce(text("product_name_raw"), F.lit("")).alias("product_name_raw"), url.alias("product_url"),
        *[text(c).alias(c) for c in OPTIONAL_TEXT], confidence.alias("ocr_confidence"), bad.alias("bad_confidence"),
        (F.map_filter(F.create_map(*[x for c in extra for x in (F.lit(c), blank_to_null(c))]), lambda k, v: v.isNotNull()) if extra
            else F.create_map().cast("map<string,string>")).alias("extra"),
    )
    sealed = [c for c in out.columns if c not in ("bad_confidence", "ocr_confidence", "extra")]
    return out.withColumn(HASH_FIELD, content_hash(sealed))


def nest(parents: DataFrame, children: DataFrame, key: str, order: str, columns: Sequence[str], name: str = "products") -> DataFrame:
    """One row for each parent with its children as an array of structs in order."""
    nested = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in columns if c != order]))).alias(name))
    return parents.join(nested, key, "left").withColumn(name, F.coalesce(name, F.array().cast(nested.schema[name].dataType)))


def decide(identity: Column, missing: Column, n_issues: Column, accepted_checksum: Column, checksum: Column) -> Column:
    """REJECTED, CONFLICT (another bundle is accepted), DUPLICATE (the same is), else ACCEPTED."""
    return (
        F.when(identity.isNotNull() | (F.size(missing) > 0) | (n_issues > 0), "REJECTED")
        .when(accepted_checksum.isNotNull() & (accepted_checksum != checksum), "CONFLICT")
        .when(accepted_checksum.isNotNull(), "DUPLICATE")
        .otherwise("ACCEPTED")
    )


# Names that stand for no member.
NO_MEMBER = ("", "unknown", "member-name")


def classify_rows(rows: DataFrame, batch: str | Column, checked: DataFrame, image: str = "image_path") -> DataFrame:
    """rows with `action`: CHECK, SKIP_EXISTING (image in checked) or nothing at all for rows of other batches and without an image.

    A row without a batch id belongs to every batch.
    """
    own, path = F.coalesce(F.trim("batch_id"), F.lit("")), F.coalesce(F.trim(image), F.lit(""))
    mine = rows.where(((own == "") | (own == col(batch))) & (path != ""))
    known = checked.select(F.col(image).alias("_known")).distinct()
    out = mine.join(known, F.trim(image) == F.col("_known"), "left")
    return out.withColumn("action", F.when(F.col("_known").isNull(), "CHECK").otherwise("SKIP_EXISTING")).drop("_known")


def ocr_rows(rows: DataFrame, member: str | Column, batch: str | Column | None = None) -> DataFrame:
    """rows with `mine`: those of the batch if one is given, else those of the member's batches."""
    own = F.coalesce(F.trim("batch_id"), F.lit(""))
    return rows.withColumn("mine", owned_by(own, member) if batch is None else F.when(col(batch).isNull(), owned_by(own, member)).otherwise(own == col(batch)))


def of_member(batches: DataFrame, member: str | None, batch: str = "batch_id") -> DataFrame:
    """Batches whose id holds the member; a placeholder is no filter."""
    return batches if member is None or member in NO_MEMBER else batches.where(F.contains(batch, F.lit(member)))


def platform_ready(batches: DataFrame, products: DataFrame, members: Sequence[str], batch: str = "batch_id") -> DataFrame:
    """Batches whose owner is known and that have a product, with their owner."""
    known = batches.withColumn("owner", owner(batch, members)).where("owner is not null")
    return known.join(products.select(batch).distinct(), batch, "left_semi")


def lifecycle(runs: DataFrame, found: DataFrame, key: str = "batch_id") -> DataFrame:
    """Discovery manifests: runs (key, started_at, ...) RUNNING until found (key, item, stop_reason, ended_at, failed) has rows for them.

    discovered: distinct items; duplicates: the other appearances; a run with a failed row ends FAILED, else COMPLETED.
    """
    ends = found.groupBy(key).agg(F.count_distinct("item").alias("discovered_count"),
        (F.count("item") - F.count_distinct("item")).alias("duplicate_count"), F.max("stop_reason").alias("stop_reason"),
        F.max("ended_at").alias("finished_at"), F.bool_or("failed").alias("_failed"))
    out = runs.join(ends, key, "left").fillna(0, ["discovered_count", "duplicate_count"])
    return out.withColumn("status", F.when(F.col("_failed").isNull(), "RUNNING").when(F.col("_failed"), "FAILED").otherwise("COMPLETED")).drop("_failed")


def submission_summary(batches: DataFrame, key: str, counts: dict[str, DataFrame], manifests: DataFrame, reports: DataFrame,
    needed: Sequence[str]) -> DataFrame:
    """One row for each batch: a count for each table, and the status of the manifest, else of the report, else by the needed tables."""
    out = summaries.with_counts(batches, key, counts)
    out = out.join(manifests.select(key, F.col("status").alias("_m")), key, "left").join(reports.select(key, F.col("status").alias("_r")), key, "left")
    every = F.lit(True)
    for n in needed:
        every = every & (F.col(n) > 0)
    return out.withColumn("status", summaries.submission_status(F.col("_m"), F.col("_r"), every)).drop("_m", "_r")

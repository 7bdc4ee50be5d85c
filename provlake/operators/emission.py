"""From manifest rows to product rows: OCR blocks, the image and page branches, one row for each product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from provlake.functions import extract, merge
from provlake.functions.text import col
from provlake.operators.images import gate_branch


def blocks(texts: str | Column, scores: str | Column, polygons: str | Column) -> Column:
    """Parallel arrays of an OCR result -> array<struct(text, confidence, polygon)>; what is missing is null."""
    t, s, p = col(texts), col(scores), col(polygons)
    return F.transform(t, lambda x, i: F.struct(x.alias("text"), F.try_element_at(s, i + 1).alias("confidence"), F.try_element_at(p, i + 1).alias("polygon")))


def joined_text(found: str | Column) -> Column:
    """Block texts that are not blank, joined by line feeds; null if there is none."""
    lines = F.filter(F.transform(col(found), lambda b: F.trim(b["text"])), lambda x: x != "")
    return F.nullif(F.array_join(lines, "\n"), F.lit(""))


def mean_confidence(found: str | Column) -> Column:
    """The mean of the confidences that are there; null if there is none."""
    c = F.filter(F.transform(col(found), lambda b: b["confidence"]), lambda x: x.isNotNull())
    return F.when(F.size(c) > 0, F.aggregate(c, F.lit(0.0), lambda a, x: a + x) / F.size(c))


def manifest_rows(products: DataFrame, images: str = "downloaded_images") -> DataFrame:
    """One row for each image, or one with blank image columns; no nulls."""
    rows = products.select("*", F.explode_outer(images).alias("_i")).drop(images)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns if c != "_i"]
    return rows.select(*texts, F.coalesce("_i.local_path", F.lit("")).alias("image_path"), F.coalesce("_i.source_url", F.lit("")).alias("source_image_url"))


def emit(rows: DataFrame, known: DataFrame, batch: str = "batch_id", position: str = "position") -> DataFrame:
    """rows with `outcome`: IMAGE, DOM_ONLY, RAW_ONLY, FAILED or SKIPPED.

    rows: batch, position, site, pid, image_path, digest, gate_text, ocr_text, expiration_dom, storage_dom; known: key.
    An image row is emitted once for each content of a product in a batch unless its key is known; its text must
    pass the gate, and must not be empty then.  A page row is emitted once for each product that is not known, for rows without
    an image and for images that the gate stops although the page had a field.  Failed rows leave no key.
    """
    pid = F.concat_ws(":", "site", "pid")
    image = F.coalesce(F.col("image_path"), F.lit("")) != ""
    r = rows.withColumn("_pid", pid).withColumn("_full", F.concat_ws(":", "site", "pid", "digest")).withColumn("_short",
        F.concat_ws(":", "site", "pid", F.left("digest", F.lit(12))))
    for name in ("_pid", "_full", "_short"):
        seen = known.select(F.col("key").alias(f"{name}_key")).distinct()
        r = r.join(seen, F.col(name) == F.col(f"{name}_key"), "left")
    r = r.withColumn("_image", image).withColumn("_old", F.col("_full_key").isNotNull() | F.col("_short_key").isNotNull())
    r = r.withColumn("_branch", gate_branch("gate_text", "expiration_dom", "storage_dom"))
    r = r.withColumn("_failed", F.col("_image") & (F.col("_branch") == "FULL") & (F.trim(F.coalesce("ocr_text", F.lit(""))) == ""))
    done = F.sum((F.col("_image") & ~F.col("_old") & ~F.col("_failed")).cast("int")).over(W.partitionBy(batch,
        "_full").orderBy(position).rowsBetween(W.unboundedPreceding, -1))
    r = r.withColumn("_first", F.col("_image") & ~F.col("_old") & (F.coalesce(done, F.lit(0)) == 0))
    r = r.withColumn("_page", ~F.col("_image") | (F.col("_first") & (F.col("_branch") == "DOM_ONLY")))
    pages = F.sum(F.col("_page").cast("int")).over(W.partitionBy(batch, "_pid").orderBy(position).rowsBetween(W.unboundedPreceding, -1))
    page_ok = F.col("_page") & F.col("_pid_key").isNull() & (F.coalesce(pages, F.lit(0)) == 0)
    outcome = (
        F.when(F.col("_first") & F.col("_failed"), "FAILED")
        .when(F.col("_first") & (F.col("_branch") == "FULL"), "IMAGE")
        .when(page_ok, "DOM_ONLY")
        .when(F.col("_first"), "RAW_ONLY")
        .otherwise("SKIPPED")
    )
    return r.withColumn("outcome", outcome).select(*rows.columns, "outcome")


def merged_products(emitted: DataFrame) -> DataFrame:
    """Product rows of emitted image and page rows: three merged fields with their sources, and the states."""
    text = F.when(F.col("outcome") == "IMAGE", F.col("ocr_text"))
    found = emitted.where(F.col("outcome").isin("IMAGE", "DOM_ONLY")).withColumn("_f", extract.disclosure_fields(text))
    none = F.lit(None).cast("string")
    fields = {"food_type": (none, "_f.food_type_raw"), "expiration": ("expiration_dom", "_f.expiration_info_raw"),
        "storage": ("storage_dom", "_f.storage_method_raw")}
    for name, (dom, ocr) in fields.items():
        found = found.withColumn(f"_{name}", merge.merge_field(dom, ocr))
    out = [x for n in fields for x in (F.col(f"_{n}.value").alias(f"{n}_raw"), F.col(f"_{n}.source").alias(f"{n}_source"))]
    states = merge.rollup_status(*[F.col(f"_{n}.status") for n in fields])
    return found.select("batch_id", "position", "site", "pid", "outcome", *out, extract.storage_type("_storage.value").alias("storage_type"),
        states.alias("validation_status"))


def product_records(emitted: DataFrame, parser_version: str = "0.1.0") -> DataFrame:
    """The whole product row of every emitted image and page row: 24 columns, in their order in the product file.

    emitted: emit's rows with product_name, food_name_candidate, product_url, sales_unit_raw, weight_raw, quantity_raw, storage_type_dom, ocr_confidence,
    crawl_collected_at and ocr_collected_at.  Page rows have no image fields, and their parse status counts the name too.
    """
    image, none = F.col("outcome") == "IMAGE", F.lit(None).cast("string")
    rows = emitted.where(F.col("outcome").isin("IMAGE", "DOM_ONLY")).withColumn("_f", extract.disclosure_fields(F.when(image, F.col("ocr_text"))))
    pairs = {"food_type": (none, "_f.food_type_raw"), "expiration": ("expiration_dom", "_f.expiration_info_raw"),
        "storage": ("storage_dom", "_f.storage_method_raw")}
    rows = rows.withColumns({f"_{n}": merge.merge_field(a, b) for n, (a, b) in pairs.items()})
    of_image = lambda c: F.when(image, c)
    value, source = lambda n: F.col(f"_{n}.value"), lambda n: F.col(f"_{n}.source")
    inferred = of_image(extract.storage_type("_storage.value", "product_name", frozen_first=True))
    storage_type = F.coalesce(F.nullif(F.col("storage_type_dom"), F.lit("")), inferred, F.lit("UNKNOWN"))
    third = F.when(image, value("food_type")).otherwise(F.col("product_name"))
    record = F.concat_ws(":", "site", "pid", of_image(F.left("digest", F.lit(12))))
    return rows.select(
        "batch_id", F.col("site").alias("source_site"), F.col("pid").alias("original_product_id"), F.col("product_name").alias("product_name_raw"),
            "food_name_candidate", "product_url",
        "sales_unit_raw", "weight_raw", "quantity_raw", value("food_type").alias("food_type_raw"), source("food_type").alias("food_type_source"),
        value("expiration").alias("expiration_info_raw"), source("expiration").alias("expiration_source"),
            value("storage").alias("storage_method_raw"), source("storage").alias("storage_source"),
        storage_type.alias("storage_type"), of_image(F.col("ocr_confidence")).alias("ocr_confidence"), "crawl_collected_at",
            of_image(F.col("ocr_collected_at")).alias("ocr_collected_at"),
        F.lit(parser_version).alias("parser_version"), merge.rollup_status(*[F.col(f"_{n}.status") for n in pairs]).alias("validation_status"),
        merge.parse_status(value("expiration"), value("storage"), third).alias("parse_status"), record.alias("source_record_id"),
            of_image(F.col("digest")).alias("image_sha256"),
    )

"""Accepted bundles: files, artifacts, registration as one step."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from provlake.functions import hashing
from provlake.functions.text import col
from provlake.operators import intake
from provlake.sources.readers import _fs as folder
from provlake.sources.readers import file_hashes, read_json_strict

# Logical names of the files of an accepted bundle.
LOGICAL = {
    "manifest": "manifest.json", "validation_report": "validation_report.json", "products": "products.csv", "crawled_products": "crawled_products.csv",
    "discovered_products": "discovered_products.csv", "image_text_check": "image_text_check.csv", "failures": "failures.csv",
}


def bundle_files(spark: SparkSession, pattern: str) -> DataFrame:
    """(batch_id, logical_name, path, size, sha256) of the known files below accepted/<batch>/."""
    names = spark.createDataFrame([(v, k) for k, v in LOGICAL.items()], "name string, logical_name string")
    files = file_hashes(spark, pattern).withColumn("batch_id", F.element_at(F.split("path", "/"), -2))
    return files.join(F.broadcast(names), "name").select("batch_id", "logical_name", "path", "size", "sha256")


def artifact_records(files: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """One artifact row for each file: deterministic id, format by suffix, rows and versions from a profile (path, ...)."""
    run = hashing.intake_run_id("batch_id", F.max(F.when(F.col("logical_name") == "manifest", F.col("sha256"))).over(Window.partitionBy("batch_id")))
    out = files.withColumn("run_id", run)
    suffix = F.lower(F.regexp_extract("path", "[.]([A-Za-z0-9]+)$", 1))
    out = out.select("run_id", hashing.artifact_id("run_id", "logical_name", "sha256").alias("artifact_id"), "batch_id", "logical_name", "path",
        F.upper(suffix).alias("format"), "size", F.col("sha256").alias("checksum"))
    if profile is None:
        return out.withColumns({"row_count": F.lit(None).cast("long"), "schema_versions": F.lit(None).cast("string")})
    return out.join(profile.select("path", "row_count", "schema_versions"), "path", "left")


def bundled_in(artifacts: DataFrame) -> DataFrame:
    """Lineage edges from every other file of a bundle to its manifest."""
    m = artifacts.where("logical_name = 'manifest'").select("run_id", F.col("artifact_id").alias("child"))
    rest = artifacts.where("logical_name <> 'manifest'").select("run_id", F.col("artifact_id").alias("parent"))
    return rest.join(m, "run_id").select("parent", "child", F.lit("BUNDLED_IN").alias("relation"))


def validate_batches(batches: DataFrame, files: DataFrame, issues: DataFrame, accepted: DataFrame) -> DataFrame:
    """One report row for each batch (batch_id, member): missing files, issues, bundle checksum, decision.

    files: batch_id, name, sha256; issues: batch_id (one row each); accepted: batch_id, bundle_checksum.
    """
    have = files.groupBy("batch_id").agg(F.collect_set("name").alias("_have"))
    sums = hashing.bundle_checksum(files, ["batch_id"])
    n = issues.groupBy("batch_id").agg(F.count("*").alias("n_issues"))
    was = accepted.select("batch_id", F.col("bundle_checksum").alias("_was"))
    out = batches.join(have, "batch_id", "left").join(sums, "batch_id", "left").join(n, "batch_id", "left").join(was, "batch_id", "left").fillna(0,
        ["n_issues"])
    missing = F.array_sort(intake.missing_files(F.coalesce("_have", F.array().cast("array<string>"))))
    error = intake.identity_error("batch_id", "member")
    return out.select("batch_id", "member", error.alias("identity_error"), F.array_join(missing, ",").alias("missing"), "n_issues", "bundle_checksum",
        intake.decide(error, missing, F.col("n_issues"), F.col("_was"), F.col("bundle_checksum")).alias("decision"))


def accepted_uris(batch: str | Column, root: str = "inbox/accepted") -> Column:
    base = F.concat(F.lit(f"{root}/"), col(batch), F.lit("/"))
    return F.struct(*[F.concat(base, F.lit(LOGICAL[k])).alias(k) for k in ("discovered_products", "crawled_products", "products")])


def suggested_batch_id(member: str | Column, at: Column, sequence: int = 1) -> Column:
    """<day in Korea>-<member>-<sequence>."""
    return F.concat_ws("-", F.date_format(F.from_utc_timestamp(at, "Asia/Seoul"), "yyyyMMdd"), col(member), F.lit(f"{sequence:03d}"))


def copy_mismatches(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("batch_id", "name"), digest: str = "sha256") -> DataFrame:
    """Files whose copy is missing or differs: keys and COPY_CHECKSUM_MISMATCH."""
    copied = after.select(*keys, F.col(digest).alias("_copy"))
    return before.join(copied, list(keys), "left").where(~F.col(digest).eqNullSafe(F.col("_copy"))).select(*keys, F.lit("COPY_CHECKSUM_MISMATCH").alias("code"))


def _same_or_refused(spark: SparkSession, files: DataFrame, target: str) -> None:
    """Raises unless target holds exactly the files (path, name) and an accepted manifest."""
    paths = [r.path for r in files.select("path").collect()]  # the names of one batch's files, a handful
    asked = file_hashes(spark, paths).drop("name").join(files.select("path", "name"), "path").select("name", "sha256")
    there = file_hashes(spark, f"{target}/*").where(~F.col("name").isin("manifest.json", "validation_report.json")).select("name", "sha256")
    if not asked.exceptAll(there).isEmpty() or not there.exceptAll(asked).isEmpty():
        raise FileExistsError(f"BATCH_ALREADY_ACCEPTED_DIFFERENT_CONTENT: {target}")
    manifest = read_json_strict(spark, f"{target}/manifest.jso[n]").select(F.get_json_object("payload", "$.status").alias("s")).collect()
    if [r.s for r in manifest] != ["ACCEPTED"]:
        raise ValueError(f"ACCEPTED_MANIFEST_INVALID: {target}")


def submit(spark: SparkSession, files: DataFrame, root: str, batch: str, report: DataFrame) -> str:
    """The files (path, name) of a batch as accepted/<batch>: copied beside it, hashed again, then one rename.

    The same files under an accepted batch's name again change nothing; other files are refused with BATCH_ALREADY_ACCEPTED_DIFFERENT_CONTENT, and
    a batch whose manifest is no accepted one with ACCEPTED_MANIFEST_INVALID.  A copy that differs raises COPY_CHECKSUM_MISMATCH and nothing is
    left behind.  The report's one row becomes manifest.json and validation_report.json; only its bytes pass the driver.
    """
    target, staging = f"{root.rstrip('/')}/{batch}", f"{root.rstrip('/')}/.{batch}-{uuid.uuid4().hex}"
    fs, path = folder(spark, target)
    if fs.exists(path):
        _same_or_refused(spark, files, target)
        return target
    make = spark._jvm.org.apache.hadoop.fs.Path
    util, conf = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jsc.hadoopConfiguration()
    try:
        fs.mkdirs(make(staging))
        rows = files.select("path", "name").collect()  # the names of one batch's files, a handful
        for r in rows:
            source = make(r.path)
            if not util.copy(source.getFileSystem(conf), source, fs, make(f"{staging}/{r.name}"), False, conf):
                raise OSError(r.path)
        wrong = copy_mismatches(file_hashes(spark, [r.path for r in rows]).drop("name").join(files.select("path", "name"), "path"),
            file_hashes(spark, f"{staging}/*"), ["name"])
        if bad := wrong.collect():
            raise ValueError("COPY_CHECKSUM_MISMATCH: " + ", ".join(r.name for r in bad))
        pretty = json.dumps(json.loads(report.select(F.to_json(F.struct("*"))).first()[0]), ensure_ascii=False, indent=2) + "\n"
        for name in ("validation_report.json", "manifest.json"):
            stream = fs.create(make(f"{staging}/{name}"))
            stream.write(pretty.encode())
            stream.close()
        if not fs.rename(make(staging), path):
            raise OSError(target)
    finally:
        fs.delete(make(staging), True)
    return target


def accepted_manifests(raw: DataFrame) -> DataFrame:
    """raw (batch_id, payload, sha256, size) -> reference rows with `issue`: null, or why the manifest can't be used.

    Issues, the first that holds: ACCEPTED_MANIFEST_INVALID (no JSON object, or the identity is wrong), CONTENT_HASH_MISMATCH (its own
    hash does not fit), NOT_ACCEPTED.  The artifact's id is that of the manifest's bytes.
    """
    v = lambda k: F.get_json_object("payload", f"$.{k}")
    ok = F.coalesce(F.schema_of_variant(F.try_parse_json("payload")).startswith("OBJECT"), F.lit(False))
    error = intake.identity_error("batch_id", F.coalesce(v("member"), F.lit("")))
    issue = (
        F.when(~ok | error.isNotNull(), "ACCEPTED_MANIFEST_INVALID")
        .when(v("content_hash").isNotNull() & (v("content_hash") != hashing.open_content_hash("payload")), "CONTENT_HASH_MISMATCH")
        .when(~v("status").eqNullSafe(F.lit("ACCEPTED")), "NOT_ACCEPTED")
    )
    name = F.concat_ws(":", F.lit("collection_submission"), "batch_id", "sha256")
    return raw.select("batch_id", v("member").alias("member"), issue.alias("issue"), hashing.uuid5(name).alias("artifact_id"),
        F.lit("collection_manifest").alias("logical_name"), F.lit("JSON").alias("format"), F.col("sha256").alias("checksum"), "size",
        v("schema_version").alias("schema_version"), F.coalesce(v("row_count").try_cast("long"), F.lit(0).cast("long")).alias("row_count"),
        v("parser_version").alias("code_version"))


def register_accepted(manifests: DataFrame, files: DataFrame, runs: DataFrame) -> dict[str, DataFrame]:
    """Tables of the bundles that are accepted and not registered yet: runs, steps, artifacts, edges.

    manifests: as accepted_manifests gives them; files: batch_id, logical_name, path, size, sha256; runs: run_id.  A second call with
    the runs of the first gives no rows: ids follow from the content.
    """
    good = manifests.where("issue is null").select("batch_id", F.col("checksum").alias("_sum")).withColumn("run_id", hashing.intake_run_id("batch_id", "_sum"))
    new = good.join(runs.select("run_id"), "run_id", "left_anti")
    own = files.join(new.select("batch_id"), "batch_id", "left_semi")
    artifacts = artifact_records(own)
    run = new.select("run_id", "batch_id", F.lit("SUCCEEDED").alias("status"))
    step = new.select(hashing.uuid5(F.concat_ws(":", "run_id", F.lit("register"))).alias("step_id"), "run_id", F.lit("register").alias("name"),
        F.lit("SUCCEEDED").alias("status"))
    return {"runs": run, "steps": step, "artifacts": artifacts, "edges": bundled_in(artifacts)}


def manifest_artifact(artifacts: DataFrame, run_id: str = "run_id") -> DataFrame:
    """The manifest's artifact of each run; of several the least id."""
    return artifacts.where("logical_name = 'manifest'").groupBy(run_id).agg(F.min("artifact_id").alias("artifact_id"))

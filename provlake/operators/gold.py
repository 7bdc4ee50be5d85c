"""Gold bundles: one versioned unit of Parquet, CSV, a quality summary and a manifest, which alone makes it exist.

`<root>/<name>/<version>/manifest.json` names everything else, with checksums.  An attempt writes its data into a folder of its own
beside it and creates the manifest last, if there is none.  So a crash at any step leaves no bundle and does not disturb the next attempt, two writers of
one version can't mix their files, and readers, who go by the manifest only, see a whole bundle or none.  `sweep` takes
away what failed attempts left.

The same rows under the same version again: DUPLICATE, nothing is written.  Other rows: VersionConflict.  Rows are compared by number
and by an order-free checksum.  Rows that are not approved, break a rule or share their key with another are not published; they are counted in the summary.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.functions import hashing
from provlake.operators import publish
from provlake.sources.commit import create_file, delete, names_in, read_file
from provlake.sources.readers import file_hashes

APPROVED = ("AUTO_APPROVED", "APPROVED")


class BundleError(ValueError):
    """MANIFEST_MISSING, MANIFEST_INVALID, CHECKSUM_MISMATCH or ROW_COUNT_MISMATCH."""


class VersionConflict(BundleError):
    """Other rows stand under this version."""


@dataclass(frozen=True)
class Bundle:
    path: str
    status: str  # PUBLISHED or DUPLICATE
    manifest: Mapping


def publishable(rows: DataFrame, key: str, rules: Mapping[str, Column], approved: Sequence[str] = APPROVED) -> DataFrame:
    """rows with `reason`: null, NOT_APPROVED, the first broken rule, or DUPLICATE_KEY (any two rows that share the key; a null key too)."""
    often = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select(F.col(key).alias("_key"))
    out = rows.join(often, rows[key].eqNullSafe(often["_key"]), "left")
    broken = F.coalesce(*[F.when(~F.coalesce(c, F.lit(False)), n) for n, c in rules.items()], F.lit(None).cast("string"))
    shared = F.when(F.col(key).isNull() | F.col("_key").isNotNull(), "DUPLICATE_KEY")
    first = F.when(~F.coalesce(F.col("review_status").isin(*approved), F.lit(False)), "NOT_APPROVED")
    return out.withColumn("reason", F.coalesce(first, broken, shared)).drop("_key")


def content(rows: DataFrame) -> dict:
    """{row_count, checksum} of rows, whatever their order."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})]
    r = rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("s")).first()
    return {"row_count": r.n, "checksum": str(r.s or 0)}


def quality_summary(tagged: DataFrame, key: str, rules: Mapping[str, Column]) -> dict:
    """What became of the rows, and each rule's pass rate over all of them."""
    counts = {r.reason or "PUBLISHED": r["count"] for r in tagged.groupBy("reason").count().collect()}  # a row for each reason
    rates = publish.pass_rates(tagged, rules, key).drop("sample").collect() if rules else []
    return {"outcomes": dict(sorted(counts.items())), "rules": [r.asDict() for r in sorted(rates, key=lambda r: r.rule)]}


def _output(spark: SparkSession, folder: str, name: str, suffix: str) -> dict:
    """The entry of one output: its path below the version, number of files, and checksum over their names and digests."""
    files = file_hashes(spark, f"{folder}/{name}/part-*").withColumn("g", F.lit(1))
    r = hashing.bundle_checksum(files, ["g"]).join(files.groupBy("g").agg(F.count("*").alias("n"), F.sum("size").alias("size")), "g").first()
    return {"path": f"{folder.rstrip('/').rsplit('/', 1)[1]}/{name}", "format": suffix, "files": r.n, "bytes": r["size"], "sha256": r.bundle_checksum}


def publish_bundle(
    rows: DataFrame, root: str, version: str, key: str, columns: Sequence[str], rules: Mapping[str, Column], inputs: DataFrame, created_at: str,
    name: str = "freshness_profiles", schema_version: str = "1.0.0", rule_version: str = "1.0.0", files_of: int = 1_000_000,
        step: Callable[[str], None] = lambda _: None,
) -> Bundle:
    """rows (with review_status) as version `version`.  inputs: artifact_id, checksum, one row for each input artifact.

    files_of: rows of a file at most.  step is told what is about to happen: check, data, csv, quality, manifest.
    """
    spark = rows.sparkSession
    base = f"{root.rstrip('/')}/{name}/{version}"
    step("check")
    tagged = publishable(rows, key, rules)
    good = publish.publish(tagged.where("reason is null"), columns, version)
    now = content(good)
    if (there := _manifest(spark, base)) is not None:
        return _settled(base, there, now)
    attempt = f"{base}/data-{uuid.uuid4().hex}"
    step("data")
    good.write.option("maxRecordsPerFile", files_of).parquet(f"{attempt}/{name}.parquet")
    step("csv")
    stored = spark.read.parquet(f"{attempt}/{name}.parquet")
    stored.write.option("maxRecordsPerFile", files_of).option("header", True).option("escape", '"').csv(f"{attempt}/{name}.csv")
    step("quality")
    summary = quality_summary(tagged, key, rules)
    text = json.dumps(summary, ensure_ascii=False, sort_keys=True, indent=2) + "\n"
    create_file(spark, f"{attempt}/quality_summary.json", text.encode())
    manifest = {
        "dataset_name": name, "dataset_version": version, "schema_version": schema_version, "rule_version": rule_version, "created_at": created_at,
        "inputs": [r.asDict() for r in inputs.select("artifact_id", "checksum").distinct().orderBy("artifact_id", "checksum").collect()],  # artifacts, not rows
        **now, "columns": good.columns, "quality": summary,
        "outputs": [_output(spark, attempt, f"{name}.{suffix}", suffix) for suffix in ("parquet", "csv")],
            "quality_summary": f"{attempt.rsplit('/', 1)[1]}/quality_summary.json",
    }
    step("manifest")
    if create_file(spark, f"{base}/manifest.json", (json.dumps(manifest, ensure_ascii=False, sort_keys=True, indent=2) + "\n").encode()):
        return Bundle(base, "PUBLISHED", manifest)
    delete(spark, attempt)  # another writer was faster
    return _settled(base, _manifest(spark, base) or {}, now)


def _settled(base: str, there: Mapping, now: Mapping) -> Bundle:
    if any(there.get(k) != v for k, v in now.items()):
        raise VersionConflict(f"{base} has other rows: {there.get('row_count')} with checksum {there.get('checksum')}")
    return Bundle(base, "DUPLICATE", there)


def _manifest(spark: SparkSession, base: str) -> dict | None:
    raw = read_file(spark, f"{base}/manifest.json")
    return None if raw is None else json.loads(raw)


def read_bundle(spark: SparkSession, root: str, version: str, name: str = "freshness_profiles", verify: bool = True) -> DataFrame:
    """The rows of a published version, after its checksums and its number of rows are verified."""
    base = f"{root.rstrip('/')}/{name}/{version}"
    try:
        manifest = _manifest(spark, base)
    except ValueError as e:
        raise BundleError(f"MANIFEST_INVALID: {base}") from e
    if manifest is None:
        raise BundleError(f"MANIFEST_MISSING: {base}")
    outputs = {o["format"]: o for o in manifest["outputs"]}
    if verify:
        for o in outputs.values():
            folder, file = o["path"].split("/")
            now = _output(spark, f"{base}/{folder}", file, o["format"]) if file in names_in(spark, f"{base}/{folder}") else {}
            if now != o:
                raise BundleError(f"CHECKSUM_MISMATCH: {o['path']}")
    out = spark.read.parquet(f"{base}/{outputs['parquet']['path']}")
    if verify and content(out) != {k: manifest[k] for k in ("row_count", "checksum")}:
        raise BundleError(f"ROW_COUNT_MISMATCH: {base}")
    return out


def versions(spark: SparkSession, root: str, name: str = "freshness_profiles") -> list[str]:
    """The published versions, sorted: folders with a manifest."""
    base = f"{root.rstrip('/')}/{name}"
    return [v for v in names_in(spark, base) if "manifest.json" in names_in(spark, f"{base}/{v}")]


def sweep(spark: SparkSession, root: str, version: str, name: str = "freshness_profiles") -> int:
    """How many folders of failed attempts it took away.  Not while a writer of this version is at work."""
    base = f"{root.rstrip('/')}/{name}/{version}"
    manifest = _manifest(spark, base) or {"outputs": []}
    used = {o["path"].split("/")[0] for o in manifest["outputs"]}
    gone = [n for n in names_in(spark, base) if n.startswith("data-") and n not in used]
    for n in gone:
        delete(spark, f"{base}/{n}")
    return len(gone)

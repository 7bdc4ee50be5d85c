"""Read-side summaries: counts by batch, states, labels, progress of logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions.text import blank_to_null, col

# Patterns of one finished item in a step's log.
PROGRESS = {"collect": "(?m)^(OK:|SKIP:|FAILED:)", "classify": "(?m)^(HAS_TEXT|NO_TEXT|UNKNOWN):", "ocr": "(?m)^(OK:|SKIP_NO_TEXT:|FAILED:)",
    "batch": "(?m)^BATCH_DONE:"}
SOURCE_LABELS = {"SEARCH": "search", "CATEGORY": "category", "URL_LIST": "URL list"}


def counts(table: DataFrame, key: str, name: str) -> DataFrame:
    return table.groupBy(key).agg(F.count("*").alias(name))


def with_counts(base: DataFrame, key: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """base with one count column for each table (0 where it has no row), from counts made before the join."""
    for name, table in tables.items():
        base = base.join(counts(table, key, name), key, "left").fillna(0, [name])
    return base


def pipeline_status(accepted: Column, done: Column, crawled: Column) -> Column:
    return F.when(accepted, "ACCEPTED").when(done, "OCR_DONE").when(crawled, "CRAWLED").otherwise("IN_PROGRESS")


def submission_status(manifest: Column, report: Column, all_files: Column) -> Column:
    return F.coalesce(manifest, report, F.when(all_files, "READY").otherwise("INCOMPLETE"))


def presence_histogram(checks: DataFrame, key: str, presence: str) -> DataFrame:
    """Counts by presence; the total counts every value that is not blank, known or not."""
    p = F.upper(blank_to_null(presence))
    kinds = {"has_text": "HAS_TEXT", "no_text": "NO_TEXT", "unknown": "UNKNOWN"}
    return checks.groupBy(key).agg(*[F.count_if(p == v).alias(n) for n, v in kinds.items()], F.count(p).alias("total"))


def discovery_label(mode: str | Column, value: str | Column) -> Column:
    m = F.upper(blank_to_null(mode))
    label = m
    for k, v in SOURCE_LABELS.items():
        label = F.when(m == k, v).otherwise(label)
    return F.when(label.isNull(), F.lit("-")).otherwise(F.concat_ws(": ", label, blank_to_null(value)))


def progress_events(step: str, log: str | Column) -> Column:
    if step == "discover":
        return F.coalesce(F.regexp_extract(F.coalesce(col(log), F.lit("")), "Discovered=([0-9]+)", 1).try_cast("int"), F.lit(0))
    return F.regexp_count(F.coalesce(col(log), F.lit("")), F.lit(PROGRESS[step]))


def progress_percent(done: str | Column, total: str | Column) -> Column:
    """0 to 100, halves to even; null without a total."""
    d, t = col(done).cast("double"), col(total).cast("double")
    return F.when(t > 0, F.greatest(F.lit(0), F.least(F.lit(100), F.bround(100 * d / t).cast("int"))))


def csv_profile(rows: DataFrame, key: str, version: str = "schema_version") -> DataFrame:
    """row_count and the sorted distinct versions, joined by commas."""
    return rows.groupBy(key).agg(F.count("*").alias("row_count"),
        F.array_join(F.array_sort(F.collect_set(blank_to_null(version))), ",").alias("schema_versions"))


def outcome_counters(rows: DataFrame, key: str, outcome: str, kinds: Mapping[str, Sequence[str]]) -> DataFrame:
    """One column for each name in kinds: how many rows of the key have one of its outcomes."""
    return rows.groupBy(key).agg(*[F.count_if(F.col(outcome).isin(*values)).alias(n) for n, values in kinds.items()])

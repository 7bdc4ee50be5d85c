"""All queries of the product-page engine, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from provlake.plans import agreements, batches, discovery, expiry, extraction, gold, layout, matching, products, records, registration, registry, relations, stores, streams, submissions

Query = Callable[[SparkSession, str], DataFrame]
_ALL = [*relations.QUERIES, *discovery.QUERIES, *extraction.QUERIES, *registry.QUERIES, *layout.QUERIES, *records.QUERIES, *matching.QUERIES,
    *gold.QUERIES, *agreements.QUERIES, *stores.QUERIES, *streams.QUERIES, *submissions.QUERIES, *batches.QUERIES, *registration.QUERIES,
    *products.QUERIES, *expiry.QUERIES]


def queries() -> dict[str, Query]:
    return {f.__name__: f for f, _ in _ALL}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: sql for f, sql in _ALL if sql}

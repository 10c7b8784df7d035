"""All queries of the core, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from provlake.plans import data_quality, diffs, discovery, event_log, ledger, scalars, streams

_PARTS = (ledger.book, event_log.book, diffs.book, discovery.book, scalars.book, streams, data_quality)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for part in _PARTS for k, v in part.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for part in _PARTS for k, v in part.oracle_sql().items()}

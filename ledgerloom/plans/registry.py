"""Named queries over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import queries_answers, queries_documents, queries_fields, queries_more, queries_projection, queries_readers, queries_records, queries_reports, queries_scores, queries_statements, queries_summaries

_MODULES = (queries_records, queries_reports, queries_more, queries_fields, queries_scores, queries_readers, queries_documents, queries_statements, queries_answers, queries_summaries, queries_projection)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for module in _MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}

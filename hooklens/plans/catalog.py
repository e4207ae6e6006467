"""All registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hooklens.plans import (
    corpus_queries, evaluation_queries, rule_queries, signal_queries, text_queries,
)

_FAMILIES = (corpus_queries, signal_queries, rule_queries, evaluation_queries, text_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for family in _FAMILIES for name, run in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for family in _FAMILIES for name, text in family.oracle().items()}

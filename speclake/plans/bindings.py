"""The registered queries: each operator bound to the given tables, with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from speclake.plans import corpus_queries, ingest_queries, learning_queries, record_queries, relational_queries, scalar_queries, stream_queries, vector_queries

MODULES = (scalar_queries, relational_queries, corpus_queries, vector_queries, record_queries, stream_queries, ingest_queries, learning_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}

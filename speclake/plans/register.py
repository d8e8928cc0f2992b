"""A table of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def registry() -> tuple[dict, dict, Callable]:
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    sql: dict[str, str] = {}

    def query(text: str | None = None) -> Callable:
        def add(f: Callable) -> Callable:
            queries[f.__name__] = f
            if text:
                sql[f.__name__] = text
            return f

        return add

    return queries, sql, query


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Registered queries: a Spark callable and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a callable ``(spark, folder) -> DataFrame`` under a name."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its schema is read from the footer once."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def load_all() -> None:
    """Import every query module once."""
    from loadlens.queries import (  # noqa: F401
        audit_queries,
        delete_queries,
        duplicate_queries,
        file_queries,
        head_queries,
        history_queries,
        key_queries,
        line_queries,
        profile_queries,
        scalar_queries,
        series_queries,
        stored_queries,
        stream_queries,
    )

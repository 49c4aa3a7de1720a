"""Named queries over the test tables and the SQL that states the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def demo(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name; decimals are returned as doubles."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = function(spark, sf_dir)
            return out.select(*(F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`") for f in out.schema))

        _QUERIES[function.__name__] = run
        if sql is not None:
            _SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    from tributary.plans import audits, documents, relational, runs, scalars, scans, state  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)

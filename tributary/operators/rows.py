"""Picking, requiring and counting rows by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each ``key`` that is greatest by ``order``, which other columns do not decide; the last one wins."""
    rest = [c for c in df.columns if c not in key]
    latest = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return latest.select(*key, *(F.col("_row")[c].alias(c) for c in rest)).select(df.columns)


def with_whole_key(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """``df`` with ``parts`` (name: column) as whole numbers; rows that lack one are dropped."""
    return df.withColumns({name: c.try_cast("long") for name, c in parts.items()}).dropna(subset=list(parts))


def required(df: DataFrame, *columns: Column) -> DataFrame:
    """Rows in which none of ``columns`` is null."""
    return df.where(reduce(lambda a, b: a & b, (c.isNotNull() for c in columns)))


def with_items(docs: DataFrame, items: DataFrame, key: dict[str, str], counted: str = "n_items") -> DataFrame:
    """Documents that have items, with their number; ``key`` maps columns of ``docs`` to those of ``items``."""
    per = items.groupBy(*(F.col(b).alias(a) for a, b in key.items())).agg(F.count(F.lit(1)).alias(counted))
    return docs.join(per, list(key))


def distinct_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: how many different keys there are."""
    return df.agg(F.count_distinct(F.struct(*key)).alias("n"))


def distinct_list(df: DataFrame, key: list[str], value: Column, order: list[str], as_name: str) -> DataFrame:
    """The distinct values of each key in the order in which they come first; nulls are left out."""
    first = df.select(*key, value.alias("_value"), F.struct(*order).alias("_at")).dropna(subset=["_value"]).groupBy(*key, "_value").agg(F.min("_at").alias("_at"))
    listed = first.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_at", "_value"))).alias("_all"))
    return listed.select(*key, F.col("_all")["_value"].alias(as_name))


def counts(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


def top_counts(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent keys; ties in their order."""
    return counts(df, key).orderBy(F.desc("n"), key).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """entity and n: the rows of each table, 0 for an empty one."""
    return reduce(DataFrame.union, (t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("entity"), "n") for name, t in tables.items()))


def removed_keys(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Keys that ``before`` has and ``after`` lacks."""
    return before.select(*key).distinct().join(after.select(*key), key, "left_anti")


def filled(df: DataFrame, column: str, as_name: str) -> DataFrame:
    """One row: all rows, and those whose ``column`` is not null."""
    return df.agg(F.count(F.lit(1)).alias("n_lines"), F.count(column).alias(as_name))


def changed_children(children: DataFrame, parents: DataFrame, key: list[str], modified: Column, created: Column, cursor: Column) -> DataFrame:
    """Children of the parents that were modified, or else created, after ``cursor``."""
    changed = parents.where(F.coalesce(modified, created) > cursor)
    return children.join(changed.select(*key), key, "left_semi")

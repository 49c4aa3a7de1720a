"""Joins in which one key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_HEAVY = 1000


def join_counted(rows: DataFrame, names: DataFrame, key: str, n: str, *, most_heavy: int = MOST_HEAVY) -> DataFrame:
    """The inner join of ``rows`` with ``names``, which has one row for each ``key`` and in ``n`` how many of ``rows`` have it.

    A key with more than one in ``most_heavy`` of those rows is heavy. There are fewer than ``most_heavy`` such keys,
    however large the tables are, so that their names are broadcast and their rows stay where they are; all others are
    joined by shuffles, in which no key weighs more than that share. Both tables are read twice, so give stored ones.
    Rows with a null key, or one without a name, go; ``n`` is dropped. Columns of ``names`` may not be named as those of
    ``rows``, the key apart. Empty tables give no rows.
    """
    total = names.agg(F.sum(n)).first()[0] or 0
    is_heavy = F.col(n) * most_heavy > total
    heavy, light = names.where(is_heavy).drop(n), names.where(~is_heavy).drop(n)
    here = rows.join(F.broadcast(heavy), key)
    there = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return here.unionByName(there)

"""Vectors that can be computed with, and the best rows of each key."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.workspace import stored

#: Entries from here on are not taken: 64 times them is no longer a whole number that a double holds exactly.
TOO_LARGE = float(1 << 46)


def usable(df: DataFrame, *, id_col: str, vector_col: str, nonzero: bool = False) -> DataFrame:
    """(row, id, vector): the rows whose vectors can be computed with, numbered; stored, so that the numbers stay.

    A vector that is null, empty, or holds null, non-finite or huge entries (2^46 or more) takes no part, nor does one of
    another length than most have (of equally common lengths the longer counts). ``nonzero``: nor one of zeros only.
    """
    vector = F.col(f"`{vector_col}`")
    fits = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < TOO_LARGE))
    if nonzero:
        fits = fits & F.exists(vector, lambda v: v != 0)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector")).where(F.coalesce(fits, F.lit(False)) & (F.size("vector") > 0))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).first()
    return rows.where(F.size("vector") == (length["d"] if length else 0))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as the rows of a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def best(rows: DataFrame, key: list[str], order: list[Column], k: int, spread: str) -> DataFrame:
    """The first ``k`` rows of each ``key`` by ``order``, with their ``rank`` from 1.

    Taken within shares of a key first, by the number ``spread``, as a key may have rows from every task.
    """
    shares = rows.withColumn("_share", F.pmod(F.col(spread), F.lit(64)))
    first = shares.withColumn("rank", F.row_number().over(Window.partitionBy(*key, "_share").orderBy(*order))).where(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= k).drop("_share")

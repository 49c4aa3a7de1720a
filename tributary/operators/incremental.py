"""Cursors, pending windows and run state."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.specs import EntitySpec

STATE = "entity string, last_id long, last_ts timestamp_ntz, last_run timestamp_ntz, records_sent long, status string"


def is_fresh(state) -> bool:
    """Whether no cursor is known: the run then reads all rows."""
    return state is None or (state["last_id"] is None and state["last_ts"] is None)


def run_mode(state: DataFrame, specs: DataFrame) -> DataFrame:
    """entity and mode (FULL or INCREMENTAL) of ``specs`` (entity, full_load) given ``state`` (STATE)."""
    known = specs.join(state.select("entity", "last_id", "last_ts"), "entity", "left")
    full = F.col("full_load") | (F.col("last_id").isNull() & F.col("last_ts").isNull())
    return known.select("entity", F.when(full, "FULL").otherwise("INCREMENTAL").alias("mode"))


def pending_window(spec: EntitySpec, as_of: Column) -> Column:
    """Rows of the pending status that are younger than the window."""
    return (F.col(spec.pending_column) == spec.pending_value) & (F.col(spec.ts_column) > as_of - F.expr(f"INTERVAL {spec.pending_days} DAYS"))


def changed_rows(df: DataFrame, spec: EntitySpec, state, as_of: Column) -> DataFrame:
    """Rows past the cursor, or pending in the window; all rows of a full load, a first run, or where no test applies.

    ``state`` is a row of STATE or None; ``as_of`` the time of the run.
    """
    if spec.full_load or is_fresh(state):
        return df
    tests = []
    if spec.id_column in df.columns and state["last_id"] is not None:
        tests.append(F.col(spec.id_column) > state["last_id"])
    if spec.ts_column in df.columns and state["last_ts"] is not None:
        tests.append(F.col(spec.ts_column) > F.lit(state["last_ts"]))
    if spec.pending_days and spec.pending_value is not None and spec.pending_column in df.columns and spec.ts_column in df.columns:
        tests.append(pending_window(spec, as_of))
    return df.where(reduce(or_, tests)) if tests else df


def limited(df: DataFrame, cursor: str, key: tuple[str, ...], n: int) -> DataFrame:
    """The first ``n`` rows in the order of the cursor, with all that tie with the last of them."""
    last = df.orderBy(cursor, *key).limit(n).agg(F.max(cursor).alias("_last"))
    return df.join(F.broadcast(last), F.col(cursor) <= F.col("_last")).drop("_last")


def cursor_values(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row: the largest id and time, nulls ignored."""
    last_id = F.max(F.col(spec.id_column).cast("long")) if spec.id_column in df.columns else F.lit(None).cast("long")
    last_ts = F.max(F.col(spec.ts_column).cast("timestamp_ntz")) if spec.ts_column in df.columns else F.lit(None).cast("timestamp_ntz")
    return df.agg(last_id.alias("last_id"), last_ts.alias("last_ts"), F.count(F.lit(1)).alias("records"))


def succeeded(state: DataFrame, runs: DataFrame) -> DataFrame:
    """``state`` after ``runs`` (entity, last_id, last_ts, run_at, records): a cursor that saw nothing new stays."""
    old = state.select("entity", F.col("last_id").alias("_id"), F.col("last_ts").alias("_ts"))
    new = runs.join(old, "entity", "left").select(
        "entity",
        F.coalesce("last_id", "_id").alias("last_id"),
        F.coalesce("last_ts", "_ts").alias("last_ts"),
        F.col("run_at").alias("last_run"),
        F.col("records").alias("records_sent"),
        F.lit("ok").alias("status"),
    )
    return state.join(runs, "entity", "left_anti").unionByName(new)


def failed(state: DataFrame, entity: str, error: str) -> DataFrame:
    """``state`` with the error (200 characters) as the status of ``entity``; its cursor stays."""
    now = F.lit(f"error: {error[:200]}")
    spark = state.sparkSession
    known = state.withColumn("status", F.when(F.col("entity") == entity, now).otherwise(F.col("status")))
    missing = spark.range(1).select(F.lit(entity).alias("entity"), now.alias("status")).join(state, "entity", "left_anti")
    return known.unionByName(missing, allowMissingColumns=True).select(state.columns)


def reset(state: DataFrame, entity: str | None = None) -> DataFrame:
    """``state`` without ``entity``, or empty: the next run is full."""
    return state.where(F.lit(False)) if entity is None else state.where(F.col("entity") != entity)


def status_report(specs: DataFrame, state: DataFrame) -> DataFrame:
    """All entities with their state; ``pending`` if they never ran."""
    return specs.select("entity").join(state, "entity", "left").withColumn("status", F.coalesce("status", F.lit("pending"))).orderBy("entity")


def missing_cursor_columns(df: DataFrame, spec: EntitySpec) -> list[str]:
    return [c for c in (spec.id_column, spec.ts_column, spec.pending_column) if c and c not in df.columns]


def missing_cursors(tables: dict[str, DataFrame], specs: dict[str, EntitySpec]) -> DataFrame:
    """entity, column_name and n_rows: cursor columns that tables lack, so that all their rows are read in every run."""
    found = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(e).alias("entity"), F.lit(c).alias("column_name"), "n_rows") for e, df in tables.items() for c in missing_cursor_columns(df, specs[e])]
    if not found:
        return next(iter(tables.values())).sparkSession.createDataFrame([], "entity string, column_name string, n_rows long")
    return reduce(DataFrame.unionByName, found)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)

"""Deciding what to do with each document, given what its link state says, and keeping that state."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.exprs import status_code


def order_action(status: Column, previous: Column, remote_id: Column, resolved: Column, sent: Column) -> Column:
    """create, resend, same, cancel or register.

    A confirmed order is created unless it was sent as confirmed before; then it is sent again if its ``resolved`` expense
    ids (a text, empty or null without any) are not those ``sent`` with it (null: unknown). A cancelled order that was sent
    as confirmed is cancelled. All others are registered.
    """
    now, before = status_code(status), status_code(previous)
    known = F.coalesce(resolved, F.lit(""))
    return (
        F.when((now == "R") & (before != "R"), "create")
        .when((now == "R") & (known != "") & ~known.eqNullSafe(sent), "resend")
        .when(now == "R", "same")
        .when((now == "A") & (before == "R") & (F.coalesce(remote_id, F.lit("")) != ""), "cancel")
        .otherwise("register")
    )


def feed_action(linked: Column, force: Column) -> Column:
    return F.when(linked & ~force, "skip").when(linked, "update").otherwise("create")


def upsert(state: DataFrame, changes: DataFrame, key: list[str], updated: str = "updated_at") -> DataFrame:
    """``state`` with ``changes``: the latest row of each key; at equal times a change wins. Columns may be added."""
    both = state.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*key, "_new")]
    latest = both.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(updated, "_new")).alias("_row"))
    return latest.select(*key, *(F.col("_row")[c].alias(c) for c in rest)).select([c for c in both.columns if c != "_new"])


def keep_target(changes: DataFrame, state: DataFrame, key: list[str], ident: str = "remote_id") -> DataFrame:
    """``changes`` that register only: the target id of the state stays, or is empty."""
    old = state.select(*key, F.col(ident).alias("_old"))
    return changes.drop(ident).join(old, key, "left").withColumn(ident, F.coalesce("_old", F.lit(""))).drop("_old")


def insert_absent(state: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    return state.unionByName(rows.join(state.select(*key), key, "left_anti"), allowMissingColumns=True)


class StateStore:
    """Versions of a state table in one folder: a version is written whole, then marked as current by renaming a file.

    Readers take the largest marked version. A writer that finds another one marked meanwhile stops, as its table was
    made from an older state. Of the versions before the current one ``keep`` stay.
    """

    def __init__(self, spark: SparkSession, folder: str, keep: int = 3):
        self.spark, self.folder, self.keep = spark, folder.rstrip("/"), keep

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, start: str) -> list[int]:
        path, files = self._path()
        found = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        return [int(n[len(start) :]) for n in found if n.startswith(start) and n[len(start) :].isdigit()]

    def version(self) -> int:
        return max(self._names("current-"), default=0)

    def read(self) -> DataFrame | None:
        n = self.version()
        return self.spark.read.parquet(f"{self.folder}/v{n}") if n else None

    def write(self, df: DataFrame) -> int:
        before, n = self.version(), 1 + max(self._names("v"), default=0)
        df.write.parquet(f"{self.folder}/v{n}")
        if self.version() != before:
            raise RuntimeError(f"{self.folder} was written by another run")
        marked, files = self._path(f"new-{uuid.uuid4().hex}")
        files.create(marked, False).close()
        if not files.rename(marked, self._path(f"current-{n}")[0]):
            raise RuntimeError(f"{self.folder} was written by another run")
        for start in ("current-", "v"):
            for old in self._names(start):
                if old < n - self.keep:
                    files.delete(self._path(f"{start}{old}")[0], True)
        return n

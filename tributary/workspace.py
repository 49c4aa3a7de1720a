"""The shared folder of a cluster, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a new temporary one, on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_scopes: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``stored`` within go at its end, but for those to ``keep``: write what was made of them before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Of each job within, shuffle files go when it ends, not when the driver happens to collect its garbage.

    A DataFrame that is taken twice is computed twice anyway: what jobs share is written and read back.
    """
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def stored(df: DataFrame, name: str, *, keep: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: any executor can be lost afterwards.

    The shuffle files of the job that writes it are removed when it ends; nothing reads them again. The table stays, unless
    it is made in the scope of ``temporary`` without ``keep``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if _scopes and not keep:
        _scopes[-1].append(path)
    with shuffles_removed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)

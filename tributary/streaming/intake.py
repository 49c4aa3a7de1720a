"""Snapshot files as they arrive: the batch jobs, run on each new set of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.plans.pipeline import Run

ARRIVED = "_arrived_at"


def arriving(spark: SparkSession, folder: str, schema: T.StructType, *, file_format: str = "parquet", files_per_trigger: int = 1000, line_breaks: bool = False) -> DataFrame:
    """The rows of files in ``folder`` as a stream. CSV files are split, unless ``line_breaks`` may stand in quoted fields."""
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if file_format == "csv":
        reader = reader.option("header", True).option("multiLine", line_breaks).option("escape", '"')
    return reader.load(folder)


def take_in(spark: SparkSession, folder: str, schema: T.StructType, job: Callable[[DataFrame, int], None], checkpoint: str, **how):
    """Run ``job`` on all files of ``folder`` that no earlier run with this ``checkpoint`` has seen, then stop.

    Files are taken in exactly once as far as ``job`` overwrites what it wrote for a batch id that it is given again.
    ``how``: see ``arriving``.
    """
    return _each(arriving(spark, folder, schema, **how), job, checkpoint)


def _each(rows: DataFrame, job: Callable[[DataFrame, int], None], checkpoint: str):
    query = rows.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_on_arrival(
    spark: SparkSession, folder: str, schema: T.StructType, entity: str, step: Callable[[Run], object], tables: dict[str, DataFrame], state: str, checkpoint: str, *, name: str = "arrivals", run: dict | None = None, **how
):
    """Take ``step`` of a ``Run`` over the rows of ``entity`` in each new set of files.

    A batch's run is named ``name`` and the batch's number, and dated by its newest file. A batch that is given again,
    because the job ended before the stream had noted it, overwrites its own payloads, ledger and decisions, and its
    writes of links are known by their number: it changes nothing. ``run``: other arguments of ``Run``; ``how``: see
    ``arriving``.
    """

    def job(batch: DataFrame, n: int) -> None:
        at = batch.agg(F.date_format(F.max(ARRIVED), "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")).first()[0]
        if at is not None:
            step(Run(spark, tables, state, as_of=at, arrived={entity: batch.drop(ARRIVED)}, stamp=f"{name}-{n:08d}", mark=(name, n), **(run or {})))

    rows = arriving(spark, folder, schema, **how)
    return _each(rows.select("*", F.col("_metadata.file_modification_time").alias(ARRIVED)), job, checkpoint)

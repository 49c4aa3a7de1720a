"""Table snapshots: CSV files, Parquet and JDBC tables in; CSV files out."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: <entity>_<yyyymmdd>_<hhmmss>.csv
SNAPSHOT_NAME = r"^(.+)_(\d{8}_\d{6})\.csv$"


def latest_snapshots(files: DataFrame, name: str = "name") -> DataFrame:
    """entity and the greatest file name of each, of the rows of ``files`` that are named like snapshots."""
    entity = F.regexp_extract(name, SNAPSHOT_NAME, 1)
    return files.where(entity != "").groupBy(entity.alias("entity")).agg(F.max(name).alias("name"))


def snapshot_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and name of the files directly in ``folder``; their content is not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"))


def read_csv_snapshot(spark: SparkSession, path: str | list[str], *, line_breaks: bool = False) -> DataFrame:
    """All columns as text, names in upper case, empty fields as null.

    ``line_breaks``: fields in quotes may hold them; each file is then read by one task, else files are split.
    """
    raw = spark.read.option("header", True).option("multiLine", line_breaks).option("escape", '"').option("inferSchema", False).csv(path)
    return upper_names(raw).select(*(F.nullif(F.col(c), F.lit("")).alias(c) for c in upper_names(raw).columns))


def read_latest(spark: SparkSession, folder: str, *, line_breaks: Collection[str] = ()) -> dict[str, DataFrame]:
    """The latest CSV snapshot of each entity in ``folder``: one row an entity reaches the driver.

    Give the entities with line breaks in fields.
    """
    latest = latest_snapshots(snapshot_files(spark, folder)).collect()
    return {r["entity"]: read_csv_snapshot(spark, f"{folder}/{r['name']}", line_breaks=r["entity"] in line_breaks) for r in latest}


def read_table(spark: SparkSession, source: str, table: str, **options) -> DataFrame:
    """A table of a relational source (``jdbc:`` url) or a Parquet file in a folder, with names in upper case.

    For JDBC, give ``column``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read in parallel.
    """
    if source.startswith("jdbc:"):
        return upper_names(spark.read.format("jdbc").options(url=source, dbtable=table, **options).load())
    return upper_names(spark.read.parquet(f"{source}/{table}.parquet"))


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.upper() for c in df.columns))


def optional_table(spark: SparkSession, source: str, table: str) -> DataFrame | None:
    """The table, or None if there is none."""
    from pyspark.errors import AnalysisException

    try:
        return read_table(spark, source, table)
    except AnalysisException:
        return None


def optional_column(df: DataFrame, name: str, kind: str, default=None) -> Column:
    """The column, or ``default`` (null) of type ``kind`` where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(default).cast(kind).alias(name)


def allowed_columns(df: DataFrame, allowed: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with those of ``allowed`` that it has, and the names that were dropped."""
    return df.select(*(c for c in allowed if c in df.columns)), [c for c in df.columns if c not in allowed]


def column_changes(spark: SparkSession, tables: dict[str, DataFrame], allowed: dict[str, list[str]]) -> DataFrame:
    """table_name, column_name, place and change (``dropped``: not allowed; ``missing``: allowed, not there) at intake, and n_filled: how many values are dropped.

    A few rows a table; the values of dropped columns are counted in one scan of each table that has some.
    """
    parts = []
    for name, df in tables.items():
        _, dropped = allowed_columns(df, allowed[name])
        missing = [c for c in allowed[name] if c not in df.columns]
        rows = [F.struct(F.lit(c).alias("column_name"), F.lit(df.columns.index(c) + 1).alias("place"), F.lit("dropped").alias("change"), F.col(f"_{n}").alias("n_filled")) for n, c in enumerate(dropped)]
        rows += [F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("int").alias("place"), F.lit("missing").alias("change"), F.lit(0).cast("long").alias("n_filled")) for c in missing]
        if rows:
            counted = df.agg(F.count(F.lit(1)).alias("_"), *(F.count(F.col(f"`{c}`")).alias(f"_{n}") for n, c in enumerate(dropped)))
            parts.append(counted.select(F.lit(name).alias("table_name"), F.inline(F.array(*rows))))
    empty = spark.createDataFrame([], "table_name string, column_name string, place int, change string, n_filled long")
    return reduce(DataFrame.unionByName, parts, empty)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns as the types of ``schema``; values that do not fit, and columns that are missing, are null."""
    fields = [F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType) for f in schema]
    return df.select(*(c.alias(f.name) for c, f in zip(fields, schema, strict=True)))


def rolling_window(df: DataFrame, date_column: str | None, as_of: Column, months: int) -> DataFrame:
    """Rows of the last 30 x ``months`` days before ``as_of``; all rows where no date column is named."""
    return df if date_column is None else df.where(F.col(date_column) >= as_of - F.expr(f"INTERVAL {30 * months} DAYS"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header each; timestamps to the second."""
    df.write.option("header", True).option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)

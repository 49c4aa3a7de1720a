"""Payload files: documents in batches with an envelope; import results and catalogs in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.workspace import stored

# The sections of an envelope, in order.
SECTIONS = ("centros_costo", "rubros", "clasificaciones", "proveedores", "pedidos", "ordenes_compra", "gastos", "ordenes_pago")


def batch_numbers(docs: DataFrame, order: list[str], size: int) -> DataFrame:
    """``docs`` with ``batch``: ``size`` documents each in the order of ``order``, which must be unique.

    Documents are numbered within range partitions, and partitions' sizes are added up: no task sees all rows. The
    partitions are stored with their numbers: planned twice, they would be coalesced in two ways. Partitions' sizes, one row
    for each, are joined as Spark sees fit.
    """
    ranged = stored(docs.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged", compression="zstd")
    within = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select("_part", before.alias("_base"))
    number = ((F.col("_base") + F.col("_n") - 1) / size).cast("long")
    return within.join(bases, "_part").withColumn("batch", number).drop("_part", "_n", "_base")


def envelopes(docs: DataFrame, section: str, doc: Column, *, dry_run: bool, options: dict[str, bool]) -> DataFrame:
    """One JSON envelope for each ``batch`` of ``docs``, with its number ``n`` of documents: its section holds them, the others are empty."""
    grouped = docs.groupBy("batch").agg(F.sort_array(F.collect_list(doc)).alias("_docs"))
    flags = F.struct(*(F.lit(v).alias(k) for k, v in options.items())) if options else F.struct(F.lit(True).alias("_"))
    parts = [F.col("_docs").alias(s) if s == section else F.array().cast("array<string>").alias(s) for s in SECTIONS]
    return grouped.select("batch", F.size("_docs").alias("n"), F.to_json(F.struct(F.lit(dry_run).alias("dry_run"), flags.alias("options"), *parts)).alias("payload"))


def _result_rows(results: DataFrame, json: str, section: str) -> DataFrame:
    kinds = "success:boolean,id:string,external_id:map<string,string>,error:string,validationErrors:map<string,array<string>>"
    parsed = F.from_json(json, f"results struct<`{section}`: array<struct<{kinds}>>>")
    return results.select(F.explode(parsed["results"][section]).alias("r")).select("r.*")


def import_results(results: DataFrame, json: str, section: str) -> DataFrame:
    """id and external_id of the successful rows of ``section`` in result documents, keys and ids being complete."""
    rows = _result_rows(results, json, section).select("success", "id", "external_id")
    return rows.where(F.col("success") & F.col("id").isNotNull() & (F.col("id") != "") & F.col("external_id").isNotNull())


def rejected_duplicates(results: DataFrame, json: str, section: str, field: str, words: tuple[str, ...]) -> DataFrame:
    """external_id of the rows of ``section`` that were rejected because their ``field`` exists already.

    They did not succeed, and the validation errors of ``field`` hold all of ``words``, in any case.
    """
    said = F.lower(F.array_join(F.coalesce(F.col("validationErrors")[field], F.array().cast("array<string>")), " "))
    rows = _result_rows(results, json, section).where(~F.coalesce("success", F.lit(False)) & F.col("external_id").isNotNull())
    for word in words:
        rows = rows.where(said.contains(word))
    return rows.select("external_id")


def section_errors(stats: DataFrame, section: str = "section", errors: str = "errors") -> DataFrame:
    """One row: the sections with errors as text, and their number."""
    bad = stats.where(F.col(errors) > 0)
    return bad.agg(F.array_join(F.sort_array(F.collect_list(section)), ",").alias("failing"), F.count(F.lit(1)).alias("n_failing"))


def result_errors(results: DataFrame, json: str) -> DataFrame:
    """section and errors of result documents: their statistics, and ``errors`` for those that name none."""
    parsed = F.from_json(json, "stats map<string,struct<ok:string,error:string>>, errors array<string>")
    stats = results.select(F.explode(parsed["stats"]).alias("section", "s")).select("section", F.coalesce(F.col("s.error").try_cast("long"), F.lit(0)).alias("errors"))
    listed = results.select(F.lit("errors").alias("section"), F.coalesce(F.size(parsed["errors"]), F.lit(0)).cast("long").alias("errors"))
    return stats.unionByName(listed).groupBy("section").agg(F.sum("errors").alias("errors"))


def raise_on_errors(stats: DataFrame, section: str = "section", errors: str = "errors") -> None:
    """Stop a run whose import had errors; its cursor then stays where it was."""
    found = section_errors(stats, section, errors).first()
    if found["n_failing"]:
        raise RuntimeError(f"import errors in: {found['failing']}")


def read_catalogs(spark: SparkSession, folder: str, sections: tuple[str, ...]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The catalogs of ``sections`` from <folder>/<section>.json, bare or under ``lookups``; and what failed.

    A section that cannot be read is reported; that none can is an error.
    """
    from pyspark.errors import PySparkException

    found: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    row = "array<struct<id:string,name:string,codename:string,codigo:string,description:string>>"
    for section in sections:
        try:
            raw = spark.read.text(f"{folder}/{section}.json", wholetext=True)
            both = F.from_json("value", f"`{section}` {row}, lookups struct<`{section}`:{row}>")
            rows = F.coalesce(both[section], both["lookups"][section])
            table = raw.select(F.posexplode(rows).alias("ordinal", "r")).select("ordinal", "r.*")
            table.limit(1).count()
            found[section] = table
        except PySparkException as error:
            failed[section] = str(error).split("\n")[0]
    if sections and not found:
        raise RuntimeError(f"no catalog could be read: {failed}")
    return found, failed

"""Sharding by a two-pass external shuffle, with DataFrame functions only.

Pass one scatters records uniformly into buckets of a stated size by a seeded hash; pass two shuffles each bucket
(``F.shuffle`` is a seeded Fisher-Yates shuffle) and lays the buckets end to end. Position p of N rows goes to shard
floor(p * n / N), so that counts differ by one at most and a bucket is written to one or two neighbouring shards
without a further exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tributary.llm.blocks import salted

BUCKET, BASE, RECORD, AT, SHARD = "_bucket", "_base", "_record", "_at", "_shard"


def record_bytes(text: F.Column | str) -> F.Column:
    """UTF-8 bytes of the text (null: none) plus 8 for the id."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8).cast("long")


def shuffle_into_shards(
    docs: DataFrame, n_shards: int, *, seed: int = 17, bucket_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``shard`` (int, 0 to n_shards - 1) and ``slot`` (long, gapless from 0 in its shard).

    Law ``rows``: shard counts are at most one apart. The same rows, seed and bucket size give the same buckets;
    rows are ordered by their columns before a bucket is shuffled, so fetch order does not matter.
    Null texts count 8 bytes; rows are scattered by id and text together, so that rows with a null or repeated id are
    spread by their texts, and rows that repeat both beyond a bucket's size by a number of their own. Repeated rows are kept, each with a slot of its own; rows that are equal in all columns are
    interchangeable. A very long text makes a bucket of its own size, which a task must hold. An empty table gives no
    rows. Columns already named ``shard`` or ``slot`` are replaced; others, whatever their names, stay as they are.
    Columns must be of types that can be ordered (no maps). Two windows run over one row for each bucket (input bytes /
    ``bucket_bytes``) in one task.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    docs = docs.drop("shard", "slot")
    names = [id_col, text_col, *(c for c in docs.columns if c not in (id_col, text_col))]
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    total, rows = docs.agg(F.sum(record_bytes(text)), F.count(F.lit(1))).first()
    buckets = max(1, math.ceil((total or 0) / bucket_bytes))
    records = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias(RECORD))
    records = records.select(F.col(RECORD)[id_col].alias("doc_id"), F.col(RECORD)[text_col].alias("text"), RECORD)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text", "_salt"), F.lit(buckets).cast("long")).alias(BUCKET)
    scattered = salted(records, bucket_bytes).select(bucket, RECORD)

    # As many counts as buckets: input bytes / bucket_bytes rows of two numbers.
    counts = scattered.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col(BUCKET).alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(BASE))

    gathered = scattered.groupBy(BUCKET).agg(F.sort_array(F.collect_list(RECORD)).alias("_records"))
    placed = gathered.join(bases, F.col(BUCKET) == F.col("_of")).sortWithinPartitions(BUCKET)
    position = F.col(BASE) + F.col(AT)
    shard = F.expr(f"(({BASE} + {AT}) * {n_shards}L) div {max(rows, 1)}L")
    start = F.expr(f"({SHARD} * {rows}L + {n_shards - 1}L) div {n_shards}L")  # first position p with floor(p * n / N) = shard
    return (
        placed.select(BASE, F.posexplode(F.shuffle("_records", seed)).alias(AT, RECORD))
        .select(RECORD, shard.cast("int").alias(SHARD), position.alias(AT))
        .select(*(F.col(RECORD)[c].alias(c) for c in docs.columns), F.col(SHARD).alias("shard"), (F.col(AT) - start).cast("long").alias("slot"))
    )


def write_shards(sharded: DataFrame, path: str) -> DataFrame:
    """Write one folder of Parquet files per shard, and read them back."""
    sharded.write.partitionBy("shard").parquet(path)
    kept = T.StructType([*(f for f in sharded.schema if f.name != "shard"), T.StructField("shard", T.IntegerType())])
    return sharded.sparkSession.read.schema(kept).parquet(path)


def shard_digest(shards: DataFrame) -> DataFrame:
    return shards.select(
        "doc_id",
        record_bytes("text").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

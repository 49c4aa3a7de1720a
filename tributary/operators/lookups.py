"""Resolving keys and texts against link states and catalogs, in bulk joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.exprs import clean, digits_key, expense_ref, normalize_text, split_list

def resolve(df: DataFrame, links: DataFrame, keys: dict[str, str], target: str, as_name: str) -> DataFrame:
    """``df`` with ``as_name``: ``target`` of the link whose columns (values of ``keys``) equal ``df``'s (its keys)."""
    own = links.select(*(F.col(v).alias(f"_link_{v}") for v in keys.values()), F.col(target).alias(as_name))
    on = [F.col(k) == F.col(f"_link_{v}") for k, v in keys.items()]
    return df.join(own, on, "left").drop(*(f"_link_{v}" for v in keys.values()))


def text_index(catalog: DataFrame, column: str, ident: str = "id", ordinal: str = "ordinal") -> DataFrame:
    """key and id of a catalog by the normalised text of ``column``; of equal texts the last row counts."""
    key = normalize_text(column)
    rows = catalog.where(F.col(ident).try_cast("int").isNotNull() & (F.coalesce(key, F.lit("")) != ""))
    return rows.groupBy(key.alias("_key")).agg(F.max_by(F.col(ident).cast("int"), ordinal).alias("_id"))


def resolve_text(df: DataFrame, attempts: list[tuple[Column, DataFrame]], as_name: str, default: int | None = None) -> DataFrame:
    """``df`` with ``as_name``: the id of the first of ``attempts`` (text, index as by text_index) that has one, else ``default``."""
    found = []
    for n, (text, index) in enumerate(attempts):
        key, ident = f"_key{n}", f"_id{n}"
        df = df.withColumn(f"_text{n}", normalize_text(text))
        df = df.join(index.select(F.col("_key").alias(key), F.col("_id").alias(ident)), F.col(f"_text{n}") == F.col(key), "left").drop(key, f"_text{n}")
        found.append(F.col(ident))
    rest = [] if default is None else [F.lit(default)]
    return df.withColumn(as_name, F.coalesce(*found, *rest)).drop(*(f"_id{n}" for n in range(len(attempts))))


def described_codes(catalog: DataFrame, prefix: str, ident: str = "id", ordinal: str = "ordinal") -> DataFrame:
    """code and id of the rows whose description is ``prefix`` and a code; the last row of a code counts."""
    text = clean("description")
    code = clean(F.when(text.startswith(prefix), F.substr(text, F.lit(len(prefix) + 1))))
    rows = catalog.where(code.isNotNull() & F.col(ident).isNotNull())
    return rows.groupBy(code.alias("code")).agg(F.max_by(ident, ordinal).alias(ident))


def match_by_digits(left: DataFrame, left_key: str, right: DataFrame, right_key: str, ident: str, as_name: str, length: int = 11) -> DataFrame:
    """``left`` with ``as_name``: the smallest ``ident`` of ``right`` with the same identifying digits."""
    index = right.withColumn("_digits", digits_key(right_key, length)).where("_digits IS NOT NULL").groupBy("_digits").agg(F.min(ident).alias(as_name))
    return left.withColumn("_own", digits_key(left_key, length)).join(index, F.col("_own") == F.col("_digits"), "left").drop("_own", "_digits")


def sent_refs(links: DataFrame, ident: str, refs: str) -> DataFrame:
    """The distinct references of links that have a target id."""
    return links.where(F.col(ident).isNotNull() & (F.col(ident) != "")).select(F.explode(split_list(refs)).alias("ref")).distinct()


def with_sent_refs(df: DataFrame, ref: Column, links: DataFrame, ident: str, refs: str) -> DataFrame:
    """Rows whose reference a sent link has."""
    return df.withColumn("_ref", ref).join(sent_refs(links, ident, refs).withColumnRenamed("ref", "_ref"), "_ref", "left_semi").drop("_ref")


def unmatched(df: DataFrame, key: str, master: DataFrame, master_key: str) -> DataFrame:
    """Keys of ``df`` that ``master`` lacks, with their number of rows; null keys are not references."""
    known = master.select(F.col(master_key).alias(key))
    return df.where(F.col(key).isNotNull()).join(known, key, "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def expense_keys(year: Column | str, delegation: Column | str, number: Column | str) -> Column:
    """The two texts that name an expense: its reference, and its key columns as JSON in the order of their names."""
    columns = {"deleg_solic": delegation, "ejercicio": year, "nro_solic": number}
    parts = F.struct(*((F.col(c) if isinstance(c, str) else c).try_cast("long").alias(k) for k, c in columns.items()))
    ref = expense_ref(parts["ejercicio"], parts["deleg_solic"], parts["nro_solic"])
    return F.when(ref.isNotNull(), F.array(ref, F.to_json(parts))).otherwise(F.array().cast("array<string>"))

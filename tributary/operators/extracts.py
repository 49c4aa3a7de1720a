"""Joins of the purchasing chain: request, expense, order, payment, withholding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.exprs import expense_ref, money

ORDER = ["EJERCICIO", "UNI_COMPRA", "NRO_OC"]
EXPENSE = ["EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC"]
REQUEST = ["EJERCICIO", "NUM_PED"]
PAYMENT = ["EJERCICIO", "NRO_OP"]

#: Columns of an order's header, and their names beside its lines.
HEADER = {"FECH_OC": "OC_FECH_OC", "OBSERVACIONES": "OC_OBSERVACIONES", "ESTADO_OC": "OC_ESTADO_OC", "FECH_CONFIRM": "OC_FECH_CONFIRM", "IMPORTE_TOT": "OC_IMPORTE_TOT"}


def touched(df: DataFrame, changed: DataFrame, on: dict[str, str], year: str = "EJERCICIO") -> DataFrame:
    """The rows of ``df`` that ``changed`` refers to: columns of ``df`` (keys of ``on``) equal those of ``changed`` (values).

    Give it to a join or an aggregation instead of ``df``, so that a few changed rows do not take the whole table. The
    years of ``changed``, from the first to the last, are a filter that the scan of ``df`` gets; its keys are a semi join.
    That filter also lets Spark put a Bloom filter of the keys on a large scan (``spark.sql.optimizer.runtime.bloomFilter``).
    """
    keys = changed.select(*(F.col(own).alias(other) for other, own in on.items())).dropna()
    first, last = keys.agg(F.min(year), F.max(year)).first()
    if first is None:
        return df.where(F.lit(False))
    in_years = (F.col(year) >= first) & (F.col(year) <= last)
    return df.where(in_years).join(keys.where(in_years).distinct(), list(on), "left_semi")


def order_header(orders: DataFrame) -> DataFrame:
    own = [c for c in ("proveedor_id",) if c in orders.columns]
    return orders.select(*ORDER, "COD_PROV", *own, *(F.col(k).alias(v) for k, v in HEADER.items()))


def with_header(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return order_header(orders).join(lines, ORDER)


def with_unit(lines: DataFrame, expenses: DataFrame) -> DataFrame:
    return lines.join(expenses.select(*EXPENSE, F.col("JURISDICCION").alias("SG_JURISDICCION")), EXPENSE, "left")


def order_extract(orders: DataFrame, lines: DataFrame, expenses: DataFrame) -> DataFrame:
    """Order lines with their header, which must exist, and the unit of their expense. Filter ``orders`` by the cursor.

    Headers come last: lines are exchanged without them, and lie by their orders afterwards, as documents need them.
    """
    return with_header(orders, with_unit(lines, expenses))


def order_line_extract(lines: DataFrame, orders: DataFrame, expenses: DataFrame) -> DataFrame:
    """Order lines, with or without a header."""
    return with_unit(lines.join(order_header(orders), ORDER, "left"), expenses)


def request_line_extract(lines: DataFrame, requests: DataFrame) -> DataFrame:
    header = requests.select(*REQUEST, *(F.col(c).alias(f"PED_{c}") for c in ("FECH_EMI", "OBSERVACIONES", "CODIGO_DEP", "COSTO_TOT")))
    return lines.join(header, REQUEST, "left")


def expense_extract(expenses: DataFrame, lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Expenses with the smallest supplier of the orders that their lines are on."""
    suppliers = lines.select(*ORDER, "DELEG_SOLIC", "NRO_SOLIC").join(orders.select(*ORDER, "COD_PROV"), ORDER)
    least = suppliers.groupBy(*EXPENSE).agg(F.min("COD_PROV").alias("OC_COD_PROV"))
    return expenses.join(least, EXPENSE, "left")


def trace_view(lines: DataFrame, expenses: DataFrame, orders: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Distinct chains of expense, order and, where known, request."""
    sg = expenses.select(*EXPENSE, *(["NRO_PED"] if "NRO_PED" in expenses.columns else []), F.col("JURISDICCION").alias("_unit"))
    joined = lines.select(*ORDER, "DELEG_SOLIC", "NRO_SOLIC").join(sg, EXPENSE).join(orders.select(*ORDER, "COD_PROV", "FECH_OC"), ORDER)
    number, unit = F.lit(None).cast("int"), F.col("_unit")
    if requests is not None and "NRO_PED" in sg.columns:
        known = requests.select("EJERCICIO", F.col("NUM_PED").alias("NRO_PED"), F.col("JURISDICCION").alias("_request_unit"))
        joined = joined.join(known, ["EJERCICIO", "NRO_PED"], "left")
        number, unit = F.col("NRO_PED"), F.col("_request_unit")
    return joined.select(
        F.col("EJERCICIO").alias("SG_EJERCICIO"),
        F.col("NRO_SOLIC").alias("SG_NRO"),
        F.col("DELEG_SOLIC").alias("SG_DELEG"),
        F.col("EJERCICIO").alias("OC_EJERCICIO"),
        F.col("UNI_COMPRA").alias("OC_UNI_COMPRA"),
        F.col("NRO_OC").alias("OC_NRO_OC"),
        F.col("COD_PROV").alias("OC_COD_PROV"),
        number.alias("PE_NRO"),
        unit.alias("PE_JURISDICCION"),
        F.col("FECH_OC").alias("FECH_HOJA"),
    ).dropDuplicates()


def payment_refs(payments: DataFrame, expenses: DataFrame, trace: DataFrame | None = None) -> DataFrame:
    """PAYMENT and refs: the sorted distinct expenses of each payment's own year, by number (any delegation) or trace."""
    keyed = payments.select(*PAYMENT, "NRO_CANCE").where(F.col("NRO_CANCE").isNotNull())
    direct = expenses.select("EJERCICIO", F.col("NRO_SOLIC").alias("NRO_CANCE"), expense_ref(*EXPENSE).alias("ref"))
    if trace is not None:
        traced = trace.select(F.col("SG_EJERCICIO").alias("EJERCICIO"), F.col("SG_NRO").alias("NRO_CANCE"), expense_ref("SG_EJERCICIO", "SG_DELEG", "SG_NRO").alias("ref"))
        direct = direct.unionByName(traced)
    return keyed.join(direct.distinct(), ["EJERCICIO", "NRO_CANCE"]).groupBy(*PAYMENT).agg(F.array_sort(F.collect_set("ref")).alias("refs"))


def fallback_refs(payments: DataFrame, order_refs: DataFrame) -> DataFrame:
    """PAYMENT and refs by the order that a payment settles: ``order_refs`` has EJERCICIO, NRO_OC and refs (an array)."""
    year = F.coalesce("RECO_DEU_COMPRA_EJER", "EJERCICIO")
    keyed = payments.where(F.col("RECO_DEU_COMPRA").isNotNull()).select(*PAYMENT, year.alias("_year"), F.col("RECO_DEU_COMPRA").alias("_oc"))
    known = order_refs.select(F.col("EJERCICIO").alias("_year"), F.col("NRO_OC").alias("_oc"), F.explode("refs").alias("ref"))
    return keyed.join(known, ["_year", "_oc"]).groupBy(*PAYMENT).agg(F.array_sort(F.collect_set("ref")).alias("refs"))


def payment_extract(payments: DataFrame, refs: DataFrame, withholdings: DataFrame | None = None, codes: DataFrame | None = None) -> DataFrame:
    """One row per payment with its expense refs and withholdings, each gathered before it is joined.

    ``withholdings`` has EJERCICIO, NRO_CANCE, COD_RET and IMPORTE; ``codes`` CODIGO, DESCRIPCION and perhaps EJERCICIO.
    """
    out = payments.join(refs, PAYMENT, "left")
    if withholdings is None:
        return out.withColumn("retenciones", F.array().cast("array<struct<COD_RET:string,IMPORTE:decimal(15,2),DESCRIPCION:string>>"))
    named = withholdings.select("EJERCICIO", "NRO_CANCE", F.col("COD_RET"), money("IMPORTE").alias("IMPORTE"))
    if codes is not None:
        on = ["EJERCICIO", "COD_RET"] if "EJERCICIO" in codes.columns else ["COD_RET"]
        named = named.join(codes.withColumnRenamed("CODIGO", "COD_RET").select(*on, "DESCRIPCION"), on, "left")
    else:
        named = named.withColumn("DESCRIPCION", F.lit(None).cast("string"))
    row = F.struct(F.col("COD_RET").cast("string").alias("COD_RET"), "IMPORTE", "DESCRIPCION")
    gathered = named.groupBy("EJERCICIO", "NRO_CANCE").agg(F.sort_array(F.collect_list(row)).alias("retenciones"))
    return out.join(gathered, ["EJERCICIO", "NRO_CANCE"], "left")

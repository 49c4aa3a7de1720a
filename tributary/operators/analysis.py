"""Questions to the purchasing chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.extracts import EXPENSE, ORDER


def orders_with_lines(orders: DataFrame, lines: DataFrame, suppliers: DataFrame) -> DataFrame:
    named = orders.join(suppliers.select("COD_PROV", "RAZON_SOCIAL"), "COD_PROV")
    return named.select(*ORDER, "COD_PROV", "RAZON_SOCIAL", "FECH_OC").join(lines, ORDER)


def requests_with_lines(requests: DataFrame, lines: DataFrame) -> DataFrame:
    return requests.join(lines, ["EJERCICIO", "NUM_PED"])


def full_chain(orders: DataFrame, lines: DataFrame, expenses: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders, their lines' expenses, and the payments that settle the order."""
    bridge = orders.select(*ORDER, "COD_PROV", "ESTADO_OC").join(lines.select(*ORDER, "DELEG_SOLIC", "NRO_SOLIC").distinct(), ORDER)
    chain = bridge.join(expenses.select(*EXPENSE, F.col("IMPORTE_TOT").alias("SG_IMPORTE")), EXPENSE)
    year = F.coalesce("RECO_DEU_COMPRA_EJER", "EJERCICIO")
    paid = payments.select(year.alias("EJERCICIO"), F.col("RECO_DEU_COMPRA").alias("NRO_OC"), "NRO_OP", F.col("IMPORTE_TOTAL").alias("OP_IMPORTE"), "ESTADO_OP")
    return chain.join(paid, ["EJERCICIO", "NRO_OC"], "left")


def payments_by_supplier(payments: DataFrame) -> DataFrame:
    """Number and total of payments by supplier and status, the largest totals first."""
    totals = payments.groupBy("COD_PROV", "ESTADO_OP").agg(F.count(F.lit(1)).alias("n_payments"), F.sum("IMPORTE_TOTAL").alias("total"))
    return totals.orderBy(F.desc("total"), "COD_PROV", "ESTADO_OP")


def line_supplier_mismatches(orders: DataFrame, lines: DataFrame, line_supplier: str) -> DataFrame:
    joined = lines.join(orders.select(*ORDER, F.col("COD_PROV").alias("OC_COD_PROV")), ORDER)
    return joined.where(F.col(line_supplier) != F.col("OC_COD_PROV"))


def payment_supplier_mismatches(orders: DataFrame, payments: DataFrame) -> DataFrame:
    own = orders.select(F.col("EJERCICIO").alias("RECO_DEU_COMPRA_EJER"), F.col("NRO_OC").alias("RECO_DEU_COMPRA"), F.col("COD_PROV").alias("OC_COD_PROV"))
    return payments.join(own, ["RECO_DEU_COMPRA_EJER", "RECO_DEU_COMPRA"]).where(F.col("COD_PROV") != F.col("OC_COD_PROV"))


def settled_payments(payments: DataFrame, suppliers: DataFrame, units: DataFrame) -> DataFrame:
    paid = payments.where(F.col("ESTADO_OP") == "C")
    named = paid.join(suppliers.select("COD_PROV", "RAZON_SOCIAL"), "COD_PROV")
    return named.join(units.select("JURISDICCION", "DENOMINACION"), "JURISDICCION")


def withholdings_of_payments(payments: DataFrame, withholdings: DataFrame, codes: DataFrame) -> DataFrame:
    own = payments.select("NRO_OP", "NRO_CANCE").join(withholdings.select("NRO_CANCE", "COD_RET", "IMPORTE"), "NRO_CANCE")
    return own.join(codes.select(F.col("CODIGO").alias("COD_RET"), "DESCRIPCION"), "COD_RET")

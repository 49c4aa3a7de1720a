"""Joins, aggregates, set operations and analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import exprs as E
from tributary.operators import analysis, extracts, lookups, rows
from tributary.plans.bindings import role, roles, with_roles
from tributary.plans.registry import demo, table

HEADER = "COD_PROV, OC_ESTADO_OC, SG_JURISDICCION"
ON_OC = "USING (EJERCICIO, UNI_COMPRA, NRO_OC)"
ON_SG = "USING (EJERCICIO, DELEG_SOLIC, NRO_SOLIC)"
SG_REF = "concat('SG-', EJERCICIO, '-', DELEG_SOLIC, '-', NRO_SOLIC)"
EXTRACT = ["EJERCICIO", "UNI_COMPRA", "NRO_OC", "ITEM_OC", "NRO_SOLIC", "COD_PROV", "OC_ESTADO_OC", "SG_JURISDICCION", "IMP_UNITARIO"]
EXTRACT_SQL = """SELECT EJERCICIO, UNI_COMPRA, NRO_OC, ITEM_OC, NRO_SOLIC, COD_PROV, ESTADO_OC AS OC_ESTADO_OC, sg.JURISDICCION AS SG_JURISDICCION,
    CAST(IMP_UNITARIO AS DOUBLE) AS IMP_UNITARIO"""


def _known(spark, sf_dir):
    """Orders of the suppliers that the master has."""
    oc, master = roles(spark, sf_dir, "oc master")
    return oc.join(master.select("COD_PROV"), "COD_PROV", "left_semi")


KNOWN = "known AS (SELECT * FROM oc WHERE COD_PROV IN (SELECT COD_PROV FROM master))"


@demo(with_roles("oc master items sg", f", {KNOWN} {EXTRACT_SQL} FROM known JOIN items {ON_OC} LEFT JOIN sg {ON_SG}"))
def po_extract(spark, sf_dir):
    items, sg = roles(spark, sf_dir, "items sg")
    return extracts.order_extract(_known(spark, sf_dir), items, sg).select(EXTRACT)


@demo(with_roles("oc master items sg", f", {KNOWN} {EXTRACT_SQL} FROM items LEFT JOIN known {ON_OC} LEFT JOIN sg {ON_SG}"))
def po_items_extract(spark, sf_dir):
    items, sg = roles(spark, sf_dir, "items sg")
    return extracts.order_line_extract(items, _known(spark, sf_dir), sg).select(EXTRACT)


@demo(with_roles("ped_items ped", "SELECT EJERCICIO, NUM_PED, ORDEN, DESCRIP_BIE, FECH_EMI AS PED_FECH_EMI, CODIGO_DEP AS PED_CODIGO_DEP FROM ped_items LEFT JOIN (SELECT * FROM ped WHERE NUM_PED % 3 <> 0) USING (EJERCICIO, NUM_PED)"))
def request_items_extract(spark, sf_dir):
    lines, ped = roles(spark, sf_dir, "ped_items ped")
    return extracts.request_line_extract(lines, ped.where("NUM_PED % 3 <> 0")).select("EJERCICIO", "NUM_PED", "ORDEN", "DESCRIP_BIE", "PED_FECH_EMI", "PED_CODIGO_DEP")


@demo(
    with_roles(
        "sg items oc",
        f""", m AS (SELECT EJERCICIO, DELEG_SOLIC, NRO_SOLIC, min(COD_PROV) AS OC_COD_PROV FROM items JOIN oc {ON_OC} GROUP BY 1, 2, 3)
        SELECT NRO_SOLIC, CAST(IMPORTE_TOT AS DOUBLE) AS IMPORTE_TOT, OC_COD_PROV FROM sg LEFT JOIN m {ON_SG}""",
    )
)
def expense_with_min_supplier(spark, sf_dir):
    sg, items, oc = roles(spark, sf_dir, "sg items oc")
    return extracts.expense_extract(sg, items, oc).select("NRO_SOLIC", "IMPORTE_TOT", "OC_COD_PROV")


def _payment_refs(spark, sf_dir):
    """Refs by number alone: the payments' year is none of the orders' years."""
    op, sg = roles(spark, sf_dir, "op sg")
    same_year = sg.withColumn("_ref_year", F.col("EJERCICIO")).withColumn("EJERCICIO", F.lit(2024))
    return op, extracts.payment_refs(op, same_year)


@demo(
    with_roles(
        "op sg ret ded",
        """, r AS (SELECT NRO_CANCE, count(*) AS n_ret, CAST(sum(IMPORTE) AS DOUBLE) AS ret_total, count(DESCRIPCION) AS n_named FROM ret LEFT JOIN ded ON COD_RET = CODIGO GROUP BY NRO_CANCE),
        s AS (SELECT NRO_SOLIC, string_agg(concat('SG-2024-', DELEG_SOLIC, '-', NRO_SOLIC), ',' ORDER BY DELEG_SOLIC) AS refs FROM sg GROUP BY NRO_SOLIC)
        SELECT NRO_OP, coalesce(refs, '') AS refs, coalesce(n_ret, 0) AS n_ret, ret_total, coalesce(n_named, 0) AS n_named
        FROM op LEFT JOIN s ON NRO_SOLIC = op.NRO_CANCE LEFT JOIN r ON r.NRO_CANCE = op.NRO_CANCE""",
    )
)
def payment_extract(spark, sf_dir):
    op, refs = _payment_refs(spark, sf_dir)
    ret, ded = roles(spark, sf_dir, "ret ded")
    found = extracts.payment_extract(op, refs, ret.withColumn("EJERCICIO", F.lit(2024)), ded)
    named = F.size(F.filter("retenciones", lambda x: x["DESCRIPCION"].isNotNull()))
    total = F.when(F.col("retenciones").isNotNull(), F.aggregate("retenciones", F.lit(0).cast("decimal(25,2)"), lambda a, x: (a + x["IMPORTE"]).cast("decimal(25,2)")))
    return found.select(
        "NRO_OP",
        F.coalesce(F.array_join("refs", ","), F.lit("")).alias("refs"),
        F.coalesce(F.size("retenciones"), F.lit(0)).cast("long").alias("n_ret"),
        total.alias("ret_total"),
        F.coalesce(named, F.lit(0)).cast("long").alias("n_named"),
    )


TRACE = f"""SELECT DISTINCT EJERCICIO AS SG_EJERCICIO, NRO_SOLIC AS SG_NRO, DELEG_SOLIC AS SG_DELEG, NRO_OC AS OC_NRO_OC, COD_PROV AS OC_COD_PROV, JURISDICCION AS PE_JURISDICCION
    FROM items JOIN sg {ON_SG} JOIN oc {ON_OC}"""
TRACE_COLUMNS = ["SG_EJERCICIO", "SG_NRO", "SG_DELEG", "OC_NRO_OC", "OC_COD_PROV", "PE_JURISDICCION"]


@demo(with_roles("items sg oc", TRACE))
def trace_view(spark, sf_dir):
    return extracts.trace_view(*roles(spark, sf_dir, "items sg oc")).select(TRACE_COLUMNS)


@demo(with_roles("items sg oc prov", f", t AS ({TRACE}) SELECT t.*, RAZON_SOCIAL FROM t JOIN prov ON COD_PROV = OC_COD_PROV WHERE OC_NRO_OC < 200"))
def trace_one(spark, sf_dir):
    items, sg, oc, prov = roles(spark, sf_dir, "items sg oc prov")
    trace = extracts.trace_view(items, sg, oc).where("OC_NRO_OC < 200").select(TRACE_COLUMNS)
    return trace.join(prov.select(F.col("COD_PROV").alias("OC_COD_PROV"), "RAZON_SOCIAL"), "OC_COD_PROV")


@demo(with_roles("oc prov_link", "SELECT NRO_OC, COD_PROV, remote_id AS proveedor_id FROM oc LEFT JOIN prov_link USING (COD_PROV)"))
def resolve_target_id(spark, sf_dir):
    oc, links = roles(spark, sf_dir, "oc prov_link")
    return lookups.resolve(oc, links, {"COD_PROV": "COD_PROV"}, "remote_id", "proveedor_id").select("NRO_OC", "COD_PROV", "proveedor_id")


BRANDS = "brands AS (SELECT p_brand AS name, max(p_partkey) AS id FROM part WHERE p_partkey % 3 = 0 AND p_size < 10 GROUP BY p_brand)"
TYPES = "types AS (SELECT p_type AS name, max(p_partkey) AS id FROM part WHERE p_partkey % 2 = 0 AND p_size < 3 GROUP BY p_type)"


def _catalog(spark, sf_dir, column, condition):
    part = table(spark, sf_dir, "part").where(condition)
    return lookups.text_index(part.select(F.col(column).alias("name"), F.col("p_partkey").alias("id"), F.col("p_partkey").alias("ordinal")), "name")


@demo(f"WITH {BRANDS}, {TYPES} SELECT p_partkey, CAST(coalesce(b.id, t.id, -1) AS INT) AS found FROM part LEFT JOIN brands b ON b.name = p_brand LEFT JOIN types t ON t.name = p_type")
def lookup_fallback_chain(spark, sf_dir):
    attempts = [(F.col("p_brand"), _catalog(spark, sf_dir, "p_brand", "p_partkey % 3 = 0 AND p_size < 10")), (F.col("p_type"), _catalog(spark, sf_dir, "p_type", "p_partkey % 2 = 0 AND p_size < 3"))]
    return lookups.resolve_text(table(spark, sf_dir, "part"), attempts, "found", default=-1).select("p_partkey", "found")


@demo(f"WITH {TYPES} SELECT p_partkey, CAST(coalesce(t.id, 1) AS INT) AS tipo_factura_id FROM part LEFT JOIN types t ON t.name = p_type")
def lookup_with_default(spark, sf_dir):
    attempts = [(F.col("p_type"), _catalog(spark, sf_dir, "p_type", "p_partkey % 2 = 0 AND p_size < 3"))]
    return lookups.resolve_text(table(spark, sf_dir, "part"), attempts, "tipo_factura_id", default=1).select("p_partkey", "tipo_factura_id")


@demo(with_roles("sg", "SELECT NRO_SOLIC, CASE WHEN n_nationkey IS NULL THEN NULL ELSE CAST(100 + n_nationkey AS INT) END AS centro_costo_id FROM sg LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 4 <> 0) ON CAST(n_nationkey AS VARCHAR) = JURISDICCION"))
def lookup_parsed_description(spark, sf_dir):
    described = F.when(F.col("n_nationkey") % 4 != 0, F.concat(F.lit("Unit "), F.col("n_nationkey"))).otherwise("none")
    catalog = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 100).cast("int").alias("id"), described.alias("description"), F.col("n_nationkey").alias("ordinal"))
    codes = lookups.described_codes(catalog, "Unit ")
    return lookups.resolve(role(spark, sf_dir, "sg"), codes, {"JURISDICCION": "code"}, "id", "centro_costo_id").select("NRO_SOLIC", "centro_costo_id")


def _sent(spark, sf_dir):
    """Sent orders with their expense refs as text."""
    oc, items = roles(spark, sf_dir, "oc items")
    sent = oc.where("ESTADO_OC = 'R' AND NRO_OC % 2 = 0").select(*extracts.ORDER)
    refs = items.join(sent, extracts.ORDER, "left_semi").withColumn("ref", E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC"))
    return refs.groupBy(*extracts.ORDER).agg(F.array_join(F.array_sort(F.collect_set("ref")), ",").alias("gasto_refs")).withColumn("remote_id", F.col("NRO_OC").cast("string"))


SENT_REFS = f"SELECT DISTINCT {SG_REF} AS ref FROM items JOIN oc {ON_OC} WHERE ESTADO_OC = 'R' AND NRO_OC % 2 = 0"


@demo(with_roles("sg items oc", f"SELECT NRO_SOLIC FROM sg WHERE {SG_REF} IN ({SENT_REFS})"))
def expenses_of_sent_orders(spark, sf_dir):
    ref = E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC")
    return lookups.with_sent_refs(role(spark, sf_dir, "sg"), ref, _sent(spark, sf_dir), "remote_id", "gasto_refs").select("NRO_SOLIC")


@demo(with_roles("items oc", SENT_REFS))
def explode_refs(spark, sf_dir):
    return lookups.sent_refs(_sent(spark, sf_dir), "remote_id", "gasto_refs")


@demo(with_roles("items oc sg", f"{SENT_REFS} UNION SELECT {SG_REF} FROM sg WHERE ESTADO_SOLIC = 'A'"))
def union_distinct_refs(spark, sf_dir):
    cancelled = role(spark, sf_dir, "sg").where("ESTADO_SOLIC = 'A'").select(E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC").alias("ref"))
    return lookups.sent_refs(_sent(spark, sf_dir), "remote_id", "gasto_refs").union(cancelled).distinct()


@demo(with_roles("oc master", "SELECT COD_PROV, count(*) AS n FROM oc WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.COD_PROV = oc.COD_PROV) GROUP BY COD_PROV"))
def orphan_suppliers_po(spark, sf_dir):
    oc, master = roles(spark, sf_dir, "oc master")
    return lookups.unmatched(oc, "COD_PROV", master, "COD_PROV")


@demo(with_roles("op master", "SELECT COD_PROV, count(*) AS n FROM op WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.COD_PROV = op.COD_PROV) GROUP BY COD_PROV"))
def orphan_suppliers_pay(spark, sf_dir):
    op, master = roles(spark, sf_dir, "op master")
    return lookups.unmatched(op, "COD_PROV", master, "COD_PROV")


@demo(with_roles("oc items", f"SELECT NRO_OC, ITEM_OC, LINE_PROV, COD_PROV AS OC_COD_PROV FROM items JOIN oc {ON_OC} WHERE LINE_PROV <> COD_PROV"))
def supplier_mismatch_items(spark, sf_dir):
    oc, items = roles(spark, sf_dir, "oc items")
    return analysis.line_supplier_mismatches(oc, items, "LINE_PROV").select("NRO_OC", "ITEM_OC", "LINE_PROV", "OC_COD_PROV")


@demo(with_roles("oc op", "SELECT NRO_OP, op.COD_PROV, oc.COD_PROV AS OC_COD_PROV FROM op JOIN oc ON oc.EJERCICIO = RECO_DEU_COMPRA_EJER AND NRO_OC = RECO_DEU_COMPRA WHERE op.COD_PROV <> oc.COD_PROV"))
def supplier_mismatch_payment(spark, sf_dir):
    oc, op = roles(spark, sf_dir, "oc op")
    return analysis.payment_supplier_mismatches(oc, op).select("NRO_OP", "COD_PROV", "OC_COD_PROV")


def order_refs(spark, sf_dir):
    items = role(spark, sf_dir, "items").withColumn("ref", E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC"))
    return items.groupBy("EJERCICIO", "NRO_OC").agg(F.array_sort(F.collect_set("ref")).alias("refs"))


@demo(
    with_roles(
        "op items",
        f"""SELECT NRO_OP, string_agg(ref, ',' ORDER BY ref) AS refs FROM (SELECT DISTINCT NRO_OP, {SG_REF.replace("EJERCICIO", "items.EJERCICIO")} AS ref
        FROM op JOIN items ON items.EJERCICIO = RECO_DEU_COMPRA_EJER AND NRO_OC = RECO_DEU_COMPRA) GROUP BY NRO_OP""",
    )
)
def payment_fallback_refs(spark, sf_dir):
    return extracts.fallback_refs(role(spark, sf_dir, "op"), order_refs(spark, sf_dir)).select("NRO_OP", F.array_join("refs", ",").alias("refs"))


@demo(
    """WITH a AS (SELECT s_suppkey, regexp_replace(s_name, '[^0-9]', '', 'g') AS d FROM supplier), b AS (SELECT regexp_replace(c_name, '[^0-9]', '', 'g') AS d, min(c_custkey) AS c_custkey FROM customer GROUP BY 1)
    SELECT s_suppkey, c_custkey FROM a LEFT JOIN b ON a.d = b.d AND length(a.d) = 9"""
)
def match_by_normalized_key(spark, sf_dir):
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    return lookups.match_by_digits(supplier, "s_name", customer, "c_name", "c_custkey", "c_custkey", length=9).select("s_suppkey", "c_custkey")


@demo(
    with_roles(
        "oc items sg op",
        f"""SELECT NRO_OC, NRO_SOLIC, COD_PROV, CAST(SG_IMPORTE AS DOUBLE) AS SG_IMPORTE, NRO_OP, CAST(OP_IMPORTE AS DOUBLE) AS OP_IMPORTE FROM oc
        JOIN (SELECT DISTINCT EJERCICIO, UNI_COMPRA, NRO_OC, DELEG_SOLIC, NRO_SOLIC FROM items) {ON_OC}
        JOIN (SELECT EJERCICIO, DELEG_SOLIC, NRO_SOLIC, IMPORTE_TOT AS SG_IMPORTE FROM sg) {ON_SG}
        LEFT JOIN (SELECT RECO_DEU_COMPRA_EJER AS EJERCICIO, RECO_DEU_COMPRA AS NRO_OC, NRO_OP, IMPORTE_TOTAL AS OP_IMPORTE FROM op) USING (EJERCICIO, NRO_OC)""",
    )
)
def full_chain(spark, sf_dir):
    return analysis.full_chain(*roles(spark, sf_dir, "oc items sg op")).select("NRO_OC", "NRO_SOLIC", "COD_PROV", "SG_IMPORTE", "NRO_OP", "OP_IMPORTE")


@demo(with_roles("op", "SELECT COD_PROV, ESTADO_OP, count(*) AS n_payments, CAST(sum(IMPORTE_TOTAL) AS DOUBLE) AS total FROM op GROUP BY COD_PROV, ESTADO_OP"))
def payments_by_supplier_status(spark, sf_dir):
    return analysis.payments_by_supplier(role(spark, sf_dir, "op"))


@demo(with_roles("oc", "SELECT count(*) AS n FROM (SELECT DISTINCT EJERCICIO, UNI_COMPRA, NRO_OC FROM oc WHERE ESTADO_OC = 'R')"))
def distinct_active_orders(spark, sf_dir):
    return rows.distinct_keys(role(spark, sf_dir, "oc").where("ESTADO_OC = 'R'"), extracts.ORDER)


@demo(with_roles("items", f"SELECT NRO_OC, string_agg(ref, ',' ORDER BY item, ref) AS refs FROM (SELECT NRO_OC, {SG_REF} AS ref, min(ITEM_OC) AS item FROM items GROUP BY ALL) GROUP BY NRO_OC"))
def distinct_refs_per_po(spark, sf_dir):
    listed = rows.distinct_list(role(spark, sf_dir, "items"), ["NRO_OC"], E.expense_ref(*extracts.EXPENSE), ["ITEM_OC"], "refs")
    return listed.select("NRO_OC", F.array_join("refs", ",").alias("refs"))


@demo(with_roles("ret", "SELECT NRO_CANCE, COD_RET, ORDINAL, CAST(IMPORTE AS DOUBLE) AS IMPORTE FROM ret QUALIFY row_number() OVER (PARTITION BY NRO_CANCE, COD_RET ORDER BY FECHA DESC, ORDINAL DESC, IMPORTE DESC) = 1"))
def last_wins_per_code(spark, sf_dir):
    return rows.latest_per_key(role(spark, sf_dir, "ret"), ["NRO_CANCE", "COD_RET"], ["FECHA", "ORDINAL", "IMPORTE"]).drop("FECHA")


@demo(with_roles("op prov jur", "SELECT NRO_OP, FECH_OP, RAZON_SOCIAL, DENOMINACION FROM op JOIN prov USING (COD_PROV) JOIN jur USING (JURISDICCION) WHERE ESTADO_OP = 'C'"))
def settled_payments(spark, sf_dir):
    found = analysis.settled_payments(*roles(spark, sf_dir, "op prov jur"))
    return found.select("NRO_OP", "FECH_OP", "RAZON_SOCIAL", "DENOMINACION").orderBy(F.desc("FECH_OP"), "NRO_OP")


@demo(with_roles("op ret ded", "SELECT NRO_OP, COD_RET, DESCRIPCION, count(*) AS n, CAST(sum(IMPORTE) AS DOUBLE) AS total FROM op JOIN ret USING (NRO_CANCE) JOIN ded ON CODIGO = COD_RET GROUP BY ALL"))
def withholdings_of_payment(spark, sf_dir):
    held = analysis.withholdings_of_payments(*roles(spark, sf_dir, "op ret ded"))
    return held.groupBy("NRO_OP", "COD_RET", "DESCRIPCION").agg(F.count(F.lit(1)).alias("n"), F.sum("IMPORTE").alias("total"))


@demo(with_roles("ped ped_items", "SELECT NUM_PED, OBSERVACIONES, ORDEN, DESCRIP_BIE, CAST(COSTO_UNI AS DOUBLE) AS COSTO_UNI FROM ped JOIN ped_items USING (EJERCICIO, NUM_PED)"))
def request_with_items(spark, sf_dir):
    return analysis.requests_with_lines(*roles(spark, sf_dir, "ped ped_items")).select("NUM_PED", "OBSERVACIONES", "ORDEN", "DESCRIP_BIE", "COSTO_UNI")


@demo(with_roles("oc items prov", f"SELECT NRO_OC, RAZON_SOCIAL, ITEM_OC, DESCRIPCION, CAST(IMP_UNITARIO AS DOUBLE) AS IMP_UNITARIO FROM oc JOIN items {ON_OC} JOIN prov USING (COD_PROV)"))
def po_with_items_supplier(spark, sf_dir):
    return analysis.orders_with_lines(*roles(spark, sf_dir, "oc items prov")).select("NRO_OC", "RAZON_SOCIAL", "ITEM_OC", "DESCRIPCION", "IMP_UNITARIO")


@demo(with_roles("items sg", f"SELECT count(*) AS n_lines, count(JURISDICCION) AS n_with_unit FROM items LEFT JOIN sg {ON_SG}"))
def lines_with_unit(spark, sf_dir):
    items, sg = roles(spark, sf_dir, "items sg")
    return rows.filled(items.join(sg.select(*extracts.EXPENSE, "JURISDICCION"), extracts.EXPENSE, "left"), "JURISDICCION", "n_with_unit")


@demo(with_roles("items oc", f"SELECT NRO_OC, ITEM_OC, NRO_SOLIC FROM items WHERE NRO_OC IN (SELECT NRO_OC FROM oc WHERE coalesce(CASE WHEN NRO_OC % 4 = 0 THEN FECH_OC + INTERVAL 400 DAYS END, FECH_OC) > TIMESTAMP '2000-06-01 00:00:00')"))
def child_by_parent_cursor(spark, sf_dir):
    items, oc = roles(spark, sf_dir, "items oc")
    modified = F.when(F.col("NRO_OC") % 4 == 0, F.col("FECH_OC") + F.expr("INTERVAL 400 DAYS"))
    found = rows.changed_children(items, oc, extracts.ORDER, modified, F.col("FECH_OC"), F.lit("2000-06-01 00:00:00").cast("timestamp_ntz"))
    return found.select("NRO_OC", "ITEM_OC", "NRO_SOLIC")


@demo("SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def keys_removed_between_snapshots(spark, sf_dir):
    before = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rows.removed_keys(before, before.where("c_acctbal >= 0"), ["c_custkey"])


@demo(with_roles("sg sg_link", f", k AS (SELECT *, {SG_REF} AS own FROM sg), l AS (SELECT *, NRO_SOLIC % 2 = 0 AS structured FROM sg_link) SELECT k.NRO_SOLIC, remote_id FROM k LEFT JOIN l ON (structured AND l.NRO_SOLIC = k.NRO_SOLIC) OR (NOT structured AND l.ref = k.own)"))
def alias_key_lookup(spark, sf_dir):
    sg, links = roles(spark, sf_dir, "sg sg_link")
    keyed = sg.withColumn("own", E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC"))
    structured, legacy = links.where("NRO_SOLIC % 2 = 0"), links.where("NRO_SOLIC % 2 <> 0")
    found = lookups.resolve(keyed, structured, {"NRO_SOLIC": "NRO_SOLIC"}, "remote_id", "_structured")
    found = lookups.resolve(found, legacy, {"own": "ref"}, "remote_id", "_legacy")
    return found.select("NRO_SOLIC", F.coalesce("_structured", "_legacy").alias("remote_id"))


@demo("SELECT concat(p_brand, '::', p_type) AS item_key, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_partkey % 3 <> 0 GROUP BY 1 ORDER BY n DESC, item_key LIMIT 10")
def top_unresolved(spark, sf_dir):
    part = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey")
    keyed = lines.join(part, lines.l_partkey == part.p_partkey).select(F.concat("p_brand", F.lit("::"), "p_type").alias("item_key"))
    return rows.top_counts(keyed, "item_key", 10)

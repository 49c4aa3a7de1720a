"""Documents over the test tables, flattened."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import exprs as E
from tributary.operators import documents, extracts
from tributary.plans.bindings import role, roles, with_roles
from tributary.plans.registry import demo
from tributary.plans.relational import ON_OC, ON_SG, SG_REF, order_refs

FIRST_LINE = "row_number() OVER (PARTITION BY EJERCICIO, UNI_COMPRA, NRO_OC ORDER BY ITEM_OC, NRO_SOLIC, DESCRIPCION, IMP_UNITARIO, CANTIDAD) AS rn"


@demo(
    with_roles(
        "items",
        f""", n AS (SELECT *, {FIRST_LINE}, {SG_REF} AS ref FROM items)
        SELECT NRO_OC, count(*) AS n_items, CAST(sum(IMP_UNITARIO) AS DOUBLE) AS total, max(CASE WHEN rn = 1 THEN DESCRIPCION END) AS first_line, string_agg(DISTINCT ref, ',' ORDER BY ref) AS refs FROM n GROUP BY NRO_OC""",
    )
)
def nest_po_items(spark, sf_dir):
    items = role(spark, sf_dir, "items")
    item = F.struct("ITEM_OC", "NRO_SOLIC", "DESCRIPCION", "IMP_UNITARIO", "CANTIDAD")
    order = [F.col(c) for c in ("ITEM_OC", "NRO_SOLIC", "DESCRIPCION", "IMP_UNITARIO", "CANTIDAD")]
    docs = documents.nested(items, extracts.ORDER, ["DESCRIPCION"], item, order, {"gasto_refs": E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC")})
    total = F.aggregate("items", F.lit(0).cast("decimal(25,2)"), lambda a, x: (a + x["IMP_UNITARIO"]).cast("decimal(25,2)"))
    return docs.select("NRO_OC", F.size("items").cast("long").alias("n_items"), total.alias("total"), F.col("DESCRIPCION").alias("first_line"), F.array_join("gasto_refs", ",").alias("refs"))


@demo(
    with_roles(
        "oc items sg prov_link unit_link sg_link",
        f""", lines AS (SELECT items.*, COD_PROV, FECH_OC, OBSERVACIONES, ESTADO_OC, u.JURISDICCION AS unit FROM oc JOIN items {ON_OC} LEFT JOIN (SELECT EJERCICIO, DELEG_SOLIC, NRO_SOLIC, JURISDICCION FROM sg) u {ON_SG}),
        n AS (SELECT lines.*, remote_id AS proveedor_id, centro_costo_id, rubro_id, {FIRST_LINE}, {SG_REF} AS ref FROM lines JOIN prov_link USING (COD_PROV) LEFT JOIN unit_link ON unit = unit_link.JURISDICCION)
        SELECT NRO_OC, count(*) AS n_items, CAST(any_value(proveedor_id) AS INT) AS proveedor_id, max(CASE WHEN rn = 1 THEN centro_costo_id END) AS centro_costo_id,
        concat('oc-', EJERCICIO, '-', UNI_COMPRA, '-', NRO_OC) AS internal_id, concat(strftime(any_value(FECH_OC), '%Y-%m-%d'), ' 00:00:00') AS created, any_value(OBSERVACIONES) AS observacion,
        string_agg(DISTINCT n.ref, ',' ORDER BY n.ref) AS gasto_refs, coalesce(string_agg(DISTINCT lpad(sg_link.remote_id, 9, '0'), ',' ORDER BY lpad(sg_link.remote_id, 9, '0')), '') AS gasto_ids, CAST(count(rubro_id) AS BIGINT) AS n_rubros
        FROM n LEFT JOIN sg_link ON sg_link.ref = n.ref GROUP BY EJERCICIO, UNI_COMPRA, NRO_OC""",
    )
)
def map_po_docs(spark, sf_dir):
    oc, items, sg, suppliers, units, expenses = roles(spark, sf_dir, "oc items sg prov_link unit_link sg_link")
    docs = documents.order_documents(extracts.order_extract(oc, items, sg), suppliers, units, expenses)
    ids = F.array_join(F.transform("gasto_ids", lambda x: F.lpad(x.cast("string"), 9, "0")), ",")
    rubros = F.size(F.filter("items", lambda x: x["rubro_id"].isNotNull())).cast("long")
    return docs.select(
        "NRO_OC", F.size("items").cast("long").alias("n_items"), "proveedor_id", "centro_costo_id", "internal_id", "created", "observacion",
        F.array_join("gasto_refs", ",").alias("gasto_refs"), F.coalesce(ids, F.lit("")).alias("gasto_ids"), rubros.alias("n_rubros"),
    )


@demo(
    with_roles(
        "ped_items ped unit_link",
        """, n AS (SELECT ped_items.*, OBSERVACIONES, COSTO_TOT, centro_costo_id, rubro_id, row_number() OVER (PARTITION BY EJERCICIO, NUM_PED ORDER BY ORDEN, DESCRIP_BIE, COSTO_UNI, CANTIDAD) AS rn
        FROM ped_items LEFT JOIN ped USING (EJERCICIO, NUM_PED) LEFT JOIN unit_link USING (JURISDICCION))
        SELECT NUM_PED, count(*) AS n_items, max(CASE WHEN rn = 1 THEN centro_costo_id END) AS centro_costo_id, any_value(OBSERVACIONES) AS observacion, CAST(any_value(COSTO_TOT) AS DOUBLE) AS monto_presupuestado,
        concat('ped-', EJERCICIO, '-', NUM_PED) AS internal_id, CAST(sum(COSTO_UNI) AS DOUBLE) AS total FROM n GROUP BY EJERCICIO, NUM_PED""",
    )
)
def map_request_docs(spark, sf_dir):
    lines, ped, units = roles(spark, sf_dir, "ped_items ped unit_link")
    docs = documents.request_documents(extracts.request_line_extract(lines, ped), units)
    total = F.aggregate("items", F.lit(0).cast("decimal(25,2)"), lambda a, x: (a + x["precio"]).cast("decimal(25,2)"))
    return docs.select("NUM_PED", F.size("items").cast("long").alias("n_items"), "centro_costo_id", F.col("PED_OBSERVACIONES").alias("observacion"), "monto_presupuestado", "internal_id", total.alias("total"))


@demo(
    with_roles(
        "sg items oc unit_link prov_link",
        f""", m AS (SELECT EJERCICIO, DELEG_SOLIC, NRO_SOLIC, min(COD_PROV) AS COD_PROV FROM items JOIN oc {ON_OC} GROUP BY 1, 2, 3)
        SELECT NRO_SOLIC, substr(FECH_SOLIC, 1, 10) AS fecha, CAST(IMPORTE_TOT AS DOUBLE) AS importe_total, lpad(CAST(NRO_DOC AS VARCHAR), 8, '0') AS factura_nro, clasificacion_id,
        substr(coalesce(FECH_NECESIDAD, FECH_ENTREGA), 1, 10) AS fecha_vencimiento, CAST(remote_id AS INT) AS proveedor_id, OBSERVACIONES AS observacion
        FROM sg LEFT JOIN m {ON_SG} LEFT JOIN unit_link USING (JURISDICCION) LEFT JOIN prov_link USING (COD_PROV) WHERE FECH_SOLIC IS NOT NULL AND ESTADO_SOLIC <> 'A'""",
    )
)
def map_expenses(spark, sf_dir):
    sg, items, oc, units, suppliers = roles(spark, sf_dir, "sg items oc unit_link prov_link")
    docs = documents.expense_documents(extracts.expense_extract(sg, items, oc), None, units, suppliers)
    return docs.select("NRO_SOLIC", "fecha", "importe_total", "factura_nro", "clasificacion_id", "fecha_vencimiento", "proveedor_id", "observacion")


@demo(
    with_roles(
        "op sg sg_link items",
        f""", d AS (SELECT NRO_OP, ref FROM (SELECT NRO_SOLIC, concat('SG-', EJERCICIO, '-', DELEG_SOLIC, '-', NRO_SOLIC) AS ref FROM sg WHERE NRO_SOLIC % 2 = 0) s JOIN op ON op.NRO_CANCE = s.NRO_SOLIC),
        f AS (SELECT DISTINCT NRO_OP, {SG_REF.replace("EJERCICIO", "items.EJERCICIO")} AS ref FROM op JOIN items ON items.EJERCICIO = RECO_DEU_COMPRA_EJER AND NRO_OC = RECO_DEU_COMPRA),
        r AS (SELECT NRO_OP, ref, false AS via_order FROM d UNION ALL SELECT NRO_OP, ref, true FROM f WHERE NRO_OP NOT IN (SELECT NRO_OP FROM d)),
        g AS (SELECT NRO_OP, any_value(via_order) AS via_order, string_agg(r.ref, ',' ORDER BY r.ref) AS refs, string_agg(DISTINCT lpad(remote_id, 9, '0'), ',' ORDER BY lpad(remote_id, 9, '0')) AS gasto_ids FROM r LEFT JOIN sg_link ON sg_link.ref = r.ref GROUP BY NRO_OP)
        SELECT NRO_OP, concat('OP-2024-', NRO_OP) AS identificador_pago, CAST(coalesce(IMPORTE_TOTAL, 0) AS DOUBLE) AS total, CASE WHEN ESTADO_OP = 'C' THEN 3 ELSE 0 END AS estado,
        CASE WHEN ESTADO_OP = 'C' THEN strftime(FECH_OP, '%Y-%m-%d') END AS fecha, CONCEPTO AS observacion, refs, via_order, gasto_ids
        FROM op JOIN g USING (NRO_OP) WHERE ESTADO_OP <> 'A' AND gasto_ids IS NOT NULL""",
    )
)
def map_payment_docs(spark, sf_dir):
    op, sg, links = roles(spark, sf_dir, "op sg sg_link")
    payments = op.withColumns({"FECH_CONFIRM": F.lit(None).cast("string"), "OBSERVACIONES": F.lit(None).cast("string")})
    known = sg.where("NRO_SOLIC % 2 = 0").select(F.col("NRO_SOLIC").alias("NRO_CANCE"), E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC").alias("ref"))
    direct = op.join(known, "NRO_CANCE").groupBy(*extracts.PAYMENT).agg(F.array_sort(F.collect_set("ref")).alias("refs"))
    docs = documents.payment_documents(payments, direct, extracts.fallback_refs(op, order_refs(spark, sf_dir)), links)
    ids = F.array_join(F.transform("gasto_ids", lambda x: F.lpad(x.cast("string"), 9, "0")), ",")
    return docs.select("NRO_OP", "identificador_pago", "total", "estado", "fecha", "observacion", F.array_join("refs", ",").alias("refs"), "via_order", ids.alias("gasto_ids"))


@demo(
    with_roles(
        "op ret ded",
        """, j AS (SELECT EJERCICIO, NRO_OP, COD_RET, IMPORTE, DESCRIPCION, ORDINAL FROM op JOIN ret USING (NRO_CANCE) LEFT JOIN ded ON CODIGO = COD_RET WHERE IMPORTE <> 0),
        l AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY EJERCICIO, NRO_OP, COD_RET ORDER BY ORDINAL DESC, IMPORTE DESC) = 1)
        SELECT NRO_OP, CAST(COD_RET AS VARCHAR) AS cod_ret, CAST(IMPORTE AS DOUBLE) AS monto_retenido, concat('RET-2024-', NRO_OP, '-', COD_RET) AS numero_certificado,
        CASE WHEN COD_RET % 2 = 0 THEN 70 + COD_RET END AS tipo_impuesto_id, CASE WHEN COD_RET % 2 = 1 THEN DESCRIPCION END AS tipo_impuesto_name FROM l""",
    )
)
def map_withholdings(spark, sf_dir):
    op, ret, ded = roles(spark, sf_dir, "op ret ded")
    payments = op.select("EJERCICIO", "NRO_OP", "NRO_CANCE")
    last = documents.last_withholdings(ret.select("NRO_CANCE", "COD_RET", "IMPORTE", F.struct("ORDINAL", "IMPORTE").alias("ordinal")), payments, ["NRO_CANCE"])
    named = last.join(ded.withColumnRenamed("CODIGO", "COD_RET"), "COD_RET", "left")
    found = named.withColumn("tipo_impuesto_id", F.when(F.col("COD_RET") % 2 == 0, (F.col("COD_RET") + 70).cast("int")))
    return documents.withholding_documents(payments, found, ["NRO_CANCE"]).select("NRO_OP", "cod_ret", "monto_retenido", "numero_certificado", "tipo_impuesto_id", "tipo_impuesto_name")


PARTY = """SELECT CAST(COD_PROV AS INT) AS cod_prov, CASE WHEN COD_PROV % 7 = 0 THEN RAZON_SOCIAL ELSE SEGMENT END AS name, RAZON_SOCIAL AS razon_social,
    concat('20', regexp_replace(RAZON_SOCIAL, '[^0-9]', '', 'g')) AS cuit, CASE COD_PROV % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS iva_condicion_id,
    CASE WHEN COD_PROV % 2 = 0 THEN concat('Legal ', NATION) ELSE 'Postal' END AS domicilio FROM prov"""


@demo(with_roles("prov", PARTY))
def map_party(spark, sf_dir):
    prov = role(spark, sf_dir, "prov")
    key = F.col("COD_PROV")
    none = {c: F.lit(None).cast("string") for stem in ("LOCA", "PROV", "COD") for c in (f"{stem}_LEGAL", f"{stem}_POSTAL")}
    none |= {f"NRO_{k}_TE{n}": F.lit(None).cast("string") for k in ("PAIS", "INTE", "TELE") for n in (1, 2, 3)}
    rows = prov.withColumns(
        none
        | {
            "FANTASIA": F.when(key % 7 == 0, " ").otherwise(F.col("SEGMENT")),
            "CUIT": F.concat(F.lit("20-"), "RAZON_SOCIAL"),
            "COD_IVA": F.when(key % 3 == 0, "rins").when(key % 3 == 1, "MONOT").otherwise("?"),
            "CALLE_LEGAL": F.when(key % 2 == 0, "Legal"),
            "NRO_LEGAL": F.when(key % 2 == 0, F.col("NATION")),
            "CALLE_POSTAL": F.lit("Postal"),
            "NRO_POSTAL": F.lit(None).cast("string"),
            "EMAIL": F.lit(None).cast("string"),
            "TE_CELULAR": F.lit(None).cast("string"),
        }
    )
    docs = documents.suppliers(rows)
    return docs.select("external_id.cod_prov", *(f"Proveedor.{c}" for c in ("name", "razon_social", "cuit", "iva_condicion_id", "domicilio")))


@demo(
    with_roles(
        "jur",
        """, k AS (SELECT 'centro_costo' AS kind UNION ALL SELECT 'rubro' UNION ALL SELECT 'clasificacion')
        SELECT kind, JURISDICCION AS code, DENOMINACION AS name, CASE WHEN kind = 'centro_costo' THEN concat('Jurisdiccion ', JURISDICCION) END AS description FROM jur, k""",
    )
)
def map_unit_fanout(spark, sf_dir):
    return documents.units(role(spark, sf_dir, "jur"))


@demo(with_roles("oc items prov_link", f"SELECT NRO_OC, COD_PROV, count(*) AS n_lines FROM oc JOIN items {ON_OC} WHERE COD_PROV NOT IN (SELECT COD_PROV FROM prov_link) GROUP BY NRO_OC, COD_PROV"))
def skipped_docs_report(spark, sf_dir):
    oc, items, links = roles(spark, sf_dir, "oc items prov_link")
    return documents.skipped_orders(oc.join(items, extracts.ORDER), links).select("NRO_OC", "COD_PROV", "n_lines")

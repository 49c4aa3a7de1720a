"""Mapping of joined rows to nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import exprs as E

UNIT_TEXT = "Jurisdiccion "

#: The columns of an order line that its document needs.
ORDER_LINE = ["EJERCICIO", "UNI_COMPRA", "NRO_OC", "ITEM_OC", "DELEG_SOLIC", "NRO_SOLIC", "DESCRIPCION", "CANTIDAD", "IMP_UNITARIO"]


def suppliers(rows: DataFrame) -> DataFrame:
    """external_id and supplier; rows without a name or a key are dropped. Null attributes are left out in JSON."""
    name = E.first_non_empty("FANTASIA", "RAZON_SOCIAL")
    tax = E.digits_key("CUIT")
    either = lambda stem: E.first_non_empty(f"{stem}_LEGAL", f"{stem}_POSTAL")
    phones = [(f"NRO_PAIS_TE{n}", f"NRO_INTE_TE{n}", f"NRO_TELE_TE{n}") for n in (1, 2, 3)]
    attributes = {
        "name": E.truncated(name, 100),
        "razon_social": E.clean("RAZON_SOCIAL"),
        "mail": E.clean("EMAIL"),
        "telefono": E.first_phone(*phones, mobile="TE_CELULAR"),
        "domicilio": F.coalesce(E.join_non_empty("CALLE_LEGAL", "NRO_LEGAL"), E.join_non_empty("CALLE_POSTAL", "NRO_POSTAL")),
        "localidad": either("LOCA"),
        "provincia": either("PROV"),
        "codigo_postal": either("COD"),
        "cuit": tax,
        "tipo_documento_id": F.when(tax.isNotNull(), 1),
        "iva_condicion_id": E.code_map("COD_IVA", E.VAT_CONDITIONS, upper=True),
    }
    kept = rows.where(name.isNotNull() & F.col("COD_PROV").isNotNull())
    return kept.select(F.struct(F.col("COD_PROV").cast("int").alias("cod_prov")).alias("external_id"), F.struct(*(c.alias(k) for k, c in attributes.items())).alias("Proveedor"))


def units(rows: DataFrame, prefix: str = UNIT_TEXT) -> DataFrame:
    """kind, code, name and description: three target rows (cost centre, rubro, classification) for each unit."""
    code = E.clean("JURISDICCION")
    kinds = F.explode(F.array(*map(F.lit, ("centro_costo", "rubro", "clasificacion"))))
    named = rows.where(code.isNotNull()).select(kinds.alias("kind"), code.alias("code"), F.coalesce(E.clean("DENOMINACION"), code).alias("name"))
    return named.withColumn("description", F.when(F.col("kind") == "centro_costo", F.concat(F.lit(prefix), "code")))


def order_item() -> Column:
    """An order line as an item; null where its key or quantity is missing."""
    ref = F.struct(
        F.lit("oc_items").alias("entity"),
        *(F.col(c).cast("long").alias(c.lower()) for c in ("EJERCICIO", "UNI_COMPRA", "NRO_OC", "ITEM_OC", "DELEG_SOLIC", "NRO_SOLIC")),
    )
    whole = F.col("CANTIDAD").isNotNull()
    for c in ("EJERCICIO", "UNI_COMPRA", "NRO_OC", "ITEM_OC"):
        whole = whole & F.col(c).isNotNull()
    item = F.struct(
        F.col("ITEM_OC").cast("int").alias("item_oc"),
        E.truncated(E.clean("DESCRIPCION"), 255).alias("name"),
        F.col("CANTIDAD").cast("double").alias("cantidad"),
        E.money("IMP_UNITARIO").alias("precio"),
        F.lit(E.UNIT_OF_MEASURE).alias("unidad_de_medida_id"),
        F.col("rubro_id").cast("int").alias("rubro_id"),
        ref.alias("mercaderia_external_ref"),
    )
    return F.when(whole, item)


def nested(lines: DataFrame, key: list[str], header: list[str], item: Column, order: list[Column], sets: dict[str, Column] | None = None) -> DataFrame:
    """One row per ``key``: the header columns of its first line in ``order``, its sorted items, and the distinct values of ``sets``."""
    first = F.min_by(F.struct(*header), F.struct(*order))
    parts = [first.alias("_header"), F.sort_array(F.collect_list(item)).alias("items")]
    parts += [F.array_sort(F.collect_set(c)).alias(name) for name, c in (sets or {}).items()]
    return lines.groupBy(*key).agg(*parts).select(*key, "_header.*", *(sets or {}), "items")


def with_suppliers(rows: DataFrame, supplier_links: DataFrame) -> DataFrame:
    """The rows whose COD_PROV resolves, with proveedor_id."""
    return rows.join(supplier_links.select("COD_PROV", F.col("remote_id").cast("int").alias("proveedor_id")), "COD_PROV")


def order_documents(lines: DataFrame, supplier_links: DataFrame | None, unit_links: DataFrame, expense_links: DataFrame) -> DataFrame:
    """Order documents: the supplier must resolve; items, expense refs, resolved expense ids and the cost centre.

    ``lines`` come from an order extract. ``supplier_links`` (COD_PROV, remote_id; None if the extract is of orders that have
    their suppliers already, which spares the lines an exchange), ``unit_links`` (JURISDICCION,
    centro_costo_id, rubro_id), ``expense_links`` (ref, remote_id). The header is that of the lowest line.
    """
    keyed = lines.where(F.col("EJERCICIO").isNotNull() & F.col("UNI_COMPRA").isNotNull() & F.col("NRO_OC").isNotNull())
    resolved = keyed if supplier_links is None else with_suppliers(keyed, supplier_links)
    links = unit_links.select(F.col("JURISDICCION").alias("SG_JURISDICCION"), "centro_costo_id", "rubro_id")
    resolved = resolved.join(links, "SG_JURISDICCION", "left")
    order = [F.col(c) for c in ("ITEM_OC", "NRO_SOLIC", "DESCRIPCION", "IMP_UNITARIO", "CANTIDAD")]
    header = ["COD_PROV", "proveedor_id", "centro_costo_id", "SG_JURISDICCION", "OC_FECH_OC", "OC_OBSERVACIONES", "OC_ESTADO_OC", "OC_FECH_CONFIRM", "OC_IMPORTE_TOT"]
    # A line's expense is resolved before lines are nested: no documents are opened and joined again.
    known = expense_links.select(F.col("ref").alias("_ref"), F.col("remote_id").cast("int").alias("_expense"))
    resolved = resolved.withColumn("_ref", E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC")).join(known, "_ref", "left")
    docs = nested(resolved, ["EJERCICIO", "UNI_COMPRA", "NRO_OC"], header, order_item(), order, {"gasto_refs": F.col("_ref"), "gasto_ids": F.col("_expense")})
    return docs.withColumns(
        {
            "gasto_ids": F.when(F.size("gasto_ids") > 0, F.col("gasto_ids")),
            "internal_id": E.build_ref("oc", "EJERCICIO", "UNI_COMPRA", "NRO_OC"),
            "created": E.created_at("OC_FECH_OC"),
            "observacion": E.truncated(E.clean("OC_OBSERVACIONES"), 255),
        }
    ).where(F.size("items") > 0)


def request_documents(lines: DataFrame, unit_links: DataFrame) -> DataFrame:
    """Request documents from a request-line extract."""
    ref = F.struct(F.lit("ped_items").alias("entity"), *(F.col(c).cast("long").alias(c.lower()) for c in ("EJERCICIO", "NUM_PED", "ORDEN")))
    item = F.when(
        F.col("CANTIDAD").isNotNull() & F.col("ORDEN").isNotNull(),
        F.struct(
            F.col("ORDEN").cast("int").alias("orden"),
            E.truncated("DESCRIP_BIE", 255).alias("descripcion"),
            F.col("CANTIDAD").cast("double").alias("cantidad"),
            E.money("COSTO_UNI").alias("precio"),
            F.lit(E.UNIT_OF_MEASURE).alias("unidad_de_medida_id"),
            F.col("rubro_id").cast("int").alias("rubro_id"),
            ref.alias("mercaderia_external_ref"),
        ),
    )
    resolved = lines.where(F.col("EJERCICIO").isNotNull() & F.col("NUM_PED").isNotNull()).join(unit_links, "JURISDICCION", "left")
    order = [F.col(c) for c in ("ORDEN", "DESCRIP_BIE", "COSTO_UNI", "CANTIDAD")]
    docs = nested(resolved, ["EJERCICIO", "NUM_PED"], ["JURISDICCION", "centro_costo_id", "PED_OBSERVACIONES", "PED_COSTO_TOT"], item, order)
    return docs.withColumns({"internal_id": E.build_ref("ped", "EJERCICIO", "NUM_PED"), "monto_presupuestado": E.money("PED_COSTO_TOT")}).where(F.size("items") > 0)


def expense_documents(expenses: DataFrame, document_types: Column | None, unit_links: DataFrame, supplier_links: DataFrame, point_of_sale: str = "SRC") -> DataFrame:
    """Expense rows from an expense extract: cancelled ones, those without an amount, a date or a whole key are dropped."""
    date = E.date_only("FECH_SOLIC")
    amount = E.money("IMPORTE_TOT")
    whole = amount.isNotNull() & (date != "") & (E.status_code("ESTADO_SOLIC") != "A")
    for c in ("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC"):
        whole = whole & E.to_int(c).isNotNull()
    units = unit_links.select("JURISDICCION", "clasificacion_id")
    known = supplier_links.select(F.col("COD_PROV").alias("OC_COD_PROV"), F.col("remote_id").cast("int").alias("proveedor_id"))
    return expenses.where(whole).join(units, "JURISDICCION", "left").join(known, "OC_COD_PROV", "left").select(
        "EJERCICIO",
        "DELEG_SOLIC",
        "NRO_SOLIC",
        date.alias("fecha"),
        amount.alias("importe_total"),
        amount.alias("importe_neto"),
        F.lit(point_of_sale).alias("punto_de_venta"),
        (F.lit(None).cast("int") if document_types is None else document_types).alias("tipo_factura_id"),
        E.zero_padded("NRO_DOC").alias("factura_nro"),
        "clasificacion_id",
        E.due_date("FECH_NECESIDAD", "FECH_ENTREGA").alias("fecha_vencimiento"),
        "proveedor_id",
        E.truncated(E.clean("OBSERVACIONES"), 255).alias("observacion"),
    )


def last_withholdings(held: DataFrame, payments: DataFrame, on: list[str]) -> DataFrame:
    """Of the withholdings of what ``payments`` settle (``on``), the last of each code with an amount other than 0.

    Take them before the join with payments: many payments may settle what has many withholdings, and each gets one row a
    code then. ``held``: the columns of ``on``, COD_RET, IMPORTE, ordinal and any others.
    """
    code, rest = E.clean(F.col("COD_RET")), [c for c in held.columns if c not in on]
    kept = held.join(payments.select(*on).distinct(), on, "left_semi")
    # rows that do not count have no order, so that texts are looked at after the semi join: a filter would go below it
    order = F.when(code.isNotNull() & (E.money("IMPORTE") != 0), F.col("ordinal"))
    latest = kept.groupBy(*on, code.alias("_code")).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return latest.where("_row IS NOT NULL").select(*on, "_row.*")


def withholding_documents(payments: DataFrame, last: DataFrame, on: list[str], tag: str = "RET") -> DataFrame:
    """Withholdings of ``payments`` (EJERCICIO, NRO_OP and ``on``): of what one payment settles, the last of equal codes counts.

    ``last``: as by ``last_withholdings``, with DESCRIPCION and tipo_impuesto_id (resolved or null). Texts are looked at
    here, once for what is settled; for each payment there is only its certificate's number to make.
    """
    code, text = E.clean(F.col("COD_RET")), E.clean("DESCRIPCION")
    alias = E.withholding_class(F.coalesce(text, code))
    free = F.col("tipo_impuesto_id").isNull()
    docs = last.select(
        *on, code.alias("cod_ret"), "ordinal", E.money("IMPORTE").alias("monto_retenido"), "tipo_impuesto_id",
        F.when(free, alias).alias("tipo"), F.when(free & alias.isNull(), text).alias("tipo_impuesto_name"),
    )
    key, parts = ["EJERCICIO", "NRO_OP"], ["monto_retenido", "tipo_impuesto_id", "tipo", "tipo_impuesto_name"]
    each = payments.select(*dict.fromkeys([*key, *on])).join(docs, on).groupBy(*key, "cod_ret").agg(F.max_by(F.struct(*parts), "ordinal").alias("_doc"))
    return each.select(*key, "cod_ret", "_doc.monto_retenido", E.build_ref(tag, *key, "cod_ret").alias("numero_certificado"), *(f"_doc.{c}" for c in parts[1:]))


def payment_documents(payments: DataFrame, direct: DataFrame, fallback: DataFrame, expense_links: DataFrame, tag: str = "OP", payment_type: int = 1) -> DataFrame:
    """Payment documents: not cancelled, with refs found directly or by the order settled, one of them resolved at least."""
    key = ["EJERCICIO", "NRO_OP"]
    live = payments.where((E.status_code("ESTADO_OP") != "A") & F.col("EJERCICIO").isNotNull() & F.col("NRO_OP").isNotNull())
    both = live.join(direct.select(*key, F.col("refs").alias("_direct")), key, "left").join(fallback.select(*key, F.col("refs").alias("_fallback")), key, "left")
    with_refs = both.withColumn("refs", F.coalesce("_direct", "_fallback")).withColumn("via_order", F.col("_direct").isNull())
    ids = with_refs.select(*key, F.explode("refs").alias("ref")).join(expense_links.select("ref", F.col("remote_id").cast("int").alias("_id")), "ref")
    ids = ids.groupBy(*key).agg(F.array_sort(F.collect_set("_id")).alias("gasto_ids"))
    return with_refs.join(ids, key).select(
        *key,
        E.build_ref(tag, "EJERCICIO", "NRO_OP").alias("identificador_pago"),
        F.coalesce(E.money("IMPORTE_TOTAL"), F.lit(0).cast("decimal(15,2)")).alias("total"),
        F.lit(payment_type).alias("tipo_de_pago_id"),
        E.payment_state("ESTADO_OP").alias("estado"),
        E.payment_date("ESTADO_OP", "FECH_CONFIRM", "FECH_OP").alias("fecha"),
        E.truncated(E.first_non_empty("CONCEPTO", "OBSERVACIONES"), 255).alias("observacion"),
        "refs",
        "via_order",
        "gasto_ids",
    )


def skipped_orders(lines: DataFrame, supplier_links: DataFrame) -> DataFrame:
    """Orders whose supplier does not resolve: one row each, with the number of their lines."""
    lost = lines.join(supplier_links.select("COD_PROV"), "COD_PROV", "left_anti")
    return lost.groupBy("EJERCICIO", "UNI_COMPRA", "NRO_OC", "COD_PROV").agg(F.count(F.lit(1)).alias("n_lines"))

"""Entities, keys and relations of the purchasing data."""

from __future__ import annotations

import dataclasses


@dataclasses.dataclass(frozen=True)
class EntitySpec:
    """How one source table is read incrementally. ``date_column`` is that of the rolling extract."""

    name: str
    table: str
    key: tuple[str, ...]
    id_column: str | None = None
    ts_column: str | None = None
    full_load: bool = False
    pending_column: str | None = None
    pending_value: str | None = None
    pending_days: int = 0
    date_column: str | None = None
    columns: tuple[str, ...] = ()


# Tables, cursors, pending statuses and key columns of the source.
ENTITIES = {
    e.name: e
    for e in (
        EntitySpec("jurisdicciones", "JURISDICCIONES", ("JURISDICCION",), full_load=True),
        EntitySpec("proveedores", "PROVEEDORES", ("COD_PROV",), ts_column="FECHA_ULT_COMP", date_column="FECHA_ULT_COMP"),
        EntitySpec("pedidos", "PEDIDOS", ("EJERCICIO", "NUM_PED"), ts_column="FECH_EMI", date_column="FECH_EMI"),
        EntitySpec("ped_items", "PED_ITEMS", ("EJERCICIO", "NUM_PED", "ORDEN"), full_load=True),
        EntitySpec(
            "orden_compra", "ORDEN_COMPRA", ("EJERCICIO", "UNI_COMPRA", "NRO_OC"), ts_column="FECH_OC", pending_column="ESTADO_OC", pending_value="N", pending_days=30, date_column="FECH_OC"
        ),
        EntitySpec("oc_items", "OC_ITEMS", ("EJERCICIO", "UNI_COMPRA", "NRO_OC", "ITEM_OC"), full_load=True),
        EntitySpec(
            "solic_gastos", "SOLIC_GASTOS", ("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC"), ts_column="FECH_SOLIC", pending_column="ESTADO_SOLIC", pending_value="C", pending_days=30, date_column="FECH_SOLIC"
        ),
        EntitySpec("orden_pago", "ORDEN_PAGO", ("EJERCICIO", "NRO_OP"), ts_column="FECH_OP", pending_column="ESTADO_OP", pending_value="N", pending_days=30, date_column="FECH_OP"),
    )
}

#: The order in which a run takes the entities.
RUN_ORDER = ("jurisdicciones", "proveedores", "ped_items", "orden_compra", "solic_gastos", "orden_pago")

# Columns of each link state besides its key, target id and time.
LINK_COLUMNS = {
    "proveedores": ("cuit", "cod_estado"),
    "centro_costo": (),
    "clasificacion": (),
    "rubro": (),
    "unidad_medida": ("name", "codigo"),
    "tipo_factura": ("name", "codigo"),
    "tipo_pago": ("name", "codigo"),
    "tipo_retencion": ("name", "codigo"),
    "pedido": (),
    "orden_compra": ("fech_confirm", "estado_oc", "cod_prov", "importe_tot", "gasto_refs", "gasto_ids"),
    "gasto": ("estado_solic", "importe_tot", "cod_prov"),
    "orden_pago": ("estado_op", "importe_total"),
}

#: The key columns of each link state. An expense is known by two texts, see ``lookups.expense_keys``.
LINK_KEYS = {
    "proveedores": "COD_PROV int",
    "centro_costo": "JURISDICCION string",
    "clasificacion": "JURISDICCION string",
    "rubro": "JURISDICCION string",
    "unidad_medida": "CODIGO string",
    "tipo_factura": "CODIGO string",
    "tipo_pago": "CODIGO string",
    "tipo_retencion": "COD_RET string",
    "pedido": "EJERCICIO int, NUM_PED int",
    "orden_compra": "EJERCICIO int, UNI_COMPRA int, NRO_OC int",
    "gasto": "ref string",
    "orden_pago": "EJERCICIO int, NRO_OP int",
}

#: Link states that a unit has, and the sections that create them.
UNIT_KINDS = (("centro_costo", "centros_costo"), ("rubro", "rubros"), ("clasificacion", "clasificaciones"))

#: Sections of an entity's import results, and the link states that they fill.
RESULT_SECTIONS = {
    "jurisdicciones": tuple((section, kind) for kind, section in UNIT_KINDS),
    "proveedores": (("proveedores", "proveedores"),),
    "ped_items": (("pedidos", "pedido"),),
    "orden_compra": (("ordenes_compra", "orden_compra"),),
    "oc_items": (("ordenes_compra", "orden_compra"),),
    "solic_gastos": (("gastos", "gasto"),),
    "orden_pago": (("ordenes_pago", "orden_pago"),),
}

# What a rejected supplier that exists already is known by: the field in error, and the words of its message.
DUPLICATE = ("cuit", ("ya existe", "cuit"))

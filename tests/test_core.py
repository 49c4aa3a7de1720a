import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.operators import audits, documents, extracts, incremental, lookups, reconcile
from tributary.plans.pipeline import Run
from tributary.sources import payloads, snapshots
from tributary.specs import ENTITIES
from tributary.streaming.intake import take_in

NOW = dt.datetime(2024, 6, 1)


def test_fresh_state_reads_all_and_strict_cursor(spark):
    spec = ENTITIES["proveedores"]
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 2, 1)), (3, None)], "COD_PROV int, FECHA_ULT_COMP timestamp_ntz")
    as_of = F.lit(NOW).cast("timestamp_ntz")
    assert incremental.changed_rows(rows, spec, None, as_of).count() == 3
    state = {"last_id": None, "last_ts": dt.datetime(2024, 1, 1)}
    assert [r.COD_PROV for r in incremental.changed_rows(rows, spec, state, as_of).collect()] == [2]
    assert incremental.changed_rows(rows, dataclasses.replace(spec, full_load=True), state, as_of).count() == 3


def test_pending_window(spark):
    spec = ENTITIES["orden_compra"]
    rows = spark.createDataFrame([(1, "N", dt.datetime(2024, 5, 20)), (2, "R", dt.datetime(2024, 5, 20)), (3, "N", dt.datetime(2024, 4, 1))], "NRO_OC int, ESTADO_OC string, FECH_OC timestamp_ntz")
    state = {"last_id": None, "last_ts": dt.datetime(2024, 5, 30)}
    assert [r.NRO_OC for r in incremental.changed_rows(rows, spec, state, F.lit(NOW).cast("timestamp_ntz")).collect()] == [1]


def test_state_moves_only_forward(spark):
    state = incremental.empty_state(spark)
    runs = spark.createDataFrame([("a", None, dt.datetime(2024, 1, 1), NOW, 5)], "entity string, last_id long, last_ts timestamp_ntz, run_at timestamp_ntz, records long")
    once = incremental.succeeded(state, runs)
    again = incremental.succeeded(once, runs.withColumn("last_ts", F.lit(None).cast("timestamp_ntz")).withColumn("records", F.lit(0).cast("long")))
    row = again.first()
    assert (row.last_ts, row.records_sent, row.status) == (dt.datetime(2024, 1, 1), 0, "ok")
    broken = incremental.failed(again, "a", "x" * 300).first()
    assert broken.last_ts == dt.datetime(2024, 1, 1) and len(broken.status) == 207
    assert incremental.failed(state, "new", "x").first().status == "error: x"
    assert incremental.reset(again, "a").count() == 0 and incremental.reset(again).count() == 0


def test_cursor_values_ignore_nulls(spark):
    rows = spark.createDataFrame([(1, None), (7, dt.datetime(2024, 1, 1))], "k int, t timestamp_ntz")
    row = incremental.cursor_values(rows, dataclasses.replace(ENTITIES["orden_pago"], id_column="k", ts_column="t")).first()
    assert (row.last_id, row.last_ts) == (7, dt.datetime(2024, 1, 1))


def test_csv_with_line_breaks_and_latest(spark, tmp_path):
    (tmp_path / "a_20240101_000000.csv").write_text("x,y\n1,old\n")
    (tmp_path / "a_20240201_000000.csv").write_text('x,y\n1,"two\nlines"\n2,\n')
    (tmp_path / "other.csv").write_text("z\n1\n")
    found = snapshots.read_latest(spark, str(tmp_path), line_breaks={"a"})
    assert list(found) == ["a"]
    assert [tuple(r) for r in found["a"].orderBy("X").collect()] == [("1", "two\nlines"), ("2", None)]
    assert snapshots.optional_table(spark, str(tmp_path), "absent") is None


def test_upsert_and_store(spark, tmp_path):
    store = reconcile.StateStore(spark, str(tmp_path / "s"))
    assert store.read() is None
    old = spark.createDataFrame([(1, "a", NOW), (2, "b", NOW)], "k int, v string, updated_at timestamp_ntz")
    new = spark.createDataFrame([(2, "c", NOW, "x"), (3, "d", NOW, "y")], "k int, v string, updated_at timestamp_ntz, extra string")
    store.write(old)
    store.write(reconcile.upsert(store.read(), new, ["k"]))
    store.write(reconcile.upsert(store.read(), new, ["k"]))
    assert store.version() == 3
    old.write.parquet(str(tmp_path / "s" / "v9"))  # a writer that was lost
    for _ in range(5):
        store.write(store.read())
    assert store.version() == 14 and not (tmp_path / "s" / "v9").exists()

    class Late(reconcile.StateStore):
        def _path(self, name=""):
            if name.startswith("new-"):
                raise AssertionError("not reached")
            return super()._path(name)

    late = Late(spark, str(tmp_path / "s"))
    real, late.version = late.version, lambda answers=iter([14, 15]): next(answers)
    with pytest.raises(RuntimeError, match="another run"):
        late.write(store.read())
    assert real() == 14
    assert sorted((r.k, r.v, r.extra) for r in store.read().collect()) == [(1, "a", None), (2, "c", "x"), (3, "d", "y")]


@pytest.mark.parametrize(
    "status, previous, remote, resolved, sent, wanted",
    [
        ("R", None, None, None, None, "create"),
        ("R", "N", "1", "7", "7", "create"),
        ("R", "R", "1", "7,8", "7", "resend"),
        ("R", "R", "1", "7", "", "resend"),
        ("R", "R", "1", "7", None, "resend"),
        ("R", "R", "1", "7", "7", "same"),
        ("R", "R", "1", "", "7", "same"),
        ("R", "R", "1", None, None, "same"),
        ("A", "R", "1", None, None, "cancel"),
        ("A", "R", "", None, None, "register"),
        ("A", None, None, None, None, "register"),
        ("N", None, None, "7", None, "register"),
        (None, "R", "1", "7", None, "register"),
    ],
)
def test_order_action(spark, status, previous, remote, resolved, sent, wanted):
    action = reconcile.order_action(*(F.lit(x).cast("string") for x in (status, previous, remote, resolved, sent)))
    assert spark.range(1).select(action.alias("x")).first().x == wanted


def test_batches_partition_the_documents(spark):
    numbered = payloads.batch_numbers(spark.range(1003).withColumnRenamed("id", "k"), ["k"], 100)
    sizes = {r.batch: (r.n, r.a, r.b) for r in numbered.groupBy("batch").agg(F.count("*").alias("n"), F.min("k").alias("a"), F.max("k").alias("b")).collect()}
    assert len(sizes) == 11 and sizes[10] == (3, 1000, 1002) and all(sizes[b] == (100, 100 * b, 100 * b + 99) for b in range(10))


def test_batches_of_wide_documents_lose_none(spark):
    wide = [F.rpad(F.sha2(F.concat(F.lit(str(n)), F.col("id").cast("string")), 512), 128, "x").alias(f"c{n}") for n in range(8)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        numbered = payloads.batch_numbers(spark.range(30_000).select(F.col("id").alias("k"), *wide), ["k"], 100)
        found = payloads.envelopes(numbered, "pedidos", F.to_json(F.struct("k", *(f"c{n}" for n in range(8)))), dry_run=False, options={})
        sent = found.select("batch", F.size(F.from_json("payload", "pedidos array<string>")["pedidos"]).alias("n")).collect()
        wrong = numbered.where(F.col("batch") != F.floor(F.col("k") / 100)).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r.batch, r.n) for r in sent) == [(b, 100) for b in range(300)] and wrong == 0


def test_import_results_and_gate(spark):
    body = '{"results": {"gastos": [{"success": true, "id": "5", "external_id": {"n": "1"}}, {"success": false, "id": "6", "external_id": {"n": "2"}}, {"success": true, "external_id": {"n": "3"}}]}}'
    found = payloads.import_results(spark.createDataFrame([(body,)], "body string"), "body", "gastos").collect()
    assert [(r.id, r.external_id["n"]) for r in found] == [("5", "1")]
    good = spark.createDataFrame([("a", 0)], "section string, errors int")
    payloads.raise_on_errors(good)
    with pytest.raises(RuntimeError, match="b"):
        payloads.raise_on_errors(good.union(spark.createDataFrame([("b", 2)], "section string, errors int")))


def test_lookup_order_and_last_duplicate(spark):
    catalog = spark.createDataFrame([(0, "1", "Factura A"), (1, "2", "factura  á"), (2, "x", "bad")], "ordinal int, id string, name string")
    index = lookups.text_index(catalog, "name")
    rows = spark.createDataFrame([("FACTURA-A",), ("bad",), (None,)], "t string")
    found = lookups.resolve_text(rows, [(F.col("t"), index)], "id", default=9)
    assert sorted((r.t or "", r.id) for r in found.collect()) == [("", 9), ("FACTURA-A", 2), ("bad", 9)]


def _purchases(spark):
    oc = spark.createDataFrame(
        [(2024, 1, 10, NOW, 5, "R", None, " obs ", 100.0), (2024, 1, 11, NOW, 6, "R", None, None, 50.0), (2024, 1, 12, NOW, 5, "N", None, None, 5.0)],
        "EJERCICIO int, UNI_COMPRA int, NRO_OC int, FECH_OC timestamp_ntz, COD_PROV int, ESTADO_OC string, FECH_CONFIRM timestamp_ntz, OBSERVACIONES string, IMPORTE_TOT double",
    )
    items = spark.createDataFrame(
        [(2024, 1, 10, 2, 1, 7, 2.0, 3.555, "second"), (2024, 1, 10, 1, 1, 8, 1.0, 2.0, " first "), (2024, 1, 11, 1, 1, 7, 1.0, 1.0, "x"), (2024, 1, 12, 1, 1, 7, None, 1.0, "x")],
        "EJERCICIO int, UNI_COMPRA int, NRO_OC int, ITEM_OC int, DELEG_SOLIC int, NRO_SOLIC int, CANTIDAD double, IMP_UNITARIO double, DESCRIPCION string",
    )
    sg = spark.createDataFrame([(2024, 1, 7, "100"), (2024, 1, 8, "200")], "EJERCICIO int, DELEG_SOLIC int, NRO_SOLIC int, JURISDICCION string")
    return oc, items, sg


def test_order_documents(spark):
    oc, items, sg = _purchases(spark)
    suppliers = spark.createDataFrame([(5, "50")], "COD_PROV int, remote_id string")
    units = spark.createDataFrame([("200", 3, 4)], "JURISDICCION string, centro_costo_id int, rubro_id int")
    expenses = spark.createDataFrame([("SG-2024-1-7", "70")], "ref string, remote_id string")
    lines = extracts.order_extract(oc, items, sg)
    (doc,) = documents.order_documents(lines, suppliers, units, expenses).collect()
    assert (doc.NRO_OC, doc.proveedor_id, doc.centro_costo_id, doc.gasto_ids, doc.gasto_refs) == (10, 50, 3, [70], ["SG-2024-1-7", "SG-2024-1-8"])
    assert [(i.item_oc, i["name"], i.rubro_id, str(i.precio)) for i in doc["items"]] == [(1, "first", 4, "2.00"), (2, "second", None, "3.56")]
    assert (doc.created, doc.observacion, doc.internal_id) == ("2024-06-01 00:00:00", "obs", "oc-2024-1-10")
    skipped = documents.skipped_orders(lines, suppliers).collect()
    assert [(r.NRO_OC, r.n_lines) for r in skipped] == [(11, 1)]


def test_expense_with_least_supplier_and_trace(spark):
    oc, items, sg = _purchases(spark)
    found = {r.NRO_SOLIC: r.OC_COD_PROV for r in extracts.expense_extract(sg, items, oc).collect()}
    assert found == {7: 5, 8: 5}
    assert extracts.trace_view(items, sg, oc).count() == 4


def _body(spark, text):
    return spark.createDataFrame([(text,)], "body string")


def _link_supplier(spark, run):
    run.take_results("proveedores", _body(spark, '{"results": {"proveedores": [{"success": true, "id": "50", "external_id": {"cod_prov": "5"}}]}}'))


def _day(spark, tables, folder, day, **how):
    return Run(spark, tables, str(folder), as_of=dt.datetime(2024, 6, day), batch=1, **how)


def _order_tables(spark):
    oc, items, sg = _purchases(spark)
    return {"ORDEN_COMPRA": oc, "OC_ITEMS": items, "SOLIC_GASTOS": sg, "JURISDICCIONES": spark.createDataFrame([("100", "a")], "JURISDICCION string, DENOMINACION string")}


ORDER_DONE = '{"stats": {"ordenes_compra": {"ok": 1, "error": 0}}, "results": {"ordenes_compra": [{"success": true, "id": "70", "external_id": {"ejercicio": 2024, "uni_compra": 1, "nro_oc": 10}}]}}'


def test_orders_are_kept_only_by_results(spark, tmp_path):
    tables = _order_tables(spark)
    run = _day(spark, tables, tmp_path, 2)
    _link_supplier(spark, run)
    assert run.orders() == {"create": 1}
    assert run.state().count() == 0 and run.links("orden_compra").count() == 0
    payload = spark.read.text(f"{tmp_path}/payloads/orden_compra/20240602_000000/ordenes_compra").collect()
    assert len(payload) == 1 and '"ordenes_compra":["{' in payload[0].value

    failing = _day(spark, tables, tmp_path, 3)
    assert failing.orders() == {"create": 1}  # no result has come
    with pytest.raises(RuntimeError, match="ordenes_compra"):
        failing.take_results("orden_compra", _body(spark, ORDER_DONE.replace('"error": 0', '"error": 2')))
    with pytest.raises(RuntimeError, match="errors"):
        failing.take_results("orden_compra", _body(spark, ORDER_DONE.replace('"stats"', '"errors": ["x"], "stats"')))
    assert failing.links("orden_compra").count() == 0
    assert failing.state().first().status.startswith("error: ") and failing.state().first().last_ts is None

    again = _day(spark, tables, tmp_path, 4)
    assert again.orders() == {"create": 1}
    assert again.take_results("orden_compra", _body(spark, ORDER_DONE)) == {"orden_compra": 1}
    (link,) = again.links("orden_compra").collect()
    assert (link.NRO_OC, link.remote_id, link.estado_oc, link.cod_prov, link.gasto_refs) == (10, "70", "R", "5", "SG-2024-1-7,SG-2024-1-8")
    assert (again.state().first().last_ts, again.state().first().status) == (NOW, "ok")
    assert _day(spark, tables, tmp_path, 5).orders() == {}


def test_orders_are_sent_again_once_when_an_expense_resolves(spark, tmp_path):
    tables = _order_tables(spark)
    run = _day(spark, tables, tmp_path, 2)
    _link_supplier(spark, run)
    run.orders()
    run.take_results("orden_compra", _body(spark, ORDER_DONE))
    again = _day(spark, tables, tmp_path, 3)
    again.reset("orden_compra")
    assert again.orders() == {"same": 1}
    gasto = '{"results": {"gastos": [{"success": true, "id": "71", "external_id": {"ejercicio": "2024", "deleg_solic": 1, "nro_solic": 7}}, {"success": true, "id": "9", "external_id": {"nro_solic": 7}}]}}'
    again.take_results("solic_gastos", _body(spark, gasto))
    assert {(r.ref, r.remote_id) for r in again.links("gasto").collect()} == {("SG-2024-1-7", "71"), ('{"deleg_solic":1,"ejercicio":2024,"nro_solic":7}', "71")}
    for day, wanted in ((4, "resend"), (5, "resend"), (6, "same")):
        late = _day(spark, tables, tmp_path, day)
        late.reset("orden_compra")
        assert late.orders() == {wanted: 1}
        if day == 5:
            late.take_results("orden_compra", _body(spark, ORDER_DONE))
    cancelled = tables | {"ORDEN_COMPRA": tables["ORDEN_COMPRA"].withColumn("ESTADO_OC", F.lit("A"))}
    last = _day(spark, cancelled, tmp_path, 7, cancel_reason="no more")
    last.reset()
    assert last.orders() == {"cancel": 1}
    payload = spark.read.text(f"{tmp_path}/payloads/orden_compra/20240607_000000/ordenes_compra").first().value
    assert '\\"estado_aprobacion\\":4' in payload and '\\"motivo_rechazo\\":\\"no more\\"' in payload


def test_rows_that_arrive_during_a_run_wait_for_the_next(spark, tmp_path):
    tables = _order_tables(spark)
    source = str(tmp_path / "source")
    tables["ORDEN_COMPRA"].write.parquet(source)
    live = tables | {"ORDEN_COMPRA": spark.read.parquet(source)}
    run = _day(spark, live, tmp_path, 2)
    _link_supplier(spark, run)
    late = tables["ORDEN_COMPRA"].where("NRO_OC = 10").withColumns({"NRO_OC": F.lit(20), "FECH_OC": F.lit("2024-06-02 01:00:00").cast("timestamp_ntz")})
    real = run.step
    run.step = lambda *args, **named: (late.write.mode("append").parquet(source), real(*args, **named))[1]
    assert run.orders() == {"create": 1}
    run.take_results("orden_compra", _body(spark, ORDER_DONE))
    assert run.state().first().last_ts == NOW
    lines = tables["OC_ITEMS"].where("NRO_OC = 10").withColumn("NRO_OC", F.lit(20))
    after = _day(spark, live | {"ORDEN_COMPRA": spark.read.parquet(source), "OC_ITEMS": tables["OC_ITEMS"].union(lines)}, tmp_path, 3)
    assert after.orders() == {"create": 1}


def test_limits_and_order_lines(spark, tmp_path):
    tables = _order_tables(spark)
    tables["ORDEN_COMPRA"] = tables["ORDEN_COMPRA"].withColumn("FECH_OC", F.expr("FECH_OC + make_interval(0, 0, 0, NRO_OC)"))
    run = _day(spark, tables, tmp_path, 2, limits={"orden_compra": 2})
    _link_supplier(spark, run)
    assert run.orders() == {"create": 1} and run.changed("orden_compra").count() == 2
    assert run.order_lines() == {"create": 1}
    assert sorted((r.NRO_OC, r.n_lines) for r in spark.read.parquet(f"{tmp_path}/skipped/oc_items/20240602_000000").collect()) == [(11, 1)]


def _all_tables(spark):
    oc, items, sg = _purchases(spark)
    text = "".join(f", {c} string" for stem in ("CALLE", "NRO", "LOCA", "COD", "PROV") for c in (f"{stem}_LEGAL", f"{stem}_POSTAL"))
    text += "".join(f", NRO_{k}_TE{n} string" for n in (1, 2, 3) for k in ("PAIS", "INTE", "TELE"))
    prov = spark.createDataFrame([(5, "five", " ", "20-12345678-9", "RINS", NOW, *[None] * 19, "1", "m@x")], f"COD_PROV int, RAZON_SOCIAL string, FANTASIA string, CUIT string, COD_IVA string, FECHA_ULT_COMP timestamp_ntz{text}, TE_CELULAR string, EMAIL string")
    more = {"IMPORTE_TOT": "double", "FECH_SOLIC": "string", "FECH_NECESIDAD": "string", "FECH_ENTREGA": "string", "TIPO_DOC": "string", "NRO_DOC": "int", "ESTADO_SOLIC": "string", "OBSERVACIONES": "string"}
    sg = sg.withColumns({c: F.lit(None).cast(k) for c, k in more.items()}).withColumns({"IMPORTE_TOT": F.lit(9.5), "FECH_SOLIC": F.lit("2024-05-01 00:00:00"), "TIPO_DOC": F.lit("FA")})
    return {
        "JURISDICCIONES": spark.createDataFrame([("100", "a"), ("200", None), (" ", "x")], "JURISDICCION string, DENOMINACION string"),
        "PROVEEDORES": prov,
        "PEDIDOS": spark.createDataFrame([(2024, 3, NOW, "o", "d", 7.0, "200")], "EJERCICIO int, NUM_PED int, FECH_EMI timestamp_ntz, OBSERVACIONES string, CODIGO_DEP string, COSTO_TOT double, JURISDICCION string"),
        "PED_ITEMS": spark.createDataFrame([(2024, 3, 1, "200", 2.0, "d", 1.5), (2024, 3, 2, "200", None, "d", 1.5)], "EJERCICIO int, NUM_PED int, ORDEN int, JURISDICCION string, CANTIDAD double, DESCRIP_BIE string, COSTO_UNI double"),
        "ORDEN_COMPRA": oc,
        "OC_ITEMS": items,
        "SOLIC_GASTOS": sg,
        "ORDEN_PAGO": spark.createDataFrame(
            [(2024, 1, NOW, 7, None, None, "C", 10.0, None, "c", None)],
            "EJERCICIO int, NRO_OP int, FECH_OP timestamp_ntz, NRO_CANCE int, RECO_DEU_COMPRA int, RECO_DEU_COMPRA_EJER int, ESTADO_OP string, IMPORTE_TOTAL double, FECH_CONFIRM timestamp_ntz, CONCEPTO string, OBSERVACIONES string",
        ),
        "RETENCIONES": spark.createDataFrame([(2024, 7, 3, "x", 1.25), (2024, 7, 4, "x", 0.0), (2024, 7, 5, "x", 2.0), (2024, 7, 6, "x", 3.0)], "EJERCICIO int, NRO_CANCE int, COD_RET int, CUENTA string, IMPORTE double"),
        "DEDUCCIONES": spark.createDataFrame([(3, "Ret. IVA"), (5, "Other")], "CODIGO int, DESCRIPCION string"),
    }


def _result(spark, section, **external):
    pairs = ", ".join(f'"{k}": "{v}"' for k, v in external.items())
    return _body(spark, f'{{"results": {{"{section}": [{{"success": true, "id": "70", "external_id": {{{pairs}}}}}]}}}}')


CATALOG = "ordinal int, id string, name string, codename string, codigo string, description string"


def test_run_of_all_entities(spark, tmp_path):
    import json

    tables = _all_tables(spark)
    catalogs = {
        "tipos_factura": spark.createDataFrame([(0, "4", "fa", "x", None, None)], CATALOG),
        "tipos_retencion": spark.createDataFrame([(0, "31", "other", "y", "z", None), (1, "32", "n", "6", None, None)], CATALOG),
        "centros_costo": spark.createDataFrame([(0, "88", "c", None, None, "Jurisdiccion 200")], CATALOG),
    }
    run = _day(spark, tables, tmp_path, 2, catalogs=catalogs)
    sent = lambda entity, section, day: [json.loads(d) for r in spark.read.text(f"{tmp_path}/payloads/{entity}/202406{day}_000000/{section}").collect() for d in json.loads(r.value)[section]]
    _link_supplier(spark, run)
    run.all()
    assert {r.entity: r.status for r in run.state().collect()} == {"solic_gastos": "ok", "orden_pago": "ok"}  # the others wait for results
    assert sorted(d["name"] for d in sent("jurisdicciones", "rubros", "02")) == ["200", "a"]
    assert sent("proveedores", "proveedores", "02")[0]["Proveedor"]["iva_condicion_id"] == 1
    (request,) = sent("ped_items", "pedidos", "02")
    assert len(request["items"]) == 1 and request["centro_costo_id"] == 88
    assert [(r.JURISDICCION, r.remote_id) for r in run.links("centro_costo").collect()] == [("200", "88")]
    assert [d["NRO_OC"] for d in sent("orden_compra", "ordenes_compra", "02")] == [10]
    assert sent("solic_gastos", "gastos", "02") == [] and sent("orden_pago", "ordenes_pago", "02") == []

    later = _day(spark, tables, tmp_path, 3, catalogs=catalogs)
    later.take_results("orden_compra", _body(spark, ORDER_DONE))
    later.take_results("proveedores", _result(spark, "proveedores", cod_prov=5))
    later.take_results("ped_items", _result(spark, "pedidos", ejercicio=2024, num_ped=3))
    later.take_results("jurisdicciones", _body(spark, '{"results": {"rubros": [{"success": true, "id": 0, "external_id": {"jurisdiccion": "100"}}], "clasificaciones": []}}'))
    assert [r.entity for r in later.pending().collect()] == ["jurisdicciones"]  # not all of it is confirmed
    assert [r.remote_id for r in later.links("rubro").collect()] == ["0"]
    both = ", ".join(f'{{"success": true, "id": {n}, "external_id": {{"jurisdiccion": "{n}"}}}}' for n in (100, 200))
    later.take_results("jurisdicciones", _body(spark, f'{{"results": {{"centros_costo": [{both}], "rubros": [{both}], "clasificaciones": [{both}]}}}}'))
    assert {r.entity for r in later.state().where("status = 'ok'").collect()} == {"jurisdicciones", "proveedores", "ped_items", "orden_compra", "solic_gastos", "orden_pago"}
    (supplier,) = later.links("proveedores").collect()
    assert (supplier.remote_id, supplier.cuit) == ("70", "20123456789")
    assert [r.remote_id for r in later.links("pedido").collect()] == ["70"] and {r.remote_id for r in later.links("rubro").collect()} == {"100", "200"}
    assert later.links("orden_compra").where("NRO_OC = 10 AND gasto_refs = 'SG-2024-1-7,SG-2024-1-8' AND remote_id = '70'").count() == 1
    later.reset()
    assert {r.status for r in later.report().collect()} == {"pending"}
    assert later.expenses() == 2 and {d["tipo_factura_id"] for d in sent("solic_gastos", "gastos", "03")} == {4}
    later.take_results("solic_gastos", _result(spark, "gastos", ejercicio=2024, deleg_solic=1, nro_solic=7))
    assert {(r.importe_tot, r.cod_prov) for r in later.links("gasto").collect()} == {("9.5", "5")}
    later.save_links("tipo_retencion", spark.createDataFrame([("3", "30", NOW)], "COD_RET string, remote_id string, updated_at timestamp_ntz"))
    assert later.payments() == 1
    (doc,) = sent("orden_pago", "ordenes_pago", "03")
    assert doc["gasto_ids"] == [70] and doc["external_id"] == {"ejercicio": 2024, "nro_op": 1}
    assert [(w["cod_ret"], w["tipo_impuesto_id"]) for w in doc["retenciones"]] == [("3", 30), ("5", 31), ("6", 32)]


def test_feed_skips_or_updates_linked_suppliers(spark, tmp_path):
    tables = _all_tables(spark)
    tables["PROVEEDORES"] = tables["PROVEEDORES"].union(tables["PROVEEDORES"].withColumns({"COD_PROV": F.lit(6), "CUIT": F.lit("27-00000000-1")}))
    run = _day(spark, tables, tmp_path, 2)
    _link_supplier(spark, run)
    assert run.feed() == {"create": 1, "skip": 1}
    assert _day(spark, tables, tmp_path, 3, force=True).feed() == {"create": 1, "update": 1}
    found = _day(spark, tables, tmp_path, 4)
    assert found.link_existing(spark.createDataFrame([("7", "27000000001"), ("8", None)], "id string, cuit string")) == 1
    assert found.feed() == {"skip": 2}


def test_changed_rows_without_documents_are_an_error(spark, tmp_path):
    tables = _all_tables(spark)
    tables["PED_ITEMS"] = tables["PED_ITEMS"].withColumn("CANTIDAD", F.lit(None).cast("double"))
    assert _day(spark, tables, tmp_path, 2, dry_run=True).requests() == 0
    run = _day(spark, tables, tmp_path, 3)
    with pytest.raises(RuntimeError, match="no changed row"):
        run.requests()
    assert run.state().first().status.startswith("error: ")


def test_payment_documents(spark):
    op = spark.createDataFrame(
        [(2024, 1, 7, None, None, "C", 10.0, "2024-05-05", None, "c"), (2024, 2, None, 10, 2024, "N", 5.0, "2024-05-06", None, None), (2024, 3, 7, None, None, "A", 1.0, "2024-05-06", None, None)],
        "EJERCICIO int, NRO_OP int, NRO_CANCE int, RECO_DEU_COMPRA int, RECO_DEU_COMPRA_EJER int, ESTADO_OP string, IMPORTE_TOTAL double, FECH_OP string, FECH_CONFIRM string, CONCEPTO string",
    ).withColumn("OBSERVACIONES", F.lit(None).cast("string"))
    _, items, sg = _purchases(spark)
    refs = spark.createDataFrame([(2024, 10, ["SG-2024-1-8", "SG-2024-1-9"])], "EJERCICIO int, NRO_OC int, refs array<string>")
    links = spark.createDataFrame([("SG-2024-1-7", "70"), ("SG-2024-1-8", "80")], "ref string, remote_id string")
    docs = documents.payment_documents(op, extracts.payment_refs(op, sg), extracts.fallback_refs(op, refs), links).orderBy("NRO_OP").collect()
    assert [(d.NRO_OP, d.gasto_ids, d.via_order, d.estado, d.fecha) for d in docs] == [(1, [70], False, 3, "2024-05-05"), (2, [80], True, 0, None)]


def test_audits(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert [(r.k, r.n) for r in audits.key_violations(rows, ["k"]).collect()] == [(1, 2)]
    profile = {r.column_name: (r.n_filled, r.n_distinct) for r in audits.column_profile(rows, "t").collect()}
    assert profile == {"k": (3, 2), "v": (2, 2)}
    coverage = {r.column_name: (r.mapped, r.found) for r in audits.mapping_coverage(rows, "t", ["k", "z"]).collect()}
    assert coverage == {"k": (True, True), "v": (False, True), "z": (True, False)}


def test_stream_intake_sees_each_file_once(spark, tmp_path):
    folder, seen = str(tmp_path / "in"), []
    spark.range(3).write.parquet(folder)
    job = lambda batch, n: seen.extend(r.id for r in batch.collect())
    take_in(spark, folder, spark.range(1).schema, job, str(tmp_path / "c"))
    spark.range(3, 5).write.mode("append").parquet(folder)
    take_in(spark, folder, spark.range(1).schema, job, str(tmp_path / "c"))
    assert sorted(seen) == [0, 1, 2, 3, 4]


def test_dry_run_keeps_state(spark, tmp_path):
    tables = _all_tables(spark)
    run = _day(spark, tables, tmp_path, 2, dry_run=True)
    assert run.suppliers() == 1
    broken = tables | {"PROVEEDORES": tables["PROVEEDORES"].withColumn("EMAIL", F.raise_error(F.lit("gone")).cast("string"))}
    with pytest.raises(Exception, match="gone"):
        _day(spark, broken, tmp_path, 3, dry_run=True).suppliers()
    assert run.state().count() == 0 and run.links("proveedores").count() == 0 and not (tmp_path / "state").exists()
    assert '"dry_run":true' in spark.read.text(f"{tmp_path}/payloads/proveedores/20240602_000000/proveedores").first().value


def test_failed_step_keeps_the_cursor(spark, tmp_path):
    tables = _all_tables(spark)
    first = _day(spark, tables, tmp_path, 2)
    first.suppliers()
    _link_supplier(spark, first)
    later = tables["PROVEEDORES"].withColumn("FECHA_ULT_COMP", F.lit("2024-07-01").cast("timestamp_ntz"))
    broken = _day(spark, tables | {"PROVEEDORES": later.withColumn("EMAIL", F.raise_error(F.lit("gone")).cast("string"))}, tmp_path, 3)
    with pytest.raises(Exception, match="gone"):
        broken.suppliers()
    row = broken.state().first()
    assert row.last_ts == NOW and row.status.startswith("error: ")

"""Runs and their results: what was sent, what is confirmed, and where cursors stand."""

import datetime as dt
import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from test_core import NOW, ORDER_DONE, _all_tables, _body, _day, _link_supplier, _order_tables, _purchases, _result

from tributary.operators import audits, documents, extracts
from tributary.plans import registry
from tributary.plans.pipeline import Run
from tributary.streaming.intake import run_on_arrival
from tributary.workspace import shared_dir, stored, temporary


def done(spark, *numbers, section="ordenes_compra"):
    rows = [{"success": True, "id": f"7{n}", "external_id": {"ejercicio": "2024", "uni_compra": 1, "nro_oc": str(n)}} for n in numbers]
    return _body(spark, json.dumps({"results": {section: rows}}))


def with_order(spark, tables, number, day):
    """The tables and one more confirmed order."""
    at = F.lit(dt.datetime(2024, 6, day)).cast("timestamp_ntz")
    more = lambda t, **how: tables[t].unionByName(tables[t].where("NRO_OC = 10").withColumns({"NRO_OC": F.lit(number), **how}))
    return tables | {"ORDEN_COMPRA": more("ORDEN_COMPRA", FECH_OC=at), "OC_ITEMS": more("OC_ITEMS")}


def test_two_feeds_of_orders_keep_their_own_links(spark, tmp_path):
    """The feed of lines finds nothing new to send, and the links of what the feed of orders sent are whole."""
    tables = _order_tables(spark)
    run = _day(spark, tables, tmp_path, 2)
    _link_supplier(spark, run)
    assert run.orders() == {"create": 1}
    lines = _day(spark, tables | {"OC_ITEMS": tables["OC_ITEMS"].where("NRO_OC = 11")}, tmp_path, 2)
    assert lines.order_lines() == {}
    assert run.take_results("orden_compra", _body(spark, ORDER_DONE)) == {"orden_compra": 1}
    (link,) = run.links("orden_compra").collect()
    assert (link.remote_id, link.estado_oc, link.gasto_refs, link.gasto_ids) == ("70", "R", "SG-2024-1-7,SG-2024-1-8", None)  # no expense has an id yet
    again = _day(spark, tables, tmp_path, 3)
    again.reset("orden_compra")
    assert again.orders() == {"same": 1}


def test_late_results_move_the_cursor_for_their_payload_only(spark, tmp_path):
    tables = _order_tables(spark)
    first = _day(spark, tables, tmp_path, 2)
    _link_supplier(spark, first)
    assert first.orders() == {"create": 1}
    more = with_order(spark, tables, 20, 2)
    second = _day(spark, more, tmp_path, 3)
    assert second.orders() == {"create": 2}
    with pytest.raises(ValueError, match="20240602_000000, 20240603_000000"):
        _day(spark, more, tmp_path, 9).take_results("orden_compra", done(spark, 10))
    second.take_results("orden_compra", done(spark, 10), stamp=first.stamp)
    assert second.state().where("entity = 'orden_compra'").first().last_ts == NOW
    assert [r.stamp for r in second.pending().collect()] == [second.stamp]
    third = _day(spark, more, tmp_path, 4)
    assert third.orders() == {"create": 1}  # order 20 was sent, and never confirmed
    third.take_results("orden_compra", done(spark, 20))
    assert third.state().where("entity = 'orden_compra'").first().last_ts == dt.datetime(2024, 6, 2)
    assert third.pending().count() == 0 and _day(spark, more, tmp_path, 5).orders() == {}
    assert sorted((r.NRO_OC, r.remote_id, r.estado_oc) for r in third.links("orden_compra").collect()) == [(10, "710", "R"), (20, "720", "R")]


def test_a_later_payload_supersedes_earlier_ones(spark, tmp_path):
    tables = _order_tables(spark)
    first = _day(spark, tables, tmp_path, 2)
    _link_supplier(spark, first)
    first.orders()
    more = with_order(spark, tables, 20, 2)
    second = _day(spark, more, tmp_path, 3)
    second.orders()
    second.take_results("orden_compra", done(spark, 10, 20))
    assert second.pending().count() == 0 and second.state().where("entity = 'orden_compra'").first().last_ts == dt.datetime(2024, 6, 2)
    newer = second.links("orden_compra").where("NRO_OC = 10").first()
    late = _body(spark, ORDER_DONE.replace('"70"', '"old"'))
    assert second.take_results("orden_compra", late, stamp=first.stamp) == {"orden_compra": 1}
    assert second.links("orden_compra").where("NRO_OC = 10").first() == newer  # as of an earlier payload
    assert second.state().where("entity = 'orden_compra'").first().last_ts == dt.datetime(2024, 6, 2)


def test_results_in_parts_and_of_other_payloads(spark, tmp_path):
    more = with_order(spark, _order_tables(spark), 20, 2)
    run = _day(spark, more, tmp_path, 3)
    _link_supplier(spark, run)
    assert run.orders() == {"create": 2}
    assert run.take_results("orden_compra", done(spark, 10, 99)) == {"orden_compra": 1}  # no payload holds order 99
    assert run.links("orden_compra").count() == 1 and run.pending().count() == 1 and run.state().where("entity = 'orden_compra'").count() == 0
    assert run.take_results("orden_compra", done(spark, 20)) == {"orden_compra": 1}
    assert run.pending().count() == 0 and run.state().where("entity = 'orden_compra'").first().last_ts == dt.datetime(2024, 6, 2)


def test_results_after_a_reset_move_nothing(spark, tmp_path):
    tables = _order_tables(spark)
    run = _day(spark, tables, tmp_path, 2)
    _link_supplier(spark, run)
    run.orders()
    run.reset("orden_compra")
    run.take_results("orden_compra", done(spark, 10), stamp=run.stamp)
    assert run.state().where("entity = 'orden_compra'").count() == 0 and run.links("orden_compra").count() == 1


def test_rejected_duplicates_are_linked_by_their_tax_ids(spark, tmp_path):
    tables = _all_tables(spark)
    more = {6: "27-00000000-1", 7: "bad", 8: "30-11111111-2"}
    for code, tax in more.items():
        tables["PROVEEDORES"] = tables["PROVEEDORES"].union(tables["PROVEEDORES"].where("COD_PROV = 5").withColumns({"COD_PROV": F.lit(code), "CUIT": F.lit(tax)}))
    directory = spark.createDataFrame([("60", "27000000001"), ("61", None), ("62", "20-12345678-9")], "id string, cuit string")
    exists = lambda code: {"success": False, "external_id": {"cod_prov": code}, "validationErrors": {"cuit": ["Ya EXISTE un proveedor", "con ese CUIT"]}}
    good = {"success": True, "id": "80", "external_id": {"cod_prov": 8}}
    other = {"success": False, "external_id": {"cod_prov": 5}, "validationErrors": {"cuit": ["no es valido"]}}
    body = lambda rows, errors: _body(spark, json.dumps({"stats": {"proveedores": {"ok": 1, "error": errors}}, "results": {"proveedores": rows}}))

    run = _day(spark, tables, tmp_path, 2)
    assert run.suppliers() == 4
    with pytest.raises(RuntimeError, match="proveedores"):
        run.take_results("proveedores", body([good, exists(6)], 1))  # without a directory
    with pytest.raises(RuntimeError, match="proveedores"):
        run.take_results("proveedores", body([good, exists(6), other], 2), directory=directory)  # an error of another kind
    with pytest.raises(RuntimeError, match="proveedores"):
        run.take_results("proveedores", body([good, exists(6), exists(7)], 2), directory=directory)  # one that the directory lacks
    assert run.links("proveedores").count() == 0
    assert run.take_results("proveedores", body([good, exists(6), exists(5)], 2), directory=directory) == {"proveedores": 3}
    assert sorted((r.COD_PROV, r.remote_id, r.cuit) for r in run.links("proveedores").collect()) == [(5, "62", "20123456789"), (6, "60", "27000000001"), (8, "80", "30111111112")]
    assert run.pending().count() == 1  # supplier 7 has no answer
    assert _day(spark, tables, tmp_path, 3).feed() == {"create": 1, "skip": 3}


def test_batch_sizes_by_entity(spark, tmp_path):
    tables = _all_tables(spark)
    run = Run(spark, tables, str(tmp_path), as_of=dt.datetime(2024, 6, 2), batch=1, batches={"jurisdicciones": 500})
    assert run.units() == 6 and run.suppliers() == 1
    sizes = lambda path: sorted(len(next(v for v in json.loads(r.value).values() if isinstance(v, list) and v)) for r in spark.read.text(f"{tmp_path}/payloads/{path}").collect())
    assert sizes("jurisdicciones/20240602_000000/rubros") == [2] and sizes("proveedores/20240602_000000/proveedores") == [1]


def test_counts_come_with_the_write(spark, tmp_path):
    """What a run decided is counted by the job that writes it: no other job reads the decisions."""
    run = _day(spark, _order_tables(spark), tmp_path, 2)
    docs = spark.range(100).select("id", F.when(F.col("id") % 4 == 0, "create").otherwise("same").alias("action"))
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("decided"))
    spark.sparkContext.setJobGroup("decided", "decided")
    _, counts = run.decided(docs, "test", ("create", "same", "cancel"))
    assert counts == {"create": 25, "same": 75} and jobs() == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert run.decided(docs.limit(0), "none", ("create",))[1] == {}


def test_changed_rows_filter_scans_before_they_are_aggregated(spark, tmp_path):
    oc, items, sg = _purchases(spark)
    for name, df in (("items", items.unionByName(items.withColumn("EJERCICIO", F.lit(2020)))), ("sg", sg)):
        df.write.parquet(f"{tmp_path}/{name}")
    items, sg = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("items", "sg"))
    changed = sg.where("NRO_SOLIC = 7")
    lines = extracts.touched(items, changed, {k: k for k in extracts.EXPENSE})
    assert sorted((r.NRO_OC, r.ITEM_OC) for r in lines.collect()) == [(10, 2), (11, 1), (12, 1)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = extracts.expense_extract(changed, lines, oc)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert {r.NRO_SOLIC: r.OC_COD_PROV for r in found.collect()} == {7: 5}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "GreaterThanOrEqual(EJERCICIO,2024), LessThanOrEqual(EJERCICIO,2024)" in plan and "might_contain" in plan
    assert extracts.touched(items, changed.limit(0), {k: k for k in extracts.EXPENSE}).count() == 0


def test_overlaps_and_profiles(spark):
    a = spark.createDataFrame([(1, "x", 0.0, None), (2, "y", -0.0, None), (None, "x", 1.5, None)], "k int, t string, f double, n string")
    b = spark.createDataFrame([(1, "1", True), (2, "2", None), (3, "x", None)], "id long, t string, flag boolean")
    found = audits.value_overlaps({"a": a, "b": b})
    assert sorted(tuple(r) for r in found.collect()) == [("a.k", "b.id", 2, 3, 2), ("a.t", "b.t", 2, 3, 1)]
    assert [(r.column, r.referenced, r.share) for r in audits.likely_relations(found).collect()] == [("a.k", "b.id", 1.0)]
    with pytest.raises(ValueError):
        audits.value_overlaps({"c": b.select("flag")})
    exact = {r.column_name: (r.printed_type, r.n_filled, r.n_distinct) for r in audits.column_profile(a, "a").collect()}
    assert exact == {"k": ("NUMBER(10)", 2, 2), "t": ("VARCHAR2", 3, 2), "f": ("NUMBER", 3, 2), "n": ("VARCHAR2", 0, 0)}
    assert {r.n_filled for r in audits.column_profile(a.limit(0), "a").collect()} == {0}
    parts = [audits.profile_sketches(x, "a", name) for name, x in (("1", a.where("k = 1")), ("2", a.where("k = 2 OR k IS NULL")), ("3", a.limit(0)))]
    merged = {r.column_name: (r.n_snapshots, r.n_rows, r.n_filled, r.about_distinct) for r in audits.merged_profile(parts[0].union(parts[1]).union(parts[2])).collect()}
    assert merged == {c: (3, 3, n, d) for c, (_, n, d) in exact.items()}
    large = spark.range(200_000).select((F.col("id") % 50_000).alias("v"))
    halves = [audits.profile_sketches(large.where(f"id % 2 = {n}"), "l", str(n)) for n in (0, 1)]
    (row,) = audits.merged_profile(halves[0].union(halves[1])).collect()
    assert abs(row.about_distinct - 50_000) < 0.05 * 50_000
    typed = spark.createDataFrame([], "d decimal(15,2), w decimal(9,0), c date, s short, l array<int>")
    assert [audits.printed_type(f) for f in typed.schema] == ["NUMBER(15,2)", "NUMBER(9,0)", "DATE", "NUMBER(5)", "ARRAY<INT>"]


def test_a_stream_that_ended_and_began_again_leaves_the_same_state(spark, tmp_path):
    tables = _order_tables(spark)
    wide = with_order(spark, tables, 20, 2)
    wide["ORDEN_COMPRA"] = wide["ORDEN_COMPRA"].unionByName(wide["ORDEN_COMPRA"].where("NRO_OC = 10").withColumns({"NRO_OC": F.lit(30), "ESTADO_OC": F.lit("A")}))
    wide["OC_ITEMS"] = wide["OC_ITEMS"].unionByName(wide["OC_ITEMS"].where("NRO_OC = 10").withColumn("NRO_OC", F.lit(30)))
    source = str(tmp_path / "in")
    for n in (10, 20, 30):
        wide["ORDEN_COMPRA"].where(f"NRO_OC = {n}").coalesce(1).write.mode("append").parquet(source)

    def stream(folder, step):
        run_on_arrival(spark, source, wide["ORDEN_COMPRA"].schema, "orden_compra", step, wide, folder, f"{folder}/checkpoint", files_per_trigger=1, run={"batch": 1, "buckets": 2})

    def state(folder):
        run = _day(spark, wide, folder, 9, buckets=2)
        links = sorted(tuple(r) for r in run.links("orden_compra").collect())
        pending = sorted(tuple(r) for r in run.pending().collect())
        sent = sorted((s.stamp, r.key) for s in run.pending().collect() for r in run.sent("orden_compra", s.stamp).collect())
        payloads = sorted(r.value for r in spark.read.text(f"{folder}/payloads/orden_compra/*/ordenes_compra").collect())
        return links, pending, sent, payloads, run.link_store("orden_compra").manifest().version

    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    for folder in (whole, broken):
        _link_supplier(spark, _day(spark, wide, folder, 1, buckets=2))
    stream(whole, Run.orders)
    done_once = []

    def lost(run):
        run.orders()
        if run.stamp.endswith("1") and not done_once:
            done_once.append(run.stamp)
            raise RuntimeError("lost after the step")

    with pytest.raises(Exception, match="lost after the step"):
        stream(broken, lost)
    stream(broken, lost)
    assert done_once and state(broken) == state(whole)
    run = _day(spark, wide, whole, 9, buckets=2)
    first, second = (r.stamp for r in run.pending().orderBy("stamp").collect())
    run.take_results("orden_compra", done(spark, 10, 20), stamp=second)
    assert [r.stamp for r in run.pending().collect()] == [first]  # apart from each other: the first waits for its own


def test_results_name_links_by_the_time_of_their_payload(spark, tmp_path):
    tables = _all_tables(spark)
    run = _day(spark, tables, tmp_path, 2)
    run.suppliers()
    _day(spark, tables, tmp_path, 5).take_results("proveedores", _result(spark, "proveedores", cod_prov=5))
    assert run.links("proveedores").first().updated_at == dt.datetime(2024, 6, 2)


def test_old_files_of_runs_go(spark, tmp_path):
    tables = _order_tables(spark)
    run = _day(spark, tables, tmp_path, 2)
    _link_supplier(spark, run)
    run.orders()
    later = _day(spark, tables, tmp_path, 3)
    later.orders()
    assert later.forget(dt.datetime(2024, 6, 3)) == 0  # the first payload is pending
    later.take_results("orden_compra", done(spark, 10))
    assert later.forget(dt.datetime(2024, 6, 3)) == 6
    assert later.sent("orden_compra", run.stamp).count() == 0 and later.sent("orden_compra", later.stamp).count() == 1
    assert later.links("orden_compra").count() == 1 and (tmp_path / "payloads/orden_compra/20240603_000000").exists()


def test_withholdings_are_found_once_for_what_many_payments_settle(spark, tmp_path):
    """Texts of 2 codes are looked at, not of 300 withholdings for each of 200 payments; of two numbers that one payment settles the last counts."""
    tables = _all_tables(spark)
    tables["RETENCIONES"] = spark.range(300).select(
        F.lit(2024).alias("EJERCICIO"), F.lit(7).alias("NRO_CANCE"), (3 + 2 * (F.col("id") % 2)).cast("int").alias("COD_RET"),
        F.format_string("%03d", "id").alias("CUENTA"), F.when(F.col("id") < 298, F.col("id") + 0.5).otherwise(0.0).alias("IMPORTE"),
    ).unionByName(spark.createDataFrame([(2024, 8, 3, "999", 1.25), (2024, 9, 3, "999", 4.0)], "EJERCICIO int, NRO_CANCE int, COD_RET int, CUENTA string, IMPORTE double"))
    payments = spark.range(200).select(F.lit(2024).alias("EJERCICIO"), F.col("id").cast("int").alias("NRO_OP"), F.lit(7).alias("NRO_CANCE")).unionByName(spark.createDataFrame([(2024, 0, 8)], "EJERCICIO int, NRO_OP int, NRO_CANCE int"))
    last = documents.last_withholdings(tables["RETENCIONES"].withColumn("ordinal", F.struct("CUENTA", "IMPORTE")), payments, ["EJERCICIO", "NRO_CANCE"])
    assert sorted((r.NRO_CANCE, r.COD_RET, r.IMPORTE) for r in last.collect()) == [(7, 3, 296.5), (7, 5, 297.5), (8, 3, 1.25)]
    found = _day(spark, tables, tmp_path, 2).withholdings(payments)
    amounts = {(r.NRO_OP, r.cod_ret): (float(r.monto_retenido), r.numero_certificado, r.tipo, r.tipo_impuesto_name) for r in found.collect()}
    assert len(amounts) == 400 and amounts[0, "3"] == (1.25, "RET-2024-0-3", "iva", None)
    assert amounts[9, "3"] == (296.5, "RET-2024-9-3", "iva", None) and amounts[9, "5"] == (297.5, "RET-2024-9-5", None, "Other")


def _shuffles(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(k).getName() for k in range(found.size())) if name.startswith("shuffle_")}


def _left_since(spark, before):
    for _ in range(50):  # files are removed by messages
        if not (left := _shuffles(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_runs_leave_no_shuffle_files(spark, tmp_path):
    """Of the jobs of a run and of its results, shuffle files go with each job: they are most of a run's disk."""
    tables = _order_tables(spark)
    run = _day(spark, tables, tmp_path, 2)
    before = _shuffles(spark)
    _link_supplier(spark, run)
    assert run.orders() == {"create": 1}
    assert run.take_results("orden_compra", _body(spark, ORDER_DONE)) == {"orden_compra": 1}
    assert not _left_since(spark, before)


def test_run_links_leaves_no_shuffle_files(spark):
    """Over the test tables, before the links are read: neither the run nor its results leave any."""
    before = _shuffles(spark)
    links = registry.queries()["run_links"](spark, "/root/testdata/sf0.001")
    assert not _left_since(spark, before) and links.where("remote_id <> ''").count()


def test_payloads_are_gzipped_lines(spark, tmp_path):
    run = _day(spark, _order_tables(spark), tmp_path, 2)
    _link_supplier(spark, run)
    run.orders()
    (file,) = [p for p in (tmp_path / "payloads/orden_compra/20240602_000000/ordenes_compra").iterdir() if p.name.startswith("part-") and p.stat().st_size > 50]
    (line,) = gzip.decompress(file.read_bytes()).decode().splitlines()
    (doc,) = json.loads(line)["ordenes_compra"]
    assert json.loads(doc)["external_id"] == {"ejercicio": 2024, "uni_compra": 1, "nro_oc": 10}
    assert all(p.name.endswith(".zstd.parquet") for p in (tmp_path / "decided/orden_compra/20240602_000000").iterdir() if p.name.startswith("part-"))


def test_suppliers_are_found_for_orders_and_not_for_lines(spark, tmp_path):
    """The same documents, with no exchange of lines by their supplier or after their headers; what is stored on the way goes."""
    oc, items, sg = _purchases(spark)
    suppliers = spark.createDataFrame([(5, "50")], "COD_PROV int, remote_id string")
    units = spark.createDataFrame([], "JURISDICCION string, centro_costo_id int, rubro_id int")
    links = spark.createDataFrame([], "ref string, remote_id string")
    known = documents.with_suppliers(oc, suppliers)
    docs = documents.order_documents(extracts.order_extract(known, items, sg), None, units, links)
    same = documents.order_documents(extracts.order_extract(oc, items, sg), suppliers, units, links)
    columns = sorted(docs.columns)
    assert docs.count() and sorted(map(str, docs.select(columns).collect())) == sorted(map(str, same.select(columns).collect()))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = extracts.with_header(known, extracts.with_unit(items, sg))
        nested = documents.nested(lines, extracts.ORDER, ["COD_PROV"], F.col("ITEM_OC"), [F.col("ITEM_OC")])
        exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(EJERCICIO")
        assert exchanges(nested) == exchanges(lines) == 4  # lines and expenses by expense, headers and lines by order
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    run = _day(spark, _order_tables(spark), tmp_path, 2)
    _link_supplier(spark, run)
    shared = shared_dir(spark).removeprefix("file://")
    run.orders()
    assert not [n for n in os.listdir(shared) if n.startswith(("orders-", "lines-", "units-"))]


def test_an_orders_header_is_exchanged_once_for_all_its_jobs(spark, tmp_path, monkeypatch):
    """Orders with their suppliers are stored: the jobs that need them neither join suppliers again nor read other orders."""
    tables = _order_tables(spark)
    seen = []
    monkeypatch.setattr(extracts, "order_header", lambda orders, f=extracts.order_header: f(seen.append(orders) or orders))
    run = _day(spark, with_order(spark, tables, 20, 2), tmp_path, 2)
    _link_supplier(spark, run)
    assert run.orders() == {"create": 2}
    lines = _day(spark, with_order(spark, tables, 20, 2) | {"OC_ITEMS": tables["OC_ITEMS"].where("NRO_OC = 10")}, tmp_path / "lines", 2)
    _link_supplier(spark, lines)
    assert lines.order_lines() == {"create": 1}
    assert len(seen) == 2 and not any("Join" in x._jdf.queryExecution().optimizedPlan().toString() for x in seen)


def test_temporary_tables_go(spark):
    inner = []
    with temporary(spark):
        inner.append(stored(spark.range(3), "x").inputFiles()[0])
        kept = stored(spark.range(4), "x", keep=True)
        with temporary(spark):
            inner.append(stored(spark.range(3), "y").inputFiles()[0])
    import os

    assert not any(os.path.exists(p.removeprefix("file://")) for p in inner) and kept.count() == 4

"""Reconciliation and run state over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import extracts, incremental, reconcile, rows
from tributary.plans.bindings import roles, with_roles
from tributary.plans.registry import demo, table
from tributary.sources.payloads import section_errors
from tributary.specs import ENTITIES

ACTIONS = """, p AS (SELECT NRO_OC AS p_oc, estado_oc AS prev, remote_id FROM oc_link),
    a AS (SELECT oc.*, CASE WHEN ESTADO_OC = 'R' AND coalesce(prev, '') <> 'R' THEN 'create' WHEN ESTADO_OC = 'R' AND NRO_OC % 4 = 0 AND NRO_OC % 8 <> 0 THEN 'resend' WHEN ESTADO_OC = 'R' THEN 'same'
    WHEN ESTADO_OC = 'A' AND coalesce(prev, '') = 'R' AND coalesce(remote_id, '') <> '' THEN 'cancel' ELSE 'register' END AS action FROM oc LEFT JOIN p ON p_oc = NRO_OC)"""


def _actions(spark, sf_dir):
    oc, links = roles(spark, sf_dir, "oc oc_link")
    joined = oc.join(links.select(*extracts.ORDER, F.col("estado_oc").alias("_previous"), "remote_id"), extracts.ORDER, "left")
    ids = lambda n: F.when(F.col("NRO_OC") % n == 0, F.concat(F.lit("7"), "NRO_OC"))
    return joined.withColumn("action", reconcile.order_action(F.col("ESTADO_OC"), F.col("_previous"), F.col("remote_id"), ids(4), ids(8)))


@demo(with_roles("oc oc_link", f"{ACTIONS} SELECT NRO_OC, ESTADO_OC, action FROM a"))
def po_action_classification(spark, sf_dir):
    return _actions(spark, sf_dir).select("NRO_OC", "ESTADO_OC", "action")


@demo(with_roles("oc oc_link", f"{ACTIONS} SELECT action, count(*) AS n FROM a GROUP BY action"))
def action_counts(spark, sf_dir):
    return rows.counts(_actions(spark, sf_dir), "action")


@demo(with_roles("oc oc_link", f"{ACTIONS} SELECT NRO_OC, action, CASE WHEN action = 'cancel' THEN 4 ELSE 1 END AS estado_aprobacion FROM a WHERE action IN ('create', 'resend', 'cancel')"))
def send_list_union(spark, sf_dir):
    decided = _actions(spark, sf_dir)
    create = decided.where("action IN ('create', 'resend')").select("NRO_OC", "action", F.lit(1).alias("estado_aprobacion"))
    cancel = decided.where("action = 'cancel'").select("NRO_OC", "action", F.lit(4).alias("estado_aprobacion"))
    return create.unionByName(cancel)


@demo(with_roles("oc oc_link", f"{ACTIONS} SELECT NRO_OC, ESTADO_OC AS estado_oc, coalesce(p.remote_id, '') AS remote_id FROM a LEFT JOIN p ON p_oc = NRO_OC WHERE action IN ('register', 'same')"))
def register_only_upsert(spark, sf_dir):
    _, links = roles(spark, sf_dir, "oc oc_link")
    quiet = _actions(spark, sf_dir).where("action IN ('register', 'same')").select(*extracts.ORDER, F.col("ESTADO_OC").alias("estado_oc"))
    return reconcile.keep_target(quiet, links, extracts.ORDER).select("NRO_OC", "estado_oc", "remote_id")


def _changes(oc):
    return oc.where("NRO_OC % 2 = 0").select(*extracts.ORDER, F.col("ESTADO_OC").alias("estado_oc"), F.concat(F.lit("n"), "NRO_OC").alias("remote_id"), F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"))


NEW = "n AS (SELECT NRO_OC, ESTADO_OC AS estado_oc, concat('n', NRO_OC) AS remote_id FROM oc WHERE NRO_OC % 2 = 0)"
UPSERTED = "SELECT NRO_OC, estado_oc, remote_id FROM n UNION ALL SELECT NRO_OC, estado_oc, remote_id FROM oc_link WHERE NRO_OC % 2 <> 0"


@demo(with_roles("oc oc_link", f", {NEW} {UPSERTED}"))
def upsert_latest_wins(spark, sf_dir):
    oc, links = roles(spark, sf_dir, "oc oc_link")
    return reconcile.upsert(links, _changes(oc), extracts.ORDER).select("NRO_OC", "estado_oc", "remote_id")


@demo(with_roles("oc oc_link", f", {NEW}, u AS ({UPSERTED}) SELECT NRO_OC, estado_oc, CASE WHEN NRO_OC % 2 = 0 THEN 'refs' END AS gasto_refs FROM u"))
def schema_evolution_union(spark, sf_dir):
    oc, links = roles(spark, sf_dir, "oc oc_link")
    return reconcile.upsert(links, _changes(oc).withColumn("gasto_refs", F.lit("refs")), extracts.ORDER).select("NRO_OC", "estado_oc", "gasto_refs")


@demo(with_roles("oc oc_link", f", {NEW} SELECT NRO_OC, remote_id FROM oc_link UNION ALL SELECT NRO_OC, remote_id FROM n WHERE NRO_OC NOT IN (SELECT NRO_OC FROM oc_link)"))
def insert_if_absent(spark, sf_dir):
    oc, links = roles(spark, sf_dir, "oc oc_link")
    return reconcile.insert_absent(links, _changes(oc), extracts.ORDER).select("NRO_OC", "remote_id")


@demo("SELECT c_custkey, forced, CASE WHEN c_custkey % 2 <> 0 THEN 'create' WHEN forced THEN 'update' ELSE 'skip' END AS action FROM customer, (SELECT true AS forced UNION ALL SELECT false)")
def create_update_skip(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    links = customers.where("c_custkey % 2 = 0").select("c_custkey", F.lit(True).alias("_linked"))
    joined = customers.select("c_custkey", F.explode(F.array(F.lit(True), F.lit(False))).alias("forced")).join(links, "c_custkey", "left")
    return joined.select("c_custkey", "forced", reconcile.feed_action(F.coalesce("_linked", F.lit(False)), F.col("forced")).alias("action"))


@demo("SELECT max(o_orderkey) AS last_id, max(o_orderdate) AS last_ts, count(*) AS records FROM orders")
def cursor_max(spark, sf_dir):
    import dataclasses

    spec = dataclasses.replace(ENTITIES["orden_compra"], id_column="o_orderkey", ts_column="o_orderdate")
    return incremental.cursor_values(table(spark, sf_dir, "orders"), spec)


def _state(spark, sf_dir):
    """A state row for each order status but one, its cursor from the orders of the first half."""
    early = table(spark, sf_dir, "orders").where("o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00' AND o_orderstatus <> 'P'")
    return early.groupBy(F.col("o_orderstatus").alias("entity")).agg(
        F.lit(None).cast("long").alias("last_id"), F.max("o_orderdate").alias("last_ts"), F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("last_run"), F.count(F.lit(1)).alias("records_sent"), F.lit("ok").alias("status")
    )


STATE = "st AS (SELECT o_orderstatus AS entity, max(o_orderdate) AS last_ts, count(*) AS records_sent, 'ok' AS status FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00' AND o_orderstatus <> 'P' GROUP BY 1)"


def _specs(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("entity"), (F.col("o_orderstatus") == "O").alias("full_load")).distinct()


@demo(f"WITH {STATE} SELECT entity, CASE WHEN entity = 'O' OR last_ts IS NULL THEN 'FULL' ELSE 'INCREMENTAL' END AS mode FROM (SELECT DISTINCT o_orderstatus AS entity FROM orders) LEFT JOIN st USING (entity)")
def run_mode(spark, sf_dir):
    return incremental.run_mode(_state(spark, sf_dir), _specs(spark, sf_dir))


@demo(f"WITH {STATE} SELECT entity, last_ts, records_sent, coalesce(status, 'pending') AS status FROM (SELECT DISTINCT o_orderstatus AS entity FROM orders) LEFT JOIN st USING (entity)")
def status_report(spark, sf_dir):
    return incremental.status_report(_specs(spark, sf_dir), _state(spark, sf_dir)).select("entity", "last_ts", "records_sent", "status")


@demo(
    f"""WITH {STATE}, late AS (SELECT o_orderstatus AS entity, max(o_orderdate) AS new_ts, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' AND o_orderstatus <> 'O' GROUP BY 1)
    SELECT coalesce(late.entity, st.entity) AS entity, coalesce(new_ts, last_ts) AS last_ts, coalesce(n, records_sent) AS records_sent FROM st FULL JOIN late ON st.entity = late.entity"""
)
def advance_cursor(spark, sf_dir):
    late = table(spark, sf_dir, "orders").where("o_orderdate >= TIMESTAMP_NTZ '1999-01-01 00:00:00' AND o_orderstatus <> 'O'")
    runs = late.groupBy(F.col("o_orderstatus").alias("entity")).agg(
        F.lit(None).cast("long").alias("last_id"), F.max("o_orderdate").alias("last_ts"), F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("run_at"), F.count(F.lit(1)).alias("records")
    )
    return incremental.succeeded(_state(spark, sf_dir), runs).select("entity", "last_ts", "records_sent")


@demo(f"WITH {STATE} SELECT entity, last_ts, CASE WHEN entity = 'F' THEN 'error: lost' ELSE status END AS status FROM st")
def error_keeps_cursor(spark, sf_dir):
    return incremental.failed(_state(spark, sf_dir), "F", "lost").select("entity", "last_ts", "status")


@demo(
    """SELECT 'orden_pago' AS entity, 'ESTADO_OP' AS column_name, count(*) AS n_rows FROM events UNION ALL SELECT 'orden_pago', 'FECH_OP', count(*) FROM events
    UNION ALL SELECT 'orden_compra', 'ESTADO_OC', count(*) FROM orders"""
)
def cursor_column_check(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "FECH_OC")
    return incremental.missing_cursors({"orden_pago": table(spark, sf_dir, "events"), "orden_compra": orders}, ENTITIES)


@demo(f"WITH {STATE} SELECT entity, CASE WHEN entity IN ('F', 'P') OR entity = 'O' THEN 'FULL' ELSE 'INCREMENTAL' END AS mode FROM (SELECT DISTINCT o_orderstatus AS entity FROM orders) LEFT JOIN st USING (entity)")
def reset_runs_full(spark, sf_dir):
    return incremental.run_mode(incremental.reset(_state(spark, sf_dir), "F"), _specs(spark, sf_dir))


@demo("WITH s AS (SELECT event_type AS section, count(*) FILTER (WHERE value > 90) AS errors FROM events GROUP BY 1) SELECT coalesce(string_agg(section, ',' ORDER BY section), '') AS failing, count(*) AS n_failing FROM s WHERE errors > 0")
def error_gate(spark, sf_dir):
    stats = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("section")).agg(F.count_if(F.col("value") > 90).alias("errors"))
    return section_errors(stats)

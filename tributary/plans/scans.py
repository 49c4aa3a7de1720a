"""Scans, sinks, filters and limits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import incremental, rows
from tributary.plans.bindings import role, roles, with_roles
from tributary.plans.registry import demo, table
from tributary.sources import payloads, snapshots
from tributary.specs import ENTITIES
from tributary.streaming.intake import take_in
from tributary.workspace import new_path

LAST_TS, AS_OF = "2000-01-01 00:00:00", "2001-08-01 00:00:00"


@demo("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_snapshot_scan(spark, sf_dir):
    folder = new_path(spark, "csv")
    snapshots.write_csv(table(spark, sf_dir, "nation"), folder)
    raw = snapshots.read_csv_snapshot(spark, folder)
    return raw.select(F.col("N_NATIONKEY").cast("int").alias("n_nationkey"), F.col("N_NAME").alias("n_name"), F.col("N_REGIONKEY").cast("int").alias("n_regionkey"))


@demo("SELECT c_custkey, c_name, CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS DOUBLE) AS c_acctbal FROM customer")
def csv_roundtrip(spark, sf_dir):
    folder = new_path(spark, "csv")
    snapshots.write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(15,2)")), folder)
    raw = snapshots.read_csv_snapshot(spark, folder)
    return raw.select(F.col("C_CUSTKEY").cast("long").alias("c_custkey"), F.col("C_NAME").alias("c_name"), F.col("C_ACCTBAL").cast("decimal(15,2)").alias("c_acctbal"))


@demo("SELECT o_orderkey, o_orderdate, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS o_totalprice, CAST(NULL AS INTEGER) AS o_orderpriority, CAST(NULL AS INTEGER) AS o_absent FROM orders")
def typed_snapshot(spark, sf_dir):
    """Text columns as types: what does not fit, and what is missing, is null."""
    folder = new_path(spark, "csv")
    snapshots.write_csv(table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(15,2)")), folder)
    raw = snapshots.read_csv_snapshot(spark, folder).withColumnsRenamed({c.upper(): c for c in ("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")})
    wanted = "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice decimal(15,2), o_orderpriority int, o_absent int"
    return snapshots.typed(raw, T.StructType.fromDDL(wanted))


@demo("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey")
def latest_snapshot_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return rows.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@demo("SELECT concat('seg_', lower(c_mktsegment)) AS entity, concat('seg_', lower(c_mktsegment), '_20240101_', lpad(CAST(max(c_custkey) AS VARCHAR), 6, '0'), '.csv') AS name FROM customer GROUP BY c_mktsegment")
def latest_snapshot_files(spark, sf_dir):
    text = F.concat(F.lit("seg_"), F.lower("c_mktsegment"), F.lit("_20240101_"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"))
    named = table(spark, sf_dir, "customer").select(F.explode(F.array(F.concat(text, F.lit(".csv")), F.concat(text, F.lit(".txt")), F.lit("other.csv"))).alias("name"))
    return snapshots.latest_snapshots(named)


@demo("SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def project_allowlist(spark, sf_dir):
    kept, _ = snapshots.allowed_columns(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderdate", "o_absent"])
    return kept


@demo("SELECT 'orders' AS table_name, 'o_orderstatus' AS column_name, 3 AS place, 'dropped' AS change, count(o_orderstatus) AS n_filled FROM orders UNION ALL SELECT 'orders', 'o_totalprice', 4, 'dropped', count(o_totalprice) FROM orders UNION ALL SELECT 'orders', 'o_orderpriority', 6, 'dropped', count(o_orderpriority) FROM orders UNION ALL SELECT 'orders', 'o_absent', NULL, 'missing', 0 UNION ALL SELECT 'customer', 'c_acctbal', 4, 'dropped', count(c_acctbal) FROM customer")
def columns_at_intake(spark, sf_dir):
    """What the allow-lists of two tables drop and miss."""
    allowed = {"orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_absent"], "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"], "nation": ["n_nationkey", "n_name", "n_regionkey"]}
    return snapshots.column_changes(spark, {t: table(spark, sf_dir, t) for t in allowed}, allowed)


@demo("SELECT s_suppkey AS S_SUPPKEY, s_name AS S_NAME, s_nationkey AS S_NATIONKEY, s_acctbal AS S_ACCTBAL FROM supplier")
def table_scan_upper(spark, sf_dir):
    return snapshots.read_table(spark, sf_dir, "supplier")


@demo("SELECT o_orderkey, 'none' AS o_clerk FROM orders")
def optional_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.coalesce(snapshots.optional_column(orders, "o_clerk", "string"), F.lit("none")).alias("o_clerk"))


@demo("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 90 DAYS")
def rolling_window_extract(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return snapshots.rolling_window(orders, "o_orderdate", F.lit(AS_OF).cast("timestamp_ntz"), 3)


BATCHES = "n AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS batch FROM orders)"


def _numbered(spark, sf_dir):
    """All orders in batches, with all their columns and a wide one."""
    docs = table(spark, sf_dir, "orders").withColumn("wide", F.sha2(F.col("o_orderkey").cast("string"), 512))
    return payloads.batch_numbers(docs, ["o_orderkey"], 500)


@demo(f"WITH {BATCHES} SELECT CAST(batch AS BIGINT) AS batch, count(*) AS n_docs, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM n GROUP BY batch")
def payload_batches(spark, sf_dir):
    measures = [F.count(F.lit(1)).alias("n_docs"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), F.count("wide").alias("_wide")]
    return _numbered(spark, sf_dir).groupBy("batch").agg(*measures).drop("_wide")


@demo(f"WITH {BATCHES} SELECT CAST(batch AS BIGINT) AS batch, false AS dry_run, true AS upsert, count(*) AS n_docs, CAST(sum(o_orderkey) AS BIGINT) AS keys, 0 AS n_others FROM n GROUP BY batch")
def payload_envelopes(spark, sf_dir):
    found = payloads.envelopes(_numbered(spark, sf_dir), "ordenes_compra", F.to_json(F.struct("o_orderkey", "wide")), dry_run=False, options={"upsert": True})
    sections = ", ".join(f"{c} array<string>" for c in payloads.SECTIONS)
    parsed = F.from_json("payload", f"dry_run boolean, options struct<upsert: boolean>, {sections}").alias("p")
    keys = F.aggregate(F.transform("p.ordenes_compra", lambda d: F.get_json_object(d, "$.o_orderkey").cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    others = sum(F.size(f"p.{c}") for c in payloads.SECTIONS if c != "ordenes_compra")
    return found.select("batch", parsed).select("batch", "p.dry_run", "p.options.upsert", F.size("p.ordenes_compra").cast("long").alias("n_docs"), keys.alias("keys"), others.alias("n_others"))


@demo("SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(900000 + o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 10 <> 0")
def explode_results(spark, sf_dir):
    row = F.struct(
        (F.col("o_orderkey") % 10 != 0).alias("success"),
        (F.col("o_orderkey") + 900000).cast("string").alias("id"),
        F.struct(F.col("o_orderkey").cast("string").alias("nro_oc")).alias("external_id"),
    )
    json = F.to_json(F.struct(F.struct(F.array(row).alias("ordenes_compra")).alias("results")))
    results = table(spark, sf_dir, "orders").select(json.alias("body"))
    found = payloads.import_results(results, "body", "ordenes_compra")
    return found.select(F.col("external_id")["nro_oc"].alias("order_key"), "id")


@demo("SELECT 'rubros' AS section, count(*) AS n FROM nation UNION ALL SELECT 'tipos', count(*) FROM nation UNION ALL SELECT 'absent', NULL")
def catalog_sections(spark, sf_dir):
    folder = new_path(spark, "catalogs")
    for section, under in (("rubros", False), ("tipos", True)):
        own = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
        listed = table(spark, sf_dir, "nation").agg(F.sort_array(F.collect_list(own)).alias(section))
        body = F.struct(F.struct(section).alias("lookups")) if under else F.struct(section)
        listed.select(F.to_json(body).alias("value")).coalesce(1).write.text(f"{folder}/{section}.json")
    found, failed = payloads.read_catalogs(spark, folder, ("rubros", "tipos", "absent"))
    counts = [t.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("section"), "n") for s, t in found.items()]
    lost = [spark.range(1).select(F.lit(s).alias("section"), F.lit(None).cast("long").alias("n")) for s in failed]
    out = counts[0]
    for more in counts[1:] + lost:
        out = out.unionByName(more)
    return out


@demo("SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 8")
def sample_recent_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(8)


@demo("SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey DESC LIMIT 8")
def sample_suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").orderBy(F.desc("s_suppkey")).limit(8)


def _state():
    import datetime

    return {"last_id": None, "last_ts": datetime.datetime.fromisoformat(LAST_TS)}


def _changed(spark, sf_dir):
    return incremental.changed_rows(role(spark, sf_dir, "oc"), ENTITIES["orden_compra"], _state(), F.lit(AS_OF).cast("timestamp_ntz"))


CHANGED = """(FECH_OC > TIMESTAMP '2000-01-01 00:00:00' OR (ESTADO_OC = 'N' AND FECH_OC > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 30 DAYS))"""


@demo(with_roles("oc", f"SELECT NRO_OC, ESTADO_OC, FECH_OC FROM oc WHERE {CHANGED}"))
def incremental_filter(spark, sf_dir):
    return _changed(spark, sf_dir).select("NRO_OC", "ESTADO_OC", "FECH_OC")


@demo(with_roles("oc", "SELECT NRO_OC, FECH_OC FROM oc WHERE ESTADO_OC = 'N' AND FECH_OC > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 30 DAYS"))
def pending_lookback(spark, sf_dir):
    window = incremental.pending_window(ENTITIES["orden_compra"], F.lit(AS_OF).cast("timestamp_ntz"))
    return role(spark, sf_dir, "oc").where(window).select("NRO_OC", "FECH_OC")


@demo(
    with_roles(
        "oc",
        f", c AS (SELECT * FROM oc WHERE {CHANGED}), l AS (SELECT max(FECH_OC) AS m FROM (SELECT FECH_OC FROM c ORDER BY FECH_OC, NRO_OC LIMIT 100)) SELECT NRO_OC, FECH_OC FROM c, l WHERE FECH_OC <= m",
    )
)
def limited_incremental(spark, sf_dir):
    return incremental.limited(_changed(spark, sf_dir), "FECH_OC", ("NRO_OC",), 100).select("NRO_OC", "FECH_OC")


@demo(with_roles("sg", "SELECT NRO_SOLIC FROM sg WHERE ESTADO_SOLIC <> 'A'"))
def exclude_cancelled(spark, sf_dir):
    from tributary.functions.exprs import status_code

    return role(spark, sf_dir, "sg").where(status_code("ESTADO_SOLIC") != "A").select("NRO_SOLIC")


@demo("SELECT c_custkey, CAST(substr(c_name, 10) AS INT) AS number FROM customer WHERE c_custkey % 7 <> 0 AND TRY_CAST(substr(c_name, 10) AS INT) IS NOT NULL")
def drop_incomplete_keys(spark, sf_dir):
    text = F.when(F.col("c_custkey") % 7 != 0, F.substring("c_name", 10, 100))
    return rows.with_whole_key(table(spark, sf_dir, "customer"), {"number": text}).select("c_custkey", F.col("number").cast("int").alias("number"))


@demo("SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority FROM orders WHERE TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) IS NOT NULL AND o_totalprice IS NOT NULL")
def required_values(spark, sf_dir):
    priority = F.substring("o_orderpriority", 1, 1).try_cast("int")
    return rows.required(table(spark, sf_dir, "orders"), F.col("o_totalprice"), priority).select("o_orderkey", priority.alias("priority"))


@demo("SELECT o_orderkey, count(l_orderkey) AS n_items FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def docs_with_items(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return rows.with_items(orders, lines, {"o_orderkey": "l_orderkey"}).select("o_orderkey", "n_items")


@demo(with_roles("op", "SELECT NRO_OP, CAST(IMPORTE_TOTAL AS DOUBLE) AS IMPORTE_TOTAL FROM op WHERE EJERCICIO = 2024 AND NRO_CANCE = 7"))
def param_filter(spark, sf_dir):
    return spark.sql("SELECT NRO_OP, IMPORTE_TOTAL FROM {op} WHERE EJERCICIO = :year AND NRO_CANCE = :number", args={"year": 2024, "number": 7}, op=role(spark, sf_dir, "op"))


@demo("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_totalprice, o_orderkey LIMIT 20")
def top_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.desc("o_orderdate"), "o_totalprice", "o_orderkey").limit(20)


@demo("SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS total FROM events GROUP BY event_type")
def stream_snapshot_intake(spark, sf_dir):
    events, out = table(spark, sf_dir, "events"), new_path(spark, "intake")
    folder = f"{out}/files"
    events.repartition(4).write.parquet(folder)

    def keep(batch, number):
        batch.select("event_type", "value").write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    take_in(spark, folder, events.schema, keep, f"{out}/checkpoint", files_per_trigger=2)
    kept = spark.read.schema("event_type string, value double, batch int").parquet(f"{out}/rows")
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(15,2)")).alias("total"))


@demo(
    with_roles(
        "oc items sg",
        """SELECT 'orden_compra' AS entity, count(*) AS n FROM oc UNION ALL SELECT 'oc_items', count(*) FROM items
        UNION ALL SELECT 'solic_gastos', count(*) FROM sg""",
    )
)
def extract_summary(spark, sf_dir):
    oc, items, sg = roles(spark, sf_dir, "oc items sg")
    return rows.table_counts({"orden_compra": oc, "oc_items": items, "solic_gastos": sg})

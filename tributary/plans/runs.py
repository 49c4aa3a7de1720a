"""Whole runs over the test tables: ledgers, keyed state, what changed rows reach, and runs on arriving files."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tributary.operators import extracts, ledger, lookups
from tributary.operators.state import KeyedStore
from tributary.plans.bindings import role, roles, with_roles
from tributary.plans.pipeline import Run
from tributary.plans.registry import demo, table
from tributary.plans.state import NEW, UPSERTED, _changes
from tributary.sources import payloads
from tributary.specs import DUPLICATE
from tributary.streaming.intake import run_on_arrival
from tributary.workspace import new_path

# Ledger.

SENT = "s AS (SELECT 'p1' AS payload, o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'p2', o_orderkey FROM orders WHERE o_orderkey % 3 = 0)"
DONE = "c AS (SELECT 'p1' AS payload, o_orderkey AS k FROM orders WHERE o_orderkey % 4 = 0 UNION ALL SELECT 'p2', o_orderkey FROM orders WHERE o_orderkey % 5 = 0)"


@demo(
    f"""WITH {SENT}, {DONE} SELECT s.payload, s.k AS o_orderkey, CASE WHEN c.k IS NOT NULL THEN 'confirmed' WHEN s.payload < max(s.payload) OVER (PARTITION BY s.k) THEN 'superseded' ELSE 'open' END AS state
    FROM s LEFT JOIN c ON c.payload = s.payload AND c.k = s.k"""
)
def payload_ledger(spark, sf_dir):
    """Keys of two payloads that overlap, given results of each, some of which it does not hold."""
    orders = table(spark, sf_dir, "orders")
    keys = lambda name, n: orders.where(F.col("o_orderkey") % n == 0).select(F.lit(name).alias("payload"), F.lit("orders").alias("section"), ledger.key_text({"k": F.col("o_orderkey")}).alias("key"))
    states = ledger.states(keys("p1", 2).unionByName(keys("p2", 3)), keys("p1", 4).unionByName(keys("p2", 5)))
    return states.select("payload", F.substr("key", F.lit(3)).cast("long").alias("o_orderkey"), "state")


def _order_run(spark, sf_dir, folder, day, **how):
    oc, items, sg, jur = roles(spark, sf_dir, "oc items sg jur")
    return Run(spark, {"ORDEN_COMPRA": oc, "OC_ITEMS": items, "SOLIC_GASTOS": sg, "JURISDICCIONES": jur}, folder, as_of=datetime.datetime(2002, 1, day), batch=1000, buckets=8, **how)


def _with_suppliers(run):
    links = role(run.spark, run.sf_dir, "prov_link").withColumn("updated_at", F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    run.save_links("proveedores", links.select(F.col("COD_PROV").cast("int").alias("COD_PROV"), "remote_id", "updated_at"))
    return run


def _first_run(spark, sf_dir, folder, **how):
    run = _order_run(spark, sf_dir, folder, 1)
    run.sf_dir = sf_dir
    return _with_suppliers(run)


def _answers(run, stamp, n):
    """Import results of every order of a payload whose number ``n`` divides, as one document a thousand orders."""
    number = F.regexp_extract("key", r"nro_oc=(\d+)", 1).cast("long")
    parts = [F.regexp_extract("key", rf"{k}=(\d+)", 1).alias(k) for k in ("ejercicio", "uni_compra", "nro_oc")]
    row = F.struct(F.lit(True).alias("success"), F.concat(F.lit("7"), number).alias("id"), F.struct(*parts).alias("external_id"))
    rows = run.sent("orden_compra", stamp).where(number % n == 0).groupBy(F.floor(number / 1000)).agg(F.collect_list(row).alias("ordenes_compra"))
    return rows.select(F.to_json(F.struct(F.struct("ordenes_compra").alias("results"))).alias("body"))


RUN = """, d AS (SELECT DISTINCT EJERCICIO, UNI_COMPRA, NRO_OC, ESTADO_OC FROM oc JOIN items USING (EJERCICIO, UNI_COMPRA, NRO_OC) JOIN prov_link USING (COD_PROV) WHERE CANTIDAD IS NOT NULL)"""


@demo(
    with_roles(
        "oc items prov_link",
        f"""{RUN} SELECT '20020101_000000' AS payload, NRO_OC, CASE WHEN NRO_OC % 4 = 0 THEN 'confirmed' ELSE 'superseded' END AS state FROM d WHERE ESTADO_OC = 'R'
        UNION ALL SELECT '20020102_000000', NRO_OC, CASE WHEN NRO_OC % 3 = 0 THEN 'confirmed' ELSE 'open' END FROM d WHERE ESTADO_OC = 'R'""",
    )
)
def run_ledger(spark, sf_dir):
    """Two runs of orders before any results, then results of the first payload for one order in four, and of the second for one in three."""
    folder = new_path(spark, "run")
    first = _first_run(spark, sf_dir, folder)
    first.orders()
    second = _order_run(spark, sf_dir, folder, 2)
    second.orders()
    stamps = [first.stamp, second.stamp]
    for stamp, n in zip(stamps, (4, 3), strict=True):
        second.take_results("orden_compra", _answers(second, stamp, n), stamp=stamp)
    both = [[run(second)("orden_compra", s).withColumn("payload", F.lit(s)) for s in stamps] for run in (lambda r: r.sent, lambda r: r.confirmed)]
    states = ledger.states(*(a.unionByName(b) for a, b in both))
    return states.select("payload", F.regexp_extract("key", r"nro_oc=(\d+)", 1).cast("long").alias("NRO_OC"), "state")


@demo(
    with_roles(
        "oc items prov_link",
        f"""{RUN}, a AS (SELECT *, CASE WHEN NRO_OC % 4 = 0 AND ESTADO_OC = 'R' THEN concat('7', NRO_OC) ELSE '' END AS remote_id FROM d)
        SELECT NRO_OC, ESTADO_OC AS estado_oc, remote_id FROM a WHERE ESTADO_OC <> 'R' OR remote_id <> ''""",
    )
)
def run_links(spark, sf_dir):
    """The link state after one run of orders and results for one order in four: sent orders only if confirmed, others registered."""
    run = _first_run(spark, sf_dir, new_path(spark, "run"))
    run.orders()
    run.take_results("orden_compra", _answers(run, run.stamp, 4))
    return run.links("orden_compra").select("NRO_OC", "estado_oc", "remote_id")


@demo(with_roles("oc items prov_link", f"{RUN} SELECT CASE WHEN ESTADO_OC = 'R' THEN 'create' ELSE 'register' END AS action, count(*) AS n, 0 AS n_links, 0 AS n_pending, 0 AS n_states FROM d GROUP BY 1"))
def dry_run_orders(spark, sf_dir):
    """A dry run decides and writes payloads, and keeps no link, payload or cursor."""
    folder = new_path(spark, "run")
    _first_run(spark, sf_dir, folder)
    run = _order_run(spark, sf_dir, folder, 2, dry_run=True)
    run.orders()
    decided = spark.read.parquet(f"{folder}/decided/orden_compra/{run.stamp}")
    kept = [F.lit(x.count()).alias(n) for n, x in (("n_links", run.links("orden_compra")), ("n_pending", run.pending()), ("n_states", run.state()))]
    return decided.groupBy("action").agg(F.count(F.lit(1)).alias("n")).select("action", "n", *kept)


@demo(
    """SELECT c_custkey AS COD_PROV, CAST(9000 + c_custkey AS VARCHAR) AS remote_id FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 0"""
)
def rejected_duplicates(spark, sf_dir):
    """Suppliers rejected because their tax id exists, linked to those of the target's directory that have it.

    One customer in three is rejected as a duplicate, one for another reason; the directory knows every second one.
    """
    tax = F.concat(F.lit("20-"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit("-1"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("COD_PROV"), tax.alias("cuit"))
    said = F.when(F.col("COD_PROV") % 3 == 0, F.lit("Ya existe un proveedor con ese CUIT")).when(F.col("COD_PROV") % 3 == 1, F.lit("CUIT no valido"))
    fields = F.when(said.isNotNull(), F.create_map(F.lit("cuit"), F.array(said)))
    row = F.struct(said.isNull().alias("success"), F.struct(F.col("COD_PROV").cast("string").alias("cod_prov")).alias("external_id"), fields.alias("validationErrors"))
    bodies = customers.groupBy(F.floor(F.col("COD_PROV") / 500)).agg(F.collect_list(row).alias("proveedores")).select(F.to_json(F.struct(F.struct("proveedores").alias("results"))).alias("body"))
    rejected = payloads.rejected_duplicates(bodies, "body", "proveedores", *DUPLICATE).select(F.col("external_id")["cod_prov"].cast("int").alias("COD_PROV"))
    directory = customers.where("COD_PROV % 2 = 0").select((9000 + F.col("COD_PROV")).cast("string").alias("id"), F.regexp_replace("cuit", "-", "").alias("cuit"))
    found = lookups.match_by_digits(rejected.join(customers, "COD_PROV"), "cuit", directory, "cuit", "id", "remote_id")
    return found.where("remote_id IS NOT NULL").select("COD_PROV", "remote_id")


# Keyed state.


def _keyed(spark, sf_dir):
    oc, links = roles(spark, sf_dir, "oc oc_link")
    store = KeyedStore(spark, new_path(spark, "state"), extracts.ORDER, buckets=16, most_deltas=2)
    store.write(links)
    changes = _changes(oc)
    for n in range(3):  # the last of them finds two deltas, and merges
        store.write(changes.where(F.col("NRO_OC") % 3 == n))
    return store


@demo(with_roles("oc oc_link", f", {NEW} {UPSERTED}"))
def keyed_state(spark, sf_dir):
    """As ``upsert_latest_wins``, through a bucketed table with deltas: a base and three writes."""
    return _keyed(spark, sf_dir).read().select("NRO_OC", "estado_oc", "remote_id")


@demo(with_roles("oc oc_link", f", {NEW}, u AS ({UPSERTED}) SELECT NRO_OC, estado_oc, remote_id FROM u WHERE NRO_OC % 1000 = 0"))
def keyed_state_lookup(spark, sf_dir):
    """The state of a few keys, read from their buckets only."""
    keys = role(spark, sf_dir, "oc").where("NRO_OC % 1000 = 0").select(*extracts.ORDER)
    return _keyed(spark, sf_dir).read(keys).join(keys, extracts.ORDER, "left_semi").select("NRO_OC", "estado_oc", "remote_id")


# What changed rows reach.


@demo(
    with_roles(
        "sg items oc",
        """, s AS (SELECT EJERCICIO, DELEG_SOLIC, NRO_SOLIC, min(COD_PROV) AS m FROM items JOIN oc USING (EJERCICIO, UNI_COMPRA, NRO_OC) GROUP BY ALL)
        SELECT NRO_SOLIC, m AS OC_COD_PROV FROM sg LEFT JOIN s USING (EJERCICIO, DELEG_SOLIC, NRO_SOLIC) WHERE FECH_SOLIC >= '2001-08-01'""",
    )
)
def changed_expenses(spark, sf_dir):
    """Changed expenses with their least supplier, from the lines that refer to them only."""
    sg, items, oc = roles(spark, sf_dir, "sg items oc")
    changed = sg.where("FECH_SOLIC >= '2001-08-01'")
    return extracts.expense_extract(changed, extracts.touched(items, changed, {k: k for k in extracts.EXPENSE}), oc).select("NRO_SOLIC", "OC_COD_PROV")


@demo(
    with_roles(
        "oc items sg",
        """SELECT DISTINCT NRO_OC, NRO_SOLIC, COD_PROV, FECH_OC FROM items JOIN sg USING (EJERCICIO, DELEG_SOLIC, NRO_SOLIC) JOIN oc USING (EJERCICIO, UNI_COMPRA, NRO_OC) WHERE FECH_SOLIC >= '2001-08-01'""",
    )
)
def changed_traces(spark, sf_dir):
    """The rows of the trace view that changed expenses have, from their lines only."""
    oc, items, sg = roles(spark, sf_dir, "oc items sg")
    changed = sg.where("FECH_SOLIC >= '2001-08-01'")
    trace = extracts.trace_view(extracts.touched(items, changed, {k: k for k in extracts.EXPENSE}), changed, oc)
    return trace.select(F.col("OC_NRO_OC").alias("NRO_OC"), F.col("SG_NRO").alias("NRO_SOLIC"), F.col("OC_COD_PROV").alias("COD_PROV"), F.col("FECH_HOJA").alias("FECH_OC"))


# Arriving files.


@demo(with_roles("oc items prov_link", f"{RUN} SELECT CASE WHEN ESTADO_OC = 'R' THEN 'create' ELSE 'register' END AS action, count(*) AS n FROM d GROUP BY 1"))
def stream_run_orders(spark, sf_dir):
    """Runs of orders on files as they arrive: what the runs of all batches decided."""
    folder = new_path(spark, "run")
    run = _first_run(spark, sf_dir, folder)
    orders = run.tables["ORDEN_COMPRA"]
    orders.repartition(4, "NRO_OC").write.parquet(f"{folder}/files")
    run_on_arrival(spark, f"{folder}/files", orders.schema, "orden_compra", Run.orders, run.tables, folder, f"{folder}/checkpoint", files_per_trigger=2, run={"buckets": 8})
    decided = spark.read.parquet(f"{folder}/decided/orden_compra/arrivals-*")
    return decided.groupBy("action").agg(F.count(F.lit(1)).alias("n"))

"""Catalog and quality queries over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators import audits, rows
from tributary.plans.registry import demo, table

ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}
PRINTED = {"bigint": "NUMBER(19)", "string": "VARCHAR2", "double": "NUMBER", "timestamp_ntz": "DATE"}
MAPPED = ["o_orderkey", "o_custkey", "o_orderdate", "o_comment"]


@demo("\nUNION ALL ".join(f"SELECT 'orders' AS table_name, {n + 1} AS place, '{c}' AS column_name, '{ORDERS[c]}' AS type, '{PRINTED[ORDERS[c]]}' AS printed_type, true AS nullable, CAST(NULL AS VARCHAR) AS default_value, CAST(NULL AS VARCHAR) AS comment, count({c}) AS n_filled, count(DISTINCT {c}) AS n_distinct FROM orders" for n, c in enumerate(ORDERS)))
def column_profile(spark, sf_dir):
    return audits.column_profile(table(spark, sf_dir, "orders").select(*ORDERS), "orders")


@demo(
    "\nUNION ALL ".join(
        [f"SELECT 'orders' AS table_name, '{c}' AS column_name, {str(c in MAPPED).lower()} AS mapped, true AS found, count({c}) / count(*) AS fill_rate FROM orders" for c in ORDERS]
        + ["SELECT 'orders', 'o_comment', true, false, NULL FROM (SELECT 1)"]
    )
)
def mapping_coverage(spark, sf_dir):
    return audits.mapping_coverage(table(spark, sf_dir, "orders").select(*ORDERS), "orders", MAPPED)


@demo("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_violations(spark, sf_dir):
    return audits.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


RELATIONS = [
    ("lineitem_orders", "lineitem", "l_orderkey", "orders", "o_orderkey", "true"),
    ("lineitem_part", "lineitem", "l_partkey", "part", "p_partkey", "true"),
    ("orders_customer", "orders", "o_custkey", "customer", "c_custkey", "c_acctbal >= 0"),
    ("events_customer", "events", "user_id", "customer", "c_custkey", "c_acctbal >= 0"),
    ("customer_nation", "customer", "c_nationkey", "nation", "n_nationkey", "true"),
]


@demo("\nUNION ALL ".join(f"SELECT '{n}' AS relation, count({a}) AS n_rows, count(CASE WHEN {a} NOT IN (SELECT {b} FROM {p} WHERE {w}) THEN 1 END) AS n_orphans FROM {c}" for n, c, a, p, b, w in RELATIONS))
def fk_orphans(spark, sf_dir):
    return audits.orphan_counts([(n, table(spark, sf_dir, c), [a], table(spark, sf_dir, p).where(w), [b]) for n, c, a, p, b, w in RELATIONS])


PAIRS = [
    ("l_partkey=p_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
    ("o_custkey=c_custkey", "orders", "o_custkey", "customer", "c_custkey"),
    ("user_id=c_custkey", "events", "user_id", "customer", "c_custkey"),
    ("l_suppkey=s_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
]


@demo("\nUNION ALL ".join(f"SELECT '{n}' AS pair, count(DISTINCT {a}) AS n_left, count(DISTINCT CASE WHEN {a} IN (SELECT {b} FROM {r}) THEN {a} END) AS n_matched FROM {t}" for n, t, a, r, b in PAIRS))
def inferred_relations(spark, sf_dir):
    """The pairs by their names, taken out of all that the values of these columns show."""
    columns = {}
    for _, left, a, right, b in PAIRS:
        columns.setdefault(left, set()).add(a)
        columns.setdefault(right, set()).add(b)
    found = audits.value_overlaps({t: table(spark, sf_dir, t).select(*sorted(cs)) for t, cs in columns.items()})
    both = found.select(F.col("left_column").alias("a"), F.col("right_column").alias("b"), F.col("n_left").alias("n"), "n_shared")
    both = both.unionByName(found.select(F.col("right_column").alias("a"), F.col("left_column").alias("b"), F.col("n_right").alias("n"), "n_shared"))
    named = spark.createDataFrame([(n, f"{left}.{a}", f"{right}.{b}") for n, left, a, right, b in PAIRS], "pair string, a string, b string")
    return named.join(both, ["a", "b"]).select("pair", F.col("n").alias("n_left"), F.col("n_shared").alias("n_matched"))


#: Columns of the test tables whose values can be compared, by family.
COMPARABLE = {
    "number": "lineitem.l_orderkey lineitem.l_partkey lineitem.l_suppkey lineitem.l_linenumber orders.o_orderkey orders.o_custkey customer.c_custkey customer.c_nationkey part.p_partkey part.p_size supplier.s_suppkey supplier.s_nationkey nation.n_nationkey nation.n_regionkey region.r_regionkey events.event_id events.user_id",
    "text": "lineitem.l_returnflag lineitem.l_linestatus orders.o_orderstatus orders.o_orderpriority customer.c_name customer.c_mktsegment part.p_name part.p_brand part.p_type supplier.s_name nation.n_name region.r_name events.event_type events.props",
    "time": "lineitem.l_shipdate orders.o_orderdate events.ts",
}
VALUES = "\nUNION ALL ".join(f"SELECT DISTINCT '{family}' AS f, '{c}' AS c, CAST({c.split('.')[1]} AS VARCHAR) AS v FROM {c.split('.')[0]}" for family, cs in COMPARABLE.items() for c in cs.split())
OVERLAPS = f"""v AS ({VALUES}), k AS (SELECT * FROM v WHERE v IS NOT NULL), n AS (SELECT c, count(*) AS n FROM k GROUP BY c),
    o AS (SELECT a.c AS left_column, b.c AS right_column, any_value(x.n) AS n_left, any_value(y.n) AS n_right, count(*) AS n_shared
    FROM k a JOIN k b ON a.f = b.f AND a.v = b.v AND a.c < b.c JOIN n x ON x.c = a.c JOIN n y ON y.c = b.c GROUP BY 1, 2)"""


def _overlaps(spark, sf_dir):
    return audits.value_overlaps({t: table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "part", "supplier", "nation", "region", "events")})


@demo(f"WITH {OVERLAPS} SELECT left_column, right_column, n_left, n_right, n_shared FROM o")
def discovered_overlaps(spark, sf_dir):
    """All pairs of columns that share values, as their schemas and values show."""
    return _overlaps(spark, sf_dir)


@demo(
    f"""WITH {OVERLAPS}, s AS (SELECT left_column AS column, right_column AS referenced, n_left AS n, n_shared / n_left AS share FROM o UNION ALL SELECT right_column, left_column, n_right, n_shared / n_right FROM o)
    SELECT "column", referenced, share FROM s WHERE share >= 0.95 AND n >= 2"""
)
def discovered_relations(spark, sf_dir):
    return audits.likely_relations(_overlaps(spark, sf_dir))


def _snapshots(spark, sf_dir):
    """The orders as three snapshots, by year of order."""
    orders = table(spark, sf_dir, "orders").select(*ORDERS)
    year = F.year("o_orderdate")
    parts = {"a": year < 1998, "b": (year >= 1998) & (year < 2000), "c": year >= 2000}
    return [audits.profile_sketches(orders.where(when), "orders", name) for name, when in parts.items()]


@demo("\nUNION ALL ".join(f"SELECT '{c}' AS column_name, 3 AS n_snapshots, count(*) AS n_rows, count({c}) AS n_filled, true AS near FROM orders" for c in ORDERS))
def merged_profile(spark, sf_dir):
    """Profiles of three snapshots, merged by their sketches; ``near``: the estimate is within 8 % of the exact number."""
    first, *rest = _snapshots(spark, sf_dir)
    merged = audits.merged_profile(reduce(DataFrame.unionByName, rest, first))
    exact = audits.column_profile(table(spark, sf_dir, "orders").select(*ORDERS), "orders").select("column_name", "n_distinct")
    near = F.abs(F.col("about_distinct") - F.col("n_distinct")) <= 0.08 * F.col("n_distinct")
    return merged.join(exact, "column_name").select("column_name", "n_snapshots", "n_rows", "n_filled", near.alias("near"))


@demo("\nUNION ALL ".join(f"SELECT '{n}' AS relation, '{c}' AS table_name, '{a}' AS columns, '{p}({b})' AS referenced, (SELECT count(*) FROM {c}) AS n_rows" for n, c, a, p, b, _ in RELATIONS))
def key_listing(spark, sf_dir):
    listed = audits.key_listing(spark, {}, [(n, c, [a], p, [b]) for n, c, a, p, b, _ in RELATIONS]).where("kind = 'foreign'")
    names = spark.createDataFrame([(n, c, a) for n, c, a, *_ in RELATIONS], "relation string, table_name string, columns string")
    sizes = rows.table_counts({c: table(spark, sf_dir, c) for c in {r[1] for r in RELATIONS}}).select(F.col("entity").alias("table_name"), F.col("n").alias("n_rows"))
    return listed.join(names, ["table_name", "columns"]).join(sizes, "table_name").select("relation", "table_name", "columns", "referenced", "n_rows")


@demo("SELECT o_orderkey, o_totalprice FROM orders WHERE abs(o_totalprice) > 400000")
def amount_overflow(spark, sf_dir):
    return audits.amount_overflow(table(spark, sf_dir, "orders"), "o_totalprice", 400_000).select("o_orderkey", F.col("o_totalprice"))

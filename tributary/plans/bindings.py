"""The purchasing tables' roles, filled from the test tables: as DataFrames, and as SQL for the same rows.

The year of an order follows from its number, as the test lines carry no year of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CENT = "CAST({} AS DECIMAL(15,2))"

#: One SELECT for each role, valid in Spark and in DuckDB.
ROLES = {
    "prov": """SELECT c_custkey AS COD_PROV, c_name AS RAZON_SOCIAL, c_nationkey AS NATION, c_mktsegment AS SEGMENT,
        CAST(c_acctbal AS DECIMAL(15,2)) AS SALDO FROM customer""",
    "master": "SELECT c_custkey AS COD_PROV, c_name AS RAZON_SOCIAL FROM customer WHERE c_acctbal >= 0",
    "jur": "SELECT CAST(n_nationkey AS VARCHAR(10)) AS JURISDICCION, n_name AS DENOMINACION, n_regionkey AS REGION FROM nation",
    "sg": """SELECT CAST(1995 + p_partkey % 7 AS INT) AS EJERCICIO, CAST(p_partkey % 4 AS INT) AS DELEG_SOLIC, p_partkey AS NRO_SOLIC,
        CAST(p_partkey % 25 AS VARCHAR(10)) AS JURISDICCION, CAST(p_retailprice AS DECIMAL(15,2)) AS IMPORTE_TOT, p_type AS TIPO_DOC,
        p_size AS NRO_DOC, p_name AS OBSERVACIONES, CASE WHEN p_partkey % 11 = 0 THEN 'A' ELSE 'N' END AS ESTADO_SOLIC,
        CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CONCAT('2001-0', CAST(1 + p_size % 9 AS VARCHAR(2)), '-15 10:30:00') END AS FECH_SOLIC,
        CASE WHEN p_partkey % 3 = 0 THEN '2001-11-30 00:00:00' END AS FECH_NECESIDAD, '2001-12-31' AS FECH_ENTREGA FROM part""",
    "oc": """SELECT CAST(1995 + o_orderkey % 7 AS INT) AS EJERCICIO, CAST(1 + o_orderkey % 3 AS INT) AS UNI_COMPRA, o_orderkey AS NRO_OC,
        o_orderdate AS FECH_OC, o_custkey AS COD_PROV, CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'N' ELSE 'A' END AS ESTADO_OC,
        CAST(NULL AS TIMESTAMP) AS FECH_CONFIRM, o_orderpriority AS OBSERVACIONES, CAST(o_totalprice AS DECIMAL(15,2)) AS IMPORTE_TOT FROM orders""",
    "items": """SELECT CAST(1995 + l_orderkey % 7 AS INT) AS EJERCICIO, CAST(1 + l_orderkey % 3 AS INT) AS UNI_COMPRA, l_orderkey AS NRO_OC,
        l_linenumber AS ITEM_OC, CAST(l_partkey % 4 AS INT) AS DELEG_SOLIC, l_partkey AS NRO_SOLIC, CAST(l_quantity AS DECIMAL(10,3)) AS CANTIDAD,
        CAST(l_extendedprice AS DECIMAL(15,2)) AS IMP_UNITARIO, CONCAT('part ', CAST(l_partkey AS VARCHAR(20)), ' ', l_returnflag) AS DESCRIPCION,
        l_suppkey AS LINE_PROV FROM lineitem""",
    "op": """SELECT 2024 AS EJERCICIO, event_id AS NRO_OP, ts AS FECH_OP, user_id AS COD_PROV, CAST(user_id % 25 AS VARCHAR(10)) AS JURISDICCION,
        CASE event_type WHEN 'purchase' THEN 'C' WHEN 'error' THEN 'A' ELSE 'N' END AS ESTADO_OP, CAST(value AS DECIMAL(15,2)) AS IMPORTE_TOTAL,
        CAST({json}(props, '$.k') AS INT) AS NRO_CANCE, event_id AS RECO_DEU_COMPRA, CAST(1995 + (event_id + event_id % 2) % 7 AS INT) AS RECO_DEU_COMPRA_EJER,
        event_type AS CONCEPTO FROM events""",
    "ret": """SELECT l_partkey AS NRO_CANCE, l_linenumber AS COD_RET, l_orderkey AS ORDINAL, l_shipdate AS FECHA,
        CAST(CAST(l_tax AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS IMPORTE FROM lineitem""",
    "ded": "SELECT r_regionkey AS CODIGO, r_name AS DESCRIPCION FROM region",
    "ped": """SELECT CAST(1995 + o_orderkey % 7 AS INT) AS EJERCICIO, o_orderkey AS NUM_PED, o_orderdate AS FECH_EMI, o_orderpriority AS OBSERVACIONES,
        CAST(o_custkey % 25 AS VARCHAR(10)) AS CODIGO_DEP, CAST(o_totalprice AS DECIMAL(15,2)) AS COSTO_TOT FROM orders""",
    "ped_items": """SELECT CAST(1995 + l_orderkey % 7 AS INT) AS EJERCICIO, l_orderkey AS NUM_PED, l_linenumber AS ORDEN, CAST(l_quantity AS DECIMAL(10,3)) AS CANTIDAD,
        CAST(l_partkey % 25 AS VARCHAR(10)) AS JURISDICCION, CONCAT('part ', CAST(l_partkey AS VARCHAR(20))) AS DESCRIP_BIE,
        CAST(l_extendedprice AS DECIMAL(15,2)) AS COSTO_UNI FROM lineitem""",
    "prov_link": "SELECT c_custkey AS COD_PROV, CAST(10000 + c_custkey AS VARCHAR(20)) AS remote_id FROM customer WHERE c_custkey % 3 <> 0",
    "unit_link": """SELECT CAST(n_nationkey AS VARCHAR(10)) AS JURISDICCION, CAST(100 + n_nationkey AS INT) AS centro_costo_id, CAST(200 + n_nationkey AS INT) AS rubro_id,
        CAST(300 + n_nationkey AS INT) AS clasificacion_id FROM nation WHERE n_nationkey % 5 <> 0""",
    "sg_link": """SELECT CONCAT('SG-', CAST(1995 + p_partkey % 7 AS VARCHAR(10)), '-', CAST(p_partkey % 4 AS VARCHAR(10)), '-', CAST(p_partkey AS VARCHAR(20))) AS ref,
        CAST(500000 + p_partkey AS VARCHAR(20)) AS remote_id, p_partkey AS NRO_SOLIC FROM part WHERE p_partkey % 3 = 0""",
    "oc_link": """SELECT CAST(1995 + o_orderkey % 7 AS INT) AS EJERCICIO, CAST(1 + o_orderkey % 3 AS INT) AS UNI_COMPRA, o_orderkey AS NRO_OC,
        CASE WHEN o_orderkey % 2 = 0 THEN 'R' ELSE 'N' END AS estado_oc, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(900000 + o_orderkey AS VARCHAR(20)) END AS remote_id,
        TIMESTAMP_NTZ '2001-01-01 00:00:00' AS updated_at FROM orders WHERE o_orderkey % 3 = 0""",
}


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a role; views are registered under names of their own, so that runs over other folders do not meet."""
    import re

    sql = ROLES[name].replace("{json}", "get_json_object").replace("VARCHAR(10)", "STRING").replace("VARCHAR(20)", "STRING").replace("VARCHAR(2)", "STRING").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
    table = re.search(r"FROM (\w+)", sql)[1]
    return spark.sql(re.sub(r"FROM (\w+)", r"FROM {source}", sql), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def roles(spark: SparkSession, sf_dir: str, names: str) -> list[DataFrame]:
    return [role(spark, sf_dir, n) for n in names.split()]


def with_roles(names: str, query: str) -> str:
    """DuckDB SQL: ``query`` over the named roles. Add other named queries in ``names`` by starting ``query`` with a comma."""
    fixed = lambda s: s.replace("{json}", "json_extract_string").replace("TIMESTAMP_NTZ '", "TIMESTAMP '")
    return "WITH " + ",\n".join(f"{n} AS ({fixed(ROLES[n])})" for n in names.split()) + "\n" + query

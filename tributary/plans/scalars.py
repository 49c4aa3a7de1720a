"""Scalar expressions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import exprs as E
from tributary.plans.bindings import role, with_roles
from tributary.plans.registry import demo, table

PADDED = "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN '  ' ELSE concat(' ', c_name, chr(10)) END"


def _padded():
    key = F.col("c_custkey") % 7
    return F.when(key == 0, None).when(key == 1, "  ").otherwise(F.concat(F.lit(" "), "c_name", F.lit("\n")))


@demo("SELECT c_custkey, CASE WHEN c_custkey % 7 > 1 THEN c_name END AS name FROM customer")
def expr_clean(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", E.clean(_padded()).alias("name"))


@demo("SELECT c_custkey, CASE WHEN c_custkey % 7 > 1 THEN c_name ELSE c_mktsegment END AS name FROM customer")
def expr_first_non_empty(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", E.first_non_empty(_padded(), "c_mktsegment").alias("name"))


@demo("SELECT c_custkey, concat('20', regexp_replace(c_name, '[^0-9]', '', 'g')) AS digits FROM customer")
def expr_digits_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", E.digits_key(F.concat(F.lit("20-"), "c_name")).alias("digits"))


@demo("SELECT c_custkey, CASE WHEN c_custkey % 7 > 1 THEN concat(c_name, ' ', c_custkey) ELSE CAST(c_custkey AS VARCHAR) END AS address FROM customer")
def expr_concat_nonempty(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", E.join_non_empty(_padded(), "c_custkey").alias("address"))


@demo("SELECT c_custkey, CASE WHEN c_custkey % 7 > 1 THEN c_name WHEN c_custkey % 2 = 0 THEN concat('54 ', c_nationkey) ELSE c_mktsegment END AS phone FROM customer")
def expr_concat_fallback(spark, sf_dir):
    second = F.when(F.col("c_custkey") % 2 == 0, "54")
    nation = F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", E.first_phone((_padded(),), (second, nation), mobile="c_mktsegment").alias("phone"))


@demo("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 6 END AS iva_condicion_id FROM customer")
def expr_code_map(spark, sf_dir):
    codes = F.element_at(F.array(*map(F.lit, ("rins", " CF ", "Rni", "other"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", E.code_map(codes, E.VAT_CONDITIONS, upper=True).alias("iva_condicion_id"))


@demo("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 7 WHEN 1 THEN 1 ELSE 8 END AS centro_costo_id FROM nation")
def expr_code_map_default(spark, sf_dir):
    code = F.element_at(F.array(*map(F.lit, ("1110101000", "1110104000", "9"))), (F.col("n_nationkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "nation").select("n_nationkey", E.code_map(code, E.UNIT_COST_CENTRES, E.OTHER_COST_CENTRE).alias("centro_costo_id"))


@demo("SELECT c_custkey, CASE WHEN c_custkey % 7 > 1 THEN concat('{\"name\":\"', c_name, '\",\"nation\":', c_nationkey, '}') ELSE concat('{\"nation\":', c_nationkey, '}') END AS doc FROM customer")
def doc_drop_nulls(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.to_json(F.struct(E.clean(_padded()).alias("name"), F.col("c_nationkey").alias("nation"))).alias("doc"))


@demo("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS INT) END AS number FROM orders")
def expr_try_int(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), "o_orderkey", F.lit(" "))).when(F.col("o_orderkey") % 3 == 1, F.concat("o_orderkey", F.lit(".0x"))).otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", E.to_int(text).alias("number"))


@demo("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def expr_date_only(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 7 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "orders").select("o_orderkey", E.date_only(text).alias("day"))


@demo("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS parsed FROM orders")
def expr_parse_ts(spark, sf_dir):
    key = F.col("o_orderkey")
    text = F.when(key % 7 == 0, "soon").when(key % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "orders").select("o_orderkey", E.parse_timestamp(text).alias("parsed"))


@demo(r"SELECT doc_id, trim(regexp_replace(strip_accents(lower(regexp_replace(text, '[^A-Za-zÀ-ÖØ-öø-ÿ0-9 .,|\n]', '', 'g'))), '[^\p{L}\p{N}]+', ' ', 'g')) AS normal FROM documents")
def expr_normalize_text(spark, sf_dir):
    plain = F.regexp_replace("text", r"[^A-Za-zÀ-ÖØ-öø-ÿ0-9 .,|\n]", "")
    return table(spark, sf_dir, "documents").select("doc_id", E.normalize_text(plain).alias("normal"))


@demo("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN concat('123456789', o_orderkey) ELSE lpad(CAST(o_orderkey AS VARCHAR), 8, '0') END AS factura_nro FROM orders")
def expr_zfill(spark, sf_dir):
    key = F.col("o_orderkey") % 7
    text = F.when(key == 0, "0").when(key == 1, F.concat(F.lit("123456789"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", E.zero_padded(text).alias("factura_nro"))


@demo("SELECT doc_id, substr(text, 1, 255) AS cut FROM documents")
def expr_truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", E.truncated("text", 255).alias("cut"))


@demo("SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(CAST(l_extendedprice AS DECIMAL(15,3)) * 1.005 AS DECIMAL(15,2)) AS DOUBLE) AS amount FROM lineitem")
def expr_round_money(spark, sf_dir):
    raised = (F.col("l_extendedprice").cast("decimal(15,3)") * F.lit("1.005").cast("decimal(4,3)")).cast("string")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", E.money(raised).alias("amount"))


@demo(with_roles("sg", "SELECT NRO_SOLIC, concat('SG-', EJERCICIO, '-', DELEG_SOLIC, '-', NRO_SOLIC) AS ref FROM sg"))
def expr_build_ref(spark, sf_dir):
    return role(spark, sf_dir, "sg").select("NRO_SOLIC", E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC").alias("ref"))


@demo(with_roles("sg", "SELECT NRO_SOLIC, CASE WHEN NRO_SOLIC % 3 = 0 THEN EJERCICIO END AS ejercicio, CASE WHEN NRO_SOLIC % 3 = 0 THEN DELEG_SOLIC END AS deleg_solic FROM sg"))
def expr_parse_ref(spark, sf_dir):
    good = E.expense_ref("EJERCICIO", "DELEG_SOLIC", "NRO_SOLIC")
    text = F.when(F.col("NRO_SOLIC") % 3 == 0, good).when(F.col("NRO_SOLIC") % 3 == 1, "SG-1-2").otherwise("XX-1-2-3")
    ref = E.parse_ref(text)
    return role(spark, sf_dir, "sg").select("NRO_SOLIC", ref["ejercicio"].alias("ejercicio"), ref["deleg_solic"].alias("deleg_solic"))


@demo("SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'ganancias' WHEN 1 THEN 'iibb' WHEN 2 THEN 'iibb' WHEN 3 THEN 'suss' WHEN 4 THEN 'iva' END AS kind FROM orders")
def expr_keyword_class(spark, sf_dir):
    texts = F.array(*map(F.lit, ("Imp. a las GANANCIAS", "IIBB local", "Ingresos  Brutos", "Seguridad-Social", "Ret. IVA", "other")))
    return table(spark, sf_dir, "orders").select("o_orderkey", E.withholding_class(F.element_at(texts, (F.col("o_orderkey") % 6 + 1).cast("int"))).alias("kind"))


@demo(with_roles("op", "SELECT NRO_OP, CASE WHEN ESTADO_OP = 'C' THEN 3 ELSE 0 END AS estado, CASE WHEN ESTADO_OP = 'C' THEN CASE WHEN NRO_OP % 2 = 0 THEN '2024-12-31' ELSE strftime(FECH_OP, '%Y-%m-%d') END END AS fecha FROM op"))
def expr_status_date(spark, sf_dir):
    confirmed = F.when(F.col("NRO_OP") % 2 == 0, "2024-12-31 08:00:00")
    return role(spark, sf_dir, "op").select("NRO_OP", E.payment_state("ESTADO_OP").alias("estado"), E.payment_date("ESTADO_OP", confirmed, "FECH_OP").alias("fecha"))


@demo(
    with_roles(
        "items",
        """SELECT NRO_OC, ITEM_OC, NRO_SOLIC, concat('{"entity":"oc_items","nro_oc":', NRO_OC, ',"item_oc":', ITEM_OC, CASE WHEN NRO_SOLIC % 2 = 0 THEN concat(',"nro_solic":', NRO_SOLIC) ELSE '' END, '}') AS ref FROM items""",
    )
)
def item_ref_json(spark, sf_dir):
    own = F.when(F.col("NRO_SOLIC") % 2 == 0, F.col("NRO_SOLIC"))
    ref = F.to_json(F.struct(F.lit("oc_items").alias("entity"), F.col("NRO_OC").alias("nro_oc"), F.col("ITEM_OC").alias("item_oc"), own.alias("nro_solic")))
    return role(spark, sf_dir, "items").select("NRO_OC", "ITEM_OC", "NRO_SOLIC", ref.alias("ref"))

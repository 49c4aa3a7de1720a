import unicodedata

import pytest
from pyspark.sql import functions as F

from tributary.functions import exprs as E


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "given, wanted",
    [(None, None), ("", None), (" \n\t ", None), (" a b\n", "a b"), ("x", "x")],
)
def test_clean(spark, given, wanted):
    assert one(spark, E.clean(F.lit(given).cast("string"))) == wanted


@pytest.mark.parametrize("given, wanted", [("20-12345678-9", "20123456789"), ("20-1", None), (None, None)])
def test_digits_key(spark, given, wanted):
    assert one(spark, E.digits_key(F.lit(given).cast("string"))) == wanted


@pytest.mark.parametrize("given, wanted", [("2024-05-06 10:00:00", "2024-05-06"), ("2024-05-06", "2024-05-06"), ("06/05/2024", ""), ("", ""), (None, "")])
def test_date_only(spark, given, wanted):
    assert one(spark, E.date_only(F.lit(given).cast("string"))) == wanted


@pytest.mark.parametrize("given, wanted", [("12", "00000012"), ("0", None), ("None", None), ("", None), (None, None), ("1234567890", "1234567890")])
def test_zero_padded(spark, given, wanted):
    assert one(spark, E.zero_padded(F.lit(given).cast("string"))) == wanted


@pytest.mark.parametrize("given, wanted", [(" 12 ", 12), ("12.0x", None), ("", None), (None, None)])
def test_to_int(spark, given, wanted):
    assert one(spark, E.to_int(F.lit(given).cast("string"))) == wanted


def test_refs(spark):
    assert one(spark, E.expense_ref(F.lit(2024), F.lit(1), F.lit(33))) == "SG-2024-1-33"
    assert one(spark, E.expense_ref(F.lit(2024), F.lit(None).cast("int"), F.lit(33))) is None
    assert one(spark, E.parse_ref(F.lit("SG-2024-1-33"))).asDict() == {"ejercicio": 2024, "deleg_solic": 1, "nro_solic": 33}
    for bad in ("SG-2024-1", "SG-a-1-2", "XX-1-2-3", ""):
        assert one(spark, E.parse_ref(F.lit(bad))) is None


@pytest.mark.parametrize(
    "given, wanted",
    [("Imp. Ganancias", "ganancias"), ("IIBB", "iibb"), ("Ingresos Brutos", "iibb"), ("SUSS", "suss"), ("Jubilación", "suss"), ("Ret. IVA", "iva"), ("otra", None), (None, None)],
)
def test_withholding_class(spark, given, wanted):
    assert one(spark, E.withholding_class(F.lit(given).cast("string"))) == wanted


def test_normalize_text(spark):
    assert one(spark, E.normalize_text(F.lit("  Árbol -- ÑANDÚ, 3º "))) == "arbol nandu 3o"
    assert one(spark, E.normalize_text(F.lit("Café"))) == "cafe"


def test_payment_state_and_date(spark):
    assert one(spark, E.payment_state(F.lit("c "))) == 3
    assert one(spark, E.payment_state(F.lit("N"))) == 0
    assert one(spark, E.payment_date(F.lit("C"), F.lit(None).cast("string"), F.lit("2024-01-02 00:00:00"))) == "2024-01-02"
    assert one(spark, E.payment_date(F.lit("N"), F.lit("2024-01-02"), F.lit("2024-01-02"))) is None


def test_money_and_codes(spark):
    assert str(one(spark, E.money(F.lit("2.675")))) == "2.68"
    assert one(spark, E.money(F.lit("x"))) is None
    assert one(spark, E.code_map(F.lit(" rins"), E.VAT_CONDITIONS, upper=True)) == 1
    assert one(spark, E.code_map(F.lit(None).cast("string"), E.UNIT_COST_CENTRES, E.OTHER_COST_CENTRE)) == 8
    assert one(spark, E.split_list(F.lit(" a, ,b"))) == ["a", "b"]

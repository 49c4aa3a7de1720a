"""Scalar expressions of the mapping jobs, as Spark columns."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"

# VAT condition codes and their ids in the target.
VAT_CONDITIONS = {"RINS": 1, "MONOT": 2, "EXEN": 3, "CF": 4, "NGAN": 5, "RNI": 6}

# Organisational unit to cost centre, for units that no lookup resolves.
UNIT_COST_CENTRES = {
    "1110101000": 7,
    "1110102000": 7,
    "1110200000": 7,
    "1110112000": 7,
    "1110115000": 7,
    "1110117000": 7,
    "1110105000": 7,
    "1110108000": 7,
    "1110109000": 7,
    "1110111000": 6,
    "1110113000": 5,
    "1110118000": 4,
    "1110106000": 3,
    "1110103000": 2,
    "1110104000": 1,
}
OTHER_COST_CENTRE = 8

#: The unit of measure of all items.
UNIT_OF_MEASURE = 5


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Text without white space at its ends; null if nothing is left."""
    return F.nullif(F.regexp_replace(col(c).cast("string"), SPACE, ""), F.lit(""))


def first_non_empty(*cs: Column | str) -> Column:
    return F.coalesce(*map(clean, cs))


def digits_key(c: Column | str, length: int = 11) -> Column:
    """The digits of an identifier, if there are ``length`` of them."""
    digits = F.regexp_replace(col(c).cast("string"), "[^0-9]", "")
    return F.when(F.length(digits) == length, digits)


def join_non_empty(*cs: Column | str, sep: str = " ") -> Column:
    """The non-empty ones, joined; null if all are empty."""
    return F.nullif(F.concat_ws(sep, *map(clean, cs)), F.lit(""))


def first_phone(*phones: tuple, mobile: Column | str | None = None) -> Column:
    """The first of several (country, area, number) that is not empty, else the mobile number."""
    rest = [] if mobile is None else [clean(mobile)]
    return F.coalesce(*(join_non_empty(*p) for p in phones), *rest)


def code_map(c: Column | str, codes: Mapping[str, int], default: int | None = None, upper: bool = False) -> Column:
    """The value of a code; ``default`` for unknown codes and nulls."""
    key = clean(c)
    key = F.upper(key) if upper else key
    found = F.try_element_at(F.create_map(*(F.lit(x) for pair in codes.items() for x in pair)), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def to_int(c: Column | str) -> Column:
    """An integer; null for text that is none."""
    return col(c).cast("string").try_cast("int")


def date_only(c: Column | str) -> Column:
    """The first ten characters if they look like yyyy-mm-dd, else an empty text."""
    text = F.regexp_replace(col(c).cast("string"), SPACE, "")
    shaped = (F.length(text) >= 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(shaped, F.substring(text, 1, 10)).otherwise("")


def parse_timestamp(c: Column | str, formats: tuple[str, ...] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")) -> Column:
    """A timestamp in the first format that fits; null if none does."""
    text = col(c).cast("string")
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats)).cast("timestamp_ntz")


@functools.cache
def _plain_characters() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition without marks is another one, those, and ligatures with their letters.

    Made by rule from the Unicode tables of Python; syllables of Hangul stay whole.
    """
    marked, plain, several = [], [], {}
    for n in (*range(0xA0, 0xAC00), *range(0xF900, 0x10000)):
        found = "".join(x for x in unicodedata.normalize("NFKD", chr(n)) if not unicodedata.combining(x))
        if len(found) == 1 and found != chr(n):
            marked.append(chr(n))
            plain.append(found)
        elif unicodedata.category(chr(n)) == "Ll" and found.isascii() and found.isalpha():
            several[chr(n)] = found
    return "".join(marked), "".join(plain), several


def normalize_text(c: Column | str) -> Column:
    """Lower case, without accents and compatibility forms, one space for all that is neither letter nor digit.

    Decomposition gives single characters, or several letters for ligatures.
    """
    marked, plain, several = _plain_characters()
    low = F.lower(col(c).cast("string"))
    apart = functools.reduce(lambda text, x: F.replace(text, F.lit(x[0]), F.lit(x[1])), several.items(), low)
    text = F.translate(F.when(low.rlike(f"[{''.join(several)}]"), apart).otherwise(low), marked, plain)
    text = F.regexp_replace(text, r"\p{M}+", "")
    return F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "), "^ +| +$", "")


def zero_padded(c: Column | str, width: int = 8) -> Column:
    """Padded with zeros to ``width``, never cut; null for '0', an empty text and 'None'."""
    text = clean(c)
    padded = F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    return F.when(~text.isin("0", "None"), padded)


def truncated(c: Column | str, n: int) -> Column:
    return F.substring(col(c).cast("string"), 1, n)


def money(c: Column | str) -> Column:
    """Two decimals, half up; null for text that is no number."""
    return col(c).cast("string").try_cast("decimal(15,2)")


def build_ref(prefix: str, *keys: Column | str) -> Column:
    """prefix-key-key; null if a key is null."""
    parts = [col(k) for k in keys]
    whole = F.lit(True)
    for p in parts:
        whole = whole & p.isNotNull()
    return F.when(whole, F.concat_ws("-", F.lit(prefix), *(p.cast("string") for p in parts)))


def expense_ref(year: Column | str, delegation: Column | str, number: Column | str) -> Column:
    return build_ref("SG", year, delegation, number)


def parse_ref(c: Column | str, prefix: str = "SG", names: tuple[str, ...] = ("ejercicio", "deleg_solic", "nro_solic")) -> Column:
    """A struct of the integers in a reference; null if it is malformed."""
    parts = F.split(col(c), "-")
    numbers = [F.get(parts, F.lit(k + 1)).try_cast("int") for k in range(len(names))]
    good = (F.size(parts) == len(names) + 1) & (F.get(parts, F.lit(0)) == prefix)
    for n in numbers:
        good = good & n.isNotNull()
    return F.when(good, F.struct(*(n.alias(name) for n, name in zip(numbers, names, strict=True))))


def withholding_class(c: Column | str) -> Column:
    """The kind of tax that a withholding's description names; the first of these that fits."""
    text = normalize_text(c)
    has = text.contains
    return (
        F.when(has("ganancia"), "ganancias")
        .when(has("iibb") | (has("ingreso") & has("bruto")), "iibb")
        .when(has("suss") | has("seguridad social") | has("jubil"), "suss")
        .when(has("iva"), "iva")
    )


def split_list(c: Column | str, sep: str = ",") -> Column:
    """The non-empty items of a separated list, trimmed."""
    return F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), sep), lambda x: F.trim(x)), lambda x: x != "")


def status_code(c: Column | str) -> Column:
    """A status as one upper-case text; empty if null."""
    return F.coalesce(F.upper(clean(c)), F.lit(""))


def payment_state(status: Column | str) -> Column:
    return F.when(status_code(status) == "C", 3).otherwise(0)


def payment_date(status: Column | str, confirmed: Column | str, ordered: Column | str) -> Column:
    """The date of a settled payment: that of its confirmation, else of its order; null for others."""
    date = F.coalesce(F.nullif(date_only(confirmed), F.lit("")), F.nullif(date_only(ordered), F.lit("")))
    return F.when(status_code(status) == "C", date)


def due_date(needed: Column | str, delivered: Column | str) -> Column:
    return F.coalesce(F.nullif(date_only(needed), F.lit("")), F.nullif(date_only(delivered), F.lit("")))


def created_at(c: Column | str) -> Column:
    date = F.nullif(date_only(c), F.lit(""))
    return F.concat(date, F.lit(" 00:00:00"))

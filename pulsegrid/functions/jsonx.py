"""Column helpers over VARIANT values parsed from JSON text.

All of them are built-in expressions (no Python UDF), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON scalar types that count as numbers. Booleans are numbers too: the
# source system tests ``isinstance(v, (int, float))`` and bool is an int.
_NUMBER_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "BOOLEAN")


def parse(text: Column | str) -> Column:
    """JSON text → VARIANT; malformed text → SQL NULL."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def get(v: Column, path: str, type_: str = "variant") -> Column:
    """``try_variant_get``: SQL NULL when the path is missing or the cast fails."""
    return F.try_variant_get(v, path, type_)


def vtype(v: Column) -> Column:
    """JSON type name of a variant (``BIGINT``, ``STRING``, ``OBJECT<...>``, ``VOID``…)."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    """True for a JSON object; False for any other value; NULL for SQL NULL."""
    # Casting to a one-field struct succeeds for every object (missing fields
    # become NULL) and fails for arrays and scalars, without building the
    # object's schema string.
    return F.try_variant_get(v, "$", "struct<__probe:int>").isNotNull() & ~F.is_variant_null(v)


def is_absent(v: Column) -> Column:
    """Missing key or explicit JSON null (both read as ``None`` by the source)."""
    return v.isNull() | F.is_variant_null(v)


def is_number(v: Column) -> Column:
    """JSON number or boolean. Strings such as ``"72"`` are *not* numbers."""
    t = vtype(v)
    return t.isin(*_NUMBER_TYPES) | t.startswith("DECIMAL")


def as_double(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def as_string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def iso_to_ts(s: Column) -> Column:
    """ISO-8601 text (with or without offset) → TIMESTAMP, NULL if unparsable."""
    return F.try_to_timestamp(s)

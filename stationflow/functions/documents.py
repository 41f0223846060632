"""Type-exact access to the fields of a JSON document held as VARIANT.

`from_json` with a schema would turn "8", 8.0 and true into 8; the checks need them apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT = "ABSENT"
NULL = "VOID"

# The characters a blank station or name may consist of.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse(text: Column) -> Column:
    """VARIANT of a JSON text; null when it is not JSON."""
    return F.try_parse_json(text)


def get(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, f"$.{path}", "variant")


def kind(value: Column) -> Column:
    """Type of a field: BIGINT, DECIMAL, DOUBLE, STRING, BOOLEAN, OBJECT, ARRAY, VOID for a JSON null,
    ABSENT without the field. What a type is made of (precision, members) is cut off."""
    name = F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)
    return F.coalesce(name, F.lit(ABSENT))


def is_number(kind_: Column) -> Column:
    return kind_.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def as_long(value: Column) -> Column:
    return F.try_variant_get(value, "$", "bigint")


def as_double(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def whole(value: Column, kind_: Column) -> Column:
    """A JSON integer as long; null for 8.0, "8" and true, and beyond 64 bits."""
    return F.when(kind_ == "BIGINT", as_long(value))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def lenient_double(value: Column, kind_: Column) -> Column:
    """Number, boolean or numeric text as double; null for anything else."""
    text = stripped(as_text(value))
    return (
        F.when(is_number(kind_), as_double(value))
        .when(kind_ == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double"))
        .when((kind_ == "STRING") & text.rlike(_NUMBER), text.try_cast("double"))
    )


def as_flag(value: Column, kind_: Column) -> Column:
    """Boolean, or a number equal to 0 or 1; null for anything else."""
    number = as_double(value)
    return (
        F.when(kind_ == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(is_number(kind_) & (number == 1), F.lit(True))
        .when(is_number(kind_) & (number == 0), F.lit(False))
    )


def is_falsy(value: Column, kind_: Column) -> Column:
    """Absent, null, false, zero, empty text, empty object or empty list."""
    return (
        kind_.isin(ABSENT, NULL)
        | ((kind_ == "BOOLEAN") & ~F.try_variant_get(value, "$", "boolean"))
        | (is_number(kind_) & (as_double(value) == 0))
        | ((kind_ == "STRING") & (as_text(value) == ""))
        | F.to_json(value).isin("{}", "[]")
    )


def digest(doc: Column) -> Column:
    """Hash of a document that does not depend on the order of its keys."""
    return F.sha1(F.to_json(doc))


def settled(value: Column) -> Column:
    """The same value, computed once where it stands.

    Filters on a computed column are pushed below it by copying its expression, which for a long
    list of rules means planning and running all of them twice. Spark does not move filters past
    an expression that depends on the partition, and partition numbers are never negative.
    """
    return F.when(F.spark_partition_id() >= 0, value)

"""Typed access to values inside a VARIANT column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")


def at(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "variant")


def text_of(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "string")


def kind(value: Column) -> Column:
    """STRING, BOOLEAN, VOID, BIGINT, DECIMAL, DOUBLE, ARRAY or OBJECT; null where the value is absent."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


# The type names that appear in Python's error messages.
_PYTHON_NAME = {
    "STRING": "str", "BOOLEAN": "bool", "VOID": "NoneType", "BIGINT": "int",
    "DECIMAL": "float", "DOUBLE": "float", "ARRAY": "list", "OBJECT": "dict",
}


def sql_map(words: dict[str, str]) -> Column:
    """A map of text literals."""
    return F.expr("map(" + ", ".join(f"'{key}', '{word}'" for key, word in words.items()) + ")")


def python_name(value: Column) -> Column:
    """The Python type name of a JSON value; an absent value counts as ``NoneType``."""
    return F.element_at(sql_map(_PYTHON_NAME), F.coalesce(kind(value), F.lit("VOID")))


# JSON texts of the values Python counts as false, each after its kind.
_FALSE = (
    "STRING ", "BOOLEAN false", "BIGINT 0", "DECIMAL 0", "DECIMAL 0.0", "DOUBLE 0.0", "DOUBLE -0.0",
    "ARRAY []", "OBJECT {}",
)


def truthy(value: Column) -> Column:
    """Python's truth value of a JSON value; false where absent or null."""
    false_texts = F.expr("array(" + ", ".join(f"'{text}'" for text in _FALSE) + ")")
    return F.coalesce(~F.array_contains(false_texts, F.concat(kind(value), F.lit(" "), text_of(value))), F.lit(False))

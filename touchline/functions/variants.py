"""Presence, type and truthiness tests on VARIANT values.

A JSON key that is absent gives SQL NULL; a key holding JSON null gives a
non-null variant of type VOID. ``from_json`` cannot tell the two apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from touchline.functions.once import once


def as_variant(df: DataFrame, column: str) -> Column:
    """The column as VARIANT: as is, or parsed from a string or binary body."""
    if not body_is_text(df, column):
        return F.col(column)
    return F.try_parse_json(F.col(column).cast("string"))


def body_is_text(df: DataFrame, column: str) -> bool:
    return not isinstance(df.schema[column].dataType, VariantType)


def as_json_text(df: DataFrame, column: str) -> Column:
    """The column as JSON text; string bodies keep their exact bytes."""
    if not body_is_text(df, column):
        return F.to_json(F.col(column))
    return F.col(column).cast("string")


def with_post(df: DataFrame, body: str = "value", output: str = "post") -> DataFrame:
    """Parse the body once into a VARIANT column; null where it is not JSON."""
    return once(df, **{output: as_variant(df, body)})


def field(value: Column | str, path: str) -> Column:
    """The value at ``path`` as VARIANT; SQL NULL when absent."""
    return F.try_variant_get(value, f"$.{path}", "variant")


def text_of(value: Column | str, path: str | None = None) -> Column:
    """The value as a string; null when absent or JSON null."""
    return F.try_variant_get(value, f"$.{path}" if path else "$", "string")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_string(value: Column) -> Column:
    return kind(value) == "STRING"


def is_object(value: Column, usual_key: str | None = None) -> Column:
    """Whether the value is an object.

    A value that has ``usual_key`` is one; this spares rendering the schema of
    every well-formed post.
    """
    by_kind = kind(value).startswith("OBJECT")
    return field(value, usual_key).isNotNull() | by_kind if usual_key else by_kind


def is_list(value: Column) -> Column:
    """Whether the value is a list; one with a first element needs no further look."""
    first = F.try_variant_get(value, "$[0]", "variant")
    return first.isNotNull() | kind(value).startswith("ARRAY")


def is_number(value: Column) -> Column:
    return kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")


def is_boolean(value: Column) -> Column:
    return kind(value) == "BOOLEAN"


# JSON texts that count as false: empty string, list or object, false, null, zero.
_FALSY = r'^(?:""|\[\]|\{\}|false|null|-?0(?:\.0*)?(?:[eE][+-]?\d+)?)$'


def truthy(value: Column) -> Column:
    """False for absent, null, false, zero, and empty string, list or object."""
    return value.isNotNull() & ~F.to_json(value).rlike(_FALSY)


def first_truthy(first: Column, second: Column) -> Column:
    return F.when(truthy(first), first).otherwise(second)


def display_text(value: Column) -> Column:
    """How a JSON value reads inside a message: ``None``, ``True``, bare strings."""
    return (
        F.when(F.is_variant_null(value), F.lit("None"))
        .when(is_boolean(value), F.initcap(F.to_json(value)))
        .when(is_string(value), text_of(value))
        .otherwise(F.to_json(value))
    )

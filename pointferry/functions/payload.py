"""Payload values: typed columns and JSON into VARIANT, field rules.

While it is being put together a payload is a ``MAP<STRING, VARIANT>``: fields can be added,
removed and replaced with map functions, without exploding rows and without a shuffle. The last
step turns the map into one VARIANT object.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from pointferry.functions.ids import binary_uuid
from pointferry.functions.numbers import numbers_to_double

FIELDS_TYPE = T.MapType(T.StringType(), T.VariantType())


def no_fields() -> Column:
    return F.expr("map()").cast(FIELDS_TYPE)


def variant_fields(value: Column) -> Column:
    """The fields of a VARIANT object; NULL when the value is not an object."""
    return value.try_cast(FIELDS_TYPE)


def json_fields(json_text: Column) -> Column:
    """The fields of a JSON object; a NULL, malformed or non-object text gives NULL."""
    return variant_fields(F.try_parse_json(json_text))


def is_bad_object(json_text: Column, fields: Column) -> Column:
    """Whether a text that should hold an object, or nothing, holds something else."""
    return json_text.isNotNull() & fields.isNull() & (F.trim(json_text) != "null")


def double_numbers(fields: Column) -> Column:
    """Every number in the fields becomes a double, at any depth.

    A single number is cast; only nested values go through their text, so long texts and vectors,
    which are most of a record, are not scanned again.
    """

    def doubled(_: Column, value: Column) -> Column:
        kind = F.schema_of_variant(value)
        return (
            F.when(kind.rlike("^(?:OBJECT|ARRAY)<"), F.parse_json(numbers_to_double(F.to_json(value))))
            .when(kind.rlike("^(?:BIGINT|DECIMAL|FLOAT)"), value.cast("double").cast("variant"))
            .otherwise(value)
        )

    return F.transform_values(fields, doubled)


def fields_to_payload(fields: Column) -> Column:
    return F.to_variant_object(fields)


def typed_fields(columns: dict[str, Column]) -> Column:
    """A fields map from already typed columns; a NULL column becomes a JSON null."""
    if not columns:
        return no_fields()
    pairs = [part for name, value in columns.items() for part in (F.lit(name), value.cast("variant"))]
    return F.create_map(*pairs)


def with_field(fields: Column, name: str, value: Column, wins: bool = True) -> Column:
    """Add one text field. ``wins`` says whether it replaces a source field of that name."""
    added = F.create_map(F.lit(name), value.cast("variant"))
    if wins:
        return F.map_concat(F.map_filter(fields, lambda k, _: k != name), added)
    return F.when(F.map_contains_key(fields, name), fields).otherwise(F.map_concat(fields, added))


def with_document(fields: Column, name: str, document: Column) -> Column:
    """Add the document text only where there is one."""
    return F.when(F.length(document) > 0, with_field(fields, name, document)).otherwise(fields)


def keep_fields(fields: Column, names: list[str] | None) -> Column:
    """Only the listed fields; unknown names are ignored and an empty list keeps everything."""
    if not names:
        return fields
    return F.map_filter(fields, lambda k, _: k.isin(list(names)))


def keep_payload(payload: Column, names: list[str] | None) -> Column:
    """keep_fields for a finished payload."""
    return payload if not names else fields_to_payload(keep_fields(payload.cast(FIELDS_TYPE), names))


_FINITE_TEXT = (
    r"(?i)\A[+-]?(?:(?:\d++\.?\d*+|\.\d++)(?:e[+-]?\d++)?|0x(?:[0-9a-f]++\.?[0-9a-f]*+|\.[0-9a-f]++)p[+-]?\d++)\z"
)
_NON_FINITE_TEXT = r"(?i)\A(?:[+-]?inf(?:inity)?|nan)\z"


def parse_numeric_or_text(text: Column) -> Column:
    """A double where the text is a number, else the text itself.

    The pattern is stricter than a cast, which would trim blanks and take a type letter (``1d``).
    A number too large for a double is not parsed and stays text.
    """
    number = text.try_cast("double")
    finite = text.rlike(_FINITE_TEXT) & (F.abs(number) < F.lit(float("inf")))
    return F.when(finite | text.rlike(_NON_FINITE_TEXT), number.cast("variant")).otherwise(text.cast("variant"))


def rfc3339(value: Column) -> Column:
    """A timestamp or date as text with second precision and an offset or Z."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ssXXX")


def rfc3339_utc(value: Column) -> Column:
    """As rfc3339, for values without a zone, which are taken as UTC."""
    return F.date_format(value.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


_KEPT = (T.BooleanType, T.IntegerType, T.LongType, T.DoubleType, T.StringType, T.NullType)


def sanitize(value: Column, data_type: T.DataType) -> Column:
    """A table value in a kind a payload can hold.

    Walks the type when the plan is built and emits one expression; no row is inspected in Python.
    """
    if isinstance(data_type, T.BinaryType):
        return F.when(F.octet_length(value) == 16, binary_uuid(value)).otherwise(F.base64(value))
    if isinstance(data_type, T.FloatType):
        return value.cast("double")
    if isinstance(data_type, _KEPT):
        return value
    if isinstance(data_type, T.VariantType):
        # A JSON column: its numbers are doubles.
        return F.parse_json(numbers_to_double(F.to_json(value)))
    if isinstance(data_type, T.TimestampType):
        return rfc3339(value)
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return rfc3339_utc(value)
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: sanitize(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        values = F.transform_values(value, lambda _, v: sanitize(v, data_type.valueType))
        return F.transform_keys(values, lambda k, _: k.cast("string"))
    if isinstance(data_type, T.StructType):
        parts = [sanitize(value[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value.cast("string")


def to_variant(value: Column, data_type: T.DataType) -> Column:
    """A sanitised value as VARIANT."""
    clean = sanitize(value, data_type)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_variant_object(clean)
    return clean.cast("variant")


def sanitized_fields(columns: dict[str, tuple[Column, T.DataType]]) -> Column:
    if not columns:
        return no_fields()
    pairs = [
        part for name, (value, data_type) in columns.items() for part in (F.lit(name), to_variant(value, data_type))
    ]
    return F.create_map(*pairs)

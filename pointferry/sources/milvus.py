"""Typed collection rows: one primary key, vector columns, scalar and JSON columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pointferry.functions.ids import is_uuid, make_point_id
from pointferry.functions.payload import double_numbers, fields_to_payload, is_bad_object, json_fields, typed_fields
from pointferry.functions.vectors import dense, named
from pointferry.sources.base import to_points

VECTOR_COLUMN = T.ArrayType(T.FloatType())


def is_vector_type(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.FloatType)


def extract_scalar(value: Column, data_type: T.DataType) -> Column:
    """A scalar column in its payload kind; a type outside the list is an error."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("bigint")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value.cast("double")
    if isinstance(data_type, (T.BooleanType, T.StringType)):
        return value
    raise TypeError(f"a field of type {data_type.simpleString()} can't go into a payload")


def extract_json_object(text: Column) -> Column:
    """A JSON column, which must hold an object; its numbers are doubles."""
    return fields_to_payload(double_numbers(json_fields(text)))


def normalize_milvus(
    raw: DataFrame,
    *,
    pk: str,
    json_columns: list[str] | None = None,
    partitions: list[str] | None = None,
    partition_column: str = "partition",
    source_ord: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """Every float-vector column becomes a named vector, the key the id, the rest the payload."""
    if pk not in raw.columns:
        raise ValueError(f"primary key column {pk!r} is missing")
    json_columns = json_columns or []
    if partitions:
        raw = raw.filter(F.col(partition_column).isin(list(partitions)))
    skipped = {pk, partition_column, source_ord}
    fields = [f for f in raw.schema.fields if f.name not in skipped]
    vectors = {f.name: F.when(F.col(f.name).isNotNull(), dense(F.col(f.name))) for f in fields if is_vector_type(f.dataType)}
    payload = {
        f.name: extract_json_object(F.col(f.name)) if f.name in json_columns else extract_scalar(F.col(f.name), f.dataType)
        for f in fields
        if not is_vector_type(f.dataType)
    }
    key, key_type = F.col(pk), raw.schema[pk].dataType
    checks = [(key.isNull(), "the entity has no primary key")]
    if isinstance(key_type, T.StringType):
        checks.append((~is_uuid(key), "text primary key is not a UUID"))
    else:
        checks.append((key < 0, "negative primary key"))
    if json_columns:
        bad = [is_bad_object(F.col(c), json_fields(F.col(c))) for c in json_columns]
        checks.append((reduce(lambda a, b: a | b, bad), "JSON column is not an object"))
    return to_points(
        raw,
        id_col=make_point_id(key, key_type),
        vectors=named(vectors),
        payload=fields_to_payload(typed_fields(payload)),
        source_ord=source_ord,
        checks=checks,
        mode=mode,
    )

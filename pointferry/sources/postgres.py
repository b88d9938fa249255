"""Relational table rows with vector columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from pointferry.functions.ids import key_to_string, to_point_uuid, uuid_id
from pointferry.functions.payload import FIELDS_TYPE, fields_to_payload, sanitized_fields
from pointferry.functions.vectors import dense, named
from pointferry.operators.scan import project
from pointferry.sources.base import carried, to_points


def normalize_pg(
    raw: DataFrame,
    *,
    key_column: str,
    vector_columns: list[str],
    json_columns: list[str] | None = None,
    columns: list[str] | None = None,
    source_ord: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """Vector columns become named vectors, all other columns, the key included, the payload.

    A row whose vector is NULL keeps that column as a NULL payload field. A vector column may be
    text, ``[0.1,0.2]``, as exports write it. ``json_columns`` are text columns with JSON in them.
    """
    if columns:
        raw = project(raw, columns + carried(source_ord), key_column)
    fields = [f for f in raw.schema.fields if f.name != source_ord]
    vector_columns = [f.name for f in fields if f.name in vector_columns]
    key, key_type = F.col(key_column), raw.schema[key_column].dataType
    for name in json_columns or []:
        if name in raw.columns and isinstance(raw.schema[name].dataType, T.StringType):
            raw = raw.withColumn(name, F.parse_json(F.col(name)))
    for name in vector_columns:
        if isinstance(raw.schema[name].dataType, T.StringType):
            numbers = F.from_json(F.col(name), "array<float>", {"mode": "FAILFAST"})
            raw = raw.withColumn(name, numbers)
    fields = [raw.schema[f.name] for f in fields]
    payload = sanitized_fields({f.name: (F.col(f.name), f.dataType) for f in fields if f.name not in vector_columns})
    missing = F.array_compact(F.array(*[F.when(F.col(v).isNull(), F.lit(v)) for v in vector_columns]))
    nulls = F.map_from_arrays(missing, F.transform(missing, lambda _: F.lit(None).cast(T.VariantType()))).cast(FIELDS_TYPE)
    return to_points(
        raw,
        id_col=uuid_id(to_point_uuid(key_to_string(key, key_type))),
        vectors=named({v: F.when(F.col(v).isNotNull(), dense(F.col(v))) for v in vector_columns}),
        payload=fields_to_payload(F.map_concat(payload, nulls) if vector_columns else payload),
        source_ord=source_ord,
        checks=[(key.isNull(), "key is NULL")],
        mode=mode,
    )

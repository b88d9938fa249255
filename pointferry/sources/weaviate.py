"""Class objects: UUID id, one default or named vector, properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.functions.ids import uuid_id
from pointferry.functions.payload import double_numbers, fields_to_payload, json_fields, keep_fields
from pointferry.functions.vectors import dense, named
from pointferry.model import DEFAULT_VECTOR
from pointferry.sources.base import carried, to_points

_SYSTEM_PROPERTY = "_additional"


def normalize_weaviate(
    raw: DataFrame,
    *,
    include_properties: list[str] | None = None,
    vector_name: str | None = None,
    tenant: str | None = None,
    source_ord: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """The chosen vector is always written as the default one; the UUID id is kept."""
    if tenant is not None:
        raw = raw.filter(F.col("tenant") == tenant)
    vector = F.try_element_at(F.col("vectors"), F.lit(vector_name)) if vector_name else F.col("vector")
    staged = raw.select(
        "id",
        vector.alias("_vector"),
        json_fields(F.col("properties")).alias("_fields"),
        *carried(source_ord),
    )
    properties = F.map_filter(F.col("_fields"), lambda k, _: k != _SYSTEM_PROPERTY)
    return to_points(
        staged,
        id_col=uuid_id(F.col("id")),
        vectors=named({DEFAULT_VECTOR: dense(F.col("_vector"))}),
        payload=fields_to_payload(double_numbers(keep_fields(properties, include_properties))),
        source_ord=source_ord,
        checks=[
            (F.col("id").isNull(), "the object has no id"),
            (F.col("_vector").isNull(), f"the object has no vector named '{vector_name}'" if vector_name else "the object has no vector"),
            (F.exists("_vector", lambda x: x.isNull()), "the object's vector has an empty place"),
            (F.col("_fields").isNull(), "properties are not a JSON object"),
        ],
        mode=mode,
    )

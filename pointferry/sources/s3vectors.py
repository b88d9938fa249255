"""Object-store vector index records with typed metadata numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.functions.ids import hashed_id
from pointferry.functions.numbers import typed_numbers
from pointferry.functions.payload import fields_to_payload, is_bad_object, json_fields, no_fields, with_field
from pointferry.functions.vectors import dense, named
from pointferry.model import DEFAULT_VECTOR
from pointferry.sources.base import DEFAULT_ID_FIELD, carried, to_points


def normalize_s3_vectors(
    raw: DataFrame, *, id_field: str = DEFAULT_ID_FIELD, source_ord: str | None = None, mode: str = "fail"
) -> DataFrame:
    """Metadata whole numbers stay whole, other numbers are doubles; 32-bit float data only."""
    staged = raw.select(
        "key",
        "data",
        "metadata",
        json_fields(typed_numbers(F.col("metadata"))).alias("_fields"),
        *carried(source_ord),
    )
    return to_points(
        staged,
        id_col=hashed_id(F.col("key")),
        vectors=named({DEFAULT_VECTOR: dense(F.col("data"))}),
        payload=fields_to_payload(with_field(F.coalesce(F.col("_fields"), no_fields()), id_field, F.col("key"))),
        source_ord=source_ord,
        checks=[
            (F.col("key").isNull(), "the vector has no key"),
            (F.col("data").isNull(), "unexpected vector data type"),
            (is_bad_object(F.col("metadata"), F.col("_fields")), "metadata is not a JSON object"),
        ],
        mode=mode,
    )

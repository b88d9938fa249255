"""Managed-index records: dense values, sparse values or both, and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.functions.ids import hashed_id
from pointferry.functions.payload import double_numbers, fields_to_payload, is_bad_object, json_fields, no_fields, with_field
from pointferry.functions.vectors import dense, named, sparse
from pointferry.model import DEFAULT_VECTOR
from pointferry.sources.base import DEFAULT_ID_FIELD, carried, to_points


def normalize_pinecone(
    raw: DataFrame,
    *,
    namespace: str | None = None,
    id_field: str = DEFAULT_ID_FIELD,
    sparse_vector: str = "sparse_vector",
    source_ord: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """Dense values are the default vector, sparse values a named one."""
    if namespace is not None:
        raw = raw.filter(F.col("namespace") == namespace)
    staged = raw.select(
        "id",
        "values",
        "sparse_indices",
        "sparse_values",
        "metadata",
        json_fields(F.col("metadata")).alias("_fields"),
        *carried(source_ord),
    )
    has_sparse = F.col("sparse_indices").isNotNull() & F.col("sparse_values").isNotNull()
    return to_points(
        staged,
        id_col=hashed_id(F.col("id")),
        vectors=named(
            {
                DEFAULT_VECTOR: F.when(F.col("values").isNotNull(), dense(F.col("values"))),
                sparse_vector: F.when(has_sparse, sparse(F.col("sparse_indices"), F.col("sparse_values"))),
            }
        ),
        payload=fields_to_payload(with_field(F.coalesce(double_numbers(F.col("_fields")), no_fields()), id_field, F.col("id"))),
        source_ord=source_ord,
        checks=[
            (F.col("id").isNull(), "the record has no id"),
            (is_bad_object(F.col("metadata"), F.col("_fields")), "metadata is not a JSON object"),
            (has_sparse & (F.size("sparse_indices") != F.size("sparse_values")), "sparse positions and values differ in length"),
        ],
        mode=mode,
    )

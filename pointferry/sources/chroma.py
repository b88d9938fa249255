"""Embedding-store records: embedding, document text and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.functions.ids import hashed_id
from pointferry.functions.payload import double_numbers, fields_to_payload, is_bad_object, json_fields, no_fields, with_document, with_field
from pointferry.functions.vectors import dense, named
from pointferry.model import DEFAULT_VECTOR
from pointferry.sources.base import DEFAULT_ID_FIELD, carried, to_points


def normalize_chroma(
    raw: DataFrame,
    *,
    id_field: str = DEFAULT_ID_FIELD,
    document_field: str = "document",
    source_ord: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """The id, then the document, are written over metadata fields of the same name."""
    staged = raw.select(
        "id",
        "embedding",
        "document",
        "metadata",
        json_fields(F.col("metadata")).alias("_fields"),
        *carried(source_ord),
    )
    with_id = with_field(F.coalesce(double_numbers(F.col("_fields")), no_fields()), id_field, F.col("id"))
    return to_points(
        staged.withColumn("_with_id", with_id),
        id_col=hashed_id(F.col("id")),
        vectors=named({DEFAULT_VECTOR: F.when(F.col("embedding").isNotNull(), dense(F.col("embedding")))}),
        payload=fields_to_payload(with_document(F.col("_with_id"), document_field, F.col("document"))),
        source_ord=source_ord,
        checks=[
            (F.col("id").isNull(), "the record has no id"),
            (is_bad_object(F.col("metadata"), F.col("_fields")), "metadata is not a JSON object"),
        ],
        mode=mode,
    )

"""Documents staged as relaxed extended JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.functions.ids import hashed_id, objectid_text
from pointferry.functions.payload import double_numbers, fields_to_payload, json_fields, with_field
from pointferry.functions.vectors import as_vector_doubles, dense, named
from pointferry.sources.base import DEFAULT_ID_FIELD, carried, to_points


def normalize_mongodb(
    raw: DataFrame,
    *,
    vector_fields: list[str],
    id_field: str = DEFAULT_ID_FIELD,
    source_ord: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """Only listed fields are tried as vectors; one that is not a list of doubles stays payload."""
    if not vector_fields:
        raise ValueError("vector_fields is required")
    staged = raw.select(json_fields(F.col("doc")).alias("_fields"), *carried(source_ord))
    doc_id = F.try_element_at(F.col("_fields"), F.lit("_id"))
    object_id = F.try_variant_get(doc_id, "$['$oid']", "string")
    id_text = F.when(F.schema_of_variant(doc_id) == "STRING", doc_id.try_cast("string")).otherwise(objectid_text(object_id))
    vectors = [
        as_vector_doubles(F.try_element_at(F.col("_fields"), F.lit(f))).alias(f"_vec_{i}") for i, f in enumerate(vector_fields)
    ]
    has_id = (F.schema_of_variant(doc_id) == "STRING") | object_id.isNotNull()
    staged = staged.select(
        "_fields", F.when(has_id, id_text).alias("_id_text"), *vectors, *carried(source_ord)
    )
    vector_columns = {f: F.col(f"_vec_{i}") for i, f in enumerate(vector_fields)}
    found = F.array(*[F.when(c.isNotNull(), F.lit(f)) for f, c in vector_columns.items()])
    rest = F.map_filter("_fields", lambda k, _: (k != "_id") & ~F.coalesce(F.array_contains(F.array_compact(found), k), F.lit(False)))
    return to_points(
        staged.withColumn("_rest", double_numbers(rest)),
        id_col=hashed_id(F.col("_id_text")),
        vectors=named({f: F.when(c.isNotNull(), dense(c)) for f, c in vector_columns.items()}),
        payload=fields_to_payload(with_field(F.col("_rest"), id_field, F.col("_id_text"), wins=False)),
        source_ord=source_ord,
        checks=[
            (F.col("_fields").isNull(), "document is not a JSON object"),
            (F.col("_id_text").isNull(), "the document's _id is of no kind a key can be made of"),
        ],
        mode=mode,
    )

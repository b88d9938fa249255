"""Search-engine hits (Elasticsearch and OpenSearch): any list of numbers is a vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.functions.ids import hashed_id
from pointferry.functions.payload import double_numbers, fields_to_payload, json_fields, no_fields, with_field
from pointferry.functions.vectors import candidate_vectors, merge_named, whole_vectors
from pointferry.sources.base import DEFAULT_ID_FIELD, carried, to_points


def _normalize_hits(
    raw: DataFrame,
    *,
    empty_is_vector: bool,
    use_fields: bool,
    detect: str,
    vector_fields: list[str] | None,
    id_field: str,
    source_ord: str | None,
    mode: str,
) -> DataFrame:
    if detect not in ("shape", "mapping"):
        raise ValueError(f"detect must be 'shape' or 'mapping', not {detect!r}")
    if detect == "mapping" and vector_fields is None:
        raise ValueError("detect='mapping' needs vector_fields")
    only = vector_fields if detect == "mapping" else None

    def candidates(fields: str):
        return candidate_vectors(F.col(fields), empty_is_vector, only)

    # Each step is its own projection because its result is used more than once in the next one.
    staged = raw.select(
        "_id",
        json_fields(F.col("_source")).alias("_body"),
        (json_fields(F.col("fields")) if use_fields else no_fields()).alias("_extra"),
        *carried(source_ord),
    )
    staged = staged.withColumns({"_body_cand": candidates("_body"), "_extra_cand": candidates("_extra")})
    staged = staged.withColumns(
        {"_body_vec": whole_vectors(F.col("_body_cand")), "_extra_vec": whole_vectors(F.col("_extra_cand"))}
    )
    body_vectors = F.col("_body_vec")
    rest = F.map_filter("_body", lambda k, _: ~F.map_contains_key(body_vectors, k))
    vectors = merge_named(body_vectors, F.col("_extra_vec")) if use_fields else body_vectors
    return to_points(
        staged.withColumn("_rest", double_numbers(rest)),
        id_col=hashed_id(F.col("_id")),
        vectors=vectors,
        payload=fields_to_payload(with_field(F.col("_rest"), id_field, F.col("_id"), wins=False)),
        source_ord=source_ord,
        checks=[
            (F.col("_body").isNull(), "the hit's _source is no JSON object"),
            (F.col("_id").isNull(), "the hit has no _id"),
        ],
        mode=mode,
    )


def normalize_elasticsearch(
    raw: DataFrame,
    *,
    detect: str = "shape",
    vector_fields: list[str] | None = None,
    id_field: str = DEFAULT_ID_FIELD,
    source_ord: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """Empty lists stay payload; vectors found in ``fields`` replace those of ``_source``."""
    return _normalize_hits(
        raw,
        empty_is_vector=False,
        use_fields="fields" in raw.columns,
        detect=detect,
        vector_fields=vector_fields,
        id_field=id_field,
        source_ord=source_ord,
        mode=mode,
    )


def normalize_opensearch(
    raw: DataFrame,
    *,
    detect: str = "shape",
    vector_fields: list[str] | None = None,
    id_field: str = DEFAULT_ID_FIELD,
    source_ord: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """An empty list is a vector of size 0."""
    return _normalize_hits(
        raw,
        empty_is_vector=True,
        use_fields=False,
        detect=detect,
        vector_fields=vector_fields,
        id_field=id_field,
        source_ord=source_ord,
        mode=mode,
    )

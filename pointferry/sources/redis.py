"""Key-value hashes under a search index, whose attribute types say how to read a field."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.functions.ids import hashed_id
from pointferry.functions.payload import fields_to_payload, parse_numeric_or_text, with_field
from pointferry.functions.vectors import bytes_to_floats, dense, named
from pointferry.sources.base import DEFAULT_ID_FIELD, carried, to_points


def attribute_types(attrs: DataFrame) -> dict[str, str]:
    """The index definition as a dict. It is schema, one row per indexed attribute, not data."""
    return {r["identifier"]: r["type"] for r in attrs.select("identifier", "type").collect()}


def normalize_redis(
    raw: DataFrame,
    *,
    attrs: DataFrame | dict[str, str],
    id_field: str = DEFAULT_ID_FIELD,
    source_ord: str | None = None,
    mode: str = "fail",
) -> DataFrame:
    """VECTOR attributes are decoded, NUMERIC ones parsed, everything else stays text."""
    types = attrs if isinstance(attrs, dict) else attribute_types(attrs)
    vector_names = sorted(k for k, t in types.items() if t.upper() == "VECTOR")
    numeric_names = sorted(k for k, t in types.items() if t.upper() == "NUMERIC")
    staged = raw.select(
        "key",
        F.map_filter("fields", lambda k, _: ~k.isin(vector_names)).alias("_texts"),
        *[bytes_to_floats(F.try_element_at(F.col("fields"), F.lit(n))).alias(f"_vec_{i}") for i, n in enumerate(vector_names)],
        *carried(source_ord),
    )
    fields = F.transform_values(
        "_texts",
        lambda k, v: F.when(k.isin(numeric_names), parse_numeric_or_text(v.cast("string"))).otherwise(
            v.cast("string").cast("variant")
        ),
    )
    vectors = {
        n: F.when(F.col(f"_vec_{i}").isNotNull(), dense(F.col(f"_vec_{i}"))) for i, n in enumerate(vector_names)
    }
    return to_points(
        staged.withColumn("_fields", fields),
        id_col=hashed_id(F.col("key")),
        vectors=named(vectors),
        payload=fields_to_payload(with_field(F.col("_fields"), id_field, F.col("key"))),
        source_ord=source_ord,
        checks=[(F.col("key").isNull(), "the hash has no key"), (F.col("_texts").isNull(), "the hash has no fields")],
        mode=mode,
    )

"""The one shape every source is brought to, and a flat view of it.

A point is one row: its id, its vectors by name (``""`` is the unnamed default vector), its
payload, the shard it belongs to, and the number that decides which of two writes with the same
id is the later one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

ID_TYPE = T.StructType(
    [
        # Unsigned 64-bit numbers do not fit BIGINT.
        T.StructField("num", T.DecimalType(20, 0)),
        T.StructField("uuid", T.StringType()),
    ]
)

VECTOR_TYPE = T.StructType(
    [
        T.StructField("data", T.ArrayType(T.FloatType())),
        # Sparse positions are unsigned 32-bit numbers, which do not fit INT.
        T.StructField("indices", T.ArrayType(T.LongType())),
        T.StructField("vectors_count", T.IntegerType()),
    ]
)

VECTORS_TYPE = T.MapType(T.StringType(), VECTOR_TYPE)

SHARD_KEY_TYPE = T.StructType(
    [
        T.StructField("keyword", T.StringType()),
        T.StructField("number", T.DecimalType(20, 0)),
    ]
)

POINT_SCHEMA = T.StructType(
    [
        T.StructField("id", ID_TYPE),
        T.StructField("vectors", VECTORS_TYPE),
        T.StructField("payload", T.VariantType()),
        T.StructField("shard_key", SHARD_KEY_TYPE),
        T.StructField("source_ord", T.LongType()),
    ]
)

POINT_COLUMNS = POINT_SCHEMA.fieldNames()
DEFAULT_VECTOR = ""

UINT64_MAX = 18446744073709551615


def empty_vectors() -> Column:
    return F.expr("map()").cast(VECTORS_TYPE)


def no_shard_key() -> Column:
    return F.lit(None).cast(SHARD_KEY_TYPE)


def id_text(id_col: Column) -> Column:
    """The id as one string: the UUID text, or the number in plain digits."""
    return F.coalesce(id_col["uuid"], id_col["num"].cast("string"))


def shard_text(shard_col: Column) -> Column:
    """The shard as one string; ``k:1`` and ``n:1`` stay apart, ``-`` is no shard."""
    return (
        F.when(shard_col["keyword"].isNotNull(), F.concat(F.lit("k:"), shard_col["keyword"]))
        .when(shard_col["number"].isNotNull(), F.concat(F.lit("n:"), shard_col["number"].cast("string")))
        .otherwise(F.lit("-"))
    )


def vector_checksum(data: Column) -> Column:
    """An exact whole-number fingerprint of a dense vector, usable for comparing two engines.

    Position times ``floor(value * 1e6)``, summed; every element counts and no rounding differs.
    """
    terms = F.transform(
        data, lambda x, i: (i + 1).cast("bigint") * F.floor(x.cast("double") * F.lit(1e6))
    )
    return F.aggregate(terms, F.lit(0).cast("bigint"), lambda acc, t: acc + t)


def payload_value(payload: Column, field: str, type_name: str = "string") -> Column:
    """One payload field with a type; a missing field or one of another kind is NULL."""
    return F.try_variant_get(payload, f"$['{field}']", type_name)


def payload_kind(payload: Column, field: str) -> Column:
    """The kind of a payload field: ``bigint``, ``double``, ``string``, ... or ``missing``."""
    kind = F.schema_of_variant(F.variant_get(payload, f"$['{field}']", "variant"))
    return F.coalesce(F.lower(F.regexp_extract(kind, r"^[A-Z]+", 0)), F.lit("missing"))


def flat_view(
    points: DataFrame,
    vectors: dict[str, str] | None = None,
    payload: dict[str, str] | None = None,
    kinds: list[str] | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Scalar columns of a point table, for comparison and reports.

    ``vectors`` maps a vector name to an output prefix (``<prefix>_dim``, ``<prefix>_sum``),
    ``payload`` maps a field to the type it is read with, ``kinds`` lists the fields whose kind is
    reported as ``<field>_kind``; ``extra`` adds columns of one's own.
    """
    out = [id_text(F.col("id")).alias("point_id"), shard_text(F.col("shard_key")).alias("shard")]
    for name, prefix in (vectors or {}).items():
        data = F.try_element_at(F.col("vectors"), F.lit(name))["data"]
        out.append(F.coalesce(F.size(data), F.lit(-1)).cast("bigint").alias(f"{prefix}_dim"))
        out.append(F.coalesce(vector_checksum(data), F.lit(0)).alias(f"{prefix}_sum"))
    for name, type_name in (payload or {}).items():
        out.append(payload_value(F.col("payload"), name, type_name).alias(name))
    for name in kinds or []:
        out.append(payload_kind(F.col("payload"), name).alias(f"{name}_kind"))
    for name, column in (extra or {}).items():
        out.append(column.alias(name))
    return points.select(*out)

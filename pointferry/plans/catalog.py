"""Planning a target collection: its vector fields, sizes, metrics, schema copy and indexes.

The catalog is three small tables:

* ``vector_params``: collection, field, kind (dense or sparse), size, distance
* ``collections``: collection, and the settings copied with it
* ``payload_indexes``: collection, field, type, params
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pointferry.functions.payload import FIELDS_TYPE, variant_fields
from pointferry.model import DEFAULT_VECTOR

# The target's metrics, and each source's words for them.
TARGET_METRICS = ["cosine", "dot", "euclid", "manhattan"]
METRIC_WORDS = {
    "option": {"cosine": "cosine", "dot": "dot", "euclid": "euclid", "manhattan": "manhattan"},
    "pinecone": {"cosine": "cosine", "euclidean": "euclid", "dotproduct": "dot"},
    "s3": {"cosine": "cosine", "euclidean": "euclid"},
    "elasticsearch": {"l2_norm": "euclid", "cosine": "cosine", "dot_product": "dot", "max_inner_product": "dot"},
    "opensearch": {"l2": "euclid", "cosinesimil": "cosine", "innerproduct": "dot", "l1": "manhattan"},
}
# What applies when no metric is named. Sources not listed have no default.
DEFAULT_METRIC = {"pg": "cosine", "milvus": "cosine", "chroma": "euclid", "faiss": "cosine"}
# An unknown word falls back to this in the search engines, and is an error elsewhere.
FALLBACK_METRIC = {"elasticsearch": "cosine", "opensearch": "cosine"}
# How the search engines declare a vector field and its size and metric.
MAPPING_WORDS = {
    "elasticsearch": ("dense_vector", "dims", "similarity"),
    "opensearch": ("knn_vector", "dimension", "space_type"),
}
# Payload index types that are carried over.
INDEX_TYPES = ["keyword", "integer", "float", "geo", "text", "bool", "datetime", "uuid"]

VECTOR_PARAMS_SCHEMA = T.StructType(
    [
        T.StructField("collection", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("distance", T.StringType()),
    ]
)


def metric_of(word: Column, source: str) -> Column:
    """The target metric of a source's word; NULL where it has none.

    The search engines match in any letter case.
    """
    words = METRIC_WORDS.get(source, METRIC_WORDS["option"])
    if source in FALLBACK_METRIC:
        word = F.lower(word)
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    metric = F.try_element_at(table, word)
    return F.coalesce(metric, F.lit(FALLBACK_METRIC[source])) if source in FALLBACK_METRIC else metric


def required_metric(word: Column, source: str) -> Column:
    """As metric_of, for sources where an unknown word is an error."""
    message = F.format_string("the source's distance '%s' has no counterpart in the target", F.coalesce(word, F.lit("none")))
    return F.coalesce(metric_of(word, source), F.raise_error(message).cast("string"))


def metric_option(field: Column, options: dict[str, str], source: str, mode: str = "fail") -> Column:
    """The metric of a field from per-field options, with the source's default.

    An unknown metric is an error, or NULL in mode ``quarantine``.
    """
    default = DEFAULT_METRIC[source]
    chosen = F.lit(default)
    if options:
        table = F.create_map(*[F.lit(x) for pair in options.items() for x in pair])
        chosen = F.coalesce(F.try_element_at(table, field), chosen)
    metric = F.when(chosen.isin(TARGET_METRICS), chosen)
    if mode == "fail":
        message = F.format_string("'%s', asked for vector '%s', is no distance of the target", chosen, field)
        return F.coalesce(metric, F.raise_error(message).cast("string"))
    return metric


def fields_from_mapping(mappings: DataFrame, source: str) -> DataFrame:
    """Vector fields declared in index mappings (collection, mapping JSON).

    Only top-level properties count, and a field without a size is skipped.
    """
    type_word, size_word, metric_word = MAPPING_WORDS[source]
    index = F.try_element_at(variant_fields(F.try_parse_json("mapping")), F.col("collection"))
    properties = variant_fields(F.try_variant_get(index, "$.mappings.properties", "variant"))
    message = F.concat(F.lit("no field properties in the mapping of index "), F.col("collection"))
    checked = F.when(properties.isNotNull(), properties).otherwise(F.raise_error(message).cast(FIELDS_TYPE))
    each = mappings.select("collection", F.explode(checked).alias("field", "definition"))
    declared = each.filter(F.try_variant_get("definition", "$.type", "string") == type_word)
    size = F.try_variant_get("definition", f"$.{size_word}", "variant")
    # A present size must be a number; a text such as "384" is an error, not a size.
    number = F.schema_of_variant(size).rlike(r"^(BIGINT|DOUBLE|DECIMAL)")
    bad_size = F.raise_error(F.concat(F.lit("the mapping gives no number as size of field "), F.col("field"))).cast("bigint")
    return declared.filter(size.isNotNull()).select(
        "collection",
        "field",
        F.lit("dense").alias("kind"),
        F.when(number, size.try_cast("bigint")).otherwise(bad_size).alias("size"),
        metric_of(F.try_variant_get("definition", f"$.{metric_word}", "string"), source).alias("distance"),
    )


def fields_from_type_text(columns: DataFrame) -> DataFrame:
    """Vector columns of a table description (collection, column, type_text), such as ``vector(384)``.

    A vector column without a declared size is an error.
    """
    vectors = columns.filter(F.col("type_text").startswith("vector"))
    size = F.regexp_extract("type_text", r"^vector\((\d+)\)$", 1).try_cast("bigint")
    message = F.concat(F.lit("the table declares no size for vector column "), F.col("column"))
    checked = F.when(size > 0, size).otherwise(F.raise_error(message).cast("bigint"))
    return vectors.select("collection", F.col("column").alias("field"), F.lit("dense").alias("kind"), checked.alias("size"))


def _shapes(vectors: Column) -> Column:
    """Kind and size of every vector, so that what is exploded no longer carries the numbers."""
    return F.transform_values(
        vectors,
        lambda _, v: F.struct(
            F.when(v["indices"].isNotNull(), F.lit("sparse")).otherwise(F.lit("dense")).alias("kind"),
            F.size(v["data"]).cast("bigint").alias("size"),
        ),
    )


def fields_from_points(points: DataFrame, collection: str | Column) -> DataFrame:
    """Vector fields found in the data, dense and sparse, with the sizes seen.

    Aggregated before the shuffle to one row per field and task. A dense field whose sizes differ
    gets a NULL size, which no target can be created with.
    """
    name = F.lit(collection) if isinstance(collection, str) else collection
    each = points.select(name.alias("collection"), F.explode(_shapes(F.col("vectors"))).alias("field", "v"))
    sized = each.select("collection", "field", "v.kind", "v.size")
    agg = sized.groupBy("collection", "field", "kind").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    size = F.when((F.col("kind") == "dense") & (F.col("low") == F.col("high")), F.col("high"))
    return agg.select("collection", "field", "kind", size.alias("size"))


def facts_of_points(points: DataFrame) -> DataFrame:
    """What a target has to know of points, in one pass: every vector field and kind with its sizes, every shard key with its points.

    Rows (field, kind, keyword, number, low, high, n). A row with a field is about vectors, one without
    about a shard key, and one with neither about points of no shard. Combined before the shuffle to
    a row per field and shard key of a task.
    """
    none = F.lit(None)
    fields = F.transform(
        F.map_entries(_shapes(F.col("vectors"))),
        lambda e: F.struct(
            e["key"].alias("field"), e["value"]["kind"].alias("kind"), e["value"]["size"].alias("size"),
            none.cast("string").alias("keyword"), none.cast("decimal(20,0)").alias("number"),
        ),
    )
    shard = F.struct(
        none.cast("string").alias("field"), none.cast("string").alias("kind"), none.cast("bigint").alias("size"),
        F.col("shard_key.keyword").alias("keyword"), F.col("shard_key.number").alias("number"),
    )
    each = points.select(F.inline(F.concat(F.coalesce(fields, F.array().cast(_FACTS)), F.array(shard))))
    return each.groupBy("field", "kind", "keyword", "number").agg(F.min("size").alias("low"), F.max("size").alias("high"), F.count(F.lit(1)).alias("n"))


_FACTS = "array<struct<field:string,kind:string,size:bigint,keyword:string,number:decimal(20,0)>>"


def vector_problems(vectors: Column, fields: dict[str, tuple[str, int | None]]) -> Column:
    """The vectors of a point that a target's fields (name to kind and size) do not take, each with a reason; else an empty list."""
    pairs = [
        part
        for name, (kind, size) in fields.items()
        for part in (F.lit(name), F.struct(F.lit(kind).alias("kind"), F.lit(size).cast("bigint").alias("size")))
    ]
    target = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,struct<kind:string,size:bigint>>")

    def judged(e: Column) -> Column:
        declared, found = F.try_element_at(target, e["key"]), e["value"]
        reason = (
            F.when(declared.isNull(), F.lit("unknown vector field"))
            .when(found["kind"] != declared["kind"], F.lit("other kind of vector"))
            .when((found["kind"] == "dense") & (found["size"] != declared["size"]), F.lit("other size"))
        )
        return F.struct(e["key"].alias("field"), found["size"].alias("size"), reason.alias("reason"))

    problems = F.filter(F.transform(F.map_entries(_shapes(vectors)), judged), lambda p: p["reason"].isNotNull())
    return F.coalesce(problems, F.array().cast("array<struct<field:string,size:bigint,reason:string>>"))


def dispatch_by_kind(indexes: DataFrame, sparse_vector: str = "sparse_vector") -> DataFrame:
    """Index descriptions (collection, vector_type, dimension, metric) to vector parameters."""
    known = F.col("vector_type").isin("dense", "sparse")
    message = F.concat(F.lit("an index is neither dense nor sparse but "), F.coalesce(F.col("vector_type"), F.lit("none")))
    kind = F.when(known, F.col("vector_type")).otherwise(F.raise_error(message).cast("string"))
    dense = F.col("vector_type") == "dense"
    return indexes.select(
        "collection",
        F.when(dense, F.lit(DEFAULT_VECTOR)).otherwise(F.lit(sparse_vector)).alias("field"),
        kind.alias("kind"),
        F.when(dense, F.col("dimension").cast("bigint")).alias("size"),
        F.when(dense, metric_of(F.col("metric"), "pinecone")).alias("distance"),
    )


def create_if_absent(planned: DataFrame, existing: DataFrame, create: bool = True) -> DataFrame:
    """The planned rows of collections that do not exist yet; none when creation is off."""
    fresh = planned.join(existing.select("collection").distinct(), "collection", "left_anti")
    return fresh if create else fresh.filter(F.lit(False))


def copy_collection(catalog: DataFrame, source: str, target: str) -> DataFrame:
    """A collection's catalog rows under another name; nothing if the target is there already."""
    present = catalog.filter(F.col("collection") == target).select(F.lit(source).alias("collection")).distinct()
    rows = catalog.filter(F.col("collection") == source).join(present, "collection", "left_anti")
    return rows.withColumn("collection", F.lit(target)).select(*catalog.columns)


def missing_indexes(source: DataFrame, target: DataFrame) -> DataFrame:
    """Payload indexes of a known type that the target lacks; a field counts, whatever its type."""
    return source.filter(F.col("type").isin(INDEX_TYPES)).join(target.select("field"), "field", "left_anti")


def size_violations(points: DataFrame, params: DataFrame) -> DataFrame:
    """Vectors whose field or size the target does not have.

    ``params`` are the fields of one collection, one row each. They enter as one looked-up map, not
    as a join: joined on the field, all vectors of a field would meet in one task.
    """
    row = F.struct("field", F.struct("kind", "size").alias("v"))
    target = params.agg(F.map_from_entries(F.collect_list(row))).scalar()
    each = points.select("id", F.explode(_shapes(F.col("vectors"))).alias("field", "v"))
    sized = each.select("id", "field", "v.kind", "v.size", F.try_element_at(target, F.col("field")).alias("t"))
    reason = (
        F.when(F.col("t").isNull(), F.lit("unknown vector field"))
        .when(F.col("kind") != F.col("t.kind"), F.lit("other kind of vector"))
        .when((F.col("kind") == "dense") & (F.col("size") != F.col("t.size")), F.lit("other size"))
    )
    return sized.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select("id", "field", "size", "reason")

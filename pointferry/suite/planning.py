"""Planning the target from mappings, descriptions and the data itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pointferry.model import id_text
from pointferry.plans import catalog
from pointferry.suite import sql, staging


def _mappings(spark: SparkSession, sf_dir: str, type_word: str, size_word: str, metric_word: str, metrics: list[str]) -> DataFrame:
    """One index mapping per embedding label, its size taken from the data."""
    emb = staging.table(spark, sf_dir, "embeddings")
    per_label = emb.groupBy("label").agg(F.max(F.size("embedding")).alias("dim"))
    name = F.format_string("idx_%d", "label")
    metric = F.get(F.array(*[F.lit(m) for m in metrics]), F.col("label") % len(metrics))
    text = F.format_string(
        f'{{"%s":{{"mappings":{{"properties":{{'
        f'"vector":{{"type":"{type_word}","{size_word}":%d,"{metric_word}":"%s"}},'
        f'"plain":{{"type":"{type_word}","{size_word}":8}},'
        f'"unsized":{{"type":"{type_word}"}},"doc":{{"type":"text"}},'
        f'"outer":{{"properties":{{"inner":{{"type":"{type_word}","{size_word}":4}}}}}}}}}}}}}}',
        name,
        "dim",
        metric,
    )
    return per_label.select(name.alias("collection"), text.alias("mapping"))


ES_METRICS = ["l2_norm", "COSINE", "dot_product", "max_inner_product", "hamming"]
OS_METRICS = ["l2", "cosinesimil", "InnerProduct", "l1", "linf"]


def m01_elasticsearch_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.fields_from_mapping(_mappings(spark, sf_dir, "dense_vector", "dims", "similarity", ES_METRICS), "elasticsearch")


def m01_opensearch_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.fields_from_mapping(_mappings(spark, sf_dir, "knn_vector", "dimension", "space_type", OS_METRICS), "opensearch")


def _mapping_sql(metrics: list[str]) -> str:
    case = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(metrics))
    return f"""
WITH l AS (SELECT label, max(len(embedding)) AS dim FROM embeddings GROUP BY label)
SELECT 'idx_' || label::VARCHAR AS collection, 'vector' AS field, 'dense' AS kind, dim::BIGINT AS size,
       CASE label % {len(metrics)} {case} END AS distance FROM l
UNION ALL SELECT 'idx_' || label::VARCHAR, 'plain', 'dense', 8, 'cosine' FROM l
"""


def m01_type_text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column descriptions as a table catalog prints them, one table per label."""
    emb = staging.table(spark, sf_dir, "embeddings")
    per_label = emb.groupBy("label").agg(F.max(F.size("embedding")).alias("dim"))
    types = F.create_map(
        F.lit("embedding"), F.format_string("vector(%d)", "dim"), F.lit("half"), F.lit("halfvec(8)"), F.lit("name"), F.lit("text")
    )
    columns = per_label.select(F.format_string("t_%d", "label").alias("collection"), F.explode(types).alias("column", "type_text"))
    return catalog.fields_from_type_text(columns)


def m01_fields_from_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = staging.collection_raw(spark, sf_dir)
    found = catalog.fields_from_points(points, F.coalesce(F.col("shard_key.keyword"), F.lit("none")))
    return found.select("collection", "field", "kind", F.coalesce("size", F.lit(-1)).alias("size"))


M01_POINTS_SQL = f"""
WITH t AS ({sql.with_vector('documents', 'doc_id')}),
c AS (SELECT doc_id, CASE WHEN n_chars % 2 = 0 THEN lang ELSE 'none' END AS collection, len(embedding) AS dim FROM t),
f AS (SELECT collection, '' AS field, 'dense' AS kind, dim FROM c WHERE doc_id % 4 = 0
      UNION ALL SELECT collection, 'text', 'dense', dim FROM c WHERE doc_id % 4 = 1
      UNION ALL SELECT collection, 'terms', 'sparse', -1 FROM c WHERE doc_id % 4 = 1
      UNION ALL SELECT collection, 'multi', 'dense', 2 * dim FROM c WHERE doc_id % 4 = 2)
SELECT collection, field, kind, CASE WHEN min(dim) = max(dim) THEN max(dim) ELSE -1 END::BIGINT AS size FROM f GROUP BY ALL
"""


def _word(column: str, words: list[str]) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), F.col(column) % len(words))


_WORDS = ["cosine", "euclidean", "dotproduct", "l2_norm", "Dot_Product", "max_inner_product", "L2", "cosinesimil", "innerproduct", "l1", "euclid", "dot", "manhattan", "hamming"]


def m02_metric_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word against every source's vocabulary."""
    part = staging.table(spark, sf_dir, "part").select("p_partkey", _word("p_partkey", _WORDS).alias("word"))
    columns = [F.coalesce(catalog.metric_of(F.col("word"), s), F.lit("none")).alias(s) for s in ("pinecone", "s3", "elasticsearch", "opensearch", "option")]
    return part.select("p_partkey", "word", *columns)


M02_SQL = f"""
WITH t AS (SELECT p_partkey, {_WORDS}[p_partkey % {len(_WORDS)} + 1] AS word FROM part)
SELECT p_partkey, word,
  CASE word WHEN 'cosine' THEN 'cosine' WHEN 'euclidean' THEN 'euclid' WHEN 'dotproduct' THEN 'dot' ELSE 'none' END AS pinecone,
  CASE word WHEN 'cosine' THEN 'cosine' WHEN 'euclidean' THEN 'euclid' ELSE 'none' END AS s3,
  CASE lower(word) WHEN 'l2_norm' THEN 'euclid' WHEN 'dot_product' THEN 'dot' WHEN 'max_inner_product' THEN 'dot' ELSE 'cosine' END AS elasticsearch,
  CASE lower(word) WHEN 'l2' THEN 'euclid' WHEN 'innerproduct' THEN 'dot' WHEN 'l1' THEN 'manhattan' ELSE 'cosine' END AS opensearch,
  CASE WHEN word IN ('cosine', 'dot', 'euclid', 'manhattan') THEN word ELSE 'none' END AS option
FROM t
"""


def m03_metric_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-field options with a default; an unknown metric is reported."""
    cust = staging.table(spark, sf_dir, "customer")
    options = {"BUILDING": "dot", "MACHINERY": "manhattan", "FURNITURE": "hamming"}
    metric = catalog.metric_option(F.col("c_mktsegment"), options, "pg", mode="quarantine")
    default = catalog.metric_option(F.col("c_mktsegment"), {}, "chroma")
    return cust.select("c_custkey", F.coalesce(metric, F.lit("invalid")).alias("metric"), default.alias("chroma_default"))


def _planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog with one collection per brand, its size from the parts."""
    part = staging.table(spark, sf_dir, "part")
    per_brand = part.groupBy("p_brand").agg(F.max("p_size").cast("bigint").alias("size"))
    return per_brand.select(
        F.col("p_brand").alias("collection"), F.lit("vec").alias("field"), F.lit("dense").alias("kind"), "size", F.lit("cosine").alias("distance")
    )


def m04_create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections exist for the brands of the dearer parts."""
    part = staging.table(spark, sf_dir, "part")
    existing = part.groupBy("p_brand").agg(F.min("p_size").alias("low")).filter("low % 2 = 0").select(F.col("p_brand").alias("collection"))
    return catalog.create_if_absent(_planned(spark, sf_dir), existing)


M04_SQL = """
SELECT p_brand AS collection, 'vec' AS field, 'dense' AS kind, max(p_size)::BIGINT AS size, 'cosine' AS distance
FROM part GROUP BY p_brand HAVING min(p_size) % 2 <> 0
"""


def m05_dispatch_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index per supplier, dense or sparse in turn."""
    supp = staging.table(spark, sf_dir, "supplier")
    indexes = supp.select(
        F.col("s_name").alias("collection"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("sparse")).otherwise(F.lit("dense")).alias("vector_type"),
        (F.col("s_nationkey") + 1).alias("dimension"),
        _word("s_suppkey", ["cosine", "euclidean", "dotproduct"]).alias("metric"),
    )
    rows = catalog.dispatch_by_kind(indexes)
    return rows.select("collection", "field", "kind", F.coalesce("size", F.lit(-1)).alias("size"), F.coalesce("distance", F.lit("none")).alias("distance"))


M05_SQL = """
SELECT s_name AS collection, CASE WHEN s_suppkey % 3 = 0 THEN 'sparse_vector' ELSE '' END AS field,
       CASE WHEN s_suppkey % 3 = 0 THEN 'sparse' ELSE 'dense' END AS kind,
       CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE s_nationkey + 1 END::BIGINT AS size,
       CASE s_suppkey % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'euclid' ELSE 'dot' END AS distance
FROM supplier
"""


def m06_copy_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of one collection under a new name, and under one that is taken."""
    planned = _planned(spark, sf_dir)
    fresh = catalog.copy_collection(planned, "Brand#2", "copy_of_2")
    taken = catalog.copy_collection(planned, "Brand#2", "Brand#3")
    return planned.unionByName(fresh).unionByName(taken)


M06_SQL = """
WITH p AS (SELECT p_brand AS collection, 'vec' AS field, 'dense' AS kind, max(p_size)::BIGINT AS size, 'cosine' AS distance FROM part GROUP BY p_brand)
SELECT * FROM p UNION ALL SELECT 'copy_of_2', field, kind, size, distance FROM p WHERE collection = 'Brand#2'
UNION ALL SELECT 'Brand#3', field, kind, size, distance FROM p WHERE collection = 'Brand#2' AND NOT EXISTS (SELECT 1 FROM p WHERE collection = 'Brand#3')
"""


_TYPES = ["keyword", "integer", "float", "geo", "text", "bool", "datetime", "uuid", "unknown"]


def m07_missing_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = staging.table(spark, sf_dir, "part")
    source = part.select(F.format_string("field_%d", "p_partkey").alias("field"), _word("p_partkey", _TYPES).alias("type"), F.col("p_name").alias("params"))
    target = part.filter(F.col("p_size") > 25).select(F.format_string("field_%d", "p_partkey").alias("field"), F.lit("text").alias("type"))
    return catalog.missing_indexes(source, target)


M07_SQL = f"""
SELECT 'field_' || p_partkey::VARCHAR AS field, {_TYPES}[p_partkey % {len(_TYPES)} + 1] AS type, p_name AS params
FROM part WHERE p_partkey % {len(_TYPES)} <> 8 AND p_size <= 25
"""


def m09_size_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of all vector forms against a target that lacks one field and has another size for one."""
    points = staging.collection_raw(spark, sf_dir)
    # The unnamed field fits, 'multi' has twice the target's size, 'text' is not a target field.
    sizes = staging.table(spark, sf_dir, "embeddings").agg(F.max(F.size("embedding")).cast("bigint").alias("size"))
    fields = F.create_map(F.lit(""), F.lit("dense"), F.lit("multi"), F.lit("dense"), F.lit("terms"), F.lit("dense"))
    params = sizes.select(F.explode(fields).alias("field", "kind"), "size")
    return catalog.size_violations(points, params).select(id_text(F.col("id")).alias("point_id"), "field", "size", "reason")


M09_SQL = f"""
WITH t AS ({sql.with_vector('documents', 'doc_id')}),
p AS (SELECT doc_id, len(embedding) AS dim, CASE WHEN doc_id % 3 = 0 THEN {sql.uuid5("'doc-' || doc_id::VARCHAR")}
             ELSE (18446744073709551615::HUGEINT - doc_id)::VARCHAR END AS point_id FROM t)
SELECT point_id, 'multi' AS field, (2 * dim)::BIGINT AS size, 'other size' AS reason FROM p WHERE doc_id % 4 = 2
UNION ALL SELECT point_id, 'text', dim::BIGINT, 'unknown vector field' FROM p WHERE doc_id % 4 = 1
UNION ALL SELECT point_id, 'terms', dim::BIGINT, 'other kind of vector' FROM p WHERE doc_id % 4 = 1
"""

ENTRIES = {
    "m01_elasticsearch_fields": (m01_elasticsearch_fields, _mapping_sql(["euclid", "cosine", "dot", "dot", "cosine"])),
    "m01_opensearch_fields": (m01_opensearch_fields, _mapping_sql(["euclid", "cosine", "dot", "manhattan", "cosine"])),
    "m01_type_text_fields": (
        m01_type_text_fields,
        """SELECT 't_' || label::VARCHAR AS collection, 'embedding' AS field, 'dense' AS kind, max(len(embedding))::BIGINT AS size
           FROM embeddings GROUP BY label""",
    ),
    "m01_fields_from_points": (m01_fields_from_points, M01_POINTS_SQL),
    "m02_metric_words": (m02_metric_words, M02_SQL),
    "m03_metric_option": (
        m03_metric_option,
        """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'dot' WHEN 'MACHINERY' THEN 'manhattan' WHEN 'FURNITURE' THEN 'invalid'
                  ELSE 'cosine' END AS metric, 'euclid' AS chroma_default FROM customer""",
    ),
    "m04_create_if_absent": (m04_create_if_absent, M04_SQL),
    "m05_dispatch_by_kind": (m05_dispatch_by_kind, M05_SQL),
    "m06_copy_collection": (m06_copy_collection, M06_SQL),
    "m07_missing_indexes": (m07_missing_indexes, M07_SQL),
    "m09_size_agreement": (m09_size_agreement, M09_SQL),
}

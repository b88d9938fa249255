"""A target that lost, gained and changed points is told from its source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pointferry.functions.ids import number_id
from pointferry.model import id_text, payload_value
from pointferry.operators import verify
from pointferry.operators.sizing import stored
from pointferry.sources import normalize_mongodb
from pointferry.suite import sql, staging


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source's points, written once.

    Both sides read them several times, each with other rows filtered. Once the embeddings are too large for a
    broadcast, the join that gives documents their vectors would shuffle whole texts for every one of these reads.
    """
    return stored(staging.collection_raw(spark, sf_dir), "points")


def _target(points: DataFrame) -> DataFrame:
    """Every 11th document is missing, every 13th has another payload, every 17th another vector; extras are added."""
    doc = F.col("source_ord")
    changed_payload = F.when(doc % 13 == 0, F.to_variant_object(F.struct(F.lit("xx").alias("lang")))).otherwise(F.col("payload"))
    changed_vector = F.when(doc % 17 == 0, F.map_filter("vectors", lambda k, _: k != "")).otherwise(F.col("vectors"))
    kept = points.filter(doc % 11 != 0).withColumns({"payload": changed_payload, "vectors": changed_vector})
    extra = points.filter(doc % 19 == 0).withColumn("id", number_id(doc + 1000000000))
    return kept.unionByName(extra)


def v01_count_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = staging.collection_raw(spark, sf_dir)
    return verify.count_reconciliation(points, _target(points))


_SHARD = "CASE WHEN n_chars % 2 = 0 THEN 'k:' || lang ELSE 'n:' || (n_chars % 10)::VARCHAR END"
V01_SQL = f"""
WITH t AS (SELECT {_SHARD} AS shard, count(*) AS source_count,
                  count(*) FILTER (doc_id % 11 <> 0) + count(*) FILTER (doc_id % 19 = 0) AS target_count FROM documents GROUP BY 1)
SELECT shard, source_count, target_count, source_count = target_count AS matches FROM t
"""


def v02_compare_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    return verify.compare_points(points, _target(points)).select(id_text(F.col("id")).alias("point_id"), "status")


V02_SQL = f"""
WITH p AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN {sql.uuid5("'doc-' || doc_id::VARCHAR")}
             ELSE (18446744073709551615::HUGEINT - doc_id)::VARCHAR END AS point_id FROM documents)
SELECT point_id, CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN doc_id % 13 = 0 OR (doc_id % 17 = 0 AND doc_id % 4 = 0) THEN 'changed' ELSE 'same' END AS status FROM p
UNION ALL SELECT (doc_id + 1000000000)::VARCHAR, 'extra' FROM p WHERE doc_id % 19 = 0
"""


def v02_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids that differ, by descent into buckets of ids whose sums differ."""
    points = _points(spark, sf_dir)
    return verify.differences(points, _target(points)).select(id_text(F.col("id")).alias("point_id"), "status")


def v02_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth point stands twice in the source, but only every tenth twice in the target."""
    points = _points(spark, sf_dir)
    twice = lambda n: points.unionByName(points.filter(F.col("source_ord") % n == 0))
    return verify.compare_points(twice(5), twice(10)).select(id_text(F.col("id")).alias("point_id"), "status")


V02_REPEATED_SQL = f"""
SELECT CASE WHEN doc_id % 3 = 0 THEN {sql.uuid5("'doc-' || doc_id::VARCHAR")} ELSE (18446744073709551615::HUGEINT - doc_id)::VARCHAR END AS point_id,
       CASE WHEN doc_id % 5 = 0 AND doc_id % 10 <> 0 THEN 'changed' ELSE 'same' END AS status FROM documents
"""


def v03_sparse_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vector in reverse order and slightly or grossly off, or with a position missing."""
    emb = staging.table(spark, sf_dir, "embeddings")
    v = F.col("embedding")
    at = F.sequence(F.lit(0).cast("bigint"), F.size(v).cast("bigint") - 1)
    k = F.col("vec_id") % 4
    factor = F.when(k == 1, F.lit(1.005)).when(k == 2, F.lit(1.05)).otherwise(F.lit(1.0))
    scaled = F.transform(v, lambda x: (x * factor).cast("float"))
    other_at, other_v = F.reverse(at), F.reverse(scaled)
    short = k == 3
    other_at = F.when(short, F.slice(other_at, F.lit(2), F.size(other_at) - 1)).otherwise(other_at)
    other_v = F.when(short, F.slice(other_v, F.lit(2), F.size(other_v) - 1)).otherwise(other_v)
    return emb.select("vec_id", verify.sparse_equal(at, v, other_at, other_v).alias("equal"))


def v04_is_vector_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of doubles that was not asked for stays payload."""
    points = normalize_mongodb(staging.mongodb_raw(spark, sf_dir), vector_fields=["text_embedding", "image_embedding"])
    return points.select(
        payload_value(F.col("payload"), "__id__").alias("source_id"),
        verify.is_vector_field(F.col("vectors"), "text_embedding").alias("text_is_vector"),
        verify.is_vector_field(F.col("vectors"), "image_embedding").alias("image_is_vector"),
        verify.is_vector_field(F.col("vectors"), "non_vector").alias("other_is_vector"),
    )


ENTRIES = {
    "v01_count_reconciliation": (v01_count_reconciliation, V01_SQL),
    "v02_differences": (v02_differences, f"SELECT * FROM ({V02_SQL}) WHERE status <> 'same'"),
    "v02_compare_points": (v02_compare_points, V02_SQL),
    "v02_repeated_ids": (v02_repeated_ids, V02_REPEATED_SQL),
    "v03_sparse_comparison": (v03_sparse_comparison, "SELECT vec_id, vec_id % 4 < 2 AS equal FROM embeddings"),
    "v04_is_vector_field": (
        v04_is_vector_field,
        """SELECT CASE WHEN c_custkey % 2 = 0 THEN 'ObjectID("' || md5(c_custkey::VARCHAR)[1:24] || '")' ELSE 'c' || c_custkey::VARCHAR END AS source_id,
                  true AS text_is_vector, c_custkey % 2 <> 0 AS image_is_vector, false AS other_is_vector FROM customer""",
    ),
}

"""Exact top-k with a payload filter, and the text lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pointferry.functions.ids import to_point_uuid
from pointferry.operators import search
from pointferry.suite import staging

K = 10


def _points_and_queries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Points with an even label, searched with the first vector of every label."""
    emb = staging.table(spark, sf_dir, "embeddings")
    points = emb.filter(F.col("label") % 2 == 0).select(F.col("vec_id").cast("string").alias("point_id"), F.col("embedding").alias("vector"))
    queries = emb.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("vector"))
    return points, queries.select(F.col("label").cast("string").alias("query_id"), "vector")


def _topk(metric: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        points, queries = _points_and_queries(spark, sf_dir)
        found = search.nearest_batch(points, queries, K, metric)
        return found.select("query_id", "point_id", F.col("rank").cast("bigint").alias("rank"), F.round("distance", 6).alias("distance"))

    return query


_DISTANCE_SQL = {
    "cosine": "1 - list_cosine_similarity(p.v, q.v)",
    "dot": "-list_inner_product(p.v, q.v)",
    "euclid": "list_distance(p.v, q.v)",
    "manhattan": "list_sum(list_transform(list_zip(p.v, q.v), lambda z: abs(z[1] - z[2])))",
}


def _topk_sql(metric: str) -> str:
    return f"""
WITH p AS (SELECT vec_id::VARCHAR AS point_id, embedding::DOUBLE[] AS v FROM embeddings WHERE label % 2 = 0),
q AS (SELECT label::VARCHAR AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS v FROM embeddings GROUP BY label),
d AS (SELECT query_id, point_id, {_DISTANCE_SQL[metric]} AS distance FROM p, q),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, point_id) AS rank FROM d)
SELECT query_id, point_id, rank, round(distance, 6) AS distance FROM r WHERE rank <= {K}
"""


ZEROS_K = 200


def l01_topk_zero_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the points are zero vectors, which have no cosine and come last; all four metrics."""
    points, queries = _points_and_queries(spark, sf_dir)
    zero = F.transform("vector", lambda x: x * F.lit(0).cast("float"))
    points = points.withColumn("vector", F.when(F.col("point_id").cast("bigint") % 3 == 0, zero).otherwise(F.col("vector")))
    every = None
    for metric in search.METRICS:
        found = search.nearest_batch(points, queries, ZEROS_K, metric).withColumn("metric", F.lit(metric))
        every = found if every is None else every.unionByName(found)
    shown = F.round(F.nanvl("distance", F.lit(-9.0)) + 0.0, 6)
    return every.select("metric", "query_id", "point_id", F.col("rank").cast("bigint").alias("rank"), shown.alias("distance"))


def _zeros_sql(metric: str) -> str:
    worth = f"CASE WHEN p.zero THEN 'NaN'::DOUBLE ELSE {_DISTANCE_SQL[metric]} END" if metric == "cosine" else _DISTANCE_SQL[metric]
    return f"""
SELECT '{metric}' AS metric, query_id, point_id, rank, round(CASE WHEN isnan(distance) THEN -9.0 ELSE distance END + 0.0, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, point_id) AS rank FROM (
    SELECT query_id, point_id, {worth} AS distance FROM
      (SELECT vec_id::VARCHAR AS point_id, vec_id % 3 = 0 AS zero, CASE WHEN vec_id % 3 = 0 THEN list_transform(embedding, lambda x: 0.0::DOUBLE) ELSE embedding::DOUBLE[] END AS v
       FROM embeddings WHERE label % 2 = 0) p,
      (SELECT label::VARCHAR AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS v FROM embeddings GROUP BY label) q)) WHERE rank <= {ZEROS_K}
"""


def l02_lookup_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of all points by id; points beyond the documents get the empty text."""
    emb = staging.table(spark, sf_dir, "embeddings")
    found = emb.select((F.col("vec_id") * 3).alias("vec_id")).select("vec_id", to_point_uuid(F.col("vec_id").cast("string")).alias("point_id"))
    docs = staging.table(spark, sf_dir, "documents")
    texts = docs.select(to_point_uuid(F.col("doc_id").cast("string")).alias("point_id"), "text")
    return search.lookup_text(found, texts, "point_id").select("vec_id", "text")


ENTRIES = {f"l01_topk_{m}": (_topk(m), _topk_sql(m)) for m in search.METRICS}
ENTRIES["l02_lookup_text"] = (
    l02_lookup_text,
    "SELECT e.vec_id * 3 AS vec_id, coalesce(d.text, '') AS text FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id * 3",
)
ENTRIES["l01_topk_zero_vectors"] = (l01_topk_zero_vectors, " UNION ALL ".join(map(_zeros_sql, search.METRICS)))

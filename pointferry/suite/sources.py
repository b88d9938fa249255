"""Every source from its raw shape to points, seen through the flat view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pointferry import sources as src
from pointferry.model import flat_view, payload_value, vector_checksum
from pointferry.suite import sql, staging


def s01_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_collection(staging.collection_raw(spark, sf_dir))
    terms = F.try_element_at(F.col("vectors"), F.lit("terms"))
    index_sum = F.aggregate(terms["indices"], F.lit(0).cast("bigint"), lambda a, x: a + x)
    count = F.try_element_at(F.col("vectors"), F.lit("multi"))["vectors_count"]
    return flat_view(
        points,
        vectors={"": "plain", "text": "text", "multi": "multi"},
        payload={"lang": "string", "source": "string", "n_chars": "bigint"},
        extra={
            "terms_index_sum": F.coalesce(index_sum, F.lit(0)),
            "multi_count": F.coalesce(count, F.lit(0)).cast("bigint"),
            "text_length": F.length(payload_value(F.col("payload"), "text")).cast("bigint"),
        },
    )


S01_SQL = f"""
WITH t AS ({sql.with_vector('documents', 'doc_id')})
SELECT CASE WHEN doc_id % 3 = 0 THEN {sql.uuid5("'doc-' || doc_id::VARCHAR")}
            ELSE (18446744073709551615::HUGEINT - doc_id)::VARCHAR END AS point_id,
       CASE WHEN n_chars % 2 = 0 THEN 'k:' || lang ELSE 'n:' || (n_chars % 10)::VARCHAR END AS shard,
       CASE WHEN doc_id % 4 = 0 THEN len(embedding) ELSE -1 END::BIGINT AS plain_dim,
       CASE WHEN doc_id % 4 = 0 THEN {sql.checksum('embedding')} ELSE 0 END AS plain_sum,
       CASE WHEN doc_id % 4 = 1 THEN len(embedding) ELSE -1 END::BIGINT AS text_dim,
       CASE WHEN doc_id % 4 = 1 THEN {sql.checksum('embedding')} ELSE 0 END AS text_sum,
       CASE WHEN doc_id % 4 = 2 THEN 2 * len(embedding) ELSE -1 END::BIGINT AS multi_dim,
       CASE WHEN doc_id % 4 = 2 THEN {sql.checksum('list_concat(embedding, embedding)')} ELSE 0 END AS multi_sum,
       lang, source, n_chars,
       CASE WHEN doc_id % 4 = 1 THEN len(embedding) * (len(embedding) - 1) // 2 ELSE 0 END::BIGINT AS terms_index_sum,
       CASE WHEN doc_id % 4 = 2 THEN 2 ELSE 0 END::BIGINT AS multi_count,
       length(text)::BIGINT AS text_length
FROM t
"""


def s02_milvus(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_milvus(
        staging.milvus_raw(spark, sf_dir), pk="o_orderkey", json_columns=["meta"], partitions=["F", "O"]
    )
    return flat_view(
        points,
        vectors={"vec": "vec"},
        payload={"price": "double", "small": "bigint", "priority": "string", "large": "boolean"},
        kinds=["small", "meta"],
        extra={
            "meta_cust": F.try_variant_get("payload", "$.meta.cust", "double"),
            "meta_cust_kind": F.lower(F.schema_of_variant(F.variant_get("payload", "$.meta.cust", "variant"))),
        },
    )


S02_SQL = f"""
WITH t AS ({sql.with_vector('orders', 'o_orderkey')})
SELECT o_orderkey::VARCHAR AS point_id, '-' AS shard, len(embedding)::BIGINT AS vec_dim, {sql.checksum('embedding')} AS vec_sum,
       o_totalprice AS price, (o_custkey % 100)::BIGINT AS small, o_orderpriority AS priority, o_totalprice > 100000 AS large,
       'bigint' AS small_kind, 'object' AS meta_kind, o_custkey::DOUBLE AS meta_cust, 'double' AS meta_cust_kind
FROM t WHERE o_orderstatus IN ('F', 'O')
"""


def s03_pinecone(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_pinecone(staging.pinecone_raw(spark, sf_dir))
    sparse = F.try_element_at(F.col("vectors"), F.lit("sparse_vector"))
    position_sum = F.aggregate(sparse["indices"], F.lit(0).cast("bigint"), lambda a, x: a + x)
    return flat_view(
        points,
        vectors={"": "dense", "sparse_vector": "sparse"},
        payload={"__id__": "string", "segment": "string", "bal": "double", "nation": "double"},
        kinds=["nation"],
        extra={"position_sum": F.coalesce(position_sum, F.lit(-1))},
    )


S03_SQL = f"""
WITH t AS ({sql.with_vector('customer', 'c_custkey')}),
u AS (
  SELECT *, CASE WHEN c_custkey % 7 = 0 THEN upper({sql.uuid5("'cust-' || c_custkey::VARCHAR")})
                 ELSE 'cust-' || c_custkey::VARCHAR END AS id,
         list_filter(list_transform(embedding, lambda x, i: {{'i': (i - 1) * 67108864, 'v': x}}), lambda s: s.v::DOUBLE > 0.1) AS hits
  FROM t)
SELECT CASE WHEN c_custkey % 7 = 0 THEN id ELSE {sql.uuid5('id')} END AS point_id, '-' AS shard,
       CASE WHEN c_custkey % 3 <> 0 THEN len(embedding) ELSE -1 END::BIGINT AS dense_dim,
       CASE WHEN c_custkey % 3 <> 0 THEN {sql.checksum('embedding')} ELSE 0 END AS dense_sum,
       CASE WHEN c_custkey % 3 <> 1 THEN len(hits) ELSE -1 END::BIGINT AS sparse_dim,
       CASE WHEN c_custkey % 3 <> 1 THEN coalesce({sql.checksum('list_transform(hits, lambda s: s.v)')}, 0) ELSE 0 END AS sparse_sum,
       CASE WHEN c_custkey % 3 <> 1 THEN coalesce(list_sum(list_transform(hits, lambda s: s.i)), 0) ELSE -1 END::BIGINT AS position_sum,
       id AS __id__,
       CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment,
       CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS bal,
       CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey::DOUBLE END AS nation,
       CASE WHEN c_custkey % 5 <> 0 THEN 'double' ELSE 'missing' END AS nation_kind
FROM u
"""


def s04_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_chroma(staging.chroma_raw(spark, sf_dir))
    return flat_view(
        points,
        vectors={"": "plain"},
        payload={"__id__": "string", "document": "string", "lang": "string", "n_chars": "double"},
        kinds=["n_chars"],
    )


S04_SQL = f"""
WITH t AS ({sql.with_vector('documents', 'doc_id')})
SELECT {sql.uuid5("'doc:' || doc_id::VARCHAR")} AS point_id, '-' AS shard,
       len(embedding)::BIGINT AS plain_dim, {sql.checksum('embedding')} AS plain_sum,
       'doc:' || doc_id::VARCHAR AS __id__,
       CASE WHEN doc_id % 6 <> 0 AND text <> '' THEN text WHEN doc_id % 10 <> 3 THEN 'old' END AS document,
       CASE WHEN doc_id % 10 <> 3 THEN lang END AS lang,
       CASE WHEN doc_id % 10 <> 3 THEN n_chars::DOUBLE END AS n_chars,
       CASE WHEN doc_id % 10 <> 3 THEN 'double' ELSE 'missing' END AS n_chars_kind
FROM t
"""


def s05_weaviate(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_weaviate(
        staging.weaviate_raw(spark, sf_dir), include_properties=["name", "size", "no_such"], vector_name="title"
    )
    return flat_view(
        points,
        vectors={"": "plain"},
        payload={"name": "string", "size": "double"},
        kinds=["name", "size", "brand", "price", "_additional", "no_such"],
    )


S05_SQL = f"""
WITH t AS ({sql.with_vector('part', 'p_partkey')})
SELECT {sql.uuid5("'part-' || p_partkey::VARCHAR")} AS point_id, '-' AS shard,
       len(embedding)::BIGINT AS plain_dim, {sql.checksum('list_reverse(embedding)')} AS plain_sum,
       p_name AS name, p_size::DOUBLE AS size, 'string' AS name_kind, 'double' AS size_kind,
       'missing' AS brand_kind, 'missing' AS price_kind, 'missing' AS _additional_kind, 'missing' AS no_such_kind
FROM t
"""


def s06_redis(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_redis(staging.redis_raw(spark, sf_dir), attrs=staging.REDIS_ATTRIBUTES)
    return flat_view(
        points,
        vectors={"embedding": "vec"},
        payload={"__id__": "string", "type": "string", "value": "double", "note": "string", "props": "string", "extra": "string"},
        kinds=["value", "note", "extra", "embedding"],
    )


S06_SQL = f"""
WITH t AS ({sql.with_vector('events', 'event_id')})
SELECT {sql.uuid5("'ev:' || event_id::VARCHAR")} AS point_id, '-' AS shard,
       len(embedding)::BIGINT AS vec_dim, {sql.checksum('embedding')} AS vec_sum,
       'ev:' || event_id::VARCHAR AS __id__, event_type AS type, value,
       CASE WHEN event_id % 2 = 0 THEN 'n/a' ELSE user_id::VARCHAR || '.0' END AS note, props, user_id::VARCHAR AS extra,
       'double' AS value_kind, CASE WHEN event_id % 2 = 0 THEN 'string' ELSE 'double' END AS note_kind,
       'string' AS extra_kind, 'missing' AS embedding_kind
FROM t
"""


def s07_mongodb(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_mongodb(
        staging.mongodb_raw(spark, sf_dir), vector_fields=["text_embedding", "image_embedding"]
    )
    return flat_view(
        points,
        vectors={"text_embedding": "text", "image_embedding": "image"},
        payload={"__id__": "string", "segment": "string", "nation": "double", "non_vector": "string"},
        kinds=["nation", "image_embedding", "non_vector", "when", "_id"],
    )


S07_SQL = f"""
WITH t AS ({sql.with_vector('customer', 'c_custkey')}),
u AS (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN 'ObjectID("' || md5(c_custkey::VARCHAR)[1:24] || '")'
                     ELSE 'c' || c_custkey::VARCHAR END AS id FROM t)
SELECT {sql.uuid5('id')} AS point_id, '-' AS shard,
       len(embedding)::BIGINT AS text_dim, {sql.checksum('embedding')} AS text_sum,
       CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 3 END::BIGINT AS image_dim,
       CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE {sql.checksum('[0.5, 1.0, -0.25]')} END AS image_sum,
       id AS __id__, c_mktsegment AS segment, c_nationkey::DOUBLE AS nation, '[1.5,2.5]' AS non_vector,
       'double' AS nation_kind, CASE WHEN c_custkey % 2 = 0 THEN 'array' ELSE 'missing' END AS image_embedding_kind,
       'array' AS non_vector_kind, 'object' AS when_kind, 'missing' AS _id_kind
FROM u
"""


def s08_opensearch(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_opensearch(staging.opensearch_raw(spark, sf_dir))
    return flat_view(
        points,
        vectors={"vec": "vec", "empty": "empty"},
        payload={"__id__": "string", "url": "string", "html": "string", "n": "double"},
        kinds=["n", "vec", "empty", "mixed", "holes", "nested"],
    )


S08_SQL = f"""
WITH t AS ({sql.with_vector('pages', 'page_id')})
SELECT {sql.uuid5("'page-' || page_id::VARCHAR")} AS point_id, '-' AS shard,
       len(embedding)::BIGINT AS vec_dim, {sql.checksum('embedding')} AS vec_sum, 0::BIGINT AS empty_dim, 0::BIGINT AS empty_sum,
       'page-' || page_id::VARCHAR AS __id__, url, html, page_id::DOUBLE AS n,
       'double' AS n_kind, 'missing' AS vec_kind, 'missing' AS empty_kind, 'array' AS mixed_kind, 'array' AS holes_kind, 'object' AS nested_kind
FROM t
"""


def s09_elasticsearch(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_elasticsearch(staging.elasticsearch_raw(spark, sf_dir))
    return flat_view(
        points,
        vectors={"pair": "pair", "hidden": "hidden"},
        payload={"__id__": "string", "role": "string", "text": "string", "turn": "double"},
        kinds=["turn", "pair", "empty", "hidden"],
    )


S09_SQL = f"""
WITH t AS ({sql.with_vector('conversations', 'conv_id')})
SELECT {sql.uuid5("conv_id::VARCHAR || '/' || turn::VARCHAR")} AS point_id, '-' AS shard,
       CASE WHEN conv_id % 2 = 0 THEN 3 ELSE 2 END::BIGINT AS pair_dim,
       CASE WHEN conv_id % 2 = 0 THEN {sql.checksum('embedding[1:3]')} ELSE {sql.checksum('[turn, conv_id]')} END AS pair_sum,
       CASE WHEN conv_id % 2 = 0 THEN len(embedding) ELSE -1 END::BIGINT AS hidden_dim,
       CASE WHEN conv_id % 2 = 0 THEN {sql.checksum('embedding')} ELSE 0 END AS hidden_sum,
       conv_id::VARCHAR || '/' || turn::VARCHAR AS __id__, role, text, turn::DOUBLE AS turn,
       'double' AS turn_kind, 'missing' AS pair_kind, 'array' AS empty_kind, 'missing' AS hidden_kind
FROM t
"""


def s10_pg(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_pg(
        staging.pg_raw(spark, sf_dir), key_column="o_orderkey", vector_columns=["embedding"]
    )
    return flat_view(
        points,
        vectors={"embedding": "vec"},
        payload={
            "o_orderkey": "bigint",
            "o_orderstatus": "string",
            "o_totalprice": "double",
            "o_orderdate": "string",
            "small": "string",
            "cust": "bigint",
            "quarter": "string",
            "guid": "string",
            "tags": "string",
            "even": "boolean",
        },
        kinds=["small", "cust", "embedding", "tags"],
    )


S10_SQL = f"""
WITH t AS ({sql.with_vector('orders', 'o_orderkey')}), m AS (SELECT *, md5(o_orderkey::VARCHAR) AS h FROM t)
SELECT {sql.uuid5('o_orderkey::VARCHAR')} AS point_id, '-' AS shard,
       CASE WHEN o_orderkey % 5 <> 0 THEN len(embedding) ELSE -1 END::BIGINT AS vec_dim,
       CASE WHEN o_orderkey % 5 <> 0 THEN {sql.checksum('embedding')} ELSE 0 END AS vec_sum,
       o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS o_orderdate,
       (o_custkey % 50)::VARCHAR AS small, o_custkey AS cust, (o_orderkey::DECIMAL(12,2) / 4)::DECIMAL(12,2)::VARCHAR AS quarter,
       concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS guid,
       '["' || o_orderpriority || '","' || o_orderstatus || '"]' AS tags, o_orderkey % 2 = 0 AS even,
       'string' AS small_kind, 'bigint' AS cust_kind,
       CASE WHEN o_orderkey % 5 <> 0 THEN 'missing' ELSE 'void' END AS embedding_kind, 'array' AS tags_kind
FROM m
"""


def s10_pg_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: a table with one vector column."""
    raw = staging.table(spark, sf_dir, "embeddings")
    points = src.normalize_pg(raw, key_column="vec_id", vector_columns=["embedding"])
    return flat_view(points, vectors={"embedding": "vec"}, payload={"vec_id": "bigint", "label": "bigint"})


def s10_pg_text_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as an export writes it: the vector as text, and JSON in a text column."""
    raw = staging.table(spark, sf_dir, "embeddings")
    as_text = F.concat(F.lit("["), F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string"))), F.lit("]"))
    exported = raw.select("vec_id", as_text.alias("embedding"), F.to_json(F.struct("label")).alias("meta"))
    points = src.normalize_pg(exported, key_column="vec_id", vector_columns=["embedding"], json_columns=["meta"])
    label = F.try_variant_get("payload", "$.meta.label", "bigint")
    return flat_view(points, vectors={"embedding": "vec"}, payload={"vec_id": "bigint"}, extra={"label": label})


S10_EMBEDDINGS_SQL = f"""
SELECT {sql.uuid5('vec_id::VARCHAR')} AS point_id, '-' AS shard, len(embedding)::BIGINT AS vec_dim,
       {sql.checksum('embedding')} AS vec_sum, vec_id, label::BIGINT AS label
FROM embeddings
"""


def s11_s3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = src.normalize_s3_vectors(staging.s3_raw(spark, sf_dir))

    def element_kind(position: int) -> Column:
        element = F.try_variant_get("payload", f"$.nest.n[{position}]", "variant")
        return F.coalesce(F.lower(F.schema_of_variant(element)), F.lit("missing"))

    return flat_view(
        points,
        vectors={"": "plain"},
        payload={"__id__": "string", "size": "bigint", "price": "double", "whole": "double", "big": "double", "brand": "string"},
        kinds=["size", "price", "whole", "big"],
        extra={"n0_kind": element_kind(0), "n1_kind": element_kind(1)},
    )


S11_SQL = f"""
WITH t AS ({sql.with_vector('part', 'p_partkey')}), u AS (SELECT *, p_partkey % 4 <> 0 AS has FROM t)
SELECT {sql.uuid5("'part/' || p_partkey::VARCHAR")} AS point_id, '-' AS shard,
       len(embedding)::BIGINT AS plain_dim, {sql.checksum('embedding')} AS plain_sum,
       'part/' || p_partkey::VARCHAR AS __id__,
       CASE WHEN has THEN p_size::BIGINT END AS size, CASE WHEN has THEN p_retailprice END AS price,
       CASE WHEN has THEN p_size::DOUBLE END AS whole,
       CASE WHEN has THEN ('1844674407370955' || lpad((p_partkey % 10000)::VARCHAR, 4, '0'))::DOUBLE END AS big,
       CASE WHEN has THEN p_brand END AS brand,
       CASE WHEN has THEN 'bigint' ELSE 'missing' END AS size_kind, CASE WHEN has THEN 'double' ELSE 'missing' END AS price_kind,
       CASE WHEN has THEN 'double' ELSE 'missing' END AS whole_kind, CASE WHEN has THEN 'double' ELSE 'missing' END AS big_kind,
       CASE WHEN has THEN 'bigint' ELSE 'missing' END AS n0_kind, CASE WHEN has THEN 'double' ELSE 'missing' END AS n1_kind
FROM u
"""


def s12_faiss(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, id_map = staging.faiss_raw(spark, sf_dir)
    points = src.normalize_faiss(vectors, id_map=id_map)
    return points.select(
        F.col("id.num").cast("string").alias("point_id"),
        F.size(F.col("vectors")[""]["data"]).cast("bigint").alias("plain_dim"),
        vector_checksum(F.col("vectors")[""]["data"]).alias("plain_sum"),
        F.col("payload").isNull().alias("no_payload"),
    )


S12_SQL = f"""
SELECT CASE WHEN vec_id % 2 = 0 THEN vec_id * 1000 + label ELSE vec_id END::VARCHAR AS point_id,
       len(embedding)::BIGINT AS plain_dim, {sql.checksum('embedding')} AS plain_sum, true AS no_payload
FROM embeddings
"""

ENTRIES = {
    "s01_collection": (s01_collection, S01_SQL),
    "s02_milvus": (s02_milvus, S02_SQL),
    "s03_pinecone": (s03_pinecone, S03_SQL),
    "s04_chroma": (s04_chroma, S04_SQL),
    "s05_weaviate": (s05_weaviate, S05_SQL),
    "s06_redis": (s06_redis, S06_SQL),
    "s07_mongodb": (s07_mongodb, S07_SQL),
    "s08_opensearch": (s08_opensearch, S08_SQL),
    "s09_elasticsearch": (s09_elasticsearch, S09_SQL),
    "s10_pg": (s10_pg, S10_SQL),
    "s10_pg_embeddings": (s10_pg_embeddings, S10_EMBEDDINGS_SQL),
    "s10_pg_text_vectors": (s10_pg_text_vectors, S10_EMBEDDINGS_SQL),
    "s11_s3_vectors": (s11_s3_vectors, S11_SQL),
    "s12_faiss": (s12_faiss, S12_SQL),
}

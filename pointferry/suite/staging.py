"""Raw source shapes made by Spark from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pointferry.functions.ids import uuid5_url
from pointferry.functions.vectors import floats_to_bytes
from pointferry.model import SHARD_KEY_TYPE, VECTORS_TYPE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_vector(spark: SparkSession, sf_dir: str, df: DataFrame, key: str) -> DataFrame:
    """Rows with an embedding chosen by their key."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = emb.agg(F.count(F.lit(1))).scalar()
    keyed = df.withColumn("_at", F.col(key) % n)
    return keyed.join(emb, F.col("_at") == F.col("vec_id")).drop("_at", "vec_id")


def _int(c: str) -> Column:
    return F.col(c).cast("string")


def collection_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point exports from documents: number and UUID ids, all vector forms, both shard-key kinds."""
    docs = with_vector(spark, sf_dir, table(spark, sf_dir, "documents"), "doc_id")
    doc = F.col("doc_id")
    number = F.when(doc % 3 != 0, F.lit("18446744073709551615").cast("decimal(20,0)") - doc)
    uuid_text = F.when(doc % 3 == 0, uuid5_url(F.concat(F.lit("doc-"), _int("doc_id"))))
    emb = F.col("embedding")
    no_indices, no_count = F.lit(None).cast("array<bigint>"), F.lit(None).cast("int")
    positions = F.sequence(F.lit(0).cast("bigint"), F.size(emb).cast("bigint") - 1)

    def vec(data: Column, indices: Column, count: Column) -> Column:
        return F.struct(data.alias("data"), indices.alias("indices"), count.alias("vectors_count"))

    vectors = (
        F.when(doc % 4 == 0, F.create_map(F.lit(""), vec(emb, no_indices, no_count)))
        .when(
            doc % 4 == 1,
            F.create_map(
                F.lit("text"), vec(emb, no_indices, no_count), F.lit("terms"), vec(emb, positions, no_count)
            ),
        )
        .when(doc % 4 == 2, F.create_map(F.lit("multi"), vec(F.concat(emb, emb), no_indices, F.lit(2))))
    )
    even = F.col("n_chars") % 2 == 0
    shard = F.struct(
        F.when(even, F.col("lang")).alias("keyword"), F.when(~even, F.col("n_chars") % 10).cast("decimal(20,0)").alias("number")
    )
    return docs.select(
        F.struct(number.cast("decimal(20,0)").alias("num"), uuid_text.alias("uuid")).alias("id"),
        vectors.cast(VECTORS_TYPE).alias("vectors"),
        F.to_variant_object(F.struct("lang", "source", "n_chars", "text")).alias("payload"),
        shard.cast(SHARD_KEY_TYPE).alias("shard_key"),
        doc.alias("source_ord"),
    )


def milvus_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = with_vector(spark, sf_dir, table(spark, sf_dir, "orders"), "o_orderkey")
    return orders.select(
        "o_orderkey",
        F.col("embedding").alias("vec"),
        F.col("o_totalprice").alias("price"),
        (F.col("o_custkey") % 100).cast("smallint").alias("small"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("o_totalprice") > 100000).alias("large"),
        F.to_json(F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("tag"))).alias("meta"),
        F.col("o_orderstatus").alias("partition"),
    )


def pinecone_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers: dense, sparse or both; sparse positions run past 2^31; some ids are UUIDs."""
    cust = with_vector(spark, sf_dir, table(spark, sf_dir, "customer"), "c_custkey")
    key, emb = F.col("c_custkey"), F.col("embedding")
    hits = F.filter(
        F.transform(emb, lambda x, i: F.struct((i.cast("bigint") * 67108864).alias("i"), x.alias("v"))),
        lambda s: s["v"] > 0.1,
    )
    has_sparse = key % 3 != 1
    meta = F.to_json(
        F.struct(
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("bal"),
            F.col("c_nationkey").alias("nation"),
            F.lit("clash").alias("__id__"),
        )
    )
    named = F.concat(F.lit("cust-"), _int("c_custkey"))
    return cust.select(
        F.when(key % 7 == 0, F.upper(uuid5_url(named))).otherwise(named).alias("id"),
        F.when(key % 3 != 0, emb).alias("values"),
        F.when(has_sparse, F.transform(hits, lambda s: s["i"])).alias("sparse_indices"),
        F.when(has_sparse, F.transform(hits, lambda s: s["v"])).alias("sparse_values"),
        F.when(key % 5 != 0, meta).alias("metadata"),
        F.col("c_mktsegment").alias("namespace"),
    )


def chroma_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_vector(spark, sf_dir, table(spark, sf_dir, "documents"), "doc_id")
    meta = F.to_json(F.struct("lang", "source", "n_chars", F.lit("old").alias("document")))
    return docs.select(
        F.concat(F.lit("doc:"), _int("doc_id")).alias("id"),
        "embedding",
        F.when(F.col("doc_id") % 6 != 0, F.col("text")).otherwise(F.lit("")).alias("document"),
        F.when(F.col("doc_id") % 10 != 3, meta).alias("metadata"),
    )


def weaviate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = with_vector(spark, sf_dir, table(spark, sf_dir, "part"), "p_partkey")
    wide = F.col("embedding").cast("array<double>")
    props = F.to_json(
        F.struct(
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            F.col("p_size").alias("size"),
            F.col("p_retailprice").alias("price"),
            F.struct(F.lit("x").alias("id")).alias("_additional"),
        )
    )
    return part.select(
        uuid5_url(F.concat(F.lit("part-"), _int("p_partkey"))).alias("id"),
        wide.alias("vector"),
        F.create_map(F.lit("title"), F.reverse(wide)).alias("vectors"),
        props.alias("properties"),
        F.col("p_brand").alias("tenant"),
    )


REDIS_ATTRIBUTES = {"type": "TAG", "value": "NUMERIC", "note": "NUMERIC", "embedding": "VECTOR", "props": "TEXT"}


def redis_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_vector(spark, sf_dir, table(spark, sf_dir, "events"), "event_id")
    coded = events.withColumn("_bytes", floats_to_bytes(F.col("embedding")))
    note = F.when(F.col("event_id") % 2 == 0, F.lit("n/a")).otherwise(_int("user_id"))
    return coded.select(
        F.concat(F.lit("ev:"), _int("event_id")).alias("key"),
        F.create_map(
            F.lit("type"), F.col("event_type").cast("binary"),
            F.lit("value"), F.col("value").cast("string").cast("binary"),
            F.lit("note"), note.cast("binary"),
            F.lit("props"), F.col("props").cast("binary"),
            F.lit("extra"), _int("user_id").cast("binary"),
            F.lit("embedding"), F.col("_bytes"),
        ).alias("fields"),
    )


def mongodb_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as relaxed extended JSON; half have object ids, half have a whole-number image list."""
    cust = with_vector(spark, sf_dir, table(spark, sf_dir, "customer"), "c_custkey")
    even = F.col("c_custkey") % 2 == 0
    hex24 = F.substr(F.md5(_int("c_custkey")), F.lit(1), F.lit(24))
    doc_id = F.when(even, F.format_string('{"$oid":"%s"}', hex24)).otherwise(F.format_string('"c%d"', "c_custkey"))
    image = F.when(even, F.format_string("[%d, 2, 3]", "c_nationkey")).otherwise(F.lit("[0.5, 1.0, -2.5E-1]"))
    return cust.select(
        F.format_string(
            '{"_id":%s,"text_embedding":%s,"image_embedding":%s,"non_vector":[1.5,2.5],"segment":"%s","nation":%d,"when":{"$date":"2024-01-01T00:00:00Z"}}',
            doc_id,
            F.to_json(F.col("embedding")),
            image,
            "c_mktsegment",
            "c_nationkey",
        ).alias("doc")
    )


def opensearch_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_vector(spark, sf_dir, table(spark, sf_dir, "pages"), "page_id")
    body = F.struct("url", "html", F.col("embedding").alias("vec"), F.col("page_id").alias("n"))
    # Lists of mixed kinds have no column type, so they are added to the text.
    extra = F.lit(',"empty":[],"mixed":[1,"2"],"holes":[1,null],"nested":{"a":1,"b":[1,2]}}')
    return pages.select(
        F.concat(F.lit("page-"), _int("page_id")).alias("_id"),
        F.regexp_replace(F.to_json(body), r"\}\z", "").alias("_head"),
        extra.alias("_tail"),
    ).select("_id", F.concat("_head", "_tail").alias("_source"))


def elasticsearch_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    conv = with_vector(spark, sf_dir, conv, "conv_id")
    body = F.struct("role", "text", "turn", F.array("turn", "conv_id").alias("pair"), F.expr("array()").cast("array<int>").alias("empty"))
    emb = F.col("embedding")
    fields = F.struct(emb.alias("hidden"), F.slice(emb, 1, 3).alias("pair"), F.array("role").alias("role"))
    return conv.select(
        F.concat_ws("/", _int("conv_id"), _int("turn")).alias("_id"),
        F.to_json(body).alias("_source"),
        F.when(F.col("conv_id") % 2 == 0, F.to_json(fields)).alias("fields"),
    )


def pg_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with every kind of column the rules tell apart; every fifth row has no vector."""
    orders = with_vector(spark, sf_dir, table(spark, sf_dir, "orders"), "o_orderkey")
    key = F.col("o_orderkey")
    return orders.select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        (F.col("o_custkey") % 50).cast("smallint").alias("small"),
        F.col("o_custkey").cast("int").alias("cust"),
        (key.cast("decimal(12,2)") / 4).cast("decimal(12,2)").alias("quarter"),
        F.unhex(F.md5(_int("o_orderkey"))).alias("guid"),
        F.array(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("tags"),
        (key % 2 == 0).alias("even"),
        F.when(key % 5 != 0, F.col("embedding")).alias("embedding"),
    )


def s3_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = with_vector(spark, sf_dir, table(spark, sf_dir, "part"), "p_partkey")
    meta = F.format_string(
        '{"size":%d,"price":%s,"whole":%d.0,"big":1844674407370955%04d,"nest":{"n":[%d,2.5]},"brand":"%s"}',
        "p_size",
        F.col("p_retailprice").cast("string"),
        "p_size",
        F.col("p_partkey") % 10000,
        "p_partkey",
        "p_brand",
    )
    return part.select(
        F.concat(F.lit("part/"), _int("p_partkey")).alias("key"),
        F.col("embedding").alias("data"),
        F.when(F.col("p_partkey") % 4 != 0, meta).alias("metadata"),
    )


def faiss_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    emb = table(spark, sf_dir, "embeddings")
    vectors = emb.select(F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"))
    id_map = emb.filter(F.col("vec_id") % 2 == 0).select(
        F.col("vec_id").alias("pos"), (F.col("vec_id") * 1000 + F.col("label")).alias("id")
    )
    return vectors, id_map

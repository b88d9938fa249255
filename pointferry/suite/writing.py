"""Upsert by id and routing to shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pointferry.functions.ids import hashed_id
from pointferry.model import SHARD_KEY_TYPE, empty_vectors, id_text, payload_value, shard_text
from pointferry.operators import upsert as up
from pointferry.plans.full_copy import ByRanges, CatalogStore, full_copy
from pointferry.session import scratch_dir
from pointferry.sinks.point_table import PointTable
from pointferry.sources import normalize_collection
from pointferry.streaming.progress import ProgressStore
from pointferry.suite import sql, staging


def event_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as writes of one point per user: each user's point is overwritten many times."""
    events = staging.table(spark, sf_dir, "events")
    shard = F.struct(F.col("event_type").alias("keyword"), F.lit(None).cast("decimal(20,0)").alias("number")).cast(SHARD_KEY_TYPE)
    return events.select(
        hashed_id(F.concat(F.lit("user-"), F.col("user_id").cast("string"))).alias("id"),
        empty_vectors().alias("vectors"),
        F.to_variant_object(F.struct("user_id", "event_id", "event_type", "value")).alias("payload"),
        shard.alias("shard_key"),
        F.col("event_id").alias("source_ord"),
    )


def _flat(points: DataFrame) -> DataFrame:
    p = F.col("payload")
    return points.select(
        id_text(F.col("id")).alias("point_id"),
        payload_value(p, "user_id", "bigint").alias("user_id"),
        payload_value(p, "event_id", "bigint").alias("event_id"),
        payload_value(p, "event_type").alias("event_type"),
        payload_value(p, "value", "double").alias("value"),
        "source_ord",
    )


def w01_latest_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(up.latest_by_id(event_writes(spark, sf_dir)))


def _latest_sql(order: str) -> str:
    return f"""
SELECT {sql.uuid5("'user-' || user_id::VARCHAR")} AS point_id, user_id, event_id, event_type, value, event_id AS source_ord
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS rn FROM events) WHERE rn = 1
"""


def _is_batch() -> Column:
    return payload_value(F.col("payload"), "event_type").isin("click", "view")


def w01_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of some event types takes a batch of the others; the batch wins whatever its order."""
    writes = event_writes(spark, sf_dir)
    existing = up.latest_by_id(writes.filter(~_is_batch()))
    return _flat(up.upsert(existing, writes.filter(_is_batch())))


BATCH_WINS = "CASE WHEN event_type IN ('click', 'view') THEN 0 ELSE 1 END, event_id DESC"


def w01_point_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a table on disk: two commits, a repeated commit, compaction, a further read."""
    writes = event_writes(spark, sf_dir)
    table = PointTable(spark, scratch_dir(spark, "w01"))
    table.append(writes.filter(~_is_batch()), writer="events", batch=0)
    table.append(writes.filter(_is_batch()), writer="events", batch=1)
    table.append(writes.filter(~_is_batch()), writer="events", batch=0)
    table.compact()
    return _flat(table.read())


def w01_null_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with a point without an id is refused as a whole; the table stays as it was."""
    writes = event_writes(spark, sf_dir)
    table = PointTable(spark, scratch_dir(spark, "w01n"))
    table.append(writes, writer="events", batch=0)
    broken = F.when(F.col("source_ord") % 100 != 0, F.col("id"))
    try:
        table.append(writes.withColumn("id", broken), writer="events", batch=1)
    except Exception as refused:
        if "has no id" not in str(refused):
            raise
    table.compact()
    return _flat(table.read())


def j01_full_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job twice: counts per shard, what the first run created, and what the second did."""
    folder = scratch_dir(spark, "j01")
    table, catalog = PointTable(spark, f"{folder}/table"), CatalogStore(spark, f"{folder}/catalog")
    raw = staging.collection_raw(spark, sf_dir)
    runs = [full_copy(raw, normalize_collection, "docs", table, catalog, "docs", run=0) for _ in range(2)]
    return runs[1].shards.select(
        "shard", "source_count", "target_count", "matches", F.lit(runs[0].created_shards).cast("bigint").alias("shards_created"),
        F.lit(runs[1].created_fields + runs[1].created_shards).cast("bigint").alias("created_again"), F.lit(runs[1].wrong_sizes).cast("bigint").alias("wrong_sizes"),
    )


def j02_full_copy_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection of unnamed vectors with indexes, then by ranges a source that also has vectors it does not take."""
    folder = scratch_dir(spark, "j02")
    table, catalog = PointTable(spark, f"{folder}/table"), CatalogStore(spark, f"{folder}/catalog")
    raw = staging.collection_raw(spark, sf_dir)
    indexes = staging.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("field")).agg(F.lit("keyword").alias("type"), F.lit(None).cast("string").alias("params"))
    unnamed = raw.filter(F.col("source_ord") % 4 == 0)
    ranges = ByRanges("source_ord", ProgressStore(spark, f"{folder}/progress"), f"{folder}/plans", 4)
    first = full_copy(unnamed, normalize_collection, "docs", table, catalog, "docs", run=0, source_indexes=indexes)
    then = full_copy(raw, normalize_collection, "docs", table, catalog, "docs", run=1, source_indexes=indexes, by_ranges=ranges, rejects=f"{folder}/rejects")
    aside = spark.read.parquet(f"{folder}/rejects")
    aside = aside.groupBy(shard_text(F.col("shard_key")).alias("shard")).agg(F.count(F.lit(1)).alias("set_aside"))
    count = lambda n: F.lit(n).cast("bigint")
    return then.shards.join(aside, "shard", "left").select(
        "shard", "source_count", "target_count", F.coalesce("set_aside", count(0)).alias("set_aside"),
        count(first.created_indexes).alias("indexes_created"), count(then.created_indexes + then.created_fields).alias("created_again"),
        count(first.created_shards + then.created_shards).alias("shards_created"), count(then.wrong_sizes).alias("wrong_vectors"), F.lit(then.complete).alias("complete"),
    )


def w02_shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points written to shard folders, counted per folder."""
    points = staging.collection_raw(spark, sf_dir)
    folder = scratch_dir(spark, "w02")
    up.shard_write_layout(points).write.partitionBy("shard").parquet(folder)
    return spark.read.parquet(folder).groupBy(F.col("shard").cast("string").alias("shard")).agg(F.count(F.lit(1)).alias("n_points"))


def w02_new_shard_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard keys of the documents that the short documents do not register."""
    points = staging.collection_raw(spark, sf_dir)
    short = points.filter(payload_value(F.col("payload"), "n_chars", "bigint") < 30)
    fresh = up.new_shard_keys(points, up.shard_keys(short))
    return fresh.select(shard_text(F.struct("keyword", "number")).alias("shard"))


W02_SHARD = "CASE WHEN n_chars % 2 = 0 THEN 'k:' || lang ELSE 'n:' || (n_chars % 10)::VARCHAR END"

ENTRIES = {
    "w01_latest_by_id": (w01_latest_by_id, _latest_sql("event_id DESC")),
    "w01_upsert": (w01_upsert, _latest_sql(BATCH_WINS)),
    "w01_point_table": (w01_point_table, _latest_sql(BATCH_WINS)),
    "w01_null_ids": (w01_null_ids, _latest_sql("event_id DESC")),
    "j01_full_copy": (
        j01_full_copy,
        f"SELECT {W02_SHARD} AS shard, count(*) AS source_count, count(*) AS target_count, true AS matches, "
        f"(SELECT count(DISTINCT {W02_SHARD}) FROM documents) AS shards_created, 0::BIGINT AS created_again, 0::BIGINT AS wrong_sizes FROM documents GROUP BY 1",
    ),
    "j02_full_copy_rules": (
        j02_full_copy_rules,
        f"SELECT {W02_SHARD} AS shard, count(*) AS source_count, count(*) FILTER (doc_id % 4 IN (0, 3)) AS target_count, count(*) FILTER (doc_id % 4 IN (1, 2)) AS set_aside, "
        "(SELECT count(DISTINCT source) FROM documents) AS indexes_created, 0::BIGINT AS created_again, "
        f"(SELECT count(DISTINCT {W02_SHARD}) FROM documents) AS shards_created, "
        "(SELECT sum(CASE doc_id % 4 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END)::BIGINT FROM documents) AS wrong_vectors, false AS complete FROM documents GROUP BY 1",
    ),
    "w02_shard_counts": (w02_shard_counts, f"SELECT {W02_SHARD} AS shard, count(*) AS n_points FROM documents GROUP BY 1"),
    "w02_new_shard_keys": (
        w02_new_shard_keys,
        f"SELECT DISTINCT {W02_SHARD} AS shard FROM documents EXCEPT SELECT {W02_SHARD} FROM documents WHERE n_chars < 30",
    ),
}

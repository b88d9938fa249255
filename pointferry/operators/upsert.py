"""Idempotent upsert by id, and routing to shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pointferry.model import POINT_COLUMNS, shard_text
from pointferry.operators.sizing import MAX_BROADCAST_ROWS, is_small, stored

# An id with more than this share of all writes is hot; there are fewer such ids than this number.
HOT_IDS = 4096


def _content_hash(df: DataFrame) -> Column:
    """Breaks ties between writes with the same order number, so a replay picks the same one."""
    parts = []
    if "payload" in df.columns:
        parts.append(F.to_json("payload"))
    if "vectors" in df.columns:
        parts.append(F.sort_array(F.map_entries("vectors")))
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


def latest_by_id(writes: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The last write of every id; the id is the only key and the whole point is replaced.

    ``max_by`` is combined on the map side: each task sends one row per id it holds, so an id
    written by a third of all rows is no larger in the shuffle than any other.
    """
    ranks = [F.col(c) for c in (order or ["source_ord"])]
    rank = F.struct(*ranks, _content_hash(writes).alias("_tie"))
    winner = F.max_by(F.struct(*[c for c in writes.columns if c != "id"]), rank)
    return writes.groupBy("id").agg(winner.alias("_w")).select("id", "_w.*")


def upsert(existing: DataFrame, batch: DataFrame, order: list[str] | None = None, batch_rows: int | None = None) -> DataFrame:
    """The table after a batch: ids in the batch are replaced, all others are kept.

    Only the batch is reduced to one point per id; the table has one already. ``batch_rows``, where
    the caller knows it, bounds the batch's ids: few enough are sent to all tasks and the table is
    not shuffled, more are joined by shuffle.
    """
    latest = latest_by_id(batch, order)
    ids = latest.select("id")
    if batch_rows is not None and batch_rows <= MAX_BROADCAST_ROWS:
        ids = F.broadcast(ids)
    kept = existing.join(ids, "id", "left_anti")
    return kept.select(*POINT_COLUMNS).unionByName(latest.select(*POINT_COLUMNS))


def last_writes(log: DataFrame, order: list[str], buckets: int) -> tuple[DataFrame, DataFrame]:
    """The last write of every id of a stored log, and its ids.

    ``order`` tells all writes apart, as rows of files can be told apart. Winners are found on ids and
    order alone; vectors and payloads are neither aggregated nor compared. Where few ids were written
    more than once the other writes pass through as they lie. Otherwise they are shuffled once, into
    ``buckets`` by id, after the hot ids' losing writes were dropped where they lie.
    """
    rank = F.struct(*order)
    best = stored(log.select("id", rank.alias("_rank")).groupBy("id").agg(F.max("_rank").alias("_best"), F.count(F.lit(1)).alias("_n")), "last-writes")
    ids = best.select("id")
    repeated = best.filter("_n > 1")
    total = best.agg(F.sum("_n").alias("n"), F.count_if(F.col("_n") > 1).alias("repeated")).first()
    if not total["repeated"]:
        return log, ids
    wins = F.col("_best").isNull() | (rank >= F.col("_best"))  # no equality: the id alone is the join's key
    if is_small(repeated):
        return log.join(F.broadcast(repeated.select("id", "_best")), "id", "left").filter(wins).select(*log.columns), ids
    hot = F.col("_n") * HOT_IDS > total["n"]
    kept = log.join(F.broadcast(repeated.filter(hot).select("id", "_best")), "id", "left").filter(wins).select(*log.columns)
    others = repeated.filter(~hot).select("id", "_best").repartition(buckets, "id")
    return kept.repartition(buckets, "id").join(others, "id", "left").filter(wins).select(*log.columns), ids


def replace_ids(existing: DataFrame, ids: DataFrame, buckets: int) -> DataFrame:
    """The points of a bucketed table whose id is not among those of newer writes.

    A small set of ids is sent to all tasks. A larger one is dealt into the table's own buckets, so
    that the table itself is not shuffled.
    """
    ids = F.broadcast(ids) if is_small(ids) else ids.repartition(buckets, "id")
    return existing.join(ids, "id", "left_anti")


def shard_keys(points: DataFrame) -> DataFrame:
    """The distinct shard keys of a set of points; a keyword and a number never coincide."""
    keyed = points.filter(F.col("shard_key.keyword").isNotNull() | F.col("shard_key.number").isNotNull())
    return keyed.select(F.col("shard_key.keyword"), F.col("shard_key.number")).distinct()


def new_shard_keys(points: DataFrame, known: DataFrame) -> DataFrame:
    """Shard keys not registered yet."""
    seen = known.select(F.col("keyword").alias("_k"), F.col("number").alias("_n"))
    fresh = shard_keys(points)
    same = F.col("keyword").eqNullSafe(F.col("_k")) & F.col("number").eqNullSafe(F.col("_n"))
    return fresh.join(seen, same, "left_anti")


def route_to_shards(points: DataFrame) -> DataFrame:
    """Points with their shard as a text column to partition a write by."""
    return points.withColumn("shard", shard_text(F.col("shard_key")))


def shard_write_layout(points: DataFrame) -> DataFrame:
    """Rows gathered by shard before a partitioned write.

    A rebalance, not a plain repartition: adaptive execution merges small shards and splits a shard
    that holds much of the data over several tasks.
    """
    return route_to_shards(points).hint("rebalance", "shard")

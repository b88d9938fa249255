"""Progress records, ranges to resume, resumable copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pointferry.functions.ids import range_offset_name
from pointferry.model import id_text, payload_value
from pointferry.operators import ranges as rg
from pointferry.plans.jobs import copy_ranges
from pointferry.session import scratch_dir
from pointferry.sinks.point_table import PointTable
from pointferry.sources import normalize_pg
from pointferry.streaming.incremental import incremental_copy
from pointferry.streaming.progress import PROGRESS_COLUMNS, ProgressStore, delete_names, latest_records, progress_totals, resume_ranges, start_offsets, store_offsets
from pointferry.suite import scans, sql, staging

WORKERS = scans.WORKERS


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stored offsets of one source per user and type: numbers, texts and unusable ones."""
    events = staging.table(spark, sf_dir, "events")
    k = F.col("event_id") % 7
    return events.select(
        F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("name"),
        F.when(k < 3, F.col("event_id")).cast("decimal(20,0)").alias("offset_num"),
        F.when(k.between(3, 5), F.concat(F.lit("key-"), F.col("event_id").cast("string"))).alias("offset_text"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_id") + 1).alias("offset_count"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        F.col("event_id").alias("seq"),
        F.lit(False).alias("deleted"),
    ).select(*PROGRESS_COLUMNS)


def c02_start_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return start_offsets(event_records(spark, sf_dir))


_NAMED = "SELECT *, event_type || ':' || user_id::VARCHAR AS name FROM events"
C02_SQL = f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts DESC, event_id DESC) AS rn FROM ({_NAMED}) WHERE event_id % 7 < 6)
SELECT name, {sql.uuid5('name')} AS record_id, CASE WHEN event_id % 7 < 3 THEN event_id::VARCHAR ELSE 'key-' || event_id::VARCHAR END AS "offset",
       event_id % 7 < 3 AS is_number, event_id + 1 AS offset_count
FROM r WHERE rn = 1 AND event_id % 11 <> 0
"""


def c03_store_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record set takes updates; an update without an offset stores nothing."""
    records = event_records(spark, sf_dir)
    first = records.filter(~F.col("name").startswith("click:"))
    after = store_offsets(first.filter(F.col("seq") % 7 < 6), records.filter(F.col("name").startswith("click:")))
    newest = latest_records(after)
    return newest.select("name", "seq", F.coalesce(F.col("offset_num").cast("string"), "offset_text").alias("offset"))


C03_SQL = f"""
SELECT name, event_id AS seq, CASE WHEN event_id % 7 < 3 THEN event_id::VARCHAR ELSE 'key-' || event_id::VARCHAR END AS "offset"
FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts DESC, event_id DESC) AS rn FROM ({_NAMED}) WHERE event_id % 7 < 6) WHERE rn = 1
"""


def c04_delete_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finished sources' records go, the others' stay."""
    records = event_records(spark, sf_dir).filter(F.col("seq") % 7 < 6)
    finished = records.select("name").filter(F.col("name").startswith("error:")).distinct()
    ended = delete_names(finished, F.lit("2100-01-01 00:00:00"), F.lit(0))
    return latest_records(records.unionByName(ended)).select("name", "seq")


C04_SQL = f"""
SELECT name, max(event_id) AS seq FROM ({_NAMED}) WHERE event_id % 7 < 6 AND event_type <> 'error' GROUP BY name
"""


def c05_resumable_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of files, copied in two runs: the second takes only the file that came later."""
    folder = scratch_dir(spark, "c05")
    events = staging.table(spark, sf_dir, "events")
    early = F.col("event_type") != "signup"
    events.filter(early).repartition("event_id").write.mode("append").parquet(f"{folder}/in")
    table, progress = PointTable(spark, f"{folder}/table"), ProgressStore(spark, f"{folder}/progress")

    def run() -> None:
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
        copy = lambda df: normalize_pg(df, key_column="event_id", vector_columns=[])
        incremental_copy(stream, copy, table, f"{folder}/checkpoint", "events", progress)

    run()
    events.filter(~early).write.mode("append").parquet(f"{folder}/in")
    run()
    run()
    p = F.col("payload")
    counted = progress.start_offsets().select("offset_count").scalar()
    return table.read().select(
        id_text(F.col("id")).alias("point_id"),
        payload_value(p, "event_id", "bigint").alias("event_id"),
        payload_value(p, "ts").alias("ts"),
        payload_value(p, "value", "double").alias("value"),
        counted.alias("copied_rows"),
    )


C05_SQL = f"""
SELECT {sql.uuid5('event_id::VARCHAR')} AS point_id, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, value,
       (SELECT count(*) FROM events) AS copied_rows
FROM events
"""


def c05_range_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders copied by key ranges in several steps, then a repeat of the whole job."""
    folder = scratch_dir(spark, "c05r")
    orders = staging.table(spark, sf_dir, "orders")
    table, progress = PointTable(spark, f"{folder}/table"), ProgressStore(spark, f"{folder}/progress")
    copy = lambda df: normalize_pg(df, key_column="o_orderkey", vector_columns=[])
    for _ in range(2):
        copy_ranges(orders, "o_orderkey", copy, table, progress, f"{folder}/plans", "orders", WORKERS, ranges_per_step=3, cleanup=False)
    p = F.col("payload")
    return table.read().select(
        id_text(F.col("id")).alias("point_id"),
        payload_value(p, "o_orderkey", "bigint").alias("o_orderkey"),
        payload_value(p, "o_totalprice", "double").alias("o_totalprice"),
    )


def c05_restart_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy that starts over with a new checkpoint folder of the same last name, over a source that has grown."""
    folder = scratch_dir(spark, "c05n")
    events = staging.table(spark, sf_dir, "events")
    early = F.col("event_type") != "signup"
    table = PointTable(spark, f"{folder}/table")
    copy = lambda df: normalize_pg(df, key_column="event_id", vector_columns=[])
    for place, rows in (("a", events.filter(early)), ("b", events.filter(~early))):
        rows.write.mode("append").parquet(f"{folder}/in")
        incremental_copy(spark.readStream.schema(events.schema).parquet(f"{folder}/in"), copy, table, f"{folder}/{place}/checkpoint", "events")
    return table.read().select(payload_value(F.col("payload"), "event_id", "bigint").alias("event_id"))


def c06_growing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders copied by ranges while the last range has no rows yet, and again when it has."""
    folder = scratch_dir(spark, "c06g")
    orders = staging.table(spark, sf_dir, "orders")
    half = orders.agg((F.max("o_orderkey") / 2).cast("bigint")).scalar()
    table, progress = PointTable(spark, f"{folder}/table"), ProgressStore(spark, f"{folder}/progress")
    copy = lambda df: normalize_pg(df, key_column="o_orderkey", vector_columns=[])
    for rows in (orders.filter(F.col("o_orderkey") <= half), orders):
        for _ in range(2):
            copy_ranges(rows, "o_orderkey", copy, table, progress, f"{folder}/plans", "orders", WORKERS, ranges_per_step=1, cleanup=False)
    counted = progress.start_offsets().filter(F.col("name").contains("-range-")).agg(F.sum("offset_count")).scalar()
    return table.read().select(payload_value(F.col("payload"), "o_orderkey", "bigint").alias("o_orderkey"), counted.alias("counted"))


def _range_records(spark: SparkSession, sf_dir: str, table: DataFrame) -> DataFrame:
    """Progress of each range, as if the orders with status F had been copied up to their largest key."""
    orders = staging.table(spark, sf_dir, "orders")
    done = rg.assign_ranges(orders.filter(F.col("o_orderstatus") == "F"), "o_orderkey", table)
    per_range = done.groupBy("range_id").agg(F.max("o_orderkey").alias("last"), F.count(F.lit(1)).alias("n"))
    return per_range.select(
        range_offset_name(F.lit("orders"), F.lit(WORKERS), F.col("range_id")).alias("name"),
        F.col("last").cast("decimal(20,0)").alias("offset_num"),
        F.lit(None).cast("string").alias("offset_text"),
        F.col("n").alias("offset_count"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("updated_at"),
        F.lit(0).cast("bigint").alias("seq"),
        F.lit(False).alias("deleted"),
    )


def _worker_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = rg.boundary_sample(staging.table(spark, sf_dir, "orders"), "o_orderkey", WORKERS)
    return rg.ranges_per_worker(sample, "o_orderkey", WORKERS)


def c06_range_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _worker_ranges(spark, sf_dir)
    resumed = resume_ranges(table, _range_records(spark, sf_dir, table), "orders", WORKERS)
    return resumed.select("range_id", "name", F.coalesce("start_key", F.lit(-1)).alias("start_key"), F.coalesce("end_key", F.lit(-1)).alias("end_key"), "done_count", "done")


_DONE_SQL = """
d AS (SELECT range_id, max(o_orderkey) AS last, count(*) AS n FROM orders
      JOIN r ON (start_key IS NULL OR o_orderkey > start_key) AND (end_key IS NULL OR o_orderkey <= end_key)
      WHERE o_orderstatus = 'F' GROUP BY range_id)
"""
C06_SQL = f"""
WITH {scans._WORKER_RANGES}, {_DONE_SQL}
SELECT r.range_id, 'orders-workers-{WORKERS}-range-' || r.range_id::VARCHAR AS name, coalesce(d.last, r.start_key, -1) AS start_key,
       coalesce(r.end_key, -1) AS end_key, coalesce(d.n, 0)::BIGINT AS done_count, coalesce(d.last >= r.end_key, false) AS done
FROM r LEFT JOIN d USING (range_id)
"""


def c07_progress_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over ranges against source counts: one source by ranges, one by itself, one not begun."""
    records = _range_records(spark, sf_dir, _worker_ranges(spark, sf_dir))
    lines = staging.table(spark, sf_dir, "lineitem").agg(
        F.lit("lines").alias("name"),
        F.max("l_orderkey").cast("decimal(20,0)").alias("offset_num"),
        F.lit(None).cast("string").alias("offset_text"),
        F.count_if(F.col("l_returnflag") == "A").alias("offset_count"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("updated_at"),
        F.lit(0).cast("bigint").alias("seq"),
        F.lit(False).alias("deleted"),
    )
    counts = None
    for name, table in (("orders", "orders"), ("lines", "lineitem"), ("parts", "part")):
        one = staging.table(spark, sf_dir, table).agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("source_count"))
        counts = one if counts is None else counts.unionByName(one)
    return progress_totals(records.unionByName(lines), counts)


C07_SQL = """
WITH t AS (SELECT 'orders' AS source, count(*) AS source_count, count(*) FILTER (o_orderstatus = 'F') AS processed FROM orders
           UNION ALL SELECT 'lines', count(*), count(*) FILTER (l_returnflag = 'A') FROM lineitem
           UNION ALL SELECT 'parts', count(*), 0 FROM part)
SELECT source, source_count, processed, source_count - processed AS remaining FROM t
"""

ENTRIES = {
    "c02_start_offsets": (c02_start_offsets, C02_SQL),
    "c03_store_offsets": (c03_store_offsets, C03_SQL),
    "c04_delete_offsets": (c04_delete_offsets, C04_SQL),
    "c05_resumable_stream": (c05_resumable_stream, C05_SQL),
    "c05_range_copy": (
        c05_range_copy,
        f"SELECT {sql.uuid5('o_orderkey::VARCHAR')} AS point_id, o_orderkey, o_totalprice FROM orders",
    ),
    "c05_restart_new_checkpoint": (c05_restart_new_checkpoint, "SELECT event_id FROM events"),
    "c06_growing_source": (c06_growing_source, "SELECT o_orderkey, (SELECT count(*) FROM orders) AS counted FROM orders"),
    "c06_range_offsets": (c06_range_offsets, C06_SQL),
    "c07_progress_totals": (c07_progress_totals, C07_SQL),
}

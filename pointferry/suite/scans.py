"""Scans, pages, ranges, counts."""

from __future__ import annotations

import datetime

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from pointferry.functions.payload import fields_to_payload, json_fields, keep_payload
from pointferry.model import id_text, payload_kind, payload_value
from pointferry.operators import ranges, scan
from pointferry.suite import sql, staging

WORKERS = 8


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.table(spark, sf_dir, "orders")


def p01_full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def p02_keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.keyset_page(_orders(spark, sf_dir), "o_orderkey", after=700, limit=500).select("o_orderkey", "o_totalprice")


def p02b_inclusive_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = scan.keyset_page(_orders(spark, sf_dir), "o_orderkey", after=700, limit=500, inclusive=True)
    return page.select("o_orderkey", "o_totalprice")


def p03_offset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.offset_page(_orders(spark, sf_dir), "o_orderkey", offset=250, limit=500).select("o_orderkey", "o_orderstatus")


def p04_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = staging.table(spark, sf_dir, "lineitem")
    return scan.project(lines, ["l_orderkey", "l_linenumber", "l_quantity"], "l_orderkey")


def p05_lean_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = staging.table(spark, sf_dir, "events")
    full = F.to_json(F.struct("event_type", "value", "props", "user_id"))
    points = events.select("event_id", fields_to_payload(json_fields(full)).alias("payload"))
    lean = points.select("event_id", keep_payload(F.col("payload"), ["event_type", "user_id", "no_such"]).alias("payload"))
    payload = F.col("payload")
    return lean.select(
        "event_id",
        payload_value(payload, "event_type").alias("event_type"),
        payload_value(payload, "user_id", "bigint").alias("user_id"),
        payload_kind(payload, "value").alias("value_kind"),
        payload_kind(payload, "props").alias("props_kind"),
        payload_kind(payload, "no_such").alias("no_such_kind"),
    )


def p06_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = scan.prune(_orders(spark, sf_dir), o_orderstatus=["F", "O"], o_orderpriority="1-URGENT")
    return chosen.select("o_orderkey", "o_orderstatus")


def _range_bounds(spark: SparkSession, sf_dir: str) -> list[tuple]:
    """Start and end of every worker range over the orders."""
    sample = ranges.boundary_sample(_orders(spark, sf_dir), "o_orderkey", WORKERS)
    ends = ranges.boundaries_of(ranges.ranges_per_worker(sample, "o_orderkey", WORKERS))
    return list(zip([None] + ends, ends + [None]))


def _scan_all_ranges(spark: SparkSession, sf_dir: str, scan_one) -> DataFrame:
    lines = staging.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    parts = [
        scan_one(lines, "l_orderkey", start, end).withColumn("range_id", F.lit(i))
        for i, (start, end) in enumerate(_range_bounds(spark, sf_dir))
    ]
    return reduce(DataFrame.unionByName, parts)


def p07_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table, range by range: every row comes out once."""
    return _scan_all_ranges(spark, sf_dir, scan.range_scan)


def p08_closed_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table by ranges closed on both sides: rows on a boundary come out twice."""
    return _scan_all_ranges(spark, sf_dir, scan.closed_range_scan)


def p09_boundary_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.boundary_sample(_orders(spark, sf_dir), "o_orderkey", WORKERS)


SAMPLE_SQL = f"SELECT o_orderkey FROM orders ORDER BY md5('0:' || o_orderkey::VARCHAR), o_orderkey LIMIT {10 * WORKERS}"


def _text_ranges(df: DataFrame) -> DataFrame:
    return df.select(
        "range_id",
        F.coalesce(F.col("start_key").cast("string"), F.lit("-")).alias("start_key"),
        F.coalesce(F.col("end_key").cast("string"), F.lit("-")).alias("end_key"),
    )


def p10a_ranges_per_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = ranges.boundary_sample(_orders(spark, sf_dir), "o_orderkey", WORKERS)
    return _text_ranges(ranges.ranges_per_worker(sample, "o_orderkey", WORKERS))


_WORKER_RANGES = f"""
s AS ({SAMPLE_SQL}),
k AS (SELECT o_orderkey AS key, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM s),
w AS (SELECT CASE WHEN max(n) < {WORKERS} THEN max(n) + 1 ELSE {WORKERS} END AS ranges, max(n) AS n FROM k),
b AS (SELECT i.i AS i, (SELECT key FROM k WHERE pos = (i.i * w.n) // w.ranges) AS key
      FROM w, unnest(generate_series(1, w.ranges - 1)) AS i(i)),
e AS (SELECT i - 1 AS range_id, key AS end_key FROM b UNION ALL SELECT ranges - 1, NULL FROM w),
r AS (SELECT range_id::INTEGER AS range_id, lag(end_key) OVER (ORDER BY range_id) AS start_key, end_key FROM e)
"""
P10A_SQL = f"""
WITH {_WORKER_RANGES}
SELECT range_id, coalesce(start_key::VARCHAR, '-') AS start_key, coalesce(end_key::VARCHAR, '-') AS end_key FROM r
"""


def _range_scan_sql(low: str) -> str:
    return f"""
WITH {_WORKER_RANGES}
SELECT l_orderkey, l_linenumber, range_id FROM lineitem
JOIN r ON (start_key IS NULL OR l_orderkey {low} start_key) AND (end_key IS NULL OR l_orderkey <= end_key)
"""


def p10b_ranges_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = ranges.boundary_sample(_orders(spark, sf_dir), "o_orderkey", WORKERS)
    return _text_ranges(ranges.ranges_per_key(sample, "o_orderkey"))


P10B_SQL = f"""
WITH s AS ({SAMPLE_SQL}),
e AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS range_id, o_orderkey AS end_key FROM s
      UNION ALL SELECT count(*), NULL FROM s)
SELECT range_id::INTEGER AS range_id, coalesce(lag(end_key) OVER (ORDER BY range_id)::VARCHAR, '-') AS start_key,
       coalesce(end_key::VARCHAR, '-') AS end_key
FROM e
"""


def p11_assign_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = ranges.boundary_sample(_orders(spark, sf_dir), "o_orderkey", WORKERS)
    table = ranges.ranges_per_key(sample, "o_orderkey")
    lines = staging.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    assigned = ranges.assign_ranges(lines, "l_orderkey", table)
    return assigned.groupBy("range_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("l_orderkey").alias("low_key"),
        F.max("l_orderkey").alias("high_key"),
        F.sum("l_quantity").cast("bigint").alias("quantity"),
    )


MANY, APART, FAR = 350, 37, 1 << 62


def p11_assign_many_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More boundaries than a decision tree would hold, with NULLs: numbers near 2^62, text, and times."""
    lines = staging.table(spark, sf_dir, "lineitem")
    present = F.when(F.col("l_linenumber") != 7, F.col("l_orderkey"))
    rows = lines.select(
        "l_orderkey",
        "l_linenumber",
        (present + F.lit(FAR)).alias("number"),
        F.lpad(present.cast("string"), 12, "0").alias("text"),
        F.timestamp_add("SECOND", present.cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("time"),
    )
    at = [APART * (i + 1) for i in range(MANY)]
    start = datetime.datetime(2024, 1, 1)
    for name, ends in (("number", [FAR + b for b in at]), ("text", [f"{b:012d}" for b in at]), ("time", [start + datetime.timedelta(seconds=b) for b in at])):
        rows = ranges.assign_ranges(rows, name, ends, f"{name}_range")
    return rows.select("l_orderkey", "l_linenumber", "number_range", "text_range", "time_range")


_MANY = f"CASE WHEN l_linenumber <> 7 THEN least((l_orderkey - 1) // {APART}, {MANY})::INTEGER END"
P11_MANY_SQL = f"SELECT l_orderkey, l_linenumber, {_MANY} AS number_range, {_MANY} AS text_range, {_MANY} AS time_range FROM lineitem"

P11_SQL = f"""
WITH s AS ({SAMPLE_SQL}),
e AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS range_id, o_orderkey AS end_key FROM s
      UNION ALL SELECT count(*), NULL FROM s),
r AS (SELECT range_id, lag(end_key) OVER (ORDER BY range_id) AS start_key, end_key FROM e)
SELECT r.range_id::INTEGER AS range_id, count(*) AS n_rows, min(l_orderkey) AS low_key, max(l_orderkey) AS high_key,
       sum(l_quantity)::BIGINT AS quantity
FROM lineitem l JOIN r ON (r.start_key IS NULL OR l.l_orderkey > r.start_key) AND (r.end_key IS NULL OR l.l_orderkey <= r.end_key)
GROUP BY ALL
"""


def p12_point_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = staging.collection_raw(spark, sf_dir).select("id")
    return scan.point_order(points).select(id_text(F.col("id")).alias("point_id"), "order_key")


P12_SQL = f"""
SELECT CASE WHEN doc_id % 3 = 0 THEN {sql.uuid5("'doc-' || doc_id::VARCHAR")}
            ELSE (18446744073709551615::HUGEINT - doc_id)::VARCHAR END AS point_id,
       CASE WHEN doc_id % 3 = 0 THEN '2' || {sql.uuid5("'doc-' || doc_id::VARCHAR")}
            ELSE '1' || lpad((18446744073709551615::HUGEINT - doc_id)::VARCHAR, 20, '0') END AS order_key
FROM documents
"""


def p12_point_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of points in id order."""
    points = staging.collection_raw(spark, sf_dir).select("id")
    page = scan.keyset_page(scan.point_order(points), "order_key", after=None, limit=100)
    return page.select(id_text(F.col("id")).alias("point_id"))


def p13_exact_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.exact_count(staging.table(spark, sf_dir, "lineitem"), by=["l_returnflag", "l_linestatus"])


def p13_total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.exact_count(staging.table(spark, sf_dir, "lineitem"))


def p14_list_then_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of customer numbers, a third of which have no record."""
    listed = staging.table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3 % (F.col("c_custkey") + 7)).alias("c_custkey"))
    ids = listed.distinct()
    records = staging.table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 3 != 0).select("c_custkey", "c_name", "c_acctbal")
    return scan.list_then_fetch(ids, records, "c_custkey")


def p14_split_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a range copy can take by user: NULL and repeated keys are set aside."""
    events = staging.table(spark, sf_dir, "events")
    key = F.when(F.col("event_id") % 10 == 0, None).when(F.col("event_id") % 10 == 1, F.col("user_id")).otherwise(
        F.col("event_id") + 1000000
    )
    good, bad = scan.split_keys(events.select("event_id", key.alias("key")), "key")
    both = good.withColumn("reject_reason", F.lit("none")).unionByName(bad)
    return both.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"))


P14_SPLIT_SQL = """
WITH k AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN user_id ELSE event_id + 1000000 END AS key FROM events),
c AS (SELECT event_id, key, count(*) OVER (PARTITION BY key) AS n FROM k)
SELECT CASE WHEN key IS NULL THEN 'key is NULL' WHEN n > 1 THEN 'key is not unique' ELSE 'none' END AS reject_reason,
       count(*) AS n_rows, sum(event_id)::BIGINT AS id_sum
FROM c GROUP BY 1
"""

ENTRIES = {
    "p01_full_scan": (
        p01_full_scan,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders",
    ),
    "p02_keyset_page": (
        p02_keyset_page,
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 500",
    ),
    "p02b_inclusive_page": (
        p02b_inclusive_page,
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey >= 700 ORDER BY o_orderkey LIMIT 500",
    ),
    "p03_offset_page": (
        p03_offset_page,
        "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 250",
    ),
    "p04_projection": (p04_projection, "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem"),
    "p05_lean_payload": (
        p05_lean_payload,
        "SELECT event_id, event_type, user_id, 'missing' AS value_kind, 'missing' AS props_kind, 'missing' AS no_such_kind FROM events",
    ),
    "p06_prune": (
        p06_prune,
        "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT'",
    ),
    "p07_range_scan": (p07_range_scan, _range_scan_sql(">")),
    "p08_closed_range_scan": (p08_closed_range_scan, _range_scan_sql(">=")),
    "p09_boundary_sample": (p09_boundary_sample, SAMPLE_SQL),
    "p10a_ranges_per_worker": (p10a_ranges_per_worker, P10A_SQL),
    "p10b_ranges_per_key": (p10b_ranges_per_key, P10B_SQL),
    "p11_assign_many_ranges": (p11_assign_many_ranges, P11_MANY_SQL),
    "p11_assign_ranges": (p11_assign_ranges, P11_SQL),
    "p12_point_order": (p12_point_order, P12_SQL),
    "p12_point_page": (p12_point_page, f"SELECT point_id FROM ({P12_SQL}) ORDER BY order_key LIMIT 100"),
    "p13_exact_count": (
        p13_exact_count,
        "SELECT l_returnflag, l_linestatus, count(*) AS n_rows FROM lineitem GROUP BY ALL",
    ),
    "p13_total_count": (p13_total_count, "SELECT count(*) AS n_rows FROM lineitem"),
    "p14_list_then_fetch": (
        p14_list_then_fetch,
        """WITH ids AS (SELECT DISTINCT c_custkey * 3 % (c_custkey + 7) AS id FROM customer)
           SELECT c_custkey, c_name, c_acctbal FROM customer JOIN ids ON c_custkey = id WHERE c_custkey % 3 <> 0""",
    ),
    "p14_split_keys": (p14_split_keys, P14_SPLIT_SQL),
}

import random

import pytest
from pyspark.sql import functions as F, types as T

from pointferry.operators import ranges as rg, scan, sizing


def _keys(spark, keys, ddl="bigint"):
    return spark.createDataFrame([(k,) for k in keys], f"k {ddl}")


def _table(df):
    return [(r["start_key"], r["end_key"]) for r in df.orderBy("range_id").collect()]


@pytest.mark.parametrize("n_keys,workers", [(0, 4), (1, 4), (3, 4), (4, 4), (5, 4), (40, 4), (37, 8), (10, 1)])
def test_ranges_per_worker_follow_the_rule(spark, n_keys, workers):
    keys = sorted(random.Random(n_keys).sample(range(1000), n_keys))
    got = _table(rg.ranges_per_worker(_keys(spark, keys), "k", workers))
    n_ranges = workers if n_keys >= workers else n_keys + 1
    ends = [keys[i * n_keys // n_ranges] for i in range(1, n_ranges)]
    assert got == list(zip([None] + ends, ends + [None]))


@pytest.mark.parametrize("n_keys", [0, 1, 7])
def test_ranges_per_key(spark, n_keys):
    keys = list(range(10, 10 + n_keys))
    assert _table(rg.ranges_per_key(_keys(spark, keys), "k")) == list(zip([None] + keys, keys + [None]))


def test_sample_is_bounded_repeatable_and_reads_only_the_key(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    sample = rg.boundary_sample(orders, "o_orderkey", 4, seed=9)
    first = [r[0] for r in sample.collect()]
    again = [r[0] for r in rg.boundary_sample(orders.repartition(7), "o_orderkey", 4, seed=9).collect()]
    assert len(first) == 40 and first == again == sorted(first)
    assert first != [r[0] for r in rg.boundary_sample(orders, "o_orderkey", 4, seed=10).collect()]
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan and "TakeOrderedAndProject" in plan
    assert rg.boundary_sample(orders.limit(5), "o_orderkey", 4).count() == 5


@pytest.mark.parametrize("kind", ["number", "text"])
def test_search_agrees_with_plain_ranges(spark, kind):
    rng = random.Random(1)
    bounds = sorted(rng.sample(range(5000), 300))
    keys = bounds + [rng.randrange(5000) for _ in range(500)]
    if kind == "text":
        bounds, keys = sorted(f"é{b:05d}" for b in bounds), [f"é{k:05d}" for k in keys]
    df = _keys(spark, keys + [None], "string" if kind == "text" else "bigint")
    want = {k: sum(b < k for b in bounds) for k in keys}
    many = {r["k"]: r["range_id"] for r in rg.assign_ranges(df, "k", bounds).collect()}
    few = bounds[::5]
    fewer = {r["k"]: r["range_id"] for r in rg.assign_ranges(df, "k", few).collect()}
    assert many == {**want, None: None}
    assert fewer == {**{k: sum(b < k for b in few) for k in keys}, None: None}


def test_sample_of_many_rows_is_the_same(spark, monkeypatch):
    df = _keys(spark, list(range(3000)), "bigint")
    few = rg.boundary_sample(df, "k", 2).collect()
    monkeypatch.setattr(rg, "MANY_ROWS", 10**9)
    assert few == rg.boundary_sample(df, "k", 2).collect() and len(few) == 20


def test_range_table_round_trip(spark):
    table = rg.range_table(spark, [3, 9], T.LongType())
    assert _table(table) == [(None, 3), (3, 9), (9, None)] and rg.boundaries_of(table) == [3, 9]


def test_bounds_reach_the_scan(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = scan.range_scan(lines, "l_orderkey", 10, 20).select("l_tax")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_orderkey,10), LessThanOrEqual(l_orderkey,20)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan


def test_partition_values_prune_folders(spark, tmp_path, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.write.partitionBy("o_orderstatus").parquet(str(tmp_path / "t"))
    pruned = scan.prune(spark.read.parquet(str(tmp_path / "t")), o_orderstatus="F", o_orderpriority=None)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan
    assert pruned.count() == orders.filter("o_orderstatus = 'F'").count()


def test_pages_walk_the_whole_table(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    seen, after = [], None
    while page := [r[0] for r in scan.keyset_page(orders, "o_orderkey", after, 400).collect()]:
        seen += page
        after = page[-1]
    by_offset = [r[0] for at in range(0, 1600, 400) for r in scan.offset_page(orders, "o_orderkey", at, 400).collect()]
    assert seen == by_offset == sorted(r[0] for r in orders.collect())
    with pytest.raises(ValueError, match="a page holds"):
        scan.keyset_page(orders, "o_orderkey", None, 0)


def test_projection_needs_key_and_known_columns(spark):
    df = spark.range(1).withColumn("b", F.lit(1))
    assert scan.project(df, ["id"], "id").columns == ["id"] and scan.project(df, [], "id").columns == ["id", "b"]
    with pytest.raises(ValueError, match="key column"):
        scan.project(df, ["b"], "id")
    with pytest.raises(ValueError, match="unknown columns"):
        scan.project(df, ["id", "c"], "id")


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_split_keys_with_one_very_hot_key(spark, monkeypatch, limit):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", limit)
    df = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(-1)).when(F.col("id") % 100 != 0, F.col("id")).alias("k"), "id")
    good, bad = scan.split_keys(df, "k")
    counts = {r["reject_reason"]: r["count"] for r in bad.groupBy("reject_reason").count().collect()}
    assert counts == {"key is NULL": 20, "key is not unique": 1000} and good.count() == 1980


def test_range_partitions_are_sorted_and_disjoint(spark):
    df = rg.range_partitions(spark.range(10000).select((F.hash("id") % 100000).alias("k")), "k", 4)
    parts = df.rdd.mapPartitions(lambda it: [[r[0] for r in it]]).collect()
    assert sum(len(p) for p in parts) == 10000 and all(p == sorted(p) for p in parts)
    filled = [p for p in parts if p]
    assert all(a[-1] <= b[0] for a, b in zip(filled, filled[1:]))

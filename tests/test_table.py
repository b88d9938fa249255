"""The point table, shard routing, and whole copies."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from pointferry.model import POINT_COLUMNS
from pointferry.operators import sizing, upsert as up
from pointferry.plans.jobs import copy_all, copy_ranges
from pointferry.sinks.point_table import PointTable
from pointferry.sources import normalize_pg
from pointferry.streaming.progress import ProgressStore


def writes(spark, rows):
    """rows: (number, text, order)"""
    df = spark.createDataFrame(rows, "n bigint, text string, o bigint")
    return df.select(
        F.struct(F.col("n").cast("decimal(20,0)").alias("num"), F.lit(None).cast("string").alias("uuid")).alias("id"),
        F.expr("map()").cast("map<string,struct<data:array<float>,indices:array<bigint>,vectors_count:int>>").alias("vectors"),
        F.to_variant_object(F.struct("text")).alias("payload"),
        F.struct(F.when(F.col("n") % 2 == 0, F.lit("even")).alias("keyword"), F.when(F.col("n") % 2 == 1, F.lit(1)).cast("decimal(20,0)").alias("number")).alias("shard_key"),
        F.col("o").alias("source_ord"),
    )


def content(points):
    rows = points.select(F.col("id.num").cast("int").alias("n"), F.to_json("payload").alias("p")).collect()
    got = {r["n"]: json.loads(r["p"])["text"] for r in rows}
    assert len(got) == len(rows), "an id came out twice"
    return got


def test_latest_write_wins_and_ties_are_stable(spark):
    rows = [(1, "old", 1), (1, "new", 2), (2, "a", 5), (2, "b", 5)]
    first = content(up.latest_by_id(writes(spark, rows)))
    again = content(up.latest_by_id(writes(spark, rows[::-1]).repartition(3)))
    assert first == again and first[1] == "new"


def test_hot_id_leaves_each_task_as_one_row(spark):
    df = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("n"), F.col("id").cast("string").alias("text"), F.col("id").alias("o"))
    w = df.select(F.struct(F.col("n").cast("decimal(20,0)").alias("num"), F.lit(None).cast("string").alias("uuid")).alias("id"), "text", F.col("o").alias("source_ord"))
    latest = up.latest_by_id(w)
    assert latest.count() == 20001
    assert latest.filter("id.num = -1").first()["text"] == "29997"
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan


def test_upsert_by_broadcast_and_by_shuffle_agree(spark):
    table = writes(spark, [(1, "a", 9), (2, "b", 9), (3, "c", 9)])
    batch = writes(spark, [(2, "B1", 0), (2, "B2", 1), (4, "D", 0)])
    want = {1: "a", 2: "B2", 3: "c", 4: "D"}
    assert content(up.upsert(table, batch)) == want
    assert content(up.upsert(table, batch, batch_rows=3)) == want
    assert content(up.upsert(table, batch, batch_rows=sizing.MAX_BROADCAST_ROWS + 1)) == want


def test_commits_replay_and_compaction(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "t"))
    assert table.read().count() == 0 and table.compact() == 0
    table.append(writes(spark, [(1, "a", 9), (2, "b", 9)]), "w", 0)
    table.append(writes(spark, [(2, "B", 1), (3, "c", 1)]), "w", 1)
    want = {1: "a", 2: "B", 3: "c"}
    assert content(table.read()) == want
    # A repeated batch is recognised by writer and number, whatever it holds now.
    table.append(writes(spark, [(2, "again", 99)]), "w", 0)
    assert content(table.read()) == want
    assert table.compact() == 2 and table.compact() == 2
    assert content(table.read()) == want
    table.append(writes(spark, [(1, "A", 0), (4, "d", 0)]), "other/writer é", 0)
    assert content(table.read()) == {1: "A", 2: "B", 3: "c", 4: "d"}
    table.append(writes(spark, [(2, "again", 99)]), "w", 1)
    assert content(table.read())[2] == "B"
    assert table.compact() == 3
    assert content(table.read()) == {1: "A", 2: "B", 3: "c", 4: "d"}


def test_vacuum_keeps_the_table_and_its_memory_of_batches(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "t"))
    table.append(writes(spark, [(1, "a", 0)]), "w", 0)
    table.compact()
    table.append(writes(spark, [(2, "b", 0)]), "w", 1)
    table.compact()
    table.append(writes(spark, [(3, "c", 0)]), "w", 2)
    assert table.vacuum() > 0 and table.vacuum() == 0
    assert content(table.read()) == {1: "a", 2: "b", 3: "c"}
    assert [p.name for p in (tmp_path / "t" / "base").iterdir()] == ["upto=2"]
    table.append(writes(spark, [(1, "again", 9)]), "w", 0)
    table.compact()
    assert content(table.read()) == {1: "a", 2: "b", 3: "c"}


def test_first_base_by_both_ways(spark, tmp_path, monkeypatch):
    rows = [(n, f"t{n}", 0) for n in range(50)] + [(7, "late", 1), (9, "late", 1)]
    want = {**{n: f"t{n}" for n in range(50)}, 7: "late", 9: "late"}
    for limit in (sizing.MAX_BROADCAST_ROWS, 1):
        monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", limit)
        table = PointTable(spark, str(tmp_path / f"t{limit}"))
        table.append(writes(spark, rows), "w")
        table.compact()
        assert content(table.read()) == want


def test_unfinished_commit_is_not_seen(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "t"))
    table.append(writes(spark, [(1, "a", 0)]), "w", 0)
    folder = table.append(writes(spark, [(1, "half", 0)]), "w", 1)
    os.remove(f"{folder}/_committed")
    assert content(table.read()) == {1: "a"}
    table.append(writes(spark, [(1, "whole", 0)]), "w", 1)
    assert content(table.read()) == {1: "whole"}


def test_commits_count_without_the_committer_marker(spark, tmp_path):
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        table = PointTable(spark, str(tmp_path / "t"))
        folder = table.append(writes(spark, [(1, "a", 0)]), "w", 0)
        assert table.append(writes(spark, [(1, "again", 0)]), "w", 0) == folder
        table.compact()
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert content(table.read()) == {1: "a"} and not os.path.exists(f"{folder}/_SUCCESS")


def test_a_new_run_takes_what_has_grown(spark, sf_dir, tmp_path):
    orders = _orders(spark, sf_dir)
    table = PointTable(spark, str(tmp_path / "t"))
    few = orders.filter("o_orderkey % 2 = 0")
    assert copy_all(few, _copy, table, "orders", run=0).complete
    assert not copy_all(orders, _copy, table, "orders", run=0).complete
    assert copy_all(orders, _copy, table, "orders", run=1).complete


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from pointferry.session import scratch_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(cluster, "x")


def test_one_shard_opens_one_folder(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "t"))
    table.append(writes(spark, [(n, str(n), 0) for n in range(10)]), "w")
    with pytest.raises(ValueError, match="compact"):
        table.read_shard("k:even")
    table.compact()
    shard = table.read_shard("k:even")
    assert set(content(shard)) == {0, 2, 4, 6, 8} and set(content(table.read_shard("n:1"))) == {1, 3, 5, 7, 9}
    assert "PartitionFilters: [isnotnull(shard" in shard._jdf.queryExecution().executedPlan().toString()


def test_keyword_and_number_shards_stay_apart(spark):
    df = spark.sql("SELECT named_struct('keyword', k, 'number', CAST(n AS decimal(20,0))) AS shard_key FROM VALUES ('1', null), (null, 1), (null, null), ('1', null) AS t(k, n)")
    keys = up.shard_keys(df)
    assert keys.count() == 2
    assert sorted(r["shard"] for r in up.route_to_shards(df).collect()) == ["-", "k:1", "k:1", "n:1"]
    known = spark.sql("SELECT '1' AS keyword, CAST(null AS decimal(20,0)) AS number")
    assert [tuple(map(str, r)) for r in up.new_shard_keys(df, known).collect()] == [("None", "1")]


def _orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def _copy(df):
    return normalize_pg(df, key_column="o_orderkey", vector_columns=[])


def _canonical(points):
    return {(r[0], r[1]) for r in points.select("id.uuid", F.to_json("payload")).collect()}


@pytest.mark.parametrize("workers,per_key", [(1, False), (4, False), (2, True)])
def test_parallel_copy_equals_one_pass(spark, sf_dir, tmp_path, workers, per_key):
    orders = _orders(spark, sf_dir)
    report = copy_ranges(
        orders, "o_orderkey", _copy, PointTable(spark, str(tmp_path / "r")), ProgressStore(spark, str(tmp_path / "p")), str(tmp_path / "plans"), "orders", workers, per_sampled_key=per_key
    )
    one = PointTable(spark, str(tmp_path / "one"))
    assert copy_all(orders, _copy, one, "orders", run=0).complete and report.complete
    assert _canonical(PointTable(spark, str(tmp_path / "r")).read()) == _canonical(one.read()) == _canonical(_copy(orders))
    assert ProgressStore(spark, str(tmp_path / "p")).start_offsets().count() == 0


def test_interrupted_copy_goes_on(spark, sf_dir, tmp_path):
    orders = _orders(spark, sf_dir)
    table, progress = PointTable(spark, str(tmp_path / "t")), ProgressStore(spark, str(tmp_path / "p"))
    calls = []

    def failing(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return _copy(df)

    args = (table, progress, str(tmp_path / "plans"), "orders", 6)
    with pytest.raises(RuntimeError):
        copy_ranges(orders, "o_orderkey", failing, *args, ranges_per_step=2)
    before = {r["name"]: r["offset_count"] for r in progress.start_offsets().collect() if "range" in r["name"]}
    assert sorted(before) == ["orders-workers-6-range-0", "orders-workers-6-range-1"]
    report = copy_ranges(orders, "o_orderkey", _copy, *args, ranges_per_step=2, cleanup=False)
    assert report.steps == 2 and report.source_count == report.target_count == orders.count()
    counts = {r["name"]: r["offset_count"] for r in progress.start_offsets().collect() if "range" in r["name"]}
    assert sum(counts.values()) == orders.count() and before.items() <= counts.items()
    assert _canonical(table.read()) == _canonical(_copy(orders))
    # All ranges are done but the open one, which finds nothing new.
    again = copy_ranges(orders, "o_orderkey", _copy, *args, cleanup=False)
    assert again.steps == 1 and again.target_count == orders.count()
    assert sum(r["offset_count"] for r in progress.start_offsets().collect() if "range" in r["name"]) == orders.count()


def test_restart_copies_again(spark, sf_dir, tmp_path):
    orders = _orders(spark, sf_dir)
    table, progress = PointTable(spark, str(tmp_path / "t")), ProgressStore(spark, str(tmp_path / "p"))
    args = ("o_orderkey", _copy, table, progress, str(tmp_path / "plans"), "orders", 3)
    copy_ranges(orders, *args, cleanup=False)
    changed = orders.withColumn("o_orderstatus", F.lit("Z"))
    copy_ranges(changed, *args, cleanup=False)
    assert _canonical(table.read()) == _canonical(_copy(orders))
    copy_ranges(changed, *args, restart=True)
    assert _canonical(table.read()) == _canonical(_copy(changed))


def test_empty_source_copies_to_an_empty_table(spark, sf_dir, tmp_path):
    empty = _orders(spark, sf_dir).filter("o_orderkey < 0")
    report = copy_ranges(empty, "o_orderkey", _copy, PointTable(spark, str(tmp_path / "t")), ProgressStore(spark, str(tmp_path / "p")), str(tmp_path / "plans"), "orders", 4)
    assert (report.source_count, report.target_count) == (0, 0)


def test_point_columns_are_what_a_commit_holds(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "t"))
    folder = table.append(writes(spark, [(1, "a", 0)]).withColumn("more", F.lit(1)), "w")
    assert spark.read.parquet(folder).columns == POINT_COLUMNS and table.count_commit(folder) == 1
    shutil.rmtree(folder)


def test_a_range_step_reads_its_rows_once(spark, sf_dir, tmp_path, monkeypatch):
    staged = str(tmp_path / "orders")
    _orders(spark, sf_dir).write.parquet(staged)
    orders, stages = spark.read.parquet(staged), []
    stage = PointTable.stage
    monkeypatch.setattr(PointTable, "stage", lambda self, points: stages.append(points._jdf.queryExecution().executedPlan().toString()) or stage(self, points))
    table, progress = PointTable(spark, str(tmp_path / "t")), ProgressStore(spark, str(tmp_path / "p"))
    report = copy_ranges(orders, "o_orderkey", _copy, table, progress, str(tmp_path / "plans"), "orders", 6, ranges_per_step=3, cleanup=False)
    assert len(stages) == report.steps == 2 and all(plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan for plan in stages)
    counts = {r["name"]: (r["offset"], r["offset_count"]) for r in progress.start_offsets().collect() if "range" in r["name"]}
    ranges = spark.read.parquet(f"{tmp_path}/plans/*").orderBy("range_id").collect()
    for r in ranges:
        inside = orders.filter((F.col("o_orderkey") > (r["start_key"] or -1)) & (F.col("o_orderkey") <= (r["end_key"] or 10**9)))
        last = r["end_key"] or inside.agg(F.max("o_orderkey")).first()[0]
        assert counts[f"orders-workers-6-range-{r['range_id']}"] == (str(last), inside.count())


def test_complete_is_about_the_rows_of_this_run(spark, sf_dir, tmp_path):
    orders = _orders(spark, sf_dir)
    table = PointTable(spark, str(tmp_path / "t"))
    copy_all(orders, _copy, table, "older", run=0)
    # Older points do not make up for rows that were lost.
    some_lost = lambda df: _copy(df).filter("id.uuid > '4'")
    assert not copy_all(orders, some_lost, table, "orders", run=0).complete
    args = ("o_orderkey", some_lost, table, ProgressStore(spark, str(tmp_path / "p")), str(tmp_path / "plans"), "lossy", 3)
    assert not copy_ranges(orders, *args).complete
    # A source with repeated ids is complete with fewer points than rows.
    twice = orders.unionByName(orders)
    report = copy_all(twice, _copy, PointTable(spark, str(tmp_path / "u")), "twice", run=0)
    assert report.complete and report.target_count == orders.count() and report.source_count == 2 * orders.count()

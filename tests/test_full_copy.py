"""The whole job: one catalog version, points set aside, resumption, and an honest end."""

import threading

import pytest
from pyspark.sql import functions as F

from pointferry.model import VECTORS_TYPE
from pointferry.plans.full_copy import ByRanges, CatalogStore, full_copy
from pointferry.plans.catalog import facts_of_points, size_violations
from pointferry.sinks.point_table import PointTable
from pointferry.sources import normalize_collection
from pointferry.streaming.progress import ProgressStore


def _raw(spark, rows):
    """rows: (number, shard keyword, size of the vector '' or None)"""
    df = spark.createDataFrame(rows, "n bigint, shard string, size int")
    vec = F.struct(F.array_repeat(F.lit(1.0).cast("float"), F.col("size")).alias("data"), F.lit(None).cast("array<bigint>").alias("indices"), F.lit(None).cast("int").alias("vectors_count"))
    return df.select(
        F.struct(F.col("n").cast("decimal(20,0)").alias("num"), F.lit(None).cast("string").alias("uuid")).alias("id"),
        F.when(F.col("size").isNotNull(), F.create_map(F.lit(""), vec)).cast(VECTORS_TYPE).alias("vectors"),
        F.to_variant_object(F.struct("n")).alias("payload"),
        F.struct(F.col("shard").alias("keyword"), F.lit(None).cast("decimal(20,0)").alias("number")).alias("shard_key"),
        F.col("n").alias("source_ord"),
    )


ROWS = [(n, "ab"[n % 2] if n % 5 else None, 3 if n % 7 else None) for n in range(60)]
WRONG = [(100, "a", 4), (101, "c", 5)]


def _ids(df):
    return sorted(int(r[0]) for r in df.select("id.num").collect())


@pytest.fixture
def store(spark, tmp_path):
    return PointTable(spark, str(tmp_path / "table")), CatalogStore(spark, str(tmp_path / "catalog"))


INDEXES = [("city", "keyword", None), ("odd", "unknown", None), ("when", "datetime", "{}")]


def test_fields_shards_and_indexes_are_one_version(spark, store):
    table, catalog = store
    indexes = spark.createDataFrame(INDEXES, "field string, type string, params string")
    args = (_raw(spark, ROWS), normalize_collection, "c", table, catalog, "src")
    first = full_copy(*args, run=0, source_indexes=indexes)
    assert (first.created_fields, first.created_shards, first.created_indexes, first.rejected) == (1, 2, 2, 0) and first.complete
    assert catalog.latest().number == 1
    assert {tuple(r) for r in catalog.indexes("c").collect()} == {("city", "keyword", None), ("when", "datetime", "{}")}
    again = full_copy(*args, run=0, source_indexes=indexes)
    assert (again.created_fields, again.created_shards, again.created_indexes) == (0, 0, 0) and catalog.latest().number == 1 and again.complete
    more = full_copy(_raw(spark, ROWS + [(90, "z", 3)]), normalize_collection, "c", table, catalog, "src", run=1, source_indexes=spark.createDataFrame([("n", "integer", None)], "field string, type string, params string"))
    assert (more.created_fields, more.created_shards, more.created_indexes) == (0, 1, 1) and more.complete


def test_vectors_of_a_wrong_size_are_set_aside(spark, store, tmp_path):
    table, catalog = store
    folder = str(tmp_path / "rejects")
    full_copy(_raw(spark, ROWS), normalize_collection, "c", table, catalog, "src", run=0)
    report = full_copy(_raw(spark, ROWS + WRONG), normalize_collection, "c", table, catalog, "src", run=1, rejects=folder)
    assert (report.rejected, report.wrong_sizes, report.complete) == (2, 2, False)
    assert _ids(table.read()) == [n for n, _, _ in ROWS]
    kept = spark.read.parquet(folder)
    assert _ids(kept) == [100, 101] and {r[0] for r in kept.select(F.col("problems")[0]["reason"]).collect()} == {"other size"}
    fields = catalog.fields().select("field", "kind", "size")
    assert size_violations(table.read(), fields).count() == 0


def test_a_field_of_several_sizes_needs_one_named(spark, store):
    table, catalog = store
    raw = _raw(spark, ROWS + WRONG)
    with pytest.raises(Exception, match="several sizes"):
        full_copy(raw, normalize_collection, "c", table, catalog, "src", run=0)
    assert catalog.latest().number == 0 and table.read().count() == 0
    report = full_copy(raw, normalize_collection, "c", table, catalog, "src", run=0, sizes={"": 3})
    assert report.rejected == 2 and _ids(table.read()) == [n for n, _, _ in ROWS]


def test_the_source_catalog_is_copied_under_the_new_name(spark, store):
    table, catalog = store
    theirs = spark.createDataFrame([("old", "", "dense", 3, "dot"), ("old", "terms", "sparse", None, None)], "collection string, field string, kind string, size bigint, distance string")
    report = full_copy(_raw(spark, ROWS), normalize_collection, "new", table, catalog, "src", run=0, source_fields=theirs)
    assert report.created_fields == 2 and report.complete
    assert {(r["collection"], r["field"], r["distance"]) for r in catalog.fields().collect()} == {("new", "", "dot"), ("new", "terms", None)}
    assert full_copy(_raw(spark, ROWS), normalize_collection, "new", table, catalog, "src", run=0, source_fields=theirs).created_fields == 0


def test_a_stopped_job_goes_on(spark, store, tmp_path):
    table, catalog = store
    raw = _raw(spark, ROWS).withColumn("key", F.col("source_ord"))
    ranges = ByRanges("key", ProgressStore(spark, str(tmp_path / "p")), str(tmp_path / "plans"), 4, ranges_per_step=1)
    calls = []

    def stopping(df):
        calls.append(1)
        if len(calls) == 4:  # the plan, two steps, then it stops
            raise RuntimeError("stopped")
        return normalize_collection(df)

    with pytest.raises(RuntimeError):
        full_copy(raw, stopping, "c", table, catalog, "src", run=0, by_ranges=ranges)
    part = table.read().count()
    assert 0 < part < len(ROWS)
    report = full_copy(raw, normalize_collection, "c", table, catalog, "src", run=0, by_ranges=ranges)
    assert report.complete and report.copy.steps == 2 and _ids(table.read()) == [n for n, _, _ in ROWS]


def test_two_jobs_register_each_shard_once(spark, store):
    _, catalog = store
    gate = threading.Barrier(2, timeout=60)

    def adding(keys):
        first = []

        def plan(version):
            rows = spark.createDataFrame([("c", k, None) for k in keys], "collection string, keyword string, number decimal(20,0)")
            fresh = rows.join(version.shard_keys("c").select("keyword"), "keyword", "left_anti")
            if not first:  # both have read the same version
                first.append(1)
                gate.wait()
            return {"shards": fresh}

        return catalog.update(plan)["shards"]

    counts = []
    jobs = [threading.Thread(target=lambda k=k: counts.append(adding(k))) for k in ("ab", "bc")]
    [j.start() for j in jobs]
    [j.join() for j in jobs]
    assert sorted(r["keyword"] for r in catalog.shard_keys("c").collect()) == ["a", "b", "c"]
    assert sorted(counts) == [1, 2] and catalog.latest().number == 2


def test_facts_are_one_pass(spark):
    facts = facts_of_points(_raw(spark, ROWS + WRONG))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Scan") == 1
    rows = {(r["field"], r["keyword"]): (r["low"], r["high"], r["n"]) for r in facts.collect()}
    assert rows[("", None)][:2] == (3, 5) and rows[(None, "c")] == (None, None, 1) and rows[(None, None)][2] == 12
    assert facts_of_points(_raw(spark, [])).count() == 0

"""Large key sets, and comparison of large tables that are nearly the same."""

import pytest
from pyspark.sql import functions as F

from pointferry.operators import scan, search, sizing, verify
from pointferry.suite import verification
from tests.test_table import writes


@pytest.mark.parametrize("kind", ["bigint", "string", "struct"])
def test_maybe_members_loses_none_and_lets_few_through(spark, kind):
    made = {"bigint": F.col("id"), "string": F.format_string("k-%d", "id"), "struct": F.struct(F.col("id").alias("a"), F.lit(None).cast("string").alias("b"))}[kind]
    rows = spark.range(200_000).select("id", made.alias("key"))
    keys = rows.filter("id % 10 = 0").select("key").unionByName(rows.limit(1).select(F.lit(None).cast(rows.schema["key"].dataType).alias("key")))
    got = sizing.maybe_members(rows, keys, "key")
    assert got.columns == ["id", "key"]
    found = got.agg(F.count_if(F.col("id") % 10 == 0).alias("members"), F.count_if(F.col("id") % 10 != 0).alias("others")).first()
    assert found["members"] == 20_000 and found["others"] < 2_000


def test_a_long_list_keeps_other_records_out_of_the_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 1)
    spark.range(50_000).select(F.col("id").alias("key"), F.repeat(F.lit("x"), 50).alias("body")).write.parquet(str(tmp_path / "records"))
    records = spark.read.parquet(str(tmp_path / "records"))
    ids = records.filter("key % 100 = 7").select("key").unionByName(spark.range(60_000, 60_010).withColumnRenamed("id", "key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = scan.list_then_fetch(ids.unionByName(ids), records, "key")
        plan = got._jdf.queryExecution().executedPlan().toString()
        join, shuffle, bitmap = (plan.index(x) for x in ("SortMergeJoin", "Exchange hashpartitioning(key", "BroadcastHashJoin"))
        assert join < shuffle < bitmap  # the bitmap stands between the scan and the exchange
        assert sorted(r["key"] for r in got.select("key").collect()) == list(range(7, 50_000, 100))
        texts = search.lookup_text(ids, records, "key", "body").collect()
        assert len(texts) == 510 and sum(r["body"] == "" for r in texts) == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _numbers(df):
    return {int(r["n"]): r["status"] for r in df.select("id.num", "status").toDF("n", "status").collect()}


@pytest.mark.parametrize("buckets", [1, 64, 1 << 16])
def test_differences_are_those_of_the_full_comparison(spark, buckets):
    mine = [(n, f"t{n}", 0) for n in range(300)] + [(5, "again", 0), (6, "t6", 0)]
    theirs = [(n, f"t{n}" if n % 50 else "other", 0) for n in range(3, 310)] + [(6, "t6", 0)]
    a, b = writes(spark, mine), writes(spark, theirs)
    want = {n: s for n, s in _numbers(verify.compare_points(a, b)).items() if s != "same"}
    assert _numbers(verify.differences(a, b, buckets)) == want and want[5] == "changed" and 6 not in want
    assert verify.differences(a, writes(spark, mine[::-1]).repartition(7), buckets).count() == 0
    assert verify.differences(a.limit(0), b.limit(0), buckets).count() == 0


def test_equal_tables_shuffle_sums_only(spark):
    a, b = (writes(spark, [(n, f"t{n}", 0) for n in range(2000)]).repartition(3) for _ in range(2))
    unequal = verify.unequal_buckets(a, b, 16)
    assert unequal.count() == 0
    plan = unequal._jdf.queryExecution().executedPlan().toString()
    first = plan.index("Exchange hashpartitioning(bucket")
    assert "HashAggregate" in plan[first:] and "partial_sum" in plan


@pytest.mark.parametrize("name", ["v02_compare_points", "v02_differences", "v02_repeated_ids"])
def test_compared_points_are_joined_with_their_vectors_once(spark, tmp_path, name):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), (F.col("id") + 9).alias("n_chars"))
    docs.unionByName(docs.filter("doc_id = 7")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(4).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5).cast("float")).alias("embedding")).write.parquet(str(tmp_path / "embeddings.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the embeddings were many
    try:
        got = verification.ENTRIES[name][0](spark, str(tmp_path))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "embeddings.parquet" not in plan and "vec_id" not in plan
        differ = {r["status"] for r in got.collect()} - {"same"}
        assert differ == ({"changed"} if name == "v02_repeated_ids" else {"missing", "changed", "extra"})
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

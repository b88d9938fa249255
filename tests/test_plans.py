"""What the plans must look like."""

import pytest
from pyspark.sql import functions as F

from pointferry import sources as src
from pointferry.functions.ids import to_point_uuid
from pointferry.operators import upsert as up, verify
from pointferry.sinks.point_table import PointTable
from pointferry.suite import staging
from tests.test_table import writes

OPTIONS = {
    "collection": {},
    "pinecone": {},
    "chroma": {},
    "weaviate": {"include_properties": ["a"]},
    "redis": {"attrs": {"v": "VECTOR", "n": "NUMERIC"}},
    "mongodb": {"vector_fields": ["v"]},
    "elasticsearch": {},
    "opensearch": {},
    "s3": {},
    "faiss": {},
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mode", ["fail", "quarantine"])
@pytest.mark.parametrize("source", sorted(OPTIONS))
def test_normalising_does_not_shuffle(spark, tmp_path, source, mode):
    spark.createDataFrame([], src.RAW_SCHEMAS[source]).write.parquet(str(tmp_path / "raw"))
    points = src.normalize(source, src.read_staged(spark, source, str(tmp_path / "raw")), mode=mode, **OPTIONS[source])
    plan = plan_of(points)
    assert "Exchange" not in plan and "Join" not in plan
    assert ("ArrowEvalPython" in plan) == (source == "redis")
    assert "BatchEvalPython" not in plan


@pytest.mark.parametrize("source", ["milvus", "pg"])
def test_typed_sources_do_not_shuffle(spark, tmp_path, sf_dir, source):
    make = {"milvus": staging.milvus_raw, "pg": staging.pg_raw}[source]
    make(spark, sf_dir).write.parquet(str(tmp_path / "raw"))
    options = {"milvus": {"pk": "o_orderkey", "json_columns": ["meta"], "partitions": ["F"]}, "pg": {"key_column": "o_orderkey", "vector_columns": ["embedding"]}}
    plan = plan_of(src.normalize(source, spark.read.parquet(str(tmp_path / "raw")), **options[source]))
    assert "Exchange" not in plan and "Python" not in plan
    if source == "milvus":
        assert "PushedFilters: [IsNotNull(partition), EqualTo(partition,F)]" in plan or "In(partition" in plan


def test_point_uuid_stays_in_generated_code_and_is_pruned(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(to_point_uuid(F.col("text")).alias("u"))
    plan = plan_of(docs)
    assert "*(1) Project" in plan and "ReadSchema: struct<text:string>" in plan


def test_small_commit_over_a_base_does_not_shuffle_the_base(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "t"))
    table.append(writes(spark, [(n, str(n), 0) for n in range(100)]), "w", 0)
    table.compact()
    table.append(writes(spark, [(1, "x", 0)]), "w", 1)
    plan = plan_of(table.read())
    join = plan[plan.index("LeftAnti") :]
    base_scan = join[: join.index("FileScan")]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in base_scan


def test_comparison_shuffles_hashes_only(spark):
    points = writes(spark, [(1, "a", 0)])
    plan = verify.compare_points(points, points)._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join") :].splitlines()[1]
    assert "h1" in join and "h2" in join and "AS payload" not in join


def test_shard_write_is_rebalanced(spark):
    plan = plan_of(up.shard_write_layout(writes(spark, [(1, "a", 0)])))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan

"""Headline timings. Prints one JSON line.

Every source's raw table is staged once, untimed, from the driver tables; what is timed is
bringing it to points, written to Spark's ``noop`` sink, and the jobs on the point table.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, functions as F  # noqa: E402

from pointferry import sources as src  # noqa: E402
from pointferry.functions.ids import number_id, uuid5_url  # noqa: E402
from pointferry.functions.payload import keep_payload  # noqa: E402
from pointferry.functions.vectors import dense, named  # noqa: E402
from pointferry.operators import scan, search, verify  # noqa: E402
from pointferry.operators.ranges import assign_ranges, boundary_sample, ranges_per_key, ranges_per_worker  # noqa: E402
from pointferry.operators.upsert import latest_by_id  # noqa: E402
from pointferry.plans.jobs import copy_ranges  # noqa: E402
from pointferry.session import local_session, scratch_dir  # noqa: E402
from pointferry.sinks.point_table import PointTable  # noqa: E402
from pointferry.streaming.progress import ProgressStore  # noqa: E402
from pointferry.suite import staging  # noqa: E402
from pointferry.suite.writing import event_writes  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = 3

def order_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order, with a vector and its other columns as JSON: what most sources are staged from."""
    orders = staging.with_vector(spark, sf_dir, staging.table(spark, sf_dir, "orders"), "o_orderkey")
    wide = F.col("embedding").cast("array<double>")
    plain = ["o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
    return orders.select(
        F.col("o_orderkey").alias("number"),
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("id"),
        "embedding",
        wide.alias("wide"),
        F.to_json(F.struct(*plain)).alias("json"),
        F.to_json(F.struct(*plain, F.col("embedding").alias("vec"))).alias("json_with_vector"),
        F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("_id"), *plain, F.col("embedding").alias("vec"))).alias("doc"),
        F.to_json(F.struct(F.col("embedding").alias("hidden"))).alias("hidden"),
        F.col("o_orderstatus").alias("status"),
    )


def from_orders(**columns: Column) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: order_columns(spark, sf_dir).select(*[c.alias(n) for n, c in columns.items()])


def sources() -> dict[str, tuple[str, Callable, dict]]:
    """Per timing: the source, how its raw table is made, and the options."""
    return {
        "s01_collection": (
            "collection",
            from_orders(
                id=number_id(F.col("number")),
                vectors=named({"": dense(F.col("embedding"))}),
                payload=F.parse_json("json"),
                shard_key=F.struct(F.col("status").alias("keyword"), F.lit(None).cast("decimal(20,0)").alias("number")),
                source_ord=F.col("number"),
            ),
            {},
        ),
        "s02_milvus": ("milvus", staging.milvus_raw, {"pk": "o_orderkey", "json_columns": ["meta"]}),
        "s03_pinecone": (
            "pinecone",
            from_orders(
                id=F.col("id"),
                values=F.col("embedding"),
                sparse_indices=F.array(F.col("number")),
                sparse_values=F.array(F.lit(0.5).cast("float")),
                metadata=F.col("json"),
                namespace=F.col("status"),
            ),
            {},
        ),
        "s04_chroma": (
            "chroma",
            from_orders(id=F.col("id"), embedding=F.col("embedding"), document=F.col("json"), metadata=F.col("json")),
            {},
        ),
        "s05_weaviate": (
            "weaviate",
            from_orders(id=uuid5_url(F.col("id")), vector=F.col("wide"), vectors=F.create_map(F.lit("t"), F.col("wide")), properties=F.col("json"), tenant=F.col("status")),
            {"vector_name": "t"},
        ),
        "s06_redis": ("redis", staging.redis_raw, {"attrs": staging.REDIS_ATTRIBUTES}),
        "s07_mongodb": ("mongodb", from_orders(doc=F.col("doc")), {"vector_fields": ["vec"]}),
        "s08_opensearch": ("opensearch", from_orders(_id=F.col("id"), _source=F.col("json_with_vector")), {}),
        "s09_elasticsearch": ("elasticsearch", from_orders(_id=F.col("id"), _source=F.col("json"), fields=F.col("hidden")), {}),
        "s10_pg": ("pg", staging.pg_raw, {"key_column": "o_orderkey", "vector_columns": ["embedding"]}),
        "s11_s3": ("s3", from_orders(key=F.col("id"), data=F.col("embedding"), metadata=F.col("json")), {}),
        "s12_faiss": ("faiss", from_orders(pos=F.col("number"), vector=F.col("embedding")), {}),
    }


def timed(run: Callable[[], object], runs: int = RUNS) -> float:
    """The best of a few runs, after the first has warmed up."""
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    folder = scratch_dir(spark, f"bench-{label}")
    df.repartition(CPUS).write.parquet(folder)
    return spark.read.parquet(folder)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def range_copy(spark: SparkSession, orders: DataFrame, workers: int) -> None:
    folder = scratch_dir(spark, "bench-ranges")
    copy_ranges(
        orders,
        "o_orderkey",
        lambda df: src.normalize_pg(df, key_column="o_orderkey", vector_columns=["embedding"]),
        PointTable(spark, f"{folder}/table"),
        ProgressStore(spark, f"{folder}/progress"),
        f"{folder}/plans",
        "orders",
        workers,
    )


def one_core_time() -> float:
    spark = local_session(1, CPUS)
    _, make_raw, options = sources()["s10_pg"]
    raw = stage(spark, make_raw(spark, SF_DIR), "one-core")
    seconds = timed(lambda: noop(src.normalize("pg", raw, **options)))
    spark.stop()
    return seconds


def main() -> None:
    # Small partitions for small tables, so that a shard's write uses all cores here as well.
    spark = local_session(CPUS, CPUS, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"})
    queries: dict[str, float] = {}
    rates: dict[str, int] = {}

    for name, (source, make_raw, options) in sources().items():
        raw = stage(spark, make_raw(spark, SF_DIR), name)
        rows = raw.count()
        queries[name] = timed(lambda: noop(src.normalize(source, raw, **options)))
        rates[name] = int(rows / queries[name])

    orders = stage(spark, staging.pg_raw(spark, SF_DIR), "orders")
    lines = staging.table(spark, SF_DIR, "lineitem")
    writes = stage(spark, event_writes(spark, SF_DIR), "writes")
    points = stage(spark, staging.collection_raw(spark, SF_DIR), "points")

    queries["w01_latest_by_id"] = timed(lambda: noop(latest_by_id(writes)))
    rates["w01_latest_by_id"] = int(writes.count() / queries["w01_latest_by_id"])

    pg_points = stage(spark, src.normalize_pg(orders, key_column="o_orderkey", vector_columns=["embedding"]), "pg-points")
    n_points = pg_points.count()
    table = PointTable(spark, scratch_dir(spark, "bench-table"))
    queries["w01_append"] = timed(lambda: table.append(pg_points, "bench", 0), runs=1)
    queries["w01_append_replay"] = timed(lambda: table.append(pg_points, "bench", 0), runs=1)
    table.append(pg_points, "bench", 1)
    queries["w01_compact"] = timed(table.compact, runs=1)
    queries["w01_read"] = timed(lambda: noop(table.read()))
    rates["w01_append"] = int(n_points / queries["w01_append"])

    sample = boundary_sample(orders, "o_orderkey", CPUS)
    queries["p10_ranges"] = timed(lambda: noop(ranges_per_worker(sample, "o_orderkey", CPUS)))
    table_of_ranges = ranges_per_key(sample, "o_orderkey")
    queries["p11_assign_ranges"] = timed(
        lambda: noop(assign_ranges(lines, "l_orderkey", table_of_ranges).groupBy("range_id").agg(F.count(F.lit(1)).alias("n")))
    )
    queries["p02_keyset_page"] = timed(lambda: noop(scan.keyset_page(lines, "l_orderkey", 1000, 1000)))
    queries["v02_compare_points"] = timed(lambda: noop(verify.compare_points(points, points)))

    emb = staging.table(spark, SF_DIR, "embeddings")
    pool = emb.select(F.col("vec_id").cast("string").alias("point_id"), F.col("embedding").alias("vector"))
    hundred = pool.orderBy("point_id").limit(100).withColumnRenamed("point_id", "query_id")
    for metric in search.METRICS:
        queries[f"l01_topk_{metric}"] = timed(lambda: noop(search.nearest_batch(pool, hundred, 10, metric)))
    wide = orders.where("embedding IS NOT NULL").select(F.col("o_orderkey").cast("string").alias("point_id"), F.col("embedding").alias("vector"))
    queries["l01_topk_orders"] = timed(lambda: noop(search.nearest_batch(wide, hundred, 10, "cosine")), runs=2)
    rates["l01_topk_orders"] = int(wide.count() / queries["l01_topk_orders"])

    queries["c06_range_copy"] = timed(lambda: range_copy(spark, orders, CPUS), runs=2)
    rates["c06_range_copy"] = int(n_points / queries["c06_range_copy"])

    full, lean = scratch_dir(spark, "bench-full"), scratch_dir(spark, "bench-lean")
    points.write.parquet(full)
    points.withColumn("payload", keep_payload(F.col("payload"), ["lang", "source"])).write.parquet(lean)
    n_docs = points.count()
    sizes = {"full_bytes_per_point": folder_bytes(spark, full) // n_docs, "lean_bytes_per_point": folder_bytes(spark, lean) // n_docs}

    result = {
        "metric": "total time of headline queries",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "points_per_second": rates,
        "sizes": sizes,
        "cpus": CPUS,
    }
    spark.stop()
    result["pg_speed_up_over_one_core"] = round(one_core_time() / queries["s10_pg"], 2)
    print(json.dumps(result))


if __name__ == "__main__":
    main()

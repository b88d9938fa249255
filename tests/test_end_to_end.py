"""A hundred records of 384 floats through each source, into a table and back, all compared."""

import bisect
import json
import random
import struct
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from pointferry import sources as src
from pointferry.operators import scan, verify
from pointferry.plans import catalog
from pointferry.plans.jobs import copy_all, copy_ranges
from pointferry.sinks.point_table import PointTable
from pointferry.sources.custom import PageClient, PagedStoreSource
from pointferry.streaming.progress import ProgressStore

N, DIM = 100, 384


def u5(text):
    return str(uuid.uuid5(uuid.NAMESPACE_URL, text))


def floats(seed, dim=DIM):
    return [float(x) for x in np.random.default_rng(seed).random(dim).astype("f4")]


def _pinecone_dense(spark):
    rows = [(str(i), floats(i), None, None, json.dumps({"source": f"s{i}"}), None) for i in range(1, N + 1)]
    want = {u5(r[0]): ({"": r[1]}, {"__id__": r[0], "source": f"s{r[0]}"}) for r in rows}
    return "pinecone", spark.createDataFrame(rows, src.RAW_SCHEMAS["pinecone"]), {}, want


def _pinecone_sparse(spark):
    rng = random.Random(1)
    rows = [(str(i), None, sorted(rng.sample(range(2**32), 5)), floats(i, 5), json.dumps({"source": "x"}), None) for i in range(N)]
    want = {u5(r[0]): ({"sparse_vector": r[3]}, {"__id__": r[0], "source": "x"}) for r in rows}
    return "pinecone", spark.createDataFrame(rows, src.RAW_SCHEMAS["pinecone"]), {}, want


def _chroma(spark):
    rows = [(str(i), floats(i), f"text {i}", json.dumps({"source": f"s{i}"})) for i in range(N)]
    want = {u5(r[0]): ({"": r[1]}, {"__id__": r[0], "document": r[2], "source": f"s{r[0]}"}) for r in rows}
    return "chroma", spark.createDataFrame(rows, src.RAW_SCHEMAS["chroma"]), {}, want


def _weaviate(spark):
    ids = [str(uuid.UUID(int=random.Random(i).getrandbits(128))) for i in range(N)]
    rows = [(u, floats(i), None, json.dumps({"content": f"c{i}", "genre": "g"}), None) for i, u in enumerate(ids)]
    want = {r[0]: ({"": r[1]}, {"content": f"c{i}", "genre": "g"}) for i, r in enumerate(rows)}
    return "weaviate", spark.createDataFrame(rows, src.RAW_SCHEMAS["weaviate"]), {}, want


def _redis(spark):
    rows = [(f"doc:{i}", {"content": f"c{i}".encode(), "genre": b"g", "embedding": struct.pack(f"<{DIM}f", *floats(i))}) for i in range(1, N + 1)]
    want = {u5(r[0]): ({"embedding": floats(i)}, {"__id__": r[0], "content": f"c{i}", "genre": "g"}) for i, r in enumerate(rows, 1)}
    attrs = {"content": "TEXT", "genre": "TAG", "embedding": "VECTOR"}
    return "redis", spark.createDataFrame(rows, src.RAW_SCHEMAS["redis"]), {"attrs": attrs}, want


def _mongodb(spark):
    docs = [{"_id": f"d{i}", "text_embedding": floats(i), "image_embedding": floats(1000 + i), "doc": f"t{i}", "source": "s", "non_vector": [1.0, 2.0, 3.0, 4.0, 5.0]} for i in range(N)]
    want = {
        u5(d["_id"]): (
            {k: d[k] for k in ("text_embedding", "image_embedding")},
            {"__id__": d["_id"], "doc": d["doc"], "source": "s", "non_vector": d["non_vector"]},
        )
        for d in docs
    }
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], src.RAW_SCHEMAS["mongodb"])
    return "mongodb", raw, {"vector_fields": ["text_embedding", "image_embedding"]}, want


def _hits(spark, source):
    rows = [(str(i), json.dumps({"vector": floats(i), "doc": f"t{i}", "source": "s"})) for i in range(1, N + 1)]
    want = {u5(r[0]): ({"vector": floats(i)}, {"__id__": r[0], "doc": f"t{i}", "source": "s"}) for i, r in enumerate(rows, 1)}
    return source, spark.createDataFrame(rows, "_id string, _source string"), {}, want


def _pg(spark):
    rows = [(i, f"Entry {i}", 20 + i, i * 0.5, i % 2 == 0, floats(i)) for i in range(N)]
    names = ["id", "name", "age", "height", "is_active"]
    want = {u5(str(r[0])): ({"embedding": r[5]}, dict(zip(names, r))) for r in rows}
    raw = spark.createDataFrame(rows, "id int, name string, age int, height double, is_active boolean, embedding array<float>")
    return "pg", raw, {"key_column": "id", "vector_columns": ["embedding"]}, want


def _s3(spark):
    rows = [(f"vector-{i}", floats(i), json.dumps({"age": i, "name": "n", "city": "c"})) for i in range(N)]
    want = {u5(r[0]): ({"": r[1]}, {"__id__": r[0], "age": i, "name": "n", "city": "c"}) for i, r in enumerate(rows)}
    return "s3", spark.createDataFrame(rows, src.RAW_SCHEMAS["s3"]), {}, want


def _faiss(spark):
    rows = [(i, [round(x, 4) for x in floats(i)]) for i in range(N)]
    want = {str(i): ({"": [float(np.float32(x)) for x in v]}, None) for i, v in rows}
    return "faiss", spark.createDataFrame(rows, src.RAW_SCHEMAS["faiss"]), {}, want


def _milvus(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.uniform(-1, 1, 5).astype("f4")], "pink_8682") for i in range(10)]
    want = {str(r[0]): ({"vector": r[1]}, {"color": r[2]}) for r in rows}
    return "milvus", spark.createDataFrame(rows, "id bigint, vector array<float>, color string"), {"pk": "id"}, want


CASES = {
    "pinecone dense": _pinecone_dense,
    "pinecone sparse": _pinecone_sparse,
    "chroma": _chroma,
    "weaviate": _weaviate,
    "redis": _redis,
    "mongodb": _mongodb,
    "elasticsearch": lambda spark: _hits(spark, "elasticsearch"),
    "opensearch": lambda spark: _hits(spark, "opensearch"),
    "pg": _pg,
    "s3": _s3,
    "faiss": _faiss,
    "milvus": _milvus,
}


@pytest.mark.parametrize("case", CASES)
def test_every_record_arrives(spark, tmp_path, case):
    source, raw, options, want = CASES[case](spark)
    table = PointTable(spark, str(tmp_path / "t"))
    report = copy_all(raw, lambda df: src.normalize(source, df, **options), table, source, run=0)
    assert report.complete and report.source_count == report.target_count == len(want)
    rows = table.read().select(F.coalesce("id.uuid", F.col("id.num").cast("string")).alias("k"), "vectors", F.to_json("payload").alias("p")).collect()
    got = {r["k"]: ({n: v["data"] for n, v in r["vectors"].items()}, None if r["p"] is None else json.loads(r["p"])) for r in rows}
    assert got == want
    fields = catalog.fields_from_points(table.read(), "target").collect()
    assert {f["field"] for f in fields} == {n for v, _ in want.values() for n in v}


def _sharded(spark):
    rows = [(str(uuid.UUID(int=i)), f"shard_{'ab'[i % 2]}", floats(i)) for i in range(N)]
    df = spark.createDataFrame(rows, "u string, shard string, v array<float>")
    vector = F.struct(F.col("v").alias("data"), F.lit(None).cast("array<bigint>").alias("indices"), F.lit(None).cast("int").alias("vectors_count"))
    return df.select(
        F.struct(F.lit(None).cast("decimal(20,0)").alias("num"), F.col("u").alias("uuid")).alias("id"),
        F.create_map(F.lit(""), vector).alias("vectors"),
        F.to_variant_object(F.struct("shard")).alias("payload"),
        F.struct(F.col("shard").alias("keyword"), F.lit(None).cast("decimal(20,0)").alias("number")).alias("shard_key"),
        F.lit(0).cast("bigint").alias("source_ord"),
    )


@pytest.mark.parametrize("workers", [1, 4])
def test_sharded_collection_copy(spark, tmp_path, workers):
    raw = _sharded(spark)
    table, progress = PointTable(spark, str(tmp_path / "t")), ProgressStore(spark, str(tmp_path / "p"))
    keyed = scan.point_order(raw)
    report = copy_ranges(keyed, "order_key", src.normalize_collection, table, progress, str(tmp_path / "plans"), "c", workers, ranges_per_step=workers, per_sampled_key=True)
    assert report.target_count == N
    table.compact()
    counts = {r["shard"]: (r["source_count"], r["target_count"], r["matches"]) for r in verify.count_reconciliation(raw, table.read()).collect()}
    assert counts == {"k:shard_a": (50, 50, True), "k:shard_b": (50, 50, True)}
    assert {r["status"] for r in verify.compare_points(raw, table.read()).collect()} == {"same"}
    assert table.read_shard("k:shard_a").count() == 50


class ListClient(PageClient):
    """A sorted list standing in for a store."""

    def __init__(self, keys):
        self.keys = keys

    def page(self, after, end, limit):
        first = 0 if after is None else bisect.bisect_right(self.keys, after)
        last = len(self.keys) if end is None else bisect.bisect_right(self.keys, end)
        return [(k, f"row {k}") for k in self.keys[first : min(last, first + limit)]]


class ListStore(PagedStoreSource):
    @classmethod
    def name(cls):
        return "list_store"

    def schema(self):
        return T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])

    def boundaries(self):
        return [100, 250, 600]

    def open_client(self):
        return ListClient(list(range(0, int(self.options["rows"]))))


@pytest.mark.parametrize("rows", [0, 90, 1000])
def test_custom_source_reads_each_range_page_by_page(spark, rows):
    spark.dataSource.register(ListStore)
    df = spark.read.format("list_store").option("rows", rows).option("pageSize", 7).load()
    got = [r["id"] for r in df.orderBy("id").collect()]
    assert got == list(range(rows)) and df.rdd.getNumPartitions() == 4

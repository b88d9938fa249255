"""Comparison, search, catalog and custom sinks."""

import json

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pointferry.operators import search, verify
from pointferry.plans import catalog
from pointferry.sinks.custom import PointClient, PointStoreSource, RetryableError
from tests.test_table import writes


def _status(expected, actual):
    return {int(r["id"]["num"]): r["status"] for r in verify.compare_points(expected, actual).collect()}


def test_compare_finds_every_difference(spark):
    a = writes(spark, [(1, "a", 0), (2, "b", 0), (3, "c", 0), (4, "d", 0)])
    b = writes(spark, [(1, "a", 9), (2, "B", 0), (4, "d", 0), (5, "e", 0)])
    assert _status(a, b) == {1: "same", 2: "changed", 3: "missing", 4: "same", 5: "extra"}


@pytest.mark.parametrize(
    "column,value",
    [
        ("payload", "parse_json('{\"text\":1}')"),
        ("payload", "CAST(null AS variant)"),
        ("shard_key", "named_struct('keyword', '1', 'number', CAST(null AS decimal(20,0)))"),
        ("vectors", "map('', named_struct('data', array(CAST(1 AS float)), 'indices', CAST(null AS array<bigint>), 'vectors_count', CAST(null AS int)))"),
    ],
)
def test_compare_sees_each_part(spark, column, value):
    a = writes(spark, [(1, "1", 0)])
    assert _status(a, a.withColumn(column, F.expr(value))) == {1: "changed"}


def test_compare_tells_whole_numbers_from_doubles(spark):
    a = writes(spark, [(1, "x", 0)]).withColumn("payload", F.expr("parse_json('{\"n\":1}')"))
    b = a.withColumn("payload", F.expr("parse_json('{\"n\":1.0}')"))
    assert _status(a, b) == {1: "changed"}


def test_sparse_comparison_cases(spark):
    rows = [
        ([1, 2], [1.0, 2.0], [2, 1], [2.0, 1.0], True),
        ([1, 2], [1.0, 2.0], [2, 1], [2.01, 1.0], True),
        ([1, 2], [1.0, 2.0], [2, 1], [2.1, 1.0], False),
        ([1, 2], [1.0, 2.0], [1], [1.0], False),
        ([1], [1.0], [1, 2], [1.0, 2.0], False),
        ([], [], [], [], True),
        ([4294967295], [0.0], [4294967295], [0.0], True),
    ]
    df = spark.createDataFrame(rows, "ia array<bigint>, va array<float>, ib array<bigint>, vb array<float>, want boolean")
    assert df.filter(verify.sparse_equal(F.col("ia"), F.col("va"), F.col("ib"), F.col("vb")) != F.col("want")).count() == 0


def _brute(points, queries, k, metric):
    out = {}
    for qid, q in queries:
        scored = []
        for pid, v in points:
            a, b = np.asarray(q, "f8"), np.asarray(v, "f8")
            d = {
                "cosine": lambda: 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b)),
                "dot": lambda: -(a @ b),
                "euclid": lambda: np.sqrt(((a - b) ** 2).sum()),
                "manhattan": lambda: np.abs(a - b).sum(),
            }[metric]()
            scored.append((round(float(d), 9), pid))
        out[qid] = sorted(scored)[:k]
    return out


@pytest.mark.parametrize("metric", search.METRICS)
@pytest.mark.parametrize("max_bytes", [1 << 20, 100])
def test_topk_equals_brute_force(spark, metric, max_bytes):
    rng = np.random.default_rng(5)
    # Small whole numbers make many equal distances, so the order by id matters too.
    points = [(f"p{i:03d}", [float(x) for x in rng.integers(1, 4, 4)]) for i in range(400)]
    queries = [(f"q{i}", [float(x) for x in rng.integers(1, 4, 4)]) for i in range(9)]
    p = spark.createDataFrame(points, "point_id string, vector array<float>").repartition(5)
    q = spark.createDataFrame(queries, "query_id string, vector array<float>")
    got = {}
    for r in search.nearest_batch(p, q, 7, metric, max_query_bytes=max_bytes).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((round(r["distance"], 9), r["point_id"]))
    want = _brute(points, queries, 7, metric)
    if metric == "cosine":
        # Equal cosines may differ in the last bits between ways of adding up; compare distances.
        assert {k: [d for d, _ in v] for k, v in got.items()} == {k: [d for d, _ in v] for k, v in want.items()}
    else:
        assert got == want


def test_single_query_topk_is_a_top_n_plan(spark):
    points = spark.createDataFrame([(f"p{i}", [float(i), 1.0]) for i in range(50)], "point_id string, vector array<float>")
    for metric in search.METRICS:
        single = search.nearest(points, [3.0, 1.0], 4, metric)
        assert "TakeOrderedAndProject" in single._jdf.queryExecution().executedPlan().toString()
        q = spark.createDataFrame([("q", [3.0, 1.0])], "query_id string, vector array<float>")
        batch = search.nearest_batch(points, q, 4, metric).orderBy("rank")
        assert [r["point_id"] for r in single.collect()] == [r["point_id"] for r in batch.collect()]
    with pytest.raises(ValueError, match="distance metric"):
        search.nearest(points, [1.0], 1, "hamming")


def test_topk_edge_inputs(spark):
    points = spark.createDataFrame([("a", [1.0, 0.0])], "point_id string, vector array<float>")
    none = spark.createDataFrame([], "query_id string, vector array<float>")
    assert search.nearest_batch(points, none, 3).count() == 0
    one = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<float>")
    assert search.nearest_batch(points, one, 3).count() == 1
    assert search.nearest_batch(points.filter("false"), one, 3).count() == 0
    mixed = spark.createDataFrame([("q", [1.0, 0.0]), ("r", [1.0])], "query_id string, vector array<float>")
    with pytest.raises(ValueError, match="differ in size"):
        search.nearest_batch(points, mixed, 3)
    with pytest.raises(PySparkException, match="another size"):
        search.nearest_batch(spark.createDataFrame([("a", [1.0])], points.schema), one, 3).collect()


def test_lookup_default(spark):
    found = spark.createDataFrame([("a",), ("b",), ("c",)], "point_id string")
    texts = spark.createDataFrame([("a", "x"), ("b", None)], "point_id string, text string")
    got = {r["point_id"]: r["text"] for r in search.lookup_text(found, texts, "point_id").collect()}
    assert got == {"a": "x", "b": "", "c": ""}


def _mapping(spark, properties, name="idx"):
    return spark.createDataFrame([(name, json.dumps({"idx": {"mappings": {"properties": properties}}}))], "collection string, mapping string")


def test_mapping_fields(spark):
    es = _mapping(spark, {"v": {"type": "dense_vector", "dims": 384, "similarity": "L2_NORM"}, "w": {"type": "dense_vector", "dims": 3}, "x": {"type": "dense_vector"}, "t": {"type": "text"}})
    rows = {r["field"]: (r["size"], r["distance"]) for r in catalog.fields_from_mapping(es, "elasticsearch").collect()}
    assert rows == {"v": (384, "euclid"), "w": (3, "cosine")}
    with pytest.raises(PySparkException, match="no number as size of field v"):
        catalog.fields_from_mapping(_mapping(spark, {"v": {"type": "knn_vector", "dimension": "384"}}), "opensearch").collect()
    with pytest.raises(PySparkException, match="no field properties"):
        catalog.fields_from_mapping(_mapping(spark, {}, name="other"), "opensearch").collect()


def test_table_description_fields(spark):
    rows = [("t", "a", "vector(3)"), ("t", "b", "halfvec(3)"), ("t", "c", "text")]
    df = spark.createDataFrame(rows, "collection string, column string, type_text string")
    assert [(r["field"], r["size"]) for r in catalog.fields_from_type_text(df).collect()] == [("a", 3)]
    with pytest.raises(PySparkException, match="no size for vector column"):
        catalog.fields_from_type_text(spark.createDataFrame([("t", "a", "vector")], df.schema)).collect()


def test_metric_rules(spark):
    fields = spark.createDataFrame([("a",), ("b",)], "f string")
    with pytest.raises(PySparkException, match="'hamming', asked for vector 'b'"):
        fields.select(catalog.metric_option(F.col("f"), {"b": "hamming"}, "milvus")).collect()
    got = [r[0] for r in fields.select(catalog.metric_option(F.col("f"), {"b": "dot"}, "faiss")).collect()]
    assert got == ["cosine", "dot"]


def test_required_metric(spark):
    words = spark.createDataFrame([("cosine",), ("euclidean",)], "w string")
    assert [r[0] for r in words.select(catalog.required_metric(F.col("w"), "s3")).collect()] == ["cosine", "euclid"]
    with pytest.raises(PySparkException, match="'dotproduct' has no counterpart"):
        words.select(catalog.required_metric(F.lit("dotproduct"), "s3")).collect()


def test_points_without_the_vector_are_not_found(spark):
    points = spark.createDataFrame([("a", [1.0]), ("b", None)], "point_id string, vector array<float>")
    q = spark.createDataFrame([("q", [1.0])], "query_id string, vector array<float>")
    assert [r["point_id"] for r in search.nearest_batch(points, q, 5, "euclid").collect()] == ["a"]
    assert [r["point_id"] for r in search.nearest(points, [1.0], 5, "euclid").collect()] == ["a"]


def test_dispatch_rejects_other_kinds(spark):
    schema = "collection string, vector_type string, dimension int, metric string"
    with pytest.raises(PySparkException, match="but hybrid"):
        catalog.dispatch_by_kind(spark.createDataFrame([("i", "hybrid", 3, "cosine")], schema)).collect()


def test_create_if_absent_can_be_off(spark):
    planned = spark.createDataFrame([("c", "f")], "collection string, field string")
    none = spark.createDataFrame([], "collection string")
    assert catalog.create_if_absent(planned, none).count() == 1
    assert catalog.create_if_absent(planned, none, create=False).count() == 0
    assert catalog.create_if_absent(planned, planned).count() == 0


class FolderClient(PointClient):
    """Stands in for a store: one file per id, so a repeated upsert overwrites; every first try fails."""

    def __init__(self, folder):
        self.folder, self.tries = folder, 0

    def upsert(self, rows):
        self.tries += 1
        if self.tries == 1:
            raise RetryableError("please retry")
        for row in rows:
            with open(f"{self.folder}/{row['id']['num']}.json", "w") as f:
                f.write(json.dumps({"payload": json.loads(row["payload"]), "batch": len(rows)}))


class FolderStore(PointStoreSource):
    @classmethod
    def name(cls):
        return "folder_store"

    def open_client(self):
        return FolderClient(self.options["folder"])


def test_custom_sink_writes_in_batches(spark, tmp_path):
    spark.dataSource.register(FolderStore)
    points = writes(spark, [(i, f"t{i}", 0) for i in range(23)]).coalesce(1)
    out = points.select("id", F.to_json(F.map_keys("vectors")).alias("vectors"), F.to_json("payload").alias("payload"), F.lit("-").alias("shard"))
    out.write.format("folder_store").option("folder", str(tmp_path)).option("batchSize", "10").mode("append").save()
    got = {int(p.stem): json.loads(p.read_text()) for p in tmp_path.iterdir()}
    assert len(got) == 23 and got[7] == {"payload": {"text": "t7"}, "batch": 10}
    assert sorted(v["batch"] for v in got.values()) == [3] * 3 + [10] * 20

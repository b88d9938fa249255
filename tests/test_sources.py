"""Edge rows of every source, written by hand."""

import json
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pointferry import sources as src
from pointferry.sources.milvus import normalize_milvus

U = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


def u5(text):
    return str(uuid.uuid5(uuid.NAMESPACE_URL, text))


def points_by_id(points):
    rows = points.withColumn("p", F.to_json("payload")).select("id", "vectors", "p", "shard_key", "source_ord").collect()
    out = {}
    for r in rows:
        key = r["id"]["uuid"] if r["id"]["uuid"] is not None else int(r["id"]["num"])
        out[key] = {
            "vectors": {k: v["data"] for k, v in r["vectors"].items()},
            "payload": None if r["p"] is None else json.loads(r["p"]),
            "raw": r,
        }
    return out


def reasons(points):
    return {(r["id"]["uuid"] or (r["id"]["num"] is not None and int(r["id"]["num"])) or None): r["reject_reason"] for r in src.rejected(points).collect()}


def test_unknown_source():
    with pytest.raises(ValueError, match="unknown source"):
        src.normalize("nope", None)


def test_unknown_mode(spark):
    raw = spark.createDataFrame([("a", [1.0], None)], src.RAW_SCHEMAS["s3"])
    with pytest.raises(ValueError, match="mode"):
        src.normalize("s3", raw, mode="skip")


def test_pinecone(spark):
    raw = spark.createDataFrame(
        [
            ("a", [1.0, 2.0], None, None, None, "n1"),
            (U, None, [4294967295, 0], [0.5, 0.25], '{"__id__":"clash","n":1,"l":[1,{"x":2}]}', "n1"),
            ("é", None, None, None, " null ", "n2"),
        ],
        src.RAW_SCHEMAS["pinecone"],
    )
    got = points_by_id(src.normalize("pinecone", raw, sparse_vector="sp"))
    assert got[u5("a")]["vectors"] == {"": [1.0, 2.0]} and got[u5("a")]["payload"] == {"__id__": "a"}
    assert got[U]["payload"] == {"__id__": U, "n": 1.0, "l": [1.0, {"x": 2.0}]}
    assert got[U]["raw"]["vectors"]["sp"]["indices"] == [4294967295, 0]
    assert got[u5("é")]["vectors"] == {}
    assert set(points_by_id(src.normalize("pinecone", raw, namespace="n2"))) == {u5("é")}


def test_pinecone_rejects(spark):
    raw = spark.createDataFrame(
        [("a", [1.0], None, None, "[1]", None), (None, [1.0], None, None, None, None), ("b", None, [1], [1.0, 2.0], None, None), ("c", [1.0], None, None, None, None)],
        src.RAW_SCHEMAS["pinecone"],
    )
    points = src.normalize("pinecone", raw, mode="quarantine")
    assert sorted(r["reject_reason"] for r in src.rejected(points).collect()) == [
        "metadata is not a JSON object",
        "sparse positions and values differ in length",
        "the record has no id",
    ]
    assert set(points_by_id(src.accepted(points))) == {u5("c")}
    with pytest.raises(PySparkException):
        src.normalize("pinecone", raw).collect()


def test_chroma_document_rules(spark):
    raw = spark.createDataFrame(
        [
            ("1", [1.0], "text", '{"document":"old","n":3}'),
            ("2", [1.0], "", '{"document":"old"}'),
            ("3", [1.0], None, None),
        ],
        src.RAW_SCHEMAS["chroma"],
    )
    got = points_by_id(src.normalize("chroma", raw))
    assert got[u5("1")]["payload"] == {"__id__": "1", "document": "text", "n": 3.0}
    assert got[u5("2")]["payload"] == {"__id__": "2", "document": "old"}
    assert got[u5("3")]["payload"] == {"__id__": "3"}
    # The document is written after the id, so it wins when both have one name.
    same = points_by_id(src.normalize("chroma", raw, id_field="x", document_field="x"))
    assert same[u5("1")]["payload"]["x"] == "text"


def test_weaviate(spark):
    raw = spark.createDataFrame(
        [
            (U, [1.0, 2.0], {"t": [3.0]}, '{"a":1,"b":"x","_additional":{"id":"q"}}', "t1"),
            (str(uuid.UUID(int=1)), None, {}, "{}", "t2"),
            (str(uuid.UUID(int=2)), [1.0, None], None, "{}", "t2"),
        ],
        src.RAW_SCHEMAS["weaviate"],
    )
    got = points_by_id(src.normalize("weaviate", raw, tenant="t1"))
    assert got == {U: got[U]} and got[U]["vectors"] == {"": [1.0, 2.0]} and got[U]["payload"] == {"a": 1.0, "b": "x"}
    named = points_by_id(src.normalize("weaviate", raw, tenant="t1", vector_name="t", include_properties=["b", "zz"]))
    assert named[U]["vectors"] == {"": [3.0]} and named[U]["payload"] == {"b": "x"}
    bad = src.rejected(src.normalize("weaviate", raw, mode="quarantine")).select("id.uuid", "reject_reason").collect()
    assert {r["uuid"][-1]: r["reject_reason"] for r in bad} == {"1": "the object has no vector", "2": "the object's vector has an empty place"}
    missing = src.rejected(src.normalize("weaviate", raw, mode="quarantine", vector_name="t")).count()
    assert missing == 2


def test_redis(spark):
    import struct

    raw = spark.createDataFrame(
        [
            ("doc:1", {"v": bytearray(struct.pack("<2f", 1.0, -2.0)), "n": b"3.5", "bad": b"x1", "t": "é".encode(), "__id__": b"mine"}),
            ("doc:2", {"n": b"7"}),
        ],
        "key string, fields map<string,binary>",
    )
    attrs = spark.createDataFrame([("v", "VECTOR"), ("n", "NUMERIC"), ("bad", "NUMERIC"), ("t", "TAG")], "identifier string, type string")
    got = points_by_id(src.normalize("redis", raw, attrs=attrs))
    assert got[u5("doc:1")]["vectors"] == {"v": [1.0, -2.0]}
    assert got[u5("doc:1")]["payload"] == {"n": 3.5, "bad": "x1", "t": "é", "__id__": "doc:1"}
    assert got[u5("doc:2")]["vectors"] == {} and got[u5("doc:2")]["payload"] == {"n": 7.0, "__id__": "doc:2"}


def test_mongodb(spark):
    docs = [
        '{"_id":"a","v":[1.0,2.5],"w":[1,2.5],"other":[1.0],"n":3,"__id__":"mine"}',
        '{"_id":{"$oid":"0123456789abcdef01234567"},"v":"[1.0]","w":[],"d":{"$date":"2024-01-01T00:00:00Z"}}',
        '{"_id":7,"v":[1.0]}',
        "[1]",
        '{"_id":{"a":1}}',
    ]
    raw = spark.createDataFrame([(d,) for d in docs], "doc string")
    points = src.normalize("mongodb", raw, vector_fields=["v", "w"], mode="quarantine")
    got = points_by_id(src.accepted(points))
    oid = 'ObjectID("0123456789abcdef01234567")'
    assert got[u5("a")]["vectors"] == {"v": [1.0, 2.5]}
    assert got[u5("a")]["payload"] == {"w": [1.0, 2.5], "other": [1.0], "n": 3.0, "__id__": "mine"}
    assert got[u5(oid)]["vectors"] == {"w": []}
    assert got[u5(oid)]["payload"] == {"__id__": oid, "v": "[1.0]", "d": {"$date": "2024-01-01T00:00:00Z"}}
    assert sorted(r["reject_reason"] for r in src.rejected(points).collect()) == [
        "document is not a JSON object",
        "the document's _id is of no kind a key can be made of",
        "the document's _id is of no kind a key can be made of",
    ]
    with pytest.raises(ValueError, match="vector_fields"):
        src.normalize("mongodb", raw, vector_fields=[])


SOURCE = '{"v":[1,2.5],"e":[],"holes":[1,null],"n":1,"__id__":"mine","doc":"t"}'


def test_elasticsearch(spark):
    raw = spark.createDataFrame(
        [("1", SOURCE, '{"v":[9.0],"h":[1.0,2.0],"doc":["t"],"e":[]}'), ("2", SOURCE, None), (None, "{}", None), ("4", "[]", None)],
        src.RAW_SCHEMAS["elasticsearch"],
    )
    points = src.normalize("elasticsearch", raw, mode="quarantine")
    got = points_by_id(src.accepted(points))
    rest = {"e": [], "holes": [1.0, None], "n": 1.0, "__id__": "mine", "doc": "t"}
    assert got[u5("1")]["vectors"] == {"v": [9.0], "h": [1.0, 2.0]} and got[u5("1")]["payload"] == rest
    assert got[u5("2")]["vectors"] == {"v": [1.0, 2.5]} and got[u5("2")]["payload"] == rest
    assert sorted(r["reject_reason"] for r in src.rejected(points).collect()) == ["the hit has no _id", "the hit's _source is no JSON object"]
    mapped = points_by_id(src.normalize("elasticsearch", raw.filter("_id = '2'"), detect="mapping", vector_fields=["h"]))
    assert mapped[u5("2")]["vectors"] == {} and mapped[u5("2")]["payload"]["v"] == [1.0, 2.5]
    with pytest.raises(ValueError, match="vector_fields"):
        src.normalize("elasticsearch", raw, detect="mapping")
    with pytest.raises(ValueError, match="detect"):
        src.normalize("elasticsearch", raw, detect="guess")


def test_opensearch_empty_list_is_a_vector(spark):
    raw = spark.createDataFrame([("1", SOURCE)], src.RAW_SCHEMAS["opensearch"])
    got = points_by_id(src.normalize("opensearch", raw, id_field="key"))
    assert got[u5("1")]["vectors"] == {"v": [1.0, 2.5], "e": []}
    assert got[u5("1")]["payload"] == {"holes": [1.0, None], "n": 1.0, "__id__": "mine", "doc": "t", "key": "1"}


def test_pg(spark):
    raw = spark.createDataFrame([(1, "Entry 1", 30, 1.75, True, [1.0, 2.0]), (2, None, None, None, None, None)], "id int, name string, age int, height double, is_active boolean, embedding array<float>")
    got = points_by_id(src.normalize("pg", raw, key_column="id", vector_columns=["embedding"]))
    assert got[u5("1")]["vectors"] == {"embedding": [1.0, 2.0]}
    assert got[u5("1")]["payload"] == {"id": 1, "name": "Entry 1", "age": 30, "height": 1.75, "is_active": True}
    assert got[u5("2")]["vectors"] == {}
    assert got[u5("2")]["payload"] == {"id": 2, "name": None, "age": None, "height": None, "is_active": None, "embedding": None}
    some = points_by_id(src.normalize("pg", raw, key_column="id", vector_columns=["embedding"], columns=["id", "age"]))
    assert some[u5("1")]["vectors"] == {} and some[u5("1")]["payload"] == {"id": 1, "age": 30}
    with pytest.raises(ValueError, match="key column"):
        src.normalize("pg", raw, key_column="id", vector_columns=[], columns=["age"])


def test_pg_json_column_numbers_are_doubles(spark):
    raw = spark.sql("""SELECT 1 AS id, parse_json('{"a":[1,2.5],"b":{"c":7}}') AS j, parse_json('null') AS k""")
    points = src.normalize("pg", raw, key_column="id", vector_columns=[])
    kinds = points.select(F.schema_of_variant(F.variant_get("payload", "$.j", "variant")), F.schema_of_variant(F.variant_get("payload", "$.k", "variant"))).first()
    assert tuple(kinds) == ("OBJECT<a: ARRAY<DOUBLE>, b: OBJECT<c: DOUBLE>>", "VOID")


def test_s3_keeps_whole_numbers(spark):
    raw = spark.createDataFrame([("vector-0", [1.0], '{"age":30,"h":1.5,"__id__":9}'), ("x", None, None)], src.RAW_SCHEMAS["s3"])
    points = src.normalize("s3", raw, mode="quarantine")
    good = src.accepted(points)
    assert points_by_id(good)[u5("vector-0")]["payload"] == {"age": 30, "h": 1.5, "__id__": "vector-0"}
    assert good.select(F.schema_of_variant("payload")).first()[0] == "OBJECT<__id__: STRING, age: BIGINT, h: DOUBLE>"
    assert src.rejected(points).first()["reject_reason"] == "unexpected vector data type"


def test_faiss_positions_and_id_map(spark):
    raw = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [3.0])], src.RAW_SCHEMAS["faiss"])
    plain = points_by_id(src.normalize("faiss", raw))
    assert set(plain) == {0, 1, 2} and plain[1]["payload"] is None and plain[1]["vectors"] == {"": [2.0]}
    id_map = spark.createDataFrame([(0, 500), (2, -1)], "pos bigint, id bigint")
    points = src.normalize("faiss", raw, id_map=id_map, mode="quarantine")
    assert set(points_by_id(src.accepted(points))) == {500, 1}
    assert src.rejected(points).first()["reject_reason"] == "negative id"


def test_milvus(spark):
    raw = spark.createDataFrame([(1, [0.5], 3, '{"a":1}', "p1"), (2, None, None, None, "p2"), (-3, None, 1, "[1]", "p1")], "pk bigint, v array<float>, n tinyint, j string, partition string")
    points = normalize_milvus(raw, pk="pk", json_columns=["j"], mode="quarantine")
    got = points_by_id(src.accepted(points))
    assert got[1]["vectors"] == {"v": [0.5]} and got[1]["payload"] == {"n": 3, "j": {"a": 1.0}}
    assert got[2]["vectors"] == {} and got[2]["payload"] == {"n": None, "j": None}
    assert [r["reject_reason"] for r in src.rejected(points).collect()] == ["negative primary key"]
    assert set(points_by_id(normalize_milvus(raw, pk="pk", partitions=["p2"]))) == {2}
    text = spark.createDataFrame([(U, 1), ("plain", 2)], "pk string, n int")
    split = normalize_milvus(text, pk="pk", mode="quarantine")
    assert set(points_by_id(src.accepted(split))) == {U}
    assert src.rejected(split).first()["reject_reason"] == "text primary key is not a UUID"
    with pytest.raises(TypeError, match="a field of type"):
        normalize_milvus(spark.createDataFrame([(1, b"x")], "pk bigint, b binary"), pk="pk")
    with pytest.raises(ValueError, match="primary key"):
        normalize_milvus(raw, pk="nope")


def test_collection_passes_through(spark):
    raw = spark.sql(
        """SELECT named_struct('num', CAST('18446744073709551615' AS decimal(20,0)), 'uuid', CAST(null AS string)) AS id,
                  map('', named_struct('data', array(CAST(0.9 AS float)), 'indices', CAST(null AS array<bigint>), 'vectors_count', CAST(null AS int))) AS vectors,
                  parse_json('{"color":"red","i":1,"d":1e0}') AS payload,
                  named_struct('keyword', 'shard_a', 'number', CAST(null AS decimal(20,0))) AS shard_key, 5L AS source_ord
           UNION ALL SELECT named_struct('num', null, 'uuid', null), null, null, null, 6L"""
    )
    points = src.normalize("collection", raw, mode="quarantine")
    got = points_by_id(src.accepted(points))
    point = got[18446744073709551615]
    assert point["raw"]["shard_key"]["keyword"] == "shard_a" and point["raw"]["source_ord"] == 5
    assert src.accepted(points).select(F.schema_of_variant("payload")).first()[0] == "OBJECT<color: STRING, d: DOUBLE, i: BIGINT>"
    assert src.rejected(points).count() == 1


@pytest.mark.parametrize("source", ["pinecone", "chroma", "weaviate", "s3", "faiss", "elasticsearch", "opensearch", "collection"])
def test_empty_source_gives_no_points(spark, source):
    raw = spark.createDataFrame([], src.RAW_SCHEMAS[source])
    assert src.normalize(source, raw).count() == 0


def test_staged_json_lines(spark, tmp_path):
    (tmp_path / "hits.jsonl").write_text('{"_id":"1","_source":{"v":[1.5,2],"n":1},"fields":{"h":[1]}}\n{"_id":"2","_source":{"s":"x"}}\n')
    raw = src.read_staged(spark, "elasticsearch", str(tmp_path), "jsonl")
    got = points_by_id(src.normalize("elasticsearch", raw))
    assert got[u5("1")]["vectors"] == {"v": [1.5, 2.0], "h": [1.0]} and got[u5("2")]["payload"] == {"__id__": "2", "s": "x"}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "d.jsonl").write_text('{"_id":"k","v":[1.5]}\n')
    docs = src.read_staged(spark, "mongodb", str(tmp_path / "docs"), "jsonl")
    assert points_by_id(src.normalize("mongodb", docs, vector_fields=["v"]))[u5("k")]["vectors"] == {"v": [1.5]}
    with pytest.raises(ValueError, match="no fixed schema"):
        src.read_staged(spark, "pg", str(tmp_path), "jsonl")
    with pytest.raises(ValueError, match="staged format"):
        src.read_staged(spark, "s3", str(tmp_path), "csv")


def test_jdbc_predicates_cover_every_key_once():
    from pointferry.sources.staged import range_predicates

    assert range_predicates("id", []) == ["1 = 1"]
    assert range_predicates("id", ["5", "o'k"]) == ['"id" <= \'5\'', '"id" > \'5\' AND "id" <= \'o\'\'k\'', '"id" > \'o\'\'k\'']

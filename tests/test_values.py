"""Vector and payload values on hand-written rows."""

import json
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointferry.functions import numbers, payload as pl, vectors as vec


def _one(spark, text, expr):
    return spark.createDataFrame([(text,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


def test_float_bits_survive(spark):
    values = [0.0, -0.0, 1.5, float("inf"), float("-inf"), float("nan"), 1e-45, 3.4028235e38]
    blobs = [struct.pack("<8f", *values), b"", None, struct.pack("<2f", 1.0, 2.0) + b"xyz", b"ab"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blobs)], "i int, b binary").coalesce(1)
    got = {r["i"]: r["v"] for r in df.select("i", vec.bytes_to_floats(F.col("b")).alias("v")).collect()}
    assert np.array(got[0], "<f4").tobytes() == np.array(values, "<f4").tobytes()
    assert got[1] == [] and got[2] is None and got[3] == [1.0, 2.0] and got[4] == []


def test_encode_then_decode_is_identity(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(rng.integers(0, 20)).astype("f4")]) for i in range(300)] + [(300, None)]
    df = spark.createDataFrame(rows, "i int, v array<float>").repartition(5)
    back = df.select("i", "v", vec.bytes_to_floats(vec.floats_to_bytes(F.col("v"))).alias("w")).collect()
    assert len(back) == 301
    assert all(r["v"] == r["w"] for r in back)


VECTOR_CASES = [
    # text, non-empty rule, empty-allowed rule, doubles-only rule
    ("[1,2.5]", [1.0, 2.5], [1.0, 2.5], None),
    ("[1.0,2.5]", [1.0, 2.5], [1.0, 2.5], [1.0, 2.5]),
    ("[1e2, -2.5E-1]", [100.0, -0.25], [100.0, -0.25], [100.0, -0.25]),
    ("[1,2]", [1.0, 2.0], [1.0, 2.0], None),
    ("[]", None, [], []),
    ("[ ]", None, [], []),
    ("[null]", None, None, None),
    ("[1.0,null]", None, None, None),
    ('["1"]', None, None, None),
    ('[1.0,"2"]', None, None, None),
    ("[true]", None, None, None),
    ("[[1.0]]", None, None, None),
    ('{"a":1.0}', None, None, None),
    ('"x"', None, None, None),
    ("null", None, None, None),
    ("1.5", None, None, None),
]


@pytest.mark.parametrize("text,full,empty,doubles", VECTOR_CASES)
def test_what_counts_as_a_vector(spark, text, full, empty, doubles):
    assert _one(spark, text, lambda v: vec.as_vector_nonempty(F.parse_json(v))) == full
    assert _one(spark, text, lambda v: vec.as_vector_or_empty(F.parse_json(v))) == empty
    assert _one(spark, text, lambda v: vec.as_vector_doubles(F.parse_json(v))) == doubles


def test_narrowing_overflows_to_infinity(spark):
    assert _one(spark, "[1e300, 0.1]", lambda v: vec.as_vector_nonempty(F.parse_json(v))) == [math.inf, float(np.float32(0.1))]


def test_merge_override_and_absent_side(spark):
    a = vec.named({"x": vec.dense(F.array(F.lit(1.0))), "y": vec.dense(F.array(F.lit(2.0)))})
    b = vec.named({"y": vec.dense(F.array(F.lit(3.0)))})
    row = spark.range(1).select(vec.merge_named(a, b).alias("m"), vec.merge_named(a, F.lit(None).cast("map<string,struct<data:array<float>,indices:array<bigint>,vectors_count:int>>")).alias("n")).first()
    assert {k: v["data"] for k, v in row["m"].items()} == {"x": [1.0], "y": [3.0]}
    assert {k: v["data"] for k, v in row["n"].items()} == {"x": [1.0], "y": [2.0]}


def _kinds(spark, text, rewrite):
    df = spark.createDataFrame([(text,)], "v string")
    return df.select(F.schema_of_variant(F.parse_json(rewrite(F.col("v")))).alias("r")).first()["r"]


def test_numbers_in_strings_are_left_alone(spark):
    text = '{"a":"1, 2.5 \\" 3","2":[1,-2.5,3e4,{"b":0}],"c":"\\\\","d":-7}'
    out = _one(spark, text, numbers.numbers_to_double)
    assert out == '{"a":"1, 2.5 \\" 3","2":[1e0,-2.5e0,3e4,{"b":0e0}],"c":"\\\\","d":-7e0}'
    assert json.loads(out) == json.loads(text)


def test_long_text_does_not_overflow_the_matcher(spark):
    text = json.dumps({"a": "x\\\"1" * 200_000, "n": list(range(20_000))})
    out = _one(spark, text, numbers.numbers_to_double)
    assert json.loads(out) == json.loads(text)
    assert out.endswith("19999e0]}")


@pytest.mark.parametrize(
    "number,kind",
    [
        ("7", "BIGINT"),
        ("-7", "BIGINT"),
        ("9223372036854775807", "BIGINT"),
        ("9223372036854775808", "DOUBLE"),
        ("9300000000000000000", "DOUBLE"),
        ("-9223372036854775809", "DOUBLE"),
        ("10000000000000000000", "DOUBLE"),
        ("1.0", "DOUBLE"),
        ("1e2", "DOUBLE"),
        ("0.5", "DOUBLE"),
    ],
)
def test_typed_numbers(spark, number, kind):
    assert _kinds(spark, f'{{"a":{number}}}', numbers.typed_numbers) == f"OBJECT<a: {kind}>"
    nested = _kinds(spark, f'{{"a":{{"b":[{number}]}}}}', numbers.typed_numbers)
    assert nested == f"OBJECT<a: OBJECT<b: ARRAY<{kind}>>>"


def test_every_number_becomes_a_double_at_any_depth(spark):
    text = '{"a":1,"b":2.5,"c":{"d":[3,{"e":4}]},"f":"5","g":null,"h":true,"i":9223372036854775808}'
    fields = spark.createDataFrame([(text,)], "v string").select(pl.double_numbers(pl.json_fields(F.col("v"))).alias("f"))
    kind = fields.select(F.schema_of_variant(pl.fields_to_payload(F.col("f")))).first()[0]
    assert kind == (
        "OBJECT<a: DOUBLE, b: DOUBLE, c: OBJECT<d: ARRAY<VARIANT>>, f: STRING, g: VOID, h: BOOLEAN, i: DOUBLE>"
    )
    nested = fields.select(F.to_json(pl.fields_to_payload(F.col("f")))).first()[0]
    assert json.loads(nested) == {"a": 1.0, "b": 2.5, "c": {"d": [3.0, {"e": 4.0}]}, "f": "5", "g": None, "h": True, "i": 9.223372036854775808e18}


@pytest.mark.parametrize("text", ["[1]", "1", '"a"', "null", "{bad", None])
def test_not_an_object_has_no_fields(spark, text):
    assert _one(spark, text, pl.json_fields) is None


def test_last_of_repeated_keys_wins(spark):
    assert _one(spark, '{"a":1,"a":2}', lambda v: F.to_json(pl.fields_to_payload(pl.json_fields(v)))) == '{"a":2}'


@pytest.mark.parametrize(
    "text,number",
    [("1.5", 1.5), ("-3", -3.0), ("+2", 2.0), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("0x1p-2", 0.25), ("Inf", math.inf), ("-infinity", -math.inf)],
)
def test_numeric_texts(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string").select(pl.parse_numeric_or_text(F.col("v")).alias("p"))
    row = df.select(F.schema_of_variant("p"), F.try_variant_get("p", "$", "double")).first()
    assert tuple(row) == ("DOUBLE", number)


@pytest.mark.parametrize("text", ["", "abc", " 1", "1 ", "1d", "1f", "1e999", "1,5", "--1", "0x10", "-nan"])
def test_other_texts_stay(spark, text):
    df = spark.createDataFrame([(text,)], "v string").select(pl.parse_numeric_or_text(F.col("v")).alias("p"))
    row = df.select(F.schema_of_variant("p"), F.try_variant_get("p", "$", "string")).first()
    assert tuple(row) == ("STRING", text)


def test_sanitize_walks_the_schema(spark):
    df = spark.sql(
        """SELECT struct(cast(1 AS smallint) AS small, 2 AS whole, 3L AS big, cast(1.25 AS float) AS single, cast('1.50' AS decimal(8,2)) AS dec,
                  timestamp_ntz'2024-01-02 03:04:05.678' AS at, date'2024-01-02' AS day, X'000102030405060708090A0B0C0D0E0F' AS guid, X'6869' AS raw,
                  array(cast(1 AS smallint)) AS list, map(1, cast(null AS string)) AS m, cast(null AS struct<a:int>) AS s) AS v"""
    )
    text = df.select(F.to_json(pl.to_variant(F.col("v"), df.schema["v"].dataType))).first()[0]
    assert json.loads(text) == {
        "small": "1", "whole": 2, "big": 3, "single": 1.25, "dec": "1.50", "at": "2024-01-02T03:04:05Z", "day": "2024-01-02T00:00:00Z",
        "guid": "00010203-0405-0607-0809-0a0b0c0d0e0f", "raw": "aGk=", "list": ["1"], "m": {"1": None}, "s": None,
    }


def test_rfc3339_prints_an_offset(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        got = spark.sql("SELECT timestamp'2024-01-02 03:04:05.9' AS t").select(pl.rfc3339(F.col("t"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == "2024-01-02T03:04:05+05:30"


def test_lean_payload_rules(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x","c":[1]}',)], "v string").select(F.parse_json("v").alias("p"))
    assert df.select(F.to_json(pl.keep_payload(F.col("p"), ["a", "zz"]))).first()[0] == '{"a":1}'
    assert df.select(F.to_json(pl.keep_payload(F.col("p"), []))).first()[0] == '{"a":1,"b":"x","c":[1]}'
    assert df.select(F.to_json(pl.keep_payload(F.col("p"), ["zz"]))).first()[0] == "{}"

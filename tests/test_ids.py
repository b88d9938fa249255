import random
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from pointferry.functions import ids


def _column(spark, values, ddl="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {ddl}")


def test_uuid5_equals_the_standard_library(spark):
    rng = random.Random(7)
    alphabet = "abcXYZ019 -_/é漢🙂\"'\\\n"
    texts = ["", "a", "x" * 5000] + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(200)]
    rows = _column(spark, texts).select("v", ids.to_point_uuid(F.col("v")).alias("u")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["u"] == str(uuid.uuid5(uuid.NAMESPACE_URL, r["v"]))


@pytest.mark.parametrize("shape", ["{}", "{{{}}}", "urn:uuid:{}", "URN:UUID:{}"])
def test_uuid_spellings_are_kept_as_written(spark, shape):
    text = shape.format("6BA7B811-9dad-11d1-80b4-00c04fd430c8")
    row = _column(spark, [text]).select(ids.is_uuid(F.col("v")).alias("ok"), ids.to_point_uuid(F.col("v")).alias("u")).first()
    assert row["ok"] and row["u"] == text


@pytest.mark.parametrize(
    "text",
    [
        "6ba7b811-9dad-11d1-80b4-00c04fd430c",
        "6ba7b811-9dad-11d1-80b4-00c04fd430cg",
        "6ba7b8119-dad-11d1-80b4-00c04fd430c8",
        "6ba7b811-9dad-11d1-80b4-00c04fd430c8\n",
        "urn:uuid:6ba7b8119dad11d180b400c04fd430c8",
        "",
    ],
)
def test_near_uuids_are_hashed(spark, text):
    row = _column(spark, [text]).select(ids.is_uuid(F.col("v")).alias("ok"), ids.to_point_uuid(F.col("v")).alias("u")).first()
    assert not row["ok"] and row["u"] == str(uuid.uuid5(uuid.NAMESPACE_URL, text))


def test_null_text_has_no_uuid(spark):
    assert _column(spark, [None]).select(ids.to_point_uuid(F.col("v"))).first()[0] is None


def test_offset_key_hashes_even_a_uuid(spark):
    text = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    assert _column(spark, [text]).select(ids.offset_key(F.col("v"))).first()[0] == str(uuid.uuid5(uuid.NAMESPACE_URL, text))


def test_binary_keys(spark):
    df = _column(spark, [bytes(range(16)), b"hello"], "binary")
    got = [r[0] for r in df.select(ids.key_to_string(F.col("v"), T.BinaryType())).collect()]
    assert got == [str(uuid.UUID(bytes=bytes(range(16)))), "hello"]


def test_timestamp_key_prints_with_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.120' AS v UNION ALL SELECT timestamp_ntz'2024-01-02 03:04:05' AS v")
    got = {r[0] for r in df.select(ids.key_to_string(F.col("v"), T.TimestampNTZType())).collect()}
    assert got == {"2024-01-02 03:04:05.12 +0000 UTC", "2024-01-02 03:04:05 +0000 UTC"}


def test_largest_number_id_survives(spark):
    df = spark.range(1).select(ids.number_id(F.lit("18446744073709551615").cast("decimal(20,0)")).alias("id"))
    assert str(df.first()["id"]["num"]) == "18446744073709551615"


def test_id_order(spark):
    df = spark.sql("SELECT CAST(n AS decimal(20,0)) AS num, u AS uuid FROM VALUES (10, null), (null, 'b'), (9, null), (null, 'a'), (null, null) AS t(n, u)")
    points = df.select(F.struct("num", "uuid").alias("id"))
    by_columns = [tuple(r["id"]) for r in points.orderBy(*ids.id_order(F.col("id"))).collect()]
    by_key = [tuple(r["id"]) for r in points.orderBy(ids.id_order_key(F.col("id"))).collect()]
    assert by_columns == by_key
    assert [str(n or u) for n, u in by_key] == ["None", "9", "10", "a", "b"]


def test_make_point_id_rejects_other_types():
    with pytest.raises(TypeError):
        ids.make_point_id(None, T.DoubleType())

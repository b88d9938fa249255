import pytest
from pyspark.sql import functions as F

from pointferry.sinks.point_table import PointTable
from pointferry.sources import normalize_pg, normalize_s3_vectors
from pointferry.sources.staged import RAW_SCHEMAS, read_staged
from pointferry.streaming.incremental import incremental_copy
from pointferry.streaming.progress import PROGRESS_SCHEMA, ProgressStore


def offsets(store):
    return {r["name"]: (r["offset"], r["is_number"], r["offset_count"]) for r in store.start_offsets().collect()}


def test_store_read_and_delete_own_records(spark, tmp_path):
    store = ProgressStore(spark, str(tmp_path / "p"))
    assert offsets(store) == {}
    store.store_one("a", 18446744073709551615, 3)
    store.store_one("b", "token", 7)
    store.store_one("b", None, 99)
    store.store_one("a", 5, 4)
    store.store_one("a-workers-2-range-0", "k", 1)
    store.store_one("ab", 1, 1)
    assert offsets(store) == {"a": ("5", True, 4), "b": ("token", False, 7), "a-workers-2-range-0": ("k", False, 1), "ab": ("1", True, 1)}
    store.delete("a")
    assert offsets(store) == {"b": ("token", False, 7), "ab": ("1", True, 1)}
    store.store_one("a", 0, 0)
    assert offsets(store)["a"] == ("0", True, 0)


def test_incomplete_records_give_no_start(spark):
    from pointferry.streaming.progress import start_offsets

    at = F.lit("2024-01-01").cast("timestamp")
    rows = spark.createDataFrame([("no count", 1, None), ("no offset", None, 5), ("both", 1, 5)], "name string, n int, offset_count bigint")
    records = rows.select("name", F.col("n").cast("decimal(20,0)").alias("offset_num"), F.lit(None).cast("string").alias("offset_text"), "offset_count", at.alias("updated_at"), F.lit(0).cast("bigint").alias("seq"), F.lit(False).alias("deleted"))
    assert records.schema.fieldNames() == PROGRESS_SCHEMA.fieldNames()
    assert [r["name"] for r in start_offsets(records).collect()] == ["both"]


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _copy(df):
    return normalize_pg(df, key_column="event_id", vector_columns=[])


def _stream(spark, events, folder, files=1):
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _canonical(points):
    return sorted((r[0], r[1]) for r in points.select("id.uuid", F.to_json("payload")).collect())


def test_stream_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    events = _events(spark, sf_dir)
    events.repartition(5).write.parquet(str(tmp_path / "in"))
    table, progress = PointTable(spark, str(tmp_path / "t")), ProgressStore(spark, str(tmp_path / "p"))

    def run(copy=_copy):
        return incremental_copy(_stream(spark, events, str(tmp_path / "in"), 2), copy, table, str(tmp_path / "c"), "events", progress)

    calls = []

    def failing(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return _copy(df)

    with pytest.raises(Exception, match="stopped"):
        run(failing)
    part = table.read().count()
    assert 0 < part < events.count() and offsets(progress)["events"][2] == part
    assert run() == 2
    assert _canonical(table.read()) == _canonical(_copy(events))
    assert offsets(progress)["events"] == ("2", True, events.count())
    assert run() == 0
    events.limit(3).withColumn("event_type", F.lit("changed")).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() >= 1
    assert table.read().count() == events.count()
    assert table.read().filter(F.try_variant_get("payload", "$.event_type", "string") == "changed").count() == 3


def test_batch_repeated_after_a_crash_before_its_record(spark, sf_dir, tmp_path):
    events = _events(spark, sf_dir)
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    table, progress = PointTable(spark, str(tmp_path / "t")), ProgressStore(spark, str(tmp_path / "p"))
    store_one, progress.store_one = progress.store_one, lambda *a: (_ for _ in ()).throw(RuntimeError("crash"))
    with pytest.raises(Exception, match="crash"):
        incremental_copy(_stream(spark, events, str(tmp_path / "in")), _copy, table, str(tmp_path / "c"), "events", progress)
    assert table.read().count() == events.count() and offsets(progress) == {}
    progress.store_one = store_one
    incremental_copy(_stream(spark, events, str(tmp_path / "in")), _copy, table, str(tmp_path / "c"), "events", progress)
    assert table.read().count() == events.count() and offsets(progress)["events"][2] == events.count()
    assert len(list((tmp_path / "t" / "commits").iterdir())) == 1


def test_new_checkpoint_starts_over(spark, sf_dir, tmp_path):
    events = _events(spark, sf_dir)
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    table, progress = PointTable(spark, str(tmp_path / "t")), ProgressStore(spark, str(tmp_path / "p"))
    for name in ("one", "two"):
        assert incremental_copy(_stream(spark, events, str(tmp_path / "in")), _copy, table, str(tmp_path / name), "events", progress) == 1
        progress.delete("events")
    assert len(list((tmp_path / "t" / "commits").iterdir())) == 2
    assert _canonical(table.read()) == _canonical(_copy(events))


def test_staged_source_as_a_stream(spark, tmp_path):
    raw = spark.createDataFrame([(f"k{i}", [float(i)], None) for i in range(10)], RAW_SCHEMAS["s3"])
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    table = PointTable(spark, str(tmp_path / "t"))
    stream = read_staged(spark, "s3", str(tmp_path / "in"), stream=True)
    assert incremental_copy(stream, normalize_s3_vectors, table, str(tmp_path / "c"), "s3") == 1
    assert table.read().count() == 10

"""Progress records: where each source, or each of its key ranges, got to.

Records are only ever appended; the newest one per name holds. A record marked deleted ends a
name's history. Offsets are a number or a text, as point ids are.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pointferry.functions.ids import offset_key, range_offset_name

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("offset_num", T.DecimalType(20, 0)),
        T.StructField("offset_text", T.StringType()),
        T.StructField("offset_count", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
        # Decides between records of one instant.
        T.StructField("seq", T.LongType()),
        T.StructField("deleted", T.BooleanType()),
    ]
)
PROGRESS_COLUMNS = PROGRESS_SCHEMA.fieldNames()


def storable(records: DataFrame) -> DataFrame:
    """Records worth storing: one without an offset stores nothing."""
    has_offset = F.col("offset_num").isNotNull() | F.col("offset_text").isNotNull()
    return records.filter(has_offset | F.col("deleted"))


def latest_records(records: DataFrame) -> DataFrame:
    """The newest record of every name that was not deleted.

    The write history of one name may be long; it is reduced before the shuffle.
    """
    rest = F.struct(*[c for c in PROGRESS_COLUMNS if c != "name"])
    newest = records.groupBy("name").agg(F.max_by(rest, F.struct("updated_at", "seq")).alias("r"))
    return newest.select("name", "r.*").filter(~F.coalesce(F.col("deleted"), F.lit(False))).select(*PROGRESS_COLUMNS)


def start_offsets(records: DataFrame) -> DataFrame:
    """(name, record_id, offset, is_number, count) to resume from; none where a part is missing."""
    newest = latest_records(storable(records))
    complete = newest.filter(F.col("offset_count").isNotNull())
    return complete.select(
        "name",
        offset_key(F.col("name")).alias("record_id"),
        F.coalesce(F.col("offset_num").cast("string"), F.col("offset_text")).alias("offset"),
        F.col("offset_num").isNotNull().alias("is_number"),
        "offset_count",
    )


def store_offsets(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """The record set after an update."""
    return existing.select(*PROGRESS_COLUMNS).unionByName(storable(updates).select(*PROGRESS_COLUMNS))


def delete_names(names: DataFrame, at: Column, seq: Column) -> DataFrame:
    """Records that end the history of the given names, and of no others."""
    return names.select(
        "name",
        F.lit(None).cast("decimal(20,0)").alias("offset_num"),
        F.lit(None).cast("string").alias("offset_text"),
        F.lit(None).cast("bigint").alias("offset_count"),
        at.cast("timestamp").alias("updated_at"),
        seq.cast("bigint").alias("seq"),
        F.lit(True).alias("deleted"),
    )


def resume_ranges(ranges: DataFrame, records: DataFrame, source: str, workers: int) -> DataFrame:
    """Ranges with their stored offset and count; ``start_key`` moves up to the offset.

    The ranges come from storage, not from a new sample, so an offset meets the range it was
    stored for.
    """
    key_type = ranges.schema["end_key"].dataType
    named = ranges.withColumn("name", range_offset_name(F.lit(source), F.lit(workers), F.col("range_id")))
    stored = start_offsets(records).select("name", F.col("offset").try_cast(key_type).alias("_offset"), "offset_count")
    joined = named.join(stored, "name", "left")
    done = F.col("_offset").isNotNull() & F.col("end_key").isNotNull() & (F.col("_offset") >= F.col("end_key"))
    return joined.select(
        "range_id",
        "name",
        F.coalesce(F.col("_offset"), F.col("start_key")).alias("start_key"),
        "end_key",
        F.coalesce(F.col("offset_count"), F.lit(0)).cast("bigint").alias("done_count"),
        done.alias("done"),
    )


def progress_totals(records: DataFrame, source_counts: DataFrame) -> DataFrame:
    """Processed rows per source, over its ranges, against the source's count.

    ``source_counts`` is (source, source_count); a record belongs to the source its name is, or
    whose range it names.
    """
    base_name = F.regexp_replace("name", r"-workers-\d+-range-\d+$", "")
    done = start_offsets(records).groupBy(base_name.alias("source")).agg(F.sum("offset_count").alias("processed"))
    joined = source_counts.join(done, "source", "left")
    processed = F.coalesce(F.col("processed"), F.lit(0)).cast("bigint")
    return joined.select(
        "source", "source_count", processed.alias("processed"), (F.col("source_count") - processed).alias("remaining")
    )


class ProgressStore:
    """Progress records in a folder of appended Parquet files.

    Nothing has to be created first. It is small: one row per name and stored step.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def records(self) -> DataFrame:
        if not self._exists():
            return self.spark.createDataFrame([], PROGRESS_SCHEMA)
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)

    def start_offsets(self) -> DataFrame:
        return start_offsets(self.records())

    def store(self, updates: DataFrame) -> None:
        """Append records (name, offset_num, offset_text, offset_count); time and order are set here."""
        stamped = (
            updates.withColumn("updated_at", F.current_timestamp())
            .withColumn("seq", F.lit(time.time_ns()).cast("bigint"))
            .withColumn("deleted", F.lit(False))
        )
        storable(stamped).select(*PROGRESS_COLUMNS).coalesce(1).write.mode("append").parquet(self.path)

    def store_one(self, name: str, offset: int | str | None, count: int) -> None:
        """Store one source's offset; a missing offset stores nothing."""
        if offset is None:
            return
        number = str(offset) if isinstance(offset, int) else None
        text = None if isinstance(offset, int) else offset
        row = self.spark.range(1).select(
            F.lit(name).alias("name"),
            F.lit(number).cast("decimal(20,0)").alias("offset_num"),
            F.lit(text).cast("string").alias("offset_text"),
            F.lit(count).cast("bigint").alias("offset_count"),
        )
        self.store(row)

    def delete(self, source: str) -> None:
        """End the records of one source and of its ranges; other sources' stay."""
        own = F.regexp_replace("name", r"-workers-\d+-(?:range-\d+|plan)$", "") == source
        names = latest_records(self.records()).filter(own).select("name")
        ended = delete_names(names, F.current_timestamp(), F.lit(time.time_ns()))
        ended.select(*PROGRESS_COLUMNS).coalesce(1).write.mode("append").parquet(self.path)

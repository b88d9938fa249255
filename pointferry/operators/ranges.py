"""Key ranges: sampled boundaries, range tables, and giving rows their range.

A range is ``(start_key, end_key]``; a NULL end is open. The boundaries are kept as a small table
next to the progress records, so a resumed run sees the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

SAMPLES_PER_WORKER = 10
# With more rows a wanted key than MANY_ROWS, about DRAWN rows a wanted key are sorted.
MANY_ROWS, DRAWN = 64, 8


def boundary_sample(df: DataFrame, key: str, workers: int, seed: int = 0) -> DataFrame:
    """``min(10 * workers, rows)`` random keys in key order; only the key column is read.

    Keys are drawn by the order of a seeded hash, so a task that is run again draws the same ones,
    which ``rand()`` would not promise once partitions change. Of many rows only those with a low
    hash are sorted, some times as many as are wanted; what is drawn is the same.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    wanted = workers * SAMPLES_PER_WORKER
    keys = df.select(key).filter(F.col(key).isNotNull())
    rows = keys.count()
    if rows > MANY_ROWS * wanted:
        low = keys.filter(draw < F.lit(f"{int(DRAWN * wanted / rows * (1 << 64)):016x}"))
        if low.count() >= wanted:
            keys = low
    return keys.orderBy(draw, key).limit(wanted).orderBy(key)


def _numbered(sample: DataFrame, key: str) -> DataFrame:
    # At most 10 keys per worker come in, so one task for the numbering is enough.
    order = Window.orderBy(key)
    return sample.select(F.col(key).alias("end_key"), (F.row_number().over(order) - 1).alias("pos"))


def ranges_per_worker(sample: DataFrame, key: str, workers: int) -> DataFrame:
    """One range per worker; with fewer keys than workers, one more than there are keys.

    Boundary ``i`` is the sample key at ``(i * keys) / ranges``. No keys give one open range.
    """
    numbered = _numbered(sample, key).withColumn("n_keys", F.count(F.lit(1)).over(Window.partitionBy()))
    n_ranges = F.when(F.col("n_keys") < workers, F.col("n_keys") + 1).otherwise(F.lit(workers))
    n_ranges = n_ranges.cast("bigint")
    bounds = numbered.withColumn("n_ranges", n_ranges)
    # The key at position p closes range i-1 for each i in 1..ranges-1 with (i * keys) div ranges = p.
    steps = F.when(F.col("n_ranges") > 1, F.sequence(F.lit(1).cast("bigint"), F.col("n_ranges") - 1))
    bounds = bounds.select("end_key", "pos", "n_keys", "n_ranges", F.explode(steps).alias("i"))
    bounds = bounds.filter(F.expr("(i * n_keys) div n_ranges = pos"))
    closed = bounds.select((F.col("i") - 1).cast("int").alias("range_id"), "end_key")
    return _with_open_end(closed, sample.schema[key].dataType)


def ranges_per_key(sample: DataFrame, key: str) -> DataFrame:
    """One range per sampled key, and an open one after the last. No keys give one open range."""
    closed = _numbered(sample, key).select(F.col("pos").cast("int").alias("range_id"), "end_key")
    return _with_open_end(closed, sample.schema[key].dataType)


def _with_open_end(closed: DataFrame, key_type: T.DataType) -> DataFrame:
    last = closed.agg(F.coalesce(F.max("range_id") + 1, F.lit(0)).cast("int").alias("range_id"))
    every = closed.unionByName(last.withColumn("end_key", F.lit(None).cast(key_type)))
    start = F.lag("end_key").over(Window.orderBy("range_id"))
    return every.select("range_id", start.alias("start_key"), "end_key")


def boundaries_of(ranges: DataFrame) -> list:
    """The closed ends in order. A range table has one row per worker or sample key, never per data row."""
    rows = ranges.filter(F.col("end_key").isNotNull()).orderBy("range_id").select("end_key").collect()
    return [r["end_key"] for r in rows]


def assign_ranges(df: DataFrame, key: str, ranges: DataFrame | list, name: str = "range_id") -> DataFrame:
    """Rows with the number of their range: how many boundaries lie below the key; a NULL key has none.

    A binary search in an array of the boundaries, for any number and any ordered type of them. Each
    halving is a projection of its own, so a row costs log2(ranges) comparisons in generated code,
    and there is no join and no Python.
    """
    boundaries = ranges if isinstance(ranges, list) else boundaries_of(ranges)
    ends = F.array(*map(F.lit, boundaries)).cast(T.ArrayType(df.schema[key].dataType))
    found, step = df.withColumn(name, F.lit(0)), 1 << len(boundaries).bit_length() >> 1
    while step:
        further = F.col(name) + step
        # Past the last boundary there is nothing to be below the key.
        found = found.withColumn(name, F.when(F.get(ends, further - 1) < F.col(key), further).otherwise(F.col(name)))
        step >>= 1
    return found.withColumn(name, F.when(F.col(key).isNotNull(), F.col(name)))


def range_partitions(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Physical range partitions for parallel work, sorted within; Spark samples the bounds itself."""
    return df.repartitionByRange(partitions, key).sortWithinPartitions(key)


def range_table(spark: SparkSession, boundaries: list, key_type: T.DataType) -> DataFrame:
    """A range table from known boundaries."""
    schema = T.StructType([T.StructField("range_id", T.IntegerType()), T.StructField("end_key", key_type)])
    closed = spark.createDataFrame(list(enumerate(boundaries)), schema)
    return _with_open_end(closed, key_type)

"""Each row's place within its group, for groups of any size.

A sort by range spreads one large group over many tasks; what every task must know of those before
it is one number. Window functions would bring a group to one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pointferry.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """A table written to the shared scratch folder and read from there."""
    folder = scratch_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def changes(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Which rows differ from the row before them in one of the columns; the first does not count."""
    found = np.zeros(batch.num_rows, bool)
    for c in columns:
        codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        found[1:] |= codes[1:] != codes[:-1]
    return found


def ranked(df: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """The table with ``rank``: the row's place from 0 among its group's rows, in the given order, nulls first.

    Rows that are equal in all these columns take neighbouring places in no particular order. The
    result is written once to the scratch folder, so ranks stay the same when an executor is lost.
    One row for each of the sort's partitions comes to the driver.
    """
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.LongType()) for c in ("_part", "_row", "_place"))])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, last, count = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = lambda i: tuple(batch.column(c)[i].as_py() for c in group)
            starts = np.flatnonzero(changes(batch, group))
            begin = np.zeros(n, np.int64)
            begin[starts] = starts
            place = np.arange(n) - np.maximum.accumulate(begin)
            if row and key(0) == last:
                place[: starts[0] if len(starts) else n] += count
            last, count = key(n - 1), int(place[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(n, part)), pa.array(np.arange(row, row + n)), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())
            row += n

    placed = stored(in_order.mapInArrow(places, schema), label)
    key = F.struct(*group) if group else F.struct(F.lit(0))
    ends = placed.groupBy("_part").agg(
        F.min_by(key, "_row").alias("first"), F.max_by(key, "_row").alias("last"), (F.max_by("_place", "_row") + 1).alias("n")
    )
    carried, before, count = [], None, 0
    for r in sorted(ends.collect(), key=lambda r: r["_part"]):
        carry = count if r["first"] == before else 0
        if carry:
            carried.append((r["_part"], carry))
        before, count = r["last"], r["n"] + (carry if r["first"] == r["last"] else 0)
    if not carried:
        return placed.withColumnRenamed("_place", "rank").drop("_part", "_row")
    # At most one row for each partition of the sort; it counts for the partition's first group only.
    carries = placed.sparkSession.createDataFrame(carried, "_part long, _carry long")
    firsts = ends.select("_part", F.col("first").alias("_first"))
    carries = F.broadcast(carries.join(firsts, "_part"))
    rank = F.col("_place") + F.when(_same(key, F.col("_first"), group), F.col("_carry")).otherwise(0)
    return placed.join(carries, "_part", "left").withColumn("rank", rank).select(*df.columns, "rank")


def _same(key: Column, other: Column, group: list[str]) -> Column:
    """Equal in all group columns, nulls included; false where there is no other."""
    same = other.isNotNull()
    for c in group:
        same = same & key[c].eqNullSafe(other[c])
    return same

"""Scans: pages, ranges, projections, pruning, counts.

Everything here is a declarative filter, sort or limit, so bounds, partition values and column
lists reach the Parquet or JDBC scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pointferry.functions.ids import id_order_key
from pointferry.operators.sizing import broadcast_if_small, matching


def project(df: DataFrame, columns: list[str] | None, key: str) -> DataFrame:
    """A column subset that must contain the key; none given means all columns."""
    if not columns:
        return df
    if key not in columns:
        raise ValueError(f"the column list must contain the key column {key!r}")
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    return df.select(*dict.fromkeys(columns))


def keyset_page(df: DataFrame, key: str, after: object | None, limit: int, inclusive: bool = False) -> DataFrame:
    """The next page in key order after a key; ``inclusive`` starts at the key itself."""
    if limit < 1:
        raise ValueError(f"a page holds one row at least, not {limit}")
    if after is not None:
        df = df.filter(F.col(key) >= F.lit(after) if inclusive else F.col(key) > F.lit(after))
    return df.orderBy(key).limit(limit)


def offset_page(df: DataFrame, key: str, offset: int, limit: int) -> DataFrame:
    """A page by position. It re-reads what it skips; key ranges are the way to read it all."""
    if limit < 1:
        raise ValueError(f"a page holds one row at least, not {limit}")
    return df.orderBy(key).offset(offset).limit(limit)


def prune(df: DataFrame, **values: object) -> DataFrame:
    """Keep named partitions, a namespace, a tenant: equality or membership per column."""
    conditions = [
        F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == v
        for c, v in values.items()
        if v is not None
    ]
    return reduce(lambda d, c: d.filter(c), conditions, df)


def in_range(key: Column, start: object | None, end: object | None, include_start: bool = False) -> Column:
    """``start < key <= end``, either side open."""
    condition = F.lit(True)
    if start is not None:
        condition = (key >= F.lit(start)) if include_start else (key > F.lit(start))
    if end is not None:
        below = key <= F.lit(end)
        condition = below if start is None else condition & below
    return condition


def range_scan(df: DataFrame, key: str, start: object | None, end: object | None) -> DataFrame:
    """The rows of one key range ``(start, end]``."""
    return df.filter(in_range(F.col(key), start, end))


def closed_range_scan(df: DataFrame, key: str, start: object | None, end: object | None) -> DataFrame:
    """The rows from a start to an end, both included."""
    return df.filter(in_range(F.col(key), start, end, include_start=True))


def point_order(points: DataFrame) -> DataFrame:
    """Points with one text column whose plain order is the point-id order."""
    return points.withColumn("order_key", id_order_key(F.col("id")))


def exact_count(df: DataFrame, by: list[str] | None = None, name: str = "n_rows") -> DataFrame:
    """Row count, in total or per group."""
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias(name))


def list_then_fetch(ids: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """The records of a list of ids, each once; an id without a record is skipped.

    Repeats in the list are dropped first. What is left is measured: when it is small the records
    are not shuffled, else only those are that a bitmap of the ids lets through.
    """
    return matching(records, ids, key, "listed-ids")


def split_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that a range copy can take, and rows it cannot, with the reason.

    A range copy needs a key that is never NULL and names one row. The counts are taken on the key
    column alone, combined before the shuffle, so a key held by very many rows costs no more than
    others. The repeated keys are measured: normally they are few, and then the rows themselves are
    not shuffled to find them.
    """
    present = df.filter(F.col(key).isNotNull())
    counts = present.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    repeated = broadcast_if_small(counts.filter("_n > 1").select(key), "repeated-keys")
    good = present.join(repeated, key, "left_anti")
    without = df.filter(F.col(key).isNull()).withColumn("reject_reason", F.lit("key is NULL"))
    twice = present.join(repeated, key, "left_semi").withColumn("reject_reason", F.lit("key is not unique"))
    return good, without.unionByName(twice)

"""Checks of a target against its source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pointferry.model import shard_text
from pointferry.operators.sizing import stored


def count_reconciliation(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts per shard on both sides, and whether they agree."""

    def per_shard(points: DataFrame, side: int) -> DataFrame:
        return points.select(shard_text(F.col("shard_key")).alias("shard"), F.lit(side).alias("side"))

    both = per_shard(source, 0).unionByName(per_shard(target, 1))
    counts = both.groupBy("shard").agg(
        F.sum(F.when(F.col("side") == 0, 1).otherwise(0)).alias("source_count"),
        F.sum(F.when(F.col("side") == 1, 1).otherwise(0)).alias("target_count"),
    )
    return counts.withColumn("matches", F.col("source_count") == F.col("target_count"))


def canonical_vectors(vectors: Column) -> Column:
    """A named-vector map as a sorted array, which unlike a map can be compared."""
    return F.array_sort(F.map_entries(vectors))


# Groups of ids whose sums are compared before any point is.
DIGEST_BUCKETS = 1 << 16


def _content(points: DataFrame) -> list[Column]:
    """What makes two points with one id the same."""
    return [F.to_json("payload"), F.schema_of_variant("payload"), canonical_vectors(F.col("vectors")), F.col("shard_key")]


def bucket_sums(points: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """For each bucket of ids the number of its points and sums of the halves of two hashes of id and content.

    Sums do not depend on order and are combined before the shuffle, so a task sends a row for each
    bucket at most, whatever its points weigh.
    """
    content = _content(points)
    hashed = points.select(
        F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket"), F.xxhash64("id", *content).alias("h1"), F.xxhash64(F.lit("second"), "id", *content).alias("h2")
    )
    halves = [F.sum(part(h)).alias(f"{h}_{name}") for h in ("h1", "h2") for name, part in (("low", lambda h: F.col(h).bitwiseAND(F.lit(0xFFFFFFFF))), ("high", lambda h: F.shiftright(h, 32)))]
    return hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *halves)


def unequal_buckets(expected: DataFrame, actual: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """The buckets of ids in which the sides differ, at most ``buckets`` rows."""
    mine, theirs = bucket_sums(expected, buckets), bucket_sums(actual, buckets)
    sums = [c for c in mine.columns if c != "bucket"]
    other = theirs.select("bucket", *[F.col(c).alias(f"_{c}") for c in sums])
    same = F.lit(True)
    for c in sums:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return mine.join(other, "bucket", "full_outer").filter(~same).select("bucket")


def differences(expected: DataFrame, actual: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """As compare_points, but only the ids that are not the same, found by descending into unequal buckets.

    Both sides are first reduced to sums per bucket. Only points of buckets that differ are compared
    one by one, so of equal tables nothing but sums is shuffled, and a few differences cost a few
    buckets. An id's points are all in one bucket.
    """
    unequal = F.broadcast(stored(unequal_buckets(expected, actual, buckets), "unequal-buckets"))
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets))
    within = lambda points: points.withColumn("bucket", bucket).join(unequal, "bucket", "left_semi").drop("bucket")
    return compare_points(within(expected), within(actual)).filter("status <> 'same'")


def compare_points(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Every id of either side with ``same``, ``changed``, ``missing`` or ``extra``.

    Content is reduced to hashes before the join, so only ids and two numbers per point are
    shuffled, not payloads and vectors. Two 64-bit hashes with different seeds stand for the
    content. Payloads are compared in their canonical JSON form together with the kinds of their
    fields, vectors in name order. An id that a side holds more than once is one row: it is the same
    when both sides hold the same contents as often.
    """

    def digest(points: DataFrame, prefix: str) -> DataFrame:
        content = _content(points)
        hashed = points.select("id", F.xxhash64(*content).alias("h1"), F.xxhash64(F.lit("second"), *content).alias("h2"))
        # Sums of whole numbers tell sets with repeats apart and are combined before the shuffle.
        wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
        return hashed.groupBy("id").agg(F.count(F.lit(1)).alias(f"{prefix}_n"), wide("h1").alias(f"{prefix}_h1"), wide("h2").alias(f"{prefix}_h2"))

    joined = digest(expected, "e").join(digest(actual, "a"), "id", "full_outer")
    status = (
        F.when(F.col("a_h1").isNull(), F.lit("missing"))
        .when(F.col("e_h1").isNull(), F.lit("extra"))
        .when((F.col("e_n") == F.col("a_n")) & (F.col("e_h1") == F.col("a_h1")) & (F.col("e_h2") == F.col("a_h2")), F.lit("same"))
        .otherwise(F.lit("changed"))
    )
    return joined.select("id", status.alias("status"))


def sparse_equal(
    indices_a: Column, values_a: Column, indices_b: Column, values_b: Column, tolerance: float = 1e-2
) -> Column:
    """Whether two sparse vectors agree by position, in any order, within a relative error."""
    a = F.map_from_arrays(indices_a, values_a)
    b = F.map_from_arrays(indices_b, values_b)

    def close(k: Column) -> Column:
        x, y = F.try_element_at(a, k).cast("double"), F.try_element_at(b, k).cast("double")
        return F.abs(x - y) <= F.lit(tolerance) * F.greatest(F.abs(x), F.abs(y))

    same_positions = F.array_sort(indices_a) == F.array_sort(indices_b)
    return same_positions & F.forall(indices_a, lambda k: F.coalesce(close(k), F.lit(False)))


def is_vector_field(vectors: Column, field: str) -> Column:
    """Whether a point carries a field as a vector."""
    return F.map_contains_key(vectors, field)

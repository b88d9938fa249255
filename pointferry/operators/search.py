"""Exact nearest points with a payload filter, and the text lookup that follows.

Every distance is computed, but no pair is ever emitted: a task multiplies its batch of points with
the broadcast query matrix and keeps ``k`` candidates per query, so what is shuffled is at most
``k * queries`` rows per task, however many points there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pointferry.operators.sizing import matching
from pointferry.session import scratch_dir

METRICS = ("cosine", "dot", "euclid", "manhattan")

# Bytes of query vectors handed to every task at once; more queries take more passes over the points.
MAX_QUERY_BYTES = 64 << 20
MERGE_SALTS = 32


def _check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"invalid distance metric {metric!r}; one of {', '.join(METRICS)}")


def distance(a: Column, b: Column, metric: str) -> Column:
    """Distance of two dense vectors in double precision; smaller is nearer for every metric.

    ``dot`` is the negated inner product, ``cosine`` one minus the cosine similarity.
    """
    _check_metric(metric)

    def total(term) -> Column:
        return F.aggregate(
            F.zip_with(a, b, lambda x, y: term(x.cast("double"), y.cast("double"))), F.lit(0.0), lambda s, t: s + t
        )

    if metric == "euclid":
        return F.sqrt(total(lambda x, y: (x - y) * (x - y)))
    if metric == "manhattan":
        return total(lambda x, y: F.abs(x - y))
    inner = total(lambda x, y: x * y)
    if metric == "dot":
        return -inner

    def norm(v: Column) -> Column:
        return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))

    return F.lit(1.0) - inner / (norm(a) * norm(b))


def nearest(points: DataFrame, query: list[float], k: int, metric: str = "cosine") -> DataFrame:
    """The ``k`` nearest points of one query vector: (point_id, vector) in, a top-k plan out."""
    literal = F.array(*[F.lit(float(x)) for x in query]).cast("array<float>")
    there = points.filter(F.col("vector").isNotNull())
    scored = there.select("point_id", distance(F.col("vector"), literal, metric).alias("distance"))
    return scored.orderBy("distance", "point_id").limit(k)


def _distances(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Distances of a block of points to a block of queries, one row per query."""
    if metric == "manhattan":
        return np.abs(queries[:, None, :] - rows[None, :, :]).sum(axis=2)
    if metric == "euclid":
        # By differences: the expanded square would lose digits between near points.
        return np.sqrt(np.square(queries[:, None, :] - rows[None, :, :]).sum(axis=2))
    inner = queries @ rows.T
    if metric == "dot":
        return -inner
    lengths = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1.0 - inner / lengths


def _keep_nearest(ids: np.ndarray, dist: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(dist) > 4 * k:
        # Points tied with the k-th stay in, so the id can decide. NaN sorts last in both steps.
        limit = np.partition(dist, k - 1)[k - 1]
        near = np.flatnonzero((dist <= limit) | np.isnan(limit))
        ids, dist = ids[near], dist[near]
    order = np.lexsort((ids, dist))[:k]
    return ids[order], dist[order]


def _local_topk(query_ids: list[str], matrix: np.ndarray, k: int, metric: str):
    """The per-task part: the k nearest of the task's own points, for every query."""
    n_queries, dim = matrix.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.empty(0, dtype="U1"), np.empty(0)) for _ in range(n_queries)]
        worst = np.full(n_queries, np.inf)
        full = np.zeros(n_queries, dtype=bool)
        # Bounds a block of points * queries, times dimensions where differences are held, to some tens of MB.
        step = max(1, (4 << 20) // max(1, n_queries * (dim if metric in ("euclid", "manhattan") else 1)))
        for batch in batches:
            vectors = batch.column("vector")
            if (np.asarray(vectors.value_lengths()) != dim).any():
                raise ValueError(f"a point's vector has another size than the queries' {dim}")
            ids = np.asarray(batch.column("point_id").to_pylist(), dtype=str)
            rows = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(len(ids), dim)
            for at in range(0, len(ids), step):
                part = _distances(rows[at : at + step], matrix, metric)
                names = ids[at : at + step]
                # A NaN is as far as it gets; compared as such it shuts out nothing nearer.
                near = (np.where(np.isnan(part), np.inf, part) <= worst[:, None]) | ~full[:, None]
                for q in np.flatnonzero(near.any(axis=1)):
                    all_ids = np.concatenate([found[q][0], names[near[q]]])
                    all_dist = np.concatenate([found[q][1], part[q][near[q]]])
                    found[q] = _keep_nearest(all_ids, all_dist, k)
                    full[q] = len(found[q][1]) >= k
                    worst[q] = np.inf if np.isnan(found[q][1][-1]) else found[q][1][-1]
        for q in range(n_queries):
            point_ids, dist = found[q]
            if len(dist):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([query_ids[q]] * len(dist), pa.string()), pa.array(point_ids, pa.string()), pa.array(dist)],
                    ["query_id", "point_id", "distance"],
                )

    return run


def _merge_topk(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest of all tasks' candidates.

    Two steps, the first over salted groups: with very many tasks the candidates of one query
    would otherwise meet in one place.
    """
    order = [F.col("distance"), F.col("point_id")]
    salted = Window.partitionBy("query_id", F.pmod(F.xxhash64("point_id"), F.lit(MERGE_SALTS))).orderBy(*order)
    first = candidates.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= k)
    final = Window.partitionBy("query_id").orderBy(*order)
    return first.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)


def nearest_batch(
    points: DataFrame, queries: DataFrame, k: int, metric: str = "cosine", max_query_bytes: int = MAX_QUERY_BYTES
) -> DataFrame:
    """The ``k`` nearest points of every query.

    ``points`` is (point_id string, vector), already filtered by payload; ``queries`` is
    (query_id string, vector). The size of all queries is measured first. If it is within the
    bound they go to the tasks at once; else they are cut by a hash of their id into slices of about
    half the bound. Each slice takes its own pass, one after the other, and leaves its candidates in
    the shared scratch folder, so the driver holds one slice at a time and nothing is left out.
    """
    _check_metric(metric)
    points = points.select(F.col("point_id").cast("string"), F.col("vector").cast("array<float>")).filter("vector is not null")
    queries = queries.select(F.col("query_id").cast("string"), F.col("vector").cast("array<float>"))
    size = queries.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim"), F.min(F.size("vector")).alias("low")
    ).first()
    out_schema = "query_id string, point_id string, distance double"
    if size["n"] == 0:
        return points.filter(F.lit(False)).select(F.lit("").alias("query_id"), "point_id", F.lit(0.0).alias("distance"), F.lit(0).alias("rank"))
    if size["dim"] != size["low"]:
        raise ValueError("the query vectors differ in size")
    slices = -(-size["n"] * size["dim"] * 8 // max_query_bytes)
    slices = slices if slices == 1 else slices * 2
    folder = scratch_dir(points.sparkSession, "candidates")
    for number in range(slices):
        chosen = queries if slices == 1 else queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(slices)) == number)
        table = chosen.toArrow()
        if table.num_rows == 0:
            continue
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix = flat.astype("<f8").reshape(table.num_rows, size["dim"])
        found = points.mapInArrow(_local_topk(table.column("query_id").to_pylist(), matrix, k, metric), out_schema)
        if slices == 1:
            return _merge_topk(found, k)
        found.write.mode("append").parquet(folder)
    return _merge_topk(points.sparkSession.read.schema(out_schema).parquet(folder), k)


def lookup_text(found: DataFrame, texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The text of every found id, or the empty text where there is none.

    The ids are measured; when they are few the texts are not shuffled to find theirs, else only
    those that may be wanted.
    """
    there = matching(texts.select(key, text), found, key, "found-ids")
    return found.join(there, key, "left").withColumn(text, F.coalesce(F.col(text), F.lit("")))

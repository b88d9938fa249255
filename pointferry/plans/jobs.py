"""Whole copies: plan, write, keep progress, verify, clean up."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from pointferry.operators.ranges import assign_ranges, boundary_sample, ranges_per_key, ranges_per_worker
from pointferry.operators.scan import in_range
from pointferry.sinks.point_table import PointTable
from pointferry.streaming.progress import ProgressStore, resume_ranges


# Steps of a copy where the caller does not say, the rows that make a further one worth while, and
# the ranges whose counts one job can keep.
DEFAULT_STEPS, STEP_ROWS, OBSERVED_RANGES = 8, 500_000, 128


@dataclass
class CopyReport:
    """Rows of the source, rows that the run's commits hold, points of the whole table, and the steps taken."""

    source_count: int
    target_count: int
    steps: int
    written: int

    @property
    def complete(self) -> bool:
        """Every row of the source is in a commit of this run; what else the table holds does not count."""
        return self.written >= self.source_count


def copy_all(raw: DataFrame, normalizer: Callable[[DataFrame], DataFrame], table: PointTable, source: str, run: int) -> CopyReport:
    """One pass over a staged export.

    ``run`` is the caller's number of this run: the same number again is a repeat, which writes
    nothing; an export that has grown is copied under a new number.
    """
    folder = table.append(normalizer(raw), writer=source, batch=run)
    # The source is counted, not the commit: after a repeat of an old run the two differ.
    return CopyReport(raw.count(), table.count(), 1, table.count_commit(folder))


def copy_ranges(
    raw: DataFrame,
    key: str,
    normalizer: Callable[[DataFrame], DataFrame],
    table: PointTable,
    progress: ProgressStore,
    plans_folder: str,
    source: str,
    workers: int,
    ranges_per_step: int | None = None,
    per_sampled_key: bool = False,
    restart: bool = False,
    cleanup: bool = True,
) -> CopyReport:
    """A resumable copy in steps of whole key ranges.

    The ranges are written down before the first step and read back on resume. Each step is one
    distributed job over its ranges; when it is through, every range of it stores its own offset
    and count. The key must be unique and never NULL, see split_keys().

    A step reads its rows once: what it covers is counted as it is written, by range, and the commit
    is named after those counts. They, and no earlier ones, are stored, so a source that grows
    meanwhile, or between runs, is neither skipped nor counted unwritten. A step that runs twice over
    the same rows finds its commit there. A range without an end that is empty so far stores nothing.

    A step reads what its outer bounds do not prune, which is little where the export is sorted or
    indexed by the key. The default is up to ``DEFAULT_STEPS`` steps of ``STEP_ROWS`` rows at least; for
    an unsorted export take one. A step has ``OBSERVED_RANGES`` ranges at most.
    """
    spark: SparkSession = raw.sparkSession
    plan_name = f"{source}-workers-{workers}-plan"
    if restart:
        progress.delete(source)
    stored = progress.start_offsets().filter(F.col("name") == plan_name).first()
    if stored is None:
        run_id = uuid.uuid4().hex[:12]
        sample = boundary_sample(raw, key, workers)
        planned = ranges_per_key(sample, key) if per_sampled_key else ranges_per_worker(sample, key, workers)
        planned.coalesce(1).write.parquet(_plan_folder(plans_folder, source, run_id))
    else:
        run_id = stored["offset"]
    ranges = spark.read.parquet(_plan_folder(plans_folder, source, run_id))
    # A row for each range, few whatever the source holds; records of an earlier run are of its ranges.
    known = resume_ranges(ranges, progress.records(), source, workers).orderBy("range_id").collect()
    if stored is None:
        progress.store_one(plan_name, run_id, len(known))
    boundaries = [r["end_key"] for r in known if r["end_key"] is not None]
    pending = [r for r in known if not r["done"]]
    rows_in_all = raw.count()
    per_step = ranges_per_step or max(1, -(-len(pending) // max(1, min(DEFAULT_STEPS, rows_in_all // STEP_ROWS))))
    per_step = min(per_step, OBSERVED_RANGES)
    steps = [pending[i : i + per_step] for i in range(0, len(pending), per_step)]
    written = sum(r["done_count"] for r in known)
    for step in steps:
        seen, points = _copy_step(_step_rows(raw, key, boundaries, step), key, step, normalizer, table, f"{source}-{run_id}")
        written += points
        progress.store(_range_offsets(spark, step, seen))
    report = CopyReport(rows_in_all, table.count(), len(steps), written)
    if cleanup:
        progress.delete(source)
    return report


def _copy_step(
    rows: DataFrame, key: str, step: list[Row], normalizer: Callable[[DataFrame], DataFrame], table: PointTable, writer: str
) -> tuple[dict[int, tuple], int]:
    """Write a step's rows in one pass; returns last key and count of each range that has rows, and the points written.

    A closed range is through up to its end, so only the open range's last key is looked for.
    """
    of_range = F.col("range_id")
    counts = {r["range_id"]: F.count_if(of_range == r["range_id"]).alias(f"n{r['range_id']}") for r in step}
    last_key = F.max(F.when(of_range == step[-1]["range_id"], F.col(key))).alias("last_key")
    read, wrote = Observation(), Observation()
    points = normalizer(rows.observe(read, *counts.values(), last_key).drop("range_id"))
    folder = table.stage(points.observe(wrote, F.count(F.lit(1)).alias("n")))
    found = read.get
    ends = {r["range_id"]: r["end_key"] if r["end_key"] is not None else found["last_key"] for r in step}
    seen = {i: (ends[i], found[f"n{i}"]) for i in counts if found[f"n{i}"]}
    if not seen:
        table.discard(folder)
        return {}, 0
    # Names exactly what the step covers, so only a repeat of the very same step is skipped.
    covers = hashlib.sha256(repr([(r["range_id"], r["start_key"], seen.get(r["range_id"])) for r in step]).encode()).hexdigest()[:16]
    table.commit(folder, f"{writer}-{covers}")
    return seen, wrote.get["n"]


def _plan_folder(plans_folder: str, source: str, run_id: str) -> str:
    return f"{plans_folder.rstrip('/')}/{quote(source, safe='')}-{run_id}"


def _step_rows(raw: DataFrame, key: str, boundaries: list, step: list[Row]) -> DataFrame:
    """The rows of a step's ranges: outer bounds reach the scan, the rest is checked per row."""
    outer = raw.filter(in_range(F.col(key), step[0]["start_key"], step[-1]["end_key"]))
    rows = assign_ranges(outer, key, boundaries)
    ids = [r["range_id"] for r in step]
    if ids != list(range(ids[0], ids[-1] + 1)):
        rows = rows.filter(F.col("range_id").isin(ids))
    # A range resumed part-way starts after its stored offset.
    for r in step[1:]:
        if r["done_count"]:
            rows = rows.filter((F.col("range_id") != r["range_id"]) | (F.col(key) > F.lit(r["start_key"])))
    return rows


def _range_offsets(spark: SparkSession, step: list[Row], seen: dict[int, tuple]) -> DataFrame:
    """Progress records of a step: the end or last key of each range, and its count so far."""
    rows = []
    for r in step:
        last, n = seen.get(r["range_id"], (None, 0))
        # A closed range is through up to its end, also where its last rows lie before it.
        offset = r["end_key"] if r["end_key"] is not None else last
        rows.append((r["name"], None if offset is None else str(offset), r["done_count"] + n))
    covered = spark.createDataFrame(rows, "name string, offset_text string, offset_count bigint")
    return covered.select("name", F.lit(None).cast("decimal(20,0)").alias("offset_num"), "offset_text", "offset_count")

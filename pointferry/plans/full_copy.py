"""A whole copy in one call: plan, create, set aside what does not fit, copy, reconcile."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pointferry.model import shard_text
from pointferry.operators.sizing import stored
from pointferry.plans.catalog import copy_collection, create_if_absent, facts_of_points, missing_indexes, vector_problems
from pointferry.plans.jobs import CopyReport, copy_all, copy_ranges
from pointferry.sinks.ledger import CommitLedger, StaleState
from pointferry.sinks.point_table import PointTable
from pointferry.streaming.progress import ProgressStore

FIELDS = "collection string, field string, kind string, size bigint, distance string"
SHARDS = "collection string, keyword string, number decimal(20,0)"
INDEXES = "collection string, field string, type string, params string"
TABLES = {"fields": FIELDS, "shards": SHARDS, "indexes": INDEXES}


@dataclass
class CatalogVersion:
    """The catalog as of one version; what others add later is not in it."""

    spark: SparkSession
    ledger: CommitLedger
    number: int

    def _read(self, name: str) -> DataFrame:
        if not self.number:
            return self.spark.createDataFrame([], TABLES[name])
        folders = [f"{self.ledger.folder(n)}/{name}" for n in range(1, self.number + 1)]
        return self.spark.read.schema(TABLES[name]).parquet(*folders)

    def fields(self) -> DataFrame:
        return self._read("fields")

    def shard_keys(self, collection: str) -> DataFrame:
        return self._read("shards").filter(F.col("collection") == collection).select("keyword", "number")

    def indexes(self, collection: str) -> DataFrame:
        return self._read("indexes").filter(F.col("collection") == collection).select("field", "type", "params")


class CatalogStore:
    """Collections' vector fields, registered shard keys and payload indexes, in versions.

    A version adds rows to all three at once and becomes visible in one step. It is made from the
    version before it: where another job came first, the additions are worked out again from what
    that job left, so nothing is registered twice.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.ledger = spark, CommitLedger(spark, path)

    def latest(self) -> CatalogVersion:
        return CatalogVersion(self.spark, self.ledger, self.ledger.load().last)

    def fields(self) -> DataFrame:
        return self.latest().fields()

    def shard_keys(self, collection: str) -> DataFrame:
        return self.latest().shard_keys(collection)

    def indexes(self, collection: str) -> DataFrame:
        return self.latest().indexes(collection)

    def update(self, plan: Callable[[CatalogVersion], dict[str, DataFrame]]) -> dict[str, int]:
        """Add what ``plan`` makes of the latest version; returns the rows added to each table. Nothing to add makes no version."""
        while True:
            version, folder = self.latest(), self.ledger.new_folder()
            added = plan(version)
            for name, schema in TABLES.items():
                rows = added.get(name, self.spark.createDataFrame([], schema))
                rows.select(*self.spark.createDataFrame([], schema).columns).coalesce(1).write.parquet(f"{folder}/{name}")
            counts = {name: self.spark.read.schema(schema).parquet(f"{folder}/{name}").count() for name, schema in TABLES.items()}
            if not any(counts.values()):
                self.ledger.fs().delete(self.ledger.at(folder[len(self.ledger.path) + 1 :]), True)
                return counts
            try:
                self.ledger.claim(folder, f"version-{uuid.uuid4().hex}", 0, expected=version.number + 1)
                return counts
            except StaleState:
                continue


@dataclass
class ByRanges:
    """A resumable copy by key ranges: the key, where progress and plans are kept, and how many ranges at a time."""

    key: str
    progress: ProgressStore
    plans_folder: str
    workers: int
    ranges_per_step: int | None = None
    restart: bool = False
    cleanup: bool = True


@dataclass
class FullReport:
    """``rejected`` points were set aside for ``wrong_sizes`` vectors that the target does not take; shards are counted on both sides."""

    created_fields: int
    created_shards: int
    created_indexes: int
    copy: CopyReport
    rejected: int
    wrong_sizes: int
    shards: DataFrame

    @property
    def complete(self) -> bool:
        """Every row of the source is in the table, and every shard of the source has points there."""
        absent = self.shards.filter((F.col("source_count") > 0) & (F.col("target_count") == 0))
        return self.copy.complete and not self.rejected and absent.isEmpty()


def full_copy(
    raw: DataFrame,
    normalizer: Callable[[DataFrame], DataFrame],
    collection: str,
    table: PointTable,
    catalog: CatalogStore,
    source: str,
    run: int,
    distances: dict[str, str] | None = None,
    default_distance: str = "cosine",
    *,
    sizes: dict[str, int] | None = None,
    source_fields: DataFrame | None = None,
    source_indexes: DataFrame | None = None,
    rejects: str | None = None,
    by_ranges: ByRanges | None = None,
) -> FullReport:
    """Plan the collection, create what is absent, copy what fits and reconcile.

    The collection's fields are those of ``source_fields`` (the source's own catalog rows of one
    collection), else those found in the data, with the sizes given or found and the metrics named in
    ``distances``. Fields, new shard keys and those of ``source_indexes`` (field, type, params) that the
    target lacks become one version of the catalog. A point with a vector whose field, kind or size
    the catalog does not have is not written; such points go to the folder ``rejects``, if named, with their
    ``problems``. With ``by_ranges`` a copy that stopped goes on where it was; else it is one pass under
    the number ``run``. A second call creates and writes nothing.

    The source is read once to plan and to count shards, and once to copy; again only to set points
    aside, if some do not fit.
    """
    facts = stored(facts_of_points(normalizer(raw)), "facts")
    created = catalog.update(lambda version: _additions(version, collection, facts, distances, default_distance, sizes, source_fields, source_indexes))
    declared = catalog.fields().filter(F.col("collection") == collection).collect()  # one row for each vector field
    problems = vector_problems(F.col("vectors"), {r["field"]: (r["kind"], r["size"]) for r in declared})
    fitting = lambda df: normalizer(df).filter(F.size(problems) == 0)
    if by_ranges is None:
        report = copy_all(raw, fitting, table, source, run)
    else:
        r = by_ranges
        report = copy_ranges(
            raw, r.key, fitting, table, r.progress, r.plans_folder, source, r.workers, ranges_per_step=r.ranges_per_step, restart=r.restart, cleanup=r.cleanup
        )
    rejected, wrong = (0, 0) if report.complete else _set_aside(normalizer(raw), problems, rejects)
    return FullReport(created["fields"], created["shards"], created["indexes"], report, rejected, wrong, _shard_counts(facts, table))


def _additions(
    version: CatalogVersion,
    collection: str,
    facts: DataFrame,
    distances: dict[str, str] | None,
    default_distance: str,
    sizes: dict[str, int] | None,
    source_fields: DataFrame | None,
    source_indexes: DataFrame | None,
) -> dict[str, DataFrame]:
    """What a version of the catalog lacks of a collection."""
    name = F.lit(collection)
    if source_fields is None:
        planned = _fields_found(facts, distances, default_distance, sizes).withColumn("collection", name)
        fields = create_if_absent(planned, version.fields())
    else:
        # The source's rows under a name that no collection has, so that only the target's can be in the way.
        theirs = source_fields.withColumn("collection", F.lit("\0source"))
        fields = copy_collection(version.fields().unionByName(theirs.select(*version.fields().columns)), "\0source", collection)
    keys = facts.filter("field IS NULL AND (keyword IS NOT NULL OR number IS NOT NULL)").select("keyword", "number")
    known = version.shard_keys(collection).select(F.col("keyword").alias("_k"), F.col("number").alias("_n"))
    same = F.col("keyword").eqNullSafe(F.col("_k")) & F.col("number").eqNullSafe(F.col("_n"))
    added = {"fields": fields, "shards": keys.join(known, same, "left_anti").withColumn("collection", name)}
    if source_indexes is not None:
        added["indexes"] = missing_indexes(source_indexes, version.indexes(collection)).withColumn("collection", name)
    return added


def _fields_found(facts: DataFrame, distances: dict[str, str] | None, default_distance: str, sizes: dict[str, int] | None) -> DataFrame:
    """The vector fields of the data. One without a single size can't be created: give its size, and the others are set aside."""
    lookup = lambda named, kind: F.create_map(*[F.lit(x) for pair in named.items() for x in pair]) if named else F.lit(None).cast(f"map<string,{kind}>")
    dense = F.col("kind") == "dense"
    found = F.when(F.col("low") == F.col("high"), F.col("high"))
    size = F.coalesce(F.try_element_at(lookup(sizes, "bigint"), F.col("field")).cast("bigint"), found)
    message = F.concat(F.lit("vectors of several sizes in field "), F.col("field"))
    size = F.coalesce(size, F.raise_error(message).cast("bigint"))
    metric = F.coalesce(F.try_element_at(lookup(distances, "string"), F.col("field")), F.lit(default_distance))
    fields = facts.filter("field IS NOT NULL")
    return fields.select("field", "kind", F.when(dense, size).alias("size"), F.when(dense, metric).alias("distance"))


def _set_aside(points: DataFrame, problems: Column, folder: str | None) -> tuple[int, int]:
    """Points with vectors that do not fit, written with their problems; returns the points and the vectors."""
    bad = points.withColumn("problems", problems).filter(F.size("problems") > 0)
    if folder is not None:
        bad.write.mode("overwrite").parquet(folder)
        bad = points.sparkSession.read.schema(bad.schema).parquet(folder)
    found = bad.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("problems")).alias("vectors")).first()
    return found["n"], found["vectors"] or 0


def _shard_counts(facts: DataFrame, table: PointTable) -> DataFrame:
    """Rows of the source, as counted with its facts, and points of the table per shard."""
    shard = shard_text(F.struct("keyword", "number"))
    ours = facts.filter("field IS NULL").select(shard.alias("shard"), F.col("n").alias("source_count"))
    theirs = table.read().groupBy(shard_text(F.col("shard_key")).alias("shard")).agg(F.count(F.lit(1)).alias("target_count"))
    both = ours.join(theirs, "shard", "full_outer")
    counts = both.select("shard", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("source_count", "target_count")])
    return counts.withColumn("matches", F.col("source_count") == F.col("target_count"))

"""A point table on Parquet folders: appended commits over a base in hash buckets.

Layout below the table folder::

    commits/commit-<n>/                  the points of one batch as written, see ledger.py
    base/upto=<n>/shard=<shard>/         one point per id, of all commits up to n, in buckets of the id

A batch only ever adds a commit: an upsert costs what the batch weighs and never rewrites the table.
Reading puts the last write per id of newer commits over the base; ``compact`` does that once and
for all. The base lies in hash buckets of the id, so newer writes are dealt into its buckets and
joined there; the base is never shuffled, however much is newer. A batch is found again by its writer
and number, so repeating it changes nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pointferry.model import POINT_COLUMNS, POINT_SCHEMA
from pointferry.operators.upsert import last_writes, replace_ids, route_to_shards
from pointferry.sinks.ledger import MARKER, CommitLedger

_WRITE_ORDER = ["commit_seq", "source_ord", "_file", "_row"]
_BASE_NAME = re.compile(r"^upto=(\d+)$")
_COMMIT_NAME = re.compile(r"^commit-(\d+)$")
_BASE_SCHEMA = T.StructType(POINT_SCHEMA.fields + [T.StructField("shard", T.StringType())])

# Buckets also where no join asks for them: a task that holds one writes one file for each shard.
_COMPACTING = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}


class PointTable:
    """Appending, reading and compacting one point table.

    ``buckets`` is the number of hash buckets of the base; a bucket is read by one task, so take the
    table's bytes over some 256 MB. A base keeps its number until another one is asked for; the first
    takes the session's number of shuffle partitions by default.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.ledger = CommitLedger(spark, self.path)

    def _state(self) -> tuple[int, int]:
        """The newest base's commit (0 is none) and the newest commit."""
        return self._newest_base(), self.ledger.load().last

    def _newest_base(self) -> int:
        fs = self.ledger.fs()
        found = fs.globStatus(self.ledger.at(f"base/*/{MARKER}"))
        names = [_BASE_NAME.match(s.getPath().getParent().getName()) for s in found or []]
        return max((int(m.group(1)) for m in names if m), default=0)

    def append(self, points: DataFrame, writer: str, batch: int = 0) -> str:
        """Write one batch and return its folder; a batch that is in the table already is not written again.

        A point without an id fails the job: it could be neither replaced nor found.
        """
        held = self.ledger.load().find(writer, batch)
        if held is not None:
            return self.ledger.folder(held)
        return self.commit(self.stage(points), writer, batch)

    def stage(self, points: DataFrame) -> str:
        """Write points to a folder of the table that is no commit yet."""
        folder = self.ledger.new_folder()
        id_ = F.col("id")
        missing = id_.isNull() | (id_["num"].isNull() & id_["uuid"].isNull())
        present = F.when(missing, F.raise_error(F.lit("a point of this batch has no id")).cast(points.schema["id"].dataType)).otherwise(id_)
        points.withColumn("id", present).select(*POINT_COLUMNS).write.parquet(folder)
        return folder

    def commit(self, folder: str, writer: str, batch: int = 0) -> str:
        """Make a staged folder the table's next commit, unless the batch is there already."""
        return self.ledger.claim(folder, writer, batch)

    def discard(self, folder: str) -> None:
        """Drop a staged folder that is to be no commit."""
        self.ledger.fs().delete(self.ledger.at(folder[len(self.path) + 1 :]), True)

    def count(self) -> int:
        """The number of points; only ids are read of what is not compacted."""
        upto, last = self._state()
        if not last or upto == last:
            return self.read().count()
        ids = self._log(upto + 1, last).select("id").distinct()
        return ids.count() if not upto else self._plain_base(upto).select("id").unionByName(ids).distinct().count()

    def count_commit(self, folder: str) -> int:
        """Rows written by one commit, from the files' footers."""
        return self.spark.read.schema(POINT_SCHEMA).parquet(folder).count()

    def _base_folder(self, upto: int) -> str:
        return f"{self.path}/base/upto={upto}"

    def _plain_base(self, upto: int) -> DataFrame:
        return self.spark.read.schema(_BASE_SCHEMA).parquet(self._base_folder(upto))

    def _base_buckets(self, upto: int) -> int | None:
        return (self.ledger.read_json(f"base/upto={upto}/{MARKER}") or {}).get("buckets")

    def _bucketed_base(self, upto: int, buckets: int) -> DataFrame:
        """The base as a relation that knows its buckets. Only a table has them, so one is named for a moment."""
        name = f"pointferry_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _BASE_SCHEMA.fields)
        # Its partitions are found in the folder, not in the catalog, which the name leaves again.
        with _settings(self.spark, {"spark.sql.hive.manageFilesourcePartitions": "false"}):
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (shard) CLUSTERED BY (id) INTO {buckets} BUCKETS LOCATION '{_quoted(self._base_folder(upto))}'"
            )
            try:
                return self.spark.table(name)
            finally:
                self.spark.sql(f"DROP TABLE {name}")

    def _log(self, first: int, last: int) -> DataFrame:
        """All writes of some commits, with each one's commit, file and row."""
        # One relation over all commit folders, so the plan does not grow with their number.
        folders = [self.ledger.folder(n) for n in range(first, last + 1)]
        log = self.spark.read.schema(POINT_SCHEMA).parquet(*folders)
        meta = F.col("_metadata")
        number = F.regexp_extract(meta["file_path"], r"/commit-(\d+)/", 1).cast("bigint")
        return log.select(*POINT_COLUMNS, number.alias("commit_seq"), meta["file_name"].alias("_file"), meta["row_index"].alias("_row"))

    def read(self) -> DataFrame:
        """The table: one point per id.

        A compacted table is read as it lies. With newer commits on top, only those are reduced,
        and the base gives up the ids they replace.
        """
        upto, last = self._state()
        if not last:
            return self.spark.createDataFrame([], POINT_SCHEMA)
        if upto == last:
            return self._plain_base(upto).select(*POINT_COLUMNS)
        kept, newer, _ = self._parts(upto, last)
        return newer if kept is None else kept.unionByName(newer)

    def _parts(self, upto: int, last: int) -> tuple[DataFrame | None, DataFrame, int]:
        """What of the base is left, the last writes of newer commits, and the number of buckets."""
        held = self._base_buckets(upto) if upto else None
        buckets = held or self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        newer, ids = last_writes(self._log(upto + 1, last), _WRITE_ORDER, buckets)
        newer = newer.select(*POINT_COLUMNS)
        if not upto:
            return None, newer, buckets
        base = self._bucketed_base(upto, held) if held else self._plain_base(upto)
        return replace_ids(base, ids, buckets).select(*POINT_COLUMNS), newer, buckets

    def read_shard(self, shard: str) -> DataFrame:
        """One shard of a compacted table; other shards' folders are not opened."""
        upto, last = self._state()
        if not upto or upto != last:
            raise ValueError("compact the table before reading one shard")
        return self._plain_base(upto).filter(F.col("shard") == shard).select(*POINT_COLUMNS)

    def compact(self) -> int:
        """Fold all commits into a new base, by shard and bucket. Returns the last commit in it.

        Only newer writes are shuffled; the old base is read bucket by bucket and written as it is read.
        """
        upto, last = self._state()
        if upto == last:
            return upto
        with _settings(self.spark, _COMPACTING):
            kept, newer, held = self._parts(upto, last)
            buckets = self.buckets or held
            points = newer.repartition(buckets, "id")
            if kept is not None:
                points = points.unionByName(kept if buckets == held and self._base_buckets(upto) else kept.repartition(buckets, "id"))
            folder, name = self._base_folder(last), f"pointferry_{uuid.uuid4().hex}"
            self.ledger.fs().delete(self.ledger.at(f"base/upto={last}"), True)  # of a job that did not finish
            try:
                route_to_shards(points).write.partitionBy("shard").bucketBy(buckets, "id").option("path", folder).saveAsTable(name, format="parquet")
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.ledger.write_json(f"base/upto={last}/{MARKER}", {"buckets": buckets})
        return last

    def vacuum(self) -> int:
        """Free what the newest base replaced, the data of commits it holds, and what never became a commit.

        A commit's folder and marker stay, so its batch is still recognised. Not to be run while
        others use the table. Returns the number of paths deleted.
        """
        upto, fs, deleted = self._newest_base(), self.ledger.fs(), 0
        for status in _listed(fs, self.ledger.at("base")):
            m = _BASE_NAME.match(status.getPath().getName())
            if m and int(m.group(1)) < upto:
                deleted += bool(fs.delete(status.getPath(), True))
        for status in _listed(fs, self.ledger.at("commits")):
            m = _COMMIT_NAME.match(status.getPath().getName())
            if not m:
                deleted += bool(fs.delete(status.getPath(), True))
            elif int(m.group(1)) <= upto:
                for data in _listed(fs, status.getPath()):
                    if MARKER not in data.getPath().getName():
                        deleted += bool(fs.delete(data.getPath(), True))
        return deleted


def _listed(fs, path) -> list:
    return list(fs.listStatus(path)) if fs.exists(path) else []


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for as long as a block runs."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

"""A hook for writing points to a store of one's own, as a Spark data source.

Subclass :class:`PointStoreSource`, give ``open_client``, register it with
``spark.dataSource.register`` and write with ``df.write.format(<name>)``. Each task sends its rows
in batches; upserts by id make a repeated task harmless.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

DEFAULT_BATCH_SIZE = 50
WRITE_ATTEMPTS = 3
RETRY_STEP_SECONDS = 0.1


class RetryableError(Exception):
    """Raised by a client for a write worth repeating."""

    retryable = True


class PointClient:
    """What a store has to offer. One client is opened per task."""

    def upsert(self, rows: list[Row]) -> None:
        raise NotImplementedError

    def close(self) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    rows: int


class PointStoreWriter(DataSourceWriter):
    def __init__(self, source: "PointStoreSource"):
        self.source = source
        self.batch_size = int(source.options.get("batchsize", DEFAULT_BATCH_SIZE))
        if self.batch_size < 1:
            raise ValueError(f"a batch takes one row at least, not {self.batch_size}")

    def write(self, iterator: Iterator[Row]) -> Written:
        client = self.source.open_client()
        total, batch = 0, []
        try:
            for row in iterator:
                batch.append(row)
                if len(batch) >= self.batch_size:
                    total += self._send(client, batch)
                    batch = []
            if batch:
                total += self._send(client, batch)
        finally:
            client.close()
        return Written(rows=total)

    @staticmethod
    def _send(client: PointClient, batch: list[Row]) -> int:
        for attempt in range(1, WRITE_ATTEMPTS + 1):
            try:
                client.upsert(batch)
                return len(batch)
            except Exception as error:
                # By attribute, not by class: a class sent along with a job is another object in the task.
                if not getattr(error, "retryable", False) or attempt == WRITE_ATTEMPTS:
                    raise
                time.sleep(attempt * RETRY_STEP_SECONDS)
        return 0

    def commit(self, messages: list[Written]) -> None:
        self.source.finished(sum(m.rows for m in messages if m is not None))

    def abort(self, messages: list[Written]) -> None:
        pass


class PointStoreSource(DataSource):
    """Base of a custom sink. ``options`` holds what was given to the writer, keys in lower case."""

    @classmethod
    def name(cls) -> str:
        return "point_store"

    def open_client(self) -> PointClient:
        raise NotImplementedError

    def finished(self, rows: int) -> None:
        """Called on the driver after all tasks wrote."""

    def schema(self) -> str:
        return "id struct<num:decimal(20,0),uuid:string>, vectors string, payload string, shard string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return PointStoreWriter(self)

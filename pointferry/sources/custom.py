"""A hook for reading a store of one's own in key ranges, as a Spark data source.

Subclass :class:`PagedStoreSource`, register it with ``spark.dataSource.register`` and read it with
``spark.read.format(<name>)``. Every key range is one task, which walks its range page by page; a
task that is run again starts its range over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

DEFAULT_PAGE_SIZE = 50


class PageClient:
    """What a store has to offer. One client is opened per task."""

    def page(self, after: Any | None, end: Any | None, limit: int) -> list[tuple]:
        """The first rows in key order with ``after < key <= end``; None leaves a side open."""
        raise NotImplementedError

    def close(self) -> None:
        pass


@dataclass
class KeyRange(InputPartition):
    start: Any | None
    end: Any | None


class PagedStoreReader(DataSourceReader):
    def __init__(self, source: "PagedStoreSource", schema: StructType):
        self.source = source
        self.key_at = schema.fieldNames().index(source.key)
        self.page_size = int(source.options.get("pagesize", DEFAULT_PAGE_SIZE))
        if self.page_size < 1:
            raise ValueError(f"a page holds one row at least, not {self.page_size}")

    def partitions(self) -> list[KeyRange]:
        ends = self.source.boundaries()
        return [KeyRange(a, b) for a, b in zip([None, *ends], [*ends, None])]

    def read(self, partition: KeyRange) -> Iterator[tuple]:
        client = self.source.open_client()
        try:
            after = partition.start
            while rows := client.page(after, partition.end, self.page_size):
                yield from rows
                after = rows[-1][self.key_at]
        finally:
            client.close()


class PagedStoreSource(DataSource):
    """Base of a custom source. ``options`` holds what was given to the reader, keys in lower case."""

    key = "id"

    @classmethod
    def name(cls) -> str:
        return "paged_store"

    def boundaries(self) -> list:
        """The inner range ends, in order, such as sampled keys; none reads everything in one task."""
        return []

    def open_client(self) -> PageClient:
        raise NotImplementedError

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedStoreReader(self, schema)

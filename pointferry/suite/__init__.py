"""Checkable queries over the driver tables: one entry per operator, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_entries() -> dict[str, tuple[Query, str | None]]:
    from pointferry.suite import planning, progress, scalars, scans, search, sources, verification, writing

    entries: dict[str, tuple[Query, str | None]] = {}
    for module in (sources, scans, scalars, planning, writing, progress, verification, search):
        clash = entries.keys() & module.ENTRIES.keys()
        if clash:
            raise ValueError(f"duplicate query names: {sorted(clash)}")
        entries.update(module.ENTRIES)
    return entries

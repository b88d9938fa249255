"""Resumable copy of an export folder with Structured Streaming.

The stream's checkpoint holds which files were taken; a stopped copy goes on where it was. A batch
goes to the table under the stream's identity and the batch number, so a batch that is repeated
after a failure is recognised there. The identity is the one Spark keeps in the checkpoint folder
itself, so no other folder, whatever its name, is taken for the same stream.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, functions as F

from pointferry.sinks.point_table import PointTable
from pointferry.streaming.progress import ProgressStore


def incremental_copy(
    stream: DataFrame,
    normalizer: Callable[[DataFrame], DataFrame],
    table: PointTable,
    checkpoint: str,
    source: str,
    progress: ProgressStore | None = None,
) -> int:
    """Take everything the stream has now, then stop; returns the number of batches of this run.

    To start over, give a new checkpoint folder and delete the source's progress.
    """
    batches = 0
    started = Event()
    identity: list[str] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal batches
        started.wait()
        folder = table.append(normalizer(batch), writer=f"{source}@{identity[0]}", batch=batch_id)
        if progress is not None:
            _record(progress, source, batch_id, table.count_commit(folder))
        batches += 1

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    identity.append(str(query.id))
    started.set()
    query.awaitTermination()
    return batches


def _record(progress: ProgressStore, source: str, batch_id: int, rows: int) -> None:
    """Add a batch to the source's count, unless its record is there from before a failure."""
    last = progress.start_offsets().filter(F.col("name") == source).first()
    if last is None:
        progress.store_one(source, batch_id, rows)
    elif int(last["offset"]) < batch_id:
        progress.store_one(source, batch_id, last["offset_count"] + rows)

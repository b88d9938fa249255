"""Point-collection exports, which already have the point shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.functions.vectors import clone_vectors
from pointferry.model import SHARD_KEY_TYPE, empty_vectors
from pointferry.sources.base import to_points


def normalize_collection(raw: DataFrame, *, source_ord: str | None = "source_ord", mode: str = "fail") -> DataFrame:
    """Ids, payload and shard keys pass through; vectors are copied value by value."""
    has_shards = "shard_key" in raw.columns
    ord_column = source_ord if source_ord in raw.columns else None
    point_id = F.col("id")
    return to_points(
        raw,
        id_col=point_id,
        vectors=F.coalesce(clone_vectors(F.col("vectors")), empty_vectors()),
        payload=F.col("payload"),
        shard_key=F.col("shard_key").cast(SHARD_KEY_TYPE) if has_shards else None,
        source_ord=ord_column,
        checks=[(point_id["num"].isNull() == point_id["uuid"].isNull(), "id needs exactly one of num and uuid")],
        mode=mode,
    )

"""What all source normalisers share: the closing projection and record checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pointferry.model import ID_TYPE, POINT_COLUMNS, VECTORS_TYPE, no_shard_key

REJECT_COLUMN = "reject_reason"
DEFAULT_ID_FIELD = "__id__"


def to_points(
    df: DataFrame,
    *,
    id_col: Column,
    vectors: Column,
    payload: Column,
    shard_key: Column | None = None,
    source_ord: str | None = None,
    checks: list[tuple[Column, str]] | None = None,
    mode: str = "fail",
) -> DataFrame:
    """Project to the point columns.

    ``checks`` lists (bad condition, reason). In mode ``fail`` a bad record ends the job; in mode
    ``quarantine`` it is kept with its reason in ``reject_reason``, for accepted() and rejected().
    """
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"mode must be 'fail' or 'quarantine', not {mode!r}")
    reason = F.lit(None).cast("string")
    for bad, text in reversed(checks or []):
        reason = F.when(F.coalesce(bad, F.lit(True)), F.lit(text)).otherwise(reason)
    point_id = id_col
    if mode == "fail" and checks:
        point_id = F.when(reason.isNull(), id_col).otherwise(F.raise_error(reason).cast(ID_TYPE))
    columns = [
        point_id.alias("id"),
        vectors.cast(VECTORS_TYPE).alias("vectors"),
        payload.cast("variant").alias("payload"),
        (no_shard_key() if shard_key is None else shard_key).alias("shard_key"),
        (F.col(source_ord) if source_ord else F.lit(0)).cast("bigint").alias("source_ord"),
    ]
    if mode == "quarantine":
        columns.append(reason.alias(REJECT_COLUMN))
    return df.select(*columns)


def accepted(points: DataFrame) -> DataFrame:
    """The good rows of a quarantine run."""
    return points.filter(F.col(REJECT_COLUMN).isNull()).select(*POINT_COLUMNS)


def rejected(points: DataFrame) -> DataFrame:
    """The bad rows of a quarantine run, with their reasons."""
    return points.filter(F.col(REJECT_COLUMN).isNotNull())


def carried(source_ord: str | None) -> list[str]:
    """The order column to carry through a staging select, when there is one."""
    return [source_ord] if source_ord else []

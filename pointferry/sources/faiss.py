"""Flat vector index: vectors by position, with an optional id map."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.functions.ids import number_id
from pointferry.functions.vectors import dense, named
from pointferry.model import DEFAULT_VECTOR
from pointferry.sources.base import to_points


def normalize_faiss(
    raw: DataFrame, *, id_map: DataFrame | None = None, source_ord: str | None = None, mode: str = "fail"
) -> DataFrame:
    """The id is the mapped value, else the position; there is no payload.

    Both sides of the id-map join are unique on the position, so it is a plain equi-join on an
    evenly spread key whatever the index size; the planner picks the strategy.
    """
    number = F.col("pos")
    if id_map is not None:
        raw = raw.join(id_map.select("pos", F.col("id").alias("_mapped")), "pos", "left")
        number = F.coalesce(F.col("_mapped"), F.col("pos"))
    return to_points(
        raw,
        id_col=number_id(number),
        vectors=named({DEFAULT_VECTOR: F.when(F.col("vector").isNotNull(), dense(F.col("vector")))}),
        payload=F.lit(None),
        source_ord=source_ord,
        checks=[(number.isNull(), "missing position"), (number < 0, "negative id")],
        mode=mode,
    )

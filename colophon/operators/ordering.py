"""Global positions of rows without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from colophon.session import Scratch

_ROW_BITS = 33  # monotonically_increasing_id: partition id above, row number below


def dense_ids(df: DataFrame, order: Sequence[str | Column], id_col: str = "id") -> DataFrame:
    """Add 0-based, gap-free ids in the given order.

    Rows are sorted by a range partitioning and written once, so that the positions found in
    each partition and the partitions' offsets come from the same layout. The offsets are one
    row per partition. ``order`` should be unique, both for stable ids and to keep the ranges
    even.
    """
    scratch = Scratch(df.sparkSession, "ids")
    keys = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    laid_out = scratch.table(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()),
        "sorted",
    )
    part = F.shiftright("_at", _ROW_BITS)
    offsets = (
        laid_out.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_part",
            (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"),
        )
    )
    row = F.col("_at") - F.shiftleft(part, _ROW_BITS)
    return (
        laid_out.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + row).alias(id_col), *df.columns)
    )


def extended_ids(known: DataFrame | None, found: DataFrame, keys: Sequence[str],
                 order: Sequence[str | Column], id_col: str = "id") -> DataFrame:
    """``known`` rows with their ids, and the rows of ``found`` whose keys it lacks, numbered behind them.

    Ids of known rows never change, so tables that hold them stay right when more is loaded. Null keys are
    equal to each other. ``found`` has each combination of keys once; without ``known`` all are new.
    """
    if known is None:
        return dense_ids(found, order, id_col)
    same = reduce(lambda a, b: a & b, (F.col(f"n.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys))
    new = dense_ids(found.alias("n").join(known.select(*keys).alias("k"), same, "left_anti"), order, id_col)
    top = known.agg(F.max(id_col)).first()[0]
    first = 0 if top is None else top + 1
    return known.unionByName(new.withColumn(id_col, F.col(id_col) + first))

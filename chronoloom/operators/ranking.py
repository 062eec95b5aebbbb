"""Ranks over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.sources.tables import Scratch


def distributed_rank(df: DataFrame, groups: list[str], order: list[Column], name: str, scratch: Scratch) -> DataFrame:
    """Adds the rank (from 1) of each row in its group, without ever holding a group in one task.

    The rows are range-partitioned by group and order, so that even a group of all rows is spread over tasks and
    sorted apart; the counts of groups per partition give each partition its start. ``order`` must be total.
    Result: the columns of ``df`` and ``name``.
    """
    # The range partitioning samples its input first; what leads to it isn't worked out twice.
    df = df if hasattr(df, "_scratch_path") else scratch.cut(df, "ranked")
    keys = [*(F.col(g) for g in groups), *order]
    spread = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The upper bits of this id are the partition, the lower 33 the row's place in it.
    placed = scratch.cut(spread.withColumn("_place", F.monotonically_increasing_id()), "placed")
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumn("_part", part).withColumn("_place", place)
    counts = placed.groupBy(*groups, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    window = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_n").over(window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("_before", before).drop("_n")
    same = F.col("p._part") == F.col("s._part")
    for g in groups:
        same = same & F.col(f"p.{g}").eqNullSafe(F.col(f"s.{g}"))
    rank = (F.col("p._place") - F.col("s._first") + F.col("s._before") + 1).cast("long")
    return placed.alias("p").join(starts.alias("s"), same).select(*(F.col(f"p.{c}") for c in df.columns), rank.alias(name))

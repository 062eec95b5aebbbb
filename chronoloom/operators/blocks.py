"""Groups of any size worked on in pairs of bounded blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Large groups are broadcast up to so many; more of them are joined by a shuffle.
BROADCAST_GROUPS = 200_000


def large_groups(df: DataFrame, keys: list[str], block_rows: int) -> DataFrame:
    """Groups of more than ``block_rows`` rows with their number ``_rows``: at most rows / block_rows of them, by a partial aggregation."""
    return df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > block_rows)


def _parted(df: DataFrame, keys: list[str], row_id: str, block_rows: int, sizes: DataFrame | None) -> DataFrame:
    sizes = large_groups(df, keys, block_rows) if sizes is None else sizes
    hot = sizes.select(*keys, F.ceil(F.col("_rows") / block_rows).cast("int").alias("_n"))
    if sizes.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        hot = F.broadcast(hot)
    return df.join(hot, keys, "left").withColumn("_n", F.coalesce("_n", F.lit(1))).withColumn("part", F.pmod(F.xxhash64(row_id), F.col("_n")).cast("int"))


def blocks(df: DataFrame, keys: list[str], row_id: str, block_rows: int, sizes: DataFrame | None = None) -> DataFrame:
    """Adds ``part``: each group becomes blocks of about ``block_rows`` rows by a hash of ``row_id``; see ``pair_blocks``."""
    return _parted(df, keys, row_id, block_rows, sizes).select(*df.columns, "part")


def pair_blocks(df: DataFrame, keys: list[str], row_id: str, block_rows: int, sizes: DataFrame | None = None) -> DataFrame:
    """Adds ``i``, ``j`` and ``part``: each group becomes blocks of about ``block_rows`` rows, each pair of blocks a task.

    A group of n blocks gives n (n + 1) / 2 tasks of two blocks at most (i = j: one block with itself). Group sizes
    are counted by a partial aggregation; only those above the limit are joined. ``sizes``: what ``large_groups`` gives, where it is known already.
    """
    own = _parted(df, keys, row_id, block_rows, sizes)
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j"))))
    return own.withColumn("_p", pair).select(*df.columns, F.col("_p.i").alias("i"), F.col("_p.j").alias("j"), "part")

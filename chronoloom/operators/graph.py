"""Operators on graphs given as tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.sources.tables import Scratch


def both_ways(df: DataFrame, a: str, b: str) -> DataFrame:
    """Every edge in both directions, as ``u`` and ``v``."""
    pair = F.explode(F.array(F.struct(F.col(a).alias("u"), F.col(b).alias("v")), F.struct(F.col(b).alias("u"), F.col(a).alias("v"))))
    return df.select(pair.alias("e")).select("e.u", "e.v")


def star_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components: ``node`` and ``label``, the smallest node of its component.

    ``edges``: ``u`` and ``v``; loops and repeated edges may occur, nodes without an edge to another don't come out.
    Large and small stars alternate until nothing changes, which takes a number of rounds in the logarithm of the
    longest path; each round is two joins on vertices and partial aggregations, cut off by a written table.
    """
    pairs = scratch.cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "pairs")
    if not pairs.limit(1).count():
        return pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    before = None
    while True:
        sym = both_ways(pairs, "u", "v")
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.cut(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = scratch.cut(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small")
        scratch.drop(large)
        scratch.drop(pairs)
        # An arc only ever moves to a smaller end, so both figures change as long as anything does.
        mark = tuple(nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        pairs = nxt
        if mark == before:
            break
        before = mark
    label = pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return scratch.cut(label.unionByName(roots), "components")


def strong_edges(edges: DataFrame, threshold: float) -> DataFrame:
    """Edges of at least this weight."""
    return edges.where(F.col("weight") >= threshold)


def neighbourhood(edges: DataFrame, centre: DataFrame, hops: int, scratch: Scratch) -> DataFrame:
    """Nodes at most so many hops from the ``node`` rows of ``centre``, directions aside: ``node`` and ``hop``.

    ``edges``: ``source``, ``target``. Each hop is one join of the newest nodes with the edges; nodes seen before
    are left out, so that the frontier, not the whole neighbourhood, is joined.
    """
    sym = both_ways(edges, "source", "target").distinct()
    seen = scratch.cut(centre.select("node").distinct().withColumn("hop", F.lit(0)), "hop")
    frontier = seen
    for h in range(1, hops + 1):
        reached = frontier.join(sym, frontier["node"] == sym["u"]).select(F.col("v").alias("node")).distinct()
        frontier = scratch.cut(reached.join(seen.select("node"), "node", "left_anti").withColumn("hop", F.lit(h)), "hop")
        seen = seen.unionByName(frontier)
    return seen


def induced_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among ``node``."""
    n = nodes.select("node")
    return edges.join(n.withColumnRenamed("node", "source"), "source", "left_semi").join(n.withColumnRenamed("node", "target"), "target", "left_semi")

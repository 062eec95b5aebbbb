"""Clusterings of one bounded block of vectors; blocks are worked on in parallel."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.graph import star_components
from chronoloom.operators.ranking import distributed_rank
from chronoloom.operators.similarity import group_neighbours, mutual_edges, same_vectors, unit_rows, vector_blocks
from chronoloom.sources.tables import Scratch

#: Rows that are clustered in one task, at most.
MOST_ROWS = 4_096


@dataclass(frozen=True)
class Sizes:
    """Wanted sizes of clusters and limits of the search."""

    target: int = 24
    least: int = 20
    most: int = 30
    k: int = 20
    least_similarity: float = 0.0
    resolution: float = 0.2
    growth: float = 1.5
    rounds: int = 8
    depth: int = 4
    absorb: float = 0.0

    def doubled(self) -> Sizes:
        """The looser sizes of the top level."""
        target = max(self.target, 2 * self.most)
        return Sizes(target, max(2, min(self.least, target // 2)), 2 * self.most, self.k, self.least_similarity, self.resolution, self.growth, self.rounds, self.depth, self.absorb)


def mutual_graph(u: np.ndarray, k: int, least: float) -> np.ndarray:
    """Symmetric weights of mutual k-nearest neighbours from a cosine on, 0 elsewhere."""
    n = len(u)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    k = min(k, n - 1)
    if k < 1:
        return np.zeros((n, n))
    near = np.zeros((n, n), bool)
    near[np.arange(n)[:, None], np.argsort(-s, axis=1, kind="stable")[:, :k]] = True
    return np.where(near & near.T & (s >= least) & (s > 0), s, 0.0)


class Adjacency:
    """A symmetric weighted graph as lists of neighbours."""

    def __init__(self, n: int, source: np.ndarray, target: np.ndarray, weight: np.ndarray):
        order = np.lexsort((target, source))
        self.n, self.source, self.target, self.weight = n, source[order], target[order], weight[order]
        self.degree = np.bincount(self.source, self.weight, n)
        edge = np.searchsorted(self.source, np.arange(n + 1)).tolist()
        t, w = self.target.tolist(), self.weight.tolist()
        self.near = [list(zip(t[a:b], w[a:b], strict=True)) for a, b in zip(edge, edge[1:], strict=False)]

    @classmethod
    def of(cls, w: np.ndarray) -> Adjacency:
        a, b = np.nonzero(w)
        return cls(len(w), a, b, w[a, b])

    def folded(self, own: np.ndarray, n: int) -> Adjacency:
        """The graph of communities: weights between and within them summed up."""
        key, at = np.unique(own[self.source] * n + own[self.target], return_inverse=True)
        return Adjacency(n, key // n, key % n, np.bincount(at, self.weight, len(key)))


def modularity_communities(w: np.ndarray | Adjacency, resolution: float, seed: int = 0) -> np.ndarray:
    """Communities of a weighted graph: local moves, refinement to connected parts, aggregation (a seeded Leiden-like search)."""
    level = w if isinstance(w, Adjacency) else Adjacency.of(w)
    member = np.arange(level.n)
    rng = np.random.default_rng(seed)
    while len(level.source):
        scale = resolution / level.degree.sum()
        degree, own, mass = level.degree.tolist(), list(range(level.n)), level.degree.tolist()
        moved = True
        while moved:
            moved = False
            for i in rng.permutation(level.n).tolist():
                to: dict[int, float] = {}
                for j, x in level.near[i]:
                    if j != i:
                        to[own[j]] = to.get(own[j], 0.0) + x
                home, d = own[i], degree[i]
                mass[home] -= d
                best, most = home, to.get(home, 0.0) - scale * d * mass[home]
                for c in sorted(to):
                    gain = to[c] - scale * d * mass[c]
                    if gain > most + 1e-12:
                        best, most = c, gain
                moved |= best != home
                mass[best] += d
                own[i] = best
        names, own = np.unique(_connected(level, own), return_inverse=True)
        member = own[member]
        if len(names) == level.n:
            break
        level = level.folded(own, len(names))
    return member


def _connected(g: Adjacency, own: list[int]) -> np.ndarray:
    """Communities cut into their connected parts."""
    out, n = [-1] * g.n, 0
    for i in range(g.n):
        if out[i] >= 0:
            continue
        stack, out[i] = [i], n
        while stack:
            j = stack.pop()
            for o, _ in g.near[j]:
                if out[o] < 0 and own[o] == own[i]:
                    out[o] = n
                    stack.append(o)
        n += 1
    return np.array(out)


def balance_penalty(label: np.ndarray, s: Sizes) -> float:
    """How far the sizes of a partition are from the wanted ones; lower is better."""
    sizes = np.bincount(label)
    sizes = sizes[sizes > 0]
    over, one = sizes > s.most, sizes == 1
    small = ~over & ~one & (sizes < s.least)
    fine = ~over & ~one & ~small
    cost = 8.0 * (sizes[over] - s.most).sum() + 2.5 * one.sum() + 1.5 * (s.least - sizes[small]).sum() + 0.15 * np.abs(sizes[fine] - s.target).sum()
    many = sizes[sizes > 1]
    cost += 0.45 * abs(np.median(many) - s.target) + 0.15 * abs(many.mean() - s.target) if len(many) else 4.0 * s.target
    if len(sizes) == 1 and over.any():
        cost += 10.0 * sizes[0]
    return float(cost)


def partition_cost(clusters: DataFrame, s: Sizes) -> DataFrame:
    """``balance_penalty`` of a whole table of clusters (``cluster_id``), to six decimals: one row with ``clusters``, ``largest`` and ``cost``.

    Sizes are counted by a partial aggregation and then by how often they occur, so the median is that of a few rows.
    """
    n = F.col("n")
    sizes = clusters.groupBy("cluster_id").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("times"))
    over, one = n > s.most, n == 1
    small = ~over & ~one & (n < s.least)
    each = F.when(over, 8.0 * (n - s.most)).when(one, 2.5).when(small, 1.5 * (s.least - n)).otherwise(0.15 * F.abs(n - s.target))
    many = F.when(n > 1, F.col("times"))
    total = sizes.agg(
        F.sum(each * F.col("times")).alias("sum"), F.sum("times").alias("clusters"), F.max("n").alias("largest"), F.coalesce(F.sum(many), F.lit(0)).alias("many"), F.sum(n * many).alias("rows"),
        F.expr("percentile(n, 0.5D, CASE WHEN n > 1 THEN times ELSE 0 END)").alias("median"),
    )
    centre = F.when(F.col("many") > 0, 0.45 * F.abs(F.col("median") - s.target) + 0.15 * F.abs(F.col("rows") / F.col("many") - s.target)).otherwise(4.0 * s.target)
    whole = F.when((F.col("clusters") == 1) & (F.col("largest") > s.most), 10.0 * F.col("largest")).otherwise(0.0)
    return total.where("clusters > 0").select("clusters", "largest", F.round(F.col("sum") + centre + whole, 6).alias("cost"))


def balanced_partition(u: np.ndarray, s: Sizes, graph: Adjacency | None = None) -> np.ndarray:
    """The best of a geometric sweep of resolutions; ties go to the smaller largest cluster. ``graph``: where it is known already."""
    graph = graph or Adjacency.of(mutual_graph(u, s.k, s.least_similarity))
    best, label = None, np.arange(len(u))
    for r in range(s.rounds):
        one = modularity_communities(graph, s.resolution * s.growth**r)
        mark = (balance_penalty(one, s), np.bincount(one).max())
        if best is None or mark < best:
            best, label = mark, one
    return label


def split_recursively(u: np.ndarray, s: Sizes, depth: int = 0, graph: Adjacency | None = None) -> np.ndarray:
    """Clusters above the largest size split again, up to the depth."""
    label = balanced_partition(u, s.doubled() if depth == 0 else s, graph)
    if depth >= s.depth:
        return label
    out, n = np.zeros(len(u), int), 0
    for c in np.unique(label):
        at = np.flatnonzero(label == c)
        if s.most < len(at) < len(u) or (depth == 0 and len(at) > s.most):
            sub = split_recursively(u[at], s, depth + 1)
        else:
            sub = np.zeros(len(at), int)
        out[at] = n + sub
        n += sub.max() + 1
    return out


def absorb_small(u: np.ndarray, label: np.ndarray, s: Sizes) -> np.ndarray:
    """Small clusters, smallest first, put to the one with the highest mean cosine above the threshold, up to the largest size."""
    if s.absorb <= 0:
        return label
    label = label.copy()
    while True:
        names, sizes = np.unique(label, return_counts=True)
        done = True
        for c in names[np.argsort(sizes, kind="stable")]:
            mine = label == c
            if mine.sum() >= s.least:
                continue
            centre = u[mine].mean(0)
            options = [(float(centre @ u[label == o].mean(0)), -int(o)) for o in names if o != c and mine.sum() + (label == o).sum() <= s.most]
            if options and max(options)[0] > s.absorb:
                label[mine] = -max(options)[1]
                done = False
                break
        if done:
            return label


def average_linkage(u: np.ndarray, clusters: int, size: np.ndarray | None = None) -> np.ndarray:
    """Agglomeration by mean cosine to a fixed number of clusters.

    With ``size`` the rows of ``u`` are the means of so many unit vectors each: the mean cosine between two groups is
    the product of their means, so groups agglomerate as their members would.
    """
    n = len(u)
    label = np.arange(n)
    if n <= clusters:
        return label
    sim, size = u @ u.T, np.ones(n) if size is None else np.asarray(size, float).copy()
    np.fill_diagonal(sim, -np.inf)
    best = sim.argmax(1)
    most = sim[np.arange(n), best]
    for _ in range(n - max(1, clusters)):
        a = int(np.argmax(most))
        a, b = sorted((a, int(best[a])))
        mean = (sim[a] * size[a] + sim[b] * size[b]) / (size[a] + size[b])
        mean[[a, b]] = -np.inf
        sim[a], sim[:, a] = mean, mean
        sim[b], sim[:, b] = -np.inf, -np.inf
        size[a] += size[b]
        label[label == b] = a
        # Rows whose nearest was one of the two look again; the others only compare the merged one.
        again = np.flatnonzero((best == a) | (best == b))
        again = np.union1d(again, [a, b])
        best[again] = sim[again].argmax(1)
        most[again] = sim[again, best[again]]
        nearer = (sim[:, a] > most) | ((sim[:, a] == most) & (a < best))
        best[nearer], most[nearer] = a, sim[nearer, a]
    return label


def cluster_blocks(rows: DataFrame, scratch: Scratch, method: str = "balanced", sizes: Sizes | None = None, clusters_per_block: int = 8) -> DataFrame:
    """Clusters of every block: ``block``, ``id``, ``cluster_id``, ``size``; ids c0001, c0002, ... by size, then by the first member.

    ``rows``: ``block`` (bounded, see ``similarity.vector_blocks``), ``id``, ``vector``. Methods: ``balanced`` (mutual
    neighbours, communities, size search, splitting and absorbing) and ``average`` (linkage to a fixed number).
    """
    s = sizes or Sizes()
    kind = rows.schema["id"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        u = unit_rows(np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vector"]]))
        label = average_linkage(u, clusters_per_block) if method == "average" else absorb_small(u, split_recursively(u, s), s)
        first = pd.Series(pdf["id"].to_numpy()).groupby(label).transform("first")
        return pd.DataFrame({"block": pdf["block"].to_numpy(), "id": pdf["id"].to_numpy(), "head": first.to_numpy()})

    found = scratch.cut(rows.select("block", "id", "vector").groupBy("block").applyInPandas(run, f"block string, id {kind}, head {kind}"), "clusters")
    sizes_ = found.groupBy("block", "head").agg(F.count("*").alias("size"))
    named = distributed_rank(sizes_, [], [F.desc("size"), F.col("head"), F.col("block")], "n", scratch)
    return found.join(named, ["block", "head"]).select("block", "id", F.format_string("c%04d", F.col("n")).alias("cluster_id"), "size")


def named_clusters(found: DataFrame, scratch: Scratch) -> DataFrame:
    """``id``, ``cluster_id``, ``size`` of rows with the ``head`` of their cluster; ids c0001, c0002, ... by size, then by head."""
    sizes = found.groupBy("head").agg(F.count("*").alias("size"))
    named = distributed_rank(sizes, [], [F.desc("size"), F.col("head")], "n", scratch)
    return found.join(named, "head").select("id", F.format_string("c%04d", F.col("n")).alias("cluster_id"), "size")


def _heads(pdf: pd.DataFrame, label: np.ndarray) -> pd.DataFrame:
    first = pd.Series(pdf["id"].to_numpy()).groupby(label).transform("first")
    return pd.DataFrame({"id": pdf["id"].to_numpy(), "head": first.to_numpy()})


def _follow(found: DataFrame, copies: DataFrame) -> DataFrame:
    """Copies with the head of their leader."""
    return found.unionByName(copies.join(found.withColumnRenamed("id", "leader"), "leader").select("id", "head"))


def balanced_clusters(rows: DataFrame, scratch: Scratch, sizes: Sizes | None = None, most_rows: int = MOST_ROWS) -> DataFrame:
    """Communities of wanted sizes of all vectors: ``id``, ``cluster_id``, ``size``.

    ``rows``: ``id``, ``vector``. The mutual-neighbour graph is that of all rows, found in pairs of blocks; equal vectors
    go together. Every connected component is worked on in one task, with size search, splitting and absorbing;
    a component of more than ``most_rows`` rows is cut into blocks of neighbouring vectors first, and only there links are lost.
    """
    s = sizes or Sizes()
    kind = rows.schema["id"].dataType.simpleString()
    copies = scratch.cut(same_vectors(rows), "copies")
    rows = scratch.cut(rows.select("id", "vector").dropDuplicates(["id"]).join(copies.select("id"), "id", "left_anti"), "rows")
    near = group_neighbours(rows.withColumn("all", F.lit(0)), "all", s.k, max(s.least_similarity, 0.0))
    edges = scratch.cut(mutual_edges(near), "edges")
    label = star_components(edges.select(F.col("source").alias("u"), F.col("target").alias("v")), scratch)
    placed = rows.join(label.withColumnRenamed("node", "id"), "id", "left").select("id", "vector", F.coalesce("label", "id").cast("string").alias("part"))
    large = scratch.cut(placed.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > most_rows), "large")
    hot = large.limit(1).count() > 0
    if hot:
        # Blocks hold at most four times the size they aim at.
        cut = vector_blocks(placed.join(large, "part", "left_semi").select("id", "vector"), max(1, most_rows // 4), scratch=scratch).select("id", "vector", F.concat(F.lit("b"), "block").alias("part"))
        placed = scratch.cut(placed.join(large, "part", "left_anti").unionByName(cut), "parts")
    both = edges.join(placed.select(F.col("id").alias("source"), "part"), "source")
    if hot:
        both = both.join(placed.select(F.col("id").alias("target"), F.col("part").alias("other")), "target").where("part = other").drop("other")

    def run(pdf: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable").reset_index(drop=True)
        if len(pdf) < 2:
            return _heads(pdf, np.arange(len(pdf)))
        u = unit_rows(np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vector"]]))
        at = pd.Series(np.arange(len(pdf)), index=pdf["id"])
        a, b, w = at[links["source"]].to_numpy(), at[links["target"]].to_numpy(), links["weight"].to_numpy()
        graph = Adjacency(len(pdf), np.r_[a, b], np.r_[b, a], np.r_[w, w])
        return _heads(pdf, absorb_small(u, split_recursively(u, s, graph=graph), s))

    links = scratch.cut(both.select("part", "source", "target", "weight"), "links")
    found = placed.groupBy("part").cogroup(links.groupBy("part")).applyInPandas(run, f"id {kind}, head {kind}")
    return named_clusters(scratch.cut(_follow(scratch.cut(found, "found"), copies), "clusters"), scratch)


def linkage_clusters(rows: DataFrame, scratch: Scratch, clusters: int, most_rows: int = MOST_ROWS) -> DataFrame:
    """Average linkage of all vectors to a fixed number of clusters: ``id``, ``cluster_id``, ``size``.

    ``rows``: ``id``, ``vector``. Up to ``most_rows`` different vectors are agglomerated at once. More of them are cut into blocks of
    neighbouring vectors, each agglomerated to a share of ``most_rows`` groups; the groups' means go on in the same
    way, so only the first steps of the agglomeration are confined to blocks.
    """
    kind = rows.schema["id"].dataType.simpleString()
    copies = scratch.cut(same_vectors(rows), "copies")
    weight = copies.groupBy(F.col("leader").alias("id")).agg(F.count("*").alias("n"))
    u = scratch.cut(rows.select("id", "vector").dropDuplicates(["id"]).join(copies.select("id"), "id", "left_anti").join(weight, "id", "left").select("id", "vector", (F.coalesce("n", F.lit(0)) + 1).cast("double").alias("size"), F.lit(True).alias("raw")), "rows")
    steps = []

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable").reset_index(drop=True)
        m = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vector"]])
        m, size, wanted = unit_rows(m) if pdf["raw"].iloc[0] else m, pdf["size"].to_numpy(), int(pdf["wanted"].iloc[0])
        label = average_linkage(m, wanted, size)
        out = _heads(pdf, label)
        total = pd.DataFrame(m * size[:, None]).groupby(label).transform("sum").to_numpy() / pd.Series(size).groupby(label).transform("sum").to_numpy()[:, None]
        return out.assign(vector=list(total), size=size)

    while True:
        n = u.count()
        if n <= most_rows:
            blocked = u.withColumn("block", F.lit("0")).withColumn("wanted", F.lit(clusters))
        else:
            blocked = scratch.cut(vector_blocks(u, max(1, most_rows // 4), scratch=scratch), "blocks")
            # All blocks together leave a quarter of what fits, but each at least one group and at most half of its rows.
            share = F.greatest(F.lit(1), F.least(F.ceil(F.col("rows") / 2), F.floor(F.col("rows") * (most_rows / 4 / n)))).cast("int")
            blocked = blocked.join(blocked.groupBy("block").agg(F.count("*").alias("rows")), "block").withColumn("wanted", share).drop("rows")
        step = scratch.cut(blocked.groupBy("block").applyInPandas(run, f"id {kind}, head {kind}, vector array<double>, size double"), "step")
        steps.append(step.select("id", "head"))
        if n <= most_rows:
            break
        u = scratch.cut(step.groupBy(F.col("head").alias("id")).agg(F.first("vector").alias("vector"), F.sum("size").alias("size")).withColumn("raw", F.lit(False)), "means")
    found = steps[0]
    for nxt in steps[1:]:
        found = found.withColumnRenamed("head", "h").join(nxt.select(F.col("id").alias("h"), "head"), "h").select("id", "head")
    return named_clusters(scratch.cut(_follow(scratch.cut(found, "found"), copies), "clusters"), scratch)


def projected_points(rows: DataFrame, dimension: int = 2) -> DataFrame:
    """Points for a plot: principal components of the vectors, in place of a neighbour embedding.

    Sums and products are summed up per partition and then by an aggregation of one row per matrix row, so that
    only the matrix of the covariance reaches the driver. An empty table gives an empty result.
    """
    spark = rows.sparkSession

    def part(frames):
        n, total, square = 0, None, None
        for pdf in frames:
            if len(pdf):
                m = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vector"]])
                n += len(m)
                total = m.sum(0) if total is None else total + m.sum(0)
                square = m.T @ m if square is None else square + m.T @ m
        if n:
            d = len(total)
            yield pd.DataFrame({"i": np.repeat(np.arange(d), d), "j": np.tile(np.arange(d), d), "n": n, "total": np.repeat(total, d), "square": square.ravel()})

    sums = rows.select("vector").mapInPandas(part, "i int, j int, n long, total double, square double").groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("square").alias("square"))
    sums = sums.toPandas().sort_values(["i", "j"])
    if not len(sums):
        return rows.select("id", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    d, n = int(sums["i"].max()) + 1, int(sums["n"].iloc[0])
    mean = sums["total"].to_numpy()[::d] / n
    cov = sums["square"].to_numpy().reshape(d, d) / n - np.outer(mean, mean)
    _, axes = np.linalg.eigh(cov)
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(d)] < 0, -1.0, 1.0)
    shipped = spark.sparkContext.broadcast((mean, axes[:, ::-1][:, :dimension]))
    kind = rows.schema["id"].dataType.simpleString()

    def place(frames):
        centre, a = shipped.value
        for pdf in frames:
            p = (np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vector"]]) - centre) @ a if len(pdf) else np.zeros((0, 2))
            yield pd.DataFrame({"id": pdf["id"], "x": p[:, 0].round(6), "y": p[:, 1].round(6)})

    return rows.select("id", "vector").mapInPandas(place, f"id {kind}, x double, y double")

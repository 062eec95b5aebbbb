"""Records grouped into clusters of mutually similar ones."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.vectors import BLOCK_ROWS, bounded_cells, fit_centres, into_cells, unit, usable
from chronoloom.operators.blocks import blocks, large_groups, pair_blocks
from chronoloom.operators.graph import star_components
from chronoloom.sources.tables import Scratch

#: A vector joins a leaf of the feature tree from this cosine with its centre on.
LEAF_COSINE = 0.9


class FeatureTree:
    """Leaves of cluster features (count, linear sum) of unit vectors; mergeable.

    For unit vectors count and linear sum give everything that is needed: the mean cosine between two leaves is
    the product of their sums over the product of their counts. The cells are the upper level of the tree, so a tree
    holds the leaves of a block of bounded size.
    """

    def __init__(self, dimension: int):
        self.count = np.zeros(0)
        self.sums = np.zeros((0, dimension))

    def insert(self, x: np.ndarray, leaf_cosine: float) -> np.ndarray:
        """Takes in unit vectors; the leaf of each."""
        return np.concatenate([self.merge(np.ones(len(p)), p, leaf_cosine) for p in (x[s : s + 2048] for s in range(0, len(x), 2048))])

    def merge(self, count: np.ndarray, sums: np.ndarray, leaf_cosine: float) -> np.ndarray:
        """Takes in features of another tree; the leaf of each. One opens a leaf if no centre is near enough; those near it go along."""
        unit_sums = lambda s: s / np.linalg.norm(s, axis=1, keepdims=True)
        x = unit_sums(sums)
        leaf = np.full(len(x), -1)
        if len(self.count):
            score = x @ unit_sums(self.sums).astype(x.dtype).T
            best = score.argmax(1)
            fits = score[np.arange(len(x)), best] >= leaf_cosine
            leaf[fits] = best[fits]
        rest = np.flatnonzero(leaf < 0)
        base, fresh = len(self.count), 0
        if len(rest):
            near = (x[rest] @ x[rest].T) >= leaf_cosine
            free = np.ones(len(rest), bool)
            for r in range(len(rest)):
                if free[r]:
                    go = near[r] & free
                    go[r] = True
                    leaf[rest[go]] = base + fresh
                    free &= ~go
                    fresh += 1
        self.count = np.r_[self.count, np.zeros(fresh)]
        self.sums = np.vstack([self.sums, np.zeros((fresh, x.shape[1]))])
        np.add.at(self.count, leaf, count)
        np.add.at(self.sums, leaf, sums)
        return leaf


def ward(count: np.ndarray, sums: np.ndarray, least: float) -> np.ndarray:
    """Cluster of each leaf: Ward's cheapest merge first, as long as the mean cosine across the merge is at least ``least``."""
    import heapq

    n = len(count)
    label, alive = np.arange(n), np.ones(n, bool)
    if n < 2:
        return label
    count, sums = count.copy(), sums.copy()
    mean = sums / count[:, None]
    a, b = np.nonzero(np.triu(mean @ mean.T >= least, 1))
    if not len(a):
        return label
    near: dict[int, set] = {}
    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        near.setdefault(p, set()).add(q)
        near.setdefault(q, set()).add(p)
    cost = lambda p, q: count[p] * count[q] / (count[p] + count[q]) * float(((sums[p] / count[p] - sums[q] / count[q]) ** 2).sum())
    spread = ((mean[a] - mean[b]) ** 2).sum(1) * count[a] * count[b] / (count[a] + count[b])
    heap = [(c, p, q, 0, 0) for c, p, q in zip(spread.tolist(), a.tolist(), b.tolist(), strict=True)]
    heapq.heapify(heap)
    age, into = np.zeros(n, int), np.arange(n)
    while heap:
        _, p, q, ap, aq = heapq.heappop(heap)
        if not (alive[p] and alive[q]) or age[p] != ap or age[q] != aq:
            continue
        count[p] += count[q]
        sums[p] += sums[q]
        alive[q], into[q] = False, p
        age[p] += 1
        around = (near.pop(q) | near[p]) - {p, q}
        near[p] = set()
        for o in around:
            near[o].discard(q)
            near[o].discard(p)
            if float(sums[p] @ sums[o]) / (count[p] * count[o]) >= least:
                near[p].add(o)
                near[o].add(p)
                heapq.heappush(heap, (cost(p, o), p, o, age[p], age[o]) if p < o else (cost(o, p), o, p, age[o], age[p]))
    for i in range(n):
        r = i
        while into[r] != r:
            r = into[r]
        label[i] = r
    return label


def clusters(elements: DataFrame, least: float = 0.77, dimension: int = 96, sure: float = 0.999, scratch: Scratch | None = None) -> DataFrame:
    """Clusters of mutually similar vectors of one type: ``id``, ``type``, ``cluster_id`` (the smallest id of the cluster).

    ``elements``: ``id``, ``type``, ``vector``; other columns are ignored. Clusters grow as long as the mean cosine
    across a merge reaches ``least``; where groups of vectors with a cosine of ``least`` among all of their pairs
    are apart from each other, these groups are the clusters. Every usable vector comes out, alone if need be; rows with a null id or type
    and vectors that are null, of another length, all zero or not finite belong to no cluster and don't come out.
    Repeated rows count once (an id with different vectors comes out for each of them); an empty table gives an empty result.

    1. Every vector goes to its nearest cell; a feature tree takes in each block of a cell. A group of copies, or of
       near copies, of any size becomes a leaf per block.
    2. Only the leaves' summaries (count and sum) go on, to all cells in their reach (see ``into_cells``), where the
       trees of the blocks are merged and Ward's method agglomerates the leaves. What the cells found out is reduced
       further by alternating stars over leaves that occur in several cells, never on one machine.
    3. One pass assigns all rows to clusters by their leaves; a leaf has no more rows than a block.
    """
    scratch = scratch or Scratch(elements.sparkSession, "clusters")
    vectors = usable(elements, dimension)
    centres = fit_centres(vectors, dimension)
    reach = math.sqrt(2 - 2 * least)

    def take_in(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("id").sort_values("id", kind="stable")
        ids = pdf["id"].to_numpy(dtype=object)
        tree = FeatureTree(dimension)
        leaf = tree.insert(unit(np.frombuffer(b"".join(pdf["v"]), dtype="<f4").reshape(len(pdf), dimension)).astype(np.float32), LEAF_COSINE)
        first = np.full(len(tree.count), len(ids))
        np.minimum.at(first, leaf, np.arange(len(ids)))
        count, sums = np.full(len(ids), None, object), np.full(len(ids), None, object)
        count[first], sums[first] = tree.count, [list(s) for s in tree.sums.astype(np.float32)]
        return pd.DataFrame({"type": pdf["type"].iloc[0], "id": ids, "leaf": ids[first[leaf]], "count": count.astype(float), "vector": sums})

    near = into_cells(vectors, centres, dimension, reach, sure, 1)
    near = blocks(near, ["type", "cell"], "id", BLOCK_ROWS, scratch.cut(large_groups(near, ["type", "cell"], BLOCK_ROWS), "large"))
    rows = scratch.cut(near.groupBy("type", "cell", "part").applyInPandas(take_in, "type string, id string, leaf string, count double, vector array<float>"), "leaves")
    leaves = into_cells(rows.where("vector is not null").select("type", "id", "vector", "count"), centres, dimension, reach, sure)
    leaves, large = bounded_cells(leaves, dimension, reach, sure, scratch)

    def agglomerate(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("id").sort_values("id", kind="stable")
        ids = pdf["id"].to_numpy(dtype=object)
        tree = FeatureTree(dimension)
        leaf = tree.merge(pdf["count"].to_numpy(), np.frombuffer(b"".join(pdf["v"]), dtype="<f4").reshape(len(pdf), dimension).astype(np.float64), LEAF_COSINE)
        # Rounding of float32 must not part a pair that lies on the border.
        label = ward(tree.count, tree.sums, least - 1e-6)[leaf]
        first = np.full(len(tree.count), len(ids))
        np.minimum.at(first, label, np.arange(len(ids)))
        return pd.DataFrame({"type": pdf["type"].iloc[0], "leaf": ids, "head": ids[first[label]]})

    linked = pair_blocks(leaves, ["type", "cell"], "id", BLOCK_ROWS, large).groupBy("type", "cell", "i", "j").applyInPandas(agglomerate, "type string, leaf string, head string")
    # A leaf has one head in most of its cells; only heads that share a leaf and differ are linked.
    member = scratch.cut(linked.groupBy("type", "leaf").agg(F.array_sort(F.collect_set("head")).alias("heads")), "members")
    node = lambda c: F.concat("type", F.lit("\x1f"), c)
    others = member.where(F.size("heads") > 1).select("type", F.col("heads")[0].alias("h0"), F.explode(F.slice("heads", F.lit(2), F.size("heads"))).alias("h"))
    labels = star_components(others.select(node(F.col("h")).alias("u"), node(F.col("h0")).alias("v")), scratch)
    # The smallest id of a cluster heads its leaf and itself, so the smallest head is the smallest id; nodes of a type are in the order of ids.
    own = member.select("type", "leaf", F.col("heads")[0].alias("h0")).withColumn("node", node(F.col("h0"))).join(labels, "node", "left")
    cluster = own.select("type", "leaf", F.coalesce(F.element_at(F.split("label", "\x1f"), 2), "h0").alias("cluster_id"))
    return rows.select("type", "id", "leaf").join(cluster, ["type", "leaf"]).select("id", "type", "cluster_id")


def cluster_pairs(elements: DataFrame, **parameters) -> DataFrame:
    """``id_a`` < ``id_b`` of one cluster; see ``clusters``. The pairs are the asked result, so they are written out."""
    found = clusters(elements, **parameters)
    a = found.select("type", "cluster_id", F.col("id").alias("id_a"))
    b = found.select("type", "cluster_id", F.col("id").alias("id_b"))
    return a.join(b, ["type", "cluster_id"]).where("id_a < id_b").select("id_a", "id_b")


def describe(elements: DataFrame, members: int = 3, dimension: int = 96, **parameters) -> DataFrame:
    """One row for each cluster: ``type``, ``cluster_id``, ``size`` and ``typical``, the ids nearest to its centre.

    The centre is the mean of the unit vectors; equal cosines go to the smaller id. One full assignment pass.
    """
    scratch = Scratch(elements.sparkSession, "clusters")
    found = scratch.cut(clusters(elements, dimension=dimension, scratch=scratch, **parameters), "found")
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    unit_v = F.transform("vector", lambda x: x.cast("double") / F.col("_norm"))
    v = usable(elements, dimension).dropDuplicates(["id", "type"]).withColumn("_norm", size).select("id", "type", unit_v.alias("u"))
    rows = scratch.cut(found.join(v, ["id", "type"]), "rows")
    centre = rows.groupBy("type", "cluster_id").agg(F.count("*").alias("size"), F.array(*[F.sum(F.col("u")[i]) for i in range(dimension)]).alias("c"))
    fit = F.round(F.aggregate(F.zip_with("u", "c", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x) / F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, x: s + x * x)), 7)
    scored = rows.join(centre, ["type", "cluster_id"]).select("type", "cluster_id", "size", "id", fit.alias("fit"))
    # The limit on the rank is also applied before the shuffle.
    rank = F.row_number().over(Window.partitionBy("type", "cluster_id").orderBy(F.desc("fit"), "id"))
    top = scored.withColumn("rank", rank).where(F.col("rank") <= members)
    nearest = F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda e: e["id"])
    return top.groupBy("type", "cluster_id").agg(F.first("size").alias("size"), nearest.alias("typical"))


def summary(elements: DataFrame, run_id: str = "run_own", **parameters) -> DataFrame:
    """A row per type in the form of cluster_summary, without its time: ``cluster_count`` and ``multi_member_cluster_count``."""
    sizes = clusters(elements, **parameters).groupBy("type", "cluster_id").agg(F.count("*").alias("size"))
    return sizes.groupBy("type").agg(F.count("*").cast("int").alias("cluster_count"), F.count_if(F.col("size") > 1).cast("int").alias("multi_member_cluster_count")).select(
        F.lit(run_id).alias("run_id"), F.col("type").alias("concept_type"), F.lit("feature_tree_ward").alias("cluster_method"), "cluster_count", "multi_member_cluster_count"
    )

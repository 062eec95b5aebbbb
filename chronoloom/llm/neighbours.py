"""The k most similar vectors of every vector."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.vectors import BLOCK_ROWS, MOST_CELLS, bounded_cells, chi_square_quantile, fit_centres, into_cells, unit, usable
from chronoloom.operators.blocks import pair_blocks
from chronoloom.sources.tables import Scratch

#: Dimensions of the stable projection that the kd-tree of a cell is built on: with more of them the boxes of the leaves
#: lie too near each other for the test to stop, with fewer the projected distance says too little.
PROJECTED = 6
#: Rows of a kd-tree leaf, and leaves that are verified between two tests.
LEAF_ROWS = 64
LEAVES_AT_ONCE = 4


def kd_leaves(points: np.ndarray, leaf_rows: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: halved at the median of the widest dimension."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        at = todo.pop()
        if len(at) <= leaf_rows:
            leaves.append(at)
            continue
        p = points[at]
        axis = int(np.argmax(p.max(0) - p.min(0)))
        order = np.argsort(p[:, axis], kind="stable")
        todo += [at[order[len(at) // 2 :]], at[order[: len(at) // 2]]]
    return leaves


def cell_neighbours(ids: np.ndarray, x: np.ndarray, k: int, least: float, sure: float, asks: np.ndarray, answers: np.ndarray, tally: dict | None = None):
    """Pairs (row, neighbour, cosine) of a cell, up to k nearest of every asking row among the answering ones.

    The leaves of a kd-tree over the projected points are visited in the order of their projected distance and their
    rows verified by the full vectors. A query stops once the next leaf's distance, squared, exceeds the chi-square
    quantile times the distance that still matters (that of its k-th neighbour so far, or that of cosine ``least``):
    the projection of a nearer vector lies further away only with a probability of 1 - ``sure``. The queries of a leaf go
    together and leave out what none of them needs; ``tally`` gets how many rows were verified, of how many. Equal cosines, to seven decimals, go to the smaller id.
    """
    n, d = x.shape
    x32 = x.astype(np.float32)
    proj = x32 @ np.random.default_rng(11).standard_normal((d, PROJECTED)).astype(np.float32)
    leaves = kd_leaves(proj, LEAF_ROWS)
    low = np.array([proj[a].min(0) for a in leaves])
    high = np.array([proj[a].max(0) for a in leaves])
    theirs_of = [a[answers[a]] for a in leaves]
    quantile = chi_square_quantile(PROJECTED, sure)
    verified, in_all = 0, 0
    out_row, out_near, out_cos = [], [], []
    for mine in leaves:
        mine = mine[asks[mine]]
        if not len(mine):
            continue
        p = proj[mine][:, None]
        away = (np.maximum(0, np.maximum(low - p, p - high)) ** 2).sum(2)
        worst = np.full(len(mine), 2 - 2 * least)
        r, near, cos = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        order = np.argsort(away.min(0), kind="stable")
        in_all += len(mine) * int(answers.sum())
        while len(order):
            # What no query needs now won't be needed later: the distances that matter only shrink.
            order = order[(away[:, order] <= quantile * worst[:, None]).any(0)]
            step, order = order[:LEAVES_AT_ONCE], order[LEAVES_AT_ONCE:]
            theirs = np.concatenate([theirs_of[o] for o in step]) if len(step) else np.zeros(0, int)
            if not len(theirs):
                continue
            verified += len(mine) * len(theirs)
            s = x32[mine] @ x32[theirs].T
            a, c = np.nonzero(s >= least - 1e-5)
            other = mine[a] != theirs[c]
            a, c = a[other], theirs[c[other]]
            if not len(a):
                continue
            exact = np.round(np.einsum("ij,ij->i", x[mine[a]], x[c]), 7)
            fine = exact >= least
            r, near, cos = np.r_[r, a[fine]], np.r_[near, c[fine]], np.r_[cos, exact[fine]]
            # Only the best k of each row are kept on the way.
            rank = np.lexsort((ids[near], -cos, r))
            r, near, cos = r[rank], near[rank], cos[rank]
            best = np.arange(len(r)) - np.searchsorted(r, r) < k
            r, near, cos = r[best], near[best], cos[best]
            full = np.flatnonzero(np.bincount(r, minlength=len(mine)) >= k)
            worst[full] = 2 - 2 * cos[np.searchsorted(r, full) + k - 1]
        out_row.append(mine[r]), out_near.append(near), out_cos.append(cos)
    if tally is not None:
        tally["verified"], tally["rows"] = tally.get("verified", 0) + verified, tally.get("rows", 0) + in_all
    if not out_row:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return np.concatenate(out_row), np.concatenate(out_near), np.concatenate(out_cos)


def followers(vectors: DataFrame, k: int) -> DataFrame:
    """Copies that needn't be searched for: ``type``, ``id``, ``leader``.

    Of more than k + 1 rows of a type with the very same vector those with the k + 1 smallest ids stay in the index.
    The last of these, the leader, has the other k before itself, and so has every further copy: their neighbours
    are the same. Copies are told by 96 bits of hashes; the limit on the rank works before the shuffle too, so a
    group of a third of all rows costs a few rows per task.
    """
    same = ["type", "h1", "h2"]
    rows = vectors.select("type", "id", F.xxhash64("vector").alias("h1"), F.hash("vector").alias("h2")).distinct()
    many = rows.groupBy(*same).agg(F.count("*").alias("copies")).where(F.col("copies") > k + 1).select(*same)
    hot = rows.join(many, same, "left_semi")
    first = hot.withColumn("rank", F.row_number().over(Window.partitionBy(*same).orderBy("id"))).where(F.col("rank") <= k + 1)
    leaders = first.groupBy(*same).agg(F.max("id").alias("leader"))
    return hot.join(leaders, same).where("id > leader").select("type", "id", "leader")


def neighbours(elements: DataFrame, k: int = 5, least: float = 0.76, dimension: int = 96, sure: float = 0.999, most_cells: int | None = MOST_CELLS) -> DataFrame:
    """The k most similar vectors of the same type of every vector: ``id``, ``near``, ``cos``, ``rank`` (from 1).

    ``elements``: ``id``, ``type``, ``vector``; other columns are ignored. Only cosines of at least ``least`` count
    (rounded to seven decimals; equal ones go to the smaller id). Rows with a null id or type and vectors that are
    null, of another length, all zero or not finite take no part; repeated rows count once; an empty table gives an
    empty result.

    The cells (see ``into_cells``; ``most_cells`` = None: as many as its test asks for) bring the cost of a query down from all rows to a few cells; inside a cell the
    neighbours are found by a kd-tree over stable projections. Shuffled are the vectors, once per cell they are in,
    and the best k of each cell. Large groups of copies are searched for once (see ``followers``).
    """
    vectors = usable(elements, dimension)
    scratch = Scratch(elements.sparkSession, "neighbours")
    copies = scratch.cut(followers(vectors, k), "copies")
    some = copies.limit(1).count() > 0
    if some:
        vectors = vectors.join(copies.select("type", "id"), ["type", "id"], "left_anti")
    centres = fit_centres(vectors, dimension)
    reach = math.sqrt(2 - 2 * least)
    cells, large = bounded_cells(into_cells(vectors, centres, dimension, reach, sure, most_cells), dimension, reach, sure, scratch, most_cells)
    tasks = pair_blocks(cells, ["type", "cell"], "id", BLOCK_ROWS, large)

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["id", "part"]).sort_values("id", kind="stable")
        ids = pdf["id"].to_numpy(dtype=object)
        names = np.arange(len(ids))  # sorted: the order of the rows is the order of the ids
        x = unit(np.frombuffer(b"".join(pdf["v"]), dtype="<f4").reshape(len(pdf), dimension))
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        part = pdf["part"].to_numpy()
        everyone = np.ones(len(ids), bool)
        runs = [(everyone, everyone)] if i == j else [(part == i, part == j), (part == j, part == i)]
        got = [cell_neighbours(names, x, k, least, sure, a, b) for a, b in runs]
        row, near, cos = (np.concatenate(g) for g in zip(*got, strict=True))
        return pd.DataFrame({"id": ids[row], "near": ids[near], "cos": cos})

    found = tasks.groupBy("type", "cell", "i", "j").applyInPandas(work, "id string, near string, cos double")
    best = found.groupBy("id").agg(F.slice(F.array_sort(F.collect_set(F.struct((-F.col("cos")).alias("far"), "near"))), 1, k).alias("b"))
    out = best.select("id", F.posexplode("b").alias("p", "e")).select("id", F.col("e.near").alias("near"), (-F.col("e.far")).alias("cos"), (F.col("p") + 1).alias("rank"))
    if not some:
        return out
    out = scratch.cut(out, "found")
    return out.unionByName(copies.join(out.withColumnRenamed("id", "leader"), "leader").select("id", "near", "cos", "rank"))


def neighbour_pairs(elements: DataFrame, **parameters) -> DataFrame:
    """``id_a`` < ``id_b`` where one is among the nearest of the other; see ``neighbours``."""
    near = neighbours(elements, **parameters)
    return near.select(F.least("id", "near").alias("id_a"), F.greatest("id", "near").alias("id_b")).distinct()

"""Cells for vector search: nearest cell centres, visited until a chi-square test holds."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.operators.blocks import BROADCAST_GROUPS, large_groups
from chronoloom.sources.tables import Scratch

#: Vectors that the centres of a type are fitted on, at most; every vector is indexed all the same.
SAMPLE_ROWS = 16_000
#: Rows of a type for each of its cells, as long as that gives no more than twice the square root of its rows.
ROWS_PER_CELL = 250
#: Cells that a vector is put into, at most.
MOST_CELLS = 5
#: A cell of more rows is split again by centres fitted on so many rows of its own; its rows meet them in parts of so many.
SPLIT_ABOVE = 40_000
SPLIT_SAMPLE = 8_000
SPLIT_ROWS = 20_000
#: Splits of a cell, at most, one below the other.
MOST_SPLITS = 6
#: Rows of a block; a cell of more is worked on in pairs of blocks.
BLOCK_ROWS = 4_000


def chi_square_quantile(dof: int, p: float) -> float:
    """By the Wilson-Hilferty approximation."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(p)
    return dof * (1 - 2 / (9 * dof) + z * math.sqrt(2 / (9 * dof))) ** 3


def usable(elements: DataFrame, dimension: int) -> DataFrame:
    """``id``, ``type``, ``v``: distinct rows with a vector of the dimension, finite and not all zero."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    kept = elements.select("id", "type", "vector").where("id is not null and type is not null and vector is not null").where((F.size("vector") == dimension) & ~bad & some)
    return kept


def _spherical_kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        order = np.argsort(near, kind="stable")
        first = np.flatnonzero(np.r_[True, near[order][1:] != near[order][:-1]])
        sums = np.add.reduceat(x[order], first)
        n = np.linalg.norm(sums, axis=1, keepdims=True)
        c[near[order][first]] = sums / np.where(n > 0, n, 1)
    return c


def unit(block: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length in double precision; huge and tiny values don't overflow."""
    b = block.astype(np.float64)
    b /= np.abs(b).max(axis=1, keepdims=True)
    return b / np.linalg.norm(b, axis=1, keepdims=True)


def fit_centres(vectors: DataFrame, dimension: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Cell centres of each type, fitted on a bounded sample of the type.

    The sample is the ``SAMPLE_ROWS`` rows with the smallest hash of their id, so neither the partitioning nor the
    sizes of other types matter.
    """
    counts = {r["type"]: r["n"] for r in vectors.groupBy("type").agg(F.count("*").alias("n")).collect()}
    h = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40))
    out = {}
    for kind, n in counts.items():
        # A tenth more than are needed (twelve standard deviations), so that the smallest ones are among them.
        low = vectors.where((F.col("type") == kind) & (h < int(min(1.0, 1.1 * SAMPLE_ROWS / n) * (1 << 40))))
        rows = low.select(h.alias("h"), "id", "vector").toArrow().sort_by([("h", "ascending"), ("id", "ascending")]).slice(0, SAMPLE_ROWS)
        x = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension) if rows.num_rows else np.ones((1, dimension))
        x = unit(x).astype(np.float32)
        out[kind] = _spherical_kmeans(x, max(1, min(len(x), n // ROWS_PER_CELL, int(2 * math.sqrt(n)))), 4, seed)
    return out


def border_limit(dimension: int, reach: float, sure: float) -> float:
    """How far beyond the border of a cell a neighbour within ``reach`` may be asked for: see ``into_cells``."""
    return math.sqrt(chi_square_quantile(1, sure) * reach * reach / dimension)


def _visited(x: np.ndarray, c: np.ndarray, limit: float, most: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the centres that they are put to: the nearest, and further ones whose border is within the limit."""
    scores = x @ c.T
    k = min(most or c.shape[0], c.shape[0])
    near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(scores, near, 1), axis=1, kind="stable"), 1)
    best = np.take_along_axis(scores, near, 1)
    gap = np.linalg.norm(c[near[:, :1]] - c[near], axis=2)
    border = np.where(gap > 0, (best[:, :1] - best) / np.where(gap > 0, gap, 1), 0)
    keep = border <= limit
    keep[:, 0] = True
    row, col = np.nonzero(keep)
    return row, near[row, col]


def into_cells(vectors: DataFrame, centres: dict[str, np.ndarray], dimension: int, reach: float, sure: float, most_cells: int | None = MOST_CELLS) -> DataFrame:
    """Each vector in its nearest cell and in further ones, until a chi-square test holds or ``most_cells`` are reached (None: only by the test).

    A neighbour at a distance of at most ``reach`` lies beyond the border to the next cell only if it differs by
    more than the vector's own distance to that border along one fixed direction. That difference, squared and in
    units of ``reach``² / ``dimension``, is taken as chi-square with one degree of freedom; once it exceeds the
    quantile ``sure``, further cells aren't visited. Result: ``type``, ``cell``, ``id``, ``v`` (the vector as it is,
    float32 bytes: scaling it first would cost the seventh decimal), and ``count`` if ``vectors`` has it.
    """
    spark = vectors.sparkSession
    shipped = spark.sparkContext.broadcast(centres)
    limit = border_limit(dimension, reach, sure)
    schema = T.StructType([T.StructField("type", T.StringType()), T.StructField("cell", T.StringType()), T.StructField("id", T.StringType()), T.StructField("v", T.BinaryType())])
    if counted := "count" in vectors.columns:
        schema = schema.add("count", T.DoubleType())

    def assign(batches):
        for batch in batches:
            kinds = np.array(batch.column("type").to_pylist(), dtype=object)
            ids = batch.column("id")
            vec = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            for kind in dict.fromkeys(kinds.tolist()):
                at = np.flatnonzero(kinds == kind)
                for i in range(0, len(at), 4096):
                    part = at[i : i + 4096]
                    x = unit(vec[part]).astype(np.float32)
                    c = shipped.value[kind]
                    row, cell = _visited(x, c, limit, most_cells)
                    raw = vec[part[row]].astype("<f4").tobytes()
                    step = 4 * dimension
                    at_rows = pa.array(part[row])
                    own = [pa.array([kind] * len(row), pa.string()), pa.array(cell.astype(str).tolist(), pa.string()), ids.take(at_rows), pa.array([raw[j * step : (j + 1) * step] for j in range(len(row))], pa.binary())]
                    if counted:
                        own.append(batch.column("count").take(at_rows))
                    yield pa.record_batch(own, names=schema.names)

    return vectors.select("type", "id", "vector", *["count"] * counted).mapInArrow(assign, schema)


def bounded_cells(cells: DataFrame, dimension: int, reach: float, sure: float, scratch: Scratch, most_cells: int | None = MOST_CELLS) -> tuple[DataFrame, DataFrame]:
    """Cells of bounded size, and those that are still larger than a block, with their sizes (see ``blocks.large_groups``).

    The number of centres that can be fitted and shipped at once is bounded, so with the data the cells grow. A cell of more than
    ``SPLIT_ABOVE`` rows is split by centres fitted on a bounded sample of its own rows, in a task for each cell; its
    rows meet them in bounded parts and go to the nearest and, by the same test, to further ones; and so on. What
    ``MOST_SPLITS`` splits leave (vectors hardly apart) is worked on in pairs of blocks, like every cell above a block.
    """
    limit = border_limit(dimension, reach, sure)
    done = None
    for level in range(MOST_SPLITS + 1):
        sizes = scratch.cut(large_groups(cells, ["type", "cell"], BLOCK_ROWS), "sizes")
        hot = sizes.where(F.col("_rows") > SPLIT_ABOVE)
        if level == MOST_SPLITS or not hot.limit(1).count():
            break
        hot = F.broadcast(hot) if hot.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else hot
        fine = cells.join(hot.select("type", "cell"), ["type", "cell"], "left_anti")
        done = [*(done or []), (fine, sizes.where(F.col("_rows") <= SPLIT_ABOVE))]
        cells = scratch.cut(_split(cells.join(hot, ["type", "cell"]), cells.schema, cells.columns, dimension, limit, most_cells, level), "cells")
    for fine, large in done or []:
        cells, sizes = cells.unionByName(fine), sizes.unionByName(large)
    return cells, sizes


def _split(rows: DataFrame, schema: T.StructType, names: list[str], dimension: int, limit: float, most_cells: int | None, seed: int) -> DataFrame:
    unit_of = lambda v: unit(np.frombuffer(b"".join(v), dtype="<f4").reshape(len(v), dimension)).astype(np.float32)
    low = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < F.lit(SPLIT_SAMPLE * (1 << 30)) / F.col("_rows")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x, n = unit_of(pdf.sort_values("id", kind="stable")["v"]), int(pdf["_rows"].iloc[0])
        c = _spherical_kmeans(x, max(1, min(len(x), max(2, n // ROWS_PER_CELL), int(2 * math.sqrt(n)))), 4, seed)
        return pd.DataFrame({"type": pdf["type"].iloc[0], "cell": pdf["cell"].iloc[0], "_centres": [c.astype("<f4").tobytes()], "_parts": -(-n // SPLIT_ROWS)})

    fitted = rows.where(low).groupBy("type", "cell").applyInPandas(fit, "type string, cell string, _centres binary, _parts long")
    fitted = fitted.select("type", "cell", "_centres", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    parted = rows.select(*names, F.pmod(F.xxhash64("id"), F.ceil(F.col("_rows") / SPLIT_ROWS)).alias("_part"))

    def assign(pdf: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        own = pdf.drop(columns="_part").reset_index(drop=True)
        if not len(own) or not len(centres):
            return own
        c = np.frombuffer(centres["_centres"].iloc[0], dtype="<f4").reshape(-1, dimension)
        row, cell = _visited(unit_of(own["v"]), c, limit, most_cells)
        out = own.iloc[row].reset_index(drop=True)
        return out.assign(cell=[f"{a}.{b}" for a, b in zip(out["cell"], cell, strict=True)])

    return parted.groupBy("type", "cell", "_part").cogroup(fitted.groupBy("type", "cell", "_part")).applyInPandas(assign, schema)

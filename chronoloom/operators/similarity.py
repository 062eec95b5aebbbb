"""Searches, neighbour graphs and figures of groups of vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.functions.vectors import dot
from chronoloom.operators.blocks import pair_blocks
from chronoloom.sources.tables import Scratch

#: Query vectors that are broadcast at once.
QUERY_BLOCK = 8_192
#: Percentiles of a distribution of scores, and bins that scores are counted in.
PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
BINS = 1 << 15
#: Rows of a block in work on pairs.
BLOCK_ROWS = 4_096
#: Of blocks of neighbouring vectors: centres fitted at once and levels at most; rows that the centres of a split are fitted on, and of a part that meets them.
MOST_CENTRES = 1_024
MOST_LEVELS = 8
SPLIT_SAMPLE = 4_000
SPLIT_ROWS = 20_000


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column]) if len(column) else np.zeros((0, 0))


def unit_rows(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n > 0, n, 1)


def query_blocks(queries: DataFrame) -> list[tuple[list, np.ndarray]]:
    """The stated query set in blocks of bounded size, by a hash of the id."""
    n = queries.count()
    parts = -(-n // (QUERY_BLOCK // 2)) if n > QUERY_BLOCK else 1
    out = []
    for b in range(parts):
        rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == b).select("id", "vector").collect()
        if rows:
            out.append(([r["id"] for r in rows], unit_rows(_matrix([r["vector"] for r in rows]))))
    return out


def search(queries: DataFrame, rows: DataFrame, k: int, least: float = -1.0, by_best: bool = False) -> DataFrame:
    """The k rows most similar to every query: ``query``, ``id``, ``score`` (cosine), ``rank``; equal scores go to the smaller id.

    ``queries`` and ``rows``: ``id``, ``vector`` of one dimension. Rows with the query's own id don't count unless
    ``by_best`` is set, which takes the best score of each id. The query set is broadcast in bounded blocks; every
    task keeps its best k (all of an id's with ``by_best``) and only those are shuffled.
    """
    spark = rows.sparkSession
    kind = queries.schema["id"].dataType.simpleString()
    own = rows.schema["id"].dataType.simpleString()
    found = None
    for ids, matrix in query_blocks(queries):
        shipped = spark.sparkContext.broadcast((np.array(ids, dtype=object), matrix))

        def run(frames, shipped=shipped):
            names, q = shipped.value
            for pdf in frames:
                if not len(pdf):
                    continue
                m = unit_rows(_matrix(pdf["vector"]))
                near = pdf["id"].to_numpy(dtype=object)
                s = np.round(q @ m.T, 9)
                if by_best:  # the best row of each id
                    order = np.argsort(near, kind="stable")
                    edge = np.flatnonzero(np.r_[True, near[order][1:] != near[order][:-1]])
                    near, s = near[order][edge], np.maximum.reduceat(s[:, order], edge, axis=1)
                else:
                    s[names[:, None] == near[None, :]] = -np.inf
                if s.shape[1] > k:
                    # Ties with the k-th are kept too: which of them counts is for the order of the ids.
                    bound = -np.partition(-s, k - 1, axis=1)[:, k - 1 : k]
                    a, b = np.nonzero((s >= np.maximum(bound, least)))
                else:
                    a, b = np.nonzero(s >= least)
                out = pd.DataFrame({"query": names[a], "id": near[b], "score": s[a, b]})
                out = out.sort_values(["query", "score", "id"], ascending=[True, False, True], kind="stable")
                yield out.groupby("query").head(k)

        part = rows.select("id", "vector").mapInPandas(run, f"query {kind}, id {own}, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.lit(None).cast(kind).alias("query"), "id", F.lit(0.0).alias("score"), F.lit(1).alias("rank")).where("false")
    best = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)


def scores(queries: DataFrame, rows: DataFrame, own: bool = False) -> DataFrame:
    """The cosine of every query of a stated set with every other row: ``query``, ``id``, ``score``; with ``own`` also with the rows of its own id."""
    spark = rows.sparkSession
    kind = queries.schema["id"].dataType.simpleString()
    found = None
    for ids, matrix in query_blocks(queries):
        shipped = spark.sparkContext.broadcast((np.array(ids, dtype=object), matrix))

        def run(frames, shipped=shipped):
            names, q = shipped.value
            for pdf in frames:
                if len(pdf):
                    s = q @ unit_rows(_matrix(pdf["vector"])).T
                    a, b = np.nonzero((names[:, None] != pdf["id"].to_numpy(dtype=object)[None, :]) | own)
                    yield pd.DataFrame({"query": names[a], "id": pdf["id"].to_numpy(dtype=object)[b], "score": s[a, b]})

        part = rows.select("id", "vector").mapInPandas(run, f"query {kind}, id {kind}, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.lit(None).cast(kind).alias("query"), "id", F.lit(0.0).alias("score")).where("false")
    return found


def distribution(scored: DataFrame) -> DataFrame:
    """Number, least, mean, percentiles and greatest of ``score``, to six decimals; for scores of one row per query."""
    p = F.percentile("score", F.array(*[F.lit(x) for x in PERCENTILES]))
    one = scored.agg(F.count("*").alias("pairs"), F.min("score").alias("least"), F.avg("score").alias("mean"), F.max("score").alias("most"), p.alias("p"))
    named = [F.round(F.col("p")[i], 6).alias(f"p{100 * x:.0f}") for i, x in enumerate(PERCENTILES)]
    return one.select("pairs", F.round("least", 6).alias("least"), F.round("mean", 6).alias("mean"), F.round("most", 6).alias("most"), *named)


def _score_bins(queries: list[tuple[list, np.ndarray]], rows: DataFrame, low: list[float], width: float) -> dict[tuple[int, int], tuple]:
    """Cosines of the queries with other rows counted in bins: for each range of ``BINS`` bins from ``low`` on number, sum, least and greatest by bin."""
    spark, out = rows.sparkSession, {}
    for ids, matrix in queries:
        shipped = spark.sparkContext.broadcast((np.array(ids, dtype=object), matrix, np.array(low)))

        def run(frames, shipped=shipped):
            names, q, begin = shipped.value
            shape = (len(begin), BINS)
            n, total, least, most = np.zeros(shape, np.int64), np.zeros(shape), np.full(shape, np.inf), np.full(shape, -np.inf)
            for pdf in frames:
                if not len(pdf):
                    continue
                s = (q @ unit_rows(_matrix(pdf["vector"])).T)[names[:, None] != pdf["id"].to_numpy(dtype=object)[None, :]]
                for r, b in enumerate(begin):
                    at = np.floor((s - b) / width).astype(np.int64)
                    inside = (at >= 0) & (at < BINS)
                    at, x = at[inside], s[inside]
                    n[r] += np.bincount(at, minlength=BINS)
                    total[r] += np.bincount(at, x, BINS)
                    np.minimum.at(least[r], at, x)
                    np.maximum.at(most[r], at, x)
            r, at = np.nonzero(n)
            yield pd.DataFrame({"r": r, "bin": at, "n": n[r, at], "total": total[r, at], "least": least[r, at], "most": most[r, at]})

        parts = rows.select("id", "vector").mapInPandas(run, "r int, bin int, n long, total double, least double, most double")
        for x in parts.groupBy("r", "bin").agg(F.sum("n"), F.sum("total"), F.min("least"), F.max("most")).collect():
            n, total, least, most = out.get((x[0], x[1]), (0, 0.0, np.inf, -np.inf))
            out[x[0], x[1]] = (n + x[2], total + x[3], min(least, x[4]), max(most, x[5]))
    return out


def score_distribution(queries: DataFrame, rows: DataFrame) -> DataFrame:
    """``distribution`` of the cosines of a stated query set with all other rows, without writing a pair.

    Two passes count the cosines in bins, the second one only those of the bins that hold the percentiles; two levels
    of ``BINS`` bins tell cosines apart that differ by 1e-9. What reaches the driver are bins, at most ``BINS`` for
    each percentile's two ranks.
    """
    spark, blocks = rows.sparkSession, query_blocks(queries)
    names = ["pairs", "least", "mean", "most", *(f"p{100 * x:.0f}" for x in PERCENTILES)]
    kind = "pairs long, " + ", ".join(f"{c} double" for c in names[1:])
    low, width = -1.0 - 1e-6, (2.0 + 2e-6) / BINS
    first = _score_bins(blocks, rows, [low], width)
    pairs = sum(x[0] for x in first.values())
    if not pairs:
        return spark.createDataFrame([(0, *[None] * (len(names) - 1))], kind)
    ranks = sorted({r for p in PERCENTILES for r in (int(np.floor(p * (pairs - 1))), int(np.ceil(p * (pairs - 1))))})

    def holding(bins: dict[int, tuple], rank: int) -> tuple[int, int]:
        """The bin with the value of a rank, and how many values lie before it."""
        before = 0
        for b in sorted(bins):
            if rank < before + bins[b][0]:
                return b, before
            before += bins[b][0]
        raise AssertionError("a rank beyond all values")

    whole = {b: x for (_, b), x in first.items()}
    places = {r: holding(whole, r) for r in ranks}
    wanted = sorted({b for b, _ in places.values()})
    fine = _score_bins(blocks, rows, [low + b * width for b in wanted], width / BINS)
    inside: dict[int, dict[int, tuple]] = {}
    for (i, b), x in fine.items():
        inside.setdefault(wanted[i], {})[b] = x
    value = {}
    for r, (b, before) in places.items():
        # A value on the edge of a bin may be counted on its other side: the last bin then holds it.
        bins, left = inside[b], r - before
        left = min(left, sum(x[0] for x in bins.values()) - 1)
        x = bins[holding(bins, left)[0]]
        value[r] = x[1] / x[0]
    at = [p * (pairs - 1) for p in PERCENTILES]
    shares = [value[int(np.floor(a))] + (a - np.floor(a)) * (value[int(np.ceil(a))] - value[int(np.floor(a))]) for a in at]
    figures = [min(x[2] for x in whole.values()), sum(x[1] for x in whole.values()) / pairs, max(x[3] for x in whole.values()), *shares]
    return spark.createDataFrame([(pairs, *(round(float(x), 6) for x in figures))], kind)


def group_neighbours(rows: DataFrame, group: str, k: int, least: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k nearest rows of the same group from a cosine of ``least`` on: ``id``, ``near``, ``score``.

    ``rows``: ``id``, the group, ``vector``. Groups are worked on in pairs of bounded blocks, each of which gives its
    best k per row; equal scores (nine decimals) go to the smaller id.
    """
    kind = rows.schema["id"].dataType.simpleString()
    tasks = pair_blocks(rows.select(group, "id", "vector"), [group], "id", block_rows)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        ids, part, u = pdf["id"].to_numpy(dtype=object), pdf["part"].to_numpy(), unit_rows(_matrix(pdf["vector"]))
        outs = []
        for asking, answering in [(part == i, part == j)] if i == j else [(part == i, part == j), (part == j, part == i)]:
            s = np.round(u[asking] @ u[answering].T, 9)
            a, b = np.nonzero(s >= least)
            out = pd.DataFrame({"id": ids[asking][a], "near": ids[answering][b], "score": s[a, b]})
            out = out[out["id"] != out["near"]].sort_values(["id", "score", "near"], ascending=[True, False, True], kind="stable")
            outs.append(out.groupby("id").head(k))
        return pd.concat(outs)

    found = tasks.groupBy(group, "i", "j").applyInPandas(run, f"id {kind}, near {kind}, score double")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "near"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("id", "near", "score")


def mutual_edges(near: DataFrame) -> DataFrame:
    """Pairs that are in each other's lists, with a positive weight: ``source`` < ``target``, ``weight``."""
    back = near.select(F.col("near").alias("id"), F.col("id").alias("near"))
    return near.where("id < near and score > 0").join(back, ["id", "near"], "left_semi").select(F.col("id").alias("source"), F.col("near").alias("target"), F.round("score", 6).alias("weight"))


def group_figures(rows: DataFrame, group: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Size and mean, least and greatest pairwise cosine of every group, to six decimals (1 for a single row).

    The pairs are never written out: every pair of blocks gives its sum, least and greatest.
    """
    kind = rows.schema[group].dataType.simpleString()
    tasks = pair_blocks(rows.select(group, "id", "vector"), [group], "id", block_rows)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        part, u = pdf["part"].to_numpy(), unit_rows(_matrix(pdf["vector"]))
        s = u[part == i] @ u[part == j].T
        values = s[np.triu_indices(len(s), 1)] if i == j else s.ravel()
        size = int((part == i).sum()) if i == j else 0
        low, high = (float(values.min()), float(values.max())) if len(values) else (None, None)
        return pd.DataFrame({"g": [pdf[group].iloc[0]], "size": [size], "pairs": [len(values)], "total": [float(values.sum())], "low": [low], "high": [high]})

    parts = tasks.groupBy(group, "i", "j").applyInPandas(run, f"g {kind}, size long, pairs long, total double, low double, high double")
    one = parts.groupBy(F.col("g").alias(group)).agg(F.sum("size").alias("size"), F.sum("total").alias("total"), F.sum("pairs").alias("pairs"), F.min("low").alias("low"), F.max("high").alias("high"))
    mean = F.when(F.col("pairs") > 0, F.col("total") / F.col("pairs")).otherwise(F.lit(1.0))
    return one.select(group, "size", F.round(mean, 6).alias("avg_similarity"), F.round(F.coalesce("low", F.lit(1.0)), 6).alias("min_similarity"), F.round(F.coalesce("high", F.lit(1.0)), 6).alias("max_similarity"))


def centroids(rows: DataFrame, group: str, dimension: int) -> DataFrame:
    """The sum of the unit vectors ``u`` of every group and its size: ``total``, ``size``."""
    return rows.groupBy(group).agg(F.array(*[F.sum(F.col("u")[i]) for i in range(dimension)]).alias("total"), F.count("*").alias("size"))


def medoids(rows: DataFrame, group: str, dimension: int) -> DataFrame:
    """The row with the highest mean cosine to its peers: the group, ``id``, ``mean_similarity``; equal ones go to the smaller id.

    ``rows``: ``id``, the group, ``u`` (unit). The mean follows from the group's sum of vectors, without any pairs.
    """
    rows = rows.select("id", group, "u")
    both = rows.join(centroids(rows, group, dimension), group)
    mean = F.when(F.col("size") > 1, (dot(F.col("u"), F.col("total")) - dot(F.col("u"), F.col("u"))) / (F.col("size") - 1)).otherwise(F.lit(1.0))
    scored = both.select(group, "id", F.round(mean, 6).alias("mean_similarity"))
    best = scored.groupBy(group).agg(F.max_by(F.struct("id", "mean_similarity"), F.struct("mean_similarity", (-F.col("id")).alias("first"))).alias("b"))
    return best.select(group, "b.id", "b.mean_similarity")


def same_vectors(rows: DataFrame, keys: tuple[str, ...] = (), prefer: Column | None = None) -> DataFrame:
    """Copies of vectors: ``id`` and the ``leader``, another row with the very same vector (and ``keys``); leaders themselves don't come out.

    The leader is the row with the smallest id, or the one that ``prefer`` orders last. Vectors are told by 96 bits of
    hashes. The leaders are aggregated partially, and a leader's rows joined by AQE's split of hot keys, so any share
    of the rows may be copies.
    """
    order = prefer if prefer is not None else F.lit(0)
    named = rows.select("id", *keys, order.alias("_order"), F.xxhash64("vector").alias("h1"), F.hash("vector").alias("h2")).distinct()
    leader = F.min("id") if prefer is None else F.max_by("id", F.struct("_order", "id"))
    first = named.groupBy(*keys, "h1", "h2").agg(leader.alias("leader"), F.count("*").alias("copies")).where(F.col("copies") > 1).drop("copies")
    return named.join(first, [*keys, "h1", "h2"]).where("id <> leader").select(*keys, "id", "leader")


def _centres(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(8):
        near = (x @ c.T).argmax(1)
        for j in range(len(c)):
            mine = x[near == j]
            if len(mine):
                c[j] = mine.mean(0) / max(1e-12, np.linalg.norm(mine.mean(0)))
    return c


def vector_blocks(rows: DataFrame, block_size: int = 128, seed: int = 13, most_sample: int = 16_000, scratch: Scratch | None = None) -> DataFrame:
    """Adds ``block``: spherical k-means with rows / block_size centres, fitted on a bounded sample, then all rows assigned.

    There are at most ``MOST_CENTRES`` centres at once. A block that still holds more than four times ``block_size`` rows is split
    again in the same way, by centres fitted on a sample of its own rows and on as many levels as it takes; its rows
    meet their centres in bounded parts. Only what ``MOST_LEVELS`` levels can't part (vectors of the same direction; see
    ``same_vectors`` to put them together first) is cut by a hash of the id, so that whatever works on a block has a
    bounded group.
    """
    spark = rows.sparkSession
    n, limit = rows.count(), 4 * block_size
    if n <= block_size:
        return rows.withColumn("block", F.lit("0"))
    sample = rows.orderBy(F.xxhash64("id", F.lit(seed))).limit(most_sample).select("vector").collect()
    shipped = spark.sparkContext.broadcast(_centres(unit_rows(_matrix([r["vector"] for r in sample])), min(-(-n // block_size), MOST_CENTRES), seed))

    def assign(frames):
        for pdf in frames:
            if len(pdf):
                yield pdf.assign(block=(unit_rows(_matrix(pdf["vector"])) @ shipped.value.T).argmax(1).astype(str))
            else:
                yield pdf.assign(block=pd.Series(dtype=str))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", block string"
    placed = rows.mapInPandas(assign, schema)
    scratch = scratch or Scratch(spark, "blocks")
    done = None
    for level in range(MOST_LEVELS):
        placed = scratch.cut(placed, "placed")
        sizes = scratch.cut(placed.groupBy("block").agg(F.count("*").alias("_n")).where(F.col("_n") > limit), "sizes")
        if not sizes.limit(1).count():
            return placed if done is None else done.unionByName(placed)
        fine = placed.join(sizes, "block", "left_anti")
        done = fine if done is None else done.unionByName(fine)
        placed = _split(placed.join(sizes, "block"), placed.columns, block_size, seed + level, schema)
    placed = scratch.cut(placed, "placed")
    sizes = placed.groupBy("block").agg(F.count("*").alias("_n"))
    cut = placed.join(sizes, "block").withColumn("block", F.concat_ws(".", "block", F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / limit))))
    return done.unionByName(cut.select(placed.columns))


def _split(rows: DataFrame, names: list[str], block_size: int, seed: int, schema: str) -> DataFrame:
    """Blocks (``_n``: their rows) parted by centres of their own."""
    low = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < F.lit(SPLIT_SAMPLE * (1 << 30)) / F.col("_n")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit_rows(_matrix(pdf.sort_values("id", kind="stable")["vector"]))
        c = _centres(x, int(min(64, max(2, -(-pdf["_n"].iloc[0] // block_size)))), seed)
        return pd.DataFrame({"block": pdf["block"].iloc[0], "_centre": list(c), "_parts": -(-pdf["_n"].iloc[0] // SPLIT_ROWS)})

    # Each bounded part of a block gets its centres.
    centres = rows.where(low).select("block", "id", "vector", "_n").groupBy("block").applyInPandas(fit, "block string, _centre array<double>, _parts long")
    centres = centres.select("block", "_centre", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    parted = rows.withColumn("_part", F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / SPLIT_ROWS)))

    def assign(pdf: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        own = pdf.drop(columns=["_n", "_part"])
        near = (unit_rows(_matrix(own["vector"])) @ np.stack(c["_centre"]).T).argmax(1) if len(own) and len(c) else np.zeros(len(own), int)
        return own.assign(block=[f"{b}.{i}" for b, i in zip(own["block"], near, strict=True)])

    return parted.select(*names, "_n", "_part").groupBy("block", "_part").cogroup(centres.groupBy("block", "_part")).applyInPandas(assign, schema)

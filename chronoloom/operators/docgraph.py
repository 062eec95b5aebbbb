"""The time-directed similarity graph of documents."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.text import collect_sentences
from chronoloom.operators.ranking import distributed_rank
from chronoloom.sources.tables import Scratch

#: Dimensions of the stand-in embedding.
DIMENSION = 64


def hashed_vector(text: str, dimension: int = DIMENSION) -> list[float]:
    """The offline stand-in for an embedding: signed counts of hashed pairs of neighbouring signs, scaled to length 1."""
    code = np.frombuffer((text or " ").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    right = code[1:] if len(code) > 1 else code
    with np.errstate(over="ignore"):
        h = (code[: len(right)] * np.uint64(0x9E3779B97F4A7C15)) ^ (right * np.uint64(0xC2B2AE3D27D4EB4F))
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
    v = np.bincount((h % np.uint64(dimension)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0), dimension)
    n = np.linalg.norm(v)
    return (v / n if n else v).tolist()


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def hashed(texts: pd.Series) -> pd.Series:
    """``hashed_vector`` for a column, distinct texts of a batch once each."""
    known = {t: hashed_vector(t) for t in texts.dropna().unique()}
    return texts.map(known).where(texts.notna(), None)


def sentence_vectors(news: DataFrame, embed=hashed_vector) -> DataFrame:
    """Unit vectors of a document's plain sentences: ``doc_id``, ``n`` (from 0), ``vector``; distinct sentences of a batch are embedded once."""
    rows = news.select("doc_id", F.posexplode(collect_sentences(F.col("normalized_text"))).alias("n", "sentence"))

    def run(frames):
        for pdf in frames:
            known = {s: embed(s) for s in pdf["sentence"].unique()}
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": pdf["n"], "vector": pdf["sentence"].map(known)})

    return rows.mapInPandas(run, "doc_id string, n int, vector array<double>")


def means(vectors: DataFrame, dimension: int) -> DataFrame:
    """The mean of a document's sentence vectors and their number: ``doc_id``, ``mean``, ``sentences``."""
    return vectors.groupBy("doc_id").agg(F.array(*[F.avg(F.col("vector")[i]) for i in range(dimension)]).alias("mean"), F.count("*").alias("sentences"))


def edges(anchors: DataFrame, candidates: DataFrame, least: float, most: int | None = None) -> DataFrame:
    """Edges from earlier documents to the anchors: ``source``, ``target``, ``weight`` (six decimals).

    ``anchors``: ``doc_id``, ``ord`` (day number), ``vectors`` (array of unit vectors), a stated set, broadcast in
    bounded blocks; ``candidates``: ``doc_id``, ``ord``, ``mean``. A candidate counts if it ends no later than the
    anchor (on the same day both ways) and isn't the anchor. The weight is the greatest, over the anchor's
    sentences, of the mean cosine with the candidate's sentences; as the mean of products is the product with the
    mean, one vector per candidate does. Edges below ``least`` are dropped in the task; ``most`` keeps the heaviest
    of each target. Documents without a day have no edges.
    """
    spark = candidates.sparkSession
    kind = candidates.schema["doc_id"].dataType.simpleString()
    stated = anchors.where("ord is not null")
    n = stated.count()
    parts = max(1, -(-n // 2_000))
    found = None
    for b in range(parts):
        rows = stated.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == b).select("doc_id", "ord", "vectors").collect()
        if not rows:
            continue
        ids = np.array([r["doc_id"] for r in rows], dtype=object)
        days = np.array([r["ord"] for r in rows])
        owner = np.repeat(np.arange(len(rows)), [len(r["vectors"]) for r in rows])
        matrix = np.array([v for r in rows for v in r["vectors"]], dtype=np.float64)
        shipped = spark.sparkContext.broadcast((ids, days, owner, matrix))

        def run(frames, shipped=shipped):
            names, ends, belongs, m = shipped.value
            first = np.flatnonzero(np.r_[True, belongs[1:] != belongs[:-1]])
            for pdf in frames:
                if not len(pdf):
                    continue
                s = m @ np.stack([np.asarray(v, dtype=np.float64) for v in pdf["mean"]]).T
                w = np.full((len(names), len(pdf)), -np.inf)
                w[belongs[first]] = np.maximum.reduceat(s, first, axis=0)
                near = pdf["doc_id"].to_numpy(dtype=object)
                ok = (pdf["ord"].to_numpy()[None, :] <= ends[:, None]) & (near[None, :] != names[:, None]) & (w >= least)
                a, c = np.nonzero(ok)
                yield pd.DataFrame({"source": near[c], "target": names[a], "weight": w[a, c]})

        part = candidates.where("ord is not null").select("doc_id", "ord", "mean").mapInPandas(run, f"source {kind}, target {kind}, weight double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return candidates.select(F.col("doc_id").alias("source"), F.col("doc_id").alias("target"), F.lit(0.0).alias("weight")).where("false")
    out = found.withColumn("weight", F.round("weight", 6))
    if most is None:
        return out
    rank = F.row_number().over(Window.partitionBy("target").orderBy(F.desc("weight"), "source"))
    return out.withColumn("rank", rank).where(F.col("rank") <= most).drop("rank")


def day_number(c):
    """Days since 0001-01-01, the first being 1."""
    return F.datediff(c, F.lit("0001-01-01").cast("date")) + 1


def in_time_order(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Documents (``doc_id``, ``ord``) with their ``position``: by day, those without one last, then by id; a distributed rank."""
    return distributed_rank(nodes.select("doc_id", "ord").distinct(), [], [F.col("ord").isNull(), F.coalesce("ord", F.lit(0)), F.col("doc_id")], "position", scratch)

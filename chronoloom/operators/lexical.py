"""Lexical retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.functions.text import lexical_tokens
from chronoloom.operators.canonical import B, K1, bounded_broadcast
from chronoloom.sources.tables import Scratch


def term_frequencies(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``term``, ``tf`` of ``doc_id``, ``text``; null texts have no terms."""
    return documents.select("doc_id", F.explode(lexical_tokens(F.col("text"))).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def bm25(queries: DataFrame, documents: DataFrame, k: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """BM25 scores of documents for a stated set of queries: ``query_id``, ``doc_id``, ``score`` (six decimals), and ``rank`` with ``k``.

    ``queries``: ``query_id``, ``text``; ``documents``: ``doc_id``, ``text``. A query's term counts as often as it
    occurs; documents that share no term with a query don't come out; equal scores go to the smaller id. The
    documents are taken apart once; only the terms of the queries, counted per document, leave their side. A
    frequent term's rows are split by AQE or met by a broadcast.
    """
    scratch = scratch or Scratch(documents.sparkSession, "bm25")
    asked = scratch.cut(queries.select("query_id", F.explode(lexical_tokens(F.col("text"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times")), "asked")
    wanted = bounded_broadcast(asked.select("term").distinct())
    words = scratch.cut(documents.select("doc_id", F.coalesce(F.size(lexical_tokens(F.col("text"))), F.lit(0)).alias("len"), lexical_tokens(F.col("text")).alias("terms")), "words")
    total = words.agg(F.count("*").alias("n"), F.avg("len").alias("avg")).first()
    n, average = total["n"], max(1.0, total["avg"] or 1.0)
    tf = scratch.cut(words.select("doc_id", "len", F.explode("terms").alias("term")).join(wanted, "term").groupBy("doc_id", "len", "term").agg(F.count("*").alias("tf")), "tf")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    terms = bounded_broadcast(scratch.cut(asked.join(df, "term").select("query_id", "term", "times", weight.alias("idf")), "weights"))
    length = F.when(F.col("len") > 0, F.col("len")).otherwise(1)
    part = F.col("times") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * length / average))
    scored = tf.join(terms, "term").groupBy("query_id", "doc_id").agg(F.round(F.sum(part), 6).alias("score"))
    if k is None:
        return scored
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def min_max(score: str, low: str, high: str):
    """Scores of a group scaled to 0..1; if all are equal 1 where they are positive, else 0."""
    return F.when(F.col(high) > F.col(low), (F.col(score) - F.col(low)) / (F.col(high) - F.col(low))).when(F.col(high) > 0, 1.0).otherwise(0.0)


def hybrid(vector_scores: DataFrame, lexical_scores: DataFrame, lexical_weight: float, k: int) -> DataFrame:
    """Both scores of a query's documents scaled and weighted: ``query_id``, ``doc_id``, ``score``, ``rank``; a missing one is 0.

    Scores are scaled over all documents that a query has on either side, so one side should hold every document.
    Least and greatest are summed up per partition, and the limit of the rank works before its shuffle: a query's
    documents are never gathered in one task.
    """
    w = min(1.0, max(0.0, lexical_weight))
    both = vector_scores.select("query_id", "doc_id", F.col("score").alias("v")).join(lexical_scores.select("query_id", "doc_id", F.col("score").alias("b")), ["query_id", "doc_id"], "full")
    both = both.fillna(0.0, ["v", "b"])
    ends = both.groupBy("query_id").agg(F.min("v").alias("v0"), F.max("v").alias("v1"), F.min("b").alias("b0"), F.max("b").alias("b1"))
    mixed = both.join(ends, "query_id").select("query_id", "doc_id", F.round((1 - w) * min_max("v", "v0", "v1") + w * min_max("b", "b0", "b1"), 6).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return mixed.withColumn("rank", rank).where(F.col("rank") <= k)

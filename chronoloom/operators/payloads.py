"""Nested JSON documents edited by the ids of tuples, and context windows around sentences."""

from __future__ import annotations

import json
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.text import is_blank, token_estimate

#: The fields that name a tuple.
TRACED = ("tuple_id", "raw_id", "sent_id")
# A value of which there is one in every process.
_GONE = ...


def _named(node: dict, lists: bool) -> list[str]:
    out = []
    for f in TRACED:
        v = node.get(f)
        out += [v] if isinstance(v, str) else [x for x in v if isinstance(x, str)] if lists and isinstance(v, list) else []
    return out


def prune(node, ids: set[str]):
    """A JSON value without the objects that name one of the ids."""
    if isinstance(node, dict):
        if ids.intersection(_named(node, True)):
            return _GONE
        kept = ((k, prune(v, ids)) for k, v in node.items())
        return {k: v for k, v in kept if v is not _GONE}
    if isinstance(node, list):
        return [v for v in (prune(x, ids) for x in node) if v is not _GONE]
    return node


def retime(node, times: dict[str, str]):
    """A JSON value whose objects that name an id have its time, where they have one as text."""
    if isinstance(node, dict):
        hit = next((i for i in _named(node, False) if i in times), None)
        return {k: times[hit] if k == "time" and hit is not None and isinstance(v, str) else retime(v, times) for k, v in node.items()}
    if isinstance(node, list):
        return [retime(x, times) for x in node]
    return node


def _with_hits(payloads: DataFrame, key: str, column: str, edits: DataFrame) -> DataFrame:
    """Every payload with the edits (``tuple_id``, ``put``) that it names: no set of all ids is sent anywhere."""
    named = payloads.select(key, F.explode(F.array_distinct(F.regexp_extract_all(column, F.lit('"((?:[^"\\\\]|\\\\.)*)"'), F.lit(1)))).alias("tuple_id"))
    hits = named.join(edits, "tuple_id").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("tuple_id", "put"))).alias("_edits"))
    return payloads.join(hits, key, "left")


def _edited(rows: DataFrame, key: str, column: str, edit) -> DataFrame:
    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series, edits: pd.Series) -> pd.Series:
        out = []
        for t, e in zip(texts, edits, strict=True):
            e = dict(e) if e is not None else {}
            if t is None or not e:
                out.append(t)
                continue
            node = edit(json.loads(t), e)
            out.append(None if node is _GONE else json.dumps(node, ensure_ascii=False))
        return pd.Series(out, dtype=object)

    return rows.withColumn(column, run(F.col(column), F.col("_edits"))).drop("_edits")


def pruned_payloads(payloads: DataFrame, key: str, column: str, gone: DataFrame) -> DataFrame:
    """JSON payloads without the objects that name a ``tuple_id`` of ``gone``; a payload that is such an object becomes null."""
    edits = gone.select("tuple_id").distinct().withColumn("put", F.lit(""))
    return _edited(_with_hits(payloads, key, column, edits), key, column, lambda node, e: prune(node, set(e)))


def retimed_payloads(payloads: DataFrame, key: str, column: str, times: DataFrame) -> DataFrame:
    """JSON payloads with new times: ``times`` has ``tuple_id`` and ``time``; of several times of one id the last by name holds."""
    edits = times.groupBy("tuple_id").agg(F.max("time").alias("put"))
    return _edited(_with_hits(payloads, key, column, edits), key, column, retime)


def _joined(lines: list[str]) -> str:
    return "\n".join(x for x in lines if x.strip())


def window_text(sentences: list[str], costs: list[int], centre: int, budget: int, reach: int) -> str:
    """The sentence with as many of its neighbours as the budget allows, one step to the left, one to the right, up to ``reach``."""
    if sum(costs) <= budget:
        return _joined(sentences)
    start = end = centre
    for step in range(1, max(1, reach) + 1):
        left, right = centre - step, centre + step
        if left >= 0 and sum(costs[left : end + 1]) <= budget:
            start = left
        if right < len(sentences) and sum(costs[start : right + 1]) <= budget:
            end = right
    return _joined(sentences[start : end + 1])


def context_windows(sentences: DataFrame, budget: int, reach: int) -> DataFrame:
    """``doc_id``, ``sentence_index`` and ``context`` for sentences (``doc_id``, ``sentence_index`` from 1, ``text``).

    A sentence's cost is its estimated tokens. A document whose total cost fits the budget is the context of each of its
    sentences. Of others only the neighbours within reach are brought together, by a join on shifted numbers, so only
    documents that the budget bounds are gathered.
    """
    rows = sentences.select("doc_id", "sentence_index", "text", token_estimate(F.col("text")).alias("cost"))
    total = rows.groupBy("doc_id").agg(F.sum("cost").alias("total"))
    near = rows.select("doc_id", F.explode(F.sequence(F.col("sentence_index") - reach, F.col("sentence_index") + reach)).alias("at"), "sentence_index", "text", "cost")
    around = near.groupBy("doc_id", "at").agg(F.array_sort(F.collect_list(F.struct("sentence_index", "text", "cost"))).alias("w"))
    short = rows.where(~is_blank(F.col("text"))).join(total.where(F.col("total") <= budget).select("doc_id"), "doc_id")
    full = short.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sentence_index", "text"))).alias("all")).select("doc_id", F.array_join("all.text", "\n").alias("full"))
    joined = rows.select("doc_id", F.col("sentence_index").alias("at")).join(around, ["doc_id", "at"]).join(total, "doc_id").join(full, "doc_id", "left")

    @F.pandas_udf(T.StringType())
    def pick(at: pd.Series, windows: pd.Series) -> pd.Series:
        out = []
        for a, w in zip(at, windows, strict=True):
            n = [x["sentence_index"] for x in w]
            out.append(window_text([x["text"] for x in w], [x["cost"] for x in w], n.index(a), budget, reach))
        return pd.Series(out, dtype=object)

    whole = F.col("total") <= budget
    return joined.select("doc_id", F.col("at").alias("sentence_index"), F.when(whole & F.col("full").isNotNull(), F.col("full")).otherwise(pick("at", "w")).alias("context"), whole.alias("whole_document_fits"))


def file_token(value) -> str:
    """A number or word as part of a file name: six decimals at most, minus as n, point as p."""
    text = format(Decimal(value).quantize(Decimal("0.000001")).normalize() + 0, "f") if isinstance(value, float) else str(value).strip()
    return (text or "0").translate(str.maketrans("-.", "np"))


def field_text(concept: Column, kind: Column, field: Column, content: Column) -> Column:
    """The four lines that a described field is embedded by."""
    return F.format_string("概念：%s\n概念类型：%s\n字段：%s\n内容：%s", concept, kind, field, content)

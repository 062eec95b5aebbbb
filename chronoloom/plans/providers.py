"""Stages answered by a language or embedding model, behind interfaces with offline stand-ins.

A stage is a table of requests (``custom_id``, ``payload`` as JSON); the answers (``custom_id``, ``response`` as JSON,
``error``) are checked, stored, and joined back. A real service is a provider with the same methods; the stand-ins are
deterministic and need no network.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.plans.stages import exists, incomplete, remaining
from chronoloom.sources.files import read_json_object, write_json_object

#: What replies may call the two actions of a normaliser.
ACTIONS = {"replace": ["replace", "reuse", "select", "替换", "复用", "选择"], "keep": ["keep", "retain", "new", "create", "保留", "新建", "创建"]}
#: Kinds of sentences and what replies may call them.
SENTENCE_TYPES = ["事件句", "混合句", "不抽取句"]
SENTENCE_ALIASES = {"事实事件": "事件句", "重要表态事件": "事件句", "计划事件": "事件句", "事实句": "事件句", "重要表态句": "事件句", "计划句": "事件句", "非事件句": "不抽取句", "无事件句": "不抽取句", "无需抽取句": "不抽取句"}
SENTENCE_HINTS = [("混合句", "混合"), ("不抽取句", "不抽取|无需抽取|无需提取|非事件|无事件"), ("事件句", "事件|表态|计划|事实")]


class Provider(Protocol):
    """Answers one payload; raises for errors of transport."""

    def answer(self, payload: dict) -> dict: ...


@dataclass
class Retrying:
    """Wraps a provider: retries with growing pauses, a least interval between calls, more room after cut answers."""

    inner: Provider
    retries: int = 3
    pause: float = 0.5
    interval: float = 0.0
    tokens: int = 1024
    most_tokens: int = 16384
    growths: int = 4
    sleep: Callable[[float], None] = time.sleep
    _last: float = field(default=float("-inf"))

    def answer(self, payload: dict) -> dict:
        tokens, grown, tries = self.tokens, 0, 0
        while True:
            wait = self._last + self.interval - time.monotonic()
            if wait > 0:
                self.sleep(wait)
            self._last = time.monotonic()
            try:
                reply = self.inner.answer({**payload, "max_tokens": tokens})
            except Exception as e:
                tries += 1
                if tries > self.retries:
                    raise
                self.sleep(float(getattr(e, "retry_after", 0) or self.pause * 2 ** (tries - 1)))
                continue
            if reply.get("cut") and grown < self.growths and tokens < self.most_tokens:
                tokens, grown = min(2 * tokens, self.most_tokens), grown + 1
                continue
            return reply


class Embedder(Protocol):
    """Vectors of a bounded list of texts, in order; raises for errors of transport."""

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class HashedEmbedder:
    """Stand-in for an embedding service: ``docgraph.hashed_vector``."""

    def embed(self, texts: list[str]) -> list[list[float]]:
        from chronoloom.operators.docgraph import hashed_vector

        return [hashed_vector(t) for t in texts]


def embedded(rows: DataFrame, make: Callable[[], Embedder], most: int = 64, retries: int = 3, pause: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``id``, ``vector``, ``error`` of rows with ``id`` and ``text``: batches of at most ``most`` distinct texts, retried with growing pauses.

    One embedder per task. A batch that fails for good, or whose answer has another number of vectors, gives an error
    for its rows, not a failure. Null texts have no vector and no error; a text that rows of a frame share is asked for once.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def answer(service: Embedder, texts: list[str]) -> tuple[list, str | None]:
        for attempt in range(retries + 1):
            try:
                got = service.embed(texts)
                if len(got) != len(texts):
                    raise ValueError(f"{len(got)} vectors for {len(texts)} texts")
                return got, None
            except Exception as e:  # noqa: BLE001
                if attempt == retries:
                    return [None] * len(texts), f"{type(e).__name__}: {e}"
                sleep(pause * 2**attempt)
        raise AssertionError

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = make()
        for pdf in frames:
            texts = pdf["text"].dropna().unique().tolist()
            vector, error = {}, {}
            for i in range(0, len(texts), most):
                part = texts[i : i + most]
                got, fault = answer(service, part)
                vector.update(zip(part, got, strict=True))
                error.update(dict.fromkeys(part, fault))
            yield pd.DataFrame({"id": pdf["id"], "vector": [vector.get(t) for t in pdf["text"]], "error": [error.get(t) for t in pdf["text"]]}, dtype=object)

    return rows.select("id", "text").mapInPandas(run, f"id {kind}, vector array<double>, error string")


class FileService(Protocol):
    """A service that answers files of requests: takes one in, tells how far it is, gives the answers back."""

    def submit(self, path: str) -> str: ...

    def state(self, job: str) -> str: ...

    def fetch(self, job: str, path: str) -> None: ...


def answered_by_files(requests: DataFrame, folder: str, service: FileService, pause: float = 30.0, polls: int = 2_880, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Answers of a service of files: requests written, handed in, waited for, fetched and read; see ``read_results``.

    What has been done is kept in ``status.json`` of the folder, so a run that was broken off goes on where it was: requests
    aren't handed in twice. A job that failed, or is not done after ``polls`` looks, is an error.
    """
    spark = requests.sparkSession
    status = f"{folder}/status.json"
    done = read_json_object(spark, status) if exists(spark, status) else {}

    def note(**more) -> None:
        done.update(more)
        write_json_object(spark, status, done)

    if "job" not in done:
        write_requests(requests, f"{folder}/requests")
        note(job=service.submit(f"{folder}/requests"), state="submitted")
    for _ in range(polls):
        if done["state"] in ("completed", "fetched"):
            break
        if done["state"] == "failed":
            raise RuntimeError(f"the job {done['job']} failed")
        note(state=service.state(done["job"]))
        if done["state"] not in ("completed", "failed"):
            sleep(pause)
    if done["state"] == "completed":
        service.fetch(done["job"], f"{folder}/results")
        note(state="fetched")
    if done["state"] != "fetched":
        raise TimeoutError(f"the job {done['job']} isn't done: {done['state']}")
    return read_results(spark, f"{folder}/results")


def ask(requests: DataFrame, make: Callable[[], Provider], timed: bool = False) -> DataFrame:
    """Answers of all requests: ``custom_id``, ``response``, ``error``, and with ``timed`` the ``seconds`` that each took. One provider per task; an error is a row, not a failure."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        for pdf in frames:
            out = []
            for cid, payload in zip(pdf["custom_id"], pdf["payload"], strict=True):
                began = time.perf_counter()
                try:
                    response, error = json.dumps(provider.answer(json.loads(payload)), ensure_ascii=False, sort_keys=True), None
                except Exception as e:  # noqa: BLE001
                    response, error = None, f"{type(e).__name__}: {e}"
                out.append((cid, response, error, time.perf_counter() - began)[: 3 + timed])
            yield pd.DataFrame(out, columns=["custom_id", "response", "error", "seconds"][: 3 + timed])

    return requests.select("custom_id", "payload").mapInPandas(run, "custom_id string, response string, error string" + ", seconds double" * timed)


def probe_figures(requests: DataFrame, stored: DataFrame | None, answers: DataFrame, namespace: str) -> DataFrame:
    """What a run took: one row of ``requests``, ``payloads`` (different ones), ``from_store``, ``asked``, ``errors`` and, of timed answers, ``mean_seconds`` and ``most_seconds``.

    ``answers``: what ``ask`` gave for the payloads that weren't stored.
    """
    keyed = requests.select(content_key(namespace, F.col("payload")).alias("key"))
    known = keyed.where("false").select("key") if stored is None else stored.select("key").distinct()
    one = keyed.groupBy("key").agg(F.count("*").alias("n")).join(known.withColumn("there", F.lit(True)), "key", "left")
    left = one.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("requests"), F.count("*").alias("payloads"), F.count("there").alias("from_store"))
    seconds = F.col("seconds") if "seconds" in answers.columns else F.lit(None).cast("double")
    right = answers.agg(F.count("*").alias("asked"), F.count("error").alias("errors"), F.avg(seconds).alias("mean_seconds"), F.max(seconds).alias("most_seconds"))
    return left.withColumn("one", F.lit(1)).join(right.withColumn("one", F.lit(1)), "one").drop("one")


def content_key(namespace: str, payload: Column) -> Column:
    """The key of an answer: namespace and SHA-256 of the payload."""
    return F.concat(F.lit(namespace + ":"), F.sha2(payload, 256))


def answered(requests: DataFrame, stored: DataFrame | None, make: Callable[[], Provider], namespace: str) -> DataFrame:
    """Answers of all requests, equal payloads asked once and stored ones (``key``, ``response``) not at all: ``custom_id``, ``key``, ``response``, ``error``."""
    keyed = requests.withColumn("key", content_key(namespace, F.col("payload")))
    open_ = keyed.select("key", "payload").dropDuplicates(["key"])
    if stored is not None:
        open_ = remaining(open_, stored, "key")
    fresh = ask(open_.withColumnRenamed("key", "custom_id"), make).withColumnRenamed("custom_id", "key")
    known = fresh if stored is None else fresh.unionByName(stored.select("key", "response", F.lit(None).cast("string").alias("error")))
    return keyed.select("custom_id", "key").join(known, "key")


def write_requests(requests: DataFrame, path: str) -> None:
    """Requests as JSON lines for a service that answers files; ``custom_id`` brings the answers back."""
    requests.select("custom_id", "payload").write.mode("overwrite").json(path)


def read_results(spark, path: str) -> DataFrame:
    """Answers of such a service: ``custom_id``, ``response``, ``error``; of repeated ones one without error goes first."""
    rows = spark.read.schema("custom_id string, response string, error string").json(path).where("custom_id is not null")
    best = rows.groupBy("custom_id").agg(F.min(F.struct(F.col("error").isNotNull().alias("bad"), "response", "error")).alias("r"))
    return best.select("custom_id", "r.response", "r.error")


def assert_complete(requests: DataFrame, results: DataFrame) -> None:
    """Raises if a request has no answer."""
    lost = incomplete(requests, results).limit(5).collect()
    if lost:
        raise ValueError(f"requests without answer: {[r[0] for r in lost]}")


def action(c: Column) -> Column:
    """replace, keep, or null for another word."""
    t = F.lower(F.trim(c))
    out = None
    for name, words in ACTIONS.items():
        out = F.when(t.isin(words), name) if out is None else out.when(t.isin(words), name)
    return out


def sentence_type(c: Column) -> Column:
    """One of the three kinds of sentences, by its name, an alias or a hint; else null."""
    t = F.trim(c)
    out = F.when(t.isin(SENTENCE_TYPES), t)
    for alias, kind in SENTENCE_ALIASES.items():
        out = out.when(t == alias, kind)
    for kind, hint in SENTENCE_HINTS:
        out = out.when(t.rlike(hint), kind)
    return out


TUPLE = "struct<subject:array<struct<concept:string,description:string>>,relation:struct<concept:string,description:string>,object:array<struct<concept:string,description:string>>,location:struct<concept:string,description:string>,time:string,confidence:double>"


def checked_tuples(results: DataFrame) -> DataFrame:
    """Tuples of extraction answers with ``valid`` and ``fault``: subject, relation and object need concepts, confidence lies in 0..1 (0.8 if missing)."""
    rows = results.select("custom_id", F.posexplode(F.from_json("response", f"struct<tuples:array<{TUPLE}>>")["tuples"]).alias("n", "t"))
    empty = lambda c: F.coalesce(F.length(F.trim(c)), F.lit(0)) == 0
    sure = F.coalesce("t.confidence", F.lit(0.8))
    fault = (
        F.when(F.coalesce(F.size("t.subject"), F.lit(0)) < 1, "subject")
        .when(F.exists("t.subject", lambda x: empty(x["concept"])), "subject")
        .when(empty(F.col("t.relation.concept")), "relation")
        .when(F.coalesce(F.size("t.object"), F.lit(0)) < 1, "object")
        .when(F.exists("t.object", lambda x: empty(x["concept"])), "object")
        .when((sure < 0) | (sure > 1), "confidence")
    )
    return rows.select("custom_id", "n", "t", sure.alias("confidence"), fault.isNull().alias("valid"), fault.alias("fault"))


def checked_timeline(results: DataFrame) -> DataFrame:
    """Events of compression answers with ``valid``: ids not negative, text not blank; a missing timeline is none."""
    kind = "struct<timeline:array<struct<event_id:int,text:string,source_sentence_ids:array<int>>>>"
    rows = results.select("custom_id", F.posexplode(F.from_json("response", kind)["timeline"]).alias("n", "e"))
    fine = (F.col("e.event_id") >= 0) & (F.length(F.trim("e.text")) > 0) & ~F.exists(F.coalesce("e.source_sentence_ids", F.array().cast("array<int>")), lambda x: x < 0)
    return rows.select("custom_id", "n", "e.event_id", "e.text", "e.source_sentence_ids", F.coalesce(fine, F.lit(False)).alias("valid"))


def render_timeline(events: DataFrame) -> DataFrame:
    """The text of a document's events by id and text, repeated ones once: ``custom_id``, ``text``."""
    ordered = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("event_id", F.trim("text").alias("text")))), lambda e: e["text"]))
    return events.where("valid").groupBy("custom_id").agg(F.array_join(ordered, "\n").alias("text"))


def coverage(events: DataFrame, sentences: DataFrame) -> DataFrame:
    """Events, distinct events and the share of a document's sentences that they cover: ``custom_id`` and figures. ``sentences``: ``custom_id``, ``n_sentences``."""
    per = events.where("valid").groupBy("custom_id").agg(F.count("*").alias("events"), F.countDistinct("text").alias("distinct_events"), F.size(F.array_distinct(F.flatten(F.collect_list("source_sentence_ids")))).alias("covered"))
    both = sentences.join(per, "custom_id", "left").fillna(0, ["events", "distinct_events", "covered"])
    return both.select("custom_id", "events", "distinct_events", F.when(F.col("n_sentences") > 0, F.round(F.col("covered") / F.col("n_sentences"), 4)).otherwise(0.0).alias("coverage"))


def checked_order(results: DataFrame, tuples: DataFrame) -> DataFrame:
    """Positions that answers give to tuples, per document, with ``valid``: exactly the document's ids, each once.

    ``results``: ``custom_id`` (document), ``response`` with ``sorted_tuple_ids``; ``tuples``: ``custom_id``, ``tuple_id``.
    """
    got = results.select("custom_id", F.posexplode(F.from_json("response", "struct<sorted_tuple_ids:array<string>>")["sorted_tuple_ids"]).alias("position", "tuple_id"))
    both = got.join(tuples.select("custom_id", "tuple_id", F.lit(True).alias("there")).distinct(), ["custom_id", "tuple_id"], "full")
    fault = both.groupBy("custom_id").agg((F.count_if(F.col("there").isNull() | F.col("position").isNull()) + F.count("*") - F.countDistinct("tuple_id")).alias("faults"))
    return got.join(fault, "custom_id").select("custom_id", "tuple_id", "position", (F.col("faults") == 0).alias("valid"))


class RuleExtractor:
    """Stand-in for extraction: the first verb of a small list parts subject and object."""

    VERBS = re.compile("宣布|启动|暂停|取消|恢复|批准|反对|审议|延长|加强|促成|谴责|要求解释|拒绝评论|公开回应|扩大规模|重新评估|正式确认|提前启动|低调结束|一度中断")

    def answer(self, payload: dict) -> dict:
        s = payload.get("sentence") or ""
        m = self.VERBS.search(s)
        subject = re.split("[，,。：:、；;]", s[: m.start()])[-1].strip() if m else ""
        rest = re.split("[，,。！？；;]", s[m.end() :])[0].strip() if m else ""
        if not (subject and rest):
            return {"tuples": []}
        concept = lambda c: {"concept": c, "description": c}
        return {"tuples": [{"subject": [concept(subject)], "relation": concept(m[0]), "object": [concept(rest)], "time": None, "location": None, "confidence": 0.6}]}


class RuleDescriber:
    """Stand-in for descriptions: the name and its first context."""

    def answer(self, payload: dict) -> dict:
        contexts = payload.get("contexts") or []
        return {"description": "，".join([payload.get("raw_str") or "", *contexts[:1]])}


def merge_groups(results: DataFrame, members: DataFrame) -> DataFrame:
    """Valid merge groups of cluster answers and what is left over, as groups of one: ``cluster_id``, ``merged``, ``source``.

    ``results``: ``custom_id`` (cluster), ``response`` with ``merge_groups`` of ``source_concepts``,
    ``merged_concept``; ``members``: ``cluster_id``, ``concept``. A group needs two known concepts that no earlier
    group of the cluster has used, and a name.
    """
    kind = "struct<merge_groups:array<struct<source_concepts:array<string>,merged_concept:string,merged_description:string>>>"
    groups = results.select(F.col("custom_id").alias("cluster_id"), F.posexplode(F.from_json("response", kind)["merge_groups"]).alias("n", "g"))
    used = groups.select("cluster_id", "n", F.trim("g.merged_concept").alias("merged"), F.explode("g.source_concepts").alias("concept")).where("length(merged) > 0").join(members, ["cluster_id", "concept"], "left_semi")
    first = used.groupBy("cluster_id", "concept").agg(F.min_by("merged", "n").alias("merged"), F.min("n").alias("n"))
    many = first.groupBy("cluster_id", "n").agg(F.count("*").alias("size")).where("size >= 2")
    kept = first.join(many, ["cluster_id", "n"], "left_semi").select("cluster_id", "merged", F.col("concept").alias("source"))
    alone = members.join(kept.select("cluster_id", F.col("source").alias("concept")), ["cluster_id", "concept"], "left_anti").select("cluster_id", F.col("concept").alias("merged"), F.col("concept").alias("source"))
    return kept.unionByName(alone)

"""The stages that a model answers: their requests, and what makes an answer valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.plans.providers import action, sentence_type

#: What units of a plan may be, and what may be advised for them.
UNIT_TYPES = ["事实事件", "重要表态事件", "计划事件"]
UNIT_ACTIONS = ["单独抽取", "按重要表态抽取，提炼核心内容和对外信号", "按计划抽取，不作已发生事实"]
#: The fields of a described concept with their weights.
FIELD_WEIGHTS = {
    "entity": {"主体类别": 0.45, "核心角色": 0.55},
    "relation": {"关系类别": 0.40, "核心议题": 0.40, "战略作用": 0.20},
    "location": {"空间类型": 0.35, "区位范围": 0.40, "议题作用": 0.25},
}
#: The verdict on a compliant concept.
COMPLIANT = "合规"


def _request(df: DataFrame, key: Column, *fields: Column) -> DataFrame:
    return df.select(key.alias("custom_id"), F.to_json(F.struct(*fields)).alias("payload"))


def compression_requests(sentences: DataFrame) -> DataFrame:
    """One per document: its sentences, numbered from 0. ``sentences``: ``doc_id``, ``sentence_index`` from 1, ``text``."""
    items = F.array_sort(F.collect_list(F.struct((F.col("sentence_index") - 1).alias("sentence_id"), "text")))
    return _request(sentences.groupBy("doc_id").agg(items.alias("sentences")), F.col("doc_id"), F.col("sentences"))


def plan_requests(sentences: DataFrame) -> DataFrame:
    """One per sentence; the document is named, not repeated: a provider reads it by ``doc_id``."""
    return _request(sentences, F.col("sent_id"), F.col("doc_id"), F.col("sent_id").alias("句子编号"), F.col("text").alias("当前请求句"))


def checked_plans(results: DataFrame) -> DataFrame:
    """Plans of answers: ``custom_id``, ``sentence_type``, ``units``, ``valid``. An answer that can't be read is a sentence without units."""
    kind = "struct<`句子编号`:string,`原句`:string,`句子类型`:string,`事件分析`:string,`事件单元`:array<struct<`编号`:string,`文本片段`:string,`单元类型`:string,`分析方法建议`:string,`抽取动作建议`:string>>>"
    rows = results.select("custom_id", F.from_json("response", kind).alias("p"))
    told = sentence_type(F.col("p.句子类型"))
    units = F.coalesce("p.事件单元", F.array().cast("array<struct<`编号`:string,`文本片段`:string,`单元类型`:string,`分析方法建议`:string,`抽取动作建议`:string>>"))
    fine = told.isNotNull() & F.forall(units, lambda u: u["单元类型"].isin(UNIT_TYPES) & u["抽取动作建议"].isin(UNIT_ACTIONS))
    valid = F.coalesce(fine, F.lit(False))
    named = F.transform(units, lambda u: F.struct(u["编号"].alias("id"), u["文本片段"].alias("span"), u["单元类型"].alias("unit_type"), u["分析方法建议"].alias("method"), u["抽取动作建议"].alias("action")))
    return rows.select("custom_id", F.when(valid, told).otherwise("不抽取句").alias("sentence_type"), F.when(valid, named).otherwise(F.slice(named, 1, 0)).alias("units"), valid.alias("valid"))


def extraction_requests(plans: DataFrame, sentences: DataFrame) -> DataFrame:
    """One per planned sentence that has units. A plan whose sentence is missing is an error."""
    wanted = plans.where(F.size("units") > 0)
    if wanted.join(sentences, wanted["custom_id"] == sentences["sent_id"], "left_anti").limit(1).count():
        raise ValueError("a plan's sentence isn't in the sentence index")
    both = wanted.join(sentences.select("sent_id", "text"), wanted["custom_id"] == F.col("sent_id"))
    return _request(both, F.col("custom_id"), F.col("text").alias("sentence"), F.col("units").alias("plan"))


def normalise_requests(concepts: DataFrame, near: DataFrame, k: int = 16) -> DataFrame:
    """One per concept with its nearest pool concepts; concepts without any are kept and not asked.

    ``concepts``: ``sent_id``, ``type``, ``concept``, ``sentence``; ``near``: ``type``, ``concept``, ``candidate``, ``score``.
    """
    rank = F.row_number().over(Window.partitionBy("type", "concept").orderBy(F.desc("score"), "candidate"))
    few = near.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("type", "concept").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "candidate"))), lambda e: e["candidate"]).alias("candidates"))
    rows = concepts.select("sent_id", "type", "concept", "sentence").distinct().join(few, ["type", "concept"])
    return _request(rows, F.concat_ws("|", "sent_id", "type", "concept"), F.col("sentence"), F.col("concept"), F.col("candidates"))


def checked_normalisation(requests: DataFrame, results: DataFrame) -> DataFrame:
    """``custom_id``, ``concept``, ``normalized``, ``fault``: a replacement must be one of the candidates, else the concept is kept."""
    asked = requests.select("custom_id", F.from_json("payload", "struct<concept:string,candidates:array<string>>").alias("q"))
    told = results.select("custom_id", F.from_json("response", "struct<`替换指示符`:string,`规范化概念`:string>").alias("a"))
    rows = asked.join(told, "custom_id", "left")
    replaces = action(F.col("a.替换指示符")) == "replace"
    known = F.array_contains("q.candidates", F.col("a.规范化概念"))
    fault = F.when(F.col("a").isNull() | action(F.col("a.替换指示符")).isNull(), "unreadable").when(replaces & ~F.coalesce(known, F.lit(False)), "invalid_replacement")
    return rows.select("custom_id", F.col("q.concept").alias("concept"), F.when(replaces & known, F.col("a.规范化概念")).otherwise(F.col("q.concept")).alias("normalized"), fault.alias("fault"))


def describe_requests(pool: DataFrame) -> DataFrame:
    """One per pool concept: its name and contexts."""
    return _request(pool, F.concat_ws("|", "type", "concept"), F.col("concept").alias("raw_str"), F.col("contexts"))


def field_requests(pool: DataFrame) -> DataFrame:
    """One per pool concept of a type with fields: its name, contexts, and the names of the fields to fill."""
    names = F.create_map(*[x for t, fields in FIELD_WEIGHTS.items() for x in (F.lit(t), F.array(*[F.lit(f) for f in fields]))])
    return _request(pool.where(F.col("type").isin(*FIELD_WEIGHTS)), F.concat_ws("|", "type", "concept"), F.col("type"), F.col("concept"), F.col("contexts"), names[F.col("type")].alias("fields"))


def compliance_requests(pool: DataFrame, most: int = 8) -> DataFrame:
    """One per pool concept with at most so many sentences."""
    return _request(pool, F.concat_ws("|", "type", "concept"), F.col("type"), F.col("concept"), F.slice("contexts", 1, most).alias("sentences"))


def checked_compliance(results: DataFrame) -> DataFrame:
    """``custom_id``, ``compliant``, ``reason``, ``valid``: anything but the one verdict is against the concept."""
    rows = results.select("custom_id", F.from_json("response", "struct<verdict:string,reason:string>").alias("v"))
    verdict = F.trim("v.verdict")
    return rows.select("custom_id", F.coalesce(verdict == COMPLIANT, F.lit(False)).alias("compliant"), F.col("v.reason").alias("reason"), F.coalesce(verdict.isin(COMPLIANT, "不" + COMPLIANT), F.lit(False)).alias("valid"))


def checked_fields(results: DataFrame) -> DataFrame:
    """``custom_id``, ``type``, ``fields`` of descriptions that fill exactly one type's fields; else both are null."""
    rows = results.select("custom_id", F.from_json("response", "struct<fields:map<string,string>>")["fields"].alias("f"))
    told = F.map_filter(F.transform_keys("f", lambda k, _: F.trim(k)), lambda k, v: (F.length(k) > 0) & (F.length(F.trim(v)) > 0))
    rows = rows.withColumn("f", told)
    holds = {t: F.forall(F.array(*[F.lit(x) for x in names]), lambda n: F.map_contains_key("f", n)) for t, names in FIELD_WEIGHTS.items()}
    types = F.array_compact(F.array(*[F.when(h, F.lit(t)) for t, h in holds.items()]))
    kind = F.when(F.size(types) == 1, types[0])
    own = F.create_map(*[x for t, names in FIELD_WEIGHTS.items() for x in (F.lit(t), F.array(*[F.lit(n) for n in names]))])
    fields = F.map_filter("f", lambda k, _: F.array_contains(own[kind], k))
    return rows.select("custom_id", kind.alias("type"), F.when(kind.isNotNull(), fields).alias("fields"))


def judge_requests(targets: DataFrame, candidates: DataFrame, k: int = 16) -> DataFrame:
    """One per element with its nearest others in the block: ``targets``: ``id``, ``raw_str``; ``candidates``: ``id``, ``near``, ``near_str``, ``score``."""
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "near"))
    few = candidates.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "near_str"))), lambda e: e["near_str"]).alias("candidates"))
    rows = targets.join(few, "id", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast("array<string>")))
    return _request(rows, F.col("id"), F.col("raw_str").alias("target"), F.col("candidates"))


def checked_names(results: DataFrame, field: str = "duplicates") -> DataFrame:
    """``custom_id``, ``names``, ``valid`` of answers that are lists of names; blank names are dropped, a missing list isn't valid."""
    told = results.select("custom_id", F.from_json("response", f"struct<{field}:array<string>>")[field].alias("n"))
    names = F.array_distinct(F.filter(F.transform("n", lambda x: F.trim(x)), lambda x: F.length(x) > 0))
    return told.select("custom_id", F.coalesce(names, F.array().cast("array<string>")).alias("names"), F.col("n").isNotNull().alias("valid"))


def checked_text(results: DataFrame, field: str) -> DataFrame:
    """``custom_id``, ``text``, ``valid`` of answers that are one text (a canonical name, a description), which must not be blank."""
    told = F.trim(F.from_json("response", f"struct<{field}:string>")[field])
    return results.select("custom_id", told.alias("text"), F.coalesce(F.length(told) > 0, F.lit(False)).alias("valid"))


def cluster_requests(members: DataFrame) -> DataFrame:
    """One per cluster of bounded size: its concepts by name. ``members``: ``cluster_id``, ``concept``."""
    return _request(members.groupBy("cluster_id").agg(F.array_sort(F.collect_set("concept")).alias("concepts")), F.col("cluster_id"), F.col("concepts"))


def order_requests(tuples: DataFrame) -> DataFrame:
    """One per document: its tuples, to be put in the order of the discourse."""
    items = F.array_sort(F.collect_list(F.struct("tuple_id", "subject", "relation", "object", "time")))
    return _request(tuples.groupBy("doc_id").agg(items.alias("tuples")), F.col("doc_id"), F.col("tuples"))


def vector_sync(pool: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a vector store lacks and what it holds too much.

    ``pool``: ``type``, ``concept``, ``description``; ``stored``: the same with ``vector``. First: concepts that are
    new or whose description has changed, to be embedded; second: stored rows that still hold. Stored rows of
    concepts that the pool no longer has are in neither.
    """
    key = ["type", "concept", "description"]
    return pool.select(*key).join(stored.select(*key), key, "left_anti"), stored.join(pool.select(*key), key, "left_semi")

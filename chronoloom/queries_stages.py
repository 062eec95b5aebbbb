"""Queries of sources, sinks and model-answered stages, and their SQL (``queries_stages_sql``)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.functions import text as X
from chronoloom.functions.vectors import rounded, weighted_sum
from chronoloom.operators import canonical as CA
from chronoloom.operators import clustering as CL
from chronoloom.operators import concepts as CO
from chronoloom.operators import docgraph as DG
from chronoloom.operators import lexical as LX
from chronoloom.operators import payloads as PA
from chronoloom.operators import similarity as SI
from chronoloom.operators import timeline as TL
from chronoloom.operators import tuples as TU
from chronoloom.plans import model_stages as MS
from chronoloom.plans import providers as PR
from chronoloom.plans.scope import names_match
from chronoloom.plans.stages import Plan, Stage, incomplete, remaining
from chronoloom.queries_stages_sql import SQL
from chronoloom.sources import files as FI
from chronoloom.sources.tables import Scratch, table
from chronoloom.streaming import pool as SP

__all__ = ["QUERIES", "SQL"]
QUERIES: dict = {}
#: Names asked for by file or stem, in the forms that a user may type.
WANTED_NAMES = ["E100", " m200 ", "ec483", "D013"]
#: Word rules of the caller: literal replacements, hints, and pattern rules on the lines that hold a hint.
LITERAL = [("海峡", "水道"), ("  ", " ")]
HINTS = ["公司", "Council"]
LINE_RULES = [("公司(?:刊发)?", "企业"), ("Council", "Board")]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _sentences(spark, folder) -> DataFrame:
    rows = table(spark, folder, "raw_news", "doc_id", "normalized_text").select("doc_id", F.posexplode(X.news_sentences(F.col("normalized_text"))).alias("n", "text"))
    n = F.col("n") + 1
    return rows.select("doc_id", n.cast("int").alias("sentence_index"), F.format_string("%s_s%03d", "doc_id", n).alias("sent_id"), "text")


def _tuples(spark, folder) -> DataFrame:
    return table(spark, folder, "raw_tuples")


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


# --- files -----------------------------------------------------------------------------------------------------------


@query
def text_files(spark, folder):
    """News texts written as a file each and scanned again."""
    at = Scratch(spark, "texts").root
    FI.write_texts(table(spark, folder, "raw_news", "file_name", "text"), at)
    return FI.read_texts(spark, at).select("doc_id", "file_name", F.md5("text").alias("digest"))


@query
def scoped_text_files(spark, folder):
    """The first folder that has texts of the scope, and those texts."""
    root = Scratch(spark, "texts").root
    FI.write_texts(table(spark, folder, "raw_news", "file_name", "text"), f"{root}/sources")
    place, kind = FI.text_folder(spark, root, "E001-E500")
    return FI.read_texts(spark, place, "E001-E500").select("file_name", F.lit(kind).alias("kind"))


@query
def json_lines(spark, folder):
    """Tuples written as JSON lines and read again."""
    at = Scratch(spark, "lines").root
    FI.write_json_lines(_tuples(spark, folder).select("tuple_id", "doc_id", "subject", "object", "time", "confidence").distinct(), at)
    return FI.read_json_lines(spark, at, "tuple_id string, doc_id string, subject string, object string, time string, confidence double")


@query
def document_lines(spark, folder):
    """Documents from one file of JSON lines."""
    root = Scratch(spark, "documents").root
    news = table(spark, folder, "raw_news", "doc_id", "normalized_text", "lang")
    FI.write_json_lines(news.select("doc_id", F.col("normalized_text").alias("text"), F.create_map(F.lit("lang"), F.col("lang")).alias("meta")), f"{root}/documents.jsonl")
    return FI.read_documents(spark, root).select("doc_id", "text", F.col("meta")["lang"].alias("lang"))


@query
def processed_documents(spark, folder):
    """Documents from processed texts, where there is no such file."""
    root = Scratch(spark, "documents").root
    FI.write_texts(table(spark, folder, "raw_news").select("file_name", F.col("normalized_text").alias("text")), f"{root}/processed")
    return FI.read_documents(spark, root).select("doc_id", "text", F.col("meta")["file_name"].alias("file_name"))


@query
def vector_table(spark, folder):
    """Vectors written as a table and read again."""
    at = Scratch(spark, "vectors").root
    FI.write_vectors(table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector")), at)
    return FI.read_vectors(spark, at).select("id", F.size("vector").alias("dimension"), F.round(F.col("vector")[0], 4).alias("first"))


@query
def vector_archives(spark, folder):
    """Vectors written as archives of matrices and read again."""
    at = Scratch(spark, "archives").root
    FI.write_archives(table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), at)
    return FI.read_archives(spark, at).select("id", F.size("vector").alias("dimension"), F.round(F.col("vector")[0], 4).alias("first"))


@query
def split_by_document(spark, folder):
    """A file of tuples for each document, named by its news file where it has one."""
    names = table(spark, folder, "raw_news").select("doc_id", X.stem(F.col("file_name")).alias("name"))
    return FI.write_per_document(_tuples(spark, folder).select("doc_id", "tuple_id", "subject").distinct(), Scratch(spark, "split").root, names)


@query
def report_lines(spark, folder):
    """The report on tuples per sentence, line by line."""
    text = TU.report_markdown(TU.global_counts(_tuples(spark, folder)), TU.count_histogram(_tuples(spark, folder)))
    return spark.createDataFrame(list(enumerate(text.splitlines())), "number int, line string")


@query
def stored_answers(spark, folder):
    """Descriptions asked for once, stored, and taken from the store the second time."""
    at = Scratch(spark, "answers").root
    asked = MS.describe_requests(table(spark, folder, "canonical").select("type", F.col("canonical_str").alias("concept"), F.coalesce("aliases", F.array().cast("array<string>")).alias("contexts")))
    FI.store(PR.answered(asked, None, PR.RuleDescriber, "describe"), at)
    again = PR.answered(asked, FI.cached(spark, at), _Nobody, "describe")
    return again.where("error is null").select("custom_id", "key", F.get_json_object("response", "$.description").alias("description"))


class _Nobody:
    """A provider that must not be asked."""

    def answer(self, payload):
        raise AssertionError("everything was stored")


@query
def file_names_wanted(spark, folder):
    """Texts that are asked for by name, stem or code."""
    return table(spark, folder, "raw_news").where(names_match(WANTED_NAMES, F.col("file_name"), F.col("doc_id"))).select("news_id")


@query
def first_texts(spark, folder):
    """The first ten texts by name: the limit is what is asked for."""
    at = Scratch(spark, "texts").root
    FI.write_texts(table(spark, folder, "raw_news", "file_name", "text"), at)
    return FI.first_files(spark, at, 10).select("file_name")


@query
def pool_of_json(spark, folder):
    """A concept pool from JSON maps of concepts with descriptions and source sentences."""
    e = table(spark, folder, "dedup_elements").where("raw_str is not null").dropDuplicates(["type", "id"])
    entry = F.struct(F.col("description").alias("描述"), F.col("contexts").alias("来源句"))
    return CO.pool_from_json(e.select(F.to_json(F.create_map("raw_str", entry)).alias("j")), "j", "any").select("concept", "description", "contexts", "count")


@query
def word_rules(spark, folder):
    """Rules on words: literal ones, and patterns on the lines with a hint."""
    return table(spark, folder, "raw_news").select("news_id", X.apply_word_rules(F.col("text"), LITERAL, HINTS, LINE_RULES).alias("text"))


# --- requests and answers --------------------------------------------------------------------------------------------


@query
def compression_requests(spark, folder):
    return MS.compression_requests(_sentences(spark, folder))


@query
def plan_requests(spark, folder):
    return MS.plan_requests(_sentences(spark, folder))


def _plan_answers(spark, folder) -> DataFrame:
    """Answers of all sorts by a sentence's number: good ones, ones with an alias or a hint, wrong units, and no JSON."""
    n, unit = F.col("sentence_index") % 6, lambda t, a: F.array(F.struct(F.lit("1").alias("编号"), F.col("text").alias("文本片段"), F.lit(t).alias("单元类型"), F.lit("m").alias("分析方法建议"), F.lit(a).alias("抽取动作建议")))
    told = F.when(n == 0, "事件句").when(n == 1, " 事实句 ").when(n == 2, "可能是混合").when(n == 3, "无需抽取的句子").otherwise("事件句")
    good = unit("事实事件", "单独抽取")
    units = F.when(n == 3, F.slice(good, 1, 0)).when(n == 4, unit("别的", "单独抽取")).otherwise(good)
    return _sentences(spark, folder).select(F.col("sent_id").alias("custom_id"), F.when(n == 5, F.lit("{")).otherwise(_json(句子类型=told, 事件单元=units)).alias("response"))


@query
def checked_plans(spark, folder):
    return MS.checked_plans(_plan_answers(spark, folder)).select("custom_id", "sentence_type", F.size("units").alias("units"), "valid")


@query
def extraction_requests(spark, folder):
    return MS.extraction_requests(MS.checked_plans(_plan_answers(spark, folder)), _sentences(spark, folder)).select("custom_id", F.get_json_object("payload", "$.sentence").alias("sentence"), F.get_json_object("payload", "$.plan[0].span").alias("span"))


def _near(spark, folder) -> DataFrame:
    """Entries that share their first sign with a subject, more alike the nearer their lengths are."""
    names = table(spark, folder, "canonical").where("type = 'entity'").select(F.col("canonical_str").alias("candidate"), F.substring("canonical_str", 1, 1).alias("sign"))
    asked = _tuples(spark, folder).select(F.col("subject").alias("concept")).where("subject is not null").distinct().withColumn("sign", F.substring("concept", 1, 1))
    return asked.join(names, "sign").select(F.lit("entity").alias("type"), "concept", "candidate", (-F.abs(F.length("concept") - F.length("candidate"))).cast("double").alias("score"))


def _asked_concepts(spark, folder) -> DataFrame:
    return MS.normalise_requests(_tuples(spark, folder).select(F.col("source_sent_id").alias("sent_id"), F.lit("entity").alias("type"), F.col("subject").alias("concept"), F.lit("s").alias("sentence")).where("sent_id is not null"), _near(spark, folder), 3)


@query
def normalise_requests(spark, folder):
    return _asked_concepts(spark, folder).select("custom_id", F.array_join(F.from_json(F.get_json_object("payload", "$.candidates"), "array<string>"), "|").alias("candidates"))


@query
def checked_normalisation(spark, folder):
    """Answers that replace, keep, name what wasn't offered, or aren't readable."""
    asked = _asked_concepts(spark, folder)
    n = F.length("custom_id") % 4
    first = F.from_json(F.get_json_object("payload", "$.candidates"), "array<string>")[0]
    said = F.when(n == 0, _json(替换指示符=F.lit("复用"), 规范化概念=first)).when(n == 1, _json(替换指示符=F.lit("Keep"))).when(n == 2, _json(替换指示符=F.lit("replace"), 规范化概念=F.lit("不在其中"))).otherwise(F.lit("x"))
    return MS.checked_normalisation(asked, asked.select("custom_id", said.alias("response"))).select("custom_id", "concept", "normalized", "fault")


@query
def described_pool(spark, folder):
    """Every canonical entry described by the offline stand-in."""
    pool = table(spark, folder, "canonical").select("type", F.col("canonical_str").alias("concept"), F.coalesce("aliases", F.array().cast("array<string>")).alias("contexts"))
    return MS.checked_text(PR.answered(MS.describe_requests(pool), None, PR.RuleDescriber, "describe"), "description")


@query
def compliance_requests(spark, folder):
    e = table(spark, folder, "dedup_elements").where("raw_str is not null").dropDuplicates(["type", "id"])
    asked = MS.compliance_requests(e.select("type", F.concat_ws("#", "raw_str", "id").alias("concept"), "contexts"), 2)
    return asked.select("custom_id", F.coalesce(F.size(F.from_json(F.get_json_object("payload", "$.sentences"), "array<string>")), F.lit(0)).alias("sentences"))


@query
def checked_compliance(spark, folder):
    """Verdicts by a record's number: for, against, padded, unknown, unreadable."""
    n = F.col("record_id") % 5
    verdict = F.when(n == 0, "合规").when(n == 1, " 合规 ").when(n == 2, "不合规").otherwise("不清楚")
    rows = table(spark, folder, "element_versions", "record_id", "origin").distinct()
    said = rows.select(F.col("record_id").cast("string").alias("custom_id"), F.when(n == 4, F.lit("{")).otherwise(_json(verdict=verdict, reason=F.col("origin"))).alias("response"))
    return MS.checked_compliance(said)


@query
def checked_fields(spark, folder):
    """Field descriptions that fill one type's fields, with more, with too few, or with blank ones."""
    rows = table(spark, folder, "element_versions", "record_id", "id").distinct()
    n, pair = F.col("record_id") % 4, lambda *k: F.create_map(*[x for f in k for x in (F.lit(f), F.col("id"))])
    fields = F.when(n == 0, pair("主体类别", "核心角色")).when(n == 1, pair(" 空间类型", "区位范围", "议题作用", "别的")).when(n == 2, pair("关系类别", "核心议题")).otherwise(F.create_map(F.lit("主体类别"), F.lit(" "), F.lit("核心角色"), F.col("id")))
    got = MS.checked_fields(rows.select(F.col("record_id").cast("string").alias("custom_id"), _json(fields=fields).alias("response")))
    return got.select("custom_id", "type", F.array_join(F.array_sort(F.map_keys("fields")), ",").alias("fields"))


@query
def field_requests(spark, folder):
    pool = table(spark, folder, "canonical").select("type", F.col("canonical_str").alias("concept"), F.coalesce("aliases", F.array().cast("array<string>")).alias("contexts"))
    asked = MS.field_requests(pool)
    return asked.select("custom_id", F.array_join(F.from_json(F.get_json_object("payload", "$.fields"), "array<string>"), ",").alias("fields"))


@query
def field_texts(spark, folder):
    e = table(spark, folder, "canonical").where("description is not null")
    return e.select("cid", PA.field_text(F.col("canonical_str"), F.col("type"), F.lit("核心角色"), F.col("description")).alias("text"))


def _label_pairs(spark, folder) -> DataFrame:
    v = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    near = SI.group_neighbours(v, "label", 4, 0.0)
    return near.select(F.col("id").cast("string").alias("id"), F.col("near").cast("string").alias("near"), F.concat(F.lit("v"), F.col("near").cast("string")).alias("near_str"), F.round("score", 6).alias("score"))


@query
def judge_requests(spark, folder):
    """For every vector the names of its two nearest ones of the same label, to be judged."""
    targets = table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("id"), F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("raw_str"))
    asked = MS.judge_requests(targets, _label_pairs(spark, folder), 2)
    return asked.select("custom_id", F.get_json_object("payload", "$.target").alias("target"), F.array_join(F.from_json(F.get_json_object("payload", "$.candidates"), "array<string>"), ",").alias("candidates"))


@query
def checked_names(spark, folder):
    """Lists of names with blank and repeated ones, and answers without a list."""
    rows = table(spark, folder, "canonical").where("aliases is not null")
    said = F.when(F.size("aliases") == 0, F.lit('{"other": 1}')).otherwise(_json(duplicates=F.concat(F.col("aliases"), F.array(F.lit(" "), F.concat(F.lit(" "), F.trim(F.col("aliases")[0]))))))
    return MS.checked_names(rows.select(F.col("cid").alias("custom_id"), said.alias("response"))).select("custom_id", F.size("names").alias("names"), "valid")


def _cluster_members(spark, folder) -> DataFrame:
    """Entries of a type by the first sign of their name as clusters."""
    return table(spark, folder, "canonical").select(F.concat("type", F.substring("canonical_str", 1, 1)).alias("cluster_id"), F.col("canonical_str").alias("concept")).distinct()


@query
def cluster_requests(spark, folder):
    return MS.cluster_requests(_cluster_members(spark, folder)).select("custom_id", F.array_join(F.from_json(F.get_json_object("payload", "$.concepts"), "array<string>"), "|").alias("concepts"))


@query
def merged_groups(spark, folder):
    """Answers that merge the two smallest concepts of a cluster, then two that are used or unknown already."""
    members = _cluster_members(spark, folder)
    two = members.groupBy("cluster_id").agg(F.slice(F.array_sort(F.collect_set("concept")), 1, 2).alias("c"))
    group = lambda sources, name: F.struct(sources.alias("source_concepts"), name.alias("merged_concept"), F.lit("d").alias("merged_description"))
    said = two.select(F.col("cluster_id").alias("custom_id"), _json(merge_groups=F.array(group(F.col("c"), F.concat(F.lit(" "), F.col("c")[0], F.lit("等"))), group(F.array(F.col("c")[0], F.lit("未知")), F.lit("again")))).alias("response"))
    return PR.merge_groups(said, members)


@query
def order_requests(spark, folder):
    return MS.order_requests(_tuples(spark, folder).select("doc_id", "tuple_id", "subject", "relation", "object", "time").distinct()).select("custom_id", F.size(F.from_json(F.get_json_object("payload", "$.tuples"), "array<struct<tuple_id:string>>")).alias("tuples"))


@query
def checked_orders(spark, folder):
    """Orders that hold a document's tuples, lack the last one, or repeat the first one."""
    t = _tuples(spark, folder).select(F.col("doc_id").alias("custom_id"), "tuple_id").distinct()
    ids = t.groupBy("custom_id").agg(F.array_sort(F.collect_set("tuple_id")).alias("ids"))
    n = F.size("ids") % 3
    told = F.when(n == 0, F.reverse("ids")).when(n == 1, F.slice("ids", F.lit(1), F.size("ids") - 1)).otherwise(F.concat("ids", F.array(F.col("ids")[0])))
    return PR.checked_order(ids.select("custom_id", _json(sorted_tuple_ids=told).alias("response")), t)


def _events(spark, folder) -> DataFrame:
    """An event for every third sentence of a document, one of them blank where the number is divisible by five, with two source sentences each."""
    s = _sentences(spark, folder).where("sentence_index % 3 = 1")
    n = F.col("sentence_index")
    event = F.struct((n - 1).alias("event_id"), F.when(n % 5 == 0, F.lit(" ")).otherwise(F.col("text")).alias("text"), F.array(n - 1, n).alias("source_sentence_ids"))
    return PR.checked_timeline(s.groupBy("doc_id").agg(F.array_sort(F.collect_list(event)).alias("timeline")).select(F.col("doc_id").alias("custom_id"), _json(timeline=F.col("timeline")).alias("response")))


@query
def checked_events(spark, folder):
    return _events(spark, folder).select("custom_id", "event_id", "valid")


@query
def rendered_events(spark, folder):
    return PR.render_timeline(_events(spark, folder))


@query
def event_coverage(spark, folder):
    sentences = _sentences(spark, folder).groupBy(F.col("doc_id").alias("custom_id")).agg(F.count("*").alias("n_sentences"))
    return PR.coverage(_events(spark, folder), sentences)


@query
def checked_extractions(spark, folder):
    """Tuples as extraction answers: blank subjects and objects, confidences out of range and missing ones."""
    t = _tuples(spark, folder).select("tuple_id", "subject", "relation", "object", "confidence").distinct()
    concept = lambda c: F.struct(c.alias("concept"), F.lit("d").alias("description"))
    sure = F.when(F.length("tuple_id") % 7 == 0, F.col("confidence") + 1).otherwise(F.col("confidence"))
    one = F.struct(F.array(concept(F.col("subject"))).alias("subject"), concept(F.col("relation")).alias("relation"), F.array(concept(F.col("object"))).alias("object"), sure.alias("confidence"))
    return PR.checked_tuples(t.select(F.col("tuple_id").alias("custom_id"), _json(tuples=F.array(one)).alias("response"))).select("custom_id", F.round("confidence", 6).alias("confidence"), "valid", "fault")


@query
def reply_words(spark, folder):
    """What replies may call actions and kinds of sentences, by a tuple's number of signs."""
    actions, kinds = ["Replace", " 复用 ", "keep", "新建", "drop", "选择"], ["事件句", "事实事件", "不抽取", "混合类", "表态", "x"]
    rows = _tuples(spark, folder).where("subject is not null").select("tuple_id", (F.length("subject") % 6 + 1).alias("n")).distinct()
    said = lambda words: F.element_at(F.array(*[F.lit(w) for w in words]), F.col("n"))
    return rows.select("tuple_id", PR.action(said(actions)).alias("action"), PR.sentence_type(said(kinds)).alias("kind"))


@query
def missing_results(spark, folder):
    """Sentences asked for that no tuple answers."""
    asked = _sentences(spark, folder).select(F.col("sent_id").alias("custom_id"))
    return incomplete(asked, _tuples(spark, folder).select(F.col("source_sent_id").alias("custom_id")))


@query
def vectors_to_make(spark, folder):
    """Concepts whose description the stored vectors don't have."""
    lacking, _ = MS.vector_sync(*_pool_and_store(spark, folder))
    return lacking


@query
def vectors_that_hold(spark, folder):
    _, kept = MS.vector_sync(*_pool_and_store(spark, folder))
    return kept.select("type", "concept", "description")


def _pool_and_store(spark, folder) -> tuple[DataFrame, DataFrame]:
    """The newest description of a name as the pool, the oldest ones as what is stored."""
    v = table(spark, folder, "element_versions", "record_id", "type", "raw_str", "description").where("type is not null and raw_str is not null and description is not null").distinct()
    pick = lambda by: v.groupBy("type", F.col("raw_str").alias("concept")).agg(by("description", "record_id").alias("description"))
    return pick(F.max_by), pick(F.min_by).withColumn("vector", F.array(F.lit(0.0)))


@query
def assembled_elements(spark, folder):
    """Descriptions, counts and vectors of the same elements joined."""
    e = table(spark, folder, "dedup_elements").where("size(vector) = 96").dropDuplicates(["id"])
    return CA.assembled(e.select("id", "raw_str", "description"), e.select("id", "count"), e.select("id", "vector")).select("id", "count", F.size("vector").alias("dimension"))


@query
def embedded_titles(spark, folder):
    """Titles embedded in bounded batches by the offline stand-in: dimension and length of every vector."""
    rows = table(spark, folder, "raw_news").select(F.col("news_id").alias("id"), X.stem(F.col("file_name")).alias("text"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    return PR.embedded(rows, PR.HashedEmbedder).select("id", F.size("vector").alias("dimension"), F.round(norm, 6).alias("length"), "error")


# --- vectors, order and lists ----------------------------------------------------------------------------------------


@query
def weighted_sums(spark, folder):
    """Two halves of a vector as fields, summed up with weights."""
    v = F.col("embedding")
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), rounded(weighted_sum([(F.slice(v, 1, 32), 0.7), (F.slice(v, 33, 32), 0.3)]), 6).alias("vector"))


@query
def mixed_scores(spark, folder):
    """Cosines of two slices of the vectors as both sides of a hybrid search, the second one only where it is positive."""
    v = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    side = lambda a, n: SI.scores(v.where("id % 100 = 0").select("id", F.slice("embedding", a, n).alias("vector")), v.select("id", F.slice("embedding", a, n).alias("vector"))).select(F.col("query").alias("query_id"), F.col("id").alias("doc_id"), F.round("score", 9).alias("score"))
    return LX.hybrid(side(1, 40), side(41, 24).where("score > 0"), 0.3, 10)


@query
def named_labels(spark, folder):
    """Labels as clusters, named by size and then by their first member."""
    v = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label")
    heads = v.groupBy("label").agg(F.min("id").alias("head"))
    return CL.named_clusters(v.join(heads, "label").select("id", "head"), Scratch(spark, "names"))


@query
def label_balance(spark, folder):
    """How far the sizes of the labels are from wanted ones."""
    return CL.partition_cost(table(spark, folder, "embeddings").select(F.col("label").alias("cluster_id")), CL.Sizes(target=40, least=30, most=60))


@query
def time_order(spark, folder):
    """News by the day that the old pipeline gives, those without one last."""
    c = table(spark, folder, "time_candidates", "doc_id", "normalized").where("normalized rlike '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'")
    days = c.groupBy("doc_id").agg(F.max(F.datediff(F.try_to_date("normalized", "yyyy-MM-dd"), F.lit("1970-01-01").cast("date"))).alias("ord"))
    nodes = table(spark, folder, "raw_news", "doc_id").join(days, "doc_id", "left")
    return DG.in_time_order(nodes, Scratch(spark, "order")).withColumn("ord", F.col("ord").cast("double"))


@query
def mapped_lists(spark, folder):
    """Merged tuples with mapped lists."""
    from chronoloom.queries import _alias_mapping, _merged

    return CO.apply_mapping_to_lists(_merged(spark, folder, Scratch(spark, "merge")), _alias_mapping(spark, folder))


@query
def described_mapping(spark, folder):
    """Versions of an element as sources of its id, with origins as groups and the first telling description."""
    v = table(spark, folder, "element_versions").where("raw_str is not null").dropDuplicates(["record_id"])
    rows = v.select("type", F.col("raw_str").alias("source"), F.col("id").alias("merged"), F.col("origin").alias("group_id"), F.col("trust").cast("string").alias("cluster_id"), "description", F.col("record_id").alias("seq"))
    return CO.grouped_mapping(rows)


# --- timeline --------------------------------------------------------------------------------------------------------


def _title_records(spark, folder) -> DataFrame:
    return TL.corrected(table(spark, folder, "raw_news").select("doc_id", "file_name", F.lit(None).cast("string").alias("text")))


@query
def title_timeline(spark, folder):
    """What the titles alone say about the end time, and what speaks against it."""
    m = TL.manifest(_title_records(spark, folder))
    return m.select("doc_id", "node_id", "base_title", "corrected_title", "raw_title_time", "end_time", "end_time_precision", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "temporal_status", "needs_review", F.array_join("review_reasons", ",").alias("reasons"))


@query
def title_forms(spark, folder):
    return _title_records(spark, folder).select("doc_id", "title_form", F.array_join("flags", ",").alias("flags"), "malformed", F.col("anchor").cast("string").alias("anchor"))


@query
def title_summary(spark, folder):
    return TL.summary(_title_records(spark, folder))


@query
def explicit_times(spark, folder):
    """Times with a year of their own in news texts, by the table function."""
    TL.register(spark)
    name = f"news_{uuid.uuid4().hex}"
    table(spark, folder, "raw_news").select("doc_id", "normalized_text", X.title_parts(X.stem(F.col("file_name")))["raw_time"].alias("title_time")).createOrReplaceTempView(name)
    found = spark.sql(f"SELECT n.doc_id, c.* FROM {name} n, LATERAL extract_time_candidates(n.normalized_text, n.title_time) c")
    return found.where("source like 'body\\_explicit\\_%' or source like 'body\\_year\\_%'").select("doc_id", "line_number", "source", "normalized", "precision", "confidence").distinct()


@query
def final_times(spark, folder):
    """The latest, then most precise, then surest time of every document among those that the old pipeline gives."""
    c = table(spark, folder, "time_candidates", "doc_id", "normalized", "confidence").where("normalized rlike '^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$'")
    part = lambda i: F.coalesce(F.get(F.split("normalized", "-"), F.lit(i)).cast("int"), F.lit(0))
    key = F.struct(part(0), part(1), part(2), F.coalesce("confidence", F.lit(0.0)))
    return c.groupBy("doc_id").agg(F.max_by("normalized", key).alias("normalized"), F.max(key)["col4"].alias("confidence"))


@query
def carried_years(spark, folder):
    """The year that holds for every stated time: the one in its text, else the last one before it in the report."""
    c = table(spark, folder, "time_candidates", "cand_id", "doc_id", "line_number", "matched_text").where("doc_id is not null").distinct()
    year = F.regexp_extract("matched_text", "(?:19|20)[0-9]{2}", 0)
    rows = c.select("cand_id", "doc_id", "line_number", F.when(F.length(year) > 0, year.cast("int")).alias("own_year"))
    return TL.carried_years(rows).select("cand_id", F.col("year").cast("double").alias("year"))


# --- runs ------------------------------------------------------------------------------------------------------------


@query
def planned_run(spark, folder):
    """A plan of two stages: what a first, a second and a forced run did."""
    at = Scratch(spark, "plan").root
    table(spark, folder, "raw_news", "doc_id", "normalized_text").write.parquet(f"{at}/raw_news.parquet")
    stages = [Stage("sentences", ("raw_news",), "sentences", _sentences), Stage("counts", ("sentences",), "counts", lambda s, d: table(s, d, "sentences").groupBy("doc_id").agg(F.count("*").alias("n")))]
    plan = Plan(stages)
    runs = [plan.run(spark, at, plan.sequence(run_all=True), **how) for how in ({"dry": True}, {}, {}, {"force": True})]
    total = table(spark, at, "counts").agg(F.sum("n")).first()[0]
    return spark.createDataFrame([(s.name, *(r[s.name] for r in runs), total) for s in stages], "stage string, dry string, first string, second string, forced string, sentences long")


@query
def streamed_pool(spark, folder):
    """The concept pool kept by a stream of tuples, read after all that is there has come."""
    at = Scratch(spark, "stream").root
    path = f"{folder}/raw_tuples.parquet"
    source = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")
    SP.pool_stream(source, f"{at}/pool", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return SP.read_pool(spark, f"{at}/pool").select("type", "concept", "count", F.col("first_seen").cast("string").alias("first_seen"))


@query
def probe_run(spark, folder):
    """What describing the reference list takes when half of it is stored."""
    pool = table(spark, folder, "canonical").select("type", F.col("canonical_str").alias("concept"), F.coalesce("aliases", F.array().cast("array<string>")).alias("contexts"))
    asked = MS.describe_requests(pool)
    keyed = asked.withColumn("key", PR.content_key("describe", F.col("payload")))
    stored = keyed.where(F.length("payload") % 2 == 0).select("key")
    fresh = remaining(keyed.dropDuplicates(["key"]), stored, "key").select(F.col("key").alias("custom_id"), "payload")
    figures = PR.probe_figures(asked, stored, PR.ask(fresh, PR.RuleDescriber, timed=True), "describe")
    return figures.select("requests", "payloads", "from_store", "asked", "errors", (F.col("most_seconds") >= F.col("mean_seconds")).alias("timed"))

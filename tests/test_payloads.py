import json

import pytest
from pyspark.sql import functions as F

from chronoloom.operators import payloads as PA
from chronoloom.plans import model_stages as MS
from chronoloom.plans.providers import RuleDescriber, RuleExtractor, ask, read_results, write_requests


def test_nested_payloads(spark):
    doc = {"empty": "", "quoted": 'a "b" \\ c', "a": [{"tuple_id": "t1", "time": "x"}, {"sent_id": ["t9", "t2"], "time": "y"}, {"raw_id": "t3", "time": None, "k": {"tuple_id": "t1", "time": "z"}}], "n": 1}
    rows = [("d1", json.dumps(doc)), ("d2", '{"tuple_id": "t2"}'), ("d3", '{"v": "t5"}'), ("d4", None)]
    df = spark.createDataFrame(rows, "doc string, body string")
    gone = spark.createDataFrame([("t2",), ("t3",), ("t3",)], "tuple_id string")
    got = {r["doc"]: r["body"] and json.loads(r["body"]) for r in PA.pruned_payloads(df, "doc", "body", gone).collect()}
    assert got == {"d1": {"empty": "", "quoted": 'a "b" \\ c', "a": [{"tuple_id": "t1", "time": "x"}], "n": 1}, "d2": None, "d3": {"v": "t5"}, "d4": None}
    times = spark.createDataFrame([("t1", "2024"), ("t2", "2025"), ("t3", "2026")], "tuple_id string, time string")
    new = json.loads(PA.retimed_payloads(df, "doc", "body", times).where("doc = 'd1'").first()["body"])
    assert [x["time"] for x in new["a"]] == ["2024", "y", None] and new["a"][2]["k"]["time"] == "2024"


def test_context_windows(spark):
    s = [("d", i, c * 10) for i, c in enumerate("甲乙丙丁戊", 1)] + [("e", 1, "短")]
    df = spark.createDataFrame(s, "doc_id string, sentence_index int, text string")
    got = {(r["doc_id"], r["sentence_index"]): r["context"].replace("\n", "")[::10] for r in PA.context_windows(df, 30, 2).collect()}
    assert got["d", 3] == "乙丙丁" and got["d", 1] == "甲乙丙" and got["e", 1] == "短" and len(got) == 6


def test_short_documents_are_their_own_context(spark):
    s = [("d", i, c) for i, c in enumerate("甲乙丙丁戊己庚辛", 1)]
    df = spark.createDataFrame(s, "doc_id string, sentence_index int, text string")
    got = PA.context_windows(df, 120, 2).collect()
    assert len(got) == 8 and all(r["whole_document_fits"] and r["context"] == "甲\n乙\n丙\n丁\n戊\n己\n庚\n辛" for r in got)


def test_names(spark):
    assert [PA.file_token(x) for x in (-0.5, 0.0, 12, "", 1.581203)] == ["n0p5", "0", "12", "0", "1p581203"]
    r = spark.range(1).select(PA.field_text(F.lit("甲"), F.lit("entity"), F.lit("核心角色"), F.lit("x"))).first()[0]
    assert r.split("\n") == ["概念：甲", "概念类型：entity", "字段：核心角色", "内容：x"]


def answers(spark, rows):
    return spark.createDataFrame([(k, json.dumps(v, ensure_ascii=False) if v is not None else None) for k, v in rows], "custom_id string, response string")


def test_plans_and_extraction(spark):
    s = spark.createDataFrame([("d", 1, "d_s001", "甲方宣布联合演习。"), ("d", 2, "d_s002", "无。")], "doc_id string, sentence_index int, sent_id string, text string")
    assert json.loads(MS.compression_requests(s).first()["payload"])["sentences"][1] == {"sentence_id": 1, "text": "无。"}
    assert MS.plan_requests(s).count() == 2
    unit = {"编号": "1", "文本片段": "甲", "单元类型": "事实事件", "分析方法建议": "m", "抽取动作建议": "单独抽取"}
    plans = MS.checked_plans(answers(spark, [("d_s001", {"句子类型": "事实句", "事件单元": [unit]}), ("d_s002", {"句子类型": "事件句", "事件单元": [{**unit, "单元类型": "?"}]}), ("d_s003", None)]))
    got = {r["custom_id"]: (r["sentence_type"], len(r["units"]), r["valid"]) for r in plans.collect()}
    assert got == {"d_s001": ("事件句", 1, True), "d_s002": ("不抽取句", 0, False), "d_s003": ("不抽取句", 0, False)}
    asked = MS.extraction_requests(plans, s)
    assert ask(asked, RuleExtractor).count() == 1
    with pytest.raises(ValueError):
        MS.extraction_requests(plans, s.where("sent_id = 'd_s002'"))


def test_concept_stages(spark):
    c = spark.createDataFrame([("s1", "entity", "甲方", "甲方来了"), ("s1", "entity", "甲方", "甲方来了"), ("s1", "entity", "独", "x")], "sent_id string, type string, concept string, sentence string")
    near = spark.createDataFrame([("entity", "甲方", "甲", 0.9), ("entity", "甲方", "乙", 0.8)], "type string, concept string, candidate string, score double")
    asked = MS.normalise_requests(c, near, k=1)
    assert asked.count() == 1 and json.loads(asked.first()["payload"])["candidates"] == ["甲"]
    key = asked.first()["custom_id"]
    for reply, wanted in (({"替换指示符": "reuse", "规范化概念": "甲"}, ("甲", None)), ({"替换指示符": "替换", "规范化概念": "乙"}, ("甲方", "invalid_replacement")), ({"替换指示符": "keep"}, ("甲方", None)), (None, ("甲方", "unreadable"))):
        r = MS.checked_normalisation(asked, answers(spark, [(key, reply)])).first()
        assert (r["normalized"], r["fault"]) == wanted
    pool = spark.createDataFrame([("entity", "甲", [str(i) for i in range(12)])], "type string, concept string, contexts array<string>")
    assert json.loads(ask(MS.describe_requests(pool), RuleDescriber).first()["response"]) == {"description": "甲，0"}
    assert len(json.loads(MS.compliance_requests(pool).first()["payload"])["sentences"]) == 8
    v = {r["custom_id"]: (r["compliant"], r["valid"]) for r in MS.checked_compliance(answers(spark, [("a", {"verdict": "合规"}), ("b", {"verdict": "不合规"}), ("c", {"verdict": "?"})])).collect()}
    assert v == {"a": (True, True), "b": (False, True), "c": (False, False)}
    f = {r["custom_id"]: (r["type"], r["fields"]) for r in MS.checked_fields(answers(spark, [("a", {"fields": {" 主体类别": "x", "核心角色": "y", "更多": "z"}}), ("b", {"fields": {"主体类别": "x", "核心角色": " "}}), ("c", {"fields": {"主体类别": "x", "核心角色": "y", "空间类型": "a", "区位范围": "b", "议题作用": "c"}})])).collect()}
    assert f == {"a": ("entity", {"主体类别": "x", "核心角色": "y"}), "b": (None, None), "c": (None, None)}
    targets = spark.createDataFrame([("e1", "甲"), ("e2", "乙")], "id string, raw_str string")
    close = spark.createDataFrame([("e1", "e2", "乙", 0.9), ("e1", "e3", "丙", 0.95)], "id string, near string, near_str string, score double")
    assert {r["custom_id"]: json.loads(r["payload"])["candidates"] for r in MS.judge_requests(targets, close, k=1).collect()} == {"e1": ["丙"], "e2": []}
    names = {r["custom_id"]: (r["names"], r["valid"]) for r in MS.checked_names(answers(spark, [("a", {"duplicates": [" x", "x", ""]}), ("b", {})])).collect()}
    assert names == {"a": (["x"], True), "b": ([], False)}
    texts = {r["custom_id"]: r["valid"] for r in MS.checked_text(answers(spark, [("a", {"canonical_str": "x"}), ("b", {"canonical_str": " "}), ("c", None)]), "canonical_str").collect()}
    assert texts == {"a": True, "b": False, "c": False}
    m = spark.createDataFrame([("c1", "b"), ("c1", "a")], "cluster_id string, concept string")
    assert json.loads(MS.cluster_requests(m).first()["payload"])["concepts"] == ["a", "b"]
    t = spark.createDataFrame([("d", "t2", "s", "r", "o", None), ("d", "t1", "s", "r", "o", None)], "doc_id string, tuple_id string, subject string, relation string, object string, time string")
    assert [x["tuple_id"] for x in json.loads(MS.order_requests(t).first()["payload"])["tuples"]] == ["t1", "t2"]
    p = spark.createDataFrame([("entity", "甲", "new"), ("entity", "乙", "same")], "type string, concept string, description string")
    stored = spark.createDataFrame([("entity", "甲", "old", [1.0]), ("entity", "乙", "same", [2.0]), ("entity", "丙", "x", [3.0])], "type string, concept string, description string, vector array<double>")
    need, keep = MS.vector_sync(p, stored)
    assert [r["concept"] for r in need.collect()] == ["甲"] and [r["concept"] for r in keep.collect()] == ["乙"]


def test_answered_files(spark, tmp_path):
    asked = spark.createDataFrame([("1", "{}"), ("2", "{}")], "custom_id string, payload string")
    write_requests(asked, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    (tmp_path / "in.jsonl").write_text('{"custom_id": "1", "error": "busy"}\n{"custom_id": "1", "response": "{}"}\n{"custom_id": "2", "response": "{}"}\n')
    got = read_results(spark, str(tmp_path / "in.jsonl"))
    assert got.count() == 2 and got.where("error is not null").count() == 0

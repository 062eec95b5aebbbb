import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronoloom.plans import providers as PR
from chronoloom.plans.config import Config, parse_bool
from chronoloom.plans.scope import in_scope, names_match, parse_scope
from chronoloom.plans.stages import Plan, Stage
from chronoloom.sources import files as FI
from chronoloom.streaming import pool as SP


def test_scope(spark):
    assert parse_scope("E014-E001") == [("E", 1, 14)] and parse_scope("D001,E003-E004") == [("D", 1, 1), ("E", 3, 4)]
    assert parse_scope("all") is None and parse_scope(" ") is None
    with pytest.raises(ValueError):
        parse_scope("D001-E002")
    df = spark.createDataFrame([("D001 a.txt",), ("E004.txt",), ("plain.txt",), (None,)], "f string")
    assert [r["f"] for r in df.where(in_scope(F.col("f"), "D001,E001-E003")).collect()] == ["D001 a.txt"]
    assert df.where(in_scope(F.col("f"), "all")).count() == 4
    assert df.where(names_match(["d001"], F.col("f"))).count() == 1


def test_config():
    c = Config.load({"top_k": "3", "force": "yes"}, {"CHRONOLOOM_TOP_K": "5"})
    assert c.top_k == 5 and c.force is True and Config.load({}, {}).block_size == 128
    assert parse_bool("auto") is None and parse_bool("off") is False


def test_stages(spark, tmp_path):
    folder = f"file://{tmp_path}"
    plan = Plan([Stage("a", (), "ta", lambda s, f: s.range(3)), Stage("b", ("ta",), "tb", lambda s, f: s.read.parquet(f"{f}/ta.parquet").selectExpr("id * 2 AS id"))])
    with pytest.raises(FileNotFoundError):
        plan.run(spark, folder, plan.sequence(only=["b"]))
    assert plan.run(spark, folder, plan.sequence(run_all=True), dry=True) == {"a": "planned", "b": "planned"}
    assert plan.run(spark, folder, plan.sequence(run_all=True)) == {"a": "run", "b": "run"}
    assert plan.run(spark, folder, plan.sequence(start="b")) == {"b": "skipped"}
    assert [s.name for s in plan.sequence(only=["b", "a"])] == ["b", "a"]
    with pytest.raises(KeyError):
        plan.sequence(only=["c"])


def test_providers(spark, tmp_path):
    asked = spark.createDataFrame([("1", json.dumps({"sentence": "甲方宣布联合演习。"}, ensure_ascii=False)), ("2", json.dumps({"sentence": "甲方宣布联合演习。"}, ensure_ascii=False)), ("3", "no json")], "custom_id string, payload string")
    got = PR.answered(asked, None, PR.RuleExtractor, "x")
    rows = {r["custom_id"]: r for r in got.collect()}
    assert rows["3"]["error"] and rows["1"]["key"] == rows["2"]["key"]
    t = PR.checked_tuples(got.where("response is not null")).where("custom_id = '1'").first()
    assert t["valid"] and t["t"]["subject"][0]["concept"] == "甲方" and t["confidence"] == 0.6
    FI.store(got, str(tmp_path / "cache"))
    stored = FI.cached(spark, str(tmp_path / "cache"))
    assert stored.count() == 1 and PR.answered(asked.limit(2), stored, lambda: None, "x").count() == 2
    with pytest.raises(ValueError):
        PR.assert_complete(asked, got.limit(0))

    class Flaky:
        calls = 0

        def answer(self, payload):
            self.calls += 1
            if self.calls == 1:
                raise OSError("busy")
            return {"cut": payload["max_tokens"] < 4096, "tokens": payload["max_tokens"]}

    waits = []
    assert PR.Retrying(Flaky(), sleep=waits.append).answer({})["tokens"] == 4096 and waits[0] == 0.5


def test_answers(spark):
    words = spark.createDataFrame([("Reuse",), ("保留",), ("?",)], "w string")
    assert [r[0] for r in words.select(PR.action(F.col("w"))).collect()] == ["replace", "keep", None]
    kinds = spark.createDataFrame([("事实事件",), ("无需抽取的句子",), ("混合类",), ("x",)], "w string")
    assert [r[0] for r in kinds.select(PR.sentence_type(F.col("w"))).collect()] == ["事件句", "不抽取句", "混合句", None]
    bad = spark.createDataFrame([("1", '{"tuples":[{"subject":[],"relation":{"concept":"r"},"object":[{"concept":"o"}]},{"subject":[{"concept":"s"}],"relation":{"concept":"r"},"object":[{"concept":"o"}],"confidence":2}]}')], "custom_id string, response string")
    assert [r["fault"] for r in PR.checked_tuples(bad).orderBy("n").collect()] == ["subject", "confidence"]
    line = spark.createDataFrame([("d", '{"timeline":[{"event_id":2,"text":"b","source_sentence_ids":[0]},{"event_id":1,"text":"a","source_sentence_ids":[1]},{"event_id":-1,"text":"c"}]}')], "custom_id string, response string")
    events = PR.checked_timeline(line)
    assert PR.render_timeline(events).first()["text"] == "a\nb"
    assert PR.coverage(events, spark.createDataFrame([("d", 4), ("e", 0)], "custom_id string, n_sentences int")).where("custom_id = 'd'").first()["coverage"] == 0.5
    order = spark.createDataFrame([("d", '{"sorted_tuple_ids":["b","a"]}'), ("e", '{"sorted_tuple_ids":["x","x"]}')], "custom_id string, response string")
    tuples = spark.createDataFrame([("d", "a"), ("d", "b"), ("e", "x")], "custom_id string, tuple_id string")
    assert {(r["custom_id"], r["valid"]) for r in PR.checked_order(order, tuples).collect()} == {("d", True), ("e", False)}
    merge = spark.createDataFrame([("c1", '{"merge_groups":[{"source_concepts":["a","b","zz"],"merged_concept":"AB"},{"source_concepts":["b","c"],"merged_concept":"BC"}]}')], "custom_id string, response string")
    members = spark.createDataFrame([("c1", x) for x in "abc"], "cluster_id string, concept string")
    assert {(r["merged"], r["source"]) for r in PR.merge_groups(merge, members).collect()} == {("AB", "a"), ("AB", "b"), ("c", "c")}


def test_files(spark, tmp_path):
    (tmp_path / "sources").mkdir()
    (tmp_path / "cleaned").mkdir()
    (tmp_path / "sources" / "D001 甲+乙.txt").write_text("正文", encoding="utf-8")
    (tmp_path / "sources" / "x.txt").write_text("y", encoding="utf-8")
    folder, kind = FI.text_folder(spark, f"file://{tmp_path}", "D001")
    assert kind == "sources"
    rows = FI.read_texts(spark, folder, "D001").collect()
    assert [(r["file_name"], r["text"]) for r in rows] == [("D001 甲+乙.txt", "正文")]
    lines = tmp_path / "a.jsonl"
    lines.write_text('{"a":1}\n\n{"__done__": true}\n')
    assert [r["a"] for r in FI.read_json_lines(spark, f"file://{lines}", "a int").collect()] == [1] and FI.is_complete(spark, f"file://{lines}")
    with pytest.raises(FileNotFoundError):
        FI.read_json_lines(spark, f"file://{tmp_path}/none", "a int")
    df = spark.createDataFrame([("d1", 1), ("d2", 2)], "doc_id string, v int")
    FI.write_per_document(df, f"file://{tmp_path}/per")
    FI.write_json_lines(df, f"file://{tmp_path}/out")
    assert FI.is_complete(spark, f"file://{tmp_path}/out") and spark.read.json(f"file://{tmp_path}/per").count() == 2
    FI.write_vectors(spark.createDataFrame([("a", [1.0])], "id string, vector array<double>"), f"file://{tmp_path}/vec")
    assert FI.read_vectors(spark, f"file://{tmp_path}/vec").first()["vector"] == [1.0]


def test_streams(spark, tmp_path):
    schema = "tuple_id string, doc_id string, subject string, relation string, object string, location string, source_sent_id string, ingested_at timestamp"
    rows = [("t1", "d", "A", "r", "B", None, "s1", datetime(2025, 1, 1)), ("t2", "d", "A", "r", "C", None, "s2", datetime(2025, 1, 2)), ("t2", "d", "A", "r", "C", None, "s2", datetime(2025, 1, 2))]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = SP.pool_stream(stream, str(tmp_path / "pool"), str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r["concept"], r["count"]) for r in SP.read_pool(spark, str(tmp_path / "pool")).collect()} == {("A", 2), ("B", 1), ("C", 1), ("r", 2)}
    q = SP.windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT sum(tuples) FROM counts").first()[0] == 3


def test_files_of_every_kind(spark, tmp_path):
    root = f"file://{tmp_path}"
    # Only the last line counts as the sentinel.
    (tmp_path / "early.jsonl").write_text('{"__done__": true}\n{"a": 1}\n')
    (tmp_path / "late.jsonl").write_text("x" * 9_000 + '\n{"__done__": true}\n\n')
    (tmp_path / "empty.jsonl").write_text("")
    assert [FI.is_complete(spark, f"{root}/{n}") for n in ("early.jsonl", "late.jsonl", "empty.jsonl", "none")] == [False, True, False, False]
    FI.write_json_object(spark, f"{root}/m.json", [{"a": "ä"}, 3, {"b": 1}])
    FI.write_json_object(spark, f"{root}/m.json", [{"a": "ä"}, 3])
    assert FI.read_json_object(spark, f"{root}/m.json") == [{"a": "ä"}] and not (tmp_path / "m.json.part").exists()
    texts = spark.createDataFrame([("D001 a+b.txt", "eins\nzwei"), ("D002.txt", None), (None, "x")], "file_name string, text string")
    assert {tuple(r) for r in FI.write_texts(texts, f"{root}/texts").collect()} == {("D001 a+b.txt", 1), ("D002.txt", 1)}
    assert [(r["file_name"], r["text"]) for r in FI.first_files(spark, f"{root}/texts", 1).collect()] == [("D001 a+b.txt", "eins\nzwei")]
    rows = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 3), ("d3", 4), ("d4", 5)], "doc_id string, n int")
    names = spark.createDataFrame([("d1", "Title: one"), ("d2", " "), ("d3", "same"), ("d4", "same")], "doc_id string, name string")
    assert {tuple(r) for r in FI.write_per_document(rows, f"{root}/split", names).collect()} == {("Title_ one.jsonl", 2), ("d2.jsonl", 1), ("d3.jsonl", 1), ("d4.jsonl", 1)}
    assert (tmp_path / "split" / "Title_ one.jsonl").read_text() == '{"n":1}\n{"n":2}\n'
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0]), (None, [1.0, 1.0])], "id string, vector array<double>")
    FI.write_archives(vectors, f"{root}/npz")
    assert {(r["id"], *r["vector"]) for r in FI.read_archives(spark, f"{root}/npz").collect()} == {("a", 1.0, 2.0), ("b", 3.0, 4.0)}
    assert FI.write_archives(vectors.where("false"), f"{root}/none").count() == 0


def test_embedding_service(spark):
    class Moody:
        """Fails on texts with an x, answers one vector too few for those with a y."""

        def embed(self, texts):
            if any("x" in t for t in texts):
                raise OSError("busy")
            return [[float(len(t))] for t in texts if "y" not in t]

    rows = spark.createDataFrame([(1, "aa"), (2, "aa"), (3, "x"), (4, None), (5, "y"), (6, "bbb")], "id int, text string").coalesce(1)
    got = {r["id"]: (r["vector"], (r["error"] or "").split(":")[0]) for r in PR.embedded(rows, Moody, most=1, retries=1, sleep=lambda s: None).collect()}
    assert got == {1: ([2.0], ""), 2: ([2.0], ""), 3: (None, "OSError"), 4: (None, ""), 5: (None, "ValueError"), 6: ([3.0], "")}
    assert all(len(r["vector"]) == 64 for r in PR.embedded(rows.where("text is not null"), PR.HashedEmbedder).collect())


class Desk:
    """A service of files that is done at the third look; the second one fails."""

    submitted, looks = 0, 0

    def submit(self, path):
        Desk.submitted += 1
        return "job-1"

    def state(self, job):
        Desk.looks += 1
        if Desk.looks == 2:
            raise ConnectionError
        return "running" if Desk.looks == 1 else "completed"

    def fetch(self, job, path):
        with open(path.removeprefix("file://"), "w") as f:
            f.write('{"custom_id": "1", "response": "{}"}\n')


def test_answers_by_files(spark, tmp_path):
    asked = spark.createDataFrame([("1", "{}")], "custom_id string, payload string")
    once = lambda: PR.answered_by_files(asked, f"file://{tmp_path}", Desk(), sleep=lambda s: None)
    with pytest.raises(ConnectionError):
        once()
    # Broken off; the next run goes on with the same job.
    assert [r["custom_id"] for r in once().collect()] == ["1"] and [r["custom_id"] for r in once().collect()] == ["1"] and Desk.submitted == 1

from datetime import datetime

from chronoloom.operators import tuples as TU

SCHEMA = "tuple_id string, doc_id string, sent_id string, subject string, relation string, object string, location string, time string, source_sent_id string, confidence double, ingested_at timestamp"


def frame(spark, rows):
    """Rows of (tuple_id, subject, relation, object, location, time)."""
    at = datetime(2025, 1, 1)
    full = [(t, t.split("_")[0], t, s, r, o, l, tm, t.rsplit("_", 1)[0], None, at) for t, s, r, o, l, tm in rows]
    return spark.createDataFrame(full, SCHEMA)


def test_delete_reasons(spark, cluttered):
    df = frame(
        spark,
        [
            ("d_s001_t001", "A", "r", "B", None, "2024年3月5日"),
            ("d_s001_t002", "A", "r", "B", None, "2024-03-05"),
            ("d_s001_t003", "C", "r", "C", None, None),
            ("d_s001_t004", "C", "r", "D", None, "近期"),
            ("d_s001_t005", "E", "r", None, None, " "),
            ("d_s001_t006", "C", "r", "C", None, None),
        ],
    )
    df = df.unionByName(df.limit(1))
    got = {r["tuple_id"][-1]: (r["copies"], r["reasons"]) for r in TU.delete_reasons(cluttered(df)).collect()}
    assert got["1"] == (2, []) and got["2"] == (1, ["duplicate_in_doc"]) and got["3"][1] == ["subject_equals_object"]
    assert got["4"][1] == ["unreliable_time_anchor"] and got["5"][1] == [] and got["6"][1] == ["duplicate_in_doc", "subject_equals_object"]
    assert TU.cleaned(df.where("false")).count() == 0


def test_merging(spark, scratch, cluttered):
    df = frame(
        spark,
        [
            ("d_s001_t001", "A", "r", "X", "P", "2024"),
            ("d_s001_t002", "A", "r", "Y", None, "2024"),
            ("d_s001_t003", "B", "r", "Y", "Q", "2024"),
            ("d_s001_t004", "C", "r", "Z", None, "2024"),
            ("d_s001_t005", "A", "r", "X", None, "2023"),
            ("d_s001_t006", None, "r", " ", None, "2024"),
            ("d_s002_t001", "C", "r", "Z", "W", "2024"),
        ],
    )
    merged = scratch.cut(TU.merged_in_sentences(cluttered(df.unionByName(df)), scratch))
    got = {r["tuple_id"]: (r["subjects"], r["objects"], r["locations"], r["members"]) for r in merged.collect()}
    assert got["d_s001_t001"] == (["A", "B"], ["X", "Y"], ["P", "Q"], 3)
    assert got["d_s001_t004"] == (["C"], ["Z"], [], 1) and got["d_s001_t005"][3] == 1 and got["d_s001_t006"][:2] == ([], [])
    assert sum(v[3] for v in got.values()) == 7
    across = {r["tuple_id"]: (r["locations"], r["copies"]) for r in TU.merged_across_document(merged).collect()}
    assert across["d_s001_t004"] == (["W"], 2) and "d_s002_t001" not in across
    figures = TU.merge_figures(df, merged, TU.merged_across_document(merged)).first()
    assert (figures["tuples"], figures["sentence_tuples"], figures["merged_away"], figures["duplicates"]) == (7, 5, 2, 1)
    parts = [(r["part"], r["subject"], r["object"]) for r in TU.expanded(merged).where("tuple_id = 'd_s001_t001'").orderBy("part").collect()]
    assert parts == [(1, "A", "X"), (2, "A", "Y"), (3, "B", "X"), (4, "B", "Y")]
    assert TU.merged_in_sentences(df.where("false"), scratch).count() == 0


def test_long_chain_merges_to_one(spark, scratch):
    rows = [(f"d_s001_t{i:03d}", f"S{i // 2}", "r", f"O{(i + 1) // 2}", None, None) for i in range(200)]
    assert TU.merged_in_sentences(frame(spark, rows), scratch).count() == 1


def test_story_order(spark, scratch):
    times = {"a": "2024-05-02", "b": "2024-05-01", "c": "2023-07", "d": "2023-06-09", "e": "2022", "f": "2022-03", "g": ""}
    df = frame(spark, [(f"d_s001_t{i:03d}", k, "r", "o", None, t) for i, (k, t) in enumerate(times.items(), 1)])
    got = [r["subject"] for r in TU.in_story_order(df.unionByName(df), scratch).orderBy("position").collect()]
    assert "".join(got) == "efdcbag"
    assert TU.in_story_order(df.where("false"), scratch).count() == 0


def test_counts(spark, scratch):
    df = frame(spark, [(f"d_s00{s}_t{i:03d}", "A", "r", "B", None, None) for s, n in ((1, 3), (2, 1), (3, 1)) for i in range(n)])
    assert [(r["rank"], r["sentence_id"], r["tuple_count"]) for r in TU.sentence_counts(df, scratch).orderBy("rank").collect()] == [(1, "d_s001", 3), (2, "d_s002", 1), (3, "d_s003", 1)]
    f = TU.global_counts(df).first()
    assert (f["tuples"], f["sentences"], f["most"], f["least"], f["mean"], f["median"]) == (5, 3, 3, 1, 1.6667, 1.0)
    assert "| 3 | 1 |" in TU.report_markdown(TU.global_counts(df), TU.count_histogram(df))


def test_unresolved_samples(spark):
    df = frame(spark, [(f"d_s001_t{i:03d}", "A", "r", "B", None, "近期") for i in range(9)])
    r = TU.unresolved_times(df).first()
    assert r["tuples"] == 9 and r["sample_ids"] == [f"d_s001_t{i:03d}" for i in range(5)]


def test_groups_of_any_size_merge_alike(spark, scratch):
    """Groups that are gathered and groups that are reduced by stars give the same."""
    import random

    rng = random.Random(3)
    pick = lambda names: rng.choice([*names, None, " "])
    rows = [(f"d_s00{rng.randrange(3)}_t{i:03d}", pick("ABCDEFGHIJ"), rng.choice("rq"), pick("UVWXYZKLMN"), pick("PQ"), rng.choice([None, "2024"])) for i in range(120)]
    df = frame(spark, rows)
    as_set = lambda d: {tuple(map(str, r)) for r in d.select("tuple_id", "sentence_id", "relation", "time", "subjects", "objects", "locations", "members").collect()}
    gathered = as_set(TU.merged_in_sentences(df, scratch))
    assert gathered == as_set(TU.merged_in_sentences(df, scratch, most=0)) == as_set(TU.merged_in_sentences(df, scratch, most=9)) and 3 < len(gathered) < 100

"""Canonical entries and survivors."""

import random
from datetime import datetime

from chronoloom.llm.canonical import resolve
from chronoloom.llm.survivors import SUMMED, field_winners, survivors

REF = [("e1", "隆雾泽渔业协会", "entity", ["Longwuze Fisheries", "隆渔会"]), ("e2", "隆雾泽渔业公司", "entity", None), ("l1", "春渡定群岛", "location", []), ("r1", "促成联合演习", "relation", [])]
ASKED = {
    "隆雾泽渔业协会": "e1", "　隆霧澤漁業協會\t": "e1", "隆雾泽-渔业协会": "e1", "隆雾泽渔业协": "e1", "隆雾泽渔业协会会": "e1", "隆雾泽业渔协会": "e1", "隆雾泽渔业木会": "e1", "隆雾渔业协": "none", "所谓隆雾泽渔业协会（简称）": "e1",
    "有关隆雾泽渔业协等": "e1", "ＬＯＮＧＷＵＺＥ　ｆｉｓｈｅｒｉｅｓ": "e1", "the longwuze  fishreies": "e1", "Longwuze Fishres": "none", "隆渔会": "e1", "春渡定群岛": "none", "隆雾泽渔业公": "e2", "They": "none", "雾隆渔泽业协会": "none", "…": "none",
}


def reference(spark):
    return spark.createDataFrame(REF, "cid string, canonical_str string, type string, aliases array<string>")


def records(spark, rows):
    return spark.createDataFrame(rows, "origin string, record_key string, type string, raw_str string")


def test_resolve(spark, cluttered):
    rows = [("x", str(i), "entity", s) for i, s in enumerate(ASKED)]
    rows += [("x", "loc", "location", "春渡定群島一带"), ("x", "null", "entity", None), ("x", "blank", "entity", " 　"), ("x", "kind", None, "隆渔会"), ("x", "long", "entity", "隆" * 50_000), *rows[:3]]
    got = {r["record_key"]: r["cid"] for r in resolve(cluttered(records(spark, rows)), cluttered(reference(spark))).collect()}
    assert {s: got[str(i)] for i, s in enumerate(ASKED)} == ASKED
    assert got["loc"] == "l1" and got["kind"] == "none" and got["long"] == "none" and "null" not in got and "blank" not in got
    assert resolve(records(spark, rows).where("false"), reference(spark)).count() == 0
    assert {r["cid"] for r in resolve(records(spark, rows), reference(spark).where("false")).collect()} == {"none"}


def osa(a, b):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_slips_against_brute_force(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("abc") for _ in range(rng.randint(4, 7))) for _ in range(40)]
    ref = spark.createDataFrame([(f"c{i}", n, "entity", []) for i, n in enumerate(names)], "cid string, canonical_str string, type string, aliases array<string>")
    asked = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    got = {r["record_key"]: r["cid"] for r in resolve(records(spark, [("x", str(i), "entity", s) for i, s in enumerate(asked)]), ref).collect()}
    for i, s in enumerate(asked):
        near = min(osa(s, n) for n in names)
        assert (got[str(i)] != "none") == (near <= 1)
        if near <= 1:
            assert osa(s, names[int(got[str(i)][1:])]) == near


def test_survivors(spark, cluttered):
    d = lambda n: datetime(2025, 1, n)
    rows = [
        (5, "a", "Old", "short", 3, 9, d(1)),
        (4, "a", "New", "a longer text  ", 0, 9, d(2)),
        (3, "a", "N/A", "？？？", -1, 10, d(9)),
        (2, "a", "Null date", "a longer text", 7, 9, None),
        (2, "a", "Null date", "a longer text", 7, 9, None),
        (9, "b", " ", None, None, 1, d(1)),
        (8, "c", "x", "y", 1, None, None),
        (7, "c", "z", "w", 2, None, None),
        (1, None, "q", "q", 1, 1, d(1)),
    ]
    df = spark.createDataFrame(rows, "record_id long, id string, raw_str string, description string, count int, trust int, updated_at timestamp")
    got = {(r["id"], r["field"]): r["record_id"] for r in field_winners(cluttered(df)).collect()}
    assert got == {("a", "raw_str"): 4, ("a", "description"): 4, ("a", "count"): 5, ("c", "raw_str"): 7, ("c", "description"): 7, ("c", "count"): 7}
    s = {r["id"]: tuple(r)[1:] for r in survivors(df).collect()}
    assert s == {"a": ("New", "a longer text  ", 3), "c": ("z", "w", 2)}
    assert field_winners(df.where("false")).count() == 0


def test_votes(spark):
    d = datetime(2025, 1, 1)
    rows = [(1, "a", "X", None, None, 3, d), (2, "a", " x ", None, None, 3, d), (3, "a", "Y", None, None, 5, d)]
    df = spark.createDataFrame(rows, "record_id long, id string, raw_str string, description string, count int, trust int, updated_at timestamp")
    r = field_winners(df).first()
    assert r["record_id"] == 3 and r["favourite"].strip().lower() == "x" and r["favourite_votes"] == 6.0


def test_votes_elect(spark):
    """Winners follow the votes: other weights, or other votes, elect other values."""
    d = lambda n: datetime(2025, 1, n)
    rows = [(1, "a", "X", "long words", 1, 3, d(3)), (2, "a", " x ", "long words", 1, 3, d(3)), (3, "a", "Y", "tiny", 2, 5, d(1)), (4, "a", "Z", "w", 3, None, None)]
    df = spark.createDataFrame(rows, "record_id long, id string, raw_str string, description string, count int, trust int, updated_at timestamp")
    won = lambda **p: {r["field"]: r["record_id"] for r in field_winners(df, **p).collect()}
    assert won() == {"raw_str": 3, "description": 1, "count": 1}
    assert won(policy=SUMMED) == {"raw_str": 1, "description": 1, "count": 1}
    assert won(policy={**SUMMED, "raw_str": ("recency",), "count": ("trust",)}) == {"raw_str": 1, "description": 1, "count": 3}
    one_voter_less = df.where("record_id <> 2")
    assert {r["field"]: r["record_id"] for r in field_winners(one_voter_less, policy=SUMMED).collect()} == {"raw_str": 3, "description": 3, "count": 3}
    # A decay that hardly counts makes three votes of trust 3 and 3 beat one of 5, a sharp one all the more.
    assert field_winners(df, policy=SUMMED, half_life_days=1.0).where("field = 'raw_str'").first()["record_id"] == 1

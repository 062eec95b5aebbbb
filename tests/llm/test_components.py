import random

import pytest

from chronoloom.llm.components import components, group_elements


def brute(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = {}
    for x in list(root):
        groups.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


def grouped(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["label"], set()).add(r["node"])
    return {frozenset(g) for g in out.values()}


def shapes():
    rng = random.Random(5)
    star = [(0, i) for i in range(1, 60)]
    path = [(i, i + 1) for i in range(1000, 1150)]
    cycle = [(2000 + i, 2000 + (i + 1) % 33) for i in range(33)]
    even = [(2100 + i, 2100 + (i + 1) % 64) for i in range(64)]
    tree = [(3000 + i, 3000 + (i - 1) // 2) for i in range(1, 127)]
    lollipop = [(4000 + a, 4000 + b) for a in range(6) for b in range(a)] + [(4005 + i, 4006 + i) for i in range(40)] + [(4045, 4003)]
    mesh = [(5000 + rng.randrange(300), 5000 + rng.randrange(300)) for _ in range(330)]
    two = [(6000, 6001), (6002, 6002)]
    return star + path + cycle + even + tree + lollipop + mesh + two


def test_all_shapes(spark, scratch):
    pairs = shapes()
    rng = random.Random(1)
    noisy = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in pairs * 2]
    rng.shuffle(noisy)
    df = spark.createDataFrame([*noisy, (None, 1), (7, None)], "a long, b long")
    got = components(df, scratch)
    assert grouped(got) == brute(pairs)
    assert got.count() == len({x for p in pairs for x in p})


def test_empty(spark, scratch):
    assert components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0


def test_elements(spark, cluttered):
    e = spark.createDataFrame(
        [("e1", "entity", "a"), ("e1", "entity", "a"), ("e2", "entity", "b"), ("e3", "relation", "a"), ("e4", "entity", "lone"), ("e5", "entity", None), (None, "entity", "a"), ("e6", None, "a"), ("e0", "entity", "b"), ("e7", "entity", "self")],
        "id string, type string, alias_key string",
    )
    m = spark.createDataFrame(
        [("entity", " A\t", "ghost"), ("entity", "GHOST　", "b"), ("entity", "b", "a"), (None, "a", "lone"), ("entity", " ", "lone"), ("entity", None, "lone"), ("relation", "a", "zzz"), ("entity", "self", "SELF ")],
        "element_type string, left_key string, right_key string",
    )
    got = {(r["element_id"], r["group_id"]) for r in group_elements(cluttered(e), cluttered(m)).collect()}
    assert got == {("e1", "e0"), ("e2", "e0"), ("e0", "e0"), ("e3", "e3"), ("e7", "e7")}
    assert group_elements(e.where("false"), m).count() == 0 and group_elements(e, m.where("false")).count() == 0


@pytest.mark.parametrize("n", [3000])
def test_hub_and_long_chain(spark, scratch, n):
    pairs = [(0, i) for i in range(1, n)] + [(n + i, n + i + 1) for i in range(n)]
    df = spark.createDataFrame(pairs, "a long, b long")
    assert grouped(components(df, scratch)) == brute(pairs)

"""Clusters and neighbours against brute force."""

import numpy as np
import pytest

from chronoloom.llm import clusters as CL
from chronoloom.llm import neighbours as NB
from chronoloom.llm import vectors as VE

SCHEMA = "id string, type string, vector array<float>"


def cloud(n=900, d=24, groups=150, seed=1):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((groups, d))
    owner = rng.integers(0, groups, n)
    x = c[owner] + 0.25 * rng.standard_normal((n, d))
    x[n // 2 : n // 2 + 30] = x[7] * np.linspace(0.5, 4, 30)[:, None]  # copies up to length
    return (x * rng.uniform(0.5, 3, (n, 1))).astype(np.float32)


def frame(spark, x, kind="entity"):
    return spark.createDataFrame([(f"id{i:05d}", kind, v.tolist()) for i, v in enumerate(x)], SCHEMA)


def cosines(x):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = np.round(u @ u.T, 7)
    np.fill_diagonal(s, -2)
    return s


def expected_pairs(s, k, least):
    out = set()
    for i in range(len(s)):
        c = np.flatnonzero(s[i] >= least)
        for j in c[np.lexsort((c, -s[i, c]))][:k]:
            out.add((f"id{min(i, j):05d}", f"id{max(i, j):05d}"))
    return out


BAD = [("bad1", "entity", None), ("bad2", "entity", []), ("bad3", "entity", [1.0] * 5), ("bad4", "entity", [0.0] * 24), ("bad5", "entity", [float("nan")] + [1.0] * 23), ("bad6", "entity", [float("inf")] + [1.0] * 23), (None, "entity", [1.0] * 24), ("bad7", None, [1.0] * 24)]


def test_neighbours(spark, cluttered):
    x = cloud()
    df = frame(spark, x)
    noisy = df.unionByName(df.limit(50)).unionByName(spark.createDataFrame(BAD, SCHEMA)).unionByName(frame(spark, x[:1] * 2, "relation").selectExpr("concat('r', id) id", "type", "vector"))
    got = {(r["id_a"], r["id_b"]) for r in NB.neighbour_pairs(cluttered(noisy), k=5, least=0.7, dimension=24).collect()}
    want = expected_pairs(cosines(x), 5, 0.7)
    assert len(got & want) / len(want) >= 0.97 and len(got - want) <= 0.03 * len(want)
    assert NB.neighbours(df.where("false"), dimension=24).count() == 0


def test_neighbours_in_blocks_are_the_same(spark, monkeypatch):
    df = frame(spark, cloud())
    whole = set(NB.neighbours(df, k=5, least=0.7, dimension=24).select("id", "near", "rank").collect())
    monkeypatch.setattr(NB, "BLOCK_ROWS", 20)
    assert set(NB.neighbours(df, k=5, least=0.7, dimension=24).select("id", "near", "rank").collect()) == whole


def test_hot_copies(spark):
    x = cloud(300)
    x = np.vstack([x, np.repeat(x[5:6], 2000, axis=0)])
    x = x[np.random.default_rng(2).permutation(len(x))]
    df = frame(spark, x)
    assert NB.followers(df, 5).count() == 2001 - 6
    got = {(r["id_a"], r["id_b"]) for r in NB.neighbour_pairs(df, k=5, least=0.7, dimension=24).collect()}
    want = expected_pairs(cosines(x), 5, 0.7)
    assert len(got & want) / len(want) >= 0.99 and len(got - want) <= 0.01 * len(want)


def test_one_cell_is_exact():
    x = cloud(400)
    s = cosines(x)
    u = VE.unit(x)
    every = np.ones(len(x), bool)
    for leaf in (16, 1000):
        NB.LEAF_ROWS, keep = leaf, NB.LEAF_ROWS
        row, near, cos = NB.cell_neighbours(np.arange(len(x)), u, 5, 0.7, 0.9999, every, every)
        NB.LEAF_ROWS = keep
        got = {(f"id{min(a, b):05d}", f"id{max(a, b):05d}") for a, b in zip(row, near, strict=True)}
        assert got == expected_pairs(s, 5, 0.7)


def test_chi_square():
    for dof, p, value in ((1, 0.95, 3.841), (8, 0.995, 21.955), (24, 0.99, 42.98)):
        assert VE.chi_square_quantile(dof, p) == pytest.approx(value, rel=0.03)


def clear_groups(seed=4):
    """Groups whose members all have a cosine of 0.77 with one another, and no one else has."""
    rng = np.random.default_rng(seed)
    c = np.eye(24)[:20]
    owner = np.r_[np.repeat(np.arange(19), rng.integers(1, 30, 19)), np.full(120, 19)]
    return owner, (c[owner] + 0.05 * rng.standard_normal((len(owner), 24))).astype(np.float32)


@pytest.mark.parametrize("block", [4000, 15])
def test_clusters(spark, cluttered, monkeypatch, block):
    monkeypatch.setattr(CL, "BLOCK_ROWS", block)
    owner, x = clear_groups()
    df = frame(spark, x)
    noisy = df.unionByName(df.limit(20)).unionByName(spark.createDataFrame(BAD, SCHEMA))
    got = {r["id"]: r["cluster_id"] for r in CL.clusters(cluttered(noisy), dimension=24).collect()}
    first = {o: f"id{np.flatnonzero(owner == o)[0]:05d}" for o in set(owner.tolist())}
    assert got == {f"id{i:05d}": first[o] for i, o in enumerate(owner.tolist())}


def test_cluster_reports(spark):
    owner, x = clear_groups()
    df = frame(spark, x)
    d = CL.describe(df, members=2, dimension=24).collect()
    assert sum(r["size"] for r in d) == len(x) and all(len(r["typical"]) == min(2, r["size"]) for r in d)
    big = max(d, key=lambda r: r["size"])
    u = VE.unit(x[owner == 19])
    ids = np.flatnonzero(owner == 19)
    assert big["typical"][0] == f"id{ids[(u @ u.sum(0)).argmax()]:05d}"
    s = CL.summary(df, dimension=24).first()
    sizes = np.bincount(owner)
    assert (s["cluster_count"], s["multi_member_cluster_count"]) == ((sizes > 0).sum(), (sizes > 1).sum())
    pairs = CL.cluster_pairs(df, dimension=24)
    assert pairs.count() == (sizes * (sizes - 1) // 2).sum() and pairs.where("id_a >= id_b").count() == 0
    assert CL.clusters(df.where("false"), dimension=24).count() == 0


def test_features_merge():
    rng = np.random.default_rng(0)
    x = VE.unit(rng.standard_normal((200, 8)))
    t = CL.FeatureTree(8)
    leaf = np.concatenate([t.insert(x[:100], 0.8), t.insert(x[100:], 0.8)])
    assert t.count.sum() == 200 and np.allclose(t.sums.sum(0), x.sum(0)) and leaf.min() == 0 and leaf.max() == len(t.count) - 1
    label = CL.ward(np.array([1.0, 1, 1]), VE.unit(np.array([[1.0, 0], [1, 0.1], [0, 1]])), 0.77)
    assert label[0] == label[1] != label[2]


def test_feature_trees_merge():
    """Trees of two halves merged hold the same features as one tree, however the rows were split."""
    rng = np.random.default_rng(3)
    heads = VE.unit(rng.standard_normal((12, 96)))
    x = VE.unit(np.repeat(heads, 40, 0) + 0.02 * rng.standard_normal((480, 96)))
    whole, merged = CL.FeatureTree(96), CL.FeatureTree(96)
    whole.insert(x, 0.9)
    for part in (x[::2], x[1::2]):
        tree = CL.FeatureTree(96)
        tree.insert(part, 0.9)
        merged.merge(tree.count, tree.sums, 0.9)
    assert len(whole.count) == len(merged.count) == 12 and merged.count.sum() == 480
    assert np.allclose(np.sort(whole.sums.sum(1)), np.sort(merged.sums.sum(1)))


def test_hot_cell_of_copies(spark, monkeypatch):
    """A third of all rows with the same vector, over many blocks, is one cluster; a leaf for each block is all that goes on."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(CL, "BLOCK_ROWS", 50)
    base = VE.unit(rng.standard_normal((201, 96)))
    rows = [(f"e{i:04d}", "entity", [float(f) for f in base[0 if i % 3 == 0 else i % 200 + 1]]) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, type string, vector array<float>")
    size = CL.clusters(df).groupBy("cluster_id").count()
    assert size.agg({"count": "sum"}).first()[0] == 600 and size.agg({"count": "max"}).first()[0] == 200


def test_kd_tree_stops():
    """Queries with near neighbours leave out leaves that lie far away; nothing is missed for it."""
    rng = np.random.default_rng(9)
    heads = VE.unit(rng.standard_normal((40, 8)))
    x = VE.unit(np.repeat(heads, 50, 0) + 0.01 * rng.standard_normal((2000, 8)))
    every, tally = np.ones(len(x), bool), {}
    row, near, cos = NB.cell_neighbours(np.arange(len(x)), x, 5, 0.7, 0.999, every, every, tally)
    s = cosines(x)
    want = {(i, int(j)) for i in range(len(x)) for j in np.lexsort((np.arange(len(x)), -s[i]))[:5] if s[i, j] >= 0.7}
    got = set(zip(row.tolist(), near.tolist(), strict=True))
    assert len(want - got) <= 0.002 * len(want) and tally["rows"] == 2000 * 2000 and tally["verified"] < 0.5 * tally["rows"]


def test_all_cells_that_the_test_asks_for(spark):
    x = cloud(seed=5)
    df = frame(spark, x)
    some = {tuple(r) for r in NB.neighbours(df, least=0.7, dimension=24).select("id", "near").collect()}
    every = {tuple(r) for r in NB.neighbours(df, least=0.7, dimension=24, most_cells=None).select("id", "near").collect()}
    assert len(every) >= len(some) * 0.999


@pytest.mark.parametrize("above", [10, 60])
def test_large_cells_are_split_again(spark, monkeypatch, above):
    """With cells split on several levels neighbours and clusters stay those of brute force."""
    for name, value in (("SPLIT_ABOVE", above), ("SPLIT_SAMPLE", 100), ("SPLIT_ROWS", 40), ("ROWS_PER_CELL", 5), ("BLOCK_ROWS", 30)):
        monkeypatch.setattr(VE, name, value)
    x = cloud(400, groups=60, seed=8)
    df = frame(spark, x)
    s = cosines(x)
    want = {(f"id{i:05d}", f"id{j:05d}") for i in range(len(x)) for j in np.lexsort((np.arange(len(x)), -s[i]))[:3] if s[i, j] >= 0.85}
    got = {tuple(r) for r in NB.neighbours(df, 3, 0.85, 24, 0.99999, None).select("id", "near").collect()}
    assert len(want ^ got) <= 0.01 * len(want)
    apart = np.random.default_rng(1).standard_normal((80, 24))
    y = np.repeat(apart, 5, 0) + 0.05 * np.random.default_rng(2).standard_normal((400, 24))
    found = CL.clusters(frame(spark, y), 0.9, 24).toPandas()
    assert found.groupby("cluster_id")["id"].size().tolist() == [5] * 80

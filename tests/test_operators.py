import os
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.functions import text as X
from chronoloom.functions import timeline as TL
from chronoloom.functions.vectors import cosine, unit, weighted_sum
from chronoloom.operators import canonical as CA
from chronoloom.operators import clustering as CL
from chronoloom.operators import concepts as CO
from chronoloom.operators import docgraph as DG
from chronoloom.operators import graph as GR
from chronoloom.operators import lexical as LX
from chronoloom.operators import similarity as SI
from chronoloom.operators import timeline as TLO
from chronoloom.operators.ranking import distributed_rank
from chronoloom.queries import QUERIES

#: The query sets have rows here.
LARGER = "/root/testdata/sf0.01"


def vectors(spark, n=60, d=8, groups=3, seed=3):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((groups, d))
    rows = [(i, (c[i % groups] + 0.4 * rng.standard_normal(d)).tolist(), i % groups) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, vector array<double>, label int")


def matrix(rows):
    m = np.array([r[1] for r in rows])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_rank(spark, scratch):
    df = spark.createDataFrame([(g, v) for g in ("a", None) for v in range(50)] + [("b", 0)], "g string, v int")
    got = {(r["g"], r["v"]): r["k"] for r in distributed_rank(df, ["g"], [F.desc("v")], "k", scratch).collect()}
    assert len(got) == 101 and got["a", 49] == 1 and got[None, 0] == 50 and got["b", 0] == 1


def test_vector_functions(spark):
    r = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [4.0, 3.0, 0.0])], "a array<double>, b array<double>, c array<double>")
    got = r.select(unit("a").alias("u"), unit("b").alias("z"), cosine(F.col("a"), F.col("b")).alias("zero"), cosine(F.col("a"), F.col("c")).alias("odd"), weighted_sum([(F.col("a"), 0.5), (F.col("a"), 0.5)]).alias("w")).first()
    assert got["u"] == [0.6, 0.8] and got["z"] == [0.0, 0.0] and got["zero"] == got["odd"] == 0.0 and np.allclose(got["w"], [0.6, 0.8])


def test_search_and_neighbours(spark, cluttered):
    rows, df = vectors(spark)
    s = matrix(rows) @ matrix(rows).T
    np.fill_diagonal(s, -2)
    want = {(i, int(j)) for i in range(0, 60, 10) for j in np.argsort(-s[i])[:4]}
    assert {(r["query"], r["id"]) for r in SI.search(cluttered(df.where("id % 10 = 0")), cluttered(df), k=4).collect()} == want
    assert SI.search(df.where("false"), df, k=4).count() == 0
    same = np.array([r[2] for r in rows])
    whole = {(i, int(j)) for i in range(60) for j in sorted(np.flatnonzero((same == same[i]) & (s[i] >= 0.2)), key=lambda j: (-s[i, j], j))[:3]}
    for size in (1000, 5):  # one block, and pairs of blocks
        near = SI.group_neighbours(df, "label", 3, 0.2, block_rows=size)
        assert {(r["id"], r["near"]) for r in near.collect()} == whole
    mutual = {(r["source"], r["target"]) for r in SI.mutual_edges(near).collect()}
    assert mutual == {(a, b) for a, b in whole if a < b and (b, a) in whole}
    for size in (1000, 5):
        f = SI.group_figures(df, "label", block_rows=size).where("label = 1").first()
        pairs = s[np.ix_(same == 1, same == 1)][np.triu_indices(20, 1)]
        assert f["size"] == 20 and np.isclose(f["avg_similarity"], pairs.mean(), atol=1e-5) and np.isclose(f["min_similarity"], pairs.min(), atol=1e-5)
    one = SI.group_figures(df.where("id = 7"), "label").first()
    assert (one["size"], one["avg_similarity"]) == (1, 1.0)
    m = SI.medoids(cluttered(df.select("id", "label", unit("vector").alias("u"))), "label", 8).where("label = 2").first()
    inner = s[np.ix_(same == 2, same == 2)].copy()
    np.fill_diagonal(inner, 0)
    assert m["id"] == np.flatnonzero(same == 2)[inner.sum(1).argmax()]


def test_clusterings(spark, scratch):
    rows, df = vectors(spark, 200, 8, 5)
    blocked = SI.vector_blocks(df.select("id", "vector"), 40)
    assert blocked.count() == 200 and blocked.groupBy("block").count().agg(F.max("count")).first()[0] <= 160
    for method in ("balanced", "average"):
        got = CL.cluster_blocks(blocked, scratch, method, CL.Sizes(target=8, least=2, most=20, k=6, absorb=0.2)).toPandas()
        assert sorted(got["id"]) == list(range(200)) and got["cluster_id"].min() == "c0001"
        assert (got.groupby("cluster_id")["id"].size() == got.groupby("cluster_id")["size"].first()).all()
    u = matrix(rows)
    label = CL.average_linkage(u, 5)
    assert len(set(label)) == 5
    assert CL.balance_penalty(np.zeros(60, int), CL.Sizes()) > CL.balance_penalty(np.repeat([0, 1], 24), CL.Sizes())
    w = np.kron(np.eye(2), np.ones((4, 4))) - np.eye(8)
    assert len(set(CL.modularity_communities(w, 0.5))) == 2
    assert CL.absorb_small(np.array([[1.0, 0], [1, 0.1], [0.9, 0]]), np.array([0, 0, 1]), CL.Sizes(least=2, most=5, absorb=0.3)).tolist() == [0, 0, 0]
    assert CL.projected_points(df).count() == 200


def test_greedy_and_links(spark, scratch):
    rows = [("entity", "0", f"e{i}", n, n.lower(), c, v) for i, (n, c, v) in enumerate([("Aa", 5, [1.0, 0.0]), ("AA", 2, [0.0, 1.0]), ("B", 3, [0.99, 0.05]), ("C", 1, [-1.0, 0.0])])]
    df = spark.createDataFrame(rows, "type string, block string, id string, raw_str string, alias_key string, count int, vector array<double>")
    got = {r["id"]: r["cid"] for r in CA.greedy_merge(df, "block").collect()}
    assert got == {"e0": "e0", "e1": "e0", "e2": "e0", "e3": "e3"}


def test_canonical(spark):
    ref = spark.createDataFrame([("ent_1", "PLA", "entity", None, ["The PLA"]), ("rel_1", "r", "relation", "d", None)], "cid string, canonical_str string, type string, description string, aliases array<string>")
    at = datetime(2025, 1, 1)
    t = spark.createDataFrame(
        [("t1", "d", " PLA ", "R", "new", None, None, "s", 0.5, at), ("t2", "d", "the pla", "r", "NEW ", "", None, "s", 0.5, at), ("t2", "d", "the pla", "r", "NEW ", "", None, "s", 0.5, at)],
        "tuple_id string, doc_id string, subject string, relation string, object string, location string, time string, source_sent_id string, confidence double, ingested_at timestamp",
    )
    aliases = CA.alias_map(ref)
    missed = CA.missed_keys(t, aliases)
    assert {(r["raw_id"], r["element_type"], r["raw_str"], r["fallback_cid"]) for r in missed.collect()} == {("t1", "entity", "new", "ent_22af645d"), ("t2", "location", "", "loc_d41d8cd9")}
    got = {r["raw_id"]: tuple(r)[2:6] for r in CA.canonical_tuples(t, CA.with_fallback(aliases, missed)).collect()}
    assert got == {"t1": ("ent_1", "rel_1", "ent_22af645d", None), "t2": ("ent_1", "rel_1", "ent_22af645d", "loc_d41d8cd9")}
    with pytest.raises(ValueError):
        CA.canonical_tuples(t, aliases, strict=True)
    f = {r["type"]: (r["entries"], r["aliases"], r["dedup_ratio"]) for r in CA.schema_figures(ref).collect()}
    assert f == {"entity": (1, 1, 0.0), "relation": (1, 0, 0.0)}
    with pytest.raises(ValueError):
        CA.assembled(ref.select(F.col("cid").alias("id")), ref.limit(1).select(F.col("cid").alias("id")), ref.select(F.col("cid").alias("id")))


def test_pool(spark):
    at = datetime(2025, 1, 1)
    rows = [(f"t{i}", "d", "A", "r", "B" if i else " ", None, f"s{i}", at) for i in range(8)]
    t = spark.createDataFrame(rows, "tuple_id string, doc_id string, subject string, relation string, object string, location string, source_sent_id string, ingested_at timestamp")
    got = {(r["type"], r["concept"]): (r["count"], r["contexts"]) for r in CO.concept_pool(t.unionByName(t)).collect()}
    assert got["entity", "A"] == (8, [f"s{i}" for i in range(5)]) and got["entity", "B"][0] == 7 and len(got) == 3
    js = spark.createDataFrame([('{"甲": {"描述": "x", "来源句": ["a", "a", "b"]}, " ": {}}',)], "j string")
    assert [tuple(r) for r in CO.pool_from_json(js, "j", "entity").collect()] == [("entity", "甲", "x", ["a", "b"], 2)]
    assert CO.pool_from_json(js, "j", "entity", distinct_contexts=False).first()["count"] == 3
    pool = spark.createDataFrame([("entity", "甲", "old", ["a"], 1)], "type string, concept string, description string, contexts array<string>, seq int")
    fresh = spark.createDataFrame([("entity", "甲", " ", ["b", "a"], 2), ("entity", "", "x", ["c"], 3)], pool.schema)
    assert tuple(CO.updated_pool(pool, fresh).first()) == ("entity", "甲", "甲", ["a", "b"], 2)
    assert CO.updated_pool(pool, fresh, keep_old=True).first()["description"] == "old"


def test_graph(spark, scratch):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "c"), ("x", "y"), ("b", "a")], "u string, v string")
    assert {(r["node"], r["label"]) for r in GR.star_components(e, scratch).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    edges = e.select(F.col("u").alias("source"), F.col("v").alias("target"), F.lit(1.0).alias("weight"))
    hood = GR.neighbourhood(edges, spark.createDataFrame([("a",)], "node string"), 1, scratch)
    assert {(r["node"], r["hop"]) for r in hood.collect()} == {("a", 0), ("b", 1)}
    assert GR.induced_edges(edges, hood).count() == 2 and GR.strong_edges(edges, 1.1).count() == 0


def test_doc_graph(spark):
    anchors = spark.createDataFrame([("x", 5, [[1.0, 0.0], [0.0, 1.0]])], "doc_id string, ord int, vectors array<array<double>>")
    c = spark.createDataFrame([("a", 4, [1.0, 0.0]), ("b", 5, [0.5, 0.5]), ("late", 6, [1.0, 0.0]), ("x", 5, [1.0, 0.0]), ("none", None, [1.0, 0.0])], "doc_id string, ord int, mean array<double>")
    assert {(r["source"], r["weight"]) for r in DG.edges(anchors, c, 0.0).collect()} == {("a", 1.0), ("b", 0.5)}
    assert DG.edges(anchors, c, 0.0, most=1).count() == 1 and DG.edges(anchors.where("false"), c, 0.0).count() == 0
    v = DG.sentence_vectors(spark.createDataFrame([("d", "甲乙。丙"), ("e", None)], "doc_id string, normalized_text string"))
    assert v.count() == 2


def test_lexical(spark):
    docs = spark.createDataFrame([(1, "台海 台海"), (2, "abc"), (3, None)], "doc_id long, text string")
    asked = spark.createDataFrame([(9, "台海"), (8, "")], "query_id long, text string")
    got = LX.bm25(asked, docs, k=3).collect()
    assert [(r["query_id"], r["doc_id"], r["rank"]) for r in got] == [(9, 1, 1)] and got[0]["score"] > 0
    s = spark.createDataFrame([(9, 1, 2.0), (9, 2, 2.0)], "query_id long, doc_id long, score double")
    assert [(r["doc_id"], r["score"]) for r in LX.hybrid(s, s.where("doc_id = 1"), 0.5, 5).orderBy("rank").collect()] == [(1, 1.0), (2, 0.5)]


@pytest.mark.parametrize(
    "raw,label,confidence,window",
    [
        ("2022.8", "2022.08", 0.62, (date(2022, 8, 1), date(2022, 8, 31))),
        ("2025.3-4", "2025.04", 0.6, (date(2025, 3, 1), date(2025, 4, 30))),
        ("2024至今", "2024", 0.5, (date(2024, 1, 1), date(2024, 12, 31))),
        ("2024.3.5-7", "2024.03.07", 0.65, (date(2024, 3, 5), date(2024, 3, 7))),
        ("2024.3.5—4.2", "2024.04.02", 0.65, (date(2024, 3, 5), date(2024, 4, 2))),
        ("2023.11-2024.2", "2024.02", 0.58, (date(2023, 11, 1), date(2024, 2, 29))),
    ],
)
def test_title_times(raw, label, confidence, window):
    t = TL.read_title(raw)
    assert (t.candidate.normalized, t.candidate.confidence, t.window) == (label, confidence, window)


def test_body_times():
    title = TL.read_title("2024.3")
    body, vague = TL.read_body("2024年3月5日至8日，甲。\n近日，4月2日乙；次日丙。\n5月丁\n去年底戊", title)
    got = [(c.normalized, c.source, round(c.confidence, 2)) for c in body]
    assert got == [
        ("2024.03.08", "body_explicit_range", 0.93),
        ("2024.04.02", "body_inferred_day", 0.78),
        ("2024.03.09", "body_relative_next_day", 0.64),
        ("2024.05", "body_inferred_month", 0.73),
        ("2023.12", "body_relative_year", 0.58),
    ]
    assert vague == ["line_2:ambiguous_relative_time"]
    final = TL.final_time(title, body)
    assert final.normalized == "2024.05" and TL.status(title, final) == "inferred"
    assert TL.review_reasons(title, body, final, vague) == ["low_confidence"]
    rolled, _ = TL.read_body("11月3日甲\n1月2日乙", TL.read_title("2023-2024"))
    assert [c.normalized for c in rolled] == ["2023.11.03", "2024.01.02"] and "year_inferred_by_rollover" in rolled[1].tags
    assert TL.review_reasons(TL.read_title("2024至今"), [], None, []) == ["unknown_time", "open_ended_title"]
    assert TL.conflict(TL.read_title("2024.3.5"), body, final) and not TL.conflict(title, body, final)


def test_timeline_records(spark):
    df = spark.createDataFrame([("d1", "M038 中线（2022.8）.txt", "2022年8月3日。"), ("d2", "M003 未闭合（2024.txt", None), ("d3", "x.txt", "")], "doc_id string, file_name string, text string")
    r = {x["doc_id"]: x for x in TLO.manifest(TLO.corrected(df)).collect()}
    assert r["d1"]["corrected_title"] == "M038 中线（2022.08.03）" and r["d1"]["node_id"] == "M038" and not r["d1"]["needs_review"]
    assert r["d2"]["review_reasons"] == ["unknown_time", "malformed_title_time"] and r["d3"]["temporal_status"] == "unknown"
    assert TLO.summary(TLO.corrected(df)).first()["documents"] == 3
    assert TLO.corrected(df.where("false")).count() == 0


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test data here")
def test_hybrid_search_against_brute_force(spark):
    """Both sides are scaled over all texts, the query's own among them."""
    news = spark.read.parquet(f"{LARGER}/raw_news.parquet").select(F.col("news_id").alias("doc_id"), F.coalesce("normalized_text", F.lit("")).alias("text"), X.stem(F.col("file_name")).alias("title"))
    rows = {r["doc_id"]: r for r in news.collect()}
    ids = sorted(rows)
    lexical = {(r["query_id"], r["doc_id"]): r["score"] for r in LX.bm25(news.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), F.col("title").alias("text")), news).collect()}
    m = np.array([DG.hashed_vector(rows[i]["text"]) for i in ids])
    scale = lambda x: (x - x.min()) / (x.max() - x.min()) if x.max() > x.min() else np.full(len(x), float(x.max() > 0))
    wanted = {}
    for q in [i for i in ids if i % 100 == 0]:
        s = np.round(0.5 * scale(np.round(m @ DG.hashed_vector(rows[q]["title"]), 9)) + 0.5 * scale(np.array([lexical.get((q, i), 0.0) for i in ids])), 6)
        wanted[q] = np.sort(s)[::-1][:10]
    got = QUERIES["hybrid_search"](spark, LARGER).orderBy("query_id", "rank").toPandas()
    assert set(got["query_id"]) == set(wanted) != set() and len(ids) > 50
    for q, best in wanted.items():
        assert np.allclose(got.loc[got["query_id"] == q, "score"], best, atol=2e-6)


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test data here")
def test_every_element_is_in_an_entry(spark):
    e = spark.read.parquet(f"{LARGER}/dedup_elements.parquet")
    unusable = {(r["type"], r["id"]) for r in e.where("vector is null or size(vector) <> 96").collect()}
    got = QUERIES["greedy_entries"](spark, LARGER).collect()
    ids = [(r["type"], r["id"]) for r in got]
    assert len(ids) == len(set(ids)) and set(ids) == {(r["type"], r["id"]) for r in e.select("type", "id").collect()}
    fine = {(r["type"], r["id"]) for r in e.where("size(vector) = 96").collect()}
    assert unusable and all(r["cid"] == r["id"] for r in got if (r["type"], r["id"]) in unusable - fine)


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test data here")
def test_news_graph_has_every_eligible_edge(spark):
    news = spark.read.parquet(f"{LARGER}/raw_news.parquet")
    days = TLO.corrected(news.select("doc_id", "file_name", F.col("normalized_text").alias("text"))).select("doc_id", DG.day_number(F.col("anchor")).alias("ord")).where("ord is not null")
    stated = days.join(DG.sentence_vectors(news).select("doc_id").distinct(), "doc_id")
    ends = {r["doc_id"]: r["ord"] for r in stated.collect()}
    asked = {r["doc_id"] for r in news.where("news_id % 100 = 0").collect()} & set(ends)
    wanted = {(a, b) for b in asked for a in ends if a != b and ends[a] <= ends[b]}
    got = [(r["source"], r["target"]) for r in QUERIES["news_graph"](spark, LARGER).collect()]
    assert len(got) == len(set(got)) and set(got) == wanted and len(wanted) > 10 * len(asked)


def planted(spark, n=10_000, d=16, seed=3):
    """Distinct vectors of one narrow direction, each of the first hundred with two copies further back."""
    rng = np.random.default_rng(seed)
    x = np.r_[np.ones(d)] + 0.3 * rng.standard_normal((n, d))
    x[-200:-100], x[-100:] = x[:100], x[:100]
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")


def test_blocks_of_a_narrow_direction(spark, scratch, monkeypatch):
    x, df = planted(spark)
    monkeypatch.setattr(SI, "MOST_CENTRES", 4)  # so that blocks must be split again
    got = SI.vector_blocks(df, 40, scratch=scratch).toPandas()
    assert sorted(got["id"]) == list(range(10_000)) and got.groupby("block")["id"].size().max() <= 160
    block = got.set_index("id")["block"]
    # Copies meet: no block is cut by a hash.
    assert all(block[i] == block[9_800 + i] == block[9_900 + i] for i in range(100))


def test_all_copies_of_one_vector(spark, scratch):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(900)], "id long, vector array<double>")
    assert SI.vector_blocks(df, 40, scratch=scratch).groupBy("block").count().agg(F.max("count")).first()[0] <= 240  # by a hash
    copies = SI.same_vectors(df)
    assert copies.count() == 899 and copies.where("leader <> 0").count() == 0
    for got in (CL.balanced_clusters(df, scratch), CL.linkage_clusters(df, scratch, 3)):
        assert got.select("cluster_id").distinct().count() == 1 and got.count() == 900


def slow_linkage(u, clusters):
    groups = [[i] for i in range(len(u))]
    while len(groups) > clusters:
        s = u @ u.T
        mean = lambda p: s[np.ix_(groups[p[0]], groups[p[1]])].mean()
        a, b = max(((a, b) for a in range(len(groups)) for b in range(a + 1, len(groups))), key=lambda p: (round(mean(p), 9), -p[0], -p[1]))
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups}


def test_linkage_against_brute_force(spark, scratch):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((40, 5))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    parts = lambda label: {frozenset(np.flatnonzero(label == c).tolist()) for c in set(label.tolist())}
    for k in (1, 4, 9):
        assert parts(CL.average_linkage(u, k)) == slow_linkage(u, k)
    # Groups' means with their sizes go on as their members would.
    first = CL.average_linkage(u, 20)
    heads = np.unique(first)
    means, sizes = np.stack([u[first == h].mean(0) for h in heads]), np.array([(first == h).sum() for h in heads])
    assert parts(heads[CL.average_linkage(means, 4, sizes)][np.searchsorted(heads, first)]) == slow_linkage(u, 4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    whole = CL.linkage_clusters(df, scratch, 4).toPandas()
    assert {frozenset(g) for g in whole.groupby("cluster_id")["id"].apply(list)} == slow_linkage(u, 4)
    in_steps = CL.linkage_clusters(df, scratch, 4, most_rows=16).toPandas()
    assert sorted(in_steps["id"]) == list(range(40)) and in_steps["cluster_id"].nunique() == 4


def test_balanced_clusters_lose_no_link(spark, scratch):
    """Every cluster of the whole graph's components: links across blocks of neighbour search count too."""
    rng = np.random.default_rng(4)
    heads = rng.standard_normal((30, 12))
    x = np.repeat(heads, 8, 0) + 0.05 * rng.standard_normal((240, 12))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    for most in (4_096, 60):
        got = CL.balanced_clusters(df, scratch, CL.Sizes(target=8, least=4, most=12, k=6), most_rows=most).toPandas()
        assert sorted(got["id"]) == list(range(240))
        owner = got.set_index("id")["cluster_id"]
        together = np.mean([owner[i] == owner[i - i % 8] for i in range(240)])
        assert together > 0.95


def test_entries_of_a_block(spark, scratch):
    """Hybrid candidates, matching by alias key, the choice of a name, ids that are lent or new, contexts of new names."""
    rows = [
        ("entity", "b", "e1", "Alpha", "alpha", "sea fleet", 5, ["c1", "c2"], [1.0, 0.0]),
        ("entity", "b", "e2", " ALPHA two ", "alpha two", "sea fleet", 2, ["c2", "c3"], [0.9, 0.1]),
        ("entity", "b", "e3", "Beta", "beta", "river port", 4, ["c4"], [0.0, 1.0]),
        ("entity", "b", "e4", "Gamma", "gamma", None, 1, None, [-1.0, 0.0]),
        ("relation", "b", "r1", "Alpha", "alpha", "says", 5, ["c1"], [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "type string, block string, id string, raw_str string, alias_key string, description string, count int, contexts array<string>, vector array<double>")
    def judge(target, others):
        return [" Alpha TWO"] if target["id"] == "e1" else []

    got = {r["id"]: r for r in CA.deduplicated(df, "block", 16, 0.5, judge).collect()}
    assert {i: r["cid"] for i, r in got.items()} == {"e1": "e1", "e2": "e1", "e3": "e3", "e4": "e4", "r1": "r1"}
    assert got["e2"]["canonical_str"] == "Alpha" and got["e2"]["description"] == "sea fleet" and got["e4"]["description"] is None
    # A chosen member lends its id and description; a new name gets an id and a description of its own.
    lent = {r["id"]: r for r in CA.deduplicated(df, "block", 16, 0.5, judge, choose=lambda m: "alpha two").collect()}
    assert (lent["e1"]["cid"], lent["e1"]["canonical_str"]) == ("e2", " ALPHA two ")
    new = {r["id"]: r for r in CA.deduplicated(df, "block", 16, 0.5, judge, choose=lambda m: "  Alpha  Group ").collect()}
    assert new["e1"]["cid"] == new["e2"]["cid"] and new["e1"]["cid"].startswith("ent_") and new["e1"]["canonical_str"] == "Alpha Group" and new["e1"]["description"] == "Alpha Group，c1"
    entries = {r["cid"]: r for r in CA.as_entries(CA.deduplicated(df, "block", 16, 0.5, judge)).collect()}
    assert entries["e1"]["aliases"] == ["alpha", "alpha two"]
    # With the lexical side alone the candidates follow the words: the one nearest by words is judged first.
    first = lambda t, o: [o["raw_str"].iloc[0]] if t["id"] == "e1" else []
    by_words = {r["id"]: r["cid"] for r in CA.deduplicated(df.withColumn("vector", F.array(F.lit(1.0), F.lit(0.0))), "block", 1, 1.0, first).collect()}
    assert by_words["e2"] == "e1" and by_words["e3"] == "e3"
    assert CA.deduplicated(df.where("false"), "block").count() == 0


def test_put_together_copies_and_unusable(spark, scratch):
    rows = [("entity", f"e{i:03d}", f"n{i}", f"n{i}", None, i, None, [1.0, 2.0]) for i in range(300)]
    rows += [("entity", "x1", "x", "x", "d", 1, None, None), ("entity", "x2", "y", "y", "d", 1, None, [float("nan"), 1.0]), ("entity", "x3", "z", "z", "d", 1, None, [1.0]), ("location", "l1", "n1", "n1", "d", 1, None, [1.0, 2.0])]
    df = spark.createDataFrame([*rows, rows[0]], "type string, id string, raw_str string, alias_key string, description string, count int, contexts array<string>, vector array<double>")
    got = {r["id"]: r["cid"] for r in CA.put_together(df, scratch, 16).collect()}
    # All copies go with the one that is named most.
    assert {got[f"e{i:03d}"] for i in range(300)} == {"e299"} and all(got[i] == i for i in ("x1", "x2", "x3", "l1")) and len(got) == 304


def test_score_distribution(spark):
    for rows, size in ((vectors(spark, 300, 8, 2), 60), (vectors(spark, 40, 3, 3), 1)):
        df = rows[1].select("id", "vector")
        asked = df.where(F.col("id") < size)
        got, want = SI.score_distribution(asked, df).first(), SI.distribution(SI.scores(asked, df)).first()
        assert got.asDict().keys() == want.asDict().keys() and got["pairs"] == want["pairs"]
        assert np.allclose(list(got), list(want), atol=1.5e-6)
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "id long, vector array<double>")
    assert list(SI.score_distribution(same, same).first())[1:] == [1.0] * 8
    assert SI.score_distribution(same.where("false"), same).first()["pairs"] == 0


def test_search_keeps_ties_and_least(spark):
    df = spark.createDataFrame([(i, [1.0, float(i // 4)]) for i in range(12)], "id long, vector array<double>")
    got = [(r["query"], r["id"], r["rank"]) for r in SI.search(df.where("id = 3"), df, k=2).orderBy("rank").collect()]
    assert got == [(3, 0, 1), (3, 1, 2)]
    assert SI.search(df.where("id = 3"), df, k=9, least=0.99).count() == 3


def test_partition_cost(spark):
    rng = np.random.default_rng(6)
    for label in (rng.integers(0, 9, 60), np.zeros(70, int), np.arange(12), np.repeat(np.arange(5), [1, 2, 25, 31, 24])):
        df = spark.createDataFrame([(int(c),) for c in label], "cluster_id int")
        got = CL.partition_cost(df, CL.Sizes()).first()
        assert np.isclose(got["cost"], CL.balance_penalty(label, CL.Sizes()), atol=1e-6) and got["clusters"] == len(set(label.tolist()))
    assert CL.partition_cost(df.where("false"), CL.Sizes()).count() == 0


def test_table_function(spark):
    """The table function gives what the fold over documents gives."""
    news = spark.createDataFrame([("d1", "D001 会（2024年3月）.txt", "3月5日开会。次日闭会。\n2023年底回顾。"), ("d2", "x.txt", None), ("d3", "E001 （2020-2021）.txt", "今年初启动，5月结束。")], "doc_id string, file_name string, text string")
    want = {tuple(map(str, r)) for r in TLO.candidates(TLO.corrected(news)).drop("n").collect()}
    TLO.register(spark)
    news.select("doc_id", "text", X.title_parts(X.stem(F.col("file_name")))["raw_time"].alias("t")).createOrReplaceTempView("some_news")
    got = {tuple(map(str, r)) for r in spark.sql("SELECT n.doc_id, c.* FROM some_news n, LATERAL extract_time_candidates(n.text, n.t) c").collect()}
    assert got == want and len(want) == 4

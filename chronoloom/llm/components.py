"""One group id for all records that pairwise matches link, directly or through others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.functions.text import alias_key, is_blank
from chronoloom.operators.graph import both_ways, star_components
from chronoloom.sources.tables import Scratch

#: Rounds of stripping and compressing at most; whatever is left then is solved as the core.
MAX_ROUNDS = 12
#: A round that takes away less than this share of the core's arcs is the last one.
LEAST_SHARE = 0.05


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Labels of the connected components of an undirected graph.

    ``edges``: columns ``a`` and ``b`` of one orderable type. Repeated pairs, both orders and loops may occur; rows
    with a null end link nothing. Result: ``node``, ``label``, one row for each node of any edge (also of a loop);
    two nodes have the same label exactly if they are linked. An empty input gives an empty result.

    Each round compresses chains of degree-two vertices to one edge (list ranking by pointer doubling) and strips
    degree-one vertices, noting for every removed vertex one that stays. What remains, the core, is solved by
    alternating stars; then the rounds are undone in reverse and removed vertices take the label of their keeper.
    All steps are joins and partial aggregations on vertices, so a hub with a third of all edges costs one
    pre-aggregated row per task, and joins on it are split by AQE.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    ends = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = scratch.cut(edges.select(ends.alias("e")).select(F.col("e.a").alias("u"), F.col("e.b").alias("v")).distinct(), "arcs")
    nodes = both.select(F.col("u").alias("node")).distinct()
    arcs = both.where("u <> v")
    n_arcs = arcs.count()
    removed: list[DataFrame] = []
    former = None
    for _ in range(MAX_ROUNDS):
        if not n_arcs:
            break
        low = scratch.cut(arcs.groupBy("u").agg(F.count("*").alias("deg"), F.min("v").alias("lo"), F.max("v").alias("hi")).where("deg <= 2"), "low")
        n_low = {r["deg"]: r["n"] for r in low.groupBy("deg").agg(F.count("*").alias("n")).collect()}
        if sum(n_low.values()) < max(1, LEAST_SHARE * n_arcs / 2):
            break
        gone, fresh, touched = _strip(low)
        if n_low.get(2):
            g2, fresh, t2 = _compress(low.where("deg = 2"), scratch)
            gone, touched = gone.unionByName(g2), touched.unionByName(t2)
        removed.append(scratch.cut(gone, "removed"))
        left = arcs.join(touched, ["u", "v"], "left_anti")
        after = scratch.cut(left.unionByName(fresh).distinct() if n_low.get(2) else left, "arcs")
        scratch.drop(low)
        if former is not None:  # the first arcs hold the nodes
            scratch.drop(former)
        arcs = former = after
        n_arcs = arcs.count()
    labels = star_components(arcs, scratch) if n_arcs else None
    for gone in reversed(removed):
        if labels is None:
            mine = gone.select("node", F.col("keeper").alias("label"))
            labels = mine
        else:
            known = labels.select(F.col("node").alias("keeper"), "label")
            mine = gone.join(known, "keeper", "left").select("node", F.coalesce("label", "keeper").alias("label"))
            after = scratch.cut(labels.unionByName(mine), "labels")
            scratch.drop(gone)
            scratch.drop(labels)
            labels = after
    if labels is None:
        return nodes.select("node", F.col("node").alias("label"))
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def _strip(low: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leaves with their keepers, no new arcs, and the arcs that go. A leaf at the end of a chain waits for the next round."""
    other = low.select(F.col("u").alias("lo"), F.col("deg").alias("other"))
    leaf = low.where("deg = 1").join(other, "lo", "left").where("other is null or (other = 1 and u > lo)")
    gone = leaf.select(F.col("u").alias("node"), F.col("lo").alias("keeper"))
    return gone, None, both_ways(gone, "node", "keeper")


def _compress(chain: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Degree-two vertices with their keepers, the arcs that replace their chains, and the arcs that go.

    A state stands for walking into vertex ``at`` from ``src``; it points to a later step of the same walk and
    knows the least vertex passed. Doubling ends when every walk has left its chain, or when the least vertices
    of the walks that can't end (pure cycles) no longer change.
    """
    walk = F.explode(F.array(F.struct(F.col("lo").alias("src"), F.col("hi").alias("to")), F.struct(F.col("hi").alias("src"), F.col("lo").alias("to"))))
    state = chain.select(F.col("u").alias("at"), walk.alias("w")).select(
        F.col("w.src").alias("src"), "at", F.col("at").alias("p"), F.col("w.to").alias("q"), F.col("at").alias("least"), F.lit(False).alias("done"), F.lit(True).alias("moved")
    )
    while True:
        step = state.select(F.col("src").alias("p"), F.col("at").alias("q"), F.col("p").alias("p2"), F.col("q").alias("q2"), F.col("least").alias("least2"), F.col("done").alias("done2"), F.lit(True).alias("hit"))
        jumped = state.where("not done").join(step, ["p", "q"], "left").select(
            "src",
            "at",
            F.coalesce("p2", "p").alias("p"),
            F.coalesce("q2", "q").alias("q"),
            F.least("least", F.coalesce("least2", "least")).alias("least"),
            F.coalesce("done2", F.lit(True)).alias("done"),
            (F.col("hit").isNotNull() & (F.col("least2") < F.col("least"))).alias("moved"),
        )
        after = scratch.cut(state.where("done").unionByName(jumped), "walks")
        scratch.drop(state)
        state = after
        open_, moved = state.where("not done").agg(F.count("*"), F.count_if("moved")).first()
        if not open_ or not moved:
            break
    per = state.groupBy("at").agg(F.min(F.when(F.col("done"), F.col("q"))).alias("e1"), F.max(F.when(F.col("done"), F.col("q"))).alias("e2"), F.min("least").alias("least"))
    per = scratch.cut(per, "chains")
    gone = per.select(F.col("at").alias("node"), F.coalesce("e1", "least").alias("keeper")).where("node <> keeper")
    fresh = both_ways(per.where("e1 <> e2").select("e1", "e2").distinct(), "e1", "e2")
    touched = both_ways(chain, "u", "lo").unionByName(both_ways(chain, "u", "hi"))
    return gone, fresh, touched


def group_elements(elements: DataFrame, matches: DataFrame) -> DataFrame:
    """Group ids of elements whose alias keys are matched: ``element_id``, ``group_id`` (the smallest id of the group).

    ``elements``: ``id``, ``type``, ``alias_key``; repeated rows count once, rows with a null id, type or key take
    no part. ``matches``: ``element_type``, ``left_key``, ``right_key``; keys are compared without outer white space
    and in lower case; a match with a null type or a null or blank key links nothing; a key that belongs to no
    element still links; a key matched with itself touches its elements. Other columns are ignored, whatever their
    names. Empty tables give an empty result. The vertex is the 128-bit MD5 of type and key, so that rows stay small.
    """
    scratch = Scratch(elements.sparkSession, "groups")
    node = lambda kind, key: F.unhex(F.md5(F.concat(kind, F.lit("\x1f"), key)))
    usable = matches.select("element_type", "left_key", "right_key").where(F.col("element_type").isNotNull() & ~is_blank(F.col("left_key")) & ~is_blank(F.col("right_key")))
    edges = usable.select(node(F.col("element_type"), alias_key(F.col("left_key"))).alias("a"), node(F.col("element_type"), alias_key(F.col("right_key"))).alias("b"))
    labels = components(edges, scratch)
    own = elements.select("id", node(F.col("type"), F.col("alias_key")).alias("node")).where("id is not null and node is not null").distinct()
    member = scratch.cut(own.join(labels, "node").select("id", "label"), "members")
    first = member.groupBy("label").agg(F.min("id").alias("group_id"))
    # An id under several keys would join their groups; ids have one key, so one row each.
    return member.join(first, "label").select(F.col("id").alias("element_id"), "group_id").distinct()

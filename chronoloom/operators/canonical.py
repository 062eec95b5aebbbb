"""Canonical ids: alias maps, resolution of tuples, schema figures and greedy merging."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.functions.text import alias_key, element_id, lexical_tokens, squeeze
from chronoloom.operators.concepts import SLOTS
from chronoloom.operators.similarity import same_vectors, search, vector_blocks
from chronoloom.sources.tables import Scratch

#: The two parameters of BM25.
K1, B = 1.5, 0.75

#: An alias map of at most so many rows is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 50_000


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint if it has at most so many rows (counted up to that many), else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def alias_map(reference: DataFrame) -> DataFrame:
    """``type``, ``alias_key``, ``cid``: an entry's name and its aliases; a key of several entries goes to the smallest cid."""
    names = F.explode(F.array_union(F.array("canonical_str"), F.coalesce("aliases", F.array().cast("array<string>"))))
    rows = reference.select("type", "cid", names.alias("name")).select("type", alias_key(F.col("name")).alias("alias_key"), "cid")
    return rows.groupBy("type", "alias_key").agg(F.min("cid").alias("cid"))


def _elements(tuples: DataFrame) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(t).alias("type"), F.lit(i).alias("n"), F.col(s).alias("raw_str")) for i, (s, t) in enumerate(SLOTS)])
    rows = tuples.select("tuple_id", "subject", "object", "relation", "location", "ingested_at").distinct()
    long = rows.select("tuple_id", "ingested_at", F.explode(cells).alias("c")).where("c.raw_str is not null")
    return long.select("tuple_id", "ingested_at", "c.slot", "c.type", "c.n", "c.raw_str", alias_key(F.col("c.raw_str")).alias("alias_key"))


def missed_keys(tuples: DataFrame, aliases: DataFrame) -> DataFrame:
    """Keys that the alias map lacks, with the first tuple and spelling: ``raw_id``, ``element_type``, ``raw_str``, ``alias_key``, ``fallback_cid``.

    An empty text is a key too; a null isn't. The keys are pre-aggregated, the map is probed once per key.
    """
    place = F.struct("ingested_at", "tuple_id", "n")
    keys = _elements(tuples).groupBy("type", "alias_key").agg(F.min_by(F.struct("tuple_id", "raw_str"), place).alias("first"))
    missed = keys.join(bounded_broadcast(aliases), ["type", "alias_key"], "left_anti")
    return missed.select(
        F.col("first.tuple_id").alias("raw_id"), F.col("type").alias("element_type"), F.col("first.raw_str").alias("raw_str"), "alias_key", element_id(F.col("type"), F.col("first.raw_str")).alias("fallback_cid")
    )


def with_fallback(aliases: DataFrame, missed: DataFrame) -> DataFrame:
    """The alias map with the fallback ids of missed keys put in."""
    return aliases.unionByName(missed.select(F.col("element_type").alias("type"), "alias_key", F.col("fallback_cid").alias("cid")))


def canonical_tuples(tuples: DataFrame, aliases: DataFrame, strict: bool = False) -> DataFrame:
    """Tuples with canonical ids: ``raw_id``, ``doc_id``, the four ``*_cid``, ``time``, ``source_sent_id``, ``confidence``.

    Null elements have null ids. With ``strict`` a key that the map lacks raises an error. One left join for each
    element; the map is broadcast if its size allows it, and a hot key is split by AQE if not.
    """
    if strict and missed_keys(tuples, aliases).limit(1).count():
        raise ValueError("the alias map lacks keys that the tuples use")
    rows = tuples.select("tuple_id", "doc_id", "subject", "object", "relation", "location", "time", "source_sent_id", "confidence").distinct()
    small = bounded_broadcast(aliases)
    for slot, kind in SLOTS:
        side = small.where(F.col("type") == kind).select(F.col("alias_key").alias(f"_{slot}"), F.col("cid").alias(f"{slot}_cid"))
        rows = rows.withColumn(f"_{slot}", alias_key(F.col(slot))).join(side, f"_{slot}", "left")
    return rows.select(F.col("tuple_id").alias("raw_id"), "doc_id", "subject_cid", "relation_cid", "object_cid", "location_cid", "time", "source_sent_id", "confidence")


def merged_entries(entries: DataFrame) -> DataFrame:
    """Entries of one cid as one: the first name and description by ``seq``, the union of aliases; by type and cid."""
    aliases = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("aliases", F.array().cast("array<string>"))))))
    return entries.groupBy("type", "cid").agg(F.min_by("canonical_str", "seq").alias("canonical_str"), F.min_by("description", F.when(F.col("description").isNotNull(), F.col("seq"))).alias("description"), aliases.alias("aliases"))


def schema_figures(reference: DataFrame) -> DataFrame:
    """Per type: entries, aliases and the share of names that merging saved (0 without aliases)."""
    one = reference.groupBy("type").agg(F.count("*").alias("entries"), F.sum(F.size(F.coalesce("aliases", F.array().cast("array<string>")))).alias("aliases"))
    return one.withColumn("dedup_ratio", F.when(F.col("aliases") > 0, F.round(1 - F.col("entries") / F.col("aliases"), 6)).otherwise(F.lit(0.0)))


def assembled(descriptions: DataFrame, pool: DataFrame, vectors: DataFrame) -> DataFrame:
    """Elements of the three tables joined on ``id``; an id that one of them lacks raises an error."""
    for a, b in ((descriptions, pool), (descriptions, vectors), (pool, descriptions), (vectors, descriptions)):
        if a.join(b, "id", "left_anti").limit(1).count():
            raise ValueError("descriptions, pool and vectors don't hold the same ids")
    return descriptions.join(pool, "id").join(vectors, "id")


def link_candidates(description_vectors: DataFrame, aliases: DataFrame, asked: DataFrame, k: int = 3) -> DataFrame:
    """For new surface forms the entries they may mean: ``ask_id``, ``cid``, ``score``, ``rank``.

    ``asked``: ``ask_id``, ``vector`` (unit); ``description_vectors``: ``type``, ``alias_key``, ``vector`` (unit).
    An entry's score is the best of its aliases. The asked vectors are a stated set, broadcast in bounded blocks.
    """
    rows = description_vectors.join(aliases, ["type", "alias_key"]).select("cid", "vector")
    found = search(asked.select(F.col("ask_id").alias("id"), "vector"), rows.select(F.col("cid").alias("id"), "vector"), k=k, by_best=True)
    return found.select(F.col("query").alias("ask_id"), F.col("id").alias("cid"), F.round("score", 6).alias("score"), "rank")


def default_judge(target: dict, others: pd.DataFrame) -> list[str]:
    """The offline stand-in for a judge: names with the target's alias key or a cosine of at least 0.9 with it."""
    same = others["alias_key"] == target["alias_key"]
    close = np.stack(others["unit"].to_numpy()) @ target["unit"] >= 0.9 if len(others) else np.zeros(0, bool)
    return others.loc[same.to_numpy() | close, "raw_str"].tolist()


def key_judge(target: dict, others: pd.DataFrame) -> list[str]:
    """A judge that only knows the alias key."""
    return others.loc[others["alias_key"] == target["alias_key"], "raw_str"].tolist()


def most_counted(members: pd.DataFrame) -> str:
    """The offline stand-in for the choice of a group's name: that of the member with the highest count, then the smallest name."""
    return members.sort_values(["count", "raw_str"], ascending=[False, True], kind="stable")["raw_str"].iloc[0]


def name_and_context(name: Column, contexts: Column) -> Column:
    """The offline stand-in for a description: the name and its first context."""
    return F.concat_ws("，", name, F.get(contexts, F.lit(0)))


class _Lexicon:
    """Postings of a block's texts. Document frequencies and lengths follow what is left of the block."""

    def __init__(self, tokens: list[list[str]]):
        self.texts = [Counter(t) for t in tokens]
        self.length = np.array([len(t) for t in tokens], dtype=float)
        postings: dict[str, list[tuple[int, int]]] = {}
        for i, t in enumerate(self.texts):
            for term, n in t.items():
                postings.setdefault(term, []).append((i, n))
        self.postings = {term: tuple(np.array(c) for c in zip(*p, strict=True)) for term, p in postings.items()}

    def scores(self, asks: int, among: np.ndarray) -> np.ndarray:
        """BM25 of the text ``asks`` as the query with the texts ``among``."""
        n, out = len(among), np.zeros(len(self.texts))
        left = np.zeros(len(self.texts), bool)
        left[among] = True
        average = max(1.0, self.length[among].mean())
        room = K1 * (1 - B + B * np.maximum(self.length, 1.0) / average)
        for term, times in self.texts[asks].items():
            at, tf = self.postings[term]
            tf, at = tf[left[at]], at[left[at]]
            out[at] += times * np.log((n - len(at) + 0.5) / (len(at) + 0.5) + 1) * tf * (K1 + 1) / (tf + room[at])
        return out[among]


def _scaled(x: np.ndarray) -> np.ndarray:
    low, high = x.min(), x.max()
    return (x - low) / (high - low) if high > low else np.full(len(x), float(high > 0))


def deduplicated(elements: DataFrame, block: str, k: int = 16, lexical_weight: float = 0.5, judge=default_judge, choose=most_counted, describe=name_and_context) -> DataFrame:
    """Elements put together as entries: a row for each element with its entry's ``cid``, ``canonical_str`` and ``description``.

    ``elements``: ``type``, the block, ``id``, ``raw_str``, ``alias_key``, ``description``, ``count``, ``contexts``, ``vector``; blocks
    have a bounded size (see ``similarity.vector_blocks``). In each block and type the element with the highest (count,
    name) of those left is the target; the ``k`` others with the highest mix of cosine and BM25 (name and description as the text, both
    scaled over the others left) are judged; those whose alias key is that of a name that the judge returns form a
    group with the target. ``choose`` names the group: the member with that name's alias key gives the entry its id, spelling and
    description; a new name gets an id of its own and a description by ``describe`` from the group's first five
    contexts. A lone element is its own entry. ``judge`` gets the target and a frame of others, ``choose`` the frame of
    members; both run in the tasks.

    Result: ``type``, ``id``, ``alias_key``, ``cid``, ``canonical_str``, ``description``. Null descriptions count as
    empty; equal scores go to the smaller id.
    """
    tokens = lexical_tokens(F.concat_ws(" ", "raw_str", "description"))
    rows = elements.select("type", F.col(block).alias("block"), "id", "raw_str", "alias_key", "description", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("contexts", F.array().cast("array<string>")).alias("contexts"), "vector", tokens.alias("tokens"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("id").sort_values("id", kind="stable").reset_index(drop=True)
        v = np.stack([np.asarray(x, dtype=np.float64) for x in pdf["vector"]])
        n = np.linalg.norm(v, axis=1, keepdims=True)
        u = v / np.where(n > 0, n, 1)
        pdf["unit"], lexicon = list(u), _Lexicon([list(t) for t in pdf["tokens"]])
        keys, free, out = pdf["alias_key"].tolist(), np.ones(len(pdf), bool), []
        for i in pdf.sort_values(["count", "raw_str"], ascending=False, kind="stable").index:
            if not free[i]:
                continue
            free[i] = False
            others, group = np.flatnonzero(free), [i]
            if len(others):
                cosine = u[others] @ u[i]
                mixed = (1 - lexical_weight) * _scaled(cosine) + lexical_weight * _scaled(lexicon.scores(i, others))
                near = others[np.lexsort((-cosine.round(9), -mixed.round(9)))[:k]]
                told = {_key(x) for x in judge(pdf.loc[i].to_dict(), pdf.loc[near])}
                group = sorted([i, *(j for j in near.tolist() if keys[j] in told)])
            free[group] = False
            name = choose(pdf.loc[group]) if len(group) > 1 else pdf.at[i, "raw_str"]
            known = next((j for j in group if keys[j] == _key(name)), i if len(group) == 1 else None)
            contexts = list(dict.fromkeys(c for j in group for c in pdf.at[j, "contexts"]))[:5]
            lent = (None, name, None) if known is None else (pdf.at[known, "id"], pdf.at[known, "raw_str"], pdf.at[known, "description"])
            out += [(pdf.at[j, "type"], pdf.at[j, "id"], keys[j], *lent, contexts) for j in group]
        return pd.DataFrame(out, columns=["type", "id", "alias_key", "cid", "canonical_str", "description", "contexts"])

    found = rows.groupBy("type", "block").applyInPandas(run, "type string, id string, alias_key string, cid string, canonical_str string, description string, contexts array<string>")
    fresh, surface = F.col("cid").isNull(), squeeze(F.col("canonical_str"))
    return found.select(
        "type", "id", "alias_key", F.coalesce("cid", element_id(F.col("type"), surface)).alias("cid"), F.when(fresh, surface).otherwise(F.col("canonical_str")).alias("canonical_str"),
        F.when(fresh, describe(surface, F.col("contexts"))).otherwise(F.col("description")).alias("description"),
    )


def _key(name: str) -> str:
    return name.strip().lower()


def as_entries(members: DataFrame) -> DataFrame:
    """Entries of elements that were put together: ``type``, ``cid``, ``canonical_str``, ``description``, ``aliases`` (distinct alias keys in order)."""
    return members.groupBy("type", "cid").agg(F.min("canonical_str").alias("canonical_str"), F.min("description").alias("description"), F.array_sort(F.collect_set("alias_key")).alias("aliases"))


def key_entries(members: DataFrame) -> DataFrame:
    """The alias map of such entries: ``type``, ``alias_key``, ``cid``; a key of several entries goes to the smallest cid."""
    return members.groupBy("type", "alias_key").agg(F.min("cid").alias("cid"))


def put_together(elements: DataFrame, scratch: Scratch, block_size: int = 128, **how) -> DataFrame:
    """``deduplicated`` for elements of any number, in blocks of neighbouring vectors.

    Elements of a type with the same vector are one for this: that with the highest (count, name) speaks for them.
    Elements without a usable vector (null, of another length than most, not finite) are entries of their own. Repeated
    rows count once; an empty table gives an empty result.
    """
    rows = scratch.cut(elements.select("type", "id", "raw_str", "alias_key", "description", "count", "contexts", "vector").where("id is not null and type is not null"), "elements")
    size = rows.where("vector is not null").groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).agg(F.max_by("d", "n")).first()[0]
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce((F.size("vector") == F.lit(size)) & finite, F.lit(False))
    fine = rows.where(usable).dropDuplicates(["type", "id"])
    alone = rows.where(~usable).dropDuplicates(["type", "id"]).join(fine.select("type", "id"), ["type", "id"], "left_anti")
    own = ["type", "id", "alias_key", F.col("id").alias("cid"), F.col("raw_str").alias("canonical_str"), "description"]
    copies = scratch.cut(same_vectors(fine, ("type",), F.struct(F.coalesce("count", F.lit(0)), "raw_str")), "copies")
    leaders = fine.join(copies.select("type", "id"), ["type", "id"], "left_anti")
    led = scratch.cut(deduplicated(vector_blocks(leaders, block_size, scratch=scratch), "block", **how), "led")
    follow = copies.join(led.select("type", F.col("id").alias("leader"), "cid", "canonical_str", "description"), ["type", "leader"]).join(fine.select("type", "id", "alias_key"), ["type", "id"])
    return led.unionByName(follow.drop("leader")).unionByName(alone.select(*own))


def greedy_merge(elements: DataFrame, block: str, k: int = 16, judge=default_judge, scratch: Scratch | None = None) -> DataFrame:
    """``deduplicated`` by vectors alone: ``type``, ``id``, ``cid``, ``canonical_str``."""
    filled = elements
    for name, kind in (("description", "string"), ("contexts", "array<string>")):
        if name not in elements.columns:
            filled = filled.withColumn(name, F.lit(None).cast(kind))
    return deduplicated(filled, block, k, 0.0, judge).select("type", "id", "cid", "canonical_str")

"""Concept pools of tuples, verdicts on concepts and mappings between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.functions.text import is_blank, strip

#: The elements of a tuple with the type of their concepts, in the order in which a tuple is read.
SLOTS = [("subject", "entity"), ("object", "entity"), ("relation", "relation"), ("location", "location")]
#: Contexts kept of a concept.
MOST_CONTEXTS = 5
#: Surface forms that name no concept, for the rule that stands in for a judge.
VAGUE = ["是", "有", "该机构", "该地区", "上述水域", "附近", "多名专家", "有关部门", "双方", "当地", "they", "there", "does", "it", "he", "she", "this", "that"]


def occurrences(tuples: DataFrame) -> DataFrame:
    """Every concept in every tuple: ``tuple_id``, ``doc_id``, ``slot``, ``type``, ``concept``, ``source``, ``place``; repeated rows once."""
    cells = F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(t).alias("type"), F.lit(i).alias("n"), F.col(s).alias("concept")) for i, (s, t) in enumerate(SLOTS)])
    rows = tuples.select("tuple_id", "doc_id", "subject", "object", "relation", "location", "source_sent_id", "ingested_at").distinct()
    long = rows.select("tuple_id", "doc_id", "source_sent_id", "ingested_at", F.explode(cells).alias("c")).where(~is_blank(F.col("c.concept")))
    place = F.struct("ingested_at", "tuple_id", F.col("c.n").alias("n"))
    return long.select("tuple_id", "doc_id", "c.slot", "c.type", F.col("c.concept").alias("concept"), F.col("source_sent_id").alias("source"), place.alias("place"))


def concept_pool(tuples: DataFrame, most: int = MOST_CONTEXTS) -> DataFrame:
    """Concepts with the number of sentences they come from and the first of these: ``type``, ``concept``, ``count``, ``contexts``.

    Sources are made distinct before they are ranked, and the limit on the rank works before the shuffle too, so a
    concept of a third of all tuples costs a few rows per task.
    """
    seen = occurrences(tuples).where("source is not null").groupBy("type", "concept", "source").agg(F.min("place").alias("place"))
    counted = seen.groupBy("type", "concept").agg(F.count("*").alias("count"))
    rank = F.row_number().over(Window.partitionBy("type", "concept").orderBy("place", "source"))
    few = seen.withColumn("rank", rank).where(F.col("rank") <= most).groupBy("type", "concept").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "source"))), lambda e: e["source"]).alias("contexts"))
    return counted.join(few, ["type", "concept"])


def updated_pool(pool: DataFrame, fresh: DataFrame, keep_old: bool = False, most: int | None = None) -> DataFrame:
    """A pool with newer rows put in: ``type``, ``concept``, ``description``, ``contexts``, ``seq`` in both.

    The latest description wins (the earliest with ``keep_old``); a blank one is the concept itself; contexts are
    distinct in the order of ``seq``, all of them or the first ``most``; blank concepts are left out. Contexts are made
    distinct, and ranked where there is a limit, before a concept's are brought together, so rows that repeat them don't count.
    """
    rows = pool.unionByName(fresh).where(~is_blank(F.col("concept")))
    told = F.when(is_blank(F.col("description")), F.col("concept")).otherwise(F.col("description"))
    pick = F.min_by if keep_old else F.max_by
    one = rows.groupBy("type", "concept").agg(pick(told, F.col("seq")).alias("description"), F.max("seq").alias("seq"))
    each = rows.select("type", "concept", "seq", F.posexplode("contexts").alias("n", "context"))
    first = each.groupBy("type", "concept", "context").agg(F.min(F.struct("seq", "n")).alias("place"))
    if most is not None:
        first = first.withColumn("rank", F.row_number().over(Window.partitionBy("type", "concept").orderBy("place", "context"))).where(F.col("rank") <= most)
    contexts = first.groupBy("type", "concept").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "context"))), lambda e: e["context"]).alias("contexts"))
    none = F.array().cast("array<string>")
    # Types may be null, concepts may not.
    same = F.col("o.type").eqNullSafe(F.col("c.type")) & (F.col("o.concept") == F.col("c.concept"))
    return one.alias("o").join(contexts.alias("c"), same, "left").select("o.type", "o.concept", "o.description", F.coalesce("c.contexts", none).alias("contexts"), "o.seq")


def rule_verdict(concept: Column) -> Column:
    """The offline stand-in for a compliance judge: whether a concept names something."""
    c = F.lower(strip(concept))
    return ~is_blank(concept) & ~c.isin(VAGUE) & (F.length(c) > 1)


def compliance(elements: DataFrame, verdict=rule_verdict) -> DataFrame:
    """Distinct concepts with their verdict: ``type``, ``concept``, ``compliant``."""
    return elements.select("type", F.col("raw_str").alias("concept")).distinct().withColumn("compliant", verdict(F.col("concept")))


def compliance_counts(judged: DataFrame, references: DataFrame) -> DataFrame:
    """Per type: concepts, compliant and invalid ones, and tuple elements that use an invalid one."""
    counts = judged.groupBy("type").agg(F.count("*").alias("concepts"), F.count_if("compliant").alias("compliant"), F.count_if(~F.col("compliant")).alias("invalid"))
    used = references.groupBy("type").agg(F.count("*").alias("invalid_references"))
    return counts.join(used, "type", "left").withColumn("invalid_references", F.coalesce("invalid_references", F.lit(0)))


def invalid_references(tuples: DataFrame, judged: DataFrame) -> DataFrame:
    """Tuple elements whose concept was judged invalid: ``tuple_id``, ``slot``, ``type``, ``concept``. An equi-join, no loop over concepts."""
    bad = judged.where("not compliant").select("type", "concept")
    return occurrences(tuples).join(bad, ["type", "concept"], "left_semi").select("tuple_id", "slot", "type", "concept")


def mapping_rows(reference: DataFrame) -> DataFrame:
    """From reference entries to mapping rows: ``type``, ``source``, ``merged``: each alias stands for its entry's name."""
    source = F.explode(F.array_union(F.array("canonical_str"), F.coalesce("aliases", F.array().cast("array<string>"))))
    return reference.select("type", source.alias("source"), F.col("canonical_str").alias("merged"))


def grouped_mapping(mapping: DataFrame) -> DataFrame:
    """Per merged concept its sorted distinct sources and their number; with ``group_id``, ``cluster_id`` and ``description`` (and ``seq``,
    its order) also groups, clusters and the first description that isn't blank."""
    more = []
    for c, name in (("group_id", "groups"), ("cluster_id", "clusters")):
        if c in mapping.columns:
            more.append(F.array_sort(F.collect_set(c)).alias(name))
    if "description" in mapping.columns:
        order = F.struct("seq", "source") if "seq" in mapping.columns else F.col("source")
        more.append(F.min_by("description", F.when(~is_blank(F.col("description")), order)).alias("description"))
    return mapping.groupBy("type", "merged").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.countDistinct("source").alias("n_sources"), *more)


def apply_mapping_to_lists(merged: DataFrame, mapping: DataFrame) -> DataFrame:
    """Merged tuples with mapped lists: each value mapped, equal ones once in the order of the first; a list of one as its value.

    ``merged``: ``tuple_id``, ``subjects``, ``relation``, ``objects``, ``locations``, ``time``. Result: ``tuple_id``, ``subject``, ``relation``,
    ``object``, ``location`` as JSON (a string, a list, or null for none), ``time``, ``replaced``. Values are joined once for all
    lists, a value that many tuples have is split by AQE or met by a broadcast.
    """
    one = mapping.groupBy("type", "source").agg(F.max("merged").alias("to"))
    lists = [("subject", "entity", F.col("subjects")), ("object", "entity", F.col("objects")), ("relation", "relation", F.array("relation")), ("location", "location", F.col("locations"))]

    def numbered(slot: str, kind: str, values: Column) -> Column:
        return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x, i: F.struct(F.lit(slot).alias("slot"), F.lit(kind).alias("type"), i.alias("n"), x.alias("source")))

    cells = F.flatten(F.array(*[numbered(*x) for x in lists]))
    each = merged.select("tuple_id", F.explode(cells).alias("c")).select("tuple_id", "c.*").where("source is not null").join(one, ["type", "source"], "left")
    each = each.withColumn("value", F.coalesce("to", "source"))
    first = each.groupBy("tuple_id", "slot", "value").agg(F.min("n").alias("n"), F.count_if(F.col("value") != F.col("source")).alias("replaced"))
    ordered = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("slot") == s, F.struct("n", "value")))), lambda e: e["value"])
    told = lambda c: F.when(F.size(c) > 1, F.to_json(c)).when(F.size(c) == 1, c[0])
    wide = first.groupBy("tuple_id").agg(*[ordered(s).alias(s) for s, _, _ in lists], F.sum("replaced").alias("replaced"))
    out = merged.select("tuple_id", "time").join(wide, "tuple_id", "left")
    return out.select("tuple_id", *[told(F.col(s)).alias(s) for s in ("subject", "relation", "object", "location")], "time", F.coalesce("replaced", F.lit(0)).alias("replaced"))


def apply_mapping(tuples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Tuples with mapped elements: ``tuple_id``, ``doc_id``, the elements, ``time`` and ``replaced``, the number of changed ones.

    Of several mappings of one source the last by name wins. Repeated rows count once.
    """
    one = mapping.groupBy("type", "source").agg(F.max("merged").alias("merged"))
    rows = tuples.select("tuple_id", "doc_id", "subject", "relation", "object", "location", "time").distinct()
    changed = F.lit(0)
    for slot, kind in SLOTS:
        side = one.where(F.col("type") == kind).select(F.col("source").alias(slot), F.col("merged").alias(f"_{slot}"))
        rows = rows.join(side, slot, "left")
        changed = changed + F.when(F.col(f"_{slot}") != F.col(slot), 1).otherwise(0)
    return rows.select("tuple_id", "doc_id", *(F.coalesce(f"_{s}", s).alias(s) for s, _ in SLOTS), "time", changed.alias("replaced"))


def apply_report(mapped: DataFrame) -> DataFrame:
    """Per document: tuples before, after dropping equal ones, replaced elements and duplicates."""
    signature = ["doc_id", "subject", "relation", "object", "location", "time"]
    one = mapped.groupBy(*signature).agg(F.count("*").alias("n"), F.sum("replaced").alias("replaced"))
    return one.groupBy("doc_id").agg(F.sum("n").alias("before"), F.count("*").alias("after"), F.sum("replaced").alias("replaced"), (F.sum("n") - F.count("*")).alias("duplicates"))


def pool_from_json(df: DataFrame, column: str, kind: str, distinct_contexts: bool = True, most: int | None = MOST_CONTEXTS) -> DataFrame:
    """Pool rows of JSON maps {concept: {"描述": text, "来源句": [texts]}}: ``type``, ``concept``, ``description``, ``contexts``, ``count``.

    ``count`` is the number of contexts before they are cut to ``most``; without ``distinct_contexts`` all are kept.
    """
    parsed = F.from_json(column, "map<string, struct<`描述`: string, `来源句`: array<string>>>")
    rows = df.select(F.explode(parsed).alias("concept", "v")).where(~is_blank(F.col("concept")))
    told = F.filter(F.transform(F.coalesce("v.来源句", F.array().cast("array<string>")), strip), lambda s: F.length(s) > 0)
    contexts = F.array_distinct(told) if distinct_contexts else told
    shown = F.slice(contexts, 1, most) if most else contexts
    return rows.select(F.lit(kind).alias("type"), strip(F.col("concept")).alias("concept"), F.coalesce("v.描述", F.lit("")).alias("description"), shown.alias("contexts"), F.size(contexts).alias("count"))

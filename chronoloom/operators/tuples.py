"""Event tuples: clean-up, merging, ordering and statistics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.text import is_blank
from chronoloom.functions.times import id_number, normalized_time, sentence_of, signature_time, time_anchor
from chronoloom.operators.graph import star_components
from chronoloom.operators.ranking import distributed_rank
from chronoloom.sources.tables import Scratch

FIELDS = ["tuple_id", "doc_id", "sent_id", "subject", "relation", "object", "location", "time", "source_sent_id", "confidence"]
#: Tuples of a sentence with equal relation and time that are gathered, at most.
MOST_GROUP = 1_000
SIGNATURE = ["doc_id", "subject", "relation", "object", "location", "sig_time"]


def projected(tuples: DataFrame) -> DataFrame:
    """The export's fields: the sentence id is the tuple's own, a missing confidence is 0.8."""
    return tuples.select("tuple_id", "doc_id", F.col("tuple_id").alias("sent_id"), "subject", "relation", "object", "location", "time", "source_sent_id", F.coalesce("confidence", F.lit(0.8)).alias("confidence"))


def _place(df: DataFrame) -> Column:
    """Where a tuple stands: sentence, tuple, time of arrival, id."""
    return F.struct(F.coalesce(id_number(F.col("tuple_id"), "s"), F.lit(0)).alias("s"), F.coalesce(id_number(F.col("tuple_id"), "t"), F.lit(0)).alias("t"), F.col("tuple_id"))


def delete_reasons(tuples: DataFrame) -> DataFrame:
    """Distinct tuples with ``copies`` and ``reasons`` why they go (empty: they stay), in a fixed order.

    ``duplicate_in_doc``: another tuple of the document with the same fields stands before it; ``subject_equals_object``;
    ``unreliable_time_anchor``: a time that isn't blank and isn't understood. The first of equal tuples counts as
    first even if it goes for another reason. Equal rows are one tuple with ``copies``; null fields are equal to
    each other. A signature of any number of rows is aggregated partially and joined back, never gathered.
    """
    rows = tuples.groupBy(*FIELDS).agg(F.count("*").alias("copies"))
    rows = rows.withColumn("sig_time", signature_time(F.col("time"))).withColumn("place", _place(rows))
    first = rows.groupBy(*SIGNATURE).agg(F.min("place").alias("first"))
    same = None
    for c in SIGNATURE:
        one = F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}"))
        same = one if same is None else same & one
    joined = rows.alias("r").join(first.alias("f"), same).select("r.*", "f.first")
    lost_time = ~is_blank(F.col("time")) & normalized_time(F.col("time")).isNull()
    reasons = F.array_compact(
        F.array(
            F.when(F.col("place") > F.col("first"), F.lit("duplicate_in_doc")),
            F.when(F.col("subject") == F.col("object"), F.lit("subject_equals_object")),
            F.when(lost_time, F.lit("unreliable_time_anchor")),
        )
    )
    return joined.select(*FIELDS, "copies", reasons.alias("reasons"))


def cleaned(tuples: DataFrame) -> DataFrame:
    """The tuples without a reason to go, each once."""
    return delete_reasons(tuples).where(F.size("reasons") == 0).select(*FIELDS)


def with_normal_times(tuples: DataFrame) -> DataFrame:
    """``time`` in normal form where it is understood, else as it is; ``time_known`` says which."""
    return tuples.withColumn("_n", normalized_time(F.col("time"))).withColumn("time_known", F.col("_n").isNotNull()).withColumn("time", F.coalesce("_n", "time")).drop("_n")


def unresolved_times(tuples: DataFrame, samples: int = 5) -> DataFrame:
    """Times that aren't understood: ``time``, ``tuples`` and the first ``sample_ids``, at most so many."""
    lost = tuples.select("tuple_id", "time").distinct().where(~is_blank(F.col("time")) & normalized_time(F.col("time")).isNull())
    counted = lost.groupBy("time").agg(F.count("*").alias("tuples"))
    # The limit on the rank is applied before the shuffle too, so a frequent text isn't gathered.
    rank = F.row_number().over(Window.partitionBy("time").orderBy("tuple_id"))
    few = lost.withColumn("rank", rank).where(F.col("rank") <= samples).groupBy("time").agg(F.array_sort(F.collect_list("tuple_id")).alias("sample_ids"))
    return counted.join(few, "time")


def in_story_order(tuples: DataFrame, scratch: Scratch) -> DataFrame:
    """Tuples with their ``position`` in the document's order by time.

    Years ascend; a year with a row of year precision is in document order, else months ascend; a month with a row
    of month precision is in document order, else days ascend. Tuples without time come last, in document order.
    Whether a year or month is coarse is aggregated and joined back; the position is a distributed rank.
    """
    rows = tuples.select(*FIELDS).distinct().withColumn("a", time_anchor(F.col("time"))).withColumn("place", _place(tuples))
    rows = rows.select(*FIELDS, "place", F.col("a.year").alias("y"), F.col("a.month").alias("m"), F.col("a.day").alias("d"), F.col("a.level").alias("level"))
    rows = scratch.cut(rows, "rows")
    spans = rows.where("level > 0").groupBy("doc_id", "y", "m").agg(F.max(F.col("level") == 1).alias("of_year"), F.max(F.col("level") == 2).alias("coarse_m"))
    years = spans.groupBy("doc_id", "y").agg(F.max("of_year").alias("coarse_y"))
    months = spans.where("m is not null").select("doc_id", "y", "m", "coarse_m")
    rows = rows.join(years, ["doc_id", "y"], "left").join(months, ["doc_id", "y", "m"], "left")
    coarse_y, coarse_m = F.coalesce("coarse_y", F.lit(False)), F.coalesce("coarse_m", F.lit(False))
    rows = rows.select(
        *FIELDS,
        F.col("y").isNull().cast("int").alias("k0"),
        F.coalesce("y", F.lit(0)).alias("k1"),
        F.when(coarse_y, 0).otherwise(F.coalesce("m", F.lit(0))).alias("k2"),
        F.when(coarse_y | coarse_m, 0).otherwise(F.coalesce("d", F.lit(0))).alias("k3"),
        F.col("place.s").alias("k4"),
        F.col("place.t").alias("k5"),
    )
    keys = ["k0", "k1", "k2", "k3", "k4", "k5", "tuple_id"]
    return distributed_rank(rows, ["doc_id"], [F.col(k) for k in keys], "position", scratch).select(*FIELDS, "position")


def _ordered_values(value: Column, place: Column) -> Column:
    """Distinct values in the order of their first place."""
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("p"), value.alias("v")))), lambda e: e["v"]))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _linked(ids: pd.Series, subjects: pd.Series, objects: pd.Series) -> pd.Series:
    """For the tuples of each group the place of the first one that they are linked with, directly or through others."""
    out = []
    for group in zip(ids, subjects, objects, strict=True):
        if group[0] is None:
            out.append(None)
            continue
        root = list(range(len(group[0])))

        def find(i: int, root=root) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        for column in group:
            first: dict = {}
            for i, value in enumerate(column):
                if value is not None:
                    a, b = find(first.setdefault(value, i)), find(i)
                    root[max(a, b)] = min(a, b)
        out.append([find(i) for i in root])
    return pd.Series(out, dtype=object)


def merged_in_sentences(tuples: DataFrame, scratch: Scratch, most: int = MOST_GROUP) -> DataFrame:
    """Tuples of a sentence with equal relation and time that share their subject or object, directly or through others, as one.

    Result: ``tuple_id`` of the first, ``doc_id``, ``sentence_id``, ``relation``, ``time``, ``subjects``, ``objects``
    and ``locations`` (distinct values in order; subjects and objects without blanks), ``members``.

    Links never leave a sentence, relation and time. Groups of up to ``most`` tuples are gathered by one shuffle and
    solved where they are; in larger ones the links run from tuples to their values, one row each, and are reduced by alternating
    stars.
    """
    rows = tuples.select(*FIELDS).distinct().withColumn("sentence_id", sentence_of(F.col("source_sent_id"), F.col("sent_id"), F.col("tuple_id"))).withColumn("place", _place(tuples))
    rows = rows.withColumn("group", F.md5(F.to_json(F.struct("sentence_id", "relation", "time"), {"ignoreNullFields": "false"})))
    rows = scratch.cut(rows.select("group", "tuple_id", "doc_id", "sentence_id", "relation", "time", "subject", "object", "location", "place"), "rows")
    hot = scratch.cut(rows.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > most).select("group"), "hot")
    some = hot.limit(1).count() > 0
    told = lambda c: F.when(~is_blank(c), c)
    fine = rows.join(hot, "group", "left_anti") if some else rows
    own = F.struct("tuple_id", "doc_id", "sentence_id", "relation", "time", "subject", "object", "location", "place")
    groups = fine.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("place", own.alias("r")))).alias("rows"))
    several = lambda f: F.when(F.size("rows") > 1, F.transform("rows", lambda e: f(e["r"])))
    label = _linked(several(lambda r: r["tuple_id"]), several(lambda r: told(r["subject"])), several(lambda r: told(r["object"])))
    each = groups.withColumn("labels", label).select("group", F.posexplode("rows").alias("i", "e"), "labels")
    each = each.select("group", F.coalesce(F.get("labels", F.col("i")), F.lit(0)).cast("string").alias("label"), "e.r.*")
    if some:
        each = each.unionByName(_labelled_by_stars(rows.join(hot, "group", "left_semi"), scratch))
    place = F.col("place")
    return each.groupBy("group", "label").agg(
        F.min_by("tuple_id", place).alias("tuple_id"),
        F.min("doc_id").alias("doc_id"),
        F.min("sentence_id").alias("sentence_id"),
        F.min("relation").alias("relation"),
        F.min("time").alias("time"),
        F.array_compact(_ordered_values(told(F.col("subject")), place)).alias("subjects"),
        F.array_compact(_ordered_values(told(F.col("object")), place)).alias("objects"),
        F.array_compact(_ordered_values(F.col("location"), place)).alias("locations"),
        F.count("*").alias("members"),
    ).drop("group", "label")


def _labelled_by_stars(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Large groups: the tuples with the smallest node of what they are linked with."""
    rows = scratch.cut(rows, "large")
    node = lambda kind, c: F.concat(F.lit(kind), F.md5(F.concat_ws("\x1f", "group", c)))
    own = F.concat(F.lit("0"), F.col("tuple_id"))
    link = lambda kind, c: rows.where(~is_blank(F.col(c))).select(own.alias("u"), node(kind, F.col(c)).alias("v"))
    links = link("1", "subject").unionByName(link("2", "object"))
    # A value that only one tuple has links nothing.
    shared = links.groupBy("v").agg(F.count("*").alias("times")).where("times > 1").select("v")
    labels = star_components(links.join(shared, "v", "left_semi"), scratch)
    named = rows.withColumn("node", own).join(labels, "node", "left")
    return named.select("group", F.coalesce("label", "node").alias("label"), "tuple_id", "doc_id", "sentence_id", "relation", "time", "subject", "object", "location", "place")


def merged_across_document(merged: DataFrame) -> DataFrame:
    """Merged tuples of a document with equal subjects, relation, objects and time as one, with all locations.

    ``copies`` counts them; the first keeps its ids.
    """
    # relation and objects stay arrays here: equal lists in equal order are equal values.
    place = F.struct(F.coalesce(id_number(F.col("tuple_id"), "s"), F.lit(0)), F.coalesce(id_number(F.col("tuple_id"), "t"), F.lit(0)), F.col("tuple_id"))
    spots = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("p"), F.col("locations").alias("v")))), lambda e: e["v"])))
    return merged.groupBy("doc_id", "subjects", "relation", "objects", "time").agg(
        F.min_by("tuple_id", place).alias("tuple_id"), F.min_by("sentence_id", place).alias("sentence_id"), spots.alias("locations"), F.sum("members").alias("members"), F.count("*").alias("copies")
    )


def merge_figures(tuples: DataFrame, in_sentences: DataFrame, in_document: DataFrame) -> DataFrame:
    """One row of counts of the merged export."""
    a = tuples.select(*FIELDS).distinct().agg(F.count("*").alias("tuples"))
    b = in_sentences.agg(F.count("*").alias("sentence_tuples"), F.count_if(F.col("members") > 1).alias("merged_groups"), F.coalesce(F.sum(F.col("members") - 1), F.lit(0)).alias("merged_away"))
    c = in_document.agg(
        F.count("*").alias("document_tuples"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        F.count_if(F.size("subjects") > 1).alias("subject_lists"),
        F.count_if(F.size("objects") > 1).alias("object_lists"),
        F.count_if(F.size("locations") > 1).alias("location_lists"),
    )
    one = F.lit(1).alias("one")
    return a.select("*", one).join(b.select("*", one), "one").join(c.select("*", one), "one").drop("one")


def expanded(merged: DataFrame) -> DataFrame:
    """Every subject with every object of a merged tuple; ids are numbered in that order."""
    rows = merged.select("tuple_id", "sentence_id", "relation", "time", F.posexplode_outer("subjects").alias("i", "subject"), "objects").select("tuple_id", "sentence_id", "relation", "time", "i", "subject", F.size("objects").alias("n"), F.posexplode_outer("objects").alias("j", "object"))
    number = F.coalesce(F.col("i"), F.lit(0)) * F.greatest(F.col("n"), F.lit(1)) + F.coalesce(F.col("j"), F.lit(0)) + 1
    return rows.select("tuple_id", number.cast("int").alias("part"), "subject", "relation", "object", "time")


def sentence_counts(tuples: DataFrame, scratch: Scratch) -> DataFrame:
    """Tuples per sentence with the ``rank`` by count (most first), then by sentence."""
    rows = tuples.select("tuple_id", "doc_id", sentence_of(F.col("source_sent_id"), F.col("sent_id"), F.col("tuple_id")).alias("sentence_id")).distinct()
    counts = rows.groupBy("doc_id", "sentence_id").agg(F.count("*").alias("tuple_count"), F.array_sort(F.collect_set("tuple_id")).alias("tuple_ids"))
    return distributed_rank(counts, [], [F.desc("tuple_count"), F.col("sentence_id")], "rank", scratch)


def count_histogram(tuples: DataFrame) -> DataFrame:
    """How many sentences have so many tuples."""
    return _per_sentence(tuples).groupBy("tuple_count").agg(F.count("*").alias("sentence_count"))


def _per_sentence(tuples: DataFrame) -> DataFrame:
    rows = tuples.select("tuple_id", sentence_of(F.col("source_sent_id"), F.col("sent_id"), F.col("tuple_id")).alias("sentence_id")).distinct()
    return rows.groupBy("sentence_id").agg(F.count("*").alias("tuple_count"))


def global_counts(tuples: DataFrame) -> DataFrame:
    """Sum, number, largest, smallest, mean (four decimals) and median of tuples per sentence.

    The median is taken from the histogram, which has as many rows as there are different counts.
    """
    per = count_histogram(tuples)
    total = per.agg(
        F.sum(F.col("tuple_count") * F.col("sentence_count")).alias("tuples"),
        F.sum("sentence_count").alias("sentences"),
        F.max("tuple_count").alias("most"),
        F.min("tuple_count").alias("least"),
        F.expr("percentile(tuple_count, 0.5D, sentence_count)").alias("median"),
    )
    return total.select("tuples", "sentences", "most", "least", F.round(F.col("tuples") / F.col("sentences"), 4).alias("mean"), "median")


def report_markdown(figures: DataFrame, histogram: DataFrame) -> str:
    """The statistics as a short Markdown report; both inputs are aggregates, the histogram has a row for each different count."""
    f = figures.first()
    lines = ["# Tuples per sentence", "", f"- tuples: {f['tuples']}", f"- sentences: {f['sentences']}", f"- mean {f['mean']}, median {f['median']}, most {f['most']}, least {f['least']}", "", "| tuples | sentences |", "| --- | --- |"]
    lines += [f"| {r['tuple_count']} | {r['sentence_count']} |" for r in histogram.orderBy(F.desc("tuple_count")).collect()]
    return "\n".join(lines) + "\n"

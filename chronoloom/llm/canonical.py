"""Free-entered values mapped to the entries of a reference list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.functions.text import fold, is_blank
from chronoloom.sources.tables import Scratch

#: Words that name nothing, in folded form, before and after a name.
BEFORE = ["所谓", "有关", "原", "the"]
AFTER = ["方面", "人员", "一带", "一事", "简称", "等"]
#: The weights of a slip.
WEIGHTS = {"exact": 0.0, "swapped": 0.7, "missing": 0.8, "added": 0.8, "wrong": 1.0}
#: The dictionary is broadcast only up to this size, reckoned from the lengths of the names; a larger one is shuffled.
BROADCAST_BYTES = 64_000_000


def surface(c: Column) -> Column:
    """Case, width and script variant folded; blanks and punctuation removed."""
    return F.regexp_replace(fold(c), r"[^\p{L}\p{M}\p{N}]+", "")


def bare(c: Column) -> Column:
    """A surface without the added words that name nothing."""
    return F.regexp_replace(c, f"^(?:{'|'.join(BEFORE)})+|(?:{'|'.join(AFTER)})+$", "")


def _deletes(df: DataFrame, text: str) -> DataFrame:
    """A row for the text itself (``at`` -1) and one for each sign left out: ``key``, ``at`` and the sign ``sign``."""
    whole = F.array(F.struct(F.col(text).alias("key"), F.lit(-1).alias("at"), F.lit("").alias("sign")))
    n = F.length(text)
    drop = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(
            F.concat(F.substring(F.col(text), F.lit(1), i - 1), F.substring(F.col(text), i + 1, n)).alias("key"),
            i.alias("at"),
            F.substring(F.col(text), i, F.lit(1)).alias("sign"),
        ),
    )
    every = F.when(n > 0, F.concat(whole, drop)).otherwise(whole)
    return df.withColumn("_d", F.explode(every)).select("*", "_d.key", "_d.at", "_d.sign").drop("_d")


def resolve(records: DataFrame, reference: DataFrame) -> DataFrame:
    """The reference entry that each record means: ``origin``, ``record_key``, ``cid`` ('none' if it means none).

    ``records``: ``origin``, ``record_key``, ``type``, ``raw_str``. ``reference``: ``cid``, ``canonical_str``,
    ``type``, ``aliases``. Other columns are ignored. A record counts once however often it is repeated; records
    with a null or blank ``raw_str`` give no row; a null type matches nothing, so such a record means 'none'.
    Texts longer than any reference name by more than one sign can't match and are never taken apart.

    Distinct strings are looked up in a symmetric-delete dictionary: a string and a name are within one slip
    exactly if they share a key of their own texts and texts with one sign left out, in fitting places. Among
    several entries the lowest weighted Damerau-Levenshtein distance wins, then the entry that more records write
    without a slip, then the smaller cid. A join on strings and a partial aggregation are the only shuffles.
    """
    scratch = Scratch(records.sparkSession, "canonical")
    name = F.explode(F.array_distinct(F.concat(F.array("canonical_str"), F.coalesce("aliases", F.array().cast("array<string>")))))
    names = reference.select("cid", "type", name.alias("n")).select("cid", "type", surface(F.col("n")).alias("name")).where("name <> ''").distinct()
    # A name of n signs gives n + 1 keys of about n signs; each row holds some 64 bytes besides.
    size = (F.length("name") + 1) * (3 * F.length("name") + 64)
    bound, longest = names.agg(F.sum(size), F.max(F.length("name"))).first()
    book = _deletes(names, "name").select(F.col("type").alias("kind"), "key", "cid", F.length("name").alias("book_len"), F.col("at").alias("book_at"), F.col("sign").alias("book_sign"))
    if (bound or 0) <= BROADCAST_BYTES:
        book = F.broadcast(book)
    records = records.where(~is_blank(F.col("raw_str"))).select("origin", "record_key", "type", "raw_str").distinct()
    records = scratch.cut(records, "records")
    strings = records.groupBy("type", "raw_str").agg(F.count("*").alias("n"))
    own = surface(F.col("raw_str"))
    forms = strings.withColumn("own", own).where(F.col("own") != "").withColumn("form", F.explode(F.array_distinct(F.array("own", bare(F.col("own")))))).drop("own")
    forms = forms.where((F.col("form") != "") & (F.length("form") <= (longest or 0) + 1))
    asked = _deletes(forms, "form")
    same_place = (F.col("at") > 0) & (F.col("book_at") > 0) & (F.length("form") == F.col("book_len"))
    cost = (
        F.when((F.col("at") < 0) & (F.col("book_at") < 0), F.lit(WEIGHTS["exact"]))
        .when((F.col("at") < 0) & (F.col("book_at") > 0), F.lit(WEIGHTS["missing"]))
        .when((F.col("at") > 0) & (F.col("book_at") < 0), F.lit(WEIGHTS["added"]))
        .when(same_place & (F.abs(F.col("at") - F.col("book_at")) == 1) & (F.col("sign") == F.col("book_sign")), F.lit(WEIGHTS["swapped"]))
        .when(same_place & (F.col("at") == F.col("book_at")), F.lit(WEIGHTS["wrong"]))
    )
    hits = asked.join(book, (asked["type"] == book["kind"]) & (asked["key"] == book["key"])).withColumn("cost", cost).where("cost is not null")
    hits = scratch.cut(hits.groupBy("type", "raw_str", "cid").agg(F.min("cost").alias("cost"), F.max("n").alias("n")), "hits")
    often = hits.where("cost = 0").groupBy("cid").agg(F.sum("n").alias("often"))
    best = hits.join(often, "cid", "left").groupBy("type", "raw_str").agg(F.min(F.struct("cost", (-F.coalesce("often", F.lit(0))).alias("seldom"), "cid")).alias("b")).select("type", "raw_str", "b.cid")
    return records.join(best, ["type", "raw_str"], "left").select("origin", "record_key", F.coalesce("cid", F.lit("none")).alias("cid"))

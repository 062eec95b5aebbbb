"""One surviving record for each group of records of the same thing, chosen field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.functions.text import fold, squeeze, strip

#: Stand-ins that say nothing, in folded form. Values without any letter or digit say nothing either.
STAND_INS = ["nan", "n/a", "na", "null", "none", "nil", "tbd", "unknown", "（空）", "(空)", "空", "无", "暂无", "不详", "未知", "待补充", "待定", "同上"]
#: Age at which a vote counts half, in days.
HALF_LIFE_DAYS = 180.0
FIELDS = ("raw_str", "description", "count")
#: What a record's vote for its value is made of, by field: weights in order, each beyond any amount of the next one.
POLICY = {"raw_str": ("trust", "recency"), "description": ("length", "recency"), "count": ("recency",)}
#: Instead of weights in order: trust times recency decay, summed up.
SUMMED = {f: ("trust x decay",) for f in FIELDS}


def says_something(plain: Column) -> Column:
    """Whether a value says anything, by its normalised form."""
    return F.coalesce(plain.rlike(r"[\p{L}\p{N}]") & ~plain.isin(STAND_INS), F.lit(False))


def field_winners(versions: DataFrame, half_life_days: float = HALF_LIFE_DAYS, policy: dict[str, tuple[str, ...]] = POLICY) -> DataFrame:
    """For each ``id`` and ``field`` the record whose value survives.

    ``versions``: ``record_id``, ``id``, ``raw_str``, ``description`` (text), ``count`` (int), ``trust`` (int),
    ``updated_at`` (timestamp); other columns are ignored. Rows are unpivoted to one row per field whose value says
    something (``count``: above 0). Every record votes for its normalised value, the votes of a value are summed up,
    and the value with the most of them is elected by ``max_by``. ``policy`` says what a vote is:

    * ``("trust x decay",)``: source trust times recency decay, summed as numbers (``SUMMED``);
    * weights in order, such as ``("trust", "recency")``: a single vote of more trust outweighs any number of votes of
      less trust, and so on; the sum of such votes is their greatest one. Weights: ``trust``, ``recency``, ``length``
      (without outer white space). Null dates are oldest, null trust is lowest.

    By default (``POLICY``) the ``raw_str`` of the highest trust survives, then the newest; the longest
    ``description``, then the newest; the newest ``count``. Equal votes go to the smallest ``record_id``. The record
    of a value is its best voter.

    Result: ``id``, ``field``, ``record_id``, ``value`` (as text), ``votes`` (trust times decay, summed) of the
    surviving value, and ``favourite`` with ``favourite_votes``, the value with most of these. Ids without any telling value
    give no rows, nor do null ids; repeated rows count once. Both steps aggregate partially before their shuffle.
    """
    rows = versions.select("record_id", "id", "raw_str", "description", "count", "trust", "updated_at").where("id is not null").distinct()
    # The normalised values, worked out once for what they are needed for.
    rows = rows.withColumns({"_raw_str": squeeze(fold(F.col("raw_str"))), "_description": squeeze(fold(F.col("description")))})
    # Computed only where a vote with decay is asked for.
    newest = rows.agg(F.max("updated_at")).scalar()
    decay = F.coalesce(F.pow(F.lit(0.5), F.datediff(newest, F.col("updated_at")) / F.lit(half_life_days)), F.lit(0.0))
    vote = F.coalesce("trust", F.lit(0)) * decay
    length = F.length(strip(F.col("description")))

    def one(field: str, value: Column, norm: Column, telling: Column) -> Column:
        weights = {"trust": F.coalesce("trust", F.lit(-1)), "recency": F.unix_micros("updated_at"), "length": length if field == "description" else F.length(strip(value.cast("string")))}
        in_order = [weights[w].cast("double") for w in policy[field] if w != "trust x decay"]
        summed = vote if "trust x decay" in policy[field] else F.lit(0.0)
        own = F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"), norm.alias("norm"), summed.alias("summed"), *(w.alias(f"w{n}") for n, w in enumerate([*in_order, *[F.lit(0.0)] * (3 - len(in_order))])))
        return F.when(telling, own)

    cells = F.array_compact(
        F.array(
            one("raw_str", F.col("raw_str"), F.col("_raw_str"), says_something(F.col("_raw_str"))),
            one("description", F.col("description"), F.col("_description"), says_something(F.col("_description"))),
            one("count", F.col("count"), F.col("count").cast("string"), F.col("count") > 0),
        )
    )
    long = rows.select("id", "record_id", vote.alias("vote"), F.explode(cells).alias("c")).select("id", "record_id", "vote", "c.*")
    # Structs compare field by field and nulls come first: null dates are oldest.
    in_order = F.struct("w0", "w1", "w2")
    values = long.groupBy("id", "field", "norm").agg(
        F.sum("vote").alias("votes"),
        F.struct(F.round(F.sum("summed"), 9).alias("summed"), F.max(in_order).alias("greatest")).alias("power"),
        F.max_by(F.struct("record_id", "value"), F.struct("summed", in_order, -F.col("record_id"))).alias("best"),
    )
    power = F.struct("power", -F.col("best.record_id"))
    won = values.groupBy("id", "field").agg(
        F.max_by(F.struct("best.record_id", "best.value", "votes"), power).alias("w"),
        F.max_by(F.struct("best.value", "votes"), F.struct("votes", power)).alias("f"),
    )
    return won.select("id", "field", "w.record_id", "w.value", F.round("w.votes", 6).alias("votes"), F.col("f.value").alias("favourite"), F.round("f.votes", 6).alias("favourite_votes"))


def survivors(versions: DataFrame) -> DataFrame:
    """The surviving records, pivoted back: ``id``, ``raw_str``, ``description``, ``count``; null where no value says anything."""
    won = field_winners(versions)
    return won.groupBy("id").agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS)).withColumn("count", F.col("count").cast("int"))

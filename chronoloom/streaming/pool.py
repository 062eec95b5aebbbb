"""Streams of tuples: the concept pool kept up to date, and counts over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from chronoloom.operators.concepts import occurrences

POOL = "type string, concept string, source string, first_seen timestamp"


def pool_stream(tuples: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream of tuples whose concepts and sources are appended to the pool at ``path``, batch by batch.

    Each batch writes a folder of its own under its number, so a batch that is repeated after a failure replaces its
    own rows: every source counts once. ``read_pool`` brings the batches together.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        rows = occurrences(batch).where("source is not null")
        fresh = rows.groupBy("type", "concept", "source").agg(F.min("place.ingested_at").alias("first_seen"))
        fresh.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return tuples.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)


def read_pool(spark, path: str) -> DataFrame:
    """``type``, ``concept``, ``count`` of distinct sources and ``first_seen``."""
    rows = spark.read.schema(POOL + ", batch long").parquet(path)
    one = rows.groupBy("type", "concept", "source").agg(F.min("first_seen").alias("first_seen"))
    return one.groupBy("type", "concept").agg(F.count("*").alias("count"), F.min("first_seen").alias("first_seen"))


def windowed_counts(tuples: DataFrame, late: str = "60 days", window: str = "1 day") -> DataFrame:
    """Tuples per relation and window of ``ingested_at``; rows later than ``late`` are dropped by the watermark."""
    return tuples.withWatermark("ingested_at", late).groupBy(F.window("ingested_at", window).alias("w"), "relation").agg(F.count("*").alias("tuples")).select("w.start", "w.end", "relation", "tuples")

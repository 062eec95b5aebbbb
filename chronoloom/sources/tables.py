"""Parquet tables of a warehouse folder, and tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The table, with only the named columns if some are named."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs on one machine (tests, a laptop) a temporary folder is made; on a
    cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(-cluster)?(\[.*\])?", spark.sparkContext.master):
        raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="chronoloom-")
    return _own_folder[app]


class Scratch:
    """Tables written to the shared folder in place of a checkpoint.

    They hold one copy outside the executors, so the loss of an executor costs no recomputation beyond its own
    tasks. ``drop`` removes a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def cut(self, df: DataFrame, label: str = "t") -> DataFrame:
        """Write ``df`` and return it as read from there."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{label}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm = self.spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

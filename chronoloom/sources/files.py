"""Text, JSON and vector files of a news warehouse."""

from __future__ import annotations

import io
import json
import uuid

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.functions.text import file_doc_id, is_blank, safe_file_name
from chronoloom.plans.scope import in_scope
from chronoloom.plans.stages import exists
from chronoloom.sources import hadoop as files
from chronoloom.sources.tables import Scratch

#: The last row of a complete JSON lines file, where one is wanted.
SENTINEL = "__done__"
#: Bytes at the end of a file that are looked at for it.
TAIL_BYTES = 4_096


def first_files(spark: SparkSession, folder: str, most: int, scope: str = "all") -> DataFrame:
    """The first text files of a folder by name, no more than so many (a limit that the caller asks for): see ``read_texts``."""
    return read_texts(spark, folder, scope).orderBy("file_name").limit(most)


def read_texts(spark: SparkSession, folder: str, scope: str = "all") -> DataFrame:
    """One row per text file, empty ones too: ``doc_id``, ``file_name``, ``text``. The scope prunes by name."""
    rows = spark.read.text(f"{folder}/*.txt", wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))
    rows = rows.withColumn("file_name", F.url_decode(F.replace("file_name", F.lit("+"), F.lit("%2B"))))
    if empty := _empty_files(folder):  # a scan passes over them
        rows = rows.unionByName(spark.createDataFrame([(n, "") for n in empty], "file_name string, text string"))
    rows = rows.where(in_scope(F.col("file_name"), scope))
    return rows.select(file_doc_id(F.col("file_name")).alias("doc_id"), "file_name", "text")


def _empty_files(folder: str) -> list[str]:
    """Names of empty text files, from the listing that a scan needs on the driver too."""
    where, root = fs.FileSystem.from_uri(folder)
    return [i.base_name for i in where.get_file_info(fs.FileSelector(root)) if i.is_file and i.size == 0 and i.base_name.endswith(".txt")]


def text_folder(spark: SparkSession, root: str, scope: str = "all") -> tuple[str, str]:
    """The first of ``cleaned``, ``sources`` and the root that holds texts of the scope, and its name."""
    for name in ("cleaned", "sources", ""):
        path = f"{root}/{name}".rstrip("/")
        if exists(spark, path) and any(spark.read.format("binaryFile").load(path).select("path").where(F.col("path").endswith(".txt") & in_scope(F.element_at(F.split("path", "/"), -1), scope)).take(1)):
            return path, name or "raw"
    raise FileNotFoundError(f"no texts of the scope below {root}")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; blank lines and the sentinel row are left out. A missing path is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    lines = spark.read.text(path).where((F.length(F.trim("value")) > 0) & F.get_json_object("value", f"$.{SENTINEL}").isNull())
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def write_json_lines(df: DataFrame, path: str) -> None:
    """JSON lines; the folder's _SUCCESS file stands for the sentinel."""
    df.write.mode("overwrite").json(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a written table is complete: its _SUCCESS file is there, or the last line of the file that isn't blank is the sentinel.

    Of a file only the last ``TAIL_BYTES`` are read.
    """
    if exists(spark, f"{path}/_SUCCESS"):
        return True
    if not exists(spark, path) or files.is_folder(spark, path):
        return False
    lines = [x for x in files.tail(spark, path, TAIL_BYTES).decode("utf-8", "replace").splitlines() if x.strip()]
    try:
        last = json.loads(lines[-1]) if lines else None
    except ValueError:
        return False
    return isinstance(last, dict) and last.get(SENTINEL) is True


def read_json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON array or object that spans lines; array entries that are no objects are left out."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def write_json_object(spark: SparkSession, path: str, value) -> None:
    """A JSON object or array of driver-side facts (manifests, reports), put in place whole or not at all."""
    files.replace(spark, path, json.dumps(value, ensure_ascii=False, indent=2).encode())


def latest_file(spark: SparkSession, folder: str, ending: str = ".json") -> str | None:
    """The path of the file that was changed last, of equal ones the last by name; None where there is none."""
    where, root = fs.FileSystem.from_uri(folder)
    found = [i for i in where.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.is_file and i.base_name.endswith(ending)]
    best = max(found, key=lambda i: (i.mtime_ns, i.base_name), default=None)
    return best and f"{folder.rstrip('/')}/{best.base_name}"


def read_json_object(spark: SparkSession, path: str):
    """What such a file holds; of an array only the entries that are objects."""
    value = json.loads(files.read(spark, path).decode())
    return [x for x in value if isinstance(x, dict)] if isinstance(value, list) else value


def _files_written(rows: DataFrame, folder: str, write) -> DataFrame:
    """Runs ``write(open_for, pdf)`` over all rows, where ``open_for(name)`` opens a file of the folder; a row for each file: ``name``, ``rows``."""

    def run(frames):
        where, root = fs.FileSystem.from_uri(folder)
        where.create_dir(root, recursive=True)
        for pdf in frames:
            if len(pdf):
                yield pd.DataFrame(write(lambda name: where.open_output_stream(f"{root}/{name}"), pdf), columns=["name", "rows"])

    return Scratch(rows.sparkSession, "written").cut(rows.mapInPandas(run, "name string, rows long"))


def write_texts(rows: DataFrame, folder: str) -> DataFrame:
    """One text file per row (``file_name``, ``text``), named by it; null texts give empty files. Gives what was written: ``name``, ``rows``."""

    def write(open_for, pdf):
        for name, text in zip(pdf["file_name"], pdf["text"], strict=True):
            with open_for(name) as f:
                f.write((text or "").encode())
            yield name, 1

    return _files_written(rows.select("file_name", "text").where("file_name is not null"), folder, lambda o, pdf: list(write(o, pdf)))


def write_per_document(df: DataFrame, path: str, names: DataFrame | None = None) -> DataFrame:
    """JSON lines, one file per document, each named by ``names`` (``doc_id``, ``name``), else by the id: what was written as ``name``, ``rows``.

    A document's rows become lines before they meet. Names lose signs that file systems refuse; documents that would
    share a name keep their ids as theirs.
    """
    lines = df.select("doc_id", F.to_json(F.struct(*[c for c in df.columns if c != "doc_id"])).alias("line"))
    given = names if names is not None else lines.select("doc_id", F.lit(None).cast("string").alias("name")).distinct()
    told = given.groupBy("doc_id").agg(F.min(F.when(~is_blank(F.col("name")), F.col("name"))).alias("name")).withColumn("name", safe_file_name(F.col("name")))
    once = told.where("name is not null").groupBy("name").agg(F.count("*").alias("n")).where("n = 1").select("name")
    own = F.coalesce("name", safe_file_name(F.col("doc_id").cast("string")))
    file_name = told.join(once, "name", "left_semi").select("doc_id", "name")
    both = lines.join(file_name, "doc_id", "left").select(F.concat(own, F.lit(".jsonl")).alias("name"), "line")

    def write(open_for, pdf):
        for name, own_lines in pdf.groupby("name", sort=False)["line"]:
            with open_for(name) as f:
                f.write(("\n".join(sorted(own_lines)) + "\n").encode())
            yield name, len(own_lines)

    # One document's rows in one row, so that no file is written twice.
    gathered = both.groupBy("name").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return _files_written(gathered, path, lambda o, pdf: list(write(o, pdf.explode("lines").rename(columns={"lines": "line"}))))


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """``doc_id``, ``text``, ``meta`` from ``documents.jsonl``, else from processed texts; only raw texts are an error."""
    if exists(spark, f"{root}/documents.jsonl"):
        return read_json_lines(spark, f"{root}/documents.jsonl", "doc_id string, text string, meta map<string,string>")
    if exists(spark, f"{root}/processed"):
        return read_texts(spark, f"{root}/processed").select("doc_id", "text", F.create_map(F.lit("file_name"), F.col("file_name")).alias("meta"))
    raise FileNotFoundError(f"no documents.jsonl and no processed texts below {root}")


def write_vectors(df: DataFrame, path: str) -> None:
    """``id`` and ``vector`` as a Parquet table, in place of an archive of matrices."""
    df.select("id", F.col("vector").cast("array<float>").alias("vector")).write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, vector array<float>").parquet(path)


def write_archives(df: DataFrame, folder: str) -> DataFrame:
    """``id`` and ``vector`` as NumPy archives with ``ids`` and a matrix ``vectors``, one for each batch of rows: ``name``, ``rows``."""

    def write(open_for, pdf):
        name = f"vectors-{uuid.uuid4().hex}.npz"
        out = io.BytesIO()
        np.savez(out, ids=pdf["id"].to_numpy(dtype=str), vectors=np.stack(pdf["vector"]).astype(np.float32))
        with open_for(name) as f:
            f.write(out.getvalue())
        return [(name, len(pdf))]

    return _files_written(df.select(F.col("id").cast("string").alias("id"), "vector").where("id is not null and vector is not null"), folder, write)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``id``, ``vector`` of all archives of a folder; ids and matrix must have as many rows."""

    def run(frames):
        for pdf in frames:
            for content in pdf["content"]:
                with np.load(io.BytesIO(content), allow_pickle=False) as z:
                    ids, m = z["ids"], z["vectors"]
                if len(ids) != len(m):
                    raise ValueError("an archive's ids and vectors differ in number")
                yield pd.DataFrame({"id": ids.astype(str), "vector": list(m.astype(np.float32))})

    return spark.read.format("binaryFile").load(f"{folder}/*.npz").select("content").mapInPandas(run, "id string, vector array<float>")


def cached(spark: SparkSession, path: str) -> DataFrame | None:
    """Stored answers by key, the latest of each; None where nothing is stored yet."""
    if not exists(spark, path):
        return None
    return spark.read.schema("key string, response string, at timestamp").parquet(path).groupBy("key").agg(F.max_by("response", "at").alias("response"))


def store(answers: DataFrame, path: str) -> None:
    """Appends answers without error to the cache."""
    answers.where("error is null").select("key", "response", F.current_timestamp().alias("at")).dropDuplicates(["key"]).write.mode("append").parquet(path)

"""Timeline correction: the end time of every document and what speaks against it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoloom.functions import timeline as T
from chronoloom.functions.text import news_code, stem, title_parts

CANDIDATE = "struct<year:int,month:int,day:int,precision:string,normalized:string,source:string,matched_text:string,line_number:int,confidence:double,tags:array<string>>"
RECORD = (
    f"doc_id string, node_id string, category string, base_title string, raw_time string, malformed boolean, title_form string, flags array<string>, candidates array<{CANDIDATE}>, "
    f"final {CANDIDATE}, anchor date, temporal_status string, conflict boolean, reasons array<string>, ambiguity_tags array<string>"
)


def corrected(news: DataFrame) -> DataFrame:
    """One record per document: title hint, body candidates, final time, its last possible day, status and review reasons.

    ``news``: ``doc_id``, ``file_name``, ``text``; other columns are ignored. A null or empty text has no body
    candidates. The fold over a document's lines runs in Arrow batches; there is no shuffle.
    """
    parts = title_parts(stem(F.col("file_name")))
    code = news_code(F.col("file_name"))
    rows = news.select(
        "doc_id",
        F.coalesce(F.concat(code["prefix"], F.format_string("%03d", code["number"])), F.col("doc_id")).alias("node_id"),
        F.upper(F.regexp_extract(F.col("doc_id"), "^[A-Za-z]+", 0)).alias("category"),
        parts["base"].alias("base_title"),
        parts["raw_time"].alias("raw_time"),
        F.coalesce(parts["malformed"], F.lit(False)).alias("malformed"),
        "text",
    )

    def run(frames):
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                title = T.read_title(r.raw_time if isinstance(r.raw_time, str) else None, bool(r.malformed))
                body, vague = T.read_body(r.text if isinstance(r.text, str) else None, title)
                final = T.final_time(title, body)
                out.append(
                    (
                        r.doc_id, r.node_id, r.category, r.base_title, title.raw, title.malformed, title.form, title.flags, [c.row() for c in body], final.row() if final else None,
                        T.boundary(final.year, final.month, final.day, end=True) if final else None, T.status(title, final), T.conflict(title, body, final), T.review_reasons(title, body, final, vague), vague,
                    )
                )
            yield pd.DataFrame(out, columns=[x.split()[0] for x in ("doc_id node_id category base_title raw_time malformed title_form flags candidates final anchor temporal_status conflict reasons ambiguity_tags").split()])

    return rows.mapInPandas(run, RECORD)


def candidates(records: DataFrame) -> DataFrame:
    """The body candidates one by one."""
    return records.select("doc_id", F.posexplode("candidates").alias("n", "c")).select("doc_id", "n", "c.*")


def manifest(records: DataFrame) -> DataFrame:
    """The main fields of every document's record; a title gets its time appended in brackets."""
    label = F.col("final.normalized")
    return records.select(
        "doc_id", "node_id", "base_title", F.when(label.isNotNull(), F.concat("base_title", F.lit("（"), label, F.lit("）"))).otherwise(F.col("base_title")).alias("corrected_title"), F.col("raw_time").alias("raw_title_time"),
        label.alias("end_time"), F.col("final.precision").alias("end_time_precision"), F.col("final.confidence").alias("confidence"), "temporal_status", (F.size("reasons") > 0).alias("needs_review"), F.col("reasons").alias("review_reasons"), F.col("conflict").alias("title_body_conflict"),
    )


def summary(records: DataFrame) -> DataFrame:
    """One row of counts."""
    review = F.size("reasons") > 0
    return records.agg(
        F.count("*").alias("documents"),
        F.count_if(review).alias("needs_review"),
        F.count_if(~review & (F.coalesce("final.confidence", F.lit(0.0)) >= 0.8)).alias("high_confidence"),
        F.count_if("conflict").alias("conflicts"),
        F.count_if(F.col("temporal_status") == "unknown").alias("unknown"),
        F.count_if(F.col("temporal_status") == "title_only").alias("title_only"),
        F.count_if(F.col("temporal_status") == "inferred").alias("inferred"),
        F.count_if(F.col("temporal_status") == "exact").alias("exact"),
    )


def carried_years(rows: DataFrame) -> DataFrame:
    """Candidates with the ``year`` that holds for them: their own, else that of the last one before them in the document; null where there is none.

    ``rows``: ``doc_id``, ``line_number``, ``cand_id``, ``own_year``. The window goes over one document at a time.
    """
    before = Window.partitionBy("doc_id").orderBy(F.col("line_number").asc_nulls_last(), "cand_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("year", F.last("own_year", ignorenulls=True).over(before))


class _Extract:
    """One row per time candidate of a text; a null text has none."""

    def eval(self, text: str, title_time: str):
        body, _ = T.read_body(text, T.read_title(title_time))
        for c in body:
            r = c.row()
            yield tuple(r[k] for k in ("year", "month", "day", "precision", "normalized", "source", "matched_text", "line_number", "confidence", "tags"))


extract_time_candidates = F.udtf(_Extract, returnType=CANDIDATE.removeprefix("struct<").removesuffix(">").replace(":", " "))


def register(spark: SparkSession) -> None:
    """Makes the table function ``extract_time_candidates(text, title_time)`` known to SQL."""
    spark.udtf.register("extract_time_candidates", extract_time_candidates)

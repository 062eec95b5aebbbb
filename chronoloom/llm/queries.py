"""Registry of the queries of training-data operators and of their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm.canonical import resolve
from chronoloom.llm.clusters import cluster_pairs, describe, summary
from chronoloom.llm.components import group_elements
from chronoloom.llm.encoding import token_ids
from chronoloom.llm.leaks import leaked
from chronoloom.llm.neighbours import neighbour_pairs
from chronoloom.llm.residue import residue
from chronoloom.llm.sentences import sentences
from chronoloom.llm.survivors import field_winners, survivors
from chronoloom.sources.tables import table

QUERIES: dict = {}
SQL: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return group_elements(table(spark, folder, "dedup_elements", "id", "type", "alias_key"), table(spark, folder, "dedup_matches", "element_type", "left_key", "right_key"))


SQL["p3_found"] = """
WITH RECURSIVE m AS (
  SELECT DISTINCT element_type AS t, lower(regexp_replace(left_key, '^[\\s\\x{3000}]+|[\\s\\x{3000}]+$', '', 'g')) AS a,
         lower(regexp_replace(right_key, '^[\\s\\x{3000}]+|[\\s\\x{3000}]+$', '', 'g')) AS b
  FROM dedup_matches WHERE element_type IS NOT NULL AND left_key IS NOT NULL AND right_key IS NOT NULL),
u AS (SELECT * FROM m WHERE a <> '' AND b <> ''),
arcs AS (SELECT t, a, b FROM u UNION SELECT t, b, a FROM u UNION SELECT t, a, a FROM u UNION SELECT t, b, b FROM u),
e AS (SELECT DISTINCT id, type, alias_key FROM dedup_elements),
near AS (SELECT DISTINCT t, a, b FROM arcs),
walk(t, a, root) USING KEY (t, a) AS (
  SELECT t, a, min(b) FROM near GROUP BY t, a
  UNION
  SELECT n.t, n.b, min(w.root) FROM walk w JOIN near n ON n.t = w.t AND n.a = w.a JOIN recurring.walk r ON r.t = n.t AND r.a = n.b
  WHERE w.root < r.root GROUP BY n.t, n.b),
g AS (SELECT e.id, w.t, w.root FROM e JOIN walk w ON w.t = e.type AND w.a = e.alias_key)
SELECT id AS element_id, min(id) OVER (PARTITION BY t, root) AS group_id FROM g
"""


@query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    loose = table(spark, folder, "unresolved").select(F.lit("unresolved").alias("origin"), F.col("rec_id").cast("string").alias("record_key"), F.col("element_type").alias("type"), "raw_str")
    known = table(spark, folder, "dedup_elements").select(F.lit("dedup_elements").alias("origin"), F.col("id").alias("record_key"), "type", "raw_str")
    return resolve(loose.unionByName(known), table(spark, folder, "canonical"))


@query
def p4_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """The report of misses: how many records of each origin and type mean no entry."""
    return p4_found(spark, folder).groupBy("origin").agg(F.count_if(F.col("cid") == "none").alias("unmatched"), F.count("*").alias("records"))


@query
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return field_winners(table(spark, folder, "element_versions")).select("id", "field", "record_id")


@query
def p6_survivors(spark: SparkSession, folder: str) -> DataFrame:
    # A double: what reads nullable whole numbers differently compares them all the same.
    return survivors(table(spark, folder, "element_versions")).withColumn("count", F.col("count").cast("double"))


_TELLING = """
WITH v AS (SELECT DISTINCT record_id, id, raw_str, description, "count" AS n, trust, updated_at FROM element_versions WHERE id IS NOT NULL),
blank AS (SELECT unnest(['nan', 'n/a', 'na', 'null', 'none', 'nil', 'tbd', 'unknown', '（空）', '空', '无', '暂无', '不详', '未知', '待补充', '待定', '同上']) AS x),
s AS (SELECT *, regexp_replace(raw_str, '^[\\s\\x{3000}]+|[\\s\\x{3000}]+$', '', 'g') AS r, regexp_replace(description, '^[\\s\\x{3000}]+|[\\s\\x{3000}]+$', '', 'g') AS d FROM v),
c AS (
  SELECT id, 'raw_str' AS field, record_id, trust AS key, updated_at, raw_str AS value FROM s WHERE regexp_matches(r, '[\\p{L}\\p{N}]') AND lower(r) NOT IN (FROM blank)
  UNION ALL SELECT id, 'description', record_id, length(d), updated_at, description FROM s WHERE regexp_matches(d, '[\\p{L}\\p{N}]') AND lower(d) NOT IN (FROM blank)
  UNION ALL SELECT id, 'count', record_id, 0, updated_at, n::VARCHAR FROM s WHERE n > 0),
w AS (SELECT id, field, record_id, value FROM c QUALIFY row_number() OVER (PARTITION BY id, field ORDER BY key DESC NULLS LAST, updated_at DESC NULLS LAST, record_id) = 1)
"""
SQL["p6_found"] = _TELLING + "SELECT id, field, record_id FROM w"
SQL["p6_survivors"] = _TELLING + """SELECT id, max(value) FILTER (field = 'raw_str') AS raw_str, max(value) FILTER (field = 'description') AS description,
max(value) FILTER (field = 'count')::DOUBLE AS "count" FROM w GROUP BY id"""


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "dedup_elements", "id", "type", "vector")


@query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_pairs(_vectors(spark, folder))


@query
def p1_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return describe(_vectors(spark, folder))


@query
def p1_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summary(_vectors(spark, folder))


@query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return neighbour_pairs(_vectors(spark, folder))


@query
def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return token_ids(table(spark, folder, "documents", "doc_id", "text"))


@query
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaked(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "eval_items", "item_id", "text", "lang"))


@query
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue(table(spark, folder, "documents", "doc_id", "text"))


@query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentences(table(spark, folder, "raw_news", "news_id", "normalized_text"), "news_id", "normalized_text")

_UNITS = """
WITH d AS (SELECT DISTINCT id, type, vector::DOUBLE[] AS v FROM dedup_elements WHERE len(vector) = 96),
f AS (SELECT id, type, v FROM d WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
u AS (SELECT id, type, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS u FROM f)
"""
#: Clusters are sets of which all pairs, and no others, reach the cosine; so the pairs that reach it are the pairs of clusters.
SQL["p1_found"] = _UNITS + "SELECT a.id AS id_a, b.id AS id_b FROM u a JOIN u b ON a.type = b.type AND a.id < b.id WHERE list_inner_product(a.u, b.u) >= 0.77"
SQL["p5_found"] = _UNITS + """, s AS (SELECT a.id, b.id AS near, round(list_inner_product(a.u, b.u), 7) AS c FROM u a JOIN u b ON a.type = b.type AND a.id <> b.id),
k AS (SELECT id, near FROM s WHERE c >= 0.76 QUALIFY row_number() OVER (PARTITION BY id ORDER BY c DESC, near) <= 5) SELECT DISTINCT least(id, near) AS id_a, greatest(id, near) AS id_b FROM k"""

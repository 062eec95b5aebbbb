"""SQL (DuckDB) for the queries of sources and stages."""

from __future__ import annotations

from chronoloom.queries_sql import MERGE, SENTENCES, SQL as CORE, STEM, V, blank, squeeze, strip

SQL: dict[str, str] = {}

DOC_ID = CORE["news_codes"]
SQL["text_files"] = f"SELECT c.doc_id, n.file_name, md5(coalesce(n.text, '')) AS digest FROM raw_news n JOIN ({DOC_ID}) c USING (news_id)"
SQL["scoped_text_files"] = "SELECT file_name, 'sources' AS kind FROM raw_news WHERE regexp_matches(file_name, '^[Ee]\\d{3}([^0-9]|$)') AND substr(file_name, 2, 3)::INT BETWEEN 1 AND 500"
SQL["json_lines"] = "SELECT DISTINCT tuple_id, doc_id, subject, object, time, confidence FROM raw_tuples"
SQL["document_lines"] = "SELECT doc_id, normalized_text AS text, lang FROM raw_news"
SQL["processed_documents"] = f"SELECT c.doc_id, coalesce(n.normalized_text, '') AS text, n.file_name FROM raw_news n JOIN ({DOC_ID}) c USING (news_id)"
SQL["vector_table"] = "SELECT vec_id::VARCHAR AS id, len(embedding)::INT AS dimension, round(embedding[1]::FLOAT, 4) AS first FROM embeddings"
SQL["vector_archives"] = SQL["vector_table"]
SQL["split_by_document"] = f"""
WITH s AS (SELECT doc_id, trim(regexp_replace(regexp_replace({STEM}, '[\\\\/:*?"<>|]', '_', 'g'), '\\.+$', '')) AS name FROM raw_news),
one AS (SELECT doc_id, CASE WHEN count(*) OVER (PARTITION BY name) = 1 AND name <> '' THEN name END AS name FROM s),
t AS (SELECT DISTINCT doc_id, tuple_id, subject FROM raw_tuples)
SELECT coalesce(o.name, t.doc_id) || '.jsonl' AS name, count(*) AS rows FROM t LEFT JOIN one o USING (doc_id) GROUP BY 1"""
SQL["report_lines"] = f"""
WITH g AS ({CORE["tuple_global_stats"]}), h AS ({CORE["tuple_histogram"]}), n AS (SELECT *, row_number() OVER (ORDER BY tuple_count DESC) AS i FROM h)
SELECT 0 AS number, '# Tuples per sentence' AS line UNION ALL SELECT 1, '' UNION ALL SELECT 2, '- tuples: ' || tuples FROM g UNION ALL SELECT 3, '- sentences: ' || sentences FROM g
UNION ALL SELECT 4, '- mean ' || mean || ', median ' || median || ', most ' || most || ', least ' || least FROM g UNION ALL SELECT 5, '' UNION ALL SELECT 6, '| tuples | sentences |' UNION ALL SELECT 7, '| --- | --- |'
UNION ALL SELECT (7 + i)::INT, '| ' || tuple_count || ' | ' || sentence_count || ' |' FROM n"""
_ENTRY = "e AS (SELECT type, canonical_str AS c, coalesce(aliases, []) AS a, '{\"raw_str\":' || to_json(canonical_str)::VARCHAR || ',\"contexts\":' || to_json(coalesce(aliases, []))::VARCHAR || '}' AS payload FROM canonical)"
_TOLD = "c || CASE WHEN len(a) > 0 THEN '，' || a[1] ELSE '' END"
SQL["stored_answers"] = f"WITH {_ENTRY} SELECT type || '|' || c AS custom_id, 'describe:' || sha256(payload) AS key, {_TOLD} AS description FROM e"
SQL["described_pool"] = f"WITH {_ENTRY} SELECT type || '|' || c AS custom_id, trim({_TOLD}) AS text, true AS valid FROM e"
_NAMES = "('e100', 'm200', 'ec483', 'd013')"
SQL["file_names_wanted"] = f"SELECT news_id FROM raw_news WHERE " + " OR ".join(f"{x} IN {_NAMES}" for c in ("file_name", "doc_id") for x in (f"lower({strip(c)})", f"lower({strip(STEM.replace('file_name', c))})", f"split_part(lower({strip(c)}), ' ', 1)"))
SQL["first_texts"] = "SELECT file_name FROM raw_news ORDER BY file_name LIMIT 10"
SQL["pool_of_json"] = f"""
WITH e AS (SELECT DISTINCT type, id, raw_str, description, contexts FROM dedup_elements WHERE raw_str IS NOT NULL AND NOT {blank('raw_str')}),
c AS (SELECT *, list_filter(list_transform(coalesce(contexts, []), lambda x: {strip('x')}), lambda x: length(x) > 0) AS t FROM e),
d AS (SELECT *, list_filter(t, lambda x, i: list_position(t, x) = i) AS u FROM c)
SELECT {strip('raw_str')} AS concept, coalesce(description, '') AS description, u[1:5] AS contexts, len(u)::INT AS count FROM d"""
_LITERAL = "replace(replace(text, '海峡', '水道'), '  ', ' ')"
SQL["word_rules"] = f"SELECT news_id, array_to_string(list_transform(string_split({_LITERAL}, chr(10)), lambda l: CASE WHEN contains(l, '公司') OR contains(l, 'Council') THEN regexp_replace(regexp_replace(l, '公司(刊发)?', '企业', 'g'), 'Council', 'Board', 'g') ELSE l END), chr(10)) AS text FROM raw_news"

_SX = f"WITH {SENTENCES} "
SQL["compression_requests"] = _SX + "SELECT doc_id AS custom_id, '{\"sentences\":[' || string_agg('{\"sentence_id\":' || (sentence_index - 1) || ',\"text\":' || to_json(text)::VARCHAR || '}', ',' ORDER BY sentence_index) || ']}' AS payload FROM sx GROUP BY doc_id"
SQL["plan_requests"] = _SX + "SELECT sent_id AS custom_id, '{\"doc_id\":' || to_json(doc_id)::VARCHAR || ',\"句子编号\":' || to_json(sent_id)::VARCHAR || ',\"当前请求句\":' || to_json(text)::VARCHAR || '}' AS payload FROM sx"
SQL["checked_plans"] = _SX + "SELECT sent_id AS custom_id, CASE sentence_index % 6 WHEN 0 THEN '事件句' WHEN 1 THEN '事件句' WHEN 2 THEN '混合句' ELSE '不抽取句' END AS sentence_type, (sentence_index % 6 < 3)::INT AS units, sentence_index % 6 < 4 AS valid FROM sx"
SQL["extraction_requests"] = _SX + "SELECT sent_id AS custom_id, text AS sentence, text AS span FROM sx WHERE sentence_index % 6 < 3"
_NEAR = """n AS (SELECT DISTINCT t.subject AS concept, c.canonical_str AS candidate, abs(length(t.subject) - length(c.canonical_str)) AS far FROM raw_tuples t JOIN canonical c ON c.type = 'entity' AND substr(t.subject, 1, 1) = substr(c.canonical_str, 1, 1)),
r AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY concept ORDER BY far, candidate) <= 3), l AS (SELECT concept, list(candidate ORDER BY far, candidate) AS c FROM r GROUP BY concept),
q AS (SELECT DISTINCT t.source_sent_id || '|entity|' || t.subject AS custom_id, t.subject AS concept, l.c FROM raw_tuples t JOIN l ON l.concept = t.subject WHERE t.source_sent_id IS NOT NULL)"""
SQL["normalise_requests"] = f"WITH {_NEAR} SELECT custom_id, array_to_string(c, '|') AS candidates FROM q"
SQL["checked_normalisation"] = f"WITH {_NEAR}, m AS (SELECT *, length(custom_id) % 4 AS n FROM q) SELECT custom_id, concept, CASE WHEN n = 0 THEN c[1] ELSE concept END AS normalized, CASE n WHEN 2 THEN 'invalid_replacement' WHEN 3 THEN 'unreadable' END AS fault FROM m"
SQL["compliance_requests"] = "SELECT DISTINCT type || '|' || raw_str || '#' || id AS custom_id, least(2, coalesce(len(contexts), 0))::INT AS sentences FROM dedup_elements WHERE raw_str IS NOT NULL"
SQL["checked_compliance"] = "SELECT record_id::VARCHAR AS custom_id, record_id % 5 < 2 AS compliant, CASE WHEN record_id % 5 < 4 THEN origin END AS reason, record_id % 5 < 3 AS valid FROM (SELECT DISTINCT record_id, origin FROM element_versions)"
SQL["checked_fields"] = "SELECT record_id::VARCHAR AS custom_id, CASE WHEN id IS NULL THEN NULL ELSE CASE record_id % 4 WHEN 0 THEN 'entity' WHEN 1 THEN 'location' END END AS type, CASE WHEN id IS NULL THEN NULL ELSE CASE record_id % 4 WHEN 0 THEN '主体类别,核心角色' WHEN 1 THEN '区位范围,空间类型,议题作用' END END AS fields FROM (SELECT DISTINCT record_id, id FROM element_versions)"
SQL["field_texts"] = "SELECT cid, '概念：' || canonical_str || chr(10) || '概念类型：' || type || chr(10) || '字段：核心角色' || chr(10) || '内容：' || description AS text FROM canonical WHERE description IS NOT NULL"
SQL["judge_requests"] = f"""WITH {V}, s AS (SELECT a.id::VARCHAR AS id, b.id::VARCHAR AS near, round(list_inner_product(a.u, b.u), 9) AS score, b.id AS nid FROM u a JOIN u b ON a.label = b.label AND a.id <> b.id),
k AS (SELECT * FROM s WHERE score >= 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, nid) <= 4),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 6) DESC, near) AS rank FROM k), l AS (SELECT id, string_agg('v' || near, ',' ORDER BY rank) AS c FROM r WHERE rank <= 2 GROUP BY id)
SELECT e.vec_id::VARCHAR AS custom_id, 'v' || e.vec_id AS target, coalesce(l.c, '') AS candidates FROM embeddings e LEFT JOIN l ON l.id = e.vec_id::VARCHAR"""
SQL["checked_names"] = "SELECT cid AS custom_id, CASE WHEN len(aliases) = 0 THEN 0 ELSE len(list_distinct(list_filter(list_transform(aliases, lambda x: trim(x)), lambda x: x <> ''))) END::INT AS names, len(aliases) > 0 AS valid FROM canonical WHERE aliases IS NOT NULL"
_MEMBERS = "m AS (SELECT DISTINCT type || substr(canonical_str, 1, 1) AS cluster_id, canonical_str AS concept FROM canonical)"
SQL["cluster_requests"] = f"WITH {_MEMBERS} SELECT cluster_id AS custom_id, string_agg(concept, '|' ORDER BY concept) AS concepts FROM m GROUP BY cluster_id"
SQL["merged_groups"] = f"""WITH {_MEMBERS}, r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY concept) AS i, count(*) OVER (PARTITION BY cluster_id) AS n, min(concept) OVER (PARTITION BY cluster_id) AS first FROM m)
SELECT cluster_id, CASE WHEN i <= 2 AND n >= 2 THEN trim(first) || '等' ELSE concept END AS merged, concept AS source FROM r"""
SQL["order_requests"] = "SELECT doc_id AS custom_id, count(*)::INT AS tuples FROM (SELECT DISTINCT doc_id, tuple_id, subject, relation, object, time FROM raw_tuples) GROUP BY doc_id"
SQL["checked_orders"] = """WITH t AS (SELECT DISTINCT doc_id, tuple_id FROM raw_tuples), l AS (SELECT doc_id, list(tuple_id ORDER BY tuple_id) AS ids FROM t GROUP BY doc_id),
o AS (SELECT doc_id, len(ids) % 3 AS n, CASE len(ids) % 3 WHEN 0 THEN list_reverse(ids) WHEN 1 THEN ids[1:len(ids) - 1] ELSE list_append(ids, ids[1]) END AS x FROM l)
SELECT doc_id AS custom_id, unnest(x) AS tuple_id, (generate_subscripts(x, 1) - 1)::INT AS position, n = 0 AS valid FROM o"""
_EVENT = _SX + ", e AS (SELECT doc_id AS custom_id, (sentence_index - 1)::INT AS event_id, sentence_index % 5 <> 0 AS valid, trim(text) AS text, sentence_index AS n FROM sx WHERE sentence_index % 3 = 1)"
SQL["checked_events"] = _EVENT + " SELECT custom_id, event_id, valid FROM e"
SQL["rendered_events"] = _EVENT + ", f AS (SELECT custom_id, text, min(event_id) AS i FROM e WHERE valid GROUP BY custom_id, text) SELECT custom_id, string_agg(text, chr(10) ORDER BY i) AS text FROM f GROUP BY custom_id"
SQL["event_coverage"] = _EVENT + """, c AS (SELECT custom_id, count(*) AS events, count(DISTINCT text) AS d, 2 * count(*) AS covered FROM e WHERE valid GROUP BY custom_id), n AS (SELECT doc_id AS custom_id, count(*) AS n FROM sx GROUP BY doc_id)
SELECT custom_id, coalesce(events, 0) AS events, coalesce(d, 0) AS distinct_events, round(coalesce(covered, 0) / n, 4) AS coverage FROM n LEFT JOIN c USING (custom_id)"""
SQL["checked_extractions"] = """WITH t AS (SELECT DISTINCT tuple_id, subject, relation, object, confidence FROM raw_tuples), c AS (SELECT *, coalesce(confidence + (length(tuple_id) % 7 = 0)::INT, 0.8) AS sure FROM t),
f AS (SELECT tuple_id, sure, CASE WHEN trim(coalesce(subject, '')) = '' THEN 'subject' WHEN trim(coalesce(relation, '')) = '' THEN 'relation' WHEN trim(coalesce(object, '')) = '' THEN 'object' WHEN sure < 0 OR sure > 1 THEN 'confidence' END AS fault FROM c)
SELECT tuple_id AS custom_id, round(sure, 6) AS confidence, fault IS NULL AS valid, fault FROM f"""
SQL["reply_words"] = """SELECT DISTINCT tuple_id, (['replace', 'replace', 'keep', 'keep', NULL, 'replace'])[length(subject) % 6 + 1] AS action, (['事件句', '事件句', '不抽取句', '混合句', '事件句', NULL])[length(subject) % 6 + 1] AS kind FROM raw_tuples WHERE subject IS NOT NULL"""
SQL["missing_results"] = _SX + "SELECT sent_id AS custom_id FROM sx WHERE sent_id NOT IN (SELECT source_sent_id FROM raw_tuples WHERE source_sent_id IS NOT NULL)"
_STORE = "v AS (SELECT DISTINCT record_id, type, raw_str AS concept, description FROM element_versions WHERE type IS NOT NULL AND raw_str IS NOT NULL AND description IS NOT NULL), p AS (SELECT type, concept, arg_max(description, record_id) AS description, arg_min(description, record_id) AS old FROM v GROUP BY type, concept)"
SQL["vectors_to_make"] = f"WITH {_STORE} SELECT type, concept, description FROM p WHERE description <> old"
SQL["vectors_that_hold"] = f"WITH {_STORE} SELECT type, concept, description FROM p WHERE description = old"
SQL["assembled_elements"] = "SELECT DISTINCT id, count, len(vector)::INT AS dimension FROM dedup_elements WHERE len(vector) = 96"
SQL["embedded_titles"] = "SELECT news_id AS id, 64 AS dimension, 1.0::DOUBLE AS length, NULL::VARCHAR AS error FROM raw_news"

_HALF = lambda a, b: f"list_transform(embedding[{a}:{b}]::DOUBLE[], lambda x: x / sqrt(list_inner_product(embedding[{a}:{b}]::DOUBLE[], embedding[{a}:{b}]::DOUBLE[])))"
SQL["weighted_sums"] = f"WITH h AS (SELECT vec_id AS id, list_transform(list_zip({_HALF(1, 32)}, {_HALF(33, 64)}), lambda p: 0.7 * p[1] + 0.3 * p[2]) AS s FROM embeddings) SELECT id, list_transform(s, lambda x: round(x / sqrt(list_inner_product(s, s)), 6)) AS vector FROM h"
_SIDE = lambda name, a, b: f"{name} AS (SELECT p.vec_id AS query_id, q.vec_id AS doc_id, round(list_cosine_similarity(p.embedding[{a}:{b}]::DOUBLE[], q.embedding[{a}:{b}]::DOUBLE[]), 9) AS s FROM embeddings p JOIN embeddings q ON p.vec_id % 100 = 0 AND p.vec_id <> q.vec_id)"
SQL["mixed_scores"] = f"""WITH {_SIDE('a', 1, 40)}, {_SIDE('b', 41, 64)}, j AS (SELECT a.query_id, a.doc_id, a.s AS v, CASE WHEN b.s > 0 THEN b.s ELSE 0 END AS l FROM a JOIN b USING (query_id, doc_id)),
e AS (SELECT *, min(v) OVER w AS v0, max(v) OVER w AS v1, min(l) OVER w AS l0, max(l) OVER w AS l1 FROM j WINDOW w AS (PARTITION BY query_id)),
m AS (SELECT query_id, doc_id, round(0.7 * CASE WHEN v1 > v0 THEN (v - v0) / (v1 - v0) WHEN v1 > 0 THEN 1 ELSE 0 END + 0.3 * CASE WHEN l1 > l0 THEN (l - l0) / (l1 - l0) WHEN l1 > 0 THEN 1 ELSE 0 END, 6) AS score FROM e)
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank FROM m QUALIFY rank <= 10"""
SQL["time_order"] = """WITH d AS (SELECT doc_id, max(date_diff('day', DATE '1970-01-01', try_strptime(normalized, '%Y-%m-%d')::DATE))::INT AS ord FROM time_candidates WHERE regexp_full_match(normalized, '[0-9]{4}-[0-9]{2}-[0-9]{2}') GROUP BY doc_id)
SELECT n.doc_id, d.ord::DOUBLE AS ord, row_number() OVER (ORDER BY d.ord NULLS LAST, n.doc_id) AS position FROM raw_news n LEFT JOIN d USING (doc_id)"""
_CELLS = ", ".join(f"{n} AS (SELECT m.tuple_id, coalesce(a.merged, x.value) AS value, min(x.i) AS i, count(*) FILTER (coalesce(a.merged, x.value) <> x.value) AS r FROM mm m, LATERAL (SELECT unnest({v}) AS value, generate_subscripts({v}, 1) AS i) x LEFT JOIN al a ON a.type = '{k}' AND a.source = x.value WHERE x.value IS NOT NULL GROUP BY 1, 2)" for n, k, v in (("ce", "entity", "m.subjects"), ("co", "entity", "m.objects"), ("cr", "relation", "[m.relation]"), ("cl", "location", "m.locations")))
_ONE = lambda n, c: f"(SELECT CASE WHEN count(*) > 1 THEN '[' || string_agg(to_json(value)::VARCHAR, ',' ORDER BY i) || ']' ELSE min(value) END FROM {n} WHERE {n}.tuple_id = mm.tuple_id) AS {c}"
SQL["described_mapping"] = f"""WITH v AS (SELECT DISTINCT ON (record_id) * FROM element_versions WHERE raw_str IS NOT NULL)
SELECT type, id AS merged, list(DISTINCT raw_str ORDER BY raw_str) AS sources, count(DISTINCT raw_str) AS n_sources, coalesce(list(DISTINCT origin ORDER BY origin) FILTER (origin IS NOT NULL), []) AS groups, coalesce(list(DISTINCT trust::VARCHAR ORDER BY trust::VARCHAR) FILTER (trust IS NOT NULL), []) AS clusters,
arg_min(description, record_id) FILTER (NOT {blank('description')}) AS description FROM v GROUP BY type, id"""
SQL["mapped_lists"] = MERGE + f""", al AS (SELECT e.type, e.raw_str AS source, max(k.canonical_str) AS merged FROM (SELECT DISTINCT type, raw_str, alias_key FROM dedup_elements) e JOIN ({CORE["alias_map"]}) g USING (type, alias_key) JOIN canonical k ON k.cid = g.cid GROUP BY ALL),
mm AS (SELECT * FROM m), {_CELLS},
re AS (SELECT tuple_id, sum(r)::BIGINT AS replaced FROM (SELECT * FROM ce UNION ALL SELECT * FROM co UNION ALL SELECT * FROM cr UNION ALL SELECT * FROM cl) GROUP BY tuple_id)
SELECT mm.tuple_id, {_ONE("ce", "subject")}, {_ONE("cr", "relation")}, {_ONE("co", "object")}, {_ONE("cl", "location")}, mm.time, coalesce(re.replaced, 0) AS replaced FROM mm LEFT JOIN re USING (tuple_id)"""

_N, _Y = "([0-9]{1,2})", "((?:19|20)[0-9]{2})"
_DASH = r"\s*[-—–~～至]\s*"
#: Title notations in order: name, pattern, groups of the end (year, month, day), confidence.
_FORMS = [
    ("title_same_year_day_range", rf"{_Y}[.年]{_N}[.月]{_N}{_DASH}{_N}[.月]{_N}(?:[^0-9]|$)", (1, 4, 5), 0.65),
    ("title_cross_year_range", rf"{_Y}(?:[.年]{_N}(?:[.月]{_N})?)?{_DASH}{_Y}(?:[.年]{_N}(?:[.月]{_N})?)?", (4, 5, 6), 0.58),
    ("title_same_year_day_range", rf"{_Y}[.年]{_N}[.月]{_N}{_DASH}{_N}(?:[^.0-9]|$)", (1, 2, 4), 0.65),
    ("title_same_year_month_range", rf"{_Y}[.年]{_N}{_DASH}{_N}(?:[.月]{_N})?(?:[^0-9]|$)", (1, 3, 4), 0.6),
    ("title_single_date", rf"{_Y}[.年]{_N}(?:[.月]{_N})?", (1, 2, 3), 0.62),
    ("title_year_only", rf"{_Y}(?:年|全年)?", (1, 0, 0), 0.5),
]


def _case(pick) -> str:
    return "CASE " + " ".join(f"WHEN f = {i} THEN {pick(x)}" for i, x in enumerate(_FORMS)) + " END"


def _group(i: int):
    return _case(lambda x: f"try_cast(nullif(regexp_extract(raw, '{x[1]}', {x[2][i]}), '') AS INT)" if x[2][i] else "NULL")


_TITLES = f"""tp AS ({CORE["title_parts"]}), nc AS ({CORE["news_codes"]}),
t0 AS (SELECT n.doc_id, n.news_id, tp.base, tp.raw_time AS raw, tp.malformed, coalesce(nc.prefix || lpad(nc.number::VARCHAR, 3, '0'), n.doc_id) AS node_id FROM raw_news n JOIN tp USING (news_id) JOIN nc USING (news_id)),
t1 AS (SELECT *, CASE WHEN raw IS NULL THEN NULL {" ".join(f"WHEN regexp_matches(raw, '{x[1]}') THEN {i}" for i, x in enumerate(_FORMS))} END AS f,
 coalesce(contains(raw, '多次'), false) AS repeated, coalesce(contains(raw, '持续') OR contains(raw, '至今') OR contains(raw, '年起'), false) AS open_ended,
 regexp_extract_all(regexp_replace(raw, '([0-9]+)', ' \\1 ', 'g'), ' ((?:19|20)[0-9]{{2}}) ', 1) AS years FROM t0),
t2 AS (SELECT *, {_group(0)} AS y, {_group(1)} AS m, {_group(2)} AS d, {_case(lambda x: x[3])} AS sure, {_case(lambda x: f"'{x[0]}'")} AS form FROM t1),
t3 AS (SELECT *, f IS NOT NULL AND NOT repeated AND NOT open_ended AS final, CASE WHEN m IS NULL THEN NULL ELSE d END AS dd FROM t2),
t4 AS (SELECT *, CASE WHEN final THEN lpad(y::VARCHAR, 4, '0') || coalesce('.' || lpad(m::VARCHAR, 2, '0'), '') || coalesce('.' || lpad(dd::VARCHAR, 2, '0'), '') END AS label,
 len(years) > 0 AND years[1] <> years[len(years)] AS many FROM t3)"""
SQL["title_timeline"] = f"""WITH {_TITLES} SELECT doc_id, node_id, base AS base_title, CASE WHEN label IS NOT NULL THEN base || '（' || label || '）' ELSE base END AS corrected_title, raw AS raw_title_time, label AS end_time,
CASE WHEN NOT final THEN NULL WHEN m IS NULL THEN 'year' WHEN dd IS NULL THEN 'month' ELSE 'day' END AS end_time_precision, CASE WHEN final THEN sure ELSE 0 END::DOUBLE AS confidence, CASE WHEN final THEN 'title_only' ELSE 'unknown' END AS temporal_status, true AS needs_review,
array_to_string(list_filter([CASE WHEN NOT final THEN 'unknown_time' END, CASE WHEN malformed THEN 'malformed_title_time' END, CASE WHEN open_ended THEN 'open_ended_title' END, CASE WHEN repeated THEN 'repeated_title' END, CASE WHEN final THEN 'low_confidence' END,
 CASE WHEN final THEN 'title_only_fallback' END, CASE WHEN many THEN 'multi_year_title_without_explicit_body_year' END], lambda x: x IS NOT NULL), ',') AS reasons FROM t4"""
SQL["title_forms"] = f"""WITH {_TITLES} SELECT doc_id, coalesce(form, 'none') AS title_form, array_to_string(list_filter([CASE WHEN repeated THEN 'repeated' END, CASE WHEN open_ended THEN 'open_ended' END], lambda x: x IS NOT NULL), ',') AS flags, coalesce(malformed, false) AS malformed,
CASE WHEN final THEN strftime(least(last_day(make_date(y, least(greatest(coalesce(m, 12), 1), 12), 1)), make_date(y, least(greatest(coalesce(m, 12), 1), 12), 1) + (CASE WHEN dd IS NULL THEN 31 ELSE greatest(dd, 1) END - 1)::INT), '%Y-%m-%d') END AS anchor FROM t4"""
SQL["title_summary"] = f"WITH {_TITLES} SELECT count(*) AS documents, count(*) AS needs_review, 0::BIGINT AS high_confidence, 0::BIGINT AS conflicts, count(*) FILTER (NOT final) AS unknown, count(*) FILTER (final) AS title_only, 0::BIGINT AS inferred, 0::BIGINT AS exact FROM t4"

# A sign before each year that no digit precedes stands for the condition on what is before it.
_P = {
    "body_explicit_range": rf"¦{_Y}年{_N}月{_N}[日号]?[^。]{{0,24}}?[至到](?:{_N}月)?{_N}[日号]",
    "body_explicit_dot": rf"¦{_Y}\.{_N}(?:\.{_N})?(?:[^0-9]|$)",
    "body_explicit_day": rf"¦{_Y}年{_N}月{_N}[日号]",
    "body_year_end": rf"¦{_Y}年底",
    "body_year_begin": rf"¦{_Y}年初",
    "body_explicit_month": rf"¦{_Y}年{_N}月",
    "body_explicit_year": rf"¦{_Y}年(?:[^月0-9¦]|$)",
}
_ANY = "|".join(p.replace("((?:19|20)", "(?:(?:19|20)").replace("([0-9]", "(?:[0-9]") for p in _P.values())
_SOURCE = "CASE " + " ".join(f"WHEN regexp_full_match(h, '{p}') THEN '{n}'" for n, p in _P.items()) + " END"
_NUM = lambda n, i: f"try_cast(nullif(regexp_extract(h, '{_P[n]}', {i}), '') AS INT)"
SQL["explicit_times"] = f"""
WITH l AS (SELECT doc_id, string_split(normalized_text, chr(10)) AS ls FROM raw_news WHERE normalized_text IS NOT NULL), n AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1)::INT AS line_number FROM l),
m AS (SELECT doc_id, line_number, unnest(regexp_extract_all(regexp_replace({strip('line')}, '(^|[^0-9])((?:19|20)[0-9]{{2}})', '\\1¦\\2', 'g'), '{_ANY}')) AS h FROM n),
s AS (SELECT *, {_SOURCE} AS source FROM m),
p AS (SELECT *, substr(h, 2, 4)::INT AS y, CASE source WHEN 'body_explicit_range' THEN coalesce({_NUM('body_explicit_range', 4)}, {_NUM('body_explicit_range', 2)}) WHEN 'body_explicit_dot' THEN {_NUM('body_explicit_dot', 2)} WHEN 'body_explicit_day' THEN {_NUM('body_explicit_day', 2)}
 WHEN 'body_explicit_month' THEN {_NUM('body_explicit_month', 2)} WHEN 'body_year_end' THEN 12 WHEN 'body_year_begin' THEN 1 END AS mo,
 CASE source WHEN 'body_explicit_range' THEN {_NUM('body_explicit_range', 5)} WHEN 'body_explicit_dot' THEN {_NUM('body_explicit_dot', 3)} WHEN 'body_explicit_day' THEN {_NUM('body_explicit_day', 3)} END AS d FROM s)
SELECT DISTINCT doc_id, line_number, source, lpad(y::VARCHAR, 4, '0') || coalesce('.' || lpad(mo::VARCHAR, 2, '0'), '') || coalesce('.' || lpad(d::VARCHAR, 2, '0'), '') AS normalized, CASE WHEN mo IS NULL THEN 'year' WHEN d IS NULL THEN 'month' ELSE 'day' END AS precision,
CASE source WHEN 'body_explicit_range' THEN 0.93 WHEN 'body_explicit_dot' THEN CASE WHEN d IS NULL THEN 0.84 ELSE 0.9 END WHEN 'body_explicit_day' THEN 0.95 WHEN 'body_year_end' THEN 0.82 WHEN 'body_year_begin' THEN 0.8 WHEN 'body_explicit_month' THEN 0.86 ELSE 0.75 END::DOUBLE AS confidence FROM p"""
SQL["final_times"] = """WITH c AS (SELECT doc_id, normalized, split_part(normalized, '-', 1)::INT AS y, coalesce(try_cast(nullif(split_part(normalized, '-', 2), '') AS INT), 0) AS m, coalesce(try_cast(nullif(split_part(normalized, '-', 3), '') AS INT), 0) AS d, coalesce(confidence, 0) AS s
 FROM time_candidates WHERE regexp_full_match(normalized, '[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?')) SELECT doc_id, normalized, s AS confidence FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY y DESC, m DESC, d DESC, s DESC) = 1"""
SQL["planned_run"] = _SX + "SELECT unnest(['sentences', 'counts']) AS stage, 'planned' AS dry, 'run' AS first, 'skipped' AS second, 'run' AS forced, (SELECT count(*) FROM sx) AS sentences"
_SLOTS = "o AS (SELECT source_sent_id AS source, ingested_at, unnest(['entity', 'entity', 'relation', 'location']) AS type, unnest([subject, object, relation, location]) AS concept FROM raw_tuples WHERE source_sent_id IS NOT NULL)"
SQL["streamed_pool"] = f"WITH {_SLOTS} SELECT type, concept, count(DISTINCT source) AS count, strftime(min(ingested_at), '%Y-%m-%d %H:%M:%S') AS first_seen FROM o WHERE NOT {blank('concept')} GROUP BY type, concept"
SQL["probe_run"] = f"WITH {_ENTRY}, p AS (SELECT payload, length(payload) % 2 = 0 AS there, count(*) AS n FROM e GROUP BY payload) SELECT sum(n)::BIGINT AS requests, count(*) AS payloads, count(*) FILTER (there) AS from_store, count(*) FILTER (NOT there) AS asked, 0::BIGINT AS errors, true AS timed FROM p"
SQL["field_requests"] = "SELECT type || '|' || canonical_str AS custom_id, CASE type WHEN 'entity' THEN '主体类别,核心角色' WHEN 'relation' THEN '关系类别,核心议题,战略作用' ELSE '空间类型,区位范围,议题作用' END AS fields FROM canonical WHERE type IN ('entity', 'relation', 'location')"
SQL["carried_years"] = """WITH c AS (SELECT DISTINCT cand_id, doc_id, line_number, matched_text FROM time_candidates WHERE doc_id IS NOT NULL), y AS (SELECT *, try_cast(nullif(regexp_extract(matched_text, '(?:19|20)[0-9]{2}'), '') AS INT) AS own FROM c)
SELECT cand_id, last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_number NULLS LAST, cand_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS year FROM y"""
SQL["named_labels"] = """WITH g AS (SELECT label, count(*) AS size, min(vec_id) AS head FROM embeddings GROUP BY label), r AS (SELECT *, row_number() OVER (ORDER BY size DESC, head) AS n FROM g)
SELECT e.vec_id AS id, 'c' || lpad(r.n::VARCHAR, 4, '0') AS cluster_id, r.size FROM embeddings e JOIN r USING (label)"""
SQL["label_balance"] = """WITH g AS (SELECT count(*) AS n FROM embeddings GROUP BY label), s AS (SELECT sum(CASE WHEN n > 60 THEN 8.0 * (n - 60) WHEN n = 1 THEN 2.5 WHEN n < 30 THEN 1.5 * (30 - n) ELSE 0.15 * abs(n - 40) END) AS each,
 count(*) AS clusters, max(n) AS largest, median(n) FILTER (n > 1) AS med, avg(n) FILTER (n > 1) AS mean FROM g)
SELECT clusters, largest, round(each::DOUBLE + CASE WHEN med IS NOT NULL THEN 0.45 * abs(med - 40) + 0.15 * abs(mean - 40) ELSE 160 END + CASE WHEN clusters = 1 AND largest > 60 THEN 10.0 * largest ELSE 0 END, 6) AS cost FROM s"""

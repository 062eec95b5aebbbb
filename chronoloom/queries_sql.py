"""SQL (DuckDB) for the core queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def squeeze(c: str) -> str:
    return strip(f"regexp_replace({c}, '{WS}+', ' ', 'g')")


def alias_key(c: str) -> str:
    return f"lower({strip(c)})"


def blank(c: str) -> str:
    return f"({c} IS NULL OR length({strip(c)}) = 0)"


def split_plain(c: str) -> str:
    marked = f"regexp_replace({squeeze(c)}, '([。！？!?；;]){WS}*', '\\1' || chr(10), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(10)), lambda x: {strip('x')}), lambda x: length(x) > 0)"


def sentences(c: str) -> str:
    return f"flatten(list_transform(string_split({c}, chr(10)), lambda l: {split_plain('l')}))"


SENTENCES = f"s AS (SELECT doc_id, {sentences('normalized_text')} AS s FROM raw_news WHERE normalized_text IS NOT NULL), si AS (SELECT doc_id, unnest(s) AS text, generate_subscripts(s, 1)::INT AS sentence_index FROM s), sx AS (SELECT doc_id, sentence_index, doc_id || '_s' || lpad(sentence_index::VARCHAR, 3, '0') AS sent_id, text FROM si)"
SQL["sentence_index"] = f"WITH {SENTENCES} SELECT * FROM sx"

RAW = strip("regexp_replace(regexp_replace(replace(regexp_replace(replace(text, chr(65279), ''), '\\r\\n?', chr(10), 'g'), chr(12288), ' '), '[\\t ]+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")
SQL["normalized_news"] = f"SELECT news_id, {RAW} AS text FROM raw_news"
RULES = [
    ("citation_bracket", rf"\[(?:注{WS}*)?[0-9０-９]+(?:{WS}*[-—–~～至]{WS}*[0-9０-９]+)?\]", "''"),
    ("empty_bracket", rf"[\[【]{WS}*[\]】]", "''"),
    ("leading_quote", '^[”＂"]+', "''"),
    ("space_before_mark", rf"{WS}+([，。！？；：,.!?])", "'\\1'"),
]
STEPS = f"c0 AS (SELECT news_id, {RAW} AS t FROM raw_news WHERE text IS NOT NULL)" + "".join(
    f", c{i + 1} AS (SELECT news_id, regexp_replace(t, '{p}', {r}, 'g') AS t FROM c{i})" for i, (_, p, r) in enumerate(RULES)
)
TIDY = f"array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: regexp_replace({strip('x')}, '[ \\t]{{2,}}', ' ', 'g')), lambda x: length(x) > 0), chr(10))"
SQL["cleaned_news"] = f"WITH {STEPS} SELECT n.news_id, {TIDY} AS text FROM raw_news n LEFT JOIN c4 ON c4.news_id = n.news_id"
SQL["cleanup_rule_stats"] = f"WITH {STEPS}, h AS (" + " UNION ALL ".join(f"SELECT '{n}' AS rule, len(regexp_extract_all(t, '{p}')) AS hits FROM c{i}" for i, (n, p, _) in enumerate(RULES)) + (
    f" UNION ALL SELECT 'blank_line', CASE WHEN t = '' THEN 0 ELSE len(list_filter(string_split(t, chr(10)), lambda x: length({strip('x')}) = 0)) - (t LIKE '%' || chr(10))::INT END FROM c4) "
    "SELECT rule, sum(hits)::BIGINT AS hits, count(*) FILTER (hits > 0) AS texts FROM h GROUP BY rule"
)
TOKENS = f"CASE WHEN {blank('normalized_text')} THEN 0 ELSE greatest(1, len(regexp_extract_all(normalized_text, '[一-鿿]')) + 2 * len(regexp_extract_all(normalized_text, '[A-Za-z0-9_]+')) + ceil(len(regexp_extract_all(normalized_text, '[，。！？；,.!?;:]')) / 2)) END::INT"
SQL["token_estimates"] = f"SELECT news_id, {TOKENS} AS tokens FROM raw_news"


def terms(c: str) -> str:
    return (
        f"flatten(list_transform(regexp_extract_all(lower({c}), '[一-鿿]+|[a-z0-9_]+'), lambda r: CASE WHEN regexp_matches(r, '^[一-鿿]') "
        "THEN list_concat(list_transform(range(1, length(r) + 1), lambda i: substr(r, i, 1)), list_transform(range(1, length(r)), lambda i: substr(r, i, 2))) ELSE [r] END))"
    )


SQL["lexical_terms"] = f"WITH t AS (SELECT doc_id, unnest({terms('normalized_text')}) AS term FROM raw_news) SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS texts FROM t GROUP BY term"
SQL["element_keys"] = f"SELECT DISTINCT id, substr(type, 1, 3) || '_' || substr(md5(raw_str), 1, 8) AS own_id, {alias_key('raw_str')} AS alias_key, {squeeze('raw_str')} AS surface FROM dedup_elements"
STEM = "regexp_replace(file_name, '(.)\\.[^.]*$', '\\1')"
CODE = "regexp_extract(file_name, '^([A-Za-z]+)(\\d{3})([^0-9]|$)', %d)"
SQL["news_codes"] = f"""
WITH a AS (SELECT news_id, {STEM} AS stem, nullif(upper({CODE % 1}), '') AS prefix, try_cast({CODE % 2} AS INT) AS number FROM raw_news),
b AS (SELECT *, trim(replace(replace(lower(regexp_extract(stem, '^[A-Za-z0-9+_-]+')), '+', '_plus_'), '-', '_'), '_') AS code FROM a)
SELECT news_id, prefix, number, CASE WHEN code = '' THEN 'doc' ELSE code END || '_' || substr(md5(stem), 1, 8) AS doc_id FROM b"""
SQL["scope_filter"] = f"""
WITH a AS (SELECT news_id, file_name, upper({CODE % 1}) AS p, try_cast({CODE % 2} AS INT) AS n FROM raw_news)
SELECT news_id, file_name FROM a WHERE (p = 'E' AND n BETWEEN 100 AND 400) OR (p = 'M' AND n BETWEEN 1 AND 300) OR (p = 'EC' AND n = 483)"""
SQL["title_parts"] = f"""
WITH a AS (SELECT news_id, {strip("regexp_replace(" + STEM + ", '[＜<][^＞>]*[＞>]$', '')")} AS t FROM raw_news), b AS (SELECT *, regexp_matches(t, '^.*?[（(][^（()）]*[)）]$') AS closed FROM a)
SELECT news_id, CASE WHEN closed THEN {strip("regexp_extract(t, '^(.*?)[（(]([^（()）]*)[)）]$', 1)")} ELSE t END AS base,
CASE WHEN closed THEN {strip("regexp_extract(t, '^(.*?)[（(]([^（()）]*)[)）]$', 2)")} END AS raw_time, NOT closed AND regexp_matches(t, '[（(][^）)]*$') AS malformed FROM b"""
SQL["news_manifest"] = f"SELECT doc_id, coalesce(len({sentences('normalized_text')}), 0)::INT AS sentences, coalesce(length(normalized_text), 0)::INT AS chars, {TOKENS} AS tokens FROM raw_news"
SQL["document_previews"] = f"""
WITH s AS (SELECT doc_id, normalized_text AS t, {sentences('normalized_text')} AS s FROM raw_news WHERE normalized_text IS NOT NULL)
SELECT doc_id, upper(regexp_extract(doc_id, '^[A-Za-z]+')) AS category, substr(array_to_string((CASE WHEN len(s) = 0 AND NOT {blank('t')} THEN [{squeeze('t')}] ELSE s END)[1:2], ' '), 1, 200) AS preview FROM s"""
Q = "[\"''“”‘’「」『』]"
SQL["repeated_sentences"] = f"""
WITH {SENTENCES}, k AS (SELECT regexp_replace(regexp_replace(regexp_replace({squeeze('text')}, '^{Q}+|{Q}+$', '', 'g'), '[。！？!?；;，,.：:]+$', ''), '{Q}+$', '') AS key FROM sx)
SELECT key, count(*) AS times FROM k GROUP BY key HAVING count(*) > 1"""
SQL["bm25_search"] = f"""
WITH d AS (SELECT news_id AS doc_id, unnest({terms('normalized_text')}) AS term FROM raw_news), tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
l AS (SELECT news_id AS doc_id, coalesce(len({terms('normalized_text')}), 0) AS len FROM raw_news), g AS (SELECT count(*) AS n, greatest(1, avg(len)) AS a FROM l),
q AS (SELECT query_id, term, count(*) AS times FROM (SELECT news_id AS query_id, unnest({terms(STEM)}) AS term FROM raw_news WHERE news_id % 100 = 0) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (SELECT query_id, doc_id, round(sum(times * ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * greatest(len, 1) / a))), 6) AS score
  FROM q JOIN df USING (term) JOIN tf USING (term) JOIN l USING (doc_id), g GROUP BY query_id, doc_id)
SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank FROM s QUALIFY rank <= 10"""

# --- tuples
T = "t AS (SELECT DISTINCT tuple_id, doc_id, sent_id, subject, relation, object, location, time, source_sent_id, confidence FROM raw_tuples)"
SENT = f"regexp_replace(CASE WHEN NOT {blank('source_sent_id')} THEN {strip('source_sent_id')} WHEN NOT {blank('sent_id')} THEN {strip('sent_id')} ELSE tuple_id END, '_t\\d+$', '')"
SQL["tuple_projection"] = "SELECT tuple_id, doc_id, tuple_id AS sent_id, subject, relation, object, location, time, source_sent_id, coalesce(confidence, 0.8) AS confidence FROM (SELECT DISTINCT * FROM raw_tuples)"
PER = f"per AS (SELECT doc_id, {SENT} AS sentence_id, count(DISTINCT tuple_id) AS tuple_count FROM raw_tuples GROUP BY ALL)"
SQL["sentence_tuple_counts"] = f"WITH {PER} SELECT *, row_number() OVER (ORDER BY tuple_count DESC, sentence_id) AS rank FROM per"
SQL["tuple_histogram"] = f"WITH {PER} SELECT tuple_count, count(*) AS sentence_count FROM per GROUP BY tuple_count"
SQL["tuple_global_stats"] = f"WITH {PER} SELECT sum(tuple_count)::BIGINT AS tuples, count(*) AS sentences, max(tuple_count) AS most, min(tuple_count) AS least, round(avg(tuple_count), 4) AS mean, median(tuple_count) AS median FROM per"
NOWS = f"regexp_replace(regexp_replace(time, '{WS}+', '', 'g'), '[—–－]', '-', 'g')"
POINT = f"""CASE WHEN regexp_full_match({NOWS}, '\\d{{4}}(年\\d{{1,2}}月\\d{{1,2}}[日号]?|[./-]\\d{{1,2}}[./-]\\d{{1,2}})')
 THEN substr({NOWS}, 1, 4) || '-' || lpad(regexp_extract({NOWS}, '^\\d{{4}}.(\\d{{1,2}})', 1), 2, '0') || '-' || lpad(regexp_extract({NOWS}, '^\\d{{4}}.\\d{{1,2}}.(\\d{{1,2}})', 1), 2, '0')
 WHEN regexp_full_match({NOWS}, '\\d{{4}}(年\\d{{1,2}}月?|[./-]\\d{{1,2}})') THEN substr({NOWS}, 1, 4) || '-' || lpad(regexp_extract({NOWS}, '^\\d{{4}}.(\\d{{1,2}})', 1), 2, '0')
 WHEN regexp_full_match({NOWS}, '\\d{{4}}年?') THEN substr({NOWS}, 1, 4)
 WHEN regexp_full_match({NOWS}, '\\d{{4}}年?初') THEN substr({NOWS}, 1, 4) || '-01' WHEN regexp_full_match({NOWS}, '\\d{{4}}年?[底末]') THEN substr({NOWS}, 1, 4) || '-12' END"""
# The notations of the test data: points, and spans of years.
NORMAL = f"coalesce({POINT}, CASE WHEN regexp_full_match({NOWS}, '\\d{{4}}年?-\\d{{4}}年?') THEN substr({NOWS}, 1, 4) || '/' || regexp_extract({NOWS}, '-(\\d{{4}})', 1) END)"
SIGNATURE = f"""CASE WHEN regexp_full_match({strip('time')}, '\\d{{4}}[年.\\-/]\\d{{1,2}}[月.\\-/]\\d{{1,2}}日?')
 THEN substr({strip('time')}, 1, 4) || '.' || lpad(regexp_extract({strip('time')}, '^\\d{{4}}.(\\d{{1,2}})', 1), 2, '0') || '.' || lpad(regexp_extract({strip('time')}, '^\\d{{4}}.\\d{{1,2}}.(\\d{{1,2}})', 1), 2, '0')
 WHEN regexp_full_match({strip('time')}, '\\d{{4}}[年.\\-/]\\d{{1,2}}月?') THEN substr({strip('time')}, 1, 4) || '.' || lpad(regexp_extract({strip('time')}, '^\\d{{4}}.(\\d{{1,2}})', 1), 2, '0')
 WHEN regexp_full_match({strip('time')}, '\\d{{4}}年?') THEN substr({strip('time')}, 1, 4) ELSE {strip('time')} END"""
SQL["tuple_point_times"] = f"SELECT DISTINCT tuple_id, {POINT} AS time FROM raw_tuples"
SQL["signature_times"] = f"SELECT DISTINCT tuple_id, {SIGNATURE} AS time FROM raw_tuples"
NORMALS = f"SELECT DISTINCT tuple_id, CASE WHEN time = '' THEN '' ELSE coalesce({NORMAL}, time) END AS time, coalesce(time = '' OR {NORMAL} IS NOT NULL, false) AS time_known FROM raw_tuples"
SQL["tuple_normal_times"] = NORMALS
SQL["unresolved_times"] = f"""
WITH u AS (SELECT DISTINCT tuple_id, time FROM raw_tuples WHERE NOT {blank('time')} AND {NORMAL} IS NULL), r AS (SELECT *, row_number() OVER (PARTITION BY time ORDER BY tuple_id) AS n FROM u)
SELECT time, count(*) AS tuples, list(tuple_id ORDER BY tuple_id) FILTER (n <= 5) AS sample_ids FROM r GROUP BY time"""
NUM = "coalesce(try_cast(regexp_extract(tuple_id, '^.*_{0}(\\d+)', 1) AS INT), 0)"
PLACE = f"{NUM.format('s')} AS ps, {NUM.format('t')} AS pt"
JUDGED_ROWS = f"""c AS (SELECT tuple_id, doc_id, sent_id, subject, relation, object, location, time, source_sent_id, confidence, count(*) AS copies, {SIGNATURE} AS st, {PLACE} FROM raw_tuples GROUP BY ALL),
jr AS (SELECT *, row_number() OVER (PARTITION BY doc_id, subject, relation, object, location, st ORDER BY ps, pt, tuple_id) > 1
 AND (ps, pt, tuple_id) <> first_value((ps, pt, tuple_id)) OVER (PARTITION BY doc_id, subject, relation, object, location, st ORDER BY ps, pt, tuple_id) AS dup,
 coalesce(subject = object, false) AS same, NOT {blank('time')} AND {NORMAL} IS NULL AS lost FROM c)"""
REASONS = f"WITH {JUDGED_ROWS} "
SQL["tuple_delete_reasons"] = REASONS + """
SELECT tuple_id, copies, array_to_string(list_filter([CASE WHEN dup THEN 'duplicate_in_doc' END, CASE WHEN same THEN 'subject_equals_object' END, CASE WHEN lost THEN 'unreliable_time_anchor' END], lambda x: x IS NOT NULL), ',') AS reasons
FROM jr WHERE dup OR same OR lost OR copies > 1"""
SQL["cleaned_tuples"] = REASONS + "SELECT tuple_id, doc_id, sent_id, subject, relation, object, location, time, source_sent_id, confidence FROM jr WHERE NOT (dup OR same OR lost)"
SQL["story_order"] = f"""
WITH {T}, n AS (SELECT tuple_id, doc_id, CASE WHEN time = '' THEN '' ELSE coalesce({NORMAL}, time) END AS time, {PLACE} FROM t),
a AS (SELECT *, regexp_extract(string_split({strip('time')}, '/')[1], '^(\\d{{4}})(-\\d{{1,2}})?(-\\d{{1,2}})?$', ['y', 'm', 'd']) AS g FROM n),
b AS (SELECT tuple_id, doc_id, time, ps, pt, try_cast(g.y AS INT) AS y, try_cast(ltrim(g.m, '-') AS INT) AS m, try_cast(ltrim(g.d, '-') AS INT) AS d FROM a),
c AS (SELECT *, y IS NOT NULL AND max(coalesce((y IS NOT NULL AND m IS NULL)::INT, 0)) OVER (PARTITION BY doc_id, y) = 1 AS cy, m IS NOT NULL AND max((m IS NOT NULL AND d IS NULL)::INT) OVER (PARTITION BY doc_id, y, m) = 1 AS cm FROM b)
SELECT tuple_id, doc_id, time, row_number() OVER (PARTITION BY doc_id ORDER BY y IS NULL, coalesce(y, 0), CASE WHEN cy THEN 0 ELSE coalesce(m, 0) END, CASE WHEN cy OR cm THEN 0 ELSE coalesce(d, 0) END, ps, pt, tuple_id) AS position FROM c"""
MERGING = f"""r AS (SELECT *, {SENT} AS sentence_id, {PLACE} FROM t),
k AS (SELECT tuple_id AS u, struct_pack(s := sentence_id, r := relation, t := time, e := 1, v := subject)::VARCHAR AS v FROM r WHERE NOT {blank('subject')}
  UNION ALL SELECT tuple_id, struct_pack(s := sentence_id, r := relation, t := time, e := 2, v := object)::VARCHAR FROM r WHERE NOT {blank('object')}),
near AS (SELECT DISTINCT a.u AS a, b.u AS b FROM k a JOIN k b ON a.v = b.v),
walk(n, root) USING KEY (n) AS (SELECT tuple_id, tuple_id FROM r UNION
  SELECT e.b, min(w.root) FROM walk w JOIN near e ON e.a = w.n JOIN recurring.walk o ON o.n = e.b WHERE w.root < o.root GROUP BY e.b),
g AS (SELECT r.*, w.root FROM r JOIN walk w ON w.n = r.tuple_id),
vals AS (SELECT root, 's' AS kind, subject AS v, min((ps, pt, tuple_id)) AS p FROM g WHERE NOT {blank('subject')} GROUP BY ALL UNION ALL SELECT root, 'o', object, min((ps, pt, tuple_id)) FROM g WHERE NOT {blank('object')} GROUP BY ALL
  UNION ALL SELECT root, 'l', location, min((ps, pt, tuple_id)) FROM g WHERE location IS NOT NULL GROUP BY ALL),
lists AS (SELECT root, coalesce(list(v ORDER BY p) FILTER (kind = 's'), []) AS subjects, coalesce(list(v ORDER BY p) FILTER (kind = 'o'), []) AS objects, coalesce(list(v ORDER BY p) FILTER (kind = 'l'), []) AS locations FROM vals GROUP BY root),
m AS (SELECT arg_min(tuple_id, (ps, pt, tuple_id)) AS tuple_id, min(doc_id) AS doc_id, min(sentence_id) AS sentence_id, min(relation) AS relation, min(time) AS time, coalesce(any_value(subjects), []) AS subjects, coalesce(any_value(objects), []) AS objects, coalesce(any_value(locations), []) AS locations, count(*) AS members
  FROM g LEFT JOIN lists USING (root) GROUP BY root)"""
MERGE = f"WITH RECURSIVE {T}, {MERGING} "
SQL["merged_sentence_tuples"] = MERGE + "SELECT * FROM m"
DOCUMENTS = f""", q AS (SELECT *, {PLACE} FROM m),
lo AS (SELECT doc_id, subjects, relation, objects, time, l, min((ps, pt, tuple_id, i)) AS p FROM (SELECT *, unnest(locations) AS l, generate_subscripts(locations, 1) AS i FROM q) GROUP BY ALL),
lx AS (SELECT doc_id, subjects, relation, objects, time, list(l ORDER BY p) AS locations FROM lo GROUP BY ALL),
d AS (SELECT doc_id, subjects, relation, objects, time, arg_min(tuple_id, (ps, pt, tuple_id)) AS tuple_id, arg_min(sentence_id, (ps, pt, tuple_id)) AS sentence_id, sum(members)::BIGINT AS members, count(*) AS copies FROM q GROUP BY ALL),
x AS (SELECT d.*, coalesce(lx.locations, []) AS locations FROM d LEFT JOIN lx ON lx.doc_id = d.doc_id AND lx.subjects = d.subjects AND lx.relation = d.relation AND lx.objects = d.objects AND lx.time IS NOT DISTINCT FROM d.time)"""
ACROSS = MERGE + DOCUMENTS
FINE = f"t AS (SELECT tuple_id, doc_id, sent_id, subject, relation, object, location, CASE WHEN time = '' THEN '' ELSE coalesce({NORMAL}, time) END AS time, source_sent_id, confidence FROM jr WHERE NOT (dup OR same OR lost))"
SQL["tuple_chain"] = f"WITH RECURSIVE {JUDGED_ROWS}, {FINE}, {MERGING} " + DOCUMENTS + " SELECT * FROM x"
SQL["merged_document_tuples"] = ACROSS + "SELECT * FROM x"
SQL["merged_export_stats"] = ACROSS + """
SELECT (SELECT count(*) FROM t) AS tuples, (SELECT count(*) FROM m) AS sentence_tuples, (SELECT count(*) FROM m WHERE members > 1) AS merged_groups, (SELECT sum(members - 1)::BIGINT FROM m) AS merged_away,
(SELECT count(*) FROM x) AS document_tuples, (SELECT sum(copies - 1)::BIGINT FROM x) AS duplicates, (SELECT count(*) FROM x WHERE len(subjects) > 1) AS subject_lists, (SELECT count(*) FROM x WHERE len(objects) > 1) AS object_lists, (SELECT count(*) FROM x WHERE len(locations) > 1) AS location_lists"""
SQL["expanded_tuples"] = MERGE + """, a AS (SELECT tuple_id, relation, time, objects, unnest(CASE WHEN len(subjects) = 0 THEN [NULL] ELSE subjects END) AS subject, unnest(range(greatest(len(subjects), 1))) AS i FROM m)
SELECT tuple_id, (i * greatest(len(objects), 1) + j + 1)::INT AS part, subject, relation, object, time FROM (SELECT *, unnest(CASE WHEN len(objects) = 0 THEN [NULL] ELSE objects END) AS object, unnest(range(greatest(len(objects), 1))) AS j FROM a)"""
SQL["extraction_manifest"] = f"""
WITH {SENTENCES}, p AS (SELECT source_sent_id AS sent_id, count(DISTINCT tuple_id) AS n FROM raw_tuples GROUP BY ALL)
SELECT doc_id, count(*) AS requested, count(n) AS completed, coalesce(sum(n), 0)::BIGINT AS tuples FROM sx LEFT JOIN p USING (sent_id) GROUP BY doc_id"""
SQL["sentences_without_tuples"] = f"WITH {SENTENCES} SELECT doc_id, sent_id FROM sx WHERE sent_id NOT IN (SELECT source_sent_id FROM raw_tuples WHERE source_sent_id IS NOT NULL)"

SQL["pruned_payloads"] = REASONS + """, g AS (SELECT tuple_id FROM jr WHERE dup OR same OR lost), a AS (SELECT DISTINCT source_sent_id, tuple_id, subject, time FROM raw_tuples WHERE source_sent_id IS NOT NULL)
SELECT source_sent_id, coalesce(string_agg(tuple_id, ',' ORDER BY tuple_id) FILTER (tuple_id NOT IN (SELECT tuple_id FROM g)), '') AS tuple_ids FROM a GROUP BY source_sent_id"""
SQL["retimed_payloads"] = f"SELECT DISTINCT tuple_id, CASE WHEN time = '' THEN '' ELSE coalesce({NORMAL}, time) END AS time FROM raw_tuples WHERE source_sent_id IS NOT NULL"

# --- concepts
OCC = f"""o AS (SELECT DISTINCT tuple_id, doc_id, source_sent_id AS source, ingested_at, unnest(['subject', 'object', 'relation', 'location']) AS slot, unnest(['entity', 'entity', 'relation', 'location']) AS type, unnest([0, 1, 2, 3]) AS n, unnest([subject, object, relation, location]) AS concept FROM raw_tuples),
oc AS (SELECT * FROM o WHERE NOT {blank('concept')})"""
SQL["concept_pool"] = f"""
WITH {OCC}, s AS (SELECT type, concept, source, min((ingested_at, tuple_id, n)) AS p FROM oc WHERE source IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY type, concept ORDER BY p, source) AS k FROM s)
SELECT type, concept, count(*) AS "count", list(source ORDER BY k) FILTER (k <= 5) AS contexts FROM r GROUP BY type, concept"""
SQL["pool_upsert"] = f"""
WITH v AS (SELECT DISTINCT * FROM element_versions), k AS (SELECT * FROM v WHERE NOT {blank('raw_str')})
SELECT type, raw_str AS concept, arg_max(CASE WHEN {blank('description')} THEN raw_str ELSE description END, record_id) AS description, list_sort(list(DISTINCT origin)) AS contexts, max(record_id) AS seq FROM k GROUP BY type, raw_str"""
SQL["latest_versions"] = "SELECT id, record_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM (SELECT DISTINCT id, record_id, updated_at FROM element_versions WHERE updated_at IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, record_id) = 1"
VAGUE = "('是', '有', '该机构', '该地区', '上述水域', '附近', '多名专家', '有关部门', '双方', '当地', 'they', 'there', 'does', 'it', 'he', 'she', 'this', 'that')"
JUDGED = f"j AS (SELECT DISTINCT type, raw_str AS concept, NOT {blank('raw_str')} AND {alias_key('raw_str')} NOT IN {VAGUE} AND length({alias_key('raw_str')}) > 1 AS compliant FROM dedup_elements)"
SQL["compliance_split"] = f"WITH {JUDGED} SELECT * FROM j"
INVALID = f"WITH {OCC}, {JUDGED}, i AS (SELECT tuple_id, slot, type, concept FROM oc SEMI JOIN (SELECT * FROM j WHERE NOT compliant) USING (type, concept))"
SQL["invalid_references"] = INVALID + "SELECT * FROM i"
SQL["compliance_counts"] = INVALID + "SELECT type, count(*) AS concepts, count(*) FILTER (compliant) AS compliant, count(*) FILTER (NOT compliant) AS invalid, coalesce((SELECT count(*) FROM i WHERE i.type = j.type), 0) AS invalid_references FROM j GROUP BY type"
SQL["grouped_mapping"] = "WITH m AS (SELECT DISTINCT type, canonical_str AS merged, unnest(list_append(coalesce(aliases, []), canonical_str)) AS source FROM canonical) SELECT type, merged, list(source ORDER BY source) AS sources, count(*) AS n_sources FROM m GROUP BY type, merged"
ALIASES = f"n AS (SELECT type, cid, unnest(list_append(coalesce(aliases, []), canonical_str)) AS name FROM canonical), am AS (SELECT type, {alias_key('name')} AS alias_key, min(cid) AS cid FROM n GROUP BY ALL)"
SQL["alias_map"] = f"WITH {ALIASES} SELECT * FROM am"
MAPPED = f"""
WITH {ALIASES}, mp AS (SELECT e.type, e.raw_str AS source, max(c.canonical_str) AS merged FROM (SELECT DISTINCT type, raw_str, alias_key FROM dedup_elements) e JOIN am USING (type, alias_key) JOIN canonical c ON c.cid = am.cid GROUP BY ALL),
t AS (SELECT DISTINCT tuple_id, doc_id, subject, relation, object, location, time FROM raw_tuples),
x AS (SELECT tuple_id, doc_id, coalesce(a.merged, subject) AS subject, coalesce(b.merged, object) AS object, coalesce(c.merged, relation) AS relation, coalesce(d.merged, location) AS location, time,
 (coalesce(a.merged <> subject, false)::INT + coalesce(b.merged <> object, false)::INT + coalesce(c.merged <> relation, false)::INT + coalesce(d.merged <> location, false)::INT) AS replaced
 FROM t LEFT JOIN mp a ON a.type = 'entity' AND a.source = subject LEFT JOIN mp b ON b.type = 'entity' AND b.source = object LEFT JOIN mp c ON c.type = 'relation' AND c.source = relation LEFT JOIN mp d ON d.type = 'location' AND d.source = location)"""
SQL["mapped_tuples"] = MAPPED + "SELECT * FROM x"
SQL["mapping_report"] = MAPPED + ", o AS (SELECT doc_id, subject, relation, object, location, time, count(*) AS n, sum(replaced) AS replaced FROM x GROUP BY ALL) SELECT doc_id, sum(n)::BIGINT AS before, count(*) AS after, sum(replaced)::BIGINT AS replaced, (sum(n) - count(*))::BIGINT AS duplicates FROM o GROUP BY doc_id"
MISSED = f"""
WITH {ALIASES}, e AS (SELECT DISTINCT tuple_id, ingested_at, unnest(['entity', 'entity', 'relation', 'location']) AS type, unnest([0, 1, 2, 3]) AS n, unnest([subject, object, relation, location]) AS raw_str FROM raw_tuples),
k AS (SELECT type, {alias_key('raw_str')} AS alias_key, arg_min(tuple_id, (ingested_at, tuple_id, n)) AS raw_id, arg_min(raw_str, (ingested_at, tuple_id, n)) AS raw_str FROM e WHERE raw_str IS NOT NULL GROUP BY ALL),
mi AS (SELECT raw_id, type AS element_type, raw_str, alias_key, substr(type, 1, 3) || '_' || substr(md5(raw_str), 1, 8) AS fallback_cid FROM k ANTI JOIN am USING (type, alias_key))"""
SQL["unresolved_report"] = MISSED + "SELECT * FROM mi"
KEYED = {s: alias_key(s) for s in ("subject", "relation", "object", "location")}
SQL["canonical_tuples"] = MISSED + f""", w AS (SELECT * FROM am UNION ALL SELECT element_type, alias_key, fallback_cid FROM mi),
t AS (SELECT DISTINCT tuple_id, doc_id, subject, object, relation, location, time, source_sent_id, confidence FROM raw_tuples)
SELECT tuple_id AS raw_id, doc_id, a.cid AS subject_cid, c.cid AS relation_cid, b.cid AS object_cid, d.cid AS location_cid, time, source_sent_id, confidence FROM t
LEFT JOIN w a ON a.type = 'entity' AND a.alias_key = {KEYED['subject']} LEFT JOIN w b ON b.type = 'entity' AND b.alias_key = {KEYED['object']}
LEFT JOIN w c ON c.type = 'relation' AND c.alias_key = {KEYED['relation']} LEFT JOIN w d ON d.type = 'location' AND d.alias_key = {KEYED['location']}"""
SQL["merged_entries"] = MISSED + """, a AS (SELECT type, cid, canonical_str, description, coalesce(aliases, []) AS aliases, 0 AS seq FROM canonical UNION ALL SELECT element_type, fallback_cid, raw_str, NULL, [alias_key], 1 FROM mi)
SELECT type, cid, arg_min(canonical_str, seq) AS canonical_str, arg_min(description, seq) FILTER (description IS NOT NULL) AS description, list_sort(list_distinct(flatten(list(aliases)))) AS aliases FROM a GROUP BY type, cid"""
SQL["schema_figures"] = "SELECT type, count(*) AS entries, sum(len(coalesce(aliases, [])))::BIGINT AS aliases, CASE WHEN sum(len(coalesce(aliases, []))) > 0 THEN round(1 - count(*) / sum(len(coalesce(aliases, []))), 6) ELSE 0 END AS dedup_ratio FROM canonical GROUP BY type"

# --- vectors
V = "v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM embeddings), u AS (SELECT id, label, CASE WHEN n > 0 THEN list_transform(e, lambda x: x / n) ELSE e END AS u FROM v)"
SQL["vector_units"] = f"WITH {V} SELECT id, list_transform(u, lambda x: round(x, 6)) AS unit FROM u"
SCORES = f"WITH {V}, s AS (SELECT a.id AS query, b.id AS id, round(list_inner_product(a.u, b.u), 9) AS score FROM u a JOIN u b ON a.id % 100 = 0 AND a.id <> b.id)"
SQL["vector_search"] = SCORES + " SELECT query, id, round(score, 6) AS score, row_number() OVER (PARTITION BY query ORDER BY score DESC, id)::INT AS rank FROM s QUALIFY rank <= 5"
FIGURES = "count(*) AS pairs, round(min(score), 6) AS least, round(avg(score), 6) AS mean, round(max(score), 6) AS most, " + ", ".join(f"round(quantile_cont(score, {q}), 6) AS {n}" for q, n in ((0.5, "p50"), (0.75, "p75"), (0.9, "p90"), (0.95, "p95"), (0.99, "p99")))
SQL["similarity_distribution"] = SCORES + f" SELECT {FIGURES} FROM s"
SQL["nearest_distribution"] = SCORES + f" SELECT {FIGURES} FROM (SELECT query, max(score) AS score FROM s GROUP BY query)"
SQL["mutual_neighbours"] = f"""
WITH {V}, s AS (SELECT a.id AS id, b.id AS near, round(list_inner_product(a.u, b.u), 9) AS score FROM u a JOIN u b ON a.label = b.label AND a.id <> b.id),
k AS (SELECT * FROM s WHERE score >= 0.05 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, near) <= 5)
SELECT a.id AS source, a.near AS target, round(a.score, 6) AS weight FROM k a JOIN k b ON a.id = b.near AND a.near = b.id WHERE a.id < a.near AND a.score > 0"""
SQL["label_figures"] = f"""
WITH {V}, s AS (SELECT a.label, list_inner_product(a.u, b.u) AS x FROM u a JOIN u b ON a.label = b.label AND a.id < b.id), n AS (SELECT label, count(*) AS size FROM u GROUP BY label)
SELECT n.label, n.size, round(coalesce(avg(x), 1), 6) AS avg_similarity, round(coalesce(min(x), 1), 6) AS min_similarity, round(coalesce(max(x), 1), 6) AS max_similarity FROM n LEFT JOIN s USING (label) GROUP BY n.label, n.size"""
SQL["label_medoids"] = f"""
WITH {V}, s AS (SELECT a.label, a.id, round(avg(list_inner_product(a.u, b.u)), 6) AS m FROM u a JOIN u b ON a.label = b.label AND a.id <> b.id GROUP BY ALL),
r AS (SELECT u.label, u.id, coalesce(s.m, 1) AS mean_similarity FROM u LEFT JOIN s USING (id)) SELECT label, id, mean_similarity FROM r QUALIFY row_number() OVER (PARTITION BY label ORDER BY mean_similarity DESC, id) = 1"""
SQL["weighted_field_search"] = """
WITH v AS (SELECT vec_id AS id, embedding[1:20]::DOUBLE[] AS a, embedding[21:40]::DOUBLE[] AS b, embedding[41:64]::DOUBLE[] AS c FROM embeddings),
s AS (SELECT x.id AS query, y.id AS id, round(0.4 * list_cosine_similarity(x.a, y.a) + 0.4 * list_cosine_similarity(x.b, y.b) + 0.2 * list_cosine_similarity(x.c, y.c), 9) AS score FROM v x JOIN v y ON x.id % 100 = 0 AND x.id <> y.id)
SELECT query, id, round(score, 6) AS score, row_number() OVER (PARTITION BY query ORDER BY score DESC, id)::INT AS rank FROM s QUALIFY rank <= 5"""
SQL["link_candidates"] = f"""
WITH {V}, s AS (SELECT a.id AS ask_id, b.label::VARCHAR AS cid, max(round(list_inner_product(a.u, b.u), 9)) AS score FROM u a JOIN u b ON a.id % 100 = 0 GROUP BY ALL)
SELECT ask_id, cid, round(score, 6) AS score, row_number() OVER (PARTITION BY ask_id ORDER BY score DESC, cid)::INT AS rank FROM s QUALIFY rank <= 3"""
SQL["document_edges"] = """
WITH q AS (SELECT vec_id AS id, unnest([1, 2, 3, 4]) AS k, unnest([embedding[1:16]::DOUBLE[], embedding[17:32]::DOUBLE[], embedding[33:48]::DOUBLE[], embedding[49:64]::DOUBLE[]]) AS e FROM embeddings),
n AS (SELECT id, k, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS u FROM q), d AS (SELECT vec_id AS id, (vec_id * 37) % 400 AS o FROM embeddings),
s AS (SELECT a.id AS target, b.id AS source, a.k, avg(list_inner_product(a.u, b.u)) AS m FROM n a JOIN n b ON a.id % 100 = 0 AND a.id <> b.id GROUP BY ALL), w AS (SELECT source, target, max(m) AS w FROM s GROUP BY ALL)
SELECT source, target, round(w, 6) AS weight FROM w JOIN d x ON x.id = source JOIN d y ON y.id = target WHERE x.o <= y.o AND w >= 0.2"""
MATCHES = f"m AS (SELECT DISTINCT element_type || '|' || {alias_key('left_key')} AS source, element_type || '|' || {alias_key('right_key')} AS target, coalesce(score, 0.0) AS weight FROM dedup_matches WHERE element_type IS NOT NULL AND NOT {blank('left_key')} AND NOT {blank('right_key')}), e AS (SELECT * FROM m WHERE weight >= 0.6), y AS (SELECT source AS u, target AS v FROM e UNION SELECT target, source FROM e)"
HOPS = f"WITH {MATCHES}, h0 AS (SELECT min(source) AS node FROM e), h1 AS (SELECT DISTINCT v AS node FROM y JOIN h0 ON u = node WHERE v NOT IN (SELECT node FROM h0)), h2 AS (SELECT DISTINCT v AS node FROM y JOIN h1 ON u = node WHERE v NOT IN (SELECT node FROM h0 UNION SELECT node FROM h1)), h AS (SELECT node, 0 AS hop FROM h0 UNION ALL SELECT node, 1 FROM h1 UNION ALL SELECT node, 2 FROM h2)"
SQL["match_neighbourhood"] = HOPS + " SELECT * FROM h"
SQL["neighbourhood_edges"] = HOPS + " SELECT * FROM e WHERE source IN (SELECT node FROM h) AND target IN (SELECT node FROM h)"

_KEYED = "e AS (SELECT DISTINCT type, id, raw_str, alias_key, description FROM dedup_elements WHERE len(vector) = 96), k AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY type, alias_key ORDER BY id) = 1)"
SQL["same_key_entries"] = f"WITH {_KEYED} SELECT type, id AS cid, raw_str AS canonical_str, description, [alias_key] AS aliases FROM k"
SQL["same_key_aliases"] = f"WITH {_KEYED} SELECT type, alias_key, id AS cid FROM k"

_VERBS = "宣布|启动|暂停|取消|恢复|批准|反对|审议|延长|加强|促成|谴责|要求解释|拒绝评论|公开回应|扩大规模|重新评估|正式确认|提前启动|低调结束|一度中断"
SQL["extracted_tuples"] = f"""WITH {SENTENCES}, v AS (SELECT sent_id, text, regexp_extract(text, '{_VERBS}') AS verb FROM sx), p AS (SELECT *, strpos(text, verb) AS pos FROM v WHERE verb <> ''),
x AS (SELECT sent_id, {strip("regexp_extract(substr(text, 1, pos - 1), '[^，,。：:、；;]*$')")} AS subject, verb AS relation, {strip("regexp_extract(substr(text, pos + length(verb)), '^[^，,。！？；;]*')")} AS object FROM p)
SELECT * FROM x WHERE subject <> '' AND object <> ''"""
_COST = TOKENS.replace("normalized_text", "text")
_AT = lambda k: f"lag(text, {k}) OVER w AS t_{k}, lag(c, {k}) OVER w AS c_{k}, lead(text, {k}) OVER w AS t{k}, lead(c, {k}) OVER w AS c{k}"
SQL["context_windows"] = f"""WITH {SENTENCES}, k AS (SELECT *, {_COST} AS c FROM sx), a AS (SELECT *, sum(c) OVER (PARTITION BY doc_id) AS total, {_AT(1)}, {_AT(2)} FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY sentence_index)),
s1 AS (SELECT *, c_1 IS NOT NULL AND c_1 + c <= 120 AS l1 FROM a), s2 AS (SELECT *, c1 IS NOT NULL AND (CASE WHEN l1 THEN c_1 ELSE 0 END) + c + c1 <= 120 AS r1 FROM s1),
s3 AS (SELECT *, c_2 IS NOT NULL AND c_2 + c_1 + c + (CASE WHEN r1 THEN c1 ELSE 0 END) <= 120 AS l2 FROM s2),
s4 AS (SELECT *, c2 IS NOT NULL AND (CASE WHEN l2 THEN c_2 + c_1 WHEN l1 THEN c_1 ELSE 0 END) + c + c1 + c2 <= 120 AS r2 FROM s3),
f AS (SELECT doc_id, string_agg(text, chr(10) ORDER BY sentence_index) AS whole FROM sx GROUP BY doc_id)
SELECT doc_id, sentence_index, CASE WHEN total <= 120 THEN whole ELSE array_to_string(list_filter([CASE WHEN l2 THEN t_2 END, CASE WHEN l1 OR l2 THEN t_1 END, text, CASE WHEN r1 OR r2 THEN t1 END, CASE WHEN r2 THEN t2 END], lambda x: x IS NOT NULL), chr(10)) END AS context,
total <= 120 AS whole_document_fits FROM s4 JOIN f USING (doc_id)"""

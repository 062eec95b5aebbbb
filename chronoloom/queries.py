"""Registry of the core queries and of their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.functions import text as X
from chronoloom.functions import times as TM
from chronoloom.functions.vectors import unit, weighted_fields
from chronoloom.operators import canonical as CA
from chronoloom.operators import clustering as CL
from chronoloom.operators import concepts as CO
from chronoloom.operators import docgraph as DG
from chronoloom.operators import graph as GR
from chronoloom.operators import lexical as LX
from chronoloom.operators import payloads as PA
from chronoloom.operators import similarity as SI
from chronoloom.operators import timeline as TL
from chronoloom.operators import tuples as TU
from chronoloom.operators.timestamps import normalize_times
from chronoloom.plans import providers as PR
from chronoloom.plans.scope import in_scope
from chronoloom.plans.stages import remaining
from chronoloom.queries_sql import SQL
from chronoloom.sources.tables import Scratch, table

__all__ = ["QUERIES", "SQL"]
QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _news(spark, folder):
    return table(spark, folder, "raw_news")


def _tuples(spark, folder):
    return table(spark, folder, "raw_tuples")


# --- time candidates -------------------------------------------------------------------------------------------------


@query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_normalized(spark, folder).select("cand_id", "normalized")


@query
def p2_normalized(spark: SparkSession, folder: str) -> DataFrame:
    """With the precision of each value."""
    return normalize_times(table(spark, folder, "time_candidates", "cand_id", "matched_text", "zone", "lang", "ref_date"))


# --- texts -----------------------------------------------------------------------------------------------------------


@query
def sentence_index(spark, folder):
    """Plain sentences of every news text, numbered from 1."""
    rows = _news(spark, folder).select("doc_id", F.posexplode(X.news_sentences(F.col("normalized_text"))).alias("n", "text"))
    n = F.col("n") + 1
    return rows.select("doc_id", n.cast("int").alias("sentence_index"), F.format_string("%s_s%03d", "doc_id", n).alias("sent_id"), "text")


@query
def normalized_news(spark, folder):
    return _news(spark, folder).select("news_id", X.normalize_raw_news(F.col("text")).alias("text"))


@query
def cleaned_news(spark, folder):
    return _news(spark, folder).select("news_id", X.clean_news(F.col("text")).alias("text"))


@query
def cleanup_rule_stats(spark, folder):
    """Hits of every character rule, and the texts that it hits."""
    rows = _news(spark, folder).where("text is not null").select(F.explode(X.character_hits(X.normalize_raw_news(F.col("text")))).alias("rule", "hits"))
    return rows.groupBy("rule").agg(F.sum("hits").cast("long").alias("hits"), F.count_if(F.col("hits") > 0).alias("texts"))


@query
def token_estimates(spark, folder):
    return _news(spark, folder).select("news_id", X.token_estimate(F.col("normalized_text")).alias("tokens"))


@query
def lexical_terms(spark, folder):
    """Every term with its occurrences and the texts it is in."""
    tf = LX.term_frequencies(_news(spark, folder).select("doc_id", F.col("normalized_text").alias("text")))
    return tf.groupBy("term").agg(F.sum("tf").alias("occurrences"), F.count("*").alias("texts"))


@query
def element_keys(spark, folder):
    e = table(spark, folder, "dedup_elements", "id", "type", "raw_str").distinct()
    raw = F.col("raw_str")
    return e.select("id", X.element_id(F.col("type"), raw).alias("own_id"), X.alias_key(raw).alias("alias_key"), X.squeeze(raw).alias("surface"))


@query
def news_codes(spark, folder):
    code = X.news_code(F.col("file_name"))
    return _news(spark, folder).select("news_id", code["prefix"].alias("prefix"), code["number"].alias("number"), X.file_doc_id(F.col("file_name")).alias("doc_id"))


@query
def scope_filter(spark, folder):
    return _news(spark, folder).where(in_scope(F.col("file_name"), "E400-E100,m001-m300, EC483")).select("news_id", "file_name")


@query
def title_parts(spark, folder):
    p = X.title_parts(X.stem(F.col("file_name")))
    return _news(spark, folder).select("news_id", p["base"].alias("base"), p["raw_time"].alias("raw_time"), p["malformed"].alias("malformed"))


@query
def news_manifest(spark, folder):
    """Per text: plain sentences, signs and estimated tokens."""
    t = F.col("normalized_text")
    return _news(spark, folder).select("doc_id", F.coalesce(F.size(X.news_sentences(t)), F.lit(0)).alias("sentences"), F.coalesce(F.length(t), F.lit(0)).alias("chars"), X.token_estimate(t).alias("tokens"))


@query
def document_previews(spark, folder):
    s = X.collect_sentences(F.col("normalized_text"))
    return _news(spark, folder).where("normalized_text is not null").select("doc_id", F.upper(F.regexp_extract("doc_id", "^[A-Za-z]+", 0)).alias("category"), X.preview(s).alias("preview"))


@query
def repeated_sentences(spark, folder):
    """Sentences that are equivalent to others, by their key."""
    return sentence_index(spark, folder).groupBy(X.same_sentence_key(F.col("text")).alias("key")).agg(F.count("*").alias("times")).where("times > 1")


@query
def bm25_search(spark, folder):
    """The stated query set, titles of texts whose number is divisible by 100, against all texts."""
    news = _news(spark, folder)
    asked = news.where("news_id % 100 = 0").select(F.col("news_id").alias("query_id"), X.stem(F.col("file_name")).alias("text"))
    return LX.bm25(asked, news.select(F.col("news_id").alias("doc_id"), F.col("normalized_text").alias("text")), k=10)


@query
def hybrid_search(spark, folder):
    """The same query set by the mix of BM25 and the cosine of hashed vectors, both scaled over all texts."""
    news = _news(spark, folder)
    asked = news.where("news_id % 100 = 0").select(F.col("news_id").alias("query_id"), X.stem(F.col("file_name")).alias("text"))
    docs = news.select(F.col("news_id").alias("doc_id"), F.coalesce("normalized_text", F.lit("")).alias("text"))
    near = SI.scores(asked.select(F.col("query_id").alias("id"), DG.hashed("text").alias("vector")), docs.select(F.col("doc_id").alias("id"), DG.hashed("text").alias("vector")), own=True)
    near = near.groupBy(F.col("query").alias("query_id"), F.col("id").alias("doc_id")).agg(F.round(F.max("score"), 9).alias("score"))
    return LX.hybrid(near, LX.bm25(asked, docs), 0.5, 10)


# --- tuples ----------------------------------------------------------------------------------------------------------


@query
def tuple_projection(spark, folder):
    return TU.projected(_tuples(spark, folder).distinct())


@query
def sentence_tuple_counts(spark, folder):
    return TU.sentence_counts(_tuples(spark, folder), Scratch(spark, "counts")).select("doc_id", "sentence_id", "tuple_count", "rank")


@query
def tuple_histogram(spark, folder):
    return TU.count_histogram(_tuples(spark, folder))


@query
def tuple_global_stats(spark, folder):
    return TU.global_counts(_tuples(spark, folder))


@query
def tuple_delete_reasons(spark, folder):
    return TU.delete_reasons(_tuples(spark, folder)).where((F.size("reasons") > 0) | (F.col("copies") > 1)).select("tuple_id", "copies", F.array_join("reasons", ",").alias("reasons"))


@query
def cleaned_tuples(spark, folder):
    return TU.cleaned(_tuples(spark, folder))


@query
def tuple_normal_times(spark, folder):
    return TU.with_normal_times(_tuples(spark, folder).select("tuple_id", "time").distinct())


@query
def tuple_point_times(spark, folder):
    """Single points only, inside generated code."""
    return _tuples(spark, folder).select("tuple_id", TM.single_point(F.col("time")).alias("time")).distinct()


@query
def signature_times(spark, folder):
    return _tuples(spark, folder).select("tuple_id", TM.signature_time(F.col("time")).alias("time")).distinct()


@query
def unresolved_times(spark, folder):
    return TU.unresolved_times(_tuples(spark, folder))


@query
def story_order(spark, folder):
    """Cleaned tuples in normal times, in the order of the story."""
    return TU.in_story_order(TU.with_normal_times(_tuples(spark, folder)), Scratch(spark, "story")).select("tuple_id", "doc_id", "time", "position")


def _merged(spark, folder, scratch):
    return scratch.cut(TU.merged_in_sentences(_tuples(spark, folder), scratch), "merged")


@query
def merged_sentence_tuples(spark, folder):
    return TU.merged_in_sentences(_tuples(spark, folder), Scratch(spark, "merge"))


@query
def merged_document_tuples(spark, folder):
    return TU.merged_across_document(_merged(spark, folder, Scratch(spark, "merge")))


@query
def merged_export_stats(spark, folder):
    m = _merged(spark, folder, Scratch(spark, "merge"))
    return TU.merge_figures(_tuples(spark, folder), m, TU.merged_across_document(m))


@query
def expanded_tuples(spark, folder):
    return TU.expanded(_merged(spark, folder, Scratch(spark, "merge")))


@query
def tuple_chain(spark, folder):
    """The flagship: clean-up, normal times, merging within sentences and across documents, in one go."""
    scratch = Scratch(spark, "chain")
    fine = TU.with_normal_times(TU.cleaned(_tuples(spark, folder))).drop("time_known")
    return TU.merged_across_document(scratch.cut(TU.merged_in_sentences(fine, scratch), "merged"))


@query
def extraction_manifest(spark, folder):
    """Per document: sentences asked for and sentences with tuples, and tuples."""
    s = sentence_index(spark, folder).select("doc_id", "sent_id")
    t = _tuples(spark, folder).select("tuple_id", F.col("source_sent_id").alias("sent_id")).distinct()
    per = t.groupBy("sent_id").agg(F.count("*").alias("n"))
    return s.join(per, "sent_id", "left").groupBy("doc_id").agg(F.count("*").alias("requested"), F.count("n").alias("completed"), F.coalesce(F.sum("n"), F.lit(0)).alias("tuples"))


@query
def sentences_without_tuples(spark, folder):
    """What a resumed extraction would still ask for."""
    done = _tuples(spark, folder).select(F.col("source_sent_id").alias("sent_id"))
    return remaining(sentence_index(spark, folder).select("doc_id", "sent_id"), done, "sent_id")


@query
def extracted_tuples(spark, folder):
    """Tuples of every distinct sentence by the offline extractor, checked."""
    s = sentence_index(spark, folder)
    asked = s.select(F.col("sent_id").alias("custom_id"), F.to_json(F.struct(F.col("text").alias("sentence"))).alias("payload"))
    found = PR.checked_tuples(PR.answered(asked, None, PR.RuleExtractor, "extract"))
    return found.where("valid").select(F.col("custom_id").alias("sent_id"), F.col("t.subject")[0]["concept"].alias("subject"), F.col("t.relation.concept").alias("relation"), F.col("t.object")[0]["concept"].alias("object"))


@query
def context_windows(spark, folder):
    """Every plain sentence with neighbours up to an estimated 120 tokens."""
    return PA.context_windows(sentence_index(spark, folder).select("doc_id", "sentence_index", "text"), 120, 2)


def _tuple_documents(spark, folder):
    """Nested JSON of every sentence's tuples."""
    t = _tuples(spark, folder).select("tuple_id", "source_sent_id", "subject", "time").distinct().where("source_sent_id is not null")
    return t.groupBy("source_sent_id").agg(F.to_json(F.struct(F.col("source_sent_id").alias("sentence"), F.array_sort(F.collect_list(F.struct("tuple_id", "subject", "time"))).alias("tuples"))).alias("body"))


@query
def pruned_payloads(spark, folder):
    """Nested tuples without those that clean-up deletes."""
    gone = TU.delete_reasons(_tuples(spark, folder)).where(F.size("reasons") > 0)
    left = F.from_json("body", "tuples array<struct<tuple_id:string>>")["tuples"]
    return PA.pruned_payloads(_tuple_documents(spark, folder), "source_sent_id", "body", gone).select("source_sent_id", F.array_join(F.transform(left, lambda t: t["tuple_id"]), ",").alias("tuple_ids"))


@query
def retimed_payloads(spark, folder):
    """Nested tuples with normal times."""
    times = TU.with_normal_times(_tuples(spark, folder).select("tuple_id", "time").distinct()).where("time_known")
    told = F.from_json("body", "tuples array<struct<tuple_id:string,time:string>>")["tuples"]
    return PA.retimed_payloads(_tuple_documents(spark, folder), "source_sent_id", "body", times).select(F.explode(told).alias("t")).select("t.tuple_id", "t.time")


# --- concepts and canonical ids --------------------------------------------------------------------------------------


@query
def concept_pool(spark, folder):
    return CO.concept_pool(_tuples(spark, folder))


@query
def pool_upsert(spark, folder):
    """Element versions put into a pool in the order of their numbers; the latest description wins."""
    v = table(spark, folder, "element_versions").distinct()
    kept = lambda rows: rows.select("type", F.col("raw_str").alias("concept"), "description", F.array("origin").alias("contexts"), F.col("record_id").alias("seq"))
    # Undated versions are the pool, dated ones come to it.
    return CO.updated_pool(kept(v.where("updated_at is null")), kept(v.where("updated_at is not null"))).select("type", "concept", "description", F.array_sort("contexts").alias("contexts"), "seq")


@query
def latest_versions(spark, folder):
    v = table(spark, folder, "element_versions", "id", "record_id", "updated_at").where("updated_at is not null")
    best = v.groupBy("id").agg(F.max(F.struct("updated_at", (-F.col("record_id")).alias("r"))).alias("b"))
    return best.select("id", (-F.col("b.r")).alias("record_id"), F.col("b.updated_at").cast("string").alias("updated_at"))


@query
def compliance_split(spark, folder):
    return CO.compliance(table(spark, folder, "dedup_elements", "type", "raw_str"))


@query
def compliance_counts(spark, folder):
    judged = CO.compliance(table(spark, folder, "dedup_elements", "type", "raw_str"))
    return CO.compliance_counts(judged, CO.invalid_references(_tuples(spark, folder), judged))


@query
def invalid_references(spark, folder):
    return CO.invalid_references(_tuples(spark, folder), CO.compliance(table(spark, folder, "dedup_elements", "type", "raw_str")))


@query
def grouped_mapping(spark, folder):
    return CO.grouped_mapping(CO.mapping_rows(table(spark, folder, "canonical")))


@query
def mapped_tuples(spark, folder):
    return CO.apply_mapping(_tuples(spark, folder), _alias_mapping(spark, folder))


def _alias_mapping(spark, folder):
    """Surface forms that an entry's alias key covers, to the entry's name."""
    ref = table(spark, folder, "canonical")
    e = table(spark, folder, "dedup_elements", "type", "raw_str", "alias_key").distinct()
    names = CA.alias_map(ref).join(ref.select("cid", "canonical_str"), "cid")
    return e.join(names, ["type", "alias_key"]).select("type", F.col("raw_str").alias("source"), F.col("canonical_str").alias("merged"))


@query
def mapping_report(spark, folder):
    return CO.apply_report(CO.apply_mapping(_tuples(spark, folder), _alias_mapping(spark, folder)))


@query
def alias_map(spark, folder):
    return CA.alias_map(table(spark, folder, "canonical"))


@query
def unresolved_report(spark, folder):
    return CA.missed_keys(_tuples(spark, folder), CA.alias_map(table(spark, folder, "canonical")))


@query
def canonical_tuples(spark, folder):
    """With fallback ids for keys that the reference list lacks."""
    aliases, scratch = CA.alias_map(table(spark, folder, "canonical")), Scratch(spark, "canonical")
    whole = scratch.cut(CA.with_fallback(aliases, CA.missed_keys(_tuples(spark, folder), aliases)), "aliases")
    return CA.canonical_tuples(_tuples(spark, folder), whole)


@query
def merged_entries(spark, folder):
    """Reference entries and fallback entries as one list."""
    ref = table(spark, folder, "canonical")
    lost = CA.missed_keys(_tuples(spark, folder), CA.alias_map(ref))
    rows = ref.select("type", "cid", "canonical_str", "description", "aliases", F.lit(0).alias("seq")).unionByName(
        lost.select(F.col("element_type").alias("type"), F.col("fallback_cid").alias("cid"), F.col("raw_str").alias("canonical_str"), F.lit(None).cast("string").alias("description"), F.array("alias_key").alias("aliases"), F.lit(1).alias("seq"))
    )
    return CA.merged_entries(rows)


@query
def schema_figures(spark, folder):
    return CA.schema_figures(table(spark, folder, "canonical"))


# --- vectors ---------------------------------------------------------------------------------------------------------


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


@query
def vector_units(spark, folder):
    return _vectors(spark, folder).select("id", F.transform(unit(F.col("vector")), lambda x: F.round(x, 6)).alias("unit"))


@query
def vector_search(spark, folder):
    v = _vectors(spark, folder)
    return SI.search(v.where("id % 100 = 0"), v, k=5).select("query", "id", F.round("score", 6).alias("score"), "rank")


@query
def similarity_distribution(spark, folder):
    v = _vectors(spark, folder)
    return SI.score_distribution(v.where("id % 100 = 0"), v)


@query
def nearest_distribution(spark, folder):
    """The same figures of the nearest neighbours of the query set."""
    v = _vectors(spark, folder)
    return SI.distribution(SI.search(v.where("id % 100 = 0"), v, k=1))


@query
def mutual_neighbours(spark, folder):
    return SI.mutual_edges(SI.group_neighbours(_vectors(spark, folder), "label", 5, 0.05))


@query
def label_figures(spark, folder):
    return SI.group_figures(_vectors(spark, folder), "label")


@query
def label_medoids(spark, folder):
    return SI.medoids(_vectors(spark, folder).select("id", "label", unit(F.col("vector")).alias("u")), "label", 64)


@query
def weighted_field_search(spark, folder):
    """Three slices of a vector as weighted fields."""
    v = F.col("vector")
    rows = _vectors(spark, folder).select("id", weighted_fields([(F.slice(v, 1, 20), 0.4), (F.slice(v, 21, 20), 0.4), (F.slice(v, 41, 24), 0.2)]).alias("vector"))
    return SI.search(rows.where("id % 100 = 0"), rows, k=5).select("query", "id", F.round("score", 6).alias("score"), "rank")


@query
def link_candidates(spark, folder):
    """Labels as entries with many aliases: for the query set the three nearest labels by their best vector."""
    v = _vectors(spark, folder)
    aliases = v.select(F.lit("entity").alias("type"), F.col("id").cast("string").alias("alias_key"), F.col("label").cast("string").alias("cid"))
    rows = v.select(F.lit("entity").alias("type"), F.col("id").cast("string").alias("alias_key"), "vector")
    return CA.link_candidates(rows, aliases, v.where("id % 100 = 0").select(F.col("id").alias("ask_id"), "vector"))


@query
def document_edges(spark, folder):
    """Four slices of a vector as a document's sentences, its number giving the end day; the query set as anchors."""
    quarter = [unit(F.slice("vector", 16 * i + 1, 16)) for i in range(4)]
    rows = _vectors(spark, folder).select(F.col("id").alias("doc_id"), F.pmod(F.col("id") * 37, F.lit(400)).cast("int").alias("ord"), F.array(*quarter).alias("vectors"))
    mean = F.array(*[(F.col("vectors")[0][i] + F.col("vectors")[1][i] + F.col("vectors")[2][i] + F.col("vectors")[3][i]) / 4 for i in range(16)])
    return DG.edges(rows.where("doc_id % 100 = 0"), rows.select("doc_id", "ord", mean.alias("mean")), least=0.2)


@query
def news_graph(spark, folder):
    """The graph of news texts: corrected end times, hashed sentence vectors, all edges of each anchor of the query set."""
    news, scratch = _news(spark, folder), Scratch(spark, "graph")
    days = TL.corrected(news.select("doc_id", "file_name", F.col("normalized_text").alias("text"))).select("doc_id", DG.day_number(F.col("anchor")).alias("ord"))
    v = scratch.cut(DG.sentence_vectors(news), "vectors")
    asked = news.where("news_id % 100 = 0").select("doc_id")
    anchors = v.join(asked, "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_list("vector").alias("vectors")).join(days, "doc_id")
    return DG.edges(anchors, DG.means(v, DG.DIMENSION).join(days, "doc_id"), least=float("-inf"))


def _match_edges(spark, folder):
    """Matches as edges between keys; the same key of two types is two nodes."""
    m = table(spark, folder, "dedup_matches").where("element_type is not null and left_key is not null and right_key is not null")
    node = lambda c: F.concat("element_type", F.lit("|"), X.alias_key(F.col(c)))
    told = m.where(~X.is_blank(F.col("left_key")) & ~X.is_blank(F.col("right_key")))
    return told.select(node("left_key").alias("source"), node("right_key").alias("target"), F.coalesce("score", F.lit(0.0)).alias("weight")).distinct()


@query
def match_neighbourhood(spark, folder):
    """Keys at most two strong matches away from the smallest key."""
    e, scratch = GR.strong_edges(_match_edges(spark, folder), 0.6), Scratch(spark, "hops")
    return GR.neighbourhood(e, e.agg(F.min("source").alias("node")), 2, scratch)


@query
def neighbourhood_edges(spark, folder):
    e, scratch = GR.strong_edges(_match_edges(spark, folder), 0.6), Scratch(spark, "hops")
    return GR.induced_edges(e, GR.neighbourhood(e, e.agg(F.min("source").alias("node")), 2, scratch))


def _blocked(spark, folder, scratch):
    v = _vectors(spark, folder).select("id", "vector")
    return scratch.cut(SI.vector_blocks(v, 128), "blocks")


@query
def vector_blocks(spark, folder):
    return _blocked(spark, folder, Scratch(spark, "blocks")).groupBy("block").agg(F.count("*").alias("size"))


@query
def balanced_clusters(spark, folder):
    return CL.balanced_clusters(_vectors(spark, folder), Scratch(spark, "balanced"), CL.Sizes(target=10, least=5, most=30, k=10, absorb=0.1))


@query
def linkage_clusters(spark, folder):
    return CL.linkage_clusters(_vectors(spark, folder), Scratch(spark, "linkage"), 64)


@query
def plot_points(spark, folder):
    return CL.projected_points(_vectors(spark, folder))


@query
def greedy_entries(spark, folder):
    """Elements put together greedily, each with its entry; those without a usable vector are entries of their own."""
    e = table(spark, folder, "dedup_elements")
    return CA.put_together(e, Scratch(spark, "greedy")).select("type", "id", "cid", "canonical_str")


@query
def deduplicated_entries(spark, folder):
    """The same as a list of entries with their aliases."""
    return CA.as_entries(CA.put_together(table(spark, folder, "dedup_elements"), Scratch(spark, "entries")))


@query
def same_key_entries(spark, folder):
    """Entries by a judge that only knows the alias key, in a block for each key."""
    e = table(spark, folder, "dedup_elements").where("size(vector) = 96").dropDuplicates(["type", "id"])
    return CA.as_entries(CA.deduplicated(e.withColumn("block", F.col("alias_key")), "block", 1_000, judge=CA.key_judge))


@query
def same_key_aliases(spark, folder):
    """The alias map of such entries."""
    e = table(spark, folder, "dedup_elements").where("size(vector) = 96").dropDuplicates(["type", "id"])
    return CA.key_entries(CA.deduplicated(e.withColumn("block", F.col("alias_key")), "block", 1_000, judge=CA.key_judge))


# --- timeline --------------------------------------------------------------------------------------------------------


def _records(spark, folder):
    return TL.corrected(_news(spark, folder).select("doc_id", "file_name", F.col("normalized_text").alias("text")))


@query
def timeline_manifest(spark, folder):
    return TL.manifest(_records(spark, folder))


@query
def timeline_candidates(spark, folder):
    return TL.candidates(_records(spark, folder))


@query
def timeline_review(spark, folder):
    return TL.manifest(_records(spark, folder)).where("needs_review")


@query
def timeline_summary(spark, folder):
    return TL.summary(_records(spark, folder))


from chronoloom import queries_stages as _stages  # noqa: E402

QUERIES.update(_stages.QUERIES)
SQL.update(_stages.SQL)

"""Every query by name, over the test tables as ``sources.adapter`` shapes them, and its SQL.

Arrays come out as joined texts and scores rounded, so that rows can be compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import json as jsonx
from ..functions import scoring, text
from ..operators import discovery, gaps, graph, matching, outline, packs, pages, promotion, quality, search, state
from ..sources import adapter as A
from ..sources.adapter import FIELDS, NORM_SQL, sql, table
from ..sources.landing import durable
from .registry import ORACLES, QUERIES, query

#: The reference year of all scores and ages, and the keywords of the filters.
NOW, KEYWORDS, NEGATIVES = 2026, ["the", "de la", "einer", "Avec"], ["tion on", "und"]


def csv(c) -> F.Column:
    return F.array_join(c, ",")


# ---- concepts -------------------------------------------------------------------------------------------------------


def _mentions(spark, d) -> DataFrame:
    return gaps.mentions(A.mention_rows(spark, d), FIELDS)


def _importance(spark, d) -> DataFrame:
    return A.mention_rows(spark, d).select("paper", "importance").distinct()


def _concept_edges(spark, d) -> DataFrame:
    return gaps.concept_edges(A.graph_nodes(spark, d), A.graph_edges(spark, d))


_CE = f"SELECT *, {NORM_SQL.format('dst')} AS norm FROM edges WHERE src IN (SELECT id FROM nodes WHERE type = 'Paper') AND dst NOT IN (SELECT id FROM nodes WHERE type = 'Paper')"
_EV = "SELECT norm, count(DISTINCT paper) AS paper_count, count(DISTINCT paper) FILTER (importance >= 4) AS core_paper_count, list_sort(list(DISTINCT slot)) AS in_slots, bool_or(importance >= 4) FILTER (field <= 1) AS moc, arg_min(raw, paper || '#' || field || '#' || ord || '#' || raw) AS display FROM mentions GROUP BY norm"
_GE = "SELECT norm, count(DISTINCT src) AS paper_count, bool_or(src IN (SELECT paper FROM mention_rows WHERE importance >= 4)) FILTER (type IN ('USES', 'INTRODUCES', 'USES_DATASET', 'EXTENDS')) AS moc FROM ce GROUP BY norm"
_GC = f"SELECT {NORM_SQL.format('id')} AS norm, arg_max(display, (ord, id, display)) AS display FROM nodes WHERE type <> 'Paper' GROUP BY 1"
_UC = "SELECT norm, count(DISTINCT paper) AS paper_count FROM (SELECT norm, paper FROM mentions UNION ALL SELECT norm, src FROM ce) GROUP BY norm"
_KN = f"SELECT DISTINCT {NORM_SQL.format('k')} AS k FROM (SELECT key AS k FROM known UNION ALL SELECT variant FROM known)"
_CAND = f"""SELECT *, CASE WHEN norm IN (SELECT k FROM kn) OR {NORM_SQL.format('concept')} IN (SELECT k FROM kn) THEN 'known'
    WHEN paper_count <= 1 AND len(list_filter(in_slots, lambda s: s <> 'mention')) = 0 AND NOT moc_graph THEN 'too_minor'
    WHEN importance < 0.30 AND core_paper_count < 2 THEN 'low_score' END AS reason
  FROM (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.35::DOUBLE * (least(core_paper_count, 3) / 3) + 0.25::DOUBLE * (least(paper_count, 5) / 5) + 0.25::DOUBLE * CASE
      WHEN list_contains(in_slots, 'title') THEN 1.0::DOUBLE WHEN list_contains(in_slots, 'method') OR list_contains(in_slots, 'result') THEN 0.8::DOUBLE
      WHEN list_contains(in_slots, 'abstract') THEN 0.6::DOUBLE WHEN list_contains(in_slots, 'reader_needed') THEN 0.4::DOUBLE ELSE 0.2::DOUBLE END
      + 0.15::DOUBLE * CASE WHEN is_method_of_core THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) AS importance
    FROM (SELECT u.norm, coalesce(ev.display, gc.display, u.norm) AS concept, coalesce(uc.paper_count, 0) AS paper_count, coalesce(ev.core_paper_count, 0) AS core_paper_count,
        coalesce(ev.in_slots, []) AS in_slots, coalesce(ge.moc, false) AS moc_graph, coalesce(ev.moc, false) OR coalesce(ge.moc, false) AS is_method_of_core
      FROM (SELECT norm FROM ev UNION SELECT norm FROM ge UNION SELECT norm FROM gc) u LEFT JOIN ev USING (norm) LEFT JOIN ge USING (norm) LEFT JOIN gc USING (norm) LEFT JOIN uc USING (norm)))"""
_SEL = "SELECT *, row_number() OVER (ORDER BY extra, importance DESC, norm) AS rank FROM (SELECT *, CASE WHEN rn <= 150 THEN 0 ELSE 1 END AS extra FROM (SELECT *, row_number() OVER (ORDER BY importance DESC, norm) AS rn FROM cand WHERE reason IS NULL)) WHERE rn <= 150 OR core_paper_count >= 2"
_NB = "SELECT norm, neighbor, shared, row_number() OVER (PARTITION BY norm ORDER BY shared DESC, neighbor) AS rank FROM (SELECT a.norm, b.norm AS neighbor, count(*) AS shared FROM (SELECT DISTINCT src, norm FROM ce) a JOIN (SELECT DISTINCT src, norm FROM ce) b ON a.src = b.src AND a.norm <> b.norm GROUP BY 1, 2)"
_ALL = {"ce": _CE, "ev": _EV, "ge": _GE, "gc": _GC, "uc": _UC, "kn": _KN, "cand": _CAND}
_GAP = ("mentions", "edges", "nodes", "known")


def _signals(spark, d) -> tuple[DataFrame, DataFrame]:
    """Mentions and the graph's concepts, which several aggregates of one query read, written once."""
    return durable(_mentions(spark, d), "mentions"), durable(_concept_edges(spark, d).select("src", "norm", "type"), "concept-edges")


def _candidates(spark, d, signals=None) -> DataFrame:
    m, e = signals or _signals(spark, d)
    return gaps.candidates(m, A.graph_nodes(spark, d), e, A.known(spark, d), m.select("paper", "importance").distinct())


@query("concept_paper_counts", sql("SELECT norm, count(DISTINCT paper) AS paper_count, count(DISTINCT paper) FILTER (importance >= 4) AS core_paper_count FROM mentions GROUP BY norm", "mentions"))
def _(spark, d):
    return gaps.evidence_signals(_mentions(spark, d)).select("norm", "paper_count", "core_paper_count")


@query("concept_slots", sql("SELECT norm, array_to_string(list_sort(list(DISTINCT slot)), ',') AS slots FROM mentions GROUP BY norm", "mentions"))
def _(spark, d):
    return gaps.evidence_signals(_mentions(spark, d)).select("norm", csv("in_slots").alias("slots"))


@query("concept_title_slots", sql("SELECT paper, norm, count(*) AS n FROM mentions WHERE slot = 'title' GROUP BY paper, norm", "mentions"))
def _(spark, d):
    return _mentions(spark, d).where("slot = 'title'").groupBy("paper", "norm").agg(F.count(F.lit(1)).alias("n"))


@query("concept_display", sql("SELECT norm, display FROM ev", "mentions", ev=_EV))
def _(spark, d):
    return gaps.evidence_signals(_mentions(spark, d)).select("norm", "display")


@query("method_of_core", sql("SELECT coalesce(ev.norm, ge.norm) AS norm, ev.moc AS via_evidence, ge.moc AS via_graph FROM (SELECT norm, moc FROM ev WHERE moc IS NOT NULL) ev FULL JOIN (SELECT norm, moc FROM ge WHERE moc IS NOT NULL) ge ON ev.norm = ge.norm", "mentions", "edges", "nodes", ce=_CE, ev=_EV, ge=_GE))
def _(spark, d):
    ev = gaps.evidence_signals(_mentions(spark, d)).select("norm", F.col("method_of_core").alias("via_evidence")).where("via_evidence is not null")
    ge = gaps.graph_signals(_concept_edges(spark, d), _importance(spark, d)).select("norm", F.col("method_of_core").alias("via_graph")).where("via_graph is not null")
    return ev.join(ge, "norm", "full")


@query("graph_paper_counts", sql("SELECT norm, count(DISTINCT src) AS paper_count FROM ce GROUP BY norm", "edges", "nodes", ce=_CE))
def _(spark, d):
    return gaps.graph_signals(_concept_edges(spark, d), _importance(spark, d)).select("norm", "paper_count")


@query("graph_display", sql("SELECT norm, display FROM gc", "nodes", gc=_GC))
def _(spark, d):
    return gaps.graph_concepts(A.graph_nodes(spark, d))


@query("union_paper_count", sql("SELECT * FROM uc", "mentions", "edges", "nodes", ce=_CE, uc=_UC))
def _(spark, d):
    return gaps.union_counts(_mentions(spark, d), _concept_edges(spark, d))


@query("graph_neighbors_topk", sql("SELECT norm, neighbor, shared, rank FROM nb WHERE rank <= 5", "edges", "nodes", ce=_CE, nb=_NB))
def _(spark, d):
    return gaps.neighbors(_concept_edges(spark, d))


@query("gap_importance_ranked", sql("SELECT norm, concept, paper_count, core_paper_count, array_to_string(in_slots, ',') AS in_slots, is_method_of_core, round(importance, 6) AS importance FROM cand", *_GAP, **_ALL))
def _(spark, d):
    return _candidates(spark, d).select("norm", "concept", "paper_count", "core_paper_count", csv("in_slots").alias("in_slots"), "is_method_of_core", F.round("importance", 6).alias("importance"))


@query("gap_digest_selected", sql("SELECT rank, norm, round(importance, 6) AS importance FROM sel WHERE rank <= 180", *_GAP, **_ALL, sel=_SEL))
def _(spark, d):
    return gaps.selected(_candidates(spark, d)).select("rank", "norm", F.round("importance", 6).alias("importance"))


@query("gap_dropped_reasons", sql("SELECT concept, reason FROM cand WHERE reason IS NOT NULL", *_GAP, **_ALL))
def _(spark, d):
    return _candidates(spark, d).where("reason is not null").select("concept", "reason")


_SOL = "SELECT paper, string_agg(text, ' ' ORDER BY nth) FILTER (claim_type = 'method') AS solution, string_agg(text, ' ' ORDER BY nth) FILTER (claim_type = 'limitation') AS problem FROM claims GROUP BY paper"
_REF = "SELECT norm, paper, slot, substr(coalesce(solution, problem, norm), 1, 120) AS snippet FROM (SELECT norm, paper, arg_min(slot, field || '#' || ord || '#' || extra) AS slot, row_number() OVER (PARTITION BY norm ORDER BY paper) AS nth FROM mentions GROUP BY norm, paper) LEFT JOIN sol USING (paper) WHERE nth = 1"


def _snippets(spark, d) -> DataFrame:
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("claim_type") == kind, F.struct("nth", "text"))))["text"]
    return A.claims(spark, d).groupBy("paper").agg(of("method").alias("solution"), of("limitation").alias("problem"))


@query("evidence_first_ref", sql("SELECT * FROM ref", "mentions", "claims", sol=_SOL, ref=_REF))
def _(spark, d):
    return gaps.first_references(_mentions(spark, d), _snippets(spark, d)).drop("nth")


@query("gap_digest", sql("SELECT rank, substr(concept, 1, 80) AS concept, norm AS normalized, round(importance, 6) AS importance, paper_count, core_paper_count, coalesce(ref.paper || '|' || slot || '|' || snippet, '') AS evidence_refs, coalesce(names, '') AS graph_neighbors FROM sel LEFT JOIN ref USING (norm) LEFT JOIN (SELECT nb.norm, string_agg(substr(coalesce(display, neighbor), 1, 80), ',' ORDER BY rank) AS names FROM nb LEFT JOIN gc ON gc.norm = neighbor WHERE rank <= 3 GROUP BY 1) USING (norm) WHERE rank <= 180", *_GAP, "claims", **_ALL, sel=_SEL, nb=_NB, sol=_SOL, ref=_REF))
def _(spark, d):
    m, e = signals = _signals(spark, d)
    chosen = durable(gaps.selected(_candidates(spark, d, signals)), "chosen")  # few, which alone need references and neighbours
    near = durable(gaps.neighbors_of(e, chosen), "near")
    names = gaps.graph_concepts(A.graph_nodes(spark, d), near.select(F.col("neighbor").alias("norm")))
    records = gaps.digest(chosen, gaps.first_references(m, _snippets(spark, d), chosen=chosen), near, names)
    refs = F.array_join(F.transform("evidence_refs", lambda r: F.concat_ws("|", r["arxiv_id"], r["slot"], r["snippet"])), ";")
    return gaps.within_budget(records).select("rank", "concept", "normalized", F.round("importance", 6).alias("importance"), "signals.paper_count", "signals.core_paper_count", refs.alias("evidence_refs"), csv("graph_neighbors").alias("graph_neighbors"))


@query("kb_known_semi", sql("SELECT DISTINCT norm FROM mentions WHERE norm IN (SELECT k FROM kn)", "mentions", "known", kn=_KN))
def _(spark, d):
    return gaps.is_known(_mentions(spark, d).select("norm").distinct(), A.known(spark, d), ["norm"])


@query("kb_unknown_anti", sql("SELECT DISTINCT norm FROM mentions WHERE norm NOT IN (SELECT k FROM kn)", "mentions", "known", kn=_KN))
def _(spark, d):
    concepts = _mentions(spark, d).select("norm").distinct()
    return concepts.join(gaps.is_known(concepts, A.known(spark, d), ["norm"]), "norm", "left_anti")


@query("normalized_concepts", f"SELECT p_partkey, {NORM_SQL.format(chr(39) + '  ' + chr(39) + ' || upper(p_name) || ' + chr(39) + ' -  ' + chr(39) + ' || p_type || ' + chr(39) + '.,;' + chr(39))} AS norm FROM part")
def _(spark, d):
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" -  "), F.col("p_type"), F.lit(".,;"))
    return table(spark, d, "part").select("p_partkey", text.concept_key(raw).alias("norm"))


# ---- discovery ------------------------------------------------------------------------------------------------------

_TERM = r"(?i)(^|[^\p{L}\p{N}_])(?:%s)($|[^\p{L}\p{N}_])"
_POS, _NEG = _TERM % r"the|de\s+la|einer|avec", _TERM % r"tion\s+on|und"
_KEEP = f"(2026 - year <= 6) AND NOT coalesce(regexp_matches(abstract, '{_NEG}'), false) AND coalesce(regexp_matches(abstract, '{_POS}'), false)"


@query("keyword_filter", sql(f"SELECT paper_id FROM papers WHERE {_KEEP}", "papers"))
def _(spark, d):
    return discovery.filter_papers(A.papers(spark, d), KEYWORDS, NEGATIVES, NOW).select("paper_id")


@query("selection_report", sql(f"SELECT 'the,de la,einer,avec' AS keywords, 'tion on,und' AS negative_keywords, count(*) AS total_input, count(*) FILTER ({_KEEP}) AS total_kept FROM papers", "papers"))
def _(spark, d):
    return discovery.selection_report(A.papers(spark, d), KEYWORDS, NEGATIVES, NOW)


@query("arxiv_year_recent", sql("SELECT paper_id, 2000 + cast(paper_id[1:2] AS INTEGER) AS year, 2026 - (2000 + cast(paper_id[1:2] AS INTEGER)) <= 6 AS recent FROM papers", "papers"))
def _(spark, d):
    return A.papers(spark, d).select("paper_id", text.paper_year("paper_id").alias("year"), discovery.recent(F.col("paper_id"), NOW).alias("recent"))


_IMPACT = "round(0.40::DOUBLE * least(1.0, ln(1 + citations) / ln(10001)) + 0.35::DOUBLE * least(1.0, ln(1 + citations / greatest(1, 2027 - year)) / ln(1001)) + 0.25::DOUBLE * greatest(0.0, least(1.0, 1 - (greatest(1, 2027 - year) - 1) / 6.0::DOUBLE)), 6)"


@query("impact_scores", sql(f"SELECT paper_id, {_IMPACT} AS score FROM papers", "papers"))
def _(spark, d):
    return A.papers(spark, d).select("paper_id", scoring.impact(F.col("citations"), F.col("year"), NOW).alias("score"))


@query("impact_topk", sql(f"SELECT paper_id, {_IMPACT} AS score FROM papers ORDER BY score DESC, doc_id LIMIT 50", "papers"))
def _(spark, d):
    return discovery.ranked_by_impact(A.papers(spark, d).withColumn("ord", F.col("doc_id")), NOW, 50).select("paper_id", "score")


_LINKS = "SELECT c_custkey AS paper, o_orderkey AS id, cast(floor(o_totalprice / 1000) AS BIGINT) AS cites, o_orderkey AS ord FROM orders JOIN customer ON o_custkey = c_custkey"


def _links(spark, d) -> DataFrame:
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(F.col("c_custkey").alias("paper"), F.col("o_orderkey").alias("id"), F.floor(F.col("o_totalprice") / 1000).alias("cites"), F.col("o_orderkey").alias("ord"))


@query("citations_topk_per_paper", sql("SELECT paper, id, cites, rank FROM (SELECT *, row_number() OVER (PARTITION BY paper ORDER BY cites DESC, ord) AS rank FROM l WHERE cites >= 50) WHERE rank <= 3", l=_LINKS))
def _(spark, d):
    return discovery.top_linked(_links(spark, d), 3, 50).select("paper", "id", "cites", "rank")


_HOPS = "SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem WHERE l_linenumber % 3 > 0 UNION SELECT DISTINCT 's' || l_suppkey, 'p' || (l_partkey + 1) FROM lineitem WHERE l_linenumber % 3 = 0"


def _hops(spark, d) -> DataFrame:
    line = table(spark, d, "lineitem")
    part, supplier = F.concat(F.lit("p"), F.col("l_partkey").cast("string")), F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    down = line.where("l_linenumber % 3 > 0").select(part.alias("src"), supplier.alias("dst"))
    up = line.where("l_linenumber % 3 = 0").select(supplier.alias("src"), F.concat(F.lit("p"), (F.col("l_partkey") + 1).cast("string")).alias("dst"))
    return down.unionByName(up).distinct().withColumn("ord", F.col("dst"))


@query("citation_bfs_depth3", "WITH RECURSIVE hops AS (" + _HOPS + "), r(id, hop) AS (SELECT 'p' || p_partkey, 0 FROM part WHERE p_partkey < 5 UNION SELECT dst, hop + 1 FROM r JOIN hops ON src = id WHERE hop < 3) SELECT id, min(hop) AS hop FROM r GROUP BY id")
def _(spark, d):
    seeds = table(spark, d, "part").where("p_partkey < 5").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"))
    return graph.reach(_hops(spark, d), seeds, 3)


@query("citation_bfs_depth8", "WITH RECURSIVE hops AS (" + _HOPS + "), r(id, hop) AS (SELECT 'p' || p_partkey, 0 FROM part WHERE p_partkey < 3 UNION SELECT dst, hop + 1 FROM r JOIN hops ON src = id WHERE hop < 8) SELECT id, min(hop) AS hop FROM r GROUP BY id")
def _(spark, d):
    """Further than most papers are apart: the search ends with the first level that finds nothing."""
    seeds = table(spark, d, "part").where("p_partkey < 3").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"))
    return graph.reach(_hops(spark, d), seeds, 8)


@query("citation_expansion", sql("SELECT s.id || '/' || a.id || '/' || b.id AS path, b.id AS id, 2 AS level FROM seeds s JOIN best a ON a.paper = s.id JOIN best b ON b.paper = a.id UNION ALL SELECT s.id || '/' || a.id, a.id, 1 FROM seeds s JOIN best a ON a.paper = s.id", hops=_HOPS, seeds="SELECT 'p' || p_partkey AS id FROM part WHERE p_partkey < 20", best="SELECT src AS paper, dst AS id FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY cites DESC, dst) AS n FROM (SELECT src, dst, length(dst) AS cites FROM hops WHERE dst <> 's1') WHERE cites >= 2) WHERE n <= 3"))
def _(spark, d):
    links = _hops(spark, d).select(F.col("src").alias("paper"), F.col("dst").alias("id"), F.length("dst").alias("cites"), "ord")
    seeds = table(spark, d, "part").where("p_partkey < 20").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"))
    excluded = spark.createDataFrame([("s1",)], "id string")
    return graph.expand_citations(links, seeds, 2, 3, 2, excluded).select("path", "id", "level")


@query("pool_union_precedence", sql("SELECT paper_id, arg_max(v, p) AS v, min(p) AS first_part FROM (SELECT paper_id, 'a' || doc_id AS v, 0 AS p FROM papers WHERE doc_id % 2 = 0 UNION ALL SELECT paper_id, 'b' || doc_id, 1 FROM papers WHERE doc_id % 3 = 0 UNION ALL SELECT paper_id, 'c' || doc_id, 2 FROM papers WHERE doc_id % 5 = 0) GROUP BY paper_id", "papers"))
def _(spark, d):
    return discovery.union_by_precedence(_parts(spark, d), "paper_id", "v").select("paper_id", "v", "first_part")


@query("gap_union_first_wins", sql("SELECT paper_id, arg_min(v, p) AS v FROM (SELECT paper_id, 'a' || doc_id AS v, 0 AS p FROM papers WHERE doc_id % 2 = 0 UNION ALL SELECT paper_id, 'b' || doc_id, 1 FROM papers WHERE doc_id % 3 = 0 UNION ALL SELECT paper_id, 'c' || doc_id, 2 FROM papers WHERE doc_id % 5 = 0) GROUP BY paper_id", "papers"))
def _(spark, d):
    return discovery.union_by_precedence(_parts(spark, d), "paper_id", "v", last_wins=False).select("paper_id", "v")


def _parts(spark, d) -> list[DataFrame]:
    p = A.papers(spark, d)
    return [p.where(F.col("doc_id") % n == 0).select("paper_id", F.concat(F.lit(x), F.col("doc_id").cast("string")).alias("v"), F.col("doc_id").alias("ord")) for x, n in (("a", 2), ("b", 3), ("c", 5))]


_HITS = "SELECT paper_id, q AS query, doc_id AS ord FROM papers, (VALUES (2), (3), (5)) t(q) WHERE doc_id % q = 0"


def _hits(spark, d) -> DataFrame:
    p = A.papers(spark, d).select("paper_id", F.explode(F.array(*map(F.lit, (2, 3, 5)))).alias("query"), F.col("doc_id").alias("ord"))
    return p.where("ord % query = 0")


@query("excluded_across_queries", sql("SELECT paper_id, query FROM (SELECT *, min(query) OVER (PARTITION BY paper_id) AS f FROM h) WHERE query = f", "papers", h=_HITS))
def _(spark, d):
    return discovery.running_exclusion(_hits(spark, d)).select("paper_id", "query")


@query("excluded_capped", sql("SELECT paper_id, query FROM k2 UNION ALL SELECT paper_id, query FROM k3 UNION ALL SELECT paper_id, query FROM k5", "papers", h=_HITS, k2="SELECT * FROM h WHERE query = 2 ORDER BY ord LIMIT 20", k3="SELECT * FROM h WHERE query = 3 AND paper_id NOT IN (SELECT paper_id FROM k2) ORDER BY ord LIMIT 20", k5="SELECT * FROM h WHERE query = 5 AND paper_id NOT IN (SELECT paper_id FROM k2 UNION SELECT paper_id FROM k3) ORDER BY ord LIMIT 20"))
def _(spark, d):
    return discovery.running_exclusion_capped(_hits(spark, d), [2, 3, 5], 20).select("paper_id", "query")


@query("excluded_by_either_id", sql("SELECT paper_id FROM papers WHERE paper_id NOT IN (SELECT paper_id FROM papers WHERE doc_id % 7 = 0) AND cast(doc_id AS VARCHAR) NOT IN (SELECT cast(doc_id AS VARCHAR) FROM papers WHERE doc_id % 11 = 0)", "papers"))
def _(spark, d):
    p = A.papers(spark, d).withColumn("own_id", F.col("doc_id").cast("string"))
    ids = p.where("doc_id % 7 = 0").select(F.col("paper_id").alias("id")).unionByName(p.where("doc_id % 11 = 0").select(F.col("own_id").alias("id")))
    return discovery.excluded(p, ids, ["paper_id", "own_id"]).select("paper_id")


@query("hf_upvotes_rank", "SELECT event_id, coalesce(cast(json_extract_string(props, '$.paper.upvotes') AS BIGINT), cast(json_extract_string(replace(props, '\"k\"', '\"upvotes\"'), '$.upvotes') AS BIGINT), 0) AS votes FROM events")
def _(spark, d):
    items = table(spark, d, "events").select("event_id", F.replace(F.col("props"), F.lit('"k"'), F.lit('"upvotes"')).alias("item"), F.col("event_id").alias("ord"))
    return discovery.by_upvotes(items).select("event_id", "votes")


@query("metadata_precedence", sql("SELECT paper_id, CASE WHEN doc_id % 3 <> 0 THEN 'pool ' || doc_id ELSE 'weak ' || doc_id END AS title, CASE WHEN doc_id % 2 = 0 THEN year ELSE year + 1 END AS year FROM papers", "papers"))
def _(spark, d):
    p = A.papers(spark, d)
    pool = p.select("paper_id", F.when(F.col("doc_id") % 3 == 0, F.col("paper_id")).otherwise(F.concat(F.lit("pool "), F.col("doc_id").cast("string"))).alias("title"), F.when(F.col("doc_id") % 2 == 0, F.col("year")).alias("year"))
    weak = p.select("paper_id", F.concat(F.lit(" weak "), F.col("doc_id").cast("string")).alias("title"), (F.col("year") + 1).alias("year"))
    return discovery.metadata([pool, weak])


@query("abstract_fill", sql("SELECT paper_id, CASE WHEN doc_id % 4 = 0 THEN CASE WHEN doc_id % 8 = 0 THEN 'second ' || doc_id ELSE NULL END ELSE 'own ' || doc_id END AS abstract FROM papers", "papers"))
def _(spark, d):
    p = A.papers(spark, d).select("paper_id", "doc_id", F.when(F.col("doc_id") % 4 == 0, " ").otherwise(F.concat(F.lit("own "), F.col("doc_id").cast("string"))).alias("abstract"))
    got = p.where("doc_id % 8 = 0").select("paper_id", F.explode(F.array(F.struct(F.lit(0).alias("ord"), F.concat(F.lit("first "), F.col("doc_id").cast("string")).alias("abstract")), F.struct(F.lit(1).alias("ord"), F.concat(F.lit("second "), F.col("doc_id").cast("string")).alias("abstract")), F.struct(F.lit(2).alias("ord"), F.lit(" ").alias("abstract")))).alias("a")).select("paper_id", "a.*")
    return discovery.fill_abstracts(p.drop("doc_id"), got)


@query("batch_responses", sql("SELECT doc_id AS pos, paper_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'id' || doc_id WHEN doc_id % 3 = 1 THEN 'pos' || doc_id END AS payload, doc_id % 3 <> 2 AS found FROM papers", "papers"))
def _(spark, d):
    p = A.papers(spark, d)
    requests = p.select(F.col("doc_id").alias("pos"), F.col("paper_id").alias("id"))
    by_id = p.where("doc_id % 3 = 0").select("paper_id", F.concat(F.lit("id"), F.col("doc_id").cast("string")).alias("payload"), F.col("doc_id").alias("pos")).withColumnRenamed("paper_id", "id")
    by_pos = p.where("doc_id % 3 = 1").select(F.lit(None).cast("string").alias("id"), F.concat(F.lit("pos"), F.col("doc_id").cast("string")).alias("payload"), F.col("doc_id").alias("pos"))
    return discovery.responses(requests, by_id.unionByName(by_pos))


@query("cache_first_fetch", sql("SELECT paper_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'hit' ELSE 'new' END AS payload, CASE WHEN doc_id % 2 = 0 THEN 'cache' ELSE 'fetched' END AS origin FROM papers WHERE doc_id % 2 = 0 OR doc_id % 3 = 0", "papers"))
def _(spark, d):
    p = A.papers(spark, d).select(F.col("paper_id").alias("id"), "doc_id")
    hits, fetched = p.where("doc_id % 2 = 0").select("id", F.lit("hit").alias("payload")), p.where("doc_id % 3 = 0").select("id", F.lit("new").alias("payload"))
    return discovery.reunited(p.select("id"), hits, fetched)


@query("eligibility_cascade", sql("SELECT paper_id FROM papers WHERE doc_id % 2 = 0 AND doc_id % 3 <> 0 AND doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND doc_id % 4 <> 0", "papers"))
def _(spark, d):
    p = A.papers(spark, d).withColumn("title", F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("A Survey of "), F.col("doc_id").cast("string"))).otherwise("Code review of a survey"))
    return discovery.eligible(p.where("doc_id % 2 = 0"), p.where("doc_id % 3 <> 0"), p.where("doc_id % 5 <> 0"), p.where("doc_id % 7 <> 0")).select("paper_id")


@query("survey_title_filter", r"""SELECT doc_id, CASE WHEN regexp_matches(t, 'code review|pull request review|review agent benchmark|review effort|review fixing|review response') THEN false
  ELSE regexp_matches(t, '\bsurveys?\b|\b(?:comprehensive|systematic|literature|scoping)\s+review\b|\breview\s+(?:of|on)\b') END AS is_survey
  FROM (SELECT doc_id, (['a survey of x', 'review of y', 'code review of surveys', 'systematic  review', 'reviewing', 'surveying', 'survey'])[1 + doc_id % 7] AS t FROM documents)""")
def _(spark, d):
    titles = F.array(*map(F.lit, ["A Survey of X", "Review of Y", "Code Review of Surveys", "Systematic  Review", "Reviewing", "Surveying", "Survey"]))
    return table(spark, d, "documents").select("doc_id", text.is_survey_title(F.get(titles, (F.col("doc_id") % 7).cast("int"))).alias("is_survey"))


@query("work_queue", sql("SELECT paper_id FROM papers WHERE paper_id NOT IN (SELECT paper_id FROM papers WHERE doc_id % 3 = 0)", "papers"))
def _(spark, d):
    p = A.papers(spark, d)
    return discovery.not_done(p, p.where("doc_id % 3 = 0"), "paper_id").select("paper_id")


@query("chunk_assignment", sql("SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 50 AS chunk FROM papers", "papers"))
def _(spark, d):
    return discovery.chunks(A.papers(spark, d).select("source", "doc_id"), 50, ["doc_id"], "source").select("source", "doc_id", "chunk")


@query("query_budget", "WITH q AS (SELECT 'q' || (c_custkey // 3) AS q, 's' || c_custkey AS s, c_custkey AS ord FROM customer), a AS (SELECT q, min(ord) AS o FROM q GROUP BY q ORDER BY o LIMIT 5), b AS (SELECT s, ord FROM q ORDER BY ord LIMIT 3) SELECT (SELECT string_agg(q, ',' ORDER BY o) FROM a) AS queries, (SELECT string_agg(s, ',' ORDER BY ord) FROM b) AS survey_queries")
def _(spark, d):
    n = table(spark, d, "customer")
    pick = lambda p, m: F.array(F.concat(F.lit(p), F.floor(F.col("c_custkey") / m).cast("string")), F.lit("later"))
    plan = n.select(F.col("c_custkey").alias("ord"), pick("q", 3).alias("normal_queries"), pick("s", 1).alias("survey_queries"))
    return discovery.query_budget(plan).select(csv("queries").alias("queries"), csv("survey_queries").alias("survey_queries"))


@query("recent_months", "SELECT o_orderkey, array_to_string(list_transform(range(2, -1, -1), lambda i: strftime(date_trunc('month', o_orderdate) - to_months(cast(i AS INTEGER)), '%Y-%m')), ',') AS months FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", csv(scoring.recent_months(F.to_date("o_orderdate"), 3)).alias("months"))


@query("title_substring_match", sql("SELECT title, arg_min(name, ord) AS name FROM t JOIN (SELECT p_name || ' ' || p_brand AS name, p_partkey AS ord FROM part) ON contains(lower(name), lower(title)) GROUP BY title", t="SELECT DISTINCT p_name AS title FROM part"))
def _(spark, d):
    part = table(spark, d, "part")
    return matching.first_match(part.select(F.concat_ws(" ", "p_name", "p_brand").alias("name"), F.col("p_partkey").alias("ord")), part.select(F.col("p_name").alias("title")).distinct())


_GS = "SELECT paper_id, q AS query, CASE WHEN q = 0 OR doc_id % 2 = 0 THEN 'hub ' ELSE 'archive ' END || q AS abstract FROM papers, (VALUES (0), (1)) t(q) WHERE (doc_id + q) % 3 = 0 AND (q = 0 OR doc_id % 2 = 0 OR doc_id % 5 = 0)"


def _answers(spark, d) -> tuple[DataFrame, DataFrame]:
    p = A.papers(spark, d).select("paper_id", "doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("query")).where("(doc_id + query) % 3 = 0")
    q = F.col("query").cast("string")
    hub = p.where("query = 0 or doc_id % 2 = 0").select("query", F.col("doc_id").alias("ord"), F.to_json(F.struct(F.struct(F.col("paper_id").alias("id")).alias("paper"), F.concat(F.lit("hub "), q).alias("summary"))).alias("item"))
    archive = p.where("doc_id % 5 = 0").select("query", F.col("doc_id").alias("ord"), F.to_json(F.struct(F.concat("paper_id", F.lit("v2")).alias("arxiv_id"), F.struct(F.concat(F.lit("archive "), q).alias("summary")).alias("paper_summary"))).alias("item"))
    return hub, archive


@query("gap_search", sql("SELECT paper_id, arg_min(abstract, query) AS abstract, min(query) AS query FROM g GROUP BY paper_id HAVING 2026 - (2000 + cast(paper_id[1:2] AS INTEGER)) <= 6", "papers", g=_GS))
def _(spark, d):
    return search.gap_search(*_answers(spark, d), ["hub", "archive"], [], NOW)[0]


@query("gap_search_audit", sql("SELECT q AS query, count(*) FILTER (q = 0 OR doc_id % 2 = 0) AS hub, count(*) FILTER (doc_id % 5 = 0) AS archive, count(*) FILTER (q = 0 OR doc_id % 2 = 0 OR doc_id % 5 = 0) AS returned FROM papers, (VALUES (0), (1)) t(q) WHERE (doc_id + q) % 3 = 0 GROUP BY q", "papers"))
def _(spark, d):
    return search.gap_search(*_answers(spark, d), [], [], NOW)[1]


@query("bulk_search", sql(f"SELECT paper_id, v AS abstract FROM (SELECT paper_id, any_value(year) AS year, arg_max(v, p) AS v FROM (SELECT paper_id, year, 'a the' AS v, 0 AS p FROM papers WHERE doc_id % 2 = 0 UNION ALL SELECT paper_id, year, 'b', 1 FROM papers WHERE doc_id % 3 = 0 UNION ALL SELECT paper_id, year, 'the c', 2 FROM papers WHERE doc_id % 5 = 0) GROUP BY paper_id) WHERE contains(v, 'the') AND 2026 - year <= 6", "papers"))
def _(spark, d):
    p = A.papers(spark, d)
    parts = [p.where(F.col("doc_id") % n == 0).select("paper_id", F.lit(v).alias("abstract"), F.col("doc_id").alias("ord")) for v, n in (("a the", 2), ("b", 3), ("the c", 5))]
    return search.bulk_search(parts, KEYWORDS, NEGATIVES, NOW)


@query("relevance_search", sql(f"SELECT paper_id, {_IMPACT} AS score FROM papers ORDER BY score DESC, CASE WHEN doc_id % 2 = 0 THEN doc_id ELSE 4611686018427387904 END, paper_id LIMIT 1000", "papers"))
def _(spark, d):
    """Papers of even number are found, each cites the one behind it, so that every document is ranked; the report has a thousand."""
    p = A.papers(spark, d)
    found = p.where("doc_id % 2 = 0").select("paper_id", F.col("doc_id").alias("ord"))
    below = p.where("doc_id % 2 = 1").select((F.col("doc_id") - 1).alias("k"), F.col("paper_id").alias("id"))
    links = p.select(F.col("doc_id").alias("k"), F.col("paper_id").alias("paper")).join(below, "k").select("paper", "id", F.lit(5).alias("cites"), F.col("k").alias("ord"))
    return search.relevance_search(found, links, p.select("paper_id", "abstract", "year", "citations"), NOW, most=1000).select("paper_id", "score")


@query("service_rows", "SELECT page_id AS ord, 'p' || page_id AS paper_id, page_id % 7 AS citation_count, CASE WHEN page_id % 2 = 0 THEN 'x' ELSE '' END AS citations FROM pages")
def _(spark, d):
    k = F.col("page_id")
    item = F.to_json(F.struct(F.struct(F.concat(F.lit("p"), k.cast("string")).alias("ArXiv")).alias("externalIds"), F.when(k % 7 != 0, k % 7).alias("citationCount"), F.when(k % 2 == 0, F.array(F.struct(F.struct(F.lit("x").alias("ArXiv")).alias("externalIds")), F.struct(F.struct(F.lit("").alias("ArXiv")).alias("externalIds")))).alias("citations")))
    rows = search.paper_rows(table(spark, d, "pages").select(k.alias("ord"), item.alias("item")))
    return rows.select("ord", "paper_id", "citation_count", csv("citations").alias("citations"))


# ---- graphs ---------------------------------------------------------------------------------------------------------

_FE, _FN, _CL = "fragment_edges", "fragment_nodes", "claims"
_REASON = """SELECT *, array_to_string(list_filter([CASE WHEN coalesce(claim_id, '') = '' THEN 'missing claim_id' END, CASE WHEN confidence <> 'verified' THEN 'confidence is not verified' END,
    CASE WHEN (paper, src) NOT IN (SELECT paper, id FROM fragment_nodes) OR (paper, dst) NOT IN (SELECT paper, id FROM fragment_nodes) THEN 'edge endpoint missing from fragment nodes' END,
    CASE WHEN coalesce(node, '') = '' THEN 'missing source_node_id' END,
    CASE WHEN node IS NOT NULL AND (paper, node, array_to_string(lines, ',')) NOT IN (SELECT paper, node, array_to_string(lines, ',') FROM claims) THEN 'source_node_id + source_lines pair is not an exact Stage 10 claim source' END], lambda x: x IS NOT NULL), '; ') AS reasons FROM fragment_edges"""
_VALID = "SELECT * FROM rejected WHERE reasons = ''"


def _fragments(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    claims = A.by_paper(A.claims(spark, d))
    return A.fragment_edges(claims), A.fragment_nodes(claims), claims


@query("weak_graph_merge", sql("SELECT src, dst, type, confidence FROM (SELECT *, row_number() OVER (PARTITION BY src, dst, type ORDER BY file, ord, confidence) AS n FROM edges) WHERE n = 1", "edges"))
def _(spark, d):
    return graph.merge_weak_edges(A.graph_edges(spark, d), ["file", "ord", "confidence"]).select("src", "dst", "type", "confidence")


@query("weak_graph_nodes", sql("SELECT id, type, display FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) AS n FROM nodes) WHERE n = 1", "nodes"))
def _(spark, d):
    return graph.merge_nodes(A.graph_nodes(spark, d), ["ord"]).select("id", "type", "display")


@query("edge_reject_reasons", sql("SELECT paper, nth, reasons FROM rejected", _FE, _FN, rejected=_REASON))
def _(spark, d):
    return graph.reject_reasons(*_fragments(spark, d)).select("paper", "nth", "reasons")


@query("verified_edge_grounding", sql("SELECT src, dst, type, node, array_to_string(lines, ',') AS lines, paper, nth FROM (SELECT *, row_number() OVER (PARTITION BY src, dst, type, node, lines ORDER BY paper, nth) AS n FROM v) WHERE n = 1", _FE, _FN, rejected=_REASON, v=_VALID))
def _(spark, d):
    return graph.merge_verified(*_fragments(spark, d)).select("src", "dst", "type", "node", csv(F.col("lines").cast("array<string>")).alias("lines"), "paper", "nth")


@query("dangling_node_prune", sql("SELECT paper, id, type FROM fragment_nodes WHERE type = 'Paper' UNION ALL SELECT paper, id, type FROM fragment_nodes SEMI JOIN ends USING (paper, id) WHERE type <> 'Paper'", _FE, _FN, rejected=_REASON, v=_VALID, ends="SELECT paper, src AS id FROM v UNION SELECT paper, dst FROM v"))
def _(spark, d):
    e, n, c = _fragments(spark, d)
    return graph.prune_nodes(n, graph.valid_edges(e, n, c))


_NODE_KEY = r"trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9+#@._/-]+', ' ', 'g'), ' +', ' ', 'g'))"
_TYPES = ["INTRODUCES", "USES", "SOLVES", "EVALUATES_ON", "MEASURES_WITH", "HAS_RESULT", "HAS_LIMITATION", "COMPARES_TO", "IMPROVES_ON", "BELONGS_TO"]


@query("compile_claim_edges", sql(f"SELECT e.paper, e.claim_id, src, dst, e.type, c.node, array_to_string(c.lines, ',') AS lines FROM (SELECT paper, claim_id, {_NODE_KEY.format('src')} AS src, {_NODE_KEY.format('dst')} AS dst, type FROM fragment_edges WHERE claim_id IS NOT NULL) e JOIN claims c ON e.paper = c.paper AND e.claim_id = c.claim_id WHERE (e.paper, src) IN (SELECT paper, {_NODE_KEY.format('id')} FROM fragment_nodes) AND (e.paper, dst) IN (SELECT paper, {_NODE_KEY.format('id')} FROM fragment_nodes) AND e.type IN ('USES', 'HAS_RESULT')", _FE, _FN))
def _(spark, d):
    e, n, c = _fragments(spark, d)
    allowed = graph.frame_nodes(n.select("paper", F.col("id").alias("label"), "type", F.struct(F.col("type") != "Paper", "id").alias("ord")))
    return graph.compile_edges(e, graph.frame_claims(c), allowed, _TYPES).select("paper", "claim_id", "src", "dst", "type", "node", csv(F.col("lines").cast("array<string>")).alias("lines"))


_SPANS = "SELECT paper, node, min(lines[1]) + 3 AS start_line, max(lines[2]) AS end_line FROM claims GROUP BY paper, node"


def _spans(spark, d) -> DataFrame:
    return A.claims(spark, d).groupBy("paper", "node").agg((F.min(F.col("lines")[0]) + 3).alias("start_line"), F.max(F.col("lines")[1]).alias("end_line"))


@query("claims_within_section", sql("SELECT c.paper, nth, c.node FROM claims c JOIN sp USING (paper, node) WHERE lines[1] BETWEEN start_line AND end_line AND lines[2] BETWEEN start_line AND end_line", _CL, sp=_SPANS))
def _(spark, d):
    return graph.within_sections(A.claims(spark, d), _spans(spark, d)).select("paper", "nth", "node")


@query("graph_report", sql("SELECT (SELECT count(*) FROM (SELECT DISTINCT id FROM fragment_nodes)) AS nodes, (SELECT count(*) FROM (SELECT DISTINCT src, dst, type, node, lines FROM v)) AS verified_edges, greatest((SELECT count(*) FROM (SELECT DISTINCT src, dst, type FROM edges)) - (SELECT count(*) FROM (SELECT DISTINCT src, dst, type, node, lines FROM v)), 0) AS weak_not_promoted", _FE, _FN, "edges", rejected=_REASON, v=_VALID))
def _(spark, d):
    e, n, c = _fragments(spark, d)
    verified = graph.distinct_edges(graph.valid_edges(e, n, c), ["src", "dst", "type", "node", "lines"])
    return graph.report(n.select("id").distinct(), verified, graph.distinct_edges(A.graph_edges(spark, d), ["src", "dst", "type"]))


@query("graph_degree_centrality", sql("SELECT id, degree, round(degree / max(degree) OVER (), 6) AS centrality FROM (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY id)", "edges"))
def _(spark, d):
    return graph.degrees(A.graph_edges(spark, d)).select("id", "degree", F.round("centrality", 6).alias("centrality"))


@query("family_evidence_score", sql("SELECT a.paper AS method, b.family, CASE WHEN count(*) >= 2 OR max(l.family) IS NOT NULL THEN count(*) ELSE 0 END AS score FROM (SELECT DISTINCT paper, norm FROM mentions) a JOIN (SELECT DISTINCT importance AS family, norm FROM mentions WHERE field = 0) b USING (norm) LEFT JOIN (SELECT DISTINCT paper, importance AS family FROM mentions WHERE field = 1) l ON l.paper = a.paper AND l.family = b.family GROUP BY 1, 2", "mentions"))
def _(spark, d):
    m = durable(gaps.keyed(A.mention_rows(spark, d)).select("paper", "importance", "field", "norm"), "mentions")
    near, own = m.select(F.col("paper").alias("method"), F.col("norm").alias("neighbor")), m.where("field = 0").select(F.col("importance").alias("family"), F.col("norm").alias("method"))
    return outline.family_scores(near, own, m.where("field = 1").select(F.col("paper").alias("method"), F.col("importance").alias("family")))


# ---- promotion ------------------------------------------------------------------------------------------------------

_SCORES = "SELECT c_custkey AS ord, 'c' || c_custkey AS paper_id, 0.35::DOUBLE * (c_custkey % 10 / 10) + 0.20::DOUBLE * (c_nationkey / 24) + 0.15::DOUBLE * (ln(1 + c_custkey) / ln(10001)) + 0.10::DOUBLE * greatest(0.0, least(1.0, (2015 + c_nationkey % 12 - 2018) / 8.0::DOUBLE)) + 0.10::DOUBLE * (c_custkey % 3 / 2) + 0.10::DOUBLE * (c_custkey % 4 / 3) + least((c_custkey % 7)::DOUBLE / 10, 0.20::DOUBLE) AS final_score FROM customer"


def _scores(spark, d) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    score = scoring.final_score(k % 10 / 10, n, F.lit(24), k, 2015 + n % 12, k % 3 / 2, k % 4 / 3, (k % 7).cast("double") / 10)
    return table(spark, d, "customer").select(k.alias("ord"), F.concat(F.lit("c"), k.cast("string")).alias("paper_id"), score.alias("final_score"))


@query("final_scores", sql("SELECT paper_id, round(final_score, 6) AS final_score FROM s", s=_SCORES))
def _(spark, d):
    return _scores(spark, d).select("paper_id", F.round("final_score", 6).alias("final_score"))


@query("promoted_papers", sql("SELECT paper_id, round(final_score, 6) AS final_score FROM s WHERE final_score >= 0.45", s=_SCORES))
def _(spark, d):
    return promotion.promoted(_scores(spark, d)).select("paper_id", F.round("final_score", 6).alias("final_score"))


@query("promoted_fallback", sql("SELECT paper_id, round(final_score, 6) AS final_score FROM s ORDER BY s.final_score DESC, ord LIMIT 1", s=_SCORES))
def _(spark, d):
    return promotion.promoted(_scores(spark, d), threshold=9.0).select("paper_id", F.round("final_score", 6).alias("final_score"))


@query("score_issues", sql("SELECT 'error' AS severity, 'promotion_candidates_missing' AS code, paper_id AS detail FROM s WHERE ord % 50 = 0 UNION ALL SELECT 'error', 'wrongly_promoted', paper_id FROM s WHERE ord % 100 = 1 AND final_score < 0.45 UNION ALL SELECT 'error', 'not_promoted', paper_id FROM s WHERE final_score >= 0.45 AND ord % 100 <> 1", s=_SCORES))
def _(spark, d):
    s = _scores(spark, d)
    ordered = s.where("ord % 50 <> 0").select("paper_id", (-F.col("ord")).cast("double").alias("final_score"), "ord")
    return promotion.score_issues(s, ordered, s, s.where("ord % 100 = 1"))


# ---- pages and texts ------------------------------------------------------------------------------------------------

_MD = "SELECT conv_id AS paper, turn, coalesce(role, 'none') AS role, 3 + len(string_split(coalesce(text, ''), chr(10))) + 1 AS n FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL"


@query("page_nodes", sql("""SELECT paper, 's.01' AS id, 'conv ' || paper AS title, 1 AS level, 1 AS start_line, 2 + sum(n) AS end_line, 's.00' AS parent_id FROM md GROUP BY paper
  UNION ALL SELECT paper, 's.01.' || lpad(cast(k AS VARCHAR), 2, '0'), role, 2, 3 + before, 2 + before + n, 's.01' FROM o
  UNION ALL SELECT paper, 's.01.' || lpad(cast(k AS VARCHAR), 2, '0') || '.01', 'turn ' || turn, 3, 5 + before, 2 + before + n, 's.01.' || lpad(cast(k AS VARCHAR), 2, '0') FROM o""", md=_MD, o="SELECT *, row_number() OVER (PARTITION BY paper ORDER BY turn) AS k, coalesce(sum(n) OVER (PARTITION BY paper ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM md"))
def _(spark, d):
    return pages.sections(A.markdown(spark, d))


@query("section_text", sql("SELECT conv_id AS paper, 's.01.' || lpad(cast(k AS VARCHAR), 2, '0') || '.01' AS id, '### turn ' || turn || chr(10) || chr(10) || coalesce(text, '') AS section_text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)"))
def _(spark, d):
    docs = A.markdown(spark, d)
    return pages.with_text(pages.sections(docs).where("level = 3"), docs).select("paper", "id", "section_text")


@query("section_lookup", "SELECT conv_id AS paper, 's.01.' || lpad(cast(k AS VARCHAR), 2, '0') AS id FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL) WHERE role = 'assistant' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1")
def _(spark, d):
    docs = A.markdown(spark, d)
    return pages.find_section(pages.sections(docs), docs, "Assistant").select("paper", "id")


@query("tree_issues", sql("SELECT paper, id, 'missing_parent' AS code FROM (SELECT conv_id AS paper, 's.01.' || lpad(cast(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS VARCHAR), 2, '0') || '.01' AS id, turn FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL) WHERE ends_with(id, '.02.01')"))
def _(spark, d):
    return pages.tree_issues(pages.sections(A.markdown(spark, d)).where("not (level = 2 and id like '%.02')"))


_WORDS = r"[\p{L}\p{N}_]+"


@query("word_counts", f"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS words, (length(coalesce(text, '')) - length(replace(coalesce(text, ''), '|', ''))) AS bars FROM documents")
def _(spark, d):
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select("doc_id", text.word_count(t).alias("words"), (F.length(t) - F.length(F.replace(t, F.lit("|"), F.lit("")))).alias("bars"))


@query("heading_diff", "SELECT conv_id AS paper, array_to_string(list_filter(['## user', '## assistant', '## judge'], lambda h: NOT list_contains(hs, h)), ',') AS missing, array_to_string(list_filter(hs, lambda h: h NOT IN ('## user', '## assistant', '## judge')), ',') AS extra, list_filter(hs, lambda h: h IN ('## user', '## assistant', '## judge')) <> list_filter(['## user', '## assistant', '## judge'], lambda h: list_contains(hs, h)) AS out_of_order FROM (SELECT conv_id, list('## ' || coalesce(role, 'none') ORDER BY turn) AS hs FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id)")
def _(spark, d):
    diff = text.heading_diff("text", ["## user", "## assistant", "## judge"])
    return A.markdown(spark, d).withColumn("d", diff).select("paper", csv("d.missing").alias("missing"), csv("d.extra").alias("extra"), F.col("d.out_of_order").alias("out_of_order"))


@query("slug_ids", r"SELECT p_partkey, CASE WHEN s = '' THEN 'method' ELSE s END AS slug FROM (SELECT p_partkey, trim(substr(regexp_replace(trim(regexp_replace(lower('The ' || p_name || ' & ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-'), '^(?:a|an|the)-', ''), 1, 80), '-') AS s FROM part)")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", text.slug(F.concat(F.lit("The "), "p_name", F.lit(" & "), "p_brand")).alias("slug"))


@query("method_id_collisions", "SELECT p_partkey, CASE WHEN n = 1 THEN s ELSE s || '-' || n END AS unique_id FROM (SELECT p_partkey, replace(p_name, ' ', '-') AS s, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS n FROM part)")
def _(spark, d):
    rows = table(spark, d, "part").select("p_partkey", text.method_slug("p_name").alias("base"))
    return state.numbered(rows, "base", ["p_partkey"]).select("p_partkey", "unique_id")


@query("figure_scores", """SELECT p_partkey, 4 * len(list_intersect(w, ['architecture', 'framework', 'workflow', 'pipeline', 'algorithm', 'method', 'model', 'system', 'overview', 'training', 'inference', 'procedure']))
  + CASE WHEN regexp_matches(c, '\\bfigure\\s+(1|2)\\b') THEN 5 ELSE 0 END + CASE WHEN regexp_matches(c, 'overview|overall') THEN 3 ELSE 0 END
  - CASE WHEN len(list_intersect(w, ['architecture', 'framework', 'workflow', 'pipeline', 'algorithm', 'method', 'model', 'system', 'overview', 'training', 'inference', 'procedure'])) = 0 AND NOT regexp_matches(c, '\\bfigure\\s+(1|2)\\b|overview|overall') AND list_has_any(w, ['curve', 'score', 'results']) THEN 5 ELSE 0 END
  - CASE WHEN list_has_any(w, ['curve', 'score', 'results']) AND NOT list_has_any(w, ['architecture', 'framework', 'workflow', 'pipeline', 'algorithm', 'method', 'model', 'system', 'overview', 'training', 'inference', 'procedure']) THEN 2 ELSE 0 END
  - least(p_size, 10) AS score
  FROM (SELECT *, regexp_extract_all(c, '[a-z0-9]+') AS w FROM (SELECT p_partkey, p_size, lower((['Figure 1: Overview of the ', 'Training curve of ', 'Results: ', 'Our model and pipeline: ', 'Figure 12 '])[1 + p_partkey % 5] || p_name) AS c FROM part))""")
def _(spark, d):
    heads = F.array(*map(F.lit, ["Figure 1: Overview of the ", "Training curve of ", "Results: ", "Our model and pipeline: ", "Figure 12 "]))
    caption = F.concat(F.get(heads, (F.col("p_partkey") % 5).cast("int")), "p_name")
    return table(spark, d, "part").select("p_partkey", text.caption_score(caption, F.col("p_size")).alias("score"))


@query("title_case", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' for LLMs' AS title FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", text.title_case(F.concat("p_name", F.lit(" FOR llms"))).alias("title"))


@query("image_allow_list", "SELECT page_id, regexp_matches(u, '^https?://') AND (regexp_matches(lower(regexp_extract(u, '://[^/]*([^?#]*)', 1)), '\\.(png|jpe?g|gif|svg|webp)$') OR ends_with(lower(regexp_extract(u, '://([^/?#]*)', 1)), 'arxiv.org')) AS allowed FROM (SELECT page_id, (['https://a.b/c.PNG?x=1', 'ftp://a.b/c.png', 'https://export.arxiv.org/x', 'https://a.b/c.pdf', 'http://a.b/d.jpeg#f'])[1 + page_id % 5] AS u FROM pages)")
def _(spark, d):
    urls = F.array(*map(F.lit, ["https://a.b/c.PNG?x=1", "ftp://a.b/c.png", "https://export.arxiv.org/x", "https://a.b/c.pdf", "http://a.b/d.jpeg#f"]))
    return table(spark, d, "pages").select("page_id", quality.allowed_image(F.get(urls, (F.col("page_id") % 5).cast("int"))).alias("allowed"))


# ---- contracts ------------------------------------------------------------------------------------------------------


@query("duplicate_ids", "SELECT p_name AS id, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def _(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_name").alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("keep_all_diff", "SELECT 'error' AS severity, 'pool_missing' AS code, cast(o_orderkey AS VARCHAR) AS detail FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(spark, d):
    seed = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    return quality.same_set(seed, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")), "id", "pool")


@query("quality_issues_union", sql("SELECT 'error' AS severity, 'node_id_repeated' AS code, id AS detail FROM nodes GROUP BY id HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'error', 'edge_endpoint_unknown', x FROM (SELECT src AS x FROM edges UNION SELECT dst FROM edges) WHERE x NOT IN (SELECT id FROM nodes) UNION ALL SELECT 'error', 'weak:edge_not_verified', src || ' ' || dst FROM fragment_edges WHERE confidence <> 'verified' UNION ALL SELECT 'error', 'weak:edge_not_grounded', src || ' ' || dst FROM fragment_edges WHERE node IS NULL UNION ALL SELECT DISTINCT 'error', 'weak:edge_endpoint_unknown', x FROM (SELECT src AS x FROM fragment_edges UNION SELECT dst FROM fragment_edges) WHERE x NOT IN (SELECT id FROM fragment_nodes)", "edges", "nodes", _FE, _FN))
def _(spark, d):
    e, n, _c = _fragments(spark, d)
    verified = quality.verified_graph(n, e).withColumn("code", F.concat(F.lit("weak:"), F.col("code")))
    return quality.all_of(quality.weak_graph(A.graph_nodes(spark, d), A.graph_edges(spark, d)), verified)


@query("outline_issues", "SELECT 'error' AS severity, 'method_family_unknown' AS code, 'c' || c_custkey AS detail FROM customer WHERE c_nationkey >= 20 UNION ALL SELECT 'warning', 'family_without_method', cast(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey < 20 AND n_nationkey NOT IN (SELECT c_nationkey FROM customer) UNION ALL SELECT 'error', 'outline_papers_missing', 'c' || c_custkey FROM customer WHERE c_custkey % 40 = 0")
def _(spark, d):
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), "c_custkey", F.col("c_nationkey").cast("string").alias("family_id"))
    verified = c.select(F.col("id").alias("paper_id")).unionByName(c.where("c_custkey % 40 = 0").select(F.col("id").alias("paper_id")))
    families = table(spark, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("id"))
    return quality.outline(c.withColumn("paper_id", F.col("id")), families, verified)


@query("glossary_issues", "SELECT 'error' AS severity, CASE doc_id % 3 WHEN 0 THEN 'entry_without_term' WHEN 1 THEN 'definition_too_long' ELSE 'entry_without_place' END AS code, CASE doc_id % 3 WHEN 0 THEN 'short' ELSE 't' || doc_id END AS detail FROM documents WHERE doc_id % 5 = 0")
def _(spark, d):
    k = F.col("doc_id")
    bad = table(spark, d, "documents").where("doc_id % 5 = 0")
    rows = bad.select(F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("t"), k.cast("string"))).alias("term"), F.when(k % 3 == 1, F.repeat(F.lit("x"), F.lit(281))).otherwise("short").alias("definition"), F.when(k % 3 == 2, F.array().cast("array<string>")).otherwise(F.array(F.lit("a"))).alias("appears_in"))
    return quality.glossary(rows)


_CH = "SELECT doc_id, (['methods', 'families', 'book'])[1 + doc_id % 3] AS kind, doc_id % 10 <> 9 AS present, CASE WHEN doc_id % 8 = 1 THEN ['method_word_count_high'] WHEN doc_id % 8 = 2 THEN ['broken_link', 'family_word_count_high'] ELSE [] END AS fi, n_chars AS words, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)"
_STATUS = "CASE WHEN NOT present THEN 'excluded_missing_verification' WHEN doc_id % 8 = 2 THEN 'excluded_form_issues' WHEN kind = 'methods' AND words < 1500 OR kind = 'families' AND words < 1000 THEN 'excluded_too_short' WHEN quality = 1 THEN 'passed' WHEN coalesce(toxic, 0) > 0 THEN 'excluded_unsupported_claims' WHEN quality IS NULL AND doc_id % 2 = 0 THEN 'excluded_missing_evidence' WHEN doc_id % 8 = 1 THEN 'passed' ELSE 'excluded_verification_failed' END"


def _chapters(spark, d) -> DataFrame:
    k = F.col("doc_id")
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    forms = F.when(k % 8 == 1, F.array(F.lit("method_word_count_high"))).when(k % 8 == 2, F.array(F.lit("broken_link"), F.lit("family_word_count_high"))).otherwise(F.array().cast("array<string>"))
    kind = F.get(F.array(F.lit("methods"), F.lit("families"), F.lit("book")), (k % 3).cast("int"))
    status = quality.chapter_status(kind, k % 10 != 9, forms, F.col("n_chars"), F.col("quality") == 1, F.col("toxic"), F.lit(0), F.when(F.col("quality").isNull() & (k % 2 == 0), 1))
    return rows.select("doc_id", kind.alias("kind"), status.alias("status"))


@query("chapter_status", sql(f"SELECT doc_id, kind, {_STATUS} AS status FROM ch", ch=_CH))
def _(spark, d):
    return _chapters(spark, d)


@query("verification_summary", sql(f"SELECT kind, status, count(*) AS n FROM (SELECT kind, {_STATUS} AS status FROM ch) GROUP BY kind, status", ch=_CH))
def _(spark, d):
    return _chapters(spark, d).groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"))


@query("evidence_items_dropped", sql("SELECT claim_type AS field, count(*) AS dropped FROM claims c JOIN sp USING (paper, node) WHERE claim_type <> 'method' AND NOT (lines[1] BETWEEN start_line AND end_line AND lines[2] BETWEEN start_line AND end_line) GROUP BY claim_type", _CL, sp=_SPANS))
def _(spark, d):
    items = A.claims(spark, d).withColumnRenamed("claim_type", "field")
    return quality.dropped_per_field(items, quality.valid_items(items, _spans(spark, d).withColumnRenamed("node", "id"), ["result", "limitation"]))


# ---- state ----------------------------------------------------------------------------------------------------------


@query("cache_latest_upsert", sql("SELECT key, fetched_at, payload, status FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY fetched_at DESC, seq DESC) AS n FROM cache_puts) WHERE n = 1", "cache_puts"))
def _(spark, d):
    return state.latest(A.cache_puts(spark, d), ["key"], ["fetched_at", "seq"]).select("key", "fetched_at", "payload", "status")


@query("cache_ttl_valid", sql("SELECT key, seq FROM cache_puts WHERE fetched_at >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 7 DAY", "cache_puts"))
def _(spark, d):
    return state.valid(A.cache_puts(spark, d), F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'"), 7).select("key", "seq")


@query("cache_evict", sql("SELECT key, seq FROM cache_puts ORDER BY fetched_at DESC, seq DESC LIMIT 500", "cache_puts"))
def _(spark, d):
    return state.evict(A.cache_puts(spark, d), 500, ["fetched_at", "seq"]).select("key", "seq")


@query("cache_alias_lookup", sql("SELECT c_custkey AS request, arg_min(e.key, pos) AS entry_id FROM (SELECT c_custkey, unnest([c_custkey % 90, c_nationkey]) AS key, unnest([0, 1]) AS pos FROM customer) k JOIN (SELECT key, max(fetched_at) AS latest FROM cache_puts GROUP BY key) e ON k.key = e.key AND e.key % 3 <> 0 AND latest >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 30 DAY GROUP BY 1", "cache_puts"))
def _(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("request"), F.posexplode(F.array(F.col("c_custkey") % 90, F.col("c_nationkey").cast("long"))).alias("pos", "key"))
    entries = state.latest(A.cache_puts(spark, d), ["key"], ["fetched_at", "seq"]).select(F.col("key").alias("entry_id"), "payload", "fetched_at")
    aliases = entries.where("entry_id % 3 <> 0").select(F.col("entry_id").alias("key"), "entry_id")
    return state.lookup(keys, aliases, entries, F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'")).select("request", "entry_id")


@query("cache_statistics", sql("SELECT (SELECT count(DISTINCT key) FROM cache_puts) AS papers, (SELECT count(*) FROM cache_puts) AS aliases, (SELECT count(*) FROM cache_puts WHERE status = 'view') AS searches", "cache_puts"))
def _(spark, d):
    puts = A.cache_puts(spark, d)
    return state.statistics(puts.select("key").distinct(), puts, puts.where("status = 'view'"))


_ATT = "SELECT status AS stage, key AS shard_id, row_number() OVER (PARTITION BY status, key ORDER BY seq) AS attempt, payload FROM cache_puts"


def _attempts(spark, d) -> DataFrame:
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("status", "key").orderBy("seq"))
    return A.cache_puts(spark, d).select(F.col("status").alias("stage"), F.col("key").alias("shard_id"), nth.alias("attempt"), "payload")


@query("attempt_numbers", sql("SELECT 'view' AS stage, c_custkey AS shard_id, coalesce(m, 0) + 1 AS attempt FROM customer LEFT JOIN (SELECT shard_id, max(attempt) AS m FROM a WHERE stage = 'view' GROUP BY 1) ON c_custkey = shard_id", "cache_puts", a=_ATT))
def _(spark, d):
    shards = table(spark, d, "customer").select(F.lit("view").alias("stage"), F.col("c_custkey").alias("shard_id"))
    return state.next_attempts(_attempts(spark, d), shards)


@query("latest_manifest", sql("SELECT stage, shard_id, max(attempt) AS attempt, arg_max(payload, attempt) AS payload FROM a GROUP BY 1, 2", "cache_puts", a=_ATT))
def _(spark, d):
    return state.latest(_attempts(spark, d), ["stage", "shard_id"], ["attempt"])


@query("run_log_status_counts", "SELECT user_id % 10 AS stage, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS completed, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1")
def _(spark, d):
    status = F.when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed: x").otherwise("running")
    return state.status_counts(table(spark, d, "events").select((F.col("user_id") % 10).alias("stage"), status.alias("status")), ["stage"])


@query("turn_results", "SELECT conv_id AS turn_id, max(turn) AS usage, count(*) AS items, coalesce(arg_max(text, turn) FILTER (role = 'assistant' AND text IS NOT NULL), arg_max(text, turn) FILTER (role <> 'assistant' AND text IS NOT NULL)) AS answer FROM conversations GROUP BY conv_id")
def _(spark, d):
    c = table(spark, d, "conversations")
    said = c.select(F.col("conv_id").alias("turn_id"), F.col("turn").alias("seq"), F.lit("message").alias("kind"), F.when(F.col("role") == "assistant", "final_answer").alias("phase"), "text", F.lit(None).cast("long").alias("usage"))
    usage = c.select(F.col("conv_id").alias("turn_id"), F.col("turn").alias("seq"), F.lit("usage").alias("kind"), F.lit(None).cast("string").alias("phase"), F.lit(None).cast("string").alias("text"), F.col("turn").alias("usage"))
    return state.turn_results(said.unionByName(usage))


@query("settled_keys", "SELECT user_id AS key, arg_max(event_id, (ts, event_id)) AS signature FROM events GROUP BY user_id HAVING max(ts) <= (SELECT max(ts) FROM events) - INTERVAL 36000 SECOND")
def _(spark, d):
    events = table(spark, d, "events")
    changes = events.select(F.col("user_id").alias("key"), F.struct("ts", "event_id").alias("o"), F.col("ts").alias("at"), F.col("event_id").alias("signature"))
    newest = events.agg(F.max("ts")).first()[0]
    return state.settled(changes, 36000, F.lit(newest).cast("timestamp_ntz")).select("key", "signature")


@query("ranked_gaps", sql("SELECT norm AS concept, round(importance, 6) AS importance, array_to_string(list_slice(list_sort(in_slots), 1, 3), ',') AS evidence FROM cand WHERE reason IS NULL ORDER BY cand.importance DESC, norm LIMIT 10", *_GAP, **_ALL))
def _(spark, d):
    rows = _candidates(spark, d).where("reason is null").select(F.col("norm").alias("concept"), "importance", F.col("in_slots").alias("evidence_ids"))
    return state.ranked_gaps(rows).select("concept", F.round("importance", 6).alias("importance"), csv("evidence_ids").alias("evidence"))


@query("append_accepted", sql("SELECT paper_id, 'pool' AS status FROM papers WHERE doc_id % 2 = 0 UNION ALL SELECT paper_id, 'expansion' FROM papers WHERE doc_id % 3 = 0 AND doc_id % 2 <> 0", "papers"))
def _(spark, d):
    p = A.papers(spark, d)
    pool = p.where("doc_id % 2 = 0").select("paper_id", F.lit("pool").alias("status"))
    new = p.where("doc_id % 3 = 0").select("paper_id", F.lit("expansion").alias("status"))
    return pool.unionByName(discovery.not_done(new, pool, "paper_id"))


# ---- JSON and packs -------------------------------------------------------------------------------------------------


@query("json_safe_get", "SELECT event_id, json_extract_string(props, '$.k') AS k, 'none' AS missing FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", jsonx.safe_get(F.col("props"), "K").alias("k"), jsonx.safe_get(F.col("props"), "a.b.0", "none").alias("missing"))


@query("harvest_distinct_ordered", sql("SELECT raw AS name, min(cast(paper AS BIGINT)) AS ord FROM mention_rows WHERE field = 1 GROUP BY raw", "mention_rows"))
def _(spark, d):
    return packs.harvest(A.mention_rows(spark, d).where("field = 1").select(F.col("raw").alias("name"), F.col("paper").cast("long").alias("ord")))


@query("pack_references", sql("SELECT importance AS target, array_to_string(list_distinct_ord, ',') AS refs FROM (SELECT importance, list(paper ORDER BY k) AS list_distinct_ord FROM (SELECT importance, paper, min(cast(paper AS BIGINT)) AS k FROM mention_rows GROUP BY 1, 2) GROUP BY 1)", "mention_rows"))
def _(spark, d):
    rows = A.mention_rows(spark, d).select(F.col("importance").alias("target"), F.col("paper").cast("long").alias("ord"), "paper")
    return packs.references(rows).select("target", csv("references").alias("refs"))


@query("family_comparison", sql("SELECT paper, arg_min(text, nth) FILTER (claim_type = 'method') AS method, arg_min(text, nth) FILTER (claim_type = 'result') AS result, arg_min(text, nth) FILTER (claim_type = 'limitation') AS limitation FROM claims GROUP BY paper", _CL))
def _(spark, d):
    c = A.claims(spark, d)
    return packs.family_rows(c.select("paper").distinct(), c)


@query("pack_nodes_topk", sql("SELECT paper, claim_type AS kind, node, rank FROM (SELECT paper, claim_type, node, row_number() OVER (PARTITION BY paper, claim_type ORDER BY min(nth), node) AS rank FROM claims GROUP BY 1, 2, 3) WHERE rank <= 2", _CL))
def _(spark, d):
    return packs.first_nodes(A.claims(spark, d).withColumnRenamed("claim_type", "kind"), 2).select("paper", "kind", "node", "rank")


@query("stream_latest")
def _(spark, d):
    """The batch form of the fold that ``streaming.folds.latest`` keeps up to date."""
    return state.latest(A.cache_puts(spark, d), ["key"], ["fetched_at", "seq"]).select("key", "seq", "status")


ORACLES["stream_latest"] = sql("SELECT key, seq, status FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY fetched_at DESC, seq DESC) AS n FROM cache_puts) WHERE n = 1", "cache_puts")


from . import answers, book, increments, landed, services, site  # noqa: E402, F401  they register further queries

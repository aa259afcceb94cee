"""Queries whose answers SQL states outright: inputs are made from the keys of whole tables, so that each answer is a formula of the key.

They cover functions that SQL itself could hardly compute: repairs of JSON and markup, sentences of a text, greedy choices, merges.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import json as jsonx
from ..functions import math, scoring, text
from ..operators import discovery, outline, packs, pages, promotion, quality, search, state
from ..sources import adapter as A
from ..sources.adapter import table
from ..sources.landing import folder
from ..streaming import folds
from .registry import ORACLES, QUERIES, query


def _k(spark, d, source: str = "supplier", key: str = "s_suppkey") -> DataFrame:
    return table(spark, d, source).select(F.col(key).alias("k"), F.col(key).cast("string").alias("s"))


def _cases(n: int, *values) -> F.Column:
    """The value at k modulo n."""
    out = None
    for i, v in enumerate(values):
        v = F.lit(v) if isinstance(v, str) else v
        out = F.when(F.col("k") % n == i, v) if out is None else out.when(F.col("k") % n == i, v)
    return out


def cat(*parts) -> F.Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])




@query("json_repair", r"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"a": ' || event_id || ', "b": "\\alpha"}' WHEN 1 THEN '{"b": [' || event_id || ', null]}' WHEN 2 THEN '"\n"' END AS json FROM events""")
def _(spark, d):
    raw = _cases(4, cat('Here:\n```json\n{"b": "\\alpha", "a": ', F.col("s"), "}\n```"), cat('  {"b": [', F.col("s"), ", null]} "), '"\\n"', cat("{broken ", F.col("s")))
    return _k(spark, d, "events", "event_id").select(F.col("k").alias("event_id"), jsonx.repair_json(raw).alias("json"))


@query("math_sanitize", r"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '$x_' || p_partkey || '$ and $$ a $b$ c $$' || chr(10) || '`\(code\)`' WHEN 1 THEN '$$' || chr(10) || 'a ' || p_partkey || ' b' || chr(10) || '$$'
    WHEN 2 THEN '$$' || chr(10) || 'r=' || p_partkey || ', (1)' || chr(10) || '$$' || chr(10) || '\mathrm{Pass} \text{Fail to} \texttt{v\_' || p_partkey || '}' ELSE '```' || chr(10) || '\(x_' || p_partkey || '\)' || chr(10) || '```' END AS text, p_partkey % 4 IN (0, 1) AS bad FROM part""")
def _(spark, d):
    raw = _cases(4, cat("\\(x_", F.col("s"), "\\) and $$ a $b$ c $$\n`\\(code\\)`"), cat("$$ $a$ ", F.col("s"), " $b$ $$"), cat("$$\n$r=", F.col("s"), ",$ (1)\n$$\n\\textsc{Pass} \\textsc{Fail to} \\texttt{v_", F.col("s"), "}"), cat("```\n\\(x_", F.col("s"), "\\)\n```"))
    seen = F.when(F.col("k") % 4 == 2, F.lit("plain")).otherwise(raw)
    return _k(spark, d, "part", "p_partkey").select(F.col("k").alias("p_partkey"), math.math_normalised(raw).alias("text"), math.bad_math(seen).alias("bad"))


@query("heading_once", "SELECT s_suppkey AS k, CASE s_suppkey % 2 WHEN 0 THEN '---' || chr(10) || 'title: \"T ' || s_suppkey || '\"' || chr(10) || '---' || chr(10) || chr(10) || 'body' ELSE '---' || chr(10) || 'title: T' || chr(10) || '---' || chr(10) || '# Other' || chr(10) || 'body' END AS text, s_suppkey % 2 = 0 AS repeated FROM supplier")
def _(spark, d):
    raw = _cases(2, cat('---\ntitle: "T ', F.col("s"), '"\n---\n# T  ', F.col("s"), "\n\nbody"), "---\ntitle: T\n---\n# Other\nbody")
    return _k(spark, d).select("k", math.heading_once(raw).alias("text"), math.repeated_heading(raw).alias("repeated"))


@query("section_summary", "SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN 'It begins here and ends in line ' || s_suppkey || '.' WHEN 1 THEN rtrim(substr(repeat('word' || s_suppkey || ' ', 80), 1, 240)) ELSE 'No end ' || s_suppkey END AS summary FROM supplier")
def _(spark, d):
    lines = _cases(3, F.array(F.lit("# Head"), F.lit("  It begins here"), F.lit(""), cat("and ends in line ", F.col("s"), ". Then more.")), F.array(F.lit("## Head"), F.repeat(cat("word", F.col("s"), " "), F.lit(80))), F.array(cat("No end ", F.col("s"))))
    return _k(spark, d).select("k", text.mechanical_summary(lines).alias("summary"))


@query("sentences_topk", "SELECT s_suppkey AS paper, n AS nth, CASE n WHEN 1 THEN 'Here is the first sentence of ' || s_suppkey || ' that is long enough.' ELSE 'Another one follows it, number ' || s_suppkey || ' as well!' END AS sentence FROM supplier, (VALUES (1), (2)) AS t(n)")
def _(spark, d):
    body = cat("# Head\nFigure: no sentence at all here.\n**Table 1 is none either.**\n| a | b |\nShort Title\nAbstract\nHere is the first sentence of ", F.col("s"), " that is long enough. Too short. HERE is the FIRST sentence of ", F.col("s"), " that is long enough.\nAnother one follows it, number ", F.col("s"), " as well! A third one is beyond the limit, surely.")
    return packs.picked_sentences(_k(spark, d).select(F.col("k").alias("paper"), body.alias("text")), 2)


_PLAN = ", ".join(f"({i}, '{s}', {p}, '{kind}', {n})" for i, s in enumerate(packs.SECTIONS) for p, (kinds, n) in enumerate(packs.SOURCES[s]) for kind in kinds) + "".join(f", ({i}, '{s}', 9, '*', 1)" for i, s in enumerate(packs.SECTIONS) if s not in packs.REQUIRED)
_SOURCES = f"""SELECT paper, section_ord, section, node, rank FROM (SELECT *, row_number() OVER (PARTITION BY paper, section_ord ORDER BY nth, node) AS rank FROM (
    SELECT paper, section_ord, section, preference, most, node, min(nth) AS nth, min(preference) OVER (PARTITION BY paper, section_ord) AS best
    FROM (SELECT paper, kind, nth, node FROM claims, LATERAL (VALUES ('claims/' || claim_type), ('*')) AS t(kind)) i JOIN (VALUES {_PLAN}) AS p(section_ord, section, preference, kind, most) USING (kind) GROUP BY paper, section_ord, section, preference, most, node)
  WHERE preference = best) WHERE rank <= most"""


def _sources(spark, d) -> tuple[DataFrame, DataFrame]:
    c = A.by_paper(A.claims(spark, d))
    return packs.section_sources(c.withColumn("kind", F.concat(F.lit("claims/"), F.col("claim_type")))), c


@query("pack_section_sources", A.sql("SELECT paper, section, node, rank FROM src", "claims", src=_SOURCES))
def _(spark, d):
    return _sources(spark, d)[0].select("paper", "section", "node", "rank")


@query("pack_method_json", A.sql("""SELECT paper, (SELECT string_agg(section || ':' || nodes, ';' ORDER BY section_ord) FROM (SELECT section_ord, section, string_agg(node || '=' || t, '|' ORDER BY rank) AS nodes FROM (SELECT s.*, n.t FROM src s JOIN nt n ON n.paper = s.paper AND n.node = s.node WHERE s.paper = c.paper) GROUP BY 1, 2)) AS plan,
    coalesce(string_agg(text, ';' ORDER BY nth) FILTER (claim_type = 'limitation'), '') AS limitations FROM claims c GROUP BY paper""", "claims", src=_SOURCES, nt="SELECT paper, node, arg_min(text, nth) AS t FROM claims GROUP BY paper, node"))  # fmt: skip
def _(spark, d):
    sources, c = _sources(spark, d)
    nodes = c.groupBy("paper", F.col("node").alias("id")).agg(F.min_by("text", "nth").alias("section_text")).withColumn("summary", F.lit(""))
    pack = packs.json_pack(packs.method_packs(packs.node_text(sources, nodes), c))
    kind = "struct<paper:string,section_plan:array<struct<section_ord:int,section:string,source_nodes:array<struct<rank:int,node:string,section_text:string>>>>,structured:map<string,array<string>>>"
    rows = packs.method_packs(packs.node_text(sources, nodes), c).select(F.from_json(pack, kind).alias("p")).select("p.*")
    plan = F.array_join(F.transform("section_plan", lambda s: F.concat(s["section"], F.lit(":"), F.array_join(F.transform(s["source_nodes"], lambda n: F.concat(n["node"], F.lit("="), n["section_text"])), "|"))), ";")
    return rows.select("paper", plan.alias("plan"), F.coalesce(F.array_join(F.try_element_at("structured", F.lit("limitation")), ";"), F.lit("")).alias("limitations"))


@query("pack_complete", "SELECT s_suppkey AS paper FROM supplier WHERE s_suppkey % 3 = 0")
def _(spark, d):
    node = lambda t: F.array(F.struct(F.lit(1).alias("rank"), F.lit("n").alias("node"), t.alias("section_text")))
    plan = F.array(*[F.struct(F.lit(i).alias("section_ord"), F.lit(s).alias("section"), node(F.when((F.col("k") % 3 == 1) & F.lit(s == "Theory"), " ").otherwise("text")).alias("source_nodes")) for i, s in enumerate(packs.REQUIRED)])
    rows = _k(spark, d).select(F.col("k").alias("paper"), F.when(F.col("k") % 3 == 2, F.slice(plan, 1, 3)).otherwise(plan).alias("section_plan"))
    return packs.complete(rows).select("paper")


@query("gap_scope_greedy", "SELECT s_suppkey AS paper, CASE s_suppkey % 4 WHEN 0 THEN 'small ring' WHEN 1 THEN 'small ring,ring' WHEN 2 THEN 'own gap' ELSE '' END AS gap_scope FROM supplier")
def _(spark, d):
    evidence = _cases(4, cat("A Small  Rings' case ", F.col("s")), cat("a small ring and another ring ", F.col("s")), "small ring", "boring gearbox, sprung")
    rows = _k(spark, d).select(F.col("k").alias("paper"), F.when(F.col("k") % 4 == 2, F.array(F.lit("own gap"))).otherwise(F.array().cast("array<string>")).alias("explicit"), evidence.alias("evidence"))
    return packs.gap_scopes(rows, ["ring", "small ring", "gear"]).select("paper", F.array_join("gap_scope", ",").alias("gap_scope"))


@query("singleton_merge", "SELECT 'o' || s_suppkey AS outline_id, CASE s_suppkey % 4 WHEN 0 THEN 'fa' WHEN 1 THEN 'fb' WHEN 2 THEN 'standalone' ELSE 'fb' END AS family, CASE WHEN s_suppkey % 4 = 2 THEN 3 ELSE 2 END AS families FROM supplier")
def _(spark, d):
    """Two families of two and three methods and one of a single method, whose neighbours decide where it goes."""
    near = _cases(4, '["a1","a2"]', '["b1","b2","a1","a2","b3"]', '["a1"]', '["b1"]')
    linked = _cases(4, "[]", "[]", '["fb"]', '["fb"]')
    method = lambda i: f'{{"id":"{i}","family_id":"f{i[0]}"}}'
    doc = cat('{"families":[{"id":"fa","method_ids":["a1","a2"]},{"id":"fb","method_ids":["b1","b2","b3"]},{"id":"fc","method_ids":["c1"],"neighbor_family_ids":', linked, '}],"methods":[' + ",".join(method(i) for i in ("a1", "a2", "b1", "b2", "b3")) + ',{"id":"c1","family_id":"fc","neighbor_method_ids":', near, '}],"parts":[{"id":"p","family_ids":["fa","fb","fc"]}]}')
    rows = outline.merge_all(_k(spark, d).select(cat("o", F.col("s")).alias("outline_id"), doc.alias("outline")))
    return rows.select("outline_id", F.get_json_object("outline", "$.methods[5].family_id").alias("family"), F.json_array_length(F.get_json_object("outline", "$.families")).alias("families"))


# ---- contracts ------------------------------------------------------------------------------------------------------------


def _violations(rows: list[tuple[str, str]]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('error', '{c}', '{x}')" for c, x in rows) + ") AS t(severity, code, detail)"


@query("search_plan_issues", _violations([("aspect_count", "25")]) + " UNION ALL SELECT 'error', 'aspect_without_id', '' FROM nation WHERE n_nationkey % 5 = 1 UNION ALL SELECT 'error', 'aspect_without_normal_queries', CASE WHEN n_nationkey % 5 = 1 THEN ' ' ELSE n_name END FROM nation WHERE n_nationkey % 4 = 2 UNION ALL SELECT 'error', 'aspect_without_positive_keywords', CASE WHEN n_nationkey % 5 = 1 THEN ' ' ELSE n_name END FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT 'error', 'aspect_without_survey_queries', CASE WHEN n_nationkey % 5 = 1 THEN ' ' ELSE n_name END FROM nation WHERE n_nationkey % 7 = 0 UNION ALL SELECT 'error', 'too_many_normal_queries', cast(2 * count(*) AS VARCHAR) FROM nation WHERE n_nationkey % 4 <> 2")
def _(spark, d):
    n = table(spark, d, "nation").withColumn("k", F.col("n_nationkey"))
    words = F.array(F.lit("a"), F.lit(" a "), cat("b", "c"))
    plan = n.select(
        F.when(F.col("k") % 5 == 1, " ").otherwise(F.col("n_name")).alias("aspect_id"),
        F.when(F.col("k") % 4 == 2, F.array(F.lit(" "))).otherwise(words).alias("normal_queries"),
        F.when(F.col("k") % 7 != 0, F.array().cast("array<string>")).alias("survey_queries"),
        F.when(F.col("k") % 3 != 0, words).alias("positive_keywords"),
    )
    return quality.search_plan(plan, {"normal_queries": 5, "survey_queries": 3})


@query("keep_all_issues", "WITH s AS (SELECT 'a' || s_suppkey AS id, s_suppkey AS k FROM supplier), x AS (SELECT 'pool_missing' AS code, id, k % 10 = 3 AS hit FROM s UNION ALL SELECT 'mirror_missing', id, k % 9 = 1 AND k % 10 <> 3 FROM s UNION ALL SELECT 'raw_missing', id, k % 20 = 5 FROM s UNION ALL SELECT 'mirror_repeated', id, k = 2 FROM s) SELECT 'error' AS severity, code, string_agg(id, ',' ORDER BY id) AS detail FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY id) AS n FROM x WHERE hit) WHERE n <= 10 GROUP BY code UNION ALL VALUES ('error', 'raw_extra', 'extra'), ('error', 'raw_kept_differs', '7') UNION ALL SELECT 'error', 'pool_too_small', cast(count(*) AS VARCHAR) FROM s WHERE k % 10 <> 3 HAVING count(*) < 40")
def _(spark, d):
    seeds = _k(spark, d).select(cat("a", F.col("s")).alias("paper_id"), "k")
    one = lambda x: spark.createDataFrame([(x,)], "paper_id string")
    raw = seeds.where("k % 20 <> 5").select("paper_id").unionByName(one("extra"))
    pool = seeds.where("k % 10 <> 3")
    mirror = pool.where("k % 9 <> 1").select("paper_id").unionByName(one("a2"))
    report = seeds.agg(F.count(F.lit(1)).alias("total_kept")).select("total_kept", F.col("total_kept").alias("selected_total"), F.lit(7).cast("long").alias("raw_kept"), F.lit(quality.KEEP_ALL).alias("selection_policy"))
    return quality.keep_all(seeds.select("paper_id"), raw, pool.select("paper_id"), mirror, report)


@query("bootstrap_issues", "WITH s AS (SELECT 'a' || s_suppkey AS id, s_suppkey AS k FROM supplier) SELECT 'error' AS severity, code, id AS detail FROM (SELECT id, 'no_reader_needed_concepts' AS code FROM s WHERE k % 7 = 1 UNION ALL SELECT id, 'text_missing' FROM s WHERE k % 2 = 0 AND k % 5 = 1 AND k % 3 <> 0 UNION ALL SELECT id, 'index_missing' FROM s WHERE k % 2 = 0 AND k % 5 <> 1 AND k % 11 = 4 UNION ALL SELECT id, 'no_claims' FROM s WHERE k % 2 = 0 AND k % 5 <> 1 AND k % 13 = 2 UNION ALL SELECT id, 'claim_not_grounded' FROM s WHERE k % 2 = 0 AND k % 5 <> 1 AND k % 13 = 4)")
def _(spark, d):
    s = _k(spark, d).select(cat("a", F.col("s")).alias("paper_id"), "k")
    words = F.array().cast("array<string>")
    weak = s.select("paper_id", F.when(F.col("k") % 7 == 1, words).otherwise(F.array(F.lit("x"))).alias("reader_needed_concepts"))
    promoted = s.where("k % 2 = 0").select("paper_id")
    claims = s.where("k % 13 <> 2").select("paper_id", F.lit("s.1").alias("node"), F.when(F.col("k") % 13 != 4, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")).alias("lines"))
    ids = lambda where: s.where(where).select("paper_id")
    return quality.bootstrap(s.select("paper_id"), weak, promoted, ids("k % 5 <> 1"), ids("k % 3 = 0"), ids("k % 11 <> 4"), claims)


@query("gap_output_issues", "WITH s AS (SELECT 'c' || s_suppkey AS id, s_suppkey AS k FROM supplier) SELECT 'error' AS severity, code, detail FROM (SELECT 'concept_not_in_digest' AS code, id AS detail FROM s WHERE k % 4 = 1 UNION ALL SELECT 'queue_too_long', cast(count(*) AS VARCHAR) FROM s UNION ALL SELECT 'priority_too_low', id FROM s WHERE k % 3 = 2 UNION ALL SELECT 'too_few_queries', id FROM s WHERE k % 5 = 0)")
def _(spark, d):
    s = _k(spark, d).withColumn("concept", cat("c", F.col("s")))
    queue = s.select("concept", F.when(F.col("k") % 3 == 2, 0.5).otherwise(0.7).alias("priority"), F.when(F.col("k") % 5 == 0, F.array(F.lit("q"))).otherwise(F.array(F.lit("q"), F.lit("r"))).alias("search_queries"))
    return quality.gap_outputs(queue, s.where("k % 4 <> 1").select("concept"))


@query("expansion_issues", "WITH s AS (SELECT 'a' || s_suppkey AS id, s_suppkey AS k FROM supplier) SELECT 'error' AS severity, code, id AS detail FROM (SELECT 'accepted_not_in_pool' AS code, id FROM s WHERE k % 4 < 2 AND k % 3 = 0 UNION ALL SELECT 'accepted_without_gap', id FROM s WHERE k % 4 < 2 AND k % 5 = 1 UNION ALL SELECT 'accepted_without_reason', id FROM s WHERE k % 4 < 2 AND k % 7 = 2 UNION ALL SELECT 'unknown_status', id FROM s WHERE k % 4 = 3)")
def _(spark, d):
    s = _k(spark, d).withColumn("paper_id", cat("a", F.col("s")))
    rows = s.select("paper_id", _cases(4, "accepted", "accepted", "rejected", "maybe").alias("status"), F.when(F.col("k") % 5 != 1, "g").alias("gap_id"), F.when(F.col("k") % 7 == 2, " ").otherwise("why").alias("why_needed"))
    return quality.expansion_outputs(rows, s.where("k % 3 <> 0").select("paper_id"))


@query("artifact_issues", "SELECT 'error' AS severity, 'artifact_missing' AS code, n_nationkey || ' out/' || n_name AS detail FROM nation WHERE n_regionkey = 2")
def _(spark, d):
    n = table(spark, d, "nation")
    stages = n.select(F.col("n_nationkey").alias("stage"), cat("out/", F.col("n_name")).alias("path"))
    return quality.artifacts_present(stages, n.where("n_regionkey <> 2").select(cat("out/", F.col("n_name")).alias("path")))


@query("katex_issues", "SELECT 'error' AS severity, 'katex_error' AS code, 'p' || page_id AS detail FROM pages WHERE page_id % 3 = 0")
def _(spark, d):
    p = table(spark, d, "pages").select(F.col("page_id").alias("k"), cat("p", F.col("page_id").cast("string")).alias("page"), "html")
    return quality.katex_errors(p.select("page", cat(F.coalesce("html", F.lit("")), F.when(F.col("k") % 3 == 0, '<span class="katex-error">').otherwise("")).alias("html")))


# ---- discovery, packs, state ------------------------------------------------------------------------------------------------


@query("citation_thresholds", "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 5 WHEN s_suppkey % 2 = 0 THEN 9 ELSE 0 END AS least FROM supplier")
def _(spark, d):
    return _k(spark, d).select("k", discovery.citation_threshold(F.when(F.col("k") % 3 == 0, 5), F.when(F.col("k") % 2 == 0, 9)).alias("least"))


@query("roots_with_details", "SELECT 'a' || s_suppkey AS paper_id, CASE WHEN s_suppkey % 2 = 0 THEN 'detail ' || s_suppkey ELSE 'row ' || s_suppkey END AS title, s_suppkey AS ord FROM supplier")
def _(spark, d):
    s = _k(spark, d).select(cat("a", F.col("s")).alias("paper_id"), cat("row ", F.col("s")).alias("title"), F.col("k").alias("ord"), "k")
    details = s.where("k % 2 = 0").select("paper_id", cat("detail ", F.col("k").cast("string")).alias("title"))
    return discovery.rooted(s.drop("k"), details)


@query("relevance_judged", "SELECT doc_id FROM documents WHERE doc_id % 3 = 0")
def _(spark, d):
    def judge(frame: pd.DataFrame):
        return [*frame["doc_id"][frame["doc_id"] % 3 == 0], -1]  # an id that it invents is ignored

    return discovery.relevance_gate(table(spark, d, "documents").select("doc_id"), judge, "doc_id", 50)


@query("relevance_fail_closed", "SELECT doc_id FROM documents WHERE doc_id < 0")
def _(spark, d):
    def judge(frame: pd.DataFrame):
        raise RuntimeError("unreachable service")

    return discovery.relevance_gate(table(spark, d, "documents").select("doc_id"), judge, "doc_id", 50, fail_open=False)


@query("metadata_batch", "SELECT s_suppkey AS pos, 'a' || s_suppkey AS id, CASE WHEN s_suppkey % 3 <> 1 THEN 'first' END AS title, CASE WHEN s_suppkey % 3 <> 1 THEN 2020 END AS year, s_suppkey % 3 <> 1 AS found FROM supplier")
def _(spark, d):
    s = _k(spark, d)
    asked = s.select(F.col("k").alias("pos"), cat("a", F.col("s")).alias("id"))
    held = s.where("k % 3 <> 1").select(cat("a", F.col("s")).alias("paper_id"), F.explode(F.array(F.struct(F.lit(2).alias("ord"), F.lit("second").alias("title")), F.struct(F.lit(1).alias("ord"), F.lit("first").alias("title")))).alias("x"))
    papers = held.select("paper_id", "x.title", F.lit(2020).alias("year"), F.lit("t").alias("abstract"), "x.ord")
    return search.metadata_batch(asked, papers).drop("abstract")


@query("aliases_repointed", "SELECT s_suppkey AS key, CASE WHEN s_suppkey % 2 = 0 THEN 'new' ELSE 'old' END || s_suppkey AS entry_id FROM supplier")
def _(spark, d):
    s = _k(spark, d)
    return state.repointed(s.select(F.col("k").alias("key"), cat("old", F.col("s")).alias("entry_id")), s.where("k % 2 = 0").select(F.col("k").alias("key"), cat("new", F.col("s")).alias("entry_id")))


@query("candidates_rebuilt", "SELECT s_suppkey AS paper_id, (s_suppkey % 50) / 100.0 AS final_score FROM supplier")
def _(spark, d):
    scores = _k(spark, d).select(F.col("k").alias("paper_id"), ((F.col("k") % 50) / F.lit(100.0)).alias("final_score"), F.col("k").alias("ord"))
    return promotion.rebuilt_candidates(scores, scores.select("paper_id"), ["paper_id", "final_score"])


@query("rewrites_spliced", "SELECT 'm' || s_suppkey AS chapter_id, CASE WHEN s_suppkey % 6 = 0 THEN 'new' ELSE 'old' END AS text FROM supplier")
def _(spark, d):
    s = _k(spark, d).withColumn("chapter_id", cat("m", F.col("s")))
    return packs.spliced(s.select("chapter_id", F.lit("old").alias("text")), s.where("k % 2 = 0").select("chapter_id", F.lit("new").alias("text")), s.select("chapter_id", (F.col("k") % 3 == 0).alias("passed")))


@query("figures_chosen", "SELECT s_suppkey AS paper, 'https://x.org/b' || s_suppkey || '.png' AS source_url, 'Overview of the framework in Figure 1' AS caption, 2 AS line FROM supplier")
def _(spark, d):
    body = cat("![Accuracy curve](https://x.org/a", F.col("s"), ".png)\n![Overview  of the framework in Figure 1](https://x.org/b", F.col("s"), ".png) text\n![none](ftp://x.org/c.png)\n![Overview  of the framework in Figure 1](https://x.org/b", F.col("s"), ".png)")
    rows = packs.figure_candidates(_k(spark, d).select(F.col("k").alias("paper"), body.alias("text")))
    return packs.best_figures(rows).select("paper", "source_url", "caption", "line")


@query("chapter_drafts", "SELECT cast(s_suppkey AS VARCHAR) AS paper, '## Summary' || chr(10) || chr(10) || 'One. Two. [arxiv:' || s_suppkey || ', n1]' || chr(10) || chr(10) || '## Theory' || chr(10) || chr(10) || 'Three. [arxiv:' || s_suppkey || ', n2]' AS text, false AS long_enough FROM supplier")
def _(spark, d):
    rows = [(0, "Summary", 1, "One.", "n1"), (0, "Summary", 2, "Two.", "n1"), (1, "Theory", 1, "Three.", "n2")]
    each = F.explode(F.array(*[F.struct(F.lit(o).alias("section_ord"), F.lit(t).alias("section"), F.lit(n).alias("nth"), F.lit(x).alias("sentence"), F.lit(z).alias("node")) for o, t, n, x, z in rows])).alias("r")
    return packs.chapter_text(_k(spark, d).select(F.col("s").alias("paper"), each).select("paper", "r.*")).select("paper", "text", "long_enough")


@query("section_bodies", "SELECT s_suppkey AS paper, CASE t WHEN 1 THEN 'a' ELSE 'b ' || s_suppkey END AS title, CASE t WHEN 1 THEN 'one' || chr(10) || 'three ' || s_suppkey ELSE 'two' END AS body FROM supplier, (VALUES (1), (2)) AS x(t)")
def _(spark, d):
    body = cat("# T\nlost\n## A\none\n## B ", F.col("s"), "\ntwo\n\n## a:\nthree ", F.col("s"), "\n")
    return pages.section_map(_k(spark, d).select(F.col("k").alias("paper"), body.alias("text")))


# ---- small functions --------------------------------------------------------------------------------------------------------


@query("month_values", "SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN '2024-03' WHEN 1 THEN '2021-' || lpad(cast(s_suppkey % 12 + 1 AS VARCHAR), 2, '0') END AS month FROM supplier")
def _(spark, d):
    value = _cases(4, "2024-3", (F.col("k") % 12 + 1).cast("string"), "13", "2024-00")
    return _k(spark, d).select("k", scoring.month(value, F.lit(2021)).alias("month"))


@query("request_limits", "SELECT s_suppkey AS k, least(s_suppkey + 1, 50) AS n FROM supplier")
def _(spark, d):
    return _k(spark, d).select("k", scoring.limited(F.col("k") + 1, 50).alias("n"))


@query("placeholders_found", "SELECT s_suppkey AS k, s_suppkey % 4 < 3 AS title, s_suppkey % 4 IN (0, 2, 3) AS ident FROM supplier")
def _(spark, d):
    title, ident = _cases(4, " ", "2401.12345v2", "Method-2401.12345", "A Method"), _cases(4, "", "fine-tuning", "2401-12345", "method-2401-12345v1")
    return _k(spark, d).select("k", text.is_placeholder_title(title).alias("title"), text.is_placeholder_id(ident).alias("ident"))


@query("display_titles", "SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN 'On x ' || s_suppkey || ' nets' WHEN 1 THEN 'On nets (x-' || s_suppkey || ')' ELSE 'On x-' || s_suppkey || ' nets' END AS title FROM supplier")
def _(spark, d):
    title = _cases(3, cat("On x ", F.col("s"), " nets"), "On nets", cat("On x-", F.col("s"), " nets"))
    return _k(spark, d).select("k", text.display_title(title, cat("x-", F.col("s"))).alias("title"))


@query("heading_keys", "SELECT s_suppkey AS k, 'results and more' AS heading, 'results and more 2' AS title FROM supplier")
def _(spark, d):
    heading = _cases(3, "3.1  Results and MORE:", "Results  and more", "12. results and more: ")
    return _k(spark, d).select("k", text.heading_key(heading).alias("heading"), text.title_key(cat(" Results & and--more ", "(2)")).alias("title"))


@query("markdown_without_contents", A.sql("SELECT paper, text FROM markdown", "markdown"))
def _(spark, d):
    """Texts to which a table of contents was put in one of three forms, or none, as they were before."""
    k, first = F.col("paper") % 4, F.regexp_extract("text", r"\A# [^\n]*\n\n", 0)
    toc = F.when(k == 0, "## Table of Contents\n\n- [user](#user)\n  - turn 0\n1. assistant\n\n").when(k == 1, "**Contents**\n1.2 user\nassistant ........ 7\n\n").when(k == 2, "- [a](#a)\n- [b](#b)\n\n* [c](#c)\n\n").otherwise("")
    rows = A.markdown(spark, d).select("paper", F.concat(first, toc, F.substr("text", F.length(first) + 1)).alias("text"))
    return rows.select("paper", text.without_contents("text").alias("text"))


@query("outline_lines_copied", "SELECT s_suppkey AS k, 3 + s_suppkey % 3 AS copied, 'See  and ' || s_suppkey AS plain FROM supplier")
def _(spark, d):
    body = cat("- 1 Intro\n* 2.3 model here\n- A.1 Proofs\n- plain item\n2 Intro\n- 5\n", F.repeat(F.lit("- Baselines.\n"), (F.col("k") % 3).cast("int")))
    return _k(spark, d).select("k", text.copied_outline_lines(body).alias("copied"), text.without_citations(cat("See [arxiv:2401.1, n3] and ", F.col("s"))).alias("plain"))


@query("diagram_labels", "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 'Decoder,X' || s_suppkey ELSE 'X' || s_suppkey END AS labels FROM supplier")
def _(spark, d):
    allowed = F.when(F.col("k") % 2 == 0, F.array(F.lit("Encoder"))).otherwise(F.array(F.lit("Encoder"), F.lit("Decoder")))
    return _k(spark, d).select("k", F.array_join(text.provenance_violations(cat("Encoder --> Decoder --> X", F.col("s"), " lower"), allowed), ",").alias("labels"))


@query("blocks_inserted", "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 'before' || chr(10) || '# Head' || chr(10) || chr(10) || 'B' || s_suppkey || chr(10) || 'after' ELSE 'B' || s_suppkey || chr(10) || chr(10) || 'no head' END AS text FROM supplier")
def _(spark, d):
    return _k(spark, d).select("k", text.insert_after_heading(_cases(2, "before\n# Head\nafter", "no head"), cat("B", F.col("s"))).alias("text"))


@query("front_values", "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 < 2 THEN 'T' || s_suppkey END AS title, 'body' AS body FROM supplier")
def _(spark, d):
    raw = _cases(3, cat("---\ntitle: \"T", F.col("s"), "\"\nx: 1\n---\nbody"), cat("---\ntitle: T", F.col("s"), "\n---\nbody"), "body")
    return _k(spark, d).select("k", text.front_value(raw, "title").alias("title"), text.body(raw).alias("body"))


@query("safe_paths", "SELECT s_suppkey AS k, s_suppkey % 5 = 0 AS component, s_suppkey % 5 IN (0, 1) AS relative FROM supplier")
def _(spark, d):
    path = _cases(5, "a.md", "a/b.md", "../a", "/a", "a/../b")
    return _k(spark, d).select("k", quality.safe_component(path).alias("component"), quality.safe_relative(path).alias("relative"))


@query("image_extensions", "SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' ELSE '.svg' END AS ending FROM supplier")
def _(spark, d):
    url, kind = _cases(3, "https://x.org/A.PNG?x=1", "https://x.org/a", "https://x.org/a.txt"), _cases(3, "text/html", "image/jpeg; q=1", "image/svg+xml")
    return _k(spark, d).select("k", quality.image_extension(url, kind).alias("ending"))


@query("required_fields", "SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 1 THEN 'b' WHEN 2 THEN 'a,b' ELSE '' END AS lacking FROM supplier")
def _(spark, d):
    have = _cases(3, F.array(F.lit("b"), F.lit("a"), F.lit("c")), F.array(F.lit("a")), F.array(F.lit("c")))
    return _k(spark, d).select("k", F.array_join(quality.lacking(have, ["a", "b"]), ",").alias("lacking"))


@query("multisets_compared", "SELECT 'error' AS severity, code, 'x' || (s_suppkey % 10) AS detail FROM supplier, (VALUES ('sets_missing'), ('sets_extra')) AS t(code) WHERE code = 'sets_missing' AND s_suppkey % 20 = 3 OR code = 'sets_extra' AND s_suppkey % 20 = 4")
def _(spark, d):
    s = _k(spark, d).withColumn("x", cat("x", (F.col("k") % 10).cast("string")))
    return quality.same_multiset(s.where("k % 20 <> 4"), s.where("k % 20 <> 3"), "x", "sets")


# ---- streams ---------------------------------------------------------------------------------------------------------------


def _drained(spark, frame: DataFrame, mode: str, name: str) -> DataFrame:
    """The rows of a streaming query that has read all there is, from its sink's files or table."""
    held = name + folder(spark, name)[-32:]
    q = frame.writeStream.outputMode(mode).format("memory").queryName(held).option("checkpointLocation", folder(spark, f"{name}-checkpoint")).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.table(held)


def _landed_puts(spark, d) -> tuple[str, str]:
    path = folder(spark, "puts")
    A.cache_puts(spark, d).select(F.col("key").cast("string").alias("key"), F.col("payload"), F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("fetched_at"), "seq", "status").write.json(path)
    return path, "key string, payload string, fetched_at timestamp, seq long, status string"


@query("stream_log_latest", A.sql("SELECT cast(key AS VARCHAR) AS key, seq, status FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY fetched_at DESC, seq DESC) AS n FROM cache_puts) WHERE n = 1", "cache_puts"))
def _(spark, d):
    """The latest status of each key, by a streaming query over landed files of which a few are read at a time."""
    path, schema = _landed_puts(spark, d)
    rows = folds.latest(folds.landed(spark, path, schema, per_trigger=3), ["key"], ["fetched_at", "seq"])
    return _drained(spark, rows, "complete", "log").select("key", "seq", "status")


@query("stream_cache_state", A.sql("SELECT cast(key AS VARCHAR) AS key, seq FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY fetched_at DESC, seq DESC) AS n, max(fetched_at) OVER () AS now FROM cache_puts) WHERE n = 1 AND epoch(now) - epoch(fetched_at) < 172800", "cache_puts"))
def _(spark, d):
    """What a cache holds when a stream of puts has been read: the last put of each key that has not expired."""
    path, schema = _landed_puts(spark, d)
    puts = folds.landed(spark, path, schema).select("key", F.col("seq").cast("string").alias("payload"), "fetched_at").withWatermark("fetched_at", "0 seconds")
    told = _drained(spark, folds.cached(puts, 172_800), "update", "cache")
    return folds.latest_cache_state(told).select("key", F.col("payload").cast("long").alias("seq"))


@query("stream_windows", "SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, d):
    """Events per day and type, by a streaming query with a watermark."""
    path = folder(spark, "events")
    table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"), "event_type").write.json(path)
    rows = folds.windowed_counts(folds.landed(spark, path, "at timestamp, event_type string"), "at", "1 day", "40 days", ["event_type"])
    return _drained(spark, rows, "complete", "windows").select(F.date_format(F.to_utc_timestamp("start", F.current_timezone()), "yyyy-MM-dd").alias("day"), "event_type", "n")


#: Names whose answers are stated here take the place of earlier ones without SQL.
ANSWERED = [n for n in QUERIES if n in ORACLES]

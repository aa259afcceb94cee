"""Queries over what is written for a site and over its checks, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import book as B
from ..operators import site as W
from ..sources import adapter as A
from ..sources.adapter import sql, table
from .book import _CONTENTS, _ENTRIES, over, rel
from .registry import query


@query("site_titles", "SELECT s_suppkey AS k, 'Research Handbook: ' || CASE s_suppkey % 4 WHEN 0 THEN 'AI Coding Agents for Accelerated Workflows ' || s_suppkey WHEN 1 THEN 'A Survey of LLMs and Text to Speech ' || s_suppkey WHEN 2 THEN 'Run ' || s_suppkey ELSE 'Explain TTS via ASR ' || s_suppkey END AS title FROM supplier")
def _(spark, d):
    k = F.col("s_suppkey").cast("string")
    topic = F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("please ai agent system in coding that can accelerate working processes "), k)).when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("a survey of llms AND text-to-speech "), k)).when(F.col("s_suppkey") % 4 == 2, "  ").otherwise(F.concat(F.lit("-I want to explain_TTS via ASR 20260617 164504  for me "), k))
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), W.site_title(topic, F.concat(F.lit("run-"), k)).alias("title"))


@query("figure_urls", sql("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE replace(text, '](/paper_figures/', '](/b' || doc_id % 3 || '/paper_figures/') END AS text FROM (SELECT doc_id, '![' || source || '](/paper_figures/' || doc_id || '.png) (/paper_figures/) ' || abstract AS text FROM papers)", "papers"))
def _(spark, d):
    own = F.concat(F.lit("!["), "source", F.lit("](/paper_figures/"), F.col("doc_id").cast("string"), F.lit(".png) (/paper_figures/) "), "abstract")
    base = F.when(F.col("doc_id") % 3 == 0, " / ").otherwise(F.concat(F.lit("b"), (F.col("doc_id") % 3).cast("string"), F.lit("/")))
    return A.papers(spark, d).select("doc_id", W.figure_urls(own, base).alias("text"))


def _page(k):
    """Pages with faults by the rest of their number."""
    front = F.concat(F.lit("---\n"), F.when(k % 7 == 1, "").otherwise("title: T\n"), F.when(k % 7 == 2, "").otherwise("head: []\n"), F.lit("---\n"))
    return F.concat(F.when(k % 7 == 3, "").otherwise(front), F.when(k % 7 == 4, "text \\(x\\)").when(k % 7 == 5, "# T\n\nbody").otherwise("## Other\n\nbody $x$"))


@query("site_source_issues", """SELECT 'error' AS severity, code, detail FROM (
  SELECT 'missing_required_file' AS code, f AS detail FROM (VALUES ('package.json'), ('src/content/docs/families/index.md')) AS t(f) UNION ALL
  SELECT 'missing_dependency', 'rehype-katex' UNION ALL
  SELECT 'missing_title', 'p' || s_suppkey || '.md' FROM supplier WHERE s_suppkey % 7 IN (1, 3) UNION ALL
  SELECT 'missing_head', 'p' || s_suppkey || '.md' FROM supplier WHERE s_suppkey % 7 IN (2, 3) UNION ALL
  SELECT 'bad_math_delimiters', 'p' || s_suppkey || '.md' FROM supplier WHERE s_suppkey % 7 = 4 UNION ALL
  SELECT 'repeated_heading', 'p' || s_suppkey || '.md' FROM supplier WHERE s_suppkey % 7 = 5)""")
def _(spark, d):
    k = F.col("s_suppkey")
    pages = table(spark, d, "supplier").select(F.concat(F.lit("p"), k.cast("string"), F.lit(".md")).alias("path"), _page(k).alias("text"))
    files = pages.select("path").unionByName(spark.createDataFrame([(p,) for p in W.REQUIRED_FILES if p not in ("package.json", W.REQUIRED_FILES[-1])], "path string"))
    package = spark.createDataFrame([('{"dependencies": {"katex": "1", "remark-math": "2"}}',)], "value string")
    return W.source_issues(files, package, pages.unionByName(pages.select(F.concat("path", F.lit(".txt")).alias("path"), F.lit("no page").alias("text"))))


@query("site_built_issues", """SELECT 'error' AS severity, code, detail FROM (
  SELECT 'missing_smoke_page' AS code, 'p' || page_id || '.html' AS detail FROM pages WHERE page_id % 5 = 0 AND page_id % 10 = 0 UNION ALL
  SELECT 'failed_formula', 'p' || page_id || '.html' FROM pages WHERE page_id % 10 = 3 UNION ALL
  SELECT 'unknown_command', 'p' || page_id || '.html' FROM pages WHERE page_id % 10 IN (4, 6))""")
def _(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), "html")
    faults = F.when(F.col("page_id") % 10 == 3, '<span class="katex-error">').when(F.col("page_id") % 10 == 4, '<mstyle mathcolor="#cc0000">').when(F.col("page_id") % 10 == 6, '<a style="color:#cc0000">').otherwise("")
    built = pages.where("page_id % 10 <> 0").select("path", F.concat(F.coalesce("html", F.lit("")), faults).alias("html"))
    return W.built_issues(pages.where("page_id % 5 = 0").select("path"), built)


@query("book_taxonomy", over("SELECT a, b, c, e, CASE WHEN depth = 0 THEN '## Part ' || dense_rank() OVER (PARTITION BY depth = 0 ORDER BY a) || ': ' || title ELSE repeat('  ', depth - 1) || '- [' || title || '](../' || replace(path, '14_chapters/', '') || ')' || CASE WHEN path LIKE '14_chapters/methods/%' THEN ' [arxiv:' || coalesce(paper, '') || ']' ELSE '' END END AS line FROM entries LEFT JOIN (SELECT '14_chapters/methods/' || id || '.md' AS path, min(paper_id) AS paper FROM b_methods GROUP BY id) USING (path) WHERE a > 0", *[f"b_{n}" for n in _CONTENTS], entries=_ENTRIES))
def _(spark, d):
    rows = W.taxonomy_lines(B.contents(*[rel(spark, d, f"b_{n}") for n in _CONTENTS]), rel(spark, d, "b_methods").select(F.col("id").alias("method_id"), "paper_id"))
    return rows.select(*[F.col(f"nth.n{i}").alias(x) for i, x in enumerate("abce")], "line")


@query("book_needs_review", sql("SELECT 'citation' AS kind, paper_id AS id, '- **citation/' || paper_id || '** - `missing_citation_metadata` (title or year is missing)' AS line FROM papers WHERE doc_id % 4 IN (1, 2) UNION ALL SELECT 'methods', 'm' || s_suppkey, '- **methods/m' || s_suppkey || '** - `excluded_too_short` (why)' FROM supplier WHERE s_suppkey % 8 = 7", "papers"))
def _(spark, d):
    p = A.papers(spark, d)
    known = p.where("doc_id % 4 <> 1").select("paper_id", F.when(F.col("doc_id") % 4 == 2, " ").otherwise("T").alias("title"), "year")
    return W.review_lines(W.reference_lines(p, known)[1].unionByName(B.excluded_chapters(rel(spark, d, "b_chapters"))))


@query("book_references", sql("SELECT paper_id, '- [arxiv:' || paper_id || '] ' || CASE WHEN doc_id % 4 IN (1, 2) THEN '<citation metadata missing> (see NEEDS_REVIEW.md)' ELSE 'T ' || source || ' (' || year || ')' END AS line FROM papers", "papers"))
def _(spark, d):
    p = A.papers(spark, d)
    known = p.where("doc_id % 4 <> 1").select("paper_id", F.when(F.col("doc_id") % 4 == 2, " ").otherwise(F.concat(F.lit(" T "), "source")).alias("title"), "year")
    return W.reference_lines(p, known)[0]


@query("book_glossary", "SELECT min(p_partkey) AS ord, '- **' || p_brand || '** - ' || arg_min(coalesce(p_type, ''), p_partkey) AS line FROM part GROUP BY p_brand")
def _(spark, d):
    return W.term_lines(table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("name"), F.col("p_type").alias("meaning")))


@query("front_defaults", "SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN '---' || chr(10) || 'head: []' || chr(10) || '---' || chr(10) || chr(10) || '# B ' || s_suppkey WHEN 1 THEN '---' || chr(10) || 'title: T' || chr(10) || 'head: []' || chr(10) || '---' || chr(10) || 'b ' || s_suppkey ELSE '---' || chr(10) || 'head:' || chr(10) || '---' || chr(10) || 'b ' || s_suppkey END AS text FROM supplier")
def _(spark, d):
    k = F.col("s_suppkey")
    own = F.concat(F.when(k % 3 == 0, "# B ").when(k % 3 == 1, "---\ntitle: T\n---\nb ").otherwise("---\nhead:\n---\nb "), k.cast("string"))
    return table(spark, d, "supplier").select(k.alias("k"), W.with_front_default(own, "head", F.lit("[]")).alias("text"))

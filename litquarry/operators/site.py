"""What is written for a book's site, and what is wrong with its files and pages.

Lines come out with their order, so that a page of any length is made by a sort and not in one place; ``page`` joins those of a page
that is known to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import math, text
from .book import base_path
from .quality import all_of, issues

# Files and libraries that a site needs, the marks of formulas that failed, what is taken out of a topic or put in its
# place for a title, in this order and without regard to case, and what stands before every title.
REQUIRED_FILES = ("astro.config.mjs", "package.json", "src/content.config.ts", "src/content/docs/index.mdx", "src/content/docs/methods/index.md", "src/content/docs/families/index.md")
REQUIRED_LIBRARIES = ("remark-math", "rehype-katex", "katex")
FAILED_FORMULA, UNKNOWN_COMMAND = "katex-error", ('mathcolor="#cc0000"', "color:#cc0000")
TITLE_REWRITES = (
    (r"[-_]+", " "),
    (r"\b20\d{6}(?: \d{6})?\b", " "),
    (r"\b(?:i want to|please|for me|my)\b", " "),
    (r"\bthat can\b", " "),
    (r"\bworking process(?:es)?\b", "workflow"),
    (r"\bAI agent systems? in coding\b", "AI coding agents"),
    (r"\baccelerate\s+workflow\b", "accelerated workflows"),
    (r"\b(AI coding agents)\s+accelerated workflows\b", "$1 for accelerated workflows"),
)
TITLE_HEAD = "Research Handbook: "
FIGURE_PATH = "/paper_figures/"


def site_title(topic: Column | str, run_id: Column | str) -> Column:
    """A title for a topic (or, where it is blank, a run's name) without the words of a request and the run's date."""
    run = text.col(run_id)
    t = F.coalesce(text.or_default(topic), run)
    for pattern, instead in TITLE_REWRITES:
        t = F.regexp_replace(t, f"(?i){pattern}", instead)
    t = F.btrim(text.squeeze(t), F.lit(" -_:"))
    return F.concat(F.lit(TITLE_HEAD), text.title_case(F.when(t == "", run).otherwise(t)))


def figure_urls(markdown: Column | str, base: Column | str) -> Column:
    """A text whose links to figures begin with the site's base address; unchanged where there is none."""
    return F.replace(text.col(markdown), F.lit(f"]({FIGURE_PATH}"), F.concat(F.lit("]("), F.coalesce(base_path(base), F.lit("")), F.lit(FIGURE_PATH)))


def has_front(markdown: Column | str, key: str) -> Column:
    """Whether the front matter has a line of this key, with or without a value."""
    return F.coalesce(text.front_matter(markdown).rlike(rf"(?m)^\s*{key}:"), F.lit(False))


def with_front_default(markdown: Column | str, key: str, value: Column) -> Column:
    """The text with ``key: value`` as the last line of its front matter where that lacks the key; a text without front matter gets one."""
    t = text.col(markdown)
    front, line = text.front_matter(t), F.concat(F.lit(f"{key}: "), value, F.lit("\n"))
    new = F.concat(F.lit("---\n"), line, F.lit("---\n\n"), t)
    more = F.concat(F.substring(t, F.lit(1), F.length(front) - 4), line, F.substr(t, F.length(front) - 3))
    return F.when(has_front(t, key), t).when(front == "", new).otherwise(more)


def source_issues(files: DataFrame, package: DataFrame, pages: DataFrame, required: tuple[str, ...] = REQUIRED_FILES) -> DataFrame:
    """What is wrong with a site's sources: ``files`` (path), ``package`` (value), a JSON text, and ``pages`` (path, text)."""
    spark = files.sparkSession
    need = spark.createDataFrame([(p,) for p in required], "path string")
    known = F.from_json(F.get_json_object("value", "$.dependencies"), "map<string,string>")
    lacking = package.select(F.explode(F.array_except(F.array(*map(F.lit, REQUIRED_LIBRARIES)), F.coalesce(F.map_keys(known), F.array().cast("array<string>")))).alias("name"))
    shown = pages.where(F.col("path").rlike(r"\.mdx?$"))
    return all_of(
        issues(need.join(files.select("path").distinct(), "path", "left_anti"), "missing_required_file", F.col("path")),
        issues(lacking, "missing_dependency", F.col("name")),
        issues(shown.where(~has_front("text", "title")), "missing_title", F.col("path")),
        issues(shown.where(~has_front("text", "head")), "missing_head", F.col("path")),
        issues(shown.where(math.bad_math(F.col("text"))), "bad_math_delimiters", F.col("path")),
        issues(shown.where(math.repeated_heading(F.col("text"))), "repeated_heading", F.col("path")),
    )


def built_issues(smoke: DataFrame, built: DataFrame) -> DataFrame:
    """What is wrong with a site that was built: ``smoke`` (path) pages that must be there, ``built`` (path, html)."""
    unknown = F.contains("html", F.lit(UNKNOWN_COMMAND[0])) | F.contains("html", F.lit(UNKNOWN_COMMAND[1]))
    pages = built.where(F.endswith("path", F.lit(".html")))
    return all_of(
        issues(smoke.join(built.select("path").distinct(), "path", "left_anti"), "missing_smoke_page", F.col("path")),
        issues(pages.where(F.contains("html", F.lit(FAILED_FORMULA))), "failed_formula", F.col("path")),
        issues(pages.where(unknown), "unknown_command", F.col("path")),
    )


def taxonomy_lines(entries: DataFrame, papers: DataFrame) -> DataFrame:
    """(nth, line) of a taxonomy: parts, their families, and the methods of each with its paper.

    ``entries`` are a book's ``contents``; ``papers`` has (method_id, paper_id).
    """
    own = F.regexp_extract("path", r"^14_chapters/methods/(.*)\.md$", 1)
    rows = entries.where("nth.n0 > 0").withColumn("method_id", F.nullif(own, F.lit("")))
    rows = rows.join(papers.groupBy("method_id").agg(F.min("paper_id").alias("paper_id")), "method_id", "left")
    link = F.concat(F.repeat(F.lit("  "), F.col("depth") - 1), F.lit("- ["), F.col("title"), F.lit("](../"), F.regexp_replace("path", "^14_chapters/", ""), F.lit(")"))
    cited = F.when(F.col("method_id").isNotNull(), F.concat(F.lit(" [arxiv:"), F.coalesce("paper_id", F.lit("")), F.lit("]"))).otherwise("")
    nth_part = F.dense_rank().over(Window.orderBy("nth.n0"))  # a book has a handful of parts
    heads = rows.where("depth = 0").select("nth", F.concat(F.lit("## Part "), nth_part.cast("string"), F.lit(": "), F.col("title")).alias("line"))
    return heads.unionByName(rows.where("depth > 0").select("nth", F.concat(link, cited).alias("line")))


def review_lines(offenders: DataFrame) -> DataFrame:
    """(kind, id, line) for chapters and citations that need a look: ``offenders`` has (kind, id, status, reason)."""
    line = F.concat(F.lit("- **"), F.col("kind"), F.lit("/"), F.col("id"), F.lit("** - `"), F.col("status"), F.lit("` ("), F.coalesce("reason", F.lit("")), F.lit(")"))
    return offenders.select("kind", "id", line.alias("line"))


def term_lines(terms: DataFrame, mark: str = "**") -> DataFrame:
    """(ord, line) of a glossary or a notation: the first explanation of each name, in the order in which names came first."""
    named = terms.where(F.coalesce("name", F.lit("")) != "")
    first = named.groupBy("name").agg(F.min_by(F.struct("ord", F.coalesce("meaning", F.lit("")).alias("meaning")), "ord").alias("f"))
    return first.select("f.ord", F.concat(F.lit(f"- {mark}"), F.col("name"), F.lit(f"{mark} - "), F.col("f.meaning")).alias("line"))


def reference_lines(promoted: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paper_id, line) for each paper, and offenders for those of which title or year is not known.

    ``promoted`` has (paper_id), ``known`` (paper_id, title, year).
    """
    ids = promoted.where(F.coalesce("paper_id", F.lit("")) != "").select("paper_id").distinct()
    rows = ids.join(known.select("paper_id", text.strip(text.or_default("title")).alias("title"), "year"), "paper_id", "left")
    there = F.col("title").isNotNull() & F.col("year").isNotNull()
    full = F.concat(F.lit("- [arxiv:"), F.col("paper_id"), F.lit("] "), F.col("title"), F.lit(" ("), F.col("year").cast("string"), F.lit(")"))
    bare = F.concat(F.lit("- [arxiv:"), F.col("paper_id"), F.lit("] <citation metadata missing> (see NEEDS_REVIEW.md)"))
    lines = rows.select("paper_id", F.when(there, full).otherwise(bare).alias("line"))
    missing = rows.where(~there).select(F.lit("citation").alias("kind"), F.col("paper_id").alias("id"), F.lit("missing_citation_metadata").alias("status"), F.lit("title or year is missing").alias("reason"))
    return lines, missing


def page(lines: DataFrame, head: str, order: list[str]) -> DataFrame:
    """(text): a heading and the lines in their order, for pages of a bounded number of lines."""
    rows = lines.agg(F.array_sort(F.collect_list(F.struct(*order, "line")))["line"].alias("l"))
    return rows.select(F.concat(F.lit(f"# {head}\n\n"), F.array_join("l", "\n"), F.lit("\n")).alias("text"))

"""What is written for a site, and its checks, on values derived by hand."""

import pytest
from pyspark.sql import functions as F

from litquarry.operators import site

TITLES = {
    ("I want to AI agent system in coding that can accelerate working process", "r"): "AI Coding Agents for Accelerated Workflows",
    ("speech_large-language-model-20260618 113735", "r"): "Speech Large Language Model",
    ("", "speech-run-20260618"): "Speech Run",
    (None, "asr via llm"): "ASR via LLM",
    (" -: ", "x"): "X",
    ("please", "the run"): "The Run",
    ("apis OF the Web", "r"): "APIs of the Web",
}


def test_titles(spark):
    rows = spark.createDataFrame([(t, r, "Research Handbook: " + w) for (t, r), w in TITLES.items()], "topic string, run string, want string")
    for r in rows.select("topic", "want", site.site_title("topic", "run").alias("got")).collect():
        assert r.got == r.want, r.topic


@pytest.mark.parametrize(("base", "want"), [("/b/", "](/b/paper_figures/x) (/paper_figures/y)"), ("b", "](/b/paper_figures/x) (/paper_figures/y)"), ("/", "](/paper_figures/x) (/paper_figures/y)"), (None, "](/paper_figures/x) (/paper_figures/y)")])
def test_figure_urls(spark, base, want):
    row = spark.createDataFrame([("](/paper_figures/x) (/paper_figures/y)", base)], "t string, b string")
    assert row.select(site.figure_urls("t", "b")).first()[0] == want


FRONTS = {
    "---\ntitle: T\n---\nbody": "---\ntitle: T\nhead: []\n---\nbody",
    "---\nhead:\n---\nbody": "---\nhead:\n---\nbody",
    "body\n---\nhead: x\n---\n": "---\nhead: []\n---\n\nbody\n---\nhead: x\n---\n",
    "": "---\nhead: []\n---\n\n",
    "---\nno end": "---\nhead: []\n---\n\n---\nno end",
}


def test_front_defaults(spark):
    rows = spark.createDataFrame(list(FRONTS.items()), "t string, want string")
    for r in rows.select("t", "want", site.with_front_default("t", "head", F.lit("[]")).alias("got"), site.with_front_default(site.with_front_default("t", "head", F.lit("[]")), "head", F.lit("no")).alias("twice")).collect():
        assert r.got == r.want and r.twice == r.want


def test_pages_are_joined_in_their_order(spark):
    terms = spark.createDataFrame([(3, "b", "late"), (1, "b", "first"), (2, "a", None), (0, "", "x"), (4, None, "y")], "ord int, name string, meaning string")
    text = site.page(site.term_lines(terms), "Glossary", ["ord"]).first()[0]
    assert text == "# Glossary\n\n- **b** - first\n- **a** - \n"
    assert site.page(site.term_lines(terms.limit(0)), "Notation", ["ord"]).first()[0] == "# Notation\n\n\n"


def test_a_sound_site_has_no_issues(spark):
    files = spark.createDataFrame([(p,) for p in site.REQUIRED_FILES], "path string")
    package = spark.createDataFrame([('{"dependencies": {"remark-math": "1", "rehype-katex": "1", "katex": "1"}}',)], "value string")
    pages = spark.createDataFrame([("a.md", "---\ntitle: T\nhead: []\n---\ntext $x$")], "path string, text string")
    assert site.source_issues(files, package, pages).collect() == []
    broken = site.source_issues(files.limit(0), spark.createDataFrame([("no json",)], "value string"), pages.limit(0)).collect()
    assert sorted(r.code for r in broken) == ["missing_dependency"] * 3 + ["missing_required_file"] * 6
    built = spark.createDataFrame([("index.html", "fine")], "path string, html string")
    assert site.built_issues(built.select("path"), built).collect() == []

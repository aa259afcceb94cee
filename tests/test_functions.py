import json

import pytest
from pyspark.sql import functions as F

from litquarry.functions import json as jsonx
from litquarry.functions import math, scoring, text
from litquarry.operators import packs, quality


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_ids_and_slugs(spark):
    got = lambda c: one(spark, c)
    assert got(text.paper_year(F.lit("2405.12345v2"))) == 2024 and got(text.paper_year(F.lit("hep-th/990.1"))) is None
    assert got(text.external_id(F.lit("https://arxiv.org/pdf/2405.12345v2.pdf"))) == "2405.12345v2" and got(text.external_id(F.lit("x"))) is None
    assert got(text.lookup_keys(F.lit("arXiv:2405.12345"))) == ["arXiv:2405.12345", "ArXiv:2405.12345"]
    assert got(text.slug(F.lit("The Best -- Method!"))) == "best-method" and got(text.slug(F.lit("!!"))) == "method"
    assert got(text.method_slug(F.lit("3D Nets"))) == "method-3d-nets"
    assert got(text.quoted_name(F.lit("cs/01 a"))) == "cspct2F01pct20a"
    assert got(text.node_key(F.lit("  Foo(Bar)  C++ "))) == "foo bar c++"
    assert got(text.heading_key(F.lit(" 3.1.  The  Title: "))) == "the title"
    assert got(text.display_title(F.lit("Deep Nets"), F.lit("deep-nets"))) == "Deep Nets" and got(text.display_title(F.lit("Deep"), F.lit("m-1"))) == "Deep (m-1)"
    assert got(text.is_placeholder_title(F.lit("2405.12345"))) and not got(text.is_placeholder_title(F.lit("Real")))
    assert got(text.is_placeholder_id(F.lit("2405-12345"))) and not got(text.is_placeholder_id(F.lit("bert")))


def test_lines_and_front_matter(spark):
    got = lambda c: one(spark, c)
    assert got(text.lines(F.lit("a\r\nb\x0bc d\n"))) == "a b c d".split() and got(text.lines(F.lit(""))) == []
    page = F.lit("---\ntitle: 'A b'\nstatus: excluded_x\n---\nBody two")
    assert got(text.body(page)) == "Body two" and got(text.front_value(page, "title")) == "A b" and got(text.front_value(page, "none")) is None
    assert got(text.word_count(page)) == 2 and got(text.word_count(F.lit("Größe ñandú x_1"))) == 3
    assert got(text.line_slice(F.lit("a\nb\nc\nd"), F.lit(2), F.lit(3))) == "b\nc"
    assert got(text.insert_after_heading(F.lit("x\n# H\nrest"), F.lit("NEW"))) == "x\n# H\n\nNEW\nrest" and got(text.insert_after_heading(F.lit("rest"), F.lit("NEW"))) == "NEW\n\nrest"
    diff = got(text.heading_diff(F.lit("## B\n## A\n## X\n## References"), ["## A", "## B", "## C"]))
    assert (diff.missing, diff.extra, diff.out_of_order) == (["## C"], ["## X"], True)
    assert got(text.copied_outline_lines(F.lit("- 3.1 Methods\n* A.2 x\n- Baselines.\n- fine"))) == 3
    assert got(text.without_citations(F.lit("a [arxiv:1, s.01] b"))) == "a  b"
    assert got(text.sentences(F.lit("# Head\nShort Title\nOne is here. Two!\n| t |\nFigure: x\nThree?"))) == ["One is here.", "Two!", "Three?"]
    assert got(text.title_case(F.lit("a survey OF llm-based ASR and the web"))) == "A Survey of LLM-Based ASR and the Web"
    assert got(text.provenance_violations(F.lit("Foo --> Bar_1 --> baz"), F.array(F.lit("Foo")))) == ["Bar_1"]


def test_scores_and_months(spark):
    got = lambda c: one(spark, c)
    assert got(scoring.recent_months(F.to_date(F.lit("2024-02-29")), 3)) == ["2023-12", "2024-01", "2024-02"]
    assert got(scoring.month(F.lit("2024-3"), F.lit(None).cast("int"))) == "2024-03" and got(scoring.month(F.lit("7"), F.lit(2020))) == "2020-07" and got(scoring.month(F.lit("13"), F.lit(2020))) is None
    assert got(scoring.year_window(F.lit(2020), F.lit(None).cast("int"))) == "2020-" and got(scoring.year_window(F.lit(None).cast("int"), F.lit(None).cast("int"))) is None
    assert got(scoring.limited(F.lit(900), 500)) == 500
    with pytest.raises(Exception):
        got(scoring.limited(F.lit(0), 500))


def test_json(spark):
    got = lambda c: one(spark, c)
    doc = F.lit('{"externalIds": {"ArXiv": "2405.1", "x": null}, "list": [{"a": 1}, {"a": 2}]}')
    assert got(jsonx.safe_get(doc, "externalIds.Arxiv")) == "2405.1" and got(jsonx.safe_get(doc, "list.1.a")) == "2"
    assert got(jsonx.safe_get(doc, "externalIds.x", "d")) == "d" and got(jsonx.safe_get(doc, "list.7", "d")) == "d"
    assert got(jsonx.string_list(F.lit("a, b,,c"))) == ["a", "b", "c"] and got(jsonx.string_list(F.lit("a, b\n c"))) == ["a, b", "c"]
    assert got(jsonx.listed_ids(F.lit("Sure: ['b', \"a\", 'z', 'b'] ok"), F.array(F.lit("a"), F.lit("b")))) == ["b", "a"]
    assert got(jsonx.search_key(F.lit("q"), F.lit(None).cast("string"), F.lit(3), F.lit(10))) == "q||3|10"
    assert got(jsonx.string_leaves(F.lit('{"a": ["x", {"b": "y"}], "c": 1}'))) == ["x", "y"]


@pytest.mark.parametrize("raw, want", [('{"a": 1}', {"a": 1}), ('x\n```json\n{"a": "b"}\n```', {"a": "b"}), (r'{"m": "\alpha \" \\ \n A"}', {"m": "\\alpha \" \\ \n A"}), ('```\n[1]\n```', [1])])
def test_lenient_json(raw, want):
    assert jsonx.parse_lenient(raw) == want


@pytest.mark.parametrize("raw", ['{"a": ', "", None, "text"])
def test_hopeless_json(spark, raw):
    with pytest.raises(ValueError):
        jsonx.parse_lenient(raw)
    rows = spark.createDataFrame([(raw,), (json.dumps({"b": 1, "a": 2}),)], "t string")
    assert [r[0] for r in rows.select(jsonx.repair_json("t")).collect()] == [None, '{"a": 2, "b": 1}']


def test_math():
    assert math.normalise_math(r"a \(x\) b \[ y \] c") == "a $x$ b $$\ny\n$$ c"
    assert math.normalise_math("```\n\\(x\\)\n```\n`\\(y\\)` \\\\(z\\\\)") == "```\n\\(x\\)\n```\n`\\(y\\)` \\\\(z\\\\)"
    assert math.normalise_math("$$ a $b$ c $$") == "$$\na b c\n$$" and math.normalise_math("$$\n$x$ + y\n$$\n") == "$$\nx + y\n$$\n"
    assert math.normalise_math(r"\textsc{ab} \textsc{a b} \text{a_b}") == r"\mathrm{ab} \text{a b} \text{a\_b}"
    assert math.has_bad_math(r"\(x\)") and not math.has_bad_math(r"`\(x\)`") and math.has_bad_math("$$ $x")
    page = "---\ntitle: \"A  b\"\n---\n\n# A b\ntext"
    assert math.without_repeated_heading(page) == "---\ntitle: \"A  b\"\n---\n\ntext" and math.without_repeated_heading(page.replace("# A b", "# C")) == page.replace("# A b", "# C")


def test_gap_scope():
    assert packs.gap_scope(["x", "y", "z", "w"], [], "") == ["x", "y", "z"]
    assert packs.gap_scope([], ["attention", "self attention", "token", "gpu"], "Self  Attention over tokens") == ["self attention", "token"]


def test_chapter_status_ladder(spark):
    none = F.array().cast("array<string>")
    ladder = lambda **k: one(spark, quality.chapter_status(**({"kind": F.lit("methods"), "present": F.lit(True), "form_issues": none, "words": F.lit(2000), "passed": F.lit(False), "unsupported": F.lit(0), "overstated": F.lit(0), "gaps": F.lit(0)} | k)))
    assert ladder(present=F.lit(None).cast("boolean")) == "excluded_missing_verification"
    assert ladder(form_issues=F.array(F.lit("bad"))) == "excluded_form_issues"
    assert ladder(words=F.lit(1499)) == "excluded_too_short" and ladder(passed=F.lit(True)) == "passed"
    assert ladder(overstated=F.lit(1)) == "excluded_unsupported_claims" and ladder(gaps=F.lit(1)) == "excluded_missing_evidence"
    assert ladder(form_issues=F.array(F.lit("method_word_count_high"))) == "passed" and ladder() == "excluded_verification_failed"


def test_paths_and_images(spark):
    got = lambda c: one(spark, c)
    assert got(quality.safe_component(F.lit("a.b"))) and not got(quality.safe_component(F.lit(".."))) and not got(quality.safe_component(F.lit("a/b")))
    assert got(quality.safe_relative(F.lit("a/b"))) and not got(quality.safe_relative(F.lit("a/../b"))) and not got(quality.safe_relative(F.lit("/a")))
    assert got(quality.allowed_image(F.lit("https://x.org/a.PNG"))) and got(quality.allowed_image(F.lit("https://export.arxiv.org/x"))) and not got(quality.allowed_image(F.lit("ftp://x.org/a.png")))
    assert got(quality.image_extension(F.lit("https://x/a.jpeg"), F.lit(None).cast("string"))) == ".jpg" and got(quality.image_extension(F.lit("https://x/a"), F.lit("image/svg+xml; x"))) == ".svg" and got(quality.image_extension(F.lit("https://x/a"), F.lit("text/html"))) is None

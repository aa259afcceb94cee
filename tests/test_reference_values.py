"""Values derived by hand for small inputs (FIXTURES.md, section 3)."""

import pytest
from pyspark.sql import functions as F

from litquarry.functions import scoring, text
from litquarry.operators import discovery, gaps, outline, pages
from litquarry.sources.adapter import FIELDS

EVIDENCE = "arxiv_id string, title string, topic_tags array<string>, problem array<string>, solution array<string>, methods array<string>, datasets array<string>, benchmarks array<string>, metrics array<string>, baselines array<string>, mentioned_entities array<string>, reader_needed_concepts array<string>, book_usage struct<importance_score_1_to_5:int>"


@pytest.fixture
def corpus(spark):
    evidence = spark.createDataFrame(
        [
            ("p1", "ViT for Vision", ["computer vision"], ["image classification needs a new architecture"], ["apply a Transformer directly to image patches"], ["ViT", "Transformer"], [], [], [], [], [], ["attention"], (5,)),
            ("p2", "CLIP Variants", ["multimodal"], ["align"], ["contrastive training over a vision encoder"], ["CLIP vision encoder", "Transformer"], ["LAION"], ["ImageNet zero-shot"], [], ["ViT"], [], [], (4,)),
            ("p3", "ASR Baselines", ["speech"], ["benchmark ASR"], ["compare"], ["wav2vec", "Mel spectrogram"], [], ["LibriSpeech"], ["WER"], [], None, [], (2,)),
        ],
        EVIDENCE,
    )
    nodes = [("p1", "Paper", "One"), ("p2", "Paper", "Two"), ("p3", "Paper", "Three"), ("vit", "Method", "ViT"), ("clip vision encoder", "Method", "CLIP vision encoder"), ("transformer", "Method", "Transformer"), ("wav2vec", "Method", "wav2vec"), ("mel spectrogram", "Dataset", "Mel spectrogram"), ("graph only concept", "Method", "Graph Only Concept")]
    edges = [("p1", "vit", "INTRODUCES"), ("p1", "transformer", "USES"), ("p2", "vit", "USES"), ("p2", "clip vision encoder", "INTRODUCES"), ("p2", "transformer", "USES"), ("p3", "wav2vec", "USES"), ("p3", "mel spectrogram", "USES_DATASET"), ("p2", "graph only concept", "USES")]
    return (
        evidence,
        spark.createDataFrame([(i, *n) for i, n in enumerate(nodes)], "ord long, id string, type string, display string"),
        spark.createDataFrame([("f", str(i), *e, "weak") for i, e in enumerate(edges)], "file string, ord string, src string, dst string, type string, confidence string"),
        spark.createDataFrame([("transformer", "transformer"), ("transformer", "transformers")], "key string, variant string"),
    )


def test_gap_digest(spark, corpus):
    evidence, nodes, edges, known = corpus
    rows = gaps.mention_rows(evidence, FIELDS)
    m = gaps.mentions(rows, FIELDS)
    c = gaps.candidates(m, nodes, gaps.concept_edges(nodes, edges), known, rows.select("paper", "importance").distinct())
    kept = [(r.norm, r.paper_count, r.core_paper_count, ",".join(r.in_slots), r.is_method_of_core, round(r.importance, 6)) for r in gaps.selected(c).orderBy("rank").collect()]
    assert kept == [
        ("vit", 2, 2, "method,result,title", True, 0.733333),
        ("clip vision encoder", 1, 1, "method", True, 0.516667),
        ("laion", 1, 1, "method", True, 0.516667),
        ("imagenet zero shot", 1, 1, "result", False, 0.366667),
        ("computer vision", 1, 1, "abstract", False, 0.316667),
        ("multimodal", 1, 1, "abstract", False, 0.316667),
    ]
    dropped = {r.concept: (r.reason, round(r.importance, 6)) for r in c.where("reason is not null").collect()}
    assert dropped["attention"] == ("low_score", 0.266667) and dropped["Graph Only Concept"] == ("low_score", 0.25)
    assert dropped["Transformer"][0] == "known" and dropped["speech"] == ("low_score", 0.2) and len(dropped) == 8
    ce = gaps.concept_edges(nodes, edges)
    refs = gaps.first_references(m, evidence.withColumnRenamed("arxiv_id", "paper"))
    d = {r.normalized: r for r in gaps.digest(gaps.selected(c), refs, gaps.neighbors(ce), gaps.graph_concepts(nodes)).collect()}
    assert d["vit"].graph_neighbors == ["Transformer", "CLIP vision encoder", "Graph Only Concept"]
    ref = d["vit"].evidence_refs[0]
    assert (ref.arxiv_id, ref.slot, ref.snippet) == ("p1", "method", "apply a Transformer directly to image patches")


def test_digest_budget(spark):
    rows = spark.createDataFrame([(1, "x" * 300)], "rank int, concept string")
    assert gaps.within_budget(rows, 1000).count() == 1
    with pytest.raises(Exception, match="size budget"):
        gaps.within_budget(rows, 100).collect()


def test_keyword_filter(spark):
    papers = spark.createDataFrame([("2401.00001", "Transformer reasoning with chain of thought."), ("2401.00002", "Robotics control with diffusion policy."), ("2401.00003", "Inference scaling for transformer reasoning."), ("1901.00001", "Transformer reasoning from an older paper.")], "paper_id string, abstract string")
    kept = discovery.filter_papers(papers, ["transformer", "reasoning"], ["robotics"], 2026)
    assert [r.paper_id for r in kept.collect()] == ["2401.00001", "2401.00003"]


def test_terms_are_whole_words(spark):
    rows = spark.createDataFrame([("évit",), ("a vit b",), ("VIT",), ("chain  of\nthought",), ("C++ x",)], "t string")
    hit = lambda terms: [bool(r[0]) for r in rows.select(F.col("t").rlike(text.any_term(terms))).collect()]
    assert hit(["vit"]) == [False, True, True, False, False]
    assert hit(["chain of thought", "c++"]) == [False, False, False, True, True]


@pytest.mark.parametrize("c, y, want", [(100, 2026, 0.684234), (10, 2024, 0.345090), (1, 2024, 0.211343), (0, 2026, 0.25), (20000, 2010, 0.75), (5, 2027, 0.0), (-1, 2020, 0.0)])
def test_impact(spark, c, y, want):
    assert spark.range(1).select(scoring.impact(F.lit(c), F.lit(y), 2026)).first()[0] == pytest.approx(want, abs=1e-6)


MARKDOWN = "# Architecture\nArchitecture intro.\n## Stack\n\n\n### Overview\nStack overview.\n\n#### Encoder\nEncoder details.\n\n## Training\nTraining details."


def test_page_index(spark):
    docs = spark.createDataFrame([("p", MARKDOWN), ("q", "no heading. At all"), ("r", "")], "paper string, text string")
    nodes = pages.with_summary(pages.sections(docs), docs)
    got = sorted((r.paper, r.id, r.level, r.start_line, r.end_line, r.parent_id, r.summary) for r in nodes.collect())
    assert got == [
        ("p", "s.01", 1, 1, 13, "s.00", "Architecture intro."),
        ("p", "s.01.01", 2, 3, 11, "s.01", "Stack overview."),
        ("p", "s.01.01.01", 3, 6, 11, "s.01.01", "Stack overview."),
        ("p", "s.01.01.01.01", 4, 9, 11, "s.01.01.01", "Encoder details."),
        ("p", "s.01.02", 2, 12, 13, "s.01", "Training details."),
        ("q", "s.01", 1, 1, 1, "s.00", "no heading."),
        ("r", "s.01", 1, 1, 1, "s.00", ""),
    ]
    assert pages.tree_issues(pages.sections(docs)).count() == 0
    found = pages.find_section(pages.sections(docs), docs, "stack / Overview").collect()
    assert [(r.paper, r.id) for r in found] == [("p", "s.01.01.01")] and found[0].section_text.startswith("### Overview\nStack overview.")


@pytest.mark.parametrize("raw, want", [("  CLIP Vision Encoder ", "clip vision encoder"), ("Mel   Spectrogram", "mel spectrogram"), ("Transformer.", "transformer"), ("ViT,", "vit"), ("wav2vec-2.0", "wav2vec 2.0"), ("\t\n", "")])
def test_concept_key(spark, raw, want):
    assert spark.range(1).select(text.concept_key(F.lit(raw))).first()[0] == want


def book(families, methods):
    return {"families": [{"id": f, "title": f, "method_ids": m, "neighbor_family_ids": n} for f, m, n in families], "methods": [{"id": m, "family_id": f, "neighbor_method_ids": n} for m, f, n in methods], "parts": [{"id": "p1", "title": "P", "family_ids": [f for f, *_ in families]}]}


def test_singletons():
    strong = outline.merge_singletons(book([("a", ["m1"], ["b"]), ("b", ["m2", "m3"], ["a"])], [("m1", "a", ["m2", "m3"]), ("m2", "b", ["m1"]), ("m3", "b", [])]))
    assert [(f["id"], f["method_ids"]) for f in strong["families"]] == [("b", ["m2", "m3", "m1"])] and strong["methods"][0]["family_id"] == "b"
    weak = outline.merge_singletons(book([("a", ["m1"], []), ("b", ["m2", "m3"], [])], [("m1", "a", ["m2"]), ("m2", "b", []), ("m3", "b", [])]))
    alone = next(f for f in weak["families"] if f["id"] == "standalone")
    assert alone["is_group"] and alone["method_ids"] == ["m1"] and weak["parts"][-1] == {"id": "standalone_methods", "title": "Standalone / Emerging Methods", "family_ids": ["standalone"]}
    best = outline.merge_singletons(book([("s", ["m1"], []), ("b", ["m2", "m3"], []), ("c", ["m4", "m5", "m6"], [])], [("m1", "s", ["m2", "m3", "m4", "m5", "m6"])] + [(f"m{i}", "b" if i < 4 else "c", []) for i in range(2, 7)]))
    assert best["methods"][0]["family_id"] == "c"
    pair = outline.merge_singletons(book([("a", ["m1"], []), ("b", ["m2"], []), ("c", ["m3", "m4"], [])], [("m1", "a", []), ("m2", "b", []), ("m3", "c", []), ("m4", "c", [])]))
    assert {f["id"]: (f["title"], f["method_ids"]) for f in pair["families"]} == {"a": ("Complementary Methods", ["m1", "m2"]), "c": ("c", ["m3", "m4"])}


@pytest.mark.parametrize(
    "given, want",
    [
        ("$$ $a_{t}=\\texttt{GO}(b)$ $$\n", "$$\na_{t}=\\texttt{GO}(b)\n$$\n"),
        ("$$\n$r=\\frac{x}{y},$ (1)\n$$\n", "$$\nr=\\frac{x}{y}, (1)\n$$\n"),
        ("$$ (1) $\\text{At}k$ $$\n", "$$\n(1) \\text{At}k\n$$\n"),
        ("$$ $x,$ (3) $\n", "$$\nx, (3)\n$$\n"),
        ("Inline $x+1$ stays.\n\n$$\ny=x+2\n$$\n", "Inline $x+1$ stays.\n\n$$\ny=x+2\n$$\n"),
        ("$$\n\\texttt{val_bpb}+\\text{A_TO_B}\n$$\n", "$$\n\\texttt{val\\_bpb}+\\text{A\\_TO\\_B}\n$$\n"),
        ("Use \\(P^{\\prime}\\) here.\n", "Use $P^{\\prime}$ here.\n"),
        ("Use `\\(raw\\)`.\n\n```md\n\\[x\\]\n```\n", "Use `\\(raw\\)`.\n\n```md\n\\[x\\]\n```\n"),
        ("\\[\na+b\n=c\n\\]\n", "$$\na+b\n=c\n$$\n"),
        ("$$\na\\\\[8.0pt]0\n$$\n", "$$\na\\\\[8.0pt]0\n$$\n"),
        ("$$\nS(x)$ $=y$ (1) $+z\n$$\n", "$$\nS(x) =y (1) +z\n$$\n"),
    ],
)
def test_mathematical_markup(given, want):
    from litquarry.functions.math import normalise_math

    assert normalise_math(given) == want and normalise_math(want) == want

"""Nested documents for writers: the plan of sections with their sources, structured fields, neighbours."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..functions import text

# The sections of a method's chapter, those that must have a source of their own, and the kinds of items from
# which each takes its sources: the first group that the paper has, and how many nodes of it.
SECTIONS = ["Summary", "Motivation", "Intuition", "Theory", "Algorithm", "Example", "Interpretation", "Strengths", "Limitations", "Software", "Related Methods"]
REQUIRED = ["Theory", "Algorithm", "Example", "Limitations"]
SOURCES = {
    "Summary": [(["claims/method", "claims/result", "claims/motivation"], 2)],
    "Motivation": [(["claims/motivation"], 2)],
    "Intuition": [(["claims/method"], 2)],
    "Theory": [(["equations"], 3), (["claims/method"], 2)],
    "Algorithm": [(["algorithms"], 3), (["claims/method"], 2)],
    "Example": [(["hyperparameters"], 2), (["results"], 2)],
    "Interpretation": [(["complexity"], 2), (["claims/result"], 2)],
    "Strengths": [(["claims/result", "claims/method"], 2)],
    "Limitations": [(["limitations"], 2), (["claims/limitation"], 2)],
    "Software": [(["datasets"], 2), (["benchmarks"], 2)],
    "Related Methods": [(["neighbors"], 2)],
}
#: Any kind of item: what a section falls back to that need not have a source of its own.
ANY = "*"


def plan(spark) -> DataFrame:
    rows = [(i, s, p, kind, n) for i, s in enumerate(SECTIONS) for p, (kinds, n) in enumerate(SOURCES[s]) for kind in kinds]
    rows += [(i, s, 9, ANY, 1) for i, s in enumerate(SECTIONS) if s not in REQUIRED]
    return spark.createDataFrame(rows, "section_ord int, section string, preference int, kind string, most int")


def first_nodes(items: DataFrame, limit: int, keys: list[str] = ("paper", "kind")) -> DataFrame:
    """The first ``limit`` distinct nodes of each kind of item, in the order of items."""
    once = items.where("node is not null").groupBy(*keys, "node").agg(F.min("nth").alias("nth"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("nth", "node"))
    return once.withColumn("rank", rank).where(F.col("rank") <= limit)


def section_sources(items: DataFrame) -> DataFrame:
    """(paper, section_ord, section, node, rank): for each section of each paper the nodes of the preferred kinds that it has.

    ``items`` has (paper, kind, nth, node), kind being a field of the evidence, with the type behind a slash for claims.
    """
    both = items.where("node is not null").select("paper", F.explode(F.array("kind", F.lit(ANY))).alias("kind"), "nth", "node")
    rows = both.join(F.broadcast(plan(items.sparkSession)), "kind")
    once = rows.groupBy("paper", "section_ord", "section", "preference", "most", "node").agg(F.min("nth").alias("nth"))
    best = F.min("preference").over(Window.partitionBy("paper", "section_ord"))
    rank = F.row_number().over(Window.partitionBy("paper", "section_ord").orderBy("nth", "node"))
    return once.withColumn("best", best).where("preference = best").withColumn("rank", rank).where("rank <= most").select("paper", "section_ord", "section", "node", "rank")


def node_text(sources: DataFrame, nodes: DataFrame) -> DataFrame:
    """Sources with the text of their node: its lines, else its summary, else nothing. ``nodes`` has (paper, id, section_text, summary).

    A paper's nodes come to its sources as one list, so that tables that are dealt out by paper are joined where they are.
    """
    listed = nodes.groupBy("paper").agg(F.collect_list(F.struct("id", text.or_default("section_text", "summary").alias("t"))).alias("_nodes"))
    own = F.transform(F.filter("_nodes", lambda n: n["id"] == F.col("node")), lambda n: n["t"])
    return sources.join(listed, "paper", "left").withColumn("section_text", F.explode_outer(own)).withColumn("section_text", F.coalesce("section_text", F.lit(""))).drop("_nodes")


def method_packs(sources: DataFrame, claims: DataFrame) -> DataFrame:
    """(paper, section_plan, structured): one nested document per paper."""
    source = F.struct("rank", "node", "section_text")
    planned = sources.groupBy("paper", "section_ord", "section").agg(F.array_sort(F.collect_list(source)).alias("source_nodes"))
    plans = planned.groupBy("paper").agg(F.array_sort(F.collect_list(F.struct("section_ord", "section", "source_nodes"))).alias("section_plan"))
    fields = claims.groupBy("paper", "claim_type").agg(F.array_sort(F.collect_list(F.struct("nth", "text"))).alias("items"))
    structured = fields.groupBy("paper").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("claim_type", F.transform("items", lambda x: x["text"]).alias("items"))))).alias("structured"))
    return plans.join(structured, "paper", "left")


def complete(packs: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Packs each of whose required sections has a source with text."""
    have = F.transform(F.filter("section_plan", lambda s: F.exists(s["source_nodes"], lambda n: F.trim(n["section_text"]) != "")), lambda s: s["section"])
    return packs.where(F.size(F.array_except(F.array(*map(F.lit, required)), have)) == 0)


def family_rows(members: DataFrame, claims: DataFrame) -> DataFrame:
    """(family, paper, method, result, limitation): the first claim of each kind per member, for comparison."""
    first = lambda kind: F.min_by("text", F.when(F.lower("claim_type") == kind, F.col("nth"))).alias(kind)
    rows = claims.groupBy("paper").agg(*[first(k) for k in ("method", "result", "limitation")])
    return members.join(rows, "paper", "left")


def references(targets: DataFrame) -> DataFrame:
    """(target, references): distinct paper ids in order. ``targets`` has (target, ord, paper)."""
    return targets.where("paper is not null").groupBy("target").agg(F.array_distinct(F.array_sort(F.collect_list(F.struct("ord", "paper")))["paper"]).alias("references"))


def harvest(items: DataFrame) -> DataFrame:
    """Distinct names in the order in which they first appear."""
    return items.where(F.coalesce(F.trim("name"), F.lit("")) != "").groupBy("name").agg(F.min("ord").alias("ord")).orderBy("ord")


def spliced(chapters: DataFrame, rewrites: DataFrame, verdicts: DataFrame, key: str = "chapter_id") -> DataFrame:
    """Chapters with a rewritten text where there is one that passed."""
    good = rewrites.join(verdicts.where("passed").select(key), key, "left_semi").select(key, F.col("text").alias("_new"))
    return chapters.join(good, key, "left").withColumn("text", F.coalesce("_new", "text")).drop("_new")


def figure_candidates(docs: DataFrame, key: str = "paper", body: str = "text") -> DataFrame:
    """(paper, line, caption, source_url, nth, score): images of a text in markdown form, each address once, scored by caption."""
    from .quality import allowed_image

    rows = docs.select(F.col(key).alias("paper"), F.posexplode(text.lines(F.coalesce(F.col(body), F.lit("")))).alias("pos", "line"))
    image = r"!\[([^\]]*)\]\((https?://[^)]+)\)"
    found = rows.where(F.col("line").rlike(image)).select("paper", (F.col("pos") + 1).alias("line"), text.clean_caption(F.coalesce(F.nullif(F.trim(F.regexp_extract("line", image, 1)), F.lit("")), F.lit("Paper figure"))).alias("caption"), F.trim(F.regexp_extract("line", image, 2)).alias("source_url"))
    once = found.where(allowed_image(F.col("source_url"))).groupBy("paper", "source_url").agg(F.min(F.struct("line", "caption")).alias("f")).select("paper", "source_url", "f.*")
    nth = F.row_number().over(Window.partitionBy("paper").orderBy("line")) - 1
    return once.withColumn("nth", nth).withColumn("score", text.caption_score(F.col("caption"), F.col("nth")))


def best_figures(candidates: DataFrame, limit: int = 1) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("paper").orderBy(F.desc("score"), "nth"))
    return candidates.withColumn("rank", rank).where(F.col("rank") <= limit)


def picked_sentences(docs: DataFrame, k: int, least: int = 25, key: str = "paper", body: str = "text") -> DataFrame:
    """(paper, nth, sentence): the first ``k`` sentences of at least ``least`` characters, each once whatever its case."""
    rows = docs.select(F.col(key).alias("paper"), F.posexplode(text.sentences(F.coalesce(F.col(body), F.lit("")))).alias("pos", "sentence")).where(F.length("sentence") >= least)
    once = rows.groupBy("paper", F.lower("sentence").alias("_low")).agg(F.min(F.struct("pos", "sentence")).alias("s")).select("paper", "s.*")
    nth = F.row_number().over(Window.partitionBy("paper").orderBy("pos"))
    return once.withColumn("nth", nth).where(F.col("nth") <= k).select("paper", "nth", "sentence")


def concept_pattern(concept: str) -> str:
    """Whole words of a concept in lower case, with a plural s where it has none."""
    words = concept.lower().split()
    plural = "" if not words or words[-1].endswith("s") else "s?"
    return rf"(?<!\w){r'\s+'.join(map(re.escape, words))}{plural}(?!\w)"


def gap_scope(explicit: list[str], concepts: list[str], evidence: str, most: int = 3) -> list[str]:
    """Explicit gaps, else concepts that the evidence names, longest first, unless each place lies within one already taken."""
    if explicit:
        return explicit[:most]
    low, taken, out = evidence.lower(), [], []
    for concept in sorted(concepts, key=lambda c: -len(c.split())):
        places = [m.span() for m in re.finditer(concept_pattern(concept), low)] if concept.split() else []
        inside = all(any(a >= s and b <= e for s, e in taken) for a, b in places)
        if places and not inside:
            out.append(concept)
            taken += places
            if len(out) == most:
                break
    return out


def gap_scopes(methods: DataFrame, concepts: list[str], most: int = 3) -> DataFrame:
    """Methods (…, explicit, evidence) with the column gap_scope."""

    @pandas_udf("array<string>")
    def scope(explicit: pd.Series, evidence: pd.Series) -> pd.Series:
        return pd.Series([gap_scope(list(x) if x is not None else [], concepts, e or "", most) for x, e in zip(explicit, evidence, strict=True)])

    return methods.withColumn("gap_scope", scope("explicit", "evidence"))


def chapter_text(pack_sentences: DataFrame, least_words: int = 1500) -> DataFrame:
    """(paper, text, words, long_enough): a draft from a pack's sentences, section by section.

    ``pack_sentences`` has (paper, section_ord, section, nth, sentence, node).
    """
    cite = F.concat(F.lit("[arxiv:"), F.col("paper"), F.lit(", "), F.col("node"), F.lit("]"))
    parts = pack_sentences.groupBy("paper", "section_ord", "section").agg(F.array_sort(F.collect_list(F.struct("nth", "sentence", cite.alias("cite")))).alias("s"))
    section = F.concat(F.lit("## "), F.col("section"), F.lit("\n\n"), F.array_join(F.transform("s", lambda x: x["sentence"]), " "), F.lit(" "), F.array_join(F.array_distinct(F.transform("s", lambda x: x["cite"])), " "))
    whole = parts.groupBy("paper").agg(F.array_sort(F.collect_list(F.struct("section_ord", section.alias("t")))).alias("t")).select("paper", F.array_join(F.transform("t", lambda x: x["t"]), "\n\n").alias("text"))
    words = F.regexp_count(F.col("text"), F.lit(f"{text.WORD}+"))
    return whole.withColumn("words", words).withColumn("long_enough", F.col("words") >= least_words)


def json_pack(packs: DataFrame) -> Column:
    return F.to_json(F.struct("paper", "section_plan", "structured"))

"""A book as relations: its outline, packs, chapters and manifest, what is wrong with them, and what is written from them.

Relations: ``methods`` (id, title, paper_id, family_id), ``families`` (id, title, is_group), ``members`` (family_id, method_id,
ord), ``parts`` (id, title, ord), ``placed`` (part_id, family_id, ord), ``sections`` (id, title, ord), ``chapters`` (kind, id, text),
``packs`` (method_id, section, section_text), ``manifest`` (chapter_id, chapter_type, status, word_count). Every rule is a filter, an
aggregate or an anti-join of these, so a book of any number of chapters is checked without gathering it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources.landing import durable
from .quality import FAMILY_WORDS, METHOD_WORDS, PLACEHOLDERS, all_of, issues

# The sections of a book and their files, the headings of its chapters, the sections that a pack needs.
BOOK_FILES = {
    "preface": "00_preface.md", "motivating_intro": "01_motivating_intro.md", "core_concepts": "02_core_concepts.md", "goals": "03_goals.md",
    "method_taxonomy": "04_method_taxonomy.md", "shared_examples": "05_shared_examples.md", "evaluation_outlook": "98_evaluation_outlook.md", "appendices": "appendices",
}
FAMILY_HEADINGS = ["## Summary", "## Motivation", "## Core Idea", "## Common Pipeline", "## Main Variants", "## Representative Methods", "## Strengths", "## Limitations", "## When to Use", "## Related Families"]
METHOD_HEADINGS = ["## Summary", "## Motivation", "## Intuition", "## Theory", "## Algorithm", "## Worked Example", "## Interpretation", "## Strengths", "## Limitations", "## Practical Guidance", "## Related Methods"]
PACK_SECTIONS = ["algorithm", "example", "limitations", "theory"]
#: Sections of a method's chapter that may hold citations alone.
CITATION_SECTIONS = ["software", "related methods", "references"]
# What a noisy title holds, and what an id that is a section's heading looks like.
NOISY_WORDS = ["report", "reports", "reported", "achieve", "achieves", "outperform", "outperforms", "reache", "reaches", "improve", "improves", "speedup", "acceleration", "trained with"]
NOISY_BEFORE_NUMBER = ["use", "uses", "on", "with"]
NOISY_UNITS = ["x", "%", "k", "m", "b"]
HEADING_IDS, HEADING_ID = ["problem-formulation", "prefilling-stage", "observation-window"], "pre-filling"
STANDALONE, STANDALONE_PART = "standalone", "standalone_methods"
LEAST_PARTS, MOST_PARTS, TITLE_CHARS, COPIED_LINES, SECTION_WORDS = 2, 5, 70, 8, 20
EXCLUDED = "excluded_"


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def is_heading_id(c: Column | str) -> Column:
    low = F.lower(text.col(c))
    inside = low.rlike("|".join(HEADING_IDS))
    return low.rlike("^[0-9]") | inside | (low == HEADING_ID)


def is_noisy_title(c: Column | str) -> Column:
    """A title that says a result: marks that end a sentence, numbers with a unit, words of a report."""
    low = F.lower(F.coalesce(text.col(c), F.lit("")))
    units = "|".join(NOISY_UNITS)
    number = low.rlike(rf"[0-9](?:\.[0-9]+)?\s*(?:{units})(?![a-z0-9_])(?<=[a-z0-9_])|[0-9]\s*%(?=[a-z0-9_])")
    before = low.rlike(rf"(?<![a-z0-9_])(?:{'|'.join(NOISY_BEFORE_NUMBER)}) [0-9]+(?![a-z0-9_])")
    return (F.length(text.col(c)) > TITLE_CHARS) | low.rlike("[.!?]") | number | before | low.rlike(text.any_term(NOISY_WORDS))


def part_issues(parts: DataFrame, placed: DataFrame, families: DataFrame) -> DataFrame:
    """Two to five parts besides that of standalone methods, or that one alone in a book without other families."""
    own = F.count_if(F.col("id") != STANDALONE_PART).alias("own")
    n = parts.agg(own, F.count_if(F.col("id") == STANDALONE_PART).alias("alone"))
    others = families.agg(F.count_if(~_blank("id") & (F.col("id") != STANDALONE)).alias("others"))
    count = n.join(F.broadcast(others), F.lit(True)).where(~F.col("own").between(LEAST_PARTS, MOST_PARTS) & ~((F.col("own") == 0) & (F.col("alone") == 1) & (F.col("others") == 0)))
    bad = issues(count, "parts_count_out_of_range", F.col("own"))
    wrong = F.broadcast(bad.select(F.lit(True).alias("_stop")).limit(1))
    first = F.row_number().over(Window.partitionBy("family_id").orderBy("part_ord", "ord"))
    order = parts.select(F.col("id").alias("part_id"), F.col("ord").alias("part_ord"))
    seen = placed.join(order, "part_id").withColumn("nth", first)
    rest = all_of(
        issues(parts.join(placed.select(F.col("part_id").alias("id")), "id", "left_anti"), "empty_part", F.col("id")),
        issues(seen.where("nth > 1"), "family_in_multiple_parts", F.concat_ws(" ", "family_id", "part_id")),
        issues(families.where(~_blank("id")).select(F.col("id").alias("family_id")).distinct().join(placed, "family_id", "left_anti"), "family_unassigned_to_part", F.col("family_id")),
    )
    return bad.unionByName(rest.join(wrong, F.lit(True), "left_anti"))


def memberships(methods: DataFrame, members: DataFrame) -> DataFrame:
    """(method_id, family_id, listed, first_family): each method with how many families list it, and the first of them."""
    counts = members.groupBy("method_id").agg(F.count(F.lit(1)).alias("listed"), F.min_by("family_id", F.struct("family_id", "ord")).alias("first_family"))
    rows = methods.select(F.col("id").alias("method_id"), "family_id")
    return rows.join(counts, "method_id", "left").withColumn("listed", F.coalesce("listed", F.lit(0)))


def repeated_titles(families: DataFrame) -> DataFrame:
    """(title, families): normalised titles that several families have."""
    rows = families.select(text.title_key("title").alias("title"), "id").where("title <> ''")
    return rows.groupBy("title").agg(F.array_sort(F.collect_list("id")).alias("families")).where(F.size("families") > 1)


def outline_issues(methods: DataFrame, families: DataFrame, members: DataFrame, sections: DataFrame, promoted: DataFrame, verified: DataFrame) -> DataFrame:
    """Rules over the outline; ``promoted`` and ``verified`` are ids of papers."""
    order = sections.agg(F.coalesce(F.array_join(F.array_sort(F.collect_list(F.struct("ord", "id")))["id"], ","), F.lit("")).alias("ids"))
    papers = methods.where(~_blank("paper_id")).groupBy("paper_id").agg(F.count(F.lit(1)).alias("n"))
    required = verified.select("paper_id").distinct().join(papers, "paper_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    unverified = papers.join(verified.select("paper_id"), "paper_id", "left_anti").join(promoted.select("paper_id"), "paper_id", "left_semi")
    known = methods.select(F.col("id").alias("method_id")).distinct()
    own = families.select(F.col("id").alias("family_id"))
    listed = memberships(methods, members)
    return all_of(
        issues(order.where(F.col("ids") != ",".join(BOOK_FILES)), "invalid_book_sections", F.col("ids")),
        issues(methods.where(~_blank("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "duplicate_method_id", F.col("id")),
        issues(required.where("n = 0"), "promoted_paper_without_method", F.col("paper_id")),
        issues(required.where("n > 1"), "promoted_paper_with_multiple_methods", F.col("paper_id")),
        issues(unverified, "unverified_promoted_paper_with_method", F.col("paper_id")),
        issues(families.where(is_noisy_title("title")), "noisy_family_title", F.col("id")),
        issues(own.join(members, "family_id", "left_anti"), "family_without_methods", F.col("family_id")),
        issues(members.join(own, "family_id", "left_semi").join(known, "method_id", "left_anti"), "family_references_missing_method", F.concat_ws(" ", "family_id", "method_id")),
        issues(repeated_titles(families), "duplicate_family_title", F.concat_ws(" ", "title", F.array_join("families", ","))),
        issues(methods.join(own, "family_id", "left_anti"), "method_family_id_missing", F.col("id")),
        issues(listed.where("listed = 0"), "method_not_listed_in_family", F.col("method_id")),
        issues(listed.where("listed > 1"), "method_listed_in_multiple_families", F.col("method_id")),
        issues(listed.where((F.col("listed") == 1) & ~F.col("first_family").eqNullSafe(F.col("family_id"))), "method_family_id_mismatch", F.col("method_id")),
        issues(methods.where(is_heading_id("id")), "section_heading_method_id", F.col("id")),
    )


def measures(chapters: DataFrame) -> DataFrame:
    """Chapters with words, equations, pseudocode (pairs of marks), citations and copied outline lines."""
    body = text.body("text")
    return chapters.select(
        "kind", "id", text.word_count("text").alias("words"),
        F.floor(F.regexp_count("text", F.lit(r"\$\$")) / 2).alias("equations"),
        F.floor(F.regexp_count("text", F.lit("```")) / 2).alias("pseudocode"),
        F.regexp_count(body, F.lit(r"\[arxiv:[^\]]+\]")).alias("citations"),
        text.copied_outline_lines("text").alias("copied"),
    )


def section_bodies(chapters: DataFrame) -> DataFrame:
    """(kind, id, title, body): the second-level sections of chapters; bodies under equal titles are put together."""
    rows = chapters.select("kind", "id", F.posexplode(F.split(F.concat(F.lit("\n"), text.body("text")), r"\n## ", -1)).alias("n", "part")).where("n > 0")
    head = F.regexp_extract("part", r"^([^\n]*)", 1)
    rows = rows.select("kind", "id", "n", F.lower(text.strip(head)).alias("title"), F.substr("part", F.length(head) + 1).alias("body"))
    joined = F.array_join(F.array_sort(F.collect_list(F.struct("n", "body")))["body"], "\n")
    return rows.groupBy("kind", "id", "title").agg(F.min("n").alias("n"), joined.alias("body"))


def chapter_issues(chapters: DataFrame, families: DataFrame, methods: DataFrame, files: DataFrame) -> DataFrame:
    """Rules over the texts of chapters; ``files`` (path) are the files below the book's folder.

    Every rule reads the texts, so they are written once: what they are made of is then neither computed nor planned again for each rule.
    """
    chapters = durable(chapters.select("kind", "id", "text"), "chapters")
    f = families.where(~F.coalesce("is_group", F.lit(False)) & ~_blank("id")).select("id")
    m = methods.where(~_blank("id")).select("id").distinct()
    own = {"families": chapters.where("kind = 'families'").join(f, "id", "left_semi"), "methods": chapters.where("kind = 'methods'").join(m, "id", "left_semi")}
    gone = excluded_chapters(chapters).where(F.col("kind").isin("families", "methods")).select("id")
    taxonomy = chapters.where((F.col("kind") == "book") & (F.col("id") == "method_taxonomy")).select("text")
    links = taxonomy.select(F.explode(F.regexp_extract_all("text", F.lit(r"\.\./(?:families|methods)/[^\s()]*?\.md"), F.lit(0))).alias("link")).distinct()
    expected = [(kind, rows.join(gone, "id", "left_anti").withColumn("link", F.concat(F.lit(f"../{kind}/"), "id", F.lit(".md")))) for kind, rows in (("families", f), ("methods", m))]
    needed = chapters.sparkSession.createDataFrame([(k, p) for k, v in BOOK_FILES.items() for p in ([f"{v}/{x}.md" for x in ("glossary", "notation", "datasets", "software", "references")] if k == "appendices" else [v])], "id string, path string")
    absent = needed.join(files.select("path").distinct(), "path", "left_anti").select("id").distinct()
    out = [
        issues(absent, "missing_book_chapter", F.col("id")),
        issues(f.join(own["families"], "id", "left_anti"), "missing_family_chapter", F.col("id")),
        issues(m.join(own["methods"], "id", "left_anti"), "missing_method_chapter", F.col("id")),
    ]
    for kind, rows in expected:
        out.append(issues(rows.join(links, "link", "left_anti"), f"method_taxonomy_missing_{'family' if kind == 'families' else 'method'}_link", F.col("id")))
    headed = durable(chapters.where(F.col("kind").isin("families", "methods")).select("kind", "id", text.second_headings("text").alias("heads")), "headings")
    for kind, heads in (("families", FAMILY_HEADINGS), ("methods", METHOD_HEADINGS)):
        diff = headed.where(F.col("kind") == kind).join(f if kind == "families" else m, "id", "left_semi").select("id", text.listed_diff(F.col("heads"), heads).alias("d"))
        wrong = diff.where((F.size("d.missing") > 0) | (F.size("d.extra") > 0) | F.col("d.out_of_order"))
        out.append(issues(wrong, "wrong_chapter_headings", F.concat_ws("/", F.lit(kind), "id")))
    size = measures(own["families"].unionByName(own["methods"]))
    sections = section_bodies(own["methods"]).where(~F.col("title").isin(CITATION_SECTIONS))
    thin = sections.where(F.regexp_count(text.without_citations("body"), F.lit(f"{text.WORD}+")) < SECTION_WORDS)
    return all_of(
        *out,
        issues(size.where(f"kind = 'families' and words < {FAMILY_WORDS}"), "family_chapter_word_count_low", F.col("id")),
        issues(own["families"].where(F.col("text").rlike(text.any_term(PLACEHOLDERS))), "family_placeholder_prose", F.col("id")),
        issues(size.where(f"kind = 'methods' and words < {METHOD_WORDS}"), "method_chapter_word_count_low", F.col("id")),
        issues(size.where(f"kind = 'methods' and copied >= {COPIED_LINES}"), "method_chapter_copied_source_outline", F.col("id")),
        issues(thin.groupBy("id").agg(F.min_by("title", "n").alias("title")), "method_chapter_citation_only_section", F.concat_ws(":", "id", "title")),
    )


def pack_issues(methods: DataFrame, packs: DataFrame) -> DataFrame:
    """Methods without a pack, or with one that lacks text for a section it needs."""
    ids = methods.where(~_blank("id")).select(F.col("id").alias("method_id")).distinct()
    full = F.array_sort(F.collect_set(F.when(F.coalesce(text.strip("section_text"), F.lit("")) != "", F.replace(text.title_key("section"), F.lit(" "), F.lit("_")))))
    have = packs.groupBy("method_id").agg(full.alias("have")).join(ids, "method_id", "left_semi")
    lacking = have.withColumn("lacks", F.array_except(F.array(*map(F.lit, PACK_SECTIONS)), "have")).where(F.size("lacks") > 0)
    return all_of(
        issues(ids.join(packs, "method_id", "left_anti"), "missing_method_pack", F.col("method_id")),
        issues(lacking, "method_pack_missing_required_section_text", F.concat_ws(" ", "method_id", F.array_join("lacks", ","))),
    )


def manifest_issues(manifest: DataFrame) -> DataFrame:
    """Chapters that are marked as passed and are too short, and those that did not pass."""
    short = lambda kind, least: manifest.where((F.col("status") == "passed") & (F.col("chapter_type") == kind) & (F.coalesce("word_count", F.lit(0)) < least))
    return all_of(
        issues(short("method", METHOD_WORDS), "passed_method_chapter_word_count_low", F.col("chapter_id")),
        issues(short("family", FAMILY_WORDS), "passed_family_chapter_word_count_low", F.col("chapter_id")),
        issues(manifest.where(~F.col("status").eqNullSafe("passed")), "chapter_not_passed", F.concat_ws(":", "chapter_type", "chapter_id"), "warning"),
    )


def excluded_chapters(chapters: DataFrame) -> DataFrame:
    """(kind, id, status, reason) of chapters whose front matter says that they are excluded; its id counts before the file's."""
    rows = chapters.select("kind", F.coalesce(text.front_value("text", "chapter_id"), "id").alias("id"), text.front_value("text", "status").alias("status"), F.coalesce(text.front_value("text", "status_reason"), F.lit("")).alias("reason"))
    return rows.where(F.startswith("status", F.lit(EXCLUDED)))


def current_chapters(chapters: DataFrame, packs: DataFrame) -> DataFrame:
    """(kind, id, current): whether a chapter shows the first image of its pack, where the pack has one.

    ``packs`` has (kind, id, markdown_image); chapters without a pack or an image, and those of the book itself, are current.
    """
    image = packs.select("kind", "id", text.strip("markdown_image").alias("_image"))
    rows = chapters.join(image, ["kind", "id"], "left")
    bound = F.col("kind").isin("families", "methods") & (F.coalesce("_image", F.lit("")) != "")
    return rows.select("kind", "id", (~bound | F.contains("text", "_image")).alias("current"))


def chapter_manifest(targets: DataFrame, chapters: DataFrame, verification: DataFrame, statuses: Column) -> DataFrame:
    """(chapter_type, chapter_id, status, word_count, equations, pseudocode, file) of all targets (kind, id).

    Counts come from the verification (kind, id, word_count, equations, pseudocode, and what ``statuses`` reads) where it has
    any, else from the text; a target without a chapter counts nothing.
    """
    kinds = F.create_map(*map(F.lit, ("families", "family", "methods", "method", "book", "book")))
    zero = lambda c: F.when(F.col(c) != 0, F.col(c))
    seen = measures(chapters).select("kind", "id", F.col("words").alias("_words"), F.col("equations").alias("_equations"), F.col("pseudocode").alias("_pseudocode"))
    rows = targets.join(seen, ["kind", "id"], "left").join(verification.withColumn("verified", F.lit(True)), ["kind", "id"], "left")
    counts = {c: F.coalesce(zero(c), F.col(f"_{own}"), F.lit(0)).cast("long") for c, own in (("word_count", "words"), ("equations", "equations"), ("pseudocode", "pseudocode"))}
    rows = rows.withColumns(counts)
    folder = F.when(F.col("kind") == "book", "book").otherwise(F.col("kind"))
    return rows.select(F.try_element_at(kinds, F.col("kind")).alias("chapter_type"), F.col("id").alias("chapter_id"), statuses.alias("status"), "word_count", "equations", "pseudocode", F.concat(F.lit("14_chapters/"), folder, F.lit("/"), "id", F.lit(".md")).alias("file"))


def shard_rows(shards: DataFrame, files: DataFrame) -> DataFrame:
    """(shard, nth, line): the rows of each shard's table behind its heading; of two places of the file the first that is there counts.

    ``shards`` has (shard, ord), ``files`` (shard, place, text) with place 0 before place 1.
    """
    one = files.groupBy("shard").agg(F.min_by("text", "place").alias("text"))
    rows = shards.join(one, "shard").select("shard", "ord", F.posexplode(text.lines("text")).alias("n", "line")).where((F.col("n") > 0) & (F.trim("line") != ""))
    return rows.select("shard", F.struct("ord", "n").alias("nth"), "line")


def shard_items(shards: DataFrame, rounds: DataFrame) -> DataFrame:
    """(shard, nth, item): the items of each shard's report, or the report itself if it has none and is completed.

    ``rounds`` has (shard, place, report) with the report as JSON; the first place counts.
    """
    one = rounds.groupBy("shard").agg(F.min_by("report", "place").alias("report"))
    items = F.coalesce(F.from_json(F.get_json_object("report", "$.items"), "array<string>"), F.array().cast("array<string>"))
    done = F.get_json_object("report", "$.status") == "completed"
    held = F.when(F.size(items) > 0, items).when(done, F.array("report")).otherwise(F.array().cast("array<string>"))
    return shards.join(one, "shard").select("shard", "ord", F.posexplode(held).alias("n", "item")).select("shard", F.struct("ord", "n").alias("nth"), "item")


def rename_references(rows: DataFrame, column: str, renamed: DataFrame) -> DataFrame:
    """The rows with each old id of ``renamed`` (old_id, new_id) in a column written as its new one."""
    names = renamed.select(F.col("old_id").alias(column), F.col("new_id").alias("_new"))
    return rows.join(names, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def heading_renames(methods: DataFrame) -> DataFrame:
    """(old_id, new_id) for methods whose id is a section's heading: the slug of their title, with the next free number behind.

    Numbers that other ids use already are skipped; of methods that want one slug the first by ord takes the first number.
    """
    slug = text.method_slug(text.or_default("title", "paper_id"))
    slug = F.when(is_heading_id(F.coalesce(slug, F.lit("method"))), F.lit("method")).otherwise(F.coalesce(slug, F.lit("method")))
    bad = methods.where(is_heading_id("id")).select("id", "ord", slug.alias("base"))
    wanted = bad.withColumn("nth", F.row_number().over(Window.partitionBy("base").orderBy("ord")))
    kept = methods.where(~is_heading_id("id")).select("id").distinct()
    stem, number = F.regexp_extract("id", r"^(.*)-([0-9]+)$", 1), F.regexp_extract("id", r"^(.*)-([0-9]+)$", 2).try_cast("int")
    numbered = kept.where(F.coalesce(number, F.lit(0)) >= 2).select(stem.alias("base"), number.alias("k"))
    taken = kept.select(F.col("id").alias("base"), F.lit(1).alias("k")).unionByName(numbered)
    per_base = wanted.select("base").distinct().join(taken, "base", "left").groupBy("base").agg(F.collect_set("k").alias("used"))
    most = wanted.groupBy("base").agg(F.max("nth").alias("most"))
    free = per_base.join(most, "base").select("base", F.array_except(F.sequence(F.lit(1), F.size("used") + F.col("most")), "used").alias("free"))
    rows = wanted.join(free, "base").withColumn("k", F.element_at("free", F.col("nth")))
    return rows.select(F.col("id").alias("old_id"), F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.col("k").cast("string"))).alias("new_id"))


def contents(sections: DataFrame, parts: DataFrame, placed: DataFrame, families: DataFrame, members: DataFrame, methods: DataFrame, excluded: DataFrame) -> DataFrame:
    """(nth, depth, title, path): the entries of a summary or sidebar in their order, without excluded (id) chapters.

    The methods of a group or of an excluded family stand at the family's own depth.
    """
    files = F.create_map(*[F.lit(x) for kv in BOOK_FILES.items() for x in kv])
    file = F.try_element_at(files, F.col("id"))
    place = lambda *n: F.struct(*[F.col(x).cast("long").alias(f"n{i}") if isinstance(x, str) else F.lit(x).cast("long").alias(f"n{i}") for i, x in enumerate(n)])
    gone = excluded.select(F.col("id").alias("_gone")).distinct()
    own = sections.where(file.isNotNull()).join(gone, F.col("id") == F.col("_gone"), "left_anti")
    book = own.select(place(0, "ord", 0, 0).alias("nth"), F.lit(1).alias("depth"), "title", F.concat(F.lit("14_chapters/book/"), file, F.when(F.col("id") == "appendices", "/glossary.md").otherwise("")).alias("path"))
    heads = parts.select(place("ord", -1, 0, 0).alias("nth"), F.lit(0).alias("depth"), "title", F.lit("").alias("path"))
    f = families.select(F.col("id").alias("family_id"), F.col("title").alias("family_title"), F.coalesce("is_group", F.lit(False)).alias("is_group"))
    at = placed.join(parts.select(F.col("id").alias("part_id"), F.col("ord").alias("part_ord")), "part_id").join(f, "family_id")
    at = at.join(gone, F.col("family_id") == F.col("_gone"), "left").withColumn("flat", F.col("is_group") | F.col("_gone").isNotNull()).drop("_gone")
    rows = at.where("not flat").select(place("part_ord", "ord", 0, 0).alias("nth"), F.lit(1).alias("depth"), F.col("family_title").alias("title"), F.concat(F.lit("14_chapters/families/"), "family_id", F.lit(".md")).alias("path"))
    m = methods.groupBy(F.col("id").alias("method_id")).agg(F.max("title").alias("method_title"))
    inner = at.join(members.select("family_id", "method_id", F.col("ord").alias("member_ord")), "family_id").join(gone, F.col("method_id") == F.col("_gone"), "left_anti").join(m, "method_id")
    leaves = inner.select(place("part_ord", "ord", 1, "member_ord").alias("nth"), F.when(F.col("flat"), 1).otherwise(2).alias("depth"), F.col("method_title").alias("title"), F.concat(F.lit("14_chapters/methods/"), "method_id", F.lit(".md")).alias("path"))
    return book.unionByName(heads).unionByName(rows).unionByName(leaves)


def summary_lines(entries: DataFrame) -> DataFrame:
    """(nth, line) of a summary: part headings and nested links, from ``contents``."""
    link = F.concat(F.repeat(F.lit("  "), F.col("depth") - 1), F.lit("- ["), "title", F.lit("](../"), "path", F.lit(")"))
    head = F.concat(F.lit("## Part "), F.col("nth.n0").cast("string"), F.lit(": "), "title")
    return entries.select("nth", F.when(F.col("depth") == 0, head).otherwise(link).alias("line"))


def path_slug(path: Column | str) -> Column:
    """The address of a chapter's file: without the folder of chapters in front and the ending behind."""
    p = F.regexp_replace(text.col(path), r"^14_chapters[^/]*/", "")
    return F.regexp_replace(p, r"\.mdx?$", "")


def base_path(c: Column | str) -> Column:
    """A base address with one slash in front and none behind; nothing where there is none."""
    inner = F.btrim(text.strip(F.coalesce(text.col(c), F.lit(""))), F.lit("/"))
    return F.when(inner == "", "").otherwise(F.concat(F.lit("/"), inner))


def href(base: Column | str, path: Column | str) -> Column:
    """A path below a base address; a slash at its end stays."""
    p = text.col(path)
    return F.concat(base_path(base), F.lit("/"), F.btrim(p, F.lit("/")), F.when(F.endswith(p, F.lit("/")), "/").otherwise(""))


def walk(items: DataFrame) -> DataFrame:
    """(ord, depth, title, path) of every item of navigation trees, children after their parents, whatever the depth.

    ``items`` has (ord, item) with item a JSON text {title, path, children}. One step goes over all items of a level.
    """
    level = items.select(F.lpad(F.col("ord").cast("string"), 6, "0").alias("ord"), "item")
    out, depth = None, 0
    while True:
        rows = level.select("ord", F.lit(depth).alias("depth"), F.get_json_object("item", "$.title").alias("title"), F.get_json_object("item", "$.path").alias("path"))
        out = rows if out is None else out.unionByName(rows)
        level = level.select("ord", F.posexplode(F.from_json(F.get_json_object("item", "$.children"), "array<string>")).alias("n", "child"))
        level = level.select(F.concat_ws(".", "ord", F.lpad(F.col("n").cast("string"), 6, "0")).alias("ord"), F.col("child").alias("item"))
        level = durable(level, "level")  # else each level would compute those before it anew
        if level.isEmpty():
            return out
        depth += 1


def method_pages(entries: DataFrame) -> DataFrame:
    """(ord, title, slug) of the methods that navigation leads to, from ``walk``."""
    rows = entries.where(F.contains("path", F.lit("/methods/")))
    return rows.select("ord", F.coalesce(F.nullif("title", F.lit("")), F.regexp_extract("path", r"([^/]+?)(?:\.[^./]+)?$", 1)).alias("title"), path_slug("path").alias("slug"))


def book_packs(sections: DataFrame, topic: str, known: DataFrame, found: DataFrame, families: DataFrame, methods: DataFrame) -> DataFrame:
    """(section_id, pack): what each of the book's few sections is written from; the lists are those of one book."""
    listed = lambda rows, c: rows.agg(F.array_sort(F.collect_set(c)).alias("v"))
    facts = listed(known, "concept").withColumnRenamed("v", "known_concepts")
    for name, rows, c in (("knowledge_gaps", found, "concept"), ("families", families, "id"), ("methods", methods, "id")):
        facts = facts.join(F.broadcast(listed(rows, c).withColumnRenamed("v", name)), F.lit(True))
    rows = sections.join(F.broadcast(facts), F.lit(True))
    data = F.struct(F.lit(topic).alias("topic"), "known_concepts", "knowledge_gaps", "families", "methods")
    return rows.select(F.col("id").alias("section_id"), F.to_json(F.struct(F.lit("book").alias("pack_type"), F.col("id").alias("section_id"), F.col("title").alias("section_title"), data.alias("data"))).alias("pack"))


def packs_to_write(targets: DataFrame, written: DataFrame, complete: DataFrame) -> DataFrame:
    """(kind, id, action): skipped where a pack is there (and, for a method, has its text), else built if it can be, else left.

    ``written`` and ``complete`` have (kind, id): packs that are there, and packs of methods whose needed sections have text.
    """
    w, c = (rows.select("kind", "id", F.lit(True).alias(n)) for rows, n in ((written.distinct(), "_written"), (complete.distinct(), "_complete")))
    rows = targets.join(w, ["kind", "id"], "left").join(c, ["kind", "id"], "left")
    method, there, full = F.col("kind") == "methods", F.col("_written").isNotNull(), F.col("_complete").isNotNull()
    return rows.select("kind", "id", F.when(there & (~method | full), "skipped").when(~method | full, "built").otherwise("left").alias("action"))

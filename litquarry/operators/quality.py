"""Contracts as queries: each rule gives a row (severity, code, detail) for each violation; no row means that all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

METHOD_WORDS, FAMILY_WORDS = 1500, 1000
# Prose that a generator leaves where it had nothing to say.
PLACEHOLDERS = ["serves as a navigation layer", "variations on the same engineering pressure", "this file is regenerated deterministically", "too thin"]
# Fixed value: issues of form that alone do not exclude a chapter; a suffix stands for further ones.
SOFT_ISSUES, SOFT_SUFFIX = ["method_word_count_high", "family_word_count_high"], "_word_count_high"


def issues(rows: DataFrame, code: str, detail: Column, severity: str = "error") -> DataFrame:
    return rows.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))


def all_of(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def require(found: DataFrame) -> None:
    """Raise if any rule of severity error is broken; the message names up to ten violations."""
    worst = found.where("severity = 'error'").limit(10).collect()
    if worst:
        raise ValueError("; ".join(f"{r['code']}: {r['detail']}" for r in worst))


def duplicates(rows: DataFrame, key: str, code: str) -> DataFrame:
    return issues(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), code, F.col(key))


def missing(rows: DataFrame, of: DataFrame, key: str, code: str) -> DataFrame:
    """Keys of ``rows`` that are not in ``of``."""
    return issues(rows.select(key).distinct().join(of.select(key), key, "left_anti"), code, F.col(key))


def same_set(left: DataFrame, right: DataFrame, key: str, code: str) -> DataFrame:
    return missing(left, right, key, f"{code}_missing").unionByName(missing(right, left, key, f"{code}_extra"))


def same_multiset(left: DataFrame, right: DataFrame, key: str, code: str) -> DataFrame:
    a, b = left.select(key), right.select(key)
    return issues(a.exceptAll(b), f"{code}_missing", F.col(key)).unionByName(issues(b.exceptAll(a), f"{code}_extra", F.col(key)))


def search_plan(plan: DataFrame, most_queries: dict[str, int] | None = None) -> DataFrame:
    """A plan (aspect_id, normal_queries, survey_queries, positive_keywords): four or five aspects, each with an id, a query and a
    keyword that are not blank and a list of survey queries, which may be empty. ``most_queries`` limits distinct queries by kind."""
    blank = F.coalesce(text.strip("aspect_id"), F.lit("")) == ""
    some = lambda c: F.coalesce(F.exists(c, lambda x: text.strip(x) != ""), F.lit(False))
    count = plan.agg(F.count(F.lit(1)).alias("n")).where("n not between 4 and 5")
    rules = [
        issues(count, "aspect_count", F.col("n")),
        issues(plan.where(blank), "aspect_without_id", F.lit("")),
        *[issues(plan.where(~some(c)), f"aspect_without_{c}", F.col("aspect_id")) for c in ("normal_queries", "positive_keywords")],
        issues(plan.where(F.col("survey_queries").isNull()), "aspect_without_survey_queries", F.col("aspect_id")),
    ]
    for c, most in (most_queries or {}).items():
        distinct = F.size(F.array_distinct(F.filter(F.transform(c, lambda x: text.strip(x)), lambda x: x != "")))
        total = plan.agg(F.sum(F.when(F.col(c).isNotNull(), distinct)).alias("n")).where(F.col("n") > most)
        rules.append(issues(total, f"too_many_{c}", F.col("n")))
    return all_of(*rules)


#: Papers that a pool needs.
LEAST_POOL = 40
KEEP_ALL = "keep_all_bulk_search_results"


def sampled(rows: DataFrame, code: str, detail: str, most: int = 10) -> DataFrame:
    """One violation that names the first ``most`` of the values; none where there are no rows."""
    first = rows.select(detail).distinct().orderBy(detail).limit(most)
    listed = first.agg(F.array_join(F.array_sort(F.collect_list(detail)), ",").alias("d")).where("d <> ''")
    return issues(listed, code, F.col("d"))


def keep_all(seeds: DataFrame, raw: DataFrame, pool: DataFrame, mirror: DataFrame, report: DataFrame, key: str = "paper_id") -> DataFrame:
    """Whether a pool holds all that a search kept.

    ``seeds`` are the ids of the seed pool, ``raw`` those of the preserved search results, ``pool`` and ``mirror`` those of the
    paper pool and its table; ``report`` is one row (total_kept, selected_total, raw_kept, selection_policy).
    """
    n = seeds.agg(F.count(F.lit(1)).alias("n"))
    told = report.join(F.broadcast(n), F.lit(True))
    named = (("seeds", seeds), ("pool", pool), ("mirror", mirror))
    differ = (("raw", raw, seeds), ("pool", pool, seeds), ("mirror", mirror, pool))
    repeated = [sampled(rows.groupBy(key).agg(F.count(F.lit(1)).alias("k")).where("k > 1"), f"{name}_repeated", key) for name, rows in named]
    sets = [sampled(a.select(key).join(b.select(key), key, "left_anti"), f"{name}_{what}", key) for name, own, of in differ for what, a, b in (("missing", of, own), ("extra", own, of))]
    small = pool.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < LEAST_POOL)
    return all_of(
        issues(told.where(~F.col("total_kept").eqNullSafe(F.col("n"))), "total_kept_differs", F.col("total_kept")),
        *repeated,
        *sets,
        issues(small, "pool_too_small", F.col("n")),
        issues(told.where(~F.col("selected_total").eqNullSafe(F.col("n"))), "selected_total_differs", F.col("selected_total")),
        issues(told.where(~F.col("raw_kept").eqNullSafe(F.col("n"))), "raw_kept_differs", F.col("raw_kept")),
        issues(told.where(F.coalesce(F.col("selection_policy") != KEEP_ALL, F.lit(False))), "selection_policy", F.col("selection_policy")),
    )


def bootstrap(pool: DataFrame, weak: DataFrame, promoted: DataFrame, texts: DataFrame, unavailable: DataFrame, indexed: DataFrame, claims: DataFrame, key: str = "paper_id") -> DataFrame:
    """What a run must have made of its pool before it goes on.

    ``weak`` has (key, reader_needed_concepts), ``claims`` (key, node, lines) the claims of verified evidence; the others are ids. A
    promoted paper whose text is listed as unavailable needs nothing more.
    """
    concepts = weak.where(F.coalesce(F.size("reader_needed_concepts"), F.lit(0)) > 0)
    nothing = promoted.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    with_text = promoted.join(texts.select(key), key, "left_semi")
    without = promoted.join(texts.select(key), key, "left_anti").join(unavailable.select(key), key, "left_anti")
    grounded = (F.coalesce(F.trim("node"), F.lit("")) != "") & (F.coalesce(F.size("lines"), F.lit(0)) > 0)
    loose = claims.where(~grounded).join(with_text.select(key), key, "left_semi").select(key).distinct()
    return all_of(
        missing(pool, concepts, key, "no_reader_needed_concepts"),
        issues(nothing, "nothing_promoted", F.lit("")),
        issues(without, "text_missing", F.col(key)),
        missing(with_text, indexed, key, "index_missing"),
        missing(with_text, claims, key, "no_claims"),
        issues(loose, "claim_not_grounded", F.col(key)),
    )


def weak_graph(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return all_of(
        issues(nodes.where(blank("id")), "node_without_id", F.col("display")),
        duplicates(nodes, "id", "node_id_repeated"),
        issues(edges.where(blank("src") | blank("dst") | blank("type")), "edge_incomplete", F.concat_ws(" ", "src", "dst", "type")),
        missing(ends, nodes, "id", "edge_endpoint_unknown"),
    )


def verified_graph(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return all_of(
        issues(edges.where(~F.col("confidence").eqNullSafe("verified")), "edge_not_verified", F.concat_ws(" ", "src", "dst")),
        issues(edges.where(F.col("node").isNull() | (F.coalesce(F.size("lines"), F.lit(0)) == 0)), "edge_not_grounded", F.concat_ws(" ", "src", "dst")),
        missing(ends, nodes, "id", "edge_endpoint_unknown"),
    )


def gap_outputs(queue: DataFrame, digest: DataFrame, most: int = 5, least_priority: float = 0.70, least_queries: int = 2) -> DataFrame:
    """Queue items (concept, priority, search_queries) against the digest (concept)."""
    many = queue.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    return all_of(
        missing(queue, digest, "concept", "concept_not_in_digest"),
        issues(many, "queue_too_long", F.col("n")),
        issues(queue.where(F.col("priority") < least_priority), "priority_too_low", F.col("concept")),
        issues(queue.where(F.size("search_queries") < least_queries), "too_few_queries", F.col("concept")),
    )


def expansion_outputs(rows: DataFrame, pool: DataFrame) -> DataFrame:
    accepted = rows.where("status = 'accepted'")
    return all_of(
        missing(accepted, pool, "paper_id", "accepted_not_in_pool"),
        issues(accepted.where(F.coalesce(F.trim("gap_id"), F.lit("")) == ""), "accepted_without_gap", F.col("paper_id")),
        issues(accepted.where(F.coalesce(F.trim("why_needed"), F.lit("")) == ""), "accepted_without_reason", F.col("paper_id")),
        issues(rows.where(~F.col("status").isin("accepted", "rejected")), "unknown_status", F.col("paper_id")),
    )


def outline(methods: DataFrame, families: DataFrame, verified: DataFrame) -> DataFrame:
    """Methods (id, paper_id, family_id) against families (id) and verified papers (paper_id)."""
    f = families.select(F.col("id").alias("family_id"))
    return all_of(
        same_multiset(verified, methods, "paper_id", "outline_papers"),
        duplicates(methods, "id", "method_id_repeated"),
        issues(methods.join(f, "family_id", "left_anti"), "method_family_unknown", F.col("id")),
        issues(f.join(methods.select("family_id"), "family_id", "left_anti"), "family_without_method", F.col("family_id"), "warning"),
    )


def links(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Links (page, target) that lead nowhere."""
    return issues(rows.join(targets.select("target").distinct(), "target", "left_anti"), "dead_link", F.concat_ws(" -> ", "page", "target"))


def glossary(entries: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return all_of(
        issues(entries.where(blank("term")), "entry_without_term", F.col("definition")),
        issues(entries.where(blank("definition")), "entry_without_definition", F.col("term")),
        issues(entries.where(F.length("definition") > 280), "definition_too_long", F.col("term")),
        issues(entries.where(F.coalesce(F.size("appears_in"), F.lit(0)) <= 0), "entry_without_place", F.col("term")),
    )


def katex_errors(pages: DataFrame) -> DataFrame:
    return issues(pages.where(F.col("html").rlike(r"katex-error|ParseError: KaTeX|Undefined control sequence")), "katex_error", F.col("page"))


def artifacts_present(stages: DataFrame, files: DataFrame) -> DataFrame:
    """Stages (stage, path) whose primary artifact is not among the files (path)."""
    return issues(stages.join(files.select("path").distinct(), "path", "left_anti"), "artifact_missing", F.concat_ws(" ", "stage", "path"))


def valid_items(items: DataFrame, sections: DataFrame, line_fields: list[str]) -> DataFrame:
    """Evidence items (paper, field, nth, node, lines) that point to a section, and in some fields to lines within it."""
    s = sections.select("paper", F.col("id").alias("node"), "start_line", "end_line")
    rows = items.join(s, ["paper", "node"])
    inside = (F.coalesce(F.size("lines"), F.lit(0)) > 0) & F.forall("lines", lambda x: x.between(F.col("start_line"), F.col("end_line")))
    return rows.where(~F.col("field").isin(line_fields) | F.coalesce(inside, F.lit(False))).drop("start_line", "end_line")


def dropped_per_field(items: DataFrame, kept: DataFrame) -> DataFrame:
    return items.join(kept.select("paper", "field", "nth"), ["paper", "field", "nth"], "left_anti").groupBy("field").agg(F.count(F.lit(1)).alias("dropped"))


def blocking(form_issues: Column) -> Column:
    """Issues of form that exclude a chapter."""
    return F.filter(form_issues, lambda x: ~x.isin(SOFT_ISSUES) & ~F.endswith(x, F.lit(SOFT_SUFFIX)))


def chapter_status(kind: Column, present: Column, form_issues: Column, words: Column, passed: Column, unsupported: Column, overstated: Column, gaps: Column) -> Column:
    """The first rung that holds: missing, form, length, passed, claims, evidence, soft issues only, failed."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (
        F.when(~F.coalesce(present, F.lit(False)), "excluded_missing_verification")
        .when(F.size(blocking(form_issues)) > 0, "excluded_form_issues")
        .when((kind == "methods") & (words < METHOD_WORDS) | (kind == "families") & (words < FAMILY_WORDS), "excluded_too_short")
        .when(F.coalesce(passed, F.lit(False)), "passed")
        .when((zero(unsupported) > 0) | (zero(overstated) > 0), "excluded_unsupported_claims")
        .when(zero(gaps) > 0, "excluded_missing_evidence")
        .when(F.size(form_issues) > 0, "passed")
        .otherwise("excluded_verification_failed")
    )


def reachable(chapters: DataFrame, tree_paths: DataFrame) -> DataFrame:
    """Chapters (path) that the navigation tree leads to."""
    return chapters.join(tree_paths.select("path").distinct(), "path", "left_semi")


def publish_blockers(chapters: DataFrame) -> DataFrame:
    """Reachable pages that must not be published: placeholders and mere surveys."""
    return all_of(
        issues(chapters.where(text.is_placeholder_id("chapter_id")), "placeholder_id", F.col("chapter_id")),
        issues(chapters.where(text.is_survey_title("title")), "context_only_page", F.col("chapter_id")),
    )


def safe_component(c: Column) -> Column:
    """A name of one path component that leads nowhere else."""
    return F.coalesce((c != "") & ~c.isin(".", "..") & ~c.rlike(r"[/\\]"), F.lit(False))


def safe_relative(c: Column) -> Column:
    return F.coalesce((c != "") & ~F.startswith(c, F.lit("/")) & ~F.exists(F.split(c, r"[/\\]"), lambda p: p == ".."), F.lit(False))


def allowed_image(url: Column) -> Column:
    """A web address of an image by its ending, or any on the hosts of the papers."""
    path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    host = F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))
    scheme = F.try_parse_url(url, F.lit("PROTOCOL"))
    return F.coalesce(scheme.isin("http", "https") & (host != "") & (path.rlike(r"\.(?:png|jpe?g|gif|svg|webp)$") | F.endswith(host, F.lit("arxiv.org")) | F.endswith(host, F.lit("ar5iv.labs.arxiv.org"))), F.lit(False))


def image_extension(url: Column, content_type: Column) -> Column:
    """The ending under which an image is stored, from its address or else its content type."""
    of_url = F.nullif(F.regexp_extract(F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))), r"\.(png|jpe?g|gif|svg|webp)$", 1), F.lit(""))
    of_type = F.nullif(F.regexp_extract(F.lower(F.trim(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1)))), r"^image/(png|jpe?g|gif|svg|webp)(?:\+xml)?$", 1), F.lit(""))
    return F.concat(F.lit("."), F.replace(F.coalesce(of_url, of_type), F.lit("jpeg"), F.lit("jpg")))


def lacking(have: Column, required: list[str]) -> Column:
    """The required names that are not among those that are there, in the order of the requirement; all of them where there is no list."""
    need = F.array(*map(F.lit, required)) if required else F.array().cast("array<string>")
    return F.array_except(need, F.coalesce(have, F.array().cast("array<string>")))

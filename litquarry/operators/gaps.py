"""The gap digest: which concepts a corpus speaks of, how they rank, and which are worth explaining.

Relations: ``mentions`` has a row for each item of a field (and one more where the item's words are all in the title),
``nodes`` and ``edges`` are the weak graph, ``known`` maps keys to variants of concepts that need no explanation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring, text
from ..sources.landing import durable, numbered

CORE = 4
#: Types of edges that say that a paper works with what they point to.
METHOD_EDGES = ["USES", "INTRODUCES", "USES_DATASET", "EXTENDS"]
#: Candidates kept by rank, in all, and the least score of one without two core papers.
TOP, CAP, LEAST = 150, 180, 0.30
NAME_CHARS, SNIPPET_CHARS, NEIGHBORS, SHOWN_NEIGHBORS = 80, 120, 5, 3
DIGEST_BYTES = 200_000
#: Concepts of a paper whose pairs are formed at once; those of a paper with more are dealt to blocks of about so many.
SIDE = 128


def mention_rows(evidence: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """Items of an evidence table's array fields as rows (paper, title, importance, field, ord, raw)."""

    def of(n: int, name: str) -> Column:
        values = F.coalesce(F.col(name), F.array().cast("array<string>"))
        return F.transform(values, lambda x, i: F.struct(F.lit(n).alias("field"), F.lpad(i.cast("string"), 6, "0").alias("ord"), x.alias("raw")))

    items = F.concat(*[of(n, name) for n, (name, _) in enumerate(fields)])
    score = F.coalesce(F.col("book_usage.importance_score_1_to_5"), F.lit(0)).cast("int")
    return evidence.select(F.col("arxiv_id").alias("paper"), "title", score.alias("importance"), F.inline(items))


def keyed(rows: DataFrame) -> DataFrame:
    """Items with their concept's key; those without one are left out."""
    return rows.where(F.col("raw").isNotNull()).withColumn("norm", text.concept_key("raw")).where("norm <> ''")


def mentions(rows: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """(paper, importance, field, ord, raw, norm, slot, extra); extra is 1 for a row that the title adds."""
    slot = F.element_at(F.array(*[F.lit(s) for _, s in fields]), F.col("field") + 1)
    base = keyed(rows)
    in_title = text.all_words_in(F.col("norm"), text.concept_key(F.coalesce("title", F.lit(""))))
    own, added = F.struct(slot.alias("slot"), F.lit(0).alias("extra")), F.struct(F.lit("title").alias("slot"), F.lit(1).alias("extra"))
    both = F.when(in_title, F.array(own, added)).otherwise(F.array(own))
    return base.select("paper", "importance", "field", "ord", "raw", "norm", F.inline(both))


def evidence_signals(m: DataFrame) -> DataFrame:
    """Per concept: papers, core papers, slots, whether a core paper lists it as method or dataset, first written form."""
    is_core = F.col("importance") >= CORE
    first = F.struct("paper", "field", "ord", "raw")
    return m.groupBy("norm").agg(
        F.count_distinct("paper").alias("paper_count"),
        F.count_distinct(F.when(is_core, F.col("paper"))).alias("core_paper_count"),
        F.array_sort(F.collect_set("slot")).alias("in_slots"),
        F.bool_or(F.when(F.col("field") <= 1, is_core)).alias("method_of_core"),
        F.min(first)["raw"].alias("display"),
    )


def slot_signals(m: DataFrame) -> DataFrame:
    """(norm, in_slots, method_of_core) of ``evidence_signals``; a task sends a concept's slots once each."""
    each = m.groupBy("norm", "slot").agg(F.bool_or(F.when(F.col("field") <= 1, F.col("importance") >= CORE)).alias("moc"))
    return each.groupBy("norm").agg(F.array_sort(F.collect_list("slot")).alias("in_slots"), F.bool_or("moc").alias("method_of_core"))


def paper_counts(m: DataFrame, edges: DataFrame) -> DataFrame:
    """(norm, paper_count, core_paper_count): papers over mentions and edges, and core papers that mention a concept.

    A concept's papers are told apart once for both counts.
    """
    both = m.select("norm", "paper", (F.col("importance") >= CORE).alias("core")).unionByName(edges.select("norm", F.col("src").alias("paper"), F.lit(False).alias("core")))
    papers = both.where("paper is not null").groupBy("norm", "paper").agg(F.bool_or("core").alias("core"))
    return papers.groupBy("norm").agg(F.count(F.lit(1)).alias("paper_count"), F.count_if("core").alias("core_paper_count"))


def concept_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges from a paper to something else than a paper, with the concept's key.

    Few papers are pointed to, so these are found first, and edges are not sorted by where they point to.
    """
    own = nodes.where("type = 'Paper'").select(F.col("id").alias("paper_id")).distinct()
    targets = edges.select("dst").distinct()
    cited = durable(own.join(targets, own["paper_id"] == targets["dst"], "left_semi"), "cited")
    out = edges.join(cited, edges["dst"] == cited["paper_id"], "left_anti").join(own, edges["src"] == own["paper_id"], "left_semi")
    return out.withColumn("norm", text.concept_key("dst"))


def graph_concepts(nodes: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """(norm, display) for nodes that are no papers; the last written form wins. Of ``chosen``, a table of few concepts ``norm``, only these."""
    others = nodes.where(~F.col("type").eqNullSafe("Paper")).withColumn("norm", text.concept_key("id")).where("norm <> ''")
    if chosen is not None:
        others = others.join(F.broadcast(chosen.select("norm").distinct()), "norm", "left_semi")
    return others.groupBy("norm").agg(F.max_by(text.or_default("display", "id"), F.struct("ord", "id", "display")).alias("display"))


def graph_signals(edges: DataFrame, importance: DataFrame) -> DataFrame:
    """Per concept: papers that point to it, and whether a core paper does by an edge of a method. Takes ``concept_edges``."""
    core = importance.where(F.col("importance") >= CORE).select(F.col("paper").alias("core_paper")).distinct()
    e = edges.join(core, edges["src"] == core["core_paper"], "left")
    return e.groupBy("norm").agg(F.count_distinct("src").alias("paper_count"), F.bool_or(F.when(F.col("type").isin(METHOD_EDGES), F.col("core_paper").isNotNull())).alias("method_of_core"))


def union_counts(m: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct papers per concept over mentions and edges."""
    both = m.select("norm", "paper").unionByName(edges.select("norm", F.col("src").alias("paper")))
    return both.groupBy("norm").agg(F.count_distinct("paper").alias("paper_count"))


def _cells(own: DataFrame, side: int) -> DataFrame:
    """(a, b): two lists of concepts of one paper; each pair of different concepts of a paper stands once, in one row.

    A paper of up to ``side`` concepts is one row with its list twice. A hub, one with more, has its concepts dealt to blocks by hash,
    as many as its own number of concepts asks for, and a row for each two blocks: no row has more than about ``side ** 2`` pairs.
    """
    hubs = own.groupBy("src").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > side)
    hubs = durable(hubs.select("src", F.ceil(F.col("_n") / side).alias("_blocks")), "hubs")
    small = own.join(hubs, "src", "left_anti").groupBy("src").agg(F.collect_list("norm").alias("a")).select("a", F.col("a").alias("b"))
    dealt = own.join(hubs, "src").withColumn("_block", F.pmod(F.xxhash64("norm"), F.col("_blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_other")
    spread = dealt.select("src", "norm", "_block", other).select("src", "norm", "_block", F.least("_block", "_other").alias("_lo"), F.greatest("_block", "_other").alias("_hi"))
    of = lambda c: F.collect_list(F.when(F.col("_block") == F.col(c), F.col("norm")))
    return small.unionByName(spread.groupBy("src", "_lo", "_hi").agg(of("_lo").alias("a"), of("_hi").alias("b")).select("a", "b", "_lo", "_hi"), allowMissingColumns=True)


def neighbors(edges: DataFrame, limit: int = NEIGHBORS, side: int = SIDE) -> DataFrame:
    """(norm, neighbor, shared, rank): concepts that share most papers; ties by name.

    Pairs are formed in lists within a row (``_cells``), each unordered pair once, and counted before they are told to both concepts.
    There are many more pairs than concepts, so concepts are numbered in the order of their names, and names come back to what is left.
    """
    named = durable(edges.select("src", "norm").where("src is not null and norm is not null").distinct(), "concepts")
    names = durable(numbered(named.select("norm").distinct(), ["norm"], "id"), "numbers")
    own = durable(named.join(names, "norm").select("src", F.col("id").alias("norm")), "numbered-concepts")
    cells = _cells(own, side)
    one_list = F.col("_lo").isNull() | (F.col("_lo") == F.col("_hi"))
    rows = cells.select(F.explode("a").alias("x"), "b", one_list.alias("_one")).select("x", F.explode("b").alias("y"), "_one")
    pairs = rows.where((F.col("x") < F.col("y")) | ~F.col("_one"))
    counts = pairs.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.count(F.lit(1)).alias("shared"))
    both = F.inline(F.array(F.struct(F.col("x").alias("norm"), F.col("y").alias("neighbor")), F.struct(F.col("y").alias("norm"), F.col("x").alias("neighbor"))))
    rank = F.row_number().over(Window.partitionBy("norm").orderBy(F.desc("shared"), "neighbor"))
    best = counts.select("shared", both).withColumn("rank", rank).where(F.col("rank") <= limit)
    for c in ("norm", "neighbor"):
        best = best.join(names.select(F.col("id").alias(c), F.col("norm").alias(f"_{c}")), c).drop(c).withColumnRenamed(f"_{c}", c)
    return best.select("norm", "neighbor", "shared", "rank")


def known_keys(known: DataFrame) -> DataFrame:
    """(known_key): keys and variants of what is known, normalised."""
    return known.select(F.explode(F.array("key", "variant")).alias("k")).select(text.concept_key("k").alias("known_key")).where("known_key <> ''").distinct()


def is_known(concepts: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """The rows one of whose columns is a key or a variant of something known, after normalisation."""
    forms = concepts.select(*concepts.columns, F.explode(F.array(*[text.concept_key(c) for c in columns])).alias("_form"))
    return forms.join(known_keys(known), F.col("_form") == F.col("known_key"), "left_semi").drop("_form").distinct()


def candidates(m: DataFrame, nodes: DataFrame, ce: DataFrame, known: DataFrame, importance: DataFrame, least: float = LEAST) -> DataFrame:
    """All concepts with their signals, importance, and the reason for which one is dropped (null if it is not).

    ``ce`` are the ``concept_edges``. They and the mentions are read by several aggregates, so they are best given as written tables. Each
    signal is made once; what there is of a concept meets in one grouping, since each has a row for it at the most.
    """
    core = importance.where(F.col("importance") >= CORE).select(F.col("paper").alias("core_paper")).distinct()
    methods = ce.where(F.col("type").isin(METHOD_EDGES))
    signals = [
        paper_counts(m, ce),
        slot_signals(m).withColumnRenamed("method_of_core", "moc_evidence"),
        m.groupBy("norm").agg(F.min(F.struct("paper", "field", "ord", "raw"))["raw"].alias("ev_display")),
        ce.select("norm").distinct(),
        methods.join(core, methods["src"] == core["core_paper"], "left_semi").select("norm", F.lit(True).alias("moc_graph")).distinct(),
        graph_concepts(nodes).withColumnRenamed("display", "graph_display"),
    ]
    known_of = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), signals).where("norm is not null")
    one = lambda c: F.any_value(c, F.lit(True)).alias(c)
    rows = known_of.groupBy("norm").agg(*(one(c) for c in known_of.columns if c != "norm")).select(
        "norm",
        F.coalesce("ev_display", "graph_display", "norm").alias("concept"),
        F.coalesce("paper_count", F.lit(0)).alias("paper_count"),
        F.coalesce("core_paper_count", F.lit(0)).alias("core_paper_count"),
        F.coalesce("in_slots", F.array().cast("array<string>")).alias("in_slots"),
        F.coalesce("moc_graph", F.lit(False)).alias("moc_graph"),
        (F.coalesce("moc_evidence", F.lit(False)) | F.coalesce("moc_graph", F.lit(False))).alias("is_method_of_core"),
    )
    rows = rows.withColumn("importance", scoring.importance(F.col("paper_count"), F.col("core_paper_count"), F.col("in_slots"), F.col("is_method_of_core")))
    keys = known_keys(known)
    forms = {"_by_norm": text.concept_key("norm"), "_by_concept": text.concept_key("concept")}
    for name, form in forms.items():  # a flag for each form, so that the signals are computed once and not joined to themselves
        rows = rows.withColumn("_form", form).join(keys.select(F.col("known_key").alias("_form"), F.lit(True).alias(name)), "_form", "left").drop("_form")
    familiar = F.coalesce("_by_norm", "_by_concept", F.lit(False))
    minor = (F.col("paper_count") <= 1) & (F.size(F.array_except("in_slots", F.array(F.lit("mention")))) == 0) & ~F.col("moc_graph")
    low = (F.col("importance") < least) & (F.col("core_paper_count") < 2)
    reason = F.when(familiar, "known").when(minor, "too_minor").when(low, "low_score")
    return rows.withColumn("reason", reason).drop("moc_graph", *forms)


def selected(c: DataFrame, top: int = TOP, cap: int = CAP) -> DataFrame:
    """The first ``top`` candidates by importance, then later ones with two core papers, ``cap`` in all, with their rank.

    The order is total: ties go by key. Ranks need one order of all candidates, so only the few that can be chosen are ranked: the best
    ``top``, and the best ``top`` + ``cap`` with two core papers. Both are a top-k that each task begins, over the live candidates, which
    are written once.
    """
    order = [F.desc("importance"), F.asc("norm")]
    live = durable(c.where("reason is null"), "live")
    few = live.orderBy(*order).limit(top).unionByName(live.where("core_paper_count >= 2").orderBy(*order).limit(top + cap)).dropDuplicates(["norm"])
    place = F.row_number().over(Window.orderBy(*order))
    chosen = few.withColumn("_place", place).where((F.col("_place") <= top) | (F.col("core_paper_count") >= 2))
    rank = F.row_number().over(Window.orderBy((F.col("_place") > top).cast("int"), *order))
    return chosen.withColumn("rank", rank).where(F.col("rank") <= cap).drop("_place")


def neighbors_of(edges: DataFrame, chosen: DataFrame, limit: int = NEIGHBORS) -> DataFrame:
    """The rows of ``neighbors`` for the few concepts ``norm`` of ``chosen``; only papers that point to one of these are looked at."""
    own = edges.select("src", "norm").where("src is not null and norm is not null")
    mine = durable(own.join(F.broadcast(chosen.select("norm")), "norm", "left_semi").distinct(), "papers-of-chosen")
    others = own.join(mine.select("src").distinct(), "src", "left_semi").distinct()
    near = others.withColumnRenamed("norm", "neighbor").join(mine, "src").where("norm <> neighbor")
    rank = F.row_number().over(Window.partitionBy("norm").orderBy(F.desc("shared"), "neighbor"))
    return near.groupBy("norm", "neighbor").agg(F.count(F.lit(1)).alias("shared")).withColumn("rank", rank).where(F.col("rank") <= limit)


def first_references(m: DataFrame, snippets: DataFrame, refs: int = 1, chosen: DataFrame | None = None) -> DataFrame:
    """(norm, paper, slot, snippet, nth): the first papers that mention a concept, in the order of papers.

    ``snippets`` has (paper, solution, problem) as arrays; without either the concept itself is the snippet. Of ``chosen``, a table of few
    concepts ``norm``, only these have references, and only their papers' snippets are made.
    """
    if chosen is not None:
        m = m.join(F.broadcast(chosen.select("norm")), "norm", "left_semi")
    per_paper = m.groupBy("norm", "paper").agg(F.min(F.struct("field", "ord", "extra", "slot"))["slot"].alias("slot"))
    nth = F.row_number().over(Window.partitionBy("norm").orderBy("paper"))
    first = per_paper.withColumn("nth", nth).where(F.col("nth") <= refs)
    if chosen is not None:
        first = durable(first, "first-papers")
        snippets = snippets.join(F.broadcast(first.select("paper").distinct()), "paper", "left_semi")
    joined = lambda c: F.nullif(F.array_join(F.col(c), " "), F.lit(""))
    pool = snippets.select("paper", F.coalesce(joined("solution"), joined("problem")).alias("pool"))
    return first.join(pool, "paper", "left").select("norm", "paper", "slot", F.substring(F.coalesce("pool", "norm"), 1, SNIPPET_CHARS).alias("snippet"), "nth")


def digest(chosen: DataFrame, refs: DataFrame, near: DataFrame, names: DataFrame) -> DataFrame:
    """The nested records of the chosen candidates, in the order of their rank."""
    by_name = near.where(F.col("rank") <= SHOWN_NEIGHBORS).join(names.select(F.col("norm").alias("neighbor"), "display"), "neighbor", "left")
    listed = by_name.groupBy("norm").agg(F.array_sort(F.collect_list(F.struct("rank", F.substring(F.coalesce("display", "neighbor"), 1, NAME_CHARS).alias("name"))))["name"].alias("graph_neighbors"))
    quoted = refs.groupBy("norm").agg(F.array_sort(F.collect_list(F.struct("nth", F.col("paper").alias("arxiv_id"), "slot", "snippet"))).alias("evidence_refs"))
    rows = chosen.join(quoted, "norm", "left").join(listed, "norm", "left")
    signals = F.struct("paper_count", "core_paper_count", "in_slots", "is_method_of_core")
    return rows.select("rank", F.substring("concept", 1, NAME_CHARS).alias("concept"), F.substring("norm", 1, NAME_CHARS).alias("normalized"), "importance", signals.alias("signals"), F.transform(F.coalesce("evidence_refs", F.array().cast("array<struct<nth:int,arxiv_id:string,slot:string,snippet:string>>")), lambda r: F.struct(r["arxiv_id"].alias("arxiv_id"), r["slot"].alias("slot"), r["snippet"].alias("snippet"))).alias("evidence_refs"), F.coalesce("graph_neighbors", F.array().cast("array<string>")).alias("graph_neighbors"))


def within_budget(records: DataFrame, budget: int = DIGEST_BYTES) -> DataFrame:
    """The records; an action on them raises if their JSON takes more bytes than the budget. There are at most ``CAP`` of them."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*records.columns)))).over(Window.partitionBy(F.lit(0)))
    return records.withColumn("_bytes", size).where(F.assert_true(F.col("_bytes") <= budget, "the digest exceeds its size budget").isNull()).drop("_bytes")

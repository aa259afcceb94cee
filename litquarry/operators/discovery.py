"""Pools of papers: union by precedence, filters by keyword and age, ranking by impact, citation expansion."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ..functions import scoring, text
from ..sources.landing import durable

MAX_AGE = 6
#: Queries of a first search, by kind.
NORMAL_QUERIES, SURVEY_QUERIES = 5, 3


def union_by_precedence(parts: list[DataFrame], key: str, value: str, last_wins: bool = True) -> DataFrame:
    """(key, value, position): of one key the last part's value (or the first's) at the place where the key came first.

    Each part has key, value and ord, its own order.
    """
    rows = None
    for n, part in enumerate(parts):
        p = part.select(F.col(key), F.col(value), F.struct(F.lit(n).alias("part"), F.col("ord").alias("ord")).alias("position"))
        rows = p if rows is None else rows.unionByName(p)
    pick = F.max_by if last_wins else F.min_by
    out = rows.groupBy(key).agg(pick(value, "position").alias(value), F.min("position").alias("position"))
    return out.select(key, value, F.col("position.part").alias("first_part"), F.col("position.ord").alias("first_ord"))


def matches(abstract: Column, terms: list[str]) -> Column | None:
    pattern = text.any_term(terms)
    return None if pattern is None else F.coalesce(abstract.rlike(pattern), F.lit(False))


def recent(paper_id: Column, now: int, most: int = MAX_AGE) -> Column:
    return F.coalesce(F.lit(now) - text.paper_year(paper_id) <= most, F.lit(True))


def keep(paper_id: Column, abstract: Column, keywords: list[str], negatives: list[str], now: int) -> Column:
    """Recent, without a negative keyword, and with a keyword if there are any."""
    good, bad = matches(abstract, keywords), matches(abstract, negatives)
    out = recent(paper_id, now)
    out = out if bad is None else out & ~bad
    return out if good is None else out & good


def filter_papers(papers: DataFrame, keywords: list[str], negatives: list[str], now: int, key: str = "paper_id", abstract: str = "abstract") -> DataFrame:
    return papers.where(keep(F.col(key), F.col(abstract), keywords, negatives, now))


def selection_report(papers: DataFrame, keywords: list[str], negatives: list[str], now: int, key: str = "paper_id", abstract: str = "abstract") -> DataFrame:
    kept = keep(F.col(key), F.col(abstract), keywords, negatives, now)
    words = lambda t: F.lit(",".join(text.normal_terms(t)))
    return papers.agg(F.count(F.lit(1)).alias("total_input"), F.count_if(kept).alias("total_kept")).select(words(keywords).alias("keywords"), words(negatives).alias("negative_keywords"), "total_input", "total_kept")


def excluded(papers: DataFrame, ids: DataFrame, columns: list[str]) -> DataFrame:
    """The papers none of whose id columns is in ``ids``."""
    for c in columns:
        papers = papers.join(ids.select(F.col("id").alias("_excluded")), F.col(c) == F.col("_excluded"), "left_anti")
    return papers


def citation_threshold(least_in_depth: Column, least: Column) -> Column:
    return F.coalesce(least_in_depth, least, F.lit(0))


def top_linked(links: DataFrame, limit: int, least: int = 0, key: str = "paper") -> DataFrame:
    """The ``limit`` most cited links of each paper with at least ``least`` citations, ties in the order of the input."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("cites"), "ord"))
    rows = links.withColumn("cites", F.coalesce("cites", F.lit(0))).where(F.col("cites") >= least)
    return rows.withColumn("rank", rank).where(F.col("rank") <= limit)


def ranked_by_impact(papers: DataFrame, now: int, most: int | None = None, key: str = "paper_id") -> DataFrame:
    """(paper_id, abstract, score): the best score and the first abstract of each id, best first, at most ``most`` of them; ties by ord, then id."""
    score = F.coalesce(scoring.impact(F.coalesce("citations", F.lit(0)), F.col("year"), now), F.lit(0.0))
    rows = papers.withColumn("score", score)
    out = rows.groupBy(key).agg(F.max("score").alias("score"), F.min_by(text.or_default("abstract"), F.when(text.or_default("abstract").isNotNull(), F.col("ord"))).alias("abstract"), F.min("ord").alias("ord"))
    out = out.orderBy(F.desc("score"), "ord", key)
    return out if most is None else out.limit(max(0, most))


def running_exclusion(hits: DataFrame, key: str = "paper_id") -> DataFrame:
    """Hits of several queries, each without what an earlier query found."""
    first = F.min("query").over(Window.partitionBy(key))
    return hits.withColumn("_first", first).where("query = _first").drop("_first")


#: Rows of the ordered fold of ``running_exclusion_capped``; where more would be needed, the queries are taken step by step.
FOLD_ROWS = 2_000_000


def running_exclusion_capped(hits: DataFrame, queries: list[int], cap: int, key: str = "paper_id", fold_rows: int = FOLD_ROWS) -> DataFrame:
    """As ``running_exclusion`` where a query keeps its first ``cap`` hits and only what was kept is excluded later.

    ``queries`` stand in the order in which they ran; of a query's hits with one id the first by ord counts, and ties of ord go by id. All
    queries before the n-th keep at most ``cap * n`` ids, so its first ``cap * (n + 1)`` hits decide what it keeps. So many
    are taken of each by rank, in one pass, and one ordered fold over them carries the ids kept: a plan of one size for any number of
    queries, and a fold of ``cap * n * (n + 1) / 2`` rows at the most, whatever the number of hits. Where that is more than
    ``fold_rows``, each query is a step of its own that is written, and what was kept is excluded from the next by a join.
    """
    order = F.create_map(*[F.lit(x) for pair in ((q, n) for n, q in enumerate(queries)) for x in pair]) if queries else None
    if order is None or cap <= 0:
        return hits.limit(0)
    placed = hits.withColumn("_nth", F.element_at(order, F.col("query").cast("int"))).where(F.col("_nth").isNotNull() & F.col(key).isNotNull())
    once = F.row_number().over(Window.partitionBy("_nth", key).orderBy("ord"))
    first = placed.withColumn("_again", once).where("_again = 1").drop("_again")
    if cap * len(queries) * (len(queries) + 1) // 2 > fold_rows:
        return _capped_in_steps(first, len(queries), cap, key).select(*hits.columns)
    place = F.row_number().over(Window.partitionBy("_nth").orderBy("ord", key))
    few = first.withColumn("_place", place).where(F.col("_place") <= cap * (F.col("_nth") + 1))

    columns, n_queries = hits.columns, len(queries)

    def fold(frame):
        kept, rows, left = set(), [], dict.fromkeys(range(n_queries), cap)
        ordered = frame.sort_values(["_nth", "_place"])
        for i, n, value in zip(ordered.index, ordered["_nth"], ordered[key], strict=True):
            if left[n] and value not in kept:
                left[n] -= 1
                rows.append(i)
                kept.add(value)
        return frame.loc[rows, columns]

    return few.groupBy(F.lit(0).alias("_all")).applyInPandas(fold, hits.schema)


def _capped_in_steps(first: DataFrame, n: int, cap: int, key: str) -> DataFrame:
    first, kept = durable(first, "hits"), None
    for i in range(n):
        rows = first.where(F.col("_nth") == i)
        rows = rows if kept is None else rows.join(kept.select(key), key, "left_anti")
        step = durable(rows.orderBy("ord", key).limit(cap).select(*first.columns), "kept")
        kept = step if kept is None else kept.unionByName(step)
    return kept


def by_upvotes(items: DataFrame) -> DataFrame:
    """Items by the upvotes of their paper, else their own, most first, ties in the order of the input."""
    votes = F.coalesce(F.get_json_object("item", "$.paper.upvotes").try_cast("long"), F.get_json_object("item", "$.upvotes").try_cast("long"), F.lit(0))
    return items.withColumn("votes", votes).orderBy(F.desc("votes"), "ord")


def query_budget(plan: DataFrame) -> DataFrame:
    """The first query of each aspect, without repetition, up to the budget of its kind."""
    first = lambda c, n: F.slice(F.array_distinct(F.array_sort(F.collect_list(F.when(F.size(c) > 0, F.struct("ord", F.get(F.col(c), F.lit(0)).alias("q")))))["q"]), 1, n)
    return plan.agg(first("normal_queries", NORMAL_QUERIES).alias("queries"), first("survey_queries", SURVEY_QUERIES).alias("survey_queries"))


def chunks(rows: DataFrame, size: int, order: list[str], key: str) -> DataFrame:
    """The number of the chunk of ``size`` rows in which a row falls, within its key."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("chunk", F.floor((nth - 1) / size))


def judged(rows: DataFrame, judge, id_col: str = "paper_id", chunk: int = 50, fail_open: bool = True) -> DataFrame:
    """The rows with what a user's judge says: (group, kept, failed) beside their own columns.

    The judge gets up to ``chunk`` rows as a pandas frame and returns ids; ids that it invents are ignored. Rows are put into groups by a hash of
    their id and into the order of ids there, so which rows it sees together depends on the rows alone and not on how they are
    partitioned. Where it raises, its chunk is marked as failed and stays (fail_open) or goes; how many did is
    ``where("failed").select("group").distinct().count()``.
    """
    n = max(1, math.ceil(rows.count() / chunk))
    names = rows.columns

    def run(key, frame):
        frame = frame[names].sort_values(id_col, kind="stable", na_position="last").reset_index(drop=True)
        parts = []
        for i in range(0, max(1, len(frame)), chunk):
            part, failed = frame.iloc[i : i + chunk], False
            try:
                good = set(judge(part))
            except Exception:  # a judge is foreign code; what its failure means is the caller's choice
                good, failed = set(part[id_col]) if fail_open else set(), True
            kept = part[id_col].isin(good) | (fail_open and failed)
            parts.append(part.assign(group=f"{key[0]}-{i // chunk}", kept=kept, failed=failed))
        return pd.concat(parts)

    schema = StructType([*rows.schema.fields, StructField("group", StringType()), StructField("kept", BooleanType()), StructField("failed", BooleanType())])
    return rows.groupBy(F.pmod(F.xxhash64(id_col), F.lit(n)).alias("_bucket")).applyInPandas(run, schema)


def relevance_gate(rows: DataFrame, judge, id_col: str = "paper_id", chunk: int = 50, fail_open: bool = True) -> DataFrame:
    """The rows that a user's judge keeps, see ``judged``."""
    return judged(rows, judge, id_col, chunk, fail_open).where("kept").select(*rows.columns)


def metadata(sources: list[DataFrame], key: str = "paper_id") -> DataFrame:
    """Title and year of each paper: the first title that is no placeholder, else the last one before it, and the first year.

    ``sources`` stand in order of precedence and have key, title and year. A title that is the paper's own id is a placeholder, however long the id.
    """
    rows = None
    for n, s in enumerate(sources):
        part = s.select(key, F.lit(n).alias("rank"), "title", "year")
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.withColumn("title", F.nullif(text.strip("title"), F.lit("")))
    real = F.when(F.col("title").isNotNull() & ~text.is_placeholder_title("title") & ~F.col("title").eqNullSafe(F.col(key).cast("string")), F.col("rank"))
    return rows.groupBy(key).agg(
        F.coalesce(F.min_by("title", real), F.max_by("title", F.when(F.col("title").isNotNull(), F.col("rank")))).alias("title"),
        F.min_by("year", F.when(F.col("year").isNotNull() & (F.col("year") != 0), F.col("rank"))).alias("year"),
    )


def fill_abstracts(papers: DataFrame, fetched: DataFrame, key: str = "paper_id") -> DataFrame:
    """Missing abstracts from ``fetched``; of several answers for an id the last with a text counts."""
    last = fetched.groupBy(key).agg(F.max_by(text.or_default("abstract"), F.when(text.or_default("abstract").isNotNull(), F.col("ord"))).alias("_fetched"))
    return papers.join(last, key, "left").withColumn("abstract", F.coalesce(text.or_default("abstract"), "_fetched")).drop("_fetched")


def responses(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers of a batch beside their requests: by id, else by position, else marked as not found."""
    by_id = answers.where("id is not null").groupBy("id").agg(F.min_by("payload", "pos").alias("by_id"))
    by_pos = answers.where("id is null").select("pos", F.col("payload").alias("by_pos"))
    rows = requests.join(by_id, "id", "left").join(by_pos, "pos", "left")
    return rows.select("pos", "id", F.coalesce("by_id", "by_pos").alias("payload"), (F.col("by_id").isNotNull() | F.col("by_pos").isNotNull()).alias("found"))


def reunited(requested: DataFrame, hits: DataFrame, fetched: DataFrame, key: str = "id") -> DataFrame:
    """Cached values first, fetched ones for the rest, in the order of the request."""
    missing = requested.join(hits, key, "left_anti")
    both = hits.select(key, "payload", F.lit("cache").alias("origin")).unionByName(fetched.join(missing, key, "left_semi").select(key, "payload", F.lit("fetched").alias("origin")))
    return requested.join(both, key, "inner")


def rooted(roots: DataFrame, details: DataFrame, key: str = "paper_id") -> DataFrame:
    """Search rows with the fields of their details where there are any."""
    d = details.select(F.col(key), *[F.col(c).alias(f"_d_{c}") for c in details.columns if c != key])
    out = roots.join(d, key, "left")
    return out.select(key, *[F.coalesce(f"_d_{c}", c).alias(c) if f"_d_{c}" in d.columns else F.col(c) for c in roots.columns if c != key])


def not_done(pool: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return pool.join(done.select(key), key, "left_anti")


def eligible(promoted: DataFrame, with_text: DataFrame, indexed: DataFrame, verified: DataFrame, key: str = "paper_id", title: str = "title") -> DataFrame:
    """Promoted papers that have a text, an index and evidence and are no mere surveys."""
    out = promoted
    for s in (with_text, indexed, verified):
        out = out.join(s.select(key).distinct(), key, "left_semi")
    return out.where(~text.is_survey_title(title))

"""Composite searches over landed answers of paper services.

Answers are tables of JSON texts: (query, ord, item). Nothing here calls a service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import json as jsonx
from ..functions import text
from . import discovery, graph


def hub_summaries(items: DataFrame) -> DataFrame:
    """(query, ord, paper_id, abstract) of a hub's items: the paper's own summary, else the item's; rows without either go."""
    get = lambda path: F.get_json_object("item", path)
    rows = items.select("query", "ord", text.or_default(get("$.paper.id")).alias("paper_id"), text.or_default(get("$.paper.summary"), get("$.summary")).alias("abstract"))
    return rows.where("paper_id is not null and abstract is not null")


def archive_summaries(items: DataFrame) -> DataFrame:
    """(query, ord, paper_id, abstract) of an archive search's items; ids lose their version."""
    get = lambda path: F.get_json_object("item", path)
    ident = text.or_default(get("$.universal_paper_id"), get("$.arxiv_id"))
    rows = items.select("query", "ord", F.split_part(ident, F.lit("v"), F.lit(1)).alias("paper_id"), text.or_default(get("$.abstract"), jsonx.safe_get(F.col("item"), "paper_summary.summary")).alias("abstract"))
    return rows.where("paper_id is not null and abstract is not null")


def paper_rows(items: DataFrame) -> DataFrame:
    """Rows of a citation service as one schema, counts as 0 where they are missing, linked papers as ids.

    ``items`` has (ord, item). Columns: ord, scholar_id, paper_id, title, year, abstract, citation_count, reference_count,
    citations, references.
    """
    get = lambda path: F.get_json_object("item", path)
    number = lambda path: F.coalesce(get(path).try_cast("long"), F.lit(0))
    linked = lambda path: F.array_compact(F.transform(F.coalesce(F.from_json(get(path), "array<struct<externalIds:struct<ArXiv:string>>>"), F.array().cast("array<struct<externalIds:struct<ArXiv:string>>>")), lambda p: F.nullif(p["externalIds"]["ArXiv"], F.lit(""))))
    return items.select("ord", get("$.paperId").alias("scholar_id"), jsonx.safe_get(F.col("item"), "externalIds.Arxiv").alias("paper_id"), get("$.title").alias("title"), get("$.year").try_cast("int").alias("year"), get("$.abstract").alias("abstract"), number("$.citationCount").alias("citation_count"), number("$.referenceCount").alias("reference_count"), linked("$.citations").alias("citations"), linked("$.references").alias("references"))


def gap_search(hub: DataFrame, archive: DataFrame, keywords: list[str], negatives: list[str], now: int) -> tuple[DataFrame, DataFrame]:
    """The kept pool (paper_id, abstract, query), and per query how many papers each service and both gave.

    Within a query the hub's abstract wins, across queries the first query's.
    """
    h, a = hub_summaries(hub), archive_summaries(archive)
    last = lambda rows, n: rows.groupBy("query", "paper_id").agg(F.max_by("abstract", "ord").alias("abstract")).withColumn("service", F.lit(n))
    both = last(a, 0).unionByName(last(h, 1))
    per_query = both.groupBy("query", "paper_id").agg(F.max_by("abstract", "service").alias("abstract"))
    pool = per_query.groupBy("paper_id").agg(F.min_by("abstract", "query").alias("abstract"), F.min("query").alias("query"))
    audit = both.groupBy("query").agg(F.count_if(F.col("service") == 1).alias("hub"), F.count_if(F.col("service") == 0).alias("archive"), F.count_distinct("paper_id").alias("returned"))
    return discovery.filter_papers(pool, keywords, negatives, now), audit


def bulk_search(parts: list[DataFrame], keywords: list[str], negatives: list[str], now: int, judge=None) -> DataFrame:
    """(paper_id, abstract) of all parts, of a repeated id the last part's, filtered by keyword and age, then by a judge."""
    pool = discovery.union_by_precedence(parts, "paper_id", "abstract").select("paper_id", "abstract")
    kept = discovery.filter_papers(pool, keywords, negatives, now)
    return kept if judge is None else discovery.relevance_gate(kept, judge)


def relevance_search(found: DataFrame, links: DataFrame, details: DataFrame, now: int, depth: int = 1, limit: int = 100, least: int = 0, excluded: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """(paper_id, abstract, score, ord): papers found and, down to ``depth``, their most cited citations, ranked by impact.

    ``found`` has (paper_id, ord), ``links`` (paper, id, cites, ord), ``details`` (paper_id, abstract, year, citations).
    """
    if excluded is not None:
        found = discovery.excluded(found, excluded, ["paper_id"])
    seeds = found.select(F.col("paper_id").alias("id"))
    below = graph.expand_citations(links, seeds, depth, limit, least, excluded).select(F.col("id").alias("paper_id")).distinct()
    rows = found.select("paper_id", "ord").unionByName(below.withColumn("ord", F.lit((1 << 62))))
    return discovery.ranked_by_impact(rows.join(details, "paper_id"), now, most)


def metadata_batch(requests: DataFrame, papers: DataFrame) -> DataFrame:
    """Requested ids (pos, id) in their order with title, year and abstract, and whether each was found; of several rows the first by ord counts."""
    first = F.min_by(F.struct("title", "year", "abstract"), "ord").alias("_p")
    p = papers.groupBy(F.col("paper_id").alias("id")).agg(first).select("id", "_p.*", F.lit(True).alias("_found"))
    return requests.join(p, "id", "left").select("pos", "id", "title", "year", "abstract", F.coalesce("_found", F.lit(False)).alias("found"))

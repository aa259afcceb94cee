"""Answers of paper services as typed relations, the requests that ask for them, and the tools that a program offers.

Nothing here calls a service: answers are landed first (``sources.readers.HttpJsonSource``) and have (query, body), body being the
JSON text of one answer. Each function names the part of an answer that it reads.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources.landing import numbered
from . import discovery, search

# The most that the services take at a time.
SEARCH_LIMIT, BATCH_LIMIT, RECOMMENDATION_LIMIT = 100, 500, 500
#: Tries of a tool, and seconds between them, times the number of the try.
TRIES, DELAY = 5, 1.0


def request_batches(ids: DataFrame, order: list[str], size: int = BATCH_LIMIT) -> DataFrame:
    """(batch, pos, id): distinct ids in their order, so many to a batch, for one request each; ids are numbered by ranges (``numbered``)."""
    once = ids.where(F.coalesce(F.trim("id"), F.lit("")) != "").groupBy("id").agg(F.min(F.struct(*order)).alias("o"))
    n = numbered(once, ["o", "id"], "n")
    return n.select(F.floor(F.col("n") / size).alias("batch"), (F.col("n") % size).alias("pos"), "id")


def _items(answers: DataFrame, path: str) -> DataFrame:
    body = F.col("body") if path == "$" else F.get_json_object("body", path)
    return answers.select("query", F.posexplode(F.from_json(body, "array<string>")).alias("ord", "item"))


def search_items(answers: DataFrame) -> DataFrame:
    """(query, ord, item) of a search or a bulk search: the list ``data``."""
    return _items(answers, "$.data")


def batch_items(answers: DataFrame) -> DataFrame:
    """(query, ord, item, found) of a batch: a list in the order of the request, null where an id is unknown."""
    return _items(answers, "$").withColumn("found", F.col("item").isNotNull())


def recommended_items(answers: DataFrame) -> DataFrame:
    """(query, ord, item) of recommendations for one or several papers: the list ``recommendedPapers``."""
    return _items(answers, "$.recommendedPapers")


def detail_rows(answers: DataFrame) -> DataFrame:
    """One row per paper of detail answers, in the schema of ``search.paper_rows`` with the query in front."""
    rows = search.paper_rows(answers.select(F.col("query").alias("ord"), F.col("body").alias("item")))
    return rows.withColumnRenamed("ord", "query")


def monthly_rows(answers: DataFrame) -> DataFrame:
    """(query, ord, paper_id, abstract) of a hub's papers of a month, in the order of the answer."""
    return search.hub_summaries(_items(answers, "$"))


def version_ids(answers: DataFrame) -> DataFrame:
    """(query, version_id): the version of a paper under which an archive keeps its overview."""
    return answers.select("query", F.get_json_object("body", "$.paper.paper_version.id").alias("version_id"))


def overviews(answers: DataFrame) -> DataFrame:
    """(query, overview): the overview's Markdown, empty where there is none."""
    return answers.select("query", F.coalesce(F.get_json_object("body", "$.overview"), F.lit("")).alias("overview"))


def similar_rows(answers: DataFrame) -> DataFrame:
    """(query, ord, paper_id, abstract) of papers that an archive calls similar: a list, or one below ``papers``."""
    listed = F.coalesce(F.get_json_object("body", "$.papers"), F.col("body"))
    return search.archive_summaries(_items(answers.select("query", listed.alias("body")), "$"))


def previews(answers: DataFrame) -> DataFrame:
    """(query, paper_id, title, abstract) of an archive's preview of a paper."""
    get = lambda path: text.or_default(F.get_json_object("body", path))
    return answers.select("query", F.coalesce(get("$.universal_paper_id"), F.col("query")).alias("paper_id"), get("$.title").alias("title"), get("$.abstract").alias("abstract"))


def models(papers: DataFrame, links: DataFrame, limit: int, least: int = 0, depth: int = 2) -> DataFrame:
    """Papers (paper_id, title, cites) with the tree of their most cited citations, ``depth`` levels deep, as nested structs.

    ``links`` has (paper, id, cites, ord). Each level is a top-k per paper and one join; a paper without links has an empty list.
    """
    top = discovery.top_linked(links, limit, least).select("paper", "id", "rank")
    level = papers.select("paper_id", F.struct("paper_id", "title", "cites").alias("model"))
    for _ in range(depth - 1):
        children = top.join(level.select(F.col("paper_id").alias("id"), "model"), "id")
        listed = children.groupBy(F.col("paper").alias("paper_id")).agg(F.array_sort(F.collect_list(F.struct("rank", "model"))).alias("c"))
        fields = papers.join(listed, "paper_id", "left")
        empty = F.filter(F.array(F.lit(None).cast(level.schema["model"].dataType)), lambda x: F.lit(False))
        level = fields.select("paper_id", F.struct("paper_id", "title", "cites", F.coalesce(F.transform("c", lambda x: x["model"]), empty).alias("citations")).alias("model"))
    return level


def rolling_requests(requests: DataFrame, seconds: int, most: int, keys: int = 1) -> DataFrame:
    """Requests (service, at) with how many the service got in the last ``seconds``, whether that is too many, and which key is next.

    Counting goes by event time within a service; the key changes with each full allowance.
    """
    at = F.unix_micros(F.col("at").cast("timestamp"))
    here = Window.partitionBy("service").orderBy(at).rangeBetween(-seconds * 1_000_000 + 1, 0)
    rows = requests.withColumn("recent", F.count(F.lit(1)).over(here))
    return rows.withColumn("limited", F.col("recent") > most).withColumn("key_index", (F.floor((F.col("recent") - 1) / most) % keys).cast("int"))


@dataclass(frozen=True)
class Tool:
    """What a program offers by name: its parameters with their types, and the function over DataFrames that does it."""

    name: str
    description: str
    run: Callable[..., DataFrame]
    parameters: dict[str, str] = field(default_factory=dict)

    def call(self, *args, tries: int = TRIES, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep, **kwargs) -> DataFrame:
        """Run it; where it raises an OSError, try again after a wait that grows with each try."""
        unknown = set(kwargs) - set(self.parameters)
        if unknown:
            raise TypeError(f"{self.name} takes no {', '.join(sorted(unknown))}")
        for n in range(1, tries + 1):
            try:
                return self.run(*args, **kwargs)
            except OSError:
                if n == tries:
                    raise
                sleep(delay * n)
        raise ValueError("tries must be 1 or more")


TOOLS = {
    t.name: t
    for t in (
        Tool("bulk_search", "Papers of several searches, filtered by keyword and age", search.bulk_search, {"parts": "list of tables", "keywords": "list of str", "negatives": "list of str", "now": "int", "judge": "function"}),
        Tool("gap_search", "Papers of two services for the concepts that are missing", search.gap_search, {"hub": "table", "archive": "table", "keywords": "list of str", "negatives": "list of str", "now": "int"}),
        Tool("relevance_search", "Found papers and those that cite them, ranked by impact", search.relevance_search, {"found": "table", "links": "table", "papers": "table", "now": "int", "most": "int"}),
        Tool("metadata_batch", "Title, year and abstract of requested ids", search.metadata_batch, {"requests": "table", "papers": "table"}),
        Tool("overview", "Overviews of papers", overviews, {"answers": "table"}),
        Tool("similar", "Papers that are similar", similar_rows, {"answers": "table"}),
    )
}

#: Functions for SQL, by name: parameters, result and body. They run in the JVM.
SQL_FUNCTIONS = {
    "lq_concept_key": ("c STRING", "STRING", r"regexp_replace(regexp_replace(replace(lower(trim(c)), '-', ' '), '\\s+', ' '), '[.,;:!?]+$', '')"),
    "lq_paper_year": ("c STRING", "INT", r"CASE WHEN c RLIKE '^[0-9]{4}\\.' THEN 2000 + CAST(substring(c, 1, 2) AS INT) END"),
    "lq_slug": ("c STRING", "STRING", r"trim(BOTH '-' FROM regexp_replace(lower(c), '[^a-z0-9]+', '-'))"),
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session's SQL; their names."""
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(SQL_FUNCTIONS)


def with_keywords_first(sentences: DataFrame, keywords: list[str], k: int) -> DataFrame:
    """(paper, nth, sentence): ``k`` sentences of each paper, those with a keyword before the others, each in the order of the text."""
    hit: Column = discovery.matches(F.col("sentence"), keywords) if keywords else F.lit(False)
    rank = F.row_number().over(Window.partitionBy("paper").orderBy((~hit).cast("int"), "nth"))
    return sentences.withColumn("_rank", rank).where(F.col("_rank") <= k).select("paper", F.col("_rank").alias("nth"), "sentence")


def cited(sentence: Column, paper: Column, node: Column) -> Column:
    """A sentence with the place that it comes from behind it."""
    return F.concat(sentence, F.lit(" [arxiv:"), paper, F.lit(", "), node, F.lit("]"))

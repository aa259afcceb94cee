"""Headings of a text as a tree of sections, in relational form.

A section ends before the next heading of its level or above, and its parent is the last heading before it of a higher one.
Both are running values per level over the headings of a text, so a text with very many headings costs two sorts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

HEADING = r"^(#{1,6})\s+(.+?)\s*$"
ROOT = "s.00"


def headings(docs: DataFrame, key: str = "paper", body: str = "text") -> DataFrame:
    """(paper, line, level, title, n_lines), lines counted from 1."""
    rows = docs.select(F.col(key).alias("paper"), text.lines(F.coalesce(F.col(body), F.lit(""))).alias("_lines"))
    rows = rows.select("paper", F.greatest(F.size("_lines"), F.lit(1)).alias("n_lines"), F.posexplode("_lines").alias("_pos", "_line"))
    line = text.strip("_line")
    return rows.where(line.rlike(HEADING)).select("paper", (F.col("_pos") + 1).alias("line"), F.length(F.regexp_extract(line, HEADING, 1)).alias("level"), F.trim(F.regexp_extract(line, HEADING, 2)).alias("title"), "n_lines")


def sections(docs: DataFrame, key: str = "paper", body: str = "text") -> DataFrame:
    """(paper, id, title, level, start_line, end_line, parent_id) for each section; a text without headings is one section."""
    h = headings(docs, key, body)
    # running values over both orders, one for each of the six levels; frames that grow at one end cost one pass
    later = Window.partitionBy("paper").orderBy(F.desc("line")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("paper").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    at_most = lambda k, over: F.last(F.when(F.col("level") <= k, F.col("line")), ignorenulls=True).over(over)
    by_level = lambda value: F.coalesce(*[F.when(F.col("level") == k, value(k)) for k in range(1, 7)])
    spans = h.withColumn("next", by_level(lambda k: at_most(k, later))).withColumn("parent", by_level(lambda k: at_most(k - 1, earlier)))
    nth = F.row_number().over(Window.partitionBy("paper", F.coalesce("parent", F.lit(0))).orderBy("line"))
    s = spans.withColumn("part", F.lpad(nth.cast("string"), 2, "0"))
    # levels are 1 to 6, so six steps up reach the root
    up = s.select(F.col("paper").alias("up_paper"), F.col("line").alias("up_line"), F.col("parent").alias("up_parent"), F.col("part").alias("up_part"))
    path = s.withColumns({"at": F.col("parent"), "id": F.col("part")})
    for _ in range(5):
        path = path.join(up, (F.col("paper") == F.col("up_paper")) & (F.col("at") == F.col("up_line")), "left")
        path = path.withColumns({"id": F.concat_ws(".", "up_part", "id"), "at": F.col("up_parent")}).drop("up_paper", "up_line", "up_parent", "up_part")
    out = path.select(
        "paper",
        F.concat(F.lit("s."), "id").alias("id"),
        "title",
        "level",
        F.col("line").alias("start_line"),
        F.greatest(F.col("line"), F.coalesce(F.col("next") - 1, F.col("n_lines"))).alias("end_line"),
        F.when(F.col("parent").isNull(), ROOT).otherwise(F.concat(F.lit("s."), F.regexp_replace("id", r"\.[^.]+$", ""))).alias("parent_id"),
    )
    bare = docs.select(F.col(key).alias("paper"), F.greatest(F.size(text.lines(F.coalesce(F.col(body), F.lit("")))), F.lit(1)).alias("n_lines")).join(h.select("paper").distinct(), "paper", "left_anti")
    whole = bare.select("paper", F.lit("s.01").alias("id"), F.lit("Document").alias("title"), F.lit(1).alias("level"), F.lit(1).alias("start_line"), F.col("n_lines").alias("end_line"), F.lit(ROOT).alias("parent_id"))
    return out.unionByName(whole)


def with_text(nodes: DataFrame, docs: DataFrame, key: str = "paper", body: str = "text") -> DataFrame:
    """Sections with their lines, heading included."""
    d = docs.select(F.col(key).alias("paper"), F.col(body).alias("_body"))
    return nodes.join(d, "paper").withColumn("section_text", text.line_slice("_body", F.col("start_line"), F.col("end_line"))).drop("_body")


def with_summary(nodes: DataFrame, docs: DataFrame, key: str = "paper", body: str = "text") -> DataFrame:
    """Sections with the first sentence of what stands below their heading."""
    return with_text(nodes, docs, key, body).withColumn("summary", text.mechanical_summary(F.slice(text.lines("section_text"), F.when(F.col("section_text").rlike(r"^\s*#{1,6}\s"), 2).otherwise(1), F.lit(1 << 30)))).drop("section_text")


def find_section(nodes: DataFrame, docs: DataFrame, section: str) -> DataFrame:
    """(paper, id, section_text): the first section of each text whose path of headings ends as ``section`` (parts between slashes)."""
    wanted = [p for p in section.split("/") if p.strip()]
    if not wanted:
        raise ValueError("section must not be empty")
    keyed = nodes.withColumn("_key", text.heading_key("title"))
    path = keyed.select("paper", "id", "start_line", "end_line", F.array("_key").alias("_path"), F.col("parent_id").alias("_at"))
    up = keyed.select(F.col("paper").alias("_up_paper"), F.col("id").alias("_up"), F.col("_key").alias("_up_key"), F.col("parent_id").alias("_up_at"))
    for _ in range(len(wanted) - 1):
        path = path.join(up, (F.col("paper") == F.col("_up_paper")) & (F.col("_at") == F.col("_up")), "left")
        path = path.withColumns({"_path": F.when(F.col("_up").isNull(), F.col("_path")).otherwise(F.concat(F.array("_up_key"), "_path")), "_at": F.col("_up_at")}).drop("_up_paper", "_up", "_up_key", "_up_at")
    hit = path.where(F.col("_path") == F.array(*[text.heading_key(F.lit(p)) for p in wanted]))
    first = hit.groupBy("paper").agg(F.min_by(F.struct("id", "start_line", "end_line"), "start_line").alias("s")).select("paper", "s.*")
    return with_text(first, docs).select("paper", "id", text.strip("section_text").alias("section_text"))


def tree_issues(nodes: DataFrame) -> DataFrame:
    """(paper, id, code): ids that repeat, parents that are not there, children that pass their parent's lines."""
    twice = nodes.groupBy("paper", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("paper", "id", F.lit("duplicate_id").alias("code"))
    up = nodes.select(F.col("paper").alias("u_paper"), F.col("id").alias("u_id"), F.col("start_line").alias("u_start"), F.col("end_line").alias("u_end"))
    below = nodes.where(F.col("parent_id") != ROOT).join(up, (F.col("paper") == F.col("u_paper")) & (F.col("parent_id") == F.col("u_id")), "left")
    orphan = below.where("u_id is null").select("paper", "id", F.lit("missing_parent").alias("code"))
    outside = below.where("start_line < u_start or end_line > u_end").select("paper", "id", F.lit("outside_parent").alias("code"))
    return twice.unionByName(orphan).unionByName(outside)


def section_map(docs: DataFrame, key: str = "paper", body: str = "text") -> DataFrame:
    """(paper, title, body): text below each second-level heading; equal titles are put together."""
    rows = docs.select(F.col(key).alias("paper"), F.posexplode(text.lines(text.body(F.coalesce(F.col(body), F.lit(""))))).alias("pos", "line"))
    is_head = F.startswith("line", F.lit("## "))
    here = Window.partitionBy("paper").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("title", F.last(F.when(is_head, text.title_key(F.substr("line", F.lit(4)))), ignorenulls=True).over(here)).where("title <> ''")
    parts = rows.groupBy("paper", "title").agg(F.array_sort(F.collect_list(F.when(~is_head, F.struct("pos", "line")))).alias("p"))
    return parts.select("paper", "title", text.strip(F.array_join(F.transform("p", lambda x: x["line"]), "\n")).alias("body"))

"""Graph fragments: merging, grounding, repair, and bounded traversal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources.landing import durable, folder


def first_per_key(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def merge_nodes(nodes: DataFrame, order: list = ("file", "ord")) -> DataFrame:
    """The first node of each id."""
    return first_per_key(nodes.withColumn("id", F.trim("id")), ["id"], list(order))


def merge_weak_edges(edges: DataFrame, order: list = ("file", "ord")) -> DataFrame:
    """The first edge of each (src, dst, type)."""
    trimmed = edges.withColumns({c: F.trim(c) for c in ("src", "dst", "type")})
    return first_per_key(trimmed, ["src", "dst", "type"], list(order))


def grounding(node: Column, lines: Column) -> Column:
    """The place that an edge or a claim cites: a node and its lines as texts; null unless both are there."""
    return F.when((F.coalesce(node, F.lit("")) != "") & (F.coalesce(F.size(lines), F.lit(0)) > 0), F.struct(node.alias("node"), F.transform(lines, lambda x: x.cast("string")).alias("lines")))


def _listed(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """(paper, name): the distinct values of each paper, a fragment's few, as one list.

    Lists are joined by paper alone, so that tables that are dealt out by paper are joined where they are.
    """
    return rows.groupBy("paper").agg(F.collect_set(value).alias(name))


def _in(name: str, value: Column) -> Column:
    return F.coalesce(F.array_contains(name, value), F.lit(False))


def reject_reasons(edges: DataFrame, nodes: DataFrame, claims: DataFrame) -> DataFrame:
    """Edges of fragments with all reasons against each, joined by '; '; an empty text says that an edge is valid."""
    ids = _listed(nodes, F.nullif(F.col("id"), F.lit("")), "_ids")
    places = _listed(claims, grounding(F.col("node"), F.col("lines")), "_places")
    rows = edges.withColumn("place", grounding(F.col("node"), F.col("lines"))).join(ids, "paper", "left").join(places, "paper", "left")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    reasons = F.array_compact(
        F.array(
            F.when(blank("claim_id"), "missing claim_id"),
            F.when(~F.col("confidence").eqNullSafe("verified"), "confidence is not verified"),
            F.when(~_in("_ids", F.col("src")) | ~_in("_ids", F.col("dst")), "edge endpoint missing from fragment nodes"),
            F.when(blank("node"), "missing source_node_id"),
            F.when(F.coalesce(F.size("lines"), F.lit(0)) == 0, "missing source_lines"),
            F.when(F.col("place").isNotNull() & ~_in("_places", F.col("place")), "source_node_id + source_lines pair is not an exact Stage 10 claim source"),
        )
    )
    return rows.withColumn("reasons", F.array_join(reasons, "; ")).drop("place", "_ids", "_places")


def valid_edges(edges: DataFrame, nodes: DataFrame, claims: DataFrame) -> DataFrame:
    return reject_reasons(edges, nodes, claims).where("reasons = ''").drop("reasons")


def merge_verified(edges: DataFrame, nodes: DataFrame, claims: DataFrame) -> DataFrame:
    """Valid edges, the first of each (src, dst, type, node, lines)."""
    return first_per_key(valid_edges(edges, nodes, claims), ["src", "dst", "type", "node", "lines"], ["paper", "nth"])


def prune_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that are papers or ends of an edge of their fragment."""
    ends = _listed(edges.select("paper", F.explode(F.array("src", "dst")).alias("id")), F.col("id"), "_ends")
    return nodes.join(ends, "paper", "left").where((F.col("type") == "Paper") | (F.col("type") != "Paper") & _in("_ends", F.col("id"))).select(*nodes.columns)


def within_sections(claims: DataFrame, sections: DataFrame) -> DataFrame:
    """Claims whose cited lines all lie in their section. ``sections`` has (paper, node, start_line, end_line)."""
    rows = claims.join(sections, ["paper", "node"])
    return rows.where(F.forall("lines", lambda x: (x >= F.col("start_line")) & (x <= F.col("end_line")))).drop("start_line", "end_line")


def frame_nodes(items: DataFrame) -> DataFrame:
    """Allowed nodes (paper, id, type, display): the first of each normalised id, in the order given by ord."""
    rows = items.withColumn("id", text.node_key("label")).where("id <> ''")
    return first_per_key(rows, ["paper", "id"], ["ord"]).select("paper", "id", "type", F.coalesce(text.or_default("label"), "id").alias("display"))


def frame_claims(claims: DataFrame) -> DataFrame:
    """Grounded claims with ids; a claim's number counts the ones that are left out as well."""
    ident = F.concat(F.lit("c"), F.lpad(F.col("nth").cast("string"), 3, "0"))
    return claims.where(grounding(F.col("node"), F.col("lines")).isNotNull()).withColumn("claim_id", ident)


def compile_edges(edges: DataFrame, claims: DataFrame, allowed: DataFrame, types: list[str]) -> DataFrame:
    """Edges that name a claim, with the claim's place, if claim, ends and type are allowed."""
    e = edges.where("claim_id is not null").select("paper", "claim_id", text.node_key("src").alias("src"), text.node_key("dst").alias("dst"), "type")
    places = claims.groupBy("paper").agg(F.collect_list(F.struct("claim_id", "node", "lines")).alias("_places"))
    rows = e.where(F.col("type").isin(types)).join(_listed(allowed, F.col("id"), "_ids"), "paper").join(places, "paper")
    own = F.filter("_places", lambda c: c["claim_id"] == F.col("claim_id"))
    own = F.transform(own, lambda c: F.struct(c["node"].alias("node"), c["lines"].alias("lines")))
    rows = rows.withColumn("_own", own).where(_in("_ids", F.col("src")) & _in("_ids", F.col("dst")))
    return rows.select("paper", "claim_id", "src", "dst", "type", F.inline("_own")).withColumn("confidence", F.lit("verified"))


def report(nodes: DataFrame, verified: DataFrame, weak: DataFrame) -> DataFrame:
    counts = nodes.agg(F.count(F.lit(1)).alias("nodes")).join(verified.agg(F.count(F.lit(1)).alias("verified_edges")), F.lit(True)).join(weak.agg(F.count(F.lit(1)).alias("weak_edges")), F.lit(True))
    return counts.select("nodes", "verified_edges", F.greatest(F.col("weak_edges") - F.col("verified_edges"), F.lit(0)).alias("weak_not_promoted"))


def distinct_edges(edges: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of edges once each, trimmed, for counts: what a merge keeps beside them is not carried along."""
    return edges.select(*[F.trim(k).alias(k) if k in ("src", "dst", "type") else F.col(k) for k in keys]).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree, centrality): how many edges touch a node, and that as a share of the largest."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    most = ends.agg(F.max("degree").alias("most"))
    return ends.join(F.broadcast(most), F.lit(True)).select("id", "degree", (F.col("degree") / F.col("most")).alias("centrality"))


def reach(edges: DataFrame, seeds: DataFrame, depth: int, per_node: int | None = None) -> DataFrame:
    """(id, hop): nodes reachable from the seeds in at most ``depth`` steps, with the fewest steps; breadth first.

    With ``per_node`` a node passes on its first that many targets by ord. The steps and each level are written to the shared folder, so
    a level costs its own join and not those before it, and a lost executor takes nothing with it. The search ends with the first
    level that finds nothing new, whatever the depth. An empty table of seeds gives an empty result.
    """
    spark = edges.sparkSession
    step = edges.select("src", "dst", "ord")
    if per_node is not None:
        nth = F.row_number().over(Window.partitionBy("src").orderBy("ord", "dst"))
        step = step.withColumn("_n", nth).where(F.col("_n") <= per_node)
    step = durable(step.select("src", "dst").distinct(), "steps")
    kinds = step.select(F.col("dst").alias("id"), F.lit(0).alias("hop")).schema
    path = folder(spark, "levels")
    level = lambda n: f"{path}/level={n:04d}"
    seeds.select("id").distinct().withColumn("hop", F.lit(0)).write.parquet(level(0))
    done = [level(0)]
    for hop in range(1, depth + 1):
        frontier, seen = spark.read.schema(kinds).parquet(done[-1]), spark.read.schema(kinds).parquet(*done)
        if frontier.isEmpty():
            break
        fresh = step.join(frontier.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).distinct()
        fresh.join(seen.select("id"), "id", "left_anti").withColumn("hop", F.lit(hop)).write.parquet(level(hop))
        done.append(level(hop))
    return spark.read.schema(kinds).parquet(*done)


def expand_citations(links: DataFrame, seeds: DataFrame, depth: int, limit: int, least: int, excluded: DataFrame | None = None) -> DataFrame:
    """(root, path, id, level): citations of citations, the ``limit`` most cited of each, down to ``depth`` levels.

    ``links`` has (paper, id, cites, ord). An excluded id is neither listed nor followed. The chosen citations and each level are
    written to the shared folder; the expansion ends with the first level that is empty.
    """
    if excluded is not None:
        links = links.join(excluded.select(F.col("id")), "id", "left_anti")
    nth = F.row_number().over(Window.partitionBy("paper").orderBy(F.desc("cites"), "ord", "id"))
    best = links.where(F.coalesce("cites", F.lit(0)) >= least).withColumn("_n", nth).where(F.col("_n") <= limit).select("paper", F.col("id").alias("child"))
    best = durable(best, "citations")
    level = seeds.select(F.col("id").alias("root"), F.col("id").alias("path"), "id")
    out = None
    for n in range(1, depth + 1):
        level = level.join(best, level["id"] == best["paper"]).select("root", F.concat_ws("/", "path", "child").alias("path"), F.col("child").alias("id"))
        level = durable(level, "level")
        if out is not None and level.isEmpty():
            break
        row = level.withColumn("level", F.lit(n))
        out = row if out is None else out.unionByName(row)
    return out

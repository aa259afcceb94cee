"""Connected components of an edge list by small-star and large-star steps on what is not settled.

Each step is a minimum per node and a join; no neighbour list is ever gathered. A small star leads a node's smaller neighbours to
the least of them. After it, a node without a larger neighbour has one edge, to that least one, whose root is its own: such leaves
are set aside, and further steps see only the nodes that some edge still has to bring together. So stars cost no join, forests
that agree but for a few nodes cost joins of about these few, and each leaf is joined once, in the end, to its hub's root.

The minimum is combined on the map side and written to the shared folder, so that both sides of a join come from plain exchanges:
only then does adaptive execution split the partition of a node with very many neighbours. Every round's edges are written too,
which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, n, inner): the least of the n smaller neighbours of each node that has any, and whether it has larger ones as well."""
    ends = edges.select("u", "v", F.lit(False).alias("low")).unionByName(edges.select(F.col("v").alias("u"), F.lit(None).cast("long").alias("v"), F.lit(True).alias("low")))
    found = ends.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n"), F.max("low").alias("inner"))
    return cut(found.where("m is not null"), "least")


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges; root is the least node reachable. Without edges the result is empty."""
    now = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v").distinct()
    now, levels = cut(now, "edges"), []
    for _ in range(rounds):
        least = _least(now)
        levels.append(least.where("not inner").select("u", "m"))
        # a node's own edge to its least neighbour is a row of ``least`` and needs no join; only what has another neighbour is joined
        several = now.join(least.where("n > 1"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(several.unionByName(least.where("inner").select("u", F.col("m").alias("v"))).distinct(), "edges")
        if now.isEmpty():
            break
        up = _least(now).select(F.col("u").alias("v"), "m")
        now = cut(now.join(up, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct(), "large")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    leaves = levels.pop()
    roots = leaves.select(F.col("u").alias("node"), F.col("m").alias("root")).unionByName(leaves.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct())
    for leaves in reversed(levels):
        # hubs without a root lead nowhere else and are their own
        named = cut(leaves.join(roots.withColumnRenamed("node", "m"), "m", "left"), "leaves")
        tops = named.where("root is null").select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
        roots = roots.unionByName(named.select(F.col("u").alias("node"), F.coalesce("root", "m").alias("root"))).unionByName(tops)
    return roots

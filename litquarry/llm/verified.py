"""Components of sets that meet under keys and are similar enough by their whole elements, without listing the pairs of a key.

First, Spark counts in how many of the meeting sets each element occurs: a set's own elements, u of its n, are in no intersection, so two
sets have at most ``(n - u) / (n + u')`` in common. A set that cannot reach the similarity by that leaves its keys: this is what texts of
one template do, each with parts of its own. The others are compared with their key's hub, the set with the fewest elements of its own (of
edited copies, the original), and where very many are left apart by it, with further ones. Only sets of one key that are then still in
different components are taken pair by pair, and only where their own elements and what each lacks of the hub leave enough in common
(``_rest``); for edited copies of one text that is close to the truth. No link between sets of one key is lost.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut
from .components import components

#: Sets that a key left apart by its hubs may have before another hub is taken, how many hubs at the most, and words of 64 bits that
#: say what a set lacks of its hub. They change what is compared with what, and no result.
WIDE, STARS, LACKS = 4096, 8, 8


def _possible(n, u, m, v, similarity: int):
    """Whether sets of n and m shingles, u and v of which no other set has, can be similar enough."""
    both = F.least(n - u, m - v)
    return 100 * both >= similarity * (n + m - both)


def linked(shared: DataFrame, sets: DataFrame, similarity: int, passing: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """(node, root) for the nodes that have links; root is the least node reachable.

    ``shared`` has (key, node), each once, ``sets`` (node, n, shingles) with the n distinct elements, and what ``passing`` needs: that
    takes pairs (a, b) and the sets and returns those that are worth a comparison of whole sets. ``similarity`` is in hundredths.
    """
    own = sets.select("node", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("node"))
    own = own.where("k = 1").groupBy("node").agg(F.count(F.lit(1)).alias("u"))
    sized = sets.select("node", "n").join(own, "node", "left").select("node", "n", F.coalesce("u", F.lit(0)).alias("u"))
    sized = cut(sized.where(100 * (F.col("n") - F.col("u")) >= similarity * F.col("n")), "sized-sets")

    here = cut(shared.join(sized, "node").select("key", "node", "n", "u"), "sized-keys")
    hubs = here.groupBy("key").agg(F.min(F.struct("u", "node", "n")).alias("hub"), F.count(F.lit(1)).alias("k")).where("k > 1")
    # whatever its partner in the key is, that has at least as many shingles of its own as the hub
    here = here.join(cut(hubs, "hubs"), "key").where(100 * (F.col("n") - F.col("u")) >= similarity * (F.col("n") + F.col("hub.u")))
    here = cut(here.select("key", "node", "n", "u", "hub"), "possible-keys")

    def verified(pairs: DataFrame) -> DataFrame:
        some = cut(passing(pairs, sets), "passing-pairs")
        x, y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        whole = some.join(x, "a").join(y, "b").withColumn("both", F.size(F.array_intersect("x", "y")))
        return cut(whole.where(100 * F.col("both") >= similarity * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b"), "links")

    edges, parts, nth = None, here.withColumn("root", F.col("node")), 0
    while True:
        hub = [F.col(f"hub.{c}") for c in ("node", "n", "u")]
        apart = (F.col("node") != hub[0]) & ((F.col("root") != F.col("hub.root")) if nth else F.lit(True))
        stars = parts.where(apart & _possible(F.col("n"), F.col("u"), hub[1], hub[2], similarity))
        found = verified(cut(stars.select(F.col("node").alias("a"), hub[0].alias("b")).distinct(), "star-pairs"))
        edges, nth = found if edges is None else edges.unionByName(found), nth + 1
        roots = cut(components(edges), "roots")
        parts = _split(here, roots)
        widest = parts.groupBy("key").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0]
        if widest is None:
            return roots
        if widest <= WIDE or nth == STARS:
            break
        hubs = parts.where("root <> hub.root").groupBy("key").agg(F.min(F.struct("u", "node", "n", "root")).alias("hub"))
        parts = parts.drop("hub").join(cut(hubs, "hubs"), "key")
    rest = verified(cut(_rest(parts, sets, similarity), "rest-pairs"))
    return roots if rest.isEmpty() else cut(components(edges.unionByName(rest)), "roots")


def _split(here: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of the keys whose nodes are in different components, with each node's root and the hub's."""
    roots = roots.withColumnRenamed("node", "named")
    parts = here.join(roots, here["node"] == roots["named"], "left").select("key", "node", "n", "u", "hub", F.coalesce("root", "node").alias("root"))
    parts = cut(parts, "rooted-keys")
    split = parts.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.first("hub").alias("hub"), F.min(F.when(F.col("node") == F.col("hub.node"), F.col("root"))).alias("top"))
    split = split.where("lo < hi").select("key", F.struct("hub.u", "hub.node", "hub.n", F.coalesce("top", "hub.node").alias("root")).alias("hub"))
    return cut(parts.drop("hub").join(cut(split, "split-keys"), "key"), "split-rows")


def _measure(batches):
    """For sets and their hubs: the number of common shingles, and a bit for each of the hub's shingles that the set lacks."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("lacks", pa.list_(pa.int64()))])
    for batch in batches:
        common, lacks = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, LACKS), np.uint64)
        for i in range(batch.num_rows):
            x, y = (np.asarray(batch.column(c)[i].values).view(np.uint64) for c in ("x", "y"))
            there = np.isin(y, x, assume_unique=True)
            common[i] = there.sum()
            bits = y[~there]
            np.bitwise_or.at(lacks[i], (bits & K.U(LACKS - 1)).astype(np.int64), K.U(1) << (bits >> K.U(58)))
        lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * LACKS, pa.array(lacks.view(np.int64).ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common), lists], schema=schema)


def _rest(parts: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(a, b): pairs of one key in different components that may be similar enough.

    Of what two sets have in common, no more is in their hub than the hub has without what either lacks, and no more is outside it than the
    shingles that either has besides the hub's and its own. For edited copies of one text this is nearly what they have in common.
    """
    x, y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    pairs = parts.select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct()
    measured = cut(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_measure, "a long, b long, c long, lacks array<long>"), "measured")
    words = [F.get("lacks", F.lit(i)).alias(f"l{i}") for i in range(LACKS)]
    named = measured.select(F.col("a").alias("node"), F.col("b").alias("_hub"), "c", *words)
    rows = parts.withColumn("_hub", F.col("hub.node")).join(named, ["node", "_hub"])
    rows = cut(rows.select("key", "node", "root", "n", "u", F.col("hub.n").alias("h"), (F.col("n") - F.col("c") - F.col("u")).alias("besides"), *(f"l{i}" for i in range(LACKS))), "measured-rows")
    p, q = rows.alias("p"), rows.alias("q")
    lacking = sum((F.bit_count(F.col(f"p.l{i}").bitwiseOR(F.col(f"q.l{i}"))) for i in range(LACKS)), F.lit(0))
    both = F.least(F.col("p.n") - F.col("p.u"), F.col("q.n") - F.col("q.u"), F.col("p.h") - lacking + F.greatest(F.lit(0), F.least("p.besides", "q.besides")))
    near = 100 * both >= similarity * (F.col("p.n") + F.col("q.n") - both)
    rest = p.join(q, (F.col("p.key") == F.col("q.key")) & (F.col("p.node") > F.col("q.node")) & (F.col("p.root") != F.col("q.root")) & near)
    return rest.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()

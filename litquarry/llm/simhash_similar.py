"""SimHash near-deduplication at a similarity of the sets of word shingles.

One fingerprint of 64 bits within four bits finds copies with a similarity far above 0.8 only. Here each text has several
short fingerprints, made of independent bits. Each is ball hashed by itself, as in ``simhash``: it emits all variants within
one bit, and fingerprints that share a variant are linked. Texts whose fingerprints of one number fall into one component
are colliding; colliding texts are verified by the Jaccard similarity of their whole sets of shingles, and only verified pairs
are linked. A bit differs with probability arccos(2s / (1 + s)) / pi for two sets of one size with similarity s; from
that, the number of fingerprints follows so that a pair at the least similarity collides with probability ``RECALL``, and
their length grows with the logarithm of the number of texts so that chance collisions stay in proportion.

Colliding texts are compared as described in ``verified``, without pairs of all texts that collide, and by a sketch of 512 other
bits first, which a pair at the least similarity passes but once in about four thousand cases.

Defined results: words are runs of other bytes than ASCII white space, with A-Z in lower case; a text of fewer words than a
shingle is one shingle; null and blank texts are alike; one row stays of each component, whatever ids are null or repeat; a
very long text is hashed whole; other columns are carried along whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut, fresh, one_of_each
from .components import components
from .decontaminate import _LOWER, _pieces
from .simhash import links, majority
from .verified import linked

#: Words in a shingle, least similarity of a link, and the probability that a pair at that similarity collides.
SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.98
#: Most differing bits of two fingerprints that are linked, fewest bits of a fingerprint, bits beyond those that number all texts, and
#: bits for a fingerprint's number. From 2**41 texts on lengths grow no more; chance collisions then cost more, and results stay.
RADIUS, LEAST_BITS, SPARE_BITS, TABLE_BITS = 2, 32, 13, 10
#: Bytes of text that are hashed at a time.
TEXT_BYTES = 1 << 20
#: Variants that a group of fingerprints holds at a time.
VARIANTS = 2 << 20
#: Texts of a key that are compared by their sketches before their sets are made, and texts whose numbers are broadcast as a filter; of
#: more, the texts are shuffled.
FEW, BROADCAST_NODES = 8, 4 << 20
#: Words of 64 bits in a sketch, and by how many standard deviations a similar pair's sketches may differ more than expected.
SKETCH, DEVIATIONS = 8, 3.5


def bit_differs(similarity: float) -> float:
    """The probability that a bit of a fingerprint differs for two sets of one size."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def plan(n: int, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int]:
    """How many fingerprints each of n texts has, and their bits."""
    bits = min(64 - TABLE_BITS, max(LEAST_BITS, max(1, n).bit_length() + SPARE_BITS))
    p = bit_differs(similarity)
    meet = sum(math.comb(bits, k) * p**k * (1 - p) ** (bits - k) for k in range(RADIUS + 1))
    return math.ceil(math.log(1 - recall) / math.log(1 - meet)), bits


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text's shingles, one text after the other, and how many each has; at least one."""
    data, offsets = K.joined(texts)
    data = _LOWER[data]
    starts, ends, first = K.words(data, offsets)
    words = K.word_hashes(data, starts, ends)
    windows = K.window_hashes(words, shingle, K.WORD_BASE)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= shingle:
            sets.append(np.unique(windows[a : b - shingle + 1]))
        else:
            sets.append(K.window_hashes(words[a:b], b - a, K.WORD_BASE) if b > a else np.zeros(1, np.uint64))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.array([len(s) for s in sets], np.int64)


def lanes(hashes: np.ndarray, n: np.ndarray, first: int, count: int) -> np.ndarray:
    """Words of 64 independent bits, texts x count: a bit is set if over half of a text's shingles have it in that lane."""
    return np.stack([majority(K.mix(hashes, 101 + lane), n) for lane in range(first, first + count)], 1)


def short_fingerprints(hashes: np.ndarray, n: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Texts x tables: the number of the table above the bits of the text's fingerprint there."""
    whole = lanes(hashes, n, 0, -(-tables * bits // 64))
    every = np.unpackbits(whole.view(np.uint8), axis=1, bitorder="little")[:, : tables * bits].reshape(len(n), tables, bits)
    padded = np.zeros((len(n), tables, 64), np.uint8)
    padded[:, :, :bits] = every
    values = np.packbits(padded, axis=2, bitorder="little").view("<u8")[:, :, 0]
    return values | np.arange(tables, dtype=np.uint64) << K.U(bits)


def _fingerprints(shingle: int, tables: int, bits: int):
    schema = pa.schema([("node", pa.int64()), ("values", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for piece in _pieces(batch, 1, TEXT_BYTES):
                hashes, n = shingle_sets(piece.column(1), shingle)
                flat = pa.array(short_fingerprints(hashes, n, tables, bits).view(np.int64).ravel())
                values = pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * tables, flat)
                flat = pa.array(np.ascontiguousarray(lanes(hashes, n, 1000, SKETCH)).view(np.int64).ravel())
                sketch = pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * SKETCH, flat)
                yield pa.RecordBatch.from_arrays([piece.column(0), values, sketch], schema=schema)
            pa.default_memory_pool().release_unused()

    return run


def _sets(shingle: int):
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for piece in _pieces(batch, 1, TEXT_BYTES):
                hashes, n = shingle_sets(piece.column(1), shingle)
                sets = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n))).astype(np.int32), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([piece.column(0), sets], schema=schema)
            pa.default_memory_pool().release_unused()

    return run


def similar_roots(texts: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(node, root) for the nodes of (node, text) that have links, by the components of all colliding pairs that are similar enough."""
    tables, bits = plan(texts.count(), similarity, recall)
    prints = cut(texts.select("node", "text").mapInArrow(_fingerprints(shingle, tables, bits), "node long, values array<long>, sketch array<long>"), "short-fingerprints")
    sketches = prints.select("node", *(F.get("sketch", F.lit(i)).alias(f"s{i}") for i in range(SKETCH)))
    prints = prints.select("node", F.explode("values").alias("value"))
    # most values belong to one text and meet no other, so rows of texts are joined to the others only
    counted = cut(prints.groupBy("value").agg(F.count(F.lit(1)).alias("k")), "values")
    roots = cut(components(links(counted.select(F.col("value").alias("fp")), counted.count(), RADIUS, bits, VARIANTS)), "value-roots")
    named = counted.join(roots, counted["value"] == roots["node"], "left").where("root is not null or k > 1")
    named = cut(named.select("value", F.coalesce("root", "value").alias("key")), "value-keys")
    keys = cut(prints.join(named, "value").select("node", "key"), "keys")
    several = cut(keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key"), "meeting-keys")
    shared = cut(keys.join(several, "key").select("key", "node").distinct(), "shared-keys")
    shared = _worth(shared, sketches, similarity)
    nodes = cut(shared.select("node").distinct(), "meeting-nodes")
    wanted = F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes
    sets = texts.join(wanted, "node", "left_semi").select("node", "text").mapInArrow(_sets(shingle), "node long, shingles array<long>")
    sets = cut(sets.select("node", F.size("shingles").cast("long").alias("n"), "shingles"), "sets")

    def passing(pairs: DataFrame, _: DataFrame) -> DataFrame:
        x, y = (sketches.select(F.col("node").alias(c), F.struct(*(f"s{i}" for i in range(SKETCH))).alias(f"s{c}")) for c in "ab")
        return pairs.join(x, "a").join(y, "b").where(_near("sa", "sb", similarity)).select("a", "b")

    return linked(shared, sets, round(100 * similarity), passing)


def _near(x: str, y: str, similarity: float):
    """Whether sketches differ in no more bits than those of sets at the least similarity, but for once in four thousand times."""
    apart = bit_differs(similarity)
    most = int(64 * SKETCH * (apart + DEVIATIONS * math.sqrt(apart * (1 - apart) / (64 * SKETCH))))
    return sum((F.bit_count(F.col(f"{x}.s{i}").bitwiseXOR(F.col(f"{y}.s{i}"))) for i in range(SKETCH)), F.lit(0)) <= most


def _worth(shared: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """(key, node) without the texts of a key of few whose sketches are far from those of all others of it.

    Most keys are a few texts that collide by chance; their sketches say so before any set of shingles is made. Keys of more than
    FEW texts stay whole, so that no key makes more than a bounded number of pairs here.
    """
    sizes = cut(shared.groupBy("key").agg(F.count(F.lit(1)).alias("k")), "key-sizes")
    many = shared.join(sizes.where(F.col("k") > FEW), "key").select("key", "node")
    few = cut(shared.join(sizes.where(F.col("k") <= FEW), "key").join(sketches, "node").drop("k"), "keys-of-few")
    p, q = few.alias("p"), few.alias("q")
    pairs = p.join(q, (F.col("p.key") == F.col("q.key")) & (F.col("p.node") < F.col("q.node")) & _near("p", "q", similarity))
    alive = pairs.select(F.col("p.key").alias("key"), F.explode(F.array("p.node", "q.node")).alias("node")).distinct()
    return cut(many.unionByName(alive), "worth-keys")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One document of each component of near copies, with all its columns: the one with the smallest id, null ids last.

    Where each row has an id of its own, that is its number, and the documents, best given as a written table, are read where they lie.
    Else rows are numbered, which takes a copy of them.
    """
    node, ident = fresh(docs.columns, "_node"), F.col(id_col).cast("long")
    n, ids = docs.agg(F.count(F.lit(1)), F.count_distinct(ident)).first()
    rows = docs.withColumn(node, ident) if n == ids else cut(docs.withColumn(node, F.monotonically_increasing_id()), "numbered")
    texts = rows.select(F.col(node).alias("node"), F.col(text_col).alias("text"))
    roots = similar_roots(texts, shingle, similarity, recall)
    return one_of_each(rows, roots, node, id_col).select(*docs.columns)

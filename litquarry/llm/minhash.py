"""MinHash near-deduplication with HyperMinHash registers, verified on whole sets of shingles.

A text's set of shingles is hashed once. Each hash falls into one of 241 buckets; a bucket's register keeps of its least hash the number
of leading zeros and the ten bits after the first one. An empty bucket takes the register of the first full one along a path of its
own through all buckets, so that small sets fill all registers too, each from an element as good as drawn by chance. Bands of six registers
are the keys under which sets meet; two sets at the least similarity of 0.85 miss each other in all forty bands once in 10**8
times. Meeting sets are compared by their registers, less those that agree by chance (``estimate``), with a margin of five standard
deviations; what passes is verified by the whole sets. Only verified pairs are linked.

Equal sets are one node from the start, so a text that a third of all rows repeat is one set in one band. Pairs within a key are not
listed; how the sets of a key are compared is described in ``verified``.

Shingles are told apart by 64 bits, equal sets by 128 bits and their sizes.

Defined results: words are runs of other bytes than ASCII white space, with A-Z in lower case; a text of fewer words than a shingle is
one shingle; a text without words, or null, has no shingles and is linked with nothing, equal ones neither; a very long text is
hashed whole, and is one row; rows that repeat are linked, and all rows with the smallest id of their component are kept; a null
id counts as larger than all others, and a component of null ids has a null id and is kept; an empty table gives an empty
result; columns other than the id and the text are not read, but ``keep_one`` returns them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut, fresh, one_of_each
from .decontaminate import _LOWER, _pieces
from .verified import linked

#: Words in a shingle, and the least similarity of a link in hundredths.
SHINGLE, SIMILARITY = 3, 85
#: Registers (a prime number, so that every path leads through all of them), bands and registers in a band, bits after the first one.
REGISTERS, BANDS, ROWS, MANTISSA = 241, 40, 6, 10
#: By how many standard deviations an estimate may be below the least similarity.
DEVIATIONS = 5
#: Nodes that are broadcast as a filter; of more, the sets are shuffled.
BROADCAST_NODES = 4 << 20
#: Bytes of text that are hashed at a time.
TEXT_BYTES = 1 << 20
_EMPTY = ~np.uint64(0)
_STEPS = (1 + K.mix(np.arange(REGISTERS, dtype=np.uint64), 31) % K.U(REGISTERS - 1)).astype(np.int64)


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text's shingles, one text after the other, and how many each has."""
    data, offsets = K.joined(texts)
    data = _LOWER[data]
    starts, ends, first = K.words(data, offsets)
    words = K.word_hashes(data, starts, ends)
    windows = K.window_hashes(words, shingle, K.WORD_BASE)
    sets = [np.zeros(0, np.uint64)]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= shingle:
            sets.append(np.unique(windows[a : b - shingle + 1]))
        else:
            sets.append(K.window_hashes(words[a:b], b - a, K.WORD_BASE) if b > a else sets[0])
    return np.concatenate(sets), np.array([len(s) for s in sets[1:]], np.int64)


def registers(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Texts x registers: leading zeros above mantissa bits. A text without shingles has zeros."""
    text = np.repeat(np.arange(len(n)), n)
    bucket = ((K.mix(hashes, 32) >> K.U(32)) * K.U(REGISTERS) >> K.U(32)).astype(np.int64)
    least = np.full(len(n) * REGISTERS, _EMPTY, np.uint64)
    np.minimum.at(least, text * REGISTERS + bucket, np.minimum(K.mix(hashes, 33), _EMPTY - K.U(1)))
    own = least.copy()
    holes = np.flatnonzero(least.reshape(-1, REGISTERS) == _EMPTY)
    holes = holes[(n > 0)[holes // REGISTERS]]
    begin, place, step = holes - holes % REGISTERS, holes % REGISTERS, _STEPS[holes % REGISTERS]
    while len(holes):
        place = (place + step) % REGISTERS
        found = own[begin + place]
        full = found != _EMPTY
        least[holes[full]] = found[full]
        holes, begin, place, step = (x[~full] for x in (holes, begin, place, step))
    zeros = np.minimum(53 - np.frexp((least >> K.U(11)).astype(np.float64))[1], 53).astype(np.uint64)
    after = (least << (zeros + K.U(1))) >> K.U(64 - MANTISSA)
    out = (zeros << K.U(MANTISSA) | after).astype(np.uint16)
    out[np.repeat(n == 0, REGISTERS)] = 0
    return out.reshape(-1, REGISTERS)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Texts x bands: a hash of the band's number and registers."""
    some = regs[:, : BANDS * ROWS].reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(K.mix(np.arange(BANDS, dtype=np.uint64), 34), some.shape[:2])
    for k in range(0, ROWS, 3):
        word = np.zeros(some.shape[:2], np.uint64)
        for j in range(k, min(ROWS, k + 3)):
            word = word << K.U(16) | some[:, :, j]
        out = K.mix(out ^ K.mix(word, 35), 36 + k)
    return out


def by_chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The share of registers that agree although their least hashes differ, for sets of n and m elements.

    The least of e hashes has z leading zeros with probability (1 - 2**-(z + 1))**e - (1 - 2**-z)**e; its mantissa is nearly uniform.
    """
    zeros = np.arange(54)
    upper, lower = 1 - 2.0 ** -(zeros + 1), 1 - 2.0**-zeros
    one, other = (np.maximum(1, x / REGISTERS)[:, None] for x in (n, m))
    return ((upper**one - lower**one) * (upper**other - lower**other)).sum(1) / 2**MANTISSA


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The similarity of sets with n and m elements from their registers, without what agrees by chance."""
    chance = by_chance(n, m)
    return ((x == y).mean(1) - chance) / (1 - chance)


def _sketches(shingle: int):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("one", pa.int64()), ("other", pa.int64()), ("registers", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for piece in _pieces(batch, 2, TEXT_BYTES):
                hashes, n = shingle_sets(piece.column(2), shingle)
                ends = np.concatenate(([0], np.cumsum(n)))
                sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(K.mix(hashes, seed), dtype=np.uint64)))[ends] for seed in (37, 38)]
                one, other = (pa.array(np.diff(x).view(np.int64)) for x in sums)
                regs = pa.array([r.tobytes() for r in registers(hashes, n)], pa.binary())
                sets = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(n.astype(np.int32)), one, other, regs, sets], schema=schema)

    return run


def _from_registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _bands(batches):
    schema = pa.schema([("row", pa.int64()), ("one", pa.int64()), ("band", pa.list_(pa.int64()))])
    for batch in batches:
        keys = pa.array(band_keys(_from_registers(batch.column(2))).view(np.int64).ravel())
        lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS, keys)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], schema=schema)


def _passing(least: float):
    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("n", "m"))
            good = estimate(_from_registers(batch.column("x")), _from_registers(batch.column("y")), n, m) >= least
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _estimated(similarity: int):
    """Pairs whose registers say that they may be similar enough."""
    share = similarity / 100
    least = share - DEVIATIONS * (share * (1 - share) / REGISTERS) ** 0.5

    def passing(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        x = sets.select(F.col("node").alias("a"), "n", F.col("registers").alias("x"))
        y = sets.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("registers").alias("y"))
        return pairs.join(x, "a").join(y, "b").mapInArrow(_passing(least), "a long, b long")

    return passing


def _rooted(sketches: DataFrame, similarity: int) -> tuple[DataFrame, DataFrame]:
    """Distinct sets (one, other, n, node, least), and (node, root) for the nodes that have links; others are their own root."""
    full = sketches.where("n > 0")
    distinct = cut(full.groupBy("one", "other", "n").agg(F.min("row").alias("node"), F.min("doc_id").alias("least")), "distinct-sets")
    named = cut(full.select("row", "one", "other", "n").join(distinct, ["one", "other", "n"]).select("row", "node"), "named-rows")
    keys = full.select("row", "one", "registers").mapInArrow(_bands, "row long, one long, band array<long>").select("row", "one", F.explode("band").alias("key"))
    meeting = cut(keys.groupBy("key").agg(F.min("one").alias("lo"), F.max("one").alias("hi")).where("lo < hi").select("key"), "meeting-keys")
    shared = cut(keys.join(meeting, "key").join(named, "row").select("key", "node").distinct(), "shared-keys")

    nodes = cut(shared.select("node").distinct(), "meeting-nodes")
    wanted = F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes
    sets = full.select(F.col("row").alias("node"), F.col("n").cast("long").alias("n"), "registers", "shingles").join(wanted, "node", "left_semi")
    return distinct, linked(shared, cut(sets, "sets"), similarity, _estimated(similarity))


def _sketched(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cut(rows.mapInArrow(_sketches(shingle), "row long, doc_id long, n int, one long, other long, registers binary, shingles array<long>"), "sketches")


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    sketches = _sketched(docs, id_col, text_col, shingle)
    distinct, roots = _rooted(sketches, similarity)
    roots = roots.withColumnRenamed("node", "named")
    rooted = cut(distinct.join(roots, distinct["node"] == roots["named"], "left").select("one", "other", "n", F.coalesce("root", "node").alias("root"), "least"), "rooted-sets")
    ids = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    named = cut(rooted.join(ids, "root").select("one", "other", "n", "component_id"), "named-sets")
    rows = sketches.select("doc_id", "one", "other", "n").join(named, ["one", "other", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id, null ids last. Texts without words all stay."""
    node = fresh(docs.columns, "_node")
    rows = cut(docs.withColumn(node, F.monotonically_increasing_id()), "numbered")
    marked = minhash_dedup(rows, node, text_col, shingle, similarity)
    return one_of_each(rows, marked.select(F.col("doc_id").alias("node"), F.col("component_id").alias("root")), node, id_col).select(*docs.columns)

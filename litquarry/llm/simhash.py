"""SimHash near-deduplication by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits have a value between them that differs from each in at most r / 2 bits.
Every distinct fingerprint therefore emits all variants within r / 2 bits (2,081 for r = 4), the variants are shuffled,
and those that two fingerprints emit link them. No pair of fingerprints is formed otherwise, so the work is linear.

Emitted as rows, the variants would be several times the input. So the shuffle carries, for each group of fingerprints
and bucket, the sorted leading bits of the scrambled variants as gaps of two bytes, or more where the corpus is large, with the
few that do not fit beside them: so many bits are kept that one value in sixty-four at most agrees by chance. A bucket answers which values came
twice; only those variants are then sent whole, with their fingerprints, and are linked where they are equal. The leading
bits of unequal variants may agree, which costs an answer and changes nothing: all equal variants agree.

All fingerprints that emit one variant lie within r bits of each other, so a star around the least of them has the
components that all their pairs have. Buckets are linked so many together that a group of them has about ``MEETINGS`` meetings,
whatever the number of buckets, and a group sends a spanning forest of its stars: a fingerprint that meets others under many
variants is one row of it, and not one for each bucket.

Defined results: a null or blank text has the fingerprint zero, linked like any other; rows repeat as in the input; a null
id counts as larger than all others, and a component of null ids has a null id; an empty table gives an empty result;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut, fresh, groups_for, one_of_each, shuffle_partitions
from .components import components
from .groups import by_bucket, from_bytes

#: Words in a shingle, seed of their hash, most differing bits of a link.
SHINGLE, SEED, RADIUS = 4, 42, 4
#: Variants of a group, variants in a bucket, bits of the mean gap between a group's values in a bucket at least, and
#: bits that values have beyond those that number all variants.
GROUP, BUCKET, GAP_BITS, SPARE_BITS = 8 << 20, 4 << 20, 12, 6
#: Variants that meet in buckets that are linked together.
MEETINGS = 1 << 20
_LANES = K.U(0x0101010101010101)


def majority(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For documents with n hashes each, one after the other: the bits that over half of a document's hashes have."""
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    m = n[full]
    begins = np.cumsum(m) - m
    blocks = -(-m // 255)  # a lane of eight bits counts up to 255
    first = np.cumsum(blocks) - blocks
    starts = np.repeat(begins, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    for k in range(8):
        lanes = np.add.reduceat((hashes >> K.U(k)) & _LANES, starts)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        bits = (2 * counts > m[:, None]).astype(np.uint8)
        out[full] |= np.ascontiguousarray(bits).view("<u8").ravel() << K.U(k)
    return out


def fingerprints(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    data, offsets = K.joined(texts)
    raw = data.tobytes()
    digest, hashes, n = xxhash.xxh64_intdigest, [], np.zeros(len(texts), np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        words = raw[a:b].lower().split()  # of bytes, both mean ASCII only
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        k = min(shingle, len(words))
        starts = [0, *(ends[: len(words) - k] + 1).tolist()]
        hashes.append(np.fromiter((digest(line[x:y], seed) for x, y in zip(starts, ends[k - 1 :].tolist(), strict=True)), np.uint64, len(starts)))
        n[i] = len(starts)
    return majority(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), n)


def fingerprint_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit number."""

    def run(batches):
        for batch in batches:
            fp = fingerprints(batch.column("text"), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def masks(half: int, width: int = 64) -> np.ndarray:
    """All values of at most ``half`` set bits among the lowest ``width``."""
    level, out = [(0, 0)], [0]
    for _ in range(half):
        level = [(m | 1 << b, b + 1) for m, lo in level for b in range(lo, width)]
        out += [m for m, _ in level]
    return np.array(out, np.uint64)


class _Layout:
    """How the scrambled variants of all groups are cut into buckets and values."""

    def __init__(self, n: int, radius: int, least: int, width: int = 64, variants: int | None = None):
        if radius % 2:
            raise ValueError("radius must be even: variants meet half way")
        self.masks = masks(radius // 2, width)
        group = max(1, (variants or GROUP) // len(self.masks))
        self.groups = groups_for(n, group)
        each, total = (max(1, k) * len(self.masks) for k in (min(n, group), n))
        self.bucket_bits = max(4, (max(least, groups_for(total, BUCKET)) - 1).bit_length())
        bits = max(each.bit_length() - 1 + GAP_BITS, total.bit_length() + SPARE_BITS)
        self.value_bits = max(8, min(64, bits) - self.bucket_bits)

    def places(self, fps: np.ndarray) -> np.ndarray:
        """Bucket and value of each variant of each fingerprint, as one number."""
        return K.mix((fps[:, None] ^ self.masks).ravel()) >> K.U(64 - self.bucket_bits - self.value_bits)


def _unsigned(column) -> np.ndarray:
    return column.combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _short(gaps: np.ndarray) -> tuple[int, bytes, bytes]:
    """Gaps in so many bytes each as take the least room in all, and those that do not fit, which the greatest number stands for."""
    bits = [int(np.count_nonzero(gaps >= K.U((1 << 8 * w) - 1))) for w in range(1, 8)]
    width = 1 + int(np.argmin([w * len(gaps) + 8 * n for w, n in enumerate(bits, 1)]))
    most = K.U((1 << 8 * width) - 1)
    low = np.minimum(gaps, most).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return width, low.tobytes(), gaps[gaps >= most].astype("<u8").tobytes()


def _long(width: int, low: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """The gaps that ``_short`` wrote."""
    gaps = np.zeros((len(low) // width, 8), np.uint8)
    gaps[:, :width] = low.reshape(-1, width)
    gaps = gaps.view("<u8").ravel()
    gaps[gaps == K.U((1 << 8 * width) - 1)] = wide
    return gaps


def _say(x: _Layout):
    schema = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("first", pa.binary()), ("width", pa.int32()), ("gaps", pa.binary()), ("wide", pa.binary())])

    def say(key, group):
        places = np.sort(x.places(_unsigned(group.column("fp"))))
        bucket = places >> K.U(x.value_bits)
        starts = K.run_starts(bucket)
        rows = []
        for b, lo, hi in zip(bucket[starts].tolist(), starts.tolist(), np.append(starts[1:], len(places)).tolist(), strict=True):
            mine = places[lo:hi]
            width, low, wide = _short(np.diff(mine))
            rows.append({"bucket": b, "grp": key[0].as_py(), "first": mine[:1].tobytes(), "width": width, "gaps": low, "wide": wide})
        return pa.Table.from_pylist(rows, schema=schema)

    return say


def _answer(key, said):
    values = []
    columns = (from_bytes(said.column("first"), np.uint64), said.column("width").to_pylist(), from_bytes(said.column("gaps"), np.uint8), from_bytes(said.column("wide"), np.uint64))
    for nth, (first, width, low, wide) in enumerate(zip(*columns, strict=True)):
        places = np.cumsum(np.concatenate((first, _long(width, low, wide))))
        values.append((places, np.full(len(places), nth, np.int32)))
    places, sender = (np.concatenate(v) for v in zip(*values, strict=True))
    order = np.argsort(places, kind="stable")
    places, sender = places[order], sender[order]
    equal = places[1:] == places[:-1]
    twice = np.concatenate((equal, [False])) | np.concatenate(([False], equal))
    places, sender = places[twice], sender[twice]
    order, bounds = by_bucket(sender)
    grps = said.column("grp").to_pylist()
    rows = [{"grp": grps[i], "places": np.unique(places[order[lo:hi]]).tobytes()} for i, lo, hi in bounds]
    return pa.Table.from_pylist(rows, schema=pa.schema([("grp", pa.int32()), ("places", pa.binary())]))


_MEETINGS = pa.schema([("bucket", pa.int32()), ("variants", pa.binary()), ("fps", pa.binary())])


def _meet(x: _Layout):
    def meet(key, group, answers):
        if not len(group) or not len(answers):
            return _MEETINGS.empty_table()
        fps = _unsigned(group.column("fp"))
        wanted = np.sort(np.concatenate(from_bytes(answers.column("places"), np.uint64)))
        places = x.places(fps)
        sieve = np.zeros(1 << 22, bool)
        sieve[(wanted & K.U((1 << 22) - 1)).astype(np.int64)] = True
        at = np.flatnonzero(sieve[(places & K.U((1 << 22) - 1)).astype(np.int64)])
        at = at[wanted[np.minimum(np.searchsorted(wanted, places[at]), len(wanted) - 1)] == places[at]]
        fp, variant = fps[at // len(x.masks)], fps[at // len(x.masks)] ^ x.masks[at % len(x.masks)]
        order, bounds = by_bucket((places[at] >> K.U(x.value_bits)).astype(np.int64))
        rows = []
        for b, lo, hi in bounds:
            mine = order[lo:hi]
            rows.append({"bucket": b, "variants": variant[mine].tobytes(), "fps": fp[mine].tobytes()})
        return pa.Table.from_pylist(rows, schema=_MEETINGS)

    return meet


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges (node, root) with the components of the edges a - b."""
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        top = v
        while (p := parent.setdefault(top, top)) != top:
            top = p
        while parent[v] != top:
            parent[v], v = top, parent[v]
        return top

    for u, v in zip(a.tolist(), b.tolist(), strict=True):
        u, v = root(u), root(v)
        if u != v:
            parent[max(u, v)] = min(u, v)
    return [(v, r) for v in list(parent) if (r := root(v)) != v]


def _link(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(key, said):
        variant, fp = (np.concatenate(from_bytes(said.column(c), np.uint64)) for c in ("variants", "fps"))
        order = np.lexsort((fp, variant))
        variant, fp = variant[order], fp[order]
        runs = K.run_starts(variant)
        hub = np.repeat(fp[runs], np.diff(np.append(runs, len(fp))))
        pair = np.unique(np.stack((fp, hub), 1)[fp != hub], axis=0)
        near = np.bitwise_count(pair[:, 0] ^ pair[:, 1]) <= radius
        edges = _forest(pair[near, 0], pair[near, 1])
        return pa.table([np.array([e[i] for e in edges], np.uint64).view(np.int64) for i in (0, 1)], schema=schema)

    return link


def links(distinct: DataFrame, n: int, radius: int = RADIUS, width: int = 64, variants: int | None = None) -> DataFrame:
    """(a, b): edges between the n distinct fingerprints ``fp`` whose components are those of all links of at most ``radius`` bits.

    Fingerprints are linked only if all bits above the lowest ``width`` are equal. ``variants`` is how many a group holds at a time.
    """
    least = shuffle_partitions(distinct.sparkSession)
    x = _Layout(n, radius, least, width, variants)
    groups = distinct.select("fp", F.pmod(F.xxhash64("fp"), F.lit(x.groups)).cast("int").alias("grp")).repartition(max(least, groups_for(x.groups, 16)), "grp").groupBy("grp")
    said = groups.applyInArrow(_say(x), "bucket int, grp int, first binary, width int, gaps binary, wide binary")
    answers = said.groupBy("bucket").applyInArrow(_answer, "grp int, places binary")
    meetings = groups.cogroup(answers.groupBy("grp")).applyInArrow(_meet(x), "bucket int, variants binary, fps binary")
    meetings = cut(meetings, "meetings")
    met = meetings.agg(F.coalesce(F.sum(F.octet_length("fps")), F.lit(0))).first()[0] // 8
    together = F.pmod(F.xxhash64("bucket"), F.lit(groups_for(met, MEETINGS))).alias("together")
    return meetings.select(together, "variants", "fps").groupBy("together").applyInArrow(_link(radius), "a long, b long").distinct()


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    rows = cut(fingerprint_rows(docs, id_col, text_col, shingle), "fingerprints")
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = cut(components(links(distinct.select("fp"), distinct.count(), radius)), "roots")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    rooted = cut(rooted, "rooted")
    ids = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    named = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id, null ids last.

    Rows are numbered, and decisions are joined back by that number, so that null and repeated ids name no other row.
    """
    node = fresh(docs.columns, "_node")
    rows = cut(docs.withColumn(node, F.monotonically_increasing_id()), "numbered")
    marked = simhash_dedup(rows, node, text_col, radius, shingle)
    roots = marked.select(F.col("doc_id").alias("node"), F.col("component_id").alias("root"))
    return one_of_each(rows, roots, node, id_col).select(*docs.columns)

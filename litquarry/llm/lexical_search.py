"""Ranked lexical search of all documents for every item of a benchmark, by sort-based accumulation.

One pass over the texts counts each document's terms and keeps how often it holds each term that an item has; these postings are
written once, and Spark counts documents, terms and document frequencies from them. A second pass goes over the postings: each task
takes the ranges of documents that it reads, lays the impacts of all matched (item, document) pairs one after the other, sorts the
packed keys item and document digit by digit (radix), adds the impacts of equal keys by ``reduceat``, and keeps the best of every
item in a heap. Only those are shuffled: a task sends at most ``top`` rows an item, however many documents match.

Items go out with the tasks in slices of checked size; documents are scanned once for each slice. A document is one row
whatever its length, and no list of an item's or a term's documents is ever gathered.

Scores are those of whole numbers, see ``impacts``. Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, with
A-Z in lower case. They are told apart by 64 bits of hash, and only from the items' terms: an unequal word counts as one of 10,000
of them once in 10**15 words.

Defined results: a text without terms, null or blank, is no document of the collection and is never found; an item without terms
finds nothing; each row of either table counts by itself, so rows that repeat are ranked one after the other; equal scores go by
ascending id, null ids last; a very long text is counted whole; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut
from .decontaminate import _pieces, slices

#: Documents kept for an item, and bytes of items' texts that go out with the tasks at a time.
TOP, SLICE_BYTES = 20, 4 << 20
#: Documents whose impacts are sorted at a time, most impacts of a sort, and into how many parts the rows of an item are ranked first.
RANGE, ENTRIES, PARTS = 1 << 16, 4 << 20, 64
#: Each byte as a term has it; what stands between terms becomes a space.
_TERM = np.array([x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256)], np.uint8)
_NO_ID = 1 << 63


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each term, text after text, and how many each text has."""
    data, offsets = K.joined(texts)
    data = _TERM[data]
    starts, ends, first = K.words(data, offsets)
    return K.word_hashes(data, starts, ends), np.diff(first)


def counted(texts: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many terms each text has, how many of the sorted vocabulary it holds, and these terms' places and occurrences."""
    hashes, n = terms(texts)
    if not len(vocabulary):
        return n, np.zeros(len(n), np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[at] == hashes
    keys = np.repeat(np.arange(len(n)), n)[known] << 32 | at[known]
    pairs, times = np.unique(keys, return_counts=True)
    held = np.bincount(pairs >> 32, minlength=len(n)) if len(n) else np.zeros(0, np.int64)
    return n, held, (pairs & 0xFFFFFFFF).astype(np.int32), times.astype(np.int32)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, volume: int) -> np.ndarray:
    """What a term with this weight adds to the score of a document with n terms that holds it tf times."""
    m = 100 - 25 + 25 * n * documents // max(1, volume)
    return weights * (1_000_000_000 * tf // (1000 * tf + 12 * m))


def radix_order(keys: np.ndarray) -> np.ndarray:
    """A stable order of unsigned keys, by their digits of 16 bits from the lowest; a digit in which all agree is left out."""
    order = np.arange(len(keys))
    for shift in range(0, 8 * keys.dtype.itemsize, 16):
        digit = (keys >> keys.dtype.type(shift)).astype(np.uint16)
        if len(digit) and (digit != digit[0]).any():
            order = order[np.argsort(digit[order], kind="stable")]
    return order


class _Items:
    """The items of a slice: ids by number, the sorted vocabulary, and for each of its terms the items with it and how often."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
        self.ids = [r[0] for r in rows]
        hashes, n = terms(pa.array([r[1] for r in rows], pa.string()))
        self.vocabulary, place = np.unique(hashes, return_inverse=True)
        pairs, times = np.unique(place.ravel().astype(np.int64) * max(1, len(rows)) + np.repeat(np.arange(len(rows)), n), return_counts=True)
        self.item, self.times = pairs % max(1, len(rows)), times.astype(np.int64)
        self.first = np.searchsorted(pairs // max(1, len(rows)), np.arange(len(self.vocabulary) + 1))


def _postings(vocabulary: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            for piece in _pieces(batch, 1):
                n, held, term, tf = counted(piece.column(1), vocabulary)
                ends = np.concatenate(([0], np.cumsum(held))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (term, tf)]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n.astype(np.int64)), *lists], schema=schema)

    return run


def _chunks(batches, items: _Items):
    """Ids, lengths and postings (document, term, tf) of ranges of up to RANGE documents that make about ENTRIES impacts at the most."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        n = batch.column(1).to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))))
        term, tf = (np.asarray(batch.column(c).flatten()).astype(np.int64) for c in (2, 3))
        made = np.concatenate(([0], np.cumsum(items.first[term + 1] - items.first[term])))[ends]
        lo = 0
        while lo < len(ids):
            hi = min(lo + RANGE, max(lo + 1, int(np.searchsorted(made, made[lo] + ENTRIES, "right")) - 1), len(ids))
            a, b = ends[lo], ends[hi]
            yield ids[lo:hi], n[lo:hi], np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1])), term[a:b], tf[a:b]
            lo = hi


def _sums(items: _Items, weights: np.ndarray, documents: int, volume: int, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray):
    """Item, document and score of each matched pair of a range of documents, by item and then document."""
    each = impacts(weights[term], tf, n[doc], documents, volume)
    fan = items.first[term + 1] - items.first[term]
    at = np.repeat(items.first[term] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())
    keys = items.item[at] << 16 | np.repeat(doc, fan)
    keys = keys.astype(np.uint32 if len(items.ids) <= 1 << 16 else np.uint64)
    order = radix_order(keys)
    keys, impact = keys[order].astype(np.int64), (np.repeat(each, fan) * items.times[at])[order]
    runs = K.run_starts(keys)
    return keys[runs] >> 16, keys[runs] & 0xFFFF, np.add.reduceat(impact, runs) if len(runs) else impact


def _best(items: _Items, weights: np.ndarray, documents: int, volume: int, top: int):
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        heaps: dict[int, list[tuple[int, int]]] = {}
        for ids, *postings in _chunks(batches, items):
            item, place, score = _sums(items, weights, documents, volume, *postings)
            runs = np.append(K.run_starts(item), len(item))
            for lo, hi in zip(runs[:-1].tolist(), runs[1:].tolist(), strict=True):
                heap, some = heaps.setdefault(int(item[lo]), []), score[lo:hi]
                least = heap[0][0] if len(heap) == top else 1
                if hi - lo > top:
                    least = max(least, int(np.partition(some, hi - lo - top)[hi - lo - top]))
                for x in np.flatnonzero(some >= least).tolist():
                    i = ids[place[lo + x]]
                    entry = (int(some[x]), -(_NO_ID if i is None else i))
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
        rows = [(item, None if -i == _NO_ID else -i, score) for item, heap in heaps.items() for score, i in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], schema.field(c).type) for c in range(3)], schema=schema)

    return run


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The best rows of each item with their ranks; first those of the parts that each item's rows are dealt to."""
    best_first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS)))
    place = F.row_number().over(Window.partitionBy("item", "part").orderBy(*best_first))
    some = parts.withColumn("place", place).where(F.col("place") <= top).drop("place", "part")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best_first))).where(F.col("rank") <= top)


def search(docs: DataFrame, bench: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item by score, those above zero."""
    spark, kinds = docs.sparkSession, "item_id long, rank int, doc_id long, score long"
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for part in slices(bench, item_col, item_text_col, slice_bytes):
        size = part.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        if size > 4 * slice_bytes:
            raise ValueError(f"items of {size} bytes share one slice; raise slice_bytes, now {slice_bytes}")
        items = _Items([(r["item_id"], r["text"]) for r in part.collect()])
        if not len(items.vocabulary):
            continue
        posted = cut(texts.mapInArrow(_postings(items.vocabulary), "doc_id long, n long, term array<int>, tf array<int>"), "postings")
        documents, volume = posted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        # one number for each term of the slice
        held = posted.select(F.explode("term").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(items.vocabulary), np.int64)
        for term, holding in held:
            weights[term] = weight(documents, holding)
        rows = _ranked(posted.where(F.size("term") > 0).mapInArrow(_best(items, weights, documents, volume, top), "item int, doc_id long, score long"), top)
        names = spark.createDataFrame(list(enumerate(items.ids)), "item int, item_id long")
        named = rows.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = named if out is None else out.unionByName(named)
    return spark.createDataFrame([], kinds) if out is None else out

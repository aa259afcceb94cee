"""Substring deduplication by Rabin-Karp hashes of every window of a fixed number of words.

A group of documents hashes each of its windows, keeps for each distinct hash the smallest document of the group, and
sends hash and document to the hash's bucket. A bucket sorts what it gets and answers, for each entry, by one bit whether
a smaller document somewhere starts the same window. The group then marks the windows, merges the marked ones into maximal
intervals of words and cuts them out. Two rounds of small binary rows are shuffled besides the texts, which move once.

Words are hashed twice, independently and without structure, and a window has a Rabin-Karp hash over each. Within a group two
windows are equal if both hashes agree, 128 bits. Between groups the first hash travels with 16 bits of the second, which also
chooses the bucket, so that 80 bits and the bucket's number decide: at 100 TB, some 10**13 windows in millions of buckets,
fewer than one unequal pair in ten thousand such corpora agrees.

Defined results: a null text has no words; a document with fewer words than a window loses none; a very long text is one row
of its group, whose arrays take about sixty bytes a word; repeated rows with one
id are not smaller than each other, so they lose nothing to each other; a null id counts as larger than all others; an
empty table gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from .common import groups_for, shuffle_partitions
from .groups import by_bucket, from_bytes, grouped, in_order, lengths

#: Words in a window, and the bytes of text whose windows make a bucket.
WINDOW, BUCKET_BYTES = 50, 16 << 20


class _Windows:
    """The windows of a group, its distinct ones in the order of buckets, and each distinct one's smallest document."""

    def __init__(self, group: pa.Table, width: int, buckets: int):
        self.rows, self.ids = in_order(group)
        self.data, offsets = K.joined(self.rows.column("text"))
        self.offsets = offsets
        self.starts, self.ends, self.first = K.words(self.data, offsets)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.doc = doc
        n = max(0, len(self.starts) - width + 1)
        self.at = np.flatnonzero(self.first[doc[:n] + 1] - np.arange(n) >= width)
        hashes, other = (K.window_hashes(K.word_hashes(self.data, self.starts, self.ends, seed), width, base)[self.at] for seed, base in ((0, K.WORD_BASE), (1, K.OTHER_BASE)))
        order, runs = K.classes(hashes, other)
        where = order[runs]  # the first window of each class: rows go by id, so its document is the smallest
        bucket = (other[where] % K.U(buckets)).astype(np.int64)
        sent = np.lexsort((where, bucket))  # within a bucket by place, so that equal documents stand together
        _, self.bounds = by_bucket(bucket[sent])
        first = where[sent]
        self.hashes, self.check, self.least = hashes[first], (other[first] >> K.U(48)).astype(np.uint16), self.ids[doc[self.at[first]]]
        entry = np.empty(len(where), np.int64)
        entry[sent] = np.arange(len(sent))
        self.entry = np.empty(len(hashes), np.int64)
        self.entry[order] = np.repeat(entry, np.diff(np.append(runs, len(order))))


def _say(width: int, buckets: int):
    def say(key, group):
        w = _Windows(group, width, buckets)
        rows = []
        for b, lo, hi in w.bounds:
            docs, times = lengths(w.least[lo:hi])
            rows.append((b, key[0].as_py(), w.hashes[lo:hi].tobytes(), w.check[lo:hi].tobytes(), docs.tobytes(), times.tobytes()))
        return pa.Table.from_pylist([dict(zip(_SAID.names, r, strict=True)) for r in rows], schema=_SAID)

    return say


_SAID = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("hashes", pa.binary()), ("checks", pa.binary()), ("docs", pa.binary()), ("times", pa.binary())])
_ANSWER = pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("smaller", pa.binary())])


def _answer(key, said):
    hashes = from_bytes(said.column("hashes"), np.uint64)
    docs = np.concatenate([np.repeat(d, t) for d, t in zip(from_bytes(said.column("docs"), np.int64), from_bytes(said.column("times"), np.uint32), strict=True)])
    every = np.concatenate(hashes)
    order, runs = K.classes(every, np.concatenate(from_bytes(said.column("checks"), np.uint16)))
    least = np.minimum.reduceat(docs[order], runs)
    smaller = np.empty(len(every), bool)
    smaller[order] = np.repeat(least, np.diff(np.append(runs, len(every)))) < docs[order]
    out, at = [], 0
    for grp, h in zip(said.column("grp").to_pylist(), hashes, strict=True):
        mine = smaller[at : at + len(h)]
        at += len(h)
        if mine.any():
            out.append({"grp": grp, "bucket": key[0].as_py(), "smaller": np.packbits(mine).tobytes()})
    return pa.Table.from_pylist(out, schema=_ANSWER)


def _cut(width: int, buckets: int, with_text: bool):
    schema = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
    schema = pa.schema(schema + [("kept", pa.string())] * with_text)

    def cut(key, group, answers):
        if not len(group):
            return schema.empty_table()
        w = _Windows(group, width, buckets)
        smaller = np.zeros(len(w.hashes), bool)
        places = {b: (lo, hi) for b, lo, hi in w.bounds}
        for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("smaller"), strict=True):
            lo, hi = places[b]
            smaller[lo:hi] = np.unpackbits(np.frombuffer(bits.as_py(), np.uint8))[: hi - lo]
        goes = smaller[w.entry] | (w.least[w.entry] < w.ids[w.doc[w.at]])
        hits = np.zeros(len(w.starts), bool)
        hits[w.at[goes]] = True
        gone = K.covered(hits, width)
        rows = []
        raw = w.data.tobytes()
        for i, doc in enumerate(w.rows.column("doc_id").to_pylist()):
            a, b = w.first[i], w.first[i + 1]
            kept = raw[w.offsets[i] : w.offsets[i + 1]].split()
            mine = gone[a:b]
            removed = []
            if mine.any():
                kept = [x for x, g in zip(kept, mine.tolist(), strict=True) if not g]
                removed = [{"start": s, "end": e} for s, e in zip(*(x.tolist() for x in K.spans(mine)), strict=True)]
            line = b" ".join(kept)
            row = {"doc_id": doc, "n_words": int(b - a), "n_removed": int(mine.sum()), "kept_sha256": hashlib.sha256(line).hexdigest(), "removed": removed}
            rows.append(row | ({"kept": line.decode("utf-8", "replace")} if with_text else {}))
        return pa.Table.from_pylist(rows, schema=schema)

    return cut


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, with_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, removed (intervals of words), and kept (the text)."""
    rows, volume = grouped(docs, id_col, text_col)
    buckets = max(shuffle_partitions(docs.sparkSession), groups_for(volume, BUCKET_BYTES))
    said = rows.groupBy("grp").applyInArrow(_say(width, buckets), "bucket int, grp int, hashes binary, checks binary, docs binary, times binary")
    answers = said.groupBy("bucket").applyInArrow(_answer, "grp int, bucket int, smaller binary")
    kept = ", kept string" if with_text else ""
    schema = f"doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,end:int>>{kept}"
    return rows.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(_cut(width, buckets, with_text), schema)

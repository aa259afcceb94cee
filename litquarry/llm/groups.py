"""Documents dealt to groups that a task can read more than once.

A group is a set of documents with the same hash of their id. It is shuffled once; every later step over the same groups
reuses that exchange. What a group says to the rest of the corpus is first made unique within the group, so a passage
that a third of all documents share costs one entry per group, whatever their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_for, shuffle_partitions, text_volume
from .kernels import run_starts

#: Bytes of text in a group. A group's working arrays take about forty times as much.
GROUP_BYTES = 4 << 20
LAST_ID = np.int64((1 << 63) - 1)


def grouped(docs: DataFrame, id_col: str, text_col: str, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """(grp, doc_id, text) dealt by grp, and the bytes of all texts."""
    spark = docs.sparkSession
    _, volume = text_volume(docs, text_col)
    n = groups_for(volume, group_bytes)
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col)))), F.lit(n)).cast("int").alias("grp"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    return rows.repartition(max(shuffle_partitions(spark), groups_for(n, 16)), "grp"), volume


def in_order(group: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The group's rows by id, then text, and the ids; a null id counts as larger than all others."""
    ids = group.column("doc_id").combine_chunks().fill_null(int(LAST_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    if len(ids) > 1 and (np.diff(ids[order]) == 0).any():
        texts = group.column("text").to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i] is not None, texts[i] or "")))
    return group.take(pa.array(order)), ids[order]


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """A stable order of entries by bucket, and (bucket, begin, end) in it for each bucket that has entries.

    The work depends on the entries alone, however many buckets there are.
    """
    if not len(bucket):
        return np.zeros(0, np.int64), []
    most = int(bucket.max())
    order = np.argsort(bucket.astype(np.uint16 if most < 1 << 16 else np.uint32), kind="stable")
    ordered = bucket[order]
    starts = run_starts(ordered)
    return order, list(zip(ordered[starts].tolist(), starts.tolist(), np.append(starts[1:], len(ordered)).tolist(), strict=True))


def lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a sequence without repetition and how often each stands in a row."""
    if not len(values):
        return values, np.zeros(0, np.uint32)
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[at], np.diff(np.append(at, len(values))).astype(np.uint32)


def from_bytes(column: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), dtype) for x in column]

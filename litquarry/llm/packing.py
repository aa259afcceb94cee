"""Best-fit packing of documents into sequences of several permitted lengths.

A document is cut into pieces of at most the largest length. Pieces are taken from the longest to the shortest. A piece
goes into the open bin that it leaves with the least room. If none can take it, a bin is opened: for each permitted length the
pieces still to come are laid into it, longest first, and the length that then costs least per token it holds, downsized to
that, is taken. At the end each bin is downsized to the shortest length that holds its contents. A length's cost is its own
plus a part that grows with its square, as attention does.

What looks best for one bin takes pieces from later ones, so a group is packed once with all lengths and once without each
number of the shortest ones, and the packing of least total cost stands. None is therefore dearer than packing with the largest
length alone and downsizing.

Packing is done in groups of documents with the same hash of their id, each of about ``GROUP`` pieces. With that many pieces a
group's loss is close to what one list of all would lose, and no list of all is needed. Only ids and lengths are shuffled.

Defined results: a null, empty or blank text has no tokens and no piece; repeated rows are packed each; a very long text is cut into pieces of the largest length; ties go to the smaller
length, then to the bin that came to that room first; a null id is packed and stays null; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, groups_for, shuffle_partitions

#: Permitted lengths, pieces in a group, and the length at which the square part of the cost equals the linear one.
SIZES, GROUP, SQUARE_FROM = (512, 1024, 2048, 4096, 8192), 20_000, 8192


def word_count(text: Column) -> Column:
    """Tokens are maximal runs of other characters than ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def cost(size: int, square_from: int = SQUARE_FROM) -> float:
    return size * (1 + size / square_from)


def total_cost(bins: list[int], square_from: int = SQUARE_FROM) -> float:
    return sum(cost(s, square_from) for s in bins)


class _Rest:
    """The pieces still to come, as distinct lengths in descending order and how many there are of each."""

    def __init__(self, lengths: list[int]):
        counts = Counter(lengths)
        self.lengths = sorted(counts, reverse=True)
        self.up = [-n for n in self.lengths]
        self.counts = [counts[n] for n in self.lengths]
        self.now = 0

    def take(self) -> None:
        self.counts[self.now] -= 1
        while self.now < len(self.counts) and not self.counts[self.now]:
            self.now += 1

    def held(self, room: int) -> int:
        """Tokens that pieces to come would put into this room, longest first."""
        start, at = room, self.now
        while at < len(self.lengths):
            at = bisect_left(self.up, -room, at)
            if at == len(self.lengths):
                break
            room -= self.lengths[at] * min(self.counts[at], room // self.lengths[at])
            at += 1
        return start - room


def _pack(lengths: list[int], menu: tuple[int, ...], sizes: tuple[int, ...], square_from: int) -> tuple[list[int], list[int], list[int]]:
    rest = _Rest(lengths)
    price = {s: cost(s, square_from) for s in sizes}
    room: dict[int, deque[int]] = {}  # bins by the room they have, first come first
    open_ = 0  # the bit of each room that some bin has
    used: list[int] = []
    bin_of, offset = [], []
    for n in lengths:
        rest.take()
        fits = open_ >> n << n
        if fits:
            space = (fits & -fits).bit_length() - 1
            bins = room[space]
            b = bins.popleft()
            if not bins:
                open_ &= ~(1 << space)
        else:
            best = None
            for s in menu:
                if s >= n:
                    held = n + rest.held(s - n)
                    per_token = price[sizes[bisect_left(sizes, held)]] / held
                    if best is None or per_token < best[0]:
                        best = (per_token, s)
            space = best[1]
            b = len(used)
            used.append(0)
        bin_of.append(b)
        offset.append(used[b])
        used[b] += n
        space -= n
        if space:
            room.setdefault(space, deque()).append(b)
            open_ |= 1 << space
    return bin_of, offset, [sizes[bisect_left(sizes, u)] for u in used]


def pack(lengths: list[int], sizes: tuple[int, ...], square_from: int = SQUARE_FROM) -> tuple[list[int], list[int], list[int]]:
    """For pieces in descending order of length: the bin and offset of each, and the size of each bin."""
    sizes = tuple(sorted(sizes))
    return min((_pack(lengths, sizes[k:], sizes, square_from) for k in range(len(sizes))), key=lambda packed: total_cost(packed[2], square_from))


_PACKED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start_token", pa.int64()), ("n_tokens", pa.int32()), ("bin_id", pa.string()), ("bin_size", pa.int32()), ("bin_offset", pa.int32()), ("bin_used", pa.int32())])


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, ...] = SIZES, tokens: Column | None = None, group: int = GROUP, square_from: int = SQUARE_FROM) -> DataFrame:
    """One row per piece: doc_id, piece, start_token, n_tokens, bin_id, bin_size, bin_offset, bin_used.

    ``tokens`` counts a row's tokens where they are not words.
    """
    largest = max(sizes)
    counted = docs.select(F.col(id_col).cast("long").alias("doc_id"), (word_count(F.col(text_col)) if tokens is None else tokens).cast("long").alias("n"))
    counted = cut(counted.where("n > 0").withColumn("row", F.monotonically_increasing_id()), "lengths")
    pieces = counted.agg(F.coalesce(F.sum(F.ceil(F.col("n") / largest)), F.lit(0))).first()[0]
    groups = groups_for(int(pieces), group)

    def run(key, rows):
        ids, n, row = (rows.column(c).combine_chunks() for c in ("doc_id", "n", "row"))
        n, row = n.to_numpy().astype(np.int64), row.to_numpy()
        each = -(-n // largest)
        doc = np.repeat(np.arange(len(n)), each)
        nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        size = np.minimum(n[doc] - nth * largest, largest)
        order = np.lexsort((nth, row[doc], -size))
        doc, nth, size = doc[order], nth[order], size[order]
        bin_of, offset, bins = pack(size.tolist(), sizes, square_from)
        bin_of = np.array(bin_of, np.int64)
        used = np.bincount(bin_of, size, minlength=len(bins)).astype(np.int32)
        name = f"{key[0].as_py():x}-"
        columns = [ids.take(pa.array(doc)), nth.astype(np.int32), nth * largest, size.astype(np.int32), pa.array([f"{name}{b:x}" for b in bin_of.tolist()]), np.array(bins, np.int32)[bin_of], np.array(offset, np.int32), used[bin_of]]
        return pa.table([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=_PACKED)

    dealt = counted.withColumn("grp", F.pmod(F.xxhash64("doc_id", "row"), F.lit(groups)).cast("int"))
    schema = "doc_id long, piece int, start_token long, n_tokens int, bin_id string, bin_size int, bin_offset int, bin_used int"
    return dealt.repartition(max(shuffle_partitions(docs.sparkSession), groups_for(groups, 16)), "grp").groupBy("grp").applyInArrow(run, schema)

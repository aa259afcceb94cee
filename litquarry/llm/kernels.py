"""Array kernels over the bytes of a group of texts: words, rolling hashes, minimisers.

Hashes are made on slices of bounded length. What is kept for each word or position of a group is stated where it is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
#: Positions that are hashed at a time, so few that a core's cache holds them, and bytes of words that are hashed one by one.
SLICE, LONG_WORD = 1 << 16, 64
#: Masks of the low bytes, by their number.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Odd bases of the rolling hashes (modulo 2**64), so that each power has an inverse.
BYTE_BASE, WORD_BASE, OTHER_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 20)
        have = tuple(np.multiply.accumulate(np.concatenate(([U(1)], np.full(n - 1, U(b))))) for b in (base, pow(base, -1, 1 << 64)))
        _powers[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x + U(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def rolling(values: np.ndarray, base: int, starts: np.ndarray | None, ends: np.ndarray | None, width: int = 0) -> np.ndarray:
    """Rabin-Karp hash of values[s:e] for each pair, or of each run of ``width`` values when starts is None."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[: len(values)], out=total[1:])
    if starts is None:
        n = len(values) - width + 1
        return (total[width:] - total[:n]) * down[:n]
    return (total[ends] - total[starts]) * down[starts]


def joined(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other and the n + 1 places where they begin and end; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of other characters than ASCII white space, and how many words come before each text."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    first[offsets[:-1][full]] = inside[offsets[:-1][full]]
    last[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def packed(data: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The eight bytes from each place lo <= i < hi as one number; past the end of the data they are zero."""
    part = np.zeros(hi - lo + 7, np.uint8)
    have = data[lo : hi + 7]
    part[: len(have)] = have
    return np.ndarray((hi - lo,), "<u8", part, strides=(1,)).copy()


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word and the seed.

    Words of up to 64 bytes are scrambled eight bytes at a time, longer ones go through XXH64, so no hash is a sum of what
    single bytes add: words do not collide by their structure.
    """
    size = ends - starts
    out = mix(size.astype(U), seed + 17)
    short = np.flatnonzero(size <= LONG_WORD)
    k = 0
    while len(short):
        for i in range(0, len(short), SLICE):
            some = short[i : i + SLICE]
            at = starts[some] + k
            lo, hi = int(at.min()), int(at.max()) + 1
            eight = packed(data, lo, hi)[at - lo] if hi - lo <= 64 * len(some) + 64 else np.array([int.from_bytes(data[x : x + 8].tobytes(), "little") for x in at.tolist()], U)
            eight &= _LOW[np.minimum(size[some] - k, 8)]
            out[some] = mix(out[some] ^ eight, seed)
        k += 8
        short = short[size[short] > k]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return out


def window_hashes(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """The Rabin-Karp hash of each run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.empty(n, U)
    for i in range(0, n, SLICE):
        j = min(n, i + SLICE)
        out[i:j] = mix(rolling(values[i : j + width - 1], base, None, None, width))
    return out


def room(offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """For positions lo to hi of joined texts: the text's number, and how far its end is."""
    at = np.arange(lo, hi)
    text = np.searchsorted(offsets, at, "right") - 1
    return text, offsets[text + 1] - at


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values, by doubling."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def run_starts(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


def classes(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by the first value in which equal pairs stand together, and where each class of equal pairs begins."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
    if not len(a):
        return order, np.zeros(0, np.int64)
    return order, np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))


def covered(hits: np.ndarray, width: int) -> np.ndarray:
    """Which positions lie in a run of ``width`` positions that begins at a hit; no run passes the end."""
    step = np.zeros(len(hits) + 1, np.int32)
    at = np.flatnonzero(hits)
    step[at] += 1
    step[at + width] -= 1
    return np.cumsum(step[:-1]) > 0


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

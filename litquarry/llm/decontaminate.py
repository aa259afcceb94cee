"""Benchmark decontamination by edit distance.

An item and a document that holds it, with edits, share words and runs of bytes. Where a pair of neighbouring words, a long
word, or a run of eight bytes of an item stands in a document too, it fixes an item-sized window of the document. Of the runs
a quarter is taken, by their hash, wherever they begin, so that texts without spaces have them too. Item and window are embedded by the CGK random
walk: at each step the walk writes the symbol under it and moves on or stays by a coin that step and symbol decide, so that
an edit shifts the walk only until it falls back in step, and few edits leave few differing symbols. Repeated samples of a
few symbols of the embedding are compared; the windows that agree with their item in one repetition are candidates. Each edit
spoils at most three runs of three bytes, so a candidate with fewer runs of the item than that leaves is
dropped without loss, and an exact edit distance of the item to the surrounding text decides on the rest.

Items are sent to the tasks in slices of a checked size; documents are read once per slice, in place, and never shuffled. A
task looks at no more than ``HITS`` pairs of anchors at a time, by texts and, within a text, by items, however common an anchor is.

Texts are compared with A-Z in lower case and every run of ASCII white space as one space, by their UTF-8 bytes. An item is found
if its edit distance to some part of the document is at most (1 - similarity) of its length.

Defined results: null or blank items match nothing; a null or blank document holds nothing; repeated items are reported each
by their own id; the result lists each document row and item once, where it is nearest, of equally near places one; a very long
text is searched whole; columns other than the id and the text are not read, whatever their names; an empty table on either
side gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import groups_for, place_of

SIMILARITY = 0.8
#: Independent walks, repetitions in each, symbols in a repetition: with these a pair whose embeddings differ in 60 % of
#: their symbols is found with probability 0.96, one that differs in 75 % with 0.39.
WALKS, REPEATS, SYMBOLS = 4, 32, 4
#: Bytes of items in a slice, windows that walk at a time, and bytes of text that are searched at a time.
SLICE_BYTES, WINDOWS, TEXT_BYTES = 4 << 20, 1 << 15, 4 << 20
#: Bytes that make a pair of words, or a single word, distinctive.
PAIR_BYTES, WORD_BYTES = 9, 10
#: Bytes of a run that is an anchor wherever it stands; of an item of LONG_ITEM bytes or more, one run in GRAM_SHARE is taken.
GRAM_BYTES, GRAM_SHARE, LONG_ITEM = 8, 4, 100
#: Anchors in one neighbourhood that make a window a candidate without a walk.
ENOUGH = 4
#: Runs of bytes in one neighbourhood that make a window at all where no word or pair of words does: the most, the fewest, and the
#: bytes of an item for each.
MOST_RUNS, LEAST_RUNS, RUN_EACH = 3, 1, 40
#: Pairs of an anchor in a text and in an item that are held at a time.
HITS = 1 << 21
#: Bytes of the runs that are counted before an edit distance is computed.
RUN_BYTES = 3
#: Pairs whose edit distances are computed at once.
PAIRS = 512
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SIEVE, _SIEVE_SHIFT = 1 << 22, K.U(64 - 22)


def normalised(raw: bytes) -> bytes:
    return b" ".join(raw.lower().split())


def _anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, everything: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of distinctive words and pairs of words, and the number of the word at which each begins."""
    size = ends - starts
    words = K.word_hashes(data, starts, ends)
    if not len(words):
        return words, np.zeros(0, np.int64)
    pairs = K.mix(words[:-1] * K.U(K.WORD_BASE) + words[1:], 11)
    inside = np.ones(len(pairs), bool)
    last = first[1:-1] - 1
    inside[last[(last >= 0) & (last < len(pairs))]] = False
    at_pair = np.flatnonzero(inside & ((size[:-1] + size[1:] >= PAIR_BYTES) | everything))
    at_word = np.flatnonzero((size >= WORD_BYTES) | everything)
    return np.concatenate((pairs[at_pair], words[at_word])), np.concatenate((at_pair, at_word))


def _grams(data: np.ndarray, offsets: np.ndarray, take) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of those runs of bytes of the normalised texts whose first hash ``take`` chooses, the text of each and where it begins there."""
    space = K._SPACE[data]
    after_space = np.concatenate(([True], space[:-1]))
    after_space[offsets[:-1][offsets[:-1] < len(data)]] = True
    keep = ~(space & after_space)
    line = np.where(space, np.uint8(32), data)[keep]
    bounds = np.concatenate(([0], np.cumsum(keep)))[offsets]
    n = len(line) - GRAM_BYTES + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = []
    for lo in range(0, n, K.SLICE):
        part = np.ndarray(min(n - lo, K.SLICE), "<u8", line, lo, (1,)) * K.U(K.BYTE_BASE)
        parts.append(lo + np.flatnonzero(take(part)))
    at = np.concatenate(parts)
    text = np.searchsorted(bounds, at, "right") - 1
    inside = at + GRAM_BYTES <= bounds[text + 1]
    at, text = at[inside], text[inside]
    return np.ndarray(n, "<u8", line, 0, (1,))[at] * K.U(K.BYTE_BASE), text, at - bounds[text]


def _line_places(starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where each word begins in its text's normalised line."""
    total = np.concatenate(([0], np.cumsum(ends - starts + 1)))
    return total[:-1] - np.repeat(total[first[:-1]], np.diff(first))


def walk(buffer: np.ndarray, base: np.ndarray, n: np.ndarray, limit: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """CGK embeddings, steps x strings: string i is buffer[base : base + n], of which at most ``limit`` bytes are there."""
    coins = np.random.default_rng(seed).integers(0, 2, (steps, 256)).astype(np.int64)
    out = np.zeros((steps, len(base)), np.uint8)
    at, top = np.zeros(len(base), np.int64), np.minimum(n, limit)
    end = len(buffer) - 1
    for j in range(steps):
        symbol = np.where(at < top, buffer[np.minimum(base + at, end)], 0)
        out[j] = symbol
        at += coins[j][symbol]
    return out


def samples(n: np.ndarray, seed: int) -> np.ndarray:
    """The steps that are sampled for strings of n bytes, in the part of the walk that is still on the string."""
    share = np.random.default_rng(1000 + seed).random(REPEATS * SYMBOLS)
    return np.minimum((share[:, None] * 1.9 * n).astype(np.int64), np.maximum(2 * n - 1, 0))


def agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two strings' samples (repetitions * symbols x strings) are equal throughout a repetition."""
    return (x == y).reshape(REPEATS, SYMBOLS, -1).all(1).any(0)


def edit_distance_within(item: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """The least edit distance of the item to a part of the text and where that part ends, if at most ``most``."""
    at = text.find(item)
    if at >= 0:
        return 0, at + len(item)
    m = len(item)
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, where = full, 0, m, m, 0
    for j, c in enumerate(text):  # a bit for each symbol of the item: whether the column rises or falls there
        eq = masks.get(c, 0)
        d0 = (((eq & plus) + plus) ^ plus) | eq | minus
        hp, hn = minus | (full & ~(d0 | plus)), plus & d0
        score += bool(hp & high) - bool(hn & high)
        hp, hn = hp << 1 & full, hn << 1 & full
        plus, minus = hn | (full & ~(d0 | hp)), hp & d0
        if score < best:
            best, where = score, j + 1
    return (best, where) if best <= most else None


def edit_distances(lines: list[bytes], item: np.ndarray, buffer: np.ndarray, base: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For many pairs of lines[item] and buffer[base : base + n] at once: the least edit distance of the line to a part of the
    string, and where the first such part ends.

    Columns of the table are bits in words of 64, one bit where the column rises and one where it falls; all pairs move on by
    one symbol of their strings at a time, and from word to word a column hands on how its lowest entry changed.
    """
    out, where = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
    length = np.array([len(x) for x in lines], np.int64)
    one, sixty_three = K.U(1), K.U(63)
    by = np.argsort(length[item], kind="stable")
    for lo in range(0, len(by), PAIRS):
        mine = by[lo : lo + PAIRS]
        kinds, own = np.unique(item[mine], return_inverse=True)
        m, size = length[item[mine]], n[mine]
        words = int(-(-m.max() // 64))
        equal = np.zeros((words, len(kinds) * 257), np.uint64)  # 256 stands for what follows a string's end
        for k, i in enumerate(kinds.tolist()):
            line = np.frombuffer(lines[i], np.uint8).astype(np.int64)
            at = np.arange(len(line))
            np.bitwise_or.at(equal, (at // 64, k * 257 + line), one << (at % 64).astype(np.uint64))
        up, down = np.full((words, len(mine)), ~K.U(0)), np.zeros((words, len(mine)), np.uint64)
        last, top = (m - 1) // 64, ((m - 1) % 64).astype(np.uint64)
        score, best, end = m.copy(), m.copy(), np.zeros(len(mine), np.int64)
        row = own * 257
        for j in range(int(size.max())):
            symbol = np.where(j < size, buffer[np.minimum(base[mine] + j, len(buffer) - 1)], 256)
            rise, fall = np.zeros(len(mine), np.uint64), np.zeros(len(mine), np.uint64)
            for w in range(words):
                eq, pv, mv = equal[w, row + symbol], up[w], down[w]
                xv = eq | mv
                eq = eq | fall
                xh = (((eq & pv) + pv) ^ pv) | eq
                ph, mh = mv | ~(xh | pv), pv & xh
                ends = last == w
                if ends.any():
                    score += np.where(ends, ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64), 0)
                next_rise, next_fall = ph >> sixty_three, mh >> sixty_three
                ph, mh = ph << one | rise, mh << one | fall
                up[w], down[w] = mh | ~(xv | ph), ph & xv
                rise, fall = next_rise, next_fall
            less = score < best
            best[less], end[less] = score[less], j + 1
        out[mine], where[mine] = best, end
    return out, where


@dataclass
class Items:
    """A slice of the benchmark as its tasks use it."""

    ids: list
    lines: list[bytes]
    sieve: np.ndarray
    gram_sieve: np.ndarray
    few: np.ndarray  # runs of bytes that a window needs
    hashes: np.ndarray
    kind: np.ndarray  # the number of each hash among the distinct ones; anchors go by it, then by item
    item: np.ndarray
    offset: np.ndarray
    sampled: list[np.ndarray]
    most: list[int]
    bare: bool  # whether an item has no distinctive word or pair


def index(rows: list[tuple[int, str]], similarity: float = SIMILARITY) -> Items | None:
    rows = sorted(((i, normalised((t or "").encode())) for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [(i, t) for i, t in rows if t]
    if not rows:
        return None
    lines = [t for _, t in rows]
    data, offsets = K.joined(pa.array(lines, pa.large_binary()))
    starts, ends, first = K.words(data, offsets)
    place = _line_places(starts, ends, first)
    owner = np.repeat(np.arange(len(lines)), np.diff(first))
    hashes, at = _anchors(data, starts, ends, first)
    bare = np.ones(len(lines), bool)
    bare[owner[at]] = False
    if bare.any():  # items without a distinctive word or pair are sought by all they have
        every, there = _anchors(data, starts, ends, first, everything=True)
        more = bare[owner[there]]
        hashes, at = np.concatenate((hashes, every[more])), np.concatenate((at, there[more]))
    length = np.array([len(t) for t in lines])
    grams, holder, begin = _grams(data, offsets, lambda h: np.ones(len(h), bool))
    use = (length[holder] < LONG_ITEM) | (grams < K.U((1 << 64) // GRAM_SHARE))
    grams, holder, begin = grams[use], holder[use], begin[use]
    gram_sieve = np.zeros(_SIEVE, bool)
    gram_sieve[(grams >> _SIEVE_SHIFT).astype(np.int64)] = True
    hashes, item, offset = np.concatenate((hashes, K.mix(grams, 13))), np.concatenate((owner[at], holder)), np.concatenate((place[at], begin))
    order = np.lexsort((item, hashes))
    hashes, item, offset = hashes[order], item[order], offset[order]
    kind = np.cumsum(np.concatenate(([0], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
    sieve = np.zeros(_SIEVE, bool)
    sieve[(hashes & K.U(_SIEVE - 1)).astype(np.int64)] = True
    n = np.diff(offsets)
    sampled = [_sampled(data, offsets[:-1], n, n, seed) for seed in range(WALKS)]
    few = np.clip(length // RUN_EACH, LEAST_RUNS, MOST_RUNS)
    return Items([i for i, _ in rows], lines, sieve, gram_sieve, few, hashes, kind, item, offset, sampled, [int((1 - similarity) * len(t) + 1e-9) for t in lines], bool(bare.any()))


def _sampled(buffer: np.ndarray, base: np.ndarray, n: np.ndarray, limit: np.ndarray, seed: int) -> np.ndarray:
    out = np.zeros((REPEATS * SYMBOLS, len(base)), np.uint8)
    for i in range(0, len(base), WINDOWS):
        j = slice(i, i + WINDOWS)
        steps = samples(n[j], seed)
        embedded = walk(buffer, base[j], n[j], limit[j], int(steps.max()) + 1, seed)
        out[:, j] = embedded[steps, np.arange(embedded.shape[1])]
    return out


def _in_parts(text: np.ndarray, lo: np.ndarray, hi: np.ndarray, items: Items):
    """Anchors of texts, in the order of texts, and the ranges of equal anchors of items, so many at a time as HITS allows."""
    total = np.concatenate(([0], np.cumsum(hi - lo)))
    bounds = np.append(np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1]))), len(text))
    i = 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(total[bounds], total[bounds[i]] + HITS, "right")) - 1)
        a, b = bounds[i], bounds[j]
        i = j
        many = int(total[b] - total[a])
        if many <= HITS:
            yield slice(a, b), lo[a:b], hi[a:b]
            continue
        # one text alone: its pairs are taken by ranges of items
        n = len(items.lines)
        place, kind = items.kind * n + items.item, items.kind[lo[a:b]] * n
        step = max(1, n * HITS // many)
        for k in range(0, n, step):
            ends = [np.searchsorted(place, kind + min(n, x)) for x in (k, k + step)]
            yield slice(a, b), *ends


def search(texts: pa.Array, items: Items) -> list[tuple[int, int, int, int]]:
    """(text, item, distance, end in the normalised text) for each item that a text holds."""
    data, offsets = K.joined(texts)
    data = _LOWER[data]
    starts, ends, first = K.words(data, offsets)
    hashes, at = _anchors(data, starts, ends, first, everything=items.bare)
    some = np.flatnonzero(items.sieve[(hashes & K.U(_SIEVE - 1)).astype(np.int64)])
    hashes, at = hashes[some], at[some]
    grams, holder, there = _grams(data, offsets, lambda h: items.gram_sieve[(h >> _SIEVE_SHIFT).astype(np.int64)])
    text = np.concatenate((np.searchsorted(first, at, "right") - 1, holder))
    place = np.concatenate((_line_places(starts, ends, first)[at], there))
    worded = np.arange(len(text)) < len(at)
    hashes = np.concatenate((hashes, K.mix(grams, 13)))
    lo, hi = np.searchsorted(items.hashes, hashes), np.searchsorted(items.hashes, hashes, "right")
    use = np.flatnonzero(hi > lo)
    use = use[np.argsort(text[use], kind="stable")]
    text, place, worded, lo, hi = text[use], place[use], worded[use], lo[use], hi[use]
    raw, found = data.tobytes(), {}
    for part, a, b in _in_parts(text, lo, hi, items):
        _confirm(raw, offsets, text[part], place[part], worded[part], a, b, items, found)
    return [(*k, *v) for k, v in found.items()]


def _confirm(raw: bytes, offsets: np.ndarray, text: np.ndarray, place: np.ndarray, worded: np.ndarray, lo: np.ndarray, hi: np.ndarray, items: Items, found: dict) -> None:
    """Put into ``found`` the items that the windows hold which these anchors fix."""
    n = hi - lo
    hit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    if not len(hit):
        return
    text, worded = np.repeat(text, n), np.repeat(worded, n)
    item, begin = items.item[hit], np.repeat(place, n) - items.offset[hit]
    # one window for each text, item and neighbourhood
    order = np.lexsort((begin, item, text))
    text, item, begin = text[order], item[order], begin[order]
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (begin[1:] // 8 != begin[:-1] // 8)))
    anchors = np.diff(np.append(np.flatnonzero(new), len(new)))
    text, item, begin = text[new], item[new], begin[new]
    strong = (anchors >= items.few[item]) | (np.add.reduceat(worded[order].astype(np.int64), np.flatnonzero(new)) > 0)
    anchors, text, item, begin = anchors[strong], text[strong], item[strong], begin[strong]
    if not len(text):
        return
    wanted, number = np.unique(text, return_inverse=True)
    lines = [b" ".join(raw[offsets[t] : offsets[t + 1]].split()) for t in wanted.tolist()]
    size = np.array([len(x) for x in lines])
    line_at = np.cumsum(size) - size
    buffer = np.frombuffer(b"".join(lines), np.uint8)
    length = np.array([len(x) for x in items.lines])[item]
    begin = np.maximum(begin, 0)
    left = np.maximum(size[number] - begin, 0)
    near = anchors >= ENOUGH
    for seed in range(WALKS):
        rest = np.flatnonzero(~near)
        got = _sampled(buffer, (line_at[number] + begin)[rest], length[rest], left[rest], seed)
        near[rest] = agree(got, items.sampled[seed][:, item[rest]])
    near = np.flatnonzero(near)
    slack = np.array(items.most)[item] + 8
    from_, to = np.maximum(begin - slack, 0), np.minimum(begin + length + slack, size[number])
    near = near[_enough_runs(items, item[near], buffer, (line_at[number] + from_)[near], (to - from_)[near], RUN_BYTES)]
    least, end = edit_distances(items.lines, item[near], buffer, (line_at[number] + from_)[near], (to - from_)[near])
    for i, d, e in zip(near.tolist(), least.tolist(), end.tolist(), strict=True):
        key = (int(text[i]), int(item[i]))
        if d <= items.most[key[1]] and (key not in found or d < found[key][0]):
            found[key] = (d, e + int(from_[i]))


def _runs(buffer: np.ndarray, base: np.ndarray, n: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string buffer[base : base + n]: its number, and each run of q bytes with how often it came before."""
    m = np.maximum(n - q + 1, 0)
    owner = np.repeat(np.arange(len(base)), m)
    at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(base, m)
    run = sum(buffer[at + k].astype(np.int64) << 8 * k for k in range(q))
    key = np.sort(owner << 32 | run)
    starts = K.run_starts(key)
    nth = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
    return key >> 32, (key & (1 << 32) - 1) << 24 | np.minimum(nth, (1 << 24) - 1)


def _enough_runs(items: Items, item: np.ndarray, buffer: np.ndarray, base: np.ndarray, n: np.ndarray, q: int) -> np.ndarray:
    """The places of pairs of item and string that share as many runs of q bytes as the permitted edits leave of the item."""
    lines = np.frombuffer(b"".join(items.lines), np.uint8)
    length = np.array([len(x) for x in items.lines])
    line_at = np.cumsum(length) - length
    least = length - q + 1 - q * np.array(items.most)
    out, step = [], max(1, WINDOWS // 32)
    for lo in range(0, len(item), step):
        mine = item[lo : lo + step]
        (a, x), (b, y) = _runs(lines, line_at[mine], length[mine], q), _runs(buffer, base[lo : lo + step], n[lo : lo + step], q)
        # a run and its count are in both lists as often as the two strings share it
        pair, run = np.concatenate((a, b)), np.concatenate((x, y))
        order = np.lexsort((run, pair))
        pair, run = pair[order], run[order]
        same = (pair[1:] == pair[:-1]) & (run[1:] == run[:-1])
        shared = np.bincount(pair[:-1][same], minlength=len(mine))
        out.append(lo + np.flatnonzero(shared >= least[mine]))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _pieces(batch: pa.RecordBatch, column: int, text_bytes: int = TEXT_BYTES):
    """Slices of a batch of about ``text_bytes`` of text."""
    data, offsets = K.joined(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + text_bytes, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def slices(bench: DataFrame, item_col: str = "item_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> list[DataFrame]:
    """The benchmark in parts of about ``slice_bytes`` of text, by a hash of its rows. Each is checked again when it is taken."""
    rows = bench.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    volume = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = groups_for(int(volume), slice_bytes // 2)
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def _taken(part: DataFrame, similarity: float, slice_bytes: int) -> Items | None:
    size = part.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > 4 * slice_bytes:
        raise ValueError(f"items of {size} bytes share one slice; raise slice_bytes, now {slice_bytes}")
    return index([(r["item_id"], r["text"]) for r in part.collect()], similarity)


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document row and item it holds: doc_id, item_id, edit_distance, similarity, end_byte (in the normalised text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edit_distance", pa.int32()), ("similarity", pa.float64()), ("end_byte", pa.int64())])
    kinds = "doc_id long, item_id long, edit_distance int, similarity double, end_byte long"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for part in slices(bench, text_col="text", slice_bytes=slice_bytes):
        items = _taken(part, similarity, slice_bytes)
        if items is None:
            continue

        def run(batches, items=items):
            for batch in batches:
                for piece in _pieces(batch, 1):
                    ids = piece.column(0).to_pylist()
                    hits = [{"doc_id": ids[t], "item_id": items.ids[i], "edit_distance": d, "similarity": 1 - d / len(items.lines[i]), "end_byte": e} for t, i, d, e in search(piece.column(1), items)]
                    yield pa.RecordBatch.from_pylist(hits, schema=schema)

        found = rows.mapInArrow(run, kinds)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], kinds) if out is None else out


def keep_clean(docs: DataFrame, bench: DataFrame, text_col: str = "text", similarity: float = SIMILARITY, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The documents that hold no item, with all their columns; nothing is shuffled."""
    column = place_of(docs, text_col)
    for part in slices(bench, slice_bytes=slice_bytes):
        items = _taken(part, similarity, slice_bytes)
        if items is None:
            continue

        def run(batches, items=items):
            for batch in batches:
                for piece in _pieces(batch, column, TEXT_BYTES // 4):
                    clean = np.ones(piece.num_rows, bool)
                    clean[[t for t, *_ in search(piece.column(column), items)]] = False
                    yield piece.filter(pa.array(clean))
                pa.default_memory_pool().release_unused()

        docs = docs.mapInArrow(run, docs.schema)
    return docs

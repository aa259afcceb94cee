"""Alignment of the tokens of two tokenizers over the same bytes, and how often each pair of token ids is linked in the corpus.

Both token sequences of a text cover the same bytes, so the places where tokens of either side end are two increasing lists. Their
merge gives the places where both end, which cut the text into groups; tokens of one group are linked, each with each. Tokenizing,
merging and the digest of the groups happen in one pass over the texts in Arrow batches, whose result is written once: a row for each
document, and with the first document of each part of about ``GROUP_BYTES`` of text that part's dictionary, the distinct pairs
of ids in it and how many documents hold each. Documents refer to their pairs by place in it, as gaps.

Spark adds up the dictionaries by pair, takes the maxima of each side, and joins both back to the dictionaries. A part then sums
over its documents' links. So what is shuffled besides the narrow documents are distinct pairs of parts, and a pair that
every document has is one row for each part.

A byte-level vocabulary whose merges are numbered in their order is applied by ``tiktoken``, which gives the same tokens in a fraction of the
time; any other goes through ``tokenizers``.

Defined results: null and empty texts, and those whose tokens' bytes on either side are not the text after a space, have no tokens
and an empty digest; special tokens' strings are plain text; rows that repeat count each as a document, whatever their ids;
a group of many tokens on both sides is counted by its distinct ids; a very long text is taken whole, by itself where
it is larger than a part; an empty table gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, groups_for, shuffle_partitions
from .decontaminate import _pieces

#: Folder of the vocabularies, and the files of the two sides.
FOLDER, BYTE_FILE, PIECE_FILE = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text in a part, and links of a group from which its distinct ids are counted first.
GROUP_BYTES, MANY_LINKS = 32 << 20, 1 << 12
# How a byte-level vocabulary cuts text before it merges bytes.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass
class Side:
    """One tokenizer: how it encodes texts, the bytes of each token, and their number."""

    encode: object
    tokens: list[bytes]
    sizes: np.ndarray


def _side(encode, tokens: list[bytes]) -> Side:
    return Side(encode, tokens, np.array([len(t) for t in tokens], np.int64))


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@functools.cache
def byte_level(path: str) -> Side:
    """A byte-level vocabulary in the JSON form; texts are encoded after a space, special tokens' strings as plain text."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte_of, vocabulary = byte_alphabet(), model["vocab"]
    special = [t for t in vocabulary if any(c not in byte_of for c in t)]
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        tokens[i] = token.encode() if token in special else bytes(byte_of[c] for c in token)
    merges = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    made = {vocabulary[c] for c in byte_of if c in vocabulary}
    if len(made) == 256 and all(a < b for a, b in itertools.pairwise(merges)) and max(made) < merges[0]:
        import tiktoken

        ranks = {tokens[i]: i for i in [*made, *merges]}
        encoding = tiktoken.Encoding("byte level", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return _side(lambda texts: [encoding.encode_ordinary(" " + t) for t in texts], tokens)
    return _side(_by_library(path), tokens)


def _by_library(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.ids for e in tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]


@functools.cache
def pieces(path: str) -> Side:
    """A model of pieces with bytes for what it lacks; it puts the space in front itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        tokens.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return _side(lambda texts: model.encode(texts, num_threads=1), tokens)


@functools.cache
def _written(a: int, b: int) -> list[str]:
    """How a token is written in a digest: ids of side A inside a group and at its end, those of B inside, at its end, and at the text's."""
    return [f"{i}{end}" for n, ends in ((a, ",|"), (b, (",", ";", ""))) for end in ends for i in range(n)]


@dataclass
class Aligned:
    """For each of the texts of a piece: numbers of tokens, groups and links, the digest, and its distinct pairs with their links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    text: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def _ids(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(n.sum())), n


def _sum(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values between one end and the next; the first begins at 0."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[ends] - total[np.concatenate(([0], ends[:-1]))]


def align(texts: list[str | None], a: Side, b: Side) -> Aligned:
    n_a, n_b, n_groups, n_links = (np.zeros(len(texts), np.int64) for _ in range(4))
    digests = [""] * len(texts)
    full = [i for i, t in enumerate(texts) if t]
    lists = [side.encode([texts[i] for i in full]) for side in (a, b)]
    kept = []
    for k, i in enumerate(full):
        line = b" " + texts[i].encode()
        if all(b"".join(map(side.tokens.__getitem__, some[k])) == line for side, some in zip((a, b), lists, strict=True)):
            kept.append(k)
    rows = np.array([full[k] for k in kept], np.int64)
    nothing = np.zeros(0, np.int64)
    if not kept:
        return Aligned(n_a, n_b, n_groups, n_links, digests, nothing, nothing, nothing)
    (ids_a, na), (ids_b, nb) = (_ids([some[k] for k in kept]) for some in lists)
    ends_a, ends_b = np.cumsum(a.sizes[ids_a]), np.cumsum(b.sizes[ids_b])
    meet = np.searchsorted(ends_b, ends_a)  # both lists increase: where the merge finds the other side
    last_a = ends_b[meet] == ends_a
    last_b = np.zeros(len(ids_b), bool)
    last_b[meet[last_a]] = True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    wide_a, wide_b = np.bincount(group_a), np.bincount(group_b)
    until_a, until_b = np.concatenate(([0], np.cumsum(wide_a))), np.concatenate(([0], np.cumsum(wide_b)))
    text_ends_a, text_ends_b = np.cumsum(na), np.cumsum(nb)
    group_ends = group_a[text_ends_a - 1] + 1
    n_a[rows], n_b[rows], n_links[rows] = na, nb, _sum(wide_a * wide_b, group_ends)
    n_groups[rows] = np.diff(np.concatenate(([0], group_ends)))

    size_a, size_b = len(a.tokens), len(b.tokens)
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    codes[np.arange(len(ids_a)) + until_b[group_a]] = ids_a + size_a * last_a
    closing = last_b.astype(np.int64)
    closing[text_ends_b - 1] = 2
    codes[np.arange(len(ids_b)) + until_a[group_b + 1]] = 2 * size_a + ids_b + size_b * closing
    write, lo = _written(size_a, size_b).__getitem__, 0
    for i, hi in zip(rows.tolist(), np.cumsum(na + nb).tolist(), strict=True):
        digests[i] = hashlib.sha256("".join(map(write, codes[lo:hi].tolist())).encode()).hexdigest()
        lo = hi

    doc = np.repeat(np.arange(len(kept)), n_groups[rows])
    links = wide_a * wide_b
    plain = links <= MANY_LINKS
    few_a = plain[group_a]
    fan = wide_b[group_a[few_a]]
    other = np.repeat(until_b[group_a[few_a]] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())
    keys = [(np.repeat(doc[group_a[few_a]] * size_a + ids_a[few_a], fan)) * size_b + ids_b[other]]
    times = [np.ones(len(keys[0]), np.int64)]
    for g in np.flatnonzero(~plain).tolist():
        (x, cx), (y, cy) = (np.unique(ids[u[g] : u[g + 1]], return_counts=True) for ids, u in ((ids_a, until_a), (ids_b, until_b)))
        keys.append(((doc[g] * size_a + x)[:, None] * size_b + y).ravel())
        times.append((cx[:, None] * cy).ravel())
    if len(keys) == 1:
        key, many = np.unique(keys[0], return_counts=True)
    else:
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        many = np.zeros(len(key), np.int64)
        np.add.at(many, where.ravel(), np.concatenate(times))
    return Aligned(n_a, n_b, n_groups, n_links, digests, rows[key // (size_a * size_b)], key % (size_a * size_b), many)


def _packed(values: np.ndarray) -> bytes:
    """Numbers in as many bytes each as the largest needs, after a byte that says how many."""
    width = 1 if not len(values) or values.max() < 1 << 8 else 2 if values.max() < 1 << 16 else 4 if values.max() < 1 << 32 else 8
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_PART = pa.schema([("grp", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("groups_sha256", pa.string()), *((c, pa.binary()) for c in ("places", "times", "pairs", "holding"))])
_PART_KINDS = "grp long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary, pairs binary, holding binary"


def _part(grp: int, ids: list, done: list[Aligned]) -> pa.RecordBatch:
    """The rows of a part's documents, the first of which carries the part's dictionary."""
    first = np.cumsum([0, *(len(x.digests) for x in done)])
    text, pair, times = (np.concatenate(x) for x in zip(*((x.text + at, x.pair, x.times) for x, at in zip(done, first, strict=False)), strict=True))
    dictionary, place = np.unique(pair, return_inverse=True)
    place, ends = place.ravel(), np.searchsorted(text, np.arange(len(ids) + 1))
    bounds = list(itertools.pairwise(ends.tolist()))
    head = [None] * (len(ids) - 1)
    columns = [[grp] * len(ids), ids, *(np.concatenate([getattr(x, c) for x in done]) for c in _COUNTS), [d for x in done for d in x.digests]]
    columns += [[_packed(np.diff(place[lo:hi], prepend=0)) for lo, hi in bounds], [_packed(times[lo:hi]) for lo, hi in bounds]]
    columns += [[_packed(dictionary), *head], [_packed(np.bincount(place, minlength=len(dictionary))), *head]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PART.types, strict=True)], schema=_PART)


def _align_all(byte_path: str, piece_path: str, group_bytes: int):
    def run(batches):
        a, b = byte_level(byte_path), pieces(piece_path)
        grp, ids, done, volume = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for piece in _pieces(batch, 1):
                texts = piece.column(1)
                ids += piece.column(0).to_pylist()
                done.append(align(texts.to_pylist(), a, b))
                volume += texts.nbytes
                if volume >= group_bytes:
                    yield _part(grp, ids, done)
                    grp, ids, done, volume = grp + 1, [], [], 0
        if ids:
            yield _part(grp, ids, done)

    return run


def _entries(batches):
    schema = pa.schema([("grp", pa.int64()), ("place", pa.int32()), ("pair", pa.int64()), ("docs", pa.int64())])
    for batch in batches:
        for grp, pairs, holding in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pair = _unpacked(pairs)
            arrays = [np.full(len(pair), grp), np.arange(len(pair), dtype=np.int32), pair, _unpacked(holding)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], schema=schema)


def _sum_up(names: list[str]):
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), *((c, pa.int64()) for c in names), ("groups_sha256", pa.string())])

    def run(key, part, answers):
        if not part.num_rows:
            return schema.empty_table()
        values = np.zeros((3, answers.num_rows), np.int64)
        order = np.argsort(answers.column("place").to_numpy())
        for row, c in zip(values, ("best_a", "best_b", "count"), strict=True):
            row[:] = answers.column(c).to_numpy()[order]
        places, times = ([_unpacked(x.as_py()) for x in part.column(c)] for c in ("places", "times"))
        sums = [values[:, np.cumsum(p)] @ t if len(p) else np.zeros(3, np.int64) for p, t in zip(places, times, strict=True)]
        table = np.array(sums, np.int64)
        columns = [part.column("doc_id"), *(part.column(c) for c in _COUNTS), *(pa.array(table[:, i]) for i in range(3)), part.column("groups_sha256")]
        return pa.table(columns, schema=schema)

    return run


def _parts(docs: DataFrame, id_col: str, text_col: str, folder: str, byte_file: str, piece_file: str, group_bytes: int) -> tuple[DataFrame, DataFrame]:
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    aligned = cut(texts.mapInArrow(_align_all(f"{folder}/{byte_file}", f"{folder}/{piece_file}", group_bytes), _PART_KINDS), "aligned")
    return aligned, aligned.where("pairs is not null").select("grp", "pairs", "holding").mapInArrow(_entries, "grp long, place int, pair long, docs long")


def _counts(entries: DataFrame, size_b: int) -> DataFrame:
    """(pair, a_id, b_id, count, a_most, b_most): in how many documents a pair is linked, and the most that its ids have with any other."""
    counts = entries.groupBy("pair").agg(F.sum("docs").alias("count"))
    counts = cut(counts.select("pair", F.floor(F.col("pair") / size_b).cast("int").alias("a_id"), (F.col("pair") % size_b).cast("int").alias("b_id"), "count"), "pair-counts")
    for side in ("a", "b"):
        counts = counts.join(counts.groupBy(f"{side}_id").agg(F.max("count").alias(f"{side}_most")), f"{side}_id")
    return counts


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(a_id, b_id, count, a_most, b_most) for each pair of ids that some document links."""
    entries = _parts(docs, id_col, text_col, folder, byte_file, piece_file, group_bytes)[1]
    return _counts(entries, len(pieces(f"{folder}/{piece_file}").tokens)).select("a_id", "b_id", "count", "a_most", "b_most")


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best and n_best_b (links whose count is the highest of their id of either side), count_sum, groups_sha256."""
    aligned, entries = _parts(docs, id_col, text_col, folder, byte_file, piece_file, group_bytes)
    counts = _counts(entries, len(pieces(f"{folder}/{piece_file}").tokens))
    best = [(F.col("count") == F.col(f"{side}_most")).cast("long").alias(f"best_{side}") for side in "ab"]
    answers = entries.join(cut(counts.select("pair", *best, "count"), "pair-maxima"), "pair").select("grp", "place", "best_a", "best_b", "count")
    rows = aligned.drop("pairs", "holding")
    n = max(shuffle_partitions(docs.sparkSession), groups_for(aligned.where("pairs is not null").count(), 16))
    kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, n_best_b long, count_sum long, groups_sha256 string"
    return rows.repartition(n, "grp").groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(_sum_up(["n_best", "n_best_b", "count_sum"]), kinds)

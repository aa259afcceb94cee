import functools
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from litquarry.llm import exact_dedup, groups, simhash, simhash_similar, substring_dedup, suffix_dedup
from litquarry.llm import kernels as K
from litquarry.llm.components import components
from litquarry.llm.suffix_array import permuted_lcp, suffix_array

LAST = (1 << 63) - 1
SPACE = r"[\x20\x09-\x0D]+"


def order(doc_id):
    return LAST if doc_id is None else doc_id


def first_starts(rows, width):
    first = {}
    for i, x in sorted(rows, key=lambda r: order(r[0])):
        for j in range(len(x) - width + 1):
            first.setdefault(tuple(x[j : j + width]) if isinstance(x, list) else x[j : j + width], order(i))
    return first


def removed(rows, width):
    first = first_starts(rows, width)
    for i, x in rows:
        gone = [False] * len(x)
        for j in range(len(x) - width + 1):
            if first[tuple(x[j : j + width]) if isinstance(x, list) else x[j : j + width]] < order(i):
                gone[j : j + width] = [True] * width
        yield i, x, gone


@pytest.fixture
def tiny_groups(monkeypatch):
    """Groups of a few texts, so that small tables need several."""
    small = functools.partial(groups.grouped, group_bytes=3000)
    monkeypatch.setattr(substring_dedup, "grouped", small)
    monkeypatch.setattr(suffix_dedup, "grouped", small)


def test_substring_dedup_is_brute_force(spark, messy, texts, tiny_groups):
    want = []
    for i, x, gone in removed([(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts], 50):
        kept = " ".join(w for w, g in zip(x, gone) if not g)
        want.append((str(i), len(x), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = substring_dedup.substring_dedup(messy).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got) == sorted(want)
    for r in got:
        assert sum(e - s for s, e in r.removed) == r.n_removed


def test_suffix_dedup_is_brute_force(spark, messy, texts, tiny_groups):
    want = []
    for i, x, gone in removed([(i, (t or "").encode()) for i, t in texts], 50):
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want.append((str(i), len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.suffix_dedup(messy).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)


def test_suffix_dedup_needs_a_width():
    with pytest.raises(ValueError):
        suffix_dedup.suffix_dedup(None, width=8)


def test_shard_tells_bytes_that_are_no_utf8_apart():
    a, b = bytes([255, 254] * 40), bytes([255, 254] * 30 + [1] * 10)
    least, start = suffix_dedup.least_documents([a, b], np.array([7, 3]), 50)
    assert least[start[0]] == 3 and least[start[1]] == 3
    assert least[start[0] + 30] == 3 and least[start[1] + 25] == 3


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80))
def test_suffix_array_and_common_prefixes(symbols):
    t = np.array(symbols, np.uint8)
    want = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    sa = suffix_array(t, 4)
    assert sa.tolist() == want
    plcp = permuted_lcp(t, sa)
    for a, b in zip(want, want[1:]):
        same = next((k for k, (x, y) in enumerate(zip(symbols[a:], symbols[b:])) if x != y), min(len(symbols) - a, len(symbols) - b))
        assert plcp[b] == same


@given(st.integers(0, 10**9), st.sampled_from([2, 4, 30, 256]), st.sampled_from([None, 1, 7, 900]))
@settings(max_examples=12, deadline=None)
def test_suffix_array_recurses_over_many_names(seed, sigma, period):
    """Long strings, most of them with over 4,096 names, some of them repeating themselves."""
    rng = np.random.default_rng(seed)
    t = rng.integers(0, sigma, 60_000).astype(np.uint8)
    if period:
        t[20_000:40_000] = np.resize(t[:period], 20_000)
    sa, b = suffix_array(t, 256), t.tobytes()
    assert np.array_equal(np.sort(sa), np.arange(len(t)))
    rank = np.empty(len(t) + 1, np.int64)
    rank[sa], rank[len(t)] = np.arange(len(t)), -1
    # neighbours are in order if their first symbols are, and their rests are
    x, y = sa[:-1], sa[1:]
    assert ((t[x] < t[y]) | (t[x] == t[y]) & (rank[x + 1] < rank[y + 1])).all(), b[:20]


def thue_morse(n, a, b):
    return "".join(a if k.bit_count() % 2 else b for k in range(n))


def test_words_and_segments_that_weak_hashes_confuse(spark):
    """Polynomial hashes modulo powers of two cannot tell these two strings of 1,024 and 2,048 symbols apart."""
    rest = [f"w{k}" for k in range(49)]
    one, two = (" ".join([*rest, thue_morse(2048, *x)]) for x in ("ab", "ba"))
    rows = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(rows).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
    rows = spark.createDataFrame([(1, thue_morse(1024, "a", "b")), (2, thue_morse(1024, "b", "a"))], "doc_id long, text string")
    x, y = (thue_morse(1024, *p) for p in ("ab", "ba"))
    gone = [x[i : i + 50] in y for i in range(975)]
    want = sum(any(gone[max(0, i - 49) : i + 1]) for i in range(1024))
    got = {r.doc_id: r.n_removed for r in suffix_dedup.suffix_dedup(rows).collect()}
    assert got == {1: 0, 2: want}


def test_segments_with_equal_hashes_are_told_apart(spark, monkeypatch, messy):
    """With a hash that cannot tell anything apart at first, the groups take another seed and the result is the same."""
    want = sorted(map(str, suffix_dedup.suffix_dedup(messy).collect()))
    group = pa.table({"grp": [0, 0], "doc_id": [1, 2], "text": ["a" * 30 + "b" * 40, "c" * 30 + "d" * 40]})
    rolling, calls = K.rolling, []

    def weak(values, base, starts, ends, width=0):
        calls.append(1)
        return np.zeros(len(starts), np.uint64) if len(calls) == 1 else rolling(values, base, starts, ends, width)

    monkeypatch.setattr(K, "rolling", weak)
    content, first, _ = suffix_dedup._Segments(group, 50).contents()
    assert len(calls) > 1 and len(first) == len(set(content.tolist())) > 1
    monkeypatch.undo()
    assert sorted(map(str, suffix_dedup.suffix_dedup(messy).collect())) == want


def test_exact_dedup_is_brute_force(spark, messy, texts):
    norm = [(i, re.sub(SPACE, " ", t or "")) for i, t in texts]
    want = []
    for i, t in norm:
        alike = [j for j, u in norm if u == t]
        want.append((str(i), str(min(alike, key=order)), len(alike), hashlib.sha256(t.encode()).hexdigest()))
    got = exact_dedup.exact_dedup(messy).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == sorted(want)
    assert sum(r.kept for r in got) == len({t for _, t in norm})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_keep_first_keeps_columns_and_one_of_each(spark, messy, texts):
    out = exact_dedup.keep_first(messy)
    assert out.columns == messy.columns
    assert out.count() == len({re.sub(SPACE, " ", t or "") for _, t in texts})


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(n)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints_and_components(spark, messy, texts):
    prints = [(i, fingerprint(t)) for i, t in texts]
    reach = [{k} for k in range(len(prints))]
    changed = True
    while changed:
        changed = False
        for a, (_, x) in enumerate(prints):
            for b, (_, y) in enumerate(prints):
                if (x ^ y).bit_count() <= 4 and reach[a] is not reach[b]:
                    both = reach[a] | reach[b]
                    for k in both:
                        reach[k] = both
                    changed = True
    want = [(str(i), f"{x:016x}", str(min((prints[m][0] for m in reach[k]), key=order))) for k, (i, x) in enumerate(prints)]
    got = simhash.simhash_dedup(messy).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == sorted(want)


@pytest.mark.parametrize("group", [64 * 2081, 8 << 20])
def test_ball_hashing_finds_every_link(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = random.Random(11)
    centres = [rng.getrandbits(64) for _ in range(40)]
    near = [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(5)]
    values = sorted({*centres, *near, 0, (1 << 64) - 1})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), len(signed)).collect()
    mask = (1 << 64) - 1
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    want = dict(parent)
    for x in values:
        for y in values:
            if (x ^ y).bit_count() <= 4:
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
    want = {v: root(v) for v in values}
    parent = {v: v for v in values}
    for r in found:
        a, b = root(r.a & mask), root(r.b & mask)
        parent[max(a, b)] = min(a, b)
    assert {v: root(v) for v in values} == want


def test_simhash_radius_is_even():
    with pytest.raises(ValueError):
        simhash._Layout(10, 3, 4)


def test_keep_one(spark, messy, texts):
    out = simhash.keep_one(messy)
    assert out.columns == messy.columns
    ids = [r.doc_id for r in out.collect()]
    assert 1 in ids and 6 not in ids and 3 in ids and 4 not in ids


@pytest.mark.parametrize("keep_one", [simhash.keep_one, simhash_similar.keep_one])
def test_keep_one_where_ids_are_null_or_repeat(spark, keep_one):
    rng = random.Random(12)
    a, b, c, d, e, f = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6))
    # near copies differ in letters only, so that fingerprints and shingles are equal
    rows = [(1, a), (None, a.upper()), (None, b), (3, c), (5, c.upper()), (5, d), (9, d.upper()), (None, e), (None, e.upper()), (None, e.title()), (7, f), (7, f)]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text.lower()) for r in got) == sorted([("1", a), ("None", b), ("3", c), ("5", d), ("None", e), ("7", f)])


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path + star + [(5, 5)], "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 7 for i in range(200, 260)) and got[7] == 7 and 5 not in got


@pytest.mark.parametrize("run", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, exact_dedup.exact_dedup, exact_dedup.keep_first, simhash.simhash_dedup, simhash.keep_one, simhash_similar.keep_one])
def test_empty_table(nothing, run):
    assert run(nothing).collect() == []


def test_lone_segments_stay_out_of_the_array(monkeypatch):
    """A segment that alone has its key holds no string of another one; all of a shard's segments were sorted."""
    sizes, array = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda t, sigma: sizes.append(len(t)) or array(t, sigma))
    shared = bytes(range(65, 115))
    segments = [[b"x" + shared, bytes(range(130, 190))], [shared + b"y", bytes(range(130, 190))]]
    u16, u64 = (lambda x, t=t: np.array(x, t).tobytes() for t in (np.uint16, np.uint64))
    rows = [
        {"shard": 0, "grp": g, "bytes": zstandard.compress(b"".join(s)), "sizes": u16([len(x) for x in s]), "keys": u64([7, 9]), "contents": u64([10 + g, 20]), "docs": np.array([5 - g], np.int64).tobytes(), "times": np.array([2], np.uint32).tobytes()}
        for g, s in enumerate(segments)
    ]
    found = suffix_dedup._shard(50)((pa.scalar(0),), pa.Table.from_pylist(rows, schema=suffix_dedup._SEGMENTS)).to_pylist()
    assert sizes == [2 * 52]
    assert [(f["grp"], np.frombuffer(f["contents"], np.uint64).tolist(), np.frombuffer(f["sizes"], np.uint16).tolist(), np.frombuffer(f["docs"], np.int64).tolist()) for f in found] == [(0, [10, 20], [1, 1, 11], [5, 4, 4])]


def test_a_cluster_makes_a_row_a_fingerprint(spark, monkeypatch):
    """Fingerprints near one another meet under many variants, in many buckets; each bucket's forest named them again."""
    values = [0, *(1 << k for k in range(30)), 1 << 40 | 7]
    run = simhash._link

    def counted(radius):
        link = run(radius)
        return lambda key, said: pa.table({"a": [0], "b": [len(link(key, said))]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    distinct = spark.createDataFrame([(v,) for v in values], "fp long").repartition(3)
    linked = {(r.node, r.root) for r in components(simhash.links(distinct, len(values))).collect()}
    assert linked == {(v, 0) for v in values}
    monkeypatch.setattr(simhash, "_link", counted)
    rows = [r.b for r in simhash.links(distinct, len(values)).collect()]
    assert sum(rows) == len(linked) - 1

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from litquarry.llm import minhash, verified
from litquarry.llm.common import table


def shingles(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} or ({" ".join(words)} if words else set())


def brute(rows):
    """(id, size, least id reachable, kept) of each row, by comparing all pairs."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and root[i] != root[j] and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
            old, new = root[i], root[j]
            root = [new if r == old else r for r in root]
    ids = {r: min((i for (i, _), x in zip(rows, root) if x == r and i is not None), default=None) for r in root}
    return sorted((str(i), len(s), str(ids[r]), i == ids[r]) for (i, _), s, r in zip(rows, sets, root))


def answer(rows):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in rows.collect())


def test_awkward_rows(spark, messy, texts):
    assert answer(minhash.minhash_dedup(messy)) == brute(texts)


def test_nothing(nothing):
    assert minhash.minhash_dedup(nothing).collect() == [] and minhash.keep_one(nothing).collect() == []


def copies(rng, base, n, share):
    for _ in range(n):
        words = base[:]
        for _ in range(int(share * len(words))):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
        yield " ".join(words)


@pytest.mark.parametrize("wide", [verified.WIDE, 2])
def test_groups_of_edited_copies(spark, monkeypatch, wide):
    """Copies with edits around the threshold, chains, small sets and texts of one template."""
    monkeypatch.setattr(verified, "WIDE", wide)
    rng = random.Random(2)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = [t for n, share in ((150, 0.02), (150, 0.03), (400, 0.01), (60, 0.04)) for t in copies(rng, fresh(n), 40, share)]
    chain = fresh(200)
    for k in range(12):
        texts.append(" ".join(chain))
        chain = [*chain[10:], *fresh(10)]
    small = fresh(9)
    texts += [" ".join(small[a:b]) for a in range(3) for b in range(7, 10)]
    template = fresh(200)
    texts += [" ".join([*template, *fresh(40)]) for _ in range(40)]
    texts += [texts[0]] * 30
    rng.shuffle(texts)
    rows = [(None if k % 50 == 7 else k // 2 if k % 11 == 0 else k, t) for k, t in enumerate(texts)]
    assert answer(minhash.minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_the_table_is_brute_force(spark, small):
    docs = table(spark, small, "documents")
    assert answer(minhash.minhash_dedup(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_keep_one_keeps_one_row_of_each_component(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(5, " ".join(base)), (None, " ".join([*base[:-1], "x"])), (5, " ".join(base)), (3, " ".join(["y", *base[1:]])), (9, ""), (8, ""), (7, "other words here")]
    got = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == [3, 7, 8, 9]


def pair(rng, n, shared):
    x = np.unique(rng.integers(0, 1 << 63, 2 * n - shared).astype(np.uint64))
    rng.shuffle(x)
    return x[:n], x[n - shared :]


@pytest.mark.parametrize(("n", "shared"), [(7, 7), (13, 12), (25, 23), (50, 46), (100, 92), (241, 222), (500, 460), (3000, 2757)])
def test_pairs_at_the_threshold_meet(n, shared):
    """Sets at or just above 0.85 meet in a band and pass the estimate, whatever their size."""
    rng = np.random.default_rng(n)
    assert 100 * shared >= 85 * (2 * n - shared)
    for _ in range(300):
        x, y = pair(rng, n, shared)
        regs = minhash.registers(np.concatenate((x, y)), np.array([n, n]))
        keys = minhash.band_keys(regs)
        assert (keys[0] == keys[1]).any()
        assert minhash.estimate(regs[:1], regs[1:], np.array([n]), np.array([n]))[0] >= 0.85 - 5 * (0.85 * 0.15 / 241) ** 0.5


@pytest.mark.parametrize("n", [300, 5000])
def test_the_estimate_is_corrected_for_chance(n):
    """Over many pairs the mean estimate is the similarity, also for sets without a common element."""
    rng = np.random.default_rng(1)
    for shared in (0, n // 3):
        pairs = [pair(rng, n, shared) for _ in range(150)]
        regs = minhash.registers(np.concatenate([s for p in pairs for s in p]), np.full(300, n))
        got = minhash.estimate(regs[::2], regs[1::2], np.full(150, n), np.full(150, n))
        assert abs(got.mean() - shared / (2 * n - shared)) < 0.01


def test_sets_of_a_text_do_not_depend_on_neighbours():
    texts = ["A b c d", "a  b\nC d", "x y", None, " ", "a b", "b c d"]
    hashes, n = minhash.shingle_sets(pa.array(texts))
    assert n.tolist() == [2, 2, 1, 0, 0, 1, 1] and (hashes[:2] == hashes[2:4]).all() and hashes[-1] in hashes[:2]
    regs = minhash.registers(hashes, n)
    assert (regs[0] == regs[1]).all() and not regs[3].any() and (regs[2] == regs[2][0]).all()


def test_a_template_makes_no_pairs(spark, monkeypatch):
    """Texts of one template, each with parts of its own, are told apart without pairs: what is listed grows with their number only."""
    rng = random.Random(3)
    template = [f"t{k}" for k in range(200)]
    rows = [(i, " ".join([*template, *(f"o{rng.randrange(10**9)}" for _ in range(28))])) for i in range(600)]
    listed = []
    real = verified.cut
    monkeypatch.setattr(verified, "cut", lambda df, what="cut": (listed.append((what, out.count())), out)[1] if (out := real(df, what)) is not None and what.endswith("-pairs") else out)
    got = minhash.minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.where("kept").count() == 600
    assert sum(n for _, n in listed) < 3000, listed

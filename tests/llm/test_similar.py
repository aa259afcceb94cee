import itertools
import random
import re

import numpy as np
import pyarrow as pa

import corpus_pipeline
import litquarry.llm.components as comp
from litquarry.llm import simhash, simhash_similar
from litquarry.llm.common import table


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def firsts(rows):
    """The places of the rows that stay, by comparing all pairs."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            old, new = root[i], root[j]
            root = [new if r == old else r for r in root]
    groups = {}
    for i, r in enumerate(root):
        groups.setdefault(r, []).append(i)
    return sorted(min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0)) for g in groups.values())


def test_near_dedup_stage_is_brute_force_jaccard(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    want = {rows[i][0] for i in firsts(rows)}
    got = [r.doc_id for r in corpus_pipeline.distinct_shingles(spark, docs, "").collect()]
    assert sorted(got) == sorted(want) and {643, 1, 709} <= want and not {770, 255, 944} & want


def test_near_dedup_keeps_one_row_of_each_component(spark):
    rng = random.Random(4)
    fresh = lambda: [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows, chain = [(None, ""), (90, " \n"), (91, None)], fresh()
    for k in range(8):  # each is near the next, the ends are far apart
        rows.append((20 - k, " ".join(chain)))
        chain = [*chain[12:], *(f"c{k}-{j}" for j in range(12))]
    for ids in ((5, None), (None, None), (5, 5), (7, 3)):
        words = fresh()
        rows += [(ids[0], " ".join(words)), (ids[1], " ".join([*words[:-3], "other"]))]
    rows += [(i, " ".join(fresh())) for i in (None, None, 5, 3)]
    got = simhash_similar.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = firsts(rows)
    sizes = sorted((str(r.doc_id), len((r.text or "").split()) > 0) for r in got)
    assert sizes == sorted((str(rows[i][0]), len((rows[i][1] or "").split()) > 0) for i in want)
    alone = {t for _, t in rows[-4:]}
    assert alone <= {r.text for r in got}


def test_pairs_at_the_threshold_collide():
    """Of pairs at similarity 0.8 at least 96 % have a fingerprint within the radius, and their sketches pass."""
    rng = np.random.default_rng(8)
    tables, bits = simhash_similar.plan(1000)
    missed = failed = 0
    for _ in range(500):
        x = np.unique(rng.integers(0, 1 << 63, 180).astype(np.uint64))
        sets, n = np.concatenate((x[:-18], x[18:])), np.array([len(x) - 18, len(x) - 18])  # 144 of 180
        one, other = simhash_similar.short_fingerprints(sets, n, tables, bits)
        assert (one >> np.uint64(bits) == np.arange(tables)).all()
        missed += np.bitwise_count(one ^ other).min() > simhash_similar.RADIUS
        one, other = simhash_similar.lanes(sets, n, 1000, simhash_similar.SKETCH)
        p = simhash_similar.bit_differs(0.8)
        failed += np.bitwise_count(one ^ other).sum() > 512 * (p + 3.5 * (p * (1 - p) / 512) ** 0.5)
    assert missed <= 20 and failed <= 3


def test_shingles_do_not_depend_on_neighbours():
    texts = ["A b c d e f", "a  b\nc d E f", "x y", None, " ", "a b c d e"]
    hashes, n = simhash_similar.shingle_sets(pa.array(texts))
    assert n.tolist() == [2, 2, 1, 1, 1, 1] and (hashes[:2] == hashes[2:4]).all() and hashes[5] == hashes[6] and hashes[7] in hashes[:2]


def test_a_template_makes_no_pairs(spark, monkeypatch):
    """Texts of one template, similar at 0.71, collide in their fingerprints; what is listed of them grows with their number only."""
    from litquarry.llm import verified

    listed = {}
    real = verified.cut

    def counting(df, what="cut"):
        out = real(df, what)
        if what.endswith("-pairs"):
            listed[what] = listed.get(what, 0) + out.count()
        return out

    monkeypatch.setattr(verified, "cut", counting)
    for n in (300, 1200):
        rng = random.Random(n)
        template = [f"t{k}" for k in range(200)]
        rows = [(i, " ".join([*template, *(f"o{rng.randrange(10**9)}" for _ in range(40))])) for i in range(n)]
        listed.clear()
        assert simhash_similar.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() == n
        assert sum(listed.values()) < 4 * n, listed


def test_edited_copies_of_one_text(spark):
    """A large group of copies with few to many edits each: the rows that stay are those of all pairs, and far fewer pairs are listed."""
    rng = random.Random(12)
    base = [f"b{k}" for k in range(160)]
    rows = []
    for i in range(250):
        words = base[:]
        for _ in range(rng.randrange(0, 9)):
            k = rng.randrange(len(words))
            words[k : k + rng.randrange(0, 3)] = [f"e{rng.randrange(10**9)}"] * rng.randrange(0, 2)
        rows.append((i, " ".join(words)))
    got = sorted(r.doc_id for r in simhash_similar.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), recall=0.999999).collect())
    assert got == sorted(rows[i][0] for i in firsts(rows))


def test_lengths_follow_the_number_of_texts():
    for n in (1, 10**6, 10**9, 2**40, 2**50):
        tables, bits = simhash_similar.plan(n)
        assert tables <= 1 << simhash_similar.TABLE_BITS and bits + simhash_similar.TABLE_BITS <= 64
        assert bits >= min(n, 2**40).bit_length() + simhash_similar.SPARE_BITS


def test_documents_with_ids_of_their_own_are_not_copied(spark, monkeypatch):
    """All documents were written once more for the numbers of their rows, near the size of the input."""
    written = []
    real = simhash_similar.cut
    monkeypatch.setattr(simhash_similar, "cut", lambda df, what: written.append((what, df.columns)) or real(df, what))
    words = [f"w{i}" for i in range(60)]
    rows = [(7, " ".join(words)), (3, " ".join(words + ["more"])), (5, "something else")]
    assert sorted(r.doc_id for r in simhash_similar.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [3, 5]
    assert written and not [w for w in written if "text" in w[1]]
    rows = [(7, rows[0][1]), (7, rows[1][1]), (None, "something else")]
    assert sorted((r.doc_id is None, r.doc_id) for r in simhash_similar.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [(False, 7), (True, None)]


def test_few_wide_gaps_do_not_widen_all():
    gaps = np.array([5, 255, 254, 70000, 0, 65535, 65534, 1 << 40] + [300] * 1000, np.uint64)
    width, low, wide = simhash._short(gaps)
    assert width == 2 and len(low) == 2 * len(gaps) and len(wide) == 8 * 3
    assert simhash._long(width, np.frombuffer(low, np.uint8), np.frombuffer(wide, np.uint64)).tolist() == gaps.tolist()
    assert simhash._short(gaps[:0]) == (1, b"", b"")


def test_a_star_step_does_not_join_a_nodes_own_edge(spark, monkeypatch):
    """The edge to the least neighbour came out of a join of all edges, once for each of them."""
    plans = []
    real = comp.cut
    monkeypatch.setattr(comp, "cut", lambda df, what: plans.append((what, df._jdf.queryExecution().optimizedPlan().toString().count("Join "))) or real(df, what))
    edges = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(100, 200), (200, 50)], "a long, b long")
    roots = {r.node: r.root for r in comp.components(edges).collect()}
    assert roots == {k: 0 for k in range(31)} | {50: 50, 100: 50, 200: 50}
    assert max(n for what, n in plans if what == "edges") == 1


def test_settled_nodes_are_joined_once(spark, monkeypatch):
    """Forests of two groups that agree but for a few nodes: each round joined the edges of all nodes again, also of those with one hub."""
    written = []
    real = comp.cut

    def counting(df, what):
        out = real(df, what)
        written.append((what, out.count()))
        return out

    monkeypatch.setattr(comp, "cut", counting)
    edges = [(k, k % 20) for k in range(20, 3000)] + [(100 + k, k + 1) for k in range(5)] + [(5000 + k, 5000 + k // 2) for k in range(1, 8)]
    roots = {r.node: r.root for r in comp.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    # 100 + k has the hub k, and so leads to k + 1 as well
    assert roots == {k: 0 if k % 20 < 6 else k % 20 for k in range(3000)} | {5000 + k: 5000 for k in range(8)}
    joined = [n for what, n in written if what in ("edges", "large")][1:]
    assert sum(joined) < 100, written
    assert sum(n for what, n in written if what == "leaves") < 3100, written

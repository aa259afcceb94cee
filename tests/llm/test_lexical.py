import heapq
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from litquarry.llm import lexical_search
from litquarry.llm.common import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n, volume = sum(k > 0 for *_, k in held), sum(k for *_, k in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, k in held:
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * k * n // volume))) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(str(item), rank, str(i), -s) for rank, (s, _, i) in enumerate(heapq.nsmallest(top, found, key=lambda x: (x[0], x[1], x[2] or 0)), 1)]
    return sorted(out)


def answer(rows):
    return sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in rows.collect())


ITEMS = [(1, "Short ünïcode words, ab ab!"), (2, None), (3, " ... "), (None, "x text TEXT"), (4, "nowhere to be found zzzz"), (1, "short text"), (5, "w" * 300)]


def test_awkward_rows(spark, messy, texts):
    bench = spark.createDataFrame([(i, t, 0, 0) for i, t in ITEMS], "item_id long, text string, score int, rank int")
    got = lexical_search.search(messy, bench)
    assert answer(got) == brute(texts, ITEMS) and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_nothing(spark, messy, nothing):
    bench = spark.createDataFrame([(1, "text")], "item_id long, text string")
    assert lexical_search.search(nothing, bench).collect() == []
    assert lexical_search.search(messy, bench.limit(0)).collect() == []


@pytest.mark.parametrize("slice_bytes", [4 << 20, 3000])
def test_the_table_is_brute_force(spark, small, slice_bytes, monkeypatch):
    monkeypatch.setattr(lexical_search, "RANGE", 37)
    monkeypatch.setattr(lexical_search, "ENTRIES", 5000)
    docs, bench = table(spark, small, "documents"), table(spark, small, "benchmark")
    got = lexical_search.search(docs.repartition(5), bench, slice_bytes=slice_bytes)
    assert answer(got) == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])


def test_ties_go_by_id_over_all_tasks(spark):
    rng = random.Random(1)
    rows = [(i, "same words here" if i % 3 else "same " * rng.randint(1, 4)) for i in range(900)]
    rng.shuffle(rows)
    rows += [(None, "same words here"), (1, "same words here"), *((10_000 + i, "other") for i in range(700))]
    items = [(7, "same words"), (8, "words same same")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string")
    assert answer(lexical_search.search(docs, bench)) == brute(rows, items)
    assert answer(lexical_search.search(docs, bench, top=3)) == brute(rows, items, 3)


def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(4)
    for kind in (np.uint32, np.uint64):
        for most in (1, 50, 1 << 20, np.iinfo(kind).max):
            keys = rng.integers(0, most, 5000, dtype=kind)
            assert (lexical_search.radix_order(keys) == np.argsort(keys, kind="stable")).all()
    assert len(lexical_search.radix_order(np.zeros(0, np.uint64))) == 0

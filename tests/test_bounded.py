"""Operators whose tasks must stay bounded: many titles of one prefix, hubs, deep searches, many queries."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from litquarry.operators import discovery, gaps, graph, matching
from litquarry.sources.landing import numbered


def test_many_titles_of_one_prefix(spark):
    rng = random.Random(1)
    titles = [f"The Great Survey of {k}" for k in range(10_000)] + ["the great survey of 12", " THE GREAT SURVEY OF 99 ", "", "  ", "ab", "é"]
    names = [(k, f"Cited as: the great survey of {rng.randrange(20_000)}, part {k}" if k % 3 else "É ab") for k in range(3000)]
    names += [(None, "the great survey of 7777"), (5, None), (0, "x")]
    got = matching.first_match(spark.createDataFrame(names, "ord long, name string"), spark.createDataFrame([(t,) for t in titles], "title string"), slice_bytes=40_000)
    plan = got._jdf.queryExecution().toString()
    assert "Generate" not in plan
    want = {}
    held = sorted((o, n) for o, n in names if o is not None and n is not None)
    for t in titles:
        if t.strip():
            want |= {t: next((n for _, n in held if t.strip().lower() in n.lower()), None)}
    assert {r.title: r.name for r in got.collect()} == {t: n for t, n in want.items() if n}


def test_no_titles_and_no_names(spark):
    some = spark.createDataFrame([(1, "a")], "ord long, name string")
    assert matching.first_match(some, spark.createDataFrame([], "title string")).collect() == []
    assert matching.first_match(some.limit(0), spark.createDataFrame([("a",)], "title string")).collect() == []


def shared(rows):
    by = {}
    for src, norm in set(rows):
        by.setdefault(src, set()).add(norm)
    return Counter(p for c in by.values() for p in itertools.permutations(c, 2))


def test_neighbors_of_a_hub(spark):
    rng = random.Random(2)
    rows = [("hub", f"c{k}") for k in range(300)] + [("hub2", f"c{k}") for k in range(100, 160)] + [(f"p{k}", f"c{rng.randrange(400)}") for k in range(200) for _ in range(4)]
    rows += rows[:50] + [("p1", None), (None, "c1")]
    got = gaps.neighbors(spark.createDataFrame(rows, "src string, norm string"), side=16).collect()
    counts, want = shared([r for r in rows if None not in r]), set()
    for norm in {a for a, _ in counts}:
        best = sorted(((-n, b) for (a, b), n in counts.items() if a == norm))[:5]
        want |= {(norm, b, -n, k) for k, (n, b) in enumerate(best, 1)}
    assert {(r.norm, r.neighbor, r.shared, r["rank"]) for r in got} == want and len(got) == len(want)


def test_a_large_hub_is_cut_into_cells(spark):
    """A paper of 5,000 concepts: no row holds more than about side x side pairs, and together they hold each pair once."""
    own = spark.range(5000).select(F.lit("hub").alias("src"), F.format_string("c%05d", "id").alias("norm"))
    cells = gaps._cells(own.unionByName(spark.createDataFrame([("p", "x"), ("p", "y")], "src string, norm string")), 128)
    size = F.when(F.col("_lo").isNull() | (F.col("_lo") == F.col("_hi")), F.size("a") * (F.size("a") - 1) / 2).otherwise(F.size("a") * F.size("b"))
    most, total, n = cells.agg(F.max(size), F.sum(size), F.count(F.lit(1))).first()
    assert total == 5000 * 4999 / 2 + 1 and most < 4 * 128**2 and n == 40 * 41 / 2 + 1


def test_reach_goes_deep_and_ends(spark):
    chain = [(f"n{k}", f"n{k + 1}", f"{k}") for k in range(30)] + [("n3", "n0", "x"), ("n5", "n1", "y"), ("a", "b", "z")]
    edges = spark.createDataFrame(chain, "src string, dst string, ord string")
    seeds = spark.createDataFrame([("n0",), ("n0",)], "id string")
    got = {r.id: r.hop for r in graph.reach(edges, seeds, 8).collect()}
    assert got == {f"n{k}": k for k in range(9)}
    short = spark.createDataFrame([("b",)], "id string")
    assert [(r.id, r.hop) for r in graph.reach(edges, short, 500).collect()] == [("b", 0)]
    assert graph.reach(edges, seeds.limit(0), 3).collect() == []
    plan = graph.reach(edges, seeds, 8)._jdf.queryExecution().toString()
    assert "Join" not in plan


def capped(rows, queries, cap):
    kept, out = set(), []
    for q in queries:
        mine, seen = [], set()
        for _, p in sorted((o, p) for p, x, o in rows if x == q):
            if p not in seen and p not in kept and len(mine) < cap:
                mine.append(p)
            seen.add(p)
        kept |= set(mine)
        out += [(p, q) for p in mine]
    return sorted(out)


@pytest.mark.parametrize("fold_rows", [discovery.FOLD_ROWS, 1])
def test_exclusion_with_a_cap(spark, fold_rows):
    rng = random.Random(3)
    rows = [(f"p{rng.randrange(60)}", rng.randrange(6), rng.randrange(40)) for _ in range(700)]
    hits = spark.createDataFrame(rows, "paper_id string, query int, ord int")
    for queries, cap in (([4, 0, 2, 5], 7), ([1], 3), ([0, 1, 2, 3, 4, 5], 25)):
        got = discovery.running_exclusion_capped(hits, queries, cap, fold_rows=fold_rows)
        assert sorted((r.paper_id, r["query"]) for r in got.collect()) == capped(rows, queries, cap)
    assert discovery.running_exclusion_capped(hits, [], 5).collect() == [] == discovery.running_exclusion_capped(hits, [1], 0).collect()


def test_the_plan_of_an_exclusion_does_not_grow(spark):
    hits = spark.range(5000).selectExpr("concat('p', id % 900) as paper_id", "cast(id % 50 as int) as query", "id as ord")
    size = lambda n: len(discovery.running_exclusion_capped(hits, list(range(n)), 10)._jdf.queryExecution().executedPlan().toString().splitlines())
    assert size(50) == size(2)
    got = discovery.running_exclusion_capped(hits, list(range(50)), 10).collect()
    assert sorted((r.paper_id, r["query"]) for r in got) == capped([(r.paper_id, r["query"], r.ord) for r in hits.collect()], range(50), 10)


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_numbers_by_ranges(spark, n):
    rng = random.Random(7)
    rows = [(rng.randrange(40), f"k{i}") for i in range(n)]
    got = numbered(spark.createDataFrame(rows, "a int, k string").repartition(5), ["a", "k"]).collect()
    assert [(r.a, r.k) for r in sorted(got, key=lambda r: r.nth)] == sorted(rows) and sorted(r.nth for r in got) == list(range(n))

import re

import corpus_pipeline
from litquarry.llm import decontaminate
from litquarry.llm.common import table


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_pipeline_is_brute_force(spark, small):
    """The tokens of each document that plain Python keeps, stage by stage."""
    docs = {r.doc_id: r.text for r in table(spark, small, "documents").collect()}
    items = [decontaminate.normalised(r.text.encode()) for r in table(spark, small, "benchmark").collect() if r.text]
    kept = {i: t for i, t in docs.items() if t and any(c.isalpha() for c in t)}
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[i]), i)
    kept = {i: kept[i] for i in first.values()}
    sets, left, out = {i: shingles(t) for i, t in kept.items()}, set(kept), set()
    while left:
        start = min(left)
        group, todo = {start}, [start]
        while todo:
            x = todo.pop()
            near = {j for j in left - group if len(sets[j] & sets[x]) >= 0.8 * len(sets[j] | sets[x])}
            group |= near
            todo += near
        left -= group
        out.add(start)
    lines = {i: decontaminate.normalised(kept[i].encode()) for i in out}
    clean = {i: x for i, x in lines.items() if not any(decontaminate.edit_distance_within(p, x, int(0.2 * len(p))) for p in items)}
    want = {i: len(x.split()) for i, x in clean.items() if x}
    got = {r.doc_id: r.n for r in corpus_pipeline.run(spark, small).groupBy("doc_id").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "n").collect()}
    assert got == want

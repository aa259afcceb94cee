import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from litquarry.llm import decontaminate, language_id, packing, queries
from litquarry.llm import kernels as K
from litquarry.llm.common import table


def check_bins(rows, sizes):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for held in bins.values():
        used = sum(r.n_tokens for r in held)
        assert {(r.bin_size, r.bin_used) for r in held} == {(min(s for s in sizes if s >= used), used)}
        at = 0
        for r in sorted(held, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_tokens
    return bins


def test_packing_loses_nothing(spark, messy, texts):
    sizes = (16, 64, 256)
    rows = packing.pack_documents(messy, sizes=sizes, group=50).collect()
    check_bins(rows, sizes)
    want, got = defaultdict(int), defaultdict(int)
    for i, t in texts:
        want[i] += len([w for w in (t or "").replace("\x0b", " ").encode().split()])
    for r in rows:
        got[r.doc_id] += r.n_tokens
    assert dict(got) == {i: n for i, n in want.items() if n}
    pieces = sorted((r.piece, r.start_token, r.n_tokens) for r in rows if r.doc_id == 11)
    assert [s for _, s, _ in pieces] == list(range(0, 20_000, 256)) and sum(n for *_, n in pieces) == 20_000


def test_packing_uses_room(spark):
    rng = random.Random(1)
    sizes = (512, 1024, 2048)
    lengths = sorted((rng.randint(1, 2048) for _ in range(3000)), reverse=True)
    _, _, bins = packing.pack(lengths, sizes)
    assert sum(lengths) / sum(bins) > 0.97
    assert packing.pack([], sizes) == ([], [], [])
    assert packing.pack([600], sizes)[2] == [1024] and packing.pack([512, 512], sizes)[2] == [512, 512]


def test_best_fit_takes_the_tightest_bin():
    bin_of, offset, bins = packing.pack([90, 70, 30, 10], (100,))
    assert bin_of == [0, 1, 1, 0] and offset == [0, 0, 70, 90] and bins == [100, 100]


def cheapest(lengths, sizes):
    """The least total cost of any way to lay the pieces into bins."""
    best = float("inf")

    def lay(rest, bins, price):
        nonlocal best
        if not rest:
            best = min(best, sum(packing.cost(min(s for s in sizes if s >= b)) for b in bins))
            return
        for k in range(len(bins)):
            if bins[k] + rest[0] <= max(sizes):
                lay(rest[1:], [*bins[:k], bins[k] + rest[0], *bins[k + 1 :]], price)
        lay(rest[1:], [*bins, rest[0]], price)

    lay(lengths, [], 0)
    return best


def test_packing_is_near_the_cheapest():
    rng, sizes, over = random.Random(3), (512, 1024, 2048), []
    for _ in range(150):
        lengths = sorted((rng.choice([rng.randint(1, 2048), rng.randint(1, 600)]) for _ in range(rng.randint(1, 7))), reverse=True)
        got = packing.total_cost(packing.pack(lengths, sizes)[2])
        over.append(got / cheapest(lengths, sizes))
        assert over[-1] >= 1 - 1e-9
    assert max(over) < 1.35 and sum(over) / len(over) < 1.03


@pytest.mark.parametrize("shape", ["uniform", "lognormal", "half"])
def test_several_lengths_are_cheaper_than_one(shape):
    rng, sizes = np.random.default_rng(5), (512, 1024, 2048, 4096)
    draw = {"uniform": lambda: rng.integers(1, 4096, 3000), "lognormal": lambda: np.clip(rng.lognormal(6, 1, 3000), 1, 4096).astype(int), "half": lambda: rng.integers(513, 700, 600)}
    lengths = sorted(draw[shape]().tolist(), reverse=True)
    joint = packing.total_cost(packing.pack(lengths, sizes)[2])
    for s in sizes:
        if s >= lengths[0]:
            _, _, bins = packing._pack(lengths, (s,), sizes, packing.SQUARE_FROM)
            assert joint <= packing.total_cost(bins) + 1e-6
    if shape == "half":  # no two of them fit into the smallest length that holds one
        _, _, smallest = packing._pack(lengths, (1024,), sizes, packing.SQUARE_FROM)
        assert joint < 0.9 * packing.total_cost(smallest)


def test_packing_of_nothing(nothing):
    assert packing.pack_documents(nothing).collect() == []


def test_language_is_held_out_accurate(spark, small):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_texts(spark, messy, nothing):
    docs = messy.withColumn("text", F.when(F.col("doc_id") == 8, "123 !? 45").otherwise(F.col("text")))
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    for i in (3, 4, 5, 8):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert {r.lang_pred for r in got.values()} <= {"en", "de", "und"} and got[None].held_out
    assert language_id.identify(nothing).collect() == []
    unlabelled = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and {3, 4, 5, 8}.isdisjoint({r.doc_id for r in kept.collect()})


def test_one_language_is_enough(spark):
    docs = spark.createDataFrame([(i, "some words here", "xx") for i in range(20)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language_id.identify(docs).collect()} == {"xx"}


def test_decoding_is_plain_weighted_loss(spark):
    """Each bit's margin and the loss of each codeword, as plain sums over the runs of a text."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").limit(300)
    model = language_id.train(docs)
    for text in [r.text for r in docs.limit(12).collect() if r.text][:6]:
        raw = bytes(language_id._PLAIN[c] for c in text.encode())
        bits, runs = np.zeros(model.code.shape[1]), 0
        for n in language_id.RUNS:
            for k in range(len(raw) - n + 1):
                value = K.mix(np.array([int.from_bytes(raw[k : k + n], "little")], np.uint64), n)[0]
                bits += model.weights[int(value) >> 64 - language_id.FEATURE_BITS]
                runs += 1
        margins = bits / runs
        losses = [sum(t * math.log1p(math.exp(-language_id.STEEP * m * c)) for t, m, c in zip(model.trust, margins, word)) for word in model.code]
        data, offsets = K.joined(pa.array([text]))
        assert np.allclose(language_id._losses(model, language_id._margins(model, data, offsets))[0], losses, rtol=1e-3)
        said = language_id.predict(spark.createDataFrame([(text,)], "text string"), model)[0].first()
        assert said[1] == model.languages[int(np.argmin(losses))]


def test_many_labels(spark):
    rng = random.Random(8)
    words = {f"l{k:02d}": ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(12)] for k in range(40)}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(30)), x) for i, x in enumerate(sorted(words) * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].lang_pred == rows[i][2] for i in held) / len(held) > 0.95
    many = spark.createDataFrame([(i, "some text", str(i)) for i in range(language_id.MOST_LANGUAGES * 2)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        language_id.train(many)


def test_the_sample_is_bounded(spark):
    docs = spark.range(40_000).selectExpr("id as doc_id", "'word' as text", "if(id % 4 = 0, 'a', 'b') as lang")
    n = dict(language_id._sample(docs, "doc_id", "text", "lang", 200).groupBy("lang").count().collect())
    assert all(120 < k < 300 for k in n.values()) and set(n) == {"a", "b"}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 7, 30])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert len(np.unique(code, axis=0)) == n


def distance(item, text):
    """Least edit distance of the item to any part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_edit_distance_is_the_full_table():
    rng = random.Random(9)
    for _ in range(300):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        text = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 30)))
        want, most = distance(item, text), rng.randint(0, 12)
        got = decontaminate.edit_distance_within(item, text, most)
        assert (got[0] if got else None) == (want if want <= most else None)


def edited(item, share, rng):
    out = list(item)
    for _ in range(int(share * len(out))):
        k = rng.randrange(len(out))
        what = rng.randrange(3)
        out[k : k + 1] = [] if what == 0 else [rng.choice("abcdefgh ")] if what == 1 else [out[k], rng.choice("abcdefgh")]
    return "".join(out)


def test_decontamination_recall_and_precision(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").collect()
    bench = [(r.item_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "benchmark").collect()]
    items = decontaminate.index(bench)
    rng = random.Random(6)
    clean = [r.text for r in docs if r.text and not any(decontaminate.normalised(t.encode()) in decontaminate.normalised(r.text.encode()) for _, t in bench)][:80]
    for share, least in ((0.0, 1.0), (0.05, 0.99), (0.12, 0.97), (0.16, 0.95), (0.2, 0.9)):
        texts, want = [], []
        for k, (i, t) in enumerate(bench):
            host = clean[k % len(clean)].split()
            cut = rng.randrange(len(host) + 1)
            texts.append(" ".join([*host[:cut], edited(t, share, rng), *host[cut:]]).upper() if k % 2 else " ".join([*host[:cut], edited(t, share, rng), *host[cut:]]))
            line = items.lines[items.ids.index(i)]
            if decontaminate.edit_distance_within(line, decontaminate.normalised(texts[k].encode()), int(0.2 * len(line))):
                want.append(k)
        hits = decontaminate.search(pa.array(texts), items)
        found = {t for t, i, *_ in hits if items.ids[i] == bench[t][0]}
        assert found <= set(want) and len(found) / len(want) >= least, share
        for t, i, d, _ in hits:
            line, text = items.lines[i], decontaminate.normalised(texts[t].encode())
            assert d <= 0.2 * len(line) and (d > 0 or line in text)
    false = decontaminate.search(pa.array(clean), items)
    assert all(distance(items.lines[i], decontaminate.normalised(clean[t].encode())) <= items.most[i] for t, i, *_ in false)


def test_decontamination_is_all_pairs(spark):
    """Every document against every item of sf0.001; a pair goes unread only if its counts of three letters rule it out."""
    docs = [(r.doc_id, decontaminate.normalised((r.text or "").encode())) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    bench = [(r.item_id, decontaminate.normalised(r.text.encode())) for r in table(spark, "/root/testdata/sf0.001", "benchmark").collect()]
    runs = lambda x: Counter(x[k : k + 3] for k in range(len(x) - 2))
    want, counts = set(), {i: runs(t) for i, t in docs}
    for j, item in bench:
        most, own = int(0.2 * len(item)), runs(item)
        for i, line in docs:
            if (own & counts[i]).total() >= len(item) - 2 - 3 * most and (got := decontaminate.edit_distance_within(item, line, most)):
                want.add((i, j, got[0]))
    rows = decontaminate.contaminated(table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "benchmark")).collect()
    got = {(r.doc_id, r.item_id, r.edit_distance) for r in rows}
    assert len(want) >= 3 and got == want


@pytest.mark.parametrize("n", [1, 20, 64, 65, 150])
def test_many_edit_distances_are_single_ones(n):
    rng = random.Random(n)
    lines = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, n))) for _ in range(6)]
    strings = [bytes(rng.choice(b"abcd") for _ in range(rng.choice([0, 1, 40, 200]))) for _ in range(60)] + lines
    item, size = np.array([rng.randrange(6) for _ in strings]), np.array([len(x) for x in strings])
    least, end = decontaminate.edit_distances(lines, item, np.frombuffer(b"".join(strings), np.uint8), np.cumsum(size) - size, size)
    for k, x in enumerate(strings):
        assert (least[k], end[k]) == decontaminate.edit_distance_within(lines[item[k]], x, 10**6)


def test_common_anchors_are_taken_in_parts(monkeypatch):
    rng = random.Random(5)
    common = "a phrase that very many items share "
    bench = [(k, common + "".join(rng.choice("abcdefghij ") for _ in range(60))) for k in range(60)]
    texts = [bench[k][1] + common * 3 for k in range(0, 60, 7)] + [common * 20, " ".join(t for _, t in bench)]
    items = decontaminate.index(bench)
    want = sorted(decontaminate.search(pa.array(texts), items))
    monkeypatch.setattr(decontaminate, "HITS", 100)
    assert sorted(decontaminate.search(pa.array(texts), items)) == want and {i for t, i, *_ in want if t == len(texts) - 1} == set(range(60))


def test_an_item_within_a_very_long_text(spark, nothing):
    item = "the quick brown fox considers a rather unusual proposal from the hen"
    long = "filler words of no importance " * 60_000
    docs = spark.createDataFrame([(1, long + item + long, "x"), (2, long, "y")], "doc_id long, Text string, item_id string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.edit_distance) for r in decontaminate.contaminated(docs, bench).collect()] == [(1, 9, 0)]
    assert [r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()] == [2]
    assert language_id.keep_identified(docs.withColumn("lang", F.lit("en"))).columns == ["doc_id", "Text", "item_id", "lang"]


def test_decontamination_of_awkward_tables(spark, messy, nothing, passage):
    bench = spark.createDataFrame([(1, passage[:200]), (2, None), (3, " "), (1, passage[:200]), (4, "zz yy"), (5, "of it")], "item_id long, text string")
    rows = decontaminate.contaminated(messy, bench).collect()
    assert {1, 2, 6, 7, 15, None} <= {r.doc_id for r in rows if r.item_id == 1} and not {3, 4, 5, 8, 11} & {r.doc_id for r in rows if r.item_id == 1}
    sliced = decontaminate.contaminated(messy, bench, slice_bytes=150).collect()
    assert sorted(map(str, sliced)) == sorted(map(str, rows))
    assert decontaminate.contaminated(nothing, bench).collect() == []
    assert decontaminate.contaminated(messy, bench.limit(0)).collect() == []
    kept = decontaminate.keep_clean(messy, bench)
    assert kept.columns == messy.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in messy.collect()} - {r.doc_id for r in rows}


def test_pipeline_runs_its_stages(spark, small):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_dedup", "decontamination", "best_fit_packing"]
    docs = table(spark, small, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert len(rows) <= before
        docs, before = spark.createDataFrame(rows, docs.schema), len(rows)
    packed = corpus_pipeline.run(spark, small)
    ids = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert ids == {r.doc_id for r in docs.collect()}
    check_bins(packed.collect(), packing.SIZES)


def test_pipeline_of_messy_and_empty_tables(spark, messy, nothing, passage, tmp_path):
    bench = spark.createDataFrame([(1, passage[:200]), (2, None)], "item_id long, text string")
    for name, docs in (("messy", messy), ("empty", nothing)):
        docs.write.parquet(f"file://{tmp_path}/{name}/documents.parquet")
        bench.write.parquet(f"file://{tmp_path}/{name}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, f"file://{tmp_path}/messy").collect()
    assert {r.doc_id for r in rows} == {8, 10, 11, 12, 13, 14, 17, 18}
    check_bins(rows, packing.SIZES)
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/empty").collect() == []


@pytest.mark.parametrize("item", ["the cat sat on the mat and the dog ran to the big red hut by the sea", "3 + 4 * 2 = 11 , 5 - 2 = 3 , 9 / 3 = 3 , 1 + 1 = 2 , 8 - 6 = 2"])
@pytest.mark.parametrize("others", [[], ["a distinctive companion of considerable extent", "another considerable companion"]])
def test_decontamination_finds_long_items_of_short_words(item, others):
    items = decontaminate.index(list(enumerate([item, *others])))
    texts = ["Something unrelated stands before it. " + item.upper() + " and after", "unrelated " + item[:30] + "x" + item[30:], "nothing of the kind here"]
    assert {(t, items.ids[i], d) for t, i, d, _ in decontaminate.search(pa.array(texts), items)} == {(0, 0, 0), (1, 0, 1)}


def test_decontamination_needs_no_spaces():
    rng = random.Random(7)
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 2000)]
    unspaced = lambda n: "".join(rng.choice(han) for _ in range(n))
    bench = [(k, unspaced(60)) for k in range(100)]
    items = decontaminate.index(bench)
    for form in (lambda x: unspaced(40) + x + unspaced(40), lambda x: f"({x}), ", lambda x: x[:20] + "\u53e3" + x[21:]):
        hits = decontaminate.search(pa.array([None, "", *(form(x) for _, x in bench)]), items)
        assert sorted((t - 2, items.ids[i]) for t, i, *_ in hits) == [(k, k) for k in range(100)]


def test_decontamination_at_the_whole_threshold(spark):
    rng = random.Random(6)
    bench = [(r.item_id, r.text) for r in table(spark, "/root/testdata/sf0.1", "benchmark").collect() if r.text]
    items = decontaminate.index(bench)
    line = dict(zip(items.ids, items.lines))
    texts = ["some words before it " + edited(t, 0.2, rng) + " and some after" for _, t in bench]
    within = {k for k, (i, _) in enumerate(bench) if decontaminate.edit_distance_within(line[i], decontaminate.normalised(texts[k].encode()), int(0.2 * len(line[i])))}
    found = {t for t, i, *_ in decontaminate.search(pa.array(texts), items) if items.ids[i] == bench[t][0]}
    assert found <= within and len(within - found) <= 0.05 * len(within)

import base64
import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest

from litquarry.llm import alignment
from litquarry.llm.common import table

BYTE, PIECE = f"{alignment.FOLDER}/{alignment.BYTE_FILE}", f"{alignment.FOLDER}/{alignment.PIECE_FILE}"


@pytest.fixture(scope="module")
def libraries():
    """Both tokenizers as their own libraries apply them, with the bytes of each token written down anew."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(BYTE)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    shown = {ByteLevel(add_prefix_space=False).pre_tokenize_str(bytes([b]).decode())[0][0]: b for b in range(128)}

    def side_a(text):
        encoding = tokenizer.encode(" " + text, add_special_tokens=False)
        spans, raw = encoding.ids, []
        for token in encoding.tokens:
            raw.append(bytes(shown[c] if c in shown else alignment.byte_alphabet()[c] for c in token))
        return spans, raw

    def side_b(text):
        ids = model.encode(text)
        names = [model.id_to_piece(i) for i in ids]
        return ids, [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(ids, names)]

    return side_a, side_b


def groups(text, side_a, side_b):
    """The groups of a text by two pointers over the ends of its tokens."""
    if not text:
        return []
    (ids_a, raw_a), (ids_b, raw_b) = side_a(text), side_b(text)
    if b"".join(raw_a) != b" " + text.encode() or b"".join(raw_b) != b" " + text.encode():
        return []
    out, i, j, at_a, at_b = [([], [])], 0, 0, 0, 0
    while i < len(ids_a) or j < len(ids_b):
        if at_a <= at_b and i < len(ids_a):
            out[-1][0].append(ids_a[i])
            at_a += len(raw_a[i])
            i += 1
        else:
            out[-1][1].append(ids_b[j])
            at_b += len(raw_b[j])
            j += 1
        if at_a == at_b:
            out.append(([], []))
    return out[:-1]


def brute(rows, side_a, side_b):
    found = [(i, groups(t, side_a, side_b)) for i, t in rows]
    links = [Counter((a, b) for xs, ys in g for a in xs for b in ys) for _, g in found]
    count = Counter(p for c in links for p in c)
    most_a, most_b = Counter(), Counter()
    for (a, b), n in count.items():
        most_a[a], most_b[b] = max(most_a[a], n), max(most_b[b], n)
    out = []
    for (i, g), c in zip(found, links):
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        best = [sum(n for p, n in c.items() if count[p] == most[p[k]]) for k, most in enumerate((most_a, most_b))]
        out.append((str(i), sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()), *best, sum(n * count[p] for p, n in c.items()), hashlib.sha256(line.encode()).hexdigest() if g else ""))
    return sorted(out), count


def answer(rows):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.n_best_b, r.count_sum, r.groups_sha256) for r in rows.collect())


ODD = ["<|endoftext|> and <s> </s> <unk>", "a▁b", "<0x41>", " leading", "trailing  ", "\n\n\t x", "é é ﬁ ½ ①", "日本語のテキスト。混ぜた text", "🙂🙃 👩‍👩‍👧", "​ 　", "\x00\x01", "don't WE'LL I've", "1234567 89", "=" * 3000, " " * 500, "ab" * 4000, "éè" * 700, "�", "ا" * 50]


@pytest.mark.parametrize("group_bytes", [alignment.GROUP_BYTES, 2000])
def test_awkward_rows(spark, messy, texts, libraries, group_bytes):
    rows = texts + [(100 + k, t) for k, t in enumerate(ODD)]
    more = spark.createDataFrame([(100 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    docs = messy.unionByName(more, allowMissingColumns=True)
    assert answer(alignment.align_documents(docs, group_bytes=group_bytes)) == brute(rows, *libraries)[0]


def test_the_table_is_two_pointers(spark, small, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "MANY_LINKS", 3)
    docs = table(spark, small, "documents").repartition(3)
    want, count = brute([(r.doc_id, r.text) for r in docs.collect()], *libraries)
    assert answer(alignment.align_documents(docs, group_bytes=50_000)) == want
    pairs = alignment.pair_counts(docs, group_bytes=50_000).collect()
    assert {(r.a_id, r.b_id): r["count"] for r in pairs} == dict(count)
    assert all(r.a_most == max(n for (a, _), n in count.items() if a == r.a_id) for r in pairs[:50])
    assert all(r.b_most == max(n for (_, b), n in count.items() if b == r.b_id) for r in pairs[:50])


def test_nothing(nothing):
    assert alignment.align_documents(nothing).collect() == [] and alignment.pair_counts(nothing).collect() == []


def test_the_fast_engine_gives_the_library_s_tokens(small):
    """The byte-level vocabulary's tokens are those of the library that the file is made for, also where merges meet odd characters."""
    import duckdb

    side, library = alignment.byte_level(BYTE), alignment._by_library(BYTE)
    rng = random.Random(7)
    marks = "aZ09 \n\t'’.,- ́　é漢🙂١²ⅷ_#"
    texts = ODD + ["".join(rng.choice(marks) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += [r[0] for r in duckdb.sql(f"select text from '{small}/documents.parquet'").fetchall() if r[0]]
    assert side.encode(texts) == library(texts)


def test_tokens_are_those_of_the_rank_file():
    ranks = dict((int(n), base64.b64decode(t)) for t, n in (line.split() for line in open(f"{alignment.FOLDER}/byte_bpe_50k.tiktoken", "rb")))
    tokens = alignment.byte_level(BYTE).tokens
    assert tokens == [ranks[i] for i in range(len(ranks))]


def test_merges_out_of_order_go_through_the_library(tmp_path):
    whole = json.load(open(BYTE))
    whole["model"]["merges"] = whole["model"]["merges"][1:] + whole["model"]["merges"][:1]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(whole))
    texts = ["the theme of another thing", "in inner"]
    assert alignment.byte_level(str(path)).encode(texts) == alignment._by_library(str(path))(texts)


def test_packed_numbers():
    for values in ([], [0, 255], [256], [70_000], [1 << 40]):
        assert alignment._unpacked(alignment._packed(np.array(values, np.int64))).tolist() == values

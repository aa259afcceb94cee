import random

import pytest

KINDS = "doc_id long, text string, lang string, source string, n_chars long, grp string, bucket string, row string, norm string, key string, _letter string"


@pytest.fixture(scope="session")
def passage():
    rng = random.Random(3)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(90))


@pytest.fixture(scope="session")
def texts(passage):
    """Ids and texts with every awkward case: nulls, blanks, copies, near copies, shared passages, a very long text, odd spaces."""
    rng = random.Random(5)
    words = passage.split()
    rows = [(1, passage), (2, "Before it. " + passage + " and after"), (3, None), (4, ""), (5, " \t\n"), (6, passage), (7, passage.replace(" ", "\n", 3)), (8, "short text"), (9, "Short  text"), (10, " ".join(words[20:80]))]
    rows += [(11, " ".join(rng.choice(words) for _ in range(20_000))), (12, "\u00a0ünïcode\u2003wörds " * 30), (13, "x" * 5000), (14, "ab " * 400), (14, "ab " * 400), (15, passage[:-1] + "!"), (16, "ab " * 380), (None, passage + " null id"), (17, "".join(map(chr, range(1, 200))) * 3), (18, words[0])]
    return rows


@pytest.fixture(scope="session")
def messy(spark, texts):
    """The texts with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, ["en", "de", None][k % 3], "s", len(t or ""), "g", "b", "r", "n", "k", "l") for k, (i, t) in enumerate(texts)], KINDS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], KINDS)

"""Snapshots with a commit of their own, and the small rules beside them."""

import datetime
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from litquarry.functions import config, text
from litquarry.functions import json as jsonx
from litquarry.operators import outline, quality
from litquarry.sources import snapshots


def test_versions_follow_each_other(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    assert snapshots.version(path) is None and snapshots.load(spark, path, "k long").collect() == []
    rows = spark.range(10).select(F.col("id").alias("k"), F.lit("é").alias("a"))
    snapshots.save(rows.repartition(3), path, "one")
    snapshots.save(rows.where("k < 4").repartition(7), path)
    assert sorted(map(tuple, snapshots.load(spark, path, "k long, a string").collect())) == [(k, "é") for k in range(4)]
    now = snapshots.version(path)
    assert (now["version"], now["updated_at"], now["rows"]) == (2, None, 4)
    names = [n for n in os.listdir(tmp_path / "state") if n.endswith(".json")]
    assert len(names) == 2 and not [n for n in os.listdir(tmp_path / "state") if n.endswith(".tmp")]
    line = (tmp_path / "state" / now["files"][0]).read_text().splitlines()[0]
    assert list(json.loads(line)) == ["a", "k"]
    snapshots.save(rows.limit(0), path, "none")
    assert snapshots.load(spark, path, "k long").collect() == [] and snapshots.version(path)["updated_at"] == "none"
    assert snapshots.expire(path, 2) == [1]
    assert snapshots.expire(path) == [2] and [n for _, _, f in os.walk(tmp_path / "state" / "data") for n in f] == []


def test_a_task_that_dies_leaves_the_version_before_it(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    snapshots.save(spark.range(5).select(F.col("id").alias("k")), path, "before")

    def dies(frames):
        for f in frames:
            yield f
            if (f["k"] == 7).any():
                os._exit(1)  # the process of the task goes between its write and the commit

    rows = spark.range(0, 20, 1, 4).select(F.col("id").alias("k"))
    with pytest.raises(Exception):  # noqa: B017  whatever Spark makes of it
        snapshots.save(rows.mapInPandas(dies, "k long"), path, "after")
    assert sorted(r.k for r in snapshots.load(spark, path, "k long").collect()) == list(range(5))
    assert snapshots.version(path)["updated_at"] == "before"
    named = set(snapshots.version(path)["files"])
    left = lambda: {os.path.relpath(os.path.join(d, n), tmp_path / "state") for d, _, f in os.walk(tmp_path / "state" / "data") for n in f}
    time.sleep(1)  # tasks that were killed may still be ending
    assert named <= left()
    snapshots.sweep(path)
    assert left() == named
    snapshots.save(rows, path, "after")
    assert snapshots.load(spark, path, "k long").count() == 20


def test_files_of_a_repeated_task_are_not_read(spark, tmp_path):
    writer = snapshots.SnapshotWriter(f"file://{tmp_path}/s", ["k"])
    first, again, none = writer.write(iter([(1,), (2,)])), writer.write(iter([(1,), (2,)])), writer.write(iter([]))
    assert first.name != again.name and none.name is None
    writer.commit([again, none, None])
    assert snapshots.version(f"file://{tmp_path}/s")["rows"] == 2
    assert sorted(r.k for r in snapshots.load(spark, f"file://{tmp_path}/s", "k long").collect()) == [1, 2]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_stamps_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for at, want in ((1704164645.6, "2024-01-02T03:04:05+00:00"), (1699162200, "2023-11-05T05:30:00+00:00"), (1699165800, "2023-11-05T06:30:00+00:00")):
            assert spark.range(1).select(config.utc_stamp(F.timestamp_millis(F.lit(int(at * 1000))))).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert config.utc_text(datetime.datetime(2024, 1, 2, 12, tzinfo=datetime.timezone(datetime.timedelta(hours=9)))) == "2024-01-02T03:00:00+00:00"
    with pytest.raises(ValueError):
        config.utc_text(datetime.datetime(2024, 1, 2))


CONTENTS = {
    "# T\n\n## Contents\n\n- [A](#a)\n  - [B](#b)\n1. C\n2.1 D\nIntro ..... 3\n\n## A\n\ntext\n": "# T\n\n## A\n\ntext\n",
    "# T\n\n## Contents\n\nThis chapter is about contents.\n\n- x\n": None,
    "# T\n\n- [a](#a)\n- [b](#b)\n\n- [c](#c)\n\nText\n": "# T\n\nText\n",
    "- [a](#a)\n- [b](#b)\nx": None,
    "- [a](http://x)\n- [b](http://y)\n- [c](http://z)\n": None,
    "**Table of Contents**\n* a\n* b\ntext": "text",
    "## 1. TABLE of contents:\n- a": "",
    "## Contents\n\n\n## A\n- b\n": None,
    "# T\n## Contents\n": None,
    "": None,
    "x ... 3\n" * 5: None,
    "## Contents\n" + "- a\n" * 5000 + "end": "end",
}


def test_tables_of_contents(spark):
    rows = spark.createDataFrame(list(CONTENTS.items()), "t string, want string")
    for r in rows.select("t", "want", text.without_contents("t").alias("got")).collect():
        assert r.got == (r.t if r.want is None else r.want)


def leaves(value):
    if isinstance(value, str):
        return [value]
    parts = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return [x for p in parts for x in leaves(p)]


def test_leaves_are_those_of_a_parser(spark):
    deep = "x"
    for k in range(60):
        deep = {"k": [deep, f'q"{k}\\']} if k % 2 else [deep, {"a:b": "c:"}]
    values = ['{"a": ["x", {"b": "y\\"z", "c:d" : "k:v"}], "n": 1, "t": true, "z": null}', '"é\\u00e9 \\n"', "[]", "5", json.dumps(deep), json.dumps(["long " * 20_000] * 3), '{"":""}']
    rows = spark.createDataFrame([(v,) for v in [*values, "{no", "", None]], "v string")
    got = [r[0] for r in rows.select(jsonx.string_leaves("v")).collect()]
    assert got == [leaves(json.loads(v)) for v in values] + [None] * 3


def test_texts_of_concepts(spark):
    cases = {'" a b\\n"': "a b", '{"concept": "x", "name": "y"}': "x", '{"concept": " ", "name": "n"}': "n", '{"concept": 5, "text": "t"}': "t", '{"title": ["a"]}': "", "5": "", "{no": "", '""': ""}
    rows = spark.createDataFrame(list(cases.items()), "v string, want string").select("want", jsonx.concept_text("v").alias("got"), jsonx.first_text(F.concat(F.lit('[3, {}, {"name": " "}, '), "v", F.lit("]")), "name", "none").alias("first"))
    out = rows.collect()
    assert all(r.want == r.got for r in out)
    assert [r.first for r in out] == ["none", "y", "n", "none", "none", "none", "none", "none"]


def test_scores_of_families_follow_the_rule(spark):
    near = [("m1", "a"), ("m1", "b"), ("m1", "a"), ("m2", "a"), ("m3", "a"), ("m4", "z")]
    own, linked = [("f", "a"), ("f", "b"), ("g", "b")], [("m2", "f"), ("m2", "f"), ("m4", "f")]
    frame = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = {(r["method"], r.family): r.score for r in outline.family_scores(frame(near, ["method", "neighbor"]), frame(own, ["family", "method"]), frame(linked, ["method", "family"])).collect()}
    for m in ("m1", "m2", "m3", "m4"):
        for f in ("f", "g"):
            want = outline.evidence_score([b for a, b in near if a == m], [b for a, b in linked if a == m], f, [b for a, b in own if a == f])
            assert got.get((m, f), 0) == want


def test_lacking_names(spark):
    rows = spark.createDataFrame([(["a", "c"],), ([],), (None,)], "have array<string>")
    assert [r[0] for r in rows.select(quality.lacking(F.col("have"), ["c", "b", "a"])).collect()] == [["b"], ["c", "b", "a"], ["c", "b", "a"]]
    assert rows.select(quality.lacking(F.col("have"), [])).first()[0] == []

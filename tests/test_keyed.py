"""Keyed tables in buckets: a change rewrites what it touches, a failed one nothing."""

import os

import pytest
from pyspark.sql import functions as F

from litquarry.sources import keyed, sinks

KINDS = "k long, s string, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, KINDS + ", ord long")


def rows(spark, path):
    return sorted((tuple(r) for r in keyed.read(spark, path, KINDS).collect()), key=str)


def files(tmp_path):
    return {os.path.join(d, n) for d, _, names in os.walk(tmp_path / "t" / "data") for n in names if n.endswith(".parquet")}


def test_a_change_rewrites_the_buckets_of_its_keys(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert rows(spark, path) == []
    first = keyed.upsert(frame(spark, [(k, "x", "old", 1) for k in range(200)]), path, ["k", "s"], buckets=16)
    assert first == list(range(16)) and len(rows(spark, path)) == 200
    before = files(tmp_path)
    touched = keyed.upsert(frame(spark, [(7, "x", "lost", 1), (7, "x", "new", 2), (999, None, "added", 1)]), path, ["k", "s"], buckets=3)
    assert 1 <= len(touched) <= 2
    added = files(tmp_path) - before
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in added} == set(touched)
    got = rows(spark, path)
    assert len(got) == 201 and (7, "x", "new") in got and (999, None, "added") in got
    assert keyed.upsert(frame(spark, []), path, ["k", "s"]) == []
    keyed.upsert(frame(spark, [(999, None, "again", 1)]), path, ["k", "s"])
    assert (999, None, "again") in rows(spark, path) and len(rows(spark, path)) == 201
    keyed.upsert(frame(spark, [(999, None, "added", 1)]), path, ["k", "s"])
    # the old folder of a bucket goes when no list names it; those of the first run stay while some of its buckets are in use
    assert keyed.expire(spark, path) > 0 and rows(spark, path) == got and keyed.expire(spark, path) == 0


def test_removal_and_expiry(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    keys = spark.createDataFrame([(1, "x"), (1, "x"), (77, "x")], "k long, s string")
    assert keyed.remove(keys, path, ["k", "s"], KINDS) == []
    keyed.upsert(frame(spark, [(1, "x", "a", 1), (2, "x", "b", 1)]), path, ["k", "s"], buckets=1)
    assert keyed.remove(keys, path, ["k", "s"], KINDS) == [0] and rows(spark, path) == [(2, "x", "b")]
    assert keyed.remove(spark.createDataFrame([(2, "x")], "k long, s string"), path, ["k", "s"], KINDS) == [0]
    assert rows(spark, path) == [] and keyed.expire(spark, path) >= 2
    keyed.upsert(frame(spark, [(3, "x", "c", 1)]), path, ["k", "s"])
    assert rows(spark, path) == [(3, "x", "c")] and keyed.expire(spark, path) == 0


def test_a_failed_change_leaves_the_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    keyed.upsert(frame(spark, [(k, "x", "old", 1) for k in range(50)]), path, ["k", "s"], buckets=4)
    version = sinks.published(spark, path)
    bad = frame(spark, [(k, "x", "new", 1) for k in range(50)]).withColumn("v", F.when(F.col("k") == 31, F.raise_error(F.lit("no")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        keyed.upsert(bad, path, ["k", "s"])
    assert sinks.published(spark, path) == version and {v for *_, v in rows(spark, path)} == {"old"}

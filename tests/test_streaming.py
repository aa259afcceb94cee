import datetime
import json
import os

import pytest

from litquarry.operators import state
from litquarry.sources import keyed
from litquarry.streaming import folds

PUTS = "key string, payload string, fetched_at timestamp, ord long"


def land(folder, name, events, nth=None):
    """A file of events; files are read in the order of their times, which ``nth`` sets."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{name}.json"
    path.write_text("\n".join(map(json.dumps, events)))
    if nth is not None:
        os.utime(path, (1_700_000_000 + 60 * nth, 1_700_000_000 + 60 * nth))


def at(minute):
    return (datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)).isoformat() + "Z"


def put(key, payload, minute):
    return {"key": key, "payload": payload, "fetched_at": at(minute), "ord": minute}


def drain(frame, mode, name, checkpoint):
    query = frame.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None


def test_latest_is_the_batch_result(spark, tmp_path):
    land(tmp_path / "in", "1", [put("a", "1", 1), put("b", "1", 2), put("a", "2", 3)])
    land(tmp_path / "in", "2", [put("a", "0", 0), put("c", "1", 4)])
    stream = folds.landed(spark, str(tmp_path / "in"), PUTS, per_trigger=1)
    drain(folds.latest(stream, ["key"], ["fetched_at", "ord"]), "complete", "latest_puts", tmp_path / "c")
    batch = state.latest(spark.read.schema(PUTS).json(str(tmp_path / "in")), ["key"], ["fetched_at", "ord"])
    assert sorted(map(tuple, spark.table("latest_puts").select("key", "payload").collect())) == sorted(map(tuple, batch.select("key", "payload").collect())) == [("a", "2"), ("b", "1"), ("c", "1")]


def test_upsert_goes_on_from_its_checkpoint(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "out")

    def run():
        query = folds.upserting(folds.landed(spark, str(folder), PUTS), path, ["key"], str(tmp_path / "c")).start()
        query.awaitTermination(120)
        return sorted((r.key, r.payload) for r in keyed.read(spark, path, PUTS.replace(", ord long", "")).collect())

    land(folder, "1", [put("a", "1", 1), put("a", "2", 2)])
    assert run() == [("a", "2")]
    land(folder, "2", [put("a", "3", 3), put("b", "1", 3)])
    assert run() == [("a", "3"), ("b", "1")] and run() == [("a", "3"), ("b", "1")]


def test_append(spark, tmp_path):
    land(tmp_path / "in", "1", [put("a", "1", 1)])
    folds.appending(folds.landed(spark, str(tmp_path / "in"), PUTS), str(tmp_path / "out"), str(tmp_path / "c")).start().awaitTermination(120)
    assert spark.read.schema(PUTS).json(str(tmp_path / "out")).count() == 1


@pytest.mark.parametrize(
    "order, told, held",
    [
        ((1, 2, 3), {("a", "1", True), ("b", "1", True), ("b", "2", True), ("c", "1", True), ("a", "1", False)}, {("b", "2"), ("c", "1")}),
        # two come when they have expired, and the last one not after the watermark of the batch before, so it is late
        ((3, 1, 2), {("c", "1", True), ("a", "1", False), ("b", "1", False)}, {("c", "1")}),
        ((2, 3, 1), {("b", "2", True), ("c", "1", True)}, {("b", "2"), ("c", "1")}),
    ],
)
def test_cache_expires(spark, tmp_path, order, told, held):
    files = {1: [put("a", "1", 0), put("b", "1", 5)], 2: [put("b", "2", 60)], 3: [put("c", "1", 61)]}
    for nth, name in enumerate(order):
        land(tmp_path / "in", str(name), files[name], nth)
    stream = folds.landed(spark, str(tmp_path / "in"), PUTS, per_trigger=1).withWatermark("fetched_at", "1 minute")
    table = "cached_puts_" + "".join(map(str, order))
    drain(folds.cached(stream, 600), "update", table, tmp_path / "c")
    assert {tuple(r) for r in spark.table(table).select("key", "payload", "live").collect()} == told
    assert {tuple(r) for r in folds.latest_cache_state(spark.table(table)).select("key", "payload").collect()} == held


def test_windows_and_bursts(spark, tmp_path):
    land(tmp_path / "in", "1", [put("a", "1", 1), put("a", "1", 4), put("b", "1", 30)])
    stream = folds.landed(spark, str(tmp_path / "in"), PUTS)
    drain(folds.windowed_counts(stream, "fetched_at", "10 minutes", "5 minutes", ["key"]), "append", "window_counts", tmp_path / "c1")
    assert [(r.key, r.n) for r in spark.table("window_counts").collect()] == [("a", 2)]
    changes = stream.select("key", stream["fetched_at"].alias("at"))
    drain(folds.quiet(changes, "5 minutes", "1 minute"), "append", "bursts", tmp_path / "c2")
    assert [(r.key, r.changes) for r in spark.table("bursts").collect()] == [("a", 2)]


def test_turns(spark):
    rows = [("t", 1, "message", None, "draft", None), ("t", 2, "message", "final_answer", "done", None), ("t", 3, "usage", None, None, 5), ("t", 4, "usage", None, None, 9), ("u", 1, "message", None, "only", None)]
    got = folds.turns(spark.createDataFrame(rows, "turn_id string, seq int, kind string, phase string, text string, usage int")).collect()
    assert sorted((r.turn_id, r.usage, r.items, r.answer) for r in got) == [("t", 9, 2, "done"), ("u", None, 1, "only")]

"""Append-only streams folded to tables, by Structured Streaming.

All of them take a streaming DataFrame and return one, or start a query with ``availableNow`` so that a run ends when what is
there has been read; the checkpoint makes the next run go on from there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import state
from ..sources import keyed


def landed(spark: SparkSession, path: str, schema: str, fmt: str = "json", per_trigger: int = 1000) -> DataFrame:
    """Files of a folder as a stream; each file is read once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(path)


def latest(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key, as an aggregate with one row of state per key (output mode update or complete)."""
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def turns(events: DataFrame) -> DataFrame:
    return state.turn_results(events)


def windowed_counts(events: DataFrame, at: str, width: str, late: str, keys: list[str], slide: str | None = None) -> DataFrame:
    """Events per window and key; what comes later than ``late`` behind the newest is dropped and its state let go.

    Windows follow one another, or with ``slide`` begin so far apart, so that an event counts in several.
    """
    window = F.window(at, width) if slide is None else F.window(at, width, slide)
    return events.withWatermark(at, late).groupBy(window, *keys).agg(F.count(F.lit(1)).alias("n")).select("window.start", "window.end", *keys, "n")


def upserting(events: DataFrame, path: str, keys: list[str], checkpoint: str, buckets: int = keyed.BUCKETS) -> DataStreamWriter:
    """Keep a table of ``sources.keyed`` up to date; of a batch the last event per key by ord counts.

    A batch rewrites the buckets of its keys only. A batch that is repeated after a failure puts the same rows again.
    """
    return events.writeStream.foreachBatch(lambda rows, _: keyed.upsert(rows, path, keys, buckets)).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def appending(events: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return events.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)


def cached(puts: DataFrame, ttl_seconds: int) -> DataFrame:
    """(key, payload, fetched_at, live): the last put of each key, and a row with live = false when it has expired.

    Time is event time, so ``puts`` needs a watermark on fetched_at. A put is live while the watermark is less than the time
    to live beyond it; one that comes when it has expired already is told at once with live = false and leaves no state. Of puts
    of one time the last one wins; a put that is older than the one held changes nothing and tells nothing. A put that is not
    after the watermark that the batch before it began with is late: Spark drops it before it gets here.
    """

    def step(key, frames, held: GroupState):
        row = lambda payload, at, live: pd.DataFrame({"key": [key[0]], "payload": [payload], "fetched_at": [pd.Timestamp(at, unit="us")], "live": [live]})
        if held.hasTimedOut:
            payload, at = held.get
            held.remove()
            yield row(payload, at, False)
            return
        payload, at = before = held.get if held.exists else (None, -1)
        for f in frames:
            micros = f["fetched_at"].astype("datetime64[us]").astype("int64").to_numpy()
            i = len(micros) - 1 - micros[::-1].argmax()
            if micros[i] >= at:
                payload, at = f["payload"].iloc[i], int(micros[i])
        if (payload, at) == tuple(before):
            return
        expires = at // 1000 + ttl_seconds * 1000
        if expires <= held.getCurrentWatermarkMs():
            if held.exists:
                held.remove()
            yield row(payload, at, False)
            return
        held.update((payload, at))
        held.setTimeoutTimestamp(expires)
        yield row(payload, at, True)

    kind = puts.schema["key"].dataType.simpleString()
    return puts.groupBy("key").applyInPandasWithState(step, f"key {kind}, payload string, fetched_at timestamp, live boolean", "payload string, at long", "update", GroupStateTimeout.EventTimeTimeout)


def latest_cache_state(rows: DataFrame) -> DataFrame:
    """The table that the rows of ``cached`` tell, once they are written: the last row of each key, gone ones left out."""
    last = rows.groupBy("key").agg(F.max_by(F.struct("payload", "fetched_at", "live"), F.struct("fetched_at", (~F.col("live")).alias("gone"))).alias("r"))
    return last.where("r.live").select("key", "r.payload", "r.fetched_at")


def quiet(changes: DataFrame, gap: str, late: str) -> DataFrame:
    """(key, from, until, changes): bursts of changes of a key that are followed by ``gap`` without one."""
    return changes.withWatermark("at", late).groupBy("key", F.session_window("at", gap)).agg(F.count(F.lit(1)).alias("changes")).select("key", F.col("session_window.start").alias("from"), F.col("session_window.end").alias("until"), "changes")

"""Streams with state of their own: a bounded cache that lets the least recently used go, and turns that end.

Both take their time from the events, so that what they say does not depend on the order in which files arrive, as long as an event is
not later than the watermark. A key's state is read once for a batch of rows and written back as far as it changed. They need
Spark's RocksDB state store; ``started`` sets it for the query that it starts.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Entries of a cache in memory.
CAPACITY = 256


def _micros(column: pd.Series) -> list[int]:
    return column.astype("datetime64[us]").astype("int64").tolist()


class _Timed(StatefulProcessor):
    """A processor whose key has at most one timer, for the next time at which something is due."""

    def init(self, handle) -> None:
        self.handle, self.timer = handle, handle.getValueState("timer", "at long")

    def due(self, at: int | None) -> None:
        old = self.timer.get()[0] if self.timer.exists() else None
        if old == at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if at is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(at)
            self.timer.update((at,))


class Recent(_Timed):
    """The entries of one cache: key, payload, other names, when it was put and when it was last used."""

    def __init__(self, capacity: int, ttl_ms: int):
        self.capacity, self.ttl = capacity, ttl_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.entries = handle.getMapState("entries", "key string", "payload string, names string, put long, used long, seq long")
        self.step = handle.getValueState("step", "n long")

    def _load(self) -> dict[str, tuple]:
        return {k[0]: tuple(v) for k, v in self.entries.iterator()}

    def _store(self, before: dict, held: dict) -> None:
        for k in before.keys() - held.keys():
            self.entries.removeKey((k,))
        for k, v in held.items():
            if before.get(k) != v:
                self.entries.updateValue((k,), v)
        self.due(min(v[2] for v in held.values()) // 1000 + self.ttl if held else None)

    def _told(self, cache, said: list[tuple]) -> pd.DataFrame:
        n = self.step.get()[0] if self.step.exists() else 0
        self.step.update((n + len(said),))
        return pd.DataFrame([(cache, n + i, what, key, payload, pd.Timestamp(at, unit="us")) for i, (what, key, payload, at) in enumerate(said, 1)], columns=["cache", "step", "what", "key", "payload", "at"])

    def handleInputRows(self, key, rows, timerValues):
        ops = []
        for f in rows:
            names = f["names"].tolist() if "names" in f else [None] * len(f)
            ops += zip(_micros(f["at"]), f["seq"].tolist(), f["kind"].tolist(), f["key"].tolist(), f["payload"].tolist(), names, strict=True)
        before, said, now = self._load(), [], timerValues.getCurrentWatermarkInMs()
        held = dict(before)
        named = {n: k for k, v in held.items() for n in (k, *json.loads(v[1]))}

        def drop(k: str, what: str | None, at: int) -> None:
            entry = held.pop(k)
            for n in (k, *json.loads(entry[1])):
                named.pop(n, None)
            if what:
                said.append((what, k, entry[0], at))

        for at, seq, kind, k, payload, names in sorted(ops, key=lambda o: (o[0], o[1])):
            if kind == "clear":
                for x in sorted(held):
                    drop(x, "cleared", at)
            elif kind == "get":
                own = named.get(k)
                if own is None:
                    said.append(("miss", k, None, at))
                else:
                    p, others, put, used, last = held[own]
                    held[own] = (p, others, put, *max((used, last), (at, seq)))
                    said.append(("hit", own, p, at))
            elif k in held and (at, seq) < held[k][3:]:
                continue
            elif at // 1000 + self.ttl <= now:
                said.append(("expired", k, payload, at))
            else:
                others = sorted({n for n in (names if names is not None else []) if n and n != k})
                for x in sorted({named[n] for n in (k, *others) if n in named}):
                    drop(x, None if x == k else "replaced", at)
                held[k] = (payload, json.dumps(others), at, at, seq)
                named |= dict.fromkeys((k, *others), k)
                said.append(("put", k, payload, at))
            while len(held) > self.capacity:
                drop(min(held, key=lambda x: (held[x][3:], x)), "evicted", at)
        self._store(before, held)
        if said:
            yield self._told(key[0], said)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        before, now = self._load(), timerValues.getCurrentWatermarkInMs()
        gone = sorted(k for k, v in before.items() if v[2] // 1000 + self.ttl <= now)
        self.timer.clear()
        self._store(before, {k: v for k, v in before.items() if k not in gone})
        if gone:
            yield self._told(key[0], [("expired", k, before[k][0], before[k][2]) for k in gone])


def recent(ops: DataFrame, capacity: int = CAPACITY, ttl_seconds: int = 30 * 86_400) -> DataFrame:
    """(cache, step, what, key, payload, at): what happens in caches of ``capacity`` entries each, by the steps of a cache.

    ``ops`` has (cache, kind, key, payload, at, seq) and may have names; it needs a watermark on ``at``. A *put* replaces the entry of its
    key and those that any of its names had; a *get* by key or name makes an entry the last used; *clear* empties a cache. Beyond the capacity
    the least recently used entry goes; one that was put ``ttl_seconds`` before the watermark goes as expired. A put that is older than
    its entry's last use changes nothing.
    """
    kind = ops.schema["cache"].dataType.simpleString()
    if capacity < 1:
        raise ValueError("capacity must be 1 or more")
    return ops.groupBy("cache").transformWithStateInPandas(Recent(capacity, ttl_seconds * 1000), f"cache {kind}, step long, what string, key string, payload string, at timestamp", "append", "eventTime")


def contents(told: DataFrame) -> DataFrame:
    """(cache, key, payload): what the caches hold after all that ``recent`` has told."""
    last = told.where("what <> 'miss'").groupBy("cache", "key").agg(F.max_by(F.struct("what", "payload"), "step").alias("r"))
    return last.where("r.what in ('put', 'hit')").select("cache", "key", "r.payload")


class Turns(_Timed):
    """One turn of a conversation: what its result will be, until it has ended or nothing has come for too long."""

    NAMES = ("items", "usage_seq", "usage", "final_seq", "final", "plain_seq", "plain", "done_at", "status", "last_at")

    def __init__(self, idle_ms: int):
        self.idle = idle_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.turn = handle.getValueState("turn", "items long, usage_seq long, usage long, final_seq long, final string, plain_seq long, plain string, done_at long, status string, last_at long")

    def handleInputRows(self, key, rows, timerValues):
        t = dict(zip(self.NAMES, self.turn.get(), strict=True)) if self.turn.exists() else dict.fromkeys(self.NAMES) | {"items": 0}

        def newest(name: str, seq: int, value) -> None:
            if t[f"{name}_seq"] is None or seq >= t[f"{name}_seq"]:
                t[f"{name}_seq"], t[name] = seq, value

        for f in rows:
            some = lambda c: [None if pd.isna(x) else x for x in f[c].tolist()]  # noqa: E731, B023
            for at, seq, kind, phase, text, usage in zip(_micros(f["at"]), *map(some, ("seq", "kind", "phase", "text", "usage")), strict=True):
                t["last_at"] = max(t["last_at"] or at, at)
                t["items"] += kind in ("message", "item")
                if kind == "usage" and usage is not None:
                    newest("usage", int(seq), int(usage))
                elif kind == "message" and text is not None and phase in ("final_answer", None):
                    newest("plain" if phase is None else "final", int(seq), text)
                elif kind == "completed":
                    t["done_at"], t["status"] = at, text or "completed"
        self.turn.update(tuple(t[n] for n in self.NAMES))
        self.due(t["done_at"] // 1000 + 1 if t["done_at"] is not None else t["last_at"] // 1000 + self.idle)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        t = dict(zip(self.NAMES, self.turn.get(), strict=True))
        self.turn.clear()
        self.timer.clear()
        yield pd.DataFrame({"turn_id": [key[0]], "status": [t["status"] or "timed out"], "usage": pd.array([t["usage"]], "Int64"), "items": [t["items"]], "answer": [t["plain"] if t["final"] is None else t["final"]]})


def turn_results(events: DataFrame, idle_seconds: int = 900) -> DataFrame:
    """(turn_id, status, usage, items, answer): one row for each turn when the watermark has passed its end; then its state goes.

    ``events`` has (turn_id, seq, kind, phase, text, usage, at) with a watermark on ``at``; kinds are *message*, *item*, *usage* and
    *completed*, whose text is the turn's status. What comes before the end in time counts, however late it arrives before the
    watermark. The answer is the last message marked as final, else the last without a phase. A turn without an end gives what it has, as
    *timed out*, when the watermark is ``idle_seconds`` past its last event.
    """
    kind = events.schema["turn_id"].dataType.simpleString()
    return events.groupBy("turn_id").transformWithStateInPandas(Turns(idle_seconds * 1000), f"turn_id {kind}, status string, usage long, items long, answer string", "append", "eventTime")


def started(rows: DataFrame, path: str, checkpoint: str):
    """A query that writes the rows as Parquet until all there is has been read."""
    spark, (name, value) = rows.sparkSession, STORE
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:  # a query takes the settings of the moment in which it starts
        return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, before)

"""Queries over streams with state and over re-runs, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import incremental
from ..sources import keyed, sinks
from ..sources.adapter import table
from ..sources.landing import folder
from ..streaming import folds, stateful
from .registry import query

_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _drained(spark, rows: DataFrame, name: str) -> DataFrame:
    path = folder(spark, name)
    q = stateful.started(rows, path, folder(spark, f"{name}-checkpoint"))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(rows.schema).parquet(path)


#: Entries and days of the caches of the query, and days that an event may be late.
ENTRIES, DAYS, LATE = 40, 7, 12


@query("stream_recent_entries", f"WITH last AS (SELECT event_type AS cache, user_id AS key, max(ts) AS put_at, arg_max(event_id, (ts, event_id)) AS seq FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY cache ORDER BY put_at DESC, seq DESC) AS n FROM last), t AS (SELECT epoch_ms(max(ts)) - {LATE} * 86400000 AS watermark FROM events) SELECT cache, cast(key AS VARCHAR) AS key, seq FROM r, t WHERE n <= {ENTRIES} AND epoch_ms(put_at) + {DAYS} * 86400000 > watermark")
def _(spark, d):
    """What is left in bounded caches, one for each type of event, after a stream of puts that is read in several batches."""
    path = folder(spark, "puts")
    table(spark, d, "events").select(F.col("event_type").alias("cache"), F.lit("put").alias("kind"), F.col("user_id").cast("string").alias("key"), F.col("event_id").cast("string").alias("payload"), F.date_format("ts", _UTC).alias("at"), F.col("event_id").alias("seq")).repartitionByRange(3, "at").write.json(path)
    ops = folds.landed(spark, path, "cache string, kind string, key string, payload string, at timestamp, seq long", per_trigger=1).withWatermark("at", f"{LATE} days")
    told = _drained(spark, stateful.recent(ops, ENTRIES, DAYS * 86_400), "recent")
    return stateful.contents(told).select("cache", "key", F.col("payload").cast("long").alias("seq"))


@query("stream_turn_results", "SELECT conv_id AS turn_id, CASE WHEN conv_id % 7 = 3 THEN 'timed out' WHEN conv_id % 5 = 0 THEN 'failed' ELSE 'completed' END AS status, max(turn) AS usage, count(*) AS items, coalesce(arg_max(text, turn) FILTER (role = 'assistant' AND text IS NOT NULL), arg_max(text, turn) FILTER (role <> 'assistant' AND text IS NOT NULL)) AS answer FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id")
def _(spark, d):
    """Each conversation's result at its end, by a stream that reads its events in batches of files, in whatever order they come."""
    path, c = folder(spark, "notifications"), table(spark, d, "conversations").where("conv_id is not null")
    at = lambda seconds: F.date_format(F.timestamp_seconds(1_704_067_200 + F.col("conv_id") % 1000 * 60 + seconds), _UTC).alias("at")
    none = lambda kind: F.lit(None).cast(kind)
    columns = ["turn_id", "seq", "kind", "phase", "text", "usage", "at"]
    own = [F.col("conv_id").alias("turn_id"), F.col("turn").alias("seq")]
    said = c.select(*own, F.lit("message").alias("kind"), F.when(F.col("role") == "assistant", "final_answer").alias("phase"), "text", none("long").alias("usage"), at(F.col("turn")))
    used = c.select(*own, F.lit("usage").alias("kind"), none("string").alias("phase"), none("string").alias("text"), F.col("turn").alias("usage"), at(F.col("turn")))
    status = F.when(F.col("conv_id") % 5 == 0, "failed").otherwise("completed")
    ends = c.where("conv_id % 7 <> 3").groupBy("conv_id").agg(F.max("turn").alias("turn")).select(*own, F.lit("completed").alias("kind"), none("string").alias("phase"), status.alias("text"), none("long").alias("usage"), at(F.col("turn") + 1))
    ends.unionByName(said).unionByName(used).select(*columns).repartition(6).write.json(path)
    # an event of no turn, long after all others, with which the watermark passes them
    late = spark.range(1).select(none("long").alias("turn_id"), F.lit(0).alias("seq"), F.lit("item").alias("kind"), none("string").alias("phase"), none("string").alias("text"), none("long").alias("usage"), F.lit("2030-01-01T00:00:00.000000Z").alias("at"))
    late.write.mode("append").json(path)
    events = folds.landed(spark, path, "turn_id long, seq long, kind string, phase string, text string, usage long, at timestamp", per_trigger=2).withWatermark("at", "30 days")
    return _drained(spark, stateful.turn_results(events), "turns").where("turn_id is not null")


@query("keyed_upserts", "SELECT user_id AS key, arg_max(event_id, ts) AS event_id, count(*) AS n FROM (SELECT * FROM events WHERE event_type <> 'error') GROUP BY user_id HAVING max(CASE WHEN event_type = 'purchase' THEN event_id ELSE -1 END) % 4 <> 1")
def _(spark, d):
    """A keyed table after three changes, each of which rewrites its own buckets, and a removal."""
    path, kinds = folder(spark, "keyed"), "key long, event_id long, n long"
    e = table(spark, d, "events").where("event_type <> 'error'")
    last = e.groupBy(F.col("user_id").alias("key")).agg(F.max_by("event_id", "ts").alias("event_id"), F.count(F.lit(1)).alias("n"))
    keyed.upsert(last.where("key % 2 = 0").select("key", F.lit(-1).cast("long").alias("event_id"), "n", F.lit(1).alias("ord")), path, ["key"], 8)
    keyed.upsert(last.select("key", "event_id", F.lit(0).cast("long").alias("n"), F.lit(1).alias("ord")).unionByName(last.withColumn("ord", F.lit(2))), path, ["key"])
    keyed.upsert(last.limit(0).withColumn("ord", F.lit(1)), path, ["key"])
    bought = e.where("event_type = 'purchase'").groupBy(F.col("user_id").alias("key")).agg(F.max("event_id").alias("last"))
    keyed.remove(bought.where("last % 4 = 1"), path, ["key"], kinds)
    return keyed.read(spark, path, kinds)


def _landed_events(spark, d) -> DataFrame:
    path = folder(spark, "events")
    table(spark, d, "events").select(F.date_format("ts", _UTC).alias("at"), "event_type", "user_id").repartition(5).write.json(path)
    return folds.landed(spark, path, "at timestamp, event_type string, user_id long", per_trigger=2)


def _day(c: str):
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


@query("stream_sliding_windows", "SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR, time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 24 HOUR]) AS start FROM events) GROUP BY 1, 2")
def _(spark, d):
    """Events in windows of 36 hours that begin every 12 hours, by a stream over files in any order."""
    rows = folds.windowed_counts(_landed_events(spark, d), "at", "36 hours", "40 days", ["event_type"], "12 hours")
    return _completed(spark, rows, "sliding").select(_day("start").alias("start"), "event_type", "n")


@query("stream_bursts", "SELECT key, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, count(*) AS changes FROM (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS burst FROM (SELECT user_id AS key, ts, event_id, coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 8 HOUR, true) AS gap FROM events)) GROUP BY key, burst")
def _(spark, d):
    """Bursts of events of a user with less than 8 hours between one and the next, by session windows of a stream."""
    rows = folds.quiet(_landed_events(spark, d).select(F.col("user_id").alias("key"), "at"), "8 hours", "40 days")
    return _completed(spark, rows, "bursts").select("key", _day("from").alias("first"), "changes")


def _completed(spark, rows: DataFrame, name: str) -> DataFrame:
    """The rows of a streaming aggregate that has read all there is, also those whose windows are still open; each batch writes them anew."""
    path = folder(spark, name)
    write = lambda found, _: sinks.parquet_snapshot(found, path)
    q = rows.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", folder(spark, f"{name}-checkpoint")).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(rows.schema).parquet(path)


def _sources(spark, paths: list[str], run: int) -> DataFrame:
    rows = spark.read.schema("doc_id long, n_chars long").json(paths)
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")).withColumn("run", F.lit(run))


@query("incremental_rerun", "WITH s AS (SELECT source, doc_id, n_chars FROM documents WHERE source IS NOT NULL AND source <> 'src5' UNION ALL SELECT 'src7', doc_id, n_chars FROM documents WHERE source = 'src6' UNION ALL SELECT 'again', doc_id, n_chars FROM documents WHERE source = 'src5') SELECT source, count(*) AS n, sum(n_chars)::BIGINT AS chars, CASE WHEN source IN ('src7', 'src9', 'again') THEN 2 ELSE 1 END AS run FROM s GROUP BY source")
def _(spark, d):
    """Sums by source of landed files, brought up to date: one source has got more, one was renamed, one is forced, the rest is the same."""
    path, target = folder(spark, "inputs"), folder(spark, "sums")
    docs = table(spark, d, "documents").where("source is not null").select("source", "doc_id", "n_chars")
    docs.repartition("source").write.partitionBy("source").json(path)
    incremental.rerun(spark, path, target, lambda s, paths: _sources(s, paths, 1), glob="*.json")
    six = docs.where("source = 'src6'").drop("source")
    six.write.json(f"{path}/source=src7/more")
    fs, p = sinks.file_system(spark, f"{path}/source=src5")
    fs.rename(p, sinks.file_system(spark, f"{path}/source=again")[1])
    forced = [r.path for r in incremental.listing(spark, path, "*.json").where("path like '%source=src9/%'").collect()]
    incremental.rerun(spark, path, target, lambda s, paths: _sources(s, paths, 2), forced, "*.json")
    rows = incremental.current(spark, target).withColumn("source", F.regexp_extract("path", "source=([^/]+)/", 1))
    return rows.groupBy("source").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.max("run").cast("int").alias("run"))

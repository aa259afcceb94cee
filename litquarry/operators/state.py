"""Caches, logs and attempts as tables: the latest row per key wins, old rows expire, the oldest are evicted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAPER_DAYS, SEARCH_DAYS, PAPER_ENTRIES, SEARCH_ENTRIES = 30, 7, 100_000, 5_000


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key; one aggregate that is combined on the map side, so a hot key costs a row per task."""
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(last).select(*keys, "_row.*")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace existing ones of the same key; of several new ones the last by ord stays."""
    fresh = latest(new, keys, ["ord"]).drop("ord")
    return existing.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def delete(existing: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return existing.join(gone.select(*keys), keys, "left_anti")


def valid(rows: DataFrame, now: Column, days: int, at: str = "fetched_at") -> DataFrame:
    return rows.where(F.col(at) >= now - F.make_interval(days=F.lit(days)))


def evict(rows: DataFrame, most: int, order: list[str]) -> DataFrame:
    """The ``most`` newest rows by order; 0 or less keeps all. A top-k that each task begins, not a sort of everything."""
    return rows if most <= 0 else rows.orderBy(*[F.desc(c) for c in order]).limit(most)


def lookup(keys: DataFrame, aliases: DataFrame, entries: DataFrame, now: Column, days: int = PAPER_DAYS) -> DataFrame:
    """(request, entry_id, payload): for each request the valid entry that its first known key names.

    ``keys`` has (request, pos, key), ``aliases`` (key, entry_id), ``entries`` (entry_id, payload, fetched_at).
    """
    hits = keys.join(aliases, "key").join(valid(entries, now, days), "entry_id")
    return hits.groupBy("request").agg(F.min_by(F.struct("entry_id", "payload"), F.struct("pos", "entry_id")).alias("hit")).select("request", "hit.*")


def repointed(aliases: DataFrame, new: DataFrame) -> DataFrame:
    """Aliases after an insert: the new entry of a key replaces the one it named."""
    return latest(aliases.withColumn("ord", F.lit(0)).unionByName(new.withColumn("ord", F.lit(1))), ["key"], ["ord", "entry_id"]).drop("ord")


def statistics(entries: DataFrame, aliases: DataFrame, searches: DataFrame) -> DataFrame:
    count = lambda rows, name: rows.agg(F.count(F.lit(1)).alias(name))
    return count(entries, "papers").join(count(aliases, "aliases"), F.lit(True)).join(count(searches, "searches"), F.lit(True))


def next_attempts(attempts: DataFrame, shards: DataFrame) -> DataFrame:
    """(stage, shard_id, attempt): the number that each shard's next attempt gets."""
    most = attempts.groupBy("stage", "shard_id").agg(F.max("attempt").alias("most"))
    return shards.join(most, ["stage", "shard_id"], "left").select("stage", "shard_id", (F.coalesce("most", F.lit(0)) + 1).alias("attempt"))


def status_counts(log: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    return log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(status) == "completed").alias("completed"), F.count_if(F.startswith(status, F.lit("failed"))).alias("failed"))


def turn_results(events: DataFrame) -> DataFrame:
    """One row per turn of a notification stream: last usage, number of items, final answer.

    The final answer is the last one that is marked so, else the last message without a phase.
    """
    last = lambda value, when: F.max_by(value, F.when(when, F.col("seq")))
    message = F.col("kind") == "message"
    return events.groupBy("turn_id").agg(
        last("usage", F.col("kind") == "usage").alias("usage"),
        F.count_if(F.col("kind").isin("message", "item")).alias("items"),
        F.coalesce(last("text", message & (F.col("phase") == "final_answer")), last("text", message & F.col("phase").isNull())).alias("answer"),
    )


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Paths of files that are new or whose size or content differs. Both sides have (path, size, sha256)."""
    b = before.select("path", F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    rows = after.join(b, "path", "left")
    return rows.where(F.col("_sha").isNull() | (F.col("_sha") != F.col("sha256")) | (F.col("_size") != F.col("size"))).select("path")


def settled(changes: DataFrame, seconds: int, now: Column) -> DataFrame:
    """Keys whose last change (key, at, signature) is ``seconds`` old, with the signature that has stood since."""
    rows = changes.groupBy("key").agg(F.max("at").alias("last"), F.max_by("signature", "at").alias("signature"))
    return rows.where(F.col("last") <= now - F.make_interval(secs=F.lit(seconds)))


def ranked_gaps(gaps: DataFrame, most: int = 10, ids: int = 3) -> DataFrame:
    """The most important gaps that are left, each with its first few evidence ids."""
    return gaps.orderBy(F.desc("importance"), "concept").limit(most).select("concept", "importance", F.slice("evidence_ids", 1, ids).alias("evidence_ids"))


def numbered(rows: DataFrame, base: str, order: list[str]) -> DataFrame:
    """Ids from a base that may repeat: the first keeps it, later ones get -2, -3 and so on."""
    nth = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    return rows.withColumn("_n", nth).withColumn("unique_id", F.when(F.col("_n") == 1, F.col(base)).otherwise(F.concat_ws("-", base, F.col("_n").cast("string")))).drop("_n")

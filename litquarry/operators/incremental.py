"""Runs that do again only what has changed: two listings of files are compared, and a new version of the result is published.

A listing says of each input its path, size and time of change, read from the file system's records and not from the files. Only
of those that differ in these the content is hashed, so a file that was touched but says the same is not done again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from ..sources.landing import durable

_KINDS = "path string, size long, changed_at timestamp, sha256 string"


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, size, changed_at) of the files below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed_at"))


def compared(before: DataFrame, after: DataFrame, forced: DataFrame | None = None) -> DataFrame:
    """(path, what) for each path of either listing: *added*, *removed*, *changed*, *forced* or *same*.

    Both have (path, size, sha256), and a path once. An unknown hash on either side counts as changed. ``forced`` has paths to do again
    although they are the same; one that is nowhere is left out. Paths go out once each, whatever the order of the listings.
    """
    b, a = (rows.select("path", F.struct("size", "sha256").alias(name)) for rows, name in ((before, "b"), (after, "a")))
    rows = b.join(a, "path", "full")
    if forced is None:
        rows = rows.withColumn("_forced", F.lit(False))
    else:
        rows = rows.join(forced.select("path", F.lit(True).alias("_forced")).distinct(), "path", "left").withColumn("_forced", F.coalesce("_forced", F.lit(False)))
    same = (F.col("a.size") == F.col("b.size")) & (F.col("a.sha256") == F.col("b.sha256"))
    what = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(~F.coalesce(same, F.lit(False)), "changed").when(F.col("_forced"), "forced").otherwise("same")
    return rows.select("path", what.alias("what"))


def signed(spark: SparkSession, now: DataFrame, before: DataFrame | None) -> DataFrame:
    """The listing with hashes: those of ``before`` where size and time are unchanged, else from the content, which only then is read."""
    if before is None:
        before = spark.createDataFrame([], _KINDS)
    known = before.select("path", "size", "changed_at", "sha256")
    kept = now.join(known, ["path", "size", "changed_at"]).select("path", "size", "changed_at", "sha256")
    fresh = now.join(kept.select("path"), "path", "left_anti")
    paths = [r.path for r in fresh.select("path").collect()]  # as many names as Spark's own listing of these files would hold
    if not paths:
        return kept
    read = spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"))
    return kept.unionByName(fresh.join(read, "path").select("path", "size", "changed_at", "sha256"))


def rerun(spark: SparkSession, inputs: str, target: str, compute: Callable[[SparkSession, list[str]], DataFrame], forced: Iterable[str] = (), glob: str = "*") -> DataFrame:
    """Bring the table at ``target`` up to date with the files below ``inputs``; what was done for each path, as (path, what).

    ``compute`` gets the paths to do and returns rows with a column ``path`` that says from which file a row is. Rows of files that are the same
    are taken over from the newest version, those of removed ones go. Rows and listing are one new version that readers see at once
    (``sinks.publish``); if nothing is to be done, none is made. A run that fails leaves the version before it, and the next one does
    all that is not in it.
    """
    newest = sinks.published(spark, target)
    old = spark.read.parquet(f"{newest}/listing") if newest else None
    now = durable(signed(spark, listing(spark, inputs, glob), old), "listing")
    wanted = spark.createDataFrame([(p,) for p in forced], "path string")
    plan = durable(compared(old if old is not None else now.limit(0), now, wanted), "changes")
    paths = [r.path for r in plan.where("what in ('added', 'changed', 'forced')").select("path").collect()]
    if not paths and plan.where("what = 'removed'").isEmpty() and newest:
        return plan
    rows = compute(spark, paths) if paths else None
    if newest:
        kept = spark.read.parquet(f"{newest}/rows").join(plan.where("what = 'same'").select("path"), "path", "left_semi")
        rows = kept if rows is None else kept.unionByName(rows, allowMissingColumns=True)

    def write(path: str) -> None:
        (rows if rows is not None else now.select("path").limit(0)).write.parquet(f"{path}/rows")
        now.write.parquet(f"{path}/listing")

    sinks.publish(spark, target, write)
    return plan


def current(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the newest version."""
    return spark.read.parquet(f"{sinks.published(spark, target)}/rows")

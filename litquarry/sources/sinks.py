"""Writers: snapshots that appear at once, keyed tables, append-only logs, content-addressed copies."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as jsonx
from ..operators import state
from .landing import put_by_key


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def replace(spark: SparkSession, path: str, write) -> None:
    """Write to a folder beside ``path`` and move it into place.

    Readers see the old rows or the new ones; between the two moves, for a moment, there is nothing at ``path``, and a reader
    that comes then fails and has to come again. If the second move fails, the first is taken back. A table that must never be
    away is kept with ``publish`` and read through ``published``.
    """
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    write(beside)
    fs, target = file_system(spark, path)
    made, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside, f"{beside}.old"))
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"could not move {path} away")
    if not fs.rename(made, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"could not move {beside} to {path}")
    fs.delete(old, True)


def publish(spark: SparkSession, path: str, write) -> str:
    """Write a new version below ``path`` and let it count by creating its mark, which is one step; the version's name."""
    fs, base = file_system(spark, path)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(base)
    version = f"v{max([int(v[1:]) for v in _marks(spark, path)], default=0) + 1:012d}"
    write(f"{path}/{version}")
    if not fs.createNewFile(Path(f"{path}/{version}.current")):
        raise OSError(f"{version} of {path} is there already")
    return version


def published(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest version that counts."""
    marks = _marks(spark, path)
    return f"{path}/{max(marks)}" if marks else None


def _marks(spark: SparkSession, path: str) -> list[str]:
    found = file_system(spark, path)[0].globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v*.current"))
    return [str(s.getPath().getName()).removesuffix(".current") for s in found or []]


def json_snapshot(rows: DataFrame, path: str) -> None:
    """Records with their fields in the order of names."""
    rows = rows.select(*sorted(rows.columns))
    replace(rows.sparkSession, path, lambda p: rows.write.json(p))


def csv_snapshot(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    rows = rows.select(*columns) if columns else rows
    replace(rows.sparkSession, path, lambda p: rows.write.option("header", True).csv(p))


def parquet_snapshot(rows: DataFrame, path: str) -> None:
    replace(rows.sparkSession, path, lambda p: rows.write.parquet(p))


def pool_with_mirror(rows: DataFrame, path: str, mirror: str, key: str = "paper_id") -> None:
    """A pool's records, and its ids as a table of one column."""
    json_snapshot(rows, path)
    csv_snapshot(rows.select(key), mirror)


def upsert(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Put rows into a keyed snapshot; the rows have ord, of one key the last counts."""
    spark = rows.sparkSession
    fs, p = file_system(spark, path)
    fresh = state.latest(rows, keys, ["ord"]).drop("ord")
    all_rows = state.upsert(spark.read.parquet(path), rows, keys) if fs.exists(p) else fresh
    parquet_snapshot(all_rows.orderBy(*keys), path)


def remove(gone: DataFrame, path: str, keys: list[str], drop_empty: bool = False) -> None:
    spark = gone.sparkSession
    left = state.delete(spark.read.parquet(path), gone, keys)
    if drop_empty and left.isEmpty():
        fs, p = file_system(spark, path)
        fs.delete(p, True)
        return
    parquet_snapshot(left, path)


def append_log(events: DataFrame, path: str) -> None:
    """Events with an id that depends on what they say and not on when."""
    ident = jsonx.event_id([c for c in events.columns if c != "timestamp"])
    events.withColumn("event_id", ident).write.mode("append").json(path)


def preserve(contents: DataFrame, path: str) -> None:
    """(name, content) kept under their SHA-256; what is there already is not written again."""
    spark = contents.sparkSession
    rows = contents.withColumn("sha256", F.sha2(F.col("content").cast("binary"), 256)).dropDuplicates(["sha256"])
    fs, p = file_system(spark, path)
    if fs.exists(p):
        rows = rows.join(spark.read.parquet(path).select("sha256"), "sha256", "left_anti")
    rows.write.mode("append").parquet(path)


def per_id(rows: DataFrame, path: str, key: str = "paper_id") -> None:
    """A folder for each id, which one task writes; rows with an error are not written."""
    good = rows.where(F.col("error").isNull()).drop("error")
    replace(rows.sparkSession, path, lambda p: put_by_key(good, p, key))


def sidecar(files: DataFrame, version: str) -> DataFrame:
    """(path, sha256, version): what outputs were made from."""
    return files.select("path", "sha256", F.lit(version).alias("version"))


def sidecar_valid(now: DataFrame, written: DataFrame, version: str) -> DataFrame:
    """(valid): whether the files are those of the sidecar, with its version."""
    w = written.select(F.col("path").alias("_path"), F.col("sha256").alias("_sha"), "version")
    rows = now.join(w, now["path"] == w["_path"], "full")
    return rows.agg(F.coalesce(F.bool_and(F.col("sha256").eqNullSafe(F.col("_sha")) & (F.col("version") == version)), F.lit(False)).alias("valid"))


def markdown_table(rows: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """(text): rows as a Markdown table, for reports of a bounded number of rows."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in columns]), F.lit(" |"))
    body = rows.agg(F.array_sort(F.collect_list(F.struct(*order, line.alias("_line"))))["_line"].alias("l"))
    return body.select(F.concat(F.lit(f"| {' | '.join(columns)} |\n|{'---|' * len(columns)}\n"), F.array_join("l", "\n")).alias("text"))

"""Tables with one row a key, kept in buckets, of which a change rewrites only those that it touches.

A key's bucket is a hash of it. The table is a list of folders, one a bucket, and a change writes new folders for its buckets beside
the old ones and then a new list, which counts from the moment its mark is there (``sinks.publish``). Readers see one list or the
next; a change that fails leaves the one before it. Folders that no list names go with ``expire``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state
from . import sinks

BUCKETS = 64


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _listed(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """The number of buckets and the folder of each that has rows; (0, {}) where there is no table."""
    now = sinks.published(spark, path)
    if now is None:
        return 0, {}
    rows = spark.read.schema("buckets int, bucket int, folder string").json(now).collect()  # one row a bucket
    return rows[0].buckets, {r.bucket: r.folder for r in rows if r.bucket >= 0}


def _publish(spark: SparkSession, path: str, buckets: int, folders: dict[int, str]) -> None:
    rows = [(buckets, -1, "")] + [(buckets, b, f) for b, f in sorted(folders.items())]
    sinks.publish(spark, path, lambda p: spark.createDataFrame(rows, "buckets int, bucket int, folder string").coalesce(1).write.json(p))


def _rewritten(spark: SparkSession, path: str, rows: DataFrame, buckets: int, folders: dict[int, str], touched: list[int], keys: list[str]) -> None:
    """A new list in which the touched buckets hold ``rows``; a bucket without rows is left out."""
    run = f"{path}/data/{uuid.uuid4().hex}"
    rows.withColumn("_bucket", _bucket(keys, buckets)).repartition("_bucket").write.partitionBy("_bucket").parquet(run)
    fs, base = sinks.file_system(spark, run)
    made = {int(s.getPath().getName().split("=")[1]): f"{run}/{s.getPath().getName()}" for s in fs.listStatus(base) if "=" in s.getPath().getName()}
    _publish(spark, path, buckets, {b: f for b, f in folders.items() if b not in touched} | made)


def _without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among those that go; null is a key like any other."""
    named = gone.select(*(F.col(k).alias(f"_gone_{i}") for i, k in enumerate(keys)))
    same = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(named[f"_gone_{i}"]) for i, k in enumerate(keys)))
    return rows.join(named, same, "left_anti")


def _read(spark: SparkSession, folders: list[str], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert(rows: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> list[int]:
    """Put rows into the table; they have ``ord``, of one key the last counts. The buckets that were written anew.

    The number of buckets is that of the table's first change. Columns are those of the first change too.
    """
    spark = rows.sparkSession
    have, folders = _listed(spark, path)
    buckets = have or buckets
    fresh = state.latest(rows, keys, ["ord"]).drop("ord")
    touched = sorted(r[0] for r in fresh.select(_bucket(keys, buckets)).distinct().collect())  # no more than there are buckets
    if not touched:
        return []
    old = _read(spark, [folders[b] for b in touched if b in folders], fresh.schema)
    kept = _without(old, fresh, keys).select(*fresh.columns)
    _rewritten(spark, path, kept.unionByName(fresh), buckets, folders, touched, keys)
    return touched


def remove(gone: DataFrame, path: str, keys: list[str], schema) -> list[int]:
    """Take the rows of these keys out of the table; the buckets that were written anew."""
    spark = gone.sparkSession
    buckets, folders = _listed(spark, path)
    if not buckets:
        return []
    touched = sorted(b for b in (r[0] for r in gone.select(_bucket(keys, buckets)).distinct().collect()) if b in folders)
    if touched:
        left = _without(_read(spark, [folders[b] for b in touched], schema), gone, keys)
        _rewritten(spark, path, left, buckets, folders, touched, keys)
    return touched


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    return _read(spark, sorted(_listed(spark, path)[1].values()), schema)


def expire(spark: SparkSession, path: str) -> int:
    """Delete the folders of runs that the newest list does not name; how many. Readers of an older list fail from then on."""
    named = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for f in _listed(spark, path)[1].values()}
    fs, base = sinks.file_system(spark, f"{path}/data")
    runs = [s.getPath() for s in fs.listStatus(base)] if fs.exists(base) else []
    gone = [p for p in runs if p.getName() not in named]
    for p in gone:
        fs.delete(p, True)
    return len(gone)

"""Folders that all machines share, and small files put there."""

from __future__ import annotations

import contextlib
import itertools
import math
import re
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Files that a task writes.
FILES = 500


def folder(spark: SparkSession, what: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a master that is this one process may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="litquarry-")
        spark.conf.set("spark.checkpoint.dir", base)
    return whole(spark, base) + f"/litquarry/{what}-{uuid.uuid4().hex}"


def whole(spark: SparkSession, path: str) -> str:
    """A path with its file system, as Spark would take it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return re.sub("^file:/(?!/)", "file:///", p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()).rstrip("/")


def durable(df: DataFrame, what: str = "step") -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: the lineage ends there, and a lost executor takes nothing with it."""
    path = folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, each: int, *keys: str, count: Callable[[], int] | None = None) -> DataFrame:
    """The rows dealt out so that a task has about ``each`` of them, by ``keys`` if there are any.

    For tables whose rows grow or cost much where they are used: a file of few bytes is one task for Spark, however many rows it has. The
    rows are counted, so they are best those of a table; else ``count`` tells how many there are.
    """
    n = math.ceil((count or rows.count)() / each)
    return rows.repartition(n, *keys) if n > 1 else rows


def put_each(rows: DataFrame, path: str) -> None:
    """(name, content) as a file for each row, of as many tasks as the rows ask for.

    Files go to any folder that ``pyarrow.fs`` opens. A task that runs again writes the same files. Spark's own writers take tens of milliseconds
    for a local file, most of it for its permissions.
    """

    def write(batches):
        fs, base = pyarrow.fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                with fs.open_output_stream(f"{base}/{name}") as out:
                    out.write(content.as_py())
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    path = _made(rows.sparkSession, path)
    rows = spread(rows.select(F.col("name").cast("string"), F.col("content").cast("binary")), FILES)
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def put_by_key(rows: DataFrame, path: str, key: str) -> None:
    """The rows as Parquet in a folder for each value of ``key``, which one task writes; for the rest as ``put_each``."""

    def named(value) -> str:  # as Spark writes values in the names of folders
        return "__HIVE_DEFAULT_PARTITION__" if value in (None, "") else re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", str(value))

    def write(batches):
        fs, base = pyarrow.fs.FileSystem.from_uri(path)
        now, out = None, contextlib.ExitStack()
        for batch in batches:
            at, rest = 0, batch.drop_columns([key])
            for name, same in itertools.groupby(map(named, batch.column(key).to_pylist())):
                n = len(list(same))
                if now is None or name != now[0]:
                    out.close()
                    here = f"{base}/{key}={name}"
                    fs.create_dir(here, recursive=True)
                    now = name, out.enter_context(pq.ParquetWriter(f"{here}/part-{TaskContext.get().partitionId():05d}.parquet", rest.schema, filesystem=fs))
                now[1].write_batch(rest.slice(at, n))
                at += n
        out.close()
        yield pa.RecordBatch.from_pydict({"n": [1]})

    path = _made(rows.sparkSession, path)
    spread(rows, FILES, key).sortWithinPartitions(key).mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _made(spark: SparkSession, path: str) -> str:
    """The path with its file system, once its folder is there."""
    fs, base = pyarrow.fs.FileSystem.from_uri(path := whole(spark, path))
    fs.create_dir(base, recursive=True)
    return path


def numbered(rows: DataFrame, order: list, name: str = "nth") -> DataFrame:
    """The rows with their place, from 0, in one order of all of them; no task sees more than its range.

    Rows are dealt to ranges, sorted there and written with the number of their range and their place in it; the sizes of the ranges, one
    number each, give what comes before them. Ties are in no particular order, so an order that is to be told apart ends with a key.
    """
    row, part = F.monotonically_increasing_id().alias("_row"), F.spark_partition_id().alias("_part")
    dealt = durable(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", part, row), "ranges")
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each range, as many as there are shuffle partitions
    places = dealt.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    # the lower 33 bits of Spark's increasing ids count the rows of a task
    return places.withColumn(name, F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_row", "_before")


def put(spark: SparkSession, path: str, content: str | bytes) -> None:
    """A small file from the driver, as for settings or a list of sources."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(content.encode() if isinstance(content, str) else content))
    finally:
        out.close()

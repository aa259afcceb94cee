"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A path without a scheme is one of Spark's default file system, and is written out as such, since other libraries would
    take it for a local one. Where the session names none, a temporary folder of this machine is set, but only if the master
    runs everything in this one process (as in tests); a cluster's machines would not share it, so there it is an error.
    """
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        there = "file://" + tempfile.mkdtemp(prefix="litquarry-")
        spark.conf.set("spark.checkpoint.dir", there)
    path = spark._jvm.org.apache.hadoop.fs.Path(there)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/(?!/)", "file:///", whole).rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/litquarry/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str = "cut") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    The lineage ends there, each row is computed once, and a lost executor takes nothing with it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place_of(df: DataFrame, column: str) -> int:
    """The place of a column whose name may be given in other case, as Spark takes names."""
    names = df.columns
    return names.index(column) if column in names else [c.lower() for c in names].index(column.lower())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_volume(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Rows and UTF-8 bytes of a text column: two numbers, whatever the table's size."""
    row = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()
    return int(row[0]), int(row[1])


def groups_for(volume: int, target: int, least: int = 1) -> int:
    """How many groups of about ``target`` a volume needs."""
    return max(least, math.ceil(volume / max(1, target)))


def fresh(columns: list[str], name: str) -> str:
    """The name, with underscores in front until no column has it (case does not tell columns apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def one_of_each(rows: DataFrame, roots: DataFrame, node: str, id_col: str) -> DataFrame:
    """The rows, numbered by the column ``node``, without those that are not the first of their component in ``roots`` (node, root).

    The first is the one with the smallest id, null ids last; of rows with equal ids the one with the smallest number.
    """
    ids = rows.select(F.col(node).alias("node"), F.col(id_col).cast("long").alias("id"))
    members = roots.join(ids, "node").select("root", F.struct(F.col("id").isNull().alias("null"), "id", "node").alias("row"))
    first = cut(members.groupBy("root").agg(F.min("row").alias("first")), "firsts")
    gone = members.join(first, "root").where("row.node <> first.node").select(F.col("row.node").alias(node))
    return rows.join(gone, node, "left_anti")

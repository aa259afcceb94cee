"""URL filters as a sort-merge range join, in DataFrame operations only.

A host is written with its labels reversed (``blog.example.com`` is ``com.example.blog.``), so a rule for a host and its
subdomains is the interval of keys that begin with the rule's key. The distinct hosts and the rules are sorted together
by key; a sweep carries the stack of nested rules that are open at each point, and a host takes from the last rule before
it those members of the stack whose interval still holds it. Paths are compared on the stack, row by row.

The sweep runs once per cell. A cell is a pair of first label and salt: hosts are dealt to the salts by hash and the rules
of a label are copied to every salt, so a label that most hosts share is swept by many tasks. Only distinct hosts are
sorted, and the join back to the rows is an equi-join on the host, which adaptive execution may split.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule; an empty host matches no
rule; of several fitting rules the longest (host and path together) wins, of equally long ones the smaller text; repeated
rules count once; of rules of one text with several verdicts the smaller verdict counts; very long urls and hosts are judged whole; rows repeat in the result as they do in the input; without rules every verdict is the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

#: (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Cells to which the hosts of one first label are dealt, at least; with more shuffle partitions there are as many cells.
SALTS = 64
DEFAULT = "allow"
STACK = "array<struct<n:int,rule:string,key:string,path:string,verdict:string>>"


def url_host(url: Column) -> Column:
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*", 0)
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def url_path(url: Column) -> Column:
    at = F.instr(url, "://")
    path = F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.coalesce(at, F.lit(0)) > 0, path).otherwise("")


def host_key(host: Column) -> Column:
    """Labels reversed, each followed by a dot; empty for an empty host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def rules_frame(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(RULES if rules is None else rules, "verdict string, host string, path string")


def _stacks(rules: DataFrame) -> DataFrame:
    """Each distinct rule host's key with the stack of rules open there: its own and those of the hosts around it."""
    mine = rules.select(
        host_key(F.col("host")).alias("key"),
        F.struct((-F.length("host") - F.length("path")).alias("n"), F.concat("host", "path").alias("rule"), host_key(F.col("host")).alias("key"), "path", "verdict").alias("r"),
    ).where("key != ''").distinct()
    keys = mine.select("key").distinct()
    labels = F.split(F.col("key"), r"\.", -1)
    around = keys.select("key", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit(".")))).alias("open"))
    return around.join(mine.withColumnRenamed("key", "open"), "open").groupBy("key").agg(F.sort_array(F.collect_list("r")).alias("stack"))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT, salts: int | None = None) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict."""
    salts = salts or max(SALTS, shuffle_partitions(pages.sparkSession))
    rows = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    hosts = rows.where("host != ''").select("host").distinct().select("host", host_key(F.col("host")).alias("key"))
    label = F.substring_index(F.col("key"), ".", 1)
    points = hosts.select(label.alias("label"), F.pmod(F.xxhash64("key"), F.lit(salts)).alias("salt"), "key", F.lit(1).alias("turn"), "host", F.lit(None).cast(STACK).alias("stack"))
    opens = _stacks(rules).select(label.alias("label"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), "key", F.lit(0).alias("turn"), F.lit(None).cast("string").alias("host"), F.col("stack").cast(STACK).alias("stack"))
    sweep = Window.partitionBy("label", "salt").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = points.unionByName(opens).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("turn = 1")
    open_now = swept.select("host", F.filter("stack", lambda r: F.startswith(F.col("key"), r["key"])).alias("stack")).where(F.size("stack") > 0)
    fits = F.get(F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    return rows.join(open_now, "host", "left").withColumn("hit", fits).select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))


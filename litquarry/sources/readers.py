"""Readers of landed files. Where a thing may have several shapes, it is read as text and taken apart by its shape."""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions import text


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something matches a path, on any file system that Spark reads."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def json_documents(spark: SparkSession, path: str, schema: StructType | str, required: bool = False) -> DataFrame:
    """Whole files as records. Without ``required`` a missing path is an empty table and a broken file a row of nulls."""
    if not required and not exists(spark, path):
        return spark.createDataFrame([], schema if isinstance(schema, StructType) else StructType.fromDDL(schema))
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST" if required else "PERMISSIVE")


def json_directory(spark: SparkSession, path: str, schema: StructType | str, key: str) -> DataFrame:
    """Records of all files of a directory; a record without its key takes the file's name, of a repeated key the last file counts."""
    if not exists(spark, f"{path}/*.json"):
        return json_documents(spark, f"{path}/*.json", schema)
    rows = spark.read.schema(schema).json(f"{path}/*.json", multiLine=True, mode="DROPMALFORMED").select("*", F.col("_metadata.file_name").alias("_file"))
    rows = rows.withColumn(key, F.coalesce(F.col(key), F.regexp_replace("_file", r"\.json$", "")))
    rest = [c for c in rows.columns if c not in (key, "_file")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "_file").alias("_r")).select(key, "_r.*")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(name, text, usable) of whole text files; usable ones are not blank."""
    rows = spark.read.text(path, wholetext=True).select(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]+$", "").alias("name"), F.col("value").alias("text"))
    return rows.withColumn("usable", text.strip("text") != "")


def csv_rows(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Rows of texts. With ``key``, only those where it is not blank. A file without rows is an error."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if key is not None:
        return rows.where(F.trim(key) != "")
    if rows.isEmpty():
        raise ValueError(f"{path} has no rows")
    return rows


def ids(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.trim(key).alias(key)).where(F.col(key) != "").distinct()


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, sha256, modified) of files, for signatures and sidecars."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"))


def newest(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The record of the file that was changed last."""
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.struct("*").alias("r"), F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_name")).alias("at"))
    return rows.agg(F.max_by("r", "at").alias("r")).where("r is not null").select("r.*")


def images(spark: SparkSession, path: str, most: int = 5 << 20) -> DataFrame:
    """(path, name) of landed images of a permitted size and kind; the name is made from the content."""
    kind = F.lower(F.regexp_extract("path", r"\.(png|jpe?g|gif|svg|webp)$", 1))
    rows = spark.read.format("binaryFile").load(path).where(F.col("length").between(1, most))
    return rows.withColumn("kind", kind).where("kind <> ''").select("path", F.concat(F.sha2("content", 256), F.lit("."), F.replace("kind", F.lit("jpeg"), F.lit("jpg"))).alias("name"))


def _field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "string")


def pool(records: DataFrame, column: str = "value") -> DataFrame:
    """(paper_id, abstract, record, ord) of a pool written as a list of records, a map of records or a map of abstracts.

    A list under ``papers`` is taken like a list by itself. An item of a list without an id raises.
    """
    rows = records.select(F.parse_json(column).alias("_v"))
    rows = rows.select(F.coalesce(F.try_variant_get("_v", "$.papers", "variant"), "_v").alias("_v"))
    is_list = F.startswith(F.schema_of_variant("_v"), F.lit("ARRAY"))
    listed = rows.where(is_list).select(F.posexplode(F.variant_get("_v", "$", "array<variant>")).alias("ord", "record"))
    listed = listed.select(F.when(F.assert_true(F.coalesce(_field(F.col("record"), "arxiv_id"), F.lit("")) != "", "a paper without an id").isNull(), _field(F.col("record"), "arxiv_id")).alias("paper_id"), _field(F.col("record"), "abstract").alias("abstract"), F.to_json("record").alias("record"), "ord")
    entries = F.map_entries(F.variant_get("_v", "$", "map<string,variant>"))
    mapped = rows.where(~is_list).select(F.posexplode(entries).alias("ord", "e"))
    plain = F.startswith(F.schema_of_variant(F.col("e.value")), F.lit("STRING"))
    mapped = mapped.select(F.col("e.key").alias("paper_id"), F.when(plain, F.try_variant_get(F.col("e.value"), "$", "string")).otherwise(_field(F.col("e.value"), "abstract")).alias("abstract"), F.to_json("e.value").alias("record"), "ord")
    return listed.unionByName(mapped)


def page_nodes(records: DataFrame, column: str = "value") -> DataFrame:
    """(id, node) of page nodes written flat or below ``nodes``; node is JSON."""
    fields = F.from_json(column, "map<string,string>")
    inner = F.when(F.map_contains_key(fields, "nodes"), F.from_json(F.try_element_at(fields, F.lit("nodes")), "map<string,string>")).otherwise(fields)
    return records.select(F.explode(inner).alias("id", "node"))


@dataclass
class _Page(InputPartition):
    url: str
    ord: int


class _Requests(DataSourceReader):
    def __init__(self, options: dict):
        base, queries = options["endpoint"], json.loads(options.get("queries", "[]"))
        keep = {k[6:]: v for k, v in options.items() if k.startswith("param.")}
        name = options.get("queryparameter", "query")
        self.pages = [_Page(f"{base}?{urllib.parse.urlencode(keep | {name: q})}", i) for i, q in enumerate(queries)] or [_Page(base, 0)]
        self.timeout, self.retries, self.header = float(options.get("timeout", 30)), int(options.get("retries", 3)), json.loads(options.get("headers", "{}"))

    def partitions(self):
        return self.pages

    def read(self, partition):
        error = None
        for _ in range(self.retries):
            try:
                request = urllib.request.Request(partition.url, headers=self.header)
                with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    yield partition.ord, partition.url, answer.status, answer.read().decode("utf-8", "replace"), None
                    return
            except urllib.error.HTTPError as e:
                error = (e.code, str(e))
                if e.code in (400, 404, 410, 422):
                    break
            except OSError as e:
                error = (None, str(e))
        yield partition.ord, partition.url, error[0], None, error[1]


class HttpJsonSource(DataSource):
    """Answers of a JSON service, one task and row per query: ``spark.read.format("litquarry-http")``.

    Options: endpoint, queries (a JSON list), queryparameter, param.<name>, headers (JSON), timeout, retries. Answers are
    meant to be landed first and then read with the readers above, so that a run does not depend on the service.
    """

    @classmethod
    def name(cls):
        return "litquarry-http"

    def schema(self):
        return "ord int, url string, status int, body string, error string"

    def reader(self, schema):
        return _Requests(self.options)


def availability(status: Column) -> Column:
    """What an answer says of a text: available, unavailable for good, or to be tried again."""
    return F.when(status.between(200, 299), "available").when(status.isin(400, 404, 410, 422), "unavailable").otherwise("transient")


def _listed(value: Column) -> Column:
    """The items of a JSON list as JSON texts (plain texts without quotes), null for anything else."""
    return F.when(F.startswith(F.ltrim(value), F.lit("[")), F.from_json(value, "array<string>"))


def paper_ids(records: DataFrame, column: str, within: str) -> DataFrame:
    """(ord, paper_id, record) of a list of ids or of records, a map by id, or either of them below the field ``within``.

    An item of a list that is neither an id nor a record with one raises; so does a value that is neither list nor map.
    """
    whole = F.col(column)
    inner = F.coalesce(F.get_json_object(whole, f"$.{within}"), whole)
    listed, mapped = _listed(inner), F.from_json(inner, "map<string,string>")
    good = F.assert_true(listed.isNotNull() | mapped.isNotNull(), "papers are a list or a map")
    items = F.when(listed.isNotNull(), F.transform(listed, lambda x: F.struct(_identity(x).alias("paper_id"), x.alias("record")))).otherwise(F.transform(F.map_entries(mapped), lambda e: F.struct(e["key"].alias("paper_id"), e["value"].alias("record"))))
    rows = records.select(F.when(good.isNull(), items).alias("_items")).select(F.posexplode("_items").alias("ord", "_i"))
    checked = F.assert_true(F.coalesce(F.col("_i.paper_id"), F.lit("")) != "", "a paper without an id")
    return rows.select("ord", F.when(checked.isNull(), F.col("_i.paper_id")).alias("paper_id"), F.col("_i.record").alias("record"))


def _identity(item: Column) -> Column:
    return F.when(F.startswith(F.ltrim(item), F.lit("{")), F.get_json_object(item, "$.arxiv_id")).otherwise(item)


def promoted(records: DataFrame, column: str = "value") -> DataFrame:
    """(ord, paper_id, record) of promoted papers: an object with a list ``promoted_papers``, or the list or map by itself."""
    return paper_ids(records, column, "promoted_papers")


def seed_pool(records: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Ids of a seed pool (ord, paper_id, record), and one row (total_kept) with the count that it declares."""
    return paper_ids(records, column, "papers"), records.select(F.get_json_object(column, "$.total_kept").try_cast("long").alias("total_kept"))


def evidence_claims(records: DataFrame, key: str = "paper", column: str = "value") -> DataFrame:
    """(paper, claims): the claims of verified evidence as JSON texts. Null says that there is no such list, an empty array that it is empty."""
    return records.select(key, _listed(F.get_json_object(column, "$.claims")).alias("claims"))

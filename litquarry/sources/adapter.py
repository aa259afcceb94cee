"""The test tables as the relations that the operators work on.

``REL`` says the same in SQL, so that a query's SQL starts from the tables and not from what Spark made of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .landing import durable, spread

#: Fields of an evidence record that hold concepts, in the order in which they are read, and the slot of each.
FIELDS = [("methods", "method"), ("datasets", "method"), ("benchmarks", "result"), ("baselines", "result"), ("metrics", "result"), ("topic_tags", "abstract"), ("reader_needed_concepts", "reader_needed"), ("mentioned_entities", "mention")]


#: Variants of a concept; with so many the mentions of one do not fill every signal.
VARIANTS = 23
#: Parts whose variants a task makes.
PARTS = 10_000
#: Claims of a task that works on whole papers.
CLAIMS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, d: str) -> DataFrame:
    year = F.lit(2018) + F.col("doc_id") % 9
    ident = F.format_string("%02d%02d.%05d", year - 2000, 1 + F.col("doc_id") % 12, F.col("doc_id"))
    return table(spark, d, "documents").select("doc_id", ident.alias("paper_id"), year.cast("int").alias("year"), (F.col("n_chars") % 1000).alias("citations"), F.col("text").alias("abstract"), "source", "lang")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    line, part = table(spark, d, "lineitem"), table(spark, d, "part")
    return line.join(part, line["l_partkey"] == part["p_partkey"]).withColumn("raw", F.concat(F.concat_ws(" ", "p_name", "p_brand"), F.lit(" v"), (F.col("l_suppkey") % VARIANTS).cast("string")))


def mention_rows(spark: SparkSession, d: str) -> DataFrame:
    """(paper, title, importance, field, ord, raw): one row per item of a field of an evidence record."""
    rows = _lines(spark, d).withColumn("title", F.min("raw").over(Window.partitionBy("l_orderkey")))
    return rows.select(F.col("l_orderkey").cast("string").alias("paper"), "title", (1 + F.col("l_orderkey") % 5).cast("int").alias("importance"), ((F.col("l_linenumber") + F.col("l_partkey")) % 8).cast("int").alias("field"), F.concat_ws("|", F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lpad(F.col("l_partkey").cast("string"), 12, "0")).alias("ord"), "raw")


def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    """(file, ord, src, dst, type, confidence)"""
    kind = F.when(F.col("l_returnflag") == "A", "USES").when(F.col("l_returnflag") == "N", "MENTIONS").otherwise("EXTENDS")
    order = F.concat_ws("|", F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lpad(F.col("l_partkey").cast("string"), 12, "0"), F.lpad(F.col("l_suppkey").cast("string"), 12, "0"), "l_linestatus")
    return _lines(spark, d).select(F.col("l_orderkey").cast("string").alias("file"), order.alias("ord"), F.col("l_orderkey").cast("string").alias("src"), F.col("raw").alias("dst"), kind.alias("type"), F.when(F.col("l_linestatus") == "F", "high").otherwise("low").alias("confidence"))


def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    """(ord, id, type, display): papers, and a node for each part, so that ids repeat."""
    orders, part = table(spark, d, "orders"), table(spark, d, "part")
    own = orders.select(F.col("o_orderkey").alias("ord"), F.col("o_orderkey").cast("string").alias("id"), F.lit("Paper").alias("type"), F.concat(F.lit("paper "), F.col("o_orderkey").cast("string")).alias("display"))
    kind = F.when(F.col("p_size") % 2 == 0, "Method").otherwise("Dataset")
    parts = spread(part, PARTS, "p_partkey").withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1)))).withColumn("v", F.concat(F.lit(" v"), F.col("v").cast("string")))
    return own.unionByName(parts.select(F.col("p_partkey").alias("ord"), F.concat(F.concat_ws(" ", "p_name", "p_brand"), "v").alias("id"), kind.alias("type"), F.concat(F.initcap("p_name"), F.lit(" "), F.col("p_brand"), "v").alias("display")))


def known(spark: SparkSession, d: str) -> DataFrame:
    """(key, variant)"""
    v = (F.col("p_partkey") % VARIANTS).cast("string")
    return table(spark, d, "part").select(F.concat(F.concat_ws(" ", "p_name", "p_brand"), F.lit(" v"), v).alias("key"), F.upper(F.concat(F.concat_ws("-", "p_name", "p_brand"), F.lit(" v"), ((F.col("p_partkey") + 7) % VARIANTS).cast("string"))).alias("variant")).distinct()


def claims(spark: SparkSession, d: str) -> DataFrame:
    """(paper, nth, claim_id, node, lines, text, claim_type): grounded claims of verified evidence, dealt out by paper."""
    nth = F.row_number().over(Window.partitionBy("paper").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    lines = _lines(spark, d).withColumn("paper", F.col("l_orderkey").cast("string"))
    rows = spread(lines, CLAIMS, "paper", count=table(spark, d, "lineitem").count).withColumn("nth", nth)
    kind = F.when(F.col("l_returnflag") == "A", "method").when(F.col("l_returnflag") == "N", "result").otherwise("limitation")
    return rows.select("paper", "nth", F.concat(F.lit("c"), F.lpad(F.col("nth").cast("string"), 3, "0")).alias("claim_id"), F.concat(F.lit("s.0"), (1 + F.col("l_linenumber") % 4).cast("string")).alias("node"), F.array(F.col("l_linenumber") * 3, F.col("l_linenumber") * 3 + 1).alias("lines"), F.col("raw").alias("text"), kind.alias("claim_type"))


def by_paper(rows: DataFrame) -> DataFrame:
    """Claims written once and dealt out by paper, so that what is grouped, ranked or joined within papers is shuffled no more."""
    return spread(durable(rows, "claims"), CLAIMS, "paper")


def fragment_edges(rows: DataFrame) -> DataFrame:
    """(paper, nth, claim_id, src, dst, type, confidence, node, lines): edges proposed for the verified graph from ``claims``, some of them bad."""
    n = F.col("nth") + F.col("paper").cast("long")
    return rows.select(
        "paper", "nth",
        F.when(n % 11 != 0, F.col("claim_id")).alias("claim_id"),
        F.col("paper").alias("src"), F.col("text").alias("dst"),
        F.when(F.col("claim_type") == "method", "USES").when(F.col("claim_type") == "result", "HAS_RESULT").otherwise("GUESSES").alias("type"),
        F.when(n % 7 != 0, "verified").otherwise("weak").alias("confidence"),
        F.when(n % 13 != 0, F.col("node")).alias("node"),
        F.when(n % 5 == 0, F.transform("lines", lambda x: x + 1)).otherwise(F.col("lines")).alias("lines"),
    )


def fragment_nodes(rows: DataFrame) -> DataFrame:
    """(paper, id, type): nodes of each fragment of ``claims``; some endpoints are missing, some nodes are unused."""
    node = lambda ident, kind: F.struct(ident.alias("id"), F.lit(kind).alias("type"))
    other = F.when((F.col("nth") + F.col("paper").cast("long")) % 6 != 0, node(F.col("text"), "Concept"))
    spare = F.when(F.col("nth") == 1, node(F.concat(F.lit("spare "), F.col("text")), "Concept"))
    return rows.select("paper", F.inline(F.array_compact(F.array(node(F.col("paper"), "Paper"), other, spare)))).distinct()


def markdown(spark: SparkSession, d: str) -> DataFrame:
    """(paper, text): a conversation as a text with headings of three levels."""
    turns = table(spark, d, "conversations").where("conv_id is not null and turn is not null")
    part = F.concat(F.when(F.col("turn") == 0, F.concat(F.lit("# conv "), F.col("conv_id").cast("string"), F.lit("\n\n"))).otherwise(""), F.lit("## "), F.coalesce("role", F.lit("none")), F.lit("\n\n### turn "), F.col("turn").cast("string"), F.lit("\n\n"), F.coalesce("text", F.lit("")))
    return turns.groupBy(F.col("conv_id").alias("paper")).agg(F.array_sort(F.collect_list(F.struct("turn", part.alias("part")))).alias("parts")).select("paper", F.array_join(F.transform("parts", lambda p: p["part"]), "\n").alias("text"))


def cache_puts(spark: SparkSession, d: str) -> DataFrame:
    """(key, fetched_at, seq, payload, status)"""
    return table(spark, d, "events").select(F.col("user_id").alias("key"), F.col("ts").alias("fetched_at"), F.col("event_id").alias("seq"), F.col("props").alias("payload"), F.col("event_type").alias("status"))


# Names of the fields in SQL order; numbers of fields are those of FIELDS.
_SLOTS = "CASE WHEN field <= 1 THEN 'method' WHEN field <= 4 THEN 'result' WHEN field = 5 THEN 'abstract' WHEN field = 6 THEN 'reader_needed' ELSE 'mention' END"
_NORM = r"regexp_replace(regexp_replace(replace(lower(trim({0})), '-', ' '), '\s+', ' ', 'g'), '[.,;:!?]+$', '')"

REL: dict[str, str] = {
    "papers": "SELECT doc_id, printf('%02d%02d.%05d', 18 + doc_id % 9, 1 + doc_id % 12, doc_id) AS paper_id, 2018 + doc_id % 9 AS year, n_chars % 1000 AS citations, text AS abstract, source, lang FROM documents",
    "li": "SELECT *, p_name || ' ' || p_brand || ' v' || (l_suppkey % 23) AS raw FROM lineitem JOIN part ON l_partkey = p_partkey",
    "mention_rows": "SELECT cast(l_orderkey AS VARCHAR) AS paper, min(raw) OVER (PARTITION BY l_orderkey) AS title, 1 + l_orderkey % 5 AS importance, (l_linenumber + l_partkey) % 8 AS field, lpad(cast(l_linenumber AS VARCHAR), 3, '0') || '|' || lpad(cast(l_partkey AS VARCHAR), 12, '0') AS ord, raw FROM li",
    "m0": f"SELECT *, {_NORM.format('raw')} AS norm, {_SLOTS} AS slot, regexp_extract_all({_NORM.format('title')}, '\\w+') AS tt, regexp_extract_all({_NORM.format('raw')}, '\\w+') AS ct FROM mention_rows",
    "mentions": "SELECT paper, importance, field, ord, raw, norm, slot, 0 AS extra FROM m0 WHERE norm <> '' UNION ALL SELECT paper, importance, field, ord, raw, norm, 'title', 1 FROM m0 WHERE norm <> '' AND len(ct) > 0 AND list_has_all(tt, ct)",
    "edges": "SELECT cast(l_orderkey AS VARCHAR) AS file, lpad(cast(l_linenumber AS VARCHAR), 3, '0') || '|' || lpad(cast(l_partkey AS VARCHAR), 12, '0') || '|' || lpad(cast(l_suppkey AS VARCHAR), 12, '0') || '|' || l_linestatus AS ord, cast(l_orderkey AS VARCHAR) AS src, raw AS dst, CASE l_returnflag WHEN 'A' THEN 'USES' WHEN 'N' THEN 'MENTIONS' ELSE 'EXTENDS' END AS type, CASE WHEN l_linestatus = 'F' THEN 'high' ELSE 'low' END AS confidence FROM li",
    "nodes": "SELECT o_orderkey AS ord, cast(o_orderkey AS VARCHAR) AS id, 'Paper' AS type, 'paper ' || o_orderkey AS display FROM orders UNION ALL SELECT p_partkey, p_name || ' ' || p_brand || ' v' || v, CASE WHEN p_size % 2 = 0 THEN 'Method' ELSE 'Dataset' END, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' ' || p_brand || ' v' || v FROM part, range(23) t(v)",
    "known": "SELECT DISTINCT p_name || ' ' || p_brand || ' v' || (p_partkey % 23) AS key, upper(p_name || '-' || p_brand || ' v' || ((p_partkey + 7) % 23)) AS variant FROM part",
    "claims": "SELECT cast(l_orderkey AS VARCHAR) AS paper, nth, 'c' || lpad(cast(nth AS VARCHAR), 3, '0') AS claim_id, 's.0' || (1 + l_linenumber % 4) AS node, [l_linenumber * 3, l_linenumber * 3 + 1] AS lines, raw AS text, CASE l_returnflag WHEN 'A' THEN 'method' WHEN 'N' THEN 'result' ELSE 'limitation' END AS claim_type FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS nth FROM li)",
    "fragment_edges": "SELECT paper, nth, CASE WHEN (nth + cast(paper AS BIGINT)) % 11 <> 0 THEN claim_id END AS claim_id, paper AS src, text AS dst, CASE claim_type WHEN 'method' THEN 'USES' WHEN 'result' THEN 'HAS_RESULT' ELSE 'GUESSES' END AS type, CASE WHEN (nth + cast(paper AS BIGINT)) % 7 <> 0 THEN 'verified' ELSE 'weak' END AS confidence, CASE WHEN (nth + cast(paper AS BIGINT)) % 13 <> 0 THEN node END AS node, CASE WHEN (nth + cast(paper AS BIGINT)) % 5 = 0 THEN list_transform(lines, lambda x: x + 1) ELSE lines END AS lines FROM claims",
    "fragment_nodes": "SELECT DISTINCT paper, paper AS id, 'Paper' AS type FROM claims UNION SELECT paper, text, 'Concept' FROM claims WHERE (nth + cast(paper AS BIGINT)) % 6 <> 0 UNION SELECT paper, 'spare ' || text, 'Concept' FROM claims WHERE nth = 1",
    "markdown": "SELECT conv_id AS paper, string_agg(CASE WHEN turn = 0 THEN '# conv ' || conv_id || chr(10) || chr(10) ELSE '' END || '## ' || coalesce(role, 'none') || chr(10) || chr(10) || '### turn ' || turn || chr(10) || chr(10) || coalesce(text, ''), chr(10) ORDER BY turn) AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id",
    "cache_puts": "SELECT user_id AS key, ts AS fetched_at, event_id AS seq, props AS payload, event_type AS status FROM events",
}
_NEEDS = {"mention_rows": ["li"], "m0": ["li", "mention_rows"], "mentions": ["li", "mention_rows", "m0"], "edges": ["li"], "claims": ["li"], "fragment_edges": ["li", "claims"], "fragment_nodes": ["li", "claims"]}


def sql(body: str, *relations: str, **more: str) -> str:
    """``body`` after the definitions of the relations it names and of further ones."""
    names = list(dict.fromkeys(x for r in relations for x in [*_NEEDS.get(r, []), r]))
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in [*[(n, REL[n]) for n in names], *more.items()]) + "\n" + body if names or more else body


NORM_SQL = _NORM

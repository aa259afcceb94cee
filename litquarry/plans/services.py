"""Queries over landed answers of services, request plans, tools and SQL functions; answers are made from the keys of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import services as V
from ..sources.adapter import NORM_SQL, table
from .registry import query


def _answers(spark, d, body) -> DataFrame:
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_suppkey").cast("string").alias("s"))
    return rows.select("k", F.concat(F.lit("q"), "s").alias("query"), body.alias("body"))


def _paper(ident, *more) -> F.Column:
    """JSON of a paper as a citation service writes it."""
    return F.concat(F.lit('{"paperId":"S'), ident, F.lit('","externalIds":{"ArXiv":"a'), ident, F.lit('"},"title":"T'), ident, F.lit('","citationCount":'), ident, *[F.lit(x) for x in more], F.lit("}"))




@query("service_search_items", "SELECT 'q' || s_suppkey AS query, o AS ord, 'a' || (s_suppkey + o) AS paper_id, s_suppkey + o AS citation_count FROM supplier, (VALUES (0), (1)) AS t(o)")
def _(spark, d):
    from ..operators.search import paper_rows

    body = F.concat(F.lit('{"total":2,"data":['), _paper(F.col("s")), F.lit(","), _paper((F.col("k") + 1).cast("string")), F.lit("]}"))
    items = V.search_items(_answers(spark, d, body))
    rows = paper_rows(items.select(F.struct("query", "ord").alias("ord"), "item"))
    return rows.select("ord.query", "ord.ord", "paper_id", "citation_count")


@query("service_batch_items", "SELECT 'q' || s_suppkey AS query, o AS ord, o <> 1 AS found FROM supplier, (VALUES (0), (1), (2)) AS t(o)")
def _(spark, d):
    body = F.concat(F.lit("["), _paper(F.col("s")), F.lit(",null,"), _paper(F.col("s")), F.lit("]"))
    return V.batch_items(_answers(spark, d, body)).select("query", "ord", "found")


@query("service_recommended", "SELECT 'q' || s_suppkey AS query, 0 AS ord, 'S' || s_suppkey AS scholar_id FROM supplier")
def _(spark, d):
    items = V.recommended_items(_answers(spark, d, F.concat(F.lit('{"recommendedPapers":['), _paper(F.col("s")), F.lit("]}"))))
    return items.select("query", "ord", F.get_json_object("item", "$.paperId").alias("scholar_id"))


@query("service_details", "SELECT 'q' || s_suppkey AS query, 'a' || s_suppkey AS paper_id, s_suppkey AS citation_count, 'x' AS citations FROM supplier")
def _(spark, d):
    body = _paper(F.col("s"), ',"citations":[{"externalIds":{"ArXiv":"x"}},{"externalIds":{}}]')
    return V.detail_rows(_answers(spark, d, body)).select("query", "paper_id", "citation_count", F.array_join("citations", ",").alias("citations"))


@query("service_monthly", "SELECT 'q' || s_suppkey AS query, 'p' || s_suppkey AS paper_id, 'own' AS abstract FROM supplier")
def _(spark, d):
    body = F.concat(F.lit('[{"paper":{"id":"p'), F.col("s"), F.lit('","summary":"own"},"summary":"other"},{"paper":{"id":""}}]'))
    return V.monthly_rows(_answers(spark, d, body)).select("query", "paper_id", "abstract")


@query("service_overviews", "SELECT 'q' || s_suppkey AS query, 'v' || s_suppkey AS version_id, CASE WHEN s_suppkey % 2 = 0 THEN '# ' || s_suppkey ELSE '' END AS overview FROM supplier")
def _(spark, d):
    versions = V.version_ids(_answers(spark, d, F.concat(F.lit('{"paper":{"paper_version":{"id":"v'), F.col("s"), F.lit('"}}}'))))
    found = V.overviews(_answers(spark, d, F.when(F.col("k") % 2 == 0, F.concat(F.lit('{"overview":"# '), F.col("s"), F.lit('"}'))).otherwise("{}")))
    return versions.join(found, "query")


@query("service_similar", "SELECT 'q' || s_suppkey AS query, 'b' || s_suppkey AS paper_id, 'text' AS abstract FROM supplier")
def _(spark, d):
    listed = F.concat(F.lit('[{"universal_paper_id":"b'), F.col("s"), F.lit('v3","abstract":"text"}]'))
    return V.similar_rows(_answers(spark, d, F.when(F.col("k") % 2 == 0, listed).otherwise(F.concat(F.lit('{"papers":'), listed, F.lit("}"))))).select("query", "paper_id", "abstract")


@query("service_previews", "SELECT 'q' || s_suppkey AS query, CASE WHEN s_suppkey % 2 = 0 THEN 'u' || s_suppkey ELSE 'q' || s_suppkey END AS paper_id, 'T' AS title FROM supplier")
def _(spark, d):
    body = F.when(F.col("k") % 2 == 0, F.concat(F.lit('{"title":"T","universal_paper_id":"u'), F.col("s"), F.lit('"}'))).otherwise('{"title":"T","universal_paper_id":" "}')
    return V.previews(_answers(spark, d, body)).select("query", "paper_id", "title")


@query("request_batches", "SELECT (o_orderkey_rank // 500) AS batch, o_orderkey_rank % 500 AS pos, id FROM (SELECT 'c' || o_custkey AS id, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS o_orderkey_rank FROM orders GROUP BY o_custkey)")
def _(spark, d):
    ids = table(spark, d, "orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("id"), "o_orderkey")
    return V.request_batches(ids, ["o_orderkey"])


@query("citation_models", "WITH p AS (SELECT c_custkey AS k, 'T' || c_custkey AS t FROM customer), n AS (SELECT max(k) + 1 AS n FROM p) SELECT k AS paper_id, (2 * k + 1) % n AS first, (2 * k + 2) % n AS second, (2 * ((2 * k + 1) % n) + 1) % n AS deeper FROM p, n")
def _(spark, d):
    """Each customer cites two others; the tree of two levels below it is one nested value."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("paper_id"), F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("title"), F.lit(1).alias("cites"))
    n = c.agg((F.max("paper_id") + 1).alias("n"))
    links = c.join(F.broadcast(n), F.lit(True)).select(F.col("paper_id").alias("paper"), F.explode(F.array(*[F.struct(F.lit(9 - i).alias("cites"), F.lit(i).alias("ord"), ((2 * F.col("paper_id") + i) % F.col("n")).alias("id")) for i in (1, 2, 3)])).alias("x")).select("paper", "x.*")
    m = V.models(c, links, limit=2, depth=3)
    return m.select("paper_id", F.col("model.citations")[0]["paper_id"].alias("first"), F.col("model.citations")[1]["paper_id"].alias("second"), F.col("model.citations")[0]["citations"][0]["paper_id"].alias("deeper"))


@query("rolling_requests", "SELECT event_id, recent, recent > 3 AS limited, cast(floor((recent - 1) / 3) % 2 AS INTEGER) AS key_index FROM (SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 599999999 PRECEDING AND CURRENT ROW) AS recent FROM events)")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("event_type").alias("service"), F.to_utc_timestamp(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "UTC"), "UTC").alias("at"))
    return V.rolling_requests(rows, 600, 3, 2).select("event_id", "recent", "limited", "key_index")


@query("tool_calls", "SELECT 'q' || s_suppkey AS query, 'o' AS overview, 2 AS tries FROM supplier")
def _(spark, d):
    """A tool whose first call fails is called again."""
    seen = []

    def flaky(answers):
        seen.append(1)
        if len(seen) < 2:
            raise ConnectionError("no answer")
        return V.TOOLS["overview"].run(answers)

    tool = V.Tool("overview", "", flaky, V.TOOLS["overview"].parameters)
    rows = tool.call(answers=_answers(spark, d, F.lit('{"overview":"o"}')), sleep=lambda _: None)
    return rows.withColumn("tries", F.lit(len(seen)))


@query("sql_functions", f"SELECT p_partkey, {NORM_SQL.format('p_name || chr(45) || p_brand || chr(46)')} AS norm, CASE WHEN p_size % 2 = 0 THEN 2000 + p_size END AS year, trim(regexp_replace(lower(p_name || '/' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def _(spark, d):
    V.register(spark)
    part = table(spark, d, "part")
    ident = F.when(F.col("p_size") % 2 == 0, F.concat(F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("01.12345"))).otherwise("no id")
    return part.select("p_partkey", F.call_function("lq_concept_key", F.concat("p_name", F.lit("-"), "p_brand", F.lit("."))).alias("norm"), F.call_function("lq_paper_year", ident).alias("year"), F.call_function("lq_slug", F.concat("p_name", F.lit("/"), "p_brand")).alias("slug"))


@query("sentences_by_keyword", "SELECT s_suppkey AS paper, nth, CASE WHEN s_suppkey % 2 = 0 THEN CASE nth WHEN 1 THEN 'Our method is third in the text' ELSE 'A plain first sentence' END ELSE CASE nth WHEN 1 THEN 'A plain first sentence' ELSE 'Another plain sentence' END END || ' [arxiv:' || s_suppkey || ', n]' AS sentence FROM supplier, (VALUES (1), (2)) AS t(nth)")
def _(spark, d):
    texts = F.array(F.lit("A plain first sentence"), F.lit("Another plain sentence"), F.when(F.col("k") % 2 == 0, "Our method is third in the text").otherwise("Last of them"))
    rows = _answers(spark, d, F.lit("")).select(F.col("k").alias("paper"), F.posexplode(texts).alias("nth", "sentence"))
    out = V.with_keywords_first(rows, ["method"], 2)
    return out.withColumn("sentence", V.cited(F.col("sentence"), F.col("paper").cast("string"), F.lit("n")))



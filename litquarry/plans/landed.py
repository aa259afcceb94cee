"""Queries that land rows as files, in every shape that the readers know, and read them back; and queries over the writers."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import config
from ..functions import json as jsonx
from ..functions import text
from ..sources import readers as R
from ..sources import snapshots
from ..sources import sinks as S
from ..sources.adapter import table
from ..sources.landing import folder, put, put_each
from .registry import query


def _suppliers(spark, d) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.concat(F.lit("a"), F.col("s_suppkey").cast("string")).alias("arxiv_id"), F.col("s_name").alias("name"))


def _texts(rows: DataFrame, value, path: str) -> str:
    """Each row's text as a file of its own that is named by its key."""
    put_each(rows.select(F.concat(F.col("k").cast("string"), F.lit(".json")).alias("name"), value.alias("content")), path)
    return path


@query("source_json_records", "SELECT 'a' || s_suppkey AS arxiv_id, s_suppkey % 5 AS n FROM supplier")
def _(spark, d):
    path = folder(spark, "records")
    record = F.to_json(F.struct("arxiv_id", (F.col("k") % 5).alias("n")))
    return R.json_documents(spark, _texts(_suppliers(spark, d), record, path), "arxiv_id string, n int", required=True)


@query("source_json_missing", "SELECT 'a' || s_suppkey AS arxiv_id, 0 AS records FROM supplier")
def _(spark, d):
    """How many records of a file that is not there each supplier has."""
    gone = R.json_documents(spark, folder(spark, "nothing"), "arxiv_id string")
    counts = gone.groupBy("arxiv_id").agg(F.count(F.lit(1)).alias("n"))
    return _suppliers(spark, d).join(counts, "arxiv_id", "left").select("arxiv_id", F.coalesce("n", F.lit(0)).cast("int").alias("records"))


@query("source_json_lenient", "SELECT CASE WHEN s_suppkey % 4 <> 1 THEN 'a' || s_suppkey END AS arxiv_id FROM supplier")
def _(spark, d):
    record = F.when(F.col("k") % 4 == 1, F.lit("{ no json")).otherwise(F.to_json(F.struct("arxiv_id")))
    return R.json_documents(spark, _texts(_suppliers(spark, d), record, folder(spark, "lenient")), "arxiv_id string")


@query("source_json_directory", "SELECT coalesce(CASE WHEN n_nationkey % 2 = 0 THEN 'id' || n_nationkey % 6 END, 'f' || lpad(cast(n_nationkey AS VARCHAR), 2, '0')) AS arxiv_id, max(n_nationkey) AS n FROM nation GROUP BY 1")
def _(spark, d):
    path = folder(spark, "directory")
    for r in table(spark, d, "nation").select("n_nationkey").collect():
        n = r.n_nationkey
        put(spark, f"{path}/f{n:02d}.json", json.dumps({"n": n} | ({"arxiv_id": f"id{n % 6}"} if n % 2 == 0 else {})))
    return R.json_directory(spark, path, "arxiv_id string, n int", "arxiv_id")


@query("source_csv_rows", "SELECT 'a' || s_suppkey AS arxiv_id, 'say \"' || s_suppkey || '\", twice' AS note FROM supplier WHERE s_suppkey % 3 <> 0")
def _(spark, d):
    path = folder(spark, "rows")
    rows = _suppliers(spark, d).select(F.when(F.col("k") % 3 == 0, " ").otherwise(F.col("arxiv_id")).alias("arxiv_id"), F.concat(F.lit('say "'), F.col("k").cast("string"), F.lit('", twice')).alias("note"))
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return R.csv_rows(spark, path, "arxiv_id")


@query("source_csv_ids", "SELECT DISTINCT 'a' || s_suppkey % 7 AS arxiv_id FROM supplier WHERE s_suppkey % 7 <> 0")
def _(spark, d):
    path = folder(spark, "ids")
    rows = _suppliers(spark, d).select(F.when(F.col("k") % 7 == 0, "").otherwise(F.concat(F.lit(" a"), (F.col("k") % 7).cast("string"), F.lit(" "))).alias("arxiv_id"), "name")
    rows.write.option("header", True).csv(path)
    return R.ids(R.csv_rows(spark, path), "arxiv_id")


@query("source_texts", "SELECT CASE WHEN n_nationkey % 5 = 0 THEN chr(10) || ' ' ELSE '# ' || n_name || chr(10) || 'text' END AS text, n_nationkey % 5 <> 0 AS usable FROM nation")
def _(spark, d):
    rows = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.when(F.col("n_nationkey") % 5 == 0, F.lit("\n ")).otherwise(F.concat(F.lit("# "), "n_name", F.lit("\ntext"))).alias("t"))
    path = folder(spark, "texts")
    for r in rows.collect():
        put(spark, f"{path}/{r.k}.md", r.t)
    return R.texts(spark, path).select("text", "usable")


_SHAPES = "SELECT shape, 'a' || k AS paper_id, CASE WHEN shape = 'plain' THEN NULL ELSE 'abstract ' || k END AS abstract FROM (VALUES ('list'), ('papers'), ('map'), ('abstracts')) AS s(shape), (SELECT s_suppkey AS k FROM supplier)"


@query("source_pool_shapes", _SHAPES)
def _(spark, d):
    rows = _suppliers(spark, d).select("k", F.col("arxiv_id"), F.concat(F.lit("abstract "), F.col("k").cast("string")).alias("abstract"))
    records = F.array_sort(F.collect_list(F.struct("k", "arxiv_id", "abstract")))
    one = rows.agg(records.alias("r"))
    listed = F.transform("r", lambda x: F.struct(x["arxiv_id"].alias("arxiv_id"), x["abstract"].alias("abstract")))
    by_id = lambda value: F.map_from_entries(F.transform("r", lambda x: F.struct(x["arxiv_id"], value(x))))
    shapes = {"list": F.to_json(listed), "papers": F.to_json(F.struct(listed.alias("papers"))), "map": F.to_json(by_id(lambda x: F.struct(x["abstract"].alias("abstract")))), "abstracts": F.to_json(by_id(lambda x: x["abstract"]))}
    out = None
    for name, value in shapes.items():
        part = R.pool(one.select(value.alias("value"))).select(F.lit(name).alias("shape"), "paper_id", "abstract")
        out = part if out is None else out.unionByName(part)
    return out


@query("source_promoted_shapes", "SELECT shape, 'a' || s_suppkey AS paper_id FROM supplier, (VALUES ('object'), ('ids'), ('records'), ('map')) AS s(shape)")
def _(spark, d):
    one = _suppliers(spark, d).agg(F.array_sort(F.collect_list("arxiv_id")).alias("r"))
    listed = F.transform("r", lambda x: F.struct(x.alias("arxiv_id"), F.lit(1).alias("n")))
    shapes = {"object": F.to_json(F.struct(listed.alias("promoted_papers"))), "ids": F.to_json("r"), "records": F.to_json(listed), "map": F.to_json(F.map_from_entries(F.transform("r", lambda x: F.struct(x, F.lit(1)))))}
    out = None
    for name, value in shapes.items():
        part = R.promoted(one.select(value.alias("value"))).select(F.lit(name).alias("shape"), "paper_id")
        out = part if out is None else out.unionByName(part)
    return out


@query("source_seed_pool", "SELECT 'a' || s_suppkey AS paper_id, (SELECT count(*) + 1 FROM supplier) AS total_kept FROM supplier")
def _(spark, d):
    one = _suppliers(spark, d).agg(F.array_sort(F.collect_list("arxiv_id")).alias("papers"), (F.count(F.lit(1)) + 1).alias("total_kept"))
    ids, told = R.seed_pool(one.select(F.to_json(F.struct("papers", "total_kept")).alias("value")))
    return ids.select("paper_id").join(F.broadcast(told), F.lit(True))


@query("source_evidence_claims", "SELECT 'a' || s_suppkey AS paper, CASE s_suppkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 0 END AS claims FROM supplier")
def _(spark, d):
    value = F.when(F.col("k") % 4 == 0, F.lit('{"claims": [{"t": 1}, {"t": 2}]}')).when(F.col("k") % 4 == 1, F.lit('{"claims": []}')).when(F.col("k") % 4 == 2, F.lit('{"claims": {"t": 1}}')).otherwise(F.lit("broken {"))
    rows = R.evidence_claims(_suppliers(spark, d).select(F.col("arxiv_id").alias("paper"), value.alias("value")))
    return rows.select("paper", F.when(F.col("claims").isNotNull(), F.size("claims")).alias("claims"))


@query("source_page_nodes", "SELECT k || '.' || s_suppkey AS id, s_suppkey AS line FROM supplier, (VALUES ('s'), ('t')) AS t(k)")
def _(spark, d):
    node = lambda k: F.concat(F.lit(f'"{k}.'), F.col("k").cast("string"), F.lit('":{"line":'), F.col("k").cast("string"), F.lit("}"))
    flat = F.concat(F.lit("{"), node("s"), F.lit(","), node("t"), F.lit("}"))
    rows = _suppliers(spark, d).select(F.when(F.col("k") % 2 == 0, flat).otherwise(F.concat(F.lit('{"nodes":'), flat, F.lit("}"))).alias("value"))
    return R.page_nodes(rows).select("id", F.get_json_object("node", "$.line").cast("int").alias("line"))


@query("source_outline", "SELECT 'f' || n_nationkey AS family, 'm' || s_suppkey AS method FROM nation JOIN supplier ON s_nationkey = n_nationkey")
def _(spark, d):
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.concat(F.lit("m"), F.col("s_suppkey").cast("string")))).alias("method_ids"))
    family = F.struct(F.concat(F.lit("f"), F.col("s_nationkey").cast("string")).alias("id"), "method_ids")
    path = folder(spark, "outline")
    s.agg(F.to_json(F.struct(F.collect_list(family).alias("families"))).alias("value")).write.text(path)
    read = R.json_documents(spark, path, "families array<struct<id:string,method_ids:array<string>>>", required=True)
    return read.select(F.explode("families").alias("f")).select(F.col("f.id").alias("family"), F.explode("f.method_ids").alias("method"))


@query("source_newest", "SELECT max(r_regionkey) AS n FROM region")
def _(spark, d):
    path = folder(spark, "newest")
    for r in table(spark, d, "region").orderBy("r_regionkey").collect():
        put(spark, f"{path}/manifest_{r.r_regionkey}.json", json.dumps({"n": r.r_regionkey}))
    return R.newest(spark, f"{path}/*.json", "n int")


@query("source_availability", "SELECT s_suppkey AS k, CASE s_suppkey % 5 WHEN 0 THEN 'available' WHEN 1 THEN 'transient' WHEN 2 THEN 'unavailable' WHEN 3 THEN 'unavailable' ELSE 'transient' END AS said FROM supplier")
def _(spark, d):
    status = F.element_at(F.array(*map(F.lit, (200, 429, 404, 422, 503))), (F.col("k") % 5 + 1).cast("int"))
    return _suppliers(spark, d).select("k", R.availability(status).alias("said"))


_IMAGES = "SELECT sha256('image ' || n_nationkey) || CASE WHEN n_nationkey % 3 = 0 THEN '.png' ELSE '.jpg' END AS name FROM nation WHERE n_nationkey % 3 < 2"


@query("source_images", _IMAGES)
def _(spark, d):
    path = folder(spark, "images")
    for r in table(spark, d, "nation").select("n_nationkey").collect():
        put(spark, f"{path}/{r.n_nationkey}.{('png', 'jpeg', 'txt')[r.n_nationkey % 3]}", f"image {r.n_nationkey}")
    put(spark, f"{path}/empty.png", "")
    put(spark, f"{path}/large.png", "x" * 400)
    return R.images(spark, path, most=300).select("name")


@query("file_signatures", "SELECT n_nationkey AS k, strlen(n_name) AS size, sha256(n_name) AS sha256 FROM nation")
def _(spark, d):
    path = folder(spark, "signatures")
    for r in table(spark, d, "nation").collect():
        put(spark, f"{path}/{r.n_nationkey}.bin", r.n_name)
    return R.files(spark, path).select(F.regexp_extract("path", r"(\d+)\.bin$", 1).cast("int").alias("k"), "size", "sha256")


@query("sink_snapshots", "SELECT 'a' || s_suppkey AS paper_id, 'second' AS said, 'a' || s_suppkey AS mirrored FROM supplier WHERE s_suppkey % 2 = 0")
def _(spark, d):
    path, mirror = folder(spark, "pool"), folder(spark, "mirror")
    rows = _suppliers(spark, d).select(F.col("arxiv_id").alias("paper_id"), "k")
    S.pool_with_mirror(rows.select("paper_id", F.lit("first").alias("said")), path, mirror)
    S.pool_with_mirror(rows.where("k % 2 = 0").select("paper_id", F.lit("second").alias("said")), path, mirror)
    ids = spark.read.option("header", True).csv(mirror).select(F.col("paper_id").alias("mirrored"))
    return spark.read.schema("paper_id string, said string").json(path).join(ids, F.col("paper_id") == F.col("mirrored"))


@query("sink_published", "SELECT s_suppkey AS k, 3 AS version FROM supplier")
def _(spark, d):
    path = folder(spark, "published")
    for n in (1, 2, 3):
        S.publish(spark, path, lambda p, n=n: _suppliers(spark, d).select("k", F.lit(n).alias("version")).write.parquet(p))
    return spark.read.parquet(S.published(spark, path))


@query("sink_upsert", "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 'new' ELSE 'old' END AS v FROM supplier")
def _(spark, d):
    path, rows = folder(spark, "upsert"), _suppliers(spark, d)
    S.upsert(rows.select("k", F.lit("old").alias("v"), F.lit(1).alias("ord")), path, ["k"])
    fresh = rows.where("k % 2 = 0")
    S.upsert(fresh.select("k", F.lit("lost").alias("v"), F.lit(2).alias("ord")).unionByName(fresh.select("k", F.lit("new").alias("v"), F.lit(3).alias("ord"))), path, ["k"])
    return spark.read.parquet(path)


@query("sink_remove", "SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 3 <> 0")
def _(spark, d):
    path, rows = folder(spark, "remove"), _suppliers(spark, d).select("k")
    S.parquet_snapshot(rows, path)
    S.remove(rows.where("k % 3 = 0"), path, ["k"])
    return spark.read.parquet(path)


@query("sink_log", "SELECT s_suppkey AS k, substr(sha256('{\"k\":' || s_suppkey || ',\"what\":\"done\"}'), 1, 16) AS event_id, count(*) AS n FROM supplier, (VALUES (1), (2)) AS t(x) GROUP BY s_suppkey")
def _(spark, d):
    path, rows = folder(spark, "log"), _suppliers(spark, d)
    S.append_log(rows.select(F.lit("done").alias("what"), "k", F.lit("2024-01-01").alias("timestamp")), path)
    S.append_log(rows.select("k", F.lit("2024-01-02").alias("timestamp"), F.lit("done").alias("what")), path)
    return spark.read.schema("k long, event_id string").json(path).groupBy("k", "event_id").agg(F.count(F.lit(1)).alias("n"))


@query("sink_preserved", "SELECT sha256('content ' || x) AS sha256 FROM (SELECT DISTINCT s_suppkey % 7 AS x FROM supplier)")
def _(spark, d):
    path = folder(spark, "preserved")
    rows = _suppliers(spark, d).select("name", F.concat(F.lit("content "), (F.col("k") % 7).cast("string")).alias("content"))
    S.preserve(rows, path)
    S.preserve(rows, path)
    return spark.read.parquet(path).select("sha256")


@query("sink_per_id", "SELECT 'a' || s_suppkey AS paper_id, 'text ' || s_suppkey AS text FROM supplier WHERE s_suppkey % 4 <> 2")
def _(spark, d):
    path = folder(spark, "per-id")
    rows = _suppliers(spark, d).select(F.col("arxiv_id").alias("paper_id"), F.concat(F.lit("text "), F.col("k").cast("string")).alias("text"), F.when(F.col("k") % 4 == 2, "gone").alias("error"))
    S.per_id(rows, path)
    return spark.read.schema("text string, paper_id string").parquet(path).select("paper_id", "text")


@query("sink_sidecar", "SELECT * FROM (VALUES ('same', true), ('other version', false), ('changed', false), ('missing', false)) AS t(what, valid)")
def _(spark, d):
    files = table(spark, d, "nation").select(F.col("n_name").alias("path"), F.sha2("n_name", 256).alias("sha256"))
    written = S.sidecar(files, "v1")
    cases = {"same": (files, "v1"), "other version": (files, "v2"), "changed": (files.withColumn("sha256", F.when(F.col("path") == "NATION_3", "x").otherwise(F.col("sha256"))), "v1"), "missing": (files.where("path <> 'NATION_3'"), "v1")}
    out = None
    for what, (now, version) in cases.items():
        part = S.sidecar_valid(now, written, version).select(F.lit(what).alias("what"), "valid")
        out = part if out is None else out.unionByName(part)
    return out


@query("sink_markdown_table", "SELECT '| r_name | n |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || r_name || '\\|x | ' || r_regionkey || ' |', chr(10) ORDER BY r_regionkey) AS text FROM region")
def _(spark, d):
    rows = table(spark, d, "region").select(F.concat("r_name", F.lit("|x")).alias("r_name"), F.col("r_regionkey").alias("n"))
    return S.markdown_table(rows, ["r_name", "n"], ["n"])


@query("sink_state_stamped", "SELECT s_suppkey AS k, 1 + s_suppkey % 2 AS run, '2024-01-02T03:04:05+00:00' AS updated_at, '2024-01-02T03:04:0' || (s_suppkey % 10) || '+00:00' AS seen_at FROM supplier")
def _(spark, d):
    """State that was saved twice, each time as a version of its own with a stamp; the second one is read."""
    path, at = folder(spark, "state"), datetime(2024, 1, 2, 4, 4, 5, tzinfo=timezone(timedelta(hours=1)))
    seen = config.utc_stamp(F.timestamp_seconds(F.lit(1_704_164_640) + F.col("k") % 10))
    rows = _suppliers(spark, d).select("k", (1 + F.col("k") % 2).cast("int").alias("run"), seen.alias("seen_at"))
    snapshots.save(rows.where("k % 2 = 0").withColumn("run", F.lit(9)), path, config.utc_text(at - timedelta(days=1)))
    snapshots.save(rows, path, config.utc_text(at))
    return snapshots.load(spark, path, "k int, run int, seen_at string").withColumn("updated_at", F.lit(snapshots.version(path)["updated_at"]))


# ---- settings and small arithmetic --------------------------------------------------------------------------------------


@query("settings_resolved", "SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN 1 + s_suppkey % 50 WHEN 1 THEN 9 ELSE 100 END AS normal_limit, s_suppkey % 3 <> 1 AS relevance_fail_open FROM supplier")
def _(spark, d):
    """Settings of a run for each supplier: from its file, from an override of it, or the defaults."""

    def resolve(frames):
        for f in frames:
            over = {"LITQUARRY_NORMAL_LIMIT": "9", "LITQUARRY_RELEVANCE_FAIL_OPEN": "off"}
            found = [config.Settings.resolve(t, over if k % 3 == 1 else {}) for k, t in zip(f["k"], f["file"], strict=True)]
            yield pd.DataFrame({"k": f["k"], "normal_limit": [s.normal_limit for s in found], "relevance_fail_open": [s.relevance_fail_open for s in found]})

    file = F.when(F.col("k") % 3 < 2, F.to_json(F.struct((1 + F.col("k") % 50).cast("string").alias("normal_limit"))))
    return _suppliers(spark, d).select("k", file.alias("file")).mapInPandas(resolve, "k long, normal_limit int, relevance_fail_open boolean").select(F.col("k").cast("int").alias("k"), "normal_limit", "relevance_fail_open")


@query("run_topics", "SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN 'from config' WHEN 1 THEN 'from file' ELSE 'run' || s_suppkey END AS topic FROM supplier")
def _(spark, d):
    k = F.col("k")
    held = F.when(k % 3 == 0, F.lit('{"topic": " from config "}')).when(k % 3 == 1, F.lit('{"topic": " "}'))
    return _suppliers(spark, d).select("k", config.run_topic(held, F.when(k % 3 == 1, "from file\n").otherwise(" "), F.concat(F.lit("run"), k.cast("string"))).alias("topic"))


@query("setting_values", "SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS switch, CASE s_suppkey % 2 WHEN 0 THEN 'a,b' ELSE 'x' || s_suppkey || ',z' END AS keys, CASE s_suppkey % 3 WHEN 0 THEN s_suppkey WHEN 1 THEN 0 ELSE 256 END AS capacity FROM supplier")
def _(spark, d):
    k = F.col("k")
    word = F.when(k % 4 == 0, " Yes ").when(k % 4 == 1, "off").when(k % 4 == 2, "1").otherwise(" ")
    keys = F.when(k % 2 == 0, F.lit('["a", " b", "a"]')).otherwise(F.concat(F.lit("x"), k.cast("string"), F.lit(", \"z\"\nx"), k.cast("string")))
    size = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, "-5").otherwise("many")
    return _suppliers(spark, d).select("k", config.switch(word).alias("switch"), F.array_join(config.key_list(keys, F.when(k % 2 == 0, "b").otherwise("z")), ",").alias("keys"), config.capacity(size).alias("capacity"))


@query("request_waits", "SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN s_suppkey + 0.5 WHEN 1 THEN 0.0 ELSE 30.0 END::DOUBLE AS wait, least(30.0, 2.0 * pow(2.0, s_suppkey % 8))::DOUBLE AS retry, CASE WHEN s_suppkey % 4 < 2 THEN s_suppkey % 2 ELSE (s_suppkey % 2 + 1) % (s_suppkey % 4) END AS next_key FROM supplier")
def _(spark, d):
    k = F.col("k")
    said = F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit(".5"))).when(k % 3 == 1, "-2").otherwise("soon")
    return _suppliers(spark, d).select("k", config.backoff_seconds(said).alias("wait"), config.retry_delay(k % 8 + 1).alias("retry"), config.rotated(k % 2, k % 4).alias("next_key"))


@query("year_ranges", "SELECT s_suppkey AS k, 2024 - s_suppkey % 5 AS first, 2024 + s_suppkey % 2 AS last, (2024 - s_suppkey % 5) || '-' || (2024 + s_suppkey % 2) AS param FROM supplier")
def _(spark, d):
    from ..functions import scoring

    both = config.year_range(F.to_date(F.lit("2024-06-30")), F.col("k") % 5, F.col("k") % 2)
    rows = _suppliers(spark, d).select("k", both.alias("y"))
    return rows.select("k", F.col("y.start").alias("first"), F.col("y.end").alias("last"), scoring.year_window(F.col("y.start"), F.col("y.end")).alias("param"))


@query("event_ids", "SELECT event_id AS k, substr(sha256('{\"a\":' || event_id || ',\"b\":\"' || event_type || '\"}'), 1, 16) AS ident FROM events")
def _(spark, d):
    rows = table(spark, d, "events").select(F.col("event_type").alias("b"), F.col("event_id").alias("a"))
    return rows.select(F.col("a").alias("k"), jsonx.event_id(["b", "a"]).alias("ident"))


@query("search_keys", "SELECT event_id AS k, event_type || '||' || (event_id % 9) || '|100' AS key FROM events")
def _(spark, d):
    return table(spark, d, "events").select(F.col("event_id").alias("k"), jsonx.search_key(F.col("event_type"), F.lit(None), F.col("event_id") % 9, F.lit(100)).alias("key"))


@query("string_lists", "SELECT event_id AS k, CASE event_id % 3 WHEN 0 THEN 'a|b' || event_id WHEN 1 THEN 'x, y|z' || event_id ELSE 'one' END AS items FROM events")
def _(spark, d):
    k = F.col("event_id")
    raw = F.when(k % 3 == 0, F.concat(F.lit(" a, b"), k.cast("string"), F.lit(" ,"))).when(k % 3 == 1, F.concat(F.lit("x, y\n\n z"), k.cast("string"))).otherwise("one")
    return table(spark, d, "events").select(k.alias("k"), F.array_join(jsonx.string_list(raw), "|").alias("items"))


@query("listed_ids", "SELECT event_id AS k, CASE WHEN event_id % 2 = 0 THEN 'p' || event_id || ',q' ELSE 'q' END AS ids FROM events")
def _(spark, d):
    k = F.col("event_id").cast("string")
    raw = F.concat(F.lit("Keep these: [\"p"), k, F.lit("\", 'q', \"other\", 'q'] and ['r']"))
    allowed = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("q"), F.concat(F.lit("p"), k), F.lit("r"))).otherwise(F.array(F.lit("q"), F.lit("r")))
    return table(spark, d, "events").select(F.col("event_id").alias("k"), F.array_join(jsonx.listed_ids(raw, allowed), ",").alias("ids"))


@query("string_leaves", "SELECT event_id AS k, 'x' || event_id || ',y,' || event_type AS leaves FROM events")
def _(spark, d):
    k = F.col("event_id").cast("string")
    value = F.concat(F.lit('{"a": ["x'), k, F.lit('", {"n": 1, "m": "y"}], "b": "'), "event_type", F.lit('", "c": null}'))
    return table(spark, d, "events").select(F.col("event_id").alias("k"), F.array_join(jsonx.string_leaves(value), ",").alias("leaves"))


@query("gap_concept_texts", "SELECT event_id AS k, CASE event_id % 6 WHEN 0 THEN event_type || ' ' || event_id WHEN 1 THEN event_type WHEN 2 THEN 'n' || event_id WHEN 3 THEN '' WHEN 4 THEN 't' || user_id ELSE '' END AS concept, CASE WHEN event_id % 6 = 4 THEN 't' || user_id ELSE 'none' END AS title FROM events")
def _(spark, d):
    """Concepts given as strings, as objects with one of several fields, as numbers and as no JSON at all; and the first title of a list."""
    k, t = F.col("event_id").cast("string"), F.col("event_type")
    cases = [F.concat(F.lit('"  '), t, F.lit(" "), k, F.lit('\\n"')), F.concat(F.lit('{"concept": "'), t, F.lit('", "name": "x"}')), F.concat(F.lit('{"concept": " ", "name": "n'), k, F.lit('"}')), F.concat(F.lit('{"concept": '), k, F.lit("}")), F.concat(F.lit('{"name": ["a"], "title": "t'), F.col("user_id").cast("string"), F.lit('"}')), F.lit("{not json")]
    item = F.coalesce(*[F.when(F.col("event_id") % 6 == i, c) for i, c in enumerate(cases)])
    rows = table(spark, d, "events").select(F.col("event_id").alias("k"), item.alias("item"))
    listed = F.when(F.try_parse_json("item").isNotNull(), F.concat(F.lit('[{"title": "  "}, {}, '), "item", F.lit("]"))).otherwise(F.lit("[]"))
    return rows.select("k", jsonx.concept_text("item").alias("concept"), jsonx.first_text(listed, "title", "none").alias("title"))


@query("external_ids", "SELECT s_suppkey AS k, CASE s_suppkey % 5 WHEN 0 THEN '2401.' || (10000 + s_suppkey) WHEN 1 THEN '2401.' || (10000 + s_suppkey) || 'v2' WHEN 2 THEN '2401.' || (10000 + s_suppkey) WHEN 3 THEN '2401.' || (10000 + s_suppkey) END AS ident, CASE WHEN s_suppkey % 5 < 4 THEN 2 ELSE 1 END AS keys FROM supplier")
def _(spark, d):
    base = F.concat(F.lit("2401."), (10000 + F.col("k")).cast("string"))
    raw = F.when(F.col("k") % 5 == 0, base).when(F.col("k") % 5 == 1, F.concat(F.lit("arXiv:"), base, F.lit("v2"))).when(F.col("k") % 5 == 2, F.concat(F.lit("https://arxiv.org/abs/"), base)).when(F.col("k") % 5 == 3, F.concat(F.lit("http://www.arxiv.org/pdf/"), base, F.lit(".pdf"))).otherwise(F.lit("10.1000/x"))
    return _suppliers(spark, d).select("k", text.external_id(raw).alias("ident"), F.size(text.lookup_keys(raw)).alias("keys"))

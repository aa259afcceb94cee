"""What larger tables bring: ids of six digits, ties at a limit, many rows in a small file."""

from pyspark.sql import functions as F

from litquarry.functions import text
from litquarry.operators import discovery, gaps
from litquarry.plans import catalogue as CORE
from litquarry.plans import landed
from litquarry.sources import adapter, landing, sinks


def test_ties_of_rank_go_by_id(spark):
    rows = [(f"1801.{k:05d}", None, 2018, 5, 7) for k in range(400)]
    papers = spark.createDataFrame(rows, "paper_id string, abstract string, year int, citations int, ord long").orderBy(F.desc("paper_id")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = discovery.ranked_by_impact(papers, 2026, 30).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.paper_id for r in got] == [f"1801.{k:05d}" for k in range(30)]


def test_an_id_of_six_digits_is_no_title(spark):
    pool = spark.createDataFrame([("1801.100000", "1801.100000", 2018), ("1801.00001", "1801.00001", None), ("1801.7", "A title", 0)], "paper_id string, title string, year int")
    weak = pool.select("paper_id", F.lit(" weak ").alias("title"), F.lit(2020).alias("year"))
    got = {r.paper_id: (r.title, r.year) for r in discovery.metadata([pool, weak]).collect()}
    assert got == {"1801.100000": ("weak", 2018), "1801.00001": ("weak", 2020), "1801.7": ("A title", 2020)}


def test_variants_of_many_parts_are_made_in_many_tasks(spark, tmp_path):
    """All parts are in one small file; sorting all their variants in its one task took memory by the number of rows."""
    n = 3 * adapter.PARTS
    spark.range(n).selectExpr("id as p_partkey", "concat('name ', id % 500) as p_name", "'b' as p_brand", "cast(id % 9 as int) as p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(3).selectExpr("id as o_orderkey").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    rows = adapter.graph_nodes(spark, str(tmp_path)).where("type <> 'Paper'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == n * adapter.VARIANTS and max(r["count"] for r in rows) < n * adapter.VARIANTS / 2


def tasks_that_wrote(spark, run):
    """How many tasks the largest stage of an action had."""
    spark.sparkContext.setJobGroup("sizes", "sizes")
    try:
        run()
        status = spark.sparkContext.statusTracker()
        stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("sizes") for s in status.getJobInfo(j).stageIds]
        return max(s.numTasks for s in stages if s)
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_many_files_are_written_by_many_tasks(spark, tmp_path):
    """A thousand suppliers lie in one small file; their files were written by its one task."""
    n = 3 * landing.FILES
    rows = spark.range(n).coalesce(1).select(F.col("id").alias("k"), F.format_string("a/%d é", "id").alias("paper_id"), F.when(F.col("id") % 4 == 2, "gone").alias("error"))
    assert tasks_that_wrote(spark, lambda: sinks.per_id(rows, f"file://{tmp_path}/ids")) == 3
    assert sorted(r.paper_id for r in spark.read.parquet(f"{tmp_path}/ids").collect()) == sorted(f"a/{k} é" for k in range(n) if k % 4 != 2)
    path = []
    assert tasks_that_wrote(spark, lambda: path.append(landed._texts(rows, F.col("paper_id"), f"file://{tmp_path}/texts"))) == 3
    assert len(list((tmp_path / "texts").glob("*.json"))) == n and spark.read.text(path[0]).count() == n


def test_rules_read_written_chapters(spark, small):
    """The texts are made once and not again for each rule, whose plan had them a dozen times."""
    rows = CORE.QUERIES["book_chapter_issues"](spark, small)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "word word" not in plan and "repeat(" not in plan


def test_packs_of_papers_are_shuffled_once(spark, small, monkeypatch):
    """Claims of each paper, some ten times as many once sections are planned, were shuffled for each grouping and join."""
    monkeypatch.setattr(adapter, "CLAIMS", 1000)
    for name in ("pack_method_json", "pack_section_sources"):
        plan = CORE.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        kinds = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert kinds and all("hashpartitioning(paper#" in line and "REPARTITION_BY_NUM" in line for line in kinds), kinds


def exchanges(rows):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return [line.split("Exchange ")[1] for line in plan.splitlines() if "Exchange " in line]


def test_fragments_are_joined_within_papers(spark, small, monkeypatch):
    """Edges were shuffled for each of their ends and for their place, and so were nodes and claims."""
    monkeypatch.setattr(adapter, "CLAIMS", 1000)
    for name in ("edge_reject_reasons", "verified_edge_grounding", "dangling_node_prune", "compile_claim_edges", "pack_nodes_topk"):
        kinds = exchanges(CORE.QUERIES[name](spark, small))
        kinds = [k for k in kinds if k.startswith("hashpartitioning")]
        rest = [k for k in kinds if not (k.startswith("hashpartitioning(paper#") and "REPARTITION_BY_NUM" in k)]
        assert kinds and not rest, (name, rest)


def test_a_report_counts_keys_alone(spark, small):
    """The places of weak edges in their files were shuffled to be counted."""
    plan = CORE.QUERIES["graph_report"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_neighbors_are_counted_by_number(spark, small):
    """Pairs of concepts went through shuffle and sort by their names."""
    kinds = exchanges(CORE.QUERIES["graph_neighbors_topk"](spark, small))
    assert any(k.startswith("hashpartitioning(norm#") for k in kinds) and not any("xxhash64" in k for k in kinds)


def test_families_need_no_titles(spark, small):
    """Items were read three times, each time with the least name of their paper as a title and with its words compared."""
    plan = CORE.QUERIES["family_evidence_score"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "regexp" not in plan


def test_keys_of_nodes(spark):
    rows = spark.createDataFrame([(" A  b",), ("a-b c!d",), ("!?x (y) ",), ("a \t b",), (None,), ("é",)], "t string")
    assert [r.k for r in rows.select(text.node_key("t").alias("k")).collect()] == ["a b", "a-b c d", "x y", "a b", "", ""]


def test_signals_of_candidates_are_made_once(spark, small):
    """Each signal was made for the list of all concepts and once more for itself, and counts of papers multiplied the mentions."""
    plan = CORE.QUERIES["ranked_gaps"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.count("Generate explode") == 3  # variants of parts, and twice the forms of what is known


def test_keys_of_concepts_are_those_of_all_rules(spark):
    odd = ["a-b  C", "-a-", "a--b", "a -b", "A b.", "a.b", "a .", "", "-", "- .", "a b ", "\u00a0a\u2003b", "É-x", "a\n", "a\tb", "x?!", "a-b c#1", None]
    want = ["a b c", " a ", "a b", "a b", "a b", "a.b", "a ", "", " ", " ", "a b", "a b", "é x", "a", "a b", "x", "a b c#1", None]
    rows = spark.createDataFrame([(x,) for x in odd], "t string")
    assert [r.k for r in rows.select(text.concept_key("t").alias("k")).collect()] == want
    blank = spark.createDataFrame([(" \u2003\n", "x"), (None, "y"), (" z", "x")], "a string, b string")
    assert [r.v for r in blank.select(text.or_default("a", "b").alias("v")).collect()] == ["x", "y", " z"]


def test_neighbors_of_few_are_those_of_all(spark, small):
    """The digest shows three neighbours of 180 concepts and counted the pairs of all."""
    edges = CORE._concept_edges(spark, small).select("src", "norm")
    every = gaps.neighbors(edges)
    chosen = every.select("norm").distinct().orderBy("norm").limit(40)
    rows = lambda df: sorted(map(tuple, df.select("norm", "neighbor", "shared", "rank").collect()))
    few = rows(gaps.neighbors_of(edges, chosen))
    assert few and few == rows(every.join(chosen, "norm", "left_semi"))
    plan = CORE.QUERIES["gap_digest"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "numbered-concepts" not in plan and "Expand" not in plan and " numbers-" not in plan

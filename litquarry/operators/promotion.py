"""Which papers are promoted by their scores, and what is wrong with score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.45


def promoted(scores: DataFrame, threshold: float = THRESHOLD, key: str = "paper_id", score: str = "final_score") -> DataFrame:
    """(paper_id, final_score): rows at or above the threshold; if there are none, the single best. Ties go by ord."""
    # two top-1 scalars decide the fallback; rows are filtered in place and never gathered
    facts = scores.agg(F.count_if(F.col(score) >= threshold).alias("_passed"), F.max_by(key, F.struct(score, (-F.col("ord")).alias("o"))).alias("_best"))
    rows = scores.join(F.broadcast(facts), F.lit(True))
    return rows.where((F.col(score) >= threshold) | ((F.col("_passed") == 0) & F.col(key).eqNullSafe(F.col("_best")))).select(key, score)


def rebuilt_candidates(scores: DataFrame, candidates: DataFrame, columns: list[str], score: str = "final_score") -> DataFrame:
    """The candidate table, or the score table by descending score where the candidates lack columns that scores have."""
    if all(c in candidates.columns for c in columns) or not all(c in scores.columns for c in columns):
        return candidates
    return scores.select(*columns).orderBy(F.desc(score), "ord" if "ord" in scores.columns else columns[0])


def score_issues(scores: DataFrame, candidates: DataFrame, pool: DataFrame, promoted_ids: DataFrame, threshold: float = THRESHOLD, key: str = "paper_id", score: str = "final_score") -> DataFrame:
    """(severity, code, detail) against score tables: ids missing, extra or repeated, order of candidates, promoted set."""
    from pyspark.sql import Window

    issue = lambda rows, code, detail: rows.select(F.lit("error").alias("severity"), F.lit(code).alias("code"), detail.cast("string").alias("detail"))
    out = []
    for name, rows in (("paper_scores", scores), ("promotion_candidates", candidates)):
        out.append(issue(rows.where(F.coalesce(F.trim(key), F.lit("")) == ""), f"{name}_without_id", F.lit("")))
        out.append(issue(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"{name}_repeated", F.col(key)))
        out.append(issue(pool.select(key).join(rows.select(key), key, "left_anti"), f"{name}_missing", F.col(key)))
        out.append(issue(rows.select(key).join(pool.select(key), key, "left_anti"), f"{name}_extra", F.col(key)))
    before = F.lag(score).over(Window.partitionBy(F.floor(F.col("ord") / 4096)).orderBy("ord"))
    # the order is checked within blocks of places, and between the blocks by their ends
    inside = candidates.withColumn("_before", before).where(F.col("_before") < F.col(score))
    ends = candidates.groupBy(F.floor(F.col("ord") / 4096).alias("block")).agg(F.min_by(score, "ord").alias("first"), F.max_by(score, "ord").alias("last"))
    following = ends.select((F.col("block") - 1).alias("block"), F.col("first").alias("next_first"))
    across = ends.join(following, "block").where(F.col("last") < F.col("next_first"))
    out.append(issue(inside.select(F.col(key).alias("d")).unionByName(across.select(F.col("block").cast("string").alias("d"))), "candidates_not_sorted", F.col("d")))
    expected = promoted(scores, threshold, key, score)
    out.append(issue(expected.select(key).join(promoted_ids.select(key), key, "left_anti"), "not_promoted", F.col(key)))
    out.append(issue(promoted_ids.select(key).join(expected.select(key), key, "left_anti"), "wrongly_promoted", F.col(key)))
    result = out[0]
    for x in out[1:]:
        result = result.unionByName(x)
    return result

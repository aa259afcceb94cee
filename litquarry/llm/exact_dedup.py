"""Exact deduplication by progressive refinement, in DataFrame operations only.

Texts are compared after a normalisation (by default every run of ASCII white space becomes one space). Rows are
refined by the length of the normalised text, then by a hash of its first characters, then by its full SHA-256; each
step keeps only rows whose group still has two members. What is shuffled is a narrow row of a length and two hashes per
document, never a text, and each count is combined on the map side, so a group that holds a third of all rows costs one
row per task. What a step decides is written to the shared folder before rows are joined to it: with plain exchanges on both
sides adaptive execution splits the partition of a hot length or group.

The SHA-256 is a column of the result for every row, so it is made in the one scan that also normalises the text, which costs
several times as much; the refinement decides which rows are grouped by it. A length that all blank texts share is one key.

Defined results: a very long text is hashed whole; a null text counts as empty; empty texts are equal to one another; of equal texts the smallest id stays,
null ids count as larger than all others, and of repeated rows with that id exactly one stays; an empty table gives an
empty result; columns other than the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh

#: Characters of the normalised text that the second refinement hashes.
PREFIX_CHARS = 256
#: Decisions, of about a hundred bytes each, that go out to the texts; of more, the texts are shuffled to them.
BROADCAST_ROWS = 1 << 19
_LAST = (1 << 63) - 1


def collapse_space(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=collapse_space, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_norm_chars."""
    norm = docs.select(F.col(id_col).alias("doc_id"), normalise(F.col(text_col)).alias("norm"))
    keys = norm.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.length("norm").alias("len"),
        F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("head"),
        F.unhex(F.sha2(F.col("norm"), 256)).alias("sha"),
    )
    keys = cut(keys, "exact-keys")

    def refine(rows: DataFrame, by: list[str]) -> DataFrame:
        again = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*by)
        return rows.join(cut(again, "exact-again"), by, "left_semi")

    alike = refine(refine(keys, ["len"]), ["len", "head"])
    first = F.min(F.struct(F.coalesce(F.col("doc_id"), F.lit(_LAST)).alias("o"), F.col("row").alias("row"), F.col("doc_id").alias("doc_id")))
    groups = alike.groupBy("len", "head", "sha").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    return keys.join(cut(groups, "exact-groups"), ["len", "head", "sha"], "left").select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first").isNull() | (F.col("first.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.col("len").cast("long").alias("n_norm_chars"),
        F.col("row").alias("row_number_in_scan"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without later copies, with all their columns.

    Decisions are joined back by id and hash. Where rows with one id repeat a text that stays, one of them stays.
    """
    marked = exact_dedup(docs, id_col, text_col)
    said = marked.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(F.count_if("kept").alias("_stay"), F.count(F.lit(1)).alias("_n")).where("_stay = 0 or _n > 1")
    said = cut(said, "exact-said")
    own, stay, ident, sha = (fresh(docs.columns, n) for n in ("_own_sha", "_stay", "_id", "_sha"))
    few = said.count() <= BROADCAST_ROWS
    said = said.select(F.col("_id").alias(ident), F.col("_sha").alias(sha), F.col("_stay").alias(stay))
    said = F.broadcast(said) if few else said  # then no text is shuffled
    rows = docs.withColumn(own, F.sha2(collapse_space(F.col(text_col)), 256))
    rows = rows.join(said, rows[id_col].eqNullSafe(said[ident]) & (rows[own] == said[sha]), "left")
    single = rows.where(F.col(stay).isNull()).select(*docs.columns)
    repeated = rows.where(F.col(stay) > 0).dropDuplicates([id_col, own]).select(*docs.columns)
    return single.unionByName(repeated)

"""Outlines of a book: families of methods, and what to do with families of one.

An outline is a small document whose merge depends on the order of its steps, so it is folded by one Python function per
outline (``applyInPandas``); different outlines run apart.
"""

from __future__ import annotations

import copy
import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STANDALONE, STANDALONE_PART, STANDALONE_TITLE = "standalone", "standalone_methods", "Standalone / Emerging Methods"
RESERVED_TITLE = "Complementary Methods"


def evidence_score(neighbor_methods: list, neighbor_families: list, family_id: str, members: list) -> int:
    """Shared neighbours if there are two, or one that a link between the families backs; else 0."""
    shared = len(set(neighbor_methods or []) & set(members or []))
    return shared if shared >= 2 or shared and family_id in (neighbor_families or []) else 0


def family_scores(neighbors: DataFrame, members: DataFrame, linked: DataFrame) -> DataFrame:
    """(method, family, score) for each method and family that share a neighbour, by the rule of ``evidence_score``.

    ``neighbors`` has (method, neighbor), ``members`` (family, method), ``linked`` (method, family): which families a method is linked with.
    A neighbour's families come to its methods as one list, and links are counted with what is shared and not joined to it.
    """
    listed = members.groupBy(F.col("method").alias("neighbor")).agg(F.collect_set(F.struct("family")).alias("_families"))
    shared = neighbors.distinct().join(listed, "neighbor").select("method", F.inline("_families")).withColumns({"_n": F.lit(1), "_linked": F.lit(False)})
    links = linked.select("method", "family", F.lit(0).alias("_n"), F.lit(True).alias("_linked")).where("method is not null and family is not null")
    counts = shared.unionByName(links).groupBy("method", "family").agg(F.sum("_n").alias("_n"), F.bool_or("_linked").alias("_linked")).where("_n > 0")
    return counts.select("method", "family", F.when((F.col("_n") >= 2) | F.col("_linked"), F.col("_n")).otherwise(0).alias("score"))


class _Book:
    def __init__(self, outline: dict):
        self.out = copy.deepcopy(outline)
        self.families = {f["id"]: f for f in self.out.get("families", [])}
        self.methods = {m["id"]: m for m in self.out.get("methods", [])}
        self.parts = self.out.setdefault("parts", [])

    def large(self) -> list[dict]:
        return [f for f in self.families.values() if f["id"] != STANDALONE and len(f.get("method_ids") or []) > 1]

    def move(self, method: str, family: str) -> None:
        target = self.families[family]
        target["method_ids"] = [*(target.get("method_ids") or []), method]
        self.methods[method]["family_id"] = family

    def drop(self, family: str) -> None:
        self.families.pop(family, None)
        for part in self.parts:
            part["family_ids"] = [x for x in part.get("family_ids") or [] if x != family]

    def open_standalone(self) -> None:
        if STANDALONE in self.families:
            return
        self.families[STANDALONE] = {"id": STANDALONE, "title": STANDALONE_TITLE, "method_ids": [], "neighbor_family_ids": [], "is_group": True}
        part = next((p for p in self.parts if p["id"] == STANDALONE_PART), None)
        if part is None:
            self.parts.append({"id": STANDALONE_PART, "title": STANDALONE_TITLE, "family_ids": [STANDALONE]})
        elif STANDALONE not in (part.get("family_ids") or []):
            part["family_ids"] = [*(part.get("family_ids") or []), STANDALONE]

    def result(self) -> dict:
        self.out["families"] = list(self.families.values())
        return prune_links(self.out)


def prune_links(outline: dict) -> dict:
    """Neighbours that are there and are not the thing itself."""
    for things, field in (("families", "neighbor_family_ids"), ("methods", "neighbor_method_ids")):
        ids = {x["id"] for x in outline.get(things) or []}
        for x in outline.get(things) or []:
            if x.get(field) is not None:
                x[field] = [n for n in x[field] if n in ids and n != x["id"]]
    return outline


def merge_singletons(outline: dict) -> dict:
    """Families of one method join the family with most evidence (ties by id), else the standalone group.

    Where there is one larger family only and two or more of one method, the last two by id become a family of their own.
    """
    book = _Book(outline)
    single = sorted(f["id"] for f in book.families.values() if len(f.get("method_ids") or []) == 1 and f["id"] != STANDALONE)
    if not single:
        return prune_links(book.out)
    member = {f: book.families[f]["method_ids"][0] for f in single}
    pair = single[-2:] if len(book.large()) == 1 and len(single) > 1 else []
    if pair:
        book.families[pair[0]] |= {"title": RESERVED_TITLE, "method_ids": [], "neighbor_family_ids": []}
    for family in single:
        if family in pair:
            book.move(member[family], pair[0])
            if family != pair[0]:
                book.drop(family)
            continue
        method, near = book.methods[member[family]], book.families[family].get("neighbor_family_ids")
        scored = [(-s, f["id"]) for f in book.large() if f["id"] != family and (s := evidence_score(method.get("neighbor_method_ids"), near, f["id"], f["method_ids"]))]
        if not scored:
            book.open_standalone()
        book.move(member[family], min(scored)[1] if scored else STANDALONE)
        book.drop(family)
    book.out["parts"] = [p for p in book.parts if p.get("family_ids") or p.get("id") == STANDALONE_PART]
    return book.result()


def merge_all(outlines: DataFrame, key: str = "outline_id", column: str = "outline") -> DataFrame:
    """Outlines as JSON texts, merged; one row in, one row out."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(**{column: frame[column].map(lambda t: json.dumps(merge_singletons(json.loads(t)), sort_keys=True))})

    rows = outlines.select(key, column)
    return rows.groupBy(key).applyInPandas(run, rows.schema)


def singletons_left(families: DataFrame) -> DataFrame:
    return families.where((F.size("method_ids") == 1) & (F.col("id") != STANDALONE)).select("id")


def targets(families: DataFrame, methods: DataFrame, sections: list[str]) -> DataFrame:
    """(kind, id, ord): what a book is written for: its fixed sections, families that are no groups, methods."""
    spark = families.sparkSession
    book = spark.createDataFrame([("book", s, i) for i, s in enumerate(sections)], "kind string, id string, ord long")
    f = families.where(~F.coalesce("is_group", F.lit(False))).select(F.lit("families").alias("kind"), "id", F.col("ord").cast("long").alias("ord"))
    m = methods.select(F.lit("methods").alias("kind"), "id", F.col("ord").cast("long").alias("ord"))
    return book.unionByName(f).unionByName(m)



"""Scores and dates as Column expressions. The reference year is always a parameter, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of the best slot in which a concept stands.
SLOT_WEIGHTS = {"title": 1.0, "method": 0.8, "result": 0.8, "abstract": 0.6, "reader_needed": 0.4, "mention": 0.2}
OLDEST_AGE = 6


def impact(citations: Column, year: Column, now: int) -> Column:
    """Citations, citations a year and recency in one score; 0 without a year, with a later year or negative citations."""
    age = F.greatest(F.lit(1), F.lit(now) - year + 1)
    total = F.least(F.lit(1.0), F.log1p(citations) / F.log1p(F.lit(10000.0)))
    pace = F.least(F.lit(1.0), F.log1p(citations / age) / F.log1p(F.lit(1000.0)))
    fresh = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - (age - 1) / F.lit(float(OLDEST_AGE))))
    score = F.round(0.40 * total + 0.35 * pace + 0.25 * fresh, 6)
    return F.when((citations >= 0) & (year <= now), score).otherwise(F.lit(0.0))


def slot_weight(slots: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in SLOT_WEIGHTS.items() for x in kv])
    return F.coalesce(F.array_max(F.transform(slots, lambda s: F.coalesce(F.try_element_at(known, s), F.lit(0.2)))), F.lit(0.2))


def importance(papers: Column, core: Column, slots: Column, method_of_core: Column) -> Column:
    score = 0.35 * (F.least(core, F.lit(3)) / 3) + 0.25 * (F.least(papers, F.lit(5)) / 5) + 0.25 * slot_weight(slots) + 0.15 * F.when(method_of_core, 1.0).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def final_score(topic: Column, degree: Column, most_degree: Column, citations: Column, year: Column, implementation: Column, need: Column, gap_boost: Column) -> Column:
    central = F.when(most_degree > 0, degree / most_degree).otherwise(F.lit(0.0))
    cited = F.log1p(citations) / F.log1p(F.lit(10000.0))
    fresh = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (year - 2018) / F.lit(8.0)))
    return 0.35 * topic + 0.20 * central + 0.15 * cited + 0.10 * fresh + 0.10 * implementation + 0.10 * need + F.least(gap_boost, F.lit(0.20))


def recent_months(day: Column, n: int = 12) -> Column:
    """The last n months up to the one of ``day`` as YYYY-MM, oldest first."""
    return F.reverse(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.date_format(F.add_months(F.trunc(day, "month"), -i), "yyyy-MM")))


def month(value: Column, year: Column) -> Column:
    """YYYY-MM of a month written so, or as a number beside a year; null if it is no month."""
    full = F.regexp_extract(value, r"^(\d{4})-(\d{1,2})$", 1)
    number = F.when(full != "", F.regexp_extract(value, r"^(\d{4})-(\d{1,2})$", 2)).otherwise(F.regexp_extract(value, r"^(\d{1,2})$", 1)).try_cast("int")
    y = F.when(full != "", full.try_cast("int")).otherwise(year)
    return F.when(number.between(1, 12) & y.isNotNull(), F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(number.cast("string"), 2, "0")))


def year_window(start: Column, end: Column) -> Column:
    """The parameter start-end of a search, null where both are."""
    return F.when(start.isNotNull() | end.isNotNull(), F.concat(F.coalesce(start.cast("string"), F.lit("")), F.lit("-"), F.coalesce(end.cast("string"), F.lit(""))))


def limited(n: Column, most: int) -> Column:
    """A request's limit, at most what the source takes; raises below 1."""
    return F.when(F.assert_true(n >= 1).isNull(), F.least(n, F.lit(most)))

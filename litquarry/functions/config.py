"""Settings as Column expressions, and a dataclass of settings read once on the driver.

A value comes from the first place that has one: an override, a file, a default. Broken values raise; they are never guessed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text

# How a switch is written, and how long to wait where a service does not say.
ON, OFF = ("1", "true", "yes", "on"), ("0", "false", "no", "off")
BACKOFF_SECONDS, MEMORY_ENTRIES = 30.0, 256


def switch(value: Column, default: bool | None = None) -> Column:
    """A switch as a boolean, the default where it is missing or blank; raises for anything else."""
    low = F.lower(text.strip(value))
    known = F.when(low.isin(*ON), True).when(low.isin(*OFF), False)
    blank = F.coalesce(low, F.lit("")) == ""
    checked = F.when(F.assert_true(blank | known.isNotNull(), F.concat(F.lit("no switch: "), value)).isNull(), known)
    return F.when(blank, F.lit(default).cast("boolean")).otherwise(checked)


def key_list(value: Column, single: Column | None = None) -> Column:
    """Keys of a JSON list, or of a text with commas or line breaks between them, and a single further one; each once, quotes removed."""
    bare = lambda x: F.btrim(F.btrim(text.strip(x), F.lit('"')), F.lit("'"))
    v = F.coalesce(value, F.lit(""))
    listed = F.coalesce(F.from_json(v, "array<string>"), F.array().cast("array<string>"))
    split = F.split(v, r"[\n,]", -1)
    keys = F.when(F.startswith(text.strip(v), F.lit("[")), listed).otherwise(split)
    keys = F.concat(keys, F.array(F.coalesce(single, F.lit("")))) if single is not None else keys
    return F.array_distinct(F.filter(F.transform(keys, bare), lambda x: x != ""))


def capacity(value: Column, default: int = MEMORY_ENTRIES) -> Column:
    """A number of entries, at least none; the default where it is no number."""
    number = text.strip(value).try_cast("int")
    return F.coalesce(F.when(number.isNotNull(), F.greatest(F.lit(0), number)), F.lit(default))


def backoff_seconds(retry_after: Column, default: float = BACKOFF_SECONDS) -> Column:
    """How long a limited request waits: what the service says, if that is a number, else the default."""
    said = text.strip(retry_after).try_cast("double")
    return F.coalesce(F.when(said.isNotNull(), F.greatest(F.lit(0.0), said)), F.lit(default))


def retry_delay(attempt: Column, first: float = 2.0, most: float = 30.0, jitter: float = 0.2, draw: Column | None = None) -> Column:
    """The wait before the next try after ``attempt`` tries: doubled each time up to ``most``, moved by a draw from -1 to 1."""
    delay = F.least(F.lit(most), F.lit(first) * F.pow(F.lit(2.0), attempt - 1))
    return F.greatest(F.lit(0.0), delay + delay * jitter * (F.lit(0.0) if draw is None else draw))


def rotated(key_index: Column, keys: Column) -> Column:
    """The place of the next key; the same one where there is no other."""
    return F.when(keys < 2, key_index).otherwise((key_index + 1) % keys)


def year_range(now: Column, back: Column, ahead: Column) -> Column:
    """(start, end): years from offsets to the current one; null where an offset is."""
    return F.struct((F.year(now) - back).alias("start"), (F.year(now) + ahead).alias("end"))


def utc_stamp(at: Column) -> Column:
    """A time as ISO text in UTC, to the second, whatever the session's zone. Its time comes from the caller, never from the clock.

    A timestamp without a zone counts as one of the session's zone.
    """
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.date_format(start + F.make_dt_interval(secs=F.unix_seconds(at.cast("timestamp")).cast("decimal(18,6)")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def utc_text(at: datetime) -> str:
    """As ``utc_stamp`` for one time with a zone."""
    if at.tzinfo is None:
        raise ValueError("a stamp needs a time with a zone")
    return at.astimezone(UTC).isoformat(timespec="seconds")


def run_topic(config: Column, topic_text: Column, name: Column) -> Column:
    """A run's topic: from its configuration (JSON), else its topic file, else its name."""
    return F.coalesce(text.strip(text.or_default(F.get_json_object(config, "$.topic"))), text.strip(text.or_default(topic_text)), name)


@dataclass(frozen=True)
class Settings:
    """Typed settings of a search; every field may come from a file or an override."""

    normal_limit: int = 100
    survey_limit: int = 20
    min_citations: int = 0
    relevance_fail_open: bool = True
    memory_entries: int = MEMORY_ENTRIES

    @classmethod
    def resolve(cls, file_text: str | None, overrides: Mapping[str, str] | None = None, prefix: str = "LITQUARRY_") -> Settings:
        """File below override: ``overrides`` is usually the process environment, with names in capitals behind a prefix."""
        held = json.loads(file_text) if file_text and file_text.strip() else {}
        if not isinstance(held, dict):
            raise ValueError("settings are an object")
        out = {}
        for f in fields(cls):
            raw = (overrides or {}).get(prefix + f.name.upper(), held.get(f.name))
            if raw is None or isinstance(raw, str) and not raw.strip():
                continue
            if f.type == "bool":
                word = str(raw).strip().lower()
                if word not in ON + OFF:
                    raise ValueError(f"{f.name} is no switch: {raw!r}")
                out[f.name] = word in ON
            else:
                out[f.name] = int(raw)
        return cls(**out)

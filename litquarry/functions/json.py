"""JSON values: lenient parsing, dotted lookups, hashes."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def safe_get(value: Column, path: str, default: str | None = None) -> Column:
    """A dotted path in a JSON text as a string: exact key, else the first that differs in case only; numbers index lists."""
    for key in path.split("."):
        if key.isdigit():
            here = F.get_json_object(value, f"$[{key}]")
            value = F.coalesce(here, F.get_json_object(value, f"$['{key}']"))
        else:
            fields = F.from_json(value, "map<string,string>")
            other = F.get(F.filter(F.map_entries(fields), lambda e: F.lower(e["key"]) == key.lower()), F.lit(0))["value"]
            exact = F.try_element_at(fields, F.lit(key))
            value = F.when(F.map_contains_key(fields, key), exact).otherwise(other)
    return F.coalesce(value, F.lit(default)) if default is not None else value


def event_id(fields: list[str]) -> Column:
    """Sixteen digits of the SHA-256 of these columns as JSON, in the order of their names."""
    return F.substring(F.sha2(F.to_json(F.struct(*sorted(fields))), 256), 1, 16)


def search_key(query: Column, years: Column, least: Column, limit: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in (query, years, least, limit)])


def string_list(value: Column) -> Column:
    """Items of a text, one a line, or between commas where it has one line at most; blanks dropped."""
    rows = F.filter(F.transform(F.split(value, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    items = F.filter(F.transform(F.split(value, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when((F.size(rows) <= 1) & F.contains(value, F.lit(",")), items).otherwise(rows)


def listed_ids(response: Column, allowed: Column) -> Column:
    """Ids in the first list of a free text that are allowed, each once, in the text's order."""
    inside = F.regexp_extract(response, r"\[([\s\S]*?)\]", 1)
    found = F.regexp_extract_all(inside, F.lit("""["']([^"']+)["']"""), F.lit(1))
    return F.array_intersect(F.array_distinct(F.transform(found, lambda x: F.trim(x))), allowed)


_ESCAPE = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?$)', re.S)


def _with_valid_escapes(text: str) -> str:
    """Within strings, a backslash that begins no escape of JSON is doubled."""
    return _ESCAPE.sub(lambda m: re.sub(r"\\(?:([\"\\/bfnrtu])|([\s\S]|$))", lambda e: e[0] if e[1] else "\\\\" + e[2], m[0]), text)


def parse_lenient(text: str | None):
    """The value of a JSON text, of its fenced block, or of either with escapes made valid; ValueError if none is JSON."""
    plain = (text or "").strip()
    fenced = re.search(r"```(?:json)?\s*(.*?)```", plain, re.S | re.I)
    for part in dict.fromkeys([plain] + ([fenced[1].strip()] if fenced and fenced[1].strip() else [])):
        for attempt in dict.fromkeys([part, _with_valid_escapes(part)]):
            try:
                return json.loads(attempt)
            except ValueError:
                continue
    raise ValueError("no JSON")


@pandas_udf(StringType())
def repair_json(texts: pd.Series) -> pd.Series:
    """Canonical JSON with sorted keys, null where nothing can be parsed."""

    def one(t):
        try:
            return json.dumps(parse_lenient(t), sort_keys=True, ensure_ascii=False)
        except ValueError:
            return None

    return texts.map(one)


#: A JSON string, with the colon behind it where it is a key.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*+:)?+'


def string_leaves(value: Column | str) -> Column:
    """All strings within a JSON value, at any depth and in order; keys are not values. Null for what is no JSON, and for objects that repeat a key.

    The value is checked as a variant; in a text that is JSON, a string is a value unless a colon follows it.
    """
    value = F.col(value) if isinstance(value, str) else value
    found = F.array_join(F.filter(F.regexp_extract_all(value, F.lit(_STRING), F.lit(0)), lambda x: ~F.endswith(x, F.lit(":"))), ",")
    return F.when(F.try_parse_json(value).isNotNull(), F.from_json(F.concat(F.lit("["), found, F.lit("]")), "array<string>"))


def text_at(value: Column, path: str) -> Column:
    """The text at a path of a variant, without blanks around it; null where there is none, where it is blank, or no string."""
    here = F.try_variant_get(value, path, "variant")
    own = F.regexp_replace(F.try_variant_get(value, path, "string"), r"^\s+|\s+$", "")
    return F.when((F.schema_of_variant(here) == "STRING") & (own != ""), own)


#: Fields that may name a concept, in the order in which they are looked at.
CONCEPT_FIELDS = ("concept", "name", "title", "text")


def concept_text(value: Column | str) -> Column:
    """The text of a concept that is given as a JSON string or as an object with one of several fields; empty where there is none."""
    item = F.try_parse_json(F.col(value) if isinstance(value, str) else value)
    return F.coalesce(text_at(item, "$"), *[text_at(item, f"$.{name}") for name in CONCEPT_FIELDS], F.lit(""))


def first_text(items: Column | str, field: str, default: str) -> Column:
    """The first text that is not blank at a field of the objects of a JSON list, else the default. A number counts as its digits, as does true."""
    listed = F.from_json(items, "array<string>")
    said = F.transform(listed, lambda x: F.regexp_replace(F.try_variant_get(F.try_parse_json(x), f"$.{field}", "string"), r"^\s+|\s+$", ""))
    return F.coalesce(F.get(F.filter(said, lambda t: t.isNotNull() & (t != "")), F.lit(0)), F.lit(default))

"""Personal data in texts, in DataFrame operations only.

Regular expressions propose spans, validators confirm them (the Luhn sum of a card number, the mod-97 sum of an IBAN,
the range of an address part, the number of digits of a phone number) and words in the neighbourhood adjust a score.

A span's place comes from splitting the text at the matches: the gaps and the matches are listed by the same left-to-right
search, so their running lengths give start and end in code points. The expressions are possessive and begin where a run
of their characters begins, so a long run without a match costs one pass over it and no stack. They find what the plain
forms find: a run that fails from its first character fails from each later one.

Defined results: a null text counts as empty and has no spans; rows repeat as in the input; every text is read whole;
columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in the order in which they are listed, and what each looks like.
BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9_])",
}
#: A text without this has no match, which spares the search.
NEEDS = {"email": "@", "phone": "+"}
#: Words that raise a span's score when they stand near it, by kind.
CONTEXT_WORDS = {
    "email": "e-?mail|contact|write to|correo|courriel|kontakt",
    "ip": "ip|address|host|server|login|adresse",
    "card": "card|visa|mastercard|amex|credit|payment|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|fax|telefon|teléfono|téléphone",
    "iban": "iban|bank|account|konto|cuenta|compte",
}
#: They stand alone: no letter, digit or underscore touches them.
CONTEXT = {k: rf"(?:^|[^\p{{L}}\p{{N}}_])(?:{words})(?:$|[^\p{{L}}\p{{N}}_])" for k, words in CONTEXT_WORDS.items()}
#: What a confirmed span scores without context, by kind, and what context adds.
SCORE = {"email": 0.8, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT_BONUS, CONTEXT_CHARS = 0.1, 40
#: Matches that are placed in one fold.
BLOCK = 64


def luhn(match: Column) -> Column:
    """Whether the digits of a match pass the Luhn sum."""
    digits = F.split(F.reverse(F.regexp_replace(match, "[^0-9]", "")), "")
    value = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether an IBAN's check sum is 1: country and check digits go last, a letter counts 10 to 35."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    step = lambda a, c: F.when(F.ascii(c) >= 65, (a * 100 + F.ascii(c) - 55) % 97).otherwise((a * 10 + F.ascii(c) - 48) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _valid(kind: str, match: Column) -> Column:
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    if kind == "ip":
        # the length comes first: a part of many digits is no number that fits
        return F.forall(F.split(match, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(digits.between(12, 19), luhn(match)).otherwise(False)
    if kind == "phone":
        return digits.between(9, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; within a lambda a plain expression is computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(kind: str, order: int, text: Column) -> Column:
    """The confirmed spans of a kind: (start, order, end, kind, score), start and end in code points, end exclusive."""
    empty = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,match:string>>")
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda g: F.length(g))
    hits = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    # the text after the last match is a gap without a match
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda p: p["hit"].isNotNull())

    def step(state, pair):
        begin = state["at"] + pair["gap"]
        end = begin + F.length(pair["hit"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), pair["hit"].alias("match")))).alias("out"))

    # A fold copies what it has gathered at each step; blocks keep that short for a text with very many matches.
    def in_blocks(p):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")), lambda b: F.slice(p, b * BLOCK + 1, BLOCK))

    def begins(blocks):
        length = lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x["gap"] + F.length(x["hit"]))
        return F.aggregate(F.transform(blocks, length), F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))

    def place(blocks, at):
        return F.flatten(F.transform(blocks, lambda block, b: F.aggregate(block, F.struct(F.get(at, b).alias("at"), empty.alias("out")), step, lambda s: s["out"])))

    placed = _let(pairs, lambda p: F.when(F.size(p) > 0, _let(in_blocks(p), lambda blocks: _let(begins(blocks), lambda at: place(blocks, at)))).otherwise(empty))
    right = F.filter(placed, lambda s: _valid(kind, s["match"]))

    def scored(s):
        near = F.concat(
            F.substring(text, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT_CHARS))),
            F.lit(" | "),
            F.substring(text, s["end"] + 1, F.lit(CONTEXT_CHARS)),
        )
        score = F.lit(SCORE[kind]) + F.when(near.rlike("(?iu)" + CONTEXT[kind]), F.lit(CONTEXT_BONUS)).otherwise(0.0)
        return F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind"), score.alias("score"))

    found = F.transform(right, scored)
    none = F.from_json(F.lit("[]"), "array<struct<start:int,order:int,end:int,kind:string,score:double>>")
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(none) if kind in NEEDS else found


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and ``found``, an array of (start, order, end, kind, score) by start, then kind."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kinds = BASE_KINDS + ADDED_KINDS
    each = text.select("doc_id", *[_spans(k, i, F.col("text")).alias(k) for i, k in enumerate(kinds)])
    return each.select("doc_id", F.array_sort(F.concat(*kinds)).alias("found"))


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, a hash of the base spans, all spans as text, and the score of each span."""
    found = find_pii(docs, id_col, text_col)
    base = F.filter("found", lambda s: s["order"] < len(BASE_KINDS))
    count = lambda i: F.size(F.filter("found", lambda s: s["order"] == i)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS + ADDED_KINDS)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )

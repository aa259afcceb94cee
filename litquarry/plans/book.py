"""Queries over a book that the test tables are shaped into: suppliers are methods, nations families, regions parts.

The relations are written once, in SQL that Spark and DuckDB both run; the rules are the operators' on one side and SQL on the other.
Faults are planted by arithmetic on the keys of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import book as B
from ..operators import outline, quality
from ..sources.adapter import table
from ..sources.landing import spread
from .registry import query

_NL = "chr(10)"
#: Rows of a base table that a task makes relations of; a chapter has up to ten kilobytes.
CHAPTERS = 2000


def _chapter(heads: list[str], words: int, bodies: dict[str, str] | None = None, front: str = "''", tail: str = "''") -> str:
    """SQL of a chapter's text: a heading and so many words each."""
    parts = " || ".join(f"'{h}' || {_NL} || {(bodies or {}).get(h) or f'repeat({chr(39)}word {chr(39)}, {words})'} || {_NL}" for h in heads)
    return f"{front} || '# Title' || {_NL} || {parts} || {tail}"


_M, _F = B.METHOD_HEADINGS, B.FAMILY_HEADINGS
_FRONT = f"'---' || {_NL} || 'chapter_id: m' || s_suppkey || {_NL} || 'status: excluded_too_short' || {_NL} || 'status_reason: \"why\"' || {_NL} || '---' || {_NL}"
_OUTLINE = " || ".join(f"'- {n}.1 Part of it' || {_NL}" for n in range(1, 10))

REL = {
    "b_methods": "SELECT CASE WHEN s_suppkey % 40 = 7 THEN 'm' || (s_suppkey - 1) WHEN s_suppkey % 50 = 9 THEN s_suppkey || '-problem-formulation' ELSE 'm' || s_suppkey END AS id, 'Title ' || (s_suppkey % 5) AS title, CASE WHEN s_suppkey % 30 = 4 THEN 'a' || (s_suppkey - 1) WHEN s_suppkey % 33 = 5 THEN '' ELSE 'a' || s_suppkey END AS paper_id, CASE WHEN s_suppkey % 37 = 8 THEN 'f99' ELSE 'f' || s_nationkey END AS family_id, s_suppkey AS ord FROM supplier",
    "b_families": "SELECT 'f' || n_nationkey AS id, CASE n_nationkey % 6 WHEN 1 THEN 'Reaches 3x' WHEN 2 THEN n_name || ' uses 3 models' WHEN 3 THEN n_name || repeat(' long', 20) ELSE replace(n_name, '_', ' ') END AS title, n_nationkey = 24 AS is_group, n_nationkey AS ord FROM nation",
    "b_members": "SELECT 'f' || s_nationkey AS family_id, 'm' || s_suppkey AS method_id, s_suppkey AS ord FROM supplier WHERE s_suppkey % 13 <> 3 AND s_nationkey <> 23 UNION ALL SELECT 'f' || ((s_nationkey + 1) % 25), 'm' || s_suppkey, s_suppkey FROM supplier WHERE s_suppkey % 29 = 6",
    "b_parts": "SELECT 'p' || r_regionkey AS id, r_name AS title, r_regionkey AS ord FROM region UNION ALL SELECT 'standalone_methods', 'Standalone', 9",
    "b_placed": "SELECT 'p' || n_regionkey AS part_id, 'f' || n_nationkey AS family_id, n_nationkey AS ord FROM nation WHERE n_nationkey <> 11 UNION ALL SELECT 'p0', 'f6', 100",
    "b_sections": "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{k.replace('_', ' ').title()}', {i})" for i, k in enumerate(B.BOOK_FILES)) + ") AS t(id, title, ord)",
    "b_promoted": "SELECT 'a' || s_suppkey AS paper_id FROM supplier",
    "b_verified": "SELECT 'a' || s_suppkey AS paper_id FROM supplier WHERE s_suppkey % 9 <> 0",
    "b_chapters": f"""SELECT 'methods' AS kind, 'm' || s_suppkey AS id, CASE s_suppkey % 8
        WHEN 1 THEN {_chapter(_M[:-1], 160)} WHEN 2 THEN {_chapter([_M[1], _M[0], *_M[2:]], 150)} WHEN 3 THEN {_chapter(_M, 20)}
        WHEN 4 THEN {_chapter(_M, 160, {"## Theory": "'[arxiv:1]'"})} WHEN 5 THEN {_chapter(_M, 150, tail=_OUTLINE)} WHEN 7 THEN {_chapter(_M, 150, front=_FRONT)} ELSE {_chapter(_M, 150)} END AS text
      FROM supplier WHERE s_suppkey % 8 <> 6
      UNION ALL SELECT 'families', 'f' || n_nationkey, CASE n_nationkey % 5 WHEN 1 THEN {_chapter([*_F, "## Further"], 110)} WHEN 2 THEN {_chapter(_F, 30)} WHEN 3 THEN {_chapter(_F, 110, tail="'This FILE is  regenerated deterministically'")} ELSE {_chapter(_F, 110)} END FROM nation WHERE n_nationkey % 5 <> 4
      UNION ALL SELECT 'book', 'method_taxonomy', string_agg(link, ' ') FROM (SELECT '(../families/f' || n_nationkey || '.md)' AS link FROM nation WHERE n_nationkey % 4 <> 1 UNION ALL SELECT '(../methods/m' || s_suppkey || '.md)' FROM supplier WHERE s_suppkey % 5 <> 2) AS l""",
    "b_files": "SELECT * FROM (VALUES " + ", ".join(f"('{v}')" for k, v in B.BOOK_FILES.items() if k not in ("goals", "appendices")) + ", ('appendices/glossary.md'), ('appendices/notation.md')) AS t(path)",
    "b_packs": "SELECT 'm' || s_suppkey AS method_id, section, CASE WHEN section = 'Limitations' AND s_suppkey % 4 = 1 THEN ' ' WHEN section = 'Theory' AND s_suppkey % 7 = 3 THEN '' ELSE 'text' END AS section_text FROM supplier, (VALUES ('Theory'), ('Algorithm'), ('Example'), ('Limitations')) AS t(section) WHERE s_suppkey % 6 <> 5",
    "b_manifest": "SELECT 'm' || s_suppkey AS chapter_id, 'method' AS chapter_type, CASE s_suppkey % 4 WHEN 0 THEN 'excluded_too_short' ELSE 'passed' END AS status, 1400 + s_suppkey % 300 AS word_count FROM supplier UNION ALL SELECT 'f' || n_nationkey, 'family', CASE n_nationkey % 4 WHEN 0 THEN 'missing' ELSE 'passed' END, 900 + n_nationkey * 10 FROM nation",
    "b_excluded": "SELECT 'm' || s_suppkey AS id FROM supplier WHERE s_suppkey % 8 = 7 UNION ALL SELECT 'f3' UNION ALL SELECT 'goals'",
}
_BASE = ("region", "nation", "supplier", "part", "orders", "customer")


def rel(spark, d: str, name: str) -> DataFrame:
    """A relation from its SQL; the test tables are its only sources."""
    text, used = REL[name].replace("{", "{{").replace("}", "}}"), {}
    for t in _BASE:
        if f"FROM {t}" in text:
            text = text.replace(f"FROM {t}", f"FROM {{{t}}}")
            used[t] = spread(table(spark, d, t), CHAPTERS)
    return spark.sql(text, **used)


def over(body: str, *names: str, **more: str) -> str:
    """SQL over relations of this module."""
    defined = [*[(n, REL[n]) for n in names], *more.items()]
    return ("WITH " + ",\n".join(f"{n} AS ({t})" for n, t in defined) + "\n" if defined else "") + body


def _rules(**codes: str) -> str:
    """A union of violations: for each code the SQL that lists the details."""
    return "\nUNION ALL ".join(f"SELECT '{'warning' if c == 'chapter_not_passed' else 'error'}' AS severity, '{c}' AS code, cast(d AS VARCHAR) AS detail FROM ({q}) AS x(d)" for c, q in codes.items())


@query("book_part_issues", over(_rules(
    empty_part="SELECT id FROM b_parts WHERE id NOT IN (SELECT part_id FROM b_placed)",
    family_in_multiple_parts="SELECT family_id || ' ' || part_id FROM (SELECT family_id, part_id, row_number() OVER (PARTITION BY family_id ORDER BY p.ord, q.ord) AS nth FROM b_placed q JOIN b_parts p ON p.id = part_id) WHERE nth > 1",
    family_unassigned_to_part="SELECT id FROM b_families WHERE id NOT IN (SELECT family_id FROM b_placed)",
), "b_parts", "b_placed", "b_families"))
def _(spark, d):
    return B.part_issues(rel(spark, d, "b_parts"), rel(spark, d, "b_placed"), rel(spark, d, "b_families"))


@query("book_part_count", over(_rules(parts_count_out_of_range="SELECT count(*) FILTER (id <> 'standalone_methods') FROM b_parts, (VALUES (0), (1)) AS t(k)"), "b_parts"))
def _(spark, d):
    twice = rel(spark, d, "b_parts").withColumn("id", F.explode(F.array("id", F.when(F.col("id") == "standalone_methods", F.col("id")).otherwise(F.concat("id", F.lit("x"))))))
    return B.part_issues(twice, rel(spark, d, "b_placed"), rel(spark, d, "b_families"))


_LISTED = "SELECT m.id, m.family_id, count(x.family_id) AS listed, min(x.family_id) AS first_family FROM b_methods m LEFT JOIN b_members x ON x.method_id = m.id GROUP BY m.id, m.family_id, m.ord"


@query("book_outline_issues", over(_rules(
    duplicate_method_id="SELECT id FROM b_methods GROUP BY id HAVING count(*) > 1",
    promoted_paper_without_method="SELECT paper_id FROM b_verified WHERE paper_id NOT IN (SELECT paper_id FROM b_methods)",
    promoted_paper_with_multiple_methods="SELECT paper_id FROM b_methods WHERE paper_id IN (SELECT paper_id FROM b_verified) GROUP BY paper_id HAVING count(*) > 1",
    unverified_promoted_paper_with_method="SELECT DISTINCT paper_id FROM b_methods WHERE paper_id IN (SELECT paper_id FROM b_promoted) AND paper_id NOT IN (SELECT paper_id FROM b_verified)",
    noisy_family_title="SELECT id FROM b_families WHERE ord % 6 IN (1, 2, 3)",
    family_without_methods="SELECT id FROM b_families WHERE id NOT IN (SELECT family_id FROM b_members)",
    family_references_missing_method="SELECT family_id || ' ' || method_id FROM b_members WHERE method_id NOT IN (SELECT id FROM b_methods)",
    duplicate_family_title="SELECT lower(title) || ' ' || string_agg(id, ',' ORDER BY id) FROM b_families GROUP BY lower(title) HAVING count(*) > 1",
    method_family_id_missing="SELECT id FROM b_methods WHERE family_id NOT IN (SELECT id FROM b_families)",
    method_not_listed_in_family="SELECT id FROM listed WHERE listed = 0",
    method_listed_in_multiple_families="SELECT id FROM listed WHERE listed > 1",
    method_family_id_mismatch="SELECT id FROM listed WHERE listed = 1 AND first_family <> family_id",
    section_heading_method_id="SELECT id FROM b_methods WHERE ord % 50 = 9 AND ord % 40 <> 7",
), "b_methods", "b_families", "b_members", "b_promoted", "b_verified", listed=_LISTED))
def _(spark, d):
    return B.outline_issues(*[rel(spark, d, f"b_{n}") for n in ("methods", "families", "members", "sections", "promoted", "verified")])


@query("book_sections_order", over(_rules(invalid_book_sections="SELECT string_agg(id, ',' ORDER BY ord) FROM b_sections WHERE id <> 'goals'"), "b_sections"))
def _(spark, d):
    wrong = rel(spark, d, "b_sections").where("id <> 'goals'")
    rows = B.outline_issues(rel(spark, d, "b_methods"), rel(spark, d, "b_families"), rel(spark, d, "b_members"), wrong, rel(spark, d, "b_promoted"), rel(spark, d, "b_verified"))
    return rows.where("code = 'invalid_book_sections'")


_OWN = "SELECT id, cast(substr(id, 2) AS INTEGER) AS k FROM (SELECT DISTINCT id FROM b_methods) WHERE id LIKE 'm%'"


@query("book_chapter_issues", over(_rules(
    missing_book_chapter="VALUES ('goals'), ('appendices')",
    missing_family_chapter="SELECT id FROM b_families WHERE NOT is_group AND ord % 5 = 4",
    missing_method_chapter="SELECT DISTINCT id FROM b_methods WHERE id NOT IN (SELECT id FROM b_chapters WHERE kind = 'methods')",
    method_taxonomy_missing_family_link="SELECT id FROM b_families WHERE NOT is_group AND ord % 4 = 1",
    method_taxonomy_missing_method_link="SELECT DISTINCT id FROM b_methods WHERE (id NOT LIKE 'm%' OR id IN (SELECT id FROM own WHERE k % 5 = 2)) AND id NOT IN (SELECT id FROM own WHERE k % 8 = 7)",
    wrong_chapter_headings="SELECT 'families/' || id FROM b_families WHERE NOT is_group AND ord % 5 = 1 UNION ALL SELECT 'methods/' || id FROM own WHERE k % 8 IN (1, 2)",
    family_chapter_word_count_low="SELECT id FROM b_families WHERE NOT is_group AND ord % 5 = 2",
    family_placeholder_prose="SELECT id FROM b_families WHERE NOT is_group AND ord % 5 = 3",
    method_chapter_word_count_low="SELECT id FROM own WHERE k % 8 = 3",
    method_chapter_copied_source_outline="SELECT id FROM own WHERE k % 8 = 5",
    method_chapter_citation_only_section="SELECT id || ':theory' FROM own WHERE k % 8 = 4",
), "b_methods", "b_families", "b_chapters", own=_OWN))
def _(spark, d):
    return B.chapter_issues(*[rel(spark, d, f"b_{n}") for n in ("chapters", "families", "methods", "files")])


@query("book_pack_issues", over(_rules(
    missing_method_pack="SELECT DISTINCT id FROM b_methods WHERE id NOT IN (SELECT method_id FROM b_packs)",
    method_pack_missing_required_section_text="SELECT method_id || ' ' || string_agg(lower(section), ',' ORDER BY section) FROM b_packs WHERE trim(section_text) = '' AND method_id IN (SELECT id FROM b_methods) GROUP BY method_id",
), "b_methods", "b_packs"))
def _(spark, d):
    return B.pack_issues(rel(spark, d, "b_methods"), rel(spark, d, "b_packs"))


@query("book_manifest_issues", over(_rules(
    passed_method_chapter_word_count_low="SELECT chapter_id FROM b_manifest WHERE status = 'passed' AND chapter_type = 'method' AND word_count < 1500",
    passed_family_chapter_word_count_low="SELECT chapter_id FROM b_manifest WHERE status = 'passed' AND chapter_type = 'family' AND word_count < 1000",
    chapter_not_passed="SELECT chapter_type || ':' || chapter_id FROM b_manifest WHERE status <> 'passed'",
), "b_manifest"))
def _(spark, d):
    return B.manifest_issues(rel(spark, d, "b_manifest"))


@query("method_memberships", over("SELECT id AS method_id, family_id, listed, first_family FROM listed", "b_methods", "b_members", listed=_LISTED))
def _(spark, d):
    return B.memberships(rel(spark, d, "b_methods"), rel(spark, d, "b_members"))


@query("excluded_chapters", "SELECT 'methods' AS kind, 'm' || s_suppkey AS id, 'excluded_too_short' AS status, 'why' AS reason FROM supplier WHERE s_suppkey % 8 = 7")
def _(spark, d):
    return B.excluded_chapters(rel(spark, d, "b_chapters"))


@query("chapter_measures", "SELECT s_suppkey AS k, 3 + s_suppkey % 3 + s_suppkey % 4 AS words, 2 AS equations, 1 AS pseudocode, s_suppkey % 3 AS citations, s_suppkey % 4 AS copied FROM supplier")
def _(spark, d):
    k = F.col("s_suppkey")
    text = F.concat(F.lit("---\nx: y z\n---\none $$a$$ $$ two $$\n```\n```\n"), F.repeat(F.lit("[arxiv:]"), F.lit(0)), F.repeat(F.lit("[arxiv:*]"), F.lit(0)), F.lit(""))
    rows = table(spark, d, "supplier").select(k, text.alias("t")).withColumn("t", F.concat("t", F.repeat(F.lit("[arxiv:-]"), (k % 3).cast("int")), F.repeat(F.lit("\n- Baselines."), (k % 4).cast("int"))))
    m = B.measures(rows.select(F.lit("methods").alias("kind"), k.cast("string").alias("id"), F.col("t").alias("text")))
    return m.select(F.col("id").cast("int").alias("k"), "words", "equations", "pseudocode", "citations", "copied")


@query("chapter_currency", "SELECT 'm' || s_suppkey AS id, s_suppkey % 3 <> 1 AS current FROM supplier")
def _(spark, d):
    s = table(spark, d, "supplier")
    ident = F.concat(F.lit("m"), F.col("s_suppkey").cast("string")).alias("id")
    image = F.concat(F.lit("![x](y"), F.col("s_suppkey").cast("string"), F.lit(".png)"))
    chapters = s.select(F.lit("methods").alias("kind"), ident, F.concat(F.lit("before "), F.when(F.col("s_suppkey") % 3 == 0, image).otherwise("")).alias("text"))
    packs = s.select(F.lit("methods").alias("kind"), ident, F.when(F.col("s_suppkey") % 3 != 2, image).otherwise(" ").alias("markdown_image"))
    return B.current_chapters(chapters, packs).select("id", "current")


@query("chapter_manifest", over("""SELECT 'family' AS chapter_type, 'f' || n_nationkey AS chapter_id, CASE WHEN n_nationkey % 3 = 0 THEN 'excluded_missing_verification' WHEN n_nationkey % 3 = 1 THEN 'passed' ELSE 'excluded_too_short' END AS status,
    CASE WHEN n_nationkey % 3 = 1 THEN 1200 WHEN n_nationkey % 3 = 2 THEN 700 WHEN n_nationkey % 2 = 0 THEN 5 ELSE 0 END AS word_count, CASE WHEN n_nationkey % 3 = 1 THEN 7 WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END AS equations, 0 AS pseudocode, '14_chapters/families/f' || n_nationkey || '.md' AS file FROM nation"""))  # fmt: skip
def _(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", F.lit("families").alias("kind"), F.concat(F.lit("f"), F.col("n_nationkey").cast("string")).alias("id"))
    texts = n.where("n_nationkey % 2 = 0").select("kind", "id", F.lit("one two $$x$$ four five").alias("text"))
    seen = n.where("n_nationkey % 3 <> 0").select("kind", "id", F.when(F.col("n_nationkey") % 3 == 1, 1200).otherwise(700).alias("word_count"), F.when(F.col("n_nationkey") % 3 == 1, 7).otherwise(0).alias("equations"), F.lit(0).alias("pseudocode"), (F.col("n_nationkey") % 3 == 1).alias("passed"))
    none = F.lit(0)
    ladder = quality.chapter_status(F.col("kind"), F.col("verified"), F.array().cast("array<string>"), F.col("word_count"), F.col("passed"), none, none, none)
    return B.chapter_manifest(n.select("kind", "id"), texts, seen, ladder)


@query("shard_rows_merged", "SELECT shard, n, line FROM (SELECT n_nationkey AS shard, k AS n, 'row ' || n_nationkey || ' ' || k || CASE WHEN n_nationkey % 2 = 0 THEN ' new' ELSE ' old' END AS line FROM nation, (VALUES (1), (3)) AS t(k) WHERE n_nationkey % 5 <> 4)")
def _(spark, d):
    n = table(spark, d, "nation").where("n_nationkey % 5 <> 4")
    shard = F.col("n_nationkey").alias("shard")
    body = lambda place: F.concat(F.lit("head\nrow "), F.col("n_nationkey").cast("string"), F.lit(f" 1 {place}\n  \nrow "), F.col("n_nationkey").cast("string"), F.lit(f" 3 {place}\n"))
    files = n.where("n_nationkey % 2 = 0").select(shard, F.lit(0).alias("place"), body("new").alias("text")).unionByName(n.select(shard, F.lit(1).alias("place"), body("old").alias("text")))
    shards = table(spark, d, "nation").select(shard, F.col("n_nationkey").alias("ord"))
    return B.shard_rows(shards, files).select("shard", F.col("nth.n").alias("n"), "line")


@query("shard_items_merged", "SELECT n_nationkey AS shard, CASE WHEN n_nationkey % 3 = 0 THEN '{\"i\":' || k || '}' ELSE '{\"status\":\"completed\",\"x\":' || n_nationkey || '}' END AS item FROM nation, (VALUES (0), (1)) AS t(k) WHERE n_nationkey % 3 = 0 OR n_nationkey % 3 = 1 AND k = 0")
def _(spark, d):
    n = table(spark, d, "nation")
    k = F.col("n_nationkey").cast("string")
    report = F.when(F.col("n_nationkey") % 3 == 0, F.lit('{"status":"x","items":[{"i":0},{"i":1}]}')).when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit('{"status":"completed","x":'), k, F.lit("}"))).otherwise(F.lit('{"status":"failed","items":[]}'))
    rounds = n.select(F.col("n_nationkey").alias("shard"), F.lit(0).alias("place"), report.alias("report"))
    return B.shard_items(n.select(F.col("n_nationkey").alias("shard"), F.col("n_nationkey").alias("ord")), rounds).select("shard", "item")


_RENAME = "SELECT id AS old_id, CASE WHEN nth = 1 THEN 'title-' || t ELSE 'title-' || t || '-' || nth END AS new_id FROM (SELECT id, right(title, 1) AS t, row_number() OVER (PARTITION BY title ORDER BY ord) AS nth FROM b_methods WHERE ord % 50 = 9 AND ord % 40 <> 7)"


@query("heading_ids_renamed", over("SELECT * FROM renamed", "b_methods", renamed=_RENAME))
def _(spark, d):
    return B.heading_renames(rel(spark, d, "b_methods"))


@query("member_references_renamed", over("SELECT 'f' || (ord % 3) AS family_id, coalesce(new_id, id) AS method_id FROM b_methods LEFT JOIN renamed ON old_id = id", "b_methods", renamed=_RENAME))
def _(spark, d):
    m = rel(spark, d, "b_methods")
    members = m.select(F.concat(F.lit("f"), (F.col("ord") % 3).cast("string")).alias("family_id"), F.col("id").alias("method_id"))
    return B.rename_references(members, "method_id", B.heading_renames(m)).select("family_id", "method_id")


_FILES = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in B.BOOK_FILES.items()) + ") AS f(id, file)"
_ENTRIES = f"""SELECT 0 AS a, ord AS b, 0 AS c, 0 AS e, 1 AS depth, title, '14_chapters/book/' || file || CASE WHEN s.id = 'appendices' THEN '/glossary.md' ELSE '' END AS path FROM b_sections s JOIN {_FILES} USING (id) WHERE s.id NOT IN (SELECT id FROM b_excluded)
  UNION ALL SELECT ord, -1, 0, 0, 0, title, '' FROM b_parts
  UNION ALL SELECT p.ord, q.ord, 0, 0, 1, x.title, '14_chapters/families/' || x.id || '.md' FROM b_placed q JOIN b_parts p ON p.id = part_id JOIN b_families x ON x.id = family_id WHERE NOT is_group AND x.id NOT IN (SELECT id FROM b_excluded)
  UNION ALL SELECT p.ord, q.ord, 1, y.ord, CASE WHEN is_group OR x.id IN (SELECT id FROM b_excluded) THEN 1 ELSE 2 END, m.title, '14_chapters/methods/' || m.id || '.md' FROM b_placed q JOIN b_parts p ON p.id = part_id JOIN b_families x ON x.id = q.family_id JOIN b_members y ON y.family_id = x.id JOIN (SELECT id, max(title) AS title FROM b_methods GROUP BY id) m ON m.id = y.method_id WHERE m.id NOT IN (SELECT id FROM b_excluded)"""
_CONTENTS = ("sections", "parts", "placed", "families", "members", "methods", "excluded")


@query("book_contents", over("SELECT a, b, c, e, depth, title, path FROM entries", *[f"b_{n}" for n in _CONTENTS], entries=_ENTRIES))
def _(spark, d):
    rows = B.contents(*[rel(spark, d, f"b_{n}") for n in _CONTENTS])
    return rows.select(*[F.col(f"nth.n{i}").alias(x) for i, x in enumerate("abce")], "depth", "title", "path")


@query("book_summary", over("SELECT a, b, c, e, CASE WHEN depth = 0 THEN '## Part ' || a || ': ' || title ELSE repeat('  ', depth - 1) || '- [' || title || '](../' || path || ')' END AS line FROM entries", *[f"b_{n}" for n in _CONTENTS], entries=_ENTRIES))
def _(spark, d):
    rows = B.summary_lines(B.contents(*[rel(spark, d, f"b_{n}") for n in _CONTENTS]))
    return rows.select(*[F.col(f"nth.n{i}").alias(x) for i, x in enumerate("abce")], "line")


_TREE = "SELECT n_nationkey AS ord, '{\"title\":\"F' || n_nationkey || '\",\"path\":\"14_chapters/families/f' || n_nationkey || '.md\",\"children\":[{\"title\":\"\",\"path\":\"14_chapters/methods/m' || n_nationkey || '.md\",\"children\":[{\"title\":\"Deep\",\"path\":\"14_chapters/methods/d' || n_nationkey || '.mdx\",\"children\":[{\"title\":\"Deeper\",\"path\":\"x\"}]}]}]}' AS item FROM nation"
REL["b_tree"] = _TREE


@query("navigation_walk", "SELECT depth, CASE depth WHEN 0 THEN 'F' || n_nationkey WHEN 1 THEN '' WHEN 2 THEN 'Deep' ELSE 'Deeper' END AS title, CASE depth WHEN 0 THEN '14_chapters/families/f' || n_nationkey || '.md' WHEN 1 THEN '14_chapters/methods/m' || n_nationkey || '.md' WHEN 2 THEN '14_chapters/methods/d' || n_nationkey || '.mdx' ELSE 'x' END AS path FROM nation, range(4) t(depth)")
def _(spark, d):
    return B.walk(rel(spark, d, "b_tree")).select("depth", "title", "path")


@query("navigation_methods", "SELECT CASE k WHEN 'm' THEN 'm' || n_nationkey ELSE 'Deep' END AS title, 'methods/' || k || n_nationkey AS slug FROM nation, (VALUES ('m'), ('d')) AS t(k)")
def _(spark, d):
    return B.method_pages(B.walk(rel(spark, d, "b_tree"))).select("title", "slug")


@query("reachable_chapters", "SELECT '14_chapters/methods/m' || n_nationkey || '.md' AS path FROM nation")
def _(spark, d):
    chapters = table(spark, d, "customer").select(F.concat(F.lit("14_chapters/methods/m"), F.col("c_custkey").cast("string"), F.lit(".md")).alias("path"))
    return quality.reachable(chapters, B.walk(rel(spark, d, "b_tree")))


@query("publish_blockers", "SELECT 'error' AS severity, CASE WHEN s_suppkey % 3 = 0 THEN 'placeholder_id' ELSE 'context_only_page' END AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'method-2401-' || (10000 + s_suppkey) ELSE 'm' || s_suppkey END AS detail FROM supplier WHERE s_suppkey % 3 < 2")
def _(spark, d):
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(F.when(k % 3 == 0, F.concat(F.lit("method-2401-"), (10000 + k).cast("string"))).otherwise(F.concat(F.lit("m"), k.cast("string"))).alias("chapter_id"), F.when(k % 3 == 1, "A  Systematic Review of it").otherwise("Code review of it").alias("title"))
    return quality.publish_blockers(rows)


@query("dead_links", "SELECT 'error' AS severity, 'dead_link' AS code, n_name || ' -> r' || n_nationkey AS detail FROM nation WHERE n_nationkey > 4")
def _(spark, d):
    pages = table(spark, d, "nation").select(F.col("n_name").alias("page"), F.concat(F.lit("r"), F.col("n_nationkey").cast("string")).alias("target"))
    return quality.links(pages, table(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("target")))


@query("page_addresses", "SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN '' ELSE '/base/x' END || '/methods/m' || s_suppkey || '/' AS href, 'methods/m' || s_suppkey AS slug FROM supplier")
def _(spark, d):
    k = F.col("s_suppkey")
    base = F.when(k % 3 == 0, " / ").when(k % 3 == 1, "base/x/").otherwise("//base/x ")
    slug = B.path_slug(F.concat(F.lit("14_chapters/methods/m"), k.cast("string"), F.when(k % 2 == 0, ".md").otherwise(".mdx")))
    return table(spark, d, "supplier").select(k.alias("k"), B.href(base, F.concat(F.lit("/"), slug, F.lit("/"))).alias("href"), slug.alias("slug"))


@query("book_section_packs", "SELECT id AS section_id, (SELECT count(*) FROM nation) AS families, (SELECT count(*) FROM supplier) AS methods, title AS section_title FROM (" + REL["b_sections"] + ")")
def _(spark, d):
    concept = lambda t, c: table(spark, d, t).select(F.col(c).alias("concept"))
    n, s = table(spark, d, "nation").select(F.col("n_name").alias("id")), table(spark, d, "supplier").select(F.col("s_name").alias("id"))
    rows = B.book_packs(rel(spark, d, "b_sections"), "a topic", concept("region", "r_name"), concept("region", "r_name"), n, s)
    size = lambda f: F.size(F.from_json(F.get_json_object("pack", f"$.data.{f}"), "array<string>")).cast("long").alias(f)
    return rows.select("section_id", size("families"), size("methods"), F.get_json_object("pack", "$.section_title").alias("section_title"))


@query("packs_to_write", "SELECT k || s_suppkey AS id, CASE WHEN k = 'f' THEN CASE WHEN s_suppkey % 2 = 0 THEN 'skipped' ELSE 'built' END WHEN s_suppkey % 3 = 0 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'skipped' ELSE 'built' END ELSE 'left' END AS action FROM supplier, (VALUES ('f'), ('m')) AS t(k)")
def _(spark, d):
    k = F.explode(F.array(F.struct(F.lit("families").alias("kind"), F.lit("f").alias("x")), F.struct(F.lit("methods").alias("kind"), F.lit("m").alias("x")))).alias("t")
    rows = table(spark, d, "supplier").select("s_suppkey", k).select("s_suppkey", "t.kind", F.concat("t.x", F.col("s_suppkey").cast("string")).alias("id"))
    return B.packs_to_write(rows.select("kind", "id"), rows.where("s_suppkey % 2 = 0"), rows.where("s_suppkey % 3 = 0 and kind = 'methods'")).select("id", "action")


@query("book_targets", over("SELECT 'book' AS kind, id, ord FROM b_sections UNION ALL SELECT 'families', id, ord FROM b_families WHERE NOT is_group UNION ALL SELECT 'methods', id, ord FROM b_methods", "b_sections", "b_families", "b_methods"))
def _(spark, d):
    return outline.targets(rel(spark, d, "b_families"), rel(spark, d, "b_methods"), list(B.BOOK_FILES))


@query("singletons_left", over("SELECT family_id AS id FROM b_members GROUP BY family_id HAVING count(*) = 1", "b_members"))
def _(spark, d):
    return outline.singletons_left(rel(spark, d, "b_members").groupBy(F.col("family_id").alias("id")).agg(F.collect_list("method_id").alias("method_ids")))

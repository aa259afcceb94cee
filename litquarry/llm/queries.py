"""The queries of this subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from .alignment import align_documents
from .common import table
from .decontaminate import contaminated
from .exact_dedup import exact_dedup
from .language_id import identify
from .lexical_search import search
from .minhash import minhash_dedup
from .packing import pack_documents
from .pii import CONTEXT, CONTEXT_BONUS, SCORE, pii_digest
from .simhash import simhash_dedup
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .url_filter import filter_urls, rules_frame
from .warc import round_trip


def op1_substring_dedup(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_warc(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_pii(spark, sf_dir):
    return pii_digest(table(spark, sf_dir, "documents")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores")


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_simhash(spark, sf_dir):
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"), rules_frame(spark))


def op9_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def op10_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def op11_minhash(spark, sf_dir):
    return minhash_dedup(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark, sf_dir):
    return align_documents(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_warc": op2_warc,
    "op3_pii": op3_pii,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_simhash": op5_simhash,
    "op6_decontamination": op6_decontamination,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_language_id": op10_language_id,
    "op11_minhash": op11_minhash,
    "op12_token_alignment": op12_token_alignment,
    "op13_lexical_search": op13_lexical_search,
}

_PII_KIND = """
  SELECT doc_id, '{kind}' AS kind, {order} AS ord,
         list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s,
         hits[i] AS m
  FROM (SELECT doc_id, gaps, hits, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits FROM d))
"""
_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11,30}\b",
}

ORACLES = {
    "op1_substring_dedup": r"""WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents), s AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)), m AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM s), gone AS (
  SELECT DISTINCT doc_id, i + k AS p FROM m, range(50) t(k) WHERE first < doc_id), x AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d), k AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM x ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op2_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages), m AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM m""",
    "op3_pii": "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ("
    + " UNION ALL ".join(_PII_KIND.format(kind=k, order=i, pattern=p) for i, (k, p) in enumerate(_PII.items()))
    + r"""), g AS (
  SELECT *, s + length(m) AS e, regexp_replace(m, '[^0-9]', '', 'g') AS digits FROM f), c AS (
  SELECT * FROM g WHERE CASE kind
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(m, '.'), lambda p: length(ltrim(p, '0')) <= 3 AND coalesce(try_cast(p AS INTEGER), 0) <= 255))
    WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN cast(reverse(digits)[i] AS INTEGER)
           WHEN cast(reverse(digits)[i] AS INTEGER) > 4 THEN cast(reverse(digits)[i] AS INTEGER) * 2 - 9
           ELSE cast(reverse(digits)[i] AS INTEGER) * 2 END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    WHEN 'iban' THEN list_reduce(list_prepend(0, list_transform(string_split(replace(m, ' ', '')[5:] || replace(m, ' ', '')[1:4], ''), lambda x: ascii(x))),
      lambda a, x: CASE WHEN x >= 65 THEN (a * 100 + x - 55) % 97 ELSE (a * 10 + x - 48) % 97 END) = 1
    ELSE true END), x AS (
  SELECT c.*, substr(t, cast(greatest(s - 40, 0) + 1 AS BIGINT), cast(least(s, 40) AS BIGINT)) || ' | ' || substr(t, cast(e + 1 AS BIGINT), 40) AS near FROM c JOIN d USING (doc_id)), z AS (
  SELECT *, CASE kind """
    + " ".join(f"WHEN '{k}' THEN {SCORE[k]} + CASE WHEN regexp_matches(near, '(?i){CONTEXT[k]}') THEN {CONTEXT_BONUS} ELSE 0 END" for k in _PII)
    + r""" END AS score FROM x), o AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) FILTER (kind <> 'iban'), '') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans,
         string_agg(printf('%.2f', score::DOUBLE), ',' ORDER BY s, ord) AS scores
  FROM z GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN o USING (doc_id)""",
    "op7_exact_dedup": r"""WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)""",
    "op8_url_filter": r"""WITH u AS (
  SELECT page_id, url, strpos(coalesce(url, ''), '://') AS cut FROM pages), p AS (
  SELECT page_id,
         CASE WHEN cut > 0 THEN translate(regexp_extract(substr(url, cut + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN cut > 0 THEN regexp_extract(substr(url, cut + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM u), r(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')), m AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
    "op11_minhash": r"""WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents), s AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM d), n AS (
  SELECT r, count(*) AS n FROM s GROUP BY r), p AS (
  SELECT x.r AS a, y.r AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.r <> y.r GROUP BY ALL), e AS (
  SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)), t(r, other) AS (
  SELECT r, r FROM d UNION SELECT t.r, e.b FROM t JOIN e ON e.a = t.other), c AS (
  SELECT t.r, min(d.doc_id) AS component_id FROM t JOIN d ON d.r = t.other GROUP BY t.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM d JOIN c USING (r) LEFT JOIN n USING (r)""",
    "op13_lexical_search": r"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents), c AS (
  SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS volume FROM d WHERE len(w) > 0), i AS (
  SELECT item_id, term, count(*)::BIGINT AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL), t AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) GROUP BY ALL), f AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM t, c GROUP BY term, docs), s AS (
  SELECT item_id, r, doc_id, sum(q * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // volume))))::BIGINT AS score
  FROM i JOIN t USING (term) JOIN f USING (term), c GROUP BY item_id, r, doc_id), k AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 20""",
}

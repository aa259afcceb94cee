import hashlib
import io
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litquarry.llm import pii, url_filter, warc

PAGE = "page_id long, url string, html string, digest string, payload string, path string"


@pytest.fixture
def pages(spark):
    long, other = "<p>" + "x" * 200 + "</p>", "é" * 60
    rows = [(5, "http://a/\r\nb", long), (3, None, long), (4, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"), (9, "u", other), (1, "u", other), (9, "u", other), (None, "u", long), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    return spark.createDataFrame([(*r, "d", "p", "q") for r in rows], PAGE)


def test_round_trip_of_archives(spark, pages):
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()]
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    want, seen = [], set()
    for i, p in rows:
        first = min(j for j, q in rows if q == p and j is not None) if len(p) >= 100 else i
        same = first == i and (len(p) < 100 or (i, p) not in seen)
        seen.add((i, p))
        want.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if same else "revisit", None if same else first))
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_payloads_come_back(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/w"
    listed = spark.createDataFrame(warc.write_archives(warc.first_copies(pages), folder).collect())
    rows = warc.read_archives(spark, listed).collect()
    kept = {r.page_id: bytes(r.payload) for r in rows if r.record_type == "response"}
    assert kept[3].startswith(b"<p>x") and kept[10].count(b"WARC/1.1") == 20 and kept[4] == b""
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    assert not [p for p in (tmp_path / "w").iterdir() if p.name.endswith(".tmp")]


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGE)).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=3000), max_size=6), st.integers(1, 4000))
def test_reader_frames_records_in_any_chunks(payloads, chunk):
    raw = b"".join(warc.record(i, "u", p, hashlib.sha256(p).hexdigest(), False, None) for i, p in enumerate(payloads))
    stream = io.BytesIO(raw)
    got = [b.partition(b"\r\n\r\n")[2] for _, b in warc.members(lambda n: stream.read(min(n, chunk)))]
    assert got == payloads


def test_reader_refuses_broken_archives():
    raw = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), False, None)
    plain = zlib.decompress(raw, 31)
    read = lambda data: list(warc.members(io.BytesIO(data).read))
    assert read(plain)[0][1].endswith(b"payload")
    for bad in (raw[:-20], plain[:-6], plain.replace(b"Content-Length: ", b"Content-Lengt: "), b"nonsense\r\n\r\n", plain.replace(b"\r\n\r\npayload", b"\r\n\r\npayloads")):
        with pytest.raises(warc.WarcError):
            read(bad)
    with pytest.raises(warc.WarcError):
        warc.verify("sha256:00", b"x")
    assert warc.verify("sha1:" + __import__("base64").b32encode(hashlib.sha1(b"x").digest()).decode(), b"x") == hashlib.sha1(b"x").hexdigest()


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(out)]


def test_pii_is_brute_force(spark):
    rng = random.Random(2)
    bits = ["a@b.c", "é", "@", ".", "1", "255", "256", "4111 1111 1111 1111", "4111-1111", "+49 (30) 1234567", "+", " ", "-", "d@e", "_x@y.z.w", "10.0.0.1", "\U0001f600", "GB82 WEST 1234 5698 7654 32", "0", "..", "iban", "\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    texts += ["", None, "a@b.c" * 500, "1" * 30000, "1." * 9000, "x" * 60000 + "@", "+1" + "-" * 20000, "a@b.c_d@e.f", "5.6.7.8.9.10.11.12", "1234567890123456789012.1.2.3"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    got = {r.doc_id: r for r in pii.pii_digest(docs).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t or "")
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want, r.spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w.startswith(k + ":") for w in want) for k in PLAIN)
        assert [s for s in r.spans.split(",") if s and not s.startswith("iban:")] == want


def test_iban_and_context(spark):
    docs = spark.createDataFrame([(1, "my IBAN is GB82 WEST 1234 5698 7654 32, ok"), (2, "GB83 WEST 1234 5698 7654 32"), (3, "call +49 30 1234567 now"), (4, "xx +49 30 1234567 now")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pii_digest(docs).collect()}
    assert got[1].spans == "iban:11:38" and got[1].scores == "1.00" and got[2].spans == ""
    assert got[3].scores == "0.70" and got[4].scores == "0.60"


def test_no_documents(nothing):
    assert pii.pii_digest(nothing).collect() == []


def verdict(url, rules, default="allow"):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[2]), m[3]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits, default=None, key=lambda f: (-f[0], f[1]))
    return host, path, best and best[1], best[2] if best else default


def test_url_rules_are_brute_force(spark):
    rng = random.Random(4)
    rules = [*url_filter.RULES, ("block", "com", "/"), ("allow", "b.a.com", "/x"), ("block", "a.com", ""), ("allow", "net", "/"[:0]), ("block", "c.b.a.com", "/x/y"), ("allow", "xample.com", "/"), ("block", "a.com", "/x"), ("allow", "com", "/xy"), ("allow", "b.a.com", "/x/y"), ("block", "a.com", "/x/y/z")]
    hosts = ["net", "a.net", "EXAMPLE.net", "www.example.net", "notexample.net", "example.com", "a.com", "b.a.com", "c.b.a.com", "d.c.b.a.com", "org", "x.org", "", "a..com", "a.com:80", "com", "xample.com"]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/de/1', '/x', '/x/y', '/fr/', '?q=/en/', '#/de/'])}{rng.choice(['', '?a', '#b'])}" for _ in range(300)]
    urls += [None, "", "no address", "http:/x", "://", "http://a://b/c"]
    pages = spark.createDataFrame([(i, u, "r", "s", "k") for i, u in enumerate(urls)], "page_id long, url string, rule string, stack string, key string")
    got = url_filter.filter_urls(pages, url_filter.rules_frame(spark, rules + rules[:2]), salts=3).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == verdict(urls[r.page_id], rules), urls[r.page_id]


def test_of_equally_long_rules_the_smaller_text_wins(spark):
    pages = spark.createDataFrame([(1, "http://a.com/xyz"), (2, "http://" + "x." * 5000 + "com/xyz/" + "p" * 50_000)], "page_id long, url string")
    rules = url_filter.rules_frame(spark, [("block", "com", "/xyz"), ("allow", "a.com", "/x")])
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got == {1: ("a.com/x", "allow"), 2: ("com/xyz", "block")}


def test_a_large_payload_and_a_page_that_most_urls_return(spark):
    rows = [(i, "u", "<p>" + "e" * 300) for i in range(400)] + [(1000 + i, "u", "y" * (3 << 20) + str(i)) for i in range(3)] + [(2000, "u", "y" * (3 << 20) + "1")]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == 404 and got[0].record_type == "response" and all(got[i].refers_to == 0 for i in range(1, 400))
    assert got[1001].payload_bytes == (3 << 20) + 1 and got[2000].refers_to == 1001


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x")], "page_id long, url string")
    none = url_filter.rules_frame(spark, None).limit(0)
    assert [(r.rule, r.verdict) for r in url_filter.filter_urls(pages, none).collect()] == [(None, "allow")] * 2
    assert url_filter.filter_urls(pages.where(F.lit(False)), url_filter.rules_frame(spark)).collect() == []

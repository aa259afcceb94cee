"""WARC archives: a writer that stores equal payloads once, and a sequential reader.

Each record is a gzip member of its own. The reader takes a file in chunks, feeds them to an incremental inflater, frames
each record by its Content-Length, passes from member to member, and verifies the digests that a record states. It holds
one chunk and one record at a time.

Archives are files in a folder that all machines share. A task writes under a name that no other attempt uses and renames
the finished file, so a lost or repeated task leaves no partial archive; what is read back is the list of files that the
successful attempts returned.

Which payloads repeat is decided on narrow rows of a row number and a digest; payloads travel by row number only, so that a page
that very many urls return is spread over all tasks.

Defined results: a null html counts as empty; a null id is written as an empty name and read back as null; of rows with one
payload the one with the smallest id is the response, null ids last, and of several such rows one; the others revisit it (a
revisit of a row without an id refers to null); an empty table writes no archive and reads no record; columns other than the
id, the url and the html are not read. A payload is held whole, one at a time, with its record, so the largest needs a few
times its size of memory in one task. A record that breaks the framing or a stated digest raises.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh_path, shuffle_partitions

#: Payloads from this many bytes on are stored once; bytes after which a task begins another archive; bytes read at a time.
DEDUP_FROM, ARCHIVE_BYTES, CHUNK = 100, 64 << 20, 1 << 16
#: Reading tasks for each shuffle partition of the session, at most.
TASKS_EACH = 4
_DATE = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive that does not hold what its records say."""


def first_copies(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", dedup_from: int = DEDUP_FROM) -> DataFrame:
    """(page_id, url, payload, digest, revisit, refers_to): for long payloads but the first of its kind, revisit is true and
    refers_to the smallest id with the same payload."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = cut(rows.withColumn("digest", F.sha2("payload", 256)).withColumn("row", F.monotonically_increasing_id()), "warc-rows")
    narrow = cut(rows.where(F.octet_length("payload") >= dedup_from).select("row", "page_id", F.unhex("digest").alias("digest")), "warc-digests")
    one = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("first")
    again = cut(narrow.groupBy("digest").agg(one, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "warc-repeated")
    later = narrow.join(again, "digest").where("row != first.row").select("row", F.lit(True).alias("revisit"), F.col("first.page_id").alias("refers_to"))
    marked = rows.join(cut(later, "warc-revisits"), "row", "left")
    return marked.select("page_id", "url", "payload", "digest", F.coalesce("revisit", F.lit(False)).alias("revisit"), "refers_to")


def _head(lines: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def record(page_id: int | None, url: str, payload: bytes, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    """One gzip member with a response, or with a revisit that keeps the HTTP head only."""
    name = "" if page_id is None else str(page_id)
    http = _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", re.sub(r"[\r\n]", " ", url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if revisit:
        to = "" if refers_to is None else str(refers_to)
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{to}>")]
    raw = _head([*head, ("Content-Length", str(len(block)))], "WARC/1.1") + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``first_copies`` as archives; the result lists (path, n_records) and each use of it writes again."""

    def run(batches):
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        out, name, size, n, made = None, "", 0, 0, []
        for batch in batches:
            for i in range(batch.num_rows):  # one row at a time becomes Python's
                if out is None:
                    name, size, n = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/.{name}.tmp")
                member = record(*(column[i].as_py() for column in batch.columns))
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    system.move(f"{base}/.{name}.tmp", f"{base}/{name}")
                    made.append((f"{folder}/{name}", n))
                    out = None
        if out is not None:
            out.close()
            system.move(f"{base}/.{name}.tmp", f"{base}/{name}")
            made.append((f"{folder}/{name}", n))
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], names=["path", "n_records"])

    return rows.select("page_id", "url", "payload", "digest", "revisit", "refers_to").mapInArrow(run, "path string, n_records long")


def members(read) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head and block of each record, from a function that reads up to n bytes. Plain, unzipped archives work too."""
    raw, plain, ended = b"", bytearray(), False
    inflater, zipped = None, None

    def more() -> bool:
        """Inflate the next chunk; False at the end of the file."""
        nonlocal raw, inflater, zipped, ended
        if not raw and not ended:
            raw = read(CHUNK)
            ended = not raw
        if not raw:
            if inflater is not None:
                raise WarcError("the archive ends within a gzip member")
            return False
        zipped = raw[:1] == b"\x1f" if zipped is None else zipped
        if not zipped:
            plain.extend(raw)
            raw = b""
            return True
        inflater = inflater or zlib.decompressobj(31)
        plain.extend(inflater.decompress(raw, 1 << 20))
        raw = inflater.unconsumed_tail
        if inflater.eof:
            raw, inflater = inflater.unused_data, None
        return True

    while True:
        while plain[:2] == b"\r\n":
            del plain[:2]
        while (end := plain.find(b"\r\n\r\n")) < 0:
            if not more():
                if plain.strip():
                    raise WarcError("the archive ends within a record's head")
                return
            while plain[:2] == b"\r\n":
                del plain[:2]
        lines = plain[:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError(f"not the head of a record: {lines[0][:40]!r}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        try:
            n = int(head["content-length"])
        except (KeyError, ValueError):
            raise WarcError("a record without a valid Content-Length") from None
        del plain[: end + 4]
        while len(plain) < n + 4:
            if not more():
                raise WarcError("the archive ends within a record's block")
        if plain[n : n + 4] != b"\r\n\r\n":
            raise WarcError("a record's block is not as long as it says")
        block = bytes(plain[:n])
        del plain[: n + 4]
        yield head, block


def verify(stated: str | None, data: bytes) -> str | None:
    """Raise unless data has the stated digest (algorithm:value, hexadecimal or base 32); return its bare value."""
    if not stated:
        return None
    kind, _, value = stated.partition(":")
    try:
        digest = hashlib.new(kind.lower(), data)
    except ValueError:
        return None
    if value.lower() != digest.hexdigest() and value.upper() != base64.b32encode(digest.digest()).decode():
        raise WarcError(f"a digest differs from {stated}")
    return digest.hexdigest()


def _page_id(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


_READ = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_archives(spark: SparkSession, paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives that the column ``path`` names, each file read by one task from its start to its end."""
    schema = _READ if with_payload else _READ.remove(_READ.get_field_index("payload"))

    def rows(path: str) -> Iterator[dict]:
        system, name = _open(path)
        with system.open_input_stream(name, compression=None) as stream:
            for head, block in members(stream.read):
                kind = head.get("warc-type", "")
                verify(head.get("warc-block-digest"), block)
                payload, n = block, len(block)
                if head.get("content-type", "").startswith("application/http"):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
                    n = int(stated[1]) if stated else len(payload)
                digest = (head.get("warc-payload-digest") or ":").partition(":")[2]
                if kind == "revisit":
                    payload = None  # it is where the record refers to
                elif n != len(payload):
                    raise WarcError("a payload is not as long as its head says")
                else:
                    digest = verify(head.get("warc-payload-digest"), payload) or digest
                yield {"page_id": _page_id(head.get("warc-record-id")), "record_id": head.get("warc-record-id"), "record_type": kind, "target_uri": head.get("warc-target-uri"), "payload_bytes": n, "payload_digest": digest, "refers_to": _page_id(head.get("warc-refers-to")), "payload": payload}

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                for row in rows(path):
                    size += len(row["payload"] or b"") if with_payload else 64
                    held.append({k: row[k] for k in schema.names})
                    if size > 8 << 20 or len(held) >= 10_000:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    kinds = "page_id long, record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * with_payload
    return paths.select("path").mapInArrow(run, kinds)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives into a folder (by default a new one of the shared folder) and read their records back."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    listed = fresh_path(spark, "warc-list")
    write_archives(first_copies(pages), folder).write.parquet(listed)
    paths = spark.read.schema("path string, n_records long").parquet(listed)
    tasks = min(paths.count(), TASKS_EACH * shuffle_partitions(spark))  # as many as the session deals out, not as the corpus has archives
    return read_archives(spark, paths.repartition(max(1, tasks)), with_payload=False)

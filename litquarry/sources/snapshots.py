"""Snapshots as a data source with a commit of its own.

Each task writes its rows to a file of its own and says so in its commit message. Only when all tasks have, the driver writes one
small file, the version, that names the files, the number of rows and the time stamp; a reader takes the newest version. So a
reader sees the rows of one run or of another, never a part, a failed or repeated task leaves files that no version
names, and between two versions there is no moment without one. Old versions stay until ``expire``, files of failed runs until
``sweep``.

    rows.write.format("litquarry-snapshot").option("path", path).option("stamp", stamp).mode("append").save()
"""

from __future__ import annotations

import json
import posixpath
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def _opened(path: str):
    """A file system of ``pyarrow.fs`` and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: its file's name, or none where it had no rows, and how many rows."""

    name: str | None = None
    rows: int = 0


@dataclass
class SnapshotWriter(DataSourceWriter):
    path: str
    columns: list[str]
    stamp: str | None = None
    run: str = field(default_factory=lambda: uuid.uuid4().hex)

    def write(self, iterator) -> Written:
        """Records as lines of JSON, their fields in the order of names."""
        name = rows = None
        files, base = _opened(self.path)
        out = None
        try:
            for row in iterator:
                if out is None:
                    name, rows = f"data/{self.run}/{uuid.uuid4().hex}.json", 0
                    files.create_dir(posixpath.dirname(posixpath.join(base, name)), recursive=True)
                    out = files.open_output_stream(posixpath.join(base, name))
                record = dict(zip(self.columns, row, strict=True))
                out.write(json.dumps(record, sort_keys=True, ensure_ascii=False, default=str).encode() + b"\n")
                rows += 1
        finally:
            if out is not None:
                out.close()
        return Written(name, rows or 0)

    def commit(self, messages) -> None:
        files, base = _opened(self.path)
        done = [m for m in messages if m is not None and m.name]
        number = max([v for v, _ in _versions(files, base)], default=0) + 1
        version = {"version": number, "updated_at": self.stamp, "rows": sum(m.rows for m in done), "files": sorted(m.name for m in done)}
        target = posixpath.join(base, f"v{number:012d}.json")
        files.create_dir(base, recursive=True)
        with files.open_output_stream(f"{target}.{self.run}.tmp") as f:
            f.write(json.dumps(version, sort_keys=True).encode())
        if files.get_file_info(target).is_file:
            raise OSError(f"version {number} of {self.path} was made by another writer meanwhile")
        files.move(f"{target}.{self.run}.tmp", target)

    def abort(self, messages) -> None:
        """The files of the run go with their folder. A task that is still ending may put one there afterwards; no version names it (``sweep``)."""
        files, base = _opened(self.path)
        folder = posixpath.join(base, f"data/{self.run}")
        if files.get_file_info(folder).is_file is False and files.get_file_info(folder).type.name == "Directory":
            files.delete_dir(folder)


class SnapshotSource(DataSource):
    """Options: ``path``, a folder that all machines see, and ``stamp``, a text that the version carries."""

    @classmethod
    def name(cls) -> str:
        return "litquarry-snapshot"

    def writer(self, schema: StructType, overwrite: bool) -> SnapshotWriter:
        return SnapshotWriter(self.options["path"], schema.names, self.options.get("stamp"))


def _versions(files, base: str) -> list[tuple[int, str]]:
    from pyarrow import fs

    found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted((int(f.base_name[1:13]), f.path) for f in found if f.is_file and f.base_name.startswith("v") and f.base_name.endswith(".json"))


def save(rows: DataFrame, path: str, stamp: str | None = None) -> None:
    """A new version of the snapshot at ``path``, with the caller's stamp."""
    rows.sparkSession.dataSource.register(SnapshotSource)
    out = rows.write.format(SnapshotSource.name()).option("path", path)
    (out.option("stamp", stamp) if stamp is not None else out).mode("append").save()


def version(path: str) -> dict | None:
    """The newest version's record: version, updated_at, rows, files."""
    files, base = _opened(path)
    there = _versions(files, base)
    if not there:
        return None
    with files.open_input_stream(there[-1][1]) as f:
        return json.loads(f.read())


def load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the newest version; none where there is no version."""
    now = version(path)
    if now is None or not now["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([f"{path.rstrip('/')}/{name}" for name in now["files"]])


def expire(path: str, keep: int = 1) -> list[int]:
    """Drop all but the newest ``keep`` versions with the files that only they name; the numbers of those that went."""
    files, base = _opened(path)
    there = _versions(files, base)
    records = {}
    for number, p in there:
        with files.open_input_stream(p) as f:
            records[number] = json.loads(f.read())
    gone = [n for n, _ in there[: max(0, len(there) - max(1, keep))]]
    needed = {f for n in records if n not in gone for f in records[n]["files"]}
    for number, p in there:
        if number in gone:
            files.delete_file(p)
            for name in set(records[number]["files"]) - needed:
                files.delete_file(posixpath.join(base, name))
    return gone


def sweep(path: str) -> int:
    """Delete the files that no version names, as failed runs leave them; how many. To be called while nothing writes there."""
    from pyarrow import fs

    files, base = _opened(path)
    named = set()
    for _, p in _versions(files, base):
        with files.open_input_stream(p) as f:
            named |= {posixpath.join(base, name) for name in json.loads(f.read())["files"]}
    there = files.get_file_info(fs.FileSelector(posixpath.join(base, "data"), allow_not_found=True, recursive=True))
    gone = [f.path for f in there if f.is_file and f.path not in named]
    for p in gone:
        files.delete_file(p)
    return len(gone)

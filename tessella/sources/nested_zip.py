"""Archives of archives as tables: a Python data source with one partition for each inner archive.

Two relations: members without content decide what is kept; content is read for the kept ones only. A member's content
never influences a decision, so the metadata pass needs no decompression.
"""

from __future__ import annotations

import contextlib
import fnmatch
import hashlib
import io
import os
import tempfile
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessella.schemas import ScanError, SourceError

OUTER = "name string, ordinal int, is_dir boolean, file_size bigint"
MEMBERS = "container string, path string, ordinal int, is_dir boolean, file_size bigint, content binary, read_error string"
SPOOL_BYTES, CHUNK = 64 << 20, 1 << 20
#: zip features that this library can't read.
_UNREADABLE = (zipfile.BadZipFile, EOFError, NotImplementedError, RuntimeError, zlib.error)


class _Container(InputPartition):
    def __init__(self, name: str, seen: str):
        super().__init__(name)
        self.name, self.seen = name, seen


def identity(path: str) -> str:
    """Size and time of change of a file: what tells, without reading it, that it is the one that was looked at before."""
    return _identity(os.stat(path))


def _identity(s: os.stat_result) -> str:
    return f"{s.st_size}:{s.st_mtime_ns}"


@contextlib.contextmanager
def opened(path: str, seen: str | None = None) -> Iterator[zipfile.ZipFile]:
    """The archive, read through the one handle that its identity was taken from; an error if it isn't `seen`."""
    with open(path, "rb") as f:
        if seen and _identity(os.fstat(f.fileno())) != seen:
            raise SourceError(f"{path} has changed since it was first looked at")
        with zipfile.ZipFile(f) as z:
            yield z


def outer_members(path: str, seen: str | None = None) -> list[tuple[str, int, bool, int]]:
    with opened(path, seen) as z:
        return [(i.filename, n, i.is_dir(), i.file_size) for n, i in enumerate(z.infolist())]


def _reason(e: Exception) -> str:
    return "unsupported_compression" if isinstance(e, (NotImplementedError, RuntimeError)) else "corrupt_archive"


class NestedZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.glob = options["path"], options.get("containers", "*.jar")
        self.with_content = options.get("content", "false") == "true"
        self.sha256, self.seen, self.most = options.get("sha256"), options.get("seen"), int(options.get("max_resource_bytes", 1 << 62))

    def partitions(self):
        self.seen = self.seen or identity(self.path)
        if self.sha256 and fingerprint(self.path)[0] != self.sha256:
            raise SourceError("the archive isn't the expected one")
        return [_Container(n, self.seen) for n, _, is_dir, _ in sorted(outer_members(self.path, self.seen)) if not is_dir and fnmatch.fnmatchcase(n.lower(), self.glob.lower())]

    def read(self, partition: _Container) -> Iterator[tuple]:
        with opened(self.path, partition.seen) as outer, tempfile.SpooledTemporaryFile(SPOOL_BYTES) as spool:
            try:
                with outer.open(partition.name) as f:
                    while block := f.read(CHUNK):
                        spool.write(block)
                inner = zipfile.ZipFile(spool)
            except _UNREADABLE as e:
                yield partition.name, "", -1, False, 0, None, _reason(e)
                return
            with inner:
                for n, i in enumerate(inner.infolist()):
                    content, error = None, None
                    if self.with_content and not i.is_dir() and i.file_size <= self.most:
                        try:
                            content = inner.read(i)
                        except _UNREADABLE as e:
                            error = _reason(e)
                    yield partition.name, i.filename, n, i.is_dir(), i.file_size, content, error


class NestedZip(DataSource):
    """Options: path; containers (a glob on inner archives' names); content (true reads all members' bytes; `read_contents`
    reads chosen ones); sha256 (of the outer archive, checked before anything is read); seen (its `identity`, which each task
    checks on the handle it reads from); max_resource_bytes."""

    @classmethod
    def name(cls) -> str:
        return "nested_zip"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> NestedZipReader:
        return NestedZipReader(dict(self.options))


def read_outer(spark: SparkSession, path: str, seen: str | None = None) -> DataFrame:
    return spark.createDataFrame(outer_members(path, seen), OUTER)


def read_members(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(NestedZip)
    return spark.read.format("nested_zip").options(path=path, **options).load()


CONTENTS = "container string, path string, ordinal int, content binary, error string"


def read_contents(kept: DataFrame, path: str, seen: str | None = None) -> DataFrame:
    """Content (or why it can't be read) of the members (container, ordinal) of `kept`, and of no others: the ordinals of a
    container meet where it is opened, once. Rows of about CHUNK bytes leave together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, ordinals in zip(b.column("container").to_pylist(), b.column("ordinals").to_pylist(), strict=True):
                with opened(path, seen) as outer, tempfile.SpooledTemporaryFile(SPOOL_BYTES) as spool:
                    with outer.open(name) as f:
                        while block := f.read(CHUNK):
                            spool.write(block)
                    held, rows = 0, []
                    with zipfile.ZipFile(spool) as inner:
                        members = inner.infolist()
                        for n in sorted(ordinals):
                            content, error = None, None
                            try:
                                content = inner.read(members[n])
                            except _UNREADABLE as e:
                                error = _reason(e)
                            rows.append((name, members[n].filename, n, content, error))
                            held += len(content or b"")
                            if held >= CHUNK:
                                yield _contents(rows)
                                held, rows = 0, []
                    if rows:
                        yield _contents(rows)

    grouped = kept.groupBy("container").agg(F.collect_set("ordinal").alias("ordinals"))
    return grouped.mapInArrow(run, CONTENTS)


def _contents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["container", "path", "ordinal", "content", "error"])


def fingerprint(path: str) -> tuple[str, int]:
    """SHA-256 and size of a file, read in blocks."""
    h, n = hashlib.sha256(), 0
    with open(path, "rb") as f:
        while block := f.read(CHUNK):
            h.update(block)
            n += len(block)
    return h.hexdigest(), n


def validate_source(path: str, expected: dict, entry: str = "product-info.json", most: int = 1 << 20) -> dict:
    """The archive's identity (version, build_number, product_code, sha256), or an error on any difference."""
    from tessella.sources.jsonl import loads

    sha, size = fingerprint(path)
    if sha != expected["sha256"]:
        raise SourceError(f"archive has sha256 {sha}")
    try:
        with zipfile.ZipFile(path) as z:
            found = [i for i in z.infolist() if i.filename == entry]
            if len(found) != 1 or found[0].file_size > most or found[0].flag_bits & 1:
                raise SourceError(f"{entry} is missing, repeated, encrypted or too large")
            info = loads(z.read(found[0]).decode("utf-8"))
    except (*_UNREADABLE, ValueError) as e:
        raise e if isinstance(e, SourceError) else SourceError(f"{entry} can't be read: {e}") from e
    got = {"version": info.get("version"), "build_number": info.get("buildNumber"), "product_code": info.get("productCode")}
    for k, v in got.items():
        if not isinstance(v, str) or v != expected[k]:
            raise SourceError(f"{k} is {v!r}, not {expected[k]!r}")
    return got | {"sha256": sha, "size": size}


def zip_bytes(entries: dict[str, bytes]) -> bytes:
    """A canonical archive: entries by name, one fixed time, level 9, mode 0644."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name in sorted(entries):
            i = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            i.compress_type, i.external_attr, i.create_system = zipfile.ZIP_DEFLATED, 0o100644 << 16, 3
            z.writestr(i, entries[name], compresslevel=9)
    return out.getvalue()


def verify_zip(data: bytes) -> dict[str, bytes]:
    """The entries of an archive that `zip_bytes` would write just so; an error otherwise."""
    from tessella.schemas import PackageError

    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            entries = {i.filename: z.read(i) for i in z.infolist()}
            if len(entries) != len(z.infolist()):
                raise PackageError("repeated entry")
    except _UNREADABLE as e:
        raise PackageError(f"unreadable archive: {e}") from e
    if zip_bytes(entries) != data:
        raise PackageError("not in canonical form")
    return entries


def scan_limit(outer: DataFrame, most: int) -> DataFrame:
    if outer.count() > most:
        raise ScanError(f"more than {most} outer members")
    return outer

"""Strict JSON Lines: exact fields and types, no repeated keys, ids or non-finite numbers; and canonical writing."""

from __future__ import annotations

import gzip
import json
import os
import uuid
from collections.abc import Iterable, Iterator, Mapping
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.schemas import StateError


def _object(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise StateError("repeated key")
    return out


def _constant(name: str):
    raise StateError(f"{name} is no number")


def loads(text: str):
    try:
        return json.loads(text, object_pairs_hook=_object, parse_constant=_constant)
    except json.JSONDecodeError as e:
        raise StateError(f"malformed JSON: {e}") from None


_EXACT = {T.StringType: str, T.LongType: int, T.IntegerType: int, T.BooleanType: bool, T.DoubleType: float}


def check(value, kind: T.DataType, optional: bool = False, at: str = "record"):
    """The value, if it has exactly this type; nulls only where optional."""
    if value is None:
        if optional:
            return None
        raise StateError(f"{at} is null")
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict) or set(value) != set(kind.names):
            raise StateError(f"{at} hasn't just the fields {', '.join(kind.names)}")
        return {f.name: check(value[f.name], f.dataType, f.nullable, f"{at}.{f.name}") for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        if not isinstance(value, list):
            raise StateError(f"{at} is no list")
        return [check(v, kind.elementType, kind.containsNull, f"{at}[{i}]") for i, v in enumerate(value)]
    if isinstance(kind, T.MapType):
        if not isinstance(value, dict):
            raise StateError(f"{at} is no object")
        return {k: check(v, kind.valueType, kind.valueContainsNull, f"{at}.{k}") for k, v in value.items()}
    if type(value) is not _EXACT[type(kind)]:
        raise StateError(f"{at} is no {kind.simpleString()}")
    return value


def strict(schema: str | T.StructType, optional: Iterable[str] = ()) -> T.StructType:
    """The schema with every field required but the named ones, at all depths."""
    s, free = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema), set(optional)

    def harden(kind, name=""):
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, harden(f.dataType), f.name in free) for f in kind.fields])
        return T.ArrayType(harden(kind.elementType), False) if isinstance(kind, T.ArrayType) else kind

    return harden(s)


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType, key: str | None = None, optional: Iterable[str] = ()) -> DataFrame:
    """A table of strict JSON Lines (plain or .gz). Lines are parsed where they are read; an id that repeats is an error,
    found by one aggregate that carries ids only. A missing file is an empty table."""
    kind = strict(schema, optional)
    loose = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if "://" not in path and not os.path.exists(path):
        return spark.createDataFrame([], loose)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(loose)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for line in b.column(0).to_pylist():
                if not line.strip():
                    raise StateError("blank line")
                rows.append(check(loads(line), kind))
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    out = spark.read.text(path).mapInArrow(run, loose)
    key = key or next((c for c in ("resource_id", "id") if c in loose.names), None)
    if key:
        twice = out.groupBy(key).count().where("count > 1 OR length(" + key + ") = 0").limit(1).collect()
        if twice:
            raise StateError(f"empty or repeated id {twice[0][0]!r}")
    return out


def records(data: bytes, label: str, schema: str | T.StructType, key: str | None = None, optional: Iterable[str] = ()) -> list[dict]:
    """The records of a file that is in memory, as strict as `read_jsonl`; errors name the label and the line."""
    kind, seen, out = strict(schema, optional), set(), []
    key = key or next((c for c in ("resource_id", "id") if c in kind.names), None)
    try:
        lines = data.decode("utf-8").split("\n")
    except UnicodeDecodeError as e:
        raise StateError(f"{label}: {e}") from None
    for n, line in enumerate(lines[:-1] if lines[-1] == "" else lines, 1):
        try:
            if not line.strip():
                raise StateError("blank line")
            row = check(loads(line), kind)
            if key and (not row[key] or row[key] in seen):
                raise StateError(f"empty or repeated id {row[key]!r}")
        except StateError as e:
            raise StateError(f"{label}:{n}: {e}") from None
        if key:
            seen.add(row[key])
        out.append(row)
    return out


def read_together(spark: SparkSession, folder: str, schemas: Mapping[str, str | T.StructType], optional: Iterable[str] = ()) -> dict[str, DataFrame]:
    """The tables of a folder, each in NAME.jsonl.gz or else NAME.jsonl. Either all are there or none (then all are empty)."""
    at = {n: next((p for p in (f"{folder}/{n}.jsonl.gz", f"{folder}/{n}.jsonl") if os.path.exists(p)), None) for n in schemas}
    lost = sorted(n for n, p in at.items() if p is None)
    if lost and len(lost) < len(at):
        raise StateError(f"{folder} lacks {', '.join(lost)}")
    return {n: read_jsonl(spark, at[n] or f"{folder}/{n}.jsonl", s, optional=optional) for n, s in schemas.items()}


def canonical(row: dict) -> str:
    return json.dumps(row, ensure_ascii=False, allow_nan=False, sort_keys=True, separators=(",", ":"))


def canonical_lines(df: DataFrame) -> DataFrame:
    """(id, line): canonical JSON in the JVM, keys sorted at all depths."""

    def ordered(c, kind):
        if isinstance(kind, T.StructType):
            inner = F.struct(*(ordered(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)))
            return F.when(c.isNotNull(), inner)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
            return F.transform(c, lambda x: ordered(x, kind.elementType))
        return c

    key = next((c for c in ("resource_id", "id") if c in df.columns), None)
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    line = F.to_json(F.struct(*(ordered(F.col(f.name), f.dataType).alias(f.name) for f in fields)), {"ignoreNullFields": "false"})
    return df.select((F.col(key) if key else F.lit("")).alias("id"), line.alias("line"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """Part files of canonical lines, sorted by id and line across files."""
    canonical_lines(df).orderBy("id", "line").select("line").write.mode("overwrite").text(path, compression="gzip" if path.endswith(".gz") else "none")


def write_file(df: DataFrame, path: str | Path) -> None:
    """One file of canonical lines by id and line (.gz: compressed, without a time, so equal tables give equal bytes) in place of
    the old one by a rename. Executors sort; the driver holds a partition at a time."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    temp = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    try:
        with temp.open("xb") as f:
            packed = gzip.GzipFile("", "wb", fileobj=f, mtime=0) if path.name.endswith(".gz") else None
            for r in canonical_lines(df).orderBy("id", "line").toLocalIterator():
                (packed or f).write(r.line.encode("utf-8") + b"\n")
            if packed:
                packed.close()
            f.flush()
            os.fsync(f.fileno())
        temp.replace(path)
    finally:
        temp.unlink(missing_ok=True)


def serialize(rows: Iterable[dict]) -> bytes:
    """One file's canonical bytes, for tables that fit a driver (state files)."""
    keyed = sorted(((r.get("resource_id") or r.get("id") or ""), canonical(r)) for r in rows)
    return "".join(line + "\n" for _, line in keyed).encode("utf-8")


def gzip_bytes(data: bytes) -> bytes:
    return gzip.compress(data, mtime=0)

"""The work queue: at most one batch of open units in flight, exported, edited elsewhere, and imported whole or not at all."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import validation as V
from tessella.schemas import QueueError, UNIT
from tessella.sources.jsonl import canonical

SCHEMA_VERSION, MOST = 1, 1000
BATCHES = "batches"
FIXED = ("source", "source_sha256", "context", "status", "findings")


@dataclass
class Checkpoint:
    completed_sequence: int = 0
    current_sequence: int | None = None
    current_batch: str | None = None
    unit_ids: list[str] = field(default_factory=list)
    batch_digest: str | None = None
    schema_version: int = SCHEMA_VERSION

    def __post_init__(self):
        active = (self.current_sequence, self.current_batch, self.batch_digest)
        if self.schema_version != SCHEMA_VERSION or type(self.completed_sequence) is not int or self.completed_sequence < 0:
            raise QueueError("checkpoint of another version or with a bad sequence")
        if any(x is None for x in active) != all(x is None for x in active) or bool(self.unit_ids) != (self.current_sequence is not None):
            raise QueueError("checkpoint with half a batch")
        if any(type(x) is not str or not x for x in self.unit_ids):
            raise QueueError("checkpoint whose unit ids aren't texts")
        if self.current_sequence is not None:
            if self.current_sequence != self.completed_sequence + 1 or len(set(self.unit_ids)) != len(self.unit_ids) or len(self.unit_ids) > MOST:
                raise QueueError("checkpoint whose batch doesn't follow")
            if self.current_batch != batch_name(self.current_sequence, self.unit_ids[0]):
                raise QueueError("checkpoint with another batch's name")
            if type(self.batch_digest) is not str or not re.fullmatch("[0-9a-f]{64}", self.batch_digest):
                raise QueueError("checkpoint whose digest isn't one")

    def to_dict(self) -> dict:
        batch = self.current_batch
        return {"schema_version": self.schema_version, "completed_sequence": self.completed_sequence, "current_sequence": self.current_sequence, "current_batch": batch, "counts": {"exported": len(self.unit_ids)}, "unit_ids": self.unit_ids, "batch_digest": self.batch_digest, "next_command": f"import-batch {batch}" if batch else "next-batch"}

    @classmethod
    def from_dict(cls, d: dict) -> Checkpoint:
        """The checkpoint that `to_dict` writes just so; an error for any other record."""
        if type(d) is not dict or not {f.name for f in fields(cls)} <= d.keys() or type(d["unit_ids"]) is not list:
            raise QueueError("checkpoint with other fields")
        out = cls(**{f.name: d[f.name] for f in fields(cls)})
        if canonical(out.to_dict()) != canonical(d):
            raise QueueError("checkpoint whose count, command or fields don't follow from its batch")
        return out


def batch_name(sequence: int, first_id: str) -> str:
    return f"{sequence}-{first_id[:12]}.jsonl"


def open_units(units: DataFrame, limit: int) -> DataFrame:
    """The `limit` open units of the smallest ids: a top-k, so no global sort."""
    if type(limit) is not int or not 1 <= limit <= MOST:
        raise QueueError(f"limit must be between 1 and {MOST}")
    return units.where("status = 'open'").orderBy("id").limit(limit)


def digest(rows: list[dict], sequence: int, path: str) -> str:
    """Over everything that an editor may not change: the envelope and all fields but the target, in order."""
    fixed = [{k: v for k, v in r.items() if k not in ("target", "batch")} for r in rows]
    return hashlib.sha256(canonical({"schema_version": SCHEMA_VERSION, "sequence": sequence, "path": path, "unit_ids": [r["id"] for r in rows], "units": fixed}).encode()).hexdigest()


def export_next(units: DataFrame, checkpoint: Checkpoint, limit: int = 100) -> tuple[list[dict], Checkpoint]:
    """The next batch's rows and the checkpoint that records it; the same again while it is in flight; none if nothing is open."""
    if checkpoint.current_batch:
        rows = _rows(units.where(F.col("id").isin(*checkpoint.unit_ids)))
        if digest(rows, checkpoint.current_sequence, checkpoint.current_batch) != checkpoint.batch_digest:
            raise QueueError("units of the batch in flight have changed")
        return _sealed(rows, checkpoint), checkpoint
    rows = _rows(open_units(units, limit))
    if not rows:
        return [], checkpoint
    sequence = checkpoint.completed_sequence + 1
    name = batch_name(sequence, rows[0]["id"])
    now = Checkpoint(checkpoint.completed_sequence, sequence, name, [r["id"] for r in rows], digest(rows, sequence, name))
    return _sealed(rows, now), now


def _rows(units: DataFrame) -> list[dict]:
    return sorted((r.asDict(recursive=True) for r in units.limit(MOST).collect()), key=lambda r: r["id"])


def _sealed(rows: list[dict], c: Checkpoint) -> list[dict]:
    batch = {"schema_version": SCHEMA_VERSION, "sequence": c.current_sequence, "path": c.current_batch, "count": len(rows), "unit_ids": c.unit_ids, "digest": c.batch_digest}
    return [r | {"batch": batch} for r in rows]


def changed_fields(units: DataFrame, batch: DataFrame, fixed=FIXED) -> DataFrame:
    """(id, field) where a batch row differs from its unit in a field that is fixed, or has no unit (field `id`)."""
    b = batch.select(F.col("id"), *(F.col(c).alias(f"_{c}") for c in fixed)).join(units.select(F.col("id").alias("_id"), *fixed), F.col("id") == F.col("_id"), "left")
    fields = F.array(F.when(F.col("_id").isNull(), F.lit("id")), *(F.when(F.col("_id").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in fixed))
    return b.select("id", F.explode(F.filter(fields, lambda f: f.isNotNull())).alias("field"))


def upsert(units: DataFrame, replacements: DataFrame) -> DataFrame:
    """units with whole rows replaced where `replacements` (one row an id) has their id. The planner broadcasts a batch of the
    queue, which is a local table of at most MOST rows; a stream's may be larger and is joined as its size demands."""
    r = replacements.select(F.col("id").alias("_id"), F.struct(*units.columns).alias("_new"))
    j = units.join(r, units["id"] == r["_id"], "left")
    return j.select(*(F.when(F.col("_id").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in units.columns))


def import_batch(units: DataFrame, batch: list[dict], checkpoint: Checkpoint, glossary: dict | None = None) -> tuple[DataFrame, dict, Checkpoint]:
    """units with the batch's targets, counts of what came in, and the checkpoint after it. Any difference in what an editor
    may not change is an error and changes nothing; findings that block don't keep a batch out."""
    if not checkpoint.current_batch:
        raise QueueError("no batch in flight")
    names = {*units.columns, "batch"}
    if [r.get("id") for r in batch] != checkpoint.unit_ids or any(set(r) != names for r in batch):
        raise QueueError("other units, another order or other fields than exported")
    envelope = _sealed([{}] * 1, checkpoint)[0]["batch"] | {"count": len(batch)}
    if any(r["batch"] != envelope for r in batch) or digest(batch, checkpoint.current_sequence, checkpoint.current_batch) != checkpoint.batch_digest:
        raise QueueError("the batch isn't the exported one")
    if blank := [r["id"] for r in batch if r["source"].strip() and not r["target"].strip()]:
        raise QueueError(f"without target: {', '.join(blank)}")
    spark = units.sparkSession
    table = spark.createDataFrame([{k: v for k, v in r.items() if k != "batch"} for r in batch], UNIT)
    wrong = changed_fields(units, table).orderBy("id", "field").collect()
    if wrong:
        raise QueueError("changed: " + ", ".join(f"{r.id} {r.field}" for r in wrong))
    done = table.withColumn("findings", V.findings(F.col("source"), F.col("target"), glossary))
    done = done.withColumn("status", F.when(V.is_blocking(F.col("findings")), "translated").otherwise("technically_reviewed"))
    counts = done.agg(F.count(F.lit(1)).alias("imported"), F.count_if(F.col("status") == "technically_reviewed").alias("reviewed"), F.count_if(V.is_blocking(F.col("findings"))).alias("blocking")).first().asDict()
    return upsert(units, done.select(*units.columns)), counts, Checkpoint(checkpoint.current_sequence)

"""A workspace directory and the commands on it: scan, next-batch, import-batch, validate, generate, package, report, status."""

from __future__ import annotations

import contextlib
import fcntl
import json
import re
import threading
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import validation as V
from tessella.operators import inventory, queue, render, report, units
from tessella.operators.classify import ScanRules
from tessella.plans import publish
from tessella.plans.lineage import cut
from tessella.schemas import COLLISION, EXCLUSION, ConfigError, EngineError, OutputPathError, QueueError, RESOURCE, STALE_UNIT, StateError, UNIT
from tessella.sources import blobs, jsonl, nested_zip

PRODUCT_FIELDS = ("archive", "version", "build_number", "product_code", "sha256", "since_build", "until_build", "plugin_id", "plugin_version")
TABLES = {"resources": RESOURCE, "exclusions": EXCLUSION, "collisions": COLLISION, "units": UNIT, "stale_units": STALE_UNIT}
#: What the generated tree was made from, and its files.
MANIFEST = "reports/generation.json"
#: Used where config/descriptor.xml, a template with the same five placeholders, is missing.
DESCRIPTOR = '<plugin><id>{{id}}</id><version>{{version}}</version><product-version since-build="{{since}}" until-build="{{until}}"/><change-notes><![CDATA[{{notes}}]]></change-notes></plugin>'
#: Locks that this thread holds: by root, whether it is shared.
_HELD = threading.local()


class Workspace:
    """config/product.json, config/scanner.json, config/glossary.json and CHANGELOG.md are read; state/ holds generations of
    tables, blobs/ the kept members' contents by hash, batches/ the exported batch, generated/ the rendered tree, dist/ the package, reports/ the status,
    inventory/ the tables as canonical files."""

    def __init__(self, spark: SparkSession, root: str | Path):
        self.spark, self.root = spark, Path(root).resolve()
        self.state, self.blobs = publish.Versions(self.root / "state"), publish.Versions(self.root / "blobs")

    # configuration
    def product(self) -> dict:
        p = jsonl.loads((self.root / "config/product.json").read_text("utf-8"))
        if set(p) != set(PRODUCT_FIELDS) or any(not isinstance(v, str) or not v for v in p.values()):
            raise ConfigError("product.json needs just these texts: " + ", ".join(PRODUCT_FIELDS))
        if len(p["sha256"]) != 64 or set(p["sha256"]) - set("0123456789abcdef"):
            raise ConfigError("sha256 isn't one")
        for k in ("since_build", "until_build"):
            if not re.fullmatch(r"[0-9]+(?:\.[0-9]+)*(?:\.\*)?", p[k]):
                raise ConfigError(f"{k} is no build range: digits with dots, and .* at the end at most")
        return p

    def rules(self) -> ScanRules:
        return ScanRules.from_json((self.root / "config/scanner.json").read_text("utf-8"))

    def glossary(self) -> dict:
        path = self.root / "config/glossary.json"
        g = jsonl.loads(path.read_text("utf-8")) if path.exists() else {}
        if not isinstance(g, dict) or set(g) - {"preferred_terms", "retained_terms"}:
            raise ConfigError("glossary.json has preferred_terms and retained_terms only")
        preferred, retained = g.get("preferred_terms", {}), g.get("retained_terms", [])
        words = lambda v: isinstance(v, list) and all(isinstance(x, str) and x.strip() for x in v)
        if not isinstance(preferred, dict) or not words(list(preferred)) or not all(words([v] if isinstance(v, str) else v) for v in preferred.values()) or not words(retained):
            raise ConfigError("terms of the glossary are texts, or lists of texts")
        return g.get("preferred_terms", {}) | {t: [] for t in g.get("retained_terms", [])}

    @contextlib.contextmanager
    def locked(self, shared: bool = False):
        """One writer or many readers. Who holds the lock may take it again, but not write under a reader's lock, which two
        readers would wait for forever."""
        held = _HELD.__dict__
        if self.root in held:
            if held[self.root] and not shared:
                raise EngineError("a reader's lock can't become a writer's")
            yield
            return
        self.root.mkdir(parents=True, exist_ok=True)
        with (self.root / ".lock").open("a") as f:
            fcntl.flock(f, fcntl.LOCK_SH if shared else fcntl.LOCK_EX)
            held[self.root] = shared
            try:
                yield
            finally:
                del held[self.root]

    def recover(self) -> None:
        """What a command that was cut short left is undone, or done to its end."""
        self.state.recover()
        self.blobs.recover()
        publish.finish(self.root / "reports")

    def markers(self) -> list[str]:
        """What a command that was cut short left, until `recover` or the next generation clears it."""
        found = [*self.root.glob("generated.*"), *(v.root / n for v in (self.state, self.blobs) for n in v.leftover()), self.root / "reports" / publish.PENDING]
        return sorted(p.relative_to(self.root).as_posix() for p in found if p.exists())

    # state
    def table(self, name: str) -> DataFrame:
        now = self.state.current()
        if now is None:
            return self.spark.createDataFrame([], TABLES[name])
        if lost := sorted(n for n in TABLES if not (now / n).exists()):
            raise StateError(f"the state lacks {', '.join(lost)}; remove state/CURRENT to begin anew")
        return self.spark.read.parquet(str(now / name))

    def checkpoint(self) -> queue.Checkpoint:
        now = self.state.current()
        path = now / "checkpoint.json" if now else None
        return queue.Checkpoint.from_dict(jsonl.loads(path.read_text("utf-8"))) if path and path.exists() else queue.Checkpoint()

    def commit(self, checkpoint: queue.Checkpoint | None = None, **tables: DataFrame) -> None:
        """A new generation: the given tables, and the others as they are."""
        everything = {n: cut(tables[n] if n in tables else self.table(n)) for n in TABLES}
        c = checkpoint or self.checkpoint()
        self.state.publish(everything, {"checkpoint.json": (jsonl.canonical(c.to_dict()) + "\n").encode()})

    # commands
    def validate_source(self) -> dict:
        p = self.product()
        return nested_zip.validate_source(str(self.root / p["archive"]), p)

    def scan(self) -> dict:
        p, rules = self.product(), self.rules()
        path = str(self.root / p["archive"])
        seen = nested_zip.identity(path)
        nested_zip.validate_source(path, p)
        resources, exclusions, collisions, contents = inventory.scan(self.spark, path, rules, with_contents=True, seen=seen)
        previous = self.table("units")
        fresh = units.explode_units(resources.join(contents.select("source_sha256", "content"), "source_sha256"))
        now = cut(units.carry_over(fresh, previous))
        c = self.checkpoint()
        if c.current_batch and not (previous.exceptAll(now).isEmpty() and now.exceptAll(previous).isEmpty()):
            raise QueueError("a batch is in flight, and the scan changes units")
        self.blobs.publish({"blobs": contents})
        stale = units.stale_units(previous, now, p["build_number"])
        self.commit(c, resources=resources, exclusions=exclusions, collisions=collisions, units=now, stale_units=stale)
        return {r[0] + ":" + r[1]: r[2] for r in report.summary(*(self.table(t) for t in ("resources", "exclusions", "collisions", "units"))).collect()}

    def next_batch(self, limit: int = 100) -> Path | None:
        rows, c = queue.export_next(self.table("units"), self.checkpoint(), limit)
        if not rows:
            return None
        path = self.root / queue.BATCHES / c.current_batch
        if not path.exists():
            publish.write_bytes(path, jsonl.serialize(rows))
        if c != self.checkpoint():
            self.commit(c)
        return path

    def import_batch(self, path: str | Path) -> dict:
        folder, path = self.root / queue.BATCHES, Path(path)
        path = path if path.is_absolute() else self.root / path
        if path.is_symlink() or path.resolve().parent != folder.resolve() or not path.is_file():
            raise OutputPathError(f"no file of {folder}: {path}")
        rows = [jsonl.loads(line) for line in path.read_text("utf-8").splitlines()]
        now, counts, c = queue.import_batch(self.table("units"), rows, self.checkpoint(), self.glossary())
        self.commit(c, units=now)
        return counts

    def validate(self) -> bool:
        """All findings anew; whether none blocks."""
        self.commit(units=units.revalidate(self.table("units"), self.glossary()))
        return self.table("units").where(V.is_blocking(F.col("findings"))).isEmpty()

    def files(self) -> dict[str, bytes]:
        """The rendered files, from the stored blobs: the archive isn't needed. Their total size is bounded by the scan's limits."""
        resources, now = self.table("resources"), self.blobs.current()
        if now is None:
            raise EngineError("nothing is scanned yet")
        contents = blobs.attach(resources, self.spark.read.parquet(str(now / "blobs"))).select("container", "resource_path", "content")
        out = render.render(resources, self.table("units"), contents)
        return {r.target_path: bytes(r.content) for r in out.toLocalIterator()}

    def inputs(self) -> str:
        """Digest of what a generation is made from."""
        return publish.state_digest({"resources": self.table("resources"), "units": self.table("units")})

    def made(self, name: str) -> dict | None:
        path = self.root / name
        return jsonl.loads(path.read_text("utf-8")) if path.exists() else None

    def generate(self) -> dict:
        files = self.files()
        changed = publish.write_tree(self.root / "generated", files)
        publish.write_bytes(self.root / MANIFEST, publish.manifest(files, self.inputs(), self.product()["build_number"]))
        return {"files": len(files), "changed": changed}

    def package(self) -> dict:
        """From sources and units again; the generated tree must be just what comes out."""
        p, files = self.product(), self.files()
        tree = self.root / "generated"
        if {str(x.relative_to(tree)): x.read_bytes() for x in tree.rglob("*") if x.is_file()} != files:
            raise EngineError("the generated tree isn't what the units give; generate first")
        notes = report.change_notes((self.root / "CHANGELOG.md").read_text("utf-8"), p["plugin_version"])
        own = self.root / "config/descriptor.xml"
        template = own.read_text("utf-8") if own.exists() else DESCRIPTOR
        values = {"id": p["plugin_id"], "version": p["plugin_version"], "since": p["since_build"], "until": p["until_build"], "notes": notes}
        descriptor = publish.fill_descriptor(template, values)
        publish.verify_descriptor(descriptor, template, values)
        data = publish.package(files, "localization", descriptor)
        publish.verify_package(data, "localization", files, descriptor)
        publish.write_bytes(self.root / "dist/localization.zip", data)
        told = publish.dist_manifest(data, "localization.zip", self.inputs())
        publish.write_bytes(self.root / "dist/manifest.json", told.encode())
        return json.loads(told)

    def status(self) -> dict:
        """The tree and the package are valid if they are, by hash, what was made, and were made from the units as they are now."""
        tree, package, inputs = self.root / "generated", self.root / "dist/localization.zip", self.inputs()
        made, packed = self.made(MANIFEST), self.made("dist/manifest.json")
        tree_valid = bool(made) and made["input_sha256"] == inputs and publish.tree_matches(tree, made["outputs"])
        zip_valid = tree_valid and bool(packed) and package.is_file() and packed["input_sha256"] == inputs and nested_zip.fingerprint(str(package)) == (packed["sha256"], packed["size"])
        states = {"present": tree.exists(), "valid": tree_valid, "recovery": ", ".join(self.markers())}, {"present": package.exists(), "valid": zip_valid}
        return report.snapshot(*(self.table(t) for t in ("resources", "exclusions", "collisions", "units", "stale_units")), self.checkpoint(), None, *states)

    def report(self) -> dict:
        r = self.status()
        publish.write_together(self.root / "reports", {"status.json": report.render_json(r).encode(), "status.md": report.render_markdown(r).encode()})
        return r

    def export(self) -> dict:
        """The tables as canonical JSON Lines below inventory/, for exchange: the exclusions, by far the longest, compressed."""
        names = {n: f"inventory/{n}.jsonl" + (".gz" if n == "exclusions" else "") for n in TABLES}
        for n, path in names.items():
            jsonl.write_file(self.table(n), self.root / path)
        return names

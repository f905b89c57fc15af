"""Writing results so that readers see all of them or none."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import uuid
from pathlib import Path
from xml.etree import ElementTree

from pyspark.sql import DataFrame

from tessella.schemas import OutputPathError, PackageError
from tessella.sources.jsonl import canonical, loads
from tessella.sources.nested_zip import verify_zip, zip_bytes

#: Files that are to be written together.
PENDING = ".pending.json"
#: Hashes that a group of the state digest holds on average.
LEAF = 4096


def safe_path(root: Path, relative: str) -> Path:
    """A path below root, without links or steps out of it."""
    out = root / relative
    if os.path.isabs(relative) or ".." in Path(relative).parts or "\\" in relative or out.is_symlink() or not out.resolve().is_relative_to(root.resolve()):
        raise OutputPathError(f"outside of {root}: {relative}")
    return out


def write_bytes(path: Path, data: bytes) -> None:
    """To a new file, on the disk, then renamed."""
    path.parent.mkdir(parents=True, exist_ok=True)
    temp = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    try:
        with temp.open("xb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        temp.replace(path)
    finally:
        temp.unlink(missing_ok=True)


def write_together(folder: Path, files: dict[str, bytes]) -> None:
    """Several files, all of them in the end: they are in one log first, from which `finish` writes them again if this is cut short."""
    write_bytes(folder / PENDING, (canonical({n: d.decode("utf-8") for n, d in files.items()}) + "\n").encode())
    finish(folder)


def finish(folder: Path) -> None:
    log = folder / PENDING
    if log.exists():
        for name, text in sorted(loads(log.read_text("utf-8")).items()):
            write_bytes(safe_path(folder, name), text.encode())
        log.unlink()


def write_tree(root: Path, files: dict[str, bytes]) -> bool:
    """A directory with just these files in place of the old one; False if it is so already. A swap that was cut short is
    undone by the next call."""
    old, new = root.with_name(f"{root.name}.old"), root.with_name(f"{root.name}.new")
    if old.exists():
        old.replace(root) if not root.exists() else shutil.rmtree(old)
    shutil.rmtree(new, ignore_errors=True)
    if root.exists() and {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*")) if p.is_file()} == files:
        return False
    new.mkdir(parents=True)
    for name, data in sorted(files.items()):
        write_bytes(safe_path(new, name), data)
    if root.exists():
        root.replace(old)
    new.replace(root)
    shutil.rmtree(old, ignore_errors=True)
    return True


class Versions:
    """Tables of one generation in one directory; a pointer file, replaced by a rename, says which generation counts."""

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def current(self) -> Path | None:
        try:
            return safe_path(self.root, (self.root / "CURRENT").read_text().split("\n")[0])
        except FileNotFoundError:
            return None

    def publish(self, tables: dict[str, DataFrame], files: dict[str, bytes] | None = None) -> Path:
        """Tables are written by the executors, side by side; nothing counts before the pointer."""
        name = f"v-{uuid.uuid4().hex}"
        folder = self.root / name
        for t, df in tables.items():
            df.write.parquet(str(folder / t))
        for f, data in (files or {}).items():
            write_bytes(safe_path(folder, f), data)
        before = self.current()
        write_bytes(self.root / "CURRENT", "\n".join([name, *([before.name] if before else [])]).encode())
        self.recover()
        return folder

    def recover(self) -> None:
        """Generations that the pointer doesn't name were cut short, or are old: they go. It names the last one and the one
        before, which tables that are still being read may point to."""
        for name in self.leftover():
            shutil.rmtree(self.root / name)

    def leftover(self) -> list[str]:
        pointer = self.root / "CURRENT"
        named = pointer.read_text().split("\n") if pointer.exists() else []
        return sorted(p.name for p in self.root.glob("v-*") if p.name not in named)


def manifest(files: dict[str, bytes], inputs: str, build: str) -> bytes:
    """What a generation was made from (a state digest), and each file's hash and size."""
    outputs = {n: {"sha256": hashlib.sha256(d).hexdigest(), "size": len(d)} for n, d in sorted(files.items())}
    return (canonical({"schema_version": 1, "build": build, "input_sha256": inputs, "outputs": outputs}) + "\n").encode()


def tree_matches(root: Path, outputs: dict[str, dict]) -> bool:
    """Whether a tree holds just these files, by hash and size, and no links."""
    if root.is_symlink() or not root.is_dir() or any(p.is_symlink() for p in root.rglob("*")):
        return False
    files = {p.relative_to(root).as_posix(): p for p in root.rglob("*") if p.is_file()}
    same = lambda n, p: p.stat().st_size == outputs[n]["size"] and hashlib.sha256(p.read_bytes()).hexdigest() == outputs[n]["sha256"]
    return files.keys() == outputs.keys() and all(same(n, p) for n, p in files.items())


def state_digest(tables: dict[str, DataFrame]) -> str:
    """Of the tables' rows, whatever their order: rows are hashed where they lie and equal ones counted; hashes are joined by
    their beginnings in groups of about LEAF, those groups' digests by shorter beginnings, and so on, so that no group grows
    with the table. The driver gets at most 256 digests."""
    from pyspark.sql import functions as F

    from tessella.plans.lineage import cut
    from tessella.sources.jsonl import canonical_lines

    out = {}
    for name, df in sorted(tables.items()):
        h = canonical_lines(df).select(F.sha2("line", 256).alias("h"))
        rows = cut(h.groupBy("h").agg(F.count(F.lit(1)).alias("n")).select("h", F.concat("h", F.lit(":"), F.col("n").cast("string")).alias("d")))
        n, deep = rows.count(), 2
        while n > LEAF * 16**deep:
            deep += 1
        for k in range(deep, 1, -1):
            joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("h", "d"))), lambda x: x["d"]), ",")
            rows = rows.groupBy(F.substring("h", 1, k).alias("h")).agg(F.sha2(joined, 256).alias("d"))
        out[name] = [tuple(r) for r in rows.orderBy("h").collect()]
    return hashlib.sha256(json.dumps(out, sort_keys=True).encode()).hexdigest()


def package(files: dict[str, bytes], name: str, descriptor: str) -> bytes:
    """An archive with one inner archive: the files and the descriptor, both in canonical form."""
    inner = zip_bytes(files | {"META-INF/plugin.xml": descriptor.encode("utf-8")})
    return zip_bytes({f"{name}/lib/{name}.jar": inner})


def fill_descriptor(template: str, values: dict[str, str]) -> str:
    """A descriptor with its placeholders filled; values are made safe for CDATA, and each placeholder must be there."""
    for k, v in values.items():
        if "{{" + k + "}}" not in template:
            raise OutputPathError(f"no placeholder for {k}")
        template = template.replace("{{" + k + "}}", v.replace("]]>", "]]]]><![CDATA[>"))
    return template


def _shape(element: ElementTree.Element, values: dict[str, str]):
    def put(text: str | None) -> str:
        return re.sub(r"\{\{(\w+)\}\}", lambda m: values.get(m[1], m[0]), text or "").strip()

    return element.tag, {k: put(v) for k, v in element.attrib.items()}, put(element.text), put(element.tail), [_shape(c, values) for c in element]


def verify_descriptor(filled: str, template: str, values: dict[str, str]) -> None:
    """An error unless the descriptor parses to the template's elements, attributes and texts with the values in their places,
    so that no value adds or ends an element."""
    try:
        got, want = _shape(ElementTree.fromstring(filled), {}), _shape(ElementTree.fromstring(template), values)
    except ElementTree.ParseError as e:
        raise PackageError(f"the descriptor doesn't parse: {e}") from None
    if got != want:
        raise PackageError("the descriptor isn't its template with the values filled in")


def verify_package(data: bytes, name: str, files: dict[str, bytes], descriptor: str) -> None:
    """An error unless a package holds just these files and this descriptor, in canonical form inside and out."""
    outer = verify_zip(data)
    if list(outer) != [f"{name}/lib/{name}.jar"]:
        raise PackageError("the package holds something else than one archive")
    if verify_zip(next(iter(outer.values()))) != files | {"META-INF/plugin.xml": descriptor.encode("utf-8")}:
        raise PackageError("the package holds other files than were made")


def dist_manifest(artifact: bytes, name: str, inputs: str = "") -> str:
    return canonical({"artifact": name, "input_sha256": inputs, "sha256": hashlib.sha256(artifact).hexdigest(), "size": len(artifact)}) + "\n"

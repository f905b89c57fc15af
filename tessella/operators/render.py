"""From units back to files, with every check that must hold before."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import expressions as E
from tessella.functions import properties
from tessella.functions import validation as V
from tessella.operators.classify import is_supported
from tessella.schemas import REVIEWED, RenderError

PLACE = ("container", "resource_path")


def _units(units: DataFrame) -> DataFrame:
    return units.select(F.col("context.container").alias("container"), F.col("context.path").alias("resource_path"), F.col("context.key").alias("key"), "id", "source", "source_sha256", "target", "status", "findings")


def unfinished(units: DataFrame) -> DataFrame:
    return units.where(~F.col("status").isin(*REVIEWED) | V.is_blocking(F.col("findings"))).select("id")


def units_without_resource(units: DataFrame, resources: DataFrame) -> DataFrame:
    return _units(units).join(resources, list(PLACE), "left_anti").select("id")


def resources_without_unit(resources: DataFrame, units: DataFrame) -> DataFrame:
    return resources.where("resource_type <> 'properties'").join(_units(units), list(PLACE), "left_anti").select("resource_id")


def key_problems(parsed: DataFrame, units: DataFrame) -> DataFrame:
    """(container, resource_path, key, problem): keys of files without a unit, units without a key, keys with several units."""
    p = parsed.select(*PLACE, "key").distinct().withColumn("_p", F.lit(True))
    u = units.groupBy(*PLACE, "key").agg(F.count(F.lit(1)).alias("_n"))
    problem = F.when(F.col("_n").isNull(), "missing").when(F.col("_p").isNull(), "extra").when(F.col("_n") > 1, "duplicate")
    return p.join(u, [*PLACE, "key"], "full_outer").select(*PLACE, "key", problem.alias("problem")).where("problem IS NOT NULL")


def broken_hashes(resources: DataFrame, contents: DataFrame) -> DataFrame:
    """resource_id where the content is missing or has another size or hash."""
    j = resources.join(contents.select(*PLACE, "content"), list(PLACE), "left")
    bad = F.col("content").isNull() | (F.sha2("content", 256) != F.col("source_sha256")) | (F.length("content") != F.col("size"))
    return j.where(bad).select("resource_id")


def stray_contents(resources: DataFrame, contents: DataFrame) -> DataFrame:
    """(container, resource_path) of contents that no resource claims, or that are there more than once."""
    n = contents.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("_n"))
    j = n.join(resources.select(*PLACE).distinct().withColumn("_claimed", F.lit(True)), list(PLACE), "left")
    return j.where(F.col("_claimed").isNull() | (F.col("_n") > 1)).select(*PLACE)


def folded(paths: DataFrame, column: str) -> DataFrame:
    """paths with `folded`, the column's case folding: lower case in the JVM where all is ASCII, and Unicode's rule, which no
    built-in expression has, for the rest."""
    ascii_only = F.col(column).rlike(r"^\p{ASCII}*$")

    @F.pandas_udf("string")
    def fold(c: pd.Series) -> pd.Series:
        return c.str.casefold()

    rest = paths.where(~ascii_only)
    return paths.where(ascii_only).withColumn("folded", F.lower(column)).unionByName(rest.withColumn("folded", fold(column)))


def case_clashes(paths: DataFrame, column: str) -> DataFrame:
    """Output paths that differ in case only."""
    return folded(paths.select(column).distinct(), column).groupBy("folded").agg(F.array_sort(F.collect_list(column)).alias("paths")).where(F.size("paths") > 1)


def require_none(problem: str, rows: DataFrame) -> None:
    """An error that names all offenders, if there are any; without any, one cheap look."""
    if not rows.isEmpty():
        raise RenderError(f"{problem}: " + ", ".join(sorted("/".join(str(v) for v in r) for r in rows.collect())))


def render_whole_file(content: bytes, target: str, path: str) -> bytes:
    """target in content's newline style, final newline and byte-order mark; XML must parse."""
    import re

    text = content.decode("utf-8")
    bom, text = ("﻿", text[1:]) if text.startswith("﻿") else ("", text)
    styles = set(re.findall(E.NEWLINE, text))
    body = re.sub(E.NEWLINE, "\n", target).rstrip("\n")
    if len(styles) > 1 or (not styles and "\n" in body):
        raise RenderError(f"newlines of {path} don't fit")
    style = next(iter(styles), "")
    out = body.replace("\n", style) + (style if text.endswith(("\r", "\n")) else "")
    if path.endswith(".xml"):
        try:
            ElementTree.fromstring(out)
        except ElementTree.ParseError as e:
            raise RenderError(f"{path}: {e}") from None
    return (bom + out).encode("utf-8")


def render(resources: DataFrame, units: DataFrame, contents: DataFrame) -> DataFrame:
    """(target_path, content): one file for each output path. All checks come first. Resources and their units meet on
    (container, path); each is rendered where it lies."""
    require_none("unsupported", resources.where(~is_supported(F.col("resource_type"), F.col("resource_path"))).select("resource_id"))
    require_none("unfinished units", unfinished(units))
    require_none("units without resource", units_without_resource(units, resources))
    require_none("resources without unit", resources_without_unit(resources, units))
    require_none("broken sources", broken_hashes(resources, contents))
    require_none("contents without one resource", stray_contents(resources, contents))
    require_none("changed unit sources", units.where(E.sha256_text(F.col("source")) != F.col("source_sha256")).select("id"))
    pairs = _units(units).groupBy(*PLACE).agg(F.collect_list(F.struct("key", "source", "target")).alias("units"))
    rows = resources.join(contents.select(*PLACE, "content"), list(PLACE)).join(pairs, list(PLACE), "left").select("resource_path", "resource_type", "content", "units")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                have = r["units"] or []
                if r["resource_type"] == "properties":
                    values = {e.key: e.value for e in properties.parse(r["content"])}
                    if sorted(u["key"] for u in have) != sorted(values) or any(values[u["key"]] != u["source"] for u in have):
                        raise RenderError(f"units and keys of {r['resource_path']} differ")
                    out.append(properties.render(r["content"], {u["key"]: u["target"] for u in have}))
                else:
                    if len(have) != 1 or have[0]["source"] != r["content"].decode("utf-8-sig"):
                        raise RenderError(f"unit and text of {r['resource_path']} differ")
                    out.append(render_whole_file(r["content"], have[0]["target"], r["resource_path"]))
            yield pa.RecordBatch.from_arrays([b.column("resource_path"), pa.array(out, pa.binary())], names=["path", "content"])

    done = rows.mapInArrow(run, "path string, content binary")
    files = done.select(E.output_path(F.col("path")).alias("target_path"), "content")
    one = files.groupBy("target_path").agg(F.countDistinct("content").alias("contents"), F.first("content").alias("content"))
    require_none("different files for a path", one.where("contents > 1").select("target_path"))
    require_none("paths that differ in case", case_clashes(one, "target_path").select("folded"))
    return one.select("target_path", "content")

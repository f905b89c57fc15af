"""Counts and states of the whole workspace."""

from __future__ import annotations

import html
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import expressions as E
from tessella.schemas import STATUSES, ChangelogError
from tessella.sources.jsonl import canonical


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def zero_filled(df: DataFrame, column: str, values) -> DataFrame:
    """Counts of all possible values, absent ones as 0; the dimension is a fixed list."""
    spark = df.sparkSession
    dim = spark.createDataFrame([(v,) for v in values], f"{column} string")
    return dim.join(counts_by(df.where(F.col(column).isin(*values)), column), column, "left").select(column, F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def findings_by_code(units: DataFrame) -> DataFrame:
    # outer, as Spark would else make a filter of the findings too, and compute them twice
    return units.select(F.explode_outer("findings").alias("f")).where("f IS NOT NULL").groupBy("f.code", "f.severity").agg(F.count(F.lit(1)).alias("n"))


def workflow_state(batch_active, any_open, any_translated, any_unit, generated, packaged):
    """From six conditions the first state that applies."""
    return (
        F.when(batch_active | any_open, "translate").when(any_translated, "validate").when(any_unit & ~generated, "generate").when(any_unit & ~packaged, "package").when(any_unit, "complete").otherwise("scan")
    )


def state_of(units: DataFrame, batch_active: bool = False, generated: bool = False, packaged: bool = False) -> DataFrame:
    """One row: workflow_state and next_command."""
    a = units.agg(*(F.coalesce(F.bool_or(F.col("status") == s), F.lit(False)).alias(s) for s in ("open", "translated")), (F.count(F.lit(1)) > 0).alias("any"))
    state = workflow_state(F.lit(batch_active), F.col("open"), F.col("translated"), F.col("any"), F.lit(generated), F.lit(packaged))
    command = F.when(F.lit(batch_active), "import-batch").when(F.col("open"), "next-batch").otherwise(F.when(state == "complete", "status").otherwise(state))
    return a.select(state.alias("workflow_state"), command.alias("next_command"))


def snapshot(resources: DataFrame, exclusions: DataFrame, collisions: DataFrame, units: DataFrame, stale: DataFrame, checkpoint, source: Mapping | None = None, generation: Mapping | None = None, package: Mapping | None = None) -> dict:
    """The status report: small aggregates, gathered on the driver."""
    table = lambda df, c: {r[0]: r[1] for r in counts_by(df, c).orderBy(c).collect()}
    codes, severities = {}, {"blocking": 0, "warning": 0}
    for r in findings_by_code(units).orderBy("code").collect():
        codes[r.code] = r.n
        severities[r.severity] += r.n
    state = state_of(units, bool(checkpoint.current_batch), bool((generation or {}).get("valid")), bool((package or {}).get("valid"))).first()
    c = collisions.agg(F.count(F.lit(1)), F.count_if("unresolved")).first()
    return {
        "source": dict(sorted((source or {}).items())),
        "counts": {"resource_files": resources.count(), "translation_units": units.count()},
        "statuses": {r[0]: r[1] for r in zero_filled(units, "status", STATUSES).collect()},
        "exclusions": table(exclusions, "reason"),
        "collisions": {"total": c[0], "unresolved": c[1]},
        "findings": {"counts": severities, "codes": codes},
        "batches": {"last_completed": checkpoint.completed_sequence, "current": checkpoint.current_sequence, "current_batch": checkpoint.current_batch},
        "generation": dict(generation or {"present": False}),
        "package": dict(package or {"present": False}),
        "stale_units": {"count": stale.count(), "by_reason": table(stale, "reason"), "records": [{"id": r.id, "reason": r.reason} for r in stale_records(stale).collect()]},
        "workflow_state": state.workflow_state,
        "next_command": f"import-batch {checkpoint.current_batch}" if checkpoint.current_batch else state.next_command,
    }


def stale_records(stale: DataFrame) -> DataFrame:
    """Stale units in the report's order."""
    return stale.select("id", "reason", "context", "old_source_sha256", "scan_build").orderBy("reason", "id")


def render_json(report: dict) -> str:
    return canonical(report) + "\n"


def _md(value) -> str:
    return html.escape(str(value)).replace("|", "&#124;").replace("`", "&#96;").replace("\n", " ")


def render_markdown(report: dict, title: str = "Status") -> str:
    """The report as headings, lists and tables."""
    out = [f"# {title}", ""]
    for head, body in report.items():
        if not isinstance(body, dict):
            out += [f"- {_md(head)}: `{_md(body)}`"]
            continue
        lists = {k: v for k, v in body.items() if isinstance(v, list)}
        flat = {f"{k}.{x}" if isinstance(v, dict) else k: y for k, v in body.items() if k not in lists for x, y in (v.items() if isinstance(v, dict) else [(None, v)])}
        out += [f"## {_md(head)}", "", "| Name | Value |", "|---|---:|", *(f"| {_md(k)} | {_md(v)} |" for k, v in flat.items()), ""]
        for rows in lists.values():
            out += [*("- " + ": ".join(f"`{_md(x)}`" for x in r.values()) for r in rows), *([""] if rows else [])]
    return "\n".join(out) + "\n"


def summary(resources: DataFrame, exclusions: DataFrame, collisions: DataFrame, units: DataFrame) -> DataFrame:
    """(measure, name, n): all counts in one table; grouping sets over the exclusions give reasons and their total at once."""
    rows = [
        exclusions.groupingSets([["reason"], []], "reason").agg(F.count(F.lit(1)).alias("n"), F.grouping("reason").alias("g")).select(F.when(F.col("g") == 1, "exclusions").otherwise("reason").alias("measure"), F.coalesce("reason", F.lit("")).alias("name"), "n"),
        resources.groupingSets([["resource_type"], []], "resource_type").agg(F.count(F.lit(1)).alias("n"), F.grouping("resource_type").alias("g")).select(F.when(F.col("g") == 1, "resources").otherwise("type").alias("measure"), F.coalesce("resource_type", F.lit("")).alias("name"), "n"),
        collisions.agg(F.count(F.lit(1)).alias("total"), F.count_if("content_identical").alias("identical"), F.count_if("unresolved").alias("unresolved")).select(F.lit("collisions").alias("measure"), F.expr("stack(3, 'total', total, 'identical', identical, 'unresolved', unresolved) AS (name, n)")),
        units.agg(F.count(F.lit(1)).alias("n")).select(F.lit("units").alias("measure"), F.lit("").alias("name"), "n"),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def change_notes(text: str, version: str) -> str:
    """The bullets of a version's section as an HTML list."""
    section, found = [], False
    for line in map(str.strip, text.splitlines()):
        if line.startswith("## "):
            if found:
                break
            found = line[3:].strip() == version
        elif found and line:
            if line[:2] not in ("- ", "* "):
                raise ChangelogError(f"not a bullet: {line!r}")
            section.append(f"<li>{html.escape(line[2:].strip(), quote=False)}</li>")
    if not section:
        raise ChangelogError(f"no notes for version {version}")
    return f"<ul>{''.join(section)}</ul>"


def section_lines(lines: DataFrame) -> DataFrame:
    """lines (doc_id, pos, line) -> version of the section that each non-header line stands in: the last header before it."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    header = F.when(F.trim("line").startswith("## "), F.trim(F.substring(F.trim("line"), 4, 1 << 20)))
    return lines.withColumn("section", F.last(header, ignorenulls=True).over(w)).where(header.isNull())


def escaped_cells(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, E.escape_markdown(F.col(column)))

"""Translation units: exploded from resources, joined with an earlier generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import expressions as E
from tessella.functions import properties
from tessella.schemas import FINDINGS


def explode_units(resources: DataFrame) -> DataFrame:
    """resources (container, resource_path, resource_type, content): a unit for each key of a properties file (of equal
    repetitions the first), one with the key "" for each other file."""
    spark = resources.sparkSession
    properties.register(spark)
    resources.createOrReplaceTempView("_tessella_contents")
    keyed = spark.sql("SELECT r.container, r.resource_path, p.pos, p.key, p.value AS source FROM _tessella_contents r, LATERAL parse_properties(r.content) p WHERE r.resource_type = 'properties'")
    first = Window.partitionBy("container", "resource_path", "key").orderBy("pos")
    keyed = keyed.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("container", "resource_path", "key", "source")
    text = E.decode_utf8(F.col("content"))
    bad = F.raise_error(F.concat(F.lit("not UTF-8: "), F.col("resource_path"))).cast("string")
    whole = resources.where("resource_type <> 'properties'").select("container", "resource_path", F.lit("").alias("key"), F.when(text.isNull() & F.col("content").isNotNull(), bad).otherwise(text).alias("source"))
    return identify(keyed.unionByName(whole))


def identify(rows: DataFrame) -> DataFrame:
    """(container, resource_path, key, source) -> id, source, source_sha256, context."""
    c = F.struct(E.path_stem(F.col("resource_path")).alias("bundle"), F.col("key"), F.col("container"), F.col("resource_path").alias("path"))
    return rows.select(E.joined_id(F.col("container"), F.col("resource_path"), F.col("key")).alias("id"), "source", E.sha256_text(F.col("source")).alias("source_sha256"), c.alias("context"))


def first_by_logical_key(previous: DataFrame) -> DataFrame:
    """Of translated units with the same path, key and source the one of the smallest id."""
    w = Window.partitionBy("context.path", "context.key", "source_sha256").orderBy("id")
    return previous.where("status <> 'open' AND target <> ''").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def carry_over(units: DataFrame, previous: DataFrame) -> DataFrame:
    """units with target, status and findings: from the same id if nothing changed, else from the same path, key and source
    in another container, else open; an empty source is reviewed at once. Two left joins, on id and on the logical key."""
    kept = lambda p: F.struct(F.col(f"{p}.target").alias("target"), F.col(f"{p}.status").alias("status"), F.col(f"{p}.findings").alias("findings"))
    p = previous.alias("p").select(F.col("p.id").alias("_id"), F.struct("p.source", "p.source_sha256", "p.context").alias("_was"), kept("p").alias("_by_id"))
    o = first_by_logical_key(previous).alias("o").select(F.col("o.context.path").alias("_path"), F.col("o.context.key").alias("_key"), F.col("o.source_sha256").alias("_sha"), F.col("o.source").alias("_source"), kept("o").alias("_logical"))
    j = units.join(p, units["id"] == p["_id"], "left").join(o, (F.col("context.path") == F.col("_path")) & (F.col("context.key") == F.col("_key")) & (units["source_sha256"] == F.col("_sha")), "left")
    same = F.col("_was").eqNullSafe(F.struct("source", "source_sha256", "context"))
    none = F.array().cast(FINDINGS)
    fresh = lambda s: F.struct(F.lit("").alias("target"), F.lit(s).alias("status"), none.alias("findings"))
    got = F.when(F.col("source") == "", fresh("technically_reviewed")).when(same, F.col("_by_id")).when(F.col("_source") == F.col("source"), F.col("_logical")).otherwise(fresh("open"))
    return j.withColumn("_got", got).select("id", "source", "source_sha256", F.col("_got.target").alias("target"), "context", F.col("_got.status").alias("status"), F.col("_got.findings").alias("findings"))


def stale_units(previous: DataFrame, units: DataFrame, build: str) -> DataFrame:
    """Earlier units that are gone or differ now, with the first reason that applies."""
    now = units.select(F.col("id").alias("_id"), F.col("context").alias("_context"), F.col("source_sha256").alias("_sha"))
    reason = F.when(F.col("_id").isNull(), "removed_from_source").when(F.col("context") != F.col("_context"), "context_changed").when(F.col("source_sha256") != F.col("_sha"), "source_changed")
    j = previous.join(now, F.col("id") == F.col("_id"), "left").withColumn("reason", reason)
    return j.where("reason IS NOT NULL").select("id", "context", F.col("source_sha256").alias("old_source_sha256"), "reason", F.lit(build).alias("scan_build"))


def revalidate(units: DataFrame, glossary: dict | None = None) -> DataFrame:
    """All units with findings and status made anew; units without target stay open."""
    from tessella.functions import validation as V

    is_open = (F.col("target") == "") & (F.col("source") != "")
    found = F.when(is_open, F.array().cast(FINDINGS)).otherwise(V.findings(F.col("source"), F.col("target"), glossary))
    return units.withColumn("findings", found).withColumn("status", V.status(F.col("source"), F.col("target"), F.col("findings"))).select(*(c.split()[0] for c in ("id", "source", "source_sha256", "target", "context", "status", "findings")))

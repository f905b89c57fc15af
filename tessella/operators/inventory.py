"""From members to an inventory: resources, exclusions, collisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions import expressions as E
from tessella.operators import classify
from tessella.operators.budgets import greedy, within_count
from tessella.operators.classify import ScanRules
from tessella.plans.lineage import cut
from tessella.sources.blobs import distinct_blobs
from tessella.schemas import CANDIDATE_REASONS, TECHNICAL_DROPS, ScanError


def first_members(members: DataFrame) -> DataFrame:
    """members with `is_first`: of a name that repeats in a container the first place counts."""
    w = Window.partitionBy("container", "path").orderBy("ordinal")
    return members.withColumn("is_first", F.row_number().over(w) == 1)


def select_collisions(resources: DataFrame, rules: ScanRules) -> tuple[DataFrame, DataFrame]:
    """Resources that stay, and exclusions of those whose path is selected in another container. A selection that names no
    resource is an error."""
    spark = resources.sparkSession
    if not rules.selections:
        return resources, spark.createDataFrame([], "container string, resource_path string, reason string, detail string")
    table = spark.createDataFrame(list(rules.selections), "resource_path string, chosen string")
    missing = missing_selections(resources, table).orderBy("resource_path").collect()
    if missing:
        raise ScanError("selections without a resource: " + ", ".join(f"{r.chosen}!/{r.resource_path}" for r in missing))
    joined = resources.join(F.broadcast(table), "resource_path", "left")
    stays = F.col("chosen").isNull() | (F.col("chosen") == F.col("container"))
    gone = joined.where(~stays).select("container", "resource_path", F.lit("collision_not_selected").alias("reason"), F.col("chosen").alias("detail"))
    return joined.where(stays).select(*resources.columns), gone


def missing_selections(resources: DataFrame, selections: DataFrame) -> DataFrame:
    return selections.join(resources.select("resource_path", F.col("container").alias("chosen")), ["resource_path", "chosen"], "left_anti")


def _several(column: str):
    """Whether a group has several values: extremes of two 64-bit hashes, which stay in a hash aggregate and need no expansion."""
    one, other = F.xxhash64(column), F.xxhash64(F.lit("other"), column)
    return (F.min(one) < F.max(one)) | (F.min(other) < F.max(other))


def colliding(resources: DataFrame) -> DataFrame:
    """The resources whose path is in more than one container, a row each, with content_identical: paths are found by
    aggregates first, so that nothing is gathered for all others."""
    g = resources.groupBy("resource_path").agg(_several("container").alias("_several"), (~_several("source_sha256")).alias("content_identical"))
    return resources.join(g.where("_several").drop("_several"), "resource_path")


def collisions(resources: DataFrame) -> DataFrame:
    """Paths in more than one container, with their resources in order: a list of one entry a container. `colliding` has them
    as rows."""
    names = [c for c in resources.columns]
    member = F.struct("container", *(c for c in names if c != "container"))
    g = colliding(resources).groupBy("resource_path").agg(F.array_sort(F.collect_list(member)).alias("resources"), F.first("content_identical").alias("content_identical"))
    ordered = F.transform("resources", lambda r: F.struct(*(r[c].alias(c) for c in names)))
    return g.select("resource_path", ordered.alias("resources"), "content_identical", (~F.col("content_identical")).alias("unresolved"))


def collision_counts(resources: DataFrame) -> DataFrame:
    """As `collisions`, with numbers in place of lists: nothing is gathered, so a path in many containers costs no more."""
    g = resources.groupBy("resource_path").agg(F.count(F.lit(1)).alias("members"), F.countDistinct("container").alias("containers"), (~_several("source_sha256")).alias("content_identical"))
    return g.where("containers > 1").select("resource_path", "members", "containers", "content_identical")


def check_claims(claimed: DataFrame, derived: DataFrame) -> DataFrame:
    """(resource_path, problem) where claimed collisions differ from derived ones."""
    c = claimed.groupBy("resource_path").agg(F.count(F.lit(1)).alias("n"), F.first("resources").alias("cr"), F.first("content_identical").alias("ci"))
    d = derived.select("resource_path", F.col("resources").alias("dr"), F.col("content_identical").alias("di"))
    j = c.join(d, "resource_path", "full_outer")
    problem = F.when(F.col("dr").isNull(), "extra").when(F.col("cr").isNull(), "missing").when(F.col("n") > 1, "duplicate").when(F.array_sort("cr") != F.array_sort("dr"), "members").when(F.col("ci") != F.col("di"), "content")
    return j.select("resource_path", problem.alias("problem")).where("problem IS NOT NULL")


def gate_by_reference(resources: DataFrame, reference: DataFrame, path: str = "resource_path") -> DataFrame:
    """resources with `in_reference`: an existence join against distinct paths."""
    paths = reference.select(F.col(path).alias("_p")).distinct()
    return resources.join(paths, F.col(path) == F.col("_p"), "left").withColumn("in_reference", F.col("_p").isNotNull()).drop("_p")


def scan(spark: SparkSession, path: str, rules: ScanRules, with_contents: bool = False, seen: str | None = None) -> tuple[DataFrame, ...]:
    """(resources, exclusions, collisions) of an archive, and its blobs (source_sha256, size, content) if asked for. Metadata
    decides everything; content is read for kept rows only, once. All reads are of the file that was `seen`."""
    from tessella.sources import nested_zip as source

    lim = rules.limits
    seen = seen or source.identity(path)
    outer = source.scan_limit(source.read_outer(spark, path, seen), lim["max_outer_members"])
    reason, too_large = classify.outer_reason(F.col("name"), F.col("is_dir"), F.col("file_size"), rules)
    plain = [~F.col("is_dir"), classify.is_safe(F.col("name")), F.lower("name").endswith(".jar")]
    o = outer.withColumn("reason", reason)
    jars = within_count(o.where(plain[0] & plain[1] & plain[2]), ["name", "ordinal"], lim["max_containers"], "counted")
    jars = jars.withColumn("reason", F.when(F.col("reason").isNull() & ~F.col("counted"), "container_budget_exceeded").when(F.col("reason").isNull() & too_large, "nested_jar_too_large").otherwise(F.col("reason")))
    open_jars = greedy(jars.where("reason IS NULL"), ["name", "ordinal"], "file_size", lim["max_total_nested_jar_bytes"], "fits")
    outer_out = o.where(~(plain[0] & plain[1] & plain[2])).select(F.lit("<outer>").alias("container"), F.col("name").alias("resource_path"), "reason")
    jar_out = jars.where("reason IS NOT NULL").select("name", "reason").union(open_jars.where("NOT fits").select("name", F.lit("total_nested_jar_bytes_exceeded").alias("reason"))).select(F.col("name").alias("container"), F.lit("").alias("resource_path"), "reason")
    opened = open_jars.where("fits").select(F.col("name").alias("container"))

    everything = cut(source.read_members(spark, path, seen=seen))
    members = everything.join(opened, "container", "left_semi")
    broken = members.where("ordinal < 0").select("container", F.lit("").alias("resource_path"), F.col("read_error").alias("reason"))
    per_jar = members.where("ordinal >= 0").groupBy("container").agg(F.count(F.lit(1)).alias("n"))
    jars_in = greedy(per_jar, ["container"], "n", lim["max_members"], "fits")
    over = jars_in.where("NOT fits").select("container", F.lit("").alias("resource_path"), F.lit("member_budget_exceeded").alias("reason"))
    rows = first_members(members.where("ordinal >= 0").join(jars_in.where("fits").select("container"), "container", "left_semi"))

    gated = rows.withColumn("in_reference", F.lit(True))
    if rules.require_reference:
        ref = everything.where(F.col("container").isin(*rules.reference_containers) & (F.col("ordinal") >= 0) & ~F.col("is_dir"))
        ref = ref.where(classify.is_reference_path(F.col("path"), rules))
        found = {r.container for r in ref.select("container").distinct().collect()}
        if lost := sorted(set(rules.reference_containers) - found):
            raise ScanError(f"reference archives are missing, unreadable or empty: {', '.join(lost)}")
        gated = gate_by_reference(rows, ref, "path")
    why = classify.inner_reason(F.col("container"), F.col("path"), F.col("is_dir"), F.col("file_size"), F.col("in_reference"), rules)
    judged = cut(gated.withColumn("reason", F.when(~F.col("is_first"), "duplicate_member").otherwise(why)))
    wanted = greedy(judged.where("reason IS NULL"), ["container", "path"], "file_size", lim["max_total_resource_bytes"], "fits")
    wanted = cut(wanted)
    no_room = wanted.where("NOT fits").select("container", F.col("path").alias("resource_path"), F.lit("total_resource_bytes_exceeded").alias("reason"))
    read_rows = source.read_contents(wanted.where("fits").select("container", "ordinal"), path, seen)
    read_rows = cut(read_rows.select("container", F.col("path").alias("resource_path"), F.sha2("content", 256).alias("source_sha256"), F.length("content").cast("bigint").alias("size"), "error", *(["content"] if with_contents else [])))
    unread = read_rows.where("error IS NOT NULL").select("container", "resource_path", F.col("error").alias("reason"))
    resources = read_rows.where("error IS NULL").select(
        E.joined_id(F.col("container"), F.col("resource_path")).alias("resource_id"), "container", "resource_path",
        classify.resource_type(F.col("resource_path"), rules.patterns).alias("resource_type"), "size", "source_sha256", F.lit("open").alias("processing_status"),
    )
    resources, unselected = select_collisions(resources, rules)
    excluded = judged.where("reason IS NOT NULL").select("container", F.col("path").alias("resource_path"), "reason")
    exclusions = outer_out.unionByName(jar_out).unionByName(broken).unionByName(over).unionByName(excluded).unionByName(no_room).unionByName(unread).withColumn("detail", F.lit("")).unionByName(unselected)
    if not with_contents:
        return resources, exclusions, collisions(resources)
    stored = distinct_blobs(read_rows.where("error IS NULL").select("content").join(resources.select("source_sha256").distinct(), F.sha2("content", 256) == F.col("source_sha256"), "left_semi"))
    return resources, exclusions, collisions(resources), stored


def path_sets(resources: DataFrame, exclusions: DataFrame, reference: DataFrame, path: str = "resource_path") -> DataFrame:
    """(p, candidate, reference, technical): every path once, with the sets that hold it: candidates (kept, or dropped for a
    reason of CANDIDATE_REASONS), the reference, and technical drops."""
    kept = resources.select(F.col(path).alias("p"), F.lit(True).alias("candidate"), F.lit(False).alias("reference"), F.lit(False).alias("technical"))
    dropped = exclusions.where(F.col("reason").isin(*CANDIDATE_REASONS)).select(F.col(path), F.lit(True), F.lit(False), F.col("reason").isin(*TECHNICAL_DROPS))
    return kept.union(dropped).union(reference.select(F.col(path), F.lit(False), F.lit(True), F.lit(False))).groupBy("p").agg(*(F.bool_or(c).alias(c) for c in ("candidate", "reference", "technical")))


def coverage(resources: DataFrame, exclusions: DataFrame, reference: DataFrame, path: str = "resource_path") -> DataFrame:
    """One row: numbers of distinct candidate and reference paths, of what they share, and of what either lacks."""
    n = lambda e: F.coalesce(F.count_if(F.expr(e)), F.lit(0)).cast("bigint")
    return path_sets(resources, exclusions, reference, path).agg(
        n("candidate").alias("candidates"), n("reference").alias("reference_paths"), n("candidate AND reference").alias("overlap"), n("NOT candidate AND reference").alias("reference_only"),
        n("candidate AND NOT reference").alias("candidates_only"), n("technical AND reference").alias("technical_drops_in_reference"),
    )


def absent_by(resources: DataFrame, reference: DataFrame, path: str, kind: str) -> DataFrame:
    """(kind, n): how many resources of each kind have a path that the reference lacks."""
    gated = gate_by_reference(resources, reference, path)
    return gated.where("NOT in_reference").groupBy(kind).agg(F.count(F.lit(1)).alias("n"))

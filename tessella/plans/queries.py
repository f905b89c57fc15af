"""Queries over the driver's tables, each through the engine's operators, with its SQL twin.

The tables stand in for the engine's own: documents are resources (source is the container), pages are whole
files, conversations are source/target pairs (a turn and the next), events are an exclusion log, labels a review state.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions import expressions as E
from tessella.functions import properties
from tessella.functions import validation as V
from tessella.functions.markup import parse_markup
from tessella.operators import budgets, classify, inventory, queue, render, report, units
from tessella.schemas import FINDINGS, STATUSES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        name = f.__name__
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return add


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def resources(self) -> DataFrame:
        """documents as resources. Of half of them the path is the content's hash, so that copies collide; of the others it is
        the hash's beginning, which different contents share. A container has a path once, as in an inventory."""
        sha = E.sha256_text(F.col("text"))
        path = F.when(sha < "8", F.substring(sha, 1, 2)).otherwise(sha)
        d = self.documents.select("doc_id", F.col("source").alias("container"), path.alias("path"), sha.alias("sha"), F.octet_length("text").cast("bigint").alias("size"), F.col("doc_id").alias("ordinal"))
        d = inventory.first_members(d).where("is_first")
        return d.select(E.joined_id(F.col("container"), F.col("doc_id").cast("string")).alias("resource_id"), "container", F.col("path").alias("resource_path"), F.lit("tip").alias("resource_type"), "size", F.col("sha").alias("source_sha256"), F.lit("open").alias("processing_status"))

    @property
    def pairs(self) -> DataFrame:
        c = self.conversations
        w = Window.partitionBy("conv_id").orderBy("turn")
        return c.select("conv_id", "turn", F.col("text").alias("source"), F.lead("text").over(w).alias("target")).where("target IS NOT NULL")


PAIRS = "SELECT conv_id, turn, source, target FROM (SELECT conv_id, turn, text AS source, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS target FROM conversations) WHERE target IS NOT NULL"
RES = """SELECT * FROM (SELECT source AS container, CASE WHEN sha256(text) < '8' THEN substr(sha256(text), 1, 2) ELSE sha256(text) END AS path, sha256(text) AS sha, octet_length(encode(text)) AS size, doc_id FROM documents)
 QUALIFY row_number() OVER (PARTITION BY container, path ORDER BY doc_id) = 1"""


# collisions and blobs
@query(f"SELECT path AS resource_path, count(*)::BIGINT AS members, count(DISTINCT container)::BIGINT AS containers, count(DISTINCT sha) = 1 AS content_identical FROM ({RES}) GROUP BY path HAVING count(DISTINCT container) > 1")
def collision_groups(t):
    return inventory.collision_counts(t.resources)


@query(f"SELECT count(*)::BIGINT AS total, count(*) FILTER (WHERE k = 1)::BIGINT AS identical, count(*) FILTER (WHERE k > 1)::BIGINT AS unresolved FROM (SELECT path, count(DISTINCT sha) AS k FROM ({RES}) GROUP BY path HAVING count(DISTINCT container) > 1)")
def collision_summary(t):
    c = inventory.collision_counts(t.resources)
    return c.agg(F.count(F.lit(1)).alias("total"), F.count_if("content_identical").alias("identical"), F.count_if(~F.col("content_identical")).alias("unresolved"))


@query(f"SELECT path AS resource_path, list_sort(list(container)) AS containers, count(DISTINCT sha) = 1 AS content_identical, count(DISTINCT sha) > 1 AS unresolved FROM ({RES}) GROUP BY path HAVING count(DISTINCT container) > 1")
def collision_members(t):
    c = inventory.collisions(t.resources)
    return c.select("resource_path", F.array_sort(F.transform("resources", lambda r: r["container"])).alias("containers"), "content_identical", "unresolved")


@query(f"SELECT count(*)::BIGINT AS unique_blobs, sum(size)::BIGINT AS unique_bytes FROM (SELECT sha, max(size) AS size FROM ({RES}) GROUP BY sha)")
def blob_dedupe_bytes(t):
    from tessella.sources.blobs import count_bytes

    return count_bytes(t.resources)


@query("SELECT DISTINCT sha256(text) AS source_sha256, octet_length(encode(text))::BIGINT AS size FROM documents")
def distinct_blobs(t):
    from tessella.sources.blobs import distinct_blobs

    return distinct_blobs(t.documents.select(F.encode("text", "utf-8").alias("content"))).select("source_sha256", "size")


@query("SELECT doc_id, sha256(source || chr(0) || doc_id || chr(0) || lang) AS id, sha256(text) AS source_sha256, substr(sha256(source || chr(0) || doc_id || chr(0) || lang), 1, 12) AS short_id FROM documents")
def unit_ids(t):
    i = E.joined_id(F.col("source"), F.col("doc_id").cast("string"), F.col("lang"))
    return t.documents.select("doc_id", i.alias("id"), E.sha256_text(F.col("text")).alias("source_sha256"), E.id_prefix(i).alias("short_id"))


@query(f"""WITH g AS (SELECT path, substr(path, 1, 1) AS c FROM ({RES}) GROUP BY path HAVING count(DISTINCT container) > 1)
SELECT path AS resource_path, CASE WHEN c < '4' THEN 'missing' WHEN c = '5' THEN 'members' WHEN c = '6' THEN 'duplicate' ELSE 'content' END AS problem FROM g WHERE c < '4' OR c IN ('5', '6') OR c > 'b'
UNION ALL SELECT 'x' || path, 'extra' FROM g WHERE c = '7'""")
def collision_claims_check(t):
    derived = inventory.collisions(t.resources)
    first = F.substring("resource_path", 1, 1)
    wrong = derived.where(first >= "4").withColumn("content_identical", F.when(first > "b", ~F.col("content_identical")).otherwise(F.col("content_identical")))
    wrong = wrong.withColumn("resources", F.when(first == "5", F.slice("resources", 1, 1)).otherwise(F.col("resources")))
    more = derived.where(first == "7").withColumn("resource_path", F.concat(F.lit("x"), "resource_path"))
    return inventory.check_claims(wrong.unionByName(wrong.where(first == "6")).unionByName(more), derived)


# classification
@query(r"""WITH m AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS path, length(html)::BIGINT AS size FROM pages),
k AS (SELECT *, CASE WHEN page_id % 11 = 0 THEN path || '/' WHEN page_id % 11 = 1 THEN '../' || path WHEN page_id % 11 = 2 THEN path || '/a.JAR' WHEN page_id % 11 = 3 THEN path || '/text_de.properties'
 WHEN page_id % 11 = 4 THEN path || '/i18n/a.properties' WHEN page_id % 11 = 5 THEN path || '/x.properties' WHEN page_id % 11 = 6 THEN 'tips/' || path || '.html' WHEN page_id % 11 = 7 THEN 'tips/t.html'
 WHEN page_id % 11 = 8 THEN 'fileTemplates/a/' || path || '.html' ELSE path END AS p FROM m)
SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'directory' WHEN p LIKE '/%' OR list_contains(string_split(p, '/'), '..') OR contains(p, '\') THEN 'unsafe_path' WHEN regexp_matches(lower(p), '\.(jar|zip)$') THEN 'nested_archive'
 WHEN regexp_matches(p, '(?:^|/)[^/]+_(?:[a-z]{2,3})(?:_(?:[A-Z]{2}|[A-Za-z]{4})(?:_[A-Z]{2})?)?\.properties$') OR list_has_any(string_split(lower(p), '/'), ['i18n', 'l10n']) THEN 'localized'
 WHEN NOT (p LIKE '%.properties' OR (p LIKE 'tips/%.html') OR (p LIKE 'fileTemplates/%.html')) THEN 'unsupported_resource'
 WHEN p LIKE '%.properties' AND page_id % 2 = 0 THEN 'not_in_translation_reference' WHEN size > 2000 THEN 'resource_too_large' END AS reason FROM k""")
def member_cascade(t):
    path, n = F.regexp_replace("url", "^https?://", ""), F.col("page_id") % 11
    made = {0: F.concat(path, F.lit("/")), 1: F.concat(F.lit("../"), path), 2: F.concat(path, F.lit("/a.JAR")), 3: F.concat(path, F.lit("/text_de.properties")), 4: F.concat(path, F.lit("/i18n/a.properties")), 5: F.concat(path, F.lit("/x.properties")), 6: F.concat(F.lit("tips/"), path, F.lit(".html")), 7: F.lit("tips/t.html"), 8: F.concat(F.lit("fileTemplates/a/"), path, F.lit(".html"))}
    p = path
    for k, v in made.items():
        p = F.when(n == k, v).otherwise(p)
    m = t.pages.select("page_id", p.alias("path"), F.length("html").cast("bigint").alias("size"), (F.col("page_id") % 2 == 1).alias("in_reference"))
    rules = classify.ScanRules(limits={"max_resource_bytes": 2000})
    return m.select("page_id", classify.inner_reason(F.lit("pages"), F.col("path"), F.col("page_id") % 11 == 0, F.col("size"), F.col("in_reference"), rules).alias("reason"))


@query("SELECT p_partkey, CASE WHEN p_type LIKE '%BRASS' THEN 'third_party_container' WHEN p_name LIKE '%1%' THEN 'already_localized' END AS reason FROM part")
def rule_first_match(t):
    rules = t.spark.createDataFrame([(0, classify.glob_regex("*BRASS"), "third_party_container"), (1, "(?s)^never$", "never")], "pos int, glob_regex string, reason string")
    first = classify.first_rule_join(t.part.select("p_partkey", "p_name", "p_type"), rules, "p_type")
    return first.select("p_partkey", F.coalesce("reason", F.when(classify.matches_glob(F.col("p_name"), "*1*"), "already_localized")).alias("reason"))


@query("SELECT event_type AS reason, count(*)::BIGINT AS n FROM events GROUP BY event_type")
def reason_counts(t):
    return report.counts_by(t.events.withColumnRenamed("event_type", "reason"), "reason")


@query("SELECT coalesce(event_type, 'all') AS reason, coalesce(user_id % 10, -1)::BIGINT AS shard, count(*)::BIGINT AS n FROM events GROUP BY GROUPING SETS ((event_type, user_id % 10), (event_type), ())")
def reason_rollup(t):
    e = t.events.select(F.col("event_type").alias("reason"), (F.col("user_id") % 10).alias("shard"))
    return e.rollup("reason", "shard").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("reason", F.lit("all")).alias("reason"), F.coalesce("shard", F.lit(-1)).cast("bigint").alias("shard"), "n")


@query("SELECT s.status, coalesce(c.n, 0)::BIGINT AS n FROM (VALUES ('open'), ('translated'), ('technically_reviewed'), ('linguistically_reviewed')) s(status) LEFT JOIN (SELECT CASE WHEN quality IS NULL THEN 'open' WHEN toxic = 1 THEN 'translated' ELSE 'technically_reviewed' END AS status, count(*) AS n FROM labels GROUP BY 1) c USING (status)")
def status_zero_filled(t):
    s = t.labels.select(F.when(F.col("quality").isNull(), "open").when(F.col("toxic") == 1, "translated").otherwise("technically_reviewed").alias("status"))
    return report.zero_filled(s, "status", STATUSES)


# order and budgets
_MEMBERS = "SELECT source AS container, lang AS path, doc_id AS ordinal FROM documents"


@query(f"SELECT container, path, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY container, path ORDER BY ordinal) AS n FROM ({_MEMBERS})) WHERE n = 1")
def first_member_wins(t):
    m = inventory.first_members(t.documents.select(F.col("source").alias("container"), F.col("lang").alias("path"), F.col("doc_id").alias("ordinal")))
    return m.where("is_first").drop("is_first")


@query(f"SELECT container, count(*)::BIGINT AS duplicates FROM (SELECT *, row_number() OVER (PARTITION BY container, path ORDER BY ordinal) AS n FROM ({_MEMBERS})) WHERE n > 1 GROUP BY container")
def duplicate_members(t):
    m = inventory.first_members(t.documents.select(F.col("source").alias("container"), F.col("lang").alias("path"), F.col("doc_id").alias("ordinal")))
    return m.where("NOT is_first").groupBy("container").agg(F.count(F.lit(1)).alias("duplicates"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= 500 AS kept FROM orders")
def container_budget(t):
    return budgets.within_count(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], 500).select("o_orderkey", "kept")


@query("""WITH RECURSIVE d AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
r(i, doc_id, used, kept) AS (SELECT 0::BIGINT, -1::BIGINT, 0::BIGINT, FALSE UNION ALL
 SELECT d.i, d.doc_id, CASE WHEN r.used + d.n_chars <= 400000 THEN r.used + d.n_chars ELSE r.used END, r.used + d.n_chars <= 400000 FROM r JOIN d ON d.i = r.i + 1)
SELECT doc_id, kept FROM r WHERE i > 0""")
def byte_budget_greedy(t):
    return budgets.greedy(t.documents.select("doc_id", "n_chars"), ["doc_id"], "n_chars", 400_000).select("doc_id", "kept")


@query("SELECT sum(n_chars)::BIGINT AS used, count(*)::BIGINT AS kept FROM documents")
def budget_all_fits(t):
    d = budgets.greedy(t.documents.select("doc_id", "n_chars"), ["doc_id"], "n_chars", 1 << 50)
    return d.where("kept").agg(F.sum("n_chars").alias("used"), F.count(F.lit(1)).alias("kept"))


# reference and selection
@query("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS in_reference FROM documents")
def reference_gate(t):
    d = inventory.gate_by_reference(t.documents.select("doc_id"), t.labels.select("doc_id"), "doc_id")
    return d.select("doc_id", "in_reference")


@query("""WITH c AS (SELECT DISTINCT doc_id AS p FROM documents WHERE doc_id % 3 > 0), r AS (SELECT DISTINCT doc_id AS p FROM labels UNION SELECT -doc_id - 1 FROM labels WHERE doc_id % 5 = 0), e AS (SELECT DISTINCT doc_id AS p FROM documents WHERE doc_id % 3 = 1)
SELECT (SELECT count(*) FROM c)::BIGINT AS candidates, (SELECT count(*) FROM r)::BIGINT AS reference_paths, (SELECT count(*) FROM c JOIN r USING (p))::BIGINT AS overlap,
 (SELECT count(*) FROM r ANTI JOIN c USING (p))::BIGINT AS reference_only, (SELECT count(*) FROM c ANTI JOIN r USING (p))::BIGINT AS candidates_only, (SELECT count(*) FROM e JOIN r USING (p))::BIGINT AS technical_drops_in_reference""")
def coverage_metrics(t):
    d, ref = t.documents.select("doc_id"), t.labels.select("doc_id")
    dropped = d.where("doc_id % 3 = 1").withColumn("reason", F.lit("corrupt_archive"))
    more = ref.where("doc_id % 5 = 0").select((-F.col("doc_id") - 1).alias("doc_id"))
    return inventory.coverage(d.where("doc_id % 3 = 2"), dropped, ref.union(more), "doc_id")


@query("SELECT lang, count(*)::BIGINT AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY lang")
def not_present_by_type(t):
    return inventory.absent_by(t.documents.select("doc_id", "lang"), t.labels.select("doc_id"), "doc_id", "lang")


_SUPPLIED = "SELECT n_name AS resource_path, n_nationkey % 2 = 0 AS chosen, 'c' || (s_suppkey % 7) AS container, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey"


@query(f"""WITH s AS ({_SUPPLIED}) SELECT resource_path, container, s_suppkey AS resource, reason FROM (SELECT *, CASE WHEN chosen AND container <> min(container) OVER (PARTITION BY resource_path) THEN 'collision_not_selected' ELSE 'kept' END AS reason FROM s)""")
def selection_rules(t):
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.select(F.col("n_name").alias("resource_path"), F.concat(F.lit("c"), (F.col("s_suppkey") % 7).cast("string")).alias("container"), F.col("s_suppkey").alias("resource"), "n_nationkey")
    chosen = s.where("n_nationkey % 2 = 0").groupBy("resource_path").agg(F.min("container").alias("c")).collect()  # a configuration of at most 25 rules
    stays, gone = inventory.select_collisions(s, classify.ScanRules(selections=tuple((r.resource_path, r.c) for r in chosen)))
    dropped = s.join(gone.select("container", "resource_path", "reason").distinct(), ["container", "resource_path"])
    names = ["resource_path", "container", "resource", "reason"]
    return stays.withColumn("reason", F.lit("kept")).select(*names).union(dropped.select(*names))


@query("SELECT n_name AS resource_path, 'c' || (n_nationkey % 4) AS chosen FROM nation WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_suppkey % 4 = n_nationkey % 4)")
def missing_selection(t):
    tag = lambda c: F.concat(F.lit("c"), (F.col(c) % 4).cast("string"))
    wanted = t.nation.select(F.col("n_name").alias("resource_path"), tag("n_nationkey").alias("chosen"))
    have = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("resource_path"), tag("s_suppkey").alias("container"))
    return inventory.missing_selections(have, wanted)


def _paths(t):
    """Candidates: brands and types of most parts; reference: those of large parts, and names that no candidate has."""
    p = lambda where: t.part.where(where).select(F.col("p_brand").alias("path")).union(t.part.where(where).select("p_type"))
    dropped = p("p_size BETWEEN 10 AND 14").withColumn("reason", F.lit("corrupt_archive"))
    return inventory.path_sets(p("p_size < 10"), dropped, p("p_size > 46").union(t.nation.select("n_name")), "path")


_OF_PARTS = """WITH c AS (SELECT p_brand AS path FROM part WHERE p_size < 15 UNION SELECT p_type FROM part WHERE p_size < 15),
r AS (SELECT p_brand AS path FROM part WHERE p_size > 46 UNION SELECT p_type FROM part WHERE p_size > 46 UNION SELECT n_name FROM nation) """


@query(_OF_PARTS + "SELECT path FROM c INTERSECT SELECT path FROM r")
def candidate_intersection(t):
    return _paths(t).where("candidate AND reference").select(F.col("p").alias("path"))


@query(_OF_PARTS + "SELECT path FROM r EXCEPT SELECT path FROM c")
def reference_difference(t):
    return _paths(t).where("reference AND NOT candidate").select(F.col("p").alias("path"))


@query(_OF_PARTS + "SELECT path FROM c UNION SELECT path FROM r")
def reference_union(t):
    return _paths(t).select(F.col("p").alias("path"))


# generations
def _generations(t):
    """orders as units: an earlier generation lacks some, and differs in some."""
    o = t.orders.select((F.col("o_orderkey") % 7).cast("string").alias("container"), F.concat(F.lit("a/"), F.col("o_custkey").cast("string"), F.lit(".properties")).alias("resource_path"), F.col("o_orderkey").cast("string").alias("key"), F.when(F.col("o_orderkey") % 13 == 0, "").otherwise(F.col("o_orderpriority")).alias("source"))
    now = units.identify(o)
    moved = F.when(F.col("key").cast("long") % 5 == 0, F.concat(F.lit("old"), F.col("container"))).otherwise(F.col("container"))
    text = F.when(F.col("key").cast("long") % 11 == 0, F.lit("before")).otherwise(F.col("source"))
    old = units.identify(o.where("key % 17 <> 0").select(moved.alias("container"), "resource_path", "key", text.alias("source")))
    old = old.withColumn("target", F.when(F.col("context.key").cast("long") % 3 == 0, "").otherwise(F.concat(F.lit("de:"), F.col("source")))).withColumn("status", F.when(F.col("target") == "", "open").otherwise("technically_reviewed")).withColumn("findings", F.array().cast(FINDINGS))
    return now, old


_GENERATIONS = r"""WITH o AS (SELECT CAST(o_orderkey % 7 AS VARCHAR) AS container, 'a/' || o_custkey || '.properties' AS path, o_orderkey AS k, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderpriority END AS source FROM orders),
now_ AS (SELECT *, sha256(container || chr(0) || path || chr(0) || k) AS id FROM o),
old_ AS (SELECT *, sha256(container || chr(0) || path || chr(0) || k) AS id, CASE WHEN k % 3 = 0 THEN '' ELSE 'de:' || source END AS target FROM
 (SELECT CASE WHEN k % 5 = 0 THEN 'old' || container ELSE container END AS container, path, k, CASE WHEN k % 11 = 0 THEN 'before' ELSE source END AS source FROM o WHERE k % 17 <> 0)) """


@query(_GENERATIONS + """, l AS (SELECT path, k, source, min_by(target, id) AS target FROM old_ WHERE target <> '' GROUP BY path, k, source)
SELECT n.id, CASE WHEN n.source = '' THEN '' WHEN i.id IS NOT NULL AND i.source = n.source THEN i.target ELSE coalesce(l.target, '') END AS target,
 CASE WHEN n.source = '' THEN 'technically_reviewed' WHEN i.id IS NOT NULL AND i.source = n.source THEN CASE WHEN i.target = '' THEN 'open' ELSE 'technically_reviewed' END WHEN l.target IS NOT NULL THEN 'technically_reviewed' ELSE 'open' END AS status
FROM now_ n LEFT JOIN old_ i ON n.id = i.id LEFT JOIN l ON l.path = n.path AND l.k = n.k AND l.source = n.source""")
def carry_over(t):
    return units.carry_over(*_generations(t)).select("id", "target", "status")


@query(_GENERATIONS + "SELECT o.id, CASE WHEN n.id IS NULL THEN 'removed_from_source' ELSE 'source_changed' END AS reason FROM old_ o LEFT JOIN now_ n ON o.id = n.id WHERE n.id IS NULL OR n.source <> o.source")
def stale_units(t):
    now, old = _generations(t)
    return units.stale_units(old, now, "1").select("id", "reason")


@query(_GENERATIONS + "SELECT CASE WHEN n.id IS NULL THEN 'removed_from_source' ELSE 'source_changed' END AS reason, count(*)::BIGINT AS n FROM old_ o LEFT JOIN now_ n ON o.id = n.id WHERE n.id IS NULL OR n.source <> o.source GROUP BY 1")
def stale_by_reason(t):
    now, old = _generations(t)
    return report.counts_by(units.stale_units(old, now, "1"), "reason")


# structural checks
@query("""WITH p AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), u AS (SELECT o_orderkey AS k, count(*) AS n FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 8 = 0 UNION ALL SELECT -o_orderkey - 1 FROM orders WHERE o_orderkey % 50 = 1) GROUP BY 1)
SELECT coalesce(p.k, u.k) AS key, CASE WHEN u.k IS NULL THEN 'missing' WHEN p.k IS NULL THEN 'extra' ELSE 'duplicate' END AS problem FROM p FULL JOIN u ON p.k = u.k WHERE u.k IS NULL OR p.k IS NULL OR u.n > 1""")
def key_problems_full_outer(t):
    o, place = t.orders.select(F.col("o_orderkey").alias("key")), [F.lit("c").alias("container"), F.lit("r").alias("resource_path")]
    parsed = t.lineitem.select(*place, F.col("l_orderkey").alias("key"))
    have = o.where("key % 9 <> 0").union(o.where("key % 8 = 0")).union(o.where("key % 50 = 1").select(-F.col("key") - 1)).select(*place, "key")
    return render.key_problems(parsed, have).select("key", "problem")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def units_without_resource(t):
    u = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.struct(F.lit("").alias("bundle"), F.lit("").alias("key"), F.lit("c").alias("container"), F.col("o_custkey").cast("string").alias("path")).alias("context"), *(F.lit("").alias(c) for c in ("source", "source_sha256", "target", "status", "findings")))
    r = t.customer.where("c_custkey % 3 = 0").select(F.lit("c").alias("container"), F.col("c_custkey").cast("string").alias("resource_path"))
    return render.units_without_resource(u, r)


@query("SELECT CAST(c_custkey AS VARCHAR) AS resource_id FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 4 > 0)")
def resources_without_unit(t):
    u = t.orders.where("o_custkey % 4 > 0").select(F.struct(F.lit("").alias("bundle"), F.lit("").alias("key"), F.lit("c").alias("container"), F.col("o_custkey").cast("string").alias("path")).alias("context"), *(F.lit("").alias(c) for c in ("id", "source", "source_sha256", "target", "status", "findings")))
    r = t.customer.select(F.col("c_custkey").cast("string").alias("resource_id"), F.lit("c").alias("container"), F.col("c_custkey").cast("string").alias("resource_path"), F.when(F.col("c_mktsegment") == "BUILDING", "properties").otherwise("tip").alias("resource_type"))
    return render.resources_without_unit(r, u)


@query("SELECT lower(c_mktsegment) || '/strasse' AS folded, count(DISTINCT CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) || '/STRASSE' WHEN c_custkey % 3 = 1 THEN c_mktsegment || '/Straße' ELSE c_mktsegment || '/strasse' END)::BIGINT AS n FROM customer GROUP BY 1 HAVING n > 1")
def case_clashes(t):
    n = F.col("c_custkey") % 3
    path = F.when(n == 0, F.concat(F.lower("c_mktsegment"), F.lit("/STRASSE"))).when(n == 1, F.concat("c_mktsegment", F.lit("/Straße"))).otherwise(F.concat("c_mktsegment", F.lit("/strasse")))
    return render.case_clashes(t.customer.select(path.alias("path")), "path").select("folded", F.size("paths").cast("bigint").alias("n"))


@query("SELECT CAST(doc_id AS VARCHAR) AS resource_id FROM documents WHERE text IS NOT NULL AND (doc_id % 5 = 0 OR doc_id % 7 = 0 OR doc_id % 11 = 0)")
def broken_hashes(t):
    """Sources that aren't what the inventory says: another hash, another size, or none."""
    d, n = t.documents.where("text IS NOT NULL"), F.col("doc_id")
    place = [F.lit("c").alias("container"), n.cast("string").alias("resource_path")]
    sha = F.when(n % 5 == 0, F.lit("0" * 64)).otherwise(E.sha256_text(F.col("text")))
    resources = d.select(n.cast("string").alias("resource_id"), *place, sha.alias("source_sha256"), (F.octet_length("text") + (n % 7 == 0).cast("int")).cast("bigint").alias("size"))
    return render.broken_hashes(resources, d.where("doc_id % 11 <> 0").select(*place, F.encode("text", "utf-8").alias("content")))


# queue
@query("SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY CAST(doc_id AS VARCHAR) LIMIT 100")
def queue_top_k(t):
    d = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return queue.open_units(d.select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality").isNull(), "open").otherwise("translated").alias("status")), 100).select("id")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey < 1000 AND o_orderkey % 3 = 0 THEN 'done' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey < 1000 AND o_orderkey % 3 = 0 THEN 'new' ELSE o_orderpriority END AS target FROM orders")
def batch_merge_upsert(t):
    u = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("target"))
    batch = u.where("id < 1000 AND id % 3 = 0").select("id", F.lit("done").alias("status"), F.lit("new").alias("target"))
    return queue.upsert(u, batch)


@query("SELECT b.id, unnest(CASE WHEN b.id < 0 THEN ['id'] WHEN b.id % 10 = 0 THEN ['source', 'status'] WHEN b.id % 10 = 1 THEN ['status'] ELSE [] END) AS field FROM (SELECT CASE WHEN o_orderkey % 10 = 5 THEN -o_orderkey ELSE o_orderkey END AS id FROM orders WHERE o_orderkey <= 900) b")
def batch_changed_fields(t):
    u = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("status"))
    n = F.col("id") % 10
    b = u.where("id <= 900").select(F.when(n == 5, -F.col("id")).otherwise(F.col("id")).alias("id"), F.when(n == 0, "other").otherwise(F.col("source")).alias("source"), F.when(n <= 1, "other").otherwise(F.col("status")).alias("status"))
    return queue.changed_fields(u, b, ("source", "status"))


@query("SELECT CASE WHEN bool_or(quality IS NULL) THEN 'translate' WHEN bool_or(toxic = 1) THEN 'validate' ELSE 'generate' END AS workflow_state, CASE WHEN bool_or(quality IS NULL) THEN 'next-batch' WHEN bool_or(toxic = 1) THEN 'validate' ELSE 'generate' END AS next_command FROM labels")
def workflow_state(t):
    s = t.labels.select(F.when(F.col("quality").isNull(), "open").when(F.col("toxic") == 1, "translated").otherwise("technically_reviewed").alias("status"))
    return report.state_of(s)


# findings
@query(f"SELECT conv_id, turn, length(target) > 2.5 * length(source) AS hit FROM ({PAIRS})")
def pair_length_ratio(t):
    return t.pairs.select("conv_id", "turn", E.length_ratio(F.col("source"), F.col("target")).alias("hit"))


@query(f"SELECT conv_id, turn FROM (SELECT conv_id, turn, source, CASE WHEN turn % 3 = 0 THEN chr(9) || ' ' ELSE target END AS target FROM ({PAIRS})) WHERE regexp_matches(source, '\\S') AND NOT regexp_matches(target, '\\S')")
def pair_empty_target(t):
    p = t.pairs.withColumn("target", F.when(F.col("turn") % 3 == 0, "\t ").otherwise(F.col("target")))
    return p.where(E.empty_target(F.col("source"), F.col("target"))).select("conv_id", "turn")


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)(^|[^\\p{L}\\p{N}_])(the|und|que)([^\\p{L}\\p{N}_]|$)')")
def glossary_hits(t):
    return t.documents.where(E.glossary_mismatch(F.col("text"), {"preferred": ["the", "und", "que"], "same": "Same"})).select("doc_id")


_PARTS = "SELECT p_partkey AS id, p_partkey % 8 AS v, 'Part {0}: ' || p_name || ' %d of {1,number,#.#} ${name} &File' AS source FROM part"
_TARGETS = """CASE v WHEN 0 THEN source WHEN 1 THEN replace(source, '{0}', '{2}') WHEN 2 THEN replace(source, '{0}', '{0') WHEN 3 THEN replace(source, '%d', '%s') WHEN 4 THEN replace(source, '${name}', '') WHEN 5 THEN replace(source, '&File', 'File') WHEN 6 THEN source || repeat('x', 400) ELSE '' END"""
_CODES = """CASE v WHEN 0 THEN [] WHEN 1 THEN ['placeholder_mismatch'] WHEN 2 THEN ['message_format_invalid', 'placeholder_mismatch'] WHEN 3 THEN ['placeholder_mismatch'] WHEN 4 THEN ['placeholder_mismatch'] WHEN 5 THEN ['placeholder_mismatch'] WHEN 6 THEN ['length_ratio'] ELSE ['empty_target', 'placeholder_mismatch'] END"""


def _parts(t):
    source = F.concat(F.lit("Part {0}: "), "p_name", F.lit(" %d of {1,number,#.#} ${name} &File"))
    swap = lambda a, b: F.replace("source", F.lit(a), F.lit(b))  # noqa: E731  no SQL text: it takes ${name} for a variable
    changes = [F.col("source"), swap("{0}", "{2}"), swap("{0}", "{0"), swap("%d", "%s"), swap("${name}", ""), swap("&File", "File"), F.concat("source", F.lit("x" * 400))]
    target = F.lit("")
    for v, change in enumerate(changes):
        target = F.when(F.col("v") == v, change).otherwise(target)
    return t.part.select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 8).alias("v"), source.alias("source")).withColumn("target", target)


@query(f"SELECT id, unnest({_CODES}) AS code FROM ({_PARTS})")
def message_format_codes(t):
    return _parts(t).select("id", F.explode_outer(V.finding_codes(F.col("source"), F.col("target"))).alias("code")).where("code IS NOT NULL")


@query(f"SELECT code, CASE WHEN code = 'length_ratio' THEN 'warning' ELSE 'blocking' END AS severity, count(*)::BIGINT AS n FROM (SELECT unnest({_CODES}) AS code FROM ({_PARTS})) GROUP BY code")
def findings_by_code(t):
    return report.findings_by_code(_parts(t).select(V.findings(F.col("source"), F.col("target")).alias("findings")))


@query(f"SELECT id, CASE WHEN target = '' THEN 'open' WHEN v IN (0, 6) THEN 'technically_reviewed' ELSE 'translated' END AS status FROM (SELECT id, v, source, {_TARGETS} AS target FROM ({_PARTS}))")
def revalidated_status(t):
    p = _parts(t).select(F.col("id").cast("string").alias("id"), "source", F.lit("").alias("source_sha256"), "target", F.lit(None).cast("struct<bundle:string,key:string,container:string,path:string>").alias("context"), F.lit("open").alias("status"), F.array().cast(FINDINGS).alias("findings"))
    return units.revalidate(p).select(F.col("id").cast("bigint").alias("id"), "status")


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 6 = 0 THEN FALSE ELSE p_partkey % 6 > 2 END AS invalid FROM part")
def choice_format_codes(t):
    styles = ["0#none|1#one|1<many", "-∞<few|0#none|0x1p3≤more", "plain", "1#one|0#none", "1<a|1<b", "x#none|1#one"]
    good = F.lit("{0,choice,0#a|1#b}")
    target = F.lit("")
    for i, s in enumerate(styles):
        target = F.when(F.col("p_partkey") % 6 == i, F.lit("{0,choice," + s + "}")).otherwise(target)
    codes = V.finding_codes(good, target)
    return t.part.select(F.col("p_partkey").alias("id"), F.array_contains(codes, "message_format_invalid").alias("invalid"))


@query("SELECT doc_id, len(regexp_extract_all(text, '%(?:%|(?:\\d+\\$)?[-#+ 0,(<]*\\d*(?:\\.\\d+)?(?:[tT][HIklMSLNpzZsQBbhAaCYyjmdeRTrDFc]|[bBhHsScCdoxXeEfgGaAn]))'))::BIGINT AS n FROM documents")
def printf_tokens(t):
    return t.documents.select("doc_id", F.size(E.printf_tokens(F.col("text"))).cast("bigint").alias("n"))


@query("SELECT doc_id, len(regexp_extract_all(replace(text, ' of ', ' ${of} $OF$ '), '\\$\\{[A-Za-z_][A-Za-z0-9_.-]*\\}|\\$[A-Za-z_][A-Za-z0-9_]*\\$'))::BIGINT AS n FROM documents")
def template_tokens(t):
    return t.documents.select("doc_id", F.size(E.template_tokens(F.replace("text", F.lit(" of "), F.lit(" ${of} $OF$ ")))).cast("bigint").alias("n"))


@query(r"""WITH d AS (SELECT doc_id, regexp_extract_all(text, '(?s)&&.?|__.?|[&_][\p{L}\p{N}]|[^&_]+|.') AS t FROM documents)
SELECT doc_id, CASE WHEN t IS NOT NULL THEN [CASE WHEN left(t[i], 2) IN ('&&', '__') THEN 'escaped:' ELSE 'mnemonic:' END || left(t[i], 1) FOR i IN range(1, len(t) + 1)
 IF left(t[i], 2) IN ('&&', '__') OR (regexp_full_match(t[i], '[&_][\p{L}\p{N}]') AND (i = 1 OR NOT regexp_matches(right(t[i - 1], 1), '[\p{L}\p{N}]')))] END AS tokens FROM d""")
def mnemonic_tokens(t):
    """All documents' own texts. The twin can't look behind, so it cuts texts into markers and what lies between, and looks at
    the piece before."""
    return t.documents.select("doc_id", E.mnemonic_tokens(F.col("text")).alias("tokens"))


@query("SELECT doc_id, len(string_split(regexp_replace(text, '\\r\\n|\\r', chr(10), 'g'), chr(10)))::BIGINT AS lines, regexp_matches(text, '(^|[^\\\\])(\\\\\\\\)*\\\\$') AS continued FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text || chr(13) || 'x' || chr(92) WHEN 1 THEN text || chr(92) || chr(92) ELSE text END AS text FROM documents)")
def natural_lines(t):
    n, back = F.col("doc_id") % 4, "\\"
    text = F.when(n == 0, F.concat("text", F.lit("\rx" + back))).when(n == 1, F.concat("text", F.lit(back * 2))).otherwise(F.col("text"))
    return t.documents.select("doc_id", text.alias("text")).select("doc_id", F.size(E.natural_lines(F.col("text"))).cast("bigint").alias("lines"), E.is_continued(F.col("text")).alias("continued"))


@query("SELECT page_id, len(regexp_extract_all(html, '</?[A-Za-z][^<>]*>'))::BIGINT AS tags, length(regexp_replace(html, '</?[A-Za-z][^<>]*>', '', 'g'))::BIGINT AS visible FROM pages")
def tag_tokens(t):
    return t.pages.select("page_id", F.size(E.tag_tokens(F.col("html"))).cast("bigint").alias("tags"), F.length(E.strip_tags(F.col("html"))).cast("bigint").alias("visible"))


@query("SELECT p_partkey AS id, p_partkey % 4 IN (1, 3) AS differs FROM part")
def placeholder_multiset(t):
    a = F.concat("p_name", F.lit(" ${a} ${b} ${a}"))
    n = F.col("p_partkey") % 4
    b = F.when(n == 0, F.concat(F.lit("${b} "), "p_name", F.lit(" ${a}${a}"))).when(n == 1, F.concat("p_name", F.lit("${a} ${b}"))).when(n == 2, F.concat(F.lit("${a}${b}"), "p_name", F.lit("${a}"))).otherwise(F.concat(F.lit("${a} ${b} ${b}"), "p_name"))
    return t.part.select(F.col("p_partkey").alias("id"), (~E.same_multiset(E.template_tokens(a), E.template_tokens(b))).alias("differs"))


@query(r"""WITH p AS (SELECT page_id, regexp_replace(regexp_replace(coalesce(html, ''), '(<script\b[^<>]*>).*?</script>', '\1</script>', 'gis'), '(<style\b[^<>]*>).*?</style>', '\1</style>', 'gis') AS h FROM pages),
q AS (SELECT page_id, len(regexp_extract_all(h, '(?s)<!--.*?-->')) AS comments, regexp_matches(h, '(?i)<!doctype') AS declared, regexp_extract_all(regexp_replace(h, '<!--.*?-->', '', 'gs'), '</?[A-Za-z][^<>]*>') AS tags FROM p),
k AS (SELECT *, [lower(regexp_extract(x, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) FOR x IN tags] AS names FROM q),
e AS (SELECT *, [CASE WHEN left(tags[i], 2) = '</' THEN '-' || names[i] WHEN right(tags[i], 2) = '/>' OR names[i] IN ('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'param', 'source', 'track', 'wbr') THEN '.' ELSE '+' || names[i] END FOR i IN range(1, len(tags) + 1)] AS steps,
 list_sum([len(regexp_extract_all(x, '(?i)\s(?:href|src)\s*=')) FOR x IN tags]) AS links FROM k),
w AS (SELECT *, list_reduce(list_concat([''], steps), lambda s, x: CASE WHEN left(x, 1) = '+' THEN s || '/' || x[2:] WHEN left(x, 1) = '-' AND ends_with(s, '/' || x[2:]) THEN left(s, length(s) - length(x)) ELSE s END) AS open,
 len([x FOR x IN steps IF left(x, 1) = '+']) AS opened, len([x FOR x IN steps IF left(x, 1) = '-']) AS closed FROM e),
z AS (SELECT *, opened - len(string_split(open, '/')) + 1 AS ended FROM w)
SELECT page_id, NOT declared AND open = '' AND closed = ended AS valid, (comments + len(steps) - closed + ended)::BIGINT AS events, coalesce(links, 0)::BIGINT AS links FROM z""")
def markup_structure(t):
    @F.pandas_udf("struct<valid:boolean,events:bigint,links:bigint>")
    def shape(html: pd.Series) -> pd.DataFrame:
        parsed = [parse_markup(h or "") for h in html]
        return pd.DataFrame({"valid": [p.valid for p in parsed], "events": [len(p.structure) for p in parsed], "links": [len(p.links) for p in parsed]})

    return t.pages.select("page_id", shape("html").alias("m")).select("page_id", "m.valid", "m.events", "m.links")


@query("SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'link_changed' WHEN 2 THEN 'markup_structure_changed' WHEN 3 THEN 'markup_structure_changed' END AS code FROM part")
def link_extract(t):
    source = F.concat(F.lit('<p>'), "p_name", F.lit(' <a href="x">y</a><br></p>'))
    target = F.expr("""CASE p_partkey % 5 WHEN 0 THEN concat('<p>', p_name, ' <a href="x">z</a><br/></p>') WHEN 1 THEN concat('<p>', p_name, ' <a href="z">y</a><br></p>')
      WHEN 2 THEN concat('<p>', p_name, ' <a href="x">y</a></p>') WHEN 3 THEN concat('<p>', p_name, ' <a href="x">y<br></p>') ELSE concat('<p>', p_name, ' <a href=''x''>y</a><br></p>') END""")
    codes = V.finding_codes(source, target)
    return t.part.select(F.col("p_partkey").alias("id"), F.get(codes, F.lit(0)).alias("code"))


# properties and rendering
@query("SELECT n_nationkey AS id, 'k.' || n_name AS key, r_name || ' = ' || n_name || ': \\' AS value FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT n_nationkey, 'long', 'ab' FROM nation")
def properties_explode(t):
    properties.register(t.spark)
    value = F.concat("r_name", F.lit(" = "), "n_name", F.lit(": \\"))
    j = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    text = F.concat(F.lit("# c\n! d\r\nk."), "n_name", F.lit(" = "), E.escape_value(value), F.lit("\nlong : a\\\n   b"))
    j.select(F.col("n_nationkey").alias("id"), text.cast("binary").alias("content")).createOrReplaceTempView("_tessella_properties")
    return t.spark.sql("SELECT t.id, p.key, p.value FROM _tessella_properties t, LATERAL parse_properties(t.content) p")


@query("SELECT n_nationkey AS id, '#c' || chr(10) || 'a=' || upper(n_name) || chr(10) || 'b : keep' AS text FROM nation")
def properties_roundtrip(t):
    @F.pandas_udf("string")
    def rendered(content: pd.Series, value: pd.Series) -> pd.Series:
        return pd.Series([properties.render(bytes(c), {"a": v}).decode() for c, v in zip(content, value, strict=True)])

    content = F.concat(F.lit("#c\na="), "n_name", F.lit("\nb : keep")).cast("binary")
    return t.nation.select(F.col("n_nationkey").alias("id"), rendered(content, F.upper("n_name")).alias("text"))


@query("SELECT n_nationkey AS id, 'k' || n_nationkey AS key, 'a\\=' || n_name AS value FROM nation")
def split_property(t):
    line = F.concat(F.lit("k"), F.col("n_nationkey").cast("string"), F.lit(" \t: a\\="), "n_name")
    return t.nation.select(F.col("n_nationkey").alias("id"), E.split_property(line).alias("p")).select("id", "p.key", "p.value")


@query("SELECT doc_id, replace(rtrim(regexp_replace(text, '\\r\\n|\\r', chr(10), 'g'), chr(10)), chr(10), chr(13) || chr(10)) || chr(13) || chr(10) AS text FROM documents")
def newline_normalise(t):
    return t.documents.select("doc_id", E.normalise_newlines(F.lit("a\r\nb\r\n"), F.col("text")).alias("text"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source || '_de.properties' ELSE source || '.html' END AS path, source AS stem FROM documents")
def output_paths(t):
    p = F.concat("source", F.when(F.col("doc_id") % 2 == 0, ".properties").otherwise(".html"))
    return t.documents.select("doc_id", E.output_path(p).alias("path"), E.path_stem(p).alias("stem"))


@query("SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages")
def html_escape(t):
    return t.pages.select("page_id", E.escape_html(F.col("html")).alias("escaped"))


@query("""WITH l AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '## v' || (turn // 3) ELSE '- ' || role END AS line FROM conversations)
SELECT conv_id AS doc_id, turn AS pos, line, 'v' || (turn // 3) AS section FROM l WHERE turn % 3 <> 0 AND turn >= 0""")
def changelog_sections(t):
    c = t.conversations
    line = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("## v"), F.floor(F.col("turn") / 3).cast("string"))).otherwise(F.concat(F.lit("- "), "role"))
    return report.section_lines(c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), line.alias("line")))


# state
@query("""SELECT CAST(n_nationkey AS VARCHAR) AS id, '{"id":"' || n_nationkey || '","nested":{"a":' || n_regionkey || ',"b":null},"text":"' || n_name || '"}' AS line FROM nation""")
def canonical_json(t):
    from tessella.sources.jsonl import canonical_lines

    n = t.nation.select(F.col("n_name").alias("text"), F.col("n_nationkey").cast("string").alias("id"), F.struct(F.lit(None).cast("string").alias("b"), F.col("n_regionkey").alias("a")).alias("nested"))
    return canonical_lines(n)


@query("SELECT CAST(user_id AS VARCHAR) AS id, count(*)::BIGINT AS n FROM events GROUP BY user_id HAVING count(*) > 1")
def repeated_ids(t):
    return t.events.groupBy(F.col("user_id").cast("string").alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(f"""WITH ex AS (SELECT event_type AS reason FROM events), re AS (SELECT lang AS kind FROM documents), co AS (SELECT count(DISTINCT sha) AS k FROM ({RES}) GROUP BY path HAVING count(DISTINCT container) > 1)
SELECT 'reason' AS measure, reason AS name, count(*)::BIGINT AS n FROM ex GROUP BY reason UNION ALL SELECT 'exclusions', '', count(*) FROM ex
UNION ALL SELECT 'type', kind, count(*) FROM re GROUP BY kind UNION ALL SELECT 'resources', '', count(*) FROM re
UNION ALL SELECT 'collisions', 'total', count(*) FROM co UNION ALL SELECT 'collisions', 'identical', count(*) FILTER (WHERE k = 1) FROM co UNION ALL SELECT 'collisions', 'unresolved', count(*) FILTER (WHERE k > 1) FROM co
UNION ALL SELECT 'units', '', count(*) FROM labels""")
def inventory_summary(t):
    collided = inventory.collision_counts(t.resources).withColumn("unresolved", ~F.col("content_identical"))
    return report.summary(t.documents.select(F.col("lang").alias("resource_type")), t.events.select(F.col("event_type").alias("reason")), collided, t.labels)


# members and records, by the parts of their names
_OUTER = """SELECT p_partkey, p_size, p_brand, CASE p_partkey % 6 WHEN 0 THEN 'lib/' || p_name || '.jar' WHEN 1 THEN 'lib\\' || p_name || '.jar' WHEN 2 THEN 'plugins/' || p_type || '/' || p_name || '.JAR'
 WHEN 3 THEN 'bin/' || p_name || '.so' WHEN 4 THEN 'lib/' || p_name || '/' ELSE '/' || p_name || '.jar' END AS name FROM part"""


def _outer(t) -> DataFrame:
    n, e = F.col("p_partkey") % 6, F.concat
    name = F.when(n == 0, e(F.lit("lib/"), "p_name", F.lit(".jar"))).when(n == 1, e(F.lit("lib\\"), "p_name", F.lit(".jar"))).when(n == 2, e(F.lit("plugins/"), "p_type", F.lit("/"), "p_name", F.lit(".JAR")))
    name = name.when(n == 3, e(F.lit("bin/"), "p_name", F.lit(".so"))).when(n == 4, e(F.lit("lib/"), "p_name", F.lit("/"))).otherwise(e(F.lit("/"), "p_name", F.lit(".jar")))
    return t.part.select("p_partkey", "p_size", "p_brand", name.alias("name"))


@query(f"""SELECT p_partkey, CASE WHEN name LIKE '%/' THEN 'directory' WHEN name LIKE '/%' OR contains(name, '\\') THEN 'unsafe_path' WHEN NOT lower(name) LIKE '%.jar' THEN 'not_jar'
 WHEN name LIKE 'plugins/ECO%' THEN 'third_party_container' WHEN name LIKE 'lib/%old%' THEN 'already_localized' WHEN p_size > 20 THEN 'nested_jar_too_large' END AS reason FROM ({_OUTER})""")
def outer_cascade(t):
    """The first reason for which an outer member isn't opened; its size counts last."""
    rules = classify.ScanRules(container_rules=(("plugins/ECO*", "third_party_container"), ("lib/*old*", "already_localized")), limits={"max_nested_jar_bytes": 20})
    m = _outer(t)
    reason, large = classify.outer_reason(F.col("name"), F.col("name").endswith("/"), F.col("p_size"), rules)
    return m.select("p_partkey", F.when(reason.isNull() & large, "nested_jar_too_large").otherwise(reason).alias("reason"))


@query("""SELECT page_id, CASE WHEN host LIKE 'a%' AND path LIKE '%1%.properties' THEN 'non_translatable_resource' WHEN path LIKE '%2%' THEN 'non_translatable_resource' END AS reason
 FROM (SELECT page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS host, 'm' || page_id || '.properties' AS path FROM pages)""")
def resource_exclusions(t):
    """Rules that need both a container and a resource to match."""
    rules = classify.ScanRules(resource_rules=(("a*", "*1*.properties", "non_translatable_resource"), ("*", "*2*", "non_translatable_resource")))
    path = F.concat(F.lit("m"), F.col("page_id").cast("string"), F.lit(".properties"))
    m = t.pages.select("page_id", F.split_part(F.regexp_replace("url", "^https?://", ""), F.lit("/"), F.lit(1)).alias("host"), path.alias("path"))
    return m.select("page_id", classify.inner_reason(F.col("host"), F.col("path"), F.lit(False), F.lit(1), F.lit(True), rules).alias("reason"))


_NAMED = """SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'META-INF/plugin' || page_id || '.properties' WHEN 1 THEN 'tips/__index__/' || page_id || '.html' WHEN 2 THEN 'tips/' || page_id || '.html' WHEN 3 THEN 'm' || page_id || '.properties'
 WHEN 4 THEN '../m.properties' WHEN 5 THEN 'tips/' || page_id || '.svg' ELSE 'fileTemplates/' || page_id || '.html' END AS path FROM pages"""


def _named(t) -> DataFrame:
    i, n = F.col("page_id").cast("string"), F.col("page_id") % 7
    made = {0: ("META-INF/plugin", ".properties"), 1: ("tips/__index__/", ".html"), 2: ("tips/", ".html"), 3: ("m", ".properties"), 5: ("tips/", ".svg"), 6: ("fileTemplates/", ".html")}
    path = F.lit("../m.properties")
    for k, (a, b) in made.items():
        path = F.when(n == k, F.concat(F.lit(a), i, F.lit(b))).otherwise(path)
    return t.pages.select("page_id", path.alias("path"))


@query(f"SELECT path, count(*)::BIGINT AS n FROM ({_NAMED}) WHERE page_id % 7 IN (2, 3, 6) GROUP BY path")
def reference_paths(t):
    """What a reference archive counts with: resources, without those that only accompany it."""
    return _named(t).where(classify.is_reference_path(F.col("path"), classify.ScanRules())).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT page_id, (kind = 'properties' AND path LIKE '%.properties') OR (kind = 'tip' AND path LIKE 'tips/%.html') OR (kind = 'file_template' AND path LIKE 'fileTemplates/%.html') AS supported
 FROM (SELECT *, CASE page_id % 3 WHEN 0 THEN 'properties' WHEN 1 THEN 'tip' ELSE 'file_template' END AS kind FROM ({_NAMED}))""")
def supported_records(t):
    """Whether a record's type, place and ending go together."""
    kind = F.element_at(F.array(F.lit("properties"), F.lit("tip"), F.lit("file_template")), (F.col("page_id") % 3 + 1).cast("int"))
    return _named(t).select("page_id", classify.is_supported(kind, F.col("path")).alias("supported"))


# what keeps units from being rendered
@query("SELECT CAST(doc_id AS VARCHAR) AS id FROM labels WHERE quality < 2 OR toxic = 1")
def unfinished_units(t):
    """Units that aren't reviewed, or have a finding that blocks."""
    finding = F.array(F.struct(F.lit("placeholder_mismatch").alias("code"), F.lit("blocking").alias("severity"))).cast(FINDINGS)
    state = F.element_at(F.array(*(F.lit(s) for s in STATUSES)), F.least(F.col("quality"), F.lit(3)) + 1)
    return render.unfinished(t.labels.select(F.col("doc_id").cast("string").alias("id"), state.alias("status"), F.when(F.col("toxic") == 1, finding).otherwise(F.array().cast(FINDINGS)).alias("findings")))


@query(f"SELECT container, path AS resource_path FROM ({RES}) WHERE size % 10 < 2")
def stray_contents(t):
    """Contents that no resource claims, or that are there twice."""
    r, last = t.resources, F.col("size") % 10
    return render.stray_contents(r.where(last != 0), r.unionByName(r.where(last == 1)))


@query("SELECT doc_id, count(DISTINCT s)::BIGINT AS styles FROM (SELECT doc_id, unnest(list_concat(regexp_extract_all(text || CASE doc_id % 3 WHEN 0 THEN chr(13) || chr(10) WHEN 1 THEN chr(13) ELSE '' END, '\\r\\n|\\r|\\n'), [NULL])) AS s FROM documents WHERE text IS NOT NULL) GROUP BY doc_id")
def newline_style_sets(t):
    """How many newline styles a text mixes."""
    n = F.col("doc_id") % 3
    text = F.concat("text", F.when(n == 0, "\r\n").when(n == 1, "\r").otherwise(""))
    return t.documents.where("text IS NOT NULL").select("doc_id", F.size(E.newline_styles(text)).cast("bigint").alias("styles"))


@query("SELECT coalesce(bool_or(quality = 0), false) AS any_open, coalesce(bool_and(quality <> 0), true) AS none_open, coalesce(bool_or(toxic = 1), false) AS any_blocking FROM labels")
def unit_quantifiers(t):
    finding = F.array(F.struct(F.lit("x").alias("code"), F.when(F.col("toxic") == 1, "blocking").otherwise("warning").alias("severity"))).cast(FINDINGS)
    u = t.labels.select(F.col("quality") == 0, V.is_blocking(finding)).toDF("open", "blocking")
    return u.agg(F.coalesce(F.bool_or("open"), F.lit(False)).alias("any_open"), F.coalesce(F.bool_and(~F.col("open")), F.lit(True)).alias("none_open"), F.coalesce(F.bool_or("blocking"), F.lit(False)).alias("any_blocking"))

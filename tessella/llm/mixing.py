"""Mixing sources to target weights, with exact budgets, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import HOT_KEYS, SPACE, WORD, cut, lookup

#: Fixed values of the contract: weights in turn, the share of all sizes, the most often a source may be used.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Rows that a range of a source's hash keys holds on average.
RANGE_ROWS = 4_096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def running(rows: DataFrame, n: int, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """rows (n of them) with, for each name of `sums`, the sum over the rows before it in `order`, by ranges of RANGE_ROWS."""
    ranged = cut(rows.repartitionByRange(max(1, -(-n // RANGE_ROWS)), *order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_first_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    each = ranged.groupBy(F.col("_range").alias("_first_range")).agg(*(F.sum(c).alias(f"_sum{k}") for k, c in sums.items()))
    starts = each.select("_first_range", *(F.coalesce(F.sum(f"_sum{k}").over(before), F.lit(0)).alias(f"_start{k}") for k in sums))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    made = ranged.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_inside{k}") for k, c in sums.items())).join(starts, F.col("_range") == F.col("_first_range"))
    return made.select(*rows.columns, *((F.col(f"_start{k}") + F.col(f"_inside{k}")).alias(k) for k in sums))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """sizes (_source, _source_size, _n): one row a source. Adds _target: weights shared out, none above `most` sizes.

    Sources are filled in order of the level at which they are full, so that the level of the rest follows from running
    sums and needs no iteration. Sources may be many: their order and sums are made by ranges.
    """
    sizes = cut(sizes)
    n, total = sizes.agg(F.count(F.lit(1)), F.sum("_source_size").cast("double")).first()
    if not n:
        return sizes.withColumn("_target", F.lit(0.0))
    numbered = running(sizes, n, [F.col("_source").asc_nulls_last()], {"_turn": F.lit(1)})
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("_turn"), F.lit(len(weights))) + 1).cast("int"))
    full = F.col("_source_size").cast("double") * most
    w = cut(numbered.withColumn("_weight", weight).drop("_turn").withColumn("_full", full).withColumn("_at", F.col("_full") / F.col("_weight")))
    weighed = w.agg(F.sum("_weight")).first()[0]
    w = running(w, n, [F.col("_at").asc(), F.col("_source").asc_nulls_last()], {"_filled": F.col("_full"), "_weighed": F.col("_weight")})
    w = cut(w.withColumn("_level", (F.lit(total * share) - F.col("_filled")) / (F.lit(weighed) - F.col("_weighed"))))
    # the first source that its level doesn't fill sets the level for all after it
    first = w.where(F.col("_level") < F.col("_at")).agg(F.min(F.struct("_at", "_level")).alias("x")).first().x
    target = F.col("_full") if first is None else F.when(F.col("_at") < first[0], F.col("_full")).otherwise(F.least(F.col("_full"), F.col("_weight") * F.lit(first[1])))
    return w.select("_source", "_source_size", "_n", target.alias("_target"))


def mix(docs: DataFrame, seed: str = "", share: float = SHARE, most: int = MOST, weights=WEIGHTS) -> DataFrame:
    """One row a row of docs (doc_id, source, size long and any more): these, source_size, target, taken.

    Each document gets a hash-random key; keys are sorted in ranges within each source, running sums of sizes are made
    from sums of ranges and sums inside a range, and each source is cut at its exact budget (its target, rounded): whole
    epochs first, then the order's beginning; only the document at the cut is taken in part. A hot source has as many
    more ranges. A range that one id fills, as its rows share a key, is split by hash of the row. Everything is a function
    of the rows, so reruns agree; of rows that share an id, and fill a range, it is one of the stored rows.

    Null source: a source of its own, last. Null id: hashed as an empty text. Repeated rows are rows of their own. Size
    0: taken 0. An empty table gives an empty table.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    extra = [c for c in docs.columns if c not in ("doc_id", "source", "size")]
    rest = F.struct(*(F.col(f"`{c}`") for c in extra)) if extra else F.lit(None).cast("string")
    rows = cut(docs.select(F.col("doc_id").alias("_id"), F.struct(F.col("source").alias("_source")).alias("_of"), F.col("size").alias("_size"), key.alias("_key"), rest.alias("_rest_of"), F.monotonically_increasing_id().alias("_row")))
    sizes = targets(rows.groupBy(F.col("_of._source").alias("_source")).agg(F.sum("_size").alias("_source_size"), F.count(F.lit(1)).alias("_n")), weights, share, most)
    budget = F.round("_target").cast("long")
    sizes = cut(
        sizes.select(F.struct("_source").alias("_of"), "_n", "_source_size", "_target", F.ceil(F.col("_n") / RANGE_ROWS).alias("_ranges"), budget.alias("_budget"))
        .withColumn("_epochs", F.when(F.col("_source_size") > 0, F.expr("_budget div _source_size")).otherwise(F.lit(0).cast("long")))
        .withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("_source_size"))
    )
    unit = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    found = lookup(rows, sizes, "_of", "_n", F.xxhash64("_key"))
    ranged = cut(found.select(*rows.columns, "_source_size", "_target", "_epochs", "_rest", F.struct("_of", F.floor(unit * F.col("_ranges")).alias("_range")).alias("_place")))
    # of ranges that an id fills only the HOT_KEYS largest need a split: no other holds more than 1/HOT_KEYS of the rows
    hot = ranged.groupBy("_place").agg(F.count(F.lit(1)).alias("_held")).where(F.col("_held") > 4 * RANGE_ROWS).orderBy(F.desc("_held"), "_place").limit(HOT_KEYS)
    hot = hot.select("_place", F.ceil(F.col("_held") / RANGE_ROWS).alias("_subs"))
    ranged = ranged.join(F.broadcast(hot), "_place", "left").withColumn("_sub", F.coalesce(F.pmod(F.xxhash64("_id", "_size", "_row"), F.col("_subs")), F.lit(0).cast("long")))
    sums = ranged.groupBy("_place", "_sub").agg(F.sum("_size").alias("_sum"))
    up_to = Window.partitionBy("_place._of").orderBy("_place._range", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("_place").alias("_p"), F.col("_sub").alias("_s"), F.coalesce(F.sum("_sum").over(up_to), F.lit(0).cast("long")).alias("_start"))
    inside = Window.partitionBy("_place", "_sub").orderBy("_key", "_id", "_size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    run = ranged.withColumn("_before", F.coalesce(F.sum("_size").over(inside), F.lit(0).cast("long")))
    placed = run.join(starts, (F.col("_place") == F.col("_p")) & (F.col("_sub") == F.col("_s")))
    part = F.least(F.col("_size"), F.greatest(F.lit(0).cast("long"), F.col("_rest") - F.col("_start") - F.col("_before")))
    return placed.select(F.col("_id").alias("doc_id"), *(F.col("_rest_of").getField(c).alias(c) for c in extra), F.col("_of._source").alias("source"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_epochs") * F.col("_size") + part).alias("taken"))


def remix(docs: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: the rows of docs (doc_id, text, source and any more), as often as `mix` takes them.

    A row that is taken in part (one a source at most) ends after so many words; n_chars follows where there is one.
    Rows that aren't taken, and those without words (null texts among them), go. Rows that repeat an id and its text are
    told apart by number. A null source is one like others. An empty table gives an empty table.
    """
    names = docs.columns
    version = F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("source"))
    each = Window.partitionBy("doc_id", "__mix_version").orderBy("__mix_version")  # equal rows of an id, one by one
    rows = docs.withColumn("__mix_version", version).withColumn("__mix_turn", F.row_number().over(each))
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), version.alias("__mix_version"))
    taken = mix(sizes, share=share, most=most).withColumn("__mix_turn", F.row_number().over(Window.partitionBy("doc_id", "__mix_version").orderBy(F.desc("taken"))))
    t = taken.where("taken > 0").select(F.col("doc_id").alias("__mix_id"), F.col("__mix_version").alias("__mix_v"), F.col("__mix_turn").alias("__mix_t"), F.col("size").alias("__mix_size"), F.col("taken").alias("__mix_taken"))
    joined = rows.join(t, F.col("doc_id").eqNullSafe(F.col("__mix_id")) & (F.col("__mix_version") == F.col("__mix_v")) & (F.col("__mix_turn") == F.col("__mix_t")))
    copies = joined.withColumn("__mix_left", F.explode(F.transform(F.sequence(F.lit(1), F.ceil(F.col("__mix_taken") / F.col("__mix_size")).cast("int")), lambda i: F.least(F.col("__mix_size"), F.col("__mix_taken") - (i - 1) * F.col("__mix_size")))))
    pieces = F.split(F.ltrim(F.col("text"), F.lit(SPACE)), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    text = F.when(F.col("__mix_left") == F.col("__mix_size"), F.col("text")).otherwise(F.rtrim(F.array_join(F.slice(pieces, F.lit(1), F.col("__mix_left").cast("int")), ""), F.lit(SPACE)))
    out = copies.withColumn("text", text)
    return (out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out).select(*names)


def op7_mixing(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH rows_ AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM rows_ GROUP BY source
), levels AS (
  SELECT source, source_size, weight, source_size::DOUBLE * 2 AS full_, source_size::DOUBLE * 2 / weight AS at_,
         ((sum(source_size) OVER ())::DOUBLE * 1.5
           - coalesce(sum(source_size::DOUBLE * 2) OVER (ORDER BY source_size::DOUBLE * 2 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY source_size::DOUBLE * 2 / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sizes
), first_ AS (
  SELECT min(at_) AS at_, arg_min(level, at_) AS level FROM levels WHERE level < at_
), targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN f.at_ IS NULL OR l.at_ < f.at_ THEN l.full_ ELSE least(l.full_, l.weight * f.level) END AS target
  FROM levels l, first_ f
), placed AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.k, r.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows_ r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
         + least(size, greatest(0, budget - (budget // source_size) * source_size - before)) END AS BIGINT) AS taken
FROM placed
"""

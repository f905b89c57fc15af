"""Cumulative budgets in a given order: what doesn't fit is skipped and uses nothing up."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.plans.lineage import cut


def within_count(df: DataFrame, order: list[str], most: int, out: str = "kept") -> DataFrame:
    """out: whether a row is among the first `most` in order. A top-k tells the last row that fits; no global window."""
    last = df.select(*order).orderBy(*order).limit(most).agg(F.max(F.struct(*order)).alias("last")).first().last
    if last is None:
        return df.withColumn(out, F.lit(False))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    border = F.struct(*(F.lit(last[c]).cast(kinds[c]).alias(c) for c in order))
    return df.withColumn(out, F.coalesce(F.struct(*order) <= border, F.lit(False)))


#: Rows of a range that `greedy` settles at once.
RANGE_ROWS = 500_000


def _fold(left: int):
    """Rows that fit, of rows in order; what is left goes from batch to batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = left
        for b in batches:
            sizes, kept = b.column("s").to_numpy(), []
            for i in np.flatnonzero(sizes <= room).tolist():  # what doesn't fit now never will
                if sizes[i] <= room:
                    room -= int(sizes[i])
                    kept.append(i)
            yield b.take(pa.array(kept, pa.int64()))

    return run


def greedy(df: DataFrame, order: list[str], size: str, budget: int, out: str = "kept") -> DataFrame:
    """out: whether a row fits in what the budget has left when its turn comes.

    Where everything fits (one aggregate tells), nothing else is to be done. Otherwise rows lie in sorted ranges, and one
    number, what is left, goes from range to range: a range fits as a whole, or its least size is too large, and then its
    sum and minimum settle it; only other ranges are folded, each in its order where it lies. Every fold leaves less, so
    few ranges need one. Null sizes fit nothing.
    """
    total, n = df.agg(F.sum(size), F.count(F.lit(1))).first()
    if (total or 0) <= budget:
        return df.withColumn(out, F.col(size).isNotNull())
    keys = [F.col(c) for c in order]
    narrow = df.where(F.col(size) <= budget).select(F.struct(*keys).alias("k"), F.col(size).cast("bigint").alias("s"))
    dealt = cut(narrow.repartitionByRange(max(1, -(-n // RANGE_ROWS)), "k").withColumn("p", F.spark_partition_id()))
    left, whole, folds = budget, [], []
    for r in sorted(dealt.groupBy("p").agg(F.sum("s").alias("sum"), F.min("s").alias("least")).collect()):
        if r["sum"] <= left:
            whole.append(r.p)
            left -= r["sum"]
        elif r.least <= left:
            mine = dealt.where(F.col("p") == r.p).select("k", "s").repartition(1).sortWithinPartitions("k")
            folds.append(cut(mine.mapInArrow(_fold(left), mine.schema)))
            left -= folds[-1].agg(F.sum("s")).first()[0] or 0
    fits = dealt.where(F.col("p").isin(*whole)).select("k") if whole else dealt.where(F.lit(False)).select("k")
    for f in folds:
        fits = fits.union(f.select("k"))
    return _attach(df, order, fits.withColumn("_fits", F.lit(True)), out)


def _attach(df: DataFrame, order: list[str], fits: DataFrame, out: str) -> DataFrame:
    on: Column | None = None
    for c in order:
        e = F.col(c).eqNullSafe(F.col(f"_k.{c}"))
        on = e if on is None else on & e
    return df.join(fits.withColumnRenamed("k", "_k"), on, "left").withColumn(out, F.coalesce("_fits", F.lit(False))).drop("_k", "_fits")

"""Connected components of a table of links, however long a node's list of neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import cut, lookup


#: Links that one task contracts, on average.
TASK_LINKS = 250_000


def forest(a: np.ndarray, b: np.ndarray) -> dict[int, int]:
    """Node -> smallest node that these links reach."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's links as stars around its components' smallest nodes."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        got = [(x, r) for x, r in forest(*(np.concatenate(c) for c in zip(*held, strict=True))).items() if x != r]
        cols = list(zip(*got, strict=True)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64())], names=["a", "b"])


def _stars(links: DataFrame) -> DataFrame:
    """A round of large stars and one of small stars. A star's centre may have any number of neighbours, so it is looked up."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = cut(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree")))
    large = cut(lookup(both, least, "u", "degree", F.xxhash64("v")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
    least = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree")))
    small = lookup(large, least, "u", "degree", F.xxhash64("v"))
    pairs = small.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
    return cut(pairs.where(F.col("a") != F.col("b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> (node, component): the smallest node that can be reached; nodes without links are left out.

    Tasks of TASK_LINKS links each contract theirs to stars; where there are several tasks, large and small stars in turn
    bring the stars together, and so on until all nodes are linked to their component's smallest. Each round's links are
    materialised.
    """
    links, before = cut(links.select("a", "b")), None
    while True:
        tasks = max(1, -(-links.count() // TASK_LINKS))
        links = cut(links.repartition(tasks).mapInArrow(_contract, "a long, b long"))
        if tasks == 1:
            break
        links = _stars(links)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select(F.col("b"), F.col("b")).distinct())

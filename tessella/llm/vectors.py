"""Nearest vectors: an exact pivot-distance index and an approximate permutation index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import cut

TOP, QUERY_EVERY = 20, 20
#: Vectors in a block, and queries that meet a block in one task, on average.
BLOCK_ROWS, QUERY_ROWS = 4096, 8192
#: Numbers of the sampled vectors (pivots, calibration) that are held at once, whatever their length.
SAMPLED_NUMBERS = 1 << 22


def usable(embeddings: DataFrame, zero: bool, query: Column | None, floor: float | None = None) -> DataFrame:
    """(row, vec_id, v array<double>, q): the rows that take part, each with a number of its own, and whether they are queries.

    Null ids, null vectors and those holding null or non-finite components are left out, and zero vectors unless `zero`.
    With `floor`, components become floor(floor * x). Materialised, so that row numbers stay.
    """
    chosen = F.coalesce(F.col("vec_id") % QUERY_EVERY == 0 if query is None else query, F.lit(False))
    finite = F.forall(F.col("v"), lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), chosen.alias("q"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
    if not zero:
        rows = rows.where(F.exists(F.col("v"), lambda x: x != 0))
    if floor is not None:  # doubles of 2^53 and more are whole
        rows = rows.withColumn("v", F.transform("v", lambda x: F.when(F.abs(x * floor) < 2.0**53, F.floor(x * floor).cast("double")).otherwise(x * floor)))
    return cut(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", "q"))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Lists as rows of doubles; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim))
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths]) if len(lengths) else []] = flat
    return out


def sampled(rows: DataFrame, n: int, dim: int, seed: int, distinct: bool = True) -> np.ndarray:
    """The n vectors of the smallest hashes (each once, if distinct): a bounded sample."""
    n = max(16, min(n, SAMPLED_NUMBERS // max(1, dim)))
    got = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "row").limit(2 * n if distinct else n).select("v").collect()
    out = np.zeros((len(got), dim))
    for i, r in enumerate(got):
        out[i, : len(r.v)] = r.v
    if distinct and len(out):
        out = out[np.sort(np.unique(out, axis=0, return_index=True)[1])]
    return out[:n]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


FOUND = (("asker", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))
FOUND_SCHEMA = "asker long, query_id long, vec_id long, score double"


def _table(parts: list[list[np.ndarray]]) -> pa.Table:
    return pa.table({name: pa.array(np.concatenate([p[i] for p in parts]) if parts else [], kind) for i, (name, kind) in enumerate(FOUND)})


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ranked(found: DataFrame, k: int, score: Column) -> DataFrame:
    return _top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))


def _dealt(data: DataFrame, asks: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both with columns sub and part, so that no group of (key, sub, part) holds many more rows of either than BLOCK_ROWS and
    QUERY_ROWS: hot keys are split on both sides by how many rows they hold. Keys without queries go nowhere."""
    asked = asks.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("parts"))
    sizes = cut(data.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("subs")).join(asked, key))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    hashed = lambda n: F.pmod(F.xxhash64("row", F.lit(n)), F.col(n)).cast("int")
    sizes = F.broadcast(sizes)  # a row a file or annulus, of which there is a bounded number
    data = data.join(sizes, key).withColumn("sub", hashed("subs")).withColumn("part", upto("parts")).drop("subs", "parts")
    asks = asks.join(sizes, key).withColumn("sub", upto("subs")).withColumn("part", hashed("parts")).drop("subs", "parts")
    return data, asks.select(*(F.col(c).alias(c) for c in asks.columns))  # columns of its own, even where both come from one table


#: Pivots, at least and at most (a sixteenth of the root of the number of vectors between), and annuli at most.
N_PIVOTS, MOST_ANNULI = (16, 1024), 1 << 17
#: Annuli that a query visits in its first round, and how many times more in each that follows.
FIRST_ANNULI, MORE_ANNULI = 1, 16


def exact_top(embeddings: DataFrame, k: int = TOP, scale: float = 64.0, query: Column | None = None, n_pivots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score long): each query's k largest inner products of floor(scale * x), exactly.

    Pivot-distance index: a coordinate more gives all vectors the same length, so that the largest inner product is the
    smallest distance, and each vector is keyed by its nearest pivot and its distance to it. A pivot's vectors lie in
    annuli of about BLOCK_ROWS, as many as they need. A query's annuli are sorted by the least distance that the triangle
    inequality leaves; it visits them in rounds, each with MORE_ANNULI times as many, and stops at the first one whose
    bound is beyond the k-th score found so far. Annuli of equal distances may hold any number of rows and are split by
    hash, as are the queries that visit one. Scores below 2^53 are exact.

    Unusable vectors take no part; rows that repeat an id are rows of their own (as queries, too); shorter vectors end in
    zeros; ties go to the smaller vec_id; fewer than k candidates are all returned; vectors of any length are whole rows;
    other columns are passed over; an empty table gives an empty table.
    """
    rows = usable(embeddings, True, query, scale)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, most, dim = rows.agg(F.count(F.lit(1)), F.max(norm), F.max(F.size("v"))).first()
    if not n:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    wanted = n_pivots or int(min(N_PIVOTS[1], max(N_PIVOTS[0], math.sqrt(n) / 16)))
    centres = sampled(rows, wanted, dim, 0)
    rest = np.sqrt(np.maximum(0, most - (centres**2).sum(1)))

    def away(v: np.ndarray, filled: bool) -> np.ndarray:
        """Distances to the pivots, in the lengthened space; filled: the last coordinate makes up the length."""
        inner, own = v @ centres.T, (v**2).sum(1)
        if filled:
            inner += np.sqrt(np.maximum(0, most - own))[:, None] * rest
            own = np.full(len(v), most)
        return np.nan_to_num(np.sqrt(np.maximum(0, own[:, None] + most - 2 * inner)), nan=0.0, posinf=0.0)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = matrix(b.column("v"), dim)
            d = away(v, True)
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec_id"), b.column("v"), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], names=["row", "vec_id", "v", "cell", "far"])

    index = cut(rows.select("row", "vec_id", "v").mapInArrow(keyed, "row long, vec_id long, v array<double>, cell int, far double"))
    in_ring = max(BLOCK_ROWS, n // MOST_ANNULI)
    counts = {r.cell: r.n for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps = min(1024, -(-max(counts.values()) // in_ring))
    quantiles = {r.cell: r.at for r in index.groupBy("cell").agg(F.percentile_approx("far", [i / steps for i in range(1, steps)] or [1.0], 10 * steps + 100).alias("at")).collect()}
    edges = {}
    for c, size in counts.items():
        rings = min(steps, -(-size // in_ring))
        edges[c] = np.unique([quantiles[c][min(steps - 1, round(i * steps / rings)) - 1] for i in range(1, rings)])

    def ringed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, far = b.column("cell").to_numpy(), b.column("far").to_numpy()
            ring = np.zeros(len(cell), np.int32)
            for c in np.unique(cell).tolist():
                ring[cell == c] = np.searchsorted(edges[c], far[cell == c], "left")
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(cell.astype(np.int64) << 32 | ring), b.column("far")], names=["row", "vec_id", "v", "annulus", "far"])

    index = index.mapInArrow(ringed, "row long, vec_id long, v array<double>, annulus long, far double")
    reach = sorted(index.groupBy("annulus").agg(F.min("far").alias("low"), F.max("far").alias("high")).collect())
    names, low, high = (np.array([r[i] for r in reach]) for i in range(3))
    of = (names >> 32).astype(int)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = away(matrix(b.column("v"), dim), False)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x.tobytes() for x in d], pa.binary())], names=["row", "vec_id", "v", "away"])

    # distances are computed once, so that every round sorts a query's annuli alike
    queries = cut(rows.where("q").select("row", "vec_id", "v").mapInArrow(measured, "row long, vec_id long, v array<double>, away binary"))

    def expand(begin: int, end: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v, least = matrix(b.column("v"), dim), b.column("least").to_numpy(zero_copy_only=False)
                # room for rounding: a distance is the root of a difference of numbers of the size of `most`
                radius = np.nan_to_num(np.sqrt(np.maximum(0, (v**2).sum(1) + most - 2 * least)) * (1 + 1e-9) + 1e-6 * (1 + np.sqrt(most)), nan=np.inf)
                out = []
                for i, d in enumerate(b.column("away").to_pylist()):
                    d = np.frombuffer(d)[of]
                    bound = np.maximum(0, np.maximum(low - d, d - high))
                    at = np.argsort(bound, kind="stable")[begin:end]
                    at = at[bound[at] <= radius[i]]
                    out.append((np.full(len(at), i), names[at]))
                which = np.concatenate([x for x, _ in out]) if out else np.zeros(0, int)
                places = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("row").take(places), b.column("vec_id").take(places), b.column("v").take(places), b.column("least").take(places), pa.array(np.concatenate([x for _, x in out]) if out else [], pa.int64())], names=["row", "query_id", "v", "least", "annulus"])

        return run

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, own, parts = left["vec_id"].to_numpy(), left["row"].to_numpy(), []
        if len(ids) and right.num_rows:
            v, qv = matrix(left["v"], dim), matrix(right["v"], dim)
            asker, asked, least = right["row"].to_numpy(), right["query_id"].to_numpy(), right["least"].to_numpy()
            for at in np.array_split(np.arange(len(asker)), len(asker) // 512 + 1):
                s = qv[at] @ v.T
                s[(own[None] == asker[at][:, None]) | (s < least[at][:, None])] = -np.inf
                for i, row in zip(at, s, strict=True):
                    left_in = np.flatnonzero(row > -np.inf)
                    top = left_in[best(ids[left_in], row[left_in], k)]
                    parts.append([np.full(len(top), asker[i]), np.full(len(top), asked[i]), ids[top], row[top]])
        return _table(parts)

    found, begin, size = None, 0, FIRST_ANNULI
    while begin < len(names):
        state = queries.withColumn("least", F.lit(float("-inf")))
        if found is not None:
            kth = found.groupBy("asker").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
            state = queries.join(kth, queries["row"] == kth["asker"], "left").select("row", "vec_id", "v", "away", F.when(F.col("n") >= k, F.col("kth")).otherwise(float("-inf")).alias("least"))
        asks = cut(state.mapInArrow(expand(begin, begin + size), "row long, query_id long, v array<double>, least double, annulus long"))
        if found is not None and asks.isEmpty():
            break
        data, asks = _dealt(index.drop("far"), asks, "annulus")
        keys = ["annulus", "sub", "part"]
        new = data.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(search, FOUND_SCHEMA)
        found = cut(_top(new if found is None else found.union(new), k).drop("rank"))
        begin, size = begin + size, size * MORE_ANNULI
    return _ranked(found, k, F.col("score").cast("long"))


#: Pivots: the root of the number of vectors, between these; the share of them that a vector's order lists; the files that
#: hold a vector; the files that a query reads, for 256 pivots (more by the power 2/3).
PERM_PIVOTS, PERM_SHARE, POSTED, READ = (256, 4096), 0.5, 2, 96
#: Share of 20 000 vectors that is reranked (less by the fourth root for more), and vectors that the bound is measured on.
RERANK, RERANK_AT, CALIBRATION = 0.04, 20_000, 2048


def permutation_top(embeddings: DataFrame, k: int = TOP, query: Column | None = None, n_pivots: int | None = None, rerank: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score double): each query's k nearest found, by inner product, approximately.

    Permutation index: a vector is the order of its nearest pivots (a bounded sample of the vectors), and lies in the
    inverted files of the POSTED first of them; every vector is indexed. A query looks up the files of its own first
    pivots, READ of 256 and a smaller share of more, so the rows that it examines grow slower than the table. There the
    footrule distance of the orders ranks (a pivot that an order lacks counts as its length), each vector in the first
    file that has it. Those within the distance that the share `rerank` of a bounded sample of all vectors keeps are
    reranked by inner product in double precision. Hot files are split, as are the queries that read one. A query with
    fewer than k found is answered from all rows.

    Zero and unusable vectors take no part; rows that repeat an id are rows of their own (as queries, too); shorter vectors
    end in zeros; ties go to the smaller vec_id; fewer than k candidates are all returned; vectors of any length are
    whole rows; other columns are passed over; an empty table gives an empty table.
    """
    rows = usable(embeddings, False, query)
    n, n_queries, dim = rows.agg(F.count(F.lit(1)), F.count_if("q"), F.max(F.size("v"))).first()
    if not n:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    centres = sampled(rows, n_pivots or int(min(PERM_PIVOTS[1], max(PERM_PIVOTS[0], math.sqrt(n)))), dim, 0)
    length = max(min(len(centres), 8), int(PERM_SHARE * len(centres)))
    reads = min(len(centres), math.ceil(READ * (len(centres) / 256) ** (2 / 3)))
    posts = min(POSTED, length)
    share = rerank if rerank is not None else RERANK * (RERANK_AT / n) ** 0.25
    room = np.uint8 if length < 256 else np.uint16

    def orders(v: np.ndarray) -> np.ndarray:
        return np.argsort(-(v @ centres.T), axis=1, kind="stable").astype(np.uint16)

    def places(order: np.ndarray) -> np.ndarray:
        """pivots x vectors: `length` less the pivot's place in the vector's order, 0 where it isn't listed."""
        out = np.zeros((len(centres), len(order)), room)
        out[order.ravel(), np.repeat(np.arange(len(order)), order.shape[1])] = np.tile(np.arange(order.shape[1], 0, -1), len(order))
        return out

    left_over = np.arange(length, 0, -1).astype(room)[:, None]

    def near(listed: np.ndarray, order: np.ndarray) -> np.ndarray:
        """(length * (length + 1) - footrule distance) / 2 of one order to all vectors."""
        return np.minimum(listed[order], left_over).sum(0, dtype=np.uint32)

    calibration = places(orders(sampled(rows, CALIBRATION, dim, 1, distinct=False))[:, :length])
    kept = max(1, min(calibration.shape[1], math.ceil(share * calibration.shape[1])))

    def filed(files: int, ask: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                order = orders(matrix(b.column("v"), dim))
                i = pa.array(np.repeat(np.arange(len(order)), files))
                listed = pa.array([x.tobytes() for x in order[:, : max(length, files)]], pa.binary())
                out = [*(c.take(i) for c in b.columns), listed.take(i), pa.array(order[:, :files].ravel().astype(np.int32))]
                if ask:
                    least = [-np.partition(-near(calibration, o).astype(np.int64), kept - 1)[kept - 1] for o in order[:, :length]]
                    out.append(pa.array(np.array(least, np.int64)).take(i))
                yield pa.RecordBatch.from_arrays(out, names=["row", "vec_id", "v", "listed", "file", "least"][: len(out)])

        return run

    kind = "row long, vec_id long, v array<double>, listed binary, file int"
    data = rows.select("row", "vec_id", "v").mapInArrow(filed(posts, False), kind)
    asks = rows.where("q").select("row", "vec_id", "v").mapInArrow(filed(reads, True), f"{kind}, least long")

    def hits(parts: list[list[np.ndarray]]) -> pa.Table:
        """A row for each query and file, with what is found there."""
        ends = np.cumsum([0, *(len(p[2]) for p in parts)])
        flat = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in (2, 3)]
        inner = pa.StructArray.from_arrays([pa.array(-flat[1], pa.float64()), pa.array(flat[0].astype(np.int64), pa.int64())], ["less", "vec_id"])
        return pa.table({"asker": pa.array([p[0] for p in parts], pa.int64()), "query_id": pa.array([p[1] for p in parts], pa.int64()), "hits": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner)})

    def listed_in(column: pa.ChunkedArray) -> np.ndarray:
        return np.stack([np.frombuffer(x, np.uint16) for x in column.to_pylist()])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            file, ids, own, v = left["file"][0].as_py(), left["vec_id"].to_numpy(), left["row"].to_numpy(), matrix(left["v"], dim)
            of_data, of_queries = listed_in(left["listed"]), listed_in(right["listed"])
            listed, posted, turn = places(of_data[:, :length]), of_data[:, :posts], np.empty(len(centres), np.int64)
            asker, asked, least, qv = right["row"].to_numpy(), right["vec_id"].to_numpy(), right["least"].to_numpy(), matrix(right["v"], dim)
            for i in range(len(asker)):
                turn[:] = reads
                turn[of_queries[i, :reads]] = np.arange(reads)
                first = turn[posted].min(1) == turn[file]  # in no file that this query reads sooner
                at = np.flatnonzero(first & (own != asker[i]) & (near(listed, of_queries[i, :length]) >= least[i]))
                s = v[at] @ qv[i]
                top = best(ids[at], s, k)
                parts.append([asker[i], asked[i], ids[at][top], s[top]])
        return hits(parts)

    data, asks = _dealt(data, asks, "file")
    keys = ["file", "sub", "part"]
    by_file = data.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(search, "asker long, query_id long, hits array<struct<less:double,vec_id:long>>")
    top = F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k)  # by score, then id; at most k for each file that a query reads
    found = by_file.groupBy("asker").agg(F.max("query_id").alias("query_id"), top.alias("hits")).select("asker", "query_id", F.explode("hits").alias("hit"))
    found = cut(found.select("asker", "query_id", "hit.vec_id", (-F.col("hit.less")).alias("score")))
    enough = min(k, n - 1)
    full = found.groupBy("asker").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= enough)
    short = cut(rows.where("q").join(full, F.col("row") == F.col("asker"), "left_anti").select("row", "vec_id", "v"))
    if short.isEmpty():
        return _ranked(found, k, F.col("score"))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, own, parts = left["vec_id"].to_numpy(), left["row"].to_numpy(), []
        if len(ids) and right.num_rows:
            v = matrix(left["v"], dim)
            for asker, asked, x in zip(right["row"].to_pylist(), right["vec_id"].to_pylist(), matrix(right["v"], dim), strict=True):
                s = np.where(own == asker, -np.inf, v @ x)
                top = best(ids, s, k)
                top = top[s[top] > -np.inf]
                parts.append([np.full(len(top), asker), np.full(len(top), asked), ids[top], s[top]])
        return _table(parts)

    # blocks of all rows, as files that each of these queries reads
    blocks = -(-n // BLOCK_ROWS)
    all_rows = rows.select("row", "vec_id", "v", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("file"))
    data, asks = _dealt(all_rows, short.withColumn("file", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), "file")
    more = data.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(scan, FOUND_SCHEMA)
    return _ranked(found.join(short.select(F.col("row").alias("asker")), "asker", "left_anti").union(more), k, F.col("score"))


OP8_SQL = """
WITH ok AS (
  SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.place, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.place <> c.place WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

"""N-gram Jaccard join: all texts whose sets of word shingles are similar, through prefix trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import cut, lookup
from tessella.llm.links import components

#: Words of a shingle; the threshold as a fraction.
WIDTH, SIMILAR = 5, (75, 100)
#: Shingles that a task gathers on average, and that a worker holds before it sends them on.
BUCKET_TOKENS, HELD_TOKENS = 1_000_000, 1_000_000
#: A shingle is frequent if it is in more than one of so many texts and in that many of those a worker holds.
RARE, LEAST_SEEN = 1024, 8
#: Sets of a block of a trie, at least and at most on average, and the shingles that such a block holds on average at most.
LEAST_SETS, TRIE_SETS, TRIE_TOKENS = 256, 2048, 1_000_000
#: Links that one copy of a centre's set is compared for; centres that a round adds to a group, and sets of the groups it is for.
CENTRE_LINKS, PIVOTS, ROUND_SETS = 4096, 3, 128
#: A round has to connect this share of the sets that were left apart, or it was the last.
ROUND_GAIN = 0.2
LOW = np.uint64((1 << 48) - 1)


def need(n):
    """Shared shingles that a set of n needs with any similar set, at least."""
    return -(-SIMILAR[0] * n // SIMILAR[1])


def similar(both, n, m):
    return SIMILAR[1] * both >= SIMILAR[0] * (n + m - both)


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of the words between [\\x20\\x09-\\x0D], A-Z lowered."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only, in both
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(WIDTH, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out ^= h[i : i + n]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def set_hash(tokens: np.ndarray) -> tuple[int, int]:
    """A set's key, and as many bits again that tell sets of one key apart."""
    from xxhash import xxh3_128_intdigest

    h = xxh3_128_intdigest(tokens.tobytes())
    return h >> 65, h & ((1 << 63) - 1)


def _texts(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        for doc, text in zip(b.column(0), b.column(1), strict=True):
            yield doc.as_py(), shingles(text.as_py())


PRINTS = "doc_id long, key long, check long, n long, frequent boolean"


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text its set's hash and size; for the texts at hand the shingles that are frequent among them."""
    rows, tokens, seen, held = [], [], set(), 0

    def flush():
        nonlocal rows, tokens, seen, held
        if tokens:
            t, n = np.unique(np.concatenate(tokens), return_counts=True)
            often = n >= max(LEAST_SEEN, len(seen) // RARE)
            rows += [(None, int(x), None, int(c), True) for x, c in zip(t[often].view(np.int64), n[often], strict=True)]
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        rows, tokens, seen, held = [], [], set(), 0
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "key", "check", "n", "frequent"])

    for doc, t in _texts(batches):
        key, check = set_hash(t) if len(t) else (None, None)
        rows.append((doc, key, check, len(t), False))
        if len(t) and key not in seen:
            seen.add(key)
            tokens.append(t)
            held += len(t)
            if held >= HELD_TOKENS:
                yield flush()
    yield flush()


def pack48(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


POSTED = "bucket int, owners binary, owner binary, low binary"
SHARED = "bucket int, part int, owners binary, counts binary, low binary, df binary"


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return (tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def whole(low: np.ndarray, bucket: np.ndarray | int, buckets: int) -> np.ndarray:
    """A shingle's id from 48 bits and its bucket, which follows from the upper ones: up to 2^16 buckets, no two are mixed up."""
    return low | (np.uint64(bucket) * np.uint64(65536) // np.uint64(buckets)) << np.uint64(48)


def _poster(buckets: int, frequent: np.ndarray, renamed: dict[tuple[int, int], int]):
    """Shingles go to their buckets; frequent ones, which would all meet in one, straight to the sets that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, owners, seen = [], [], set()

        def flush():
            rows = []
            ids, own = np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.uint32), [len(h) for h in held])
            keys = np.array(owners, np.uint64)
            often = frequent[np.minimum(np.searchsorted(frequent, ids), len(frequent) - 1)] == ids if len(frequent) else np.zeros(len(ids), bool)
            bucket = bucket_of(ids, buckets)
            for chosen, place, wide in ((~often, bucket, False), (often, np.uint64(buckets) + keys[own] % np.uint64(buckets), True)):
                i, o, p = ids[chosen], own[chosen], place[chosen].astype(np.int32)
                if wide:
                    i = whole(i & LOW, bucket[chosen], buckets)
                order = np.argsort(p, kind="stable")
                i, o, p = i[order], o[order], p[order]
                cuts = np.flatnonzero(np.diff(p)) + 1
                for x, y, where in zip(np.split(i, cuts), np.split(o, cuts), p[np.concatenate([[0], cuts]).astype(int)] if len(p) else [], strict=False):
                    there, inverse = np.unique(y, return_inverse=True)
                    rows.append((int(where), keys[there].tobytes(), inverse.astype("<u4" if len(there) > 65535 else "<u2").tobytes(), x.astype("<u8").tobytes() if wide else pack48(x & LOW)))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            held.clear(), owners.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["bucket", "owners", "owner", "low"])

        size = 0
        for _, t in _texts(batches):
            if not len(t):
                continue
            key, check = set_hash(t)
            if (key := renamed.get((key, check), key)) in seen:
                continue
            seen.add(key)
            held.append(t)
            owners.append(key)
            size += len(t)
            if size >= HELD_TOKENS:
                yield flush()
                size = 0
                if len(seen) > 1_000_000:
                    seen.clear()
        if held:
            yield flush()

    return run


def _open(table: pa.Table, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Owner of each posting, and its whole id or 48 bits of it."""
    own, low = [], []
    for keys, which, ids in zip(table["owners"].to_pylist(), table["owner"].to_pylist(), table["low"].to_pylist(), strict=True):
        keys = np.frombuffer(keys, np.uint64)
        own.append(keys[np.frombuffer(which, "<u4" if len(keys) > 65535 else "<u2")])
        low.append(np.frombuffer(ids, "<u8") if wide else unpack48(ids))
    return np.concatenate(own), np.concatenate(low)


def _sharer(buckets: int, parts: int):
    """Of a bucket's shingles those that several sets have go to these sets, with their number."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        wide = bucket >= buckets
        own, low = _open(table, wide)
        order = np.argsort(low, kind="stable")
        own, low = own[order], low[order]
        if not wide:
            same = low[1:] == low[:-1]
            several = np.append(same, False) | np.insert(same, 0, False)
            own, low = own[several], low[several]
        order = np.lexsort((own, low))  # copies of a set that different workers posted
        own, low = own[order], low[order]
        first = np.ones(len(own), bool)
        first[1:] = (own[1:] != own[:-1]) | (low[1:] != low[:-1])
        own, low = own[first], low[first]
        starts = np.flatnonzero(np.insert(low[1:] != low[:-1], 0, True)) if len(low) else np.zeros(0, int)
        n = np.diff(np.append(starts, len(low)))
        df = np.full(len(low), 65535, np.uint16) if wide else np.minimum(np.repeat(n, n), 65534).astype(np.uint16)
        keep = df >= 2
        own, low, df = own[keep], low[keep], df[keep]
        part = (own % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((own, part))
        own, low, df, part = own[order], low[order], df[order], part[order]
        rows = []
        cuts = np.flatnonzero(np.diff(part)) + 1
        for o, i, d, p in zip(np.split(own, cuts), np.split(low, cuts), np.split(df, cuts), np.split(part, cuts), strict=True):
            if len(o):
                keys, counts = np.unique(o, return_counts=True)
                rows.append((-1 if wide else bucket, int(p[0]), keys.tobytes(), counts.astype("<u4").tobytes(), i.astype("<u8").tobytes() if wide else pack48(i), d.tobytes()))
        cols = list(zip(*rows, strict=True)) or [[]] * 6
        return pa.table({"bucket": pa.array(cols[0], pa.int32()), "part": pa.array(cols[1], pa.int32()), **{c: pa.array(x, pa.binary()) for c, x in zip(("owners", "counts", "low", "df"), cols[2:], strict=True)}})

    return run


SETS = "key long, n long, entry int, tokens binary"


def _assembler(buckets: int):
    """Sets, as their shared shingles in the global order (rarest first), of those that share enough to be similar to any.

    Shingles of one set only come before all others in the order and are in no intersection, so their number suffices.
    `entry` shingles are in the set's prefix: similar sets have one of these in common.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            own, ids, df = [], [], []
            for bucket, keys, counts, low, d in zip(*(left[c].to_pylist() for c in ("bucket", "owners", "counts", "low", "df")), strict=True):
                own.append(np.repeat(np.frombuffer(keys, np.uint64), np.frombuffer(counts, "<u4")))
                ids.append(np.frombuffer(low, "<u8") if bucket < 0 else whole(unpack48(low), bucket, buckets))
                df.append(np.frombuffer(d, np.uint16))
            own, ids, df = np.concatenate(own), np.concatenate(ids), np.concatenate(df)
            order = np.lexsort((ids, df, own))
            own, ids = own[order], ids[order]
            keys, sizes = right["key"].to_numpy().astype(np.uint64), right["n"].to_numpy()
            at = np.argsort(keys)
            keys, sizes = keys[at], sizes[at]
            starts = np.flatnonzero(np.insert(own[1:] != own[:-1], 0, True))
            shared = np.diff(np.append(starts, len(own)))
            n = sizes[np.searchsorted(keys, own[starts])]
            for i in np.flatnonzero(shared >= need(n)).tolist():
                s = int(shared[i])
                rows.append((int(own[starts[i]]), int(n[i]), s - int(need(n[i])) + 1, ids[starts[i] : starts[i] + s].tobytes()))
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.table({"key": pa.array(cols[0], pa.int64()), "n": pa.array(cols[1], pa.int64()), "entry": pa.array(cols[2], pa.int32()), "tokens": pa.array(cols[3], pa.binary())})

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tokens = [np.frombuffer(t, np.uint64)[:k] for t, k in zip(b.column("tokens").to_pylist(), b.column("entry").to_pylist(), strict=True)]
        ids = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(np.repeat(b.column("key").to_numpy(), [len(t) for t in tokens]))], names=["token", "key"])


class Trie:
    """Sets in the global order; a node holds the run of shingles that its sets share, and bounds on what is below."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.sets, self.sizes = sets, sizes
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        top: list = []
        todo = [(order, 0, top)]  # a stack of its own: tries of nested sets are as deep as there are sets
        while todo:
            members, depth, siblings = todo.pop()
            first, last = sets[members[0]], sets[members[-1]]
            n = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:n] != last[depth:n])
            end = depth + int(differ[0]) if len(differ) else n
            here, children, group = [i for i in members if len(sets[i]) == end], [], []
            for i in members[len(here) :]:  # the shortest come first
                if group and sets[i][end] != sets[group[0]][end]:
                    todo.append((group, end, children))
                    group = []
                group.append(i)
            if group:
                todo.append((group, end, children))
            of = sizes[members]
            siblings.append((first[depth:end], here, children, int(of.min()), int(of.max()), max(len(sets[i]) for i in members) - end, min(members), len(members)))
        self.root = top[0]

    def links(self, linked) -> None:
        """For each set x, calls linked(x, y, True) on the similar sets y < x, unless linked(x, y, False) says they are one."""
        mark = np.zeros(1 + max((int(s.max()) for s in self.sets if len(s)), default=0), np.uint8)
        for x in range(1, len(self.sets)):
            own, n = self.sets[x], int(self.sizes[x])
            mark[own] = 1
            todo = [(self.root, 0)]
            while todo:
                (run, here, children, low, high, rest, least, members), both = todo.pop()
                if n * SIMILAR[0] > high * SIMILAR[1] or low * SIMILAR[0] > n * SIMILAR[1] or least >= x:
                    continue
                if members == 1 and linked(x, least, False):
                    continue
                if len(run):
                    both += int(mark[run].sum())
                    left = min(rest, len(own) - int(np.searchsorted(own, run[-1], "right")))
                else:
                    left = min(rest, len(own))
                if not similar(both + left, n, low):
                    continue
                for y in here:
                    if y < x and similar(both, n, int(self.sizes[y])):
                        linked(x, y, True)
                todo += [(c, both) for c in children]
            mark[own] = 0


def _join(table: pa.Table) -> pa.Table:
    """Links that connect the similar sets of a group's two blocks (or one)."""
    keys, sizes, block = table["key"].to_numpy(), table["n"].to_numpy(), table["block"].to_numpy()
    order = np.lexsort((keys, block))
    keys, sizes, block = keys[order], sizes[order], block[order]
    raw = [np.frombuffer(t, np.uint64) for t in table["tokens"].to_pylist()]
    # places in the global order stand in for shingles, which the sets list in this order
    rank = _ranks([raw[i] for i in order])
    # sets that are known to be connected start as one
    known, first, place = np.unique(table["known"].to_numpy()[order], return_index=True, return_inverse=True)
    parent = [int(first[p]) for p in place]

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    found = []

    def linked(x: int, y: int, link: bool) -> bool:
        a, b = root(x), root(y)
        if a != b and link:
            parent[max(a, b)] = min(a, b)
            found.append((int(keys[x]), int(keys[y])))
        return a == b

    if len(keys) > 1:
        Trie(rank, sizes).links(linked)
    cols = list(zip(*found, strict=True)) or [[], []]
    return pa.table({"a": pa.array(cols[0], pa.int64()), "b": pa.array(cols[1], pa.int64())})


def _ranks(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Small numbers for shingles, the same for the same shingle, ascending within each set.

    Any order will do inside a group as long as all its sets use it: rarest in the group first.
    """
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.empty(len(counts), np.int64)
    place[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    return [np.sort(p) for p in np.split(place[inverse], cuts)]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = [similar(len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)), n, m) for x, y, n, m in zip(*(b.column(c).to_pylist() for c in ("tokens", "_tokens", "n", "_n")), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _similar_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar. The set of b, a centre, is copied once for every CENTRE_LINKS."""
    degrees = cut(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("degree")).withColumn("copies", F.ceil(F.col("degree") / CENTRE_LINKS).cast("int")))
    dealt = lookup(pairs, degrees, "b", "degree", F.xxhash64("a")).withColumn("copy", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int")).select("a", "b", "copy")
    centres = sets.join(degrees, sets["key"] == degrees["b"]).select("b", F.col("n").alias("_n"), F.col("tokens").alias("_tokens"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    both = dealt.join(sets.select(F.col("key").alias("a"), "n", "tokens"), "a").join(centres, ["b", "copy"]).select("a", "b", "n", "tokens", "_n", "_tokens")
    return cut(both.mapInArrow(_verified, "a long, b long"))


def _parts(groups: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, n, component, part) and (component, part, sets, shingles): what the links connect inside a group of candidates."""
    merged = components(links).withColumnRenamed("component", "part")
    rows = cut(groups.join(merged, "node", "left").withColumn("part", F.coalesce("part", "node")))
    return rows, cut(rows.groupBy("component", "part").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles")))


def _connected(groups: DataFrame, links: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All links found, and `_parts` by them, after rounds in which every set outside its group's largest part is compared
    with PIVOTS sets of that part.

    Random edits of one text make copies of which each is similar to some others only, so one centre leaves many apart; a
    few more leave hardly any, at a cost in proportion to the sets apart. Rounds end when they gain little.
    """
    before, turn = None, 0
    while True:
        rows, parts = _parts(groups, links)
        main = parts.groupBy("component").agg(F.max_by("part", F.struct("sets", "part")).alias("main"), F.sum("sets").alias("members"), F.count(F.lit(1)).alias("parts"))
        main = cut(main.where((F.col("parts") > 1) & (F.col("members") > ROUND_SETS)).drop("parts"))
        apart = parts.join(main, "component").where("part <> main").agg(F.sum("sets")).first()[0] or 0
        if not apart or (before is not None and apart > (1 - ROUND_GAIN) * before):
            return links, rows, parts
        placed = cut(lookup(rows.select("node", "component", "part"), main, "component", "members", F.xxhash64("node")).where("main IS NOT NULL"))
        hashed = F.xxhash64("node", F.lit(turn))
        chosen = placed.where("part = main").groupBy("component", F.pmod(hashed, F.lit(PIVOTS)).alias("slot")).agg(F.min_by("node", hashed).alias("pivot"), F.max("members").alias("members"))
        pivots = cut(chosen.groupBy("component").agg(F.collect_list("pivot").alias("pivots"), F.max("members").alias("weight")))
        near = lookup(placed.where("part <> main").select(F.col("node").alias("a"), "component"), pivots, "component", "weight", F.xxhash64("a"))
        links = cut(links.union(_similar_pairs(cut(near.select("a", F.explode("pivots").alias("b"))), sets)))
        before, turn = apart, turn + 1


def _groups(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, known, component, one, two, block): where each set is to be compared.

    Of a group of candidates that is connected already nothing is left to do. Otherwise the sets of large connected parts
    lie in blocks of their own, the rest in mixed ones; all pairs of blocks meet but those inside a part. Blocks are the
    smaller, the fewer sets are mixed, as that deals a group to more tasks and copies a set no more often than its group
    has mixed blocks; they are bounded by sets and by shingles.
    """
    large = F.col("sets") > LEAST_SETS
    mixed = parts.groupBy("component").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("sets").alias("members"),
        F.coalesce(F.sum(F.when(~large, F.col("sets"))), F.lit(0)).alias("few"), F.coalesce(F.sum(F.when(~large, F.col("shingles"))), F.lit(0)).alias("of_few"),
    ).where("parts > 1")
    width = F.least(F.lit(TRIE_SETS), F.greatest(F.lit(LEAST_SETS), F.col("few") / 8))
    blocks = lambda n, tokens, w: F.greatest(F.ceil(n / w), F.ceil(tokens / TRIE_TOKENS)).cast("int")
    mixed = cut(mixed.select("component", "members", blocks(F.col("few"), F.col("of_few"), width).alias("mixed"), width.alias("width")))
    sized = cut(parts.join(mixed, "component").select("component", "part", "sets", "members", "mixed", F.when(large, blocks(F.col("sets"), F.col("shingles"), F.col("width"))).otherwise(0).alias("blocks")))
    of_group = cut(sized.groupBy("component").agg(F.max("members").alias("members"), F.max("mixed").alias("mixed"), F.collect_list(F.when(F.col("blocks") > 0, F.struct("part", "blocks"))).alias("larges")))
    placed = lookup(lookup(rows, sized.select("part", "sets", "blocks"), "part", "sets", F.xxhash64("node")).where("blocks IS NOT NULL"), of_group, "component", "members", F.xxhash64("node"))
    hashed = F.xxhash64("node")
    own = F.when(F.col("blocks") > 0, F.struct(F.col("part").alias("of"), F.pmod(hashed, F.col("blocks")).cast("int").alias("block"))).otherwise(F.struct(F.lit(-1).cast("long").alias("of"), F.pmod(hashed, F.col("mixed")).cast("int").alias("block")))
    placed = placed.withColumn("own", own)
    struct = "array<struct<of:bigint,block:int>>"
    upto = lambda n, of: F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct(of.alias("of"), i.alias("block")))).otherwise(F.array().cast(struct))
    others = F.flatten(F.transform(F.filter("larges", lambda x: x["part"] != F.col("own.of")), lambda x: upto(x["blocks"], x["part"])))
    met = placed.withColumn("other", F.explode(F.concat(upto(F.col("mixed"), F.lit(-1).cast("long")), others)))
    return met.select(F.col("node").alias("key"), F.col("part").alias("known"), "component", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), F.col("own.block").alias("block"))


def _renamed(of_docs: DataFrame, classes: DataFrame) -> dict[tuple[int, int], int]:
    """(key, check) -> another key, for sets that share their key with a set of a smaller check. At 10^10 sets some five are
    to be expected, so they may be listed."""
    twice = classes.where("low <> high").select("key", "low")
    if twice.isEmpty():
        return {}
    found = of_docs.where("n > 0").join(twice, "key").where("check <> low").select("key", "check").distinct().collect()
    return {(r.key, r.check): r.check for r in found}


def _classes(of_docs: DataFrame) -> DataFrame:
    least = (F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.min("check").alias("low"), F.max("check").alias("high"))
    return cut(of_docs.where("n > 0").groupBy("key").agg(*least))


def join(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text): doc_id, n_shingles, component_id, copies (documents of the same set).

    Documents link when their sets of 5-word shingles are similar; component_id is the smallest doc_id that links reach.
    Equal sets become one class first. Shingles are counted over all classes; a class keeps those that others have too
    and goes on only if they are enough for a similar class to exist. In the order of these counts, similar classes share
    a shingle of their prefixes, which brings candidates together as stars, not pairs. Each set is compared with one
    centre first, then, in larger groups, with a few sets of the group's largest connected part, which connects nearly all
    copies; groups that this leaves in several parts are joined in prefix trees: overlaps are summed along shared paths,
    and a branch is left as soon as what remains can't make up the threshold. Only links that connect are kept. Larger
    groups are joined block by block (blocks are bounded by sets and by shingles), but for blocks of sets that are
    connected already.

    Text with fewer than five words is one shingle; without words it is an empty set, linked with nothing, its own
    component. Null id: its rows take part; a component of null ids only has a null id. Rows that repeat an id are rows of
    their own. An empty table gives an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = cut(rows.mapInArrow(_prints, PRINTS))
    of_docs = prints.where(~F.col("frequent"))
    classes = _classes(of_docs)
    if renamed := _renamed(of_docs, classes):
        table = docs.sparkSession.createDataFrame([(*k, v) for k, v in renamed.items()], "key long, check long, _other long")
        of_docs = of_docs.join(F.broadcast(table), ["key", "check"], "left").withColumn("key", F.coalesce("_other", "key")).drop("_other")
        classes = _classes(of_docs)
    n_classes, total = classes.agg(F.count(F.lit(1)), F.sum("n")).first()
    buckets, parts = max(1, -(-(total or 0) // BUCKET_TOKENS)), max(1, -(-(total or 0) // (8 * BUCKET_TOKENS)), -(-n_classes // 32768))
    # at most RARE times a text's mean number of shingles
    often = prints.where("frequent").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= max(LEAST_SEEN, n_classes / RARE)).select("key").collect()
    frequent = np.unique(np.array([r.key for r in often], np.int64).view(np.uint64))
    posted = rows.mapInArrow(_poster(buckets, frequent, renamed), POSTED)
    shared = posted.groupBy("bucket").applyInArrow(_sharer(buckets, parts), SHARED)
    sized = classes.select("key", "n", F.pmod("key", F.lit(parts)).cast("int").alias("part"))
    sets = cut(shared.groupBy("part").cogroup(sized.groupBy("part")).applyInArrow(_assembler(buckets), SETS))

    entries = cut(sets.mapInArrow(_entries, "token long, key long"))
    stars = cut(entries.groupBy("token").agg(F.min("key").alias("centre"), F.count(F.lit(1)).alias("several")).where("several > 1"))
    near = cut(lookup(entries, stars, "token", "several", F.xxhash64("key")).where(F.col("centre") != F.col("key")).select(F.col("key").alias("a"), F.col("centre").alias("b")).distinct())
    groups = cut(components(near).join(sets.select(F.col("key").alias("node"), "n"), "node"))
    to_centres, in_parts, parts_of = _connected(groups, _similar_pairs(cut(near.groupBy("a").agg(F.min("b").alias("b"))), sets), sets)
    pairs = _groups(in_parts, parts_of)
    groups_of_sets = sets.join(pairs, "key").select("key", "n", "tokens", "component", "one", "two", "block", "known")
    links = groups_of_sets.groupBy("component", "one", "two").applyInArrow(_join, "a long, b long")
    joined = components(links.union(to_centres))

    with_component = classes.join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    ids = cut(with_component.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size")))
    of_class = cut(lookup(with_component, ids, "component", "size", F.xxhash64("key")).select("key", "copies", "component_id"))
    out = lookup(of_docs, of_class, "key", "copies", F.xxhash64("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, without those that `join` puts in a component with a smaller id.

    A row without words stays. Of equal rows of one id one stays; rows of an id with other texts are judged by their id.
    """
    kept = cut(join(docs.select("doc_id", "text")).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("__join_kept")).agg(F.count(F.lit(1)).alias("__join_rows")))
    out = docs.join(kept.select("__join_kept"), F.col("doc_id").eqNullSafe(F.col("__join_kept")), "left_semi")
    if kept.where("__join_rows > 1").isEmpty():
        return out
    names = docs.columns
    return out.withColumn("__join_text", F.xxhash64("text")).dropDuplicates(["doc_id", "__join_text"]).select(*names)


def op10_jaccard_join(docs: DataFrame) -> DataFrame:
    return join(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")

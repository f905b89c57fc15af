"""Language identification: multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import cut, lookup
from tessella.llm.toxicity import fold

FOLDS, HELD_OUT, UNKNOWN = 4, 2, "und"
#: Character n-grams of one to three letters of words with their borders, hashed to so many features.
FEATURE_BITS = 15
FEATURES = 1 << FEATURE_BITS
#: Rows that the classifier is fitted on, at most: so many of each language first, then those of the smallest hashes; every
#: how manyth sets the temperature; features that these rows may hold together.
TRAIN_ROWS, OF_EACH_LANG, CALIBRATE_EVERY, TRAIN_FEATURES = 3000, 50, 5, 10_000_000
#: How many times the rows to choose are looked at for it: evenly spread hashes give fewer than chosen once in 10^30.
SPARE = 4
#: Follow-the-regularised-leader: learning rate, its smoothing, the elastic net's two penalties, passes.
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 1e-4, 1e-4, 3
#: Term frequencies are shares of a text's n-grams, times this.
SCALE = 100.0
WORD = re.compile(r"[^\W\d_]+")
#: Words that are turned into features at once.
AT_ONCE = 50_000


def letters(text: str) -> list[str]:
    """Runs of letters. The pattern's runs may hold numbers like `½` and `Ⅷ`, at which they are parted."""
    words = WORD.findall(text)
    if all(map(str.isalpha, words)):
        return words
    return [w for run in words for w in "".join(c if c.isalpha() else " " for c in run).split(" ") if w]


def grams(text: str | None) -> Iterator[np.ndarray]:
    """The features of all n-grams of the text's words, with repeats; a word is what stands between borders `^` and `$`."""
    words = letters((text or "").lower())
    for i in range(0, len(words), AT_ONCE):
        c = np.frombuffer(("^" + "$^".join(words[i : i + AT_ONCE]) + "$").encode("utf-32-le"), np.uint32)
        inside = c != ord("$")  # what begins with or crosses an end is no n-gram of a word
        two, h = inside[:-1], c * np.uint32(0x9E3779B1)
        parts = [h]
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + c[1:] * np.uint32(0xC2B2AE3D)
        parts.append(h[two])
        h = (h[:-1] ^ (h[:-1] >> np.uint32(13))) * np.uint32(0x27D4EB2F) + c[2:] * np.uint32(0x165667B1)
        parts.append(h[two[:-1] & two[1:]])
        h = np.concatenate(parts)
        yield (h ^ (h >> np.uint32(16))) * np.uint32(0x7FEB352D) >> np.uint32(32 - FEATURE_BITS)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each feature."""
    held, total = np.zeros(FEATURES, bool), np.zeros(FEATURES, np.int64)
    for b in batches:
        for t in b.column(0):
            for g in grams(t.as_py()):
                held[g] = True
            total += held
            held[:] = False
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["feature", "docs"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, share = [], []
        for t in b.column("text"):
            n = sum((np.bincount(g, minlength=FEATURES) for g in grams(t.as_py())), np.zeros(FEATURES, np.int64))
            i = np.flatnonzero(n)
            at.append(i.astype(np.int32).tobytes())
            share.append((SCALE * n[i] / max(1, n.sum())).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("order"), pa.array(at, pa.binary()), pa.array(share, pa.binary())], names=["lang", "order", "at", "share"])


class Leader:
    """FTRL-proximal for K classes: weights follow from running sums, and are zero where the sums don't pass L1."""

    def __init__(self, k: int, features: int = FEATURES):
        self.z, self.n = np.zeros((features + 1, k)), np.zeros((features + 1, k))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        w[np.abs(z) <= L1] = 0
        return w

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[y] -= 1
        g = x[:, None] * p[None]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """That of the least log loss, by golden section over its logarithm."""
    # the second term keeps it finite where all answers are right
    loss = lambda t: -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean() + 1e-3 * t * t
    a, b, r = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(rows: list, idf: np.ndarray) -> tuple[list[str], np.ndarray, float]:
    """rows (lang, at, share) -> languages, weights (the last row is the bias), temperature."""
    langs = sorted({r.lang for r in rows})
    of = {c: i for i, c in enumerate(langs)}
    data = []
    for r in rows:
        at = np.frombuffer(r.at, np.int32)
        data.append((np.append(at, FEATURES), np.append(np.frombuffer(r.share, np.float32) * idf[at], 1.0), of[r.lang]))
    held = data[::CALIBRATE_EVERY] if len(data) >= 10 * CALIBRATE_EVERY else data
    used = [d for i, d in enumerate(data) if i % CALIBRATE_EVERY] if len(data) >= 10 * CALIBRATE_EVERY else data
    leader, order = Leader(len(langs)), np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(used)):
            leader.learn(*used[i])
    w = leader.weights(np.arange(FEATURES + 1))
    return langs, w, temperature(np.array([x @ w[at] for at, x, _ in held]), np.array([y for *_, y in held]))


def inverse_frequencies(learn: DataFrame) -> np.ndarray:
    """Of all documents of learn (text), for each feature: log((1 + documents) / (1 + documents that have it)) + 1."""
    df = np.zeros(FEATURES)
    for r in learn.select("text").mapInArrow(_frequencies, "feature int, docs long").groupBy("feature").agg(F.sum("docs").alias("docs")).collect():
        df[r.feature] = r.docs
    return np.log((1 + max(1, learn.count())) / (1 + df)) + 1


def sample(learn: DataFrame, train_rows: int = TRAIN_ROWS, train_features: int = TRAIN_FEATURES) -> list:
    """At most `train_rows` different rows (lang, at, share) of learn (doc_id, text, lang), with at most `train_features`
    features together (but one row at least): OF_EACH_LANG of each language first, then those of the smallest hashes."""
    version = F.xxhash64("text")
    keys = cut(learn.select("doc_id", "lang", version.alias("_version")).distinct().withColumn("_key", F.xxhash64("doc_id", "lang", "_version")))
    # hashes are spread evenly, so those of a language's (or of all) first rows lie below a bound that its number of rows gives
    counts = cut(keys.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")))
    share = F.col("_key").cast("double") / 2.0**64 + 0.5
    total = counts.agg(F.sum("_n")).first()[0] or 0
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("_key", "doc_id", "_version"))
    low = lookup(keys, counts, "lang", "_n", F.col("_key")).where(share * F.col("_n") < SPARE * OF_EACH_LANG)
    first = low.withColumn("_turn", turn).where(F.col("_turn") <= OF_EACH_LANG).select("_turn", "_key", "doc_id", "lang", "_version").orderBy("_turn", "_key", "doc_id", "lang", "_version").limit(train_rows)
    of_all = keys.where(share * total < SPARE * train_rows)
    more = of_all.select(F.lit(OF_EACH_LANG + 1).alias("_turn"), "_key", "doc_id", "lang", "_version").orderBy("_key", "doc_id", "lang", "_version").limit(train_rows)
    each = first.union(more).groupBy("doc_id", "lang", "_version").agg(F.min("_turn").alias("_turn"), F.min("_key").alias("_key"))
    chosen = each.orderBy("_turn", "_key", "doc_id", "lang", "_version").limit(train_rows).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("_version").alias("_of"), F.struct("_turn", "_key").alias("order"))
    on = learn["doc_id"].eqNullSafe(F.col("_id")) & (learn["lang"] == F.col("_lang")) & (version == F.col("_of"))
    rows = learn.join(F.broadcast(chosen), on).select("lang", "order", "text").dropDuplicates(["lang", "order", "text"])
    vectors = cut(rows.mapInArrow(_vectors, "lang string, order struct<_turn:int,_key:long>, at binary, share binary"))
    sizes = sorted((tuple(r.order), r.n) for r in vectors.select("order", (F.length("at") / 4).cast("long").alias("n")).collect())
    held, last = 0, None
    for order, n in sizes:
        if last is not None and held + n > train_features:
            break
        held, last = held + n, order
    if last is None:
        return []
    taken = vectors.where((F.col("order._turn") < last[0]) | ((F.col("order._turn") == last[0]) & (F.col("order._key") <= last[1]))).collect()
    return sorted(taken, key=lambda r: (zlib.crc32(r.at), r.lang, tuple(r.order)))


def identify(docs: DataFrame, held_out: int = HELD_OUT, folds: int = FOLDS, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """docs (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Document frequencies are counted over all documents of the learning folds that have a lang; the classifier is fitted
    on a bounded `sample` of them, in which every language has its rows, and its temperature on a fifth of these; every
    whole text is then scored (its logits are the mean of its n-grams').

    Null text or text without a letter: `und` with score 0, which is also the answer when there is nothing to learn from.
    Null id: hashed as an empty text. Repeated rows are learned from once and answered as often as they occur. Texts of any
    length are read in pieces. Of languages equally likely the first by code point counts. An empty table gives an empty
    table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), (fold(F.col("doc_id"), folds) == held_out).alias("held_out"))
    learn = rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    got = sample(learn.select("doc_id", "text", "lang"), train_rows)
    idf = inverse_frequencies(learn)
    langs, w, t = fit(got, idf) if got else ([], np.zeros((FEATURES + 1, 0)), 1.0)
    per_gram, bias = SCALE * w[:-1] * idf[:, None] / t, w[-1] / t

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score = [], []
            for text in b.column("text"):
                total, n = np.zeros(len(langs)), 0
                for g in grams(text.as_py()) if langs else ():
                    total, n = total + per_gram[g].sum(0), n + len(g)
                p = softmax(total / n + bias) if n else None
                pred.append(UNKNOWN if p is None else langs[int(p.argmax())])
                score.append(0.0 if p is None else float(p.max()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def op6_language_id(docs: DataFrame) -> DataFrame:
    return identify(docs.select("doc_id", "text", "lang"))

"""Toxicity: a learned lexicon, met through Levenshtein automata, weighed by context windows."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import cut

#: Labelled rows that the lexicon and the calibration are learned from, at most (those of the smallest hashes).
TRAIN_ROWS = 20_000
#: Words whose weight a worker remembers: how many, and up to which length. More only costs time.
REMEMBERED, REMEMBERED_LETTERS = 150_000, 64
#: Contexts (different words before its first place in a row) in toxic rows that make a word a term: a number, and a share of the toxic rows.
LEAST_CONTEXTS, LEAST_SHARE, LEAST_WEIGHT = 6, 0.01, 3.0
#: A beginning that so many terms share, and that clean rows lack, stands for words with other endings.
STEM_LETTERS, STEM_TERMS = (4, 8), 5
#: Letters that signs stand for; the folds.
SIGNS = str.maketrans("013457@$!", "oieastasi")
FOLDS = 5
TOKEN = re.compile(r"[^\W_](?:[\w@$!*'’]*[^\W_])?")
REPEATS = re.compile(r"(.)\1{2,}")
#: Quoting marks, and words near a term that tell a report from an address.
OPEN_CLOSE = (("“", "”"), ("«", "»"), ("„", "“"), ("‹", "›"))
REPORTS = frozenset("said says wrote quote quoted quotes quoting called term word words phrase citation zitat cita mot wort palabra".split())
ADDRESS = frozenset("you your youre u ur du dein dich tu te toi vous votre eres tú usted".split())
QUOTED, REPORTED, ADDRESSED, PER_EDIT, STEMMED = 0.1, 0.5, 1.5, 0.7, 0.8


def plain_form(word: str) -> str:
    return REPEATS.sub(r"\1", word.translate(SIGNS).replace("'", "").replace("’", ""))


def edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """All terms' Levenshtein automata (transposed neighbours count as one edit) intersected with the terms' trie.

    A state is a set of (trie node, edits used, letter owed by a transposition); sets are made as words need them and
    remembered, so a word costs a look-up a letter and most words fail after a few.
    """

    def __init__(self, terms: dict[str, float]):
        self.next: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.room = [0]
        for t in terms:
            node = 0
            self.room[0] = max(self.room[0], edits(t))
            for c in t:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.term.append(None)
                    self.room.append(0)
                node = self.next[node][c]
                self.room[node] = max(self.room[node], edits(t))
            self.term[node] = t
        self.start = self._close({(0, 0, "")})
        self.moves: dict[tuple[frozenset, str], frozenset] = {}

    def _close(self, states: set) -> frozenset:
        """With the letters of terms that the word may lack; of what costs more for the same, the cheapest only."""
        todo, least = list(states), {}
        while todo:
            node, used, owed = todo.pop()
            if used > self.room[node] or least.get((node, owed), 9) <= used:
                continue
            least[node, owed] = used
            if not owed:
                todo += [(n, used + 1, "") for n in self.next[node].values()]
        return frozenset((n, u, o) for (n, o), u in least.items())

    def _move(self, states: frozenset, c: str) -> frozenset:
        out = set()
        for node, used, owed in states:
            if owed:
                if owed == c:
                    out.add((node, used, ""))
                continue
            out.add((node, used + 1, ""))
            for d, n in self.next[node].items():
                out.add((n, used + (d != c), ""))
                if d != c and c in self.next[n]:
                    out.add((self.next[n][c], used + 1, d))
        return self._close(out)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its edits, and how many."""
        states = self.start
        for c in word:
            key = (states, c)
            got = self.moves.get(key)
            if got is None:
                if len(self.moves) > 50_000:
                    self.moves.clear()
                got = self.moves[key] = self._move(states, c)
            states = got
            if not states:
                return None
        found = [(u, self.term[n]) for n, u, o in states if not o and self.term[n] is not None and u <= edits(self.term[n])]
        return min(found)[::-1] if found else None


class Lexicon:
    """Weights of words: terms, beginnings that stand for them, and misspellings that clean rows don't know as words.

    Every term is in the automaton. What is only near it counts the less, the more its neighbourhood is used in clean rows.
    """

    def __init__(self, terms: dict[str, float], stems: dict[str, float] | None = None, plain: frozenset = frozenset(), shares: dict[str, float] | None = None):
        """plain: clean words that are near a term; shares: of the contexts of a term and its plain words, the term's part, where it isn't 1."""
        self.terms, self.stems, self.plain, self.shares, self.known = terms, stems or {}, plain, shares or {}, {}
        self.automaton = Automaton(terms)

    def __getstate__(self):
        return self.terms, self.stems, self.plain, self.shares

    def __setstate__(self, state):
        self.__init__(*state)

    def weight(self, word: str) -> float:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            got = self._weight(word)
            if len(word) <= REMEMBERED_LETTERS:
                self.known[word] = got
        return got

    def _weight(self, word: str) -> float:
        if word in self.terms:
            return self.terms[word]
        if word in self.plain or not self.terms:
            return 0.0
        plain = plain_form(word)
        if plain in self.terms:
            return PER_EDIT * self.terms[plain]
        for n in range(STEM_LETTERS[0], min(STEM_LETTERS[1], len(plain) - 1) + 1) if self.stems else ():
            if plain[:n] in self.stems:
                return STEMMED * self.stems[plain[:n]]
        if plain in self.plain or (found := self.automaton.match(plain)) is None:
            return 0.0
        return self.terms[found[0]] * PER_EDIT ** found[1] * self.shares.get(found[0], 1.0)

    def features(self, text: str) -> tuple[float, float]:
        """Sum and maximum of the weights of the text's words, each times its context's factor."""
        low = text.lower()
        words = TOKEN.findall(low)
        weight = self.weight
        hits = {w for w in set(words) if weight(w) > 0}
        if not hits:
            return 0.0, 0.0
        total = most = 0.0
        end = 0
        for i, w in enumerate(words):
            start = low.find(w, end)  # between words no letter stands
            end = start + len(w)
            if w in hits:
                x = weight(w) * self.context(low, start, end, words, i)
                total, most = total + x, max(most, x)
        return total, most

    def context(self, low: str, start: int, end: int, words: list[str], i: int) -> float:
        """Factor for a term at low[start:end], the i-th word: quoted, reported, addressed to someone, or plain."""
        before, after = low[max(0, start - 80) : start].rpartition("\n")[2], low[end : end + 80].partition("\n")[0]
        if any(before.rfind(a) > before.rfind(b) and b in after for a, b in OPEN_CLOSE) or (before.count('"') % 2 and '"' in after):
            return QUOTED
        if not REPORTS.isdisjoint(words[max(0, i - 4) : i]):
            return REPORTED
        return ADDRESSED if not ADDRESS.isdisjoint(words[max(0, i - 4) : i + 3]) else 1.0


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text (null: empty), modulo n."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in (batch.slice(i, 250) for i in range(0, batch.num_rows, 250)):  # few at once: there is a row for each word
            seen = set()
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                words = TOKEN.findall((text or "").lower())
                first = dict(zip(reversed(words), reversed(["", *words[:-1]]), strict=True))
                seen.update((w, p, toxic) for w, p in first.items())
            cols = list(zip(*seen, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32())], names=["word", "before", "toxic"])


def learn_lexicon(train: DataFrame) -> Lexicon:
    """train (text, toxic 0/1, bounded). A word counts once a row, by the word before its first place, so copies count once."""
    n1, n0 = (int(x or 0) for x in train.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    pairs = train.mapInArrow(_contexts, "word string, before string, toxic int").groupBy("word", "before").agg(F.max("toxic").alias("bad"), F.min("toxic").alias("good"))
    words = cut(pairs.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("good")).alias("good")))

    def weight(bad, good):
        return F.log((bad + 0.5) / (n1 + 1)) - F.log((good + 0.5) / (n0 + 1))

    least = max(LEAST_CONTEXTS, math.ceil(LEAST_SHARE * n1))
    ranked = words.withColumn("w", weight(F.col("bad"), F.col("good"))).where((F.col("bad") >= least) & (F.col("w") >= LEAST_WEIGHT) & (F.length("word") >= 3))
    chosen = sorted(ranked.collect(), key=lambda r: r.word)  # each takes a share of the contexts of a bounded number of rows
    terms, toxic_contexts = {r.word: r.w for r in chosen}, {r.word: r.bad for r in chosen}
    lengths = F.sequence(F.lit(STEM_LETTERS[0]), F.least(F.lit(STEM_LETTERS[1]), F.length("word") - 1))
    ends = words.where(F.length("word") > STEM_LETTERS[0]).select("bad", "good", F.explode(F.transform(lengths, lambda n: F.substring(F.col("word"), F.lit(1), n))).alias("stem"))
    of_terms = {t[:n] for t in terms for n in range(STEM_LETTERS[0], STEM_LETTERS[1] + 1) if len(t) > n}
    stems: dict[str, float] = {}
    if of_terms:
        sums = ends.where(F.col("stem").isin(*of_terms)).groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("n"))
        got = sums.where((F.col("n") >= STEM_TERMS) & (F.col("bad") >= least) & (F.col("good") <= 0.02 * F.col("bad"))).withColumn("w", weight(F.col("bad"), F.col("good"))).collect()
        top = max(terms.values())
        for r in sorted(got, key=lambda r: len(r.stem)):
            # the longest beginning that still has nearly all of them
            longest = max((x for x in got if x.stem.startswith(r.stem) and x.bad >= 0.9 * r.bad), key=lambda x: len(x.stem))
            if not any(r.stem.startswith(s) or s.startswith(r.stem) for s in stems):
                stems[longest.stem] = min(longest.w, top)
    lexicon = Lexicon(terms, stems)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, good = b.column("word").to_pylist(), b.column("good").to_pylist()
            found = [(x, m[0], n) for x, n in zip(words, good, strict=True) if x not in terms and lexicon.weight(x) > 0 and (m := lexicon.automaton.match(plain_form(x)))]
            cols = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["word", "term", "good"])

    clean = words.where((F.col("good") > 0) & (weight(F.col("bad"), F.col("good")) < LEAST_WEIGHT)).select("word", F.col("good").cast("long").alias("good"))
    met = clean.mapInArrow(near, "word string, term string, good long").groupBy("term").agg(F.collect_set("word").alias("words"), F.sum("good").alias("good")).collect()
    shares = {r.term: toxic_contexts[r.term] / (toxic_contexts[r.term] + r.good) for r in met}
    return Lexicon(terms, stems, frozenset(w for r in met for w in r.words), shares)


def _scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The columns of docs but text, then total and most."""
    rest = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text") + ", total double, most double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [lexicon.features(t.as_py() or "") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array([x[0] for x in got], pa.float64()), pa.array([x[1] for x in got], pa.float64())], names=[*rest, "total", "most"])

    return docs.mapInArrow(run, schema)


def calibrate(total: np.ndarray, most: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Logistic regression on log(1 + total) and the maximum, by Newton's method."""
    x = np.stack([np.ones_like(total), np.log1p(total), most], axis=1)
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - toxic) + ridge * w * (0, 1, 1)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, ridge, ridge])
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    w[1:] = np.maximum(w[1:], 0)
    return w


def sample(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic): at most `train_rows` labelled documents of the learning folds, those of the smallest hashes; rows that
    repeat an id and its text count once.

    Null labels and labels without a document are passed over; of several labels of an id the largest counts.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = marks.where(fold(F.col("_id"), FOLDS) != 0).orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = cut(rows.join(F.broadcast(chosen), rows["doc_id"] == chosen["_id"]).select("doc_id", "text", "toxic").dropDuplicates(["doc_id", "text"]))
    # ids that repeat with other texts don't add to the bound
    keyed = found.withColumn("key", F.xxhash64("doc_id", "text"))
    last = keyed.select("key").orderBy("key").limit(train_rows).agg(F.max("key")).first()[0]
    return keyed.where(F.lit(last is not None) & (F.col("key") <= (last or 0))).select("text", "toxic")


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[Lexicon, np.ndarray | None]:
    """Lexicon and calibration from a `sample`. Without labels of both kinds there is no calibration."""
    train = sample(docs, labels, train_rows)
    lexicon = learn_lexicon(train)
    got = _scored(train, lexicon).collect()  # three numbers for each row of the sample
    toxic = np.array([r.toxic for r in got], float)
    known = 0 < toxic.sum() < len(toxic)
    return lexicon, calibrate(np.array([r.total for r in got], float), np.array([r.most for r in got], float), toxic) if known else None


def probability(w: np.ndarray | None, total, most):
    if w is None:
        return 0.0 * total
    return 1 / (1 + np.exp(-np.clip(w[0] + w[1] * np.log1p(total) + w[2] * most, -700, 700)))


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """docs (doc_id, text) and labels (doc_id, toxic): doc_id, held_out, score, predicted.

    Words that toxic rows use in many contexts and clean ones don't become weighted terms; all whole texts are then
    scored through the automaton of the terms.

    Words of any length count, in whole texts of any length; a letter that is repeated counts once. Of terms equally near
    to a word the first by code point counts. Null or empty text: no term, the score of such a text. Null id: hashed as an empty text, without a label. Without
    labels of both kinds every score is 0. Repeated rows are scored as often as they occur. An empty table gives an
    empty table.
    """
    lexicon, w = learn(docs, labels, train_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([lexicon.features(t.as_py() or "") for t in b.column("text")], float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(probability(w, got[:, 0], got[:, 1]))], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose score is below the threshold; see `score`.

    Null and empty texts stay where such a text's score is below the threshold, as it is where most rows are clean;
    repeated rows are judged alike; without labels of both kinds all rows stay; an empty table gives an empty table.
    """
    lexicon, w = learn(docs, labels)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([lexicon.features(t.as_py() or "") for t in b.column(place)], float).reshape(-1, 2)
            yield b.filter(pa.array(probability(w, got[:, 0], got[:, 1]) < threshold))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))

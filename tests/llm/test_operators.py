"""Each operator against plain versions, and on tables with nulls, ties, repetitions, nothing, and names of its own."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import jaccard, language, licenses, line_dedup, mixing, packing, pii, toxicity, vectors
from tessella.llm.links import components
from tessella.llm.packing import Encoder, default_tokenizer, sum_of_squares

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
LONG = "word " * 30_000 + "end"
ROWS = [
    (1, None, None, None, None, None),
    (2, "", "en", "a", 0, "x"),
    (3, "A shared line of at least twenty signs.\nown text", "en", "a", 1, None),
    (4, " a SHARED line of at least twenty signs.\t\nown text", "en", "b", 1, None),
    (5, "a shared line of at least twenty signs.", "de", "b", 1, None),
    (5, "a shared line of at least twenty signs.", "de", "b", 1, None),
    (6, LONG, "en", "a", 1, None),
    (None, "one two three four five six", "fr", None, 1, None),
    (7, "one two three four five six", "fr", "c", 1, None),
    (8, "   \n\t", "fr", "c", 1, None),
    (9, "é😀 x@y.zz +1 (269) 555-3296", None, "c", 1, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return [r.asDict() for r in df.collect()]


# 1
def plain_dedup(data):
    lines = [(i, t or "") for i, t in data]
    key = lambda x: x.strip(brute.SPACE).translate({c: c + 32 for c in range(65, 91)})
    holders: dict = {}
    for i, t in lines:
        for x in t.split("\n"):
            holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in lines:
        kept = [x for x in t.split("\n") if len(key(x)) < 20 or len(holders[key(x)]) < 3 or i == max(h for h in holders[key(x)] if h is not None)]
        out.append((i, len(t.split("\n")), len(t.split("\n")) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_line_dedup(docs, empty):
    got = Counter(tuple(r) for r in line_dedup.op1_line_dedup(docs).collect())
    assert got == plain_dedup([(r[0], r[1]) for r in ROWS])
    assert line_dedup.op1_line_dedup(empty).collect() == []
    clash = docs.withColumn("n_lines", F.lit("mine")).withColumn("_pos", F.lit(1))
    out = line_dedup.without_shared_lines(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    assert {r["_pos"] for r in rows(line_dedup.dedup_lines(clash))} == {1}


# 2
def test_pii_base(docs, empty):
    got = sorted(((r["doc_id"], r["base_sha256"]) for r in rows(pii.op2_pii(docs))), key=str)
    assert got == sorted(((r[0], brute.base_sha256(r[1])) for r in ROWS), key=str)
    assert pii.op2_pii(empty).collect() == []


def test_pii_random_texts(spark):
    r = random.Random(3)
    data = [(i, "".join(r.choice(["1", "2", "3", ".", "-", " ", "+", "@", "a", "b.", "4111 1111 1111 1111", "(", "255", "é", "\n"]) for _ in range(60))) for i in range(400)]
    data += [(1000, "a" * 40_000 + "@"), (1001, "1" * 40_000), (1002, "1 2-" * 20_000), (1003, "a@b." * 5000), (1004, "1." * 3000)]
    got = {x["doc_id"]: x for x in rows(pii.op2_pii(spark.createDataFrame(data, "doc_id long, text string")))}
    for i, t in data:
        assert got[i]["base_sha256"] == brute.base_sha256(t), t[:80]
        assert [got[i][f"n_{k}"] for k in brute.PATTERNS] == [sum(s.startswith(k) for s in brute.base_spans(t)) for k in brute.PATTERNS]


def test_pii_adds_secrets(spark):
    data = [(i, f"hello x{i}@mail{i}.example.com and 10.0.0.{i} or +1 (269) 555-32{i:02d}") for i in range(60)]
    data += [(100 + i, f"he wrote password=ab12cd34ef{i} there 12 34") for i in range(40)] + [(200, "12 34 and 5 6"), (201, "clean text")]
    got = {x["doc_id"]: x["spans"] for x in rows(pii.op2_pii(spark.createDataFrame(data, "doc_id long, text string")))}
    assert got[101] == "secret:9:29" and got[200] == got[201] == ""
    assert got[7].count(",") == 2


def test_pii_adds_other_kinds(spark):
    """Every added kind is found where its context speaks for it; plain words and numbers aren't."""
    r = random.Random(7)
    hexed = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do".split()
    data, want = [], {}
    for i in range(240):
        before, after = " ".join(r.choices(words, k=6)), " ".join(r.choices(words, k=6))
        kind, span = [
            ("secret", f'token = "{hexed(40)}'), ("key", "ghp_" + "a1B2" * r.choice([9, 40])), ("id", f"{r.randint(100, 999)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"),
            ("name", "Dr. Ada Lovelace"), ("opaque", "Zk9" + hexed(30)), (None, "version 12 34"),
        ][i % 6]
        cue = {"id": "ssn: ", "name": "contact ", "opaque": "account key "}.get(kind, "")
        data.append((i, f"{before} {cue}{span} {after} a{i}@mail.example.com 10.0.0.{i}"))
        want[i] = None if kind is None else f"{kind}:{len(before) + 1 + len(cue)}:{len(before) + 1 + len(cue) + len(span)}"
    got = {x["doc_id"]: x for x in rows(pii.op2_pii(spark.createDataFrame(data, "doc_id long, text string")))}
    for kind in ("secret", "key", "id", "name", "opaque"):
        mine = [i for i, w in want.items() if w and w.startswith(kind)]
        assert sum(want[i] in got[i]["spans"].split(",") for i in mine) >= 0.9 * len(mine), kind
    assert all(got[i]["n_spans"] == 2 for i, w in want.items() if w is None)
    assert all(got[i]["n_spans"] == 3 for i, w in want.items() if w and w.startswith("secret"))  # its hexadecimal part isn't told twice


def test_estimate_tells_good_labelers_from_bad():
    r = random.Random(1)
    counts = Counter()
    for _ in range(4000):
        truth = r.random() < 0.4
        vote = lambda right: (1 if truth else -1) if r.random() < right else r.choice([1, -1])  # noqa: B023,E731
        counts["secret", (vote(0.95), vote(0.9), vote(0.8), vote(0.7), vote(0.0))] += 1
    prior, odds = pii.estimate([(k, v, n) for (k, v), n in sorted(counts.items())])
    assert abs(prior["secret"] - 0.4) < 0.05
    power = [o[1] - o[-1] for o in odds]
    assert power[0] > power[1] > power[2] > power[3] > power[4] and abs(power[4]) < 0.3


# 3
def toxic_corpus(spark):
    r = random.Random(5)
    plain = ["".join(r.choice("abcdefgh") for _ in range(r.randint(3, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(400):
        words = r.choices(plain, k=40)
        if i % 4 == 0:
            words = [w for w in words for w in ([w, r.choice(["zorkling", "vumpish", "quixnorp"])] if r.random() < 0.15 else [w])] + ["zorkling"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs += [(1000, "you are a zorklng"), (1001, "he said “zorkling” about the word"), (1002, "z0rkling you"), (1003, None), (1004, "")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark, docs, empty):
    d, labels = toxic_corpus(spark)
    got = {r["doc_id"]: r for r in rows(toxicity.op3_toxicity(d, labels))}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i, r in got.items() if i < 400 and r["held_out"]]
    assert sum(got[i]["predicted"] == int(i % 4 == 0) for i in held) / len(held) > 0.97
    assert got[1000]["predicted"] == got[1002]["predicted"] == 1  # misspelled
    assert got[1001]["score"] < got[1000]["score"] and got[1003]["score"] == got[1004]["score"] < 0.5
    assert toxicity.op3_toxicity(empty, labels).collect() == []
    none = labels.where("false")
    assert {r["score"] for r in rows(toxicity.op3_toxicity(docs, none))} == {0.0}
    kept = toxicity.drop_toxic(d, labels)
    assert kept.columns == d.columns and 990 < 1000 and {r["doc_id"] for r in rows(kept)} == {i for i, r in got.items() if not r["predicted"]}


def test_toxicity_crowded_terms(spark):
    """Single clean words near a term weigh nothing themselves, and leave the term in the automaton."""
    d, labels = toxic_corpus(spark)
    near = ["zorklin", "corkling", "zorking", "zorklings", "zorkline"]
    clean = [i for i in range(400) if i % 4 and zlib.crc32(str(i).encode()) % 5]
    more = spark.createDataFrame([(i, f" {w}") for i, w in zip(clean, near, strict=False)], "doc_id long, more string")
    d = d.join(more, "doc_id", "left").select("doc_id", F.concat("text", F.coalesce("more", F.lit(""))).alias("text"))
    lexicon, _ = toxicity.learn(d, labels)
    assert set(near) <= lexicon.plain and {lexicon.weight(w) for w in near} == {0.0}
    assert 0.5 * lexicon.terms["zorkling"] < lexicon.weight("zorklng") < toxicity.PER_EDIT * lexicon.terms["zorkling"]
    got = {r["doc_id"]: r for r in rows(toxicity.op3_toxicity(d, labels))}
    assert got[1000]["predicted"] == 1


def test_stretched_words_are_met():
    x = toxicity.Lexicon({"zorkling": 4.0})
    assert x.weight("zorkl" + "i" * 20 + "ng") == x.weight("zorkl" + "i" * 500 + "ng") == toxicity.PER_EDIT * 4.0
    assert x.weight("zorkling" * 30) == 0.0


def test_learning_counts_repeated_rows_once(spark):
    d, labels = toxic_corpus(spark)
    once = toxicity.sample(d, labels)
    assert once.count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(400))
    assert toxicity.sample(d.union(d).union(d), labels).count() == once.count()
    other = d.union(d.select("doc_id", F.concat("text", F.lit(" again")).alias("text")))
    assert toxicity.sample(other, labels, 50).count() == 50


def plain_features(lexicon, text):
    """Sum and maximum of weights by plain distances and a plain reading of contexts."""
    low, total, most = text.lower(), 0.0, 0.0
    found = [(m.group(), m.start()) for m in toxicity.TOKEN.finditer(low)]
    words = [w for w, _ in found]
    for i, (w, at) in enumerate(found):
        folded = re.sub(r"(.)\1\1+", r"\1", w.translate(toxicity.SIGNS).replace("'", "").replace("’", ""))
        stems = [s for n in range(4, min(8, len(folded) - 1) + 1) for s in lexicon.stems if s == folded[:n]]
        near = sorted((levenshtein(folded, t), t) for t in lexicon.terms if levenshtein(folded, t) <= toxicity.edits(t))
        if w in lexicon.terms:
            x = lexicon.terms[w]
        elif w in lexicon.plain:
            x = 0.0
        elif folded in lexicon.terms:
            x = 0.7 * lexicon.terms[folded]
        elif stems:
            x = 0.8 * lexicon.stems[stems[0]]
        elif folded in lexicon.plain or not near:
            x = 0.0
        else:
            x = lexicon.terms[near[0][1]] * 0.7 ** near[0][0] * lexicon.shares.get(near[0][1], 1.0)
        if x:
            left, right = low[max(0, at - 80) : at].split("\n")[-1], low[at + len(w) : at + len(w) + 80].split("\n")[0]
            if (left.rfind("“") > left.rfind("”") and "”" in right) or (left.count('"') % 2 == 1 and '"' in right):
                x *= 0.1
            elif set(words[max(0, i - 4) : i]) & toxicity.REPORTS:
                x *= 0.5
            elif set(words[max(0, i - 4) : i + 3]) & toxicity.ADDRESS:
                x *= 1.5
        total, most = total + x, max(most, x)
    return total, most


def test_features_against_a_plain_version():
    r = random.Random(4)
    lexicon = toxicity.Lexicon({"abcab": 4.0, "bacca": 3.5, "ccabbacab": 5.0}, {"cabb": 3.0}, frozenset(["abcac"]), {"bacca": 0.25})
    parts = ["abcab", "bacca", "baca", "abcac", "ccabbacba", "cabbxyz", "ab", "said", "you", "“", "”", '"', "\n", "4bcab", "accccab", "plain", "ccabbacaaaab"]
    for _ in range(1500):
        text = " ".join(r.choice(parts) for _ in range(14))
        got, want = lexicon.features(text), plain_features(lexicon, text)
        assert np.allclose(got, want), text


def test_lexicon_against_plain_counts(spark):
    d, labels = toxic_corpus(spark)
    train = toxicity.sample(d, labels)
    lexicon = toxicity.learn_lexicon(train)
    bad, good = {}, {}
    n = Counter(x.toxic for x in train.collect())
    for text, toxic in train.collect():
        words, seen = toxicity.TOKEN.findall(text.lower()), set()
        for p, w in zip(["", *words], words, strict=False):
            if w not in seen:
                seen.add(w)
                (bad if toxic else good).setdefault(w, set()).add(p)
    least = max(6, math.ceil(0.01 * n[1]))
    weight = {w: math.log((len(bad[w]) + 0.5) / (n[1] + 1)) - math.log((len(good.get(w, ())) + 0.5) / (n[0] + 1)) for w in bad}
    want = {w: x for w, x in weight.items() if len(bad[w]) >= least and x >= 3 and len(w) > 2}
    assert lexicon.terms.keys() == want.keys() and all(abs(lexicon.terms[w] - x) < 1e-9 for w, x in want.items())


def test_calibration_is_a_minimum():
    r = np.random.default_rng(3)
    total, most = r.exponential(2, 500), r.exponential(1, 500)
    toxic = (r.random(500) < 1 / (1 + np.exp(2 - total - most))).astype(float)
    w = toxicity.calibrate(total, most, toxic)

    def loss(w):
        z = w[0] + w[1] * np.log1p(total) + w[2] * most
        return (np.logaddexp(0, z) - toxic * z).sum() + 0.005 * (w[1] ** 2 + w[2] ** 2)

    assert all(loss(w) <= loss(w + e) + 1e-9 for e in 0.01 * np.vstack([np.eye(3), -np.eye(3)])) and w[1] > 0 and w[2] > 0


def levenshtein(a, b):
    """With transposed neighbours as one edit."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_automaton_against_distance():
    r = random.Random(1)
    terms = ["abcab", "bacca", "abc", "ccabbacab", "aabbccaab"]
    a = toxicity.Automaton(dict.fromkeys(terms, 1.0))
    for _ in range(3000):
        w = "".join(r.choice("abc") for _ in range(r.randint(1, 10)))
        near = [(levenshtein(w, t), t) for t in terms if levenshtein(w, t) <= toxicity.edits(t)]
        got = a.match(w)
        assert (got is None) == (not near) and (got is None or got[1] == min(near)[0]), (w, got, near)


# 4 and 8
def vectors_table(spark, n=700, dim=16, seed=2):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    data = [(i, [float(np.float32(v)) for v in x[i]]) for i in range(n)]
    data += [(n, None), (n + 1, [0.0] * dim), (n + 2, [1.0, None] + [0.0] * (dim - 2)), (n + 3, [float("nan")] * dim), (None, data[3][1]), (2000, [2.0, 1.0])]
    data += [(20, data[20][1]), (40, data[7][1]), (41, data[40][1])]  # rows that repeat an id
    data += [(3000 + i, data[5][1]) for i in range(30)]  # ties
    data += [(5000, [0.25] * 300)]  # a long one
    clash = [(i, v, "mine", 1, "v", True, 2) for i, v in data]
    have = [(i, np.array([*v, *[0.0] * (300 - len(v))])) for i, v in data if i is not None and v is not None and all(y is not None and math.isfinite(y) for y in v)]
    return spark.createDataFrame(clash, "vec_id long, embedding array<float>, v string, row long, cell string, q boolean, annulus int"), have


def answers(df):
    """Each asker's (rank, vec_id, score), askers of one id by what they got."""
    got: dict = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in got.items()}


def wanted(have, score, k=20):
    """The same by brute force: candidates are all rows but the asker's own."""
    out: dict = {}
    for a, (q, x) in enumerate(have):
        if q % 20 == 0:
            top = sorted((-score(x, y), i) for b, (i, y) in enumerate(have) if b != a)[:k]
            out.setdefault(q, []).extend((n + 1, i, -s) for n, (s, i) in enumerate(top))
    return {q: sorted(x) for q, x in out.items()}


@pytest.mark.parametrize("block", [4096, 10])
def test_exact_top(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    monkeypatch.setattr(vectors, "MORE_ANNULI", 4)
    df, have = vectors_table(spark)
    ints = [(i, np.floor(64 * v).astype(int)) for i, v in have]
    assert answers(vectors.exact_top(df)) == wanted(ints, lambda x, y: int(x @ y))


def recall(got, want):
    hits = [len({i for _, i, _ in want[q]} & {i for _, i, _ in found}) / len({i for _, i, _ in want[q]}) for q, found in got.items()]
    return np.mean(hits)


def test_permutation_top(spark):
    df, have = vectors_table(spark)
    have = [(i, v) for i, v in have if v.any()]
    got, want = answers(vectors.permutation_top(df)), wanted(have, lambda x, y: float(x @ y))
    assert {q: [n for n, *_ in x] for q, x in got.items()} == {q: [n for n, *_ in x] for q, x in want.items()}
    scores: dict = {}
    for i, x in have:
        scores.setdefault(i, []).append(x)
    assert all(min(abs(s - float(a @ b)) for a in scores[q] for b in scores[i]) < 1e-9 for q, found in got.items() for _, i, s in found)
    assert recall(got, want) > 0.9
    # queries that find too few are answered from all rows
    assert answers(vectors.permutation_top(df, rerank=0.0, k=200)).keys() == got.keys()
    assert {len(x) for q, x in answers(vectors.permutation_top(df, rerank=0.0, k=200)).items() if q != 20 and q != 40} == {200}


def test_permutation_recall_on_many_vectors(spark):
    """Vectors without any structure, where less than a twentieth is reranked."""
    n = 20_000
    x = np.random.default_rng(4).normal(size=(n, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got: dict = {}
    for r in vectors.permutation_top(df, query=F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    d = x.astype(float)
    hits = []
    for q, found in got.items():
        s = d @ d[q]
        s[q] = -9
        hits.append(len(found & set(np.argsort(-s)[:20].tolist())) / 20)
    assert len(got) == 200 and np.mean(hits) >= 0.9, np.mean(hits)
    assert vectors.RERANK < 0.05


def test_small_vector_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert vectors.exact_top(spark.createDataFrame([], kind)).collect() == vectors.permutation_top(spark.createDataFrame([], kind)).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], kind)
    assert [tuple(r) for r in vectors.exact_top(few).collect()] == [(0, 1, 1, 2048), (0, 2, 2, -4096)]
    assert [tuple(r)[:3] for r in vectors.permutation_top(few).collect()] == [(0, 1, 1), (0, 2, 2)]
    assert vectors.exact_top(few.where("vec_id = 0")).collect() == []


# 5
def test_packing(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    got = packing.pack(docs.withColumn("piece", F.lit("clash"))).collect()
    ids = Counter()
    for i, text, *_ in ROWS:
        x = t.encode(text or "", add_special_tokens=False).ids + [1]
        for p in range(0, len(x), 4096):
            part = x[p : p + 4096]
            ids[(i, p // 4096, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == ids
    places: dict = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        ends = [0, *(a + n for a, n in sorted(p))]
        assert [a for a, _ in sorted(p)] == ends[:-1] and ends[-1] <= 4096
    assert packing.pack(empty).collect() == []


def test_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    t, e, r = Tokenizer.from_file(default_tokenizer()), Encoder(default_tokenizer()), random.Random(4)
    parts = ["a", "B", "don't", "'s", ".", ",", "..", "%%", " ", "  ", "\n", "\t", "é", "İ", "Σ", "ß", "1", "23", "_", "😀", "\x1c", " ", "é", "<|endoftext|>", "x" * 70]
    for _ in range(1500):
        s = "".join(r.choice(parts) for _ in range(12))
        assert np.frombuffer(e(s), "<u4").tolist() == t.encode(s, add_special_tokens=False).ids, repr(s)


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t, e = Tokenizer.from_file(path), Encoder(path)
    assert not packing.has_short_way(path) and packing.has_short_way(default_tokenizer())
    for s in ("Hello, World.  Two", "", "\n\n x", "é½😀 don't"):
        assert np.frombuffer(e(s), "<u4").tolist() == t.encode(s, add_special_tokens=False).ids


def test_repeated_rows_are_spread_over_shards(spark):
    d = spark.createDataFrame([(None, "same text")] * 600 + [(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    got = packing.pack(d, shard_pieces=100).collect()
    of = Counter(r.sequence_id >> 32 for r in got if r.doc_id is None)
    assert len(got) == 800 and len(of) == 8 and max(of.values()) < 200


def plain_packing(lengths, capacity):
    """Each placement tried in turn: bins as lists, the sum of squared counts counted anew."""
    left, out = [], []
    for s in lengths:
        count = Counter(g for g in left if 0 < g < capacity)
        tries = []
        for gap in sorted(g for g in count if g >= s):
            after = Counter(count)
            after[gap] -= 1
            after[gap - s] += gap > s
            tries.append((sum(n * n for g, n in after.items() if g), gap))
        if s < capacity and tries:
            gap = min(tries)[1]
            b = max(i for i, g in enumerate(left) if g == gap)
        else:
            b, gap = len(left), capacity
            left.append(capacity)
        out.append((left[b], gap))
        left[b] -= s
    return len(left), [capacity - g for g, _ in out]


def test_sum_of_squares_against_a_plain_version():
    r = random.Random(5)
    for _ in range(60):
        lengths = sorted((r.randint(1, 20) for _ in range(40)), reverse=r.random() < 0.7)
        bins, offsets = sum_of_squares(np.array(lengths), 20)
        assert (int(bins.max()) + 1, offsets.tolist()) == plain_packing(lengths, 20)


def test_sum_of_squares_wastes_little():
    n = np.sort(np.random.default_rng(1).integers(1, 3000, 4000))[::-1]
    bins, offsets = sum_of_squares(n, 4096)
    assert np.bincount(bins, n).max() <= 4096 and bins.max() + 1 <= 1.01 * math.ceil(n.sum() / 4096)


# 6
def test_language(spark, docs, empty):
    r = random.Random(2)
    say = {"xx": ["bala", "mala", "kala"], "yy": ["snurf", "blorf", "grompf"], "zz": ["éti", "èvi", "ôri"]}
    data = [(i, " ".join(r.choice(say[k]) + r.choice("abc") for _ in range(20)), k) for i in range(300) for k in [["xx", "yy", "zz"][i % 3]]]
    data += [(900, None, "xx"), (901, "12 %%", "xx"), (902, "malab kalac", None), (None, "blorfa snurfb", None)]
    got = {x["doc_id"]: x for x in rows(language.op6_language_id(spark.createDataFrame(data, "doc_id long, text string, lang string")))}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and got[i]["lang_pred"] == k for i, _, k in data[:300])
    assert (got[900]["lang_pred"], got[900]["score"]) == (got[901]["lang_pred"], got[901]["score"]) == ("und", 0.0)
    assert got[902]["lang_pred"] == "xx" and got[None]["lang_pred"] == "yy" and all(0 <= x["score"] <= 1 for x in got.values())
    assert language.op6_language_id(empty).collect() == []
    assert {x["lang_pred"] for x in rows(language.op6_language_id(docs.withColumn("lang", F.lit(None).cast("string"))))} == {"und"}


def test_numbers_are_no_letters(spark):
    data = [(i, "bala mala", "xx") for i in range(40)] + [(100, "½ ²", None), (101, "Ⅷ ①", None), (102, "a½b", None)]
    got = {x["doc_id"]: x for x in rows(language.op6_language_id(spark.createDataFrame(data, "doc_id long, text string, lang string")))}
    assert got[100]["lang_pred"] == got[101]["lang_pred"] == "und" and got[102]["lang_pred"] == "xx"
    assert language.letters("a½b cd") == ["a", "b", "cd"]


def test_language_of_long_repeated_and_rare_rows(spark):
    r = random.Random(2)
    say = {"xx": ["bala", "mala", "kala"], "yy": ["snurf", "blorf", "grompf"], "rare": ["oqoq", "iqiq", "uquq"]}
    text = lambda k, n=20: " ".join(r.choice(say[k]) for _ in range(n))
    data = [(i, text(["xx", "yy"][i % 2]), ["xx", "yy"][i % 2]) for i in range(400)] + [(9000 + i, text("rare"), "rare") for i in range(8)]
    data += [(0, data[0][1], "xx")] * 300 + [(5000, text("yy", 60_000), None), (5001, text("rare", 50), None)]
    d = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x["lang_pred"] for x in rows(language.identify(d, train_rows=30))}
    assert got[5000] == "yy" and got[5001] == "rare"
    learn = d.where("lang IS NOT NULL")
    assert Counter(x.lang for x in language.sample(learn, 30))["rare"] == 8
    assert len(language.sample(learn)) == 408 and len(language.sample(learn, train_features=100)) < 10


def test_language_sample_is_of_the_smallest_hashes(spark):
    """Of each language first, then of all, whatever the languages' sizes."""
    data = [(i, f"word{i} and {i % 7}", "a" if i < 5000 else "b" if i < 5400 else "c") for i in range(5403)]
    learn = spark.createDataFrame([*data, *data[:300]], "doc_id long, text string, lang string").repartition(16)
    key = F.xxhash64("doc_id", "lang", F.xxhash64("text"))
    keys = sorted((r.k, r.lang) for r in learn.select(key.alias("k"), "lang").distinct().collect())
    seen: Counter = Counter()
    ranked = []
    for k, lang in keys:
        seen[lang] += 1
        ranked.append((min(seen[lang], language.OF_EACH_LANG + 1), k, lang))
    want = sorted(ranked)[:200]
    got = sorted((*r.order, r.lang) for r in language.sample(learn, 200))
    assert [(k, lang) for _, k, lang in got] == [(k, lang) for _, k, lang in want] and {lang for *_, lang in want} == {"a", "b", "c"}


def test_frequencies_against_plain_counts(spark):
    texts = ["ab ba", "Ab", None, "12", "x" * 30, "ab"]
    df = Counter(f for t in texts for f in {int(x) for g in language.grams(t) for x in g})
    idf = language.inverse_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert np.allclose(idf, [math.log(7 / (1 + df[i])) + 1 for i in range(language.FEATURES)])


def test_leader_against_single_weights():
    """Follow-the-regularised-leader, a coordinate at a time, as it was published."""
    r = random.Random(3)
    k, features = 3, 6
    leader = language.Leader(k, features)
    z, n = [[0.0] * k for _ in range(features + 1)], [[0.0] * k for _ in range(features + 1)]

    def weight(i, c):
        if abs(z[i][c]) <= language.L1:
            return 0.0
        sign = 1 if z[i][c] > 0 else -1
        return -(z[i][c] - sign * language.L1) / ((language.BETA + math.sqrt(n[i][c])) / language.ALPHA + language.L2)

    for _ in range(200):
        at = sorted(r.sample(range(features + 1), 3))
        x, y = [r.uniform(0, 3) for _ in at], r.randrange(k)
        w = {i: [weight(i, c) for c in range(k)] for i in at}
        logits = [sum(v * w[i][c] for v, i in zip(x, at, strict=True)) for c in range(k)]
        e = [math.exp(v - max(logits)) for v in logits]
        for v, i in zip(x, at, strict=True):
            for c in range(k):
                g = (e[c] / sum(e) - (c == y)) * v
                sigma = (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / language.ALPHA
                z[i][c] += g - sigma * w[i][c]
                n[i][c] += g * g
        leader.learn(np.array(at), np.array(x), y)
    want = [[weight(i, c) for c in range(k)] for i in range(features + 1)]
    assert np.allclose(leader.weights(np.arange(features + 1)), want)


def test_temperature_against_a_grid():
    r = np.random.default_rng(5)
    logits = r.normal(size=(400, 3)) * 4
    y = np.array([r.choice(3, p=language.softmax(x / 2.5)) for x in logits])
    loss = lambda t: -np.log(language.softmax(logits / t)[np.arange(400), y]).mean()
    t = language.temperature(logits, y)
    assert loss(t) <= min(loss(g) for g in np.exp(np.linspace(-3, 3, 200))) + 1e-3 and 1.8 < t < 3.4


# 7
def test_mixing(spark, docs, empty):
    assert mixing.op7_mixing(empty).collect() == []
    got = rows(mixing.op7_mixing(docs))
    assert len(got) == len(ROWS)
    r = random.Random(8)
    data = [(i, " ".join(["w"] * r.randint(0, 30)), r.choice(["a"] * 20 + ["b", "c", "d", None])) for i in range(3000)]
    got = rows(mixing.op7_mixing(spark.createDataFrame(data, "doc_id long, text string, source string")))
    source = {i: s for i, _, s in data}
    total = sum(x["size"] for x in got)
    by: dict = {}
    for x in got:
        assert 0 <= x["taken"] <= 2 * x["size"]
        by.setdefault(source[x["doc_id"]], []).append(x)
    for x in by.values():
        assert abs(sum(y["taken"] for y in x) - x[0]["target"]) <= 0.5 and x[0]["target"] <= 2 * x[0]["source_size"] == 2 * sum(y["size"] for y in x)
    assert abs(sum(x[0]["target"] for x in by.values()) - 1.5 * total) < 1e-6 * total
    # filled from the smallest level on, by plain repetition
    names = sorted((s for s in by if s is not None)) + [None]
    weight, cap = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, {s: 2 * by[s][0]["source_size"] for s in names}
    full: set = set()
    while True:
        left = (1.5 * total - sum(cap[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        new = {s for s in names if s not in full and weight[s] * left > cap[s]}
        if not new:
            break
        full |= new
    for s in names:
        assert abs(by[s][0]["target"] - (cap[s] if s in full else weight[s] * left)) < 1e-6 * total


def test_mixing_many_sources_and_hot_ids(spark, monkeypatch):
    """Sources in several ranges, and a third of the rows without an id: the same totals as by plain repetition."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    r = random.Random(3)
    data = [(None if i % 3 == 0 else i, f"s{r.randrange(150):03d}", r.randint(0, 9)) for i in range(2000)] + [(None, None, 4)] * 500
    d = spark.createDataFrame(data, "doc_id long, source string, size long")
    got = rows(mixing.mix(d))
    assert sorted(((x["doc_id"] or -1, x["source"] or "", x["size"]) for x in got)) == sorted((i or -1, s or "", n) for i, s, n in data)
    size, taken, target = Counter(), Counter(), {}
    for x in got:
        assert 0 <= x["taken"] <= 2 * x["size"]
        size[x["source"]] += x["size"]
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
    names = sorted(s for s in size if s is not None) + [None]
    total, weight, full = sum(size.values()), {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, set()
    while True:
        left = (1.5 * total - sum(2 * size[s] for s in full)) / max(1, sum(weight[s] for s in names if s not in full))
        if not (new := {s for s in names if s not in full and weight[s] * left > 2 * size[s]}):
            break
        full |= new
    for s in names:
        assert abs(target[s] - (2 * size[s] if s in full else weight[s] * left)) < 1e-6 * total and abs(taken[s] - target[s]) <= 0.5
    key = lambda x: (x["doc_id"] or -1, x["source"] or "", x["size"], x["taken"])
    assert sorted(map(key, got)) == sorted(map(key, rows(mixing.mix(d))))


def test_remix_takes_what_mix_says(spark):
    data = [(i, f"doc {i} " + "w " * (i % 7), ["a", "b", "c", None][i % 4], 5) for i in range(60)] + [(3, "doc 3 w w w ", None, 5)] * 2
    d = spark.createDataFrame(data, "doc_id long, text string, source string, n_chars long")
    want = Counter()
    for x in mixing.mix(d.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))).collect():
        want[x.doc_id] += x.taken
    got = Counter()
    out = mixing.remix(d)
    assert out.columns == d.columns
    for x in out.collect():
        got[x.doc_id] += len(x.text.split())
        assert x.n_chars == len(x.text)
    assert +want == got


# 9
def test_licenses(spark, docs, empty):
    body = licenses.TEMPLATES["mit-permission"]
    words = body.split()
    data = [(1, None), (2, ""), (3, "x " * 50 + body + " y" * 50), (4, " ".join(words[:30] + ["changed"] + words[31:])), (5, " ".join(words[:20])), (6, "Foo. Licensed under CC BY-NC 4.0.\nbar"), (None, "released UNDER the mit  license!"), (7, LONG)]
    got = sorted(((r["doc_id"] or 0, r["license"]) for r in rows(licenses.scan(spark.createDataFrame(data, "doc_id long, text string")))))
    assert got == [(0, "mit"), (3, "mit-permission"), (4, "mit-permission"), (6, "cc-by-nc-4.0")]
    assert licenses.scan(empty).collect() == [] and licenses.scan(docs).collect() == []


def test_licenses_find_what_containment_says(spark):
    r = random.Random(9)
    split = lambda s: [w for w in re.split(r"[^\w]+|_", s.lower()) if w]
    shingle = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    data, want = [], set()
    for i in range(300):
        name = r.choice(sorted(licenses.TEMPLATES))
        w = split(licenses.TEMPLATES[name])
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = "zzz"
        text = " ".join([*("q" + str(r.random())[2:5] for _ in range(r.randint(0, 40))), *w, *("t" for _ in range(r.randint(0, 9)))])
        data.append((i, text))
        for n, body in licenses.TEMPLATES.items():
            s = shingle(split(body))
            if len(s & shingle(split(text))) >= 0.75 * len(s):
                want.add((i, n))
    got = {(x["doc_id"], x["license"]) for x in rows(licenses.scan(spark.createDataFrame(data, "doc_id long, text string")))}
    assert got <= want and len(got) >= 0.99 * len(want)


# 10
def test_jaccard(spark, docs, empty):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(jaccard.op10_jaccard_join(docs))), key=str)
    want = brute.components([(i, t) for i, t, *_ in ROWS if i is not None])
    assert [g for g in got if g[0] is not None] == sorted(((i, *want[i]) for i, *_ in ROWS if i is not None), key=str)
    assert [g for g in got if g[0] is None] == [(None, 2, 7)]
    assert jaccard.op10_jaccard_join(empty).collect() == []


@pytest.mark.parametrize("trie_sets", [2048, 7, 40])
def test_jaccard_near_the_threshold(spark, monkeypatch, trie_sets):
    monkeypatch.setattr(jaccard, "TRIE_SETS", trie_sets)
    monkeypatch.setattr(jaccard, "CENTRE_LINKS", trie_sets // 2)
    r = random.Random(6)
    base = [[f"w{r.randrange(5000)}" for _ in range(r.randint(8, 80))] for _ in range(40)]
    common = [f"c{i}" for i in range(30)]
    data = []
    for i in range(400):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        if r.random() < 0.5:
            w = w[: r.randint(4, len(w))]
        if r.random() < 0.5:
            w = [*common, *w]
        data.append((i, " ".join(w)))
    want = brute.components(data)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in rows(jaccard.op10_jaccard_join(spark.createDataFrame(data, "doc_id long, text string")))}
    assert got == want
    kept = {x["doc_id"] for x in rows(jaccard.keep_one(spark.createDataFrame(data, "doc_id long, text string")))}
    assert kept == {c for _, c in want.values()}


@pytest.mark.parametrize("task_links", [250_000, 40])
def test_components_of_paths_and_stars(spark, monkeypatch, task_links):
    from tessella.llm import links as module

    monkeypatch.setattr(module, "TASK_LINKS", task_links)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(3, 2), (2, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(200, 400)]}, 2: 2, 3: 2}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_clashing_names(spark):
    """Columns named like the operators' own stay what they are."""
    names = ["size", "taken", "component_id", "total", "most", "_id", "_row", "key", "piece", "n_dropped", "_t", "score"]
    data = [(i, f"one two three four five {i % 3}", "s", *(f"{n}{i}" for n in names)) for i in range(6)]
    d = spark.createDataFrame(data, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for out in (toxicity.drop_toxic(d, labels), jaccard.keep_one(d), mixing.remix(d), line_dedup.without_shared_lines(d)):
        assert out.columns == d.columns
        assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names)
    for op in (line_dedup.op1_line_dedup, pii.op2_pii, packing.op5_packing, mixing.op7_mixing, licenses.op9_license_scan, jaccard.op10_jaccard_join):
        op(d).collect()
    language.op6_language_id(d.withColumn("lang", F.lit("en"))).collect()


def shingle_ranks(sets):
    order = {t: i for i, t in enumerate(sorted(set().union(*sets)))}
    return [np.array(sorted(order[t] for t in s), np.int64) for s in sets]


def test_trie_of_deeply_nested_and_of_large_sets():
    nested = [np.arange(n) for n in range(1, 2401)]
    found = []
    jaccard.Trie(nested, np.arange(1, 2401)).links(lambda x, y, link: found.append((x, y)) if link else x == y)
    want = sum(sum(4 * m >= 3 * n for m in range(1, n)) for n in range(1, 2401))
    assert len(found) == want
    r = np.random.default_rng(3)
    base = np.sort(r.choice(60_000, 20_000, replace=False))
    large = [base, np.sort(np.append(base[:-2000], np.arange(70_000, 71_000))), np.sort(r.choice(60_000, 20_000, replace=False))]
    found = []
    jaccard.Trie(large, np.array([len(x) for x in large])).links(lambda x, y, link: found.append((x, y)) if link else False)
    assert found == [(1, 0)]


def test_jaccard_of_long_texts(spark):
    r = random.Random(12)
    base = [f"w{r.randrange(10**7)}" for _ in range(20_000)]
    data = []
    for i in range(12):
        w = list(base)
        for _ in range(r.choice([300, 1500])):
            w[r.randrange(len(w))] = f"x{r.randrange(10**7)}"
        data.append((i, " ".join(w)))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in rows(jaccard.op10_jaccard_join(spark.createDataFrame(data, "doc_id long, text string")))}
    assert got == brute.components(data)


def test_jaccard_hot_group_in_rounds(spark, monkeypatch):
    """A group of which each text is similar to some others only: rounds and blocks give what all pairs give."""
    monkeypatch.setattr(jaccard, "ROUND_SETS", 8)
    monkeypatch.setattr(jaccard, "LEAST_SETS", 16)
    monkeypatch.setattr(jaccard, "TRIE_SETS", 32)
    monkeypatch.setattr(jaccard, "TRIE_TOKENS", 1500)
    r = random.Random(10)
    base = [f"w{i}" for i in range(100)]
    data = []
    for i in range(300):
        w = list(base)
        for _ in range(r.choice([1, 2, 2, 3, 5])):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        data.append((i, " ".join(w)))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in rows(jaccard.op10_jaccard_join(spark.createDataFrame(data, "doc_id long, text string")))}
    assert got == brute.components(data)


def test_jaccard_tells_sets_of_one_key_apart(spark):
    import pyarrow as pa

    data = [(i, f"one two three four five {i % 4}") for i in range(20)]
    # eight keys for all sets: the executors' copy of the module must agree, so the functions are handed over as they are
    real = jaccard.set_hash
    jaccard.set_hash = lambda tokens: (real(tokens)[0] % 2, real(tokens)[1])
    try:
        batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in data]), pa.array([t for _, t in data])], names=["doc_id", "text"])
        prints = pa.Table.from_batches(list(jaccard._prints([batch])))
    finally:
        jaccard.set_hash = real
    of_docs = spark.createDataFrame([tuple(r.values()) for r in prints.to_pylist() if not r["frequent"]], jaccard.PRINTS)
    names = jaccard._renamed(of_docs, jaccard._classes(of_docs))
    keys = {names.get((r.key, r.check), r.key) for r in of_docs.collect()}
    assert len({(r.key) for r in of_docs.collect()}) <= 2 and len(keys) == 4

"""Personal data: base patterns plus weakly supervised spans, in DataFrame operations only."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import cut

#: The contract's patterns, written so that no text makes them slow: a run of characters is entered at its beginning (or
#: where the last match ended) only, and what can't be given back with success isn't given back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
#: Candidates for more spans; the base kinds come along, as they teach the labelers' reliability.
MORE = {
    "secret": r"(?i:(?<![a-z0-9])(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|contraseña|passwort|motdepasse)\s{0,3}[=:]\s{0,3})[\"'“]?[^\s,;\"'“”]{4,}+",
    "key": r"(?<![A-Za-z0-9_-])(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk-[A-Za-z0-9]{20,}+|AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9_-])",
    "id": r"(?<![A-Za-z0-9-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9-])",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Mlle|Monsieur|Madame|Señor|Señora|Sra?)\.?\x20\p{Lu}[\p{L}'-]{1,40}(?:\x20\p{Lu}[\p{L}'-]{1,40})?",
}
#: Long runs of mixed signs that no prefix announces; what another added span holds already isn't one.
MORE["opaque"] = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+={0,2}"
KINDS = (*BASE, *MORE)
#: Characters before a candidate that the context labeler reads.
WINDOW = 48
#: Gazetteer and context cues: fixed lists.
GAZETTEER = r"(?i)password|passwd|pwd|secret|token|key|@(?:[a-z0-9-]+\.)*(?:mail|gmail|outlook|yahoo|hotmail|web|example|gmx)[a-z0-9-]*\.|^(?:akia|asia|ghp_|sk-|aiza)|^\+(?:1|33|34|44|49)(?![0-9])|^[45][0-9]{3}|(?:mr|mrs|ms|dr|herr|frau|mme|sra?)\.?\x20"
CUES_FOR = r"(?i)(?:e-?mail|mail|contact|call|phone|tel|mobile|fax|ip|address|host|card|visa|iban|account|ssn|social|password|secret|key|login|user|name|dear|kontakt|telefon|correo|courriel)[\p{L}]*[\s:=.,(#-]{0,6}(?:is\s|=|:)?\s*$"
CUES_AGAINST = r"(?i)(?:version|ver|v|release|isbn|issn|page|pages|section|figure|table|chapter|price|total|sum|rfc|serial|part)[\s:=.,(#-]{0,6}$"
LABELERS = ("pattern", "check", "gazetteer", "context", "mixture")
#: Features of the final classifier, with their number of values: length, shape of the value, variety of its signs, the words
#: before it, and whether something is assigned.
FEATURES = {"length": 5, "shape": 5, "variety": 4, "before": 3, "assigned": 2}
ROUNDS = 40


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    d = F.reverse(digits)
    at = lambda i: F.substring(d, i + 1, F.lit(1)).cast("int")
    step = lambda a, i: a + F.when(i % 2 == 0, at(i)).when(at(i) > 4, 2 * at(i) - 9).otherwise(2 * at(i))
    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), step) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(OCTETS)
    n = F.length(_digits(m))
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), _luhn(_digits(m))).otherwise(False)
    return (n >= 9) & (n <= 15) if kind == "phone" else F.lit(True)


def _votes(kind: str, m: Column, before: Column) -> Column:
    """One of -1, 0, 1 from each labeler."""
    one = lambda yes, no=None: F.when(yes, 1).when(no, -1).otherwise(0) if no is not None else F.when(yes, 1).otherwise(0)
    value = _value(kind, m)
    letters, digits = value.rlike(r"\p{L}"), value.rlike("[0-9]")
    checks = _valid(kind, m) if kind in ("ip", "card", "phone") else None
    return F.array(
        one(F.length(m) >= {"card": 15, "ip": 7, "phone": 11}.get(kind, 6), F.length(m) < 4),
        one(checks, ~checks) if checks is not None else F.lit(0),
        one(m.rlike(GAZETTEER)),
        one(before.rlike(CUES_FOR), before.rlike(CUES_AGAINST)),
        one(letters & digits & (F.length(value) >= 8), ~letters & (F.length(_digits(value)) < 7)) if kind not in ("name",) else F.lit(0),
    )


def _value(kind: str, m: Column) -> Column:
    return F.regexp_replace(m, r"^[^=:]*[=:]\s*[\"'“]?", "") if kind == "secret" else m


def _features(kind: str, m: Column, before: Column) -> Column:
    """FEATURES of a candidate, each counted from 0."""
    value = _value(kind, m)
    step = lambda n, *at: sum((F.when(n >= a, 1).otherwise(0) for a in at), F.lit(0))
    letters, digits = value.rlike(r"\p{L}"), value.rlike("[0-9]")
    shape = F.when(value.rlike(r"[^\p{L}0-9+/=_-]"), 4).when(~letters, 0).when(~digits, 1).when(value.rlike("^[0-9a-fA-F]+$"), 2).otherwise(3)
    variety = step(F.size(F.array_distinct(F.split(F.left(value, F.lit(256)), ""))), 5, 9, 13)
    cue = F.when(before.rlike(CUES_FOR), 1).when(before.rlike(CUES_AGAINST), 2).otherwise(0)
    assigned = (m if kind == "secret" else before).rlike(r"[=:]\s*[\"'“]?" + ("" if kind == "secret" else "$")).cast("int")
    return F.array(step(F.length(value), 8, 12, 20, 32), shape, variety, cue, assigned)


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Matches as array<struct<kind, start, end, ok, votes>>, in order. Starts follow from the lengths of what lies between."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.zip_with(matches, between, lambda m, g: F.struct(m.alias("m"), F.char_length(m).alias("n"), F.char_length(g).alias("gap"), F.right(g, F.lit(WINDOW)).alias("before")))
    real = F.filter(zipped, lambda x: x["m"].isNotNull())
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,ok:boolean,votes:array<int>,traits:array<int>>>")

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        end = start + x["n"]
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), (_valid(kind, x["m"]) if kind in BASE else F.lit(False)).alias("ok"), _votes(kind, x["m"], x["before"]).alias("votes"), _features(kind, x["m"], x["before"]).alias("traits"))
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

    return F.aggregate(real, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda a: a["spans"])


def estimate(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[dict[str, float], list[dict[int, float]]]:
    """Expectation-maximisation over (kind, votes, how many): each kind's prior and each labeler's log-odds of each vote.

    Votes are taken as independent given the truth; a labeler starts as right in four of five votes, and counts are
    smoothed by that belief. The number of patterns is bounded by kinds and votes, whatever the input.
    """
    prior = {k: 0.5 for k, _, _ in patterns}
    believed = {1: (0.4, 0.1), 0: (0.5, 0.5), -1: (0.1, 0.4)}
    odds = [{v: math.log(a / b) for v, (a, b) in believed.items()} for _ in LABELERS]
    for _ in range(rounds):
        hits = {k: [1.0, 2.0] for k in prior}
        seen = [{v: [20 * a, 20 * b] for v, (a, b) in believed.items()} for _ in LABELERS]
        for kind, votes, n in patterns:
            z = math.log(prior[kind] / (1 - prior[kind])) + sum(o[v] for o, v in zip(odds, votes, strict=True))
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            hits[kind][0] += n * p
            hits[kind][1] += n
            for s, v in zip(seen, votes, strict=True):
                s[v][0] += n * p
                s[v][1] += n * (1 - p)
        prior = {k: min(0.99, max(0.01, a / b)) for k, (a, b) in hits.items()}
        odds = []
        for s in seen:
            yes, no = sum(x[0] for x in s.values()), sum(x[1] for x in s.values())
            odds.append({v: math.log(a / yes) - math.log(b / no) for v, (a, b) in s.items()})
    return prior, odds


def classifier(patterns: list[tuple[str, tuple[int, ...], tuple[int, ...], int]], rounds: int = 600, rate: float = 2.0, ridge: float = 1e-4) -> tuple[dict[str, float], list[list[float]]]:
    """The final span classifier: logistic regression on kind and text features, fitted to the truth that the labelers'
    votes make likely. It doesn't see the votes, so it also speaks where no labeler does.

    patterns (kind, votes, features, how many). They weigh by the logarithm of their number, so that a rare kind isn't
    drowned by a common one.
    """
    votes: Counter = Counter()
    for kind, v, _, n in patterns:
        votes[kind, v] += n
    prior, odds = estimate([(k, v, n) for (k, v), n in sorted(votes.items())])
    kinds = sorted(prior)
    starts = np.cumsum([len(kinds), *FEATURES.values()])
    x = np.zeros((len(patterns), starts[-1]))
    z, share = np.zeros(len(patterns)), np.log1p([n for *_, n in patterns])
    for i, (kind, v, traits, _) in enumerate(patterns):
        x[i, kinds.index(kind)] = 1
        x[i, starts[:-1] + np.array(traits)] = 1
        z[i] = math.log(prior[kind] / (1 - prior[kind])) + sum(o[a] for o, a in zip(odds, v, strict=True))
    y, share, w = 1 / (1 + np.exp(-np.clip(z, -30, 30))), share / share.sum(), np.zeros(x.shape[1])
    for _ in range(rounds):
        w -= rate * (x.T @ (share * (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - y)) + ridge * w)
    return {k: float(w[i]) for i, k in enumerate(kinds)}, [w[a : a + n].tolist() for a, n in zip(starts, FEATURES.values(), strict=False)]


def find_spans(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs (doc_id, text): doc_id, base and all, each array<struct<kind, start, end>> in order of kind and start; a text of any length is one row.

    `base` are the matches of the base patterns that pass their checks. `all` adds what the final classifier takes for
    personal data among the other candidates, where no base span lies: labelers (pattern, check, gazetteer, context,
    mixture of characters) vote on every candidate of the whole corpus, expectation-maximisation estimates their
    reliability from counts of votes, and a logistic classifier on features of the text is fitted to its answers. Offsets are code points, ends
    exclusive.

    Null or empty text: no spans. Null id: kept. Repeated rows are answered as often as they occur. Without candidates
    nothing is learned and nothing added. An empty table gives an empty table.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), text.alias("text"))
    needs = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+")}
    none = F.array().cast("array<struct<kind:string,start:int,end:int,ok:boolean,votes:array<int>,traits:array<int>>>")
    each = [F.when(needs.get(k, F.lit(True)), _found(F.col("text"), k, p)).otherwise(none) for k, p in (BASE | MORE).items()]
    found = cut(rows.select("doc_id", F.concat(*each).alias("found")))
    counted = found.select(F.explode("found").alias("x")).groupBy("x.kind", "x.votes", "x.traits").count().collect()
    patterns = sorted((r.kind, tuple(r.votes), tuple(r.traits), r["count"]) for r in counted)  # bounded by kinds, votes, features
    plain = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    base = F.transform(F.filter("found", lambda x: x["ok"]), plain)
    if not patterns:
        return found.select("doc_id", base.alias("base"), base.alias("all"))
    bias, weights = classifier(patterns)
    kinds = F.create_map(*(x for k, b in bias.items() for x in (F.lit(k), F.lit(float(b)))))

    def likely(x: Column) -> Column:
        z = F.element_at(kinds, x["kind"])
        for i, w in enumerate(weights):
            z = z + F.element_at(F.array(*(F.lit(v) for v in w)), F.get(x["traits"], F.lit(i)) + 1)
        return z >= math.log(threshold / (1 - threshold))

    more = F.filter("found", lambda x: x["kind"].isin(*MORE) & likely(x))
    meets = lambda x, y: (y["start"] < x["end"]) & (x["start"] < y["end"])
    apart = lambda x: ~F.exists("base", lambda y: meets(x, y)) & ((x["kind"] != "opaque") | ~F.exists("more", lambda y: (y["kind"] != "opaque") & meets(x, y)))
    out = found.withColumn("base", base).withColumn("more", more)
    free = F.filter("more", apart)
    return out.select("doc_id", "base", F.concat("base", F.transform(free, plain)).alias("all"))


def op2_pii(docs: DataFrame) -> DataFrame:
    spans = find_spans(docs.select("doc_id", "text"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["kind"], F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    counts = [of(k).alias(f"n_{k}") for k in BASE] + [F.size("all").cast("long").alias("n_spans")]
    return spans.select("doc_id", *counts, F.sha2(F.encode(joined("base"), "utf-8"), 256).alias("base_sha256"), joined("all").alias("spans"))

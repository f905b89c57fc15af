"""The pipeline's stages against plain versions of what they decide."""

from collections import Counter

import brute

import corpus_pipeline
from tessella.llm import toxicity
from tessella.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read(spark, SF, "documents")
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        steps.append((name, docs, out))
        docs = out
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, f) = steps
    for x in (b, c, d, e):
        assert x.columns == a.columns
    bad = {r.doc_id for r in toxicity.score(a, read(spark, SF, "labels")).where("predicted = 1").collect()}
    assert {r.doc_id for r in b.collect()} == {r.doc_id for r in a.collect()} - bad
    texts = {r.doc_id: r.text for r in b.collect()}
    lines = Counter(k for t in texts.values() for k in {x.strip(brute.SPACE).lower() for x in t.split("\n")})
    for r in c.collect():
        assert r.n_chars == len(r.text)
        assert all(x in r.text for x in texts[r.doc_id].split("\n") if lines[x.strip(brute.SPACE).lower()] < 3)
    want = brute.components([(r.doc_id, r.text) for r in c.collect()])
    assert {r.doc_id for r in d.collect()} == {x for _, x in want.values()}
    words = {r.doc_id: len((r.text or "").split()) for r in d.collect()}
    taken = Counter()
    for r in e.collect():
        taken[r.doc_id] += len(r.text.split())
    assert set(taken) <= set(words) and all(taken[i] <= 2 * words[i] for i in taken)
    assert abs(sum(taken.values()) - 1.5 * sum(words.values())) <= 0.01 * sum(words.values())
    packed = Counter(r.doc_id for r in f.where("piece = 0").collect())
    assert packed == Counter(r.doc_id for r in e.collect())


def test_stages_on_odd_tables(spark, tmp_path):
    """Null and empty texts, null ids, names of the operators' own, no labels, and no rows at all."""
    line = "a shared line of at least twenty signs"
    data = [(None, None, None, None, None, 1, "r", "k"), (1, "", "en", "a", 0, 1, "r", "k"), (2, None, "en", "a", 0, 1, "r", "k")]
    data += [(10 + i, f"{line}\nwords of document number {i} and some more", "en", ["a", None][i % 2], 9, 1, "r", "k") for i in range(6)]
    data += [(10, f"{line}\nwords of document number 0 and some more", "en", "a", 9, 1, "r", "k")] * 2
    kind = "doc_id long, text string, lang string, source string, n_chars long, size int, _row string, key string"
    for name, rows in (("odd", data), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, kind).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs = read(spark, folder, "documents")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
            assert all(r._row == "r" and r.key == "k" for r in docs.collect())
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
        assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
        if rows:
            assert sum(line in r.text for r in docs.dropDuplicates(["doc_id"]).collect()) <= 1 and {r.doc_id for r in docs.collect()} >= {15}


def test_run_gives_sequences(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0

"""Archive to package, the queue, budgets, state files; and every query against its SQL."""

import io
import json
import random
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from tessella.__main__ import main
from tessella.operators import budgets, classify, inventory, queue, render, report
from tessella.operators.classify import ScanRules
from tessella.plans import publish, queries
from tessella.plans.workspace import Workspace
from tessella.schemas import ChangelogError, ConfigError, EngineError, OutputPathError, PackageError, QueueError, ScanError, SourceError, StateError
from tessella.sources import jsonl, nested_zip

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def jar(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


def archive(path, members):
    path.write_bytes(jar(members))
    return str(path)


def reasons(df):
    return sorted((r.container, r.resource_path, r.reason) for r in df.collect())


def test_globs(spark):
    cases = [("*.properties", "a/b.properties", True), ("tips/**/*.html", "tips/a/b.html", True), ("tips/**/*.html", "tips/b.html", False), ("a?c", "abc", True), ("[ab].x", "b.x", True), ("[!ab].x", "b.x", False), ("a+b.(c)", "a+b.(c)", True), ("*", "a\nb", True), ("[", "[", True)]
    for glob, path, want in cases:
        assert spark.range(1).select(classify.matches_glob(F.lit(path), glob)).first()[0] is want, glob
    assert spark.range(1).select(classify.matches_resource_glob(F.lit("tips/b.html"), "tips/**/*.html")).first()[0]
    loc = {"foo_bar.properties": True, "x_menu.properties": False, "a/i18n/b.html": True, "m_de_DE.properties": True, "l10n": True, "b.html": False}
    for path, want in loc.items():
        assert spark.range(1).select(classify.is_localized(F.lit(path))).first()[0] is want, path


def test_scan_is_a_partition(spark, tmp_path):
    a = jar([("m.properties", b"k=1"), ("tips/t.html", b"<p>t</p>"), ("x_de.properties", b"k=2"), ("A.class", b""), ("d/", b""), ("../e.html", b""), ("in.jar", b"z"), ("big.properties", b"x" * 300), ("m.properties", b"k=3")])
    z = jar([("m.properties", b"k=9"), ("tips/t.html", b"<p>t</p>")])
    p = archive(tmp_path / "o.zip", [("lib/a.jar", a), ("lib/z.jar", z), ("bad.jar", b"no zip"), ("run.sh", b""), ("../evil.jar", z), ("third.jar", z)])
    rules = ScanRules(container_rules=(("third*", "third_party_container"),), limits=ScanRules().limits | {"max_resource_bytes": 200})
    res, exc, col = inventory.scan(spark, p, rules)
    assert sorted((r.container, r.resource_path, r.resource_type, r.size) for r in res.collect()) == [("lib/a.jar", "m.properties", "properties", 3), ("lib/a.jar", "tips/t.html", "tip", 8), ("lib/z.jar", "m.properties", "properties", 3), ("lib/z.jar", "tips/t.html", "tip", 8)]
    assert reasons(exc) == sorted([
        ("<outer>", "../evil.jar", "unsafe_path"), ("<outer>", "run.sh", "not_jar"), ("bad.jar", "", "corrupt_archive"), ("third.jar", "", "third_party_container"),
        ("lib/a.jar", "../e.html", "unsafe_path"), ("lib/a.jar", "A.class", "unsupported_resource"), ("lib/a.jar", "big.properties", "resource_too_large"), ("lib/a.jar", "d/", "directory"),
        ("lib/a.jar", "in.jar", "nested_archive"), ("lib/a.jar", "m.properties", "duplicate_member"), ("lib/a.jar", "x_de.properties", "localized"),
    ])
    assert sorted((r.resource_path, len(r.resources), r.content_identical, r.unresolved) for r in col.collect()) == [("m.properties", 2, False, True), ("tips/t.html", 2, True, False)]
    chosen = ScanRules(container_rules=rules.container_rules, selections=(("m.properties", "lib/z.jar"),), limits=rules.limits)
    res, exc, col = inventory.scan(spark, p, chosen)
    assert [r.resource_path for r in col.collect()] == ["tips/t.html"] and ("lib/a.jar", "m.properties", "collision_not_selected") in reasons(exc)
    with pytest.raises(ScanError):
        inventory.scan(spark, p, ScanRules(selections=(("none", "lib/z.jar"),)))
    gated = ScanRules(reference_containers=("lib/z.jar",), require_reference=True)
    assert ("lib/a.jar", "big.properties", "not_in_translation_reference") in reasons(inventory.scan(spark, p, gated)[1])
    with pytest.raises(ScanError):
        inventory.scan(spark, p, ScanRules(reference_containers=("bad.jar",), require_reference=True))
    with pytest.raises(ConfigError):
        ScanRules(container_rules=(("a", "localized"),))


def test_scan_budgets(spark, tmp_path):
    j = lambda n: jar([(f"{i}.properties", b"abcd") for i in range(n)])
    p = archive(tmp_path / "o.zip", [("a.jar", j(2)), ("b.jar", j(2)), ("c.jar", j(1))])
    base = ScanRules().limits
    run = lambda **k: reasons(inventory.scan(spark, p, ScanRules(limits=base | k))[1])
    assert run(max_members=3) == [("b.jar", "", "member_budget_exceeded")]
    assert run(max_containers=2) == [("c.jar", "", "container_budget_exceeded")]
    assert run(max_total_resource_bytes=8) == [("b.jar", "0.properties", "total_resource_bytes_exceeded"), ("b.jar", "1.properties", "total_resource_bytes_exceeded"), ("c.jar", "0.properties", "total_resource_bytes_exceeded")]
    assert run(max_total_nested_jar_bytes=2 * len(j(2))) == [("c.jar", "", "total_nested_jar_bytes_exceeded")]
    with pytest.raises(ScanError):
        run(max_outer_members=2)


@pytest.mark.parametrize("budget", [0, 50, 500, 10**6])
@pytest.mark.parametrize("rows", [500_000, 13])
def test_greedy_budget(spark, monkeypatch, budget, rows):
    monkeypatch.setattr(budgets, "RANGE_ROWS", rows)
    r = random.Random(budget)
    data = [(i, r.randint(0, 40)) for i in range(120)]
    left, want = budget, {}
    for i, s in data:
        want[i] = s <= left
        left -= s * want[i]
    got = budgets.greedy(spark.createDataFrame(data, "i long, s long"), ["i"], "s", budget)
    assert {x.i: x.kept for x in got.collect()} == want


def workspace(tmp_path, sources):
    a = jar(sources)
    path = tmp_path / "product.zip"
    path.write_bytes(jar([("product-info.json", json.dumps({"version": "1", "buildNumber": "10.1", "productCode": "XX"})), ("lib/a.jar", a)]))
    (tmp_path / "config").mkdir(exist_ok=True)
    product = {"archive": "product.zip", "version": "1", "build_number": "10.1", "product_code": "XX", "sha256": nested_zip.fingerprint(str(path))[0], "since_build": "10", "until_build": "10.*", "plugin_id": "p", "plugin_version": "1.0"}
    (tmp_path / "config/product.json").write_text(json.dumps(product))
    rules = {"container_exclusions": [], "resource_exclusions": [], "resource_selections": [], "resource_patterns": ["*.properties", "tips/**/*.html"], "localization_directories": ["i18n"], "translation_reference_containers": [], "require_translation_reference": False, "limits": ScanRules().limits}
    (tmp_path / "config/scanner.json").write_text(json.dumps(rules))
    (tmp_path / "CHANGELOG.md").write_text("# C\n\n## 1.0\n- first <b>\n\n## 0.9\n- older\n")


def test_commands_end_to_end(spark, tmp_path, capsys):
    workspace(tmp_path, [("m.properties", b"# c\nsave=Save {0}\nname=Name\nempty=\n"), ("tips/t.html", b"<p>Tip</p>\r\n")])
    call = lambda *a: main(["--root", str(tmp_path), *a], spark)
    assert call("validate-source") == 0 and call("scan") == 0
    w = Workspace(spark, tmp_path)
    assert {(r.context.key, r.status) for r in w.table("units").collect()} == {("save", "open"), ("name", "open"), ("empty", "technically_reviewed"), ("", "open")}
    assert call("generate") == 1  # units are open
    assert call("next-batch", "--limit", "2") == 0 and call("next-batch") == 0  # the same again
    batch = next((tmp_path / "batches").iterdir())
    rows = [json.loads(x) for x in batch.read_text().splitlines()]
    assert len(rows) == 2
    done = lambda r: r | {"target": {"Save {0}": "{0} sichern", "Name": "Name", "<p>Tip</p>\r\n": "<p>Tipp</p>\n"}[r["source"]]}
    batch.write_bytes(jsonl.serialize([done(r) | {"source": "x"} for r in rows]))
    assert call("import-batch", str(batch)) == 1
    batch.write_bytes(jsonl.serialize([done(r) for r in rows]))
    assert call("import-batch", str(batch)) == 0
    assert call("next-batch") == 0
    (tmp_path / "product.zip").rename(tmp_path / "away.zip")  # generation needs the stored blobs only
    batch = max((tmp_path / "batches").iterdir())
    batch.write_bytes(jsonl.serialize([done(json.loads(x)) for x in batch.read_text().splitlines()]))
    assert call("import-batch", str(batch)) == 0 and call("validate") == 0 and call("generate") == 0
    made = {str(p.relative_to(tmp_path / "generated")): p.read_bytes() for p in (tmp_path / "generated").rglob("*") if p.is_file()}
    assert made == {"m_de.properties": b"# c\nsave={0} sichern\nname=Name\nempty=\n", "tips/t.html": b"<p>Tipp</p>\r\n"}
    assert call("package") == 0
    first = (tmp_path / "dist/localization.zip").read_bytes()
    assert call("package") == 0 and (tmp_path / "dist/localization.zip").read_bytes() == first
    assert set(nested_zip.verify_zip(nested_zip.verify_zip(first)["localization/lib/localization.jar"])) == {"META-INF/plugin.xml", "m_de.properties", "tips/t.html"}
    assert call("status") == 0 and json.loads(capsys.readouterr().out.splitlines()[-1])["workflow_state"] == "complete"
    # an edited file, or units that have changed, make what was generated invalid
    page = tmp_path / "generated/tips/t.html"
    page.write_bytes(b"<p>Tapp</p>\r\n")
    assert w.status()["workflow_state"] == "generate" and not w.status()["package"]["valid"]
    assert call("generate") == 0 and w.status()["workflow_state"] == "complete"
    w.commit(units=w.table("units").withColumn("target", F.when(F.col("context.key") == "name", "Titel").otherwise(F.col("target"))))
    assert not w.status()["generation"]["valid"] and call("package") == 1 and call("generate") == 0 and not w.status()["package"]["valid"]
    assert call("package") == 0 and w.status()["workflow_state"] == "complete"
    # a new version of the product carries what it can
    workspace(tmp_path, [("m.properties", b"save=Save {0}\nname=Names\n"), ("tips/t.html", b"<p>Tip</p>\r\n")])
    assert call("scan") == 0
    assert {(r.context.key, r.status) for r in w.table("units").collect()} == {("save", "technically_reviewed"), ("name", "open"), ("", "technically_reviewed")}
    assert sorted((r.context.key, r.reason) for r in w.table("stale_units").collect()) == [("empty", "removed_from_source"), ("name", "source_changed")]
    assert call("bogus") == 2


def test_blocking_batches_and_scans_in_flight(spark, tmp_path):
    workspace(tmp_path, [("m.properties", b"a=A {0}\nb=B\n")])
    call = lambda *a: main(["--root", str(tmp_path), *a], spark)
    assert call("scan") == 0 and call("next-batch", "--limit", "1") == 0
    batch = next((tmp_path / "batches").iterdir())
    assert call("scan") == 0  # nothing changes
    workspace(tmp_path, [("m.properties", b"a=A {0}\nb=B\nc=C\n")])
    assert call("scan") == 1  # another unit, while the batch is out
    rows = [json.loads(x) for x in batch.read_text().splitlines()]
    batch.write_bytes(jsonl.serialize([r | {"target": "{9} " + r["source"]} for r in rows]))
    assert call("import-batch", str(batch)) == 1  # imported, but a finding blocks
    assert call("import-batch", str(batch)) == 1 and Workspace(spark, tmp_path).checkpoint().completed_sequence == 1
    for bad in ({"preferred_terms": []}, {"other": {}}, {"preferred_terms": {"a": [1]}}):
        (tmp_path / "config/glossary.json").write_text(json.dumps(bad))
        assert call("validate") == 1
    product = json.loads((tmp_path / "config/product.json").read_text())
    (tmp_path / "config/product.json").write_text(json.dumps(product | {"until_build": "10.x"}))
    assert call("scan") == 1


def test_contents_of_kept_members_only(spark, tmp_path):
    p = archive(tmp_path / "o.zip", [("a.jar", jar([("x", b"1"), ("y", b"2" * 10), ("z", b"3")])), ("b.jar", jar([("x", b"4")]))])
    kept = spark.createDataFrame([("a.jar", 2), ("a.jar", 0)], "container string, ordinal int")
    assert sorted((r.container, r.path, r.ordinal, bytes(r.content), r.error) for r in nested_zip.read_contents(kept, p).collect()) == [("a.jar", "x", 0, b"1", None), ("a.jar", "z", 2, b"3", None)]
    out = inventory.scan(spark, archive(tmp_path / "p.zip", [("a.jar", jar([("m.properties", b"k=1"), ("n.properties", b"k=1"), ("A.class", b"no")]))]), ScanRules(), with_contents=True)
    assert [bytes(r.content) for r in out[3].collect()] == [b"k=1"]


def test_checkpoint_rules():
    with pytest.raises(QueueError):
        queue.Checkpoint(1, 3, "3-a.jsonl", ["a"], "d")
    with pytest.raises(QueueError):
        queue.Checkpoint(1, 2, None, ["a"], "d")
    c = queue.Checkpoint(1, 2, "2-a.jsonl", ["a"], "d" * 64)
    assert queue.Checkpoint.from_dict(c.to_dict()) == c
    good = c.to_dict()
    odd = [{"counts": {"exported": 2}}, {"counts": {"exported": True}}, {"next_command": "next-batch"}, {"batch_digest": "d"}, {"batch_digest": "D" * 64}, {"unit_ids": "a"}, {"unit_ids": ["a", ""]}, {"unit_ids": ["a", 1]}, {"more": 1}, {"current_sequence": "2"}, {"completed_sequence": True}]
    for bad in [good | o for o in odd] + [{k: v for k, v in good.items() if k != n} for n in good] + [[good], None]:
        with pytest.raises(QueueError):
            queue.Checkpoint.from_dict(bad)


@pytest.mark.parametrize("limit", [True, 0, -1, 1001, "1"])
def test_limits(spark, limit):
    with pytest.raises(QueueError):
        queue.open_units(spark.createDataFrame([], "id string, status string"), limit)


def test_strict_jsonl(spark, tmp_path):
    kind = "id string, n bigint, tags array<string>, sub struct<a:boolean>"
    good = '{"id":"b","n":1,"tags":["x"],"sub":{"a":true}}'
    f = tmp_path / "t.jsonl"
    f.write_text(good + "\n" + good.replace('"b"', '"a"') + "\n")
    df = jsonl.read_jsonl(spark, str(f), kind)
    assert [r.line for r in jsonl.canonical_lines(df).orderBy("id").collect()] == [jsonl.canonical(json.loads(x)) for x in (good.replace('"b"', '"a"'), good)]
    jsonl.write_jsonl(df, str(tmp_path / "out.gz"))
    assert spark.read.text(str(tmp_path / "out.gz")).count() == 2
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), kind).count() == 0
    for bad in (good.replace("1", "1.0"), good.replace("1", "true"), good.replace('"n":1', '"n":null'), good.replace("{", '{"z":1,', 1), good.replace('"n":1', '"n":1,"n":2'), good.replace("1", "NaN"), "[]", "{", good + "\n" + good, good.replace('"b"', '""')):
        f.write_text(bad + "\n")
        with pytest.raises(Exception) as e:
            jsonl.read_jsonl(spark, str(f), kind).collect()
        assert isinstance(e.value, StateError) or "StateError" in str(e.value), bad


def test_publishing(spark, tmp_path):
    root = tmp_path / "tree"
    assert publish.write_tree(root, {"a/b": b"1"}) and not publish.write_tree(root, {"a/b": b"1"}) and publish.write_tree(root, {"c": b"2"})
    assert [p.name for p in root.iterdir()] == ["c"]
    for bad in ("../x", "/x", "a\\b"):
        with pytest.raises(OutputPathError):
            publish.safe_path(root, bad)
    v = publish.Versions(tmp_path / "v")
    v.publish({"t": spark.range(3)})
    (tmp_path / "v/v-broken").mkdir()
    v.recover()
    assert spark.read.parquet(str(v.current() / "t")).count() == 3 and len(list((tmp_path / "v").glob("v-*"))) == 1
    data = nested_zip.zip_bytes({"b": b"2", "a": b"1"})
    assert nested_zip.verify_zip(data) == {"a": b"1", "b": b"2"}
    with pytest.raises(PackageError):
        nested_zip.verify_zip(jar([("a", b"1")]))
    assert publish.state_digest({"t": spark.range(5)}) == publish.state_digest({"t": spark.range(5).repartition(3)}) != publish.state_digest({"t": spark.range(6)})


def test_state_digest_in_levels(spark, monkeypatch):
    monkeypatch.setattr(publish, "LEAF", 1)
    rows = [(i % 700, f"t{i % 700}") for i in range(900)]
    df = spark.createDataFrame(rows, "id int, text string")
    same = publish.state_digest({"t": df})
    assert same == publish.state_digest({"t": spark.createDataFrame(rows[::-1], df.schema).repartition(5)})
    assert same != publish.state_digest({"t": df.dropDuplicates()}) and same != publish.state_digest({"u": df})
    assert publish.state_digest({"t": df.where("id < 0")}) == publish.state_digest({"t": df.limit(0)})


def test_files_written_together(tmp_path, monkeypatch):
    publish.write_together(tmp_path, {"a": b"1", "b": b"2"})
    write = publish.write_bytes

    def cut_short(path, data):
        if path.name == "b":
            raise OSError("no power")
        write(path, data)

    monkeypatch.setattr(publish, "write_bytes", cut_short)
    with pytest.raises(OSError):
        publish.write_together(tmp_path, {"a": b"3", "b": "ä".encode()})
    assert (tmp_path / publish.PENDING).exists() and (tmp_path / "b").read_bytes() == b"2"
    monkeypatch.undo()
    publish.finish(tmp_path)
    publish.finish(tmp_path)
    assert (tmp_path / "a").read_bytes() == b"3" and (tmp_path / "b").read_text("utf-8") == "ä" and not (tmp_path / publish.PENDING).exists()


def test_descriptors_and_packages():
    template = '<p><id>{{id}}</id><r since="{{since}}"/><n><![CDATA[{{n}}]]></n></p>'
    fill = lambda **v: (publish.fill_descriptor(template, v), template, v)
    publish.verify_descriptor(*fill(id="x", since="1", n="<ul>]]> & </ul>"))
    for bad in ({"id": "x</id><id>y", "since": "1", "n": ""}, {"id": "x", "since": '1" more="2', "n": ""}, {"id": "<", "since": "1", "n": ""}):
        with pytest.raises(PackageError):
            publish.verify_descriptor(*fill(**bad))
    files = {"a/b": b"1"}
    data = publish.package(files, "l", "<p/>")
    publish.verify_package(data, "l", files, "<p/>")
    for wrong in ((data, "m", files, "<p/>"), (data, "l", {"a/b": b"2"}, "<p/>"), (data, "l", files, "<q/>"), (data[:-1], "l", files, "<p/>")):
        with pytest.raises(PackageError):
            publish.verify_package(*wrong)


def test_locks(spark, tmp_path):
    w, again = Workspace(spark, tmp_path), Workspace(spark, tmp_path)
    with w.locked(), again.locked(), again.locked(shared=True):
        pass
    with w.locked(shared=True), again.locked(shared=True):
        with pytest.raises(EngineError), again.locked():
            pass
    with w.locked():  # free again
        pass


def test_exchange_files(spark, tmp_path):
    kind = "id string, n bigint"
    df = spark.createDataFrame([("b", 1), ("a", 2)], kind)
    for name in ("x.jsonl", "y.jsonl.gz"):
        jsonl.write_file(df, tmp_path / name)
        first = (tmp_path / name).read_bytes()
        jsonl.write_file(df.repartition(2), tmp_path / name)
        assert (tmp_path / name).read_bytes() == first
    assert (tmp_path / "x.jsonl").read_text() == '{"id":"a","n":2}\n{"id":"b","n":1}\n' and not list(tmp_path.glob(".*"))
    assert jsonl.records((tmp_path / "x.jsonl").read_bytes(), "x", kind) == [{"id": "a", "n": 2}, {"id": "b", "n": 1}] and jsonl.records(b"", "x", kind) == []
    for bad in (b'{"id":"a","n":2}\n\n', b'{"id":"a","n":2}\n{"id":"a","n":3}\n', b'{"id":"a"}\n', b"\xff\n"):
        with pytest.raises(StateError, match="x:"):
            jsonl.records(bad, "x", kind)
    both = jsonl.read_together(spark, str(tmp_path), {"x": kind, "y": kind})
    assert both["x"].exceptAll(both["y"]).isEmpty() and both["x"].count() == both["y"].count() == 2
    assert jsonl.read_together(spark, str(tmp_path / "none"), {"x": kind})["x"].isEmpty()
    with pytest.raises(StateError):
        jsonl.read_together(spark, str(tmp_path), {"x": kind, "z": kind})


def test_archives_that_change(spark, tmp_path):
    path = archive(tmp_path / "p.zip", [("lib/a.jar", jar([("m.properties", b"a=b\n")]))])
    seen = nested_zip.identity(path)
    assert nested_zip.read_members(spark, path, seen=seen).count() == 1
    archive(tmp_path / "p.zip", [("lib/a.jar", jar([("m.properties", b"a=bc\n")]))])
    with pytest.raises(SourceError):
        nested_zip.outer_members(path, seen)
    with pytest.raises(Exception, match="has changed"):
        nested_zip.read_contents(spark.createDataFrame([("lib/a.jar", 0)], "container string, ordinal int"), path, seen).collect()
    with pytest.raises(Exception, match="has changed"):
        nested_zip.read_members(spark, path, seen=seen).collect()


def test_case_folding(spark):
    paths = ["a/Maße", "A/MASSE", "k", "\u212a", "ς", "Σ", "only", ""]
    got = render.case_clashes(spark.createDataFrame([(p,) for p in [*paths, None]], "p string"), "p").collect()
    want = {f: sorted(p for p in paths if p.casefold() == f) for f in {p.casefold() for p in paths}}
    assert {r.folded: r.paths for r in got} == {f: v for f, v in want.items() if len(v) > 1}


def test_notes():
    assert report.change_notes("## 2\n- b\n## 1\n* a < c\n", "1") == "<ul><li>a &lt; c</li></ul>"
    for text, version in (("## 1\n", "1"), ("## 1\n- a\n", "2"), ("## 1\nprose\n", "1")):
        with pytest.raises(ChangelogError):
            report.change_notes(text, version)


def test_render_refuses(spark):
    with pytest.raises(EngineError):
        render.render_whole_file(b"a\r\nb\n", "x", "t.html")
    with pytest.raises(EngineError):
        render.render_whole_file(b"<a/>", "<a", "t.xml")
    assert render.render_whole_file("﻿a\n".encode(), "b", "t.html") == "﻿b\n".encode()


def test_streamed_validation(spark, tmp_path):
    from tessella.streaming.queue import validated

    spark.createDataFrame([("1", "{0}", "{1}"), ("2", "a", "b")], "id string, source string, target string").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("id string, source string, target string").parquet(str(tmp_path / "in"))
    q = validated(s).writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r.id, r.status) for r in spark.table("seen").collect()) == [("1", "translated"), ("2", "technically_reviewed")]


def _plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or v != v:
        return None
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.SQL[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    rows = lambda d: sorted(repr([_plain(v) for v in r]) for r in d[cols].astype(object).itertuples(index=False))
    assert rows(got) == rows(want)


def test_blobs(spark, tmp_path):
    import hashlib

    from tessella.sources import blobs

    for data in (b"a", b"", b"bcd"):
        (tmp_path / hashlib.sha256(data).hexdigest()).write_bytes(data)
    b = blobs.read_blobs(spark, str(tmp_path))
    assert sorted(bytes(r.content) for r in b.collect()) == [b"", b"a", b"bcd"]
    res = b.select(F.lit("r").alias("resource_id"), "source_sha256", F.when(F.col("size") == 3, 4).otherwise(F.col("size")).alias("size"))
    assert sorted(r.content is None for r in blobs.attach(res, b).collect()) == [False, False, True]
    (tmp_path / ("0" * 64)).write_bytes(b"x")
    with pytest.raises(Exception, match="wrong content"):
        blobs.read_blobs(spark, str(tmp_path)).collect()


def test_imports_once(spark, tmp_path):
    from tessella.streaming.queue import import_into

    v = publish.Versions(tmp_path / "state")
    v.publish({"units": spark.createDataFrame([("1", "a"), ("2", "b")], "id string, target string")})
    spark.createDataFrame([("2", "x"), ("9", "y")], "id string, target string").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        s = spark.readStream.schema("id string, target string").parquet(str(tmp_path / "in"))
        import_into(str(tmp_path / "state"), str(tmp_path / "cp"), s).awaitTermination(60)
    assert sorted(tuple(r) for r in spark.read.parquet(str(v.current() / "units")).collect()) == [("1", "a"), ("2", "x")]
    # no generation yet, and a batch that repeats an id
    spark.createDataFrame([("2", "a"), ("2", "b")], "id string, target string").write.parquet(str(tmp_path / "twice"))
    for state, want in (("fresh", []), ("state", [("1", "a"), ("2", "b")])):
        s = spark.readStream.schema("id string, target string").parquet(str(tmp_path / "twice"))
        (tmp_path / "state" / v.current().name / "batch_id").unlink(missing_ok=True)
        import_into(str(tmp_path / state), str(tmp_path / f"cp-{state}"), s).awaitTermination(60)
        assert sorted(tuple(r) for r in spark.read.parquet(str(publish.Versions(tmp_path / state).current() / "units")).collect()) == want

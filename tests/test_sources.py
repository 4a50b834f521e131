import io
import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from cantorel.sources import api, files, sinks


def test_paging_and_retries():
    answers = {"u?q=1": {"continue": {"cm": "2"}}, "u?q=1&cm=2": {"query-continue": {"x": {"cm": "3"}}}, "u?q=1&cm=3": {}}
    assert len(list(api.pages("u", {"q": "1"}, answers.__getitem__))) == 3
    with pytest.raises(api.PagedError):
        list(api.pages("u", {}, lambda _: {"continue": {"cm": "2"}}))
    with pytest.raises(api.PagedError):
        n = iter(range(100))
        list(api.pages("u", {}, lambda _: {"continue": {"cm": str(next(n))}}, most=5))
    waits, left = [], [urllib.error.HTTPError("u", 429, "", {"Retry-After": "7"}, None), urllib.error.HTTPError("u", 503, "", {}, None), None]

    def opened(url, timeout):
        e = left.pop(0)
        if e:
            raise e
        return io.BytesIO(b'{"a": 1}')

    assert api.fetch("u", opened=opened, sleep=waits.append) == {"a": 1} and waits == [7.0, 2.0]
    with pytest.raises(urllib.error.HTTPError):
        api.fetch("u", opened=lambda *a, **k: (_ for _ in ()).throw(urllib.error.HTTPError("u", 404, "", {}, None)), sleep=waits.append)


def test_api_relations(spark):
    body = lambda q: json.dumps({"query": q})
    df = lambda *qs: spark.createDataFrame([("For guitar", i, body(q)) for i, q in enumerate(qs)], "key string, page int, body string")
    rows, bad = api.members(df({"categorymembers": [{"ns": 0, "pageid": 1, "title": "A"}]}, {"categorymembers": [{"ns": 0, "pageid": 1, "title": "A"}, {"ns": 0, "pageid": 2, "title": "B"}]}))
    assert sorted(tuple(r) for r in rows.collect()) == [("For guitar", 1, "A"), ("For guitar", 2, "B")] and bad.count() == 0
    listed, bad = api.all_categories(df({"allcategories": [{"category": "For+guitar", "size": 0, "pages": 0, "files": 0, "subcats": 0}, {"category": "For+guitar", "size": 2, "pages": 2, "files": 0, "subcats": 0}, {"category": "Gone", "size": -1, "pages": 0, "files": 0, "subcats": 0}]}))
    assert [tuple(r) for r in listed.collect()] == [("For guitar", 2, 2, 0, 0)] and bad.count() == 0
    info = api.category_info(spark.createDataFrame([("a",), ("b",), ("c",)], "name string"), df({"pages": [{"title": "Category:a", "categoryinfo": {"pages": 0, "files": 0, "subcats": 0}}, {"title": "Category:b", "missing": True}]}))
    assert {r.name: (r.missing, r.page_count) for r in info.collect()} == {"a": (False, 0), "b": (True, None), "c": (True, None)}
    rev = api.revisions(df({"pages": [{"pageid": 1, "title": "A", "revisions": [{"revid": 9, "slots": {"main": {"content": "x"}}}]}]}))
    assert [tuple(r) for r in rev.collect()] == [(1, "A", 9, "x")]
    meta = api.file_metadata(df({"pages": [{"pageid": 5, "title": "File:a.pdf", "imageinfo": [{"url": "u", "size": 3, "sha1": "s", "mime": "m", "extmetadata": {"LicenseShortName": {"value": "PD"}}}]}]}))
    assert (meta.first().filename, meta.first().license, meta.first().file_id) == ("a.pdf", "PD", "5")
    got = api.batches(spark.range(120), "id", 50).orderBy("batch").collect()
    assert [len(r["keys"]) for r in got] == [50, 50, 20]


def test_files_and_sinks(spark, tmp_path):
    p = f"{tmp_path}/doc.json"
    sinks.write_json(spark, p, {"schema_version": 2, "b": 1, "a": "é"})
    assert open(p).read() == '{\n  "a": "é",\n  "b": 1,\n  "schema_version": 2\n}\n'
    with pytest.raises(files.ManifestError):
        sinks.write_json(spark, p, {"schema_version": 1})
    with pytest.raises(FileExistsError):
        sinks.write_json(spark, p, {"schema_version": 3}, once=True)
    assert files.unexpected_keys(spark, p, {"a", "b", "schema_version"}).count() == 0
    assert files.unexpected_keys(spark, p, {"a", "c"}).first().missing == ["c"]
    (tmp_path / "m.json").write_text('{"schema_version": 1, "model_type": "Work", "items": [{"id": "1"}, {"id": "2"}]}')
    assert files.read_manifest(spark, f"{tmp_path}/m.json", "Work", "id: string").count() == 2
    with pytest.raises(files.ManifestError):
        files.read_manifest(spark, f"{tmp_path}/m.json", "Other", "id: string")
    (tmp_path / "log.csv").write_text("﻿filename,status\na.pdf,ok\n")
    assert files.read_status_log(spark, f"{tmp_path}/log.csv").columns == ["filename", "status"]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/12.wiki").write_text("a\nb")
    assert [tuple(r) for r in files.read_pages(spark, f"{tmp_path}/pages").collect()] == [("12", "a\nb")]
    (tmp_path / "o/x").mkdir(parents=True)
    (tmp_path / "o/x/a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "o/x/b.pdf").write_bytes(b"<html>")
    assert sorted((r.path.rpartition("/")[2], r.is_pdf, r.size) for r in files.hashed_tree(spark, f"{tmp_path}/o").collect()) == [("a.pdf", True, 10), ("b.pdf", False, 6)]
    empty = spark.createDataFrame([], "a string")
    assert files.optional(lambda: spark.read.json(f"{tmp_path}/none"), empty).count() == 0
    links = files.file_links(spark.createDataFrame([("1", '<a href="/Special:ImagefromIndex/7"> <a href="x/images/a/b.pdf">')], "page_id string, html string"))
    assert [tuple(r) for r in links.collect()] == [("1", "7", "a/b.pdf")]


def test_objects_are_stored_kept_repaired_and_refused(spark, tmp_path):
    from cantorel.session import ship

    ship(spark)
    df = spark.createDataFrame([("a", b"%PDF-1"), ("b", b"%PDF-1"), ("c", b"%PDF-2"), ("d", b"<html>")], "path string, content binary")
    run = lambda: {r.sha256: (r.object_path, r.outcome) for r in sinks.write_objects(df, f"file://{tmp_path}", "%PDF-").collect()}
    first = run()
    assert sorted(o for _, o in first.values()) == ["refused", "stored", "stored"]
    paths = [p for p, o in first.values() if o == "stored"]
    assert sorted((tmp_path / p).read_bytes() for p in paths) == [b"%PDF-1", b"%PDF-2"]
    (tmp_path / paths[0]).write_bytes(b"broken")
    assert sorted(o for _, o in run().values()) == ["kept", "refused", "repaired"]
    assert sorted((tmp_path / p).read_bytes() for p in paths) == [b"%PDF-1", b"%PDF-2"]
    assert [p.read_bytes() for p in (tmp_path / "quarantine").iterdir()] == [b"broken"]


def test_catalogue_is_required_and_aliases_are_not(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"schema_version": 1, "works": [{"id": "1"}, {"id": "2"}]}')
    (tmp_path / "d.json").write_text('{"schema_version": 2, "works": []}')
    (tmp_path / "a.json").write_text('{"composers": {"Bach": ["JSB", "Bach J"]}, "works": {"2": ["x"]}}')
    (tmp_path / "b.json").write_text("{broken")
    assert sorted(r.id for r in files.read_catalogue(spark, f"{tmp_path}/c.json", "id: string").collect()) == ["1", "2"]
    with pytest.raises(files.ManifestError):
        files.read_catalogue(spark, f"{tmp_path}/d.json", "id: string")
    composers, works = files.read_aliases(spark, f"{tmp_path}/a.json")
    assert sorted(map(tuple, composers.collect())) == [("Bach", "Bach J"), ("Bach", "JSB")] and [tuple(r) for r in works.collect()] == [("2", "x")]
    for name in ("b.json", "none.json"):
        assert [df.count() for df in files.read_aliases(spark, f"{tmp_path}/{name}")] == [0, 0]


def test_status_log_is_appended(spark, tmp_path):
    row = spark.createDataFrame([tuple("x" for _ in sinks.STATUS_COLUMNS)], ", ".join(f"{c} string" for c in sinks.STATUS_COLUMNS)).withColumn("more", F.lit(1))
    for _ in range(2):
        sinks.append_status(row, f"{tmp_path}/log")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 2


def test_markdown(spark):
    works = spark.createDataFrame([("Bach [J]", "B*", "https://x/a b"), ("Bach [J]", "A", "u")], "composer string, title string, url string")
    assert sinks.grouped_markdown(works).first().markdown == "### Bach \\[J\\]\n\n- [A](<u>)\n- [B\\*](<https://x/ab>)\n"


def test_rendering(spark):
    works = spark.createDataFrame([("1", "Bach", "A <b>", "u", 1), ("2", "Bach", "B", "v", 2)], "work_id string, composer string, title string, url string, ord int")
    man = spark.createDataFrame([("1", f"p{i}", i) for i in range(10)], "work_id string, relative_path string, ord int")
    csv = {r.work_id: r for r in sinks.csv_catalogue(works, man, ["work_id", "paths", "files"]).collect()}
    assert csv["1"].paths.startswith("p0 | p1") and csv["2"].files == 0
    rows = {r.work_id: r for r in sinks.search_rows(works, man.withColumnRenamed("relative_path", "path")).collect()}
    assert len(rows["1"].files) == 8 and rows["1"].file_total == 10 and rows["2"].file_total == 0
    assert sinks.grouped_html(works).first().html.count("<li>") == 2 and "&lt;b&gt;" in sinks.grouped_html(works).first().html
    assert sinks.embedded_json(spark.createDataFrame([("</script>",)], "x string")).first().value == '{"x":"<\\/script>"}'
    objects = sinks.store_objects(spark.createDataFrame([("a", b"x"), ("b", b"x"), ("c", b"y")], "path string, content binary"))
    assert sorted(r.sources for r in objects.collect()) == [["a", "b"], ["c"]]
    cats = spark.createDataFrame([(0, "a", "b", "c", "d")], "id int, name string, name_zh string, family string, kind string")
    doc = json.loads(sinks.catalogue_document(works, cats, works.agg(F.count("*").alias("works"))).first().value)
    assert doc["summary"]["works"] == 2 and [w["work_id"] for w in doc["works"]] == ["1", "2"]

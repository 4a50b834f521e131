import gzip
import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from cantorel.llm import warczip as wz

PAGES = "page_id long, url string, html string, digest string"


def test_round_trip(spark):
    big = "<p>é" * 400
    pages = [(1, "http://a/\nb", big), (2, "u", big), (9, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, "u", big), (9, "v", big), (7, "w", "x" * 999), (8, "w", "x" * 999)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], PAGES).repartition(3)
    manifest = wz.write_archives(df, archive_bytes=300)
    assert manifest.count() > 1
    got = wz.read_archives(manifest).collect()
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        other = h == big and i != 9
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if other else "response", 9 if other else None, None if other else raw))
    key = lambda x: repr(x)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)


def test_equal_payloads_without_ids_are_responses(spark):
    df = spark.createDataFrame([(None, "u", "y" * 2000, "")] * 2, PAGES)
    assert [r.record_type for r in wz.read_archives(wz.write_archives(df)).collect()] == ["response"] * 2


def test_empty(spark):
    assert wz.read_archives(wz.write_archives(spark.createDataFrame([], PAGES))).count() == 0


def source(data):
    return pa.PythonFile(io.BytesIO(data), mode="r") if not isinstance(data, bytes) else pa.BufferReader(data)


def records(n=3):
    return [(wz.record(i, "u", f"payload {i}".encode(), hashlib.sha1(f"payload {i}".encode()).hexdigest(), None, "2020-01-01T00:00:00Z"), {"key": str(i)}) for i in range(n)]


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)  # so that the writer uses 64-bit fields and records
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = wz.archive(records())
    assert b"PK\x06\x07" in data and b"PK\x06\x06" in data
    f = source(data)
    assert [wz.parse_record(f.read_at(n, a))["payload"] for a, n in wz.places(f)] == [b"payload 0", b"payload 1", b"payload 2"]


def test_archives_of_others(tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}")
        z.writestr("archive/one.warc.gz", b"".join(r for r, _ in records(4)))
        z.comment = b"a comment PK\x05\x06 with a signature in it"
    f = source(out.getvalue())
    assert [wz.parse_record(f.read_at(n, a))["page_id"] for a, n in wz.places(f)] == [0, 1, 2, 3]


@pytest.mark.parametrize("data", [b"", b"not a zip", b"PK\x05\x06" + b"\xff" * 16 + b"\0\0"])
def test_broken_archives_are_errors(data):
    with pytest.raises(ValueError):
        list(wz.places(source(data)))


def test_compressed_members_and_wrong_digests_are_errors():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a.warc.gz", b"x" * 100)
    with pytest.raises(ValueError):
        list(wz.places(source(out.getvalue())))
    with pytest.raises(ValueError):
        wz.parse_record(wz.record(1, "u", b"x", "0" * 40, None, "d"))


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "/").replace("_gz", ".gz").replace("_warc", ".warc").replace("_cdxj", ".cdxj"), data)
    return source(out.getvalue())


def ids(f):
    return [wz.parse_record(f.read_at(n, a))["page_id"] for a, n in wz.places(f)]


def test_plain_warcs_and_partial_indexes():
    packed = [r for r, _ in records(4)]
    assert ids(zipped(archive__a_warc=b"".join(map(gzip.decompress, packed)))) == [0, 1, 2, 3]
    line = lambda k, name="a.warc.gz": f'k {{"offset": {sum(map(len, packed[:k]))}, "length": {len(packed[k])}, "filename": "{name}"}}\n'
    for held in ((1,), (0, 3), (2, 1), (1, 1)):
        assert ids(zipped(archive__a_warc_gz=b"".join(packed), indexes__i_cdxj="".join(map(line, held)))) == [0, 1, 2, 3]
    bad = [
        {"archive__a_warc_gz": packed[0], "indexes__i_cdxj": line(0, "b.warc.gz")}, {"archive__a_txt": b"x"}, {"archive__a_warc": b"no record"}, {"archive__a_warc_gz": packed[0][:-9]},
        {"archive__a_warc_gz": packed[0], "indexes__i_cdxj": line(0) + '{"offset": 3, "length": 9, "filename": "a.warc.gz"}'}, {"archive__a_warc": gzip.decompress(packed[0])[:-9]},
    ]
    for members in bad:
        with pytest.raises(ValueError):
            list(wz.places(zipped(**members)))


def test_neighbours_are_read_together():
    got = list(wz._together(["a", "a", "a", "b", "b"], [0, 10, 10 + wz._NEAR + 20, 0, 5], [10, 10, 5, 5, wz._AT_ONCE]))
    assert got == [("a", 0, 20, [0, 1]), ("a", 30 + wz._NEAR, 35 + wz._NEAR, [2]), ("b", 0, 5, [3]), ("b", 5, 5 + wz._AT_ONCE, [4])]


def test_only_archives_of_ended_tasks_are_in_the_folder(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", "z" * 50, "") for i in range(30)], PAGES).repartition(4)
    folder = f"file://{tmp_path}/out"
    manifest = wz.write_archives(df, folder, archive_bytes=400)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(r.path.rpartition("/")[2] for r in manifest.collect())
    assert [p.name for p in tmp_path.iterdir()] == ["out"] and wz.read_archives(manifest).count() == 30

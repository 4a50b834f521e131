"""Web archives packed in ZIP files: a writer, and a reader that range-reads records in place.

An archive holds ``archive/data.warc.gz`` and ``indexes/index.cdxj``, both stored, so that a
record's bytes are at (member's data + the index's offset). The reader parses the end
record, the ZIP64 locator and directory where there are any, and the central directory, and
then reads single records; nothing is extracted.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantorel.llm.kernels import chunks
from cantorel.llm.storage import delete, drop, materialize, scratch_path, ship

#: Compressed bytes after which an archive is closed and another begun.
ARCHIVE_BYTES = 16 << 20
#: Payloads below this are never revisits.
REVISIT_BYTES = 1000
_END, _LOCATOR, _END64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
_GZIP = b"\x1f\x8b"
#: Records of one archive that lie this near to each other are read at once, up to so many bytes.
_NEAR, _AT_ONCE = 1 << 16, 4 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_path(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


@dataclass(frozen=True)
class Member:
    """A file in a ZIP archive: its name, size, method, and where its local header is."""

    name: str
    size: int
    method: int
    header: int


class ZipDirectory:
    """The central directory of an open random-access file, and the places of stored members' data."""

    def __init__(self, source: pa.NativeFile):
        self.source, self.size = source, source.size()
        self.members = {m.name: m for m in self._entries(*self._directory())}

    def _at(self, offset: int, n: int) -> bytes:
        if offset < 0 or offset + n > self.size:
            raise ValueError(f"ZIP structure outside the file at {offset}")
        return self.source.read_at(n, offset)

    def _directory(self) -> tuple[int, int, int]:
        """(entries, bytes, offset) of the central directory."""
        n = min(self.size, 22 + 0xFFFF)
        tail = self._at(self.size - n, n)
        at = tail.rfind(_END)
        while at >= 0 and (at + 22 > n or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != n):
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no ZIP end record")
        entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
        end = self.size - n + at
        if end >= 20 and self._at(end - 20, 4) == _LOCATOR:
            (end64,) = struct.unpack_from("<Q", self._at(end - 20, 20), 8)
            record = self._at(end64, 56)
            if record[:4] != _END64:
                raise ValueError("no ZIP64 end record where its locator points")
            entries, length, offset = struct.unpack_from("<QQQ", record, 32)
        elif 0xFFFF == entries or 0xFFFFFFFF in (length, offset):
            raise ValueError("ZIP64 archive without locator")
        return entries, length, offset

    def _entries(self, entries: int, length: int, offset: int) -> Iterator[Member]:
        data, at = self._at(offset, length), 0
        for _ in range(entries):
            if data[at : at + 4] != _ENTRY:
                raise ValueError("broken ZIP central directory")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed, size, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
            (header,) = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            k, stop = at + 46 + n_name, at + 46 + n_name + n_extra
            while k + 4 <= stop:
                kind, n = struct.unpack_from("<HH", data, k)
                if kind == 1:  # 64-bit values of those fields that are all ones, in this order
                    wide = list(struct.unpack_from(f"<{n // 8}Q", data, k + 4))
                    size = wide.pop(0) if size == 0xFFFFFFFF else size
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    header = wide.pop(0) if header == 0xFFFFFFFF else header
                k += 4 + n
            yield Member(name, size, method, header)
            at = stop + n_comment

    def data_offset(self, member: Member) -> int:
        """Where a stored member's bytes start."""
        if member.method != 0:
            raise ValueError(f"{member.name} is compressed, not stored")
        local = self._at(member.header, 30)
        if local[:4] != _LOCAL:
            raise ValueError(f"no local header for {member.name}")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        return member.header + 30 + n_name + n_extra

    def read(self, member: Member) -> bytes:
        return self._at(self.data_offset(member), member.size)


def _line(s: str | None) -> str:
    """A header value: control characters percent-encoded, so that it stays one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in s or "")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One gzip member with a response record, or a revisit record without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"Refers-To-Page-ID: {refers_to}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 1, mtime=0)


def parse_record(packed: bytes) -> dict:
    """Headers and payload of one record, compressed or not; the payload of a response is checked against its digest."""
    raw = gzip.decompress(packed) if packed[:2] == _GZIP else packed
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError("no WARC record at the given place")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    sent = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    digest, revisit = fields.get("warc-payload-digest", "").removeprefix("sha1:"), fields["warc-type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields.get('warc-record-id')} doesn't match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("page-id"), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "payload_digest": digest,
        "payload_bytes": int(sent["content-length"]) if revisit else len(payload), "refers_to": number("refers-to-page-id"), "payload": None if revisit else payload,
    }


def archive(records: list[tuple[bytes, dict]]) -> bytes:
    """A ZIP file of gzip members and their index."""
    warc, index = io.BytesIO(), []
    for packed, about in records:
        index.append(f"{about['key']} {json.dumps(about | {'offset': warc.tell(), 'length': len(packed), 'filename': 'data.warc.gz'})}\n")
        warc.write(packed)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in (("archive/data.warc.gz", warc.getvalue()), ("indexes/index.cdxj", "".join(index).encode())):
            z.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


def _write(folder: str, date: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_path(folder)
        fs.create_dir(base, recursive=True)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        held: list[tuple[bytes, dict]] = []
        closed = 0

        def close() -> pa.RecordBatch:
            with fs.open_output_stream(f"{base}/{name}-{closed:05d}.wacz") as f:
                f.write(archive(held))
            out = pa.RecordBatch.from_pydict({"path": [f"{name}-{closed:05d}.wacz"], "records": [len(held)]})
            held.clear()
            return out

        n = 0
        for whole in batches:
            for batch in chunks(whole, "html", 4 << 20):
                for r in batch.to_pylist():
                    payload = (r["html"] or "").encode()
                    packed = record(r["page_id"], r["url"], payload, r["digest"], r["refers_to"], date)
                    held.append((packed, {"key": "null" if r["page_id"] is None else str(r["page_id"]), "digest": r["digest"]}))
                    n += len(packed)
                    if n >= size:
                        yield close()
                        closed, n = closed + 1, 0
        if held:
            yield close()

    return run


def _commit(drafts: str, folder: str):
    """Move the archives of tasks that ended well into place; one that is there already was moved before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_path(folder)
        source = open_path(drafts)[1]
        fs.create_dir(base, recursive=True)
        for batch in batches:
            names = batch.column("path").to_pylist()
            for name in names:
                if fs.get_file_info(f"{base}/{name}").type == pafs.FileType.NotFound:
                    fs.move(f"{source}/{name}", f"{base}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}" for name in names], pa.string()), batch.column("records")], ["path", "records"])

    return run


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a WARC record for every row into archives of about ``archive_bytes``; returns (path, records).

    Of rows with equal payloads of REVISIT_BYTES or more, those with the largest id are
    responses and the others revisits of it; where no id is not null, all are responses. Null
    payloads are empty. The archives go to ``folder`` (a new one in the shared folder by
    default), written by the executors beside it and moved there once all tasks have ended well:
    what a lost or repeated task leaves is never in the folder, and is deleted. An empty table
    makes no archive. Columns of any other name are not read.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "archives")
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = rows.filter(F.octet_length("html") >= REVISIT_BYTES)
    first = large.groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).filter((F.col("n") > 1) & F.col("kept").isNotNull())
    first = materialize(first.select("digest", "kept"), "responses")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    marked = rows.join(first, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    # on the file system of the folder, as archives are moved
    drafts = f"{folder.rstrip('/')}.drafts-{uuid.uuid4().hex[:12]}/d"
    written = materialize(marked.mapInArrow(_write(drafts, date, archive_bytes), _MANIFEST), "written")
    out = materialize(written.mapInArrow(_commit(drafts, folder), _MANIFEST), "manifest")
    drop(first)
    drop(written)
    delete(spark, drafts)
    return out


_MANIFEST = "path string, records long"
_PLACES = "path string, offset long, length long"
_RECORDS = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def _scan(z: ZipDirectory, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Places of the records between two places of a WARC, compressed one by one or plain."""
    at = start
    while at < end:
        if z._at(at, min(2, end - at)) == _GZIP:
            d, fed = zlib.decompressobj(31), at
            while not d.eof:
                block = z._at(fed, min(1 << 16, end - fed))
                if not block:
                    raise ValueError("cut-off gzip member")
                d.decompress(block)
                fed += len(block)
            n = fed - at - len(d.unused_data)
        else:
            head = z._at(at, min(1 << 16, end - at)).partition(b"\r\n\r\n")[0]
            size = re.search(rb"(?im)^content-length:\s*([0-9]+)\s*$", head)
            if not head.startswith(b"WARC/1.") or not size:
                raise ValueError(f"no WARC record at {at}")
            n = len(head) + 4 + int(size[1]) + 4
            if at + n > end:
                raise ValueError("cut-off WARC record")
        yield at, n
        at += n


def places(source: pa.NativeFile) -> Iterator[tuple[int, int]]:
    """(offset in the file, length) of every record of an archive, in order.

    Records are found by the indexes, and by scanning what no index covers. A member below
    ``archive/`` that is no WARC, an index that names none, and places that overlap are errors.
    """
    z = ZipDirectory(source)
    held = {m.name.rpartition("/")[2]: m for m in z.members.values() if m.name.startswith("archive/") and not m.name.endswith("/")}
    for name in held:
        if not name.endswith((".warc.gz", ".warc")):
            raise ValueError(f"archive/{name} is no WARC")
    known: dict[str, set[tuple[int, int]]] = {name: set() for name in held}
    for m in z.members.values():
        if m.name.startswith("indexes/") and ".cdx" in m.name:
            data = z.read(m)
            for line in (gzip.decompress(data) if m.name.endswith(".gz") else data).splitlines():
                if b"{" not in line:
                    continue
                about = json.loads(line[line.index(b"{") :])
                if about["filename"] not in known:
                    raise ValueError(f"an index names {about['filename']}, which is not in the archive")
                known[about["filename"]].add((int(about["offset"]), int(about["length"])))
    for name, m in held.items():
        base, at = z.data_offset(m), 0
        for offset, length in sorted(known[name]):
            if offset < at or offset + length > m.size:
                raise ValueError(f"places of {name} overlap or lie outside it")
            yield from _scan(z, base + at, base + offset)
            yield base + offset, length
            at = offset + length
        yield from _scan(z, base + at, base + m.size)


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, at = open_path(path)
            with fs.open_input_file(at) as f:
                found = list(places(f))
            yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(found), pa.string()), "offset": pa.array([a for a, _ in found], pa.int64()), "length": pa.array([n for _, n in found], pa.int64())})


def _together(path: list[str], offset: list[int], length: list[int]) -> Iterator[tuple[str, int, int, list[int]]]:
    """Consecutive records that are read at once: (path, start, end, their positions)."""
    k = 0
    while k < len(path):
        start, end, n = offset[k], offset[k] + length[k], k + 1
        while n < len(path) and path[n] == path[k] and end <= offset[n] <= end + _NEAR and offset[n] + length[n] - start <= _AT_ONCE:
            end, n = offset[n] + length[n], n + 1
        yield path[k], start, end, list(range(k, n))
        k = n


def _read(payloads: bool):
    names = [x.split()[0] for x in _RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for batch in batches:
            rows, held = [], 0
            column = [batch.column(k).to_pylist() for k in ("path", "offset", "length")]
            for path, start, end, group in _together(*column):
                if path != opened:
                    if source:
                        source.close()
                    fs, at = open_path(path)
                    opened, source = path, fs.open_input_file(at)
                block = source.read_at(end - start, start)
                for k in group:
                    r = parse_record(block[column[1][k] - start : column[1][k] - start + column[2][k]])
                    held += len(r["payload"] or b"")
                    rows.append(r if payloads else r | {"payload": None})
                    if held > 8 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, kinds)], names)
                        rows, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, kinds)], names)
        if source:
            source.close()

    return run


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives in column ``path``.

    Columns: page_id, url, record_type, payload_digest (lower-case hexadecimal SHA-1, checked
    for responses), payload_bytes (of the full payload, from the stored response headers for
    revisits), refers_to, and payload (null for revisits, or without ``payloads``). An empty
    archive has no records; a broken one is an error.
    """
    ship(manifest.sparkSession)
    n = max(1, min(manifest.count(), 20_000))
    paths = manifest.select("path").repartition(n)
    return paths.mapInArrow(_locate, _PLACES).mapInArrow(_read(payloads), _RECORDS)

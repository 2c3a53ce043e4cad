"""WARC records in ZIP packages: a writer, and a reader that never extracts a package.

A package is a ZIP file of stored (uncompressed) members: ``archive/*.warc.gz``, one gzip member a
record, and ``indexes/index.cdxj`` with the byte range of each record.  The reader takes the end of a
package, parses the central directory (ZIP64 too), finds where the stored members begin, reads the
index, and deals the records' byte ranges to tasks that read just those ranges.  A member without index
is read record after record by one task.

Writing: each task writes packages of its own under the given folder, in a file system that pyarrow
knows (file, hdfs, s3 ...), with a fresh name, so a task that runs again leaves an unnamed stray file and
no damage; the manifest, a small table, names the packages that count.  Of rows with equal payloads of at
least ``min_bytes``, the smallest key is a response and the others revisit it.

Null html is an empty payload; a null url an empty target; control characters in a url are
percent-encoded; rows of equal key and payload are alike; an empty table gives no package.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.tables import BROADCAST_ROWS, keep

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of one archive member, of one range read, and of the neighbourhood dealt to one task.
MEMBER_BYTES, READ_BYTES, DEALT_BYTES = 64 << 20, 4 << 20, 4 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key, url: str, payload: bytes, refers_to) -> bytes:
    """One gzipped record; ``refers_to``: the key of the response that a revisit stands for."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    url = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{key}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}",
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    data = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes the packages and returns the manifest (path, records), already kept."""
    rows = pages.select(F.col(key).cast("long").alias("key"), F.coalesce(url, F.lit("")).alias("url"), F.coalesce(F.encode(html, "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    equal = rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    equal = keep(equal, "equal")
    rows = rows.join(F.broadcast(equal) if equal.count() <= BROADCAST_ROWS else equal, "sha", "left")
    rows = rows.selectExpr("key", "url", "payload", "if(key <=> first, null, first) as refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                package = package or _Package(folder)
                package.add(*row)
        if package:
            package.close()
            yield pa.RecordBatch.from_arrays([pa.array([package.path]), pa.array([package.records])], ["path", "records"])

    return keep(rows.mapInArrow(run, "path string, records long"), "manifest")


class _Package:
    def __init__(self, folder: str):
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.wacz"
        system, path = fs.FileSystem.from_uri(self.path)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.sink = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Stream(self.sink), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member, self.index, self.records, self.at = None, [], 0, 0

    def add(self, key, url: str, payload: bytes, refers_to) -> None:
        if self.member is None or self.at >= MEMBER_BYTES:
            if self.member:
                self.member.close()
            self.name, self.at = f"archive/{self.records:012d}.warc.gz", 0
            self.member = self.zip.open(zipfile.ZipInfo(self.name), "w", force_zip64=True)
        data = record(key, url, payload, refers_to)
        self.member.write(data)
        self.index.append(json.dumps({"filename": self.name, "offset": self.at, "length": len(data)}))
        self.at += len(data)
        self.records += 1

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo("indexes/index.cdxj"), "\n".join(self.index))
        self.zip.close()
        self.sink.close()


class _Stream:
    """What zipfile needs of a stream that can't seek."""

    def __init__(self, sink):
        self.sink = sink

    def write(self, data) -> int:
        self.sink.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        self.sink.flush()


def directory(file, size: int) -> list[tuple[str, int, int]]:
    """(name, begin, length) of the stored members of an open package, from its central directory."""
    def at(begin: int, n: int) -> bytes:
        file.seek(begin)
        return file.read(n)

    tail_at = max(0, size - 65557)
    tail = at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    length, begin = struct.unpack("<II", tail[end + 12 : end + 20])
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
        (wide,) = struct.unpack("<Q", tail[end - 12 : end - 4])
        length, begin = struct.unpack("<QQ", at(wide, 56)[40:56])
    table, found, p = at(begin, length), [], 0
    while table[p : p + 4] == b"PK\x01\x02":
        (method,) = struct.unpack("<H", table[p + 10 : p + 12])
        packed, full, n_name, n_extra, n_comment = struct.unpack("<IIHHH", table[p + 20 : p + 34])
        (local,) = struct.unpack("<I", table[p + 42 : p + 46])
        name, extra = table[p + 46 : p + 46 + n_name].decode(), table[p + 46 + n_name : p + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:  # 64-bit values, only of the fields that overflow, in this order
                wide64 = list(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                full = wide64.pop(0) if full == 0xFFFFFFFF else full
                packed = wide64.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide64.pop(0) if local == 0xFFFFFFFF else local
            extra = extra[4 + n :]
        if method == 0:
            header = at(local, 30)
            if header[:4] != b"PK\x03\x04":
                raise ValueError(f"no local header of {name}")
            found.append((name, local + 30 + sum(struct.unpack("<HH", header[26:30])), packed))
        p += 46 + n_name + n_extra + n_comment
    return found


def ranges(manifest: DataFrame, path: str = "path") -> DataFrame:
    """(path, begin, length, whole): the byte range of every record, or of a member without index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, inner = fs.FileSystem.from_uri(name)
                with system.open_input_file(inner) as file:
                    members = directory(file, file.size())
                    where, out, indexed = {m: b for m, b, _ in members}, [], set()
                    for member, begin, length in members:
                        if member.startswith("indexes/"):
                            file.seek(begin)
                            for line in file.read(length).splitlines():
                                entry = json.loads(line[line.index(b"{") :])
                                indexed.add(entry["filename"])
                                out.append((where[entry["filename"]] + int(entry["offset"]), int(entry["length"]), False))
                    out += [(b, n, True) for m, b, n in members if m.endswith((".warc", ".warc.gz")) and m not in indexed]
                for i in range(0, len(out), 4096):
                    b, n, w = zip(*out[i : i + 4096])
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(b)), pa.array(b, pa.int64()), pa.array(n, pa.int64()), pa.array(w)], ["path", "begin", "length", "whole"])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select(path).repartition(n, path).mapInArrow(run, "path string, begin long, length long, whole boolean")


def _inflate(data: bytes, whole: bool) -> Iterator[bytes]:
    """The plain bytes of each gzip member, or of plain data."""
    while data:
        if data[:2] != b"\x1f\x8b":
            yield data
            return
        z = zlib.decompressobj(31)
        yield z.decompress(data)
        data = z.unused_data if whole else b""


def _parse(data: bytes) -> Iterator[tuple]:
    while data.startswith(b"WARC/"):
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
        n = int(fields["content-length"])
        block, data = rest[:n], rest[n:].lstrip(b"\r\n")
        http, _, payload = block.partition(b"\r\n\r\n")
        sent = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
        if fields["warc-type"] == "response":
            yield fields, payload, len(payload), digest(payload)
        elif fields["warc-type"] == "revisit":
            yield fields, None, int(sent.get("content-length", 0)), fields["warc-payload-digest"].partition(":")[2]


SCHEMA = "type string, record_id string, url string, date string, refers_to string, payload binary, payload_bytes long, payload_digest string, intact boolean"


def records(manifest: DataFrame, path: str = "path", payload: bool = True) -> DataFrame:
    """Every response and revisit of the packages: ``SCHEMA``.  Length and digest of a response are
    those of the payload that was read, ``intact`` whether the digest is the one in the header; a
    revisit has no payload (null) and takes both from its headers.  ``payload`` false leaves the
    payloads null (they are read and digested all the same)."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def rows(file, run: list[tuple[int, int, bool]]) -> Iterator[tuple]:
        file.seek(run[0][0])
        data = file.read(run[-1][0] + run[-1][1] - run[0][0])
        for begin, length, whole in run:
            for plain in _inflate(data[begin - run[0][0] : begin - run[0][0] + length], whole):
                for f, body, n, sha in _parse(plain):
                    yield (f["warc-type"], f["warc-record-id"], f.get("warc-target-uri"), f.get("warc-date"), f.get("warc-refers-to"), body if payload else None, n, sha,
                           f.get("warc-payload-digest", "") in ("", f"sha1:{sha}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 5 + [pa.binary(), pa.int64(), pa.string(), pa.bool_()]
        system = file = name = None
        for batch in batches:
            pending: list[tuple[int, int, bool]] = []
            asked = [*zip(*(c.to_pylist() for c in batch.columns))]
            for i, (path_, begin, length, whole) in enumerate(asked):
                if path_ != name:
                    system, inner = fs.FileSystem.from_uri(path_)
                    file, name = system.open_input_file(inner), path_
                pending.append((begin, length, whole))
                after = asked[i + 1] if i + 1 < len(asked) else None
                if after is None or after[0] != name or after[1] != begin + length or after[1] + after[2] - pending[0][0] > READ_BYTES:
                    for part in _batched(rows(file, pending)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names)
                    pending = []

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges(manifest, path).withColumn("near", F.floor(F.col("begin") / DEALT_BYTES)).repartition(n, "path", "near")
    return dealt.sortWithinPartitions("path", "begin").select("path", "begin", "length", "whole").mapInArrow(run, SCHEMA)


def _batched(rows: Iterator[tuple], limit: int = 4 << 20) -> Iterator[list[tuple]]:
    part, size = [], 0
    for r in rows:
        part.append(r)
        size += 200 + len(r[5] or b"")
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def page_key(column: str) -> Column:
    """The key in a record id that ``record`` wrote; null where it was null."""
    return F.regexp_extract(column, r"<urn:x-page:(-?\d+)>", 1).try_cast("long")

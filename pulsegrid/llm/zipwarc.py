"""WARC archives packaged in ZIP files, read by ranges.

Writing: every partition of pages becomes one package (a name of its own; only
packages in the manifest, which Spark commits, count) with two stored members,
``archive/data.warc`` and ``indexes/index.cdxj``. Of pages with equal payloads
of at least ``min_bytes`` bytes the one with the largest page_id is a response
record, the others are revisits that refer to it and carry no payload. Rows
that repeat page_id and payload of a response are responses too. A page without
page_id is a revisit where a page with one has its payload, else a response.
A null html is an empty payload, a null url an empty target URI.

Reading: the end-of-directory record is found from the file's end, the ZIP64
locator and record are followed if there, the central directory gives the
members, and records are read at the offsets of the index, nearby records in
one request. Nothing is extracted. Members that are not stored are refused;
packages without an index are read from the start of the archive member.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import open_folder, shared_path, stage, text_slices

ARCHIVE, INDEX = "archive/data.warc", "indexes/index.cdxj"
PAGE_URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
RANGE_BYTES = 4 << 20
MANIFEST = "folder string, path string, records long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

# ---------------------------------------------------------------- records


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    lines.append(f"WARC-Record-ID: <{PAGE_URN}{'' if page_id is None else page_id}>")
    lines.append("WARC-Target-URI: " + "".join((url or "").splitlines()))
    lines += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{PAGE_URN}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(PAGE_URN)
    return int(number) if number else None


def parse_record(data: bytes) -> dict:
    """Fields of the record that ``data`` holds, its digest checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _headers(lines)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_headers(http.split(b"\r\n")[1:])["content-length"])
    named = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "payload_bytes": size,
        "payload_digest": named,
        "record_type": fields["warc-type"],
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload": payload if fields["warc-type"] == "response" else None,
    }


# ---------------------------------------------------------------- packages


class PackageWriter:
    """Streams records into the archive member; ``close`` adds the index."""

    def __init__(self, out):
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(self._info(ARCHIVE), "w", force_zip64=True)
        self.at, self.index = 0, []

    @staticmethod
    def _info(name: str) -> zipfile.ZipInfo:
        return zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))

    def add(self, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> None:
        data = record(page_id, url, payload, refers_to)
        self.member.write(data)
        self.index.append(json.dumps({"offset": self.at, "length": len(data), "page": page_id}))
        self.at += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(self._info(INDEX), "".join(line + "\n" for line in self.index))
        self.zip.close()


class Package:
    """Members of a ZIP file on a random-access source (size, read_at)."""

    END, END64, LOCATOR, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"

    def __init__(self, source):
        self.source, size = source, source.size()
        tail_at = max(0, size - 65535 - 22)
        tail = source.read_at(size - tail_at, tail_at)
        at = tail.rfind(self.END, 0, max(len(tail) - 18, 0))
        while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(self.END, 0, at)  # the signature can occur in a comment
        if at < 0:
            raise ValueError("not a ZIP file")
        entries, length, begin = struct.unpack_from("<10xHII", tail, at)
        end_at = tail_at + at
        if end_at >= 20:
            locator = source.read_at(20, end_at - 20)
            if locator[:4] == self.LOCATOR:
                record_at = struct.unpack_from("<8xQ", locator)[0]
                end64 = source.read_at(56, record_at)
                if end64[:4] != self.END64:
                    raise ValueError("damaged ZIP64 record")
                entries, length, begin = struct.unpack_from("<32xQQQ", end64)
        self.members = self._directory(source.read_at(length, begin) if length else b"", entries)

    def _directory(self, data: bytes, entries: int) -> dict[str, tuple[int, int, int]]:
        """name -> (method, stored size, offset of the local header)."""
        out, at = {}, 0
        for _ in range(entries):
            if data[at : at + 4] != self.ENTRY:
                raise ValueError("damaged central directory")
            method, packed, full, n, extra, comment, local = struct.unpack_from("<10xH8xIIHHH8xI", data, at)
            name = data[at + 46 : at + 46 + n].decode("utf-8", "replace")
            wide, x, end = [], at + 46 + n, at + 46 + n + extra
            while x + 4 <= end:
                tag, length = struct.unpack_from("<HH", data, x)
                if tag == 1:
                    wide = list(struct.unpack_from(f"<{length // 8}Q", data, x + 4))
                x += 4 + length
            if full == 0xFFFFFFFF and wide:
                full = wide.pop(0)
            if packed == 0xFFFFFFFF and wide:
                packed = wide.pop(0)
            if local == 0xFFFFFFFF and wide:
                local = wide.pop(0)
            out[name] = (method, packed, local)
            at = end + comment
        return out

    def locate(self, name: str) -> tuple[int, int]:
        """Where the bytes of a stored member begin, and how many there are."""
        method, size, local = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed: only stored members can be read by range")
        head = self.source.read_at(30, local)
        if head[:4] != self.LOCAL:
            raise ValueError("damaged local header")
        n, extra = struct.unpack_from("<26xHH", head)
        return local + 30 + n + extra, size

    def records(self) -> Iterator[bytes]:
        """Every record, at the ranges that the index names."""
        begin, size = self.locate(ARCHIVE)
        if INDEX not in self.members:
            yield from self._scan(begin, size)
            return
        index_at, index_size = self.locate(INDEX)
        lines = self.source.read_at(index_size, index_at).splitlines() if index_size else []
        ranges = [(x["offset"], x["length"]) for x in map(json.loads, lines)]
        k = 0
        while k < len(ranges):
            first, last = ranges[k][0], k + 1
            while last < len(ranges) and ranges[last][0] + ranges[last][1] - first <= RANGE_BYTES and ranges[last][0] >= first:
                last += 1
            end = max(o + n for o, n in ranges[k:last])
            data = self.source.read_at(end - first, begin + first)
            for o, n in ranges[k:last]:
                yield data[o - first : o - first + n]
            k = last

    def _scan(self, begin: int, size: int) -> Iterator[bytes]:
        at = 0
        while at < size:
            want = 4096
            head = self.source.read_at(min(want, size - at), begin + at)
            while b"\r\n\r\n" not in head and len(head) < size - at:
                want *= 4
                head = self.source.read_at(min(want, size - at), begin + at)
            lines = head.partition(b"\r\n\r\n")[0]
            n = len(lines) + 4 + int(_headers(lines.split(b"\r\n")[1:])["content-length"]) + 4
            yield self.source.read_at(n, begin + at)
            at += n


# ---------------------------------------------------------------- Spark


def write_packages(pages: DataFrame, min_bytes: int = 0, out: str | None = None) -> DataFrame:
    """Write packages under the URL ``out`` (a new shared folder if not
    given); returns the manifest: folder, path, records."""
    folder = out or shared_path(pages.sparkSession, "warc")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("sha", F.sha1("html")).withColumn("bytes", F.octet_length("html"))
    # equal payloads of a hot group meet as one partial row per task
    first = own.where(F.col("bytes") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    first = stage(first.where("n > 1 AND first IS NOT NULL").select("sha", "first"), "payloads")
    rows = own.join(first, "sha", "left")
    other = (F.col("first").isNotNull()) & (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        path = f"{root.rstrip('/')}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.wacz"
        with files.open_output_stream(path) as stream:
            writer = PackageWriter(stream)
            for batch in batches:
                for at, texts in text_slices(batch.column(2), 8 << 20):
                    ids, urls, refers = (batch.column(k).slice(at, len(texts)).to_pylist() for k in (0, 1, 3))
                    for page_id, url, text, ref in zip(ids, urls, texts, refers):
                        writer.add(page_id, url, text.encode(), ref)
            writer.close()
        columns = [pa.array([folder]), pa.array([path]), pa.array([len(writer.index)], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["folder", "path", "records"])

    return stage(rows.mapInArrow(write, MANIFEST), "packages")


def read_packages(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """One row per record: RECORDS, and the payload (null for a revisit)."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [field.split()[0] for field in RECORDS.split(", ")] + ["payload"] * payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payload

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, _ = open_folder(row["folder"])
                with files.open_input_file(row["path"]) as source:
                    rows, size = [], 0
                    for data in Package(source).records():
                        rows.append(parse_record(data))
                        size += len(data) if payload else 500
                        if size > RANGE_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                    yield batch_of(rows)

    shards = manifest.where("records > 0").select("folder", "path").repartition(parts, "path")
    return shards.mapInArrow(read, RECORDS + ", payload binary" * payload)


def archive(pages: DataFrame, min_bytes: int = 0, out: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as read
    back from the packages of ``pages``."""
    records = read_packages(write_packages(pages, min_bytes, out), payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') h FROM pages),
d AS (SELECT page_id, strlen(h) n, sha1(h) s, max(page_id) OVER (PARTITION BY h) m FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(s, CAST(1 + 5 * (k // 4) AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN m IS NULL OR page_id IS NOT DISTINCT FROM m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN m IS NULL OR page_id IS NOT DISTINCT FROM m THEN NULL ELSE m END AS refers_to
FROM d
"""

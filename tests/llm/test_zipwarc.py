import io
import random
import struct
import zipfile

import duckdb
import pyarrow as pa
import pytest

from pulsegrid.llm import zipwarc as Z

ODD = [(1, "http://a", "<p>x</p>"), (5, "u", "<p>x</p>"), (3, None, "<p>x</p>"), (7, "u\r\nInjected: 1", None), (8, "é", ""), (9, "u", "é\r\n\r\nWARC/1.1"), (9, "u", "other"), (None, "n", "<p>x</p>"), (None, "n", "lone"), (10, "u", "y" * 3_000_000), (11, "u", "same"), (11, "u", "same")]


def test_pages_equal_sql(spark):
    pages = spark.createDataFrame([(*r, 1, "x") for r in ODD], "page_id long, url string, html string, bytes long, first string")
    got = Z.archive(pages)
    con = duckdb.connect()
    con.register("pages", pages.toPandas().astype({"page_id": "Int64"}))
    want = con.execute(Z.ORACLE).df()
    as_text = lambda rows: sorted(str(tuple(None if x != x or x is None else x for x in r)).replace(".0", "") for r in rows)
    assert as_text(map(tuple, got.collect())) == as_text(want.astype(object).where(want.notna(), None).values.tolist())
    assert Z.archive(pages.limit(0)).count() == 0


def test_payloads_come_back(spark):
    pages = spark.createDataFrame(ODD, "page_id long, url string, html string")
    rows = Z.read_packages(Z.write_packages(pages, min_bytes=5)).collect()
    assert sorted(str((r.page_id, bytes(r.payload))) for r in rows if r.record_type == "response" and r.page_id in (7, 8, 9, 10)) == sorted(
        str((p, (h or "").encode())) for p, _, h in ODD if p in (7, 8, 9, 10))
    assert {r.page_id: r.record_type for r in rows}[11] == "response" and sum(r.refers_to == 5 for r in rows) == 3


def package(records, **options):
    out = io.BytesIO()
    w = Z.PackageWriter(out)
    for r in records:
        w.add(*r)
    w.close()
    return out.getvalue()


def test_reader_agrees_with_zipfile_and_scans_without_index():
    rng = random.Random(1)
    data = package([(k, "u", rng.randbytes(rng.randint(0, 5000)), None) for k in range(200)])
    z = zipfile.ZipFile(io.BytesIO(data))
    p = Z.Package(pa.BufferReader(data))
    begin, size = p.locate(Z.ARCHIVE)
    assert data[begin : begin + size] == z.read(Z.ARCHIVE)
    with_index = list(p.records())
    del p.members[Z.INDEX]
    assert list(p.records()) == with_index and b"".join(with_index) == z.read(Z.ARCHIVE)


def test_zip64_directory_and_comment():
    name, body = Z.ARCHIVE.encode(), Z.record(4, "u", b"hello", None)
    big = 0xFFFFFFFF
    local = struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0, 0, 0, 0, 0, big, big, len(name), 20) + name + struct.pack("<2H2Q", 1, 16, len(body), len(body)) + body
    extra = struct.pack("<2H3Q", 1, 24, len(body), len(body), 0)
    entry = struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, big, big, len(name), len(extra), 0, 0, 0, 0, big) + name + extra
    at = len(local)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, at + len(entry), 1)
    comment = b"PK\5\6 is not the end"
    end = struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, big, big, len(comment)) + comment
    data = local + entry + end64 + locator + end
    assert [Z.parse_record(r)["payload"] for r in Z.Package(pa.BufferReader(data)).records()] == [b"hello"]


def test_damage_and_compression_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(Z.ARCHIVE, b"x" * 100)
    with pytest.raises(ValueError):
        list(Z.Package(pa.BufferReader(out.getvalue())).records())
    with pytest.raises(ValueError):
        Z.Package(pa.BufferReader(b"no archive"))
    with pytest.raises(ValueError):
        Z.parse_record(Z.record(1, "u", b"payload", None).replace(b"payload", b"paylord"))

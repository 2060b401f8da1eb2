from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import archives
from gaugeworks.llm.archives import (
    arc_record,
    arc_to_warc,
    arc_version_block,
    convert_pages,
    http_parts,
    payload_digest,
    read_arc,
    read_warc,
    warc_date,
    warc_record,
    warc_rows,
)
from gaugeworks.llm.queries import PAGES_SQL, op9_legacy_archives
from gaugeworks.sources.scratch import scratch_path

TRICKY = b"WARC/1.0\r\n\r\nhttp://x 1 2 3 4\n\nfiledesc://y 0 0 0 3\nabc"


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    bodies = [b"", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + TRICKY, bytes(range(256)) * 10]
    data = arc_version_block(version, "f.arc", "20200102030405")
    data += b"".join(arc_record(version, "http://a b/", "1.2.3.4", "20200102030405", "text/html", 200, body) for body in bodies)
    records = list(read_arc(data))
    assert [r["filedesc"] for r in records] == [True, False, False, False]
    assert [r["body"] for r in records[1:]] == bodies
    assert records[1]["URL"] == "http://a%20b/" and records[1]["Archive-date"] == "20200102030405"
    assert ("Result-code" in records[1]) == (version == 2)
    # Extra newlines between records and a cut file are no harm to what is whole.
    assert len(list(read_arc(b"\n\n" + data + b"\n"))) == 4
    assert len(list(read_arc(data[:-100]))) == 3


def test_pieces_of_formats():
    assert warc_date("20200102030405") == "2020-01-02T03:04:05Z"
    assert warc_date("2020") == "2020-01-01T00:00:00Z"
    assert warc_date("") == "1970-01-01T00:00:00Z"
    assert http_parts(b"HTTP/1.0 200 OK\nX: y\n\nbody\r\n\r\n") == (b"HTTP/1.0 200 OK\nX: y\n\n", b"body\r\n\r\n")
    assert http_parts(b"no head\r\n\r\n") == (b"", b"no head\r\n\r\n")
    assert payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    blocks = [b"", TRICKY, b"\r\n\r\n"]
    data = b"".join(warc_record([("WARC-Type", "resource")], block) for block in blocks)
    assert [block for _, block in read_warc(data)] == blocks


ROWS = [
    (5, "http://a/", "same"),
    (3, "http://b/ c", "same"),
    (None, "http://n/", "same"),
    (9, None, None),
    (8, "http://e/", ""),
    (7, "dns:x", "ünï 🙂 \r\n\r\n"),
    (3, "http://b/", "other"),
    (6, "http://l/", "long " * 50_000),
    (2, "http://t/", TRICKY.decode()),
]


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(archives, "FILE_BYTES", 1_000)
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    found = convert_pages(pages).collect()
    assert len(found) == len(ROWS)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found), key=str)
    size = lambda text: len((text or "").encode())
    first = {"same": 3, "": 8}
    expected = []
    for page, _, html in ROWS:
        response = first.get(html or "")
        kind = "response" if response is None or response == page else "revisit"
        expected.append((page, size(html), kind, response if kind == "revisit" else None))
    assert got == sorted(expected, key=str)
    for row in found:
        assert any(payload_digest((html or "").encode()) == row.payload_digest and page == row.page_id for page, _, html in ROWS)
    assert convert_pages(pages.limit(0)).count() == 0


def test_any_bytes_and_a_least_size(spark, tmp_path):
    folder = tmp_path / "arc"
    folder.mkdir()
    bodies = [bytes(range(256)), bytes(range(256)), b"HTTP/1.1 200 OK\r\n\r\nab", b"HTTP/1.1 200 OK\r\n\r\nab"]
    records = [arc_record(1, f"http://h/{i}", "0.0.0.0", "2001", "image/png", 200, body) for i, body in enumerate(bodies)]
    (folder / "one.arc").write_bytes(arc_version_block(1, "one", "2001") + b"".join(records))
    for least, kinds in ((0, ["resource", "resource", "response", "revisit"]), (3, ["resource", "resource", "response", "response"])):
        out = scratch_path(spark, "warc")
        arc_to_warc(spark, str(folder), out, least_bytes=least)
        rows = warc_rows(spark, out).collect()
        assert sorted(r.record_type for r in rows) == sorted(kinds)
        assert {r.payload_digest for r in rows} == {payload_digest(bodies[0]), payload_digest(b"ab")}


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    frame = op9_legacy_archives(spark, folder)
    expected = duck.sql(f"SELECT {', '.join(frame.columns)} FROM ({PAGES_SQL})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(expected)


def test_smallest_of_long_and_text_ids(spark):
    for kind, ids in (("long", [2**63 - 1, 10**18 + 5, 10**18 + 3, 10**18 + 4]), ("string", ["d", "c", "a", "b"])):
        pages = spark.createDataFrame([(i, f"http://x/{k}", "same") for k, i in enumerate(ids)], f"page_id {kind}, url string, html string")
        found = {r.page_id: r.refers_to for r in archives.convert_pages(pages.coalesce(1)).collect()}
        assert found == {i: None if i == min(ids) else min(ids) for i in ids}


def test_text_ids_come_back_as_they_were(spark):
    ids = [" a", "a ", "b\nc", "", None, "x%20y", "ü/?#", "a:b", " a"]
    pages = spark.createDataFrame([(i, "http://x", f"page {i!r} {n}" if n < 8 else "page ' a' 0") for n, i in enumerate(ids)], "page_id string, url string, html string")
    rows = convert_pages(pages).collect()
    assert sorted((r.page_id for r in rows), key=str) == sorted(ids, key=str)
    revisit = [r for r in rows if r.record_type == "revisit"]
    assert [(r.page_id, r.refers_to) for r in revisit] == [(" a", " a")]

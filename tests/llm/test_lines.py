from __future__ import annotations

from collections import defaultdict

import duckdb
import numpy as np
import xxhash
from pyspark.sql import functions as F

from gaugeworks.llm import lines
from gaugeworks.llm.lines import drop_repeated_lines
from gaugeworks.llm.queries import LINES_SQL, op7_line_dedup
from tests.llm.brute import documents

BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=20, documents=3):
    key = lambda line: line.strip(BLANKS).translate(UPPER)
    order = lambda doc: (doc is not None, doc or 0)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        stay = [p for p in parts if len(holders[key(p)]) < documents or doc == max(holders[key(p)], key=order)]
        out.append((doc, len(parts), len(parts) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


LONG = "A line of Some length é"
ROWS = [
    (1, f"{LONG}\nown line of the first document\n{LONG}"),
    (2, f"  {LONG.lower()}\t\nx\n\n"),
    (3, f"{LONG}\r\nshort"),
    (4, None),
    (5, ""),
    (6, "short\nshort"),
    (None, f"{LONG}"),
    (7, "É" * 19 + "\n" + "é" * 20),
    (8, "É" * 19 + "\n" + "é" * 20),
    (9, "É" * 19 + "\n" + "é" * 20),
    (2, f"{LONG}"),
    (10, "two documents only hold this line"),
    (11, "two documents only hold this line"),
    (11, "two documents only hold this line"),
    (12, "filler words " * 3000 + "\n" + LONG),
]


def test_against_brute_force(spark):
    docs = documents(spark, ROWS).withColumn("digests", F.lit("clash")).withColumn("line_dedup", F.lit(1)).withColumn("a.b", F.lit(2))
    found = drop_repeated_lines(docs)
    assert sorted(found.columns) == sorted(docs.columns)
    got = [(r.doc_id, r.line_dedup.n_lines, r.line_dedup.n_dropped, r.text or "") for r in found.collect()]
    assert sorted(got, key=str) == brute(ROWS)
    assert found.filter("doc_id = 4").first().text is None
    assert found.filter("doc_id = 3").first()["a.b"] == 2
    assert drop_repeated_lines(docs.limit(0)).count() == 0


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(lines, "MIN_FILTER_BITS", 1 << 18)
    monkeypatch.setattr(lines, "MAX_FILTER_BITS", 1 << 18)
    rows = [(i, "\n".join(f"line number {j % 40_000} of the corpus" for j in range(i * 400, i * 400 + 700))) for i in range(120)]
    found = drop_repeated_lines(documents(spark, rows).repartition(7))
    got = [(r.doc_id, r.line_dedup.n_lines, r.line_dedup.n_dropped, r.text) for r in found.collect()]
    assert sorted(got, key=str) == brute(rows)


def test_the_filter_holds_what_is_seen_twice(spark):
    """However the hashes are cut into parts, no line that two rows hold is missing."""
    rows = [(i, "\n".join(f"line number {j} of the corpus" for j in range(i * 90, i * 90 + 100))) for i in range(20)]
    docs = documents(spark, rows).repartition(5)
    bits = 1 << 20
    filters = [lines.twice_seen_filter(docs, "text", 20, bits, held) for held in (30, 10**6)]
    for found in filters:
        known = np.frombuffer(found, np.uint8)
        for j in range(1900):
            hashed = np.array([xxhash.xxh3_64_intdigest(f"line number {j} of the corpus".encode())], np.uint64)
            hit = all(known[int(p[0]) >> 3] >> (int(p[0]) & 7) & 1 for p in lines._positions(hashed, bits))
            twice = j % 90 < 10 and 90 <= j < 1800
            assert hit or not twice
        assert np.unpackbits(known).sum() < 2 * 300


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    frame = op7_line_dedup(spark, folder)
    expected = duck.sql(f"SELECT {', '.join(frame.columns)} FROM ({LINES_SQL})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(expected)
    assert sum(row[2] for row in expected) > 0

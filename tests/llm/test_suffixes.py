from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import suffixes
from gaugeworks.llm.queries import op2_suffix_dedup
from gaugeworks.llm.suffixes import COVER, LENGTH, PERIOD, SAMPLE, Fingerprints, remove_repeated_strings
from tests.llm.brute import documents, sha

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Rows in order of the corpus; a dictionary of every string of 100 bytes seen so far."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        covered = np.zeros(len(data), bool)
        for at in range(len(data) - 99):
            string = data[at : at + 100]
            if string in seen:
                covered[at : at + 100] = True
            seen.add(string)
        edges = np.diff(np.concatenate([[0], covered, [0]]).astype(int))
        spans = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
        kept = bytes(b for b, c in zip(data, covered) if not c)
        out.append((doc, len(data), int(covered.sum()), len(spans), sha(kept), kept, [(a, b - a) for a, b in spans]))
    return sorted(out, key=str)


def results(frame):
    return sorted(
        (
            (r.id if "id" in r else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept), [(s.begin, s.length) for s in r.spans])
            for r in frame.collect()
        ),
        key=str,
    )


def test_cover_holds_every_difference():
    assert sorted({(a - b) % PERIOD for a in COVER for b in COVER}) == list(range(PERIOD))
    for i in range(PERIOD):
        for j in range(PERIOD):
            assert any((i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER for d in range(PERIOD))
    assert PERIOD - 1 + SAMPLE == LENGTH


def test_fingerprints_tell_substrings_apart():
    random.seed(1)
    data = np.frombuffer(bytes(random.choices(b"ab", k=3000)), np.uint8)
    prints = Fingerprints(data, suffixes.BASES[0])
    for length in (1, 5, 28, 100):
        found, own = {}, prints.all(length)
        assert (own == prints.at(np.arange(len(own)), length)).all()
        for at, value in enumerate(own.tolist()):
            assert found.setdefault(value, data[at : at + length].tobytes()) == data[at : at + length].tobytes()
        assert len(set(own.tolist())) == len({data[a : a + length].tobytes() for a in range(len(own))})


def word(k=5):
    return "".join(random.choices("abcdefghijklmnop é", k=k))


def mixed_rows():
    random.seed(11)
    base = "".join(word() for _ in range(600))
    rows = [(i, "".join(word() for _ in range(random.randint(0, 60)))) for i in range(40)]
    for i in range(40, 80):
        a = random.randint(0, 2500)
        rows.append((i, word() + base[a : a + random.randint(50, 600)] + word() + base[-random.randint(1, 400) :]))
    edited = list(base)
    for at in random.sample(range(len(edited)), 12):
        edited[at] = "Z"
    rows += [(90, base), (91, "".join(edited)), (92, base + base), (93, "a" * 700), (94, "a" * 99), (95, "ab" * 300), (96, "x" * 100)]
    rows += [(97, None), (98, ""), (None, base[:300]), (None, "a" * 150), (99, base), (99, base)]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"piece_bytes": 150, "block_bytes": 600, "held_records": 100}])
def test_against_brute_force(spark, sizes):
    """Also with texts cut into many pieces over many blocks, and little merged before it is sent."""
    rows = mixed_rows()
    docs = documents(spark, rows).repartition(5).withColumn("block", F.lit("clash")).withColumn("part", F.lit(1)).withColumn("id", F.lit(0))
    found = remove_repeated_strings(docs, **sizes)
    got, expected = results(found), brute(rows)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert got == expected


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    frame = op2_suffix_dedup(spark, SF)
    expected = [row[:5] for row in brute(rows)]
    assert sorted(map(tuple, frame.collect()), key=str) == expected
    assert any(row[2] for row in expected)


def test_empty_table_and_one_long_text(spark):
    docs = documents(spark, [(1, "abc")])
    assert remove_repeated_strings(docs.limit(0)).count() == 0
    random.seed(3)
    text = "".join(random.choices("abcdefghijklmnopqrstuvwxyz ", k=900_000))
    text = text + text[100_000:100_500]
    row = remove_repeated_strings(documents(spark, [(1, text)])).first()
    assert (row.n_bytes, row.n_removed, row.n_spans) == (len(text), 500, 1)
    assert bytes(row.kept).decode() == text[:900_000]


def test_samples_spread_over_all_buckets():
    random.seed(3)
    data = bytes(random.choices(b"abcdefgh ", k=40_000)) * 2
    block = suffixes.Block(
        {"block": 0, "sizes": [len(data)], "data": suffixes.zstandard.compress(data), "windows": [len(data) - LENGTH + 1], "ids": [1], "own": [len(data)], "last": [True]}
    )
    keys, spread, at = suffixes._sample_keys(block, {})
    counts = np.bincount((spread % np.uint64(16)).astype(int), minlength=16)
    assert counts.min() > 0.8 * len(at) / 16
    strings = {}
    for key, bucket, place in zip(keys.tolist(), spread.tolist(), at.tolist()):
        assert strings.setdefault(data[place : place + SAMPLE], (key, bucket)) == (key, bucket)


def test_settled_places_of_one_string_spread_over_all_buckets():
    """A passage that every block holds: one record stays in its bucket, the rest is dealt by block."""
    blocks = 640
    places = np.arange(blocks, dtype=np.uint64) << np.uint64(suffixes._POSITION_BITS)
    sent = list(suffixes._sent(np.full(blocks, 7, np.uint64), np.full(blocks, 3), places, suffixes.LATER, 16))
    settled = [(bucket, suffixes._places(data)) for bucket, decided, _, data in sent if decided]
    assert np.array_equal(np.sort(np.concatenate([part for _, part in settled])), places[1:])
    counts = np.bincount([bucket for bucket, _ in settled], minlength=16)
    assert counts.min() > 0 and counts.max() < 4 * blocks / 16

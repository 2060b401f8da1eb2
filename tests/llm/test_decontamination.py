from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeworks.llm import decontamination
from gaugeworks.llm.decontamination import (
    PieceIndex,
    best_distance,
    contaminated_documents,
    error_budget,
    letter_masks,
    normalized,
    pieces,
)
from gaugeworks.llm.queries import op10_benchmark_decontamination
from tests.llm.brute import documents

SF = "/root/testdata/sf0.001"


def plain_distance(pattern, text):
    """Least edit distance of the pattern to any substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        before, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text("ab c", min_size=1, max_size=20), st.text("ab c", max_size=30))
def test_bit_parallel_distance(pattern, text):
    assert best_distance(letter_masks(pattern), len(pattern), text) == plain_distance(pattern, text)


def test_pieces_cover_the_pattern():
    for length in (32, 33, 100, 401):
        pattern = "".join(chr(97 + i % 26) for i in range(length))
        errors = error_budget(length)
        found = pieces(pattern, errors)
        assert len(found) == errors + 1 and "".join(p for _, p in found) == pattern
        assert all(pattern[offset : offset + len(p)] == p and p for offset, p in found)


def test_edited_passages_are_found():
    random.seed(3)
    words = ["".join(random.choices("abcdefghij", k=random.randint(2, 9))) for _ in range(3000)]
    items = [(i, normalized(" ".join(words[i * 30 : i * 30 + 30]))) for i in range(20)]
    index = PieceIndex(items, 0.05)
    for number, pattern in items:
        for edits in range(error_budget(len(pattern)) + 4):
            letters = list(pattern)
            for at in random.sample(range(len(letters)), edits):
                letters[at] = random.choice(["", "z", letters[at] + "q"])
            text = " ".join(words[1000:1100]) + " " + "".join(letters) + " " + " ".join(words[2000:2100])
            distance = plain_distance(pattern, text)
            found = index.search(text)
            expected = {number: distance} if distance <= error_budget(len(pattern)) else {}
            assert found == expected


def test_short_items_are_exact_whole_words():
    index = PieceIndex([(1, "who wrote it?"), (2, "what is 2+2"), (3, "x" * 31), (4, "\u4e2d\u6587")], 0.05)
    assert index.search("so who wrote it? nobody") == {1: 0}
    assert index.search("who wrote it?") == {1: 0}
    assert index.search("(what is 2+2)") == {2: 0} == index.search("what is 2+22, what is 2+2")
    assert index.search("what is 2+22") == {} == index.search("somewhat is 2+2")
    assert index.search("who wrote its?") == {} == index.search("x" * 32) == index.search("x" * 30 + "y")
    assert index.search("x" * 31) == {3: 0} and index.search("\u4e2d\u6587") == {4: 0}


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    found = {r.doc_id: (list(r.item_ids), r.min_errors) for r in op10_benchmark_decontamination(spark, SF).collect()}
    holding = {}
    for doc in docs:
        text = normalized(doc.text)
        hits = [i.item_id for i in items if normalized(i.text) in text]
        if hits:
            holding[doc.doc_id] = sorted(hits)
    assert holding and {doc: ids for doc, (ids, errors) in found.items() if errors == 0} == holding
    for doc, (ids, errors) in found.items():
        text = normalized(next(d.text for d in docs if d.doc_id == doc))
        best = min(plain_distance(normalized(i.text), text) for i in items if i.item_id in ids)
        assert best == errors


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 64)
    passage = "What is the capital city of the country that borders both seas?"
    items = spark.createDataFrame(
        [(1, passage), (2, passage), (1, passage), (3, "short one"), (4, ""), (5, None), (None, "an item without a number of its own here")],
        "item_id long, text string",
    ).withColumn("doc_id", F.lit(0))
    rows = [
        (1, f"x {passage.upper().replace(' ', chr(10) + ' ')} y"),
        (2, "short one"),
        (3, None),
        (4, ""),
        (None, passage),
        (6, passage[1:]),
        (6, passage[1:]),
        (7, "word " * 200_000 + passage),
        (8, passage[: len(passage) // 2]),
        (9, "An item without a number of its own here"),
    ]
    docs = documents(spark, rows).withColumn("item", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("errors", F.lit(1))
    found = contaminated_documents(docs, items).collect()
    got = sorted(((r.doc_id, list(r.item_ids), r.min_errors) for r in found), key=str)
    both = [1, 2]
    assert got == sorted([(1, both, 0), (2, [3], 0), (None, both, 0), (6, both, 1), (6, both, 1), (7, both, 0), (9, [], 0)], key=str)
    assert contaminated_documents(docs.limit(0), items).count() == 0
    assert contaminated_documents(docs, items.limit(0)).count() == 0

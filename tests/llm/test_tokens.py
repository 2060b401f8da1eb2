from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeworks.llm.frames import with_running_totals
from gaugeworks.llm.packing import hilbert_keys, pack_along_curve
from gaugeworks.llm.queries import WORD_VOCABULARY, op4_packing, op6_token_counts
from gaugeworks.llm.token_counts import count_tokens
from gaugeworks.llm.tokens import ChunkEncoder
from tests.llm.brute import documents

SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(WORD_VOCABULARY)
ENCODER = ChunkEncoder(WORD_VOCABULARY, counts_only=False)
COUNTER = ChunkEncoder(WORD_VOCABULARY, counts_only=True)

ODD = ["", None, " ", "\n\t", "don't WE'LL i'm", "<|endoftext|>a<|startoftext|> b<|endof", "ŉ İ ß ẞ ΑΣ Σ ς", "é ́x", "a\x1cb\x85c\xa0d　e", "日本語 テスト 12３", "🙂👍🏽 x", "a" * 3000, "x " * 5000, "᠎ a", "​ a­b", "ﬁ ² ½ ١"]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert np.frombuffer(ENCODER.ids(text or ""), "<u4").tolist() == library_ids(text)
    assert COUNTER.count(text or "") == len(library_ids(text))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x250), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == library_ids(text)


def test_texts_together():
    every = [f"a{chr(code)}B" for code in range(0x3100) if not 0xD800 <= code < 0xE000]
    texts = [text or "" for text in ODD] + every + ["One, two. One; TWO!"] * 3 + ["", "x" * 70 + " <|endoftext|>"]
    for size in (1, 100, 8 << 20):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr("gaugeworks.llm.tokens.TOGETHER_BYTES", size)
            chosen = texts if size > 1 else texts[: len(ODD) + 200]
            found = [ids.tolist() for ids in ENCODER.ids_together(pa.array(chosen, pa.string()))]
        assert found == [np.frombuffer(ENCODER.ids(text), "<u4").tolist() for text in chosen]
    assert found[: len(ODD)] == [library_ids(text) for text in ODD]
    assert list(ENCODER.ids_together(pa.array([], pa.string()))) == []


def test_other_kinds_of_files():
    import sentencepiece

    text = "Two words,  and   spaces\n"
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert ChunkEncoder(path, True).count(text) == len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert ChunkEncoder(path, True).count(text) == len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


def test_counts_query_is_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {row.doc_id: row for row in op6_token_counts(spark, SF).collect()}
    assert len(found) == len(docs)
    for doc in docs:
        row = found[doc.doc_id]
        assert row.n_tokens == len(library_ids(doc.text))
        assert row.n_bytes == len((doc.text or "").encode())
        assert row.over_limit == (row.n_tokens > 2048)


def test_counts_edge_cases(spark):
    docs = documents(spark, [(i, text) for i, text in enumerate(ODD)] + [(None, "a b"), (3, "a b"), (3, "a b")])
    docs = docs.withColumn("n_tokens", F.lit("clash")).withColumn("id", F.lit(1))
    found = count_tokens(docs, WORD_VOCABULARY).collect()
    assert len(found) == len(ODD) + 3
    by_id = {row.doc_id: row.n_tokens for row in found if row.doc_id not in (None, 3)}
    assert by_id == {i: len(library_ids(text)) for i, text in enumerate(ODD) if i != 3}
    assert [row.n_tokens for row in found if row.doc_id is None] == [2]
    assert count_tokens(docs.limit(0), WORD_VOCABULARY).count() == 0


def check_packing(rows, texts, sequence):
    """Pieces tile documents and sequences; checksums are those of the library's ids."""
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
        by_sequence.setdefault(row.sequence_id, []).append(row)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = library_ids(texts[doc]) + [2]
        at = 0
        for piece in sorted(pieces, key=lambda p: p.start):
            assert piece.start == at and piece.length > 0 and piece.doc_tokens == len(ids)
            data = np.array(ids[at : at + piece.length], "<u4").tobytes()
            assert piece.ids_crc32 == zlib.crc32(data)
            at += piece.length
        assert at == len(ids)
    short = 0
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= sequence
        short += at < sequence
    assert short <= 1
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_packing_query(spark):
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_packing(op4_packing(spark, SF).collect(), texts, 4096)


def test_packing_edge_cases(spark):
    texts = dict(enumerate(ODD))
    docs = documents(spark, list(texts.items())).withColumn("curve", F.lit("clash")).withColumn("ids", F.lit(0))
    rows = pack_along_curve(docs, WORD_VOCABULARY, sequence_tokens=64).collect()
    check_packing(rows, texts, 64)
    assert all(zlib.crc32(bytes(row.ids)) == row.ids_crc32 for row in rows)
    repeated = documents(spark, [(1, "same text")] * 40 + [(None, None)] * 3)
    rows = pack_along_curve(repeated, WORD_VOCABULARY, sequence_tokens=8).collect()
    assert sum(row.length for row in rows) == 40 * 3 + 3
    assert pack_along_curve(docs.limit(0), WORD_VOCABULARY).count() == 0


def test_hilbert_keys_step_to_neighbours():
    side = np.arange(8)
    grid = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    keys = hilbert_keys(grid, 3)
    path = grid[np.argsort(keys)]
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_running_totals_by_group(spark, parts):
    rows = [(g, i, (i * 7 + 3) % 5) for g in (None, 1, 2, 2**40) for i in range(1 if g == 1 else 200)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(rows, "g long, i long, v long")
        found = {(r.g, r.i): r.before for r in with_running_totals(frame, ("g", "i"), "v", "before", group="g").collect()}
        whole = sorted(r.before for r in with_running_totals(frame, ("g", "i"), "v", "before").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected, held = {}, {}
    for g, i, v in rows:
        expected[g, i] = held.get(g, 0)
        held[g] = held.get(g, 0) + v
    assert found == expected
    total = np.cumsum([0] + [v for _, _, v in rows])
    assert whole == sorted(total[:-1].tolist())

from __future__ import annotations

import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gaugeworks.llm.alignment import Aligner, align_tokenizers, encode_and_align, group_of_tokens, linked_ids, linked_pairs
from gaugeworks.llm.queries import op11_tokenizer_alignment
from gaugeworks.llm.tokens import byte_letters
from tests.llm.brute import documents

SF = "/root/testdata/sf0.001"
A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")

A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
A_LETTERS = {letter: byte for byte, letter in byte_letters().items()}
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def plain_tokens(text):
    """Ids and bytes of the tokens of both, encoded whole; nothing where the bytes differ."""
    if not text:
        return [], [], [], []
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text, num_threads=1)
    a_bytes = [bytes(A_LETTERS[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
        return [], [], [], []
    return a, b, a_bytes, b_bytes


def plain_groups(text):
    a, b, a_bytes, b_bytes = plain_tokens(text)
    a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
    common = sorted({*a_ends} & {*b_ends})
    groups = [([], []) for _ in common]
    for side, ids, ends in ((0, a, a_ends), (1, b, b_ends)):
        for token, end in zip(ids, ends):
            groups[next(k for k, cut in enumerate(common) if end <= cut)][side].append(token)
    return groups


def plain_rows(texts):
    """The result by comparing all pairs of tokens of every group."""
    every = [plain_groups(text) for text in texts]
    linked = [Counter((x, y) for left, right in groups for x in left for y in right) for groups in every]
    counts = Counter(pair for links in linked for pair in links)
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    rows = []
    for groups, links in zip(every, linked):
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append(
            (
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                sum(links.values()),
                sum(n for pair, n in links.items() if counts[pair] == highest[pair[0]]),
                sum(n * counts[pair] for pair, n in links.items()),
                hashlib.sha256(shown.encode()).hexdigest() if groups else "",
            )
        )
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

ODD = [
    "", None, " ", "   ", "a", "a ", " a", "a  b", "a   b  ", "\n", "a\nb", "a\n b", "a\n  b", " \t x", "a  b", "a　 b",
    "<|endoftext|> <s> </s> <unk> <0x41> x", "x▁y z", "▁", "▁ a b", "\x00a b", "a\x1c b", "é ẛ̣", "日本語 テスト 12３",
    "🙂👍🏽 x 🙂", "don't WE'LL i'm", "0123456789" * 40, "a" * 3000, "x " * 2000, "١٢ ² ½ ﬁ", "\r\n\r\n end", "a᠎ b", "a﻿ b", "a\u0085 b",
]


def test_every_odd_text_like_the_whole_text(spark):
    texts = ODD + ODD[5:12]
    rows = align_tokenizers(documents(spark, list(enumerate(texts))), A_PATH, B_PATH).orderBy("doc_id").collect()
    for text, row, expected in zip(texts, rows, plain_rows(texts), strict=True):
        assert tuple(row[c] for c in COLUMNS) == expected, repr(text)


ALIGNER = Aligner(A_PATH, B_PATH)


@settings(max_examples=250, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([" ", "  ", "\n", "\t", "▁", "the", "a", "'s", "<s>", " "]), st.text(max_size=8)), max_size=12))
def test_runs_are_independent(parts):
    import pyarrow as pa

    text = "".join(parts)
    text = text.encode("utf-8", "ignore").decode()
    assert ALIGNER.cuttable
    words, at, numbers = ALIGNER.runs(pa.array([text, "x y"]))
    runs = [words[k] for k in at[: numbers[0]]]
    assert " ".join(runs) == text
    rows = ALIGNER.rows_of(runs)
    expected = plain_groups(text)
    if text and ALIGNER.known.fits[rows].all():
        shown = b"".join(ALIGNER.known.shown[row] for row in rows).decode()
        assert shown == "".join(f"{','.join(map(str, x))}|{','.join(map(str, y))};" for x, y in expected)
    elif text:
        assert not expected


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.integers(0, 2**32 - 1))
def test_pointers_end_where_both_end(n, seed):
    rng = np.random.default_rng(seed)
    a_ends = np.append(np.flatnonzero(rng.random(n - 1) < 0.5) + 1, n) if n > 1 else np.array([1])
    b_ends = np.append(np.flatnonzero(rng.random(n - 1) < 0.3) + 1, n) if n > 1 else np.array([1])
    common = np.intersect1d(a_ends, b_ends)
    a_group, b_group = group_of_tokens(a_ends, b_ends)
    assert a_group.tolist() == np.searchsorted(common, a_ends).tolist()
    assert b_group.tolist() == np.searchsorted(common, b_ends).tolist()


def test_large_groups_are_reduced_to_distinct_ids(monkeypatch):
    rng = np.random.default_rng(1)
    a_ids, b_ids = rng.integers(0, 9, 300), rng.integers(0, 7, 200)
    a_group, b_group = np.sort(rng.integers(0, 6, 300)), np.sort(rng.integers(0, 6, 200))
    expected = Counter((g, a << 32 | b) for g, a in zip(a_group, a_ids) for h, b in zip(b_group, b_ids) if g == h)
    for limit in (0, 500, 10**9):
        monkeypatch.setattr("gaugeworks.llm.alignment.LARGE_GROUP", limit)
        found = Counter()
        for g, pair, n in zip(*linked_ids(a_ids, a_group, b_ids, b_group, 6)):
            found[(g, pair)] += n
        assert found == expected


def test_query_like_brute_force(spark):
    from checks.base import table

    docs = {row["doc_id"]: row["text"] for row in table(spark, SF, "documents").collect()}
    found = {row["doc_id"]: tuple(row[c] for c in COLUMNS) for row in op11_tokenizer_alignment(spark, SF).collect()}
    assert found == dict(zip(docs, plain_rows(docs.values())))


@pytest.mark.parametrize("limit", [0, 1, 40, 500])
def test_rare_pairs_by_join_give_the_same(spark, limit):
    texts = [f"the cat number {k % 7} sat, unlikely{k}ness  of the mat " * (k % 3) for k in range(60)]
    docs = documents(spark, list(enumerate(texts)))
    rows = align_tokenizers(docs, A_PATH, B_PATH, broadcast_pairs=limit).orderBy("doc_id").collect()
    assert [tuple(row[c] for c in COLUMNS) for row in rows] == plain_rows(texts)


def test_counts_of_pairs(spark):
    texts = ["unbelievable tokens", "unbelievable", None, "tokens tokens"]
    encoded = encode_and_align(documents(spark, list(enumerate(texts))), A_PATH, B_PATH)
    expected = Counter()
    for text in texts:
        expected.update({(x, y) for left, right in plain_groups(text) for x in left for y in right})
    rows = linked_pairs(encoded).collect()
    assert {(row["a_id"], row["b_id"]): row["n_docs"] for row in rows} == dict(expected)
    best = {x: max(n for (y, _), n in expected.items() if x == y) for x, _ in expected}
    assert all(row["best"] == (row["n_docs"] == best[row["a_id"]]) for row in rows)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "a cat"), (1, "a cat"), (None, "a cat"), (None, None), (2, "")]
    docs = spark.createDataFrame([(*row, "x", 5, b"y") for row in rows], "doc_id long, text string, id string, row int, pairs binary")
    found = sorted(map(str, align_tokenizers(docs, A_PATH, B_PATH).select("doc_id", *COLUMNS).collect()))
    expected = plain_rows([text for _, text in rows])
    assert len(found) == 5
    assert [row["count_sum"] for row in align_tokenizers(docs, A_PATH, B_PATH).filter("doc_id = 1").collect()] == [expected[0][5]] * 2


def test_empty_table(spark):
    found = align_tokenizers(documents(spark, []), A_PATH, B_PATH)
    assert found.columns == ["doc_id", *COLUMNS] and found.count() == 0


def test_other_pairs_of_files(spark):
    """The word vocabulary drops white space: nothing is given back, so nothing is linked."""
    found = align_tokenizers(documents(spark, [(1, "a cat")]), public_tokenizers.path("word_bpe_49k.json"), B_PATH).first()
    assert found["n_a"] == 0 and found["groups_sha256"] == ""
    assert json.load(open(public_tokenizers.path("word_bpe_49k.json")))["normalizer"]


def test_a_full_table_of_runs_begins_anew(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr("gaugeworks.llm.alignment.CACHE_RUNS", 3)
    aligner = Aligner(A_PATH, B_PATH)
    for text in ["a b c d e f", "b c d x y", "a b c", "z"]:
        words, at, _ = aligner.runs(pa.array([text]))
        shown = b"".join(aligner.known.shown[row] for row in aligner.rows_of(words)[at]).decode()
        assert shown == "".join(f"{','.join(map(str, x))}|{','.join(map(str, y))};" for x, y in plain_groups(text))
    assert len(aligner.known.rows) == 1

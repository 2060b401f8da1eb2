from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import language
from gaugeworks.llm.language import (
    FEATURES,
    calibrate,
    document_frequencies,
    fit_ftrl,
    identify_languages,
    ngram_counts,
    tf_idf,
    train,
    with_language,
)
from gaugeworks.llm.queries import op3_language_id
from tests.llm.brute import documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op3_language_id(spark, SF).collect()
    assert len(found) == len(docs)
    right = total = 0
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
        assert row.lang_pred in {"en", "de", "fr", "es", "und"}
        if row.held_out and docs[row.doc_id].lang:
            total += 1
            right += row.lang_pred == docs[row.doc_id].lang
    assert total > 200 and right / total > 0.98


def test_ngrams_count_letters_only():
    assert ngram_counts("12 !?\n") is None and ngram_counts("") is None
    assert (ngram_counts("Ab, c") == ngram_counts("aB--- C 9")).all()
    assert ngram_counts("abc").sum() == 5 + 4 + 3
    long = "Grüße an alle " * 200_000
    assert ngram_counts(long).sum() == sum(len(" " + long.lower().strip() + " ") - n for n in range(3))


def test_long_texts_in_slices(monkeypatch):
    text = "straße und weg, " * 300
    whole = ngram_counts(text)
    monkeypatch.setattr(language, "_LETTERS_AT_ONCE", 101)
    assert (ngram_counts(text) == whole).all()


def test_document_frequencies_see_every_row(spark):
    texts = ["one two", "two three", "", "17", "three"] * 11
    total, rows = document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
    expected = sum((c > 0).astype(int) for c in map(ngram_counts, texts) if c is not None)
    assert rows == 33 and (total == expected).all()


def test_penalties_make_weights_sparse():
    rng = np.random.default_rng(0)
    samples = [(k % 2, np.array([k % 2, 10 + k % 50]), np.array([0.9, 0.1 * rng.random()])) for k in range(400)]
    weights = fit_ftrl(samples, 2)
    assert weights.shape == (FEATURES + 1, 2)
    assert weights[0, 0] > 0 > weights[0, 1] and weights[1, 1] > 0 > weights[1, 0]
    assert (weights[60:FEATURES] == 0).all()


def test_temperature_cools_overconfidence():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 2000)
    sure = np.where(rng.random(2000) < 0.8, labels, 1 - labels)
    scores = np.stack([5.0 * (sure == 0), 5.0 * (sure == 1)], 1)
    chance = 1 / (1 + np.exp(-5 / calibrate(scores, labels)))
    assert chance == pytest.approx(0.8, abs=0.03)
    assert calibrate(np.zeros((0, 2)), np.zeros(0, int)) == 1.0


def test_edge_cases(spark):
    rows = [(i, "der und die das nicht " * 5, "de") for i in range(60)] + [(100 + i, "the and of that with " * 5, "en") for i in range(60)]
    odd = [(500, None, "de"), (501, "", None), (502, "12 #$", "en"), (None, "the and of"), (503, "der und " * 300_000), (504, "der", ""), (505, "der und die", None), (505, "der und die", None)]
    docs = documents(spark, rows + odd).withColumn("language", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("score", F.lit(1))
    found = identify_languages(docs).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and by_id[500].score == 0
    assert by_id[None].lang_pred == "en" and by_id[503].lang_pred == by_id[505].lang_pred == "de"
    assert identify_languages(docs.limit(0)).count() == 0
    unlabelled = identify_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}
    model = train(docs)
    passed = with_language(docs, model)
    assert sorted(passed.columns) == sorted(docs.columns)
    assert passed.filter("doc_id = 3").first().language.lang == "de"


def test_weights_have_length_one():
    at, weights = tf_idf(ngram_counts("some words"), np.ones(FEATURES))
    assert np.linalg.norm(weights) == pytest.approx(1) and len(at) == len(weights)


def test_scores_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = identify_languages(docs.repartition(3, "source"))
    other = identify_languages(docs.unionByName(docs.limit(0)).repartition(11).sortWithinPartitions(F.col("doc_id").desc()))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_every_label_that_is_not_null_is_learned(spark, monkeypatch):
    rows = [(i, "aaa bbb abab " * 3, "") for i in range(40)] + [(100 + i, "xyz zyx xxyy " * 3, "x") for i in range(40)]
    rows += [(200 + i, "mno", None) for i in range(20)]
    found = {(r.doc_id // 100, r.lang_pred) for r in identify_languages(documents(spark, rows)).collect()}
    assert {(0, ""), (1, "x")} <= found and not {(0, "x"), (1, "")} & found
    monkeypatch.setattr(language, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="more than 1 labels"):
        train(documents(spark, rows))


def test_repeated_rows_are_drawn_as_one(spark):
    rows = [(1, "aaa bbb", "a")] * 500 + [(i, f"xyz zyx {i}", "x") for i in range(2, 40)]
    assert train(documents(spark, rows)).labels == ["a", "x"]

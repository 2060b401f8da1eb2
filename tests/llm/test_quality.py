from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import quality
from gaugeworks.llm.quality import base_statistics, chi_square_quantile, judge_quality, repeated_words
from gaugeworks.llm.queries import op8_quality_outliers
from tests.llm.brute import WORD, documents

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(marked),
        failed,
    )


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op8_quality_outliers(spark, SF).collect()
    assert len(found) == len(docs)
    for row in found:
        assert tuple(row[1:7]) == brute(docs[row.doc_id])
        assert not (row.base_failed and row.kept)


def test_repeated_words_are_exact():
    random.seed(1)
    for size in (0, 4, 5, 6, 50, 400):
        words = [random.choice([b"a", b"b", b"c"]) for _ in range(size)]
        assert repeated_words(words) == brute(b" ".join(words).decode())[4]


def test_chi_square():
    assert chi_square_quantile(0.95, 4) == pytest.approx(9.487729, abs=1e-5)
    assert chi_square_quantile(0.999, 6) == pytest.approx(22.457744, abs=1e-5)


def test_outliers_of_a_group(spark):
    """One estimate per language and source: what is ordinary in one group is rejected in another."""
    random.seed(7)

    def text(letters, noise=0):
        words = ["".join(random.choices("abcdefgh", k=max(1, round(random.gauss(letters, 1.5))))) for _ in range(120)]
        return " ".join(w + "#$%" * noise for w in words)

    rows = [(i, text(5), "en", "a") for i in range(300)] + [(1000 + i, text(9), "de", "b") for i in range(300)]
    rows += [(2000 + i, text(9), "en", "a") for i in range(30)] + [(3000 + i, text(5, 1), "en", "a") for i in range(30)]
    kept = {r.doc_id: r.kept for r in judge_quality(documents(spark, rows)).collect()}
    assert not any(kept[i] for i in kept if i >= 2000)
    assert sum(not kept[i] for i in kept if i < 2000) <= 2


def test_estimate_is_robust(spark):
    """Concentration steps agree with the same steps in plain arrays, and ignore a fifth of outliers."""
    random.seed(5)
    rng = np.random.default_rng(5)
    good, bad = rng.normal(0, 1, (800, 4)) * [1, 0.2, 0.1, 0.1] + [5, 1, 1, 1], rng.normal(20, 1, (200, 4))
    points = np.concatenate([good, bad])
    rows = spark.createDataFrame([(*map(float, p), "=x", "=y") for p in points], [*quality.DIMENSIONS, "cell_lang", "cell_source"])
    row = quality.estimates_by_group(rows).first()
    center = np.array([row[f"m{i}"] for i in range(4)])
    assert np.abs(center - [5, 1, 1, 1]).max() < 0.15
    spread = np.linalg.inv(np.array([[row[f"p{min(i, j)}{max(i, j)}"] for j in range(4)] for i in range(4)]))
    assert spread[0, 0] == pytest.approx(1 + quality.FLOORS[0] ** 2, rel=0.25)


def test_edge_cases(spark):
    plain = " ".join(f"word{i} other{i * 7}" for i in range(30))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c"), (None, plain, None, None), (5, plain), (5, plain), (6, "same line of words\n" * 50)]
    rows += [(7, "x" * 200_000), (8, " ".join(f"w{i}" for i in range(60_000)))]
    docs = documents(spark, rows).withColumn("n_words", F.lit("clash")).withColumn("distance", F.lit(1)).withColumn("n", F.lit(1))
    found = judge_quality(docs).collect()
    assert len(found) == len(rows)
    verdict = {r.doc_id: (r.base_failed, r.kept) for r in found}
    assert verdict[1] == verdict[2] == verdict[3] == verdict[4] == verdict[6] == verdict[7] == (True, False)
    assert verdict[None] == verdict[5] == verdict[8] == (False, True)
    assert judge_quality(docs.limit(0)).count() == 0
    assert base_statistics("é é <b>".encode()) == (2, 6, 2, 0, 0, 1)
    assert math.isfinite(max(r.distance or 0 for r in found))


def test_small_tables_are_judged(spark):
    random.seed(8)
    rows = [(i, " ".join("".join(random.choices("abcdefgh", k=random.randint(3, 7))) for _ in range(60)), "en", "a") for i in range(40)]
    rows.append((99, " ".join("x" * 40 + "#$%&|" * 8 + str(i) for i in range(60)), "xx", "b"))
    found = {r.doc_id: r for r in judge_quality(documents(spark, rows)).collect()}
    assert all(r.distance is not None for r in found.values())
    assert not found[99].kept and not found[99].base_failed

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from gaugeworks.llm.licenses import LIKENESS, NOTICES, PHRASES, SHIFT, scan_licenses
from gaugeworks.llm.queries import op12_license_scan
from tests.llm.brute import documents

SF = "/root/testdata/sf0.01"
COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def places(words, part):
    return [d for d in range(len(words) - len(part) + 1) if words[d : d + len(part)] == part]


def plain_row(text, phrases=PHRASES, notices=NOTICES):
    """Every place of every three words of every template, compared one by one."""
    words = WORD.findall((text or "").translate(LOWER))
    base = [(label, d) for label, texts in phrases.items() for phrase in texts for d in places(words, phrase.split())]
    found = {label: 1.0 for label, _ in base}
    for label, texts in notices.items():
        for notice in texts:
            wanted = notice.split()
            votes = defaultdict(set)
            for t in range(len(wanted) - 2):
                for d in places(words, wanted[t : t + 3]):
                    votes[d - t].add(t)
            for diagonal in votes:
                near = [(x, t) for x in range(diagonal - SHIFT, diagonal + SHIFT + 1) for t in votes.get(x, ())]
                covered = len({t + i for _, t in near for i in range(3)})
                span = max(x + t + 3 for x, t in near) - min(x + t for x, t in near)
                likeness = 2.0 * covered / (len(wanted) + span)
                if covered >= LIKENESS * len(wanted) and likeness >= LIKENESS:
                    found[label] = max(found.get(label, 0.0), likeness)
    starts = [d for _, d in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for label, _ in base})), ",".join(sorted(found)), max(found.values(), default=0.0),
    )


def scanned(spark, texts, **options):
    rows = scan_licenses(documents(spark, list(enumerate(texts))), **options).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    return rows


MIT = NOTICES["mit"][0]
ODD = [
    "", None, "   ", "mit", "Under the MIT license", "UNDER THE MIT LICENSE.", "under the mit license under the mit license",
    "under the mit licenses", "under the\nMIT---License!", "ünder the mit license", "under the mıt license", "UNDER THE MİT LICENSE",
    "cc by nc cc by nc by nc cc-by-nc 4.0", "CC BY\x00NC", "apache license, version 2", "Apache License, Version 2.0", "apache license version 20",
    "Licensed under the Apache License, Version 2.0", "GNU General Public License, version 3", "GNU Lesser General Public License, version 3",
    "GNU Affero General Public License, version 3", MIT, MIT.upper(), MIT.replace("free of charge", "free of any charge at all"),
    MIT.replace("copy modify merge ", ""), MIT[: len(MIT) // 2], "x " * 300 + MIT + " y" * 50, MIT + " " + MIT,
    "cc by nc " * 2000, "the software " * 1500, "Kelvin worK under the mit license", "licensed under cc by nc 4 0 licensed under cc by sa 4 0",
]


def test_odd_texts_like_brute_force(spark):
    for text, row in zip(ODD, scanned(spark, ODD), strict=True):
        assert tuple(row[c] for c in COLUMNS) == plain_row(text), repr(text and text[:60])


def test_changed_notices_like_brute_force(spark):
    """Words put in, left out, exchanged and moved; notices one after the other."""
    rng = random.Random(5)
    texts = []
    every = [text for kind in (NOTICES, PHRASES) for kinds in kind.values() for text in kinds]
    for _ in range(250):
        words = " ".join(rng.choices(every, k=rng.randint(1, 3))).split()
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 2)] = rng.choices(["the", "license", "new", "of"], k=rng.randint(0, 3))
            words = words or ["x"]
        texts.append(" ".join(words))
    rows = scanned(spark, texts)
    assert [tuple(row[c] for c in COLUMNS) for row in rows] == [plain_row(text) for text in texts]
    assert 60 < sum(row["n_base"] == 0 and row["labels"] != "" for row in rows)


def test_query_like_brute_force(spark):
    rows = op12_license_scan(spark, SF).collect()
    docs = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {row["doc_id"]: tuple(row[c] for c in COLUMNS) for row in rows} == {i: plain_row(text) for i, text in docs.items()}


def test_spans(spark):
    row = scanned(spark, ["one two " + MIT + " three, under the mit license"])[0]
    n = len(MIT.split())
    assert [(s["label"], s["begin"], s["end"]) for s in row["spans"]] == [("mit", 2, n + 2), ("mit", n + 3, n + 7)]
    assert [s["likeness"] for s in row["spans"]] == [1.0, 1.0]


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "cc by nc"), (1, "cc by nc"), (None, "cc by nc"), (None, None), (1, "mit"), (None, None)]
    docs = spark.createDataFrame(
        [(*row, "x", 3, [1], "y") for row in rows], "doc_id long, text string, words string, hash int, run array<int>, template string"
    )
    found = sorted((str(row["doc_id"]), row["n_words"], row["labels"]) for row in scan_licenses(docs).collect())
    assert found == sorted([("1", 3, "cc-by-nc")] * 2 + [("None", 3, "cc-by-nc")] + [("None", 0, "")] * 2 + [("1", 1, "")])


def test_own_phrases_and_notices(spark, monkeypatch):
    phrases, notices = {"a,b": ("one two three four",), "z": ("three four five",)}, {"long": ("a b c d e f g h",)}
    texts = ["one two three four five", "a b c x d e f g h", "a b c"]
    for limit in (0, 100):
        # Beyond the bound the templates are no longer broadcast by hint.
        monkeypatch.setattr("gaugeworks.llm.licenses.BROADCAST_RUNS", limit)
        rows = scanned(spark, texts, phrases=phrases, notices=notices)
        assert [tuple(row[c] for c in COLUMNS) for row in rows] == [plain_row(text, phrases, notices) for text in texts]
    with pytest.raises(ValueError, match="3 words"):
        scan_licenses(documents(spark, []), phrases={"x": ("too short",)})


def test_empty_table(spark):
    assert scan_licenses(documents(spark, [])).collect() == []


def test_plan_is_native_and_reads_once(spark):
    plan = op12_license_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert not re.search("Python|Pandas|Arrow", plan)
    assert plan.split("Initial Plan")[0].count("Scan parquet") == 1

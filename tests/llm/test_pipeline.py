from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeworks.llm.decontamination import normalized
from gaugeworks.llm.simhash import drop_near_duplicates, similar_groups
from tests.llm.brute import WORD, documents
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def shingles(text, size=5):
    words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)])


def similar(a, b):
    if not a or not b:
        return not a and not b
    return 5 * len(a & b) >= 4 * len(a | b)


def brute_keepers(rows):
    """Smallest id of each group of similar texts, by all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for at, (doc, _) in enumerate(rows):
        least[find(at)] = min(doc, least.get(find(at), doc))
    return sorted(least.values())


def near_rows(seed=9):
    random.seed(seed)
    rows, number = [], 0
    for group in range(25):
        words = ["".join(random.choices("abcdefghij", k=6)) for _ in range(random.randint(80, 400))]
        for copy in range(random.choice([1, 2, 4])):
            edited = list(words)
            for at in random.sample(range(len(words)), int(len(words) * random.choice([0, 0.005, 0.01, 0.1]))):
                edited[at] = "edit" + str(number)
            rows.append((number, " ".join(edited)))
            number += 1
    return rows + [(number, ""), (number + 1, None), (number + 2, "two words"), (number + 3, "two words")]


def test_near_copies_by_similarity(spark):
    rows = near_rows()
    docs = documents(spark, rows).withColumn("node", F.lit("clash")).withColumn("same", F.lit(1)).withColumn("id", F.lit(1))
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == brute_keepers(rows)
    assert drop_near_duplicates(docs.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(5, long), (5, long), (5, "other text"), (None, long), (None, "only null"), (None, "only null")]
    kept = sorted(((r.doc_id, r.text) for r in drop_near_duplicates(documents(spark, rows)).collect()), key=str)
    assert kept == sorted([(5, long), (5, "other text"), (None, "only null")], key=str)


def test_planted_near_copies_are_found(spark):
    """Over the given documents: every pair of similarity 0.8 or more is in one group, others are not linked."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    groups = {r.id: r.component_id for r in similar_groups(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    assert sorted(set(groups.values())) == brute_keepers(rows)


def edited_copies(words, copies, edits, seed):
    rng = random.Random(seed)
    texts = []
    for copy in range(copies):
        edited = list(words)
        for at in rng.sample(range(len(words)), edits):
            edited[at] = f"e{copy}x{at}"
        texts.append(" ".join(edited))
    return texts


def test_independent_copies_of_one_text(spark):
    """Copies are similar to the original, hardly to each other: one group, through the original."""
    words = [f"w{i}" for i in range(1000)]
    rows = list(enumerate(edited_copies(words, 150, 20, 3) + [" ".join(words)]))
    groups = {r.id: r.component_id for r in similar_groups(documents(spark, rows)).collect()}
    assert sorted(set(groups.values())) == brute_keepers(rows) == [0]


def test_copies_just_below_the_limit_stay_apart(spark):
    """Three hundred texts that share most shingles, no two of them enough; beside them two that do."""
    words = [f"w{i}" for i in range(700)]
    rows = list(enumerate(edited_copies(words, 300, 20, 4)))
    rows += [(1000, rows[7][1] + " one word"), (1001, rows[9][1] + " two more words")]
    kept = sorted(r.doc_id for r in drop_near_duplicates(documents(spark, rows)).collect())
    assert kept == brute_keepers(rows) and 299 <= len(kept) < 302


def test_long_texts_that_share_a_shingle(spark):
    rows = []
    for number in range(60):
        words = [f"t{number}w{i}" for i in range(3000)]
        words[100:105] = "the one shingle they share".split()
        rows.append((number, " ".join(words)))
    rows += [(100 + number, text.replace("w2000 ", "x ").replace("w50 ", "y ")) for number, text in rows[:3]]
    kept = sorted(r.doc_id for r in drop_near_duplicates(documents(spark, rows)).collect())
    assert kept == list(range(60))


def test_stages_one_by_one(spark):
    """Each stage against a plain version of its decision, on what the stage before it kept."""
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "benchmark_decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, items = docs.columns, [normalized(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: r for r in docs.collect()}

    docs = stages["language_id"](spark, docs, SF).cache()
    after = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(after) <= set(before) and len(after) > 0.95 * len(before)
    assert all(after[i] == before[i] for i in after)

    docs = stages["line_dedup"](spark, docs, SF).cache()
    found = {r.doc_id: r for r in docs.collect()}
    expected = {doc: text for doc, _, _, text in brute_lines([(i, r.text) for i, r in after.items()])}
    assert docs.columns == columns and {i: r.text for i, r in found.items()} == expected
    assert all(r.n_chars == len(r.text) for r in found.values())

    docs = stages["near_dedup"](spark, docs, SF).cache()
    assert docs.columns == columns
    kept = {r.doc_id: r for r in docs.collect()}
    assert sorted(kept) == brute_keepers([(i, r.text) for i, r in found.items()])
    assert all(kept[i] == found[i] for i in kept)

    docs = stages["benchmark_decontamination"](spark, docs, SF).cache()
    clean = {r.doc_id: r.text for r in docs.collect()}
    leaks = {i for i, r in kept.items() if any(item in normalized(r.text) for item in items)}
    assert docs.columns == columns and not leaks & set(clean) and set(kept) - leaks - set(clean) <= set(kept)
    assert len(set(kept) - leaks - set(clean)) <= 1

    check_packing(stages["packing"](spark, docs, SF).collect(), clean, 4096)


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    assert rows and sum(sum(n for _, n in s) < 4096 for s in by_sequence.values()) <= 1


def test_stages_take_odd_and_empty_tables(spark):
    rows = [(1, None), (2, ""), (3, "12 34"), (None, "some words of a text", "en"), (4, "some other words here", "en"), (4, "some other words here", "en")]
    docs = documents(spark, rows).withColumn("row", F.lit("clash")).withColumn("language", F.lit(1)).withColumn("line_dedup", F.lit(2))
    names = docs.columns
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, empty = stage(spark, docs, SF), stage(spark, empty, SF)
        assert empty.count() == 0 and docs.count() >= 1 and docs.columns == names
        assert docs.filter("language = 1 AND line_dedup = 2 AND row = 'clash'").count() == docs.count()


def test_short_near_copies_at_the_limit(spark):
    """Texts of 8 and 9 words: 4 of 5 shingles shared, exactly 0.8; and long ones just at the limit."""
    rows = []
    for pair in range(100):
        words = [f"p{pair}w{i}" for i in range(9)]
        rows += [(2 * pair, " ".join(words[:8])), (2 * pair + 1, " ".join(words))]
    for pair in range(100, 200):
        words = [f"p{pair}w{i}" for i in range(104)]
        rows += [(2 * pair, " ".join(words[:84])), (2 * pair + 1, " ".join(words))]
    kept = sorted(r.doc_id for r in drop_near_duplicates(documents(spark, rows)).collect())
    assert kept == list(range(0, 400, 2))


@pytest.mark.parametrize(
    "stage, operator", [("language_id", "with_language"), ("line_dedup", "drop_repeated_lines"), ("decontamination", "contaminated_documents")]
)
def test_stages_hand_small_batches_to_their_workers(spark, monkeypatch, stage, operator):
    plain = getattr(corpus_pipeline, operator)

    def watched(docs, *args, **options):
        def passed(batches):
            for batch in batches:
                assert batch.nbytes <= 8 << 20
                yield batch

        return plain(docs.mapInArrow(passed, docs.schema), *args, **options)

    monkeypatch.setattr(corpus_pipeline, operator, watched)
    rows = [(number, f"{number} and some words of a long text " * 400, "en") for number in range(1_500)]
    docs = documents(spark, rows).coalesce(1)
    assert getattr(corpus_pipeline, stage)(spark, docs, SF).count() == len(rows)

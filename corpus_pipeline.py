"""A corpus made ready for training: documents in, packed sequences out.

Each stage calls one operator of ``gaugeworks.llm`` with its production parameters
and works on all that the stage before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import Registry, table
from gaugeworks.functions.columns import ref
from gaugeworks.llm.decontamination import contaminated_documents
from gaugeworks.llm.frames import batches_up_to, free_name
from gaugeworks.llm.language import UNDETERMINED, fold, train, with_language
from gaugeworks.llm.lines import drop_repeated_lines
from gaugeworks.llm.packing import pack_along_curve
from gaugeworks.llm.simhash import drop_near_duplicates
from gaugeworks.sources.scratch import written

#: Below this chance of its best language a text is rejected.
MIN_LANGUAGE_SCORE = 0.4
#: A batch of whole texts on its way through a worker.
BATCH_BYTES = "4m"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without letters, or like none of them, go.

    Where no label is known nothing can be learned, and only texts without
    letters go.
    """
    with batches_up_to(spark, BATCH_BYTES):
        model = train(docs.filter(fold("doc_id") != 2))
        name = free_name(docs, "language")
        judged = with_language(docs, model, name=name)
        found = ref(name)
        if model.labels:
            keep = (found["lang"] != UNDETERMINED) & (found["score"] >= MIN_LANGUAGE_SCORE)
        else:
            keep = F.coalesce(ref("text"), F.lit("")).rlike(r"\p{L}")
        # Written here, or the caller's batches would be the session's, of 64 MB in JVM and worker each.
        return written(judged.filter(keep).select(*[ref(column) for column in docs.columns]), "language", compression="zstd")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` follows the text."""
    name = free_name(docs, "line_dedup")
    changed = ref(name)["n_dropped"] > 0
    columns = [
        F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
        if column == "n_chars"
        else ref(column)
        for column in docs.columns
    ]
    with batches_up_to(spark, BATCH_BYTES):
        return written(drop_repeated_lines(docs, name=name).select(*columns), "lines", compression="zstd")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return drop_near_duplicates(docs, words=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    with batches_up_to(spark, BATCH_BYTES):
        leaks = contaminated_documents(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leak")).distinct()
        leaks = written(leaks, "leaks")
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["leak"]), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, without the ids themselves."""
    return pack_along_curve(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("packing", packing),
]

#: No SQL has trained models, BK-trees or tokenizers; the tests compare with a brute-force version.
ORACLE_SQL = None

checks = Registry()


@checks.add("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

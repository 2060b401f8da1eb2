"""Token counts by a two-tier lookup on the map side.

First tier: a compact table of frequent chunks and their lengths, broadcast.
Second tier: a bounded cache in each Python worker, filled by encoding what the
first tier misses.  No pre-token is shuffled; documents stay where they are.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, batches_of, whole_text
from gaugeworks.llm.tokens import ChunkEncoder, worker_encoder

#: The table has at most so many chunks of at most so many letters: under 5 MB.
FREQUENT_CHUNKS = 65_536
FREQUENT_LETTERS = 64
#: Documents looked at to choose the frequent chunks.  The choice decides speed, never a count.
FREQUENT_FROM_ROWS = 20_000
_PER_TASK = 16_384


class FrequentLengths:
    """The broadcast table in compact form: chunks in one string, lengths in one array."""

    def __init__(self, lengths: dict[str, int], spark):
        joined = "\n".join(lengths).encode()
        counts = np.array(list(lengths.values()), np.uint16).tobytes()
        self.id = uuid.uuid4().hex
        self._data: Broadcast = spark.sparkContext.broadcast((joined, counts))

    def table(self) -> dict[str, int]:
        joined, counts = self._data.value
        if not counts:
            return {}
        return dict(zip(joined.decode().split("\n"), np.frombuffer(counts, np.uint16).tolist()))


def frequent_lengths(
    docs: DataFrame, path: str, text_col: str = "text", rows: int = FREQUENT_FROM_ROWS
) -> FrequentLengths:
    """The most frequent chunks of about ``rows`` documents with their lengths in tokens.

    Each task sends its own most frequent chunks only, so what travels is
    bounded by the tasks, not by the words of the corpus.
    """
    encoder = ChunkEncoder(path, counts_only=True)
    lengths: dict[str, int] = {}
    if encoder.by_chunk:
        total = docs.count()
        sample = docs.select(whole_text(text_col).alias("text")).sample(min(1.0, rows / max(total, 1)), seed=42)
        schema = pa.schema([("chunk", pa.string()), ("n", pa.int64())])

        def top(batches: Batches) -> Batches:
            found: Counter = Counter()
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    found.update(chunk for chunk in text.split() if len(chunk) <= FREQUENT_LETTERS)
                if len(found) > 50 * _PER_TASK:
                    found = Counter(dict(found.most_common(10 * _PER_TASK)))
            yield from batches_of(schema, iter(found.most_common(_PER_TASK)), 20_000)

        chosen = (
            sample.mapInArrow(top, "chunk string, n long")
            .groupBy("chunk")
            .agg(F.sum("n").alias("n"))
            .orderBy(F.col("n").desc(), "chunk")
            .limit(FREQUENT_CHUNKS)
            .select("chunk")
            .collect()
        )
        lengths = {row["chunk"]: encoder.count(row["chunk"]) for row in chosen}
        lengths = {chunk: n for chunk, n in lengths.items() if n < 65_536}
    return FrequentLengths(lengths, docs.sparkSession)


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row.

    Counts are those of the library for the file at ``path`` (``tokenizers``
    for ``.json``, ``sentencepiece`` for ``.model``) on the whole text, without
    added special tokens; special strings inside a text are read as the library
    reads them.  A null or empty text has 0 tokens; a null id stays null;
    repeated rows are counted each; an empty table gives an empty result.
    Columns other than the two named are not looked at.
    """
    frequent = frequent_lengths(docs, path, text_col)
    rows = docs.select(
        ref(id_col).alias("id"), whole_text(text_col).alias("text"), F.octet_length(whole_text(text_col)).alias("n_bytes")
    )

    def counted(batches: Batches) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, True, frequent)
        for batch in batches:
            counts = [encoder.count(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(counted, f"id {kind}, n_bytes int, n_tokens long")
    return found.select(
        F.col("id").alias(id_col),
        F.col("n_bytes").cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )

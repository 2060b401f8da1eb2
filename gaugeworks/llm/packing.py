"""Packing along a space-filling curve.

Every document gets a point: the mean of hashed signs of its token ids in a few
dimensions.  Documents are range-sorted by the Hilbert key of the point and laid
end to end along the curve, so neighbours in a sequence are alike and only the
very last sequence can be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import (
    Batches,
    batches_of,
    batches_up_to,
    pack_planes,
    unpack_planes,
    whole_text,
    with_running_totals,
)
from gaugeworks.llm.tokens import worker_encoder
from gaugeworks.sources.scratch import written

DIMENSIONS = 3
BITS = 10
#: The mean of hashed signs rarely leaves this interval.
SPREAD = 0.5
_FIELD = 21
_SLICE = 1 << 20
#: What moves between Spark and a worker at a time.
BATCH_BYTES = "8m"


def hashed_bits(size: int) -> np.ndarray:
    """Per token id three hashed bits, one in each 21-bit field of a word, so one sum counts all three."""
    with np.errstate(over="ignore"):
        x = np.arange(size, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    word = np.zeros(size, np.uint64)
    for d in range(DIMENSIONS):
        word |= ((x >> np.uint64(d)) & np.uint64(1)) << np.uint64(_FIELD * d)
    return word


def sign_means(ids: np.ndarray, bits: np.ndarray) -> list[float]:
    """Mean hashed sign of the ids per dimension; long texts in slices that fit the fields."""
    counts = [0] * DIMENSIONS
    for begin in range(0, len(ids), _SLICE):
        total = int(bits[ids[begin : begin + _SLICE] & (len(bits) - 1)].sum())
        for d in range(DIMENSIONS):
            counts[d] += (total >> (_FIELD * d)) & ((1 << _FIELD) - 1)
    return [2 * count / len(ids) - 1 for count in counts]


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows) with ``bits`` bits per dimension.

    The published bit-transpose construction (J. Skilling, 2004), for all
    points at once.
    """
    x = points.astype(np.int64).copy()
    count, dimensions = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for d in range(dimensions):
            on = (x[:, d] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] = np.where(on, x[:, 0] ^ low, x[:, 0] ^ swap)
            if d:
                x[:, d] ^= swap
        q >>= 1
    for d in range(1, dimensions):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(count, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, -1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(count, np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dimensions):
            key = (key << 1) | ((x[:, d] >> bit) & 1)
    return key


def _points(means: np.ndarray) -> np.ndarray:
    top = (1 << BITS) - 1
    scaled = (means / SPREAD + 1) / 2 * (top + 1)
    return np.clip(scaled, 0, top).astype(np.int64)


def tokenized(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``id, row, curve, n_tokens, ids`` per document; ``row`` tells repeated rows apart, ids are byte planes."""
    rows = docs.select(
        ref(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), whole_text(text_col).alias("text")
    )
    end = np.array([end_id], "<u4")

    def encoded(batches: Batches) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, False)
        bits = hashed_bits(1 << 16)
        for batch in batches:
            kept, lengths, means = [], [], np.zeros((batch.num_rows, DIMENSIONS))
            for at, found in enumerate(encoder.ids_together(batch.column("text"))):
                ids = np.append(found, end)
                means[at] = sign_means(ids, bits)
                lengths.append(len(ids))
                kept.append(pack_planes(ids))
            curve = hilbert_keys(_points(means))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("row"),
                    pa.array(curve),
                    pa.array(lengths, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                ["id", "row", "curve", "n_tokens", "ids"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encoded, f"id {kind}, row long, curve long, n_tokens long, ids binary")


def pack_along_curve(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence_tokens: int = 4096,
    end_id: int = 2,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers.
    The documents, each closed by ``end_id``, lie end to end along the curve and
    are cut every ``sequence_tokens`` ids, whatever document that falls into, so
    every sequence but the last is full.  A null or empty text is its end id
    alone; a null id stays null; equal points are ordered by id, repeated rows
    by their place in the input; an empty table gives no pieces.  Other columns
    are not looked at.

    Texts are tokenized once; the ids move once, to their place on the curve.
    """
    with batches_up_to(docs.sparkSession, BATCH_BYTES):
        ids = written(tokenized(docs, path, end_id, id_col, text_col), "ids", compression="zstd")
        placed = with_running_totals(ids, ("curve", "id", "row"), "n_tokens", "begin", label="curve")
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kind = ids.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (
        ", ids binary" if with_ids else ""
    )

    def pieces(batches: Batches) -> Batches:
        for batch in batches:
            types = [batch.schema.field("id").type] + [pa.int64()] * 6 + [pa.binary()] * with_ids
            columns = (batch.column(name).to_pylist() for name in ("id", "begin", "ids"))

            def cut(rows=zip(*columns)):
                for doc, begin, planes in rows:
                    data = unpack_planes(planes, np.uint32).tobytes()
                    total, start = len(data) // 4, 0
                    while start < total:
                        sequence, offset = divmod(begin + start, sequence_tokens)
                        length = min(total - start, sequence_tokens - offset)
                        piece = data[4 * start : 4 * (start + length)]
                        row = (doc, start, length, zlib.crc32(piece), total, sequence, offset)
                        yield (*row, piece) if with_ids else row
                        start += length

            yield from batches_of(pa.schema(list(zip(names, types))), cut())

    found = placed.select("id", "begin", "ids").mapInArrow(pieces, schema)
    return found.withColumnRenamed("id", id_col) if id_col != "id" else found

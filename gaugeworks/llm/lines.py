"""Removal of lines that many documents share.

Two Bloom filters over all line keys say which hashes were seen once and which
at least twice.  They are built in shards: a task sends the bit positions it set,
grouped by shard, and each shard is merged on its own.  Only the twice-seen filter
is kept; lines it does not hold are certainly unique and are never shuffled.  The
suspected rest is confirmed exactly on cryptographic digests of the keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, add_shards, batches_of, text_bytes
from gaugeworks.sources.scratch import written

BLANKS = b" \t\n\x0b\x0c\r"
#: The filter is broadcast: at most 2**29 bits, 64 MB.  Beyond some 10**8 lines it fills up, which
#: sends more lines to the exact step and changes no result.
MAX_FILTER_BITS = 1 << 29
MIN_FILTER_BITS = 1 << 20
#: Bits are chosen from the bytes of text: ten or more for a line of ordinary length.
BYTES_PER_BIT = 8
SHARD_BITS = 18
HELD_HASHES = 1_000_000


def line_key(line: bytes) -> bytes:
    """The line without blanks at both ends, A-Z in lower case."""
    return line.strip(BLANKS).lower()


def long_enough(key: bytes, least: int) -> bool:
    """Whether a key has at least ``least`` code points."""
    if len(key) < least:
        return False
    return key.isascii() or len(key) - sum(byte & 0xC0 == 0x80 for byte in key) >= least


def _keys(text: bytes, least: int) -> set[bytes]:
    return {key for key in map(line_key, text.split(b"\n")) if long_enough(key, least)}


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def twice_seen_filter(docs: DataFrame, text_col: str, least: int, bits: int, held_hashes: int = HELD_HASHES) -> bytes:
    """The filter of hashes seen in at least two rows, as ``bits / 8`` bytes."""
    shard_size = 1 << SHARD_BITS
    schema = pa.schema([("shard", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def positions(held: list[int]) -> Iterator[tuple]:
        hashes, counts = np.unique(np.array(held, np.uint64), return_counts=True)
        once = np.unique(np.concatenate(_positions(hashes, bits)))
        twice = np.unique(np.concatenate(_positions(hashes[counts > 1], bits)))
        shards = np.unique(once >> np.uint64(SHARD_BITS))
        for shard in shards:
            begin, end = shard << np.uint64(SHARD_BITS), (shard + np.uint64(1)) << np.uint64(SHARD_BITS)
            own = [
                (array[np.searchsorted(array, begin) : np.searchsorted(array, end)] - begin).astype("<u4").tobytes()
                for array in (once, twice)
            ]
            yield int(shard), *own

    def seen(batches: Batches) -> Batches:
        def rows():
            held: list[int] = []
            for batch in batches:
                for text in batch.column("text"):
                    held.extend(xxhash.xxh3_64_intdigest(key) for key in _keys(text.as_py(), least))
                    if len(held) >= held_hashes:
                        yield from positions(held)
                        held = []
            if held:
                yield from positions(held)

        yield from batches_of(schema, rows())

    def add(filters, parts):
        if filters is None:
            filters = np.zeros((2, shard_size), bool)
        once, twice = parts
        filters[1, once[filters[0, once]]] = True
        filters[1, twice] = True
        filters[0, once] = True
        return filters

    def merged(batches: Batches) -> Batches:
        parts = (
            (shard, (np.frombuffer(once, "<u4"), np.frombuffer(twice, "<u4")))
            for batch in batches
            for shard, once, twice in zip(*(column.to_pylist() for column in batch.columns))
        )
        out = pa.schema([("shard", pa.int32()), ("bits", pa.binary())])
        rows = (
            (shard, np.packbits(filters[1], bitorder="little").tobytes())
            for shard, filters in add_shards(parts, add)
            if filters[1].any()
        )
        yield from batches_of(out, rows)

    shards = (
        docs.select(text_bytes(text_col).alias("text"))
        .mapInArrow(seen, "shard int, once binary, twice binary")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(merged, "shard int, bits binary")
    )
    whole = bytearray(bits // 8)
    width = shard_size // 8
    # At most bits / 8 bytes in all: the filter itself.
    for row in shards.collect():
        whole[row["shard"] * width : (row["shard"] + 1) * width] = row["bits"]
    return bytes(whole)


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, documents: int = 3
) -> DataFrame:
    """``id, digests``: per document the keys that it loses, as 16-byte BLAKE2b digests."""
    size = docs.select(F.sum(F.octet_length(text_bytes(text_col)))).first()[0] or 0
    bits = min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, 1 << max(size // BYTES_PER_BIT, 1).bit_length()))
    spark = docs.sparkSession
    twice = spark.sparkContext.broadcast(twice_seen_filter(docs, text_col, least, bits))
    rows = docs.select(ref(id_col).alias("id"), text_bytes(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def suspected(batches: Batches) -> Batches:
        known = np.frombuffer(twice.value, np.uint8)

        def hit(positions: np.ndarray) -> np.ndarray:
            return (known[positions >> np.uint64(3)] >> (positions & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            schema = pa.schema([("id", batch.schema.field("id").type), ("digest", pa.binary())])

            def rows(batch=batch):
                for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                    keys = list(_keys(text.as_py(), least))
                    if not keys:
                        continue
                    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
                    first, second = _positions(hashes, bits)
                    for at in np.flatnonzero(hit(first) & hit(second)):
                        yield doc, _digest(keys[at])

            yield from batches_of(schema, rows(), 10_000)

    found = written(rows.mapInArrow(suspected, f"id {kind}, digest binary"), "lines")
    # Both keys spread a hot line over all partitions before its documents are counted.
    holders = found.groupBy("digest", "id").agg(F.lit(1).alias("one"))
    confirmed = (
        holders.groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
        .filter(F.col("n") >= documents)
        .select("digest", "keeper")
    )
    lost = holders.join(confirmed, "digest").filter(~F.col("id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("id").agg(F.collect_list("digest").alias("digests"))


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 20,
    documents: int = 3,
    name: str = "line_dedup",
) -> DataFrame:
    """All columns, ``text_col`` without its repeated lines, and the struct ``name(n_lines, n_dropped)``.

    A line's key is the line without ASCII blanks at both ends and with A-Z in
    lower case.  Keys of at least ``least`` code points that at least
    ``documents`` different ids hold lose all their lines, except in the largest
    id.  A null text counts as one empty line and stays null; rows that repeat
    an id count as one document and are treated alike; a null id counts as one
    id that is smaller than any other; an empty table stays empty.  A column
    that is already called ``name`` is replaced; all others pass through.
    """
    lost = repeated_lines(docs, id_col, text_col, least, documents)
    kept = [column for column in docs.columns if column.lower() != name.lower()]
    rows = docs.select(F.struct(*[ref(column) for column in kept]).alias("row"))
    joined = rows.alias("r").join(lost.alias("l"), F.col(f"r.row.`{id_col}`").eqNullSafe(F.col("l.id")), "left")
    inputs = joined.select("row", F.col(f"row.`{text_col}`").cast("string").cast("binary").alias("text"), "digests")

    def cleaned(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, drops = [], [], []
            for text, digests in zip(batch.column("text").to_pylist(), batch.column("digests").to_pylist()):
                n_lines, dropped = (text or b"").count(b"\n") + 1, 0
                if digests:
                    gone = set(digests)
                    lines = text.split(b"\n")
                    stay = [
                        line
                        for line in lines
                        if not (long_enough(key := line_key(line), least) and _digest(key) in gone)
                    ]
                    dropped = len(lines) - len(stay)
                    text = b"\n".join(stay)
                texts.append(text)
                totals.append(n_lines)
                drops.append(dropped)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.binary()), pa.array(totals, pa.int64()), pa.array(drops, pa.int64())],
                ["row", "text", "n_lines", "n_dropped"],
            )

    schema = T.StructType(inputs.schema.fields[:1]).add("text", "binary").add("n_lines", "long").add("n_dropped", "long")
    result = inputs.mapInArrow(cleaned, schema)
    return result.select(
        *[
            F.col("text").cast("string").alias(text_col) if column == text_col else F.col("row").getField(column).alias(column)
            for column in kept
        ],
        F.struct("n_lines", "n_dropped").alias(name),
    )

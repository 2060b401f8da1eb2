"""Removal of repeated byte strings, by suffixes sorted one bucket at a time.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier.
Sorting every suffix of the corpus is not needed for that, only those that tie
for ``LENGTH`` bytes, and a difference cover tells which can:

1. Texts are range-sorted by id and cut into blocks; a position in a block is a
   position in the order of the corpus.
2. Blocks are cut into runs at positions their own content chooses, so repeated
   passages have repeated runs.  Only the first of equal runs goes on.
3. Cover sample.  Positions whose residue is in a difference cover modulo
   ``PERIOD`` are ranked by their next ``SAMPLE`` bytes.  Any two positions have
   a common offset below ``PERIOD`` at which both are samples, so suffixes that
   tie for ``LENGTH`` bytes have samples of equal rank.  A suffix without a
   repeated sample in reach is unique.
4. The remaining suffixes go to buckets and each bucket is sorted alone; of
   those that tie, all but the first are marked.

Buckets are ranges of fingerprints rather than of letters: ties are what counts,
and fingerprints spread evenly whatever the text.  A task merges what is equal in
its own blocks before anything is sent, so a string that fills a third of the
corpus is sent once per task.  Ties are decided on two polynomial fingerprints of
the bytes: one of 64 bits, and one that names the bucket.  As the buckets grow in
number with the corpus and not in size, the chance of a wrong tie stays at some
10**-9 per bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, batches_of, batches_up_to, forget_shuffles, pack_planes, text_bytes, unpack_planes
from gaugeworks.sources.scratch import drop_written, written

LENGTH = 100
PERIOD = 73
SAMPLE = LENGTH - PERIOD + 1
#: Powers of two modulo 73: every residue is a difference of two of them.
COVER = sorted({pow(2, k, PERIOD) for k in range(9)})
#: Longer texts are cut into pieces that overlap by ``LENGTH - 1`` bytes.
PIECE = 400_000
BLOCK = 400_000
RUN_BITS = 6
BUCKET_RECORDS = 400_000
HELD_RECORDS = 500_000
#: What moves between Spark and a worker at a time.
BATCH_BYTES = 4 << 20
#: Places a task gathers over its buckets before it answers.
HELD_ANSWERS = 1_000_000
_POSITION_BITS = 20
#: Consecutive blocks that share their answers.
_GROUP_BITS = 4
_SEQUENCE_BITS = 24
_U = np.uint64

LATER, REPEATED = "later", "repeated"


# --- fingerprints -----------------------------------------------------------------------


class Fingerprints:
    """Fingerprints of any substring of a block from running sums of a polynomial."""

    _tables: dict = {}

    def __init__(self, data: np.ndarray, base: int):
        letters, powers, inverses = self._prepared(base)
        with np.errstate(over="ignore"):
            sums = np.cumsum(letters[data] * powers[: len(data)], dtype=np.uint64)
        self._sums = np.concatenate([np.zeros(1, np.uint64), sums])
        self._inverses = inverses

    @classmethod
    def _prepared(cls, base: int):
        if base not in cls._tables:
            size = 1 << _POSITION_BITS
            inverse = pow(base, -1, 1 << 64)
            letters = np.random.default_rng(base).integers(1, 1 << 63, 256, np.uint64) * _U(2) + _U(1)
            with np.errstate(over="ignore"):
                powers = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
                inverses = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, inverse, np.uint64)]), dtype=np.uint64)
            cls._tables[base] = letters, powers, inverses
        return cls._tables[base]

    def at(self, begins: np.ndarray, lengths) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self._sums[begins + lengths] - self._sums[begins]) * self._inverses[begins]

    def all(self, length: int) -> np.ndarray:
        """At every position where ``length`` bytes follow."""
        count = max(0, len(self._sums) - length)
        with np.errstate(over="ignore"):
            return (self._sums[length:] - self._sums[:count]) * self._inverses[:count]


BASES = (0x9E3779B97F4A7C13, 0xD1B54A32D192ED0B)


def _mixed(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = (values ^ (values >> _U(31))) * _U(0xBF58476D1CE4E5B9)
        return values ^ (values >> _U(29))


# --- blocks -----------------------------------------------------------------------------


def _pieces(text: bytes, size: int) -> Iterator[tuple[int, bytes, int, int, bool]]:
    """base, bytes, windows that start in it, own bytes, last?"""
    base = 0
    while len(text) - base > size + LENGTH - 1:
        yield base, text[base : base + size + LENGTH - 1], size, size, False
        base += size
    rest = text[base:]
    yield base, rest, max(0, len(rest) - LENGTH + 1), len(rest), True


def _block_type(kind: T.DataType) -> T.StructType:
    return (
        T.StructType()
        .add("part", T.IntegerType())
        .add("block", T.LongType())
        .add("kind", T.IntegerType())
        .add("data", T.BinaryType())
        .add("ids", T.ArrayType(kind))
        .add("sizes", T.ArrayType(T.IntegerType()))
        .add("windows", T.ArrayType(T.IntegerType()))
        .add("own", T.ArrayType(T.IntegerType()))
        .add("last", T.ArrayType(T.BooleanType()))
    )


_BLOCK = 2


def blocks_of(docs: DataFrame, id_col: str, text_col: str, piece_bytes: int, block_bytes: int) -> DataFrame:
    """The texts end to end in blocks, in the order of ids (null first; repeated ids by input place).

    A block's bytes are kept compressed, as they move with their answers in each step.
    """
    rows = docs.select(
        ref(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text_bytes(text_col).alias("text")
    )
    ordered = rows.repartitionByRange("id", "row").sortWithinPartitions("id", "row")

    def packed(batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()

        def blocks():
            sequence, size = 0, 0
            held: list[tuple] = []

            def block():
                number = part << _SEQUENCE_BITS | sequence
                columns = list(zip(*held))
                data = b"".join(columns[1])
                sizes = [len(piece) for piece in columns[1]]
                return part, number, _BLOCK, zstandard.compress(data, 3), list(columns[0]), sizes, *map(list, columns[2:])

            for batch in batches:
                for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                    for _, data, windows, own, last in _pieces(text.as_py(), piece_bytes):
                        held.append((doc, data, windows, own, last))
                        size += len(data)
                        if size >= block_bytes:
                            yield block()
                            held, size, sequence = [], 0, sequence + 1
            if held:
                yield block()

        yield from batches_of(_arrow(kind), blocks(), 64, BATCH_BYTES)

    kind = rows.schema["id"].dataType
    return written(ordered.mapInArrow(packed, _block_type(kind)), "blocks", compression="zstd")


def _arrow(kind: T.DataType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(_block_type(kind))


class Block:
    """A block's bytes, pieces, and runs."""

    def __init__(self, row: dict):
        self.number = row["block"]
        sizes = np.array(row["sizes"], np.int64)
        self.data = np.frombuffer(zstandard.decompress(row["data"], int(sizes.sum())), np.uint8)
        self.begins = np.cumsum(sizes) - sizes
        self.windows = np.array(row["windows"], np.int64)
        self.ids, self.own, self.last = row["ids"], row["own"], row["last"]
        self.first = Fingerprints(self.data, BASES[0])

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of the runs of windows: cut where the content of the window says so."""
        starts = self.begins[self.windows > 0]
        counts = self.windows[self.windows > 0]
        if not len(starts):
            return starts, starts
        valid = _between(len(self.data), starts, starts + counts)[: max(0, len(self.data) - LENGTH + 1)]
        begins = valid & (self.first.all(LENGTH) >> _U(64 - RUN_BITS) == 0)
        begins[starts] = True
        found = np.flatnonzero(begins)
        last = np.repeat(starts + counts, np.diff(np.append(np.searchsorted(found, starts), len(found))))
        return found, np.minimum(np.append(found[1:], last[-1]), last)


def _between(size: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True from each begin to before its end."""
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, begins, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


# --- buckets ----------------------------------------------------------------------------

_RECORDS = pa.schema(
    [("bucket", pa.int32()), ("settled", pa.bool_()), ("keys", pa.binary()), ("places", pa.binary())]
)
_RECORD_TYPES = "bucket int, settled boolean, keys binary, places binary"


def _ties(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, then place (as given); where a key begins; number of its occurrence."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    begins = np.ones(len(order), bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(begins)
    number = np.arange(len(order)) - np.repeat(at, np.diff(np.append(at, len(order))))
    return order, at, number


def _sent(keys: np.ndarray, bucket: np.ndarray, places: np.ndarray, mode: str, buckets: int) -> Iterator[tuple]:
    """Packed records per bucket, after equal keys of this task are merged.

    One place per key is enough to tell which come later, two to tell that a
    key is repeated; the other places are settled here and dealt by block, as
    a passage that every text holds would otherwise settle in one bucket.
    Places ascend.
    """
    settled = [np.zeros(0, _U)]
    by_bucket = np.argsort(bucket, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(bucket[by_bucket], prepend=-1)), len(bucket))
    for begin, end in zip(edges, edges[1:]):
        own = by_bucket[begin:end]
        order, _, number = _ties(keys[own])
        more = number >= (1 if mode == LATER else 2)
        settled.append(places[own[order[more]]])
        keep = own[np.sort(order[~more])]
        yield int(bucket[own[0]]), False, pack_planes(keys[keep]), _deltas(places[keep])
    decided = np.sort(np.concatenate(settled))
    block = decided >> _U(_POSITION_BITS)
    dealt = _mixed(block) % _U(buckets)
    for part in np.split(np.arange(len(decided)), np.flatnonzero(np.diff(block)) + 1):
        if len(part):
            yield int(dealt[part[0]]), True, b"", _deltas(decided[part])


def _deltas(places: np.ndarray) -> bytes:
    return pack_planes(np.diff(places, prepend=_U(0)))


def _places(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(data, np.uint64), dtype=np.uint64)


def _sorted_buckets(records: DataFrame, mode: str, label: str, kind: int) -> DataFrame:
    """``part, block, kind, data``: places that come later than an equal key, or whose key is repeated.

    A task answers for all its buckets together, in rows that name the first
    block of a group: rows grow with tasks and groups, not with every pair of
    a bucket and a block.
    """

    def answers(places: np.ndarray) -> Iterator[tuple]:
        places = np.sort(places)
        group = places >> _U(_POSITION_BITS + _GROUP_BITS)
        for part in np.split(places, np.flatnonzero(np.diff(group)) + 1):
            if len(part):
                head = int(part[0]) >> _POSITION_BITS + _GROUP_BITS << _GROUP_BITS
                within = (part & _U((1 << _POSITION_BITS + _GROUP_BITS) - 1)).astype(np.uint32)
                yield head >> _SEQUENCE_BITS, head, kind, pack_planes(within)

    def sort_one(held: list[tuple]) -> np.ndarray:
        keys = np.concatenate([unpack_planes(row[0], np.uint64) for row in held])
        places = np.concatenate([_places(row[1]) for row in held])
        by_place = np.argsort(places)
        keys, places = keys[by_place], places[by_place]
        order, at, number = _ties(keys)
        if mode == LATER:
            marked = number > 0
        else:
            sizes = np.diff(np.append(at, len(order)))
            marked = np.repeat(sizes > 1, sizes)
        return places[order[marked]]

    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])

    def sorted_(batches: Batches) -> Batches:
        def found():
            current, held = None, []
            for batch in batches:
                for bucket, settled, *record in zip(*(column.to_pylist() for column in batch.columns)):
                    if settled:
                        yield _places(record[1])
                        continue
                    if bucket != current and held:
                        yield sort_one(held)
                        held = []
                    current = bucket
                    held.append(record)
            if held:
                yield sort_one(held)

        def rows():
            held, size = [np.zeros(0, _U)], 0
            for places in found():
                held.append(places)
                size += len(places)
                if size >= HELD_ANSWERS:
                    yield from answers(np.concatenate(held))
                    held, size = [np.zeros(0, _U)], 0
            yield from answers(np.concatenate(held))

        yield from batches_of(schema, rows(), 2_000, BATCH_BYTES)

    ordered = records.repartition("bucket").sortWithinPartitions("bucket")
    return written(ordered.mapInArrow(sorted_, "part int, block long, kind int, data binary"), label, compression="zstd")


def _emitter(found: Callable[[Block, dict], tuple | None], buckets: int, mode: str, held_records: int):
    """A map over blocks and their answers, in order, that sends keyed places to buckets."""

    def emitted(batches: Batches) -> Batches:
        def rows():
            held, size = [], 0
            for block, answers in _in_order(batches):
                record = found(block, answers)
                if record is None or not len(record[0]):
                    continue
                keys, spread, at = record
                places = _U(block.number << _POSITION_BITS) + at.astype(np.uint64)
                held.append((keys, (spread % _U(buckets)).astype(np.int64), places))
                size += len(at)
                if size >= held_records:
                    yield from _sent(*map(np.concatenate, zip(*held)), mode, buckets)
                    held, size = [], 0
            if held:
                yield from _sent(*map(np.concatenate, zip(*held)), mode, buckets)

        yield from batches_of(_RECORDS, rows(), 2_000, BATCH_BYTES)

    return emitted


def _in_order(batches: Batches) -> Iterator[tuple[Block, dict[int, np.ndarray]]]:
    """Blocks with their answers; those of a group of blocks precede its first block."""
    waiting: dict[int, list[np.ndarray]] = {}
    group = None
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at].as_py() for name in ("block", "kind")}
            if row["block"] >> _GROUP_BITS != group:
                waiting, group = {}, row["block"] >> _GROUP_BITS
            if row["kind"] < _BLOCK:
                waiting.setdefault(row["kind"], []).append(unpack_planes(batch.column("data")[at].as_py(), np.uint32))
                continue
            waiting = {kind: [np.sort(np.concatenate(parts))] if len(parts) > 1 else parts for kind, parts in waiting.items()}
            begin = (row["block"] & (1 << _GROUP_BITS) - 1) << _POSITION_BITS
            answers = {}
            for kind, (places,) in waiting.items():
                first, end = np.searchsorted(places, [begin, begin + (1 << _POSITION_BITS)])
                if end > first:
                    answers[kind] = places[first:end].astype(np.int64) - begin
            yield Block({name: batch.column(name)[at].as_py() for name in batch.schema.names}), answers


def _together(blocks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Blocks after their answers, the blocks of a range in one partition in order."""
    whole = blocks
    for part in answers:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole.repartition("part").sortWithinPartitions("part", "block", "kind")


# --- the steps --------------------------------------------------------------------------


def _run_keys(block: Block, _answers: dict):
    begins, ends = block.runs()
    if not len(begins):
        return None
    lengths = ends - begins + LENGTH - 1
    second = Fingerprints(block.data, BASES[1])
    with np.errstate(over="ignore"):
        spread = lengths.astype(np.uint64) * _U(0x9E3779B97F4A7C15)
        return _mixed(block.first.at(begins, lengths) ^ spread), _mixed(second.at(begins, lengths) + spread), begins


def _first_windows(block: Block, answers: dict) -> np.ndarray | None:
    """True at the windows of runs that no equal run precedes."""
    begins, ends = block.runs()
    later = np.isin(begins, answers.get(0, np.zeros(0, np.int64)))
    if not len(begins) or later.all():
        return None
    return _between(len(block.data), begins[~later], ends[~later])


_IN_COVER = np.isin(np.arange(PERIOD), [residue % PERIOD for residue in COVER])


def _sample_keys(block: Block, answers: dict):
    windows = _first_windows(block, answers)
    if windows is None:
        return None
    reach = _widened(windows, 0, PERIOD - 1)
    at = np.flatnonzero(reach & np.resize(_IN_COVER, len(reach)))
    # The rank only rules suffixes out: 48 bits are plenty.
    first = _mixed(block.first.at(at, SAMPLE))
    return first & _U(0xFFFFFFFF_FFFF0000), first, at


def _widened(marks: np.ndarray, before: int, after: int) -> np.ndarray:
    at = np.flatnonzero(marks)
    if not len(at):
        return marks
    return _between(len(marks), np.maximum(at - before, 0), np.minimum(at + after + 1, len(marks)))


def _suffix_keys(block: Block, answers: dict):
    samples = answers.get(1)
    windows = _first_windows(block, answers) if samples is not None else None
    if windows is None:
        return None
    repeated = np.zeros(len(block.data), bool)
    repeated[samples] = True
    at = np.flatnonzero(windows & _widened(repeated, PERIOD - 1, 0))
    second = Fingerprints(block.data, BASES[1])
    return _mixed(block.first.at(at, LENGTH)), _mixed(second.at(at, LENGTH)), at


def remove_repeated_strings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = True,
    piece_bytes: int = PIECE,
    block_bytes: int = BLOCK,
    held_records: int = HELD_RECORDS,
) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256[, kept, spans]`` per row.

    A text is its UTF-8 bytes.  Each byte goes that lies in a string of 100
    bytes which also starts earlier: in a row of smaller id, or earlier in the
    same row; strings are judged on the input, and overlaps count.  ``kept`` are
    the other bytes, ``spans`` the removed runs (begin, length).  Null and empty
    texts have 0 bytes; null ids come first and rows that repeat an id follow
    their place in the input, so all but the first of equal rows lose
    everything (from 100 bytes on); an empty table gives no rows.  Other columns
    are not looked at.
    """
    if piece_bytes + block_bytes + LENGTH > 1 << _POSITION_BITS:
        raise ValueError("a piece and a block must fit the positions of a block")
    with batches_up_to(docs.sparkSession, f"{BATCH_BYTES}b"):
        return _without_repeats(docs, id_col, text_col, with_text, piece_bytes, block_bytes, held_records)


def _without_repeats(
    docs: DataFrame, id_col: str, text_col: str, with_text: bool, piece_bytes: int, block_bytes: int, held_records: int
) -> DataFrame:
    blocks = blocks_of(docs, id_col, text_col, piece_bytes, block_bytes)
    forget_shuffles(docs.sparkSession)
    size = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda held, x: held + x))).first()[0] or 0

    def buckets(share: float) -> int:
        return max(16, int(size * share) // BUCKET_RECORDS)

    def step(found, source, share, mode, label, kind):
        records = source.mapInArrow(_emitter(found, buckets(share), mode, held_records), _RECORD_TYPES)
        return _sorted_buckets(records, mode, label, kind)

    runs = step(_run_keys, blocks, 2**-RUN_BITS, LATER, "runs", 0)
    forget_shuffles(docs.sparkSession)
    samples = step(_sample_keys, _together(blocks, runs), len(COVER) / PERIOD, REPEATED, "samples", 1)
    forget_shuffles(docs.sparkSession)
    strings = step(_suffix_keys, _together(blocks, runs, samples), 0.2, LATER, "suffixes", 1)
    forget_shuffles(docs.sparkSession)

    kind = blocks.schema["ids"].dataType.elementType
    out = T.StructType().add("id", kind).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    if with_text:
        span = T.StructType().add("begin", "long").add("length", "long")
        out = out.add("kept", "binary").add("spans", T.ArrayType(span))

    def judged(batches: Batches) -> Batches:
        from pyspark.sql.pandas.types import to_arrow_schema

        def rows():
            state = None
            for block, answers in _in_order(batches):
                covered = _covered(block, answers)
                for at, begin in enumerate(block.begins):
                    own = block.own[at]
                    state = state or _Document(with_text)
                    state.add(block.data[begin : begin + own], covered[begin : begin + own], covered[begin + own : begin + own + LENGTH - 1])
                    if block.last[at]:
                        yield block.ids[at], *state.result()
                        state = None

        yield from batches_of(to_arrow_schema(out), rows(), 2_000, BATCH_BYTES)

    result = written(_together(blocks, runs, strings).mapInArrow(judged, out), "strings-removed", compression="zstd")
    for table in (blocks, runs, samples, strings):
        drop_written(table)
    return result.withColumnRenamed("id", id_col) if id_col != "id" else result


def _covered(block: Block, answers: dict) -> np.ndarray:
    """Bytes of the block inside a window that starts earlier elsewhere; pieces end before the next begins."""
    steps = np.zeros(len(block.data) + 1, np.int32)
    begins, ends = block.runs()
    later = np.isin(begins, answers.get(0, np.zeros(0, np.int64)))
    np.add.at(steps, begins[later], 1)
    np.add.at(steps, ends[later] + LENGTH - 1, -1)
    windows = answers.get(1, np.zeros(0, np.int64))
    np.add.at(steps, windows, 1)
    np.add.at(steps, windows + LENGTH, -1)
    return np.cumsum(steps[:-1]) > 0


class _Document:
    """Bytes of one text, piece by piece; what a piece covers of the next is carried over."""

    def __init__(self, with_text: bool):
        self._sha = hashlib.sha256()
        self._bytes = self._removed = self._spans = 0
        self._inside = False
        self._carried = np.zeros(0, bool)
        self._kept: list[bytes] | None = [] if with_text else None
        self._runs: list[list[int]] = []

    def add(self, data: np.ndarray, covered: np.ndarray, beyond: np.ndarray) -> None:
        covered = covered.copy()
        size = min(len(self._carried), len(covered))
        covered[:size] |= self._carried[:size]
        self._carried = beyond
        edges = np.diff(np.concatenate([[self._inside], covered]).astype(np.int8))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self._spans += len(begins)
        kept = data[~covered].tobytes()
        self._sha.update(kept)
        if self._kept is not None:
            self._kept.append(kept)
            self._runs += [[self._bytes + int(b), -1] for b in begins]
            first = len(self._runs) - len(begins) - (1 if self._inside else 0)
            for k, end in enumerate(ends):
                self._runs[first + k][1] = self._bytes + int(end) - self._runs[first + k][0]
        self._bytes += len(data)
        self._removed += int(covered.sum())
        if len(covered):
            self._inside = bool(covered[-1])

    def result(self) -> tuple:
        row = self._bytes, self._removed, self._spans, self._sha.hexdigest()
        if self._kept is None:
            return row
        if self._inside:
            self._runs[-1][1] = self._bytes - self._runs[-1][0]
        return *row, b"".join(self._kept), [{"begin": b, "length": n} for b, n in self._runs]

"""Alignment of two tokenizers over a corpus.

Two token sequences of one text are intervals over its bytes.  Tokens that
overlap, directly or through others, make a group; groups are what lies between
two byte offsets where tokens of both sequences end.  Every token points to the
token that reaches farthest right among those it overlaps, and doubling these
pointers brings all tokens of a group to its last one, for all texts of a batch
at once.

Texts are encoded in runs that begin at a single blank after another character
than white space: neither tokenizer has a token across such a place, so runs
that repeat are encoded and aligned once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, batches_of, batches_up_to, pack_planes, unpack_planes, whole_text
from gaugeworks.llm.tokens import byte_letters, gathered_spans
from gaugeworks.sources.scratch import written

#: Pairs of ids whose counts are broadcast at once: 16 bytes each.  Rarer pairs meet their counts by a join.
BROADCAST_PAIRS = 2_000_000
#: Runs and links that a worker knows before it begins anew.
CACHE_RUNS = 500_000
CACHE_PAIRS = 4_000_000
#: Pairs a worker counts before it sends them on.
COUNTED_TOGETHER = 2_000_000
#: Groups with more pairs of occurrences are reduced to their distinct ids before pairs are made.
LARGE_GROUP = 4_096

# White space to Python or to either tokenizer, at the end of a run; and the empty run.
_OPEN_END = r"^$|[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]$"
# Fixed value: how byte-level vocabularies of this kind split a text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters that all libraries sort alike.
_COMMON = re.compile("[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f\n]*\\Z").match
_LINK_BITS = 32


class ByteLevel:
    """A byte-level vocabulary file of ``tokenizers``; a text is encoded with a blank before it."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True
        self._library.no_truncation()
        self._library.no_padding()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        before = rules.get("pre_tokenizer") or {}
        added = [token for token in rules.get("added_tokens", []) if not token["special"]]
        self.cuttable = (
            rules.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not added
        )
        values = {letter: byte for byte, letter in byte_letters().items()}
        size = self._library.get_vocab_size(with_added_tokens=True)
        self.bytes_of = [b""] * size
        for token, at in self._library.get_vocab(with_added_tokens=True).items():
            plain = all(letter in values for letter in token)
            self.bytes_of[at] = bytes(values[letter] for letter in token) if plain else token.encode()
        self._plain = self._by_rank(rules) if self.cuttable else None

    def _by_rank(self, rules: dict):
        """The same merges in a faster library, where ids follow the order of the merges."""
        model = rules["model"]
        merges = [merge if isinstance(merge, str) else " ".join(merge) for merge in model.get("merges", [])]
        order = [model["vocab"].get(merge.replace(" ", "")) for merge in merges]
        letters = {model["vocab"].get(letter) for letter in byte_letters().values()}
        if letters != set(range(256)) or order != list(range(256, 256 + len(merges))) or model.get("ignore_merges"):
            return None
        import tiktoken

        ranks = {self.bytes_of[at]: at for at in range(256 + len(merges))}
        return tiktoken.Encoding("merges", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, runs: list[str]) -> list[list[int]]:
        """Ids of each run; those of common letters take the faster way."""
        if self._plain is None:
            return self._encode(runs)
        found = [self._plain(" " + run) if _COMMON(run) else None for run in runs]
        others = [at for at, ids in enumerate(found) if ids is None]
        for at, ids in zip(others, self._encode([runs[at] for at in others])):
            found[at] = ids
        return found

    def _encode(self, runs: list[str]) -> list[list[int]]:
        return [found.ids for found in self._library.encode_batch_fast([" " + run for run in runs], add_special_tokens=False)]


class Pieces:
    """A model file of ``sentencepiece``, which adds the blank itself."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self._library = sentencepiece.SentencePieceProcessor(model_file=path)
        rules = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            rules.ParseFromString(file.read())
        pieces = [self._library.id_to_piece(at) for at in range(self._library.get_piece_size())]
        cleaning = rules.normalizer_spec
        self.cuttable = (
            cleaning.name == "identity"
            and cleaning.add_dummy_prefix
            and not cleaning.remove_extra_whitespaces
            and not rules.trainer_spec.treat_whitespace_as_suffix
            and not any("▁" in piece.lstrip("▁") for piece in pieces)
            and not any(piece.type == piece.USER_DEFINED for piece in rules.pieces)
        )
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if self._library.is_byte(at) else piece.replace("▁", " ").encode()
            for at, piece in enumerate(pieces)
        ]

    def encode(self, runs: list[str]) -> list[list[int]]:
        return self._library.encode(runs, num_threads=1)


def _reader(path: str):
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


def group_of_tokens(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of two sequences that cover the same bytes, numbered from the left.

    The tokens of B come after those of A in one row of pointers.  A token
    points to the one that overlaps it and ends last; only a token of B that
    ends where a token of A ends points to itself.
    """
    if not len(a_ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a_starts = np.concatenate([[0], a_ends[:-1]])
    b_starts = np.concatenate([[0], b_ends[:-1]])
    last_b = np.searchsorted(b_starts, a_ends, "left") - 1
    last_a = np.searchsorted(a_starts, b_ends, "left") - 1
    own = len(a_ends) + np.arange(len(b_ends))
    points = np.concatenate([len(a_ends) + last_b, np.where(a_ends[last_a] > b_ends, last_a, own)])
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            break
        points = farther
    last = np.flatnonzero(points[own] == own) + len(a_ends)
    return np.searchsorted(last, points[: len(a_ends)]), np.searchsorted(last, points[len(a_ends) :])


def linked_ids(
    a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray, groups: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, packed id pair and number of links of all pairs of occurrences that share a group."""
    n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    large = n_a * n_b > LARGE_GROUP
    found = []
    if large.any():
        for group in np.flatnonzero(large):
            left, times_left = np.unique(a_ids[a_group == group], return_counts=True)
            right, times_right = np.unique(b_ids[b_group == group], return_counts=True)
            pairs = (left[:, None] << _LINK_BITS | right).ravel()
            found.append((np.full(len(pairs), group), pairs, np.outer(times_left, times_right).ravel()))
    small_a = ~large[a_group]
    of_a, ids_a = a_group[small_a], a_ids[small_a]
    first_b = np.cumsum(n_b) - n_b
    ends, right = gathered_spans(first_b[of_a], n_b[of_a], b_ids)
    left = np.repeat(ids_a, n_b[of_a])
    found.append((np.repeat(of_a, n_b[of_a]), left << _LINK_BITS | right, np.ones(len(left), np.int64)))
    group, pairs, links = (np.concatenate(parts) for parts in zip(*found))
    return group, pairs, links


class _Known:
    """What is known of runs: counts, links and groups as text, end to end in flat arrays.  Row 0 has nothing."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.shown: list[bytes] = [b""]
        self.fits = np.ones(1, bool)
        self.counts = np.zeros((1, 3), np.int64)
        self.begins, self.lengths = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.pairs, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, fits: np.ndarray, counts: np.ndarray, lengths: np.ndarray, pairs: np.ndarray, links: np.ndarray, shown: list[bytes]) -> int:
        first = len(self.shown)
        self.shown += shown
        self.fits = np.concatenate([self.fits, fits])
        self.counts = np.concatenate([self.counts, counts])
        self.begins = np.concatenate([self.begins, len(self.pairs) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.links = np.concatenate([self.links, links])
        return first


class Aligner:
    """Aligned runs of texts; runs seen before are answered from a bounded table."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = _reader(a_path), _reader(b_path)
        self.cuttable = self.a.cuttable and self.b.cuttable
        self._a_bytes, self._b_bytes = _Vocabulary(self.a.bytes_of), _Vocabulary(self.b.bytes_of)
        # An id and whether it is the last of its side of a group, as text.
        self._words = [f"{at}{mark}".encode() for at in range(len(self.a.bytes_of)) for mark in ",|"]
        self._b_words = len(self._words)
        self._words += [f"{at}{mark}".encode() for at in range(len(self.b.bytes_of)) for mark in ",;"]
        self.known = _Known()

    def runs(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct runs; the runs of all texts as places among them; how many each text has."""
        if not self.cuttable:
            coded = texts.dictionary_encode()
            return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), np.ones(len(texts), np.int64)
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        open_end = pc.match_substring_regex(coded.dictionary, _OPEN_END).to_numpy(zero_copy_only=False)
        numbers = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.to_pylist()
        if not open_end.any():
            return words, at, numbers
        # Texts with runs that end in white space, or with several blanks together, are put together one by one.
        text_of = np.repeat(np.arange(len(numbers)), numbers)
        odd = np.zeros(len(numbers), bool)
        odd[text_of[open_end[at]]] = True
        places = {word: place for place, word in enumerate(words)}
        begin = np.cumsum(numbers) - numbers
        pieces = [at[b : b + n] for b, n in zip(begin.tolist(), numbers.tolist())]
        for text in np.flatnonzero(odd):
            merged = _closed(pieces[text].tolist(), words, open_end)
            pieces[text] = np.array([places.setdefault(run, len(places)) for run in merged], np.int64)
            numbers[text] = len(merged)
        return list(places), np.concatenate(pieces), numbers

    def rows_of(self, runs: list[str]) -> np.ndarray:
        """Where each run stands in the table of known runs; missing ones are aligned together."""
        missing = [run for run in runs if run not in self.known.rows]
        if missing and (len(self.known.shown) > CACHE_RUNS or len(self.known.pairs) > CACHE_PAIRS):
            self.known, missing = _Known(), runs
        if missing:
            first = self.known.add(*self._align(missing))
            self.known.rows.update(zip(missing, range(first, first + len(missing))))
        return np.fromiter(map(self.known.rows.__getitem__, runs), np.int64, len(runs))

    def whole_text(self, text: str) -> int:
        return self.known.add(*self._align([text]))

    def _align(self, runs: list[str]) -> tuple:
        """Whether the tokens of a run give its bytes back; then its counts, links and groups."""
        n_a, a_ids = _flat(self.a.encode(runs))
        n_b, b_ids = _flat(self.b.encode(runs))
        fits = self._fitting(runs, n_a, a_ids, n_b, b_ids)
        if not fits.all():
            a_ids, b_ids = a_ids[np.repeat(fits, n_a)], b_ids[np.repeat(fits, n_b)]
            n_a, n_b = n_a * fits, n_b * fits
        a_group, b_group = group_of_tokens(np.cumsum(self._a_bytes.lengths[a_ids]), np.cumsum(self._b_bytes.lengths[b_ids]))
        # Groups follow the runs: where each run's groups end.
        last_a = np.cumsum(n_a)
        ends = np.zeros(len(runs), np.int64)
        ends[n_a > 0] = a_group[last_a[n_a > 0] - 1] + 1
        ends = np.maximum.accumulate(ends)
        groups = int(ends[-1])
        group, pairs, links = linked_ids(a_ids, a_group, b_ids, b_group, groups)
        run_of, pairs, links = _summed(np.searchsorted(ends, group, "right"), pairs, links)
        lengths = np.bincount(run_of, minlength=len(runs))
        # Each group's ids of A, then its ids of B, with the mark that follows each.
        of_a, of_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        words = np.zeros(len(a_ids) + len(b_ids), np.int64)
        ends_a, ends_b = np.cumsum(of_a), np.cumsum(of_b)
        number_a, number_b = np.arange(len(a_ids)), np.arange(len(b_ids))
        words[number_a + (ends_b - of_b)[a_group]] = 2 * a_ids + (number_a + 1 == ends_a[a_group])
        words[number_b + ends_a[b_group]] = self._b_words + 2 * b_ids + (number_b + 1 == ends_b[b_group])
        texts = list(map(self._words.__getitem__, words.tolist()))
        bounds = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        shown = [b"".join(texts[begin:end]) for begin, end in zip(bounds, bounds[1:])]
        counts = np.stack([n_a, n_b, np.diff(ends, prepend=0)], 1)
        return fits, counts, lengths, pairs, links, shown

    def _fitting(self, runs: list[str], n_a: np.ndarray, a_ids: np.ndarray, n_b: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
        expected = [f" {run}".encode() for run in runs]
        a_bytes, b_bytes = self._a_bytes.text(a_ids), self._b_bytes.text(b_ids)
        lengths = np.fromiter(map(len, expected), np.int64, len(runs))
        a_lengths, b_lengths = (
            np.bincount(np.repeat(np.arange(len(runs)), n), vocabulary.lengths[ids], len(runs)).astype(np.int64)
            for n, vocabulary, ids in ((n_a, self._a_bytes, a_ids), (n_b, self._b_bytes, b_ids))
        )
        fits = (lengths == a_lengths) & (lengths == b_lengths)
        if fits.all() and a_bytes == b_bytes == b"".join(expected):
            return fits
        begin_a, begin_b = np.cumsum(a_lengths) - a_lengths, np.cumsum(b_lengths) - b_lengths
        for at in np.flatnonzero(fits).tolist():
            a, b, n = int(begin_a[at]), int(begin_b[at]), int(lengths[at])
            fits[at] = a_bytes[a : a + n] == b_bytes[b : b + n] == expected[at]
        return fits


class _Vocabulary:
    """The bytes of all tokens, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(token) for token in tokens], np.int64)
        self._begins = np.cumsum(self.lengths) - self.lengths
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def text(self, ids: np.ndarray) -> bytes:
        return gathered_spans(self._begins[ids], self.lengths[ids], self._bytes)[1].tobytes()


def _closed(places: list[int], words: list[str], open_end: np.ndarray) -> list[str]:
    """The runs of one text: cut only at a blank after another character than white space."""
    merged: list[str] = []
    held: list[str] = []
    for place in places:
        held.append(words[place])
        if not open_end[place]:
            merged.append(" ".join(held))
            held = []
    if held:
        # White space at the end stays with what is before it.
        rest = " ".join(held)
        merged[-1:] = [f"{merged[-1]} {rest}" if merged else rest]
    return merged


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each list has, and all ids."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return lengths, np.fromiter(chain.from_iterable(lists), np.int64, int(lengths.sum()))


def _summed(owner: np.ndarray, pairs: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links summed by owner and pair, in this order."""
    order = np.lexsort((pairs, owner))
    owner, pairs, links = owner[order], pairs[order], links[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (pairs[1:] != pairs[:-1])
    at = np.flatnonzero(first)
    return owner[at], pairs[at], np.add.reduceat(links, at) if len(at) else links


_aligners: dict = {}


def _worker_aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this Python worker, kept between tasks."""
    key = (a_path, b_path)
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(a_path, b_path)
    return _aligners[key]


def _least_width(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _unpacked(data: bytes, count: int) -> np.ndarray:
    if not count:
        return np.zeros(0, np.int64)
    return unpack_planes(data, np.dtype(f"u{len(data) // count}")).astype(np.int64)


_ENCODED = "row long, id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs long, pairs binary, links binary"


def encode_and_align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table with one row per document: its tokens, groups and distinct id pairs with their links."""
    rows = docs.select(ref(id_col).alias("id"), whole_text(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def align(batches: Batches) -> Batches:
        aligner = _worker_aligner(a_path, b_path)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = _aligned_batch(aligner, batch.column("text"))
            places = pa.array(np.arange(number, number + batch.num_rows))
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [places, batch.column("id"), *columns],
                ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs", "pairs", "links"],
            )

    with batches_up_to(docs.sparkSession, "4m"):
        return written(rows.mapInArrow(align, _ENCODED.format(id=kind)), "aligned", compression="zstd")


def _aligned_batch(aligner: Aligner, texts: pa.Array) -> list[pa.Array]:
    words, at, numbers = aligner.runs(texts)
    at = aligner.rows_of(words)[at]
    ends = np.cumsum(numbers)
    owner = np.repeat(np.arange(len(numbers)), numbers)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at[empty[owner]] = 0
    broken = np.zeros(len(numbers), bool)
    broken[owner[~aligner.known.fits[at]]] = True
    for text in np.flatnonzero(broken):
        # The runs may differ from their bytes and the text may not: the text decides, its runs count nothing.
        at[ends[text] - numbers[text] : ends[text]] = 0
        at[ends[text] - numbers[text]] = aligner.whole_text(texts[int(text)].as_py())
    known = aligner.known
    totals = [np.bincount(owner, known.counts[at, k], minlength=len(numbers)).astype(np.int64) for k in range(3)]
    of_text = np.repeat(owner, known.lengths[at])
    _, places = gathered_spans(known.begins[at], known.lengths[at], np.arange(len(known.pairs)))
    of_text, pairs, links = _summed(of_text, known.pairs[places], known.links[places])
    bounds = np.searchsorted(of_text, np.arange(len(numbers) + 1))
    n_links = np.add.reduceat(np.append(links, 0), bounds[:-1]) * (np.diff(bounds) > 0)
    shown = list(map(known.shown.__getitem__, at.tolist()))
    digests, packed_pairs, packed_links = [], [], []
    for text, (begin, end) in enumerate(zip((ends - numbers).tolist(), ends.tolist())):
        groups = b"".join(shown[begin:end])[:-1]
        digests.append(hashlib.sha256(groups).hexdigest() if groups else "")
        span = slice(bounds[text], bounds[text + 1])
        packed_pairs.append(pack_planes(_narrow_pairs(pairs[span])))
        packed_links.append(pack_planes(_least_width(links[span])))
    return [
        *[pa.array(total) for total in totals],
        pa.array(n_links.astype(np.int64)),
        pa.array(digests, pa.string()),
        pa.array(np.diff(bounds)),
        pa.array(packed_pairs, pa.binary()),
        pa.array(packed_links, pa.binary()),
    ]


def _narrow_pairs(pairs: np.ndarray) -> np.ndarray:
    """Pairs of ids below 65,536 take four bytes."""
    left, right = pairs >> _LINK_BITS, pairs & ((1 << _LINK_BITS) - 1)
    if len(pairs) and max(left.max(), right.max()) >= 1 << 16:
        return pairs.astype(np.uint64)
    return (left << 16 | right).astype(np.uint32)


def _wide_pairs(data: bytes, count: int) -> np.ndarray:
    values = _unpacked(data, count)
    if count and len(data) == 4 * count:
        return (values >> 16) << _LINK_BITS | (values & 0xFFFF)
    return values


def _batch_pairs(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [_wide_pairs(data, n) for data, n in zip(batch.column("pairs").to_pylist(), batch.column("n_pairs").to_pylist())]


def linked_pairs(encoded: DataFrame) -> DataFrame:
    """``a_id, b_id, n_docs, best``: in how many documents a pair is linked; the most frequent of its A id, ties included.

    Workers count the pairs of many documents before anything is shuffled.
    """

    def count(batches: Batches) -> Batches:
        held: list[np.ndarray] = []
        total = 0

        def sent() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array((pairs >> _LINK_BITS)), pa.array(pairs & ((1 << _LINK_BITS) - 1)), pa.array(n)], ["a_id", "b_id", "n"]
            )

        for batch in batches:
            for pairs in _batch_pairs(batch):
                held.append(pairs)
                total += len(pairs)
            if total >= COUNTED_TOGETHER:
                yield sent()
                held, total = [], 0
        if total:
            yield sent()

    counted = encoded.select("n_pairs", "pairs").mapInArrow(count, "a_id long, b_id long, n long")
    return (
        counted.groupBy("a_id", "b_id")
        .agg(F.sum("n").alias("n_docs"))
        .withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a_id")))
    )


def align_tokenizers(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """Per row: ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_links`` counts the pairs of occurrences of A and B tokens in one group.
    A pair of ids counts the documents in which it is linked; ``count_sum`` sums
    these counts over the links, ``n_best`` counts the links whose count is the
    highest of their A id.  ``groups_sha256`` digests the ids of all groups.

    Null and empty texts, and texts that the tokens of either file do not give
    back byte for byte, have zeros and an empty digest, and link nothing.
    Repeated rows count each; a null id stays null; other columns are not
    looked at; an empty table gives an empty result.

    Counts of frequent pairs are broadcast, at most ``broadcast_pairs`` of them.
    Rarer pairs meet their counts by a join: each is in fewer documents than
    the rarest one broadcast, so that no key of the join is hot.
    """
    spark = docs.sparkSession
    encoded = encode_and_align(docs, a_path, b_path, id_col, text_col)
    rated = written(linked_pairs(encoded), "linked-pairs", compression="zstd")
    frequent, least = _frequent(rated, broadcast_pairs)
    table = spark.sparkContext.broadcast(frequent)

    def score(batches: Batches) -> Batches:
        keys, values = table.value
        for batch in batches:
            sums, best = [], []
            for pairs, data in zip(_batch_pairs(batch), batch.column("links").to_pylist()):
                links = _unpacked(data, len(pairs))
                known, at = _looked_up(keys, pairs)
                found = values[at[known]]
                sums.append(int((links[known] * (found >> 1)).sum()))
                best.append(int((links[known] * (found & 1)).sum()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in kept], pa.array(sums, pa.int64()), pa.array(best, pa.int64())],
                [*kept, "count_sum", "n_best"],
            )

    kept = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kind = encoded.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, count_sum long, n_best long"
    scored = encoded.select(*kept, "n_pairs", "pairs", "links").mapInArrow(score, schema)
    if least > 1:
        scored = _with_rare(scored, _rare_links(encoded, table), rated.filter(F.col("n_docs") < least))
    return scored.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def _looked_up(keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are among the sorted keys, and where each would be."""
    at = np.searchsorted(keys, pairs)
    known = np.zeros(len(pairs), bool)
    inside = at < len(keys)
    known[inside] = keys[at[inside]] == pairs[inside]
    return known, at


def _frequent(rated: DataFrame, limit: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """The pairs found in at least so many documents, sorted, with count and mark in one number; and so many.

    The bound is the least power of two that leaves at most ``limit`` pairs.
    """
    power = F.length(F.bin("n_docs")) - 1
    sizes = {row["power"]: row["n"] for row in rated.groupBy(power.alias("power")).agg(F.count("*").alias("n")).collect()}
    least, held = max(sizes, default=0) + 1, 0
    while least > 0 and held + sizes.get(least - 1, 0) <= limit:
        least -= 1
        held += sizes.get(least, 0)
    chosen = rated.filter(F.col("n_docs") >= 1 << least).select(
        F.shiftleft(F.col("a_id"), _LINK_BITS).bitwiseOR(F.col("b_id")).alias("pair"),
        (F.col("n_docs") * 2 + F.col("best").cast("long")).alias("value"),
    )
    found = chosen.toArrow()
    pairs, values = found["pair"].to_numpy(), found["value"].to_numpy()
    order = np.argsort(pairs)
    return (pairs[order], values[order]), 1 << least


def _rare_links(encoded: DataFrame, table) -> DataFrame:
    """The links of pairs that are not among the broadcast ones."""

    def rare(batches: Batches) -> Batches:
        keys, _ = table.value

        def rows() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, pairs, data in zip(
                    batch.column("row").to_pylist(), _batch_pairs(batch), batch.column("links").to_pylist()
                ):
                    known, _ = _looked_up(keys, pairs)
                    if known.all():
                        continue
                    left = pairs[~known]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(left), row)),
                            pa.array(left >> _LINK_BITS),
                            pa.array(left & ((1 << _LINK_BITS) - 1)),
                            pa.array(_unpacked(data, len(pairs))[~known]),
                        ],
                        ["row", "a_id", "b_id", "links"],
                    )

        yield from rows()

    return encoded.select("row", "n_pairs", "pairs", "links").mapInArrow(rare, "row long, a_id long, b_id long, links long")


def _with_rare(scored: DataFrame, links: DataFrame, rated: DataFrame) -> DataFrame:
    sums = (
        links.join(rated, ["a_id", "b_id"])
        .groupBy("row")
        .agg(
            F.sum(F.col("links") * F.col("n_docs")).alias("rare_sum"),
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("rare_best"),
        )
    )
    return scored.join(sums, "row", "left").withColumns(
        {
            "count_sum": F.col("count_sum") + F.coalesce("rare_sum", F.lit(0)),
            "n_best": F.col("n_best") + F.coalesce("rare_best", F.lit(0)),
        }
    )

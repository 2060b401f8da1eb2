"""Exact token ids from a cache of white-space chunks.

A vocabulary whose pre-tokenizer drops white space never lets a token cross it,
so the ids of a text are the ids of its chunks one after the other.  Chunks of
plain letters, digits and punctuation are split and merged piece by piece with
the library's own model; everything else goes through the library whole.  Files
of another kind are always encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# White space to Python but not to the tokenizer, or the other way round: such texts are encoded whole.
_ODD_SPACE = re.compile("[\x1c-\x1f\u180e]")
_ODD_SPACE_ARROW = r"[\x1c-\x1f\x{180e}]"
# Characters that normalization leaves alone and whose lower case needs no context.
_PLAIN = re.compile(r"[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f]*\Z")
_SPECIAL = "<|"
# What a chunk of the plain kind does not hold, to Arrow.
_NOT_PLAIN_ARROW = r"[^!-~\x{a1}-\x{ac}\x{ae}-\x{12f}\x{131}-\x{17f}]|<\|"
CACHE_CHUNKS = 200_000
CACHE_PIECES = 200_000
#: Texts are taken together up to so many bytes, so what repeats in them is looked up once.
TOGETHER_BYTES = 4 << 20
_PACKED = [struct.Struct(f"<{size}I").pack for size in range(17)]


def byte_letters() -> dict[int, str]:
    """The usual one-letter-per-byte alphabet of byte-level vocabularies, by its rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkEncoder:
    """Ids or counts of whole texts; what is seen often is answered from a bounded table."""

    def __init__(self, path: str, counts_only: bool, frequent: dict[str, int] | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        self.counts_only = counts_only
        self.by_chunk = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._library = lambda text: model.encode(text, num_threads=1) if text else []
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self._library = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
            self._model = tokenizer.model
            self._read_rules(path)
        self.frequent = frequent or {}
        # Two generations each: when the young one is full it becomes the old one.
        self._chunks, self._old_chunks = dict(self.frequent), {}
        self._pieces, self._old_pieces = {}, {}

    def _read_rules(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        cleaning = [step["type"] for step in (rules.get("normalizer") or {}).get("normalizers", [])]
        marks = [added["content"] for added in rules.get("added_tokens", [])]
        self.by_chunk = (
            [step["type"] for step in steps] == ["Split", "ByteLevel"]
            and steps[0].get("behavior") == "Removed"
            and steps[0].get("invert") is True
            and not steps[1]["add_prefix_space"]
            and not steps[1]["use_regex"]
            and cleaning == ["NFC", "Replace", "Lowercase"]
            and all(mark.startswith(_SPECIAL) and not re.search(r"\s", mark) for mark in marks)
        )
        if self.by_chunk:
            pattern = steps[0]["pattern"]["Regex"]
            self._split = regex.compile(pattern).findall
            self._split_lines = regex.compile(pattern + "|\n").findall
            self._letters = byte_letters()

    def _value(self, ids: list[int]):
        if self.counts_only:
            return len(ids)
        return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else struct.pack(f"<{len(ids)}I", *ids)

    def _miss(self, chunk: str):
        value = self._old_chunks.get(chunk)
        if value is None:
            value = self._encode(chunk)
        if len(chunk) <= 64:
            if len(self._chunks) >= CACHE_CHUNKS + len(self.frequent):
                self._chunks, self._old_chunks = dict(self.frequent), self._chunks
            self._chunks[chunk] = value
        return value

    def _encode(self, chunk: str):
        if len(chunk) > 1024 or _SPECIAL in chunk or not _PLAIN.match(chunk):
            return self._value(self._library(chunk))
        lowered = chunk.lower()
        words = (lowered,) if lowered.isalpha() else self._split(lowered)
        found = [self._piece(word) for word in words]
        return sum(found) if self.counts_only else b"".join(found)

    def _piece(self, word: str):
        value = self._pieces.get(word)
        return self._missing_piece(word) if value is None else value

    def _missing_piece(self, word: str):
        value = self._old_pieces.get(word)
        if value is None:
            # Printable ASCII stands for itself in the alphabet of bytes.
            mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
            value = self._value([token.id for token in self._model.tokenize(mapped)])
        if len(word) <= 64:
            if len(self._pieces) >= CACHE_PIECES:
                self._pieces, self._old_pieces = {}, self._pieces
            self._pieces[word] = value
        return value

    def _values(self, text: str) -> list:
        chunks = text.split()
        values = list(map(self._chunks.get, chunks))
        if None in values:
            for at, value in enumerate(values):
                if value is None:
                    values[at] = self._miss(chunks[at])
        return values

    def count(self, text: str) -> int:
        if self.by_chunk and not _ODD_SPACE.search(text):
            return sum(self._values(text))
        return len(self._library(text))

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.by_chunk and not _ODD_SPACE.search(text):
            return b"".join(self._values(text))
        return np.array(self._library(text), "<u4").tobytes()

    def ids_together(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a column without nulls; chunks and pieces that repeat are looked up once."""
        if not self.by_chunk:
            for text in texts.to_pylist():
                yield np.array(self._library(text), "<u4")
            return
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < len(texts):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + TOGETHER_BYTES, "right")))
            yield from self._some(texts.slice(begin, end - begin))
            begin = end

    def _some(self, texts: pa.Array) -> Iterator[np.ndarray]:
        odd = pc.match_substring_regex(texts, _ODD_SPACE_ARROW)
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        chunks = split.flatten().dictionary_encode()
        unlike = pc.or_(
            pc.match_substring_regex(chunks.dictionary, _NOT_PLAIN_ARROW), pc.greater(pc.utf8_length(chunks.dictionary), 1024)
        )
        offsets, values = self._chunk_ids(chunks.dictionary, ~unlike.to_numpy(zero_copy_only=False))
        at = chunks.indices.to_numpy(zero_copy_only=False)
        ends, ids = _gathered(offsets, values, at)
        # Ends of texts, counted in chunks and then in ids.
        of_texts = ends[np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))]
        begin = 0
        for number, (end, alone) in enumerate(zip(of_texts.tolist(), odd.to_pylist())):
            yield np.array(self._library(texts[number].as_py()), "<u4") if alone else ids[begin:end]
            begin = end

    def _chunk_ids(self, chunks: pa.Array, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the ids of each chunk in one array, and that array.

        Chunks of ASCII letters are one piece each, other plain ones are split.
        """
        letters = pc.ascii_is_alpha(chunks).to_numpy(zero_copy_only=False) & plain
        mixed = plain & ~letters
        others = [self._chunks.get(chunk) or self._miss(chunk) for chunk in chunks.filter(pa.array(~plain)).to_pylist()]
        lines = chunks.filter(pa.array(mixed)).to_pylist()
        split = pa.array(self._split_lines("\n".join(lines).lower()), pa.string())
        whole = pc.ascii_lower(chunks.filter(pa.array(letters))).cast(pa.string())
        pieces = pa.chunked_array([whole, split]).combine_chunks().dictionary_encode()
        words = pieces.dictionary.to_pylist()
        known = list(map(self._pieces.get, words))
        for k, value in enumerate(known):
            if value is None:
                known[k] = b"" if words[k] == "\n" else self._missing_piece(words[k])
        at = pieces.indices.to_numpy(zero_copy_only=False)
        ends, ids = _gathered(*_laid_out(known), at)
        bounds = [np.arange(len(whole) + 1)]
        if lines:
            # A line ends where its separator is; the last one at the end.
            breaks = np.flatnonzero(at == words.index("\n")) if len(lines) > 1 else []
            bounds.append(np.append(breaks, len(at)).astype(np.int64))
        edges = ends[np.concatenate(bounds)]
        other_offsets, other_ids = _laid_out(others)
        lengths, begins = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        for kind, (offsets, base) in zip(
            (letters, mixed, ~plain), ((edges[: len(whole) + 1], 0), (edges[len(whole) :], 0), (other_offsets, len(ids)))
        ):
            lengths[kind], begins[kind] = np.diff(offsets), base + offsets[:-1]
        return gathered_spans(begins, lengths, np.concatenate([ids, other_ids]))


def _laid_out(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of packed values, end to end."""
    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, values), np.int64, len(values)) // 4, out=offsets[1:])
    return offsets, np.frombuffer(b"".join(values), "<u4")


def _gathered(offsets: np.ndarray, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return gathered_spans(offsets[at], (offsets[1:] - offsets[:-1])[at], values)


def gathered_spans(begins: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the spans when laid end to end, and their values."""
    offsets = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    places = np.repeat(begins - offsets[:-1], lengths) + np.arange(offsets[-1])
    return offsets, values[places]


_encoders: dict = {}


def worker_encoder(path: str, counts_only: bool, frequent=None) -> ChunkEncoder:
    """The encoder of this Python worker, kept between tasks.  ``frequent`` makes the first-tier table."""
    key = (path, counts_only, None if frequent is None else frequent.id)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = ChunkEncoder(path, counts_only, None if frequent is None else frequent.table())
    return _encoders[key]


def forget_encoders() -> None:
    """Let a worker that has other work give back the tables of its encoder."""
    _encoders.clear()

"""Benchmark passages in documents, found up to a number of edits.

A test item may differ from the passage by ``error_rate`` of its letters.  Cut
into one piece more than that many edits, at least one piece must occur
unchanged, so an automaton over all pieces finds every candidate; a
bit-parallel scan of the letters around the hit settles the edit distance.
"""

from __future__ import annotations

import uuid

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, batches_of, whole_text

#: Items are searched in blocks of at most so many bytes; a larger benchmark takes more passes.
BLOCK_BYTES = 8 << 20
ERROR_RATE = 0.05
#: Shorter items allow no edits and must stand as whole words.
MIN_LETTERS = 32


def normalized(text: str | None) -> str:
    """Lower case, runs of white space as one space, none at the ends."""
    return " ".join((text or "").lower().split())


def error_budget(length: int, error_rate: float = ERROR_RATE) -> int:
    return int(length * error_rate) if length >= MIN_LETTERS else 0


def stands_alone(text: str, begin: int, end: int) -> bool:
    """Whether ``text[begin:end]`` neither begins nor ends inside a word."""
    begins = begin == 0 or not (text[begin].isalnum() and text[begin - 1].isalnum())
    return begins and (end == len(text) or not (text[end - 1].isalnum() and text[end].isalnum()))


def pieces(pattern: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces with their offsets, of about equal length."""
    count, length = errors + 1, len(pattern)
    cuts = [length * k // count for k in range(count + 1)]
    return [(begin, pattern[begin:end]) for begin, end in zip(cuts, cuts[1:])]


def letter_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for at, letter in enumerate(pattern):
        masks[letter] = masks.get(letter, 0) | 1 << at
    return masks


def best_distance(masks: dict[str, int], length: int, text: str) -> int:
    """The least edit distance of the pattern to any substring of ``text`` (Myers, 1999)."""
    full = (1 << length) - 1
    last = 1 << (length - 1)
    up, down, score, best = full, 0, length, length
    for letter in text:
        equal = masks.get(letter, 0)
        vertical = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        rise = down | (~(diagonal | up) & full)
        fall = up & diagonal
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
            if score < best:
                best = score
        rise = (rise << 1) & full
        fall = (fall << 1) & full
        up = fall | (~(vertical | rise) & full)
        down = rise & vertical
    return best


class PieceIndex:
    """The automaton over the pieces of some items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = {}
        owners: dict[str, list] = {}
        for item, pattern in items:
            errors = error_budget(len(pattern), error_rate)
            self.items[item] = (pattern, errors, letter_masks(pattern))
            for offset, piece in pieces(pattern, errors):
                owners.setdefault(piece, []).append((item, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in owners.items():
            self.automaton.add_word(piece, (len(piece), found))
        if owners:
            self.automaton.make_automaton()

    def search(self, text: str) -> dict[int, int]:
        """Item to edit distance, for the items whose best passage in ``text`` keeps the budget."""
        best: dict[int, int] = {}
        if not self.items or not text:
            return best
        tried: set = set()
        for end, (size, owners) in self.automaton.iter(text):
            for item, offset in owners:
                known = best.get(item)
                if known == 0:
                    continue
                begin = end + 1 - size - offset
                if (item, begin) in tried:
                    continue
                tried.add((item, begin))
                pattern, errors, masks = self.items[item]
                if len(pattern) < MIN_LETTERS:
                    if stands_alone(text, begin, end + 1):
                        best[item] = 0
                    continue
                if begin >= 0 and text.startswith(pattern, begin):
                    best[item] = 0
                    continue
                window = text[max(0, begin - errors) : begin + len(pattern) + errors]
                distance = best_distance(masks, len(pattern), window)
                if distance <= errors and (known is None or distance < known):
                    best[item] = distance
        return best


_indexes: dict = {}


def contaminated_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = ERROR_RATE,
) -> DataFrame:
    """``id_col, contaminated, n_items, item_ids, min_errors`` for every row that holds a passage of an item.

    Both sides are compared in lower case with white space runs as one space.
    An item is found if some substring of the document is within
    ``error_rate`` of the item's letters in edit distance; an item of fewer than
    ``MIN_LETTERS`` letters has to occur unchanged and as whole words.  Items
    that are null or empty are in no document; equal items are all named; items that repeat an id count as one if equal and are searched each
    if not.  Null and empty documents hold nothing; repeated rows and null ids
    are reported as they are; an empty table on either side gives no rows.
    Documents are scanned where they lie, once per block of items.
    """
    spark = docs.sparkSession
    cleaned = items.select(ref(item_col).alias("item"), whole_text(item_text_col).alias("text")).distinct()
    size = cleaned.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    rows = docs.select(ref(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), whole_text(text_col).alias("text"))
    kind, item_kind = rows.schema["id"].dataType.simpleString(), cleaned.schema["item"].dataType.simpleString()
    found = None
    for block in range(blocks):
        own = cleaned.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        patterns = [(row["item"], normalized(row["text"])) for row in own]
        numbered = [(number, text) for number, (_, text) in enumerate(patterns) if text]
        names = [name for name, _ in patterns]
        shared, key = spark.sparkContext.broadcast((numbered, names)), uuid.uuid4().hex

        def searched(batches: Batches, shared=shared, key=key) -> Batches:
            if key not in _indexes:
                _indexes.clear()
                _indexes[key] = PieceIndex(shared.value[0], error_rate)
            index, names = _indexes[key], shared.value[1]
            for batch in batches:
                schema = pa.schema(
                    [("id", batch.schema.field("id").type), ("row", pa.int64()), ("item", names_type), ("errors", pa.int64())]
                )

                def rows(batch=batch):
                    for doc, row, text in zip(*(batch.column(name).to_pylist() for name in ("id", "row", "text"))):
                        for number, errors in index.search(normalized(text)).items():
                            yield doc, row, names[number], errors

                yield from batches_of(schema, rows())

        names_type = pa.string() if item_kind == "string" else pa.int64()
        part = rows.mapInArrow(searched, f"id {kind}, row long, item {'string' if item_kind == 'string' else 'long'}, errors long")
        found = part if found is None else found.unionByName(part)
    return (
        found.groupBy("row", "id")
        .agg(F.array_sort(F.collect_set("item")).alias("item_ids"), F.min("errors").alias("min_errors"))
        .select(
            F.col("id").alias(id_col),
            F.lit(True).alias("contaminated"),
            F.size("item_ids").cast("long").alias("n_items"),
            "item_ids",
            "min_errors",
        )
    )

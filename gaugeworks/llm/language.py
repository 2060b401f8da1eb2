"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character n-grams of the letters of a
text.  Document frequencies come from every training row; the weights are fitted
on a bounded sample per language by follow-the-regularised-leader with an L1 and
an L2 penalty, in one task, and the temperature of the softmax is calibrated on
a part of the sample that the fit has not seen.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, add_shards, batches_of, whole_text
from gaugeworks.llm.tokens import forget_encoders

UNDETERMINED = "und"
FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
MAX_N = 3
#: About so many rows per language are fitted on; all rows shape the document frequencies.
SAMPLE_PER_LANGUAGE = 1_500
#: More labels than so many raise an error: the weights of all must fit a worker.
MAX_LANGUAGES = 256
CALIBRATION_SHARE = 0.2
DOUBT = 0.01
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0005, 0.001
_SHARD = 1 << 10
_LETTERS_AT_ONCE = 1 << 20

_letter_table: list = []


def _is_letter() -> np.ndarray:
    if not _letter_table:
        _letter_table.append(np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000))
    return _letter_table[0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def ngram_counts(text: str) -> np.ndarray | None:
    """Occurrences per hashed n-gram (n = 1 to ``MAX_N``) of lower-case letters; None without letters.

    Every run of other characters is one separator.  Long texts go through in
    slices that overlap, so each n-gram is counted once.
    """
    codes = _codes(text.lower())
    letters = _is_letter()[codes]
    if not letters.any():
        return None
    kept = np.where(letters, codes, 0)
    # One separator at each end and for each run.
    kept = np.concatenate([[0], kept, [0]]).astype(np.uint32)
    stay = np.ones(len(kept), bool)
    stay[1:] = (kept[1:] != 0) | (kept[:-1] != 0)
    kept = kept[stay]
    counts = np.zeros(FEATURES, np.int64)
    with np.errstate(over="ignore"):
        for begin in range(0, len(kept), _LETTERS_AT_ONCE):
            part = kept[begin : begin + _LETTERS_AT_ONCE + MAX_N - 1]
            own = min(_LETTERS_AT_ONCE, len(kept) - begin)
            hashed = np.zeros(len(part), np.uint32)
            for n in range(1, MAX_N + 1):
                size = len(part) - n + 1
                if size <= 0:
                    break
                hashed = hashed[:size] * np.uint32(0x01000193) + part[n - 1 :] + np.uint32(n)
                mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                counts += np.bincount((mixed >> np.uint32(32 - FEATURE_BITS))[:own], minlength=FEATURES)
    return counts


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and weights: logarithmic term frequency times idf, of length one."""
    at = np.flatnonzero(counts)
    weights = (1 + np.log(counts[at])) * idf[at]
    norm = np.linalg.norm(weights)
    return at, (weights / norm if norm else weights)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Rows that hold each feature, and all rows, over every row of ``texts(text)``.

    Each task sends one array per shard of features; shards are added apart.
    """
    schema = pa.schema([("shard", pa.int32()), ("counts", pa.binary())])

    def counted(batches: Batches) -> Batches:
        forget_encoders()
        total, rows = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts = ngram_counts(text)
                if counts is not None:
                    total += counts > 0
                    rows += 1
        if rows:
            parts = [(shard, total[shard * _SHARD : (shard + 1) * _SHARD].tobytes()) for shard in range(FEATURES // _SHARD)]
            yield from batches_of(schema, iter([*parts, (-1, np.array([rows], np.int64).tobytes())]))

    def added(batches: Batches) -> Batches:
        parts = (
            (shard, np.frombuffer(counts, np.int64))
            for batch in batches
            for shard, counts in zip(*(column.to_pylist() for column in batch.columns))
        )
        sums = add_shards(parts, lambda total, values: values.copy() if total is None else total + values)
        yield from batches_of(schema, ((shard, total.tobytes()) for shard, total in sums))

    found = (
        texts.mapInArrow(counted, "shard int, counts binary")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(added, "shard int, counts binary")
        .collect()
    )
    total, rows = np.zeros(FEATURES, np.int64), 0
    for row in found:
        values = np.frombuffer(row["counts"], np.int64)
        if row["shard"] < 0:
            rows = int(values[0])
        else:
            total[row["shard"] * _SHARD : (row["shard"] + 1) * _SHARD] = values
    return total, rows


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(-1, keepdims=True))
    return raised / raised.sum(-1, keepdims=True)


def fit_ftrl(samples: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights ``(FEATURES + 1, classes)``, the last row the intercepts; most are exactly zero."""
    z = np.zeros((FEATURES + 1, classes))
    squares = np.zeros((FEATURES + 1, classes))

    def weights(z_part, squares_part):
        strength = (BETA + np.sqrt(squares_part)) / ALPHA + L2
        return np.where(np.abs(z_part) <= L1, 0.0, -(z_part - np.sign(z_part) * L1) / strength)

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for which in rng.permutation(len(samples)):
            label, at, values = samples[which]
            rows = np.append(at, FEATURES)
            inputs = np.append(values, 1.0)
            z_part, squares_part = z[rows], squares[rows]
            current = weights(z_part, squares_part)
            error = _softmax(inputs @ current)
            error[label] -= 1
            gradient = inputs[:, None] * error
            change = (np.sqrt(squares_part + gradient**2) - np.sqrt(squares_part)) / ALPHA
            z[rows] = z_part + gradient - change * current
            squares[rows] = squares_part + gradient**2
    return weights(z, squares)


def calibrate(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_temperature: float) -> float:
        chances = np.log(np.maximum(_softmax(scores / math.exp(log_temperature)), 1e-12))
        right = chances[np.arange(len(labels)), labels]
        # A little doubt, or a part without errors would ask for no temperature at all.
        return float(-((1 - DOUBT) * right + DOUBT * chances.mean(1)).mean())

    low, high, ratio = -4.0, 4.0, (math.sqrt(5) - 1) / 2
    left, right = high - ratio * (high - low), low + ratio * (high - low)
    for _ in range(60):
        if loss(left) <= loss(right):
            high, right = right, left
            left = high - ratio * (high - low)
        else:
            low, left = left, right
            right = low + ratio * (high - low)
    return math.exp((low + high) / 2)


class LanguageModel:
    """Labels, inverse document frequencies, weights and temperature; its size is bounded by the features."""

    def __init__(self, labels: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.labels, self.idf, self.weights, self.temperature = labels, idf, weights, temperature

    def scores(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[at] + self.weights[FEATURES]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text) if text else None
        if counts is None or not self.labels:
            return UNDETERMINED, 0.0
        chances = _softmax(self.scores(*tf_idf(counts, self.idf)) / self.temperature)
        best = int(chances.argmax())
        return self.labels[best], float(min(1.0, chances[best]))


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    id_col: str = "doc_id",
) -> LanguageModel:
    """Fit on the rows of ``docs`` with a text and a label that is not null.

    Which rows are fitted on follows from id and text, so the same rows in
    another layout give the same model; rows that repeat id, text and label are
    drawn as one.  Without a column ``id_col`` the text alone decides.
    """
    key = ref(id_col).cast("string") if id_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(key.alias("row"), whole_text(text_col).alias("text"), ref(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull()
    )
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    labels = sorted(row["lang"] for row in sizes)
    if not labels:
        return LanguageModel([], np.zeros(FEATURES), np.zeros((FEATURES + 1, 0)), 1.0)
    totals, count = document_frequencies(rows)
    idf = np.log((1 + count) / (1 + totals)) + 1
    number = {lang: at for at, lang in enumerate(labels)}
    # Rows are drawn one by one, also those of equal texts: no group of copies can swell the sample.
    scale = 1 << 20
    limit = {row["lang"]: min(scale, math.ceil(scale * sample_per_language / row["n"])) for row in sizes}
    chosen: Column = F.lit(False)
    place = F.pmod(F.xxhash64("row", "text"), F.lit(scale))
    for lang in labels:
        chosen = chosen | ((F.col("lang") == lang) & (place < limit[lang]))
    drawn = rows.filter(chosen).dropDuplicates(["row", "text", "lang"])
    sample = drawn.select("text", "lang", F.xxhash64(F.lit(1), "row", "text").alias("place"))
    shared = docs.sparkSession.sparkContext.broadcast(idf.astype(np.float32))

    def featured(batches: Batches) -> Batches:
        schema = pa.schema([("label", pa.int32()), ("place", pa.int64()), ("at", pa.binary()), ("weights", pa.binary())])

        def out():
            for batch in batches:
                for text, lang, place in zip(*(batch.column(n).to_pylist() for n in ("text", "lang", "place"))):
                    counts = ngram_counts(text)
                    if counts is not None:
                        at, values = tf_idf(counts, shared.value)
                        yield number[lang], place, at.astype("<u4").tobytes(), values.astype("<f4").tobytes()

        yield from batches_of(schema, out())

    def fitted(batches: Batches) -> Batches:
        samples, held = [], []
        for batch in batches:
            for label, place, at, values in zip(*(column.to_pylist() for column in batch.columns)):
                sample = (label, np.frombuffer(at, "<u4").astype(np.int64), np.frombuffer(values, "<f4"))
                (held if place % 1000 < 1000 * CALIBRATION_SHARE else samples).append(sample)
        if samples:
            weights = fit_ftrl(samples, len(labels))
            model = LanguageModel(labels, idf, weights, 1.0)
            scores = np.array([model.scores(at, values) for _, at, values in held]).reshape(len(held), len(labels))
            temperature = calibrate(scores, np.array([label for label, _, _ in held], int))
            schema = pa.schema([("temperature", pa.float64()), ("weights", pa.binary())])
            yield from batches_of(schema, iter([(temperature, weights.astype("<f4").tobytes())]))

    # The bounded sample is fitted in one task; what comes back is the model.
    found = (
        sample.mapInArrow(featured, "label int, place long, at binary, weights binary")
        .repartition(1)
        .sortWithinPartitions("place", "label")
        .mapInArrow(fitted, "temperature double, weights binary")
        .collect()
    )
    if not found:
        return LanguageModel([], idf, np.zeros((FEATURES + 1, 0)), 1.0)
    weights = np.frombuffer(found[0]["weights"], "<f4").reshape(FEATURES + 1, len(labels))
    return LanguageModel(labels, idf.astype(np.float32), weights, found[0]["temperature"])


_models: dict = {}


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", name: str = "language") -> DataFrame:
    """All columns and the struct ``name(lang, score)``, predicted from the text alone.

    ``lang`` is a learned label with its calibrated probability, or ``und``
    with score 0 where the text is null or has no letter, or nothing was
    learned.  Long texts are read whole; rows are judged one by one, so
    repeated rows agree; an empty table stays empty.  A column already called
    ``name`` is replaced; all others pass through.
    """
    kept = [column for column in docs.columns if column.lower() != name.lower()]
    shared, key = docs.sparkSession.sparkContext.broadcast(vars(model)), uuid.uuid4().hex
    row = F.struct(*[ref(column) for column in kept]).alias("row")
    # A text that passes through is read where it stands: each travels once.
    inside = next((at for at, column in enumerate(kept) if column == text_col and docs.schema[column].dataType == T.StringType()), None)
    rows = docs.select(row) if inside is not None else docs.select(row, ref(text_col).cast("string").alias("text"))

    def predicted(batches: Batches) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        if key not in _models:
            _models.clear()
            _models[key] = LanguageModel(**shared.value)
        model = _models[key]
        for batch in batches:
            texts = batch.column("text") if inside is None else batch.column("row").field(inside)
            found = [model.predict(text.as_py()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["row", "lang", "score"],
            )

    schema = T.StructType(rows.schema.fields[:1]).add("lang", "string").add("score", "double")
    result = rows.mapInArrow(predicted, schema)
    return result.select(
        *[F.col("row").getField(column).alias(column) for column in kept], F.struct("lang", "score").alias(name)
    )


def fold(id_col: str) -> Column:
    """CRC-32 of the id as text, modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(ref(id_col).cast("string"), F.lit("")).cast("binary")) % 4


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col, held_out, lang_pred, score`` per row, learned from the rows that are not held out."""
    held_out = fold(id_col) == 2
    model = train(docs.filter(~held_out), text_col, lang_col, id_col=id_col)
    rows = docs.select(ref(id_col).alias("id"), held_out.alias("held_out"), ref(text_col).alias("text"))
    return with_language(rows, model, "text").select(
        F.col("id").alias(id_col), "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )

"""Quality rules: plain limits first, then robust multivariate outliers per language and source.

Each document becomes a short vector of transformed statistics.  Per group of
language and source a minimum-covariance-determinant estimate is reached by
concentration steps that see every row: distances under the current estimate,
the nearest ``SUPPORT`` of the rows, their mean and covariance, again.  A
document far from its group in Mahalanobis distance is rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, text_bytes
from gaugeworks.sources.scratch import written

SYMBOLS = b"#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_BLANK_BYTES = _BLANKS.encode()

#: Statistics of a document, in the order of its vector.
DIMENSIONS = ("word_length", "symbols", "dup_lines", "repeats")
#: Natural spread a statistic is granted at least: many groups have none in three of the four.
FLOORS = (0.25, 0.05, 0.15, 0.15)
#: Share of a group's rows that shapes its estimate.
SUPPORT = 0.75
#: Chance of rejecting an ordinary document of a normal group.
TAIL = 1e-5
STEPS = 4
#: Groups below this size are judged with the other small groups of their language, then of the table.
MIN_ROWS = 100
#: Estimates are broadcast up to this many groups (some 30 MB); beyond, they are joined by a shuffle.
BROADCAST_GROUPS = 100_000
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur at least twice.

    Windows are numbered exactly: pairs of words, then pairs of pairs, each
    renumbered by sorting, so nothing but integers is held.
    """
    if len(words) <= width:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0

    def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * len(words) + right, return_inverse=True)[1]

    two = paired(ids[:-1], ids[1:])
    four = paired(two[:-2], two[2:])
    _, five, counts = np.unique(four[:-1] * len(words) + ids[4:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[five] > 1)
    if not len(starts):
        return 0
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return int((np.cumsum(steps) > 0).sum())


def base_statistics(text: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word."""
    words = text.split()
    blanks = len(text) - len(text.translate(None, _BLANK_BYTES))
    letters = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(_BLANK_BYTES)]
    return len(words), letters - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def _with_statistics(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    rows = docs.select(
        ref(id_col).alias("id"),
        ref(lang_col).cast("string").alias("lang"),
        ref(source_col).cast("string").alias("source"),
        text_bytes(text_col).alias("text"),
    )
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

    def measured(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [base_statistics(text.as_py()) for text in batch.column("text")]
            columns = list(zip(*found)) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("id", "lang", "source")] + [pa.array(c, pa.int64()) for c in columns],
                ["id", "lang", "source", *names],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(measured, f"id {kind}, lang string, source string, " + ", ".join(f"{n} long" for n in names))


def _vector() -> dict[str, Column]:
    """Transformed statistics.  Short texts lean to a common word length, shares are square-rooted."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "word_length": (chars + 150.0) / (words + 30.0),
        "symbols": F.sqrt(F.col("n_symbols") / F.greatest(chars, F.lit(1))),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "repeats": F.sqrt(F.col("n_repeat_words") / F.greatest(words, F.lit(1))),
    }


def _chi_square_below(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees."""
    half, term, total = x / 2, 1.0, 1.0
    for k in range(1, freedom // 2):
        term *= half / k
        total += term
    return 1 - math.exp(-half) * total


def chi_square_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square_below(middle, freedom) < p else (low, middle)
    return high


_PAIRS = [(i, j) for i in range(len(DIMENSIONS)) for j in range(i, len(DIMENSIONS))]


def _distance() -> Column:
    """Squared Mahalanobis distance under the estimate joined to the row."""
    total = F.lit(0.0)
    for i, j in _PAIRS:
        weight = 1.0 if i == j else 2.0
        left = F.col(DIMENSIONS[i]) - F.col(f"m{i}")
        right = F.col(DIMENSIONS[j]) - F.col(f"m{j}")
        total = total + weight * F.col(f"p{i}{j}") * left * right
    return F.greatest(total, F.lit(0.0))


_ESTIMATE = "lang string, source string, n long, " + ", ".join(
    [f"m{i} double" for i in range(len(DIMENSIONS))] + [f"p{i}{j} double" for i, j in _PAIRS]
)


def _inverted(moments: DataFrame) -> DataFrame:
    """Estimates (mean and precision) from rows of counts, sums and sums of products per group."""
    size = len(DIMENSIONS)
    floor = np.diag(np.square(FLOORS))
    # What the covariance of the nearest share of a normal sample has to be multiplied by.
    factor = SUPPORT / _chi_square_below(chi_square_quantile(SUPPORT, size), size + 2)

    def invert(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names if n not in ("lang", "source")}
            used = column["used"].astype(float)
            mean = np.stack([column[f"s{i}"] / used for i in range(size)], 1)
            spread = np.empty((len(used), size, size))
            for i, j in _PAIRS:
                spread[:, i, j] = spread[:, j, i] = column[f"s{i}{j}"] / used - mean[:, i] * mean[:, j]
            scale = np.where(column["whole"], 1.0, factor)
            precision = np.linalg.inv(spread * scale[:, None, None] + floor)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("source"), batch.column("n")]
                + [pa.array(mean[:, i]) for i in range(size)]
                + [pa.array(precision[:, i, j]) for i, j in _PAIRS],
                [part.split()[0] for part in _ESTIMATE.split(", ")],
            )

    return moments.mapInArrow(invert, _ESTIMATE)


def _sums() -> list[Column]:
    return [F.sum(F.col(d)).alias(f"s{i}") for i, d in enumerate(DIMENSIONS)] + [
        F.sum(F.col(DIMENSIONS[i]) * F.col(DIMENSIONS[j])).alias(f"s{i}{j}") for i, j in _PAIRS
    ]


def _sum_names() -> list[str]:
    return [f"s{i}" for i in range(len(DIMENSIONS))] + [f"s{i}{j}" for i, j in _PAIRS]


def _joined(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with the estimate of their group, none for groups without."""
    left, right = rows.alias("r"), estimates.alias("e")
    if estimates.count() <= BROADCAST_GROUPS:
        right = F.broadcast(right)
    same = F.col("r.cell_lang").eqNullSafe(F.col("e.lang")) & F.col("r.cell_source").eqNullSafe(F.col("e.source"))
    return left.join(right, same, "left").select("r.*", *[f"e.{name}" for name in estimates.columns if name not in ("lang", "source")])


def _cells(rows: DataFrame) -> DataFrame:
    """Group of each row: language and source, or ``*`` for what is too small on its own."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("rows"))
    small = F.col("rows") < MIN_ROWS
    by_lang = Window.partitionBy("lang")
    rest = F.sum(F.when(small, F.col("rows"))).over(by_lang)
    cells = sizes.withColumns(
        {
            "cell_lang": F.when(small & (rest < MIN_ROWS), F.lit("*")).otherwise(F.concat(F.lit("="), F.coalesce("lang", F.lit("")))),
            "cell_source": F.when(small, F.lit("*")).otherwise(F.concat(F.lit("="), F.coalesce("source", F.lit("")))),
        }
    )
    left, right = rows.alias("r"), cells.alias("c")
    same = F.col("r.lang").eqNullSafe(F.col("c.lang")) & F.col("r.source").eqNullSafe(F.col("c.source"))
    return left.join(right, same).select("r.*", "c.cell_lang", "c.cell_source")


def estimates_by_group(rows: DataFrame, least_rows: int = MIN_ROWS) -> DataFrame:
    """Robust mean and precision per group of rows that passed the limits, groups of ``least_rows`` or more."""
    groups = ["cell_lang", "cell_source"]
    bin_of = F.least(F.floor(F.log2(F.lit(1.0) + _distance()) * 24), F.lit(480)).cast("int")
    # Start from medians: the spread around them in steps of quartiles, no products yet.
    quartiles = rows.groupBy(*groups).agg(
        F.count("*").alias("n"),
        *[F.percentile_approx(d, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q{i}") for i, d in enumerate(DIMENSIONS)],
    )
    start = {f"m{i}": F.col(f"q{i}")[1] for i in range(len(DIMENSIONS))}
    for i, j in _PAIRS:
        spread = (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349
        start[f"p{i}{j}"] = 1 / (spread * spread + FLOORS[i] ** 2) if i == j else F.lit(0.0)
    estimates = written(
        quartiles.filter(F.col("n") >= least_rows).select(
            F.col("cell_lang").alias("lang"), F.col("cell_source").alias("source"), "n", *[c.alias(n) for n, c in start.items()]
        ),
        "quality-start",
    )
    for _ in range(STEPS):
        near = _joined(rows, estimates).filter(F.col("n").isNotNull())
        bins = near.groupBy(*groups, "n", bin_of.alias("bin")).agg(F.count("*").alias("used"), *_sums())
        before = F.sum("used").over(Window.partitionBy(*groups).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
        nearest = bins.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < SUPPORT * F.col("n"))
        moments = nearest.groupBy(F.col("cell_lang").alias("lang"), F.col("cell_source").alias("source"), "n").agg(
            F.sum("used").alias("used"), *[F.sum(name).alias(name) for name in _sum_names()]
        )
        moments = moments.withColumn("whole", F.col("used") == F.col("n"))
        estimates = written(_inverted(moments), "quality-step")
    return estimates


def judge_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Per row: ``id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance``.

    ``base_failed`` is the plain limits' verdict.  Rows that pass are judged in
    their group of language and source (null is a value of its own): rejected
    above the ``1 - TAIL`` quantile of squared distances.  Small groups are
    pooled; a last pool below ``MIN_ROWS`` is judged by the estimate over all
    rows together.  A null or empty text has no words and fails; repeated rows count
    each; null ids stay null; an empty table gives no rows.  Other columns are
    not looked at.
    """
    measured = _with_statistics(docs, id_col, text_col, lang_col, source_col)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    rows = written(measured.withColumns(_vector() | {"base_failed": failed}), "quality")
    passed = written(_cells(rows.filter(~F.col("base_failed"))), "quality-cells")
    estimates = estimates_by_group(passed)
    if 0 < passed.filter(F.col("cell_lang") == "*").count() < MIN_ROWS:
        together = passed.withColumns({"cell_lang": F.lit("*"), "cell_source": F.lit("*")})
        estimates = estimates.unionByName(estimates_by_group(together, 1))
    limit = chi_square_quantile(1 - TAIL, len(DIMENSIONS))
    judged = _joined(passed, estimates).withColumn("distance", F.when(F.col("n").isNotNull(), F.sqrt(_distance())))
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = [F.col("id").alias(id_col), *shown]
    kept = judged.select(*out, F.coalesce(F.col("distance") <= math.sqrt(limit), F.lit(True)).alias("kept"), "distance")
    return kept.unionByName(
        rows.filter("base_failed").select(*out, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    )

"""Train/validation/test splits and class-aware samples with exact sizes.

Random order comes from the md5 of seed and row key.  To take the first n rows
of a class in that order nobody has to sort the class: digests are read as a
trie whose branches know their row counts.  The branch that holds the n-th row
is followed until few rows are left, ordering those gives the digest of the
n-th row, and every row is then decided by comparing its own digest with that
cutoff.  The data is never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.columns import epoch_seconds, instant, ref, refs, seeded_digest
from gaugeworks.operators.contracts import ContractError, class_counts
from gaugeworks.operators.quantiles import exact_quantiles
from gaugeworks.operators.ranges import DEFAULT_ROWS_PER_RANGE, with_group_row_number
from gaugeworks.operators.shape import rows_from_wide

TRAIN, VALIDATION, TEST = "train", "validation", "test"
# Rows that belong to no split: a label outside 0 and 1, or no time.
REJECTED = "rejected"
SPLITS = (TRAIN, VALIDATION, TEST)
# Shares of the data up to the end of train and of validation.
TRAIN_SHARE, VALIDATION_SHARE = 0.70, 0.85
DIGEST = "__digest"
# Hexadecimal digits told apart at a time, and those of a whole digest.
PREFIX_DIGITS = 3
DIGEST_DIGITS = 32
# Rows of one prefix that a task may put in order.
LEAF_ROWS = 50_000


def split_sizes(rows: int, train_share: float = TRAIN_SHARE, validation_share: float = VALIDATION_SHARE) -> tuple[int, int]:
    """Ranks of the last train and the last validation row of a class of ``rows`` rows."""
    if rows < 3:
        raise ContractError("a stratified split needs at least 3 rows per class")
    train_end = min(max(1, math.floor(rows * train_share)), rows - 2)
    validation_end = min(max(train_end + 1, math.floor(rows * validation_share)), rows - 1)
    return train_end, validation_end


def rank_cutoffs(
    df: DataFrame, label: str, digest: str, ranks: Mapping[int, Sequence[int]], leaf_rows: int = LEAF_ROWS
) -> dict[tuple[int, int], str]:
    """Digest of the row at each wanted rank (1-based) of each class.

    Rows are counted by the first digits of their digest; only the prefixes
    that hold a wanted rank are counted again by more digits, until a prefix
    has at most ``leaf_rows`` rows, which are then put in order.  However many
    rows there are, no task orders more than that.  Rows whose digests are
    equal, as those of one key, cannot be told apart and share a rank's cutoff.
    """
    wanted = {(group, rank) for group, group_ranks in ranks.items() for rank in group_ranks if rank > 0}
    found: dict[tuple[int, int], str] = {}
    # Open ranks, with the prefix that holds them and the rows of the class before it.
    at = {(group, rank): ("", 0) for group, rank in wanted}
    while at:
        counts = _digest_counts(df, label, digest, {(group, prefix) for (group, _), (prefix, _) in at.items()})
        leaves: dict[tuple[int, int], tuple[str, int]] = {}
        deeper: dict[tuple[int, int], tuple[str, int]] = {}
        for (group, rank), (prefix, below) in at.items():
            for part, n in counts.get((group, prefix), ()):
                if rank <= below + n:
                    break
                below += n
            else:
                raise ContractError(f"class {group} has no row of rank {rank}")
            if len(part) >= DIGEST_DIGITS:
                found[group, rank] = part
            else:
                (leaves if n <= leaf_rows else deeper)[group, rank] = (part, below)
        found.update(_leaf_digests(df, label, digest, leaves))
        at = deeper
    return found


def _digest_counts(df: DataFrame, label: str, digest: str, prefixes: set[tuple[int, str]]) -> dict[tuple[int, str], list[tuple[str, int]]]:
    """Rows by the next digits below each prefix: 16 ** PREFIX_DIGITS counts of a prefix at most."""
    width = len(next(iter(prefixes))[1])
    inside = _with_prefix(label, digest, prefixes)
    counted = (
        df.filter(inside)
        .groupBy(ref(label).alias("g"), F.substring(ref(digest), 1, width + PREFIX_DIGITS).alias("p"))
        .agg(F.count("*").alias("n"))
    )
    found: dict[tuple[int, str], list[tuple[str, int]]] = {}
    for row in counted.collect():
        found.setdefault((row["g"], row["p"][:width]), []).append((row["p"], row["n"]))
    return {prefix: sorted(parts) for prefix, parts in found.items()}


def _with_prefix(label: str, digest: str, prefixes: set[tuple[int, str]]) -> Column:
    inside = F.lit(False)
    for group, prefix in sorted(prefixes):
        inside = inside | ((ref(label) == group) & ref(digest).startswith(prefix))
    return inside


def _leaf_digests(
    df: DataFrame, label: str, digest: str, leaves: Mapping[tuple[int, int], tuple[str, int]]
) -> dict[tuple[int, int], str]:
    """The digests at ranks whose prefix has few rows."""
    if not leaves:
        return {}
    prefixes = {(group, prefix) for (group, _), (prefix, _) in leaves.items()}
    width = len(next(iter(prefixes))[1])
    rows = (
        df.filter(_with_prefix(label, digest, prefixes))
        .select(ref(label).alias("g"), ref(digest).alias("d"), F.substring(ref(digest), 1, width).alias("p"))
        .withColumn("r", F.row_number().over(Window.partitionBy("g", "p").orderBy("d")))
    )
    chosen = F.lit(False)
    for (group, rank), (prefix, below) in leaves.items():
        chosen = chosen | ((F.col("g") == group) & (F.col("p") == prefix) & (F.col("r") == rank - below))
    numbered = {(row["g"], row["p"], row["r"]): row["d"] for row in rows.filter(chosen).collect()}
    return {(group, rank): numbered[group, prefix, rank - below] for (group, rank), (prefix, below) in leaves.items()}


def with_digest(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    return df.withColumn(DIGEST, seeded_digest(seed, keys))


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int = 42,
    name: str = "split",
    train_share: float = TRAIN_SHARE,
    validation_share: float = VALIDATION_SHARE,
) -> DataFrame:
    """Random split per class with exact sizes; ``keys`` identify a row.

    Rows whose label is null or outside 0 and 1 go to the split ``rejected``.
    """
    counts = class_counts(df, label)
    ends = {group: split_sizes(rows, train_share, validation_share) for group, rows in counts.items()}
    keyed = with_digest(df, keys, seed)
    cutoffs = rank_cutoffs(keyed, label, DIGEST, ends)
    split = F.lit(REJECTED)
    for group, (train_end, validation_end) in ends.items():
        part = (
            F.when(F.col(DIGEST) <= cutoffs[group, train_end], TRAIN)
            .when(F.col(DIGEST) <= cutoffs[group, validation_end], VALIDATION)
            .otherwise(TEST)
        )
        split = F.when(ref(label) == group, part).otherwise(split)
    return keyed.withColumn(name, split).drop(DIGEST)


def chronological_boundaries(
    df: DataFrame,
    time: str,
    shares: Sequence[float] = (TRAIN_SHARE, VALIDATION_SHARE),
    exact: bool = True,
    accuracy: int = 10_000,
    **options,
) -> list[int]:
    """Epoch seconds at the given shares of the rows in time order."""
    epochs = df.select(epoch_seconds(ref(time)).alias("epoch"))
    if exact:
        found = exact_quantiles(epochs, {"epoch": list(shares)}, discrete=True, **options)["epoch"]
    else:
        found = epochs.agg(F.percentile_approx("epoch", list(shares), accuracy)).first()[0] or [None, None]
    if any(value is None for value in found):
        raise ContractError("no boundaries: the table has no times")
    boundaries = [int(value) for value in found]
    if boundaries[0] >= boundaries[1]:
        raise ContractError(f"split boundaries do not increase: {boundaries}")
    return boundaries


def chronological_split(df: DataFrame, time: str, name: str = "split", **options) -> DataFrame:
    """Oldest rows train, newest test; readings of one second stay together; without a time: ``rejected``."""
    train_end, validation_end = chronological_boundaries(df, time, **options)
    moment = ref(time)

    def upto(second: int) -> Column:
        return moment < instant_of(df, time, second + 1)

    split = (
        F.when(upto(train_end), TRAIN)
        .when(upto(validation_end), VALIDATION)
        .when(moment.isNotNull(), TEST)
        .otherwise(REJECTED)
    )
    return df.withColumn(name, split)


def instant_of(df: DataFrame, time: str, second: int) -> Column:
    """Literal for an epoch second in the type of the time column."""
    from datetime import datetime, timezone

    text = datetime.fromtimestamp(second, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    zone = "" if df.schema[time].dataType.simpleString() == "timestamp_ntz" else "+00:00"
    return instant(df, time, text + zone)


def split_audit(df: DataFrame, label: str, time: str, split: str = "split") -> DataFrame:
    """Rows, class counts, time range and class availability per split."""
    audit = df.groupBy(ref(split).alias("split")).agg(
        F.count("*").alias("row_count"),
        F.count_if(ref(label) == 0).alias("normal_rows"),
        F.count_if(ref(label) == 1).alias("fault_rows"),
        F.min(ref(time)).alias("start_time"),
        F.max(ref(time)).alias("end_time"),
    )
    both = (F.col("normal_rows") > 0) & (F.col("fault_rows") > 0)
    return audit.withColumn("status", F.when(both, "passed").otherwise("warning"))


def leakage_check(df: DataFrame, time: str, split: str = "split") -> DataFrame:
    """Does every split end before the next one begins?"""
    wide = df.agg(
        *[
            bound(F.when(ref(split) == part, ref(time))).alias(f"{part}_{kind}")
            for part in SPLITS
            for kind, bound in (("min", F.min), ("max", F.max))
        ]
    )

    def row(earlier: str, later: str) -> dict[str, Column]:
        ordered = F.col(f"{earlier}_max") <= F.col(f"{later}_min")
        return {
            "check_name": F.lit(f"{earlier}_before_{later}"),
            "status": F.when(ordered, "PASS").otherwise("FAIL"),
        }

    return rows_from_wide(wide, [row(TRAIN, VALIDATION), row(VALIDATION, TEST)])


def partition_check(df: DataFrame, keys: Sequence[str], split: str = "split") -> DataFrame:
    """Split sizes against the total: nothing lost, nothing empty, no key in two splits.

    Rows of the split ``rejected`` are counted apart; they are not lost.
    """
    per_key = df.groupBy(*refs(keys)).agg(
        F.count("*").alias("__rows"),
        *[F.count_if(ref(split) == part).alias(f"__{part}") for part in (*SPLITS, REJECTED)],
    )
    present = [(F.col(f"__{part}") > 0).cast("int") for part in SPLITS]
    totals = per_key.agg(
        F.sum("__rows").alias("total_rows"),
        *[F.sum(f"__{part}").alias(f"{part}_rows") for part in (*SPLITS, REJECTED)],
        F.count_if(present[0] + present[1] + present[2] > 1).alias("shared_keys"),
    )
    parts = [F.col(f"{part}_rows") for part in SPLITS]
    return totals.withColumns(
        {
            "adds_up": parts[0] + parts[1] + parts[2] + F.col(f"{REJECTED}_rows") == F.col("total_rows"),
            "none_empty": (parts[0] > 0) & (parts[1] > 0) & (parts[2] > 0),
        }
    )


def with_class_rank(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int = 42,
    name: str = "class_rank",
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """Random rank of every row within its class, for callers that need all ranks."""
    keyed = with_digest(df, keys, seed)
    return with_group_row_number(keyed, [label], [DIGEST, *keys], name, rows_per_range).drop(DIGEST)


def with_class_total(df: DataFrame, label: str, name: str = "class_total") -> DataFrame:
    """Class size on every row, from literals: the 0/1 domain bounds the classes."""
    total = F.lit(None).cast("long")
    for group, rows in class_counts(df, label).items():
        total = F.when(ref(label) == group, F.lit(rows).cast("long")).otherwise(total)
    return df.withColumn(name, total)


def take_per_class(
    df: DataFrame, label: str, keys: Sequence[str], quotas: Mapping[int, int], counts: Mapping[int, int], seed: int = 42
) -> DataFrame:
    """Exactly ``quotas[class]`` random rows of each class."""
    keyed = with_digest(df, keys, seed)
    partial = {group: [n] for group, n in quotas.items() if 0 < n < counts.get(group, 0)}
    cutoffs = rank_cutoffs(keyed, label, DIGEST, partial)
    kept = F.lit(False)
    for group, n in quotas.items():
        if n <= 0 or not counts.get(group, 0):
            continue
        mine = ref(label) == group
        kept = kept | (mine & (F.col(DIGEST) <= cutoffs[group, n]) if group in partial else mine)
    return keyed.filter(kept).drop(DIGEST)


def capped_quotas(counts: Mapping[int, int], max_rows: int, fill_single_class: bool = True) -> dict[int, int]:
    """A third of the cap at most for faults, the rest for normal rows.

    With one class only, ``fill_single_class`` lets it use the whole cap;
    otherwise it keeps its own quota.
    """
    negatives, positives = counts.get(0, 0), counts.get(1, 0)
    if negatives + positives <= max_rows:
        return {0: negatives, 1: positives}
    if fill_single_class and (not negatives or not positives):
        return {0: min(negatives, max_rows), 1: min(positives, max_rows)}
    faults = min(positives, max_rows // 3)
    return {0: min(negatives, max_rows - faults), 1: faults}


def capped_class_sample(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    max_rows: int = 100_000,
    seed: int = 42,
    fill_single_class: bool = True,
) -> DataFrame:
    counts = class_counts(df, label)
    return take_per_class(df, label, keys, capped_quotas(counts, max_rows, fill_single_class), counts, seed)


def fault_preserving_quotas(counts: Mapping[int, int], max_rows: int) -> dict[int, int]:
    """All faults (or as many as fit), then normal rows up to the cap."""
    negatives, positives = counts.get(0, 0), counts.get(1, 0)
    if not positives:
        raise ContractError("no fault rows in the training data")
    faults = min(positives, max_rows)
    return {0: min(negatives, max_rows - faults), 1: faults}


def fault_preserving_sample(
    df: DataFrame, label: str, keys: Sequence[str], max_rows: int = 100_000, seed: int = 42
) -> DataFrame:
    counts = class_counts(df, label)
    return take_per_class(df, label, keys, fault_preserving_quotas(counts, max_rows), counts, seed)


def seeded_order(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Reproducible shuffle of the rows."""
    keyed = with_digest(df, keys, seed)
    return keyed.orderBy(DIGEST, *refs(keys)).drop(DIGEST)

"""Hard negatives by branch and bound on dimensions.

Vectors lie in blocks, dimension by dimension.  For an anchor the dimensions
are read in descending order of its own magnitudes; what the remaining ones can
still add, at least and at most, follows from the least and largest component
of the block, so that most candidates leave the bitmap before their scores are
complete.  What is left has exact scores.

Blocks meet packs of anchors through a join on the shard of the block, so
anchors are never collected or broadcast as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, batches_of, batches_up_to
from gaugeworks.sources.scratch import written

#: Rows of a block at most, and anchors of a pack on average.
BLOCK_ROWS = 8_192
PACK_ANCHORS = 128
#: Packs that meet a shard's blocks in one tile.
TILE_PACKS = 32
#: Dimensions read between two looks at the bounds.
STEP = 8

_BLOCK = "n int, width int, dims int, ids binary, labels binary, columns binary, least binary, most binary"


def _components(vectors: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows have finite components only; their components, scaled and rounded down."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.nan_to_num(np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.float64)).astype(np.int64)
    ends = np.cumsum(lengths)
    finite = np.isfinite(flat)
    bad = np.concatenate([[0], np.cumsum(~finite)])
    fits = (bad[ends] == bad[ends - lengths]) & np.asarray(vectors.is_valid())
    whole = np.floor(scale * np.where(finite, flat, 0.0))
    if len(whole) and np.abs(whole).max() >= 2**31:
        raise OverflowError("components beyond 31 bits: their scores may not fit a long")
    whole = whole.astype(np.int64)
    return fits, [whole[end - length : end] if fit else None for end, length, fit in zip(ends, lengths, fits)]


def _least_type(values: np.ndarray) -> np.dtype:
    top = int(np.abs(values).max()) if values.size else 0
    return np.dtype(np.int16 if top < 2**15 else np.int32)


def _block(ids: np.ndarray, labels: np.ndarray, rows: list[np.ndarray]) -> tuple:
    """One block; rows of a label lie together, shorter vectors end in zeros."""
    order = np.lexsort((ids, labels))
    dims = max(map(len, rows))
    matrix = np.zeros((dims, len(rows)), np.int64)
    for place, at in enumerate(order):
        matrix[: len(rows[at]), place] = rows[at]
    if dims * int(np.abs(matrix).max(initial=0)) ** 2 >= 2**62:
        raise OverflowError("scores may not fit a long")
    kind = _least_type(matrix)
    least, most = (f(matrix, axis=1) if dims else np.zeros(0, np.int64) for f in (np.min, np.max))
    return (
        len(rows), kind.itemsize, dims, ids[order].tobytes(), labels[order].tobytes(), matrix.astype(kind).tobytes(), least.tobytes(), most.tobytes(),
    )


class _Block:
    def __init__(self, row: dict):
        kind = np.int16 if row["width"] == 2 else np.int32
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.columns = np.frombuffer(row["columns"], kind).reshape(row["dims"], row["n"]).astype(np.int64)
        self.least, self.most = np.frombuffer(row["least"], np.int64), np.frombuffer(row["most"], np.int64)

    def order(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Dimensions in descending magnitude of the anchor; what those after each can still add, least and most."""
        dims = min(len(vector), len(self.columns))
        order = np.argsort(-np.abs(vector[:dims]), kind="stable")
        low, high = vector[order] * self.least[order], vector[order] * self.most[order]
        rest = [np.append(np.cumsum(x[::-1])[::-1], 0) for x in (np.minimum(low, high), np.maximum(low, high))]
        return order, rest[0], rest[1]


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, equal ones by smaller id; rows that repeat an id and a score count once."""
    if len(scores) > 4 * n:
        # Everything that ties with the n-th stays.
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        among = np.flatnonzero(scores >= least)
    else:
        among = np.arange(len(scores))
    order = among[np.lexsort((ids[among], -scores[among]))]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (ids[order][1:] != ids[order][:-1]) | (scores[order][1:] != scores[order][:-1])
    if fresh.all() or len(among) == len(scores):
        return order[fresh][:n]
    found = order[fresh]
    # Repeats may have taken the places of others.
    return found[:n] if len(found) >= n else _best_of_all(scores, ids, n)


def _best_of_all(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((ids, -scores))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (ids[order][1:] != ids[order][:-1]) | (scores[order][1:] != scores[order][:-1])
    return order[fresh][:n]


def nearest_of_label(block: _Block, vector: np.ndarray, label: int, own: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the ``n`` best rows of a block with the anchor's label."""
    begin, end = np.searchsorted(block.labels, [label, label + 1])
    place = begin + np.flatnonzero(block.ids[begin:end] != own)
    partial = np.zeros(len(place), np.int64)
    order, low, high = block.order(vector)
    # Repeats of a row must not rule out others: bounds count distinct ids only.
    distinct = len(np.unique(block.ids[place])) == len(place)
    for step in range(0, len(order), STEP):
        for dim in order[step : step + STEP]:
            partial += vector[dim] * block.columns[dim][place]
        at = min(step + STEP, len(order))
        if distinct and len(place) > n:
            least = np.partition(partial, len(place) - n)[len(place) - n] + low[at]
            stays = partial + high[at] >= least
            place, partial = place[stays], partial[stays]
    chosen = _best(partial, block.ids[place], n)
    return partial[chosen], block.ids[place[chosen]]


def within_windows(
    block: _Block, vector: np.ndarray, label: int, windows: np.ndarray, n: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of scores the ``n`` best rows of other labels inside it."""
    begin, end = np.searchsorted(block.labels, [label, label + 1])
    place = np.concatenate([np.arange(begin), np.arange(end, len(block.ids))])
    partial = np.zeros(len(place), np.int64)
    order, low, high = block.order(vector)
    floors, tops = windows[:, 0], windows[:, 1]
    distinct = len(np.unique(block.ids[place])) == len(place)
    for step in range(0, len(order), STEP):
        for dim in order[step : step + STEP]:
            partial += vector[dim] * block.columns[dim][place]
        at = min(step + STEP, len(order))
        at_least, at_most = partial + low[at], partial + high[at]
        if len(place) > n and distinct:
            # A row is wanted by a window if it may lie inside, above the n-th of those that surely do.
            wanted = np.zeros(len(place), bool)
            for floor, top in windows:
                sure = at_least[(at_least >= floor) & (at_most <= top)]
                if len(sure) >= n:
                    floor = max(floor, np.partition(sure, len(sure) - n)[len(sure) - n])
                wanted |= (at_most >= floor) & (at_least <= top)
        else:
            wanted = (at_most >= floors.min()) & (at_least <= tops.max())
        place, partial = place[wanted], partial[wanted]
        if not len(place):
            break
    found = []
    for floor, top in windows:
        inside = (partial >= floor) & (partial <= top)
        scores, ids = partial[inside], block.ids[place[inside]]
        chosen = _best(scores, ids, n)
        found.append((scores[chosen], ids[chosen]))
    return found


def columnar_blocks(rows: DataFrame, scale: float, shards: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A written table of blocks from rows of ``id, label, vector``, dealt over so many shards."""
    schema = pa.schema(
        [("n", pa.int32()), ("width", pa.int32()), ("dims", pa.int32())]
        + [(name, pa.binary()) for name in ("ids", "labels", "columns", "least", "most")]
    )

    def build(batches: Batches) -> Batches:
        def blocks() -> Iterator[tuple]:
            ids: list[int] = []
            labels: list[int] = []
            held: list[np.ndarray] = []
            for batch in batches:
                fits, vectors = _components(batch.column("vector"), scale)
                own_ids, own_labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
                for at in np.flatnonzero(fits).tolist():
                    ids.append(own_ids[at])
                    labels.append(own_labels[at])
                    held.append(vectors[at])
                    if len(held) == block_rows:
                        yield _block(np.array(ids, np.int64), np.array(labels, np.int64), held)
                        ids, labels, held = [], [], []
            if held:
                yield _block(np.array(ids, np.int64), np.array(labels, np.int64), held)

        yield from batches_of(schema, blocks(), 1)

    # The rows are few bytes each: dealt evenly by id, whatever file they came from.
    dealt = rows.repartition(shards, "id")
    blocks = dealt.mapInArrow(build, _BLOCK).withColumn("shard", F.pmod(F.spark_partition_id(), F.lit(shards)))
    return written(blocks, "vector-blocks", compression="zstd")


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256.0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of components scaled and rounded down.  An
    anchor's positives are the ``positives`` best other rows of its label; each
    gets the ``negatives`` best rows of other labels whose score is at least
    ``low`` and at most ``high`` hundredths of its own.  Equal scores are
    ordered by smaller id.

    Rows with a null id, label or vector, or with a null or non-finite
    component, take no part.  An id stands for one vector: rows that repeat id
    and vector count once, and an anchor is never its own positive.  Of vectors
    of different length the common dimensions count.  Components beyond 31 bits
    raise an error, as scores might not fit.  Other columns are not looked at;
    an empty table, or one without anchors, gives an empty result.
    """
    taken = rows.filter(ref(id_col).isNotNull() & ref(label_col).isNotNull() & ref(vector_col).isNotNull())
    kind = rows.schema[vector_col].dataType.elementType.simpleString()
    plain = taken.select(
        ref(id_col).cast("long").alias("id"),
        ref(label_col).cast("long").alias("label"),
        (ref(vector_col) if kind in ("float", "double") else ref(vector_col).cast("array<double>")).alias("vector"),
        is_anchor.alias("is_anchor"),
    )
    spark = rows.sparkSession
    shards = min(max(1, -(-plain.count() // block_rows)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = columnar_blocks(plain.drop("is_anchor"), scale, shards, block_rows)
    numbers = lambda x: F.floor(F.lit(scale) * x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    anchors = written(
        plain.filter(F.col("is_anchor") & finite)
        .select(F.col("id").alias("anchor_id"), "label", F.transform("vector", numbers).alias("vector"))
        .distinct(),
        "anchors",
        compression="zstd",
    )
    packs = max(1, -(-anchors.count() // PACK_ANCHORS))
    search = lambda wanted, n: _searched(blocks, wanted, shards, packs, n)
    with batches_up_to(spark, "8m"):
        nothing = F.array().cast("array<struct<positive_id:long,low:long,high:long>>")
        found = search(anchors.withColumn("windows", nothing), positives).select(
            "anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        nearest = written(_first(found, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"), "positives")
        # The least whole number of at least `low` hundredths, the largest of at most `high`.
        score = F.col("positive_score").cast("decimal(20,0)")
        window = F.struct(
            "positive_id",
            F.ceil(score * low / 100).cast("long").alias("low"),
            F.floor(score * high / 100).cast("long").alias("high"),
        )
        wanted = nearest.groupBy("anchor_id").agg(F.collect_list(window).alias("windows"))
        inside = written(search(anchors.join(wanted, "anchor_id"), negatives), "negatives", compression="zstd")
    ranked = _first(
        inside.withColumnRenamed("other_id", "negative_id").withColumnRenamed("score", "negative_score"),
        ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives,
    )
    return ranked.join(nearest, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _first(found: DataFrame, keys: list[str], score: str, other: str, n: int) -> DataFrame:
    """The ``n`` first of each key; what repeats counts once."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(other))
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _searched(blocks: DataFrame, anchors: DataFrame, shards: int, packs: int, n: int) -> DataFrame:
    """What each block has for each anchor: the best of its label, or of other labels inside each window.

    Blocks and packs meet in tiles: the blocks of one shard and a bounded number of packs.
    """

    def search(batches: Batches) -> Batches:
        def rows() -> Iterator[tuple]:
            held, at = None, None
            for batch in batches:
                for row in batch.to_pylist():
                    key = (row["ids"], row["columns"])
                    if held is None or key != at:
                        held, at = _Block(row), key
                    for anchor in row["anchors"]:
                        yield from _found(held, anchor, n)

        yield from batches_of(schema, rows(), 20_000)

    schema = pa.schema([(name, pa.int64()) for name in ("anchor_id", "positive_id", "other_id", "score")])
    parts = -(-packs // TILE_PACKS)
    pack = F.pmod(F.xxhash64("anchor_id"), F.lit(packs))
    packed = (
        anchors.groupBy(pack.alias("pack"))
        .agg(F.collect_list(F.struct("anchor_id", "label", "vector", "windows")).alias("anchors"))
        .select("anchors", F.pmod("pack", F.lit(parts)).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    )
    copies = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return copies.join(packed, ["shard", "part"]).drop("shard", "part").mapInArrow(
        search, "anchor_id long, positive_id long, other_id long, score long"
    )


def _found(block: _Block, anchor: dict, n: int) -> Iterator[tuple]:
    own, vector = anchor["anchor_id"], np.array(anchor["vector"], np.int64)
    if anchor["windows"]:
        windows = np.array([(window["low"], window["high"]) for window in anchor["windows"]], np.int64)
        for window, (scores, ids) in zip(anchor["windows"], within_windows(block, vector, anchor["label"], windows, n)):
            for score, other in zip(scores.tolist(), ids.tolist()):
                yield own, window["positive_id"], other, score
    else:
        scores, ids = nearest_of_label(block, vector, anchor["label"], own, n)
        for score, other in zip(scores.tolist(), ids.tolist()):
            yield own, None, other, score

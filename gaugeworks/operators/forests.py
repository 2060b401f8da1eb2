"""Random forests of two classes, grown from counts over binned rows.

Rows are binned once and written as blocks of bytes.  Nodes of many rows are
split by counts that all tasks add up; as soon as a node has few enough rows,
they are sent to one task, which grows the rest below it.  So a tree costs one
pass for each of its first levels and one shuffle, whatever its depth, and no
task holds more than ``SUBTREE_ROWS`` rows.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.sources.scratch import drop_written, scratch_path, written

BINS = 32
# Values of a feature that its bins are cut from.
CUT_ROWS = 10_000
BLOCK_ROWS = 65_536
# Drawn rows of a node that one task takes over, each counted as often as it is drawn.
SUBTREE_ROWS = 3_000_000
# Bytes of drawn rows that are dealt to tasks at once.
DEALT_BYTES = 4_000_000_000
# Counts of nodes that are looked at together.
COUNTS_AT_ONCE = 2_000_000
LEAST_GAIN = 1e-12
MODEL_CLASS = "org.apache.spark.ml.classification.RandomForestClassificationModel"
TREE_CLASS = "org.apache.spark.ml.classification.DecisionTreeClassificationModel"

BLOCKS = "block long, row_count int, bins binary, labels binary"
COUNTS = "tree int, node int, counts binary"
SPLITS = "tree int, node int, feature int, bin int, gain double, n0 long, n1 long, left0 long, left1 long"
DRAWN = "tree int, node int, place long, row_count int, bins binary, labels binary, times binary"
NODES = "tree int, root int, id int, feature int, bin int, gain double, left_id int, right_id int, n0 long, n1 long"


def _poisson_table() -> np.ndarray:
    """How often a row is drawn, by 16 random bits: a Poisson number of mean 1."""
    ends = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(ends, (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


POISSON = _poisson_table()


@dataclass(frozen=True)
class ForestPlan:
    """What tasks need to know of a forest."""

    features: int
    trees: int
    depth: int
    leaf: int
    weights: tuple[float, float]
    seed: int
    subtree_rows: int = SUBTREE_ROWS

    @property
    def tried(self) -> int:
        """Features tried for a split: the square root of their number, all for a single tree."""
        return self.features if self.trees == 1 else math.ceil(math.sqrt(self.features))


@dataclass
class Crown:
    """The first levels of a tree; ``wide`` nodes wait for their split, ``small`` ones for what grows below them."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    counts: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    level: list[int] = field(default_factory=lambda: [0])
    wide: list[int] = field(default_factory=list)
    small: list[int] = field(default_factory=list)

    def add(self, counts: tuple[int, int], level: int) -> int:
        for values, value in zip(
            (self.feature, self.bin, self.gain, self.left, self.right, self.counts, self.level),
            (-1, 0, -1.0, -1, -1, counts, level),
        ):
            values.append(value)
        return len(self.feature) - 1

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The node of the crown that each row ends in."""
        feature, cut = np.array(self.feature), np.array(self.bin)
        children = np.array([self.right, self.left])
        node = np.zeros(bins.shape[1], dtype=np.int64)
        moving = np.arange(bins.shape[1])
        while True:
            moving = moving[feature[node[moving]] >= 0]
            if not moving.size:
                return node
            at = node[moving]
            goes_left = bins[feature[at], moving] <= cut[at]
            node[moving] = children[goes_left.astype(np.int64), at]


# --- rows ------------------------------------------------------------------------------------


def feature_cuts(rows: DataFrame, features: Sequence[str], label: str, weights: tuple[float, float], count: int, seed: int) -> list[np.ndarray]:
    """At most 31 cuts a feature, between values of about 10,000 weighted rows; a value equal to a cut lies below it."""
    kept = rows.select(*[ref(name) for name in features], F.when(ref(label) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0])))
    if count > CUT_ROWS:
        kept = kept.sample(min(1.0, CUT_ROWS / count), seed)
    *values, weight = (column.to_numpy() for column in kept.toArrow().columns)
    return [_cuts(column, weight) for column in values]


def _cuts(values: np.ndarray, weight: np.ndarray) -> np.ndarray:
    found, place = np.unique(values, return_inverse=True)
    if len(found) < 2:
        return np.empty(0)
    ends = np.arange(len(found) - 1)
    if len(ends) > BINS - 1:
        before = np.cumsum(np.bincount(place, weight))
        targets = np.arange(1, BINS) * (before[-1] / BINS)
        above = np.clip(np.searchsorted(before, targets), 1, len(found) - 1)
        nearer = np.where(targets - before[above - 1] < before[above] - targets, above - 1, above)
        ends = np.unique(np.clip(nearer, 0, len(found) - 2))
    return np.unique(found[ends] / 2 + found[ends + 1] / 2)


def binned_blocks(rows: DataFrame, features: Sequence[str], label: str, cuts: Sequence[np.ndarray]) -> DataFrame:
    """The rows as blocks of bytes, one for each bin and label, written once."""
    names = [f"f{i}" for i in range(len(features))]
    plain = rows.select(*[ref(f).cast("double").alias(n) for f, n in zip(features, names)], ref(label).cast("double").alias("label"))

    def block(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts)
        labels = whole.column("label").to_numpy()
        if not np.isin(labels, (0.0, 1.0)).all():
            raise ValueError("forests are trained on rows of the classes 0 and 1 only")
        bins = np.array([np.searchsorted(cuts[i], whole.column(n).to_numpy()) for i, n in enumerate(names)], dtype=np.uint8)
        values = [[number], [whole.num_rows], [bins.tobytes()], [labels.astype(np.uint8).tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["block", "row_count", "bins", "labels"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, count = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= BLOCK_ROWS:
                yield block(number, held)
                number, held, count = number + 1, [], 0
        if count:
            yield block(number, held)

    return written(plain.mapInArrow(blocks, BLOCKS), "blocks")


def _read_blocks(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for block, count, bins, labels in zip(*(column.to_pylist() for column in batch.columns)):
            yield block, np.frombuffer(bins, np.uint8).reshape(features, count), np.frombuffer(labels, np.uint8)


def _times(plan: ForestPlan, tree: int, block: int, count: int) -> np.ndarray:
    """How often a tree draws each row of a block."""
    return POISSON[np.random.default_rng([plan.seed, tree, block]).integers(0, 65_536, count, dtype=np.uint16)]


def _features_tried(plan: ForestPlan, random: np.random.Generator, nodes: int) -> np.ndarray:
    if plan.tried >= plan.features:
        return np.tile(np.arange(plan.features), (nodes, 1))
    return random.random((nodes, plan.features), dtype=np.float32).argpartition(plan.tried - 1, axis=1)[:, : plan.tried]


def _crown_random(plan: ForestPlan, tree: int, node: int) -> np.random.Generator:
    return np.random.default_rng([plan.seed, tree, 1, node])


# --- splits ----------------------------------------------------------------------------------


def _row_counts(tried: np.ndarray, slots: np.ndarray, bins: np.ndarray, stride: int, rows: np.ndarray, labels: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Drawn rows by node, feature tried, bin and class; ``bins`` is flat, ``stride`` rows a feature."""
    nodes, features = tried.shape
    counts = np.empty((features, nodes * BINS * 2))
    first = slots * (BINS * 2)
    first += labels[rows]
    drawn = times[rows].astype(np.float64)
    for k in range(features):
        at = (tried[:, k] * stride)[slots]
        at += rows
        cell = bins[at].astype(np.int64)
        cell *= 2
        cell += first
        counts[k] = np.bincount(cell, drawn, nodes * BINS * 2)
    return counts.reshape(features, nodes, BINS, 2).transpose(1, 0, 2, 3)


def _best_splits(counts: np.ndarray, plan: ForestPlan) -> tuple[np.ndarray, ...]:
    """Of each node: feature tried, bin, gain (Gini, weighted), both classes left of it; gain -1 without a split."""
    below = counts.cumsum(axis=2)
    whole = below[:, :1, -1:, :]
    w0, w1 = plan.weights
    left0, left1 = below[..., 0], below[..., 1]
    right0, right1 = whole[..., 0] - left0, whole[..., 1] - left1
    allowed = (left0 + left1 >= plan.leaf) & (right0 + right1 >= plan.leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = ((w0 * left0) ** 2 + (w1 * left1) ** 2) / (w0 * left0 + w1 * left1)
        score += ((w0 * right0) ** 2 + (w1 * right1) ** 2) / (w0 * right0 + w1 * right1)
    score[~allowed] = -1.0
    best = score.reshape(len(score), -1).argmax(axis=1)
    tried, cut = np.divmod(best, BINS)
    node = np.arange(len(score))
    all0, all1 = w0 * whole[:, 0, 0, 0], w1 * whole[:, 0, 0, 1]
    gain = (score[node, tried, cut] - (all0**2 + all1**2) / (all0 + all1)) / (all0 + all1)
    gain[(score[node, tried, cut] < 0) | (gain <= LEAST_GAIN)] = -1.0
    return tried, cut, gain, left0[node, tried, cut], left1[node, tried, cut]


def _may_split(n0: np.ndarray, n1: np.ndarray, plan: ForestPlan) -> np.ndarray:
    return (n0 > 0) & (n1 > 0) & (n0 + n1 >= 2 * plan.leaf)


def grow(bins: np.ndarray, labels: np.ndarray, times: np.ndarray, depth: int, plan: ForestPlan, random: np.random.Generator) -> dict[str, np.ndarray]:
    """All nodes below one, level by level; a child's number is larger than its parent's.

    Siblings that are leaves of the same class become one leaf, as in ``pyspark.ml``.
    """
    stride, flat = bins.shape[1], np.ascontiguousarray(bins).ravel()
    rows = np.arange(stride)
    n0, n1 = (np.array([times[labels == group].sum(dtype=np.float64)]) for group in (0, 1))
    levels, ids, made = [], np.zeros(1, dtype=np.int64), 1
    is_open = _may_split(n0, n1, plan) & (depth > 0)
    slots = np.zeros(stride, dtype=np.int64)
    if not is_open[0]:
        rows = rows[:0]
    for level in range(depth + 1):
        total = len(ids)
        feature, cut = np.full(total, -1), np.zeros(total, dtype=np.int64)
        gain, left0, left1 = np.full(total, -1.0), np.zeros(total), np.zeros(total)
        opened = np.flatnonzero(is_open)
        if opened.size:
            tried = _features_tried(plan, random, len(opened))
            ends = np.cumsum(np.bincount(slots, minlength=len(opened)))
            step = max(1, COUNTS_AT_ONCE // (tried.shape[1] * BINS * 2))
            for start in range(0, len(opened), step):
                stop = min(start + step, len(opened))
                part = slice(ends[start - 1] if start else 0, ends[stop - 1])
                counts = _row_counts(tried[start:stop], slots[part] - start, flat, stride, rows[part], labels, times)
                which, at, won, l0, l1 = _best_splits(counts, plan)
                nodes = opened[start:stop]
                split = won > 0
                feature[nodes] = np.where(split, tried[np.arange(start, stop), which], -1)
                cut[nodes], gain[nodes], left0[nodes], left1[nodes] = at, won, l0, l1
        split = np.flatnonzero(feature >= 0)
        left_id, right_id = np.full(total, -1), np.full(total, -1)
        left_id[split] = made + 2 * np.arange(len(split))
        right_id[split] = left_id[split] + 1
        levels.append((ids, feature, np.where(feature >= 0, cut, 0), gain, left_id, right_id, n0, n1))
        if not split.size:
            break
        made += 2 * len(split)
        ids = np.column_stack([left_id[split], right_id[split]]).ravel()
        next0 = np.column_stack([left0[split], n0[split] - left0[split]]).ravel()
        next1 = np.column_stack([left1[split], n1[split] - left1[split]]).ravel()
        next_open = _may_split(next0, next1, plan) & (level + 1 < depth)
        # Rows stay in the order of their nodes: those going left and those going right are merged.
        numbers = np.append(np.where(next_open, np.cumsum(next_open) - 1, -1), -1)
        pair = np.full(total, -1)
        pair[split] = np.arange(len(split))
        pair = pair[opened]
        goes_left = flat[(feature[opened] * stride)[slots] + rows] <= cut[opened][slots]
        sizes = np.zeros(int(next_open.sum()), dtype=np.int64)
        sides = []
        for child, chosen in ((0, goes_left), (1, ~goes_left)):
            number = np.where(pair >= 0, numbers[2 * pair + child], -1)
            chosen &= (number >= 0)[slots]
            sides.append(rows[chosen])
            here = np.bincount(slots[chosen], minlength=len(opened))
            sizes[number[number >= 0]] = here[number >= 0]
        is_left = np.repeat(np.flatnonzero(next_open) % 2 == 0, sizes)
        rows = np.empty(len(is_left), dtype=np.int64)
        rows[is_left], rows[~is_left] = sides
        slots = np.repeat(np.arange(len(sizes)), sizes)
        n0, n1, is_open = next0, next1, next_open
    return _pruned([len(level[0]) for level in levels], plan, *(np.concatenate(values) for values in zip(*levels)))


def _pruned(sizes: list[int], plan: ForestPlan, ids, feature, cut, gain, left_id, right_id, n0, n1) -> dict[str, np.ndarray]:
    says = n1 * plan.weights[1] > n0 * plan.weights[0]
    ends = np.cumsum(sizes)
    for start, end in zip((ends - sizes)[::-1], ends[::-1]):
        inner = np.arange(start, end)[feature[start:end] >= 0]
        left, right = left_id[inner], right_id[inner]
        merged = inner[(feature[left] < 0) & (feature[right] < 0) & (says[left] == says[right])]
        feature[merged], cut[merged], gain[merged], left_id[merged], right_id[merged] = -1, 0, -1.0, -1, -1
    kept = np.zeros(len(ids), dtype=bool)
    kept[0] = True
    for start, end in zip(ends - sizes, ends):
        inner = np.arange(start, end)[kept[start:end] & (feature[start:end] >= 0)]
        kept[left_id[inner]] = kept[right_id[inner]] = True
    number = np.append(np.cumsum(kept) - 1, -1)
    found = {"id": number[ids], "feature": feature, "bin": cut, "gain": gain, "left_id": number[left_id], "right_id": number[right_id], "n0": n0, "n1": n1}
    return {name: values[kept] for name, values in found.items()}


# --- trees over many tasks -------------------------------------------------------------------


def _split_wide(blocks: DataFrame, crowns: dict[int, Crown], plan: ForestPlan) -> None:
    """Split the wide nodes of all crowns by one pass over the blocks."""
    waiting = {tree: crown for tree, crown in crowns.items() if crown.wide}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        tried = {tree: np.concatenate([_features_tried(plan, _crown_random(plan, tree, n), 1) for n in crown.wide]) for tree, crown in waiting.items()}
        for block, bins, labels in _read_blocks(batches, plan.features):
            for tree, crown in waiting.items():
                times = _times(plan, tree, block, len(labels))
                drawn = np.flatnonzero(times)
                slot_of = np.full(len(crown.feature), -1)
                slot_of[crown.wide] = np.arange(len(crown.wide))
                slots = slot_of[crown.nodes_of(bins[:, drawn])]
                rows, slots = drawn[slots >= 0], slots[slots >= 0]
                found = _row_counts(tried[tree], slots, bins.reshape(-1), len(labels), rows, labels, times)
                sums[tree] = sums[tree] + found if tree in sums else found
        for tree, found in sums.items():
            nodes = waiting[tree].wide
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(nodes), pa.int32()), pa.array(nodes, pa.int32()), pa.array([np.ascontiguousarray(x).tobytes() for x in found], pa.binary())],
                ["tree", "node", "counts"],
            )

    def decided(table: pa.Table) -> pa.Table:
        tree, node = (table.column(n)[0].as_py() for n in ("tree", "node"))
        counts = sum(np.frombuffer(x, np.float64) for x in table.column("counts").to_pylist()).reshape(1, -1, BINS, 2)
        which, cut, gain, left0, left1 = _best_splits(counts, plan)
        tried = _features_tried(plan, _crown_random(plan, tree, node), 1)
        n0, n1 = counts[0, 0].sum(axis=0)
        row = (tree, node, tried[0, which[0]] if gain[0] > 0 else -1, cut[0], gain[0], n0, n1, left0[0], left1[0])
        schema = pa.schema([(n, pa.float64() if n == "gain" else pa.int64() if n[-1] in "01" else pa.int32()) for n in (c.split()[0] for c in SPLITS.split(", "))])
        return pa.table([[float(v) if f.name == "gain" else int(v)] for v, f in zip(row, schema)], schema=schema)

    for row in blocks.mapInArrow(counted, COUNTS).groupBy("tree", "node").applyInArrow(decided, SPLITS).collect():
        crown, node = crowns[row["tree"]], row["node"]
        crown.counts[node] = (row["n0"], row["n1"])
        crown.wide.remove(node)
        if row["feature"] < 0 or min(crown.counts[node]) == 0:
            continue
        crown.feature[node], crown.bin[node], crown.gain[node] = row["feature"], row["bin"], row["gain"]
        level = crown.level[node] + 1
        left = (row["left0"], row["left1"])
        right = (row["n0"] - left[0], row["n1"] - left[1])
        crown.left[node], crown.right[node] = (crown.add(counts, level) for counts in (left, right))
        for child in (crown.left[node], crown.right[node]):
            n0, n1 = crown.counts[child]
            if level < plan.depth and _may_split(np.int64(n0), np.int64(n1), plan):
                (crown.wide if n0 + n1 > plan.subtree_rows else crown.small).append(child)
    for tree in waiting:
        crowns[tree].wide.sort()
        crowns[tree].small.sort()


def _grown(blocks: DataFrame, crowns: dict[int, Crown], plan: ForestPlan) -> DataFrame:
    """The nodes below all small nodes of the crowns, written once; each grows in one task."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, bins, labels in _read_blocks(batches, plan.features):
            for tree, crown in crowns.items():
                times = _times(plan, tree, block, len(labels))
                drawn = np.flatnonzero(times)
                mine = bins[:, drawn]
                node_of = crown.nodes_of(mine)
                for node in crown.small:
                    rows = np.flatnonzero(node_of == node)
                    if rows.size:
                        at = drawn[rows]
                        values = [[tree], [node], [block], [len(rows)], [mine[:, rows].tobytes()], [labels[at].tobytes()], [times[at].tobytes()]]
                        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], [c.split()[0] for c in DRAWN.split(", ")])

    def rest(table: pa.Table) -> pa.Table:
        tree, node = (table.column(n)[0].as_py() for n in ("tree", "node"))
        table = table.sort_by("place")
        sizes = table.column("row_count").to_pylist()
        bins = np.concatenate([np.frombuffer(x, np.uint8).reshape(plan.features, n) for x, n in zip(table.column("bins").to_pylist(), sizes)], axis=1)
        labels, times = (np.concatenate([np.frombuffer(x, np.uint8) for x in table.column(n).to_pylist()]) for n in ("labels", "times"))
        del table
        found = grow(bins, labels, times, plan.depth - crowns[tree].level[node], plan, np.random.default_rng([plan.seed, tree, 2, node]))
        count = len(found["id"])
        columns = {"tree": np.full(count, tree), "root": np.full(count, node), **found}
        kinds = {"gain": pa.float64(), "n0": pa.int64(), "n1": pa.int64()}
        names = [c.split()[0] for c in NODES.split(", ")]
        return pa.table([pa.array(columns[n].astype(kinds.get(n, pa.int32()).to_pandas_dtype()), kinds.get(n, pa.int32())) for n in names], names=names)

    tasks = 4 * max(1, sum(len(crown.small) for crown in crowns.values()))
    sent = blocks.mapInArrow(dealt, DRAWN).repartition(min(tasks, 4_000), "tree", "node")
    path = scratch_path(blocks.sparkSession, "nodes")
    sent.groupBy("tree", "node").applyInArrow(rest, NODES).write.partitionBy("tree").parquet(path)
    return blocks.sparkSession.read.schema(NODES).parquet(path)


@dataclass(frozen=True)
class GrownTrees:
    """Trees of one batch: their crowns, the nodes below them, and how many each has."""

    crowns: dict[int, Crown]
    nodes: DataFrame
    below: dict[tuple[int, int], int]

    def size(self, tree: int) -> int:
        crown = self.crowns[tree]
        return len(crown.feature) + sum(max(0, self.below.get((tree, node), 0) - 1) for node in crown.small)


def grow_trees(blocks: DataFrame, rows: int, trees: Sequence[int], plan: ForestPlan) -> GrownTrees:
    crowns = {tree: Crown() for tree in trees}
    for crown in crowns.values():
        (crown.wide if rows > plan.subtree_rows and plan.depth > 0 else crown.small).append(0)
    while any(crown.wide for crown in crowns.values()):
        _split_wide(blocks, crowns, plan)
    nodes = _grown(blocks, crowns, plan)
    below = {(row["tree"], row["root"]): row["count"] for row in nodes.groupBy("tree", "root").count().collect()}
    return GrownTrees(crowns, nodes, below)


def trees_at_once(rows: int, plan: ForestPlan) -> int:
    """Trees whose drawn rows (63 of 100) are dealt to tasks together."""
    return max(1, int(DEALT_BYTES // (0.64 * max(rows, 1) * (plan.features + 2))))


# --- saved as pyspark.ml models --------------------------------------------------------------


def save_forest(spark: SparkSession, grown: GrownTrees, trees: Sequence[int], cuts: Sequence[np.ndarray], plan: ForestPlan, parameters: dict[str, object], path: str) -> None:
    """Some of the trees as a ``RandomForestClassificationModel``."""
    crown_rows, places = [], []
    for number, tree in enumerate(trees):
        crown, offset = grown.crowns[tree], len(grown.crowns[tree].feature)
        small = set(crown.small)
        for node in range(len(crown.feature)):
            if node in small and (tree, node) in grown.below:
                # The root of what was grown takes the place of the node, the others follow the crown.
                places.append((tree, node, number, node, offset - 1))
                offset += grown.below[tree, node] - 1
            else:
                crown_rows.append((number, node, crown.feature[node], crown.bin[node], crown.gain[node], crown.left[node], crown.right[node], *crown.counts[node]))
    shape = "tree_id int, id int, feature int, bin int, gain double, left_id int, right_id int, n0 long, n1 long"
    columns = [c.split()[0] for c in shape.split(", ")]
    nodes = spark.createDataFrame(crown_rows, shape)
    if places:
        put = spark.createDataFrame(places, "tree int, root int, tree_id int, place int, shift int")

        def moved(name):
            return F.when(F.col(name) > 0, F.col(name) + F.col("shift")).when(F.col(name) == 0, F.col("place")).otherwise(F.lit(-1)).alias(name)

        grown_rows = grown.nodes.filter(F.col("tree").isin(list(trees))).join(F.broadcast(put), ["tree", "root"])
        nodes = nodes.unionByName(grown_rows.select(*[moved(c) if c in ("id", "left_id", "right_id") else F.col(c) for c in columns]))
    w0, w1 = plan.weights
    stats = F.array(F.col("n0") * F.lit(w0), F.col("n1") * F.lit(w1))
    total = stats[0] + stats[1]
    all_cuts = F.array(*[F.array(*[F.lit(float(x)) for x in c]).cast("array<double>") for c in cuts])
    inner = F.col("feature") >= 0
    split = F.struct(
        F.col("feature").alias("featureIndex"),
        F.when(inner, F.array(F.get(F.get(all_cuts, F.col("feature")), F.col("bin")))).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    data = nodes.select(
        F.col("tree_id").alias("treeID"),
        F.struct(
            F.col("id"),
            (stats[1] > stats[0]).cast("double").alias("prediction"),
            (1.0 - (stats[0] * stats[0] + stats[1] * stats[1]) / (total * total)).alias("impurity"),
            stats.alias("impurityStats"),
            (F.col("n0") + F.col("n1")).alias("rawCount"),
            F.col("gain"),
            F.col("left_id").alias("leftChild"),
            F.col("right_id").alias("rightChild"),
            split.alias("split"),
        ).alias("nodeData"),
    )
    data.write.parquet(f"{path}/data")
    described = [(number, _description(spark, TREE_CLASS, parameters, numFeatures=plan.features, numClasses=2), 1.0) for number in range(len(trees))]
    spark.createDataFrame(described, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = _description(spark, MODEL_CLASS, {**parameters, "numTrees": len(trees)}, numFeatures=plan.features, numClasses=2, numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")


def _description(spark: SparkSession, kind: str, parameters: dict[str, object], **more: int) -> str:
    return json.dumps(
        {
            "class": kind,
            "timestamp": int(time.time() * 1000),
            "sparkVersion": spark.version,
            "uid": f"forest_{uuid.uuid4().hex[:12]}",
            "paramMap": parameters,
            "defaultParamMap": {},
            **more,
        }
    )

"""Near duplicates by SimHash fingerprints and BK-trees.

Fingerprints are 64 bits over word shingles.  Equal fingerprints are one node
with as many rows as it has.  Nodes that may be within the radius share the bits
of some choice of blocks (of ``radius + 3`` blocks at most ``radius`` differ), so
every such choice is a shard of its own.  A shard's nodes form BK-trees, whose
children are keyed by their integer Hamming distance to the parent, and a search
follows only the edges that the radius allows.  A large shard is cut into trees
of bounded size, and every node of the shard visits each.  Shards answer with a
spanning forest of the links they find, never with all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.llm.components import connected_components
from gaugeworks.llm.frames import Batches, batches_of, batches_up_to, forget_shuffles, text_bytes
from gaugeworks.llm.tokens import forget_encoders
from gaugeworks.sources.scratch import drop_written, written

BITS = 64
SEED = 42
TREE_NODES = 4_096
_SLICE = 255 << 8


class BKTree:
    """Fingerprints, each below the parent's child for their distance."""

    def __init__(self) -> None:
        self._nodes: list[tuple[int, dict[int, int]]] = []

    def add(self, value: int) -> None:
        nodes, at = self._nodes, 0
        if nodes:
            while True:
                own, children = nodes[at]
                distance = (own ^ value).bit_count()
                if distance not in children:
                    children[distance] = len(nodes)
                    break
                at = children[distance]
        nodes.append((value, {}))

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Positions, in order of insertion, of the fingerprints at most ``radius`` away."""
        nodes = self._nodes
        stack = [0] if nodes else []
        while stack:
            at = stack.pop()
            own, children = nodes[at]
            distance = (own ^ value).bit_count()
            if distance <= radius:
                yield at
            for edge, child in children.items():
                if distance - radius <= edge <= distance + radius:
                    stack.append(child)


class Forest:
    """Union-find that tells whether a link joined two trees."""

    def __init__(self, size: int) -> None:
        self._parent = list(range(size))

    def find(self, at: int) -> int:
        parent = self._parent
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    def join(self, left: int, right: int) -> bool:
        left, right = self.find(left), self.find(right)
        self._parent[max(left, right)] = min(left, right)
        return left != right


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words, repeats included; fewer words make one shingle."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), SEED)], np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    begins = [0, *(ends[:-words] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[begin:end], SEED) for begin, end in zip(begins, ends[words - 1 :].tolist())),
        np.uint64,
        len(found) - words + 1,
    )


_LOW = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """Per row of hashes, how often each bit (most significant first) is set.

    Eight counters of a byte each share a word, so up to 255 words are added
    before the bytes are taken apart.
    """
    rows, size = hashes.shape
    counts = np.zeros((rows, BITS), np.int64)
    for begin in range(0, size, _SLICE):
        part = hashes[:, begin : begin + _SLICE]
        groups = -(-part.shape[1] // 255)
        padded = np.zeros((rows, groups * 255), np.uint64)
        padded[:, : part.shape[1]] = part
        for bit in range(8):
            sums = ((padded >> np.uint64(bit)) & _LOW).reshape(rows, groups, 255).sum(2, dtype=np.uint64)
            apart = sums.astype(">u8").view(np.uint8).reshape(rows, groups, 8).sum(1, dtype=np.int64)
            counts[:, 7 - bit :: 8] += apart
    return counts


def majority_bits(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = bit_counts(hashes[None, :])[0]
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``id, fp`` per row, the fingerprint as a signed long."""
    rows = docs.select(ref(id_col).alias("id"), text_bytes(text_col).alias("text"))

    def hashed(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signed(majority_bits(shingle_hashes(text.as_py(), words))) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], ["id", "fp"])

    return rows.mapInArrow(hashed, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def block_masks(radius: int) -> list[int]:
    """Masks (signed) such that two values within ``radius`` bits agree under at least one."""
    blocks = radius + 3
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    single = [((1 << (end - begin)) - 1) << begin for begin, end in zip(cuts, cuts[1:])]
    return [signed(sum(chosen)) for chosen in combinations(single, blocks - radius)]


def _blocks_of_work(members: DataFrame, shard: list[str], tree_nodes: int) -> DataFrame:
    """Members of shards of at least two, with ``i, j, own``: a node in every tree and every search of its shards.

    A shard of n trees has a block of work for each pair of trees ``i <= j``:
    the nodes of tree i, searched by those of tree j.  ``own`` is the tree of
    the node itself.
    """
    shared = (
        members.groupBy(*shard)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select(*shard, F.ceil(F.col("n") / tree_nodes).cast("int").alias("trees"))
    )
    own = F.pmod(F.xxhash64("node"), F.col("trees")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("trees") - 1))
    return (
        members.join(shared, shard)
        .withColumn("own", own)
        .withColumn("other", other)
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
        .drop("trees", "other")
    )


def shard_links(nodes: DataFrame, radius: int, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Links ``a, b`` between fingerprints (``fp``, distinct) within ``radius`` bits: a forest per block of work."""
    masks = block_masks(radius)
    shards: Column = F.explode(
        F.array(*[F.struct(F.lit(number).alias("shard"), F.col("fp").bitwiseAND(F.lit(mask)).alias("value")) for number, mask in enumerate(masks)])
    )
    members = nodes.select(F.col("fp").alias("node"), shards.alias("s")).select("node", "s.shard", "s.value")
    work = _blocks_of_work(members, ["shard", "value"], tree_nodes)
    key = ["shard", "value", "i", "j"]
    ordered = work.repartition(*key).sortWithinPartitions(*key, "own", "node")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def searched(batches: Batches) -> Batches:
        def links():
            for group in _groups(batches, key):
                own, fp = group["own"], group["node"]
                values = fp.view(np.uint64).tolist()
                if len(values) == 2:
                    if (values[0] ^ values[1]).bit_count() <= radius:
                        yield int(fp[0]), int(fp[1])
                    continue
                same = group["i"][0] == group["j"][0]
                split = len(values) if same else int(np.searchsorted(own, own[0], side="right"))
                tree, forest = BKTree(), Forest(len(values))
                for at in range(split):
                    if same:
                        for found in tree.within(values[at], radius):
                            if forest.join(found, at):
                                yield int(fp[found]), int(fp[at])
                    tree.add(values[at])
                for at in range(split, len(values)):
                    for found in tree.within(values[at], radius):
                        if forest.join(found, at):
                            yield int(fp[found]), int(fp[at])

        yield from batches_of(schema, links(), 10_000)

    return ordered.mapInArrow(searched, "a long, b long")


def _groups(batches: Batches, key: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Runs of rows with equal keys in a sorted stream."""
    held: list[dict[str, np.ndarray]] = []

    def whole() -> dict[str, np.ndarray]:
        return {name: np.concatenate([part[name] for part in held]) for name in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
        changes = np.zeros(batch.num_rows, bool)
        for name in key:
            changes[1:] |= rows[name][1:] != rows[name][:-1]
        cuts = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            part = {name: values[begin:end] for name, values in rows.items()}
            if held and any(held[0][name][0] != part[name][0] for name in key):
                yield whole()
                held = []
            held.append(part)
    if held:
        yield whole()


def near_duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    radius: int = 2,
    tree_nodes: int = TREE_NODES,
) -> DataFrame:
    """``id_col, fingerprint, component_id`` per row.

    Texts are compared with A-Z in lower case, words being what ASCII blanks
    part.  ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the
    smallest id among all rows whose fingerprints can be reached in steps of at
    most ``radius`` bits.  A null or empty text has the fingerprint zero and is
    linked like any other; repeated rows have equal results; null ids take no
    part in the minimum, and a group of null ids only has a null component; an
    empty table gives no rows.  Other columns are not looked at.
    """
    found = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = written(found.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = connected_components(shard_links(nodes, radius, tree_nodes), "links")
    members = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = members.groupBy("root").agg(F.min("least").alias("component_id"))
    named = members.join(smallest, "root").select("fp", "component_id")
    return found.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# --- similarity of shingle sets -----------------------------------------------------------

#: Sets whose fingerprints differ in at most so many bits are counted before all others.
NEAR_BITS = 2
#: Hashes of a set's shingles whose minimum lets near copies meet before all others.
FIRST_LANES = 3
#: Nodes that share a shingle meet in blocks of work of about twice so many.
SHINGLE_NODES = 512
#: A set has a parity sketch of about as many bits as shingles, and so many at least.
SKETCH_BITS = 64
#: Shingles of at least ``HOT_COUNT`` of ``HOT_SAMPLE`` sets come last in the order; this decides speed only.
HOT_SAMPLE, HOT_COUNT, HOT_SHINGLES = 4_000, 8, 65_536
#: Links a node may propose per block and round, nearest first; all that are left in the last.
NEAREST = (4, 32, 256, None)
#: What moves between Spark and a worker at a time.
BATCH_BYTES = 4 << 20


def lane_hashes(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """Independent hashes of the same shingles, a row per lane."""
    salts = np.random.default_rng(SEED).integers(1, 1 << 63, lanes, np.uint64)[:, None]
    with np.errstate(over="ignore"):
        mixed = hashes[None, :] ^ salts
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return mixed ^ (mixed >> np.uint64(31))


def packed_set(text: bytes, words: int) -> np.ndarray:
    """The set of shingles as ascending 32-bit hashes."""
    return np.unique((shingle_hashes(text, words) >> np.uint64(32)).astype(np.uint32))


def prefix_length(size: int, similarity: float) -> int:
    """So many first shingles in a common order hold one of any set that is similar."""
    return size - math.ceil(similarity * size - 1e-9) + 1


def parity_sketch(values: np.ndarray) -> bytes:
    """Per bit whether an odd number of shingles fall on it: two sets differ in at least as many shingles as bits."""
    size = max(SKETCH_BITS, 1 << (len(values) - 1).bit_length())
    return np.packbits(np.bincount(values & np.uint32(size - 1), minlength=size) & 1, bitorder="little").tobytes()


def _sets(docs: DataFrame, id_col: str, text_col: str, words: int, with_shingles: bool) -> DataFrame:
    """``id, same, node`` or ``node, n, shingles, sketch, fp`` per row.

    ``node`` is a hash of the whole set of shingles, ``fp`` its SimHash fingerprint.
    """
    rows = docs.select(ref(id_col).alias("id"), F.xxhash64(ref(text_col)).alias("same"), text_bytes(text_col).alias("text"))

    def hashed(batches: Batches) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            sets = [packed_set(text.as_py(), words) for text in batch.column("text")]
            nodes = pa.array([signed(xxhash.xxh3_64_intdigest(found.tobytes())) for found in sets], pa.int64())
            if not with_shingles:
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("same"), nodes], ["id", "same", "node"])
                continue
            sizes = pa.array(list(map(len, sets)), pa.int32())
            shingles = pa.array([found.tobytes() for found in sets], pa.binary())
            sketches = pa.array([parity_sketch(found) if len(found) else b"" for found in sets], pa.binary())
            fps = pa.array([signed(majority_bits(lane_hashes(found.astype(np.uint64), 1)[0])) for found in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([nodes, sizes, shingles, sketches, fps], ["node", "n", "shingles", "sketch", "fp"])

    if with_shingles:
        return rows.select("text").mapInArrow(hashed, "node long, n int, shingles binary, sketch binary, fp long")
    return rows.mapInArrow(hashed, f"id {rows.schema['id'].dataType.simpleString()}, same long, node long")


def _hot_shingles(nodes: DataFrame) -> np.ndarray:
    """Shingles that many sets of a sample hold, the rarest first."""
    scale = 1 << 30
    limit = min(scale, scale * HOT_SAMPLE // max(1, nodes.count()))

    def apart(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("shingles"):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(packed.as_py(), np.int32))], ["shingle"])

    sample = nodes.filter(F.pmod(F.xxhash64(F.lit(1), "node"), F.lit(scale)) < limit).select("shingles")
    counts = sample.mapInArrow(apart, "shingle int").groupBy("shingle").agg(F.count("*").alias("n"))
    hot = counts.filter(F.col("n") >= HOT_COUNT).orderBy(F.col("n").desc(), "shingle").limit(HOT_SHINGLES).collect()
    return np.array([row["shingle"] for row in reversed(hot)], np.int32).view(np.uint32)


def prefix_members(nodes: DataFrame, similarity: float, hot: np.ndarray) -> DataFrame:
    """``shingle, node, n, at``: the first shingles of each set, ascending with those of ``hot`` last, with their places."""
    by_value = np.argsort(hot)
    shared = nodes.sparkSession.sparkContext.broadcast((hot[by_value], by_value))

    def first(batches: Batches) -> Iterator[pa.RecordBatch]:
        values, ranks = shared.value
        for batch in batches:
            parts = []
            for packed in batch.column("shingles"):
                own = np.frombuffer(packed.as_py(), np.uint32)
                if len(values):
                    place = np.minimum(np.searchsorted(values, own), len(values) - 1)
                    late = values[place] == own
                    own = np.concatenate([own[~late], own[late][np.argsort(ranks[place[late]])]])
                parts.append(own[: prefix_length(len(own), similarity)])
            if not parts:
                continue
            counts = np.array(list(map(len, parts)))
            node, size = (np.repeat(batch.column(name).to_numpy(zero_copy_only=False), counts) for name in ("node", "n"))
            at = np.concatenate([np.arange(count, dtype=np.int32) for count in counts])
            whole = [pa.array(np.concatenate(parts).view(np.int32)), pa.array(node), pa.array(size), pa.array(at)]
            yield pa.RecordBatch.from_arrays(whole, ["shingle", "node", "n", "at"])

    return nodes.select("node", "n", "shingles").mapInArrow(first, "shingle int, node long, n int, at int")


def _sketch_distances(sketches: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Bits that differ for the wanted pairs; of sketches of unequal length the longer is folded."""
    found = np.zeros(wanted.shape, np.int32)
    lengths = np.array([len(sketch) for sketch in sketches])
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths >= length)
        rows = np.zeros((len(own), length // 8), np.uint64)
        for size in np.unique(lengths[own]):
            of_size = np.flatnonzero(lengths[own] == size)
            whole = np.frombuffer(b"".join(sketches[own[of_size]]), np.uint64).reshape(len(of_size), -1, length // 8)
            rows[of_size] = np.bitwise_xor.reduce(whole, axis=1)
        shortest = lengths[own] == length
        for at, place in enumerate(own):
            others = np.flatnonzero(wanted[place, own] & (shortest | shortest[at]))
            if len(others):
                found[place, own[others]] = np.bitwise_count(rows[others] ^ rows[at]).sum(1)
    return found


def proposed_links(group: dict[str, np.ndarray], similarity: float, nearest: int | None) -> tuple[np.ndarray, bool]:
    """Pairs of places in a block that may be similar and are not joined yet: the nearest of each node, and whether that is all.

    What is left out for good is surely not similar: by the sizes, by the places
    of the shared shingle (the first that two similar sets share leaves room for
    the others), or by more sketch bits than shingles may differ.
    """
    size, at, root, own = group["n"], group["at"], group["root"], group["own"]
    sums = size[:, None] + size[None, :].astype(np.float32)
    rest = size - at
    wanted = np.minimum.outer(size, size) >= similarity * np.maximum.outer(size, size) - 1e-3
    wanted &= np.minimum.outer(rest, rest) >= sums * (similarity / (1 + similarity)) - 1e-2
    wanted &= root[:, None] != root[None, :]
    if group["i"][0] != group["j"][0]:
        wanted &= own[:, None] != own[None, :]
    if not wanted.any():
        return np.zeros((0, 2), np.int64), True
    distance = _sketch_distances(group["sketch"], wanted)
    wanted &= distance <= sums * ((1 - similarity) / (1 + similarity)) + 1e-2
    whole = nearest is None or int(wanted.sum(1).max()) <= nearest
    if not whole:
        score = np.where(wanted, distance / sums, np.float32(np.inf))
        chosen = np.zeros_like(wanted)
        np.put_along_axis(chosen, np.argpartition(score, nearest - 1, axis=1)[:, :nearest], True, axis=1)
        wanted &= chosen | chosen.T
    return np.argwhere(np.triu(wanted | wanted.T)), whole


_BLOCK_KEY = ["shingle", "i", "j"]


def _proposals(work: DataFrame, similarity: float, nearest: int | None) -> DataFrame:
    """``a, b``: the links that the blocks propose; ``shingle, i, j`` of the blocks that have more."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shingle", pa.int32()), ("i", pa.int32()), ("j", pa.int32())])

    def searched(batches: Batches) -> Batches:
        def links():
            for group in _groups(batches, _BLOCK_KEY):
                if group["root"].min() == group["root"].max():
                    continue
                node = group["node"]
                pairs, whole = proposed_links(group, similarity, nearest)
                if not whole:
                    yield (None, None, *(int(group[name][0]) for name in _BLOCK_KEY))
                ends = np.sort(node[pairs], axis=1)
                yield from ((a, b, None, None, None) for a, b in zip(ends[:, 0].tolist(), ends[:, 1].tolist()))

        yield from batches_of(schema, links(), 10_000)

    kind = "a long, b long, shingle int, i int, j int"
    return work.repartition(*_BLOCK_KEY).sortWithinPartitions(*_BLOCK_KEY).mapInArrow(searched, kind).distinct()


def _first_pairs(nodes: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: every set beside one that has a minimal shingle and about the size in common with it.

    As many pairs as sets and lanes at most, whatever the groups: most near
    copies are joined by them, so that the exact search has few sets left to
    tell apart.
    """
    schema = pa.schema([("lane", pa.int32()), ("least", pa.int64()), ("band", pa.int32()), ("node", pa.int64()), ("n", pa.int32())])

    def minima(batches: Batches) -> Batches:
        def rows():
            for batch in batches:
                for node, n, packed in zip(*(batch.column(name).to_pylist() for name in ("node", "n", "shingles"))):
                    hashes = lane_hashes(np.frombuffer(packed, np.uint32).astype(np.uint64), FIRST_LANES).min(1)
                    band = int(math.log(n) / -math.log(similarity)) if similarity < 1 else n
                    for lane, least in enumerate(hashes.view(np.int64).tolist()):
                        yield lane, least, band, node, n

        yield from batches_of(schema, rows(), 20_000)

    key = ["lane", "least", "band"]
    found = nodes.select("node", "n", "shingles").mapInArrow(minima, "lane int, least long, band int, node long, n int")
    firsts = found.groupBy(*key).agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("size")).filter("size > 1")
    alike = F.least("n", F.col("first.n")) >= similarity * F.greatest("n", F.col("first.n")) - 1e-3
    return found.join(firsts, key).filter((F.col("node") != F.col("first.node")) & alike).select(
        F.least("node", F.col("first.node")).alias("a"), F.greatest("node", F.col("first.node")).alias("b")
    ).distinct()


def _fingerprint_pairs(nodes: DataFrame, radius: int) -> DataFrame:
    """``a, b``: sets whose SimHash fingerprints are equal, or found within ``radius`` bits by BK-trees.

    A spanning forest of such links: equal fingerprints stand in a star around
    their smallest node, which also stands for them in the trees.
    """
    least = written(nodes.groupBy("fp").agg(F.min("node").alias("least")), "fingerprints")
    equal = nodes.select("node", "fp").join(least, "fp").filter("node != least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    links = shard_links(least.select("fp"), radius)
    for side in "ab":
        links = links.join(least.select(F.col("fp").alias(side), F.col("least").alias(f"node_{side}")), side)
    near = links.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    return equal.unionByName(near)


def _sketched(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs that sketches and sizes do not rule out."""
    own = nodes.select("node", "n", "sketch")
    sides = [own.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")) for side in "ab"]

    def kept(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n_a, n_b, one, other in zip(*(batch.column(name).to_pylist() for name in ("n_a", "n_b", "sketch_a", "sketch_b"))):
                short, long = sorted((np.frombuffer(side, np.uint8) for side in (one, other)), key=len)
                folded = np.bitwise_xor.reduce(long.reshape(-1, len(short)), axis=0)
                distance = int(np.bitwise_count(folded ^ short).sum())
                keep.append(distance <= (n_a + n_b) * ((1 - similarity) / (1 + similarity)) + 1e-2)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(kept, "a long, b long")


def _counted_links(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """A written table of the pairs that are similar by their shingles."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    packed = written(nodes.select("node", "shingles").join(needed, "node", "left_semi"), "shingles")
    sided = pairs.join(packed.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a").join(
        packed.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b"
    )
    good = written(_similar(sided.select("a", "b", "left", "right"), "a long, b long", similarity), "similar-pairs")
    drop_written(packed)
    return good


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """A written table ``node, root`` after some more links; only the groups they join are worked on again."""
    if roots is None:
        return written(connected_components(links, "similar"), "roots")
    ends = links
    for side in "ab":
        known = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        ends = ends.join(known, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    between = ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).filter("a != b").distinct()
    merged = connected_components(between, "similar").select(F.col("node").alias("old"), F.col("root").alias("new"))
    moved = roots.join(merged, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    # A root that stood alone is in no table yet.
    alone = merged.join(roots, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    return written(moved.unionByName(alone), "roots")


def _similar(pairs: DataFrame, columns: str, similarity: float) -> DataFrame:
    """Pairs whose packed shingles (``left``, ``right``) are similar, by counting."""

    def counted(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                one, other = (np.frombuffer(side.as_py(), np.uint32) for side in (left, right))
                shared = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(shared >= similarity * (len(one) + len(other) - shared) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(counted, columns)


def similar_links(nodes: DataFrame, similarity: float, shingle_nodes: int = SHINGLE_NODES) -> DataFrame:
    """``node, root``: nodes (``node, n, shingles, sketch, fp``) linked by a Jaccard similarity, all such links counted in.

    Sets of near fingerprints, found by BK-trees, and sets of a minimal shingle
    in common are counted first.  Of the others, two similar sets share one of
    their first shingles, whatever the order, and meet there.  A pair joins only after its shingles were counted.  Each round
    the nodes of a block propose their nearest that are not joined to them yet,
    so a group of near copies is joined without a list of all its pairs; the
    rounds end when no block has a pair left that is neither joined nor counted.
    """
    spark = nodes.sparkSession
    # The nearest first: most near copies are one group before any two of them are searched for.
    firsts = _fingerprint_pairs(nodes, NEAR_BITS).unionByName(_first_pairs(nodes, similarity))
    known = written(firsts.distinct(), "candidates")
    good = _counted_links(_sketched(known, nodes, similarity), nodes, similarity)
    roots = _joined(None, good)
    drop_written(good)
    forget_shuffles(spark)
    members = written(prefix_members(nodes, similarity, _hot_shingles(nodes)), "prefixes", compression="zstd")
    # Sets that are one group already need not meet again.
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("shingle").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least != most").select("shingle")
    work = written(_blocks_of_work(members.join(several, "shingle", "left_semi"), ["shingle"], shingle_nodes), "shingle-members", compression="zstd")
    drop_written(members)
    forget_shuffles(spark)
    unfinished = None
    for nearest in NEAREST:
        own = nodes.select("node", "sketch").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        left = work if unfinished is None else work.join(unfinished, _BLOCK_KEY, "left_semi")
        found = written(_proposals(left.join(own, "node"), similarity, nearest), "candidates")
        pairs = found.filter("a IS NOT NULL").select("a", "b")
        good = _counted_links(pairs.join(known, ["a", "b"], "left_anti"), nodes, similarity)
        before, roots = roots, _joined(roots, good)
        drop_written(before)
        drop_written(good)
        known = known.unionByName(pairs)
        unfinished = found.filter("a IS NULL").select(*_BLOCK_KEY)
        forget_shuffles(spark)
        if unfinished.isEmpty():
            break
    drop_written(work)
    return roots


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8
) -> DataFrame:
    """``id, same, component_id, keeper``: groups of rows linked by a Jaccard similarity of shingle sets.

    Every pair of similar sets is linked (sets of 32-bit hashes of shingles).
    ``component_id`` is the smallest id of the group (null ids take no part) and
    ``keeper`` marks the row that stands for it (of equal rows, all).
    """
    spark = docs.sparkSession
    with batches_up_to(spark, f"{BATCH_BYTES}b"):
        found = written(_sets(docs, id_col, text_col, words, False), "sets", compression="zstd")
        sets = _sets(docs, id_col, text_col, words, True).filter("n > 0")
        first = [F.first(name).alias(name) for name in ("n", "shingles", "sketch", "fp")]
        nodes = written(sets.groupBy("node").agg(*first), "set-nodes", compression="zstd")
        forget_shuffles(spark)
        roots = similar_links(nodes, similarity)
        drop_written(nodes)
    rows = found.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    order = F.struct(F.col("id").isNull(), "id", "same")
    chosen = rows.groupBy("root").agg(F.min(order).alias("first"))
    return rows.join(chosen, "root").select(
        "id", "same", F.col("first.id").alias("component_id"), (order == F.col("first")).alias("keeper")
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8
) -> DataFrame:
    """The rows of ``docs``, one of each group of ``similar_groups``: the one with the smallest id.

    Null and empty texts are equal sets and so one group; rows that repeat
    another in id and text are kept once; an empty table stays empty.  All
    columns pass through unchanged.
    """
    kept = similar_groups(docs, id_col, text_col, words, similarity).filter("keeper").select("id", "same").distinct()
    rows = docs.select(F.struct(*[ref(name) for name in docs.columns]).alias("row"), ref(id_col).alias("id"), F.xxhash64(ref(text_col)).alias("same"))
    joined = rows.alias("r").join(kept.alias("k"), F.col("r.id").eqNullSafe(F.col("k.id")) & (F.col("r.same") == F.col("k.same")))
    single = joined.select("r.row", "r.id", "r.same").dropDuplicates(["id", "same"])
    return single.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])

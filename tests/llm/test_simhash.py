from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from gaugeworks.llm.components import connected_components
from gaugeworks.llm import simhash
from gaugeworks.llm.queries import op5_simhash_near_dedup
from gaugeworks.llm.simhash import BITS, BKTree, block_masks, near_duplicate_groups, shard_links, signed, similar_groups
from tests.llm.brute import WORD, documents

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text, size=3):
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [words[i : i + size] for i in range(len(words) - size + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(BITS) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(rows, radius=2):
    prints = [brute_fingerprint(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for at, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(at)] = min(doc, least.get(find(at), doc))
    return sorted(((doc, f"{prints[at]:016x}", least.get(find(at))) for at, (doc, _) in enumerate(rows)), key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = sorted(map(tuple, op5_simhash_near_dedup(spark, SF).collect()), key=str)
    expected = brute_groups(rows)
    assert found == expected
    assert len({row[2] for row in expected}) < len(rows)


def test_edge_cases(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, None), (4, ""), (7, " \n"), (3, "one"), (5, "ONE"), (6, "one two"), (None, "one two"), (None, "only nulls here"), (2, "a b c")]
    rows += [(20, base), (21, base.upper()), (22, base + " end"), (22, base + " end"), (23, "É é"), (24, "é é")]
    docs = documents(spark, rows).withColumn("fp", F.lit("clash")).withColumn("fingerprint", F.lit(1)).withColumn("root", F.lit(1))
    assert sorted(map(tuple, near_duplicate_groups(docs).collect()), key=str) == brute_groups(rows)
    assert near_duplicate_groups(docs.limit(0)).count() == 0


def test_no_link_is_lost_in_cut_shards(spark):
    """Clusters of fingerprints, shards of several trees: the same components as all pairs give."""
    random.seed(2)
    values = set()
    for _ in range(12):
        center = random.getrandbits(64)
        values |= {center}
        for _ in range(40):
            value = center
            for bit in random.sample(range(64), random.randint(1, 5)):
                value ^= 1 << bit
            values.add(value)
    values = sorted(values)
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    links = {
        size: {tuple(sorted(r)) for r in connected_components(shard_links(nodes, 2, size)).collect()} for size in (4, 64, 4096)
    }
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    groups = {}
    for v in values:
        groups.setdefault(find(v), set()).add(signed(v))
    expected = {frozenset(g) for g in groups.values() if len(g) > 1}
    for size in links:
        roots = {}
        for row in connected_components(shard_links(nodes, 2, size)).collect():
            roots.setdefault(row.root, set()).add(row.node)
        assert {frozenset(g) for g in roots.values()} == expected
        assert all(root == min(group) for root, group in roots.items())


def test_bk_tree_finds_what_a_scan_finds():
    random.seed(4)
    values = [random.getrandbits(16) for _ in range(500)]
    tree = BKTree()
    for value in values:
        tree.add(value)
    for query in values[:50]:
        for radius in (0, 2, 5):
            expected = [i for i, v in enumerate(values) if (v ^ query).bit_count() <= radius]
            assert sorted(tree.within(query, radius)) == expected


def test_masks_hold_for_every_error():
    for radius in (1, 2, 3):
        masks = block_masks(radius)
        random.seed(radius)
        for _ in range(500):
            error = 0
            for bit in random.sample(range(64), radius):
                error |= 1 << bit
            assert any(error & mask == 0 for mask in masks)


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 400), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in connected_components(chain).collect()}
    assert found == {i: 0 for i in range(301)} | {400: 400, 500: 400}


def test_independent_edits_of_one_text_are_one_group(spark):
    """Copies similar to the original only: links between copies fail, those to the original must not be lost."""
    random.seed(6)
    words = [f"w{i}" for i in range(1_000)]
    rows = [(0, " ".join(words))]
    for copy in range(1, 401):
        edited = list(words)
        for place in random.sample(range(0, 1_000, 5), 17):
            edited[place] = f"edit{copy}x{place}"
        rows.append((copy, " ".join(edited)))
    groups = similar_groups(documents(spark, rows)).collect()
    assert {row.component_id for row in groups} == {0}


def test_near_copies_of_the_pipeline_meet_by_fingerprints(spark, monkeypatch):
    words = [f"w{(i * 7919) % 4001}" for i in range(1500)]
    rows = [(i, " ".join([*words[:-1], f"end{i}"])) for i in range(6)] + [(10 + i, f"text {i} of its own words {i * i} and no other {i}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = simhash._sets(docs, "doc_id", "text", 5, True)
    fps = {r.node: r.fp for r in nodes.select("node", "fp").collect()}
    near = {(a, b) for a in fps for b in fps if a < b and ((fps[a] ^ fps[b]) & ((1 << 64) - 1)).bit_count() <= simhash.NEAR_BITS}
    found = {(r.a, r.b) for r in simhash._fingerprint_pairs(nodes, simhash.NEAR_BITS).collect()}
    assert near and found <= near

    def groups(pairs):
        root = {node: node for node in fps}
        for _ in fps:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert groups(found) == groups(near)
    radii = []

    def searched(nodes, radius, *rest):
        radii.append(radius)
        return shard_links(nodes, radius, *rest)

    monkeypatch.setattr(simhash, "shard_links", searched)
    kept = simhash.drop_near_duplicates(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 10, 11, 12, 13]
    assert radii == [simhash.NEAR_BITS]

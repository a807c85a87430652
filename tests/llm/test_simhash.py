"""SimHash near-duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from scoutlens.llm import simhash


def brute_fingerprint(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(fps, bits=3):
    parent = {k: k for k in fps}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if bin(fps[a] ^ fps[b]).count("1") <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    vocabulary = [f"wörd{i}" for i in range(300)]
    out = {}
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.randint(1, 150))
        out[i * 10] = "  ".join(words)
        for j in range(rng.randint(0, 3)):                # near copies: one word changed, or upper case
            copy = list(words)
            copy[rng.randrange(len(copy))] = "new"
            out[i * 10 + j + 1] = "\n".join(copy).upper() if j == 2 else " ".join(copy)
    out |= {1001: "", 1002: None, 1003: "one", 1004: "ONE", 1005: "one two", 1006: " \t\n"}
    return out


def test_fingerprints_and_components(spark, texts):
    docs = spark.createDataFrame([(k, v, 0, "x") for k, v in texts.items()], "doc_id long, text string, fp int, rep string")
    rows = simhash.near_duplicates(docs).collect()
    fps = {k: brute_fingerprint(v) for k, v in texts.items()}
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in rows} == fps
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(fps)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute_components(fps).values()))


def test_large_keys_are_split_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 16)
    rng = random.Random(4)
    base = rng.getrandbits(64)
    fps = {}
    for i in range(300):                                  # a dense ball, a chain, and strangers
        x = base
        for b in rng.sample(range(20), rng.randint(0, 4)):
            x ^= 1 << b
        fps[i] = x if i < 200 else rng.getrandbits(64)
    for i in range(20):
        fps[400 + i] = (1 << 3 * (i + 1)) - 1
    nodes = {}
    for k, x in fps.items():
        nodes[x] = min(k, nodes.get(x, k))
    signed = [(int(np.uint64(x).astype(np.int64)), k) for x, k in nodes.items()]
    links = simhash.links(spark.createDataFrame(signed, "fp long, rep long"))
    got = {r["node"]: r["component"] for r in simhash.components(links).collect()}
    expected = {k: c for k, c in brute_components({k: x for x, k in nodes.items()}).items() if c != k}
    assert got == expected


def test_masks_find_every_pair_at_every_size():
    rng = random.Random(6)
    for nodes in (10, 10**7, 10**10, 10**14):
        masks = simhash.blocks_for(nodes, 3)
        for _ in range(200):
            flipped = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(not flipped & m for m in masks)
    assert len(simhash.blocks_for(10**7, 3)) > len(simhash.blocks_for(10, 3))


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (3, "a b c d")], "doc_id long, text string")
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in rows) == [(-1, -1), (3, 3), (7, 3), (7, 3)]
    assert sorted(r["doc_id"] or -1 for r in simhash.keep_one(docs).collect()) == [-1, 3]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_chains_reach_their_smallest_node(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "u long, v long")
    got = {r["node"]: r["component"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 1001: 1000}

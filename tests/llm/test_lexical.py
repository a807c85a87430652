"""Ranked lexical search: ranks and scores by brute force, bounds, blocks of queries, edge rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from scoutlens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for d, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 12 * m))
                    for t in terms(text) if t in b)
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return out


def got(frame):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(120)] + ["The", "x9", "日本"]
    weight = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weight, k=rng.randint(1, 80)))) for i in range(1500)]
    docs += [(5000 + i, docs[3][1]) for i in range(300)]                       # exact copies
    docs += [(7000, None), (7001, ""), (7002, "!?"), (None, docs[5][1]), (7003, "abc " * 30000), (9, docs[9][1])]
    items = [(i, rng.choice([", ", " ", "-"]).join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(30)]
    items += [(100, docs[3][1]), (101, docs[5][1].upper()), (102, None), (103, "..."), (104, "nowhere"), (105, "abc abc")]
    return docs, items


def test_brute_force(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame([(i, t, 1, "a") for i, t in docs], "doc_id long, text string, score int, item_id string").repartition(3)
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, rank int")
    want = sorted(brute(docs, items), key=repr)
    small = lexical.Params(block=256, leaf=8, subspaces=16, sample=100)
    assert got(lexical.search(d, q, params=small)) == want
    assert got(lexical.search(d, q)) == want
    # several blocks of queries, and a query with more terms than a block takes
    assert got(lexical.search(d, q, params=lexical.Params(items=7, terms=10, block=512, leaf=64))) == want


def test_repeated_queries_and_empty_tables(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame(docs[:200], "doc_id long, text string")
    q = spark.createDataFrame([items[0], items[0], (None, items[1][1])], "item_id long, text string")
    rows = lexical.search(d, q).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    assert len(by[0]) == 2 * len(set(by[0])) and by[None]
    assert lexical.search(d.limit(0), q).count() == 0
    assert lexical.search(d, q.limit(0)).count() == 0
    assert lexical.search(d.where("doc_id < 0"), q).columns == ["item_id", "rank", "doc_id", "score", "scored"]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    centres = [rng.choice(300, 12, replace=False) for _ in range(10)]
    doc, term = [], []
    for i in range(2000):
        mine = np.unique(np.concatenate([rng.choice(centres[i % 10], 6), rng.choice(300, 2)]))
        doc += [i] * len(mine)
        term += mine.tolist()
    doc, term = np.array(doc), np.array(term)
    value = rng.integers(1, 10**6, len(doc))
    tree = lexical.BallTree(doc, term, value, 300, lexical.Params(leaf=16))
    rank, seen = np.arange(2000), 0
    for c in centres:
        w = rng.integers(1, 9000, len(c))
        full = np.zeros(300, np.int64)
        full[c] = w
        score = np.bincount(doc, full[term] * value, minlength=2000).astype(np.int64)
        # every ball's bound covers every document in it
        length = np.sqrt(np.bincount(c % tree.spaces, w.astype(float)**2, minlength=tree.spaces))
        bound = tree.centroid[:, c] @ w + tree.radius @ length
        for level in range(tree.levels + 1):
            edges = tree.edges[::1 << (tree.levels - level)]
            for j in range(1 << level):
                assert score[tree.order[edges[j]:edges[j + 1]]].max() <= bound[(1 << level) + j] * (1 + 1e-9) + 1
        at, s, n = tree.search(c, w, 20, 0, rank)
        want = np.lexsort((rank, -score))[:20]
        order = np.lexsort((at, -s))
        assert at[order].tolist() == want.tolist() and s[order].tolist() == score[want].tolist()
        seen += n
    assert seen < 10 * 2000 * 0.6

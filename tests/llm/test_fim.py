"""Fill-in-middle: every column by brute force, exact restoration, the rank index's bound."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scoutlens.llm import fim, queries

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    parts = ["a", "bb", "é", "中文字", "😀", " ", "  ", "\n", "\t", "\x0b", " ", "<P", ">", "<", "S>", "long" * 40, ". "]
    texts = [None, "", " ", "\n\n", "x", " x ", "<P>", "a <S> b", "a <M", "word " * 50000, "é" * 70000 + " z", "a\r\nb"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(400)]
    out = list(enumerate(texts))
    return [*out, (None, "null key with some words"), (12, texts[12]), (-3, "negative key and some words")]


def test_columns_by_brute_force(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows],
                                 "doc_id long, text string, form string, n int, output string")
    got = fim.transform(docs).withColumn("back", fim.restore(fim.F.col("form"), fim.F.col("output"))).collect()
    assert len(got) == len(rows)
    as_set = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n"], r["form"], r["prefix_chars"] or 0, r["middle_chars"] or 0,
                      r["output"], r["back"]) for r in got))
    want = sorted((i is None, i or 0, n, f, p or 0, m or 0, o, t or "") for i, t in rows for n, f, p, m, o in [brute(i, t)])
    assert as_set == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert all((r["prefix_chars"] is None) == (r["form"] == "plain") for r in got)
    assert max(r["max_residual"] for r in got) <= 127
    assert fim.transform(docs.limit(0)).count() == 0


def test_query_columns(spark, sf_small):
    for r in queries.op11_fim(spark, sf_small).limit(50).collect():
        assert len(r["output_sha256"]) == len(r["restored_sha256"]) == 64
        assert (r["output_sha256"] == r["restored_sha256"]) == (r["form"] == "plain")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5000), min_size=1, max_size=60), min_size=1, max_size=6), st.sampled_from([0, 1, 9, 127]))
def test_index_is_exact_and_bounded(steps, bound):
    lists = [np.cumsum(x) for x in steps]
    offsets = np.concatenate(lists).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    index = fim.RankIndex(offsets, bounds, bound)
    rank = np.arange(len(offsets))
    assert (index(rank) == offsets).all()
    assert np.abs(index.predict(rank) - offsets).max() <= bound
    assert set(bounds[:-1]) <= set(index.first.tolist())


def test_straight_lists_need_one_segment():
    index = fim.RankIndex(np.arange(0, 700000, 7), np.array([0, 40000, 100000]))
    assert len(index.first) == 2 and not index.residual.any()

"""Sampling without replacement against enumeration; exact round trips."""

import collections
import math

import numpy as np
import pyarrow as pa
import pytest

from scoutlens.llm import lattice as L
from scoutlens.llm import sentencepiece as S


@pytest.fixture(scope="module")
def vocab():
    return L.vocabulary(S.MODEL_PATH)


def segmentations(vocab, atom):
    own = {x: i for i, x in enumerate(vocab.pieces) if x and i not in set(vocab.byte_id.tolist())}

    def rec(rest):
        if not rest:
            yield ()
        for j in range(1, len(rest) + 1):
            piece = own.get(rest[:j])
            if piece is not None:
                for more in rec(rest[j:]):
                    yield (piece, *more)

    return list(rec(atom))


@pytest.mark.parametrize("far", [7.0, 0.2])            # 0.2: sets are kept together and split when popped
def test_samples_follow_the_distribution_without_replacement(vocab, monkeypatch, far):
    monkeypatch.setattr(S, "FAR", far)
    every = segmentations(vocab, b" on it")
    weight = S.piece_weight(vocab)
    p = np.array([np.prod(weight[list(s)]) for s in every])
    p /= p.sum()
    number, n, k = {s: i for i, s in enumerate(every)}, 6000, 3
    doc, rank, log, inclusion, ids, _ = S._encode_chunk(vocab, pa.array(["on it"] * n), np.arange(n).astype(np.uint64), k, 5)
    drawn = collections.defaultdict(list)
    total = collections.defaultdict(float)
    for d, x, lp, li in zip(doc, ids, log, inclusion):
        i = number[tuple(x.tolist())]
        assert lp == pytest.approx(math.log(p[i]), abs=1e-9)
        drawn[d].append(i)
        total[d] += math.exp(lp - li)
    assert all(len(set(x)) == k for x in drawn.values())
    first = np.bincount([x[0] for x in drawn.values()], minlength=len(p)) / n
    second = np.bincount([x[1] for x in drawn.values()], minlength=len(p)) / n
    after = np.array([sum(p[a] * p[b] / (1 - p[a]) for a in range(len(p)) if a != b) for b in range(len(p))])
    assert abs(first - p).sum() / 2 < 0.03 and abs(second - after).sum() / 2 < 0.03
    assert np.mean(list(total.values())) == pytest.approx(1.0, abs=0.02)   # inclusion scores are unbiased


def test_all_segmentations_come_once_if_fewer_than_asked(vocab):
    every = segmentations(vocab, b" it")
    doc, rank, log, inclusion, ids, _ = S._encode_chunk(vocab, pa.array(["it"]), np.array([9], np.uint64), 50, 1)
    assert sorted(tuple(x.tolist()) for x in ids) == sorted(every)
    assert rank == list(range(len(every))) and set(inclusion) == {0.0}
    assert sum(map(math.exp, log)) == pytest.approx(1.0)


@pytest.mark.parametrize("text", ["  on", "it;\r\n", "a\r\r b"])
def test_runs_of_spaces_and_carriage_returns_are_in_the_lattice(vocab, text):
    every = segmentations(vocab, (" " + text).replace("\n", "").encode())
    _, _, log, _, ids, _ = S._encode_chunk(vocab, pa.array([text]), np.array([4], np.uint64), 200, 1)
    line_feed = int(vocab.byte_id[10])
    assert sorted(tuple(i for i in x.tolist() if i != line_feed) for x in ids) == sorted(every)
    assert sum(map(math.exp, log)) == pytest.approx(1.0)


def test_long_words_follow_the_uncut_distribution(vocab):
    """First pieces of a run that no place cuts, and log probabilities, against the uncut lattice."""
    text, n = "x" * 150, 3000
    weight = S.piece_weight(vocab)
    raw = np.frombuffer((" " + text).encode(), np.uint8)
    run = L.run(vocab, raw)
    beta = L.log_backward(run, weight[:, None])[:, 0]
    _, rank, log, _, ids, _ = S._encode_chunk(vocab, pa.array([text] * n), np.arange(n).astype(np.uint64), 2, 5)
    for x, lp in list(zip(ids, log))[:40]:
        assert lp == pytest.approx(np.log(weight[x]).sum() - beta[0], abs=1e-6)
    edges = range(run.first[0], run.first[1])
    p = {int(run.piece[e]): math.exp(math.log(weight[run.piece[e]]) + beta[run.length[e]] - beta[0]) for e in edges}
    first = collections.Counter(int(x[0]) for x, r in zip(ids, rank) if r == 0)
    assert sum(p.values()) == pytest.approx(1.0)
    assert sum(abs(first[k] / n - q) for k, q in p.items()) / 2 < 0.04
    start, end = L.atoms_cut(vocab, raw, np.array([0]), np.array([len(raw)]))
    assert (end - start).max() > L.LONGEST


ODD = ["", None, " ", "  two  spaces ", "a\nb\r\n\tc", "▁ literal ▁mark", "ünï çødé \U0001F600☃", "x" * 500, "\x00\x7f",
       "ab " * 4000, " " * 300 + "x", "我们看书" * 60, "=" * 3000, "The quick brown fox", "The quick brown fox", "é" * 200]


def test_round_trip_and_determinism(spark):
    rows = [(i, x, "kept", "other") for i, x in enumerate(ODD)] + [(None, "no key", "kept", "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, ids string")
    coded = S.encode(docs, keep=("source",))
    assert coded.columns == ["doc_id", "source", "sample", "ids", "log_prob", "log_inclusion"]
    found = S.decode(coded).collect()
    text = {i: x or "" for i, x in enumerate(ODD)} | {None: "no key"}
    assert {r["doc_id"] for r in found} == set(text)
    assert all(r["decoded"] == text[r["doc_id"]] for r in found)
    for i in (0, 1):
        only = [r for r in found if r["doc_id"] == i]
        assert [(r["sample"], r["ids"], r["log_prob"], r["log_inclusion"]) for r in only] == [(0, [], 0.0, 0.0)]
    distinct = collections.defaultdict(set)
    for r in found:
        distinct[r["doc_id"]].add(tuple(r["ids"]))
    assert all(len(v) == sum(r["doc_id"] == k for r in found) for k, v in distinct.items())
    again = S.encode(docs.repartition(5), keep=("source",)).collect()
    plain = lambda rs: sorted((str(r["doc_id"]), r["sample"], r["ids"], r["log_prob"], r["log_inclusion"]) for r in rs)
    assert plain(again) == plain(found)
    assert S.encode(docs.limit(0)).count() == 0


def test_decoding_of_ids_that_spell_no_text(spark):
    odd = spark.createDataFrame([(1, [3 + 0xFF]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in S.decode(odd).collect()} == {1: "�", 2: None, 3: ""}

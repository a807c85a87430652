"""Byte-level words and hashes, and segmentation lattices, against plain Python."""

import math
import re
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scoutlens.llm import langid
from scoutlens.llm import lattice as L
from scoutlens.llm import text as T


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ9 \t\n\x0b.é☃\U0001F600-", max_size=30)), max_size=6))
def test_words_are_those_of_the_patterns(texts):
    for separator, pattern in ((T.SPACE, r"[^\x20\x09-\x0D]+"), (T.NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        w = T.word_column(pa.array(["x y", *texts], pa.string()).slice(1), separator)
        got = [[bytes(w.data[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])]
               for a, b in zip(w.bounds, w.bounds[1:])]
        assert got == [re.findall(pattern, lower(x)) for x in texts]


def test_hashes_tell_words_apart_and_do_not_depend_on_place():
    words = ["a", "b", "ab", "ba", "abcdefgh", "abcdefghi", "x" * 300, "x" * 301, "é"]
    text = " ".join(words) + " " + " ".join(words)
    w = T.word_column(pa.array([text]))
    h = T.hashes(w.data, w.start, w.end)
    assert (h[:len(words)] == h[len(words):]).all() and len(set(h.tolist())) == len(words)
    assert T.hash_word("abcdefghi") == int(h[5])


def test_chunks_cover_all_rows():
    batch = pa.record_batch([pa.array(["x" * 10] * 9 + ["y" * 100, None, ""])], ["text"])
    sizes = [c.num_rows for c in T.chunks([batch, batch.slice(0, 0)], limit=35)]
    assert sum(sizes) == 12 and max(sizes) == 3


def brute_mass(vocab, atom, p):
    """Mass of all segmentations of the bytes of an atom."""
    own = {x: i for i, x in enumerate(vocab.pieces) if x and i not in set(vocab.byte_id.tolist())}

    def rec(i):
        if i == len(atom):
            return 1.0
        width = 1 if atom[i] < 0x80 else 2 if atom[i] < 0xE0 else 3 if atom[i] < 0xF0 else 4
        mass = sum(p[own[atom[i:j]]] * rec(j) for j in range(i + 1, len(atom) + 1) if atom[i:j] in own)
        if atom[i:i + width] not in own:
            mass += np.prod([p[vocab.byte_id[x]] for x in atom[i:i + width]]) * rec(i + width)
        return mass

    return rec(0)


@pytest.mark.parametrize("word", [" the", " élève", " ☃x", " \U0001F600a", "a", " "])
def test_forward_and_backward_sum_all_segmentations(word):
    vocab = L.vocabulary(langid.MODEL_PATH)
    p = np.random.default_rng(0).dirichlet(np.ones(len(vocab.pieces)))
    raw = word.encode()
    lat = L.match(vocab, np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))
    scale = np.exp(-L.PER_BYTE * len(raw))
    expected = brute_mass(vocab, raw, p)
    weight = L.scaled(vocab, p[:, None])
    assert L.total(lat, L.forward(lat, weight))[0, 0] * scale == pytest.approx(expected, rel=1e-9)
    assert L.backward(lat, weight)[0][0, 0] * scale == pytest.approx(expected, rel=1e-9)


def plain_log_mass(vocab, atom, p):
    """Log mass of all segmentations of any atom, uncut, by exact decimals."""
    bytes_of = set(vocab.byte_id.tolist())
    own = {x: Decimal(float(p[i])) for i, x in enumerate(vocab.pieces) if x and i not in bytes_of}
    mass = [Decimal(1)] + [Decimal(0)] * len(atom)
    for i in range(len(atom)):
        if not mass[i] or atom[i] & 0xC0 == 0x80:
            continue
        width = 1 if atom[i] < 0x80 else 2 if atom[i] < 0xE0 else 3 if atom[i] < 0xF0 else 4
        for j in range(i + 1, min(i + 40, len(atom)) + 1):
            if atom[i:j] in own:
                mass[j] += mass[i] * own[atom[i:j]]
        if atom[i:i + width] not in own:
            mass[i + width] += mass[i] * math.prod(Decimal(float(p[vocab.byte_id[x]])) for x in atom[i:i + width])
    return float(mass[-1].ln())


LONG = [" " + "x" * 300, " " * 300, "=" * 90 + "a", " https://example.org/" + "path/of/the/page-" * 12, " " + "我们在这里看见一本书" * 20,
        " " + "ไม่มีอะไรเลย" * 12, " " + "é" * 100 + "x" * 70, " " + "\U0001F600" * 40, "   " + "0af9" * 40 + ";\r", "a" * 64, "a" * 65]


@pytest.mark.parametrize("word", LONG)
def test_no_segmentation_of_a_long_word_is_lost(word, monkeypatch):
    monkeypatch.setattr(L, "WINDOW", 37)                 # windows meet inside pieces and characters
    vocab = L.vocabulary(langid.MODEL_PATH)
    p = np.random.default_rng(1).dirichlet(np.ones(len(vocab.pieces)), 2).T + 1e-9
    raw = ("in front" + word).encode()
    data = np.frombuffer(raw, np.uint8)
    start, end = L.atoms_cut(vocab, data, np.array([0, 8]), np.array([8, len(raw)]))
    assert start[0] == 0 and end[-1] == len(raw) and (start[1:] == end[:-1]).all()
    for a, b in zip(start, end):
        bytes(raw[a:b]).decode()                         # cut between characters
    got = L.log_mass(vocab, data, start, end, L.scaled(vocab, p)).sum(axis=0) - L.PER_BYTE * len(raw)
    for i in range(2):
        expected = plain_log_mass(vocab, raw[:8], p[:, i]) + plain_log_mass(vocab, raw[8:], p[:, i])
        assert got[i] == pytest.approx(expected, rel=1e-10)


def test_a_run_agrees_with_the_shared_steps():
    vocab = L.vocabulary(langid.MODEL_PATH)
    p = L.scaled(vocab, np.random.default_rng(2).dirichlet(np.ones(len(vocab.pieces)), 3).T)
    for word in (" the", " ☃x", "      spaces", " \U0001F600a"):
        raw = np.frombuffer(word.encode(), np.uint8)
        lat, run = L.match(vocab, raw, np.array([0]), np.array([len(raw)])), L.run(vocab, raw)
        alpha, beta = L.log_forward(run, p), L.log_backward(run, p)
        assert np.exp(beta[0]) == pytest.approx(L.backward(lat, p)[0][0], rel=1e-10)
        assert alpha[-1] == pytest.approx(beta[0], rel=1e-10)
        assert np.exp(alpha) == pytest.approx(np.array([x[0] for x in L.forward(lat, p)]), rel=1e-10)


def test_long_words_without_crossing_pieces_are_cut_short():
    vocab = L.vocabulary(langid.MODEL_PATH)
    raw = np.frombuffer((" " + "\U0001F600" * 5000).encode(), np.uint8)
    start, end = L.atoms_cut(vocab, raw, np.array([0]), np.array([len(raw)]))
    assert (end - start).max() <= L.LONGEST and len(start) < len(raw) / 40

"""Language identification by segmentation-marginalised unigram models.

Each language has a probability for every piece of a fixed public vocabulary. A text's
likelihood is the product over its words of the summed probability of *all* segmentations
of the word into pieces (forward algorithm), so no single tokenisation is chosen. Piece
probabilities are learned by expectation-maximisation: expected piece counts over all
segmentations of all learning texts (forward-backward; the first round starts from equal
piece probabilities), plus ``smooth``.

Texts are lower-cased; every run of a-z and non-ASCII characters is a word with the
vocabulary's word mark in front (a text without any Unicode letter is not judged). Expected counts are summed inside each task first, so at
most languages x pieces rows leave a task, whatever a language's share is.

Defined results: a null, empty or letterless text is ``und`` with score 0; with no
learning text every text is ``und``; equal scores go to the smaller language; an empty
table gives no rows; repeated rows are each predicted; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lattice as L
from . import text as T
from .common import text_of, with_key

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN = "und"
ROUNDS = 1                         # of expectation-maximisation
SMOOTH = 0.05                      # expected count added to each piece
CHUNK = 2 << 20                    # bytes of text segmented together
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass(frozen=True)
class Model:
    path: str
    languages: list
    probability: np.ndarray        # pieces x languages


def _atoms(column: pa.Array, vocab: L.Vocabulary):
    """Distinct words of a chunk as byte ranges of ``data``; the distinct word of each word,
    and where each text's words begin: (data, start, end, inverse, bounds)."""
    data, offsets = T.buffers(pc.utf8_lower(column.fill_null("")))
    w = T.words(data, offsets, NOT_LETTER)
    # a word at the very start of a text has no space before it: give every word one
    size = w.end - w.start
    spaced = np.empty(int(size.sum()) + len(size), np.uint8)
    at = np.cumsum(size + 1) - (size + 1)
    spaced[at] = 0x20
    body = np.ones(len(spaced), bool)
    body[at] = False
    spaced[body] = data[~NOT_LETTER[data]]
    pieces = np.cumsum([0, *w.counts])
    start, end = L.atoms_cut(vocab, spaced, at, at + size + 1)
    bounds = np.searchsorted(start, np.append(at, len(spaced))[pieces])
    _, first, inverse = np.unique(T.hashes(spaced, start, end), return_index=True, return_inverse=True)
    return spaced, start[first], end[first], inverse, bounds


def _expect(path: str, languages: list, probability: np.ndarray | None):
    """Expected piece counts by language of a task's texts: rows (lang, piece, n)."""
    def apply(batches):
        vocab = L.vocabulary(path)
        uniform = np.full((len(vocab.pieces), 1), 1.0 / len(vocab.pieces))
        p = L.scaled(vocab, uniform if probability is None else probability)
        counts = np.zeros((len(languages), len(vocab.pieces)))
        number = {x: i for i, x in enumerate(languages)}
        for c in T.chunks(batches, limit=CHUNK):
            data, start, end, inverse, bounds = _atoms(c.column("text"), vocab)
            if not len(start):
                continue
            lang = np.array([number[x] for x in c.column("lang").to_pylist()])
            of = np.repeat(lang, np.diff(bounds))
            n = np.bincount(of * len(start) + inverse, minlength=len(languages) * len(start))
            n = n.reshape(len(languages), -1).astype(float)
            small = end - start <= L.LONGEST
            for i in np.flatnonzero(~small):
                run = L.run(vocab, data[start[i]:end[i]])
                a, b = L.log_forward(run, p), L.log_backward(run, p)
                share = np.exp(a[run.start] + np.log(p[run.piece]) + b[run.start + run.length] - b[0])
                for j in range(len(languages)):
                    np.add.at(counts[j], run.piece, n[j, i] * share[:, j if share.shape[1] > 1 else 0])
            lat = L.match(vocab, data, start[small], end[small])
            alpha, beta = L.forward(lat, p), L.backward(lat, p)
            n = n[:, small][:, lat.order]
            z = beta[0]
            for length, atom, _, piece, cut in lat.edges:
                for d in range(len(alpha) - length):
                    lo, hi = cut[d], cut[d + 1]
                    if hi <= lo:
                        continue
                    a, q = atom[lo:hi], piece[lo:hi]
                    share = alpha[d][a] * p[q] * beta[d + length][a] / z[a]
                    for i in range(len(languages)):
                        w = n[i, a] * share[:, i if share.shape[1] > 1 else 0]
                        np.add.at(counts[i], q, w)
        lang, piece = np.nonzero(counts)
        for lo in range(0, len(lang), 1 << 16):
            at = slice(lo, lo + (1 << 16))
            yield pa.record_batch([pa.array(lang[at]), pa.array(piece[at]), pa.array(counts[lang[at], piece[at]])],
                                  ["lang", "piece", "n"])
    return apply


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", path: str = MODEL_PATH,
        rounds: int = ROUNDS, smooth: float = SMOOTH) -> Model:
    """Learn from the rows of ``docs`` with a language."""
    rows = docs.select(text_of(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())   # one row a language
    pieces = len(L.vocabulary(path).pieces)
    if not languages:
        return Model(path, [], np.zeros((pieces, 0)))
    probability = None
    for _ in range(rounds):
        parts = rows.mapInArrow(_expect(path, languages, probability), "lang long, piece long, n double")
        sums = parts.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()    # languages x pieces at most
        counts = np.full((pieces, len(languages)), smooth)
        counts[sums["piece"].to_numpy(), sums["lang"].to_numpy()] += sums["n"].to_numpy()
        probability = np.round(counts / counts.sum(axis=0), 12)   # the order of summing leaves no trace
    return Model(path, languages, np.maximum(probability, 1e-12))


def _judge(column: pa.Array, model: Model, vocab: L.Vocabulary, p: np.ndarray):
    """For each text the best language's number (one past the last: none), its share of the
    likelihood, and the second's."""
    rows, none = len(column), len(model.languages)
    best, share, second = np.full(rows, none), np.zeros(rows), np.zeros(rows)
    data, start, end, inverse, bounds = _atoms(column, vocab)
    if len(start) and none:
        mass = L.log_mass(vocab, data, start, end, p)
        doc = np.repeat(np.arange(rows), np.diff(bounds))
        like = np.stack([np.bincount(doc, mass[inverse, i], rows) for i in range(none)], axis=1)
        like = np.exp(like - like.max(axis=1, keepdims=True))
        like /= like.sum(axis=1, keepdims=True)
        letters = pc.match_substring_regex(column.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
        some = (np.diff(bounds) > 0) & letters
        ranked = np.sort(like, axis=1)
        best, share = np.where(some, like.argmax(axis=1), none), np.where(some, ranked[:, -1], 0.0)
        if none > 1:
            second = np.where(some, ranked[:, -2], 0.0)
    return best, share, second


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score): the likeliest language and its share of the likelihood under
    equal priors; ``runner_up`` is the second language's share."""
    def apply(batches):
        vocab = L.vocabulary(model.path)
        p = L.scaled(vocab, model.probability)
        names = pa.array([*model.languages, UNKNOWN])
        for c in T.chunks(batches, limit=CHUNK):
            best, share, second = _judge(c.column("text"), model, vocab, p)
            yield pa.record_batch([c.column("key"), names.take(pa.array(best)), pa.array(share), pa.array(second)],
                                  ["key", "lang_pred", "score", "runner_up"])

    rows = with_key(docs, key, text)
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(apply, f"key {kind}, lang_pred string, score double, runner_up double") \
        .withColumnRenamed("key", key)


def where_known(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with a share of ``least``."""
    def apply(batches):
        vocab = L.vocabulary(model.path)
        p = L.scaled(vocab, model.probability)
        for c in T.chunks(batches, text, CHUNK):
            best, share, _ = _judge(c.column(text), model, vocab, p)
            yield c.filter(pa.array((best < len(model.languages)) & (share >= least)))

    return docs.mapInArrow(apply, docs.schema)

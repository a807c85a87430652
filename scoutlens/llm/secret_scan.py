"""Secret scan with a linear-chain conditional random field.

Base patterns (assignments to names like ``password``, access keys, long hexadecimal runs) are
always reported. Beside them a conditional random field tags the tokens of every text as outside
(O), begin (B) or inside (I) a secret and reports the spans that no base span touches. Its
features are the token's shape (length, character classes, changes between classes, first bytes),
the words and signs around it, and the file's own make-up (share of digits and of code signs, size).
The most likely tags are found by Viterbi's algorithm.

Learning: base spans of a bounded sample of texts are the labels. Windows of tokens around them,
and one window from each sampled text without any, go to the driver, where the field is fitted
by quasi-Newton steps on its exact likelihood (forward-backward). Each labelled window is also learned
with its secret redrawn in other alphabets, its sign and name sometimes taken away, so that shape and
context carry the decision and not the base patterns' own alphabets.

Tokens are runs of letters, digits, ``+ / _ -`` and non-ASCII characters. A decoded sequence is a whole
text; texts of over 1 MB are decoded in pieces cut at white space (base patterns run over the
whole text all the same). Work is linear in the text, nothing is shuffled.

Defined results: a null or empty text has no span; without a base span in the sample there is no model
and only base spans are reported; equal rows get equal results; an empty table gives no rows; further
columns are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import materialize, with_key

#: base patterns, on bytes with A-Z lower-cased (assign) or as they are (fixed by the contract)
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}
FOUND = "crf"                                   # kind of the spans that the field adds

O, B, I = 0, 1, 2                               # noqa: E741 - the usual names of the tags


@dataclass(frozen=True)
class Params:
    documents: int = 16384       # sampled texts, about
    labelled: int = 1024         # windows with a secret
    plain: int = 2048            # windows without
    context: int = 16            # tokens kept on each side of a secret
    copies: int = 6              # of a labelled window, with the secret redrawn
    most_tokens: int = 96        # longer windows are not learned from
    most_bytes: int = 4096
    steps: int = 60
    penalty: float = 0.05        # of squared weights
    seed: int = 11


@dataclass(frozen=True)
class Model:
    weights: np.ndarray          # (features, tags)
    moves: np.ndarray            # (tag, next tag)
    first: np.ndarray            # tag at the start of a sequence


# --- base spans -----------------------------------------------------------------------------

_NOT_HEX = np.ones(256, bool)
_NOT_HEX[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = False


def base_spans(data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
    """(start, kind, end, start of the secret itself) in bytes of ``data``, by text, in report order."""
    raw, low = data.tobytes(), T.fold(data).tobytes()
    out = [[] for _ in range(len(offsets) - 1)]
    for spans, lo, hi in zip(out, offsets[:-1].tolist(), offsets[1:].tolist()):
        for m in ASSIGN.finditer(low, lo, hi):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                spans.append((m.start(), 0, m.end(), m.start(2)))
        for m in ACCESS.finditer(raw, lo, hi):
            if m.end() - m.start() >= LEAST["access"]:
                spans.append((m.start(), 1, m.end(), m.start()))
    w = T.words(data, offsets, _NOT_HEX)
    for at in np.flatnonzero(w.end - w.start >= LEAST["hex"]).tolist():
        text = int(np.searchsorted(w.bounds, at, "right")) - 1
        out[text].append((int(w.start[at]), 2, int(w.end[at]), int(w.start[at])))
    for spans in out:
        spans.sort()
    return out


# --- features -------------------------------------------------------------------------------

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100), *b"+/_-"]] = False
#: character classes: 0 other, 1 digit, 2 lower, 3 upper, 4 sign inside tokens, 5 not ASCII
_CLASS = np.zeros(256, np.uint8)
for _n, _chars in enumerate((range(0x30, 0x3A), range(0x61, 0x7B), range(0x41, 0x5B), b"+/_-", range(0x80, 0x100)), 1):
    _CLASS[list(_chars)] = _n
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_LENGTHS = np.array([2, 3, 4, 5, 7, 9, 13, 17, 21, 25, 33, 49])      # lower ends of the length classes
_CODE = np.zeros(256, bool)
_CODE[list(b"={}()[];<>$\\|&#")] = True
WORD_BITS, HEAD_BITS = 14, 12
_BUCKETS = len(_LENGTHS) + 1
#: sizes of the feature families; a token has one feature of each
SIZES = {"shape": 32 * _BUCKETS, "digits": 11 * _BUCKETS, "changes": 11 * _BUCKETS, "hex": 4 * _BUCKETS,
         "head": 1 << HEAD_BITS, "word": 1 << WORD_BITS, "before": 1 << WORD_BITS, "before2": 1 << WORD_BITS,
         "after": 1 << WORD_BITS, "gap": 32, "next_gap": 32, "file": 96, "gap_shape": 32 * _BUCKETS * 2}
_AT = dict(zip(SIZES, np.concatenate([[0], np.cumsum(list(SIZES.values()))]).tolist()))
FEATURES = sum(SIZES.values())


def file_class(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Class of each text by share of digits, share of code signs and size (below 96)."""
    size = np.diff(offsets)
    digits = np.concatenate([[0], np.cumsum(_CLASS[data] == 1, dtype=np.int64)])
    code = np.concatenate([[0], np.cumsum(_CODE[data], dtype=np.int64)])
    share = lambda c: np.diff(c[offsets]) / np.maximum(size, 1)
    return (np.searchsorted([0.002, 0.01, 0.03, 0.1, 0.3], share(digits)) * 4
            + np.searchsorted([0.002, 0.02, 0.08], share(code))) * 4 + np.searchsorted([500, 5000, 50000], size)


def features(data: np.ndarray, offsets: np.ndarray, file: np.ndarray) -> tuple[T.Words, np.ndarray]:
    """Tokens of all sequences and their features, one row per token."""
    w = T.words(data, offsets, _SEPARATOR)
    a, b, n = w.start, w.end, len(w.start)
    if not n:
        return w, np.zeros((0, len(SIZES)), np.int32)
    cls = _CLASS[data]

    def within(flag, lo, hi):
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int32)])
        return total[hi] - total[lo]

    size = b - a
    length = np.searchsorted(_LENGTHS, size, "right")
    digits = within(cls == 1, a, b)
    mask = (digits > 0).astype(np.int64)
    for c in (2, 3, 4, 5):
        mask |= (within(cls == c, a, b) > 0).astype(np.int64) << (c - 1)
    change = np.zeros(len(data), bool)
    change[1:] = cls[1:] != cls[:-1]
    changes = within(change, np.minimum(a + 1, b), b)
    hexed = within(_HEX[data], a, b) == size
    low = T.fold(data)
    word = T.hashes(low, a, b)
    own = (word >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    doc = w.doc
    same = np.zeros(n + 1, bool)                      # token i follows token i - 1 in one sequence
    same[1:n] = doc[1:] == doc[:-1]
    before = np.where(same[:n], np.concatenate([[0], own[:-1]]), 0)
    before2 = np.where(same[:n] & np.concatenate([[False], same[:n - 1]]), np.concatenate([[0, 0], own[:-2]])[:n], 0)
    after = np.where(same[1:], np.concatenate([own[1:], [0]]), 0)
    # signs in the gap before each token (and after the last one of a sequence)
    lo = np.where(same[:n], np.concatenate([[0], b[:-1]]), offsets[doc])
    gap = (~same[:n]).astype(np.int64) * 16
    last = np.where(same[1:], np.concatenate([a[1:], [0]]), offsets[doc + 1])
    next_gap = (~same[1:]).astype(np.int64) * 16
    for bit, signs in enumerate((b":", b"=", b"\"'`", b"\n")):
        flag = np.isin(data, np.frombuffer(signs, np.uint8))
        gap |= (within(flag, lo, a) > 0).astype(np.int64) << bit
        next_gap |= (within(flag, b, last) > 0).astype(np.int64) << bit
    first = T.mix(T.head(low, a) & T.MASK[np.minimum(size, 4)]) >> np.uint64(64 - HEAD_BITS)
    columns = {
        "shape": mask * _BUCKETS + length, "digits": 10 * digits // size * _BUCKETS + length,
        "changes": 10 * changes // size * _BUCKETS + length, "hex": (hexed * 2 + (digits > 0)) * _BUCKETS + length,
        "head": first.astype(np.int64), "word": own, "before": before, "before2": before2, "after": after,
        "gap": gap, "next_gap": next_gap, "file": file[doc], "gap_shape": (gap * _BUCKETS + length) * 2 + (digits > 0)}
    return w, np.stack([columns[f] + _AT[f] for f in SIZES], axis=1).astype(np.int32)


# --- the field ------------------------------------------------------------------------------

def viterbi(scores: np.ndarray, starts: np.ndarray, model: Model) -> np.ndarray:
    """Most likely tags of sequences laid end to end (``starts``: their first tokens).

    The tokens are dealt into equal lanes that step together: per lane the best score of each
    (tag before, tag at the end), then the lanes are joined one after another, then all lanes
    keep their best predecessors and are followed back."""
    n = len(scores)
    if not n:
        return np.zeros(0, np.int8)
    steps = max(1, int(np.sqrt(n)))
    lanes = -(-n // steps)
    first = np.zeros(lanes * steps, bool)
    first[starts[starts < n]] = True
    first[n:] = True                                 # padding: a sequence of its own each
    u = np.zeros((lanes * steps, 3))
    u[:n] = scores
    u, first = u.reshape(lanes, steps, 3), first.reshape(lanes, steps)
    moves = np.where(first[:, :, None, None], model.first[None, None, None, :], model.moves[None, None])

    through = moves[:, 0] + u[:, 0, None, :]                             # (lane, before, tag)
    for s in range(1, steps):
        through = (through[:, :, :, None] + (moves[:, s] + u[:, s, None, :])[:, None]).max(axis=2)
    enter = np.zeros((lanes, 3))
    for x in range(1, lanes):
        enter[x] = (enter[x - 1][:, None] + through[x - 1]).max(axis=0)
    back = np.empty((steps, lanes, 3), np.int8)
    best = enter
    for s in range(steps):
        step = best[:, :, None] + moves[:, s] + u[:, s, None, :]
        back[s] = step.argmax(axis=1)
        best = step.max(axis=1)
    row = np.arange(lanes)
    origin = np.tile(np.arange(3, dtype=np.int8), (lanes, 1))            # entering tag of each end tag
    for s in range(steps - 1, -1, -1):
        origin = back[s][row[:, None], origin]
    tag = np.empty(lanes, np.int8)
    tag[-1] = best[-1].argmax()
    for x in range(lanes - 1, 0, -1):
        tag[x - 1] = origin[x, tag[x]]
    out = np.empty((lanes, steps), np.int8)
    for s in range(steps - 1, -1, -1):
        out[:, s] = tag
        tag = back[s][row, tag]
    return out.reshape(-1)[:n]


def likelihood(scores: np.ndarray, length: np.ndarray, weight: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Of padded sequences (sequence, token, tag): log Z of each, the tags' marginals and the
    weighted sum of the marginals of (tag, next tag). Forward-backward in scaled probabilities."""
    many, most, _ = scores.shape
    inside = np.arange(most) < length[:, None]
    top = np.where(inside, scores.max(axis=2), 0.0)
    e = np.exp(np.where(inside[:, :, None], scores - top[:, :, None], 0.0)).transpose(1, 0, 2).copy()
    inside = inside.T
    step = np.exp(moves)
    ahead, scale = np.empty_like(e), np.ones((most, many))
    for t in range(most):
        now = (np.exp(first) if t == 0 else ahead[t - 1] @ step) * e[t]
        scale[t] = np.where(inside[t], now.sum(axis=1), 1.0)
        ahead[t] = np.where(inside[t][:, None], now / scale[t][:, None], 0.0)
    behind = np.ones_like(e)
    for t in range(most - 2, -1, -1):
        behind[t] = np.where(inside[t + 1][:, None], (e[t + 1] * behind[t + 1] / scale[t + 1][:, None]) @ step.T, 1.0)
    right = e[1:] * behind[1:] * (inside[1:] * weight / scale[1:])[:, :, None]
    pairs = ahead[:-1].reshape(-1, 3).T @ right.reshape(-1, 3) * step
    log_z = np.log(scale).sum(axis=0) + top.sum(axis=1)
    return log_z, (ahead * behind * inside[:, :, None]).transpose(1, 0, 2), pairs


def minimise(loss, x: np.ndarray, steps: int, memory: int = 8, tol: float = 1e-6) -> np.ndarray:
    """Limited-memory BFGS with backtracking; ``loss(x)`` gives value and slope."""
    value, slope = loss(x)
    past: list = []
    for _ in range(steps):
        if np.abs(slope).max() < tol:
            break
        d, held = -slope, []
        for s, y, rho in reversed(past):
            a = rho * (s @ d)
            d = d - a * y
            held.append(a)
        if past:
            s, y, _ = past[-1]
            d = d * ((s @ y) / (y @ y))
        else:
            d = d / max(1.0, np.abs(slope).sum())
        for (s, y, rho), a in zip(past, reversed(held)):
            d = d + (a - rho * (y @ d)) * s
        size, fall = 1.0, slope @ d
        while size > 1e-10:
            new, grad = loss(x + size * d)
            if new <= value + 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        s, y = size * d, grad - slope
        if s @ y > 1e-12:
            past = [*past[1 - memory:], (s, y, 1.0 / (s @ y))]
        x, value, slope = x + size * d, new, grad
    return x


def train(rows: np.ndarray, tags: np.ndarray, length: np.ndarray, weight: np.ndarray, params: Params = Params()) -> Model:
    """Fit the penalised log-likelihood. ``rows``: features of all tokens of all sequences, end to
    end; ``tags``: their tags; ``weight``: of each sequence."""
    known, at = np.unique(rows, return_inverse=True)
    at = at.reshape(rows.shape)
    many, most, k = len(length), int(length.max()), len(known)
    starts = np.cumsum(length) - length
    place = np.repeat(np.arange(many) * most - starts, length) + np.arange(len(rows))
    seq = np.repeat(np.arange(many), length)
    each, total = weight[seq], weight.sum()

    def by_feature(amount):
        return np.stack([np.bincount(at.ravel(), np.repeat(amount[:, t], at.shape[1]), minlength=k) for t in range(3)], axis=1)

    # what the labels hold of each feature, move and start
    held = by_feature(np.eye(3)[tags] * each[:, None])
    inner = np.flatnonzero(seq[1:] == seq[:-1])
    held_moves = np.zeros((3, 3))
    np.add.at(held_moves, (tags[inner], tags[inner + 1]), each[inner])
    held_first = np.bincount(tags[starts], weight, minlength=3)
    wanted = np.concatenate([held.ravel(), held_moves.ravel(), held_first])

    def loss(x):
        w, moves, first = x[:3 * k].reshape(k, 3), x[3 * k:3 * k + 9].reshape(3, 3), x[3 * k + 9:]
        scores = np.zeros((many * most, 3))
        for f in range(at.shape[1]):
            scores[place] += w[at[:, f]]
        log_z, marginal, pairs = likelihood(scores.reshape(many, most, 3), length, weight, moves, first)
        flat = marginal.reshape(-1, 3)[place]
        slope = np.concatenate([by_feature(flat * each[:, None]).ravel(), pairs.ravel(), (marginal[:, 0] * weight[:, None]).sum(axis=0)])
        value = weight @ log_z - wanted @ x
        return (value + params.penalty / 2 * (x @ x)) / total, (slope - wanted + params.penalty * x) / total

    x = minimise(loss, np.zeros(3 * k + 12), params.steps)
    full = np.zeros((FEATURES, 3), np.float32)
    full[known] = x[:3 * k].reshape(k, 3)
    return Model(full, x[3 * k:3 * k + 9].reshape(3, 3), x[3 * k + 9:])


# --- learning from base spans ---------------------------------------------------------------

def _windows(data, offsets, file, spans, params: Params):
    """(text, spans inside, file class, weight) of each text: one around each group of secrets, or
    one plain window at a place drawn by the text's hash, which stands for the whole text."""
    w, drawn = T.words(data, offsets, _SEPARATOR), T.hashes(data, offsets[:-1], offsets[1:])
    for d in range(len(offsets) - 1):
        lo, hi = int(w.bounds[d]), int(w.bounds[d + 1])
        if lo == hi:
            continue
        if spans[d]:
            groups = []
            for _, _, end, start in spans[d]:
                first = max(lo, int(np.searchsorted(w.end, start, "right")) - params.context)
                last = min(hi, int(np.searchsorted(w.start, end)) + params.context)
                if groups and first < groups[-1][1]:
                    groups[-1] = (groups[-1][0], max(last, groups[-1][1]), [*groups[-1][2], (start, end)])
                else:
                    groups.append((first, last, [(start, end)]))
            weight = 1.0
        else:
            size = 3 * params.context
            first = lo + int(drawn[d] % np.uint64(max(1, hi - lo - size)))
            groups, weight = [(first, min(hi, first + size), [])], min((hi - lo) / size, 16.0)
        for first, last, inside in groups:
            a, b = int(w.start[first]), int(w.end[last - 1])
            if first > lo:
                a = int(w.end[first - 1])                # the signs before the first token belong to it
            if last - first <= params.most_tokens and b - a <= params.most_bytes:
                yield data[a:b].tobytes(), [(max(x, a) - a, min(y, b) - a) for x, y in inside], int(file[d]), max(weight, 1.0)


_ALPHABETS = (b"0123456789abcdef", b"0123456789ABCDEF", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
              b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
              b"abcdefghijklmnopqrstuvwxyz0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
              b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")


_SIGNS = re.compile(rb"""["']?\x20*[:=]\x20*["']?$""")
_NAME = re.compile(rb"""[A-Za-z_]+["']?\x20*[:=]\x20*["']?$""")


def redraw(text: bytes, spans: list, rng) -> tuple[bytes, list]:
    """The window with every secret redrawn (alphabet and length); of each four secrets one keeps
    the name and signs before it, one keeps the name, two have neither."""
    out, moved, at = b"", [], 0
    for a, b in spans:
        if a < at:
            continue
        before = text[at:a]
        way = rng.integers(4)
        before = (before, _SIGNS.sub(b" ", before), _NAME.sub(b"", before), _NAME.sub(b"", before))[way]
        if way and text[b:b + 1] in (b'"', b"'"):
            b += 1                                           # its closing quote goes as well
        letters = np.frombuffer(_ALPHABETS[rng.integers(len(_ALPHABETS))], np.uint8)
        new = letters[rng.integers(0, len(letters), rng.integers(16, 49))].tobytes()
        out += before
        moved.append((len(out), len(out) + len(new)))
        out += new
        at = b
    return out + text[at:], moved


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> Model | None:
    """The field learned from the base spans of about ``params.documents`` texts."""
    rows = with_key(docs, key, text)
    n = rows.count()
    if not n:
        return None
    bar = min(1.0, params.documents / n)
    drawn = rows.where(F.pmod(F.xxhash64("key", "text", F.lit(params.seed)), F.lit(1 << 30)) < int(bar * (1 << 30)))

    def cut(batches):
        for c in T.chunks(batches):
            data, offsets = T.buffers(c.column("text"))
            got = list(_windows(data, offsets, file_class(data, offsets), base_spans(data, offsets), params))
            yield pa.record_batch([
                pa.array([x[0] for x in got], pa.binary()), pa.array([[v for s in x[1] for v in s] for x in got], pa.list_(pa.int32())),
                pa.array([x[2] for x in got], pa.int32()), pa.array([x[3] for x in got], pa.float64())],
                ["window", "spans", "file", "weight"])

    found = materialize(drawn.select("text").mapInArrow(cut, "window binary, spans array<int>, file int, weight double").distinct(),
                        "secret-windows")
    order = F.xxhash64("window", F.lit(params.seed)), F.col("window"), F.col("file"), F.col("weight"), F.col("spans")
    labelled = found.where(F.size("spans") > 0).orderBy(*order).limit(params.labelled).collect()
    if not labelled:
        return None
    plain = found.where(F.size("spans") == 0).orderBy(*order).limit(params.plain).collect()
    rng = np.random.default_rng(params.seed)
    texts, marks, files, weight = [], [], [], []
    for r in [*labelled, *plain]:
        spans = list(zip(r["spans"][::2], r["spans"][1::2]))
        versions = [(bytes(r["window"]), spans)]
        versions += [redraw(bytes(r["window"]), spans, rng) for _ in range(params.copies)] if spans else []
        for body, inside in versions:
            texts.append(body)
            marks.append(inside)
            files.append(r["file"])
            weight.append(r["weight"])
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    w, feats = features(np.frombuffer(b"".join(texts), np.uint8), offsets, np.array(files))
    tags = np.zeros(len(feats), np.int64)
    for d, inside in enumerate(marks):
        for a, b in inside:
            mine = slice(*w.bounds[d:d + 2])
            inner = np.flatnonzero((w.end[mine] > offsets[d] + a) & (w.start[mine] < offsets[d] + b)) + mine.start
            if len(inner):
                tags[inner] = I
                tags[inner[0]] = B
    full = w.counts > 0
    return train(feats, tags, w.counts[full], np.array(weight)[full], params)


# --- scanning -------------------------------------------------------------------------------

def _pieces(data: np.ndarray, offsets: np.ndarray, limit: int):
    """Sequences (start, end, text): whole texts, long ones cut after white space."""
    for d, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while hi - lo > limit:
            space = np.flatnonzero(T.SPACE[data[lo:lo + limit]])
            if not len(space):                           # no white space for so long: the next one ends the piece
                rest = T.SPACE[data[lo + limit:hi]]
                space = [limit + (int(rest.argmax()) if rest.any() else len(rest) - 1)]
            cut = lo + int(space[-1]) + 1
            yield lo, cut, d
            lo = cut
        if hi > lo:
            yield lo, hi, d


def tagged(data: np.ndarray, offsets: np.ndarray, model: Model) -> list[tuple[int, int, int]]:
    """(text, start, end) in bytes of every span that the field tags."""
    file, out, group = file_class(data, offsets), [], []

    def run():
        lo, hi = group[0][0], group[-1][1]
        bounds = np.array([g[0] for g in group] + [hi]) - lo
        of = np.array([g[2] for g in group])
        w, rows = features(data[lo:hi], bounds, file[of])
        if not len(rows):
            return
        scores = np.zeros((len(rows), 3), np.float32)
        for f in range(rows.shape[1]):
            scores += model.weights[rows[:, f]]
        tag = viterbi(scores, w.bounds[:-1], model)
        doc = w.doc
        first = tag == B                                 # an inside tag after O or at a start begins a span as well
        first[1:] |= (tag[1:] == I) & ((tag[:-1] == O) | (doc[1:] != doc[:-1]))
        first[0] |= tag[0] == I
        at = np.flatnonzero(first)
        if not len(at):
            return
        stop = np.append(np.flatnonzero((tag[1:] != I) | (doc[1:] != doc[:-1])), len(tag) - 1)   # last token of a run
        last = stop[np.searchsorted(stop, at)]
        out.extend(zip(of[doc[at]].tolist(), (w.start[at] + lo).tolist(), (w.end[last] + lo).tolist()))

    for piece in _pieces(data, offsets, T.CHUNK_BYTES):
        if group and piece[1] - group[0][0] > T.CHUNK_BYTES:
            run()
            group = []
        group.append(piece)
    if group:
        run()
    return out


def scan(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, n_assign, n_access, n_hex, n_found, base and spans: ``kind:start:end``
    in code points, end exclusive, by start and kind, comma-joined (base spans, all spans)."""
    rows = with_key(docs, key, text)
    names = (*KINDS, FOUND)

    def apply(batches):
        for c in T.chunks(batches):
            data, offsets = T.buffers(c.column("text"))
            base = base_spans(data, offsets)
            every = [[s[:3] for s in spans] for spans in base]
            for d, a, b in tagged(data, offsets, model) if model else ():
                if not any(a < y and x < b for x, _, y, _ in base[d]):
                    every[d].append((a, len(KINDS), b))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            said, count = [], np.zeros((len(names), c.num_rows), np.int64)
            for d, spans in enumerate(every):
                spans.sort()
                at = chars[offsets[d]]
                for _, kind, _ in spans:
                    count[kind, d] += 1
                said.append([(kind, f"{names[kind]}:{chars[a] - at}:{chars[b] - at}") for a, kind, b in spans])
            yield pa.record_batch([
                c.column("key"), *map(pa.array, count),
                pa.array([",".join(x for kind, x in s if kind < len(KINDS)) for s in said], pa.string()),
                pa.array([",".join(x for _, x in s) for s in said], pa.string())],
                ["key", "n_assign", "n_access", "n_hex", "n_found", "base", "spans"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(apply, f"key {kind}, n_assign long, n_access long, n_hex long, n_found long, base string, spans string") \
        .withColumnRenamed("key", key)

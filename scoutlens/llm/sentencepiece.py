"""SentencePiece encoding with distinct sampled segmentations, and decoding.

For each text ``samples`` distinct segmentations are drawn without replacement from the
unigram distribution over its lattice by Gumbel top-k: every set of segmentations sharing a
beginning carries the largest perturbed log-probability of its members, drawn top-down
(conditioned on the parent's), and best-first (A*) search pops sets in falling order of it;
backward masses are the exact heuristic. A popped set gives its best member; what is left
of it is split at every place where another piece could follow. Places whose beginning has
lost ``FAR`` nats of probability stay together as one set and are only split if that set is
popped itself. The next set's value after the last sample is the threshold of the
inclusion score ``log P(sampled) = log(1 - exp(-exp(log_prob - threshold)))`` (0 when
nothing is left).

The lattice is over a fixed public vocabulary; a space is the word mark, and a mark is put
in front of a non-empty text. It holds every segmentation of the text: atoms begin at the
first of a run of spaces and at tabs and line feeds, which no piece crosses, and long atoms are cut only
where no piece crosses either. Piece
probabilities follow the vocabulary's merge order (Zipf's law); byte pieces spell characters that have
no piece, so decoding gives back every text exactly. Draws depend only on the row key, the
place in the text, the sample and the seed: not on batches, partitions or task attempts.

Defined results: a null or empty text has one segmentation, without pieces, of probability
1; texts with fewer than ``samples`` segmentations give all of them; repeated rows give
repeated samples; an empty table gives no rows; further columns are carried only if named
in ``keep`` (under a prefix-free name they must not clash with the output's).
"""

from __future__ import annotations

import heapq
import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from . import lattice as L
from . import text as T
from .common import text_of

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SEED = 11
SMOOTH = 0.3                        # exponent on piece probabilities, as in subword regularisation
FAR = 7.0                           # nats of a beginning below which places stay together
CHUNK = 1 << 20                     # bytes of text encoded together
PIECES = 1 << 18                    # pieces decoded together
_BREAK = np.zeros(256, bool)
_BREAK[[0x09, 0x0A]] = True         # no piece holds them beside other bytes


def piece_weight(vocab: L.Vocabulary) -> np.ndarray:
    """Zipf over the merge order (a byte piece counts as a rarest piece), to the power SMOOTH:
    a text's segmentations have probability proportional to their product."""
    rank = np.arange(len(vocab.pieces), dtype=float)
    p = 1.0 / (rank + 2.7)
    p[vocab.byte_id] = 1.0 / len(rank)
    p[vocab.length == 0] = 0.0
    return (p / p.sum()) ** SMOOTH


def _uniform(h: np.ndarray) -> np.ndarray:
    """(0, 1) from 64-bit hashes."""
    return ((T.mix(h) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


class _Draws:
    """The lattice of a chunk's distinct atoms as nodes with outgoing edges, largest first."""

    def __init__(self, vocab: L.Vocabulary, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        p = L.scaled(vocab, piece_weight(vocab)[:, None])
        small = np.flatnonzero(end - start <= L.LONGEST)
        lat = L.match(vocab, data, start[small], end[small])
        beta = L.backward(lat, p)
        size = lat.size
        self.root = np.empty(len(start), np.int64)       # first node of the caller's atom
        first = np.cumsum(size + 1) - (size + 1)
        self.root[small[lat.order]] = first
        count = int((size + 1).sum())
        degree = np.zeros(count, np.int64)
        for _, atom, s, _, _ in lat.edges:
            degree[first[atom] + s] += 1                 # one edge of a length per node
        offset = np.append(0, np.cumsum(degree))
        edge_piece = np.empty(offset[-1], np.int32)
        edge_to = np.empty(offset[-1], np.int64)
        edge_p = np.empty(offset[-1])
        fill = offset[:-1].copy()
        for length, atom, s, piece, cut in reversed(lat.edges):   # long pieces first
            node = first[atom] + s
            at = fill[node]
            fill[node] += 1
            edge_piece[at], edge_to[at] = piece, node + length
            for d in np.flatnonzero(np.diff(cut)):
                lo, hi = cut[d], cut[d + 1]
                a = atom[lo:hi]
                edge_p[at[lo:hi]] = p[piece[lo:hi], 0] * beta[d + length][a, 0] / beta[d][a, 0]
        parts = [(degree, edge_piece, edge_to, edge_p)]
        for i in np.flatnonzero(end - start > L.LONGEST):
            run = L.run(vocab, data[start[i]:end[i]])
            b = L.log_backward(run, p)[:, 0]
            to = run.start + run.length
            parts.append((np.diff(run.first), run.piece.astype(np.int32), count + to,
                          np.exp(np.log(p[run.piece, 0]) + b[to] - b[run.start])))
            self.root[i] = count
            count += len(b)
        degree, self.piece, self.to, self.p = (np.concatenate(x) for x in zip(*parts))
        self.offset = np.append(0, np.cumsum(degree))
        self.forks = np.repeat(degree > 1, degree)       # edges of nodes with several
        self.log_p = np.log(np.maximum(self.p, 1e-300))
        # plain numbers for the search, which looks at a few nodes of each text
        self.root_view, self.offset_view, self.to_view = map(memoryview, (self.root, self.offset, self.to))
        self.p_view, self.log_view = memoryview(self.p), memoryview(self.log_p)

    def paths(self, atom: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One segmentation for every occurrence: edges in order, and each occurrence's
        first edge (one more at the end)."""
        node, which = self.root[atom], np.arange(len(atom))
        steps, step = [], 0
        while True:
            lo, hi = self.offset[node], self.offset[node + 1]
            go = hi > lo
            if not go.all():
                node, which, lo, hi = node[go], which[go], lo[go], hi[go]
            if not len(node):
                break
            u = _uniform(key[which] + np.uint64(step * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            edge, u = lo.copy(), u - self.p[lo]
            late = np.flatnonzero((u >= 0) & (edge + 1 < hi))
            while len(late):
                edge[late] += 1
                u[late] -= self.p[edge[late]]
                late = late[(u[late] >= 0) & (edge[late] + 1 < hi[late])]
            steps.append((which, edge))
            node = self.to[edge]
            step += 1
        if not steps:
            return np.zeros(0, np.int64), np.zeros(len(atom) + 1, np.int64)
        n = np.zeros(len(atom), np.int64)
        for which, _ in steps:
            n[which] += 1
        first = np.append(0, np.cumsum(n))
        out = np.empty(first[-1], np.int64)
        for i, (which, edge) in enumerate(steps):
            out[first[which] + i] = edge
        return out, first


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _atoms(column: pa.Array, vocab: L.Vocabulary):
    """Atoms of a string column, a word mark in front of each non-empty text."""
    column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    mark = pc.if_else(pc.equal(pc.binary_length(column), 0), _text(""), _text(" "))
    data, offsets = T.buffers(pc.binary_join_element_wise(mark, column, _text("")))
    begins = np.zeros(len(data) + 1, bool)
    space = data == 0x20
    begins[:-1] |= space | _BREAK[data]
    begins[1:-1] &= ~(space[1:] & space[:-1])            # a run of spaces is in one atom with the word behind it
    begins[offsets] = True
    begins[1:] |= _BREAK[data]
    at = np.flatnonzero(begins[:len(data)])
    start, end = L.atoms_cut(vocab, data, at, np.append(at[1:], len(data)))
    return data, start, end, np.searchsorted(start, offsets)


class _Search:
    """Perturbed best-first search over one text's segmentations. A set in the queue is
    (leaf, at, log probability of the beginning, node, atom, edge): the leaf's first ``at``
    edges followed by ``edge``, or, where edge is None, all that leave the leaf later."""

    def __init__(self, draws, atoms, sampled, seed):
        self.d, self.atoms, self.sampled = draws, atoms, sampled
        self.random = random.Random(seed)
        self.leaves: list = []                           # (edges, log probability)
        self.heap: list = []
        self.pushed = 0

    def gumbel(self) -> float:
        return -math.log(self.random.expovariate(1.0) or 1e-300)

    def push(self, mass: float, top: float, item):
        """Queue a set with a Gumbel value of location ``mass`` known to be under ``top``."""
        a, b = -top, -self.gumbel() - mass
        low, high = (a, b) if a < b else (b, a)
        heapq.heappush(self.heap, (high + math.log1p(math.exp(low - high)), self.pushed, item))
        self.pushed += 1

    def finish(self, head: np.ndarray, edge: int, head_log: float, atom: int, draw: int):
        """Complete a beginning: through the atom's rest, then the draw's later atoms."""
        offset, to, p = self.d.offset_view, self.d.to_view, self.d.p_view
        path, log, node = [edge], head_log, to[edge]
        while offset[node + 1] > offset[node]:
            edge, last, u = offset[node], offset[node + 1] - 1, self.random.random()
            u -= p[edge]
            while u >= 0 and edge < last:
                edge += 1
                u -= p[edge]
            path.append(edge)
            log += self.d.log_view[edge]
            node = to[edge]
        edges, first, logs = self.sampled(draw)
        a = first[atom + 1]
        return np.concatenate([head, np.array(path, np.int64), edges[a:]]), log + float(logs[-1] - logs[a])

    def split(self, leaf: int, at: int, head_log: float, node: int, atom: int, value: float, whole: bool) -> list:
        """(log mass, set) of what leaves ``leaf`` at its edge ``at`` or later; unless
        ``whole``, far places are queued as one set."""
        offset, to, log_p = self.d.offset_view, self.d.to_view, self.d.log_view
        edges, log = self.leaves[leaf]
        sets: list = []
        while at < len(edges):
            if not whole and head_log < -FAR:
                if not self.d.forks[edges[at:]].any():   # the rest has no other way
                    return sets
                rest = head_log + math.log(-math.expm1(min(log - head_log, -1e-12)))
                self.push(rest, value, (leaf, at, head_log, node, atom, None))
                return sets
            edge = int(edges[at])
            for other in range(offset[node], offset[node + 1]):
                if other != edge:
                    sets.append((head_log + log_p[other], (leaf, at, head_log, node, atom, other)))
            head_log += log_p[edge]
            node, at = to[edge], at + 1
            if offset[node + 1] == offset[node] and at < len(edges):
                atom += 1
                node = self.d.root_view[self.atoms[atom]]
        return sets

    def run(self, samples: int):
        """[(edges, log probability)] and the threshold."""
        top = self.gumbel()
        edges, _, logs = self.sampled(0)
        self.leaves.append((edges, float(logs[-1])))
        if samples > 0:
            for mass, item in self.split(0, 0, 0.0, self.d.root_view[self.atoms[0]], 0, top, False):
                self.push(mass, top, item)
        while self.heap and len(self.leaves) < samples:
            value, _, (leaf, at, head_log, node, atom, edge) = heapq.heappop(self.heap)
            value = -value
            if edge is None:                             # the best member is in one of the parts
                parts = self.split(leaf, at, head_log, node, atom, value, True)
                chosen = max(range(len(parts)), key=lambda i: parts[i][0] + self.gumbel())
                for i, (mass, item) in enumerate(parts):
                    if i != chosen:
                        self.push(mass, value, item)
                leaf, at, head_log, node, atom, edge = parts[chosen][1]
            log = head_log + self.d.log_view[edge]
            self.leaves.append(self.finish(self.leaves[leaf][0][:at], edge, log, atom, len(self.leaves)))
            node = self.d.to_view[edge]
            new = len(self.leaves) - 1
            if self.d.offset_view[node + 1] == self.d.offset_view[node] and at + 1 < len(self.leaves[new][0]):
                atom += 1
                node = self.d.root_view[self.atoms[atom]]
            for mass, item in self.split(new, at + 1, log, node, atom, value, False):
                self.push(mass, value, item)
        return self.leaves, -self.heap[0][0] if self.heap else -math.inf


def _encode_chunk(vocab, column, keys, samples, seed):
    """For each (text, sample): text number, sample, ids, log probability, inclusion."""
    data, start, end, bounds = _atoms(column, vocab)
    out_doc, out_rank, out_log, out_in, ids, sizes = [], [], [], [], [], []
    if len(start):
        _, first, inverse = np.unique(T.hashes(data, start, end), return_index=True, return_inverse=True)
        draws = _Draws(vocab, data, start[first], end[first])
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        place = np.arange(len(start)) - bounds[doc]
        row = T.mix(keys + np.uint64(seed))
        per_draw = []
        for j in range(samples):
            e, f = draws.paths(inverse, T.pair(row[doc], (place * 64 + j).astype(np.uint64)))
            per_draw.append((e, f))
    for i in range(len(bounds) - 1):
        lo, hi = int(bounds[i]), int(bounds[i + 1])
        if hi == lo:
            got, threshold = [(np.zeros(0, np.int64), 0.0)], -math.inf
        else:
            def sampled(j, lo=lo, hi=hi):
                e, f = per_draw[j]
                e = e[f[lo]:f[hi]]
                return e, f[lo:hi + 1] - f[lo], np.append(0.0, np.cumsum(draws.log_p[e]))
            got, threshold = _Search(draws, inverse[lo:hi], sampled, int(row[i])).run(samples)
        for rank, (edges, log) in enumerate(got):
            out_doc.append(i)
            out_rank.append(rank)
            out_log.append(log)
            rate = log - threshold                       # log of the exponential's mean
            out_in.append(0.0 if threshold == -math.inf else rate if rate < -30
                          else math.log(-math.expm1(-math.exp(min(rate, 30)))))
            ids.append(draws.piece[edges] if len(edges) else np.zeros(0, np.int32))
            sizes.append(len(edges))
    return out_doc, out_rank, out_log, out_in, ids, sizes


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple = (), samples: int = SAMPLES,
           seed: int = SEED, path: str = MODEL_PATH) -> DataFrame:
    """One row per sampled segmentation: key, ``keep`` columns, sample (from 0), ids, log_prob,
    log_inclusion."""
    def apply(batches):
        vocab = L.vocabulary(path)
        for c in T.chunks(batches, "_text", CHUNK):
            keys = c.column("_seed").to_numpy().view(np.uint64)
            doc, rank, log, inclusion, ids, sizes = _encode_chunk(vocab, c.column("_text"), keys, samples, seed)
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), flat)
            take = pa.array(doc, pa.int64())
            columns = [c.column(name).take(take) for name in (key, *keep)]
            yield pa.record_batch([*columns, pa.array(rank, pa.int32()), lists, pa.array(log, pa.float64()),
                                   pa.array(inclusion, pa.float64())],
                                  [key, *keep, "sample", "ids", "log_prob", "log_inclusion"])

    rows = docs.select(key, *keep, text_of(text).alias("_text"),
                       F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("_seed"))
    schema = TY.StructType([TY.StructField(f.name, f.dataType) for f in rows.schema if f.name not in ("_text", "_seed")])
    schema = schema.add("sample", "integer").add("ids", TY.ArrayType(TY.IntegerType())) \
        .add("log_prob", "double").add("log_inclusion", "double")
    return rows.mapInArrow(apply, schema)


def _strings(data: np.ndarray, ends: np.ndarray, null: pa.Array) -> pa.Array:
    """Texts from UTF-8 bytes and their borders; ids that spell no UTF-8 give U+FFFD."""
    raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    try:
        text = raw.cast(pa.string())
    except pa.ArrowInvalid:
        text = pa.array([x.decode(errors="replace") for x in raw.to_pylist()], pa.string())
    return pc.if_else(null, pa.scalar(None, pa.string()), text)


def _list_sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _slices(batches, column: str):
    """Slices of the batches with about PIECES list elements (one row at least)."""
    for batch in batches:
        ends = np.append(0, np.cumsum(_list_sizes(batch.column(column))))
        lo = 0
        while lo < batch.num_rows:
            hi = max(int(np.searchsorted(ends, ends[lo] + PIECES, "right")) - 1, lo + 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def decode(encoded: DataFrame, ids: str = "ids", to: str = "decoded", path: str = MODEL_PATH) -> DataFrame:
    """The rows with the text that the piece ids spell (null ids: null)."""
    def apply(batches):
        vocab = L.vocabulary(path)
        begin = np.append(0, np.cumsum(vocab.length))
        spelled = np.frombuffer(b"".join(p or b"" for p in vocab.pieces), np.uint8)
        for batch in _slices(batches, ids):
            lists = batch.column(ids)
            piece = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = _list_sizes(lists)
            n = vocab.length[piece]
            total = int(n.sum())
            at = np.repeat(begin[piece] - (np.cumsum(n) - n), n) + np.arange(total)
            data = spelled[at]
            ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(sizes))]
            marks = ends[:-1][np.diff(ends) > 0]         # the mark in front of each text
            marks = marks[data[marks] == 0x20]
            data = np.delete(data, marks)
            text = _strings(data, ends - np.searchsorted(marks, ends), pc.is_null(lists))
            names = batch.schema.names
            yield pa.record_batch([*batch.columns, text], [*names, to])

    schema = TY.StructType([TY.StructField(f.name, f.dataType) for f in encoded.schema]).add(to, "string")
    return encoded.mapInArrow(apply, schema)

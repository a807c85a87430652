"""Segmentation lattices over a fixed public piece vocabulary, for many words at once.

A word ("atom") is a byte range of a text buffer; a leading space byte stands for the
vocabulary's word mark. All pieces starting at every character are found by walking a
double-array trie for all positions together. Edges are grouped by piece length, so each
dynamic-programming step adds at most one edge to a node and needs no scatter-add.

Characters without a piece of their own fall back to byte pieces. Atoms longer than
``LONGEST`` bytes are cut where no piece crosses: every segmentation passes such a place, so
the mass of an atom is the product of its parts' and nothing is lost. What has no such place
for over ``LONGEST`` bytes (one character repeated, say) is a ``Run``, handled alone in log
space with time and memory in proportion to its bytes.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np

LONGEST = 64                        # bytes of an atom that shares its steps with others
WINDOW = 1 << 16                    # bytes of long atoms searched for cuts together
MARK = "▁"
PER_BYTE = 1.2                      # masses are scaled by exp(PER_BYTE * bytes)


class Vocabulary(NamedTuple):
    """Pieces as bytes (word mark: a space) and their trie."""

    pieces: list                    # bytes by id; None for control ids
    length: np.ndarray              # bytes by id, 0 for control ids
    byte_id: np.ndarray             # id of the piece for each byte value
    base: np.ndarray                # double-array trie
    check: np.ndarray
    value: np.ndarray               # piece id at a node, else -1


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read a sentencepiece model (byte fallback required) and build its trie."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    byte_id = np.full(256, -1, np.int64)
    pieces: list = [None] * size
    words = {}
    for i in range(size):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte_id[int(name[3:-1], 16)] = i
            pieces[i] = bytes([int(name[3:-1], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text = name.replace(MARK, " ").encode()
            pieces[i] = text
            words[text] = i
            if b" " in text.lstrip(b" ") or (len(text) > 1 and (b"\n" in text or b"\t" in text)):
                raise ValueError(f"a piece crosses words: {name!r}")
    if (byte_id < 0).any():
        raise ValueError("the vocabulary has no piece for every byte")
    length = np.array([len(p) if p else 0 for p in pieces], np.int64)
    return Vocabulary(pieces, length, byte_id, *_trie(words))


def _trie(words: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    children: list[dict] = [{}]
    leaf = [-1]
    for word, i in words.items():
        node = 0
        for b in word:
            if b not in children[node]:
                children[node][b] = len(children)
                children.append({})
                leaf.append(-1)
            node = children[node][b]
        leaf[node] = i
    room = 256 + 4 * len(children)
    base, check = np.zeros(room + 256, np.int32), np.full(room + 256, -1, np.int32)
    value = np.full(room + 256, -1, np.int32)
    used = bytearray(room + 256)
    used[0] = 1
    slots, free, wide = {0: 0}, 256, 256               # a base is never negative: bytes fit below any slot from 256 on
    for node in range(len(children)):                    # parents come before their children
        slot, kids = slots.pop(node), sorted(children[node])
        value[slot] = leaf[node]
        if not kids:
            base[slot] = room
            continue
        while used[free]:
            free += 1
        first, tries = (free if len(kids) == 1 else max(free, wide)), 0
        at = first - kids[0]
        while any(used[at + b] for b in kids):
            at += 1
            tries += 1
        if len(kids) > 1 and tries > 32:                 # too crowded there: begin further on
            wide = at + kids[0]
        base[slot] = at
        for b in kids:
            used[at + b] = 1
            check[at + b] = slot
            slots[children[node][b]] = at + b
    return base, check, value


class Lattice(NamedTuple):
    """Edges of sorted atoms (longest first). ``order[i]``: the caller's atom at place i."""

    size: np.ndarray                # bytes of each atom, descending
    order: np.ndarray
    wide: np.ndarray                # wide[d]: atoms of at least d bytes
    edges: list                     # (length, atom, start, piece, cut by start)


def atoms_cut(vocab: Vocabulary, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut atoms of over LONGEST bytes at characters that no piece crosses, into parts of up to
    LONGEST bytes where such places allow it; order is kept."""
    long = np.flatnonzero(end - start > LONGEST)
    if not len(long):
        return start, end
    starts, ends, last = [], [], 0
    for i in long:
        starts.append(start[last:i])
        ends.append(end[last:i])
        free = start[i] + _uncrossed(vocab, data[start[i]:end[i]])
        cuts, at = [], 0                                 # places in free; its last is the atom's end
        while at < len(free) - 1:
            cuts.append(free[at])
            at = max(int(np.searchsorted(free, free[at] + LONGEST, "right")) - 1, at + 1)
        starts.append(np.array(cuts, np.int64))
        ends.append(np.array([*cuts[1:], end[i]], np.int64))
        last = i + 1
    return np.concatenate([*starts, start[last:]]), np.concatenate([*ends, end[last:]])


def _uncrossed(vocab: Vocabulary, atom: np.ndarray) -> np.ndarray:
    """Character borders of an atom, its ends included, that lie inside no piece at that place."""
    n, reach = len(atom), int(vocab.length.max())
    crossed = np.zeros(n + 1, np.int64)                  # +1 behind a piece's start, -1 at its end
    for lo in range(0, n, WINDOW):
        hi = min(lo + WINDOW, n)
        part = atom[lo:hi + reach]                       # a piece that starts in the window ends in the part
        for length, found in _pieces(vocab, part, np.array([0]), np.array([len(part)])).items():
            at = lo + np.concatenate([rel for _, rel, _ in found])
            at = at[at < hi]
            if length > 1:                               # at most one piece of a length starts at a place
                crossed[at + 1] += 1
                crossed[at + length] -= 1
    free = np.cumsum(crossed) <= 0
    free[1:-1] &= (atom[1:] & 0xC0) != 0x80
    free[[0, -1]] = True
    return np.flatnonzero(free)


def _pieces(vocab: Vocabulary, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> dict:
    """Pieces at all characters of the atoms: {length: [(atoms, places, pieces)]}."""
    n = len(size)
    atom = np.repeat(np.arange(n), size)
    rel = np.arange(len(atom)) - np.repeat(np.cumsum(size) - size, size)
    lead = data[start[atom] + rel]
    border = (lead & 0xC0) != 0x80
    atom, rel, lead = atom[border], rel[border], lead[border]
    width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
    at, left = start[atom] + rel, size[atom] - rel
    state = np.zeros(len(atom), np.int32)
    place = np.arange(len(atom))
    alone = np.zeros(len(atom), bool)                    # the character has a piece of its own
    found: dict[int, list] = {}
    depth = 0
    while len(place):
        step = vocab.base[state] + data[at[place] + depth]
        ok = vocab.check[step] == state
        place, state = place[ok], step[ok]
        depth += 1
        piece = vocab.value[state]
        hit = piece >= 0
        got = place[hit]
        if len(got):
            alone[got[width[got] == depth]] = True
            found.setdefault(depth, []).append((atom[got], rel[got], piece[hit].astype(np.int64)))
        more = left[place] > depth
        place, state = place[more], state[more]
    lost = np.flatnonzero(~alone)
    for k in range(4):                                   # byte pieces of such characters
        have = lost[(width[lost] > k) & (left[lost] > k)]
        if len(have):
            found.setdefault(1, []).append((atom[have], rel[have] + k, vocab.byte_id[data[at[have] + k]]))
    return found


def match(vocab: Vocabulary, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Lattice:
    """All pieces at all characters of the atoms (each of 1..LONGEST bytes)."""
    size = (end - start).astype(np.int64)
    order = np.argsort((255 - size).astype(np.uint8), kind="stable")
    start, size = start[order], size[order]
    n = len(size)
    wide = n - np.searchsorted(size[::-1], np.arange(LONGEST + 2))
    found = _pieces(vocab, data, start, size)
    edges = []
    for length in sorted(found):
        a, s, p = (np.concatenate(x) for x in zip(*found[length]))
        by = np.argsort(s.astype(np.uint8), kind="stable")
        a, s, p = a[by], s[by], p[by]
        edges.append((length, a, s, p, np.searchsorted(s, np.arange(LONGEST + 2))))
    return Lattice(size, order, wide, edges)


def scaled(vocab: Vocabulary, probability: np.ndarray) -> np.ndarray:
    """Piece probabilities (pieces x columns) times exp(PER_BYTE * bytes)."""
    return probability * np.exp(PER_BYTE * vocab.length)[:, None]


def forward(lattice: Lattice, p: np.ndarray) -> list[np.ndarray]:
    """alpha[d][atom, column]: mass of all segmentations of an atom's first d bytes."""
    top = int(lattice.size[0]) if len(lattice.size) else 0
    alpha = [np.ones((int(lattice.wide[0]), p.shape[1]))]
    for d in range(1, top + 1):
        here = np.zeros((int(lattice.wide[d]), p.shape[1]))
        for length, atom, _, piece, cut in lattice.edges:
            if length <= d:
                lo, hi = cut[d - length], cut[d - length + 1]
                if hi > lo:
                    here[atom[lo:hi]] += alpha[d - length][atom[lo:hi]] * p[piece[lo:hi]]
        alpha.append(here)
    return alpha


def backward(lattice: Lattice, p: np.ndarray) -> list[np.ndarray]:
    """beta[d][atom, column]: mass of all segmentations of an atom's bytes from d on."""
    top = int(lattice.size[0]) if len(lattice.size) else 0
    beta: list = [None] * (top + 1)
    for d in range(top, -1, -1):
        here = np.zeros((int(lattice.wide[d]), p.shape[1]))
        here[int(lattice.wide[d + 1]):] = 1.0            # atoms that end here
        for length, atom, _, piece, cut in lattice.edges:
            lo, hi = cut[d], cut[d + 1]
            if hi > lo:
                here[atom[lo:hi]] += beta[d + length][atom[lo:hi]] * p[piece[lo:hi]]
        beta[d] = here
    return beta


def total(lattice: Lattice, alpha: list[np.ndarray]) -> np.ndarray:
    """Mass of each atom in the caller's order."""
    out = np.empty((len(lattice.size), alpha[0].shape[1]))
    for d in range(1, len(alpha)):
        lo, hi = int(lattice.wide[d + 1]), int(lattice.wide[d])
        out[lattice.order[lo:hi]] = alpha[d][lo:hi]
    return out


class Run(NamedTuple):
    """One atom of any size: edges by start, the longest first."""

    first: np.ndarray               # edges that leave place d: first[d]:first[d + 1]
    start: np.ndarray
    length: np.ndarray
    piece: np.ndarray


def run(vocab: Vocabulary, atom: np.ndarray) -> Run:
    """All pieces at all characters of one atom's bytes."""
    found = _pieces(vocab, atom, np.array([0]), np.array([len(atom)]))
    start, length, piece = (np.concatenate(x) for x in zip(*(
        (s, np.full(len(s), size), p) for size, parts in found.items() for _, s, p in parts)))
    by = np.lexsort((-length, start))
    start, length, piece = start[by], length[by], piece[by]
    return Run(np.searchsorted(start, np.arange(len(atom) + 2)), start, length, piece)


def _log_sum(rows: np.ndarray) -> np.ndarray:
    top = rows.max(axis=0)
    return top + np.log(np.exp(rows - top).sum(axis=0))


def log_backward(run: Run, p: np.ndarray) -> np.ndarray:
    """log beta[d, column]: mass of all segmentations from place d on (-inf inside a character that
    no byte piece enters)."""
    log = np.log(p[run.piece])
    n = len(run.first) - 2
    beta = np.full((n + 1, p.shape[1]), -np.inf)
    beta[n] = 0.0
    first = run.first.tolist()
    for d in range(n - 1, -1, -1):
        lo, hi = first[d], first[d + 1]
        if hi > lo:
            beta[d] = _log_sum(log[lo:hi] + beta[d + run.length[lo:hi]])
    return beta


def log_forward(run: Run, p: np.ndarray) -> np.ndarray:
    """log alpha[d, column]: mass of all segmentations of the first d bytes."""
    end = run.start + run.length
    by = np.argsort(end, kind="stable")
    log, start = np.log(p[run.piece[by]]), run.start[by]
    n = len(run.first) - 2
    alpha = np.full((n + 1, p.shape[1]), -np.inf)
    alpha[0] = 0.0
    first = np.searchsorted(end[by], np.arange(n + 2)).tolist()
    for d in range(1, n + 1):
        lo, hi = first[d], first[d + 1]
        if hi > lo:
            alpha[d] = _log_sum(log[lo:hi] + alpha[start[lo:hi]])
    return alpha


def log_mass(vocab: Vocabulary, data: np.ndarray, start: np.ndarray, end: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Log mass of atoms of any size (atoms x columns)."""
    out = np.empty((len(start), p.shape[1]))
    small = end - start <= LONGEST
    lat = match(vocab, data, start[small], end[small])
    out[small] = np.log(total(lat, forward(lat, p)))
    for i in np.flatnonzero(~small):
        out[i] = log_backward(run(vocab, data[start[i]:end[i]]), p)[0]
    return out

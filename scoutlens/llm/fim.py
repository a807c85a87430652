"""Fill-in-middle transformation with a piecewise-linear learned rank index.

A text is cut at two token boundaries into prefix, middle and suffix, which are written in
another order between control strings so that a left-to-right model learns to fill in. Where
boundary number ``k`` of a text lies is answered by :class:`RankIndex`: straight segments are
fitted to all boundary offsets of every text such that none is off by more than ``bound``, a
cut is predicted from its segment and then corrected exactly by the boundary's stored residual.

A draw decides for each text by the hash of seed and key: its cuts and its form (``plain``,
``psm``: prefix, suffix, middle; ``spm``: suffix, prefix, middle). Texts are handled as byte
buffers, about 1 MB at a time; nothing is shuffled.

Defined results: a null text counts as empty and stays plain, as does a text that holds a
control string; a null key is drawn like an empty one; repeated rows have equal results; an
empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"      # control strings


@dataclass(frozen=True)
class Params:
    seed: int = 42
    formed_percent: int = 50       # texts that are cut
    spm_percent: int = 80          # of these: suffix first
    bound: int = 127               # a segment's greatest error; residuals fit a signed byte


class RankIndex:
    """Learned index from rank to offset over lists of ascending offsets, laid end to end.

    A segment covers consecutive ranks of one list by the line from its first to its last
    offset. Segments whose error is over ``bound`` are halved, all of a level at once, so there
    are at most log2(longest list) rounds. Lines are evaluated in whole numbers, therefore
    prediction plus residual is the offset itself.
    """

    def __init__(self, offsets: np.ndarray, bounds: np.ndarray, bound: int = Params.bound):
        """``offsets`` of list ``i`` are ``offsets[bounds[i]:bounds[i + 1]]``; no list is empty."""
        self.residual = np.zeros(len(offsets), np.int8 if bound < 128 else np.int64)
        lo, hi = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64) - 1
        done = []
        while len(lo):
            size = hi - lo + 1
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            base, rise, run = offsets[lo], offsets[hi] - offsets[lo], np.maximum(hi - lo, 1)
            line = np.repeat(base, size) + np.repeat(rise, size) * (at - np.repeat(lo, size)) // np.repeat(run, size)
            off = offsets[at] - line
            worst = np.maximum.reduceat(np.abs(off), np.cumsum(size) - size)
            good = worst <= bound
            kept = np.repeat(good, size)
            self.residual[at[kept]] = off[kept]
            done.append(np.stack([lo, base, rise, run], axis=1)[good])
            lo, hi = lo[~good], hi[~good]
            middle = (lo + hi) // 2                      # a segment of two ranks has no error
            lo, hi = np.concatenate([lo, middle + 1]), np.concatenate([middle, hi])
        table = np.concatenate(done) if done else np.zeros((0, 4), np.int64)
        self.first, self.base, self.rise, self.run = table[np.argsort(table[:, 0])].T

    def predict(self, rank: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.first, rank, "right") - 1
        return self.base[s] + self.rise[s] * (rank - self.first[s]) // self.run[s]

    def __call__(self, rank: np.ndarray) -> np.ndarray:
        """The offset of each rank: predicted, then corrected."""
        return self.predict(rank) + self.residual[rank]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all token boundaries, each text's start included, and the bounds of the
    texts' lists. A token is a word with the white space before it, or closing white space."""
    w = T.words(data, offsets)
    n = len(offsets) - 1
    full = offsets[1:] > offsets[:-1]
    closing = np.zeros(n, bool)
    closing[full] = T.SPACE[data[offsets[1:][full] - 1]]
    size = 1 + w.counts + closing
    bounds = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(bounds[-1], np.int64)
    out[bounds[:-1]] = offsets[:-1]
    out[bounds[w.doc] + 1 + np.arange(len(w.end)) - w.bounds[w.doc]] = w.end
    out[bounds[1:][closing] - 1] = offsets[1:][closing]
    return out, bounds


def draws(key: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit draws of a key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """One row per row: key, n (tokens), form, prefix_chars, middle_chars (null if plain),
    output (the transformed text), n_segments and max_residual (of the text's rank index)."""
    h1, h2, h3, h4 = draws(key, params.seed)
    body = text_of(text)
    marked = body.contains(PREFIX) | body.contains(SUFFIX) | body.contains(MIDDLE)
    form = F.when((body == "") | marked | (h3 % 100 >= params.formed_percent), "plain") \
        .when(h4 % 100 < params.spm_percent, "spm").otherwise("psm")
    rows = docs.select(F.col(key).alias("key"), body.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    bound = params.bound

    def apply(batches):
        for c in T.chunks(batches):
            data, offsets = T.buffers(c.column("text"))
            raw = data.tobytes()
            marks, bounds = boundaries(data, offsets)
            index = RankIndex(marks, bounds, bound)
            n = np.diff(bounds) - 1
            a, b = (c.column(h).to_numpy() % (n + 1) for h in ("h1", "h2"))
            cut, end = index(bounds[:-1] + np.minimum(a, b)), index(bounds[:-1] + np.maximum(a, b))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])      # code points up to each byte
            forms = c.column("form").to_pylist()
            out = []
            for f, lo, x, y, hi in zip(forms, offsets[:-1].tolist(), cut.tolist(), end.tolist(), offsets[1:].tolist()):
                if f == "plain":
                    out.append(raw[lo:hi])
                elif f == "psm":
                    out.append(b"".join((p, raw[lo:x], s, raw[y:hi], m, raw[x:y])))
                else:
                    out.append(b"".join((s, raw[y:hi], p, raw[lo:x], m, raw[x:y])))
            plain = np.array([f == "plain" for f in forms], bool)
            worst = np.maximum.reduceat(np.abs(index.residual.astype(np.int64)), bounds[:-1])
            yield pa.record_batch([
                c.column("key"), pa.array(n), c.column("form"),
                pa.array(chars[cut] - chars[offsets[:-1]], mask=plain), pa.array(chars[end] - chars[cut], mask=plain),
                pa.array(out, pa.binary()).cast(pa.string()),
                pa.array(np.diff(np.searchsorted(index.first, bounds))), pa.array(worst)],
                ["key", "n", "form", "prefix_chars", "middle_chars", "output", "n_segments", "max_residual"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(apply, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, "
                           "output string, n_segments long, max_residual long").withColumnRenamed("key", key)


def restore(form: Column, output: Column) -> Column:
    """The text that an output was made of: parts hold no control string, so they split cleanly."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return F.when(form == "plain", output) \
        .when(form == "psm", F.concat(part[1], part[3], part[2])) \
        .otherwise(F.concat(part[2], part[3], part[1]))

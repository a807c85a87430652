"""Language-model scoring by deleted interpolation.

The probability of a token after its predecessor mixes maximum-likelihood estimates,

    P(w | v) = a_b * c(vw) / c(v)  +  b_b * c(w) / N  +  c_b / (V + 1),

with weights that depend on the bucket b of the context's count c(v) (powers of two; an
unseen context has no bigram part). The weights of each bucket maximise the likelihood of
held-out text by expectation-maximisation: one learning fold is deleted, the counts of the
other folds give the estimates, and the deleted fold's tokens are what is predicted. Scores
then use the counts of all learning texts with these weights. A text is its words
(`[^\\x20\\x09-\\x0D]+`, A-Z lower-cased) and one end token; the first token's context is the
text's beginning, whose count is the number of learning texts.

How it runs: texts are dealt to batches of about ``BATCH`` bytes. Each batch sends its
distinct tokens and bigrams (64-bit hashes) with its own counts to the hash range they
belong to, once per batch however often they occur there, so a word with a third of all
tokens is one row per batch. A range adds the counts up and sends each batch the totals for
the keys it asked for, in the order asked. A batch then has every count that its texts need.
Held-out tokens are summarised by (bucket, bigram ratio, unigram ratio) on a fine logarithmic
grid of bounded size, where expectation-maximisation runs.

Defined results: a null or empty text is one end token; a null key counts as empty text in
the folds; with no learning text every score is that of a uniform choice among one token;
repeated rows are each scored; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import fold_of, materialize, with_key

FOLDS, HELD_OUT, DELETED = 7, 2, 6  # learning: all folds but HELD_OUT; DELETED sets the weights
BATCH = 6 << 20                     # bytes of text of a batch, about
RANGE = 6 << 20                     # bytes of text for each range of hashes
BUCKETS = 26                        # of context counts: 0, 1, 2-3, 4-7, ...
GRID = 8                            # grid lines an octave
ROUNDS = 60                         # of expectation-maximisation
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def _pack(x: np.ndarray) -> bytes:
    """64-bit numbers by byte plane: sorted hashes and small counts then compress well."""
    return np.ascontiguousarray(x.astype(np.uint64)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.uint64)[:, 0]


def _batches(rows: DataFrame, batches: int, deleted: int) -> DataFrame:
    """(batch, blob): texts in compressed Arrow blobs, dealt to batches by hash; the deleted
    fold's texts have batches of their own, numbered from ``batches`` on."""
    def apply(parts):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for c in T.chunks(parts, limit=2 << 20):
            to = c.column("batch").to_numpy()
            order = np.argsort(to, kind="stable")
            cut = np.flatnonzero(np.append(True, np.diff(to[order]) != 0))
            ids, blobs = [], []
            plain = c.select(["key", "fold", "text"])
            for lo, hi in zip(cut, [*cut[1:], len(order)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, plain.schema, options=options) as out:
                    out.write_batch(plain.take(pa.array(order[lo:hi])))
                ids.append(int(to[order[lo]]))
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["batch", "blob"])

    h = F.xxhash64("key", "text")
    to = F.when(F.col("fold") == DELETED, batches + F.pmod(h, F.lit(deleted))).otherwise(F.pmod(h, F.lit(batches)))
    return rows.withColumn("batch", to).mapInArrow(apply, "batch long, blob binary")


class _Batch:
    """Tokens of a batch's texts and the distinct keys it asks for."""

    def __init__(self, table: pa.Table):
        keys, folds, sizes, tokens = [], [], [], []
        for blob in table["blob"]:                        # one blob's text at a time
            part = pa.ipc.open_stream(blob.as_buffer()).read_all().combine_chunks()
            keys.append(part["key"].combine_chunks())
            folds.append(part["fold"].to_numpy())
            w = T.word_column(part["text"].combine_chunks())
            size = w.counts + 1                           # with the end token
            token = np.full(int(size.sum()), END, np.uint64)
            is_word = np.ones(len(token), bool)
            is_word[np.cumsum(size) - 1] = False
            token[is_word] = T.hashes(w.data, w.start, w.end)
            sizes.append(size)
            tokens.append(token)
        self.key, self.fold, self.size = pa.concat_arrays(keys), np.concatenate(folds), np.concatenate(sizes)
        self.first = np.append(0, np.cumsum(self.size))
        token = np.concatenate(tokens)
        del tokens
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[self.first[:-1]] = START
        self.learns = np.repeat(self.fold != HELD_OUT, self.size)
        self.keys, self.of = [], []
        for x in (token, T.pair(before, token)):
            keys, of = np.unique(x, return_inverse=True)
            self.keys.append(keys)
            self.of.append(of)
        self.previous = np.append(-1, self.of[0][:-1])    # place of the context among the tokens
        self.previous[self.first[:-1]] = -1

    def requests(self, ranges: int):
        """(level, range, keys, own counts)."""
        for level, (keys, of) in enumerate(zip(self.keys, self.of)):
            n = np.bincount(of[self.learns], minlength=len(keys))
            part = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            cut = np.searchsorted(part, np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(cut)):
                yield level, int(r), _pack(keys[cut[r]:cut[r + 1]]), _pack(n[cut[r]:cut[r + 1]])

    def answered(self, replies: pa.Table, column: str) -> list[np.ndarray]:
        """Counts of the own keys, by level, from the ranges' replies."""
        rows = sorted(zip(replies["level"].to_pylist(), replies["range"].to_pylist(), range(replies.num_rows)))
        out: list[list] = [[], []]
        for level, _, i in rows:
            out[level].append(_unpack(replies[column][i].as_py()))
        return [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in out]

    def estimates(self, counts: list[np.ndarray], texts: int):
        """For each token: its count, its bigram's count, its context's count."""
        c1, c2 = counts[0][self.of[0]], counts[1][self.of[1]]
        context = np.where(self.previous >= 0, counts[0][self.previous], texts)
        return c1, c2, context


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(context > 0, 1 + np.log2(np.maximum(context, 1)).astype(np.int64), 0), BUCKETS - 1)


def _counts(asked: DataFrame, batches: int) -> DataFrame:
    """Totals of each hash range: a row for every block asked for (all, kept: counts in the
    order asked; kept only for the deleted fold's batches), and one row with batch -1: the
    range's distinct tokens and tokens, in all learning texts and in those not deleted."""
    def apply(table: pa.Table) -> pa.Table:
        blocks = [_unpack(x.as_py()) for x in table["keys"]]
        own = np.concatenate([_unpack(x.as_py()) for x in table["counts"]]).astype(float)
        batch = table["batch"].to_numpy()
        sizes = np.array([len(b) for b in blocks])
        keys, of = np.unique(np.concatenate(blocks), return_inverse=True)
        every = np.bincount(of, own, len(keys)).astype(np.int64)
        kept = np.bincount(of, own * np.repeat(batch < batches, sizes), len(keys)).astype(np.int64)
        cut = np.append(0, np.cumsum(sizes))
        everything = [_pack(every[of[a:b]]) for a, b in zip(cut, cut[1:])]
        without = [_pack(kept[of[a:b]]) if x >= batches else None for a, b, x in zip(cut, cut[1:], batch)]
        totals = [int((every > 0).sum()), int(every.sum()), int((kept > 0).sum()), int(kept.sum())]
        level, part = table["level"][0].as_py(), table["range"][0].as_py()
        n = len(batch)
        return pa.table({
            "batch": pa.array([*batch, -1], pa.int64()), "level": pa.array([level] * (n + 1), pa.int32()),
            "range": pa.array([part] * (n + 1), pa.int32()), "every": pa.array([*everything, None], pa.binary()),
            "kept": pa.array([*without, None], pa.binary()),
            "totals": pa.array([*[None] * n, totals], pa.list_(pa.int64()))})

    return asked.groupBy("level", "range").applyInArrow(
        apply, "batch long, level int, range int, every binary, kept binary, totals array<long>")


def weights(grid: pa.Table, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights (bucket x 3: bigram, unigram, uniform) by expectation-maximisation over
    the held-out grid (bucket, n, x2, x1: mean base-2 logs of bigram and unigram estimate over
    the uniform one; null: zero)."""
    bucket, n = grid["bucket"].to_numpy(), grid["n"].to_numpy().astype(float)
    ratio = np.ones((len(bucket), 3))
    for j, name in enumerate(("x2", "x1")):
        x = grid[name].to_numpy().astype(float)
        ratio[:, j] = np.where(np.isnan(x), 0.0, np.exp2(np.nan_to_num(x)))

    def climb(rows, start, prior):
        w = start
        for _ in range(rounds):
            share = ratio[rows] * w
            share /= share.sum(axis=1, keepdims=True)
            total = (share * n[rows, None]).sum(axis=0) + prior
            w = total / total.sum()
        return w

    even = np.full(3, 1 / 3)
    pooled = climb(np.ones(len(bucket), bool), even, even) if len(bucket) else even
    out = np.empty((BUCKETS, 3))
    for b in range(BUCKETS):                              # a bucket with little text leans on all of them
        out[b] = climb(bucket == b, pooled, pooled) if b else np.array([0.0, *(
            climb(bucket == b, pooled, pooled)[1:])])
        out[b] = np.maximum(out[b], 1e-6 * np.array([b > 0, 1, 1]))
        out[b] = np.round(out[b] / out[b].sum(), 9)
    return out


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigrams), score (the mixture's log10 probability)."""
    rows = with_key(docs, key, text).withColumn("key", F.col("key").cast("long")) \
        .withColumn("fold", fold_of("key", FOLDS).cast("int"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + 1).alias("n"),
                    F.sum((F.col("fold") != HELD_OUT).cast("long")).alias("texts"),
                    F.sum(((F.col("fold") != HELD_OUT) & (F.col("fold") != DELETED)).cast("long")).alias("kept")).first()
    total, texts, kept_texts = (int(size[x] or 0) for x in ("n", "texts", "kept"))
    batches = -(-total * (FOLDS - 1) // (FOLDS * BATCH)) or 1
    deleted = -(-total // (FOLDS * BATCH)) or 1
    ranges = max(1, total // RANGE)

    def ask(table: pa.Table) -> pa.Table:
        batch = table["batch"][0].as_py()
        found = list(_Batch(table.select(["blob"])).requests(ranges))
        level, part, keys, counts = zip(*found) if found else ((), (), (), ())
        return pa.table({"batch": pa.array([batch] * len(found), pa.int64()), "level": pa.array(level, pa.int32()),
                         "range": pa.array(part, pa.int32()), "keys": pa.array(keys, pa.binary()),
                         "counts": pa.array(counts, pa.binary())})

    packed = _batches(rows, batches, deleted)
    asked = packed.groupBy("batch").applyInArrow(ask, "batch long, level int, range int, keys binary, counts binary")
    replies = materialize(_counts(asked, batches), "lm-counts")
    sums = replies.where("batch = -1 and level = 0").agg(
        *[F.coalesce(F.sum(F.col("totals")[i]), F.lit(0)).alias(str(i)) for i in range(4)]).first()
    vocabulary, tokens, kept_vocabulary, kept_tokens = (int(x) for x in sums)

    def summarise(left: pa.Table, right: pa.Table) -> pa.Table:
        names = {"bucket": pa.int32(), "i2": pa.int32(), "i1": pa.int32(), "n": pa.int64(), "x2": pa.float64(), "x1": pa.float64()}
        if not left.num_rows:
            return pa.table({k: pa.array([], t) for k, t in names.items()})
        b = _Batch(left)
        c1, c2, context = b.estimates(b.answered(right, "kept"), kept_texts)
        uniform = kept_vocabulary + 1.0
        with np.errstate(divide="ignore", invalid="ignore"):
            x2 = np.where(c2 > 0, np.log2(c2 / np.maximum(context, 1) * uniform), np.nan)
            x1 = np.where(c1 > 0, np.log2(c1 / max(kept_tokens, 1) * uniform), np.nan)
        cell = lambda x: np.where(np.isnan(x), -4096, np.round(np.nan_to_num(x) * GRID)).astype(np.int64)
        group = (_bucket(context) << 32) | ((cell(x2) + 8192) << 16) | (cell(x1) + 8192)
        keys, of = np.unique(group, return_inverse=True)
        sums = [np.bincount(of, np.nan_to_num(x), len(keys)) for x in (x2, x1)]
        out = [keys >> 32, (keys >> 16) & 0xFFFF, keys & 0xFFFF, np.bincount(of, minlength=len(keys)), *sums]
        return pa.table({k: pa.array(x).cast(t) for (k, t), x in zip(names.items(), out)})

    def of_batches(wanted: str):
        here = _batches(rows.where(wanted), batches, deleted) if wanted else packed
        back = replies.where("batch >= 0" if not wanted else f"batch >= {batches}").select(
            "batch", "level", "range", *(["kept"] if wanted else ["every"]))
        return here.groupBy("batch").cogroup(back.groupBy("batch"))

    grid = of_batches(f"fold = {DELETED}").applyInArrow(
        summarise, "bucket int, i2 int, i1 int, n long, x2 double, x1 double")
    mean = lambda x, i: F.when(F.col(i) != 4096, F.sum(x) / F.sum("n")).alias(x)
    grid = grid.groupBy("bucket", "i2", "i1").agg(F.sum("n").alias("n"), mean("x2", "i2"), mean("x1", "i1")) \
        .orderBy("bucket", "i2", "i1").toArrow()
    mix = weights(grid)

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        names = {"key": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
                 "base_score": pa.float64(), "score": pa.float64()}
        if not left.num_rows:
            return pa.table({k: pa.array([], t) for k, t in names.items()})
        b = _Batch(left)
        c1, c2, context = b.estimates(b.answered(right, "every"), texts)
        w = mix[_bucket(context)]
        p = w[:, 0] * c2 / np.maximum(context, 1) + w[:, 1] * c1 / max(tokens, 1) + w[:, 2] / (vocabulary + 1.0)
        base = np.log10((c1 + 1.0) / (tokens + vocabulary + 1.0))
        each = [np.add.reduceat(x, b.first[:-1]) for x in ((c1 > 0).astype(np.int64), base, np.log10(p))]
        return pa.table({k: pa.array(x).cast(t) for (k, t), x in zip(
            names.items(), [b.key, b.fold == HELD_OUT, b.size, *each])})

    found = of_batches("").applyInArrow(
        apply, "key long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return found.select(F.col("key").alias(key), "held_out", "n_tokens", "n_known",
                        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")

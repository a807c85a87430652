"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and unlabelled texts (U) train a linear numpy classifier on the
presence of hashed words and word beginnings. The risk of a classifier f under class prior
``pi`` is estimated as ``pi * R_P(+) + max(0, R_U(-) - pi * R_P(-))`` (Kiryo et al., 2017):
U's risk as negatives is corrected by the share of positives inside U, and the correction
is kept from going below zero; where it would, the step goes back up (the paper's gradient
ascent on the negative part).

Three passes over the texts: feature support in P and in U (all learning rows), the bounded
training matrix, the scores. Only the training matrix is bounded (``max_positive`` confirmed
keys, about ``max_unlabelled`` rows, chosen by hash); support counts use every learning row and
every confirmed positive among them, and scores cover every row.

Defined results: a null or empty text has no feature and scores the bias; with no confirmed
toxic text to learn from every score is the class prior; an empty table gives no rows;
repeated rows are each scored; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from ..operators.joins import join_small
from .common import materialize, with_key

BITS = 20                          # feature space of 2**20
PREFIXES = (4, 5, 6, 7, 8)         # bytes; beginnings count only for longer words


@dataclass(frozen=True)
class Params:
    max_positive: int = 4096       # training rows: confirmed toxic
    max_unlabelled: int = 12288    # training rows: unlabelled
    features: int = 4096           # kept features (largest evidence)
    min_positive: int = 5          # least toxic texts with a feature
    min_ratio: float = 2.5         # least support ratio P : U
    caution: float = 1.5           # standard errors taken off the support in P first
    epochs: int = 500
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 17


@dataclass(frozen=True)
class Model:
    features: np.ndarray           # sorted feature ids
    weights: np.ndarray
    bias: float
    prior: float

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -60, 60)))


def features(column: pa.Array, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs of a string column, as two sorted arrays.

    ``kept`` (a boolean table over the feature space) keeps those features only."""
    w = T.word_column(column, T.NOT_ALNUM)
    low = np.uint64((1 << BITS) - 1)
    doc, size = w.doc, w.end - w.start
    head = T.head(w.data, w.start)                       # the first eight bytes of each word
    ids, docs = [T.hashes(w.data, w.start, w.end) & low], [doc]
    for k in PREFIXES:
        longer = size > k
        ids.append(T.mix((head[longer] & T.MASK[k]) + np.uint64(k)) & low)
        docs.append(doc[longer])
    ids, docs = np.concatenate(ids), np.concatenate(docs)
    if kept is not None:
        have = kept[ids]
        ids, docs = ids[have], docs[have]
    both = np.unique((docs.astype(np.uint64) << np.uint64(BITS)) | ids)
    return (both >> np.uint64(BITS)).astype(np.int64), (both & low).astype(np.int64)


def _table(kept: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << BITS, bool)
    table[kept] = True
    return table


def _support(rows: DataFrame) -> DataFrame:
    """feature, p, u: texts of P and of U that have it. rows: text, positive."""
    def count(batches):
        p, u = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for c in T.chunks(batches):
            doc, feature = features(c.column("text"))
            positive = np.asarray(c.column("positive").to_numpy(zero_copy_only=False), bool)
            p += np.bincount(feature[positive[doc]], minlength=1 << BITS)
            u += np.bincount(feature, minlength=1 << BITS)
        at = np.flatnonzero(u)
        for lo in range(0, len(at), 1 << 16):
            part = at[lo:lo + (1 << 16)]
            yield pa.record_batch([pa.array(part), pa.array(p[part]), pa.array(u[part])], ["feature", "p", "u"])

    parts = rows.mapInArrow(count, "feature long, p long, u long")
    return parts.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", params: Params = Params()) -> Model:
    """Train on ``docs`` (the learning rows) with the confirmed positives of ``labels``."""
    rows = with_key(docs, key, text)
    known = (labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
             .where("key is not null and y is not null").groupBy("key").agg(F.max("y").alias("y")))
    prior = known.agg(F.avg(F.when(F.col("y") == 1, 1.0).otherwise(0.0)).alias("m")).first()["m"]
    prior = float(min(max(prior or 0.0, 1e-3), 0.9))
    confirmed = materialize(known.where("y = 1").select("key", F.lit(True).alias("positive")), "confirmed")
    marked = (join_small(rows, confirmed, "key", stage=False)             # every confirmed positive
              .select("key", "text", F.coalesce("positive", F.lit(False)).alias("positive")))
    sizes = marked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("positive").cast("long")).alias("p")).first()
    n_u, n_p = int(sizes["n"] or 0), int(sizes["p"] or 0)
    empty = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))), prior)
    if not n_p:
        return empty
    # the support in P, less what chance may add, against what U's rate lets expect
    expected = (F.col("u") + 1.0) * (n_p / n_u)
    sure = F.col("p") - params.caution * F.sqrt("p")
    evidence = F.col("p") * F.log(F.col("p") / expected)
    best = (_support(marked.drop("key")).where((F.col("p") >= params.min_positive) & (sure >= params.min_ratio * expected))
            .orderBy(evidence.desc(), "feature").limit(params.features).select("feature").collect())
    kept = np.array(sorted(r["feature"] for r in best), np.int64)
    if not len(kept):
        return empty
    share = min(1.0, params.max_unlabelled / max(n_u, 1))
    order = F.xxhash64(F.col("key"), F.lit(params.seed))
    chosen = (marked.where("positive").select("key", "positive").distinct()
              .orderBy(order, "key").limit(params.max_positive))          # at most max_positive keys
    drawn = rows.join(F.broadcast(chosen), "key").select("key", "text", "positive").unionByName(
        rows.where(F.pmod(F.xxhash64("key", "text", F.lit(params.seed)), F.lit(1 << 20)) < int(share * (1 << 20)))
        .withColumn("positive", F.lit(False)))

    def matrix(batches):
        table = _table(kept)
        for c in T.chunks(batches):
            doc, feature = features(c.column("text"), table)
            ends = np.searchsorted(doc, np.arange(c.num_rows + 1))
            at = np.searchsorted(kept, feature)
            have = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))
            yield pa.record_batch([c.column("positive"), have], ["positive", "have"])

    sample = drawn.drop("key").mapInArrow(matrix, "positive boolean, have array<int>").toArrow()
    return train(sample.column("positive").to_numpy(), sample.column("have").combine_chunks(), kept, prior, params)


def train(positive: np.ndarray, have, kept: np.ndarray, prior: float, params: Params) -> Model:
    """nnPU risk minimised by Adam over presence lists (``have``: indices into ``kept``)."""
    if isinstance(have, pa.ChunkedArray):
        have = have.combine_chunks()
    sizes = np.diff(have.offsets.to_numpy())
    row, col = np.repeat(np.arange(len(sizes)), sizes), have.flatten().to_numpy().astype(np.int64)
    order = np.lexsort((col, row))                       # a fixed order whatever task came first
    row, col = row[order], col[order]
    positive = np.asarray(positive, bool)
    n_p, n_u = max(int(positive.sum()), 1), max(int((~positive).sum()), 1)
    w, b = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    sigmoid = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, params.epochs + 1):
        z = np.bincount(row, w[col], len(sizes)) + b
        s = sigmoid(z)
        as_negative = np.logaddexp(0, z)                 # logistic loss of calling the row clean
        negative_risk = as_negative[~positive].sum() / n_u - prior * as_negative[positive].sum() / n_p
        if negative_risk >= 0:
            g = np.where(positive, prior / n_p * ((s - 1) - s), s / n_u)
        else:                                            # over-fitted: undo the negative part
            g = np.where(positive, prior / n_p * s, -s / n_u)
        gw = np.bincount(col, g[row], len(w)) + params.decay * w
        gb = float(g.sum())
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        w = w - params.rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b = b - params.rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return Model(kept, w, b, prior)


def _scores(column: pa.Array, model: Model, table: np.ndarray) -> np.ndarray:
    margin = np.full(len(column), model.bias)
    if len(model.features):
        doc, feature = features(column, table)
        at = np.searchsorted(model.features, feature)
        margin += np.bincount(doc, model.weights[at], len(column))
    return model(margin)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row, score in 0..1."""
    def apply(batches):
        table = _table(model.features)
        for c in T.chunks(batches):
            yield pa.record_batch([c.column("key"), pa.array(_scores(c.column("text"), model, table))], ["key", "score"])

    rows = with_key(docs, key, text)
    return rows.mapInArrow(apply, f"key {rows.schema['key'].dataType.simpleString()}, score double") \
        .withColumnRenamed("key", key)


def where_clean(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores less than ``threshold``."""
    def apply(batches):
        table = _table(model.features)
        for c in T.chunks(batches, text):
            yield c.filter(pa.array(_scores(c.column(text), model, table) < threshold))

    return docs.mapInArrow(apply, docs.schema)

"""Ranked lexical search: exact inner products by sparse ball trees.

A document is a sparse vector of whole numbers, one per term: the term frequency saturated by
the document's length. A query holds its terms' weights. Their inner product is the score, in
64-bit whole numbers. Every task builds ball trees over blocks of its documents: a node has the
centroid of its vectors and, in each of several subspaces of terms, the radius around it, so

    score <= <query, centroid> + sum over subspaces of |query part| * radius

for all documents below. Bounds are rounded up by more than their floating-point error. A search
takes nodes best bound first and stops when the next bound is under the k-th best score so far;
leaves are scored in whole numbers. A query's first ``k``-th score comes from a bounded sample of
documents (any subset's k-th best is at most the whole table's), so most subtrees are never opened.
The result is exact whatever the sample, the trees or the blocks look like.

The query set is read in blocks of at most ``items`` queries and ``terms`` distinct terms (a query
with more is a block of its own); for each block the documents are read once and only the block's
terms are kept. Nothing of the documents reaches the driver but document counts of the block's
terms. Each task passes on at most k rows per query. Words are compared with the block's terms by
64-bit hash (of 10^10 different words, one is taken for one of 8192 terms with probability 4e-6).

Defined results: null texts have no term; documents without a term neither count nor match;
a query without a term or with terms of weight 0 only gets no row; each query row gets its own
ranks, also where rows repeat; documents are ranked by score, then key (null keys last); empty
tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .common import materialize, with_key

# bytes outside terms, A-Z being lower-cased before: all of ASCII but digits and letters
SEPARATOR = T.NOT_ALNUM
SATURATION = 1_000_000_000     # numerator, length factor and mixing of the score (fixed by the contract)
FREQUENCY, LENGTH = 1000, 12
FLAT, STEEP = 75, 25


@dataclass(frozen=True)
class Params:
    k: int = 20
    items: int = 1024          # queries of a block
    terms: int = 8192          # distinct terms of a block
    block: int = 4096          # documents of a tree
    leaf: int = 32             # documents of a leaf
    subspaces: int = 512
    sketch: int = 32           # dimensions in which a block is split
    sample: int = 4096         # documents that first floors come from, about
    seed: int = 5


@dataclass(frozen=True)
class Queries:
    """A block of queries: its terms, and per query the term numbers and their repeats."""

    number: np.ndarray
    vocabulary: list
    terms: list
    repeats: list

    def lookup(self):
        """Sorted hashes of the vocabulary and the term number of each."""
        h = np.array([T.hash_word(w) for w in self.vocabulary], np.uint64)
        order = np.argsort(h)
        return h[order], order


def terms_of(text: str | None) -> list[str]:
    w = T.word_column(pa.array([text or ""], pa.string()), SEPARATOR)
    return [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]


def query_blocks(queries: DataFrame, params: Params):
    """Blocks of (number, text) rows, read one after another from the driver's side."""
    number, terms, vocabulary = [], [], {}

    def block():
        ids = [np.unique([vocabulary[t] for t in ts], return_counts=True) for ts in terms]
        return Queries(np.array(number), list(vocabulary), [i for i, _ in ids], [n for _, n in ids])

    for row in queries.toLocalIterator():
        found = terms_of(row["text"])
        new = set(found) - set(vocabulary)
        if number and (len(number) >= params.items or len(vocabulary) + len(new) > params.terms):
            yield block()
            number, terms, vocabulary = [], [], {}
        if found:
            number.append(row["number"])
            terms.append(found)
            for t in found:
                vocabulary.setdefault(t, len(vocabulary))
    if number:
        yield block()


def vectors(docs: DataFrame, lookup) -> DataFrame:
    """(key, n, terms, tf) of each document (key, text) with a term: all its terms counted in
    ``n``, those of the block by number in ``terms``."""
    hashed, number = lookup

    def apply(batches):
        for c in T.chunks(batches):
            w = T.word_column(c.column("text"), SEPARATOR)
            h = T.hashes(w.data, w.start, w.end)
            at = np.minimum(np.searchsorted(hashed, h), len(hashed) - 1)
            mine = hashed[at] == h
            pairs, tf = np.unique(w.doc[mine] * len(hashed) + number[at[mine]], return_counts=True)
            doc = pairs // len(hashed)
            ends = np.searchsorted(doc, np.arange(c.num_rows + 1)).astype(np.int32)
            out = pa.record_batch([
                c.column("key"), pa.array(w.counts),
                pa.ListArray.from_arrays(pa.array(ends), pa.array((pairs % len(hashed)).astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int64)))], ["key", "n", "terms", "tf"])
            yield out.filter(pa.array(w.counts > 0))

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(apply, f"key {kind}, n long, terms array<int>, tf array<long>")


def frequencies(found: DataFrame, size: int) -> np.ndarray:
    """Documents with each term of the block."""
    def count(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(b.column("terms").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["term", "n"])

    got = found.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[got["term"].to_numpy()] = got["n"].to_numpy()
    return out


def weights(df: np.ndarray, n: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """The vector entry of each term frequency; ``n``: its document's terms."""
    m = FLAT + STEEP * n * docs // total
    return SATURATION * tf // (FREQUENCY * tf + LENGTH * m)


class BallTree:
    """Ball tree over sparse vectors of whole numbers: rows ``doc`` (ascending), ``term``, ``value``."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, size: int, params: Params = Params()):
        n = int(doc[-1]) + 1 if len(doc) else 0
        self.size = size
        self.spaces = min(params.subspaces, max(size, 1))
        levels = max(0, math.ceil(math.log2(max(n, 1) / params.leaf)))
        order = self._split(doc, term, value, n, levels, params)
        # leaves are equal runs of the ordered documents; level l has 2^l nodes
        self.levels = levels
        self.edges = np.round(np.linspace(0, n, (1 << levels) + 1)).astype(np.int64)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        new = np.lexsort((term, place[doc]))
        self.doc, self.term, self.value = place[doc][new], term[new], value[new]
        self.order = order
        self.starts = np.searchsorted(self.doc, np.arange(n + 1))
        self._balls(n)

    def _split(self, doc, term, value, n, levels, params):
        """Order of the documents: halved again and again along the direction between two far
        points, in a signed random sketch of the vectors. Any order gives right results."""
        rng = np.random.default_rng(params.seed)
        to, sign = rng.integers(0, params.sketch, self.size), rng.choice([-1.0, 1.0], self.size)
        flat = np.bincount(doc * params.sketch + to[term], sign[term] * value, minlength=n * params.sketch)
        points = flat.reshape(n, params.sketch)
        parts = [np.arange(n)]
        for _ in range(levels):
            halves = []
            for p in parts:
                x = points[p]
                a = x[((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax()]
                b = x[((x - a) ** 2).sum(axis=1).argmax()]
                at = np.argsort(x @ (b - a), kind="stable")
                halves += [p[at[:len(p) // 2]], p[at[len(p) // 2:]]]
            parts = halves
        return np.concatenate(parts) if n else np.zeros(0, np.int64)

    def _balls(self, n: int) -> None:
        """Centroid and radii of every node, level by level (node 1 is the root, 2i and 2i + 1
        are the children of i)."""
        nodes = 2 << self.levels
        self.centroid, self.radius = np.zeros((nodes, self.size)), np.zeros((nodes, self.spaces))
        space = np.arange(self.size) % self.spaces
        for level in range(self.levels + 1):
            edges = self.edges[::1 << (self.levels - level)]
            first, many = 1 << level, 1 << level
            count = np.diff(edges)
            node = np.repeat(np.arange(many), count)              # of each document
            at = node[self.doc]
            sums = np.bincount(at * self.size + self.term, self.value, minlength=many * self.size)
            c = sums.reshape(many, self.size) / np.maximum(count, 1)[:, None]
            own = np.zeros((many, self.spaces))
            for s in range(0, self.size, self.spaces):            # terms s.. fall in subspaces 0..
                part = c[:, s:s + self.spaces] ** 2
                own[:, :part.shape[1]] += part
            near = c[at, self.term]
            gap = np.bincount(self.doc * self.spaces + space[self.term], (self.value - near) ** 2 - near ** 2,
                              minlength=n * self.spaces).reshape(n, self.spaces)
            gap += own[node]
            self.centroid[first:first + many] = c
            full = np.flatnonzero(count)
            # entries are at most 10^6: sums of squares are off by far less than 1
            self.radius[first + full] = np.sqrt(np.maximum(np.maximum.reduceat(gap, edges[:-1][full], axis=0), 0) + 1.0)

    def search(self, terms: np.ndarray, weight: np.ndarray, k: int, floor: int, rank: np.ndarray):
        """The k best (document, score) with a score of at least ``floor``, over 0; equal scores by
        ``rank``. Also the number of documents scored."""
        best_doc, best_score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.order):
            return best_doc, best_score, 0
        floor = max(floor, 1)
        length = np.sqrt(np.bincount(terms % self.spaces, weight.astype(float) ** 2, minlength=self.spaces))
        used = np.flatnonzero(length)
        bound = self.centroid[:, terms] @ weight.astype(float) + self.radius[:, used] @ length[used]
        bound = (bound * (1 + 1e-9) + 1).tolist()                 # over any error of the sums above
        dense = np.zeros(self.size, np.int64)
        dense[terms] = weight
        open_, seen = [(-bound[1], 1)], 0
        while open_:
            high, node = heapq.heappop(open_)
            if -high < floor:
                break
            if node < 1 << self.levels:
                for child in (2 * node, 2 * node + 1):
                    if bound[child] >= floor:
                        heapq.heappush(open_, (-bound[child], child))
                continue
            lo, hi = self.edges[node - (1 << self.levels)], self.edges[node - (1 << self.levels) + 1]
            a, b = self.starts[lo], self.starts[hi]
            if a == b:
                continue
            seen += int(hi - lo)
            sums = np.concatenate([[0], np.cumsum(dense[self.term[a:b]] * self.value[a:b])])
            ends = self.starts[lo:hi + 1] - a
            score = sums[ends[1:]] - sums[ends[:-1]]
            good = np.flatnonzero(score >= floor)
            if len(good):
                best_doc = np.concatenate([best_doc, self.order[lo + good]])
                best_score = np.concatenate([best_score, score[good]])
                if len(best_doc) > k:
                    top = np.lexsort((rank[best_doc], -best_score))[:k]
                    best_doc, best_score = best_doc[top], best_score[top]
                if len(best_doc) == k:
                    floor = max(floor, int(best_score.min()))
        return best_doc, best_score, seen


def _blocks(batches, limit: int):
    """Tables of at most ``limit`` rows."""
    held, rows = [], 0
    for b in batches:
        at = 0
        while at < b.num_rows:
            part = b.slice(at, limit - rows)
            held.append(part)
            rows, at = rows + part.num_rows, at + part.num_rows
            if rows == limit:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _candidates(found: DataFrame, q: Queries, weight: np.ndarray, docs: int, total: int, floor: np.ndarray,
                params: Params) -> DataFrame:
    """(number, key, score, scored): each task's best of every query, not under the query's floor.
    ``scored``: documents that the query scored in the task, the same on each of its rows."""
    size = len(q.vocabulary)
    wanted = [(i, t[weight[t] > 0], (r * weight[t])[weight[t] > 0]) for i, (t, r) in enumerate(zip(q.terms, q.repeats))]

    def apply(batches):
        best: dict = {}                        # query -> (keys, scores, scored)
        for block in _blocks(batches, params.block):
            block = block.combine_chunks()
            keys = block.column("key").combine_chunks()
            lists = block.column("terms").combine_chunks()
            count = pc.list_value_length(lists).to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(keys)), count)
            tf = block.column("tf").combine_chunks().flatten().to_numpy()
            n = block.column("n").to_numpy()
            tree = BallTree(doc, lists.flatten().to_numpy().astype(np.int64), impacts(tf, n[doc], docs, total), size, params)
            rank = np.empty(len(keys), np.int64)
            rank[pc.sort_indices(keys, null_placement="at_end").to_numpy()] = np.arange(len(keys))
            for i, terms, w in wanted:
                before = best.get(i)
                least = int(floor[i])
                if before is not None and len(before[1]) == params.k:
                    least = max(least, int(before[1].min()))
                at, score, seen = tree.search(terms, w, params.k, least, rank)
                if not len(at):
                    if before is not None:
                        best[i] = (*before[:2], before[2] + seen)
                    continue
                got = keys.take(pa.array(at))
                if before is not None:
                    got = pa.concat_arrays([before[0], got])
                    score, seen = np.concatenate([before[1], score]), before[2] + seen
                order = pc.sort_indices(pa.table([got, pa.array(-score)], ["key", "score"]), null_placement="at_end",
                                        sort_keys=[("score", "ascending"), ("key", "ascending")])[:params.k]
                best[i] = (got.take(order), score[order.to_numpy()], seen)
        for i, (got, score, seen) in best.items():
            yield pa.record_batch([pa.array(np.full(len(score), q.number[i])), got, pa.array(score),
                                   pa.array(np.full(len(score), seen))], ["number", "key", "score", "scored"])

    kind = found.schema["key"].dataType.simpleString()
    return found.mapInArrow(apply, f"number long, key {kind}, score long, scored long")


def _first(rows: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, ranked."""
    w = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _floors(found: DataFrame, q: Queries, weight, docs: int, total: int, params: Params) -> np.ndarray:
    """Each query's k-th best score among a sample of the documents, 0 if it matches fewer."""
    few = found.where(F.rand(params.seed) < params.sample / docs) if docs > params.sample else found.limit(0)
    top = _first(_candidates(few, q, weight, docs, total, np.zeros(len(q.number), np.int64), params), params.k)
    last = top.groupBy("number").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") == params.k)
    out = np.zeros(len(q.number), np.int64)
    at = {int(x): i for i, x in enumerate(q.number)}
    for r in last.collect():                    # a row per query of the block at most
        out[at[r["number"]]] = r["s"]
    return out


def search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", params: Params = Params()) -> DataFrame:
    """(item, rank, key, score, scored) of each query's k best documents with a score over 0.
    ``scored``: the documents that the row's task scored for the query (the others were pruned)."""
    asked = materialize(queries.select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("text"),
                                       F.monotonically_increasing_id().alias("number")), "lexical-queries")
    rows, out = with_key(docs, key, text), None
    for q in query_blocks(asked.select("number", "text"), params):
        found = materialize(vectors(rows, q.lookup()), "lexical-vectors")
        size = found.agg(F.count("*").alias("docs"), F.sum("n").alias("total")).first()
        n, total = int(size["docs"]), int(size["total"] or 0)
        if not n:
            break
        weight = weights(frequencies(found, len(q.vocabulary)), n)
        floor = _floors(found, q, weight, n, total, params)
        part = materialize(_first(_candidates(found, q, weight, n, total, floor, params), params.k), "lexical-best")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = materialize(_first(rows.limit(0).select(F.lit(0).cast("long").alias("number"), "key", F.lit(0).cast("long").alias("score"),
                                                      F.lit(0).cast("long").alias("scored")), params.k), "lexical-best")
    return out.join(asked.select("number", "item"), "number").select(
        F.col("item").alias(item), "rank", F.col("key").alias(key), "score", "scored")

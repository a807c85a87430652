"""Approximate nearest neighbours by inner product, with an adaptive dimension scan.

Vectors lie in inverted lists (k-means on a bounded sample, every vector indexed). For the
scan they are turned by a fixed random rotation and laid out in blocks of columns. A query
visits its most promising lists; there the squared distance over the first columns estimates
the full one, and a hypothesis test abandons a candidate as soon as the estimate says that
it cannot reach the query's floor (ADSampling, Gao & Long, 2023): with p of d columns seen,
``partial * d / p > (1 + EPSILON / sqrt(p))**2 * limit``. Inner products are searched through
``|q - x|^2 = |q|^2 + |x|^2 - 2 q.x``: a candidate must reach the floor f, so its own limit is
``|q|^2 + |x|^2 - 2 f``. The floor is the k-th best of a bounded set of seeds (sample vectors
compared in full), never above the true k-th best; seeds are candidates too, so each query
finds ``min(k, candidates)`` rows at least. Survivors are scored exactly in double precision
on the original vectors.

Equal vectors are one candidate with its k + 1 smallest ids (no result can hold more of
them) and one query; the found ids are then given to every row that asked. The number of
probed lists is set from sample queries whose neighbours in the sample are known. Lists and
queries meet in cells of at most ``LIST_ROWS`` x ``QUERY_ROWS`` rows, so no list is one task.

Bounds: ``sample`` vectors train the lists, ``seeds`` of them give floors, at most ``lists``
lists. Defined results: rows whose id is null, or whose vector is null, empty, zero, of
another than the most common dimension, or holds a null or non-finite component, take no part;
ties go to the smaller id; repeated rows count once; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

EPSILON = 2.1                       # of the hypothesis test
BLOCK = 16                          # columns tested at once
LIST_ROWS, QUERY_ROWS = 4096, 512   # of a cell
SLACK = 1e-9                        # relative, for rounding
DENSE = 0.1                         # share of pairs up to which single pairs are followed


@dataclass(frozen=True)
class Params:
    sample: int = 16384
    seeds: int = 4096
    lists: int = 4096
    rounds: int = 8                 # of k-means
    recall: float = 0.95            # aimed at when the number of probes is set
    trial: int = 512                # sample queries for that
    seed: int = 3


@dataclass(frozen=True)
class Index:
    centre: np.ndarray              # lists x d
    rotation: np.ndarray            # d x d
    probes: int
    seed_vec: np.ndarray
    seed_ids: list                  # the ids of each seed


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec double array) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & \
        F.exists("vec", lambda x: x != 0)
    some = rows.select(F.col(key).cast("long").alias("id"), v.alias("vec")) \
        .where(F.col("id").isNotNull() & F.col("vec").isNotNull() & fine)
    sizes = some.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return some.where(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(rep, ids, vec): each vector once with its k + 1 smallest ids."""
    place = F.dense_rank().over(W.partitionBy("vec").orderBy("id"))
    return rows.withColumn("n", place).where(F.col("n") <= k + 1).groupBy("vec") \
        .agg(F.sort_array(F.collect_set("id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "ids", "vec")


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (centre**2).sum(axis=1) / 2
    for lo in range(0, len(x), 4096):
        out[lo:lo + 4096] = (x[lo:lo + 4096] @ centre.T - half).argmax(axis=1)
    return out


def train(vectors: DataFrame, k: int, params: Params = Params()) -> Index:
    """Lists, rotation, floor seeds and number of probes from at most ``params.sample`` vectors."""
    n = vectors.count()
    # about a quarter more than needed by hash, so that tasks pass on little before the limit
    bar = min(1.0, 1.25 * params.sample / max(n, 1))
    few = vectors.where(F.pmod(F.xxhash64("vec", F.lit(params.seed + 1)), F.lit(1 << 30)) < int(bar * (1 << 30)))
    drawn = few.orderBy(F.xxhash64("vec", F.lit(params.seed)), "rep").limit(params.sample).toArrow()
    x, random = _matrix(drawn["vec"]), np.random.default_rng(params.seed)
    if not len(x):
        return Index(np.zeros((1, 0)), np.zeros((0, 0)), 1, x, [])
    lists = int(max(1, min(params.lists, round(1.5 * n**0.5), len(x) // 16)))
    centre = x[random.permutation(len(x))[:lists]].copy()
    for _ in range(params.rounds):
        of = _nearest(x, centre)
        size = np.bincount(of, minlength=lists)
        for j in range(x.shape[1]):
            centre[:, j] = np.where(size > 0, np.bincount(of, x[:, j], lists) / np.maximum(size, 1), centre[:, j])
    of = _nearest(x, centre)
    # as many sample neighbours as reach as far as k neighbours among all rows
    near = max(1, min(k, -(-k * len(x) // n), len(x) - 1))
    needed = [0]
    for i in range(min(params.trial, len(x)) if len(x) > 1 else 0):
        score = x @ x[i]
        score[i] = -np.inf
        order = np.empty(lists, np.int64)
        order[np.argsort(-(centre @ x[i]), kind="stable")] = np.arange(lists)
        needed.extend(order[of[np.argpartition(-score, near - 1)[:near]]])
    probes = int(np.quantile(needed, params.recall)) + 1
    rotation = np.linalg.qr(random.normal(size=(x.shape[1], x.shape[1])))[0]
    seeds = min(params.seeds, len(x))
    return Index(centre, rotation, min(probes, lists), x[:seeds], drawn["ids"].to_pylist()[:seeds])


def _place(vectors: DataFrame, index: Index) -> DataFrame:
    """The index: every distinct vector with its list."""
    def apply(batches):
        for b in batches:
            if b.num_rows:
                of = _nearest(_matrix(b.column("vec")), index.centre)
                yield pa.record_batch([*b.columns, pa.array(of)], [*b.schema.names, "list"])

    return vectors.mapInArrow(apply, "rep long, ids array<long>, vec array<double>, list long")


FOUND = "array<struct<ids:array<bigint>,score:double>>"


def _ask(queries: DataFrame, index: Index, k: int) -> DataFrame:
    """Each distinct query with its floor, the lists to visit and its best seeds."""
    def apply(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                b = batch.slice(lo, 1024)
                q = _matrix(b.column("vec"))
                lists = np.argsort(-(q @ index.centre.T), axis=1, kind="stable")[:, :index.probes]
                floors, best = np.full(len(q), -np.inf), []
                score = q @ index.seed_vec.T
                top = min(k + 1, score.shape[1])
                pick = np.argpartition(-score, top - 1, axis=1)[:, :top]
                for i, x in enumerate(q):
                    exact = np.einsum("ij,j->i", index.seed_vec[pick[i]], x)
                    best.append([{"ids": index.seed_ids[s], "score": float(v)} for s, v in zip(pick[i], exact)])
                    others = exact[(index.seed_vec[pick[i]] != x).any(axis=1)]     # without the query's own vector
                    if len(others) >= k:
                        floors[i] = np.sort(others)[-k]
                yield pa.record_batch([
                    b.column("q"), b.column("vec"), pa.array(floors), pa.array(list(lists.astype(np.int64)), pa.list_(pa.int64())),
                    pa.array(best, pa.list_(pa.struct([("ids", pa.list_(pa.int64())), ("score", pa.float64())])))],
                    ["q", "vec", "floor", "lists", "best"])

    return queries.mapInArrow(apply, f"q long, vec array<double>, floor double, lists array<long>, best {FOUND}")


def scan(x: np.ndarray, q: np.ndarray, floor: np.ndarray, rotation: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) that the adaptive dimension scan does not abandon."""
    d = x.shape[1]
    blocks = [slice(lo, min(lo + BLOCK, d)) for lo in range(0, d, BLOCK)]
    xr, qr = x @ rotation, q @ rotation
    columns = [np.ascontiguousarray(xr[:, b]) for b in blocks]
    whole = (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None, :]
    limit = whole * (1 + SLACK) - 2 * np.where(np.isfinite(floor), floor, 0.0)[:, None]
    limit = np.where(np.isfinite(floor)[:, None], limit + SLACK * whole, np.inf)

    def test(partial, seen, bound):
        return partial * (d / seen) <= (1 + EPSILON / seen**0.5) ** 2 * bound

    alive, a, b, partial, seen = np.ones(whole.shape, bool), None, None, np.zeros(whole.shape), 0
    for block, column in zip(blocks, columns):
        seen += column.shape[1]
        if a is None:                                    # many pairs left: a whole block at once
            part = qr[:, block]
            partial += (part**2).sum(axis=1)[:, None] + (column**2).sum(axis=1)[None, :] - 2 * part @ column.T
            if seen < d:
                alive &= test(partial, seen, limit)
            if seen == d or np.count_nonzero(alive) < DENSE * alive.size:
                a, b = np.nonzero(alive)
                partial = partial[a, b]
        else:                                            # few: only those
            partial = partial + ((qr[a, block] - column[b]) ** 2).sum(axis=1)
            if seen < d:
                go = test(partial, seen, limit[a, b])
                a, b, partial = a[go], b[go], partial[go]
    return a, b


def _best(group: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each group."""
    order = np.lexsort((tie, -score, group))
    g = group[order]
    begin = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(begin, np.diff(np.append(begin, len(g))))
    return order[rank < k]


def search(rows: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding",
           params: Params = Params()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (same columns as ``rows``)
    its k nearest rows other than itself."""
    vectors = materialize(distinct_vectors(usable(rows, key, vector), k), "vectors")
    index = train(vectors, k, params)
    d = index.centre.shape[1]
    asked = queries.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    asked = usable(asked.where(F.size("vec") == d), "id", "vec").distinct()       # the index's dimension, not the queries' commonest
    named = asked.withColumn("h", F.xxhash64("vec"))
    single = named.groupBy("h", "vec").agg(F.min("id").alias("q"))
    asks = materialize(_ask(single.select("q", "vec"), index, k), "queries")
    placed = materialize(_place(vectors, index), "lists")

    def cells(df, size, name):
        """Lists cut into pieces of about ``size`` rows; (list, pieces) has a row per list."""
        return df.groupBy("list").count().select("list", F.ceil(F.col("count") / size).cast("int").alias(name))

    visits = asks.select("q", "vec", "floor", F.explode("lists").alias("list"))
    parts = F.broadcast(cells(placed, LIST_ROWS, "list_parts").join(cells(visits, QUERY_ROWS, "query_parts"), "list"))

    def cell(df, own, own_parts, other_parts, names):
        mine = F.pmod(F.xxhash64(own), F.col(own_parts)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1))
        return df.join(parts, "list").select(*[c for c in df.columns if c != "list"], "list", mine.alias(names[0]),
                                             other.alias(names[1]))

    left = cell(placed, "rep", "list_parts", "query_parts", ("i", "j"))
    right = cell(visits, "q", "query_parts", "list_parts", ("j", "i"))

    def apply(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (a.num_rows and b.num_rows):
            return pa.table({"q": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())),
                             "score": pa.array([], pa.float64())})
        x, q = _matrix(a["vec"]), _matrix(b["vec"])
        i, j = scan(x, q, b["floor"].to_numpy(), index.rotation)
        score = np.einsum("ij,ij->i", x[j], q[i])
        floor = b["floor"].to_numpy()[i]                 # what is below it cannot be among the k best
        reach = score >= np.where(np.isfinite(floor), floor - SLACK * np.abs(floor), -np.inf)
        i, j, score = i[reach], j[reach], score[reach]
        top = _best(i, score, a["rep"].to_numpy()[j], k + 1)
        return pa.table({"q": b["q"].take(pa.array(i[top])), "ids": a["ids"].take(pa.array(j[top])), "score": score[top]})

    from_lists = left.groupBy("list", "i", "j").cogroup(right.groupBy("list", "i", "j")) \
        .applyInArrow(apply, "q long, ids array<long>, score double")
    from_seeds = asks.select("q", F.explode("best").alias("b")).select("q", "b.ids", "b.score")
    found = from_lists.unionByName(from_seeds).select("q", F.explode("ids").alias("vec_id"), "score")
    # a candidate may be found in its list and among the seeds
    found = found.groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    order = [F.desc("score"), F.asc("vec_id")]
    found = found.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(*order))).where(F.col("n") <= k + 1)
    members = named.join(single, ["h", "vec"]).select(F.col("id").alias("query_id"), "q")
    out = members.join(found.drop("n"), "q").where("vec_id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(*order))
    return out.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Clustering and similarity (M-U1 … M-U10) on Spark.

* Standardisation and silhouettes are aggregate + join-back plans; the
  silhouette uses the squared-Euclidean decomposition (cluster sums of x and of
  ||x||^2), so each point is compared with k cluster summaries, never with
  other points — no pair of rows is ever materialised.
* K-Means runs all groups, values of k and restarts at once: each iteration is
  one pass over the rows in Arrow batches with per-task sums. PCA sums the covariances
  of all positions in one pass and solves each position's eigenproblem in a task.
* Similarity search broadcasts the single target vector and keeps the top k
  with ``orderBy().limit()``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators.joins import attach_scalars, join_small, scalars
from ..operators.stats import archetype_expr
from ..session import materialize

MAX_GROUPS = 1000      # groups that get models of their own
SLICE = 1024           # rows whose distances to all centres a task holds at once
INIT_ROWS = 2048       # different vectors of a group that K-Means starts are drawn from, about


def standardize(df: DataFrame, cols: list[str], part: list[str] | None = None,
                suffix: str = "") -> DataFrame:
    """M-U1: (x - mean) / population std per group; a 0-variance column is only centred."""
    part = list(part or [])
    stats = df.groupBy(*part).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                                  *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = join_small(df, stats, part, "left") if part else attach_scalars(df, stats)
    for c in cols:
        s = F.col(f"_s_{c}")
        scale = F.when(s > 0, s).otherwise(F.lit(1.0))
        j = j.withColumn(f"{c}{suffix}", (F.col(c) - F.col(f"_m_{c}")) / scale)
    return j.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def _vec(cols: list[str]):
    return F.array(*[F.col(c).cast("double") for c in cols])


def silhouette(df: DataFrame, cluster: str, cols: list[str], part: list[str] | None = None,
               out: str = "silhouette") -> DataFrame:
    """M-U3: mean silhouette per group with squared Euclidean distances.

    For a point x and a cluster C with n_C points, sum S_C and sum of squared
    norms Q_C, the mean squared distance is (n_C|x|^2 - 2 x.S_C + Q_C) / n_C
    (own cluster: divided by n_C - 1, excluding the point itself). A point in a
    singleton cluster, or on one spot with all others, scores 0; a group with one cluster (or all singletons)
    has no silhouette (NULL). Same definition as Spark's ClusteringEvaluator.
    """
    part = list(part or [])
    v = _vec(cols)
    pts = df.select(*part, F.col(cluster).alias("_c"), v.alias("_x"))
    return _silhouette(pts, part, len(cols), out)


def _silhouette(pts: DataFrame, part: list[str], dim: int, out: str = "silhouette") -> DataFrame:
    """:func:`silhouette` of points (part..., _c, _x: array of ``dim`` numbers)."""
    sq = F.aggregate("_x", F.lit(0.0), lambda acc, e: acc + e * e)
    pts = pts.withColumn("_xx", sq)
    summ = pts.groupBy(*part, "_c").agg(
        F.count("*").alias("_n"), F.sum("_xx").alias("_q"),
        F.array(*[F.sum(F.col("_x")[i]) for i in range(dim)]).alias("_s"))
    # k summaries per group, bounded by the number of clusters
    per_group = summ.groupBy(*part).agg(
        F.collect_list(F.struct("_c", "_n", "_q", "_s")).alias("_cl"),
        F.count("*").alias("_k"))
    j = join_small(pts, per_group, part, "inner") if part else attach_scalars(pts, per_group)

    def mean_sq(c):
        dot = F.aggregate(F.zip_with("_x", c["_s"], lambda a, b: a * b), F.lit(0.0),
                          lambda acc, e: acc + e)
        return c["_n"] * F.col("_xx") - 2 * dot + c["_q"]

    own = F.filter("_cl", lambda c: c["_c"] == F.col("_c"))[0]
    a = F.when(own["_n"] > 1, mean_sq(own) / (own["_n"] - 1))
    others = F.transform(F.filter("_cl", lambda c: c["_c"] != F.col("_c")),
                         lambda c: mean_sq(c) / c["_n"])
    b = F.array_min(others)
    s = F.when(own["_n"] <= 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.when(F.greatest(a, b) == 0, F.lit(0.0))))
    res = j.withColumn("_sil", s).groupBy(*part).agg(
        F.avg("_sil").alias(out), F.first("_k").alias("n_clusters"),
        F.count("*").alias("n_points"))
    # undefined for one cluster or one point per cluster (sklearn raises)
    ok = (F.col("n_clusters") > 1) & (F.col("n_clusters") < F.col("n_points"))
    return res.withColumn(out, F.when(ok, F.col(out)))


def best_k(sweep: DataFrame, part: list[str], k: str = "k", score: str = "silhouette") -> DataFrame:
    """M-U4: the k with the highest score per group, smallest k on ties."""
    return sweep.groupBy(*part).agg(
        F.max_by(F.col(k), F.struct(F.col(score), -F.col(k))).alias("best_k"),
        F.max(score).alias("best_silhouette"))


def fill_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL and NaN features -> 0, before anything is scaled."""
    return df.fillna(0.0, subset=cols)


def _groups(df: DataFrame, part: str, most: int = MAX_GROUPS) -> dict:
    """Rows by group, after checking that the groups are few (models are fitted for each)."""
    rows = df.groupBy(part).count().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{part} has over {most} groups; fit them in several calls")
    return {r[0]: r["count"] for r in rows}


def _points(df: DataFrame, cols: list[str], part: str) -> DataFrame:
    """A stage table (g, x): standardised features of every row, missing ones 0 before scaling. It is passed over
    very often, so it is dealt over the whole cluster however few files the table had."""
    z = standardize(fill_missing(df, cols), cols, [part], suffix="_std")
    z = z.select(F.col(part).alias("g"), _vec([f"{c}_std" for c in cols]).alias("x"))
    return materialize(z.repartition(2 * df.sparkSession.sparkContext.defaultParallelism), "points")


def _plus_plus(x: np.ndarray, k: int, rng, w: np.ndarray | None = None) -> np.ndarray:
    """k-means++ start from the rows of ``x``, which stand for ``w`` rows each."""
    w = np.ones(len(x)) if w is None else w
    at = [int(rng.choice(len(x), p=w / w.sum()))]
    d = ((x - x[at[0]]) ** 2).sum(axis=1)
    for _ in range(1, k):
        p = d * w
        at.append(int(rng.choice(len(x), p=p / p.sum()) if p.sum() > 0 else rng.integers(len(x))))
        d = np.minimum(d, ((x - x[at[-1]]) ** 2).sum(axis=1))
    return x[at].copy()


def start_sample(points: DataFrame, groups: list, seed: int = C.SEED, rows: int = INIT_ROWS) -> DataFrame:
    """(g, x, w): different vectors of each group of (g, x), about ``rows`` of them, with the rows that each
    stands for.

    Equal vectors are one candidate. Each is taken by its own hash with a probability that is half by its
    copies and half the same for all, so one vector with very many copies is in the sample and leaves
    room for the others; a group of fewer vectors than half of ``rows`` is taken whole. Nothing is sorted and no
    group meets in a task."""
    each = materialize(points.where(F.col("g").isin(list(groups))).groupBy("g", "x").agg(F.count("*").alias("w")), "vectors")
    size = each.groupBy("g").agg(F.sum("w").alias("rows"), F.count("*").alias("vectors"))
    p = F.least(F.lit(1.0), rows / 2 * (F.col("w") / F.col("rows") + 1 / F.col("vectors")))
    u = F.pmod(F.xxhash64("x", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return join_small(each, size, ["g"], "inner").withColumn("p", p).where(u < F.col("p")).select(
        "g", "x", (F.col("w") / F.col("p")).alias("w"))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assign(x: np.ndarray, centres: list[np.ndarray]):
    """Nearest centre and squared distance of each row, for every model."""
    size = (x**2).sum(axis=1)
    every = np.concatenate(centres)
    scores = x @ every.T - (every**2).sum(axis=1) / 2
    at = 0
    for c in centres:
        half = scores[:, at:at + len(c)]
        at += len(c)
        label = half.argmax(axis=1)
        yield label, np.maximum(size - 2 * half[np.arange(len(x)), label], 0.0)


def _by_group(batch, groups, column: str):
    """(group, row numbers) of the rows of ``groups`` in a batch."""
    kinds = batch.column(column).dictionary_encode()
    code = kinds.indices.fill_null(len(kinds.dictionary)).to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    names = kinds.dictionary.to_pylist()
    ends = np.searchsorted(code[order], np.arange(len(names) + 1))
    for i, g in enumerate(names):
        if g in groups:
            yield g, order[ends[i]:ends[i + 1]]


def _totals(points: DataFrame, centres: dict, dim: int, cost: bool = False) -> DataFrame:
    """(g, model, cluster, n, q, s0...): sums over all rows for every model (q: of squared norms), added up
    inside each task first. ``cost``: also that of squared distances. All models of a group and k share their
    matrix products, over SLICE rows at a time."""
    names = [*(["cost"] if cost else []), "n", "q", *(f"s{i}" for i in range(dim))]
    kinds: dict = {}                                       # by group and k: the models and their centres, the last column for |c|^2 / 2
    for g, ms in centres.items():
        for m, c in ms.items():
            kinds.setdefault(g, {}).setdefault(len(c), []).append(m)
    kinds = {g: [(k, ms, np.column_stack([every := np.concatenate([centres[g][m] for m in ms]), -(every**2).sum(axis=1) / 2]))
                 for k, ms in by_k.items()] for g, by_k in kinds.items()}

    def apply(batches):
        sums: dict = {}
        for b in batches:
            x = _matrix(b.column("x"))
            for g, mine in _by_group(b, centres, "g"):
                for lo in range(0, len(mine), SLICE):
                    rows = x[mine[lo:lo + SLICE]]
                    size, one = (rows**2).sum(axis=1), np.ones(len(rows))
                    known, turned = np.column_stack([one, size, rows]), np.vstack([rows.T, one])
                    for k, ms, every in kinds[g]:
                        score = (every @ turned).reshape(len(ms), k, len(rows))
                        top = score.max(axis=1)
                        hot = np.equal(score, top[:, None], out=score, casting="unsafe").reshape(-1, len(rows))
                        part = hot @ known
                        if part[:, 0].sum() != top.size:   # as near to several centres: the first
                            hot = (hot.reshape(score.shape) * (hot.reshape(score.shape).cumsum(axis=1) == 1)).reshape(hot.shape)
                            part = hot @ known
                        part = part.reshape(len(ms), k, -1)
                        if cost:
                            far = hot.reshape(score.shape) @ np.maximum(size - 2 * top, 0.0)[:, :, None]
                            part = np.concatenate([far, part], axis=2)
                        sums[g, k] = sums[g, k] + part if (g, k) in sums else part
        found = [(g, k, ms) for g, by_k in kinds.items() for k, ms, _ in by_k if (g, k) in sums]
        if found:                                          # one batch: models are many and columns too
            total = np.concatenate([sums[g, k].reshape(k * len(ms), -1) for g, k, ms in found])
            yield pa.record_batch([pa.array([g for g, k, ms in found for _ in range(k * len(ms))]),
                                   pa.array(np.concatenate([np.repeat(ms, k) for _, k, ms in found])),
                                   pa.array(np.concatenate([np.tile(np.arange(k), len(ms)) for _, k, ms in found])),
                                   *map(pa.array, total.T)], ["g", "model", "cluster", *names])

    kind = points.schema["g"].dataType.simpleString()
    parts = points.mapInArrow(apply, f"g {kind}, model long, cluster long, " + ", ".join(f"{c} double" for c in names))
    return parts.groupBy("g", "model", "cluster").agg(*[F.sum(c).alias(c) for c in names])


def _model_silhouettes(points: DataFrame, best: dict, dim: int) -> DataFrame:
    """(g, k, silhouette) of the models ``best`` ({(g, k): (centres, inertia)}): :func:`silhouette`'s definition, from
    one pass for the clusters' sums and one in which each task adds up its rows' scores."""
    centres: dict = {}
    for (g, k), (c, _) in best.items():
        centres.setdefault(g, {})[k] = c
    t = _totals(points, centres, dim).toArrow()            # groups x k x clusters rows at most
    sums = np.column_stack([t[c].to_numpy() for c in ("n", "q", *(f"s{i}" for i in range(dim)))])
    known = {g: {k: np.zeros((len(c), 2 + dim)) for k, c in ms.items()} for g, ms in centres.items()}
    for i, (g, k, c) in enumerate(zip(t["g"].to_pylist(), t["model"].to_pylist(), t["cluster"].to_pylist())):
        known[g][k][c] = sums[i]

    def scores(x: np.ndarray, label: np.ndarray, of: np.ndarray) -> np.ndarray:
        n, q, s = of[:, 0], of[:, 1], of[:, 2:]
        total = n * (x**2).sum(axis=1)[:, None] - 2 * x @ s.T + q       # squared distances to all of a cluster
        rows = np.arange(len(x))
        own = n[label]
        a = total[rows, label] / np.maximum(own - 1, 1)
        other = total / np.maximum(n, 1)
        other[:, n == 0] = np.inf
        other[rows, label] = np.inf
        b = other.min(axis=1)
        top = np.maximum(a, b)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where((own <= 1) | (top == 0), 0.0, (b - a) / top)

    def apply(batches):
        found: dict = {}
        for b in batches:
            x = _matrix(b.column("x"))
            for g, mine in _by_group(b, centres, "g"):
                rows, ks = x[mine], list(centres[g])
                for k, (label, _) in zip(ks, _assign(rows, [centres[g][k] for k in ks])):
                    some = (known[g][k][:, 0] > 0).sum()
                    if 1 < some < known[g][k][:, 0].sum():               # undefined for one cluster or one point per cluster
                        found[g, k] = found.get((g, k), 0.0) + scores(rows, label, known[g][k]).sum()
        for (g, k), s in found.items():
            yield pa.record_batch([pa.array([g]), pa.array([k], pa.int32()), pa.array([s / known[g][k][:, 0].sum()])], ["g", "k", "s"])

    kind = points.schema["g"].dataType.simpleString()
    return points.mapInArrow(apply, f"g {kind}, k int, s double").groupBy("g", "k").agg(F.sum("s").alias("silhouette"))


def kmeans_many(points: DataFrame, wanted: dict, dim: int, n_init: int, seed: int = C.SEED,
                max_iter: int = 100, tol: float = 1e-4) -> dict:
    """Lloyd's K-Means for many (group, k, restart) at once: {(group, k): (centres, inertia)} of
    the restart with the lowest inertia.

    ``wanted``: the values of k for each group. Every iteration is one pass over ``points``
    (g, x) for all models that still move; tasks send one row per model and cluster. Starts
    are k-means++ on a weighted sample of each group's different vectors (:func:`start_sample`).
    """
    drawn = start_sample(points, list(wanted), seed).orderBy("g", F.xxhash64("x", F.lit(seed)), "x").toArrow()
    labels, x, w = np.array(drawn["g"].to_pylist(), object), _matrix(drawn["x"].combine_chunks()), drawn["w"].to_numpy()
    centres: dict = {}
    spec: dict = {}
    for g, ks in wanted.items():
        mine, stand = x[labels == g], w[labels == g]
        rng = np.random.default_rng(seed)
        centres[g] = {}
        for k in ks:
            for _ in range(n_init):
                m = len(centres[g])
                spec[g, m] = k
                centres[g][m] = _plus_plus(mine, min(k, len(mine)), rng, stand)
    moving = {g: dict(c) for g, c in centres.items()}
    for _ in range(max_iter):
        moving = {g: c for g, c in moving.items() if c}
        if not moving:
            break
        t = _totals(points, moving, dim).toArrow()         # groups x models x k rows at most
        sums = np.column_stack([t[f"s{i}"].to_numpy() for i in range(dim)])
        n, cluster = t["n"].to_numpy(), t["cluster"].to_numpy()
        new = {g: {m: c.copy() for m, c in ms.items()} for g, ms in moving.items()}
        for i, (g, m) in enumerate(zip(t["g"].to_pylist(), t["model"].to_pylist())):
            if n[i] > 0:
                new[g][m][cluster[i]] = sums[i] / n[i]
        for g, ms in new.items():
            for m, c in ms.items():
                still = ((c - moving[g][m]) ** 2).sum(axis=1).max() > tol**2
                centres[g][m] = c
                if not still:
                    del moving[g][m]
                else:
                    moving[g][m] = c
    cost = _totals(points, centres, dim, True).groupBy("g", "model").agg(F.sum("cost").alias("cost")).collect()
    best: dict = {}
    for r in sorted(cost, key=lambda r: r["model"]):
        at = r["g"], spec[r["g"], r["model"]]
        if at not in best or r["cost"] < best[at][1] - 1e-9:
            best[at] = (centres[r["g"]][r["model"]], float(r["cost"]))
    return best


def k_sweep(df: DataFrame, cols: list[str], part: str | None = "position", ks=C.K_RANGE,
            n_init: int = 10, seed: int = C.SEED, min_rows: int = C.MIN_ROWS_TO_CLUSTER,
            euclidean: bool = False) -> DataFrame:
    """M-U2 / M-U10: for each k, K-Means with restarts; inertia and silhouette (of squared
    distances; ``euclidean``: the exact Euclidean one, which compares all rows of a group).

    Missing features count 0, then features are standardised per group (population
    std). Groups with fewer than ``min_rows`` rows are skipped. Returns (part, k,
    inertia, silhouette, best_k, is_best); without ``part`` all rows are one group and
    the result has no group column. All k and restarts of all groups share each pass
    over the rows, and one plan gives all silhouettes.
    """
    spark = df.sparkSession
    name = part or "_all"
    points = _points(df if part else df.withColumn("_all", F.lit("all")), cols, name)
    kind = points.schema["g"].dataType.simpleString()
    groups = [g for g, n in _groups(points, "g").items() if g is not None and n >= min_rows]
    schema = f"g {kind}, k int, inertia double"
    if not groups:
        sweep = spark.createDataFrame([], schema).withColumn("silhouette", F.lit(None).cast("double"))
    else:
        best = kmeans_many(points, {g: list(ks) for g in groups}, len(cols), n_init, seed)

        if euclidean:
            from .density import silhouette_points

            def label(batches):
                for b in batches:
                    x = _matrix(b.column("x"))
                    for g, rows in _by_group(b, groups, "g"):
                        mine = b.take(pa.array(rows))
                        for k, (c, _) in zip(ks, _assign(x[rows], [best[g, k][0] for k in ks])):
                            yield pa.record_batch([mine.column("g"), pa.array(np.full(len(rows), k), pa.int32()),
                                                   pa.array(c, pa.int32()), mine.column("x")], ["g", "k", "_c", "_x"])

            labelled = points.mapInArrow(label, f"g {kind}, k int, _c int, _x array<double>")
            sil = silhouette_points(labelled.withColumn("w", F.lit(1.0)), ["g", "k"], len(cols)).select("g", "k", "silhouette")
        else:
            sil = _model_silhouettes(points, best, len(cols))
        cost = spark.createDataFrame([(g, int(k), v[1]) for (g, k), v in best.items()], schema)
        sweep = cost.join(sil, ["g", "k"], "left")
    out = sweep.join(best_k(sweep, ["g"]), "g", "left") \
        .withColumn("is_best", F.col("k") == F.col("best_k")).drop("best_silhouette")
    return out.withColumnRenamed("g", part) if part else out.drop("g")


def cluster_by_position(df: DataFrame, cols: list[str], best: dict | DataFrame,
                        part: str = "position", n_init: int = 20, seed: int = C.SEED,
                        min_rows: int = C.MIN_ROWS_TO_CLUSTER) -> DataFrame:
    """M-U5: final K-Means per position at its best k; small positions get cluster -1.

    Cluster ids are canonicalised: by size descending, then by centre
    (lexicographic), so reruns give stable labels. Returns ``df`` with ``cluster``.
    """
    if isinstance(best, DataFrame):
        few = best.select(part, "best_k").distinct().limit(MAX_GROUPS + 1).collect()
        best = {r[part]: int(r["best_k"]) for r in few if r["best_k"] is not None}
    points = _points(df, cols, part)
    sizes = _groups(points, "g")
    wanted = {g: [k] for g, k in best.items() if sizes.get(g, 0) >= min_rows}
    if not wanted:
        return df.withColumn("cluster", F.lit(-1))
    found = kmeans_many(points, wanted, len(cols), n_init, seed)
    centres = {g: {0: found[g, k][0]} for g, (k,) in wanted.items()}
    size = {(r["g"], r["cluster"]): r["n"] for r in _totals(points, centres, len(cols)).select("g", "cluster", "n").collect()}
    for g, c in centres.items():
        order = sorted(range(len(c[0])), key=lambda i: (-size.get((g, i), 0), c[0][i].tolist()))
        centres[g] = c[0][order]
    z = standardize(fill_missing(df, cols), cols, [part], suffix="_std")
    row = df.columns

    def label(batches):
        for b in batches:
            x, out = _matrix(b.column("_x")), np.full(b.num_rows, -1)
            for g, rows in _by_group(b, centres, part):
                out[rows] = next(_assign(x[rows], [centres[g]]))[0]
            yield pa.record_batch([*[b.column(c) for c in row], pa.array(out, pa.int32())], [*row, "cluster"])

    wide = z.select(*row, _vec([f"{c}_std" for c in cols]).alias("_x"))
    schema = T.StructType([*df.schema.fields, T.StructField("cluster", T.IntegerType())])
    return wide.mapInArrow(label, schema)


def _principal(points: DataFrame, dim: int, n: int = 2) -> DataFrame:
    """(g, pc): the first ``n`` principal axes of every group of (g, x), one after another.

    One pass sums x and the upper triangle of x x' inside each task; the groups' sums are added by a
    partial aggregate and each group's symmetric eigenproblem is solved in a task of its own."""
    upper = np.triu_indices(dim)

    def sums(batches):
        total: dict = {}
        for b in batches:
            groups, x, arrow = b.column("g").to_pylist(), _matrix(b.column("x")), b.schema.field("g").type
            for g in set(groups):
                mine = x[[h == g for h in groups]]
                part = np.concatenate([[len(mine)], mine.sum(axis=0), (mine.T @ mine)[upper]])
                total[g] = total[g] + part if g in total else part
        for g, part in total.items():
            yield pa.record_batch([pa.array([g] * len(part), arrow), pa.array(np.arange(len(part))), pa.array(part)], ["g", "at", "s"])

    def solve(table: pa.Table) -> pa.Table:
        s = np.zeros(1 + dim + len(upper[0]))
        s[table.column("at").to_numpy()] = table.column("s").to_numpy()
        mean = s[1:1 + dim] / s[0]
        cov = np.zeros((dim, dim))
        cov[upper] = s[1 + dim:] / s[0]
        cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
        axes = np.linalg.eigh(cov)[1][:, ::-1][:, :n].T                    # largest variance first
        axes = np.concatenate([axes, np.zeros((max(n - dim, 0), dim))])
        sign = np.where(axes[np.arange(n), np.abs(axes).argmax(axis=1)] < 0, -1.0, 1.0)
        return pa.table({"g": table.column("g")[:1], "pc": pa.array([(axes * sign[:, None]).ravel().tolist()])})

    kind = points.schema["g"].dataType.simpleString()
    parts = points.mapInArrow(sums, f"g {kind}, at long, s double").groupBy("g", "at").agg(F.sum("s").alias("s"))
    return parts.groupBy("g").applyInArrow(solve, f"g {kind}, pc array<double>")


def embed_2d(df: DataFrame, cols: list[str], part: str = "position") -> DataFrame:
    """M-U6: 2-D PCA embedding per position (the reference's UMAP fallback).

    Each axis' sign is fixed so its largest-magnitude loading is positive. The covariances of all
    positions come from one pass; the axes are joined back as a small checked table. A position
    of one row, or of equal rows, lies at the origin; rows without a position have no place (NULL).
    """
    z = standardize(fill_missing(df, cols), cols, [part], suffix="_std")
    z = materialize(z.select(*df.columns, _vec([f"{c}_std" for c in cols]).alias("_x")), "embedding")
    axes = _principal(z.where(F.col(part).isNotNull()).select(F.col(part).alias("g"), F.col("_x").alias("x")), len(cols))
    axes = axes.select(F.col("g").alias("_g"), F.col("pc").alias("_pc"))
    out = join_small(z, axes, lambda side: z[part] == side["_g"], "left")
    dim = len(cols)
    along = lambda k: F.aggregate(F.zip_with("_x", F.slice("_pc", k * dim + 1, dim), lambda a, b: a * b),
                                  F.lit(0.0), lambda s, e: s + e)
    return out.select(*df.columns, along(0).alias("umap_x"), along(1).alias("umap_y"))


def archetypes(df: DataFrame, out: str = "archetype") -> DataFrame:
    """M-U7: archetype label of each row from its own z-score features."""
    return df.withColumn(out, archetype_expr("", cols_present=set(df.columns)))


def similar(df: DataFrame, name_col: str, target: str, cols: list[str], k: int = 5,
            order_col: str = "row_id", out: str = "similarity_distance") -> DataFrame:
    """M-U8: the k rows nearest (Euclidean, standardised space) to the target's first
    row; all rows of the target (case-insensitive name) excluded; unknown -> empty.

    Two bounded actions fetch the per-column mean / population std (2 numbers per
    feature) and the target's coordinates (one row); the scan then computes each
    row's distance as plain column arithmetic and keeps ``orderBy().limit(k)``.
    """
    df = fill_missing(df, cols)
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    mean = {c: stats[f"m_{c}"] for c in cols}
    scale = {c: stats[f"s_{c}"] if stats[f"s_{c}"] else 1.0 for c in cols}
    z = df.select("*", *[((F.col(c) - F.lit(mean[c])) / F.lit(scale[c])).alias(f"_z_{c}")
                         for c in cols])
    is_t = F.lower(F.col(name_col)) == F.lit(target.lower())
    t = z.where(is_t).orderBy(order_col).select(*[f"_z_{c}" for c in cols]).first()
    if t is None:
        return z.limit(0).withColumn(out, F.lit(None).cast("double")).drop(
            *[f"_z_{c}" for c in cols])
    sq = None
    for c in cols:
        d = F.col(f"_z_{c}") - F.lit(t[f"_z_{c}"])
        sq = d * d if sq is None else sq + d * d
    cand = z.where(~is_t | F.col(name_col).isNull()).withColumn(out, F.sqrt(sq))
    res = cand.orderBy(F.col(out), F.col(order_col)).limit(k)
    # standardised coordinates replace the raw ones, as in the reference's output space
    return res.select(*[F.col(f"_z_{c}").alias(c) if c in cols else F.col(c) for c in df.columns],
                      out)


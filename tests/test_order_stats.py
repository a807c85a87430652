"""Distributed order statistics vs pandas / brute force (hot group included)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scoutlens.models import metrics
from scoutlens.operators.order_stats import average_ranks, exact_quantiles, prefix_sums


def _frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    # one group holds ~80 % of the rows (hot key); values with ties and NULLs
    g = rng.choice(["hot", "b", "c"], n, p=[0.8, 0.15, 0.05])
    v = np.round(rng.normal(size=n), 1)
    v[rng.choice(n, 100, replace=False)] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v, "y": rng.integers(0, 2, n), "id": np.arange(n)})
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    return pdf, df


def test_quantiles_match_pandas(spark):
    pdf, df = _frame(spark)
    got = exact_quantiles(df.repartition(7), ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0]).toPandas()
    exp = pdf.groupby("g")["v"].quantile([0.0, 0.25, 0.5, 0.9, 1.0]).reset_index()
    exp.columns = ["g", "p", "q"]
    m = got.merge(exp, on=["g", "p"])
    assert len(m) == len(exp) == len(got)
    assert np.allclose(m.q_x, m.q_y)


def test_average_ranks_match_pandas(spark):
    pdf, df = _frame(spark)
    got = average_ranks(df, ["g"], "v").toPandas()
    pdf["r"] = pdf.groupby("g")["v"].rank(method="average")
    m = pdf.dropna().merge(got, on=["g", "v"])
    assert len(m) == pdf["v"].notna().sum()
    assert np.allclose(m.r, m.avg_rank)


def test_prefix_sums_descending_totals(spark):
    pdf, df = _frame(spark)
    ps = prefix_sums(df, [], "v", {"pos": F.col("y")}, descending=True).toPandas()
    d = pdf.dropna()
    for _, row in ps.sample(20, random_state=1).iterrows():
        above = d[d.v > row.v]
        assert row.n_lt == len(above)
        assert row.pos_lt == above.y.sum()
        assert row.n_eq == (d.v == row.v).sum()
    assert (ps.n_tot == len(d)).all()


def _brute_ap(y, s):
    order = np.argsort(-s, kind="stable")
    ys, ss = y[order], s[order]
    ap, tp, P = 0.0, 0, y.sum()
    i = 0
    while i < len(ss):
        j = i
        while j < len(ss) and ss[j] == ss[i]:
            j += 1
        tp_new = tp + ys[i:j].sum()
        prec = tp_new / j
        ap += (tp_new - tp) / P * prec
        tp = tp_new
        i = j
    return ap


def _brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    tot = 0.0
    for p in pos:
        tot += (neg < p).sum() + 0.5 * (neg == p).sum()
    return tot / (len(pos) * len(neg))


def test_ap_auc_pk_vs_brute_force(spark):
    rng = np.random.default_rng(3)
    n = 400
    y = rng.integers(0, 2, n)
    s = np.round(rng.random(n) + 0.3 * y, 2)   # ties on purpose
    pdf = pd.DataFrame({"y": y, "s": s, "id": np.arange(n)})
    df = spark.createDataFrame(pdf)
    ap = metrics.average_precision(df, "y", "s").first()[0]
    auc = metrics.roc_auc(df, "y", "s").first()[0]
    assert abs(ap - _brute_ap(y, s)) < 1e-12
    assert abs(auc - _brute_auc(y, s)) < 1e-12
    k = int(y.sum())
    top = pdf.sort_values(["s", "id"], ascending=[False, True]).head(k)
    pk = metrics.precision_at_k(df, "y", "s", "id").first()
    assert pk["k"] == k and abs(pk["precision_at_k"] - top.y.sum() / k) < 1e-12

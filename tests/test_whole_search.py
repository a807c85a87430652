"""The whole search: families of forests grown together, scores that travel in pieces, packed forests, full comparison."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scoutlens import config as C
from scoutlens.models import forest as R
from scoutlens.models import metrics
from scoutlens.models import supervised as S
from scoutlens.plans import q_models as Q


@pytest.fixture(scope="module")
def bins():
    rng = np.random.default_rng(11)
    x = rng.integers(0, 40, (900, 5)).astype(np.int8)
    return x, ((x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 12, 900)) > 38).astype(float), np.arange(900) * 3 + 1


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.default_rng(12)
    rows = [(i, f"g{i % 60}", float(a), float(b), int(a + rng.normal(0, 0.7) > 0.8)) for i, (a, b) in enumerate(rng.normal(0, 1, (600, 2)))]
    return spark.createDataFrame(rows, "row_id long, grp string, a double, b double, y int").repartition(3)


@pytest.mark.parametrize("nodes,first", [(4096, 0), (3, 40)])
def test_families_grown_together_are_those_grown_apart(bins, monkeypatch, nodes, first):
    """Every node of every family, and where other rows end, as when each family is grown by itself; rows are counted less often."""
    x, y, ids = bins
    monkeypatch.setattr(R, "NODES", nodes)
    found = R.families([R.Spec(i, fold=1, **p) for i, p in enumerate(R.draws(C.RF_GRID, 60))], 5)
    make = lambda: [R.Batch(f, first, min(3, f.num_trees - first)) for f, _ in found]
    apart = [R.grow(b, x[:700], y[:700], ids[:700]) for b in make()]
    together = make()
    ends = R.grow_together(together, x[:700], y[:700], ids[:700], x[700:])
    assert len(found) > 15
    for a, b, end in zip(apart, together, ends):
        inner = a.feature >= 0
        assert a.depth == b.depth and (a.feature == b.feature).all() and (a.value == b.value).all() and (a.rows == b.rows).all()
        assert (a.cut[inner] == b.cut[inner]).all() and (a.left[inner] == b.left[inner]).all()
        assert (a.walk(x[700:]) == end).all() and (b.walk(x[700:]) == end).all()


def test_one_class_and_few_rows_together(bins):
    x, y, ids = bins
    for n, of in ((900, np.zeros(900)), (1, y), (2, np.array([0.0, 1.0]))):
        batches = [R.Batch(R.Spec(0, 4, min_leaf=m), 0, 4) for m in (1, 2)]
        ends = R.grow_together(batches, x[:n], of[:n], ids[:n], x[:5])
        for b, end in zip(batches, ends):
            a = R.grow(R.Batch(b.spec, 0, 4), x[:n], of[:n], ids[:n])
            assert (a.feature == b.feature).all() and (a.value == b.value).all() and (end == a.walk(x[:5])).all()


def test_scores_travel_in_pieces(spark, df, monkeypatch):
    """One value for each forest, fold and hundred trees, not a row for each score; the precision is that of the rows."""
    cuts = R.cuts_of(df, ["a", "b"])
    rows = R.binned(metrics.grouped_folds(df, "grp", "y", 3), ["a", "b"], "y", cuts, "fold")
    specs = [R.Spec(i, n, d, fold=f) for i, (n, d) in enumerate([(5, 3), (250, 2)]) for f in range(3)]
    asked, pieces = [], R._pieces
    monkeypatch.setattr(R, "_pieces", lambda *a: asked.append(pieces(*a)) or asked[-1])
    got = {(r["forest"], r["fold"]): r["average_precision"] for r in R.cross_precision(rows, specs).collect()}
    assert asked[0].count() == 3 * (1 + 3)
    scores = R.cross_scores(rows, specs)
    want = {(r["forest"], r["fold"]): r["average_precision"] for r in metrics.average_precision(scores, "y", "p", ["forest", "fold"]).collect()}
    assert set(got) == set(want) and len(got) == 6
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)


def test_precision_at_hand(spark):
    rng = np.random.default_rng(13)
    y, p = rng.integers(0, 2, 300), np.round(rng.random(300), 1)
    rows = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    assert metrics.average_precision_at_hand(y, p) == pytest.approx(metrics.average_precision(rows, "y", "p").first()[0], abs=1e-12)
    assert metrics.average_precision_at_hand(np.zeros(3), p[:3]) is None and metrics.average_precision_at_hand(y[:0], p[:0]) is None


def test_forests_are_packed(spark, df, bins, monkeypatch):
    """A deep forest reaches the driver in a few bytes a node, without what only importances need, and scores the same however it is opened."""
    x, y, ids = bins
    one = R.grow(R.Batch(R.Spec(0, 20, 30), 0, 20), x, y, ids)
    walk, rest = one.pack(5)
    assert len(walk) < 4 * len(one.feature)
    back = R.Batch.unpack(walk, rest)
    inner = one.feature >= 0
    for name in ("feature", "value", "gain", "tree"):
        assert (getattr(back, name) == getattr(one, name)).all()
    assert (back.left[inner] == one.left[inner]).all() and (back.cut[inner] == one.cut[inner]).all()
    assert (R.Batch.unpack(walk).predict(x) == one.predict(x)).all()
    model = R.fit(df, ["a", "b"], "y", R.Spec(0, 12, 30))
    score = lambda: [r["p"] for r in model.transform(df).orderBy("row_id").select(vector_to_array("probability")[1].alias("p")).collect()]
    kept = score()
    monkeypatch.setattr(R, "KEPT", 0)
    monkeypatch.setattr(R, "CELLS", 100)
    assert score() == pytest.approx(kept, abs=1e-12) and model.trees == 12


def test_comparison_trains_whole_models(spark, df, monkeypatch):
    """The compared models have their full sizes, the search its whole grid, and the winner is calibrated as it was trained."""
    asked = []
    lr = S.train_lr
    said = lambda name: lambda x, cols, y, *a, **k: asked.append((name, a, k)) or lr(x, cols, y)
    monkeypatch.setattr(S, "train_rf", said("rf"))
    monkeypatch.setattr(S, "train_gbt", said("gbt"))
    monkeypatch.setattr(S, "train_forest", said("forest"))
    best = {"num_trees": 300, "max_depth": 12}
    search = spark.createDataFrame([("{'num_trees': 9}", False), (str(best), True)], "params string, is_best boolean")
    monkeypatch.setattr(S, "tuned_rf", lambda x, cols, y, group, *a, **k: asked.append(("search", a, k)) or (search, lr(x, cols, y)))
    monkeypatch.setattr(Q, "DF", ["a", "b"])
    rows = df.withColumnRenamed("grp", "group").withColumn("y", F.when(F.col("row_id") % 50 > 0, F.col("y")))    # twelve labels unknown
    monkeypatch.setattr(Q, "_d", lambda *_: rows)
    scores, train, learn, held = Q._out_of_fold(spark, "")
    assert asked == [("search", (), {}), ("rf", (), {}), ("gbt", (), {})]
    assert scores.select("model").distinct().count() == 4 and learn.count() + held.count() == 588 == learn.unionByName(held).where('y IS NOT NULL').count()
    for name in train:
        if train[name]:
            train[name](learn)
    assert asked[3:] == [("rf", (), {}), ("gbt", (), {}), ("forest", (), best)]


def test_folds_fitted_side_by_side(df):
    """Calibrations do not depend on how many folds are fitted at once."""
    fit = lambda x: S.train_rf(x, ["a", "b"], "y", num_trees=3, max_depth=3)
    one, many = ([(a, b) for _, a, b in S.fit_calibrated(df, ["a", "b"], "y", 3, train_fn=fit, at_once=n)] for n in (1, 3))
    assert len(one) == 3 and [v for f in one for v in f] == pytest.approx([v for f in many for v in f], rel=1e-6)


def test_a_tuned_forest_is_calibrated(df):
    """A forest's scoring leaves the other folds' probabilities alone, whatever a column is called."""
    fit = lambda x: S.train_forest(x, ["a", "b"], "y", num_trees=4, max_depth=3)
    fitted = S.fit_calibrated(df, ["a", "b"], "y", 3, train_fn=fit)
    rows = df.withColumn("_share", F.lit(7)).withColumn("_p1_own", F.lit(8))
    got = S.apply_calibrated(fitted, rows, ["a", "b"])
    assert len(fitted) == 3 and {"_share", "_p1_own"} <= set(got.columns) and "_share_" not in got.columns
    assert got.where("p_calibrated BETWEEN 0 AND 1 AND _share = 7").count() == 600

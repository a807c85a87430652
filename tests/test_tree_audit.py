"""Scores of tree ensembles repeated by DuckDB and by joins from the exported node table."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from scoutlens.models import audit
from scoutlens.models import supervised as S

COLS = ["a", "b", "c"]
WALK = """
WITH RECURSIVE w AS (
  SELECT d.id, d.x, n.* FROM d JOIN n ON n.node = 0
  UNION ALL
  SELECT w.id, w.x, n.* FROM w JOIN n ON n.tree = w.tree
    AND n.node = CASE WHEN w.x[CAST(w.feature AS BIGINT) + 1] <= w.threshold THEN w."left" ELSE w."right" END
  WHERE w.feature IS NOT NULL)
SELECT id, sum(value * weight) AS total, sum(weight) AS weights FROM w WHERE feature IS NULL GROUP BY id"""


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        a, b, c = rng.gauss(0, 1), float(rng.randint(0, 5)), rng.random()
        rows.append((i, a if i % 11 else None, b, c, (a + 0.3 * b + rng.gauss(0, 0.5) > 0.6)))
    rows += [(400, None, None, None, True), (401, 1e308, -1e308, 0.0, False)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y boolean").withColumn("node", F.lit("clash"))


@pytest.mark.parametrize("boosted", [False, True])
def test_node_table_repeats_the_scores(spark, data, boosted, tmp_path):
    model = S.train_gbt(data, COLS, "y", rounds=15, depth=3) if boosted else S.train_rf(data, COLS, "y", num_trees=12, max_depth=5)
    own = {r["id"]: r["p"] for r in S.positive_probability(model, data, COLS).select("id", "p").collect()}
    nodes = audit.node_table(model)
    assert nodes.count() > 12 and nodes.where("feature IS NOT NULL").count() < nodes.where("feature IS NULL").count()
    got = {r["id"]: r["p"] for r in audit.walk(nodes, data, COLS, "id", audit.depth(model), boosted).collect()}
    assert set(got) == set(own) and max(abs(got[i] - own[i]) for i in own) < 1e-6

    n = nodes.toPandas()                                   # noqa: F841 - read by DuckDB
    d = data.select("id", F.array(*[F.coalesce(c, F.lit(0.0)) for c in COLS]).alias("x")).toPandas()  # noqa: F841
    walked = duckdb.sql(WALK).df().set_index("id")
    score = 1 / (1 + (-2 * walked["total"]).map(math.exp)) if boosted else walked["total"] / walked["weights"]
    assert set(score.index) == set(own) and max(abs(score[i] - own[i]) for i in own) < 1e-6


def test_walk_sees_a_wrong_table(spark, data):
    model = S.train_rf(data, COLS, "y", num_trees=5, max_depth=4)
    nodes, levels = audit.node_table(model), audit.depth(model)
    own = {r["id"]: r["p"] for r in S.positive_probability(model, data, COLS).select("id", "p").collect()}
    wrong = nodes.withColumn("threshold", F.col("threshold") + 0.5)
    got = {r["id"]: r["p"] for r in audit.walk(wrong, data, COLS, "id", levels, False).collect()}
    assert max(abs(got[i] - own[i]) for i in own) > 1e-3
    assert audit.walk(nodes, data.limit(0), COLS, "id", levels, False).count() == 0

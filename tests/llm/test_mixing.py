"""Temperature mixing against DuckDB and against the definition, on skewed sources."""

import collections
import math
import os
import random
import sys

import duckdb
import pytest

from scoutlens.llm import mixing, queries

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
import oracle_check as OC  # noqa: E402


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(900):
        source = "hot" if i % 2 else f"s{rng.randint(0, 3)}" if i % 4 else "rare" if i % 80 == 0 else None
        out.append((i, rng.choice([" ".join(["w"] * rng.randint(0, 40)), "", "a\tb \n c"]), source, "x", "y"))
    out += [(950, None, "rare", "x", "y"), (951, "", "silent", "x", "y"), (952, None, "silent", "x", "y")]
    out += [(960, "twice the same", "s1", "x", "y")] * 2 + [(961, "same key", "s1", "x", "y"), (961, "other text", "s1", "x", "y")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    # further columns under names the operator uses itself
    return spark.createDataFrame(rows, "doc_id long, text string, source string, k string, c string")


def test_plan_matches_sql(spark, docs, tmp_path_factory, monkeypatch):
    folder = str(tmp_path_factory.mktemp("mix"))
    docs.write.parquet(f"{folder}/documents.parquet")
    got = queries.QUERIES["op8_mixing"](spark, folder).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    want = con.execute(queries.ORACLE["op8_mixing"]).df()
    assert 0 < want["alpha"].iloc[0] < 1 and want["epoch"].max() > 0
    assert OC.digest(OC.norm(got)) == OC.digest(OC.norm(want))


def shares(rows):
    tokens = collections.Counter()
    for _, text, source, *_ in rows:
        tokens[source] += len((text or "").split())
    return {s: n for s, n in tokens.items() if n}


@pytest.mark.parametrize(("target", "limit"), [(0.9, None), (None, 3.0), (0.99, 1.5), (0.0, None)])
def test_exponent_meets_its_targets(docs, rows, target, limit):
    tokens = shares(rows)
    whole = sum(tokens.values())
    chosen = mixing.plan(docs, target_entropy=target, max_repeat=limit).toPandas()
    a = chosen["alpha"].iloc[0]

    def weights(a):
        w = {s: (n / whole) ** a for s, n in tokens.items()}
        return {s: x / sum(w.values()) for s, x in w.items()}

    entropy = lambda a: -sum(x * math.log(x) for x in weights(a).values()) / math.log(len(tokens))
    repeat = lambda a: max(x * whole / tokens[s] for s, x in weights(a).items())
    if limit is not None:
        assert repeat(a) <= limit + 1e-4
    if target is not None and limit is None:
        assert entropy(a) >= target - 1e-5
    if 0 < a < 1:                                         # and no further from the shares than needed
        assert (target is not None and entropy(a + 1e-4) < target) or (limit is not None and repeat(a - 1e-4) > limit)


def test_budget_is_kept_and_passes_are_whole(docs, rows):
    tokens = shares(rows)
    whole = sum(tokens.values())
    chosen = mixing.plan(docs, target_entropy=0.97, max_repeat=None, budget=3 * whole).toPandas()
    chosen["source"] = chosen["source"].where(chosen["source"].notna(), None)
    assert "silent" not in set(chosen["source"].dropna())
    for source, part in chosen.groupby("source", dropna=False):
        source = None if not isinstance(source, str) else source
        quota = part["weight"].iloc[0] * 3 * whole
        assert quota - 1 <= part["n_tokens"].sum() <= quota + 45   # the last text may cross it
        last = part["epoch"].max()
        per_epoch = part.groupby("epoch")["n_tokens"].sum()
        assert (per_epoch[per_epoch.index < last] == tokens[source]).all()
        ordered = part.sort_values(["stream_at", "n_tokens"])
        assert (ordered["n_tokens"].cumsum().shift(fill_value=0) == ordered["stream_at"]).all()
    again = mixing.plan(docs.repartition(7), target_entropy=0.97, max_repeat=None, budget=3 * whole).toPandas()
    key = ["doc_id", "content", "epoch", "stream_at"]
    assert sorted(map(tuple, again[key].values.tolist())) == sorted(map(tuple, chosen[key].values.tolist()))


def test_mix_gives_rows_as_often_as_planned(docs):
    chosen = mixing.plan(docs).toPandas()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = collections.Counter(r["doc_id"] for r in mixed.collect())
    want = collections.Counter()
    for r in chosen.itertuples():
        want[r.doc_id] += r.rows
    assert got == want
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.plan(docs.limit(0)).count() == 0


def test_rows_without_a_key_spread_over_all_blocks(spark):
    n = 20 * mixing.BLOCK
    docs = spark.range(n).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'a' AS source", "concat('text number ', id) AS text")
    docs = docs.union(docs.where("text = 'text number 7'"))   # a repeated row is one unit of two rows
    chosen = mixing.plan(docs, target_entropy=None, max_repeat=None, budget=3 * n + 3)
    assert chosen.agg({"rows": "sum"}).first()[0] == n + 1
    units = mixing._units(docs, "doc_id", "source", "text")
    block = mixing.F.expr("pmod(conv(substring(md5(concat('7||', content)), 1, 8), 16, 10), 20)")
    sizes = [r["count"] for r in units.groupBy(block.alias("b")).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 1.2 * mixing.BLOCK


def test_order_of_blocks_is_the_order_of_their_draws(docs, monkeypatch):
    cols = ["doc_id", "content", "epoch", "stream_at"]
    monkeypatch.setattr(mixing, "BLOCK", 8)
    fine = sorted(map(str, mixing.plan(docs).select(cols).collect()))
    for digits in (1, 32):                                # 16 ranges; a range for each block
        monkeypatch.setattr(mixing, "RANGE", digits)
        assert sorted(map(str, mixing.plan(docs).select(cols).collect())) == fine


def test_no_python_in_the_plan(docs):
    text = mixing.plan(docs)._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text

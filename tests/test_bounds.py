"""Weight search by bounds, blocked Gram matrices, distinct sketches and early stopping by AUC, against the plain way."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom.operators import ensemble as ens
from scoreloom.operators import models, profile
from scoreloom.operators.bounds import auc_bounds, histogram, narrow
from scoreloom.operators.distinct import majority_shares, native_counts, single_valued, spread
from scoreloom.operators.gram import gram_corr_pairs
from scoreloom.operators.metrics import auc_by
from scoreloom.operators.rounds import best_round, first_rounds, leaf_values, stop_by_auc

MODELS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def tuples(spark):
    u = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 1000
    rows = spark.range(6000).select("id", (u(0) < 0.4).cast("int").alias("y"))
    rows = rows.select(
        "id", "y", (0.45 * u(1) + 0.25 * F.col("y") + 0.1).alias("a"), (0.6 * u(2) + 0.2 * F.col("y")).alias("b"),
        u(3).alias("c"), F.round(u(4) * 3 + F.col("y"), 0).alias("d"),
    )
    return rows.groupBy(*MODELS).agg(F.sum("y").alias("__pos"), F.count("*").alias("__n")).cache()


def test_bounds_hold_for_every_candidate(spark, tuples):
    grid = ens.simplex_grid(4, 0.25)
    exact = {r["candidate"]: r["auc"] for r in ens.search_on_tuples(tuples, MODELS).collect()}
    for bins in (16, 500):
        found = auc_bounds(histogram(tuples, MODELS, list(enumerate(grid)), 0.0, 4.0, bins)).collect()
        assert len(found) == len(grid)
        for r in found:
            assert r["low"] - 1e-12 <= exact[r["candidate"]] <= r["high"] + 1e-12


@pytest.mark.parametrize("step", [0.5, 0.25, 0.1])
def test_same_winner_with_few_ranked(tuples, step):
    best, left = ens.best_grid_point(tuples, MODELS, step)
    every = ens.search_on_tuples(tuples, MODELS, step).orderBy(F.desc("auc"), "candidate").first()
    assert best.first() == every
    grid = ens.simplex_grid(4, step)
    assert left.passes[0] == len(grid) and len(left.left) < max(5, len(grid) // 4)


def test_shuffled_rows_do_not_grow_with_the_grid(tuples):
    """A pass makes at most ``cells`` rows a task, whatever the number of candidates."""
    sizes = []
    for step in (0.25, 0.1):
        grid = ens.simplex_grid(4, step)
        rows = histogram(tuples, MODELS, list(enumerate(grid)), 0.0, 4.0, max(16, 8192 // len(grid))).count()
        sizes.append(rows)
        assert rows <= 8192
    assert sizes[1] < 2 * sizes[0]


def test_nothing_to_search(spark, tuples):
    none = tuples.where("a > 100")
    assert ens.best_grid_point(none, MODELS)[0].first() is None
    assert ens.best_weights(none, MODELS)[0] == dict.fromkeys(MODELS, 0.25)
    flat = tuples.select(*[F.lit(0.5).alias(m) for m in MODELS], "__pos", "__n")
    assert ens.best_grid_point(flat, MODELS)[0].first()["auc"] == 0.5
    assert narrow(flat, MODELS, ens.simplex_grid(4, 0.25)).passes == []


def test_gram_equals_pairwise_correlations(spark):
    draw = np.random.RandomState(3)
    x = draw.randn(500, 30) + draw.randn(500, 1)
    x[:, 5] = 7.0
    x[:, 6] = 1e9 + x[:, 7] * 1e-3
    table = [[None if draw.rand() < 0.2 and j != 6 else float(v) for j, v in enumerate(r)] for r in x]
    for r in table:
        r[9] = None
        r[11] = None if r[10] is not None else r[11]
    names = [f"v{j}" for j in range(30)]
    df = spark.createDataFrame(table, ", ".join(f"{n} double" for n in names)).repartition(6)
    got = {(r["a"], r["b"]): r["corr"] for r in gram_corr_pairs(df, names, block=8).collect()}
    assert len(got) == 435 and set(got) == {(r["a"], r["b"]) for r in profile.corr_pairs(df, names).collect()}
    for (a, b), corr in got.items():
        i, j = int(a[1:]), int(b[1:])
        both = np.array([(r[i], r[j]) for r in table if r[i] is not None and r[j] is not None])
        if len(both) < 2 or both.std(axis=0).min() == 0:
            assert corr is None
        else:
            assert corr == pytest.approx(abs(np.corrcoef(both.T)[0, 1]), abs=1e-6 if 6 in (i, j) else 1e-9)
    assert {r["corr"] for r in gram_corr_pairs(df.where("v0 > 1e12"), names, block=16).collect()} == {None}


def test_five_hundred_columns_in_one_scan(spark):
    df = spark.range(2000).select(*[(F.pmod(F.xxhash64("id", F.lit(j)), F.lit(1000)) + F.col("id") * (j % 5)).alias(f"v{j}") for j in range(500)])
    pairs = profile.corr_pairs(df, df.columns)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 2000") == 1
    assert pairs.count() == 124_750
    want = df.stat.corr("v3", "v8")
    assert pairs.where("a = 'v3' and b = 'v8'").first()["corr"] == pytest.approx(abs(want), abs=1e-9)


def test_distinct_counts_only_where_it_matters(spark):
    df = spark.range(20_000).select(
        "id", (F.col("id") % 3).alias("three"), (F.col("id") % 1000).alias("edge"), F.lit("x").alias("one"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") > 5, -0.0).otherwise(0.0).alias("zeros"), F.array("id").alias("list"), (F.col("id") % 12_000).cast("string").alias("text"),
    )
    found = spread(df, df.columns, lambda c, rows: [1005] if c == "edge" else [2, 0.9 * rows])
    assert found["edge"].exact and found["edge"].distinct == 1000
    assert not found["id"].exact and not found["text"].exact and 11_000 < found["text"].distinct < 13_000
    assert [found[c].distinct for c in ("one", "none", "zeros")] == [1, 0, 1]
    assert found["three"].distinct == 3
    counts = {r["column"]: r["n"] for r in native_counts(df, df.columns).groupBy("column").agg(F.count("value").alias("n")).collect()}
    assert counts["id"] == 20_000 and counts["none"] == 0 and counts["zeros"] == 1 and counts["list"] == 20_000
    assert set(single_valued(df, df.drop("list").columns)) == {"one", "none", "zeros"}


def test_types_by_sketch_are_those_by_count(spark):
    df = spark.range(30_000).select(
        "id", (F.col("id") % 2).alias("two"), (F.col("id") % 19).alias("nineteen"), (F.col("id") % 20).alias("twenty"),
        (F.col("id") % 1500).cast("string").alias("low_edge"), (F.col("id") % 1499).cast("string").alias("low"),
        (F.col("id") % 15_000).cast("string").alias("half"), F.col("id").cast("string").alias("unique"), F.lit(1).alias("one"),
        F.timestamp_seconds("id").alias("at"),
    )
    exact = {r["column"]: r["type"] for r in profile.feature_types(df).collect()}
    assert {r["column"]: r["type"] for r in profile.feature_types(df, exact=False).collect()} == exact
    assert len(set(exact.values())) >= 7


def test_majority_is_counted_not_estimated(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") < 9_900, "top").otherwise(F.col("id").cast("string")).alias("at_cut"),
        F.when(F.col("id") < 9_901, 5).otherwise(F.col("id")).alias("above"), "id",
        F.when(F.col("id") < 9_950, None).otherwise(F.col("id")).alias("missing"),
    )
    shares = majority_shares(df, df.columns, 0.99)
    assert shares == {"at_cut": None, "above": 0.9901, "id": None, "missing": None}
    assert profile.quasi_constant_columns(df, 0.99) == ["above"]
    assert profile.quasi_constant_columns(df, 0.98) == ["at_cut", "above"]
    with pytest.raises(ValueError):
        majority_shares(df, ["id"], 0.3)


@pytest.fixture(scope="module")
def boosted(spark):
    u = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 1000
    df = spark.range(1500).select("id", u(1).alias("a"), u(2).alias("b"), u(3).alias("c"))
    df = df.withColumn("y", (F.col("a") + 0.4 * u(4) + 0.8 * u(5) * F.col("b") > 1.0).cast("int")).cache()
    cols = models.Columns("id", "y", ("a", "b", "c"))
    train, held_out = (models.prepare_matrix(df.where(w), cols).cache() for w in ("id % 3 <> 0", "id % 3 = 0"))
    return models.fit("hgb", train, cols, {"max_iter": 24, "max_depth": 4, "learning_rate": 0.3}), held_out, cols


def test_stopping_round_is_that_of_a_loop(boosted):
    fitted, held_out, cols = boosted
    model = fitted.stages[-1]
    cut = {r: fitted.copy() for r in range(1, len(model.trees) + 1)}
    aucs = []
    for r in cut:
        part = type(fitted)([*fitted.stages[:-1], first_rounds(model, r)])
        aucs.append(auc_by(models.score(part, held_out, cols, ["y"]).withColumn("p", F.col("p")), "p", "y").first()["auc"])
    for patience in (2, 5, 50):
        best, stop = 0, len(aucs)
        for i, auc in enumerate(aucs):
            if auc > aucs[best]:
                best = i
            if i - best >= patience:
                stop = i + 1
                break
        chosen, seen = stop_by_auc(fitted, held_out, "y", patience)
        assert seen.best == best + 1 and len(chosen.stages[-1].trees) == best + 1
        assert list(seen.aucs[:stop]) == pytest.approx(aucs[:stop], abs=1e-12)
        assert len(seen.aucs) <= stop + patience


def test_leaf_values_add_up_to_the_margin(boosted):
    fitted, held_out, _ = boosted
    model = fitted.stages[-1]
    rows = model.copy().setLeafCol("leaf").transform(type(fitted)(fitted.stages[:-1]).transform(held_out)).limit(50).collect()
    values = leaf_values(model)
    for r in rows:
        assert sum(v[int(k)] for v, k in zip(values, r["leaf"])) == pytest.approx(r["rawPrediction"][1], abs=1e-9)


def test_best_round():
    assert best_round([0.5, 0.6, 0.6, 0.59], 2) == (2, True)
    assert best_round([None, 0.4, None], 5) == (2, False)
    draw = random.Random(1)
    for _ in range(50):
        aucs = [draw.random() for _ in range(30)]
        best, stopped = best_round(aucs, 6)
        assert aucs[best - 1] == max(aucs[: best - 1 + 7]) if stopped else aucs[best - 1] == max(aucs)

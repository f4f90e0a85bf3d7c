from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom.operators import ensemble as ens
from scoreloom.operators import select
from scoreloom.operators.folds import assign_folds


def wide_scores(n=300):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.5)
        good = 0.3 * y + rng.random()
        fair = 0.15 * y + rng.random()
        rows.append((str(i), y, round(good, 2), round(fair, 2), rng.random()))
    return rows


@pytest.fixture
def preds(spark):
    df = spark.createDataFrame(wide_scores(), "row_id string, y int, a double, b double, c double")
    return df.unpivot(["row_id", "y"], ["a", "b", "c"], "model", "p")


def brute_auc(y, p):
    y, p = np.array(y), np.array(p)
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def columns():
    rows = wide_scores()
    return [r[1] for r in rows], {m: np.array([r[i] for r in rows]) for m, i in (("a", 2), ("b", 3), ("c", 4))}


def test_weights_are_cleaned():
    assert ens.clean_weights({"a": -1, "b": 0}) == {"a": 0.5, "b": 0.5}
    assert ens.clean_weights({"a": -1, "b": 3, "c": 1}) == {"a": 0.0, "b": 0.75, "c": 0.25}
    assert ens.drop_light_models({"a": 0.96, "b": 0.04}) == {"a": 1.0}
    assert len(ens.simplex_grid(3, 0.25)) == 15 and all(abs(sum(g) - 1) < 1e-12 for g in ens.simplex_grid(4, 0.1))


def test_search_equals_brute_force(preds):
    y, cols = columns()
    found = ens.blend_weight_search(preds, ["a", "b", "c"], 0.5, ranges=3).collect()
    assert len(found) == 6
    for r in found:
        blend = r["w_a"] * cols["a"] + r["w_b"] * cols["b"] + r["w_c"] * cols["c"]
        assert r["auc"] == pytest.approx(brute_auc(y, blend), abs=1e-9)


def test_refined_weights_never_lose_to_the_grid(preds):
    tuples = ens.score_tuples(preds, ["a", "b", "c"])
    _, coarse = ens.best_weights(tuples, ["a", "b", "c"], 0.5, refine=0)
    weights, fine = ens.best_weights(tuples, ["a", "b", "c"], 0.5, refine=2)
    assert fine >= coarse and sum(weights.values()) == pytest.approx(1.0)


def test_greedy_equals_brute_force(preds):
    y, cols = columns()
    chosen, current = [], 0.0
    while len(chosen) < 3:
        rest = [m for m in cols if m not in chosen]
        auc = {m: brute_auc(y, sum(cols[x] for x in [*chosen, m]) / (len(chosen) + 1)) for m in rest}
        best = max(auc, key=auc.get)
        if auc[best] - current <= 1e-4:
            break
        chosen, current = [*chosen, best], auc[best]
    got = ens.greedy_select(preds, ["c", "b", "a"])
    assert [m for m, _ in got] == chosen and got[-1][1] == pytest.approx(current)
    assert ens.with_fallback(["a"], ["x", "y", "z", "w"]) == ["x", "y", "z"]


def test_ridge_equals_closed_form(spark, preds):
    y, cols = columns()
    matrix = ens.pred_matrix(preds, ["a", "b", "c"])
    folds = assign_folds(matrix.select("row_id", "y"), "row_id", 4, 42, "y").select("row_id", "fold")
    joined = matrix.join(folds, "row_id")
    full, per_fold = ens.fit_stack_ridge(joined, ["a", "b", "c"], alpha=10.0)
    x, t = np.column_stack([cols[m] for m in "abc"]), np.array(y, float)
    xc = x - x.mean(0)
    want = np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ (t - t.mean()))
    assert np.allclose(full.coefficients, want)
    assert full.intercept == pytest.approx(t.mean() - want @ x.mean(0))
    where = {r["row_id"]: r["fold"] for r in folds.collect()}
    keep = np.array([where[str(i)] != 0 for i in range(len(t))])
    xk, tk = x[keep], t[keep]
    xc = xk - xk.mean(0)
    part = np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ (tk - tk.mean()))
    assert np.allclose(per_fold[0].coefficients, part)
    assert ens.apply_stack_oof(joined, per_fold).where("p is null").count() == 0


def test_rank_blend_and_rescale(spark, preds):
    y, cols = columns()
    got = {r["row_id"]: r["p"] for r in ens.rank_average_minmax(preds).collect()}
    assert min(got.values()) == 0.0 and max(got.values()) == 1.0 and len(got) == len(y)
    flat = spark.createDataFrame([("1", 0.5), ("2", 0.5)], "row_id string, p double")
    assert {r["p"] for r in ens.rescale(flat).collect()} == {0.5}


def test_blend_weighted_ignores_missing_models_and_scores(spark):
    df = spark.createDataFrame(
        [("1", 0, "a", 0.2), ("1", 0, "b", 0.8), ("1", 0, "zz", 1.0), ("2", 1, "a", None), ("2", 1, "b", 0.6)],
        "row_id string, y int, model string, p double",
    )
    got = {r["row_id"]: r["p"] for r in ens.blend_weighted(df, {"a": 0.5, "b": 0.5}).collect()}
    assert got["1"] == pytest.approx(0.5) and got["2"] == pytest.approx(0.6)


def test_meta_ensemble_choice_applies_to_unseen_rows(preds):
    rows = preds.select("row_id", "y").distinct()
    folds = assign_folds(rows, "row_id", 5, 42, "y").select("row_id", "fold")
    for strategy in ("auto", "ridge_stacking", "rank_avg", "simple_avg", "weighted_avg"):
        choice, report = ens.meta_ensemble(preds, folds, ["a", "b", "c"], strategy, step=0.5, refine=0)
        assert report.count() == 4
        if strategy != "auto":
            assert choice.method == strategy
        out = ens.apply_ensemble(preds.drop("y"), choice)
        assert out.count() == 300 and out.where(F.col("p").isNull()).count() == 0


def test_diverse_selection_and_filtering(spark, preds):
    twin = preds.where("model = 'a'").withColumns({"model": F.lit("a2"), "p": F.col("p") * 3})
    got = ens.diverse_select(preds.unionByName(twin), ["a", "a2", "b", "c"], 2, 0.9).orderBy("rank").collect()
    assert [r["model"] for r in got] == ["a", "b"]
    bad = preds.where("model = 'a'").withColumns({"model": F.lit("bad"), "p": -F.col("p")})
    kept = ens.filter_models(preds.unionByName(bad), 0.5)
    assert "bad" not in ens.model_names(kept)


def test_correlation_pruning_counts_already_dropped_columns(spark):
    df = spark.range(50).select(
        F.col("id").alias("a"), (F.col("id") * 2).alias("b"), (F.col("id") * 2 + 1).alias("c"),
        F.pmod(F.col("id") * 7, F.lit(11)).alias("d"),
    )
    assert {r["column"] for r in select.correlated_columns(df, ["a", "b", "c", "d"]).collect()} == {"b", "c"}


def test_select_features_keeps_categories_and_caps(spark):
    df = spark.range(100).select(*[F.pmod(F.col("id") * (i + 2), F.lit(13 + i)).alias(f"f{i}") for i in range(5)],
                                 F.lit("x").alias("cat"))
    table = spark.createDataFrame([(f"f{i}", float(i)) for i in range(5)], "column string, avg_importance double")
    kept, report = select.select_features(df, [f"f{i}" for i in range(5)], ["cat", "cat"], table)
    assert kept == ["f1", "f2", "f3", "f4", "cat"] and report["final_features"] == 5
    top = select.select_by_importance(table, "avg_importance", 0.0, 2).collect()
    assert [r["column"] for r in top] == ["f4", "f3"]

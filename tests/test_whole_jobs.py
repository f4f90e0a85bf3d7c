"""The queries of whole jobs run them as declared, and rounds past the stop are not fitted."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from scoreloom.operators import models
from scoreloom.operators.rounds import fit_by_auc, round_steps, stop_by_auc
from scoreloom.plans import scoring
from scoreloom.suite import QUERIES


def test_steps_end_with_all_rounds():
    assert round_steps(800, 50) == [75, 300, 800] and round_steps(1000, 60) == [90, 360, 1000]
    for rounds in (1, 5, 74, 149, 150, 151, 600, 5000):
        for patience in (0, 1, 7, 50):
            steps = round_steps(rounds, patience)
            assert steps[-1] == rounds and steps == sorted(steps) and sum(steps) <= 1.7 * rounds


@pytest.fixture(scope="module")
def noisy(spark):
    u = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 1000
    df = spark.range(900).select("id", u(1).alias("a"), u(2).alias("b"), u(3).alias("c"))
    df = df.withColumn("y", (F.col("a") + 0.4 * u(4) + 0.8 * u(5) * F.col("b") > 1.0).cast("int")).coalesce(1)
    cols = models.Columns("id", "y", ("a", "b", "c"))
    return *(models.prepare_matrix(df.where(w), cols).cache() for w in ("id % 3 <> 0", "id % 3 = 0")), cols


@pytest.mark.parametrize("patience", [4, 30])
def test_a_fit_in_steps_is_the_whole_fit_cut_back(noisy, patience):
    train, held_out, cols = noisy
    sizes = []

    def fit(n):
        sizes.append(n)
        return models.fit("lgb", train, cols, {"n_estimators": n, "num_leaves": 8, "learning_rate": 0.2, "subsample": 0.8})

    trees = lambda m: [t.toDebugString.split("\n", 1)[1] for t in m.stages[-1].trees]
    whole, seen = stop_by_auc(fit(48), held_out, "y", patience)
    sizes.clear()
    assert trees(fit_by_auc(fit, 48, held_out, "y", patience)) == trees(whole)
    steps = round_steps(48, patience)
    assert sizes == [n for i, n in enumerate(steps) if i == 0 or steps[i - 1] < seen.best + patience]


def test_one_class_needs_one_fit(noisy):
    train, held_out, cols = noisy
    sizes = []

    def fit(n):
        sizes.append(n)
        return models.fit("lgb", train.where("y = 1"), cols, {"n_estimators": n})

    assert not isinstance(fit_by_auc(fit, 800, held_out, "y"), PipelineModel) and sizes == [75]


@pytest.fixture(scope="module")
def few_docs(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("few"))
    rows = [(i, "word " * (i % 9 + 1) + "7" * (i % 5), ("en", "de")[i % 2], f"s{i % 3}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.withColumn("n_chars", F.length("text")).write.parquet(f"{at}/documents.parquet")
    labels = spark.range(60).select(F.col("id").alias("doc_id"), ((F.col("id") % 9 > 4) != (F.col("id") % 7 == 0)).cast("int").alias("quality"))
    labels.write.parquet(f"{at}/labels.parquet")
    return at


def _asked(monkeypatch, **less):
    """What a job asks of each family; the fits themselves are of one round here."""
    asked, real = {}, models.oof_scores

    def oof_scores(family, train, cols, test, k, seeds=(42,), params=None, parallelism=4, **options):
        asked[family] = {"k": k, "seeds": tuple(seeds), "params": params, "stop": options["early_stop"], "patience": options.get("patience")}
        small = {**params, "n_estimators": 1, "max_depth": 1}
        return real(family, train, cols, test, **{"k": k, "seeds": seeds, **less}, params=small, parallelism=8, **options)

    monkeypatch.setattr(scoring, "oof_scores", oof_scores)
    return asked


def test_the_aggressive_query_runs_the_whole_job(spark, monkeypatch, few_docs):
    asked, steps, real = _asked(monkeypatch), [], scoring.best_weights
    monkeypatch.setattr(scoring, "best_weights", lambda t, names, step: steps.append(step) or real(t, names, step))
    assert QUERIES["aggressive"](spark, few_docs).count() == 90
    assert list(asked) == ["lgb", "xgb", "hgb", "cat"] and steps == [0.25]
    for family, got in asked.items():
        assert got == {"k": 5, "seeds": (42,), "params": scoring.AGGRESSIVE_PARAMS[family], "stop": "auc", "patience": 60}


def test_the_compete_query_runs_the_whole_job(spark, monkeypatch, few_docs):
    asked = _asked(monkeypatch, k=2, seeds=(42,))
    board = {r["candidate"] for r in QUERIES["compete"](spark, few_docs).collect()}
    assert board == {"lgb", "xgb", "cat", "hgb", "blend_all", "blend_top2"} and list(asked) == ["lgb", "xgb", "cat", "hgb"]
    for family, got in asked.items():
        assert (got["k"], got["seeds"], got["stop"]) == (5, (42, 101, 202), "auc")
        rounds = models.tree_settings(family, {**models.PRESETS[family], **got["params"]})
        assert rounds["maxIter"] == 800 and rounds["maxDepth"] >= 5 and rounds["stepSize"] == 0.05

"""Invariants of fits and whole jobs on labelled documents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import models, search
from scoreloom.operators.metrics import auc_by
from scoreloom.plans import scoring
from scoreloom.session import materialize
from scoreloom.sources.store import load_model, save_model
from scoreloom.suite import fixtures as fx
from scoreloom.suite.models import DOC_COLUMNS, SMALL

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    train, test, template = fx.doc_splits(spark, SF)
    return materialize(train, "docs"), materialize(test, "docs"), materialize(template, "docs")


def test_parameter_translation():
    assert models.tree_settings("lgb", {"n_estimators": 50, "num_leaves": 31, "colsample_bytree": 0.8, "subsample": 0.9,
                                        "learning_rate": 0.1, "min_child_samples": 20, "reg_alpha": 3}) == {
        "maxIter": 50, "maxDepth": 5, "featureSubsetStrategy": "0.8", "subsamplingRate": 0.9, "stepSize": 0.1,
        "minInstancesPerNode": 20,
    }
    assert models.tree_settings("rf", {"n_estimators": 9, "max_depth": 40, "max_features": None}) == {
        "numTrees": 9, "maxDepth": 30, "featureSubsetStrategy": "all"
    }
    assert models.seed_count(0, 4999) == 1 and models.seed_count(1, 10) == 10 and models.seed_count(0, 5000) == 10


def test_draws_are_seeded_and_inside_the_space():
    for family in search.SPACES:
        for variant in ("standard", "staged", "dataset"):
            space = search.search_space(family, variant)
            draws = search.draw_params(family, 5, 7, space)
            assert draws == search.draw_params(family, 5, 7, space) != search.draw_params(family, 5, 8, space)
            for draw in draws:
                for name, spec in space.items():
                    assert draw[name] in spec[1] if spec[0] == "choice" else spec[1] <= draw[name] <= spec[2]


def test_space_table_lists_every_parameter(spark):
    assert search.space_table(spark).count() == sum(len(s) for s in search.SPACES.values())


def test_policy_rules():
    assert search.policy_params({"n_samples": 500, "ratio": 0.1}, "xgb")["max_depth"] == 4
    assert search.policy_params({"n_samples": 500, "ratio": 0.01}, "lgb")["num_leaves"] == 15
    assert search.policy_params({"n_samples": 30000, "ratio": 0.0}, "rf")["max_depth"] == 20
    assert search.policy_params({"n_samples": 10000, "ratio": 0.0}, "hgb") == search.POLICY["hgb"]["base"]


@pytest.mark.parametrize("family", ["rf", "cat"])
def test_every_row_is_scored_once_and_well(spark, docs, family):
    train, test, _ = docs
    cols = models.Columns("row_id", "target", fx.DOC_NUMERIC, ("lang",) if family == "cat" else ())
    preds = models.oof_scores(family, train, cols, test, 3, (42,), SMALL[family])
    oof, unseen = preds.where("split = 'oof'"), preds.where("split = 'test'")
    assert oof.count() == oof.select("row_id").distinct().count() == train.count()
    assert unseen.count() == unseen.select("row_id").distinct().count() == test.count()
    assert preds.where("p < 0 or p > 1 or p is null").count() == 0
    assert auc_by(oof, "p", "y").first()["auc"] > 0.8


def test_two_seeds_are_averaged(spark, docs):
    train, _, _ = docs
    both = models.oof_scores("rf", train, DOC_COLUMNS, None, 2, (1, 2), SMALL["rf"])
    assert both.count() == train.count()


def test_single_class_scores_that_class(spark, docs):
    train, test, _ = docs
    for value in (0, 1):
        part = models.prepare_matrix(train.where(F.col("target") == value), DOC_COLUMNS)
        model = models.fit("hgb", part, DOC_COLUMNS, SMALL["hgb"])
        scored = models.score(model, models.prepare_matrix(test, DOC_COLUMNS), DOC_COLUMNS)
        assert {r["p"] for r in scored.select("p").distinct().collect()} == {float(value)}


def test_model_survives_saving(spark, docs, tmp_path):
    train, test, _ = docs
    ready = models.prepare_matrix(train, DOC_COLUMNS)
    model = models.fit("logistic", ready, DOC_COLUMNS, SMALL["logistic"])
    save_model(model, str(tmp_path / "m"))
    unseen = models.prepare_matrix(test, DOC_COLUMNS)
    a = models.score(model, unseen, DOC_COLUMNS).orderBy("row_id").collect()
    assert a == models.score(load_model(str(tmp_path / "m")), unseen, DOC_COLUMNS).orderBy("row_id").collect()


def test_zoo_records_failures_and_goes_on(spark, docs):
    train, _, _ = docs
    specs = {"rf": SMALL["rf"], "nothing": {}}
    preds, report, fitted = models.model_zoo(specs, train, DOC_COLUMNS, None, 2, refit=False)
    got = {r["model"]: r for r in report.collect()}
    assert got["rf"]["cv_auc"] > 0.8 and got["nothing"]["error"] and not fitted
    assert preds.count() == train.count()


def test_indexable_leaves_wide_categories_out(spark, docs):
    train, _, _ = docs
    wide = train.withColumn("code", F.col("row_id").cast("string"))
    assert models.indexable(wide, ["lang", "code"], 50) == ("lang",)


def test_balanced_job_publishes_every_template_row(spark, docs):
    train, test, template = docs
    done = scoring.balanced(train, test, template, k=2, overrides=SMALL)
    out = done.published
    assert out.count() == template.count() == out.select("row_id").distinct().count()
    assert out.where("target < 1e-6 or target > 1 - 1e-6 or target is null").count() == 0
    board = {r["candidate"]: r["auc"] for r in done.board.collect()}
    assert set(board) == {"lgb", "hgb", "blend"} and board[done.best] == max(board.values()) > 0.8


def test_staged_job_skips_a_failing_family(spark, docs, tmp_path):
    store = str(tmp_path / 'preds')
    done = scoring.compete(*docs, families=("hgb", "nothing"), fast_run=True, overrides=SMALL, store=store)
    assert "nothing" in done.notes and done.published.count() == docs[2].count()
    again = scoring.compete(*docs, families=("hgb",), fast_run=True, overrides=SMALL, store=store, done=("hgb",))
    assert again.published.count() == docs[2].count()
    assert again.board.where("candidate = 'hgb'").first()["auc"] == pytest.approx(
        done.board.where("candidate = 'hgb'").first()["auc"]
    )

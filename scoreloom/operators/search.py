"""Parameter policies, search spaces and cross-validated search."""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import replace
from functools import partial
from math import exp, log

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.folds import safe_folds
from scoreloom.operators.models import (
    FAMILY_ERRORS,
    FORESTS,
    Columns,
    Params,
    build_estimator,
    family_name,
    in_parallel,
    label_facts,
    prepare_matrix,
    tree_settings,
    with_ordered,
)
from scoreloom.session import materialize

# Search spaces as (kind, low, high) or ("choice", values).  "log" is a log-uniform float.
SPACES: dict[str, dict[str, tuple]] = {
    "lgb": {
        "n_estimators": ("int", 100, 500),
        "max_depth": ("int", 3, 12),
        "learning_rate": ("log", 0.01, 0.3),
        "num_leaves": ("int", 10, 100),
        "min_child_samples": ("int", 5, 50),
        "subsample": ("float", 0.6, 1.0),
        "colsample_bytree": ("float", 0.6, 1.0),
        "reg_alpha": ("log", 1e-3, 10.0),
        "reg_lambda": ("log", 1e-3, 10.0),
    },
    "xgb": {
        "n_estimators": ("int", 100, 500),
        "max_depth": ("int", 3, 10),
        "learning_rate": ("log", 0.01, 0.3),
        "subsample": ("float", 0.6, 1.0),
        "colsample_bytree": ("float", 0.6, 1.0),
        "min_child_weight": ("int", 1, 10),
        "gamma": ("float", 0.0, 5.0),
        "reg_alpha": ("log", 1e-3, 10.0),
        "reg_lambda": ("log", 1e-3, 10.0),
    },
    "cat": {
        "iterations": ("int", 200, 500),
        "depth": ("int", 4, 10),
        "learning_rate": ("log", 0.01, 0.3),
        "l2_leaf_reg": ("float", 1.0, 10.0),
        "border_count": ("int", 32, 255),
    },
    "rf": {
        "n_estimators": ("int", 100, 500),
        "max_depth": ("int", 5, 20),
        "min_samples_leaf": ("int", 1, 10),
        "max_features": ("choice", ("sqrt", "log2", None)),
    },
    "hgb": {
        "max_iter": ("int", 100, 500),
        "max_depth": ("int", 3, 15),
        "learning_rate": ("log", 0.01, 0.3),
        "min_samples_leaf": ("int", 10, 50),
        "l2_regularization": ("log", 1e-3, 10.0),
    },
    "logistic": {
        "C": ("log", 1e-3, 10.0),
        "penalty": ("choice", ("l1", "l2", "elasticnet")),
        "l1_ratio": ("float", 0.0, 1.0),
    },
}
SPACES["et"] = SPACES["rf"]

# Where the quick 3-fold tuner ("staged") and the per-dataset tuner ("dataset") differ.
SPACE_VARIANTS: dict[str, dict[str, dict[str, tuple]]] = {
    "staged": {
        "lgb": {"n_estimators": ("int", 300, 1500), "learning_rate": ("log", 0.01, 0.1),
                "num_leaves": ("int", 15, 127), "min_child_samples": ("int", 10, 100)},
        "xgb": {"n_estimators": ("int", 300, 1500), "learning_rate": ("log", 0.01, 0.1), "max_depth": ("int", 3, 8)},
        "cat": {"iterations": ("int", 300, 1500), "learning_rate": ("log", 0.01, 0.1), "depth": ("int", 4, 8)},
        "hgb": {"max_iter": ("int", 300, 1000), "learning_rate": ("log", 0.01, 0.1), "max_depth": ("int", 3, 8)},
    },
    "dataset": {
        "lgb": {"n_estimators": ("int", 100, 1000), "learning_rate": ("log", 0.01, 0.1)},
        "xgb": {"n_estimators": ("int", 100, 1000), "learning_rate": ("log", 0.01, 0.1)},
        "cat": {"iterations": ("int", 100, 1000), "learning_rate": ("log", 0.01, 0.1), "depth": ("int", 4, 8)},
        "hgb": {"max_iter": ("int", 100, 1000), "learning_rate": ("log", 0.01, 0.1), "max_depth": ("int", 3, 10),
                "min_samples_leaf": ("int", 5, 50)},
    },
}


def search_space(family: str, variant: str = "standard") -> dict[str, tuple]:
    """The declared space of a family, ``standard``, ``staged`` or ``dataset``."""
    family = family_name(family)
    return {**SPACES[family], **SPACE_VARIANTS.get(variant, {}).get(family, {})}

# Parameter policy per family.  "tiny" is below 1,000 rows, "small" below 5,000,
# "large" above 20,000; "wide" is more than 0.05 features per row and wins over size.
POLICY: dict[str, dict[str, Params]] = {
    "lgb": {
        "base": {"n_estimators": 500, "learning_rate": 0.05, "num_leaves": 31, "min_child_samples": 20,
                 "subsample": 0.8, "colsample_bytree": 0.8, "reg_alpha": 0.1, "reg_lambda": 0.1},
        "tiny": {"n_estimators": 200, "num_leaves": 15, "min_child_samples": 10, "reg_alpha": 1.0, "reg_lambda": 1.0},
        "small": {"n_estimators": 300, "num_leaves": 20, "min_child_samples": 15},
        "large": {"n_estimators": 1000, "num_leaves": 50, "min_child_samples": 30},
        "wide": {"colsample_bytree": 0.6, "reg_alpha": 1.0, "reg_lambda": 1.0},
    },
    "xgb": {
        "base": {"n_estimators": 500, "learning_rate": 0.05, "max_depth": 6, "subsample": 0.8,
                 "colsample_bytree": 0.8, "min_child_weight": 3, "reg_alpha": 0.1, "reg_lambda": 1.0},
        "tiny": {"n_estimators": 200, "max_depth": 4, "min_child_weight": 5, "reg_alpha": 1.0},
        "large": {"n_estimators": 1000, "max_depth": 8},
        "wide": {"colsample_bytree": 0.6, "max_depth": 4},
    },
    "cat": {
        "base": {"iterations": 500, "learning_rate": 0.05, "depth": 6, "l2_leaf_reg": 3.0},
        "tiny": {"iterations": 200, "depth": 4, "l2_leaf_reg": 10.0},
        "large": {"iterations": 1000, "depth": 8},
    },
    "hgb": {
        "base": {"max_iter": 500, "learning_rate": 0.05, "max_depth": 6, "min_samples_leaf": 20,
                 "l2_regularization": 1.0},
        "tiny": {"max_iter": 200, "max_depth": 4, "min_samples_leaf": 10, "l2_regularization": 10.0},
        "large": {"max_iter": 1000, "max_depth": 8},
    },
    "rf": {
        "base": {"n_estimators": 500, "max_depth": 15, "min_samples_split": 5, "min_samples_leaf": 2},
        "tiny": {"n_estimators": 200, "max_depth": 10, "min_samples_split": 10, "min_samples_leaf": 5},
        "large": {"n_estimators": 1000, "max_depth": 20},
    },
    "et": {
        "base": {"n_estimators": 500, "max_depth": 15, "min_samples_split": 5, "min_samples_leaf": 2},
        "tiny": {"n_estimators": 200, "max_depth": 10},
        "large": {"n_estimators": 1000, "max_depth": 20},
    },
}
SIZE_LIMITS = {"tiny": 1000, "small": 5000, "large": 20000}
WIDE_RATIO = 0.05


def policy_column(family: str, param: str, n: Column, ratio: Column) -> Column:
    """One policy parameter as an expression over a dataset summary."""
    rules = POLICY[family]
    tests = {
        "wide": ratio > WIDE_RATIO,
        "tiny": n < SIZE_LIMITS["tiny"],
        "small": (n >= SIZE_LIMITS["tiny"]) & (n < SIZE_LIMITS["small"]),
        "large": n > SIZE_LIMITS["large"],
    }
    options = [F.when(test, F.lit(float(rules[name][param]))) for name, test in tests.items()
               if param in rules.get(name, {})]
    return F.coalesce(*options, F.lit(float(rules["base"][param])))


def param_policy(summary: DataFrame, families: Sequence[str] = tuple(POLICY), keys: Sequence[str] = ()) -> DataFrame:
    """(keys, family, param, value) for every summarised dataset."""
    n, ratio = F.col("n_samples"), F.col("ratio")
    entries = [
        F.struct(F.lit(f).alias("family"), F.lit(p).alias("param"), policy_column(f, p, n, ratio).alias("value"))
        for f in families
        for p in POLICY[f]["base"]
    ]
    return summary.select(*keys, F.inline(F.array(*entries)))


def policy_params(summary_row: dict, family: str) -> Params:
    """The policy for one dataset as plain parameters."""
    rules, n = POLICY.get(family, {"base": {}}), summary_row["n_samples"]
    size = ("tiny" if n < SIZE_LIMITS["tiny"] else "small" if n < SIZE_LIMITS["small"]
            else "large" if n > SIZE_LIMITS["large"] else "medium")
    params = {**rules["base"], **rules.get(size, {})}
    return {**params, **rules.get("wide", {})} if summary_row["ratio"] > WIDE_RATIO else params


def run_policy(n: Column) -> dict[str, Column]:
    """Folds, rounds and seeds of a full and a fast staged run."""
    return {
        "folds": F.lit(5), "rounds": F.lit(800), "n_seeds": F.when(n < 5000, 3).otherwise(1),
        "fast_folds": F.lit(3), "fast_rounds": F.lit(300), "fast_seeds": F.lit(1),
    }


def param_gates(summary: DataFrame, n_text_columns: int = 0, keys: Sequence[str] = ()) -> DataFrame:
    """Regularisation gates of the baseline from the features-per-row ratio."""
    ratio = F.col("ratio")
    return summary.select(
        *keys,
        F.when(ratio >= 0.010, 1.0).otherwise(0.0).alias("l2"),
        F.when(ratio >= 0.030, 70).when(ratio >= 0.015, 50).otherwise(20).alias("min_rows"),
        F.when(F.lit(n_text_columns > 0) | (F.col("n_samples") >= 5000), 10).otherwise(1).alias("n_seeds"),
    )


def space_table(spark: SparkSession) -> DataFrame:
    """(family, param, kind, lo, hi, choices)."""
    rows = [
        (family, name, spec[0], None, None, [str(v) for v in spec[1]])
        if spec[0] == "choice"
        else (family, name, spec[0], float(spec[1]), float(spec[2]), None)
        for family, space in SPACES.items()
        for name, spec in space.items()
    ]
    return spark.createDataFrame(
        rows, "family string, param string, kind string, lo double, hi double, choices array<string>"
    )


def draw_params(family: str, n_trials: int, seed: int = 42, space: dict[str, tuple] | None = None) -> list[Params]:
    """Seeded random draws from a family's space."""
    rng = random.Random(seed)
    space = space or SPACES[family_name(family)]
    drawn = []
    for _ in range(n_trials):
        one: Params = {}
        for name, spec in space.items():
            if spec[0] == "int":
                one[name] = rng.randint(spec[1], spec[2])
            elif spec[0] == "float":
                one[name] = rng.uniform(spec[1], spec[2])
            elif spec[0] == "log":
                one[name] = exp(rng.uniform(log(spec[1]), log(spec[2])))
            else:
                one[name] = rng.choice(spec[1])
        drawn.append(one)
    return drawn


def hyper_search(
    family: str, train: DataFrame, cols: Columns, trials: Sequence[Params], k: int = 3, seed: int = 42,
    parallelism: int = 4,
) -> DataFrame:
    """(model, trial, params, score): mean k-fold AUC of each parameter set.

    Fits run on stored folds, a few at a time; the evaluator keeps every threshold and nothing is fitted again at the end.
    """
    folded, enc = safe_folds(prepare_matrix(train, cols), cols.id, cols.label, k, seed), None
    if cols.wide and family_name(family) == "cat":
        folded, _, cols, enc = with_ordered(materialize(folded, "search_folds"), cols, fold="fold", seed=seed)
    stored = materialize(folded, f"search_{family}", "fold")
    facts = label_facts(stored, cols.label)
    raw = "prediction" if family_name(family) == "ridge" else "rawPrediction"
    judge = BinaryClassificationEvaluator(labelCol=cols.label, rawPredictionCol=raw, numBins=0)

    def one(params: Params, fold: int) -> float:
        use = replace(cols, pick=enc.pick(fold)) if enc else cols
        estimator = build_estimator(family, use, params, seed, facts.n, facts.deviation)
        model = estimator.fit(stored.where(F.col("fold") != fold))
        return judge.evaluate(model.transform(stored.where(F.col("fold") == fold)))

    aucs = in_parallel([partial(one, params, fold) for params in trials for fold in range(k)], parallelism)
    rows = [
        (family, i, json.dumps(params, sort_keys=True), float(sum(aucs[i * k:(i + 1) * k]) / k))
        for i, params in enumerate(trials)
    ]
    return train.sparkSession.createDataFrame(rows, "model string, trial int, params string, score double")


def best_trial(trials: DataFrame) -> tuple[Params, float]:
    top = trials.orderBy(F.desc("score"), "trial").first()
    return json.loads(top["params"]), top["score"]


def tune_all(
    families: Sequence[str], train: DataFrame, cols: Columns, summary_row: dict, n_trials: int = 20, k: int = 3,
    seed: int = 42, spaces: dict[str, dict[str, tuple]] | None = None, search: bool = True,
    failures: dict[str, str] | None = None,
) -> dict[str, Params]:
    """Best parameters per family; the size policy stands in when a search fails or is switched off.

    What made a family's search fail is put into ``failures``.
    """
    chosen: dict[str, Params] = {}
    for family in families:
        if not search:
            chosen[family] = policy_params(summary_row, family)
            continue
        try:
            draws = draw_params(family, n_trials, seed, (spaces or {}).get(family))
            chosen[family], _ = best_trial(hyper_search(family, train, cols, draws, k, seed))
        except FAMILY_ERRORS as problem:  # same rule as the model zoo: one family must not end the run
            chosen[family] = policy_params(summary_row, family)
            if failures is not None:
                failures[family] = str(problem)[:500]
    return chosen


def mllib_settings(family: str, params: Params) -> dict[str, object]:
    """What a parameter set means for MLlib, for reports."""
    return tree_settings(family_name(family), params) if family_name(family) not in ("logistic", "ridge") else dict(params)


__all__ = ["FORESTS", "POLICY", "SPACES", "best_trial", "draw_params", "hyper_search", "mllib_settings",
           "param_gates", "param_policy", "policy_params", "run_policy", "space_table", "tune_all"]

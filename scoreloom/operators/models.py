"""Model families on ``pyspark.ml``: presets, fits and out-of-fold scoring.

Five boosting and forest families share two MLlib algorithms.  They stay different through depth,
step, sampling and feature view: ``cat`` sees indexed categories, all others numbers only.
Leaf-wise growth, ordered boosting and L1/L2 leaf terms have no MLlib counterpart and are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial, reduce
from math import ceil, log2

from pyspark.errors import IllegalArgumentException
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.scalar import category_text, finite_or_zero
from scoreloom.operators.distinct import spread
from scoreloom.operators.ensemble import fold_average
from scoreloom.operators.folds import assign_holdout, hash_positions, safe_folds
from scoreloom.operators.metrics import auc_by
from scoreloom.operators.ordered import OrderedEncoding, apply_totals, fit_ordered, ordered_rates
from scoreloom.operators.rounds import PATIENCE, fit_by_auc
from scoreloom.session import enable_checkpoints, materialize

Params = dict[str, object]

# Default parameters of each family.
PRESETS: dict[str, Params] = {
    "logistic": {"max_iter": 1000, "C": 1.0},
    "rf": {"n_estimators": 200, "max_depth": 10, "min_samples_leaf": 2},
    "et": {"n_estimators": 500, "max_depth": 15},
    "hgb": {"max_iter": 800, "learning_rate": 0.05, "max_depth": 6, "min_samples_leaf": 20},
    "lgb": {"n_estimators": 800, "learning_rate": 0.05, "num_leaves": 31, "min_child_samples": 20,
            "subsample": 0.9, "colsample_bytree": 0.9},
    "xgb": {"n_estimators": 800, "learning_rate": 0.05, "max_depth": 6, "subsample": 0.9, "colsample_bytree": 0.9},
    "cat": {"iterations": 800, "learning_rate": 0.05, "depth": 6},
    "ridge": {"alpha": 1000.0},
}
ALIASES = {"lightgbm": "lgb", "xgboost": "xgb", "catboost": "cat", "histgb": "hgb"}
BOOSTED = ("hgb", "lgb", "xgb", "cat")
FORESTS = ("rf", "et")
MAX_INDEXED_LEVELS = 256
MLLIB_MAX_DEPTH = 30
#: Values that a task of a boosted fit reads at least, in fits stopped by AUC: their rounds are many and short.
TASK_CELLS = 1_000_000
#: What a family's own data or parameters can cause.  Anything else, such as a lost executor or a full disk, ends the run.
FAMILY_ERRORS = (ValueError, IllegalArgumentException)


def family_name(name: str) -> str:
    return ALIASES.get(name, name)


def tree_settings(family: str, params: Params) -> dict[str, object]:
    """Translate library-style parameter names into MLlib's."""
    out: dict[str, object] = {}
    rounds = next((params[k] for k in ("n_estimators", "iterations", "max_iter") if k in params), None)
    if rounds is not None:
        out["numTrees" if family in FORESTS else "maxIter"] = int(rounds)
    depths = [int(params[k]) for k in ("max_depth", "depth") if params.get(k)]
    if "num_leaves" in params or "max_leaf_nodes" in params:
        depths.append(ceil(log2(int(params.get("num_leaves", params.get("max_leaf_nodes"))))))
    if depths:
        out["maxDepth"] = min(*depths, MLLIB_MAX_DEPTH)
    floors = [float(params[k]) for k in ("min_child_samples", "min_samples_leaf", "min_child_weight") if k in params]
    if floors:
        out["minInstancesPerNode"] = max(1, round(max(floors)))
    if "subsample" in params or "max_samples" in params:
        out["subsamplingRate"] = float(params.get("subsample", params.get("max_samples")))
    if "colsample_bytree" in params:
        share = float(params["colsample_bytree"])
        out["featureSubsetStrategy"] = "all" if share >= 1 else str(share)
    if "max_features" in params:
        out["featureSubsetStrategy"] = params["max_features"] or "all"
    gain = next((params[k] for k in ("gamma", "min_split_gain", "min_impurity_decrease") if k in params), None)
    if gain is not None:
        out["minInfoGain"] = float(gain)
    bins = next((params[k] for k in ("max_bins", "border_count") if k in params), None)
    if bins is not None:
        out["maxBins"] = int(bins)
    if "learning_rate" in params and family not in FORESTS:
        out["stepSize"] = float(params["learning_rate"])
    return out


@dataclass(frozen=True)
class Columns:
    """What a model reads."""

    id: str
    label: str
    numeric: tuple[str, ...]
    cats: tuple[str, ...] = ()
    weight: str | None = None
    #: Text columns with too many levels to index; the category-aware family reads their ordered target statistics.
    wide: tuple[str, ...] = ()
    #: Columns with such statistics (arrays, see ``ordered``), and the place of the value that a fit reads.
    ordered: tuple[str, ...] = ()
    pick: int = 0


class ConstantModel(Model):
    """Stands in when training rows hold a single class: scores exactly that class."""

    def __init__(self, value: float):
        super().__init__()
        self.value = value

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("p", F.lit(self.value))


def prepare_matrix(df: DataFrame, cols: Columns, keep: Sequence[str] = ()) -> DataFrame:
    """Only the columns a fit needs, with finite numbers and text categories."""
    extra = [c for c in (cols.label, cols.weight, *keep) if c and c in df.columns]
    return df.select(
        cols.id,
        *extra,
        *[finite_or_zero(F.col(f"`{c}`")).alias(c) for c in cols.numeric],
        *[category_text(F.col(f"`{c}`")).alias(c) for c in (*cols.cats, *cols.wide)],
        *[c for c in cols.ordered if c in df.columns],
    )


def with_ordered(
    train: DataFrame, cols: Columns, test: DataFrame | None = None, fold: str | None = None, seed: int = 42
) -> tuple[DataFrame, DataFrame | None, Columns, OrderedEncoding | None]:
    """Wide text columns replaced by their ordered target statistics in both splits.

    ``train`` and ``test`` are prepared matrices.  With ``fold`` every row carries a value per fold left out, so that one
    pass serves all fits of a cross-validation; ``with_pick`` chooses.
    """
    if not cols.wide:
        return train, test, cols, None
    suffix = f"__ots{seed}"
    enc = fit_ordered(train, cols.wide, cols.label, fold)
    train = ordered_rates(train, enc, cols.label, cols.id, fold, seed, suffix).drop(*cols.wide)
    if test is not None:
        test = apply_totals(test, enc, cols.id, suffix)
    named = replace(cols, wide=(), ordered=tuple(f"{c}{suffix}" for c in enc.columns), pick=enc.pick())
    return train, test, named, enc


def indexable(df: DataFrame, cats: Sequence[str], limit: int = MAX_INDEXED_LEVELS) -> tuple[str, ...]:
    """Categories few enough for tree splits; wider ones reach the model through their encodings."""
    if not cats:
        return ()
    found = spread(df, cats, lambda *_: [limit])
    return tuple(c for c in cats if found[c].distinct <= limit)


def build_estimator(
    family: str, cols: Columns, params: Params | None = None, seed: int = 42, n_rows: int | None = None,
    label_std: float | None = None, valid_col: str | None = None,
) -> Pipeline:
    """A pipeline that ends in column ``p``-producing scores of one family."""
    family = family_name(family)
    if family not in PRESETS:
        raise ValueError(f"unknown family {family}")
    merged = {**PRESETS[family], **(params or {})}
    stages: list[Estimator] = []
    inputs = list(cols.numeric)
    if family == "cat":
        for c in cols.cats:
            stages.append(
                StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc")
            )
            inputs.append(f"{c}__idx")
        if cols.ordered:
            picked = ", ".join(f"`{c}`[{cols.pick}] AS `{c}__{cols.pick}`" for c in cols.ordered)
            stages.append(SQLTransformer(statement=f"SELECT *, {picked} FROM __THIS__"))
            inputs += [f"{c}__{cols.pick}" for c in cols.ordered]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="__x", handleInvalid="error"))
    common = {"featuresCol": "__x", "labelCol": cols.label}
    if cols.weight:
        common["weightCol"] = cols.weight
    if family == "logistic":
        stages.append(StandardScaler(inputCol="__x", outputCol="__z", withMean=True))
        strength = merged.get("C")
        penalty = merged.get("penalty", "l2")
        mix = {"l1": 1.0, "elasticnet": float(merged.get("l1_ratio", 0.5))}.get(penalty, 0.0)
        # The scaler divides by the sample deviation; this makes the penalty that of population scaling.
        strength = 1.0 / (float(strength) * n_rows) if strength and n_rows else 0.0
        shrink = (n_rows - 1) / n_rows if n_rows else 1.0
        l1, l2 = strength * mix * shrink**0.5, strength * (1 - mix) * shrink
        stages.append(
            LogisticRegression(
                **{**common, "featuresCol": "__z"},
                maxIter=int(merged["max_iter"]),
                regParam=l1 + l2,
                elasticNetParam=l1 / (l1 + l2) if l1 + l2 else 0.0,
                standardization=False,
            )
        )
    elif family == "ridge":
        if n_rows is None or label_std is None:
            raise ValueError("ridge needs the row count and the label's population deviation")
        stages.append(StandardScaler(inputCol="__x", outputCol="__z", withMean=True))
        stages.append(
            LinearRegression(
                featuresCol="__z",
                labelCol=cols.label,
                solver="normal",
                standardization=False,
                elasticNetParam=0.0,
                regParam=float(merged["alpha"]) * label_std / n_rows * (n_rows - 1) / n_rows,  # as above
            )
        )
    elif family in FORESTS:
        settings = tree_settings(family, merged)
        if family == "et":
            settings = {"featureSubsetStrategy": "sqrt", **settings}
        stages.append(RandomForestClassifier(**common, seed=seed, bootstrap=family == "rf", **settings))
    elif family in BOOSTED:
        settings = tree_settings(family, merged)
        if family == "cat" and cols.cats:
            settings.setdefault("maxBins", MAX_INDEXED_LEVELS + 2)
        if valid_col:
            settings["validationIndicatorCol"] = valid_col
        stages.append(GBTClassifier(**common, seed=seed, **settings))
    else:
        raise ValueError(f"unknown family {family}")
    return Pipeline(stages=stages)


@dataclass(frozen=True)
class LabelFacts:
    """Rows and positives of a training set."""

    n: int
    pos: int

    @property
    def deviation(self) -> float:
        share = self.pos / self.n
        return (share * (1 - share)) ** 0.5


def label_facts(df: DataFrame, label: str) -> LabelFacts:
    row = df.agg(F.count("*"), F.count_if(F.col(label) == 1)).first()
    return LabelFacts(row[0], row[1])


def fold_facts(df: DataFrame, label: str, fold: str) -> dict[int, LabelFacts]:
    """Facts of the rows outside each fold, from one count per fold."""
    rows = df.groupBy(fold).agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos")).collect()
    n, pos = sum(r["n"] for r in rows), sum(r["pos"] for r in rows)
    return {r[fold]: LabelFacts(n - r["n"], pos - r["pos"]) for r in rows}


def fit(
    family: str, train: DataFrame, cols: Columns, params: Params | None = None, seed: int = 42,
    valid_col: str | None = None, facts: LabelFacts | None = None,
) -> Model:
    """Fit one family on a 0/1 label; a training set with one class yields that class as a constant score."""
    if facts is None:
        facts = label_facts(train if valid_col is None else train.where(~F.col(valid_col)), cols.label)
    if not facts.n:
        raise ValueError("no training rows")
    if facts.pos in (0, facts.n):
        return ConstantModel(float(facts.pos > 0))
    enable_checkpoints(train.sparkSession)
    estimator = build_estimator(family, cols, params, seed, facts.n, facts.deviation, valid_col)
    return estimator.fit(train)


def score(model: Model, df: DataFrame, cols: Columns, keep: Sequence[str] = ()) -> DataFrame:
    """(id, keep..., p): positive-class probability, or the raw prediction of a linear regression."""
    scored = model.transform(df)
    return scored.select(cols.id, *keep, _chance(scored).alias("p"))


def _chance(scored: DataFrame) -> Column:
    if "probability" in scored.columns:
        p = vector_to_array(F.col("probability"))[1]
    elif "prediction" in scored.columns:
        p = F.col("prediction")
    else:
        p = F.col("p")
    return p.cast("double")


def mean_score(models: Sequence[Model], df: DataFrame, cols: Columns) -> DataFrame:
    """(id, p): mean score of several models, taken in one scan and averaged inside the row."""
    out, names = df, []
    for i, model in enumerate(models):
        scored = model.transform(out)
        names.append(f"__p{i}")
        out = scored.select(*df.columns, *names[:-1], _chance(scored).alias(names[-1]))
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return out.select(cols.id, (total / len(names)).alias("p"))


def with_class_weights(df: DataFrame, label: str, out: str = "__weight") -> DataFrame:
    """Balanced weights n / (2 n_class) as a column; the two counts are driver scalars."""
    n1, n = df.agg(F.count_if(F.col(label) == 1), F.count("*")).first()
    if not n1 or n1 == n:
        return df.withColumn(out, F.lit(1.0))
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(n / (2.0 * n1))).otherwise(F.lit(n / (2.0 * (n - n1)))))


def in_parallel(tasks: Iterable[Callable[[], object]], parallelism: int) -> list:
    """Submit independent Spark jobs from a few driver threads."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(lambda task: task(), tasks))


def oof_scores(
    family: str, train: DataFrame, cols: Columns, test: DataFrame | None = None, k: int = 5,
    seeds: Sequence[int] = (42,), params: Params | None = None, parallelism: int = 4, fold_col: str | None = None,
    early_stop: bool | str = False, patience: int = PATIENCE,
) -> DataFrame:
    """k-fold out-of-fold scores, averaged over seeds, plus test scores averaged over folds and seeds.

    ``early_stop`` ends boosted fits on their held-out fold: ``"auc"`` keeps the round with the best AUC, once none has been
    better for ``patience`` rounds (``rounds``), True stops the fit when the loss falls by less than a hundredth.

    Returns the prediction table (model, split, row_id, y, p).  Rows are written once per seed, one
    folder per fold, so a fit reads its training folds and scoring reads the held-out folder only.  ``fold_col`` reuses existing fold numbers.
    """
    tasks: list[Callable[[], tuple[DataFrame, Model]]] = []
    unseen = None if test is None else prepare_matrix(test, cols)
    for seed in seeds:
        if fold_col:
            folded, name = prepare_matrix(train, cols, [fold_col]), fold_col
        else:
            folded, name = safe_folds(prepare_matrix(train, cols), cols.id, cols.label, k, seed), "fold"
        use, enc = cols, None
        if cols.wide and family_name(family) == "cat":
            folded, unseen, use, enc = with_ordered(materialize(folded, "wide_folds"), cols, unseen, name, seed)
        stored = materialize(folded, f"folds_{family}", name)
        facts = fold_facts(stored, cols.label, name)
        tasks += [
            partial(_one_fold, family, stored, replace(use, pick=enc.pick(f)) if enc else use, params, seed, name, f,
                    early_stop, facts[f], patience)
            for f in range(k)
            if f in facts
        ]
    done = in_parallel(tasks, parallelism)
    parts, models = [part for part, _ in done], [model for _, model in done]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    if len(seeds) > 1:
        stacked = fold_average(stacked, ["row_id", "y"])
    out = stacked.select(F.lit(family).alias("model"), F.lit("oof").alias("split"), "row_id", "y", "p")
    if test is not None:
        if cols.wide and family_name(family) == "cat":
            unseen = materialize(unseen, "wide_test")
        unseen = mean_score(models, unseen, cols).select(
            F.lit(family).alias("model"), F.lit("test").alias("split"), F.col(cols.id).alias("row_id"),
            F.lit(None).cast("int").alias("y"), "p",
        )
        out = out.unionByName(unseen)
    return materialize(out, f"preds_{family}")


def _one_fold(
    family: str, stored: DataFrame, cols: Columns, params: Params | None, seed: int, fold: str, number: int,
    early_stop: bool | str, facts: LabelFacts, patience: int = PATIENCE,
) -> tuple[DataFrame, Model]:
    held_out = F.col(fold) == number
    boosted = family_name(family) in BOOSTED
    if early_stop and early_stop != "auc" and boosted:
        model = fit(family, stored.withColumn("__valid", held_out), cols, params, seed, "__valid", facts)
    elif early_stop and boosted:
        rounds = tree_settings(family, {**PRESETS[family_name(family)], **(params or {})})["maxIter"]
        cells = facts.n * (len(cols.numeric) + len(cols.cats) + len(cols.ordered))
        rows = stored.where(~held_out).coalesce(max(1, ceil(cells / TASK_CELLS)))

        def begun(n: int) -> Model:
            return fit(family, rows, cols, {**(params or {}), "n_estimators": n}, seed, facts=facts)

        model = fit_by_auc(begun, rounds, stored.where(held_out), cols.label, patience)
    else:
        model = fit(family, stored.where(~held_out), cols, params, seed, facts=facts)
    out = score(model, stored.where(held_out), cols, [cols.label]).select(
        F.col(cols.id).alias("row_id"), F.col(cols.label).cast("int").alias("y"), "p"
    )
    return out, model


def model_zoo(
    specs: dict[str, Params], train: DataFrame, cols: Columns, test: DataFrame | None = None, k: int = 5,
    seed: int = 42, refit: bool = True, balanced: bool = True, parallelism: int = 4,
) -> tuple[DataFrame, DataFrame, dict[str, Model]]:
    """Out-of-fold scores of several families, full refits, and a (model, cv_auc, error) table.

    A family that fails is recorded and skipped.  With ``refit`` the test scores come from the fit on
    all rows instead of the fold average.
    """
    balanced_cols = cols
    if balanced:
        train = with_class_weights(train, cols.label)
        balanced_cols = replace(cols, weight="__weight")
    folded = safe_folds(prepare_matrix(train, balanced_cols), cols.id, cols.label, k, seed)
    stored = materialize(folded, "zoo")
    preds, report, fitted = None, [], {}
    for name, params in specs.items():
        family = params.get("family", name)
        extra = {p: v for p, v in params.items() if p != "family"}
        use = cols if family_name(family) == "ridge" else balanced_cols
        try:
            scores = oof_scores(family, stored, use, None if refit else test, k, [seed], extra, parallelism, "fold")
            if refit:
                ready = None if test is None else prepare_matrix(test, use)
                rows = stored
                if family_name(family) == "cat":
                    rows, ready, use, _ = with_ordered(stored, use, ready, seed=seed)
                    rows = materialize(rows, "zoo_wide") if use.ordered else rows
                fitted[name] = fit(family, rows, use, extra, seed)
                if test is not None:
                    full = score(fitted[name], ready, use).select(
                        F.lit(family).alias("model"), F.lit("test").alias("split"),
                        F.col(cols.id).alias("row_id"), F.lit(None).cast("int").alias("y"), "p",
                    )
                    scores = scores.unionByName(full)
        except FAMILY_ERRORS as problem:  # a failed family is a row of the report, not the end of the run
            report.append((name, None, str(problem)[:500]))
            continue
        scores = scores.withColumn("model", F.lit(name))
        cv = auc_by(scores.where(F.col("split") == "oof"), "p", "y").first()["auc"]
        report.append((name, cv, None))
        preds = scores if preds is None else preds.unionByName(scores)
    table = train.sparkSession.createDataFrame(report, "model string, cv_auc double, error string")
    return preds, table, fitted


def holdout_fit(
    family: str, train: DataFrame, cols: Columns, test: DataFrame, params: Params | None = None, seed: int = 42
) -> tuple[float | None, DataFrame]:
    """Safety baseline: one stratified 80/20 fit, its validation AUC and the test scores."""
    marked = materialize(assign_holdout(prepare_matrix(train, cols), cols.id, 0.2, seed, cols.label), "holdout")
    model = fit(family, marked.where(F.col("is_valid") == 0), cols, params, seed)
    valid = score(model, marked.where(F.col("is_valid") == 1), cols, [cols.label])
    auc = auc_by(valid, "p", cols.label).first()
    return (auc["auc"] if auc else None), score(model, prepare_matrix(test, cols), cols)


def seed_count(n_text_columns: int, n_rows: int) -> int:
    """Ten seeds when any text column exists or the table has 5,000 rows, else one."""
    return 10 if n_text_columns > 0 or n_rows >= 5000 else 1


def seed_average(
    family: str, train: DataFrame, cols: Columns, test: DataFrame, seeds: Sequence[int], params: Params | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Mean test score over full fits with different seeds."""
    stored, ready = materialize(prepare_matrix(train, cols), "seed_average"), prepare_matrix(test, cols)
    if cols.wide and family_name(family) == "cat":
        stored, ready, cols, _ = with_ordered(stored, cols, ready, seed=seeds[0])
        stored, ready = materialize(stored, "seed_average"), materialize(ready, "wide_test")
    models = in_parallel([partial(fit, family, stored, cols, params, s) for s in seeds], parallelism)
    return mean_score(models, ready, cols)


def tree_importances(family: str, train: DataFrame, cols: Columns, params: Params | None = None, seed: int = 42
                     ) -> DataFrame:
    """(column, importance) of a tree ensemble; one number per feature."""
    numeric_only = Columns(cols.id, cols.label, cols.numeric)
    model = fit(family, prepare_matrix(train, numeric_only), numeric_only, params, seed)
    values = [0.0] * len(cols.numeric)
    if not isinstance(model, ConstantModel):
        values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    return train.sparkSession.createDataFrame(list(zip(cols.numeric, values)), "column string, importance double")


def permutation_importance(
    model: Model, df: DataFrame, cols: Columns, columns: Sequence[str] | None = None, seed: int = 42, at_once: int = 25
) -> DataFrame:
    """(column, drop): AUC lost when one column is shuffled among the rows.

    The shuffle is a join of two hash orders: row number i in one order receives the values of row number i in another,
    its donor, for every column in turn.  So the rows are moved once for all columns; ``at_once`` of them are then scored
    in one scan, a score column each, and ranked together.
    """
    columns = list(columns or cols.numeric)
    base_df = materialize(prepare_matrix(df, cols), "permutation")
    donor = _numbered(base_df.select(cols.id, *columns), cols.id, seed + 1).select("__at", F.struct(*columns).alias("__donor"))
    mixed = materialize(_numbered(base_df, cols.id, seed).join(donor, "__at").drop("__at"), "permuted")
    base = auc_by(score(model, base_df, cols, [cols.label]), "p", cols.label).first()["auc"]
    found: dict[str, float] = {}
    for begin in range(0, len(columns), at_once):
        out, names = mixed, []
        for i, c in enumerate(columns[begin : begin + at_once]):
            changed = out.withColumn("__own", F.col(c)).withColumn(c, F.col("__donor")[c])
            scored = model.transform(changed)
            kept = [F.col("__own").alias(c) if x == c else F.col(x) for x in mixed.columns]
            out = scored.select(*kept, *names, _chance(scored).alias(f"__p{i}"))
            names.append(f"__p{i}")
        long = out.select(cols.label, *names).unpivot([cols.label], names, "at", "p")
        aucs = {r["at"]: r["auc"] for r in auc_by(long, "p", cols.label, ["at"]).collect()}
        found |= {c: aucs[n] for c, n in zip(columns[begin : begin + at_once], names)}
    rows = [(c, base - found[c]) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, drop double")


def _numbered(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    return hash_positions(df, id_col, seed).drop("__size")

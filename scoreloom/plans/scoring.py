"""Whole scoring jobs: from train, test and template to a published table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.operators.ensemble import (
    apply_ensemble,
    apply_stack_oof,
    auc_by_model,
    best_candidate,
    best_weights,
    blend_mean,
    blend_rank,
    blend_weighted,
    candidates,
    fit_stack_ridge,
    meta_ensemble,
    model_names,
    pred_matrix,
    rank_average_minmax,
    ranked_predictions,
    score_tuples,
)
from scoreloom.operators.features import (
    bin_features,
    column_stats,
    differences,
    interactions,
    log_features,
    missing_flags,
    missing_rates,
    neighbour_pairs,
    quantile_edges,
    rank_features,
    row_aggregates,
    triangle_pairs,
    zscore,
)
from scoreloom.operators.folds import safe_folds
from scoreloom.operators.metrics import auc_by
from scoreloom.operators.models import (
    FAMILY_ERRORS,
    MAX_INDEXED_LEVELS,
    Columns,
    ConstantModel,
    Params,
    family_name,
    holdout_fit,
    indexable,
    model_zoo,
    oof_scores,
    seed_average,
    tree_importances,
)
from scoreloom.operators.profile import dataset_summary, top_features
from scoreloom.operators.publish import publish, require_same_length, require_unique
from scoreloom.operators.search import (
    SPACES,
    best_trial,
    draw_params,
    hyper_search,
    param_gates,
    policy_params,
    run_policy,
    search_space,
)
from scoreloom.operators.select import average_importance, mutual_information, select_features
from scoreloom.plans.prepare import Prepared, encode_columns, flag_missing, prepare, prepare_coded, prepare_raw
from scoreloom.session import materialize
from scoreloom.sources.store import append_trials, load_predictions, save_model, save_predictions

# Parameters of the default two-model job.
BALANCED_PARAMS: dict[str, Params] = {
    "lgb": {"n_estimators": 800, "learning_rate": 0.03, "num_leaves": 63, "min_child_samples": 20,
            "subsample": 0.8, "colsample_bytree": 0.7},
    "hgb": {"max_iter": 600, "learning_rate": 0.03, "max_depth": 7, "min_samples_leaf": 20},
}
# Parameters of the seven-model job.
ADVANCED_PARAMS: dict[str, Params] = {
    "lgb": {"n_estimators": 500, "learning_rate": 0.05, "num_leaves": 31, "subsample": 0.8, "colsample_bytree": 0.8},
    "xgb": {"n_estimators": 500, "learning_rate": 0.05, "max_depth": 6, "subsample": 0.8, "colsample_bytree": 0.8},
    "cat": {"iterations": 500, "learning_rate": 0.05, "depth": 6},
    "hgb": {"max_iter": 500, "learning_rate": 0.05, "max_depth": 6},
    "et": {"n_estimators": 500, "max_depth": 15},
    "rf": {"n_estimators": 500, "max_depth": 15},
    "ridge": {"alpha": 1000.0},
}
# Parameters of the wide-feature job.
AGGRESSIVE_PARAMS: dict[str, Params] = {
    "lgb": {"n_estimators": 1000, "learning_rate": 0.03, "num_leaves": 63, "min_child_samples": 20,
            "subsample": 0.8, "colsample_bytree": 0.7},
    "xgb": {"n_estimators": 1000, "learning_rate": 0.03, "max_depth": 7, "subsample": 0.8,
            "colsample_bytree": 0.7, "min_child_weight": 3},
    "hgb": {"max_iter": 1000, "learning_rate": 0.03, "max_depth": 7, "min_samples_leaf": 20},
    "cat": {"iterations": 1000, "learning_rate": 0.03, "depth": 8},
}
#: Rounds without a better AUC after which a fit of the wide-feature job stops.
AGGRESSIVE_PATIENCE = 60
# Models of the train-then-ensemble job.
ZOO_PARAMS: dict[str, Params] = {
    "logistic": {"max_iter": 1000},
    "rf": {"n_estimators": 200, "max_depth": 10, "min_samples_leaf": 2},
    "histgb": {"max_iter": 200, "max_depth": 10, "learning_rate": 0.1, "min_samples_leaf": 20},
    "lightgbm": {"n_estimators": 300, "max_depth": 10, "learning_rate": 0.05, "num_leaves": 31,
                 "min_child_samples": 20},
    "xgboost": {"n_estimators": 300, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.8,
                "colsample_bytree": 0.8},
    "catboost": {"iterations": 300, "depth": 6, "learning_rate": 0.05},
}


@dataclass(frozen=True)
class Outcome:
    """What a job returns: the published table, its board and the prediction table behind it."""

    published: DataFrame
    board: DataFrame
    predictions: DataFrame | None = None
    best: str | None = None
    notes: dict[str, object] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


def _columns(data: Prepared, cats: Sequence[str] = (), wide: Sequence[str] = ()) -> Columns:
    return Columns(data.roles.id, data.roles.target, data.roles.numeric, tuple(cats), wide=tuple(wide))


def _category_columns(data: Prepared, max_levels: int = MAX_INDEXED_LEVELS) -> Columns:
    """What the category-aware family reads: few-level text columns as they are, the others by ordered statistics."""
    cats = indexable(data.train, data.roles.cats, max_levels)
    return _columns(data, cats, [c for c in data.roles.cats if c not in cats])


def _publish(data: Prepared, scores: DataFrame, key: str = "row_id") -> DataFrame:
    """The published table; predictions must have one row for each template row and no id twice."""
    keyed = scores.withColumnRenamed(key, data.roles.id) if key != data.roles.id else scores
    keyed = materialize(keyed, "scores")
    require_unique(keyed, data.roles.id)
    require_same_length(data.template, keyed)
    return publish(data.template, keyed, data.roles.id, "p", data.roles.prediction)


def _with(params: dict[str, Params], overrides: dict[str, Params] | None) -> dict[str, Params]:
    return {f: {**p, **(overrides or {}).get(f, {})} for f, p in params.items()}


def _top_interactions(data: Prepared, reach: str) -> Prepared:
    roles = data.roles
    if len(roles.numeric) < 2:
        return data
    if reach == "triangle":
        pairs = triangle_pairs(top_features(data.train, roles.numeric, roles.target, 8), 4, 6)
    else:
        pairs = neighbour_pairs(top_features(data.train, roles.numeric, roles.target, 10), 2)
    names = [f"{a}__x__{b}" for a, b in pairs]
    return Prepared(
        roles.with_numeric(*names), interactions(data.train, pairs), interactions(data.test, pairs), data.template
    )


def balanced(
    train: DataFrame, test: DataFrame, template: DataFrame, families: Sequence[str] = ("lgb", "hgb"), k: int = 5,
    overrides: dict[str, Params] | None = None, parallelism: int = 4, early_stop: bool | str = True,
) -> Outcome:
    """Encodings, missing flags, interactions, two families out of fold, rank blend, best by AUC.

    Boosted fits stop early on their held-out fold, here and in the other jobs, unless ``early_stop`` is off.
    """
    data = prepare(train, test, template)
    data = flag_missing(data, 0.01, "__miss", numeric_only=True)
    data = _top_interactions(data, "triangle")
    cols = _columns(data)
    params = _with({f: BALANCED_PARAMS[f] for f in families}, overrides)
    preds = None
    for f, p in params.items():
        part = oof_scores(f, data.train, cols, data.test, k, params=p, parallelism=parallelism, early_stop=early_stop)
        preds = part if preds is None else preds.unionByName(part)
    return _best_of(data, preds)


def fast(train: DataFrame, test: DataFrame, template: DataFrame, **options) -> Outcome:
    """The same job with one family."""
    return balanced(train, test, template, families=("lgb",), **options)


def _best_of(data: Prepared, preds: DataFrame) -> Outcome:
    """Best of every single family and, with two or more, their rank blend."""
    oof, unseen = preds.where(F.col("split") == "oof"), preds.where(F.col("split") == "test")
    names = model_names(preds)
    board = auc_by_model(oof).select(F.col("model").alias("candidate"), "auc")
    if len(names) > 1:
        blended = auc_by(blend_rank(oof), "p", "y")
        board = board.unionByName(blended.select(F.lit("blend").alias("candidate"), "auc"))
    board = materialize(board, "board")
    best = best_candidate(board).first()["candidate"]
    scores = blend_rank(unseen, ("row_id",)) if best == "blend" else unseen.where(F.col("model") == best)
    return Outcome(_publish(data, scores.select("row_id", "p")), board, preds, best)


def baseline(
    train: DataFrame, test: DataFrame, template: DataFrame, overrides: Params | None = None, seeds: int | None = None,
    max_levels: int = MAX_INDEXED_LEVELS,
) -> Outcome:
    """Seed-averaged boosting on raw features, its regularisation gated by features per row.

    Text columns of up to ``max_levels`` levels are indexed; wider ones are read by their ordered target statistics and
    by out-of-fold and frequency encodings.  ``notes`` says which is which.
    """
    raw = prepare_raw(train, test, template)
    sorted_out = _category_columns(raw, max_levels)
    data = encode_columns(raw, sorted_out.wide)
    cols = replace(sorted_out, numeric=data.roles.numeric)
    summary = dataset_summary(raw.train, raw.roles.numeric, raw.roles.cats, raw.roles.target)
    gates = param_gates(summary, len(raw.roles.cats)).first()
    floor = gates["min_rows"]
    params: Params = {"iterations": 300, "learning_rate": 0.1, "min_samples_leaf": floor, "subsample": 0.8,
                      "l2_regularization": gates["l2"], **(overrides or {})}
    n_seeds = seeds or gates["n_seeds"]
    family = "cat" if data.roles.cats else "hgb"
    if cols.cats:
        params.setdefault("max_bins", max_levels + 2)
    scores = seed_average(family, data.train, cols, data.test, range(n_seeds), params)
    board = data.train.sparkSession.createDataFrame([("baseline", n_seeds, floor)],
                                                    "candidate string, n_seeds int, min_rows int")
    return Outcome(_publish(data, scores, data.roles.id), board, None, "baseline", {"indexed": cols.cats, "encoded": cols.wide})


def safety(train: DataFrame, test: DataFrame, template: DataFrame, overrides: Params | None = None) -> Outcome:
    """One holdout fit, published at once."""
    data = prepare(train, test, template)
    params: Params = {"n_estimators": 300, "learning_rate": 0.05, "num_leaves": 31, **(overrides or {})}
    auc, scores = holdout_fit("lgb", data.train, _columns(data), data.test, params)
    board = data.train.sparkSession.createDataFrame([("safety", auc)], "candidate string, auc double")
    return Outcome(_publish(data, scores, data.roles.id), board, None, "safety")


def family_stage(
    data: Prepared, family: str, fast_run: bool = False, tune_trials: int = 0, overrides: Params | None = None,
    parallelism: int = 4, seeds: Sequence[int] | None = None, early_stop: bool | str = "auc",
) -> DataFrame:
    """Out-of-fold and test scores of one family under the staged run's folds; boosted fits keep their best round by AUC.

    Folds, rounds and, without ``seeds``, their number follow ``run_policy``.
    """
    kind = "fast_" if fast_run else ""
    sized = data.train.agg(F.count("*").alias("n"))
    policy = sized.select(*[c.alias(name) for name, c in run_policy(F.col("n")).items()]).first()
    k, rounds = policy[f"{kind}folds"], policy[f"{kind}rounds"]
    seeds = (42, 101, 202)[: policy[f"{kind}seeds" if fast_run else "n_seeds"]] if seeds is None else seeds
    cols = _category_columns(data) if family == "cat" else _columns(data)
    params: Params = {"max_iter": rounds}
    if family in ("lgb", "xgb"):
        params = {"n_estimators": rounds}
    elif family == "cat":
        params = {"iterations": rounds}
    if tune_trials and not fast_run:
        draws = [
            {**d, **(overrides or {})} for d in draw_params(family, tune_trials, 42, search_space(family, "staged"))
        ]
        tuned, _ = best_trial(hyper_search(family, data.train, cols, draws, 3, 42, parallelism))
        params.update(tuned)
    params.update(overrides or {})
    return oof_scores(family, data.train, cols, data.test, k, seeds, params, parallelism, early_stop=early_stop)


def compete(
    train: DataFrame, test: DataFrame, template: DataFrame, families: Sequence[str] = ("lgb", "xgb", "cat", "hgb"),
    fast_run: bool = False, tune_trials: int = 0, overrides: dict[str, Params] | None = None, parallelism: int = 5,
    store: str | None = None, done: Sequence[str] = (), seeds: Sequence[int] | None = None, early_stop: bool | str = "auc",
    blends: bool = True,
) -> Outcome:
    """Every family, then single models and, with ``blends``, rank blends on one leaderboard.

    A family that its own data or parameters make fail is skipped and named in ``notes``; any other failure ends the run.
    With ``store`` each family's scores replace those of an earlier run there as soon as they exist, and families named
    in ``done`` are read back instead of fitted again.
    """
    data = flag_missing(prepare(train, test, template))
    preds, failed = None, {}
    for f in families:
        try:
            if store and f in done:
                part = load_predictions(train.sparkSession, store, [f])
            else:
                part = family_stage(data, f, fast_run, tune_trials, (overrides or {}).get(f), parallelism, seeds, early_stop)
                if store:
                    save_predictions(part, store)
        except FAMILY_ERRORS as problem:  # a failed family is noted, the others go on
            failed[f] = str(problem)[:500]
            continue
        preds = part if preds is None else preds.unionByName(part)
    if preds is None:
        raise RuntimeError(f"every family failed: {failed}")
    oof, unseen = preds.where(F.col("split") == "oof"), preds.where(F.col("split") == "test")
    names = model_names(preds)
    solo = auc_by_model(oof).select(F.col("model").alias("candidate"), "auc")
    board = materialize(candidates(oof, names) if blends else solo, "board")
    best = best_candidate(board).first()["candidate"]
    if best == "blend_all":
        scores = blend_rank(unseen, ("row_id",))
    elif best == "blend_top2":
        solo = board.where(~F.col("candidate").startswith("blend_"))
        top = [r["candidate"] for r in solo.orderBy(F.desc("auc"), "candidate").limit(2).collect()]
        scores = blend_rank(unseen.where(F.col("model").isin(top)), ("row_id",))
    else:
        scores = unseen.where(F.col("model") == best).select("row_id", "p")
    return Outcome(_publish(data, scores), board, preds, best, failed, failed)


def meta(train: DataFrame, test: DataFrame, template: DataFrame, **options) -> Outcome:
    """Every family; the best single one is published."""
    return compete(train, test, template, blends=False, **options)


def tune(
    train: DataFrame, test: DataFrame, template: DataFrame, families: Sequence[str] = ("lgb", "xgb", "rf", "hgb"),
    tune_trials: int = 20, k: int = 3, store: str | None = None, parallelism: int = 4, overrides: Params | None = None,
) -> tuple[dict[str, Params], DataFrame]:
    """Best parameters of each family and all trials; with ``store`` the trials are added to those of earlier searches."""
    data = prepare(train, test, template)
    trials, best = None, {}
    for family in families:
        cols = _category_columns(data) if family_name(family) == "cat" else _columns(data)
        draws = [{**d, **(overrides or {})} for d in draw_params(family, tune_trials)]
        found = materialize(hyper_search(family, data.train, cols, draws, k, 42, parallelism), "trials")
        if store:
            append_trials(found, f"{store}/trials")
        best[family] = best_trial(found)[0]
        trials = found if trials is None else trials.unionByName(found)
    return best, trials


def full(train: DataFrame, test: DataFrame, template: DataFrame, **options) -> dict[str, Outcome]:
    """The safety baseline first, then every family and the blends."""
    return {"safety": safety(train, test, template), "compete": compete(train, test, template, **options)}


def advanced(
    train: DataFrame, test: DataFrame, template: DataFrame, models: Sequence[str] = tuple(ADVANCED_PARAMS), k: int = 5,
    strategy: str = "moderate", overrides: dict[str, Params] | None = None, importance_trees: int = 100,
    parallelism: int = 4, early_stop: bool | str = True, policy: bool = True, tune_trials: int = 0,
) -> Outcome:
    """Summary, feature selection, diverse models on shared folds, best meta ensemble.

    With ``policy`` the size and width of the table decide the parameters of the families that have rules; with
    ``tune_trials`` a search does.
    """
    data = prepare(train, test, template)
    roles = data.roles
    summary = dataset_summary(data.train, roles.numeric, roles.cats, roles.target).first().asDict()
    importances = feature_importance(data, importance_trees)
    kept, report = select_features(data.train, roles.numeric, roles.cats, importances, strategy=strategy)
    numeric = tuple(c for c in roles.numeric if c in kept)
    folded = materialize(safe_folds(data.train, roles.id, roles.target, k, 42), "advanced_folds")
    chosen = {m: tuned_params(data, m, tune_trials, (overrides or {}).get(m)) if policy or tune_trials else {} for m in models}
    params = _with({m: {**ADVANCED_PARAMS[m], **chosen[m]} for m in models}, overrides)
    preds = None
    for m, p in params.items():
        cols = replace(_category_columns(data) if m == "cat" else _columns(data), numeric=numeric)
        part = oof_scores(m, folded, cols, data.test, k, params=p, parallelism=parallelism, fold_col="fold",
                          early_stop=early_stop)
        preds = part if preds is None else preds.unionByName(part)
    folds = folded.select(F.col(roles.id).alias("row_id"), "fold")
    choice, board = meta_ensemble(preds.where(F.col("split") == "oof"), folds, list(params))
    scores = apply_ensemble(preds.where(F.col("split") == "test"), choice)
    notes = {"summary": summary, "selection": report, "models": choice.models, "weights": choice.weights}
    return Outcome(
        _publish(data, scores), board.withColumnRenamed("method", "candidate"), preds, choice.method, notes
    )


def feature_importance(data: Prepared, trees: int = 100) -> DataFrame:
    """(column, rf, et, mi, avg_importance) of the numeric features."""
    cols = _columns(data)
    settings: Params = {"n_estimators": trees, "max_depth": 10}
    rf = tree_importances("rf", data.train, cols, settings).withColumnRenamed("importance", "rf")
    et = tree_importances("et", data.train, cols, settings).withColumnRenamed("importance", "et")
    mi = mutual_information(data.train, data.roles.numeric, data.roles.target)
    joined = rf.join(et, "column").join(mi, "column")
    return average_importance(joined, ["rf", "et", "mi"])


# How many numeric columns each transform of the wide feature set takes, in table order, if limited.
WIDE_LIMITS = {"log": 50, "rank": 30, "bin": 20, "row": 15, "zscore": 30}
ALL_COLUMNS: dict[str, int | None] = dict.fromkeys(WIDE_LIMITS)


def left_out(data: Prepared, limits: dict[str, int | None]) -> dict[str, list[str]]:
    """Numeric columns beyond each limit of the wide feature set."""
    return {kind: list(data.roles.numeric[n:]) for kind, n in limits.items() if n is not None and data.roles.numeric[n:]}


def widen(data: Prepared, limits: dict[str, int | None] = ALL_COLUMNS) -> Prepared:
    """The wide feature set: every transform fitted on train and applied to both splits alike.

    ``limits`` bounds the columns of a transform (None: all); ``left_out`` names what a limit leaves out.
    """
    roles, train, test = data.roles, data.train, data.test
    numeric = list(roles.numeric)
    rates = missing_rates(train, roles.features)
    stats = column_stats(train, numeric)
    edges = quantile_edges(train, numeric[:limits["bin"]])
    top = top_features(train, numeric, roles.target, 10) if len(numeric) >= 2 else []
    pairs, gaps = neighbour_pairs(top, 2), triangle_pairs(top, 5, 8)

    def transform(df: DataFrame) -> DataFrame:
        df = missing_flags(df, rates, 0.01, "__miss")
        df = log_features(df, stats, limits["log"])
        df = rank_features(df, numeric, limits["rank"], roles.id)
        df = bin_features(df, edges)
        df = differences(interactions(df, pairs), gaps)
        if len(numeric) >= 3:
            df = row_aggregates(df, numeric[:limits["row"]])
        return zscore(df, stats, limits["zscore"])

    wide_train = materialize(transform(train), "wide_train")
    wide_test = materialize(transform(test), "wide_test")
    added = [c for c in wide_train.columns if c not in train.columns]
    return Prepared(roles.with_numeric(*added), wide_train, wide_test, data.template)


def aggressive(
    train: DataFrame, test: DataFrame, template: DataFrame, families: Sequence[str] = ("lgb", "xgb", "hgb", "cat"),
    k: int = 5, overrides: dict[str, Params] | None = None, parallelism: int = 5, step: float = 0.25,
    early_stop: bool | str = "auc", limits: dict[str, int | None] = ALL_COLUMNS,
) -> Outcome:
    """Wide features, several families, then blends and two kinds of ridge stacking compared by AUC.

    Boosted fits keep their best round by AUC: at steps of 0.03 the loss of most rounds falls by less than a stop by loss asks
    for, which would leave a few of the 1,000.
    """
    narrow = prepare(train, test, template)
    data = widen(narrow, limits)
    params = _with({f: AGGRESSIVE_PARAMS[f] for f in families}, overrides)
    folded = materialize(safe_folds(data.train, data.roles.id, data.roles.target, k, 42), "wide_folds")
    preds = None
    for f, p in params.items():
        cols = _category_columns(data) if f == "cat" else _columns(data)
        part = oof_scores(f, folded, cols, data.test, k, params=p, parallelism=parallelism,
                          fold_col="fold", early_stop=early_stop, patience=AGGRESSIVE_PATIENCE)
        preds = part if preds is None else preds.unionByName(part)
    names = list(params)
    if len(names) < 2:
        raise ValueError("the wide job compares blends and needs at least two families")
    preds = materialize(preds, "wide_preds")
    oof, unseen = preds.where(F.col("split") == "oof"), preds.where(F.col("split") == "test")
    folds = folded.select(F.col(data.roles.id).alias("row_id"), "fold")
    weights, weighted_auc = best_weights(score_tuples(oof, names), names, step)
    ranked = materialize(ranked_predictions(preds), "wide_ranks")
    stacks = {}
    for name, source in (("stack_ridge", preds), ("stack_ridge_rank", ranked)):
        matrix = materialize(
            pred_matrix(source.where(F.col("split") == "oof"), names).join(folds, "row_id"), "wide_matrix"
        )
        full, per_fold = fit_stack_ridge(matrix, names, alpha=100.0)
        auc = auc_by(apply_stack_oof(matrix, per_fold), "p", "y").first()["auc"]
        stacks[name] = (auc, source, full)
    rows = [("blend_weighted", weighted_auc), *[(name, auc) for name, (auc, _, _) in stacks.items()]]
    board = materialize(
        candidates(oof, names).unionByName(oof.sparkSession.createDataFrame(rows, "candidate string, auc double")),
        "board",
    )
    best = best_candidate(board).first()["candidate"]
    if best in stacks:
        _, source, full = stacks[best]
        matrix = pred_matrix(source.where(F.col("split") == "test"), names, ("row_id",))
        scores = matrix.select("row_id", full.expression().alias("p"))
    elif best == "blend_weighted":
        scores = blend_weighted(unseen, weights, ("row_id",))
    elif best.startswith("blend_"):
        solo = board.where(F.col("candidate").isin(names)).orderBy(F.desc("auc"), "candidate")
        members = [r["candidate"] for r in solo.limit(2 if best == "blend_top2" else len(names)).collect()]
        scores = blend_rank(unseen.where(F.col("model").isin(members)), ("row_id",))
    else:
        scores = unseen.where(F.col("model") == best).select("row_id", "p")
    return Outcome(_publish(data, scores), board, preds, best, {"weights": weights, "left_out": left_out(narrow, limits)})


def train_and_ensemble(
    train: DataFrame, test: DataFrame, template: DataFrame, specs: dict[str, Params] | None = None, k: int = 5,
    step: float = 0.25, parallelism: int = 4, tune_trials: int = 0, store: str | None = None,
) -> Outcome:
    """Model zoo, optimised weights, and the weighted / rank / simple variants side by side.

    With ``tune_trials`` each family's parameters are searched first.  With ``store`` the trials, the fitted models, and the
    scores of every model and variant are written there.
    """
    data = prepare_coded(train, test, template)
    cols = _category_columns(data)
    specs = dict(specs or ZOO_PARAMS)
    for name in specs if tune_trials else ():
        family = family_name(specs[name].get("family", name))
        if family not in SPACES:
            continue
        draws = [{**specs[name], **d} for d in draw_params(family, tune_trials)]
        trials = materialize(hyper_search(family, data.train, cols, draws, parallelism=parallelism), "trials")
        if store:
            append_trials(trials, f"{store}/trials")
        specs[name] = best_trial(trials)[0]
    preds, report, fitted = model_zoo(specs, data.train, cols, data.test, k, parallelism=parallelism)
    if preds is None:
        raise RuntimeError("every model failed")
    preds = materialize(preds, "zoo_preds")
    oof, unseen = preds.where(F.col("split") == "oof"), preds.where(F.col("split") == "test")
    names = model_names(preds)
    weights, auc = best_weights(score_tuples(oof, names), names, step)
    variants = {
        "weighted_ensemble": blend_weighted(unseen, weights, ("row_id",)),
        "rank_average": rank_average_minmax(unseen, ("row_id",)),
        "simple_average": blend_mean(unseen, ("row_id",)),
    }
    stacked = unseen.select("model", "row_id", "p")
    for name, scores in variants.items():
        stacked = stacked.unionByName(scores.select(F.lit(name).alias("model"), "row_id", "p"))
    if store:
        kept = stacked.select("model", "row_id", "p", F.lit(None).cast("int").alias("y"), F.lit("test").alias("split"))
        save_predictions(kept.unionByName(oof.select(*kept.columns)), f"{store}/predictions")
        for name, model in fitted.items():
            if not isinstance(model, ConstantModel):
                save_model(model, f"{store}/models/{name}")
    board = report.select(F.col("model").alias("candidate"), F.col("cv_auc").alias("auc"), "error")
    return Outcome(
        _publish(data, variants["weighted_ensemble"]), board, stacked, "weighted_ensemble",
        {"weights": weights, "auc": auc},
        {r["model"]: r["error"] for r in report.where("error is not null").collect()},
    )


def tuned_params(data: Prepared, family: str, n_trials: int, overrides: Params | None = None) -> Params:
    """Search result of one family, or the size policy when no trial is asked for."""
    roles = data.roles
    summary = dataset_summary(data.train, roles.numeric, roles.cats, roles.target).first().asDict()
    if not n_trials:
        return policy_params(summary, family)
    if family_name(family) not in SPACES:
        return {}
    draws = [{**d, **(overrides or {})} for d in draw_params(family, n_trials)]
    cols = _category_columns(data) if family_name(family) == "cat" else _columns(data)
    return best_trial(hyper_search(family, data.train, cols, draws))[0]

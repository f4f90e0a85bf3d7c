"""Blending and stacking on the long prediction table (model, split, row_id, y, p)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations, product

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.operators.bounds import Narrowed, narrow, weight_grid, weighted_score
from scoreloom.operators.lookup import lookup
from scoreloom.operators.metrics import auc_by, auc_by_weighted
from scoreloom.operators.ordering import positioned, with_rank_fraction
from scoreloom.operators.profile import corr_pairs
from scoreloom.session import materialize

MIN_GAIN = 1e-4
RIDGE_ALPHA = 1000.0


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def model_names(preds: DataFrame) -> list[str]:
    return [r["model"] for r in preds.select("model").distinct().orderBy("model").collect()]


def pred_matrix(preds: DataFrame, models: Sequence[str], keep: Sequence[str] = ("row_id", "y")) -> DataFrame:
    """One row per row_id with a column per model; explicit names, so no extra job finds them.

    Conditional aggregates, not ``pivot``: that shuffles the long rows twice, by model first.
    """
    return preds.groupBy(*keep).agg(*[F.first(F.when(F.col("model") == m, F.col("p")), ignorenulls=True).alias(m) for m in models])


def auc_by_model(preds: DataFrame) -> DataFrame:
    return auc_by(preds, "p", "y", ["model"])


def fold_average(scores: DataFrame, keys: Sequence[str] = ("model", "row_id")) -> DataFrame:
    """Mean score per row over folds and seeds."""
    return scores.groupBy(*keys).agg(F.avg("p").alias("p"))


def clean_weights(weights: dict[str, float]) -> dict[str, float]:
    """Negative weights become 0, the rest sum to 1; all equal when nothing is left."""
    clipped = {m: max(float(w), 0.0) for m, w in weights.items()}
    total = sum(clipped.values())
    if total == 0:
        return {m: 1.0 / len(clipped) for m in clipped}
    return {m: w / total for m, w in clipped.items()}


def drop_light_models(weights: dict[str, float], floor: float = 0.05) -> dict[str, float]:
    kept = {m: w for m, w in clean_weights(weights).items() if w >= floor}
    return clean_weights(kept or weights)


def blend_mean(preds: DataFrame, keep: Sequence[str] = ("row_id", "y"), models: Sequence[str] | None = None) -> DataFrame:
    """Mean score per row.  Scores add up in name order: the order in which a shuffle delivers the models must not
    decide whether two rows tie.  ``models`` saves the job that finds the names."""
    names = sorted(model_names(preds) if models is None else models, key=lambda m: (m is not None, m))
    total, n = _totals(preds, keep, dict.fromkeys(names, 1.0))
    return total.select(*keep, F.try_divide(F.col("__total"), n).alias("p"))


def _totals(preds: DataFrame, keep: Sequence[str], weights: dict[str, float]) -> tuple[DataFrame, Column]:
    """``__total``, each key's weighted sum of its present scores in the order of ``weights``, and the sum of those weights.

    A sum and a count per model in a hash aggregate: the rows of a key meet before the shuffle, in numbers instead of lists.
    """
    at = {m: F.col("model").eqNullSafe(F.lit(m)) for m in weights}
    summed = preds.groupBy(*keep).agg(
        *[F.sum(F.when(at[m], F.col("p"))).alias(f"__p{i}") for i, m in enumerate(weights)],
        *[F.count(F.when(at[m], F.col("p"))).alias(f"__n{i}") for i, m in enumerate(weights)],
    )
    total = divisor = F.lit(0.0)
    for i, w in enumerate(weights.values()):
        total = total + F.coalesce(F.lit(w) * F.col(f"__p{i}"), F.lit(0.0))
        divisor = divisor + F.lit(w) * F.col(f"__n{i}")
    return summed.withColumn("__total", total), divisor


def blend_weighted(
    preds: DataFrame, weights: dict[str, float], keep: Sequence[str] = ("row_id", "y")
) -> DataFrame:
    """Weighted mean per row; models without a weight count 0, missing scores are left out."""
    cleaned = clean_weights(weights)
    total, divisor = _totals(preds.where(F.col("p").isNotNull()), keep, {m: cleaned[m] for m in sorted(cleaned)})
    return total.select(*keep, F.try_divide(F.col("__total"), divisor).alias("p"))


def ranked_predictions(preds: DataFrame, ranges: int | None = None) -> DataFrame:
    """Replace ``p`` by its tie-averaged rank fraction within (model, split)."""
    groups = [c for c in ("model", "split") if c in preds.columns]
    ranked = with_rank_fraction(preds, "p", "__rank", groups, ranges)
    return ranked.withColumn("p", F.col("__rank")).select(*preds.columns)


def blend_rank(
    preds: DataFrame, keep: Sequence[str] = ("row_id", "y"), ranges: int | None = None, models: Sequence[str] | None = None
) -> DataFrame:
    return blend_mean(ranked_predictions(preds, ranges), keep, model_names(preds) if models is None else models)


def rescale(blend: DataFrame, column: str = "p") -> DataFrame:
    """Min-max to [0, 1]; left alone when flat."""
    low, high = blend.agg(F.min(column), F.max(column)).first()
    if low is None or high == low:
        return blend
    return blend.withColumn(column, (F.col(column) - F.lit(low)) / F.lit(high - low))


def rank_average_minmax(preds: DataFrame, keep: Sequence[str] = ("row_id", "y")) -> DataFrame:
    return rescale(materialize(blend_rank(preds, keep), "rank_blend"))


def score_tuples(preds: DataFrame, models: Sequence[str]) -> DataFrame:
    """Distinct score combinations with row and positive counts.

    Every AUC-driven search below runs on this table: rows that agree on all models collapse
    before any candidate multiplies them.
    """
    matrix = pred_matrix(preds, models).na.drop(subset=list(models))
    tuples = matrix.groupBy(*models).agg(
        F.sum(F.col("y").cast("bigint")).alias("__pos"), F.count("*").alias("__n")
    )
    return materialize(tuples, "score_tuples")


def _auc_of(tuples: DataFrame, scores: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """(candidate, auc) of several score expressions in one job."""
    wide = tuples.select("__pos", "__n", *[s.alias(name) for name, s in scores.items()])
    long = wide.unpivot(["__pos", "__n"], list(scores), "candidate", "score")
    return auc_by_weighted(long, "score", "__pos", "__n", ["candidate"], ranges=ranges)


def simplex_grid(n_models: int, step: float = 0.25) -> list[tuple[float, ...]]:
    """All weight vectors on a grid of ``step`` that sum to one, in lexicographic order.

    A vector is a choice of ``n_models - 1`` bars among ``parts + n_models - 1`` places, so only vectors that count are made.
    """
    parts = round(1 / step)
    places = parts + n_models - 1
    return [
        tuple((b - a - 1) / parts for a, b in zip((-1, *bars), (*bars, places)))
        for bars in combinations(range(places), n_models - 1)
    ]


def blend_weight_search(
    preds: DataFrame, models: Sequence[str], step: float = 0.25, ranges: int | None = None
) -> DataFrame:
    """(candidate, weights..., auc) for every grid point, all scored in one pass."""
    return search_on_tuples(score_tuples(preds, models), models, step, ranges)


def search_on_tuples(
    tuples: DataFrame, models: Sequence[str], step: float = 0.25, ranges: int | None = None,
    numbers: Sequence[int] | None = None,
) -> DataFrame:
    """(candidate, weights..., auc) of the grid points, or of those with the given ``numbers``."""
    grid = simplex_grid(len(models), step)
    points = [(i, grid[i]) for i in (range(len(grid)) if numbers is None else numbers)]
    literal = weight_grid(points)
    long = tuples.select("__pos", "__n", F.inline(literal), *models).select(
        "candidate", weighted_score(models).alias("score"), "__pos", "__n"
    )
    auc = auc_by_weighted(long, "score", "__pos", "__n", ["candidate"], ranges=ranges)
    weights = F.get(F.filter(literal, lambda g: g["candidate"] == F.col("candidate")), F.lit(0))["w"]
    return auc.select("candidate", *[F.get(weights, F.lit(i)).alias(f"w_{m}") for i, m in enumerate(models)], "auc")


def best_grid_point(
    tuples: DataFrame, models: Sequence[str], step: float = 0.25, ranges: int | None = None
) -> tuple[DataFrame, Narrowed]:
    """The row of ``search_on_tuples`` with the largest AUC (ties: the first point), without ranking every candidate.

    Histograms rule out the points that cannot win (``bounds.narrow``); only the rest are ranked exactly.
    """
    left = narrow(tuples, models, simplex_grid(len(models), step))
    exact = search_on_tuples(tuples, models, step, ranges, left.left)
    return exact.where(F.col("auc").isNotNull()).orderBy(F.desc("auc"), "candidate").limit(1), left


def best_weights(
    tuples: DataFrame, models: Sequence[str], step: float = 0.25, refine: int = 2
) -> tuple[dict[str, float], float]:
    """Best grid point, then ``refine`` rounds of moving weight between pairs with a halved step."""
    row = best_grid_point(tuples, models, step)[0].first()
    if row is None:
        return clean_weights(dict.fromkeys(models, 1.0)), None
    weights = {m: row[f"w_{m}"] for m in models}
    best = row["auc"]
    for _ in range(refine):
        step /= 2
        moves = [
            tuple(clean_weights({**weights, a: weights[a] - step, b: weights[b] + step}).values())
            for a, b in product(models, models) if a != b and weights[a] >= step
        ]
        if not moves:
            break
        left = narrow(tuples, models, moves).left
        scores = {f"{i}": _sum([F.lit(w) * F.col(f"`{m}`") for m, w in zip(models, moves[i])]) for i in left}
        top = min(
            (r for r in _auc_of(tuples, scores).collect() if r["auc"] is not None),
            key=lambda r: (-r["auc"], int(r["candidate"])), default=None,
        )
        if top is not None and top["auc"] > best:
            weights, best = dict(zip(models, moves[int(top["candidate"])])), top["auc"]
    return weights, best


def greedy_select(
    preds: DataFrame, models: Sequence[str], min_gain: float = MIN_GAIN, tuples: DataFrame | None = None
) -> list[tuple[str, float]]:
    """Forward selection by AUC of the running mean: [(model, auc after adding it)].

    At most one job per round, and each round scores all remaining models together.  Scores add up
    in name order, so rows that tie do so whatever the order of selection.
    """
    tuples = tuples if tuples is not None else score_tuples(preds, models)
    chosen: list[tuple[str, float]] = []
    remaining = sorted(models)
    current = 0.0
    while remaining:
        picked = [m for m, _ in chosen]
        scores = {
            m: _sum([F.col(f"`{x}`") for x in sorted([*picked, m])]) / F.lit(len(picked) + 1) for m in remaining
        }
        ranked = _auc_of(tuples, scores).where(F.col("auc").isNotNull())
        if not chosen:
            solo = {r["candidate"]: r["auc"] for r in ranked.collect()}
            remaining = sorted(solo, key=lambda m: (-solo[m], m))
            if not remaining:
                break
            name, auc = remaining[0], solo[remaining[0]]
        else:
            top = ranked.collect()
            order = {m: i for i, m in enumerate(remaining)}
            best = min(top, key=lambda r: (-r["auc"], order[r["candidate"]]))
            name, auc = best["candidate"], best["auc"]
        if auc - current <= min_gain:
            break
        chosen.append((name, auc))
        current = auc
        remaining.remove(name)
    return chosen


def with_fallback(chosen: Sequence[str], models: Sequence[str]) -> list[str]:
    """Fewer than two selected models: take the first three instead."""
    return list(chosen) if len(chosen) >= 2 else list(models)[:3]


@dataclass(frozen=True)
class Ridge:
    models: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]

    def expression(self) -> Column:
        terms = [F.lit(c) * F.col(f"`{m}`") for m, c in zip(self.models, self.coefficients)]
        return F.lit(self.intercept) + _sum(terms)


def _solve(models: Sequence[str], sums: dict[str, float], alpha: float) -> Ridge:
    """Ridge with an unpenalised intercept from sums of a k x k problem (k = number of models)."""
    n, k = sums["n"], len(models)
    mean = np.array([sums[f"x{i}"] for i in range(k)]) / n
    y_mean = sums["y"] / n
    cross = np.array([[sums[f"x{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    cross = cross - n * np.outer(mean, mean)
    target = np.array([sums[f"x{i}_y"] for i in range(k)]) - n * mean * y_mean
    coef = np.linalg.solve(cross + alpha * np.eye(k), target)
    return Ridge(tuple(models), float(y_mean - coef @ mean), tuple(float(c) for c in coef))


def fit_stack_ridge(
    matrix: DataFrame, models: Sequence[str], fold: str = "fold", alpha: float = RIDGE_ALPHA
) -> tuple[Ridge, dict[int, Ridge]]:
    """Full fit and one fit per left-out fold from a single ``groupBy(fold)`` of moment sums."""
    x = [F.col(f"`{m}`").cast("double") for m in models]
    y = F.col("y").cast("double")
    k = len(models)
    terms = {"n": F.count("*").cast("double"), "y": F.sum(y)}
    terms.update({f"x{i}": F.sum(x[i]) for i in range(k)})
    terms.update({f"x{i}_y": F.sum(x[i] * y) for i in range(k)})
    terms.update({f"x{i}_{j}": F.sum(x[i] * x[j]) for i in range(k) for j in range(i, k)})
    rows = matrix.groupBy(fold).agg(*[t.alias(name) for name, t in terms.items()]).collect()
    whole = {name: sum(r[name] for r in rows) for name in terms}
    per_fold = {
        r[fold]: _solve(models, {name: whole[name] - r[name] for name in terms}, alpha)
        for r in rows
        if whole["n"] > r["n"]
    }
    return _solve(models, whole, alpha), per_fold


def apply_stack_oof(matrix: DataFrame, per_fold: dict[int, Ridge], fold: str = "fold") -> DataFrame:
    """Each row scored by the fit that left its fold out."""
    branches = [F.when(F.col(fold) == k, fit.expression()) for k, fit in per_fold.items()]
    return matrix.withColumn("p", F.coalesce(*branches))


@dataclass(frozen=True)
class EnsembleChoice:
    method: str
    auc: float
    models: tuple[str, ...]
    weights: dict[str, float] = field(default_factory=dict)
    ridge: Ridge | None = None


def ranked_tuples(matrix: DataFrame, models: Sequence[str]) -> DataFrame:
    """Distinct score combinations with ``__pos``, ``__n`` (labelled rows), a score ``__c<i>`` and a rank fraction ``__r<i>``
    per model.

    Rows with equal scores have equal ranks, so blends of ranks are judged without row ids.  Ranks are within ``split``, if any.
    """
    y, groups = F.col("y").cast("bigint"), [c for c in ("split",) if c in matrix.columns]
    names = [f"__c{i}" for i in range(len(models))]
    scores = matrix.select("y", *groups, *[F.col(f"`{m}`").alias(c) for m, c in zip(models, names)])
    tuples = materialize(
        scores.groupBy(*groups, *names).agg(
            F.coalesce(F.sum(y), F.lit(0)).alias("__pos"), F.count(y).alias("__n"), F.count(F.lit(1)).alias("__rows")
        ),
        "ranked_tuples",
    )
    out = tuples
    for i, c in enumerate(names):
        counts = tuples.where(F.col(c).isNotNull()).groupBy(*groups, c).agg(F.sum("__rows").alias("n"))
        placed, size = positioned(counts, [c], groups)
        rank = (F.col("upto") - (F.col("n") - 1) / 2.0) / F.col("total")
        out = lookup(out, placed.select(*groups, c, "n", rank.alias(f"__r{i}")), [*groups, c], "n", size)
    return materialize(out, "ranked_tuples")


def rank_blend(models: Sequence[str], members: Sequence[str]) -> Column:
    """Mean of the members' present ranks in a table of ``ranked_tuples``, added up in name order."""
    ranks = [F.col(f"__r{list(models).index(m)}") for m in sorted(members)]
    total = reduce(lambda a, b: a + b, [F.coalesce(r, F.lit(0.0)) for r in ranks], F.lit(0.0))
    return F.try_divide(total, _sum([r.isNotNull().cast("int") for r in ranks]).cast("double"))


def meta_ensemble(
    preds: DataFrame, folds: DataFrame, models: Sequence[str], strategy: str = "auto", alpha: float = RIDGE_ALPHA,
    step: float = 0.25, refine: int = 2,
) -> tuple[EnsembleChoice, DataFrame]:
    """Greedy selection, then simple / weighted / rank / ridge blends compared by AUC.

    ``preds`` holds out-of-fold scores and ``folds`` is (row_id, fold).  Returns the choice and a
    (method, auc) table.  ``strategy`` other than ``auto`` forces that method.
    """
    tuples = score_tuples(preds, models)
    solo = _auc_of(tuples, {m: F.col(f"`{m}`") for m in models}).collect()
    ordered = [r["candidate"] for r in sorted(solo, key=lambda r: (-(r["auc"] or 0.0), r["candidate"]))]
    chosen = with_fallback([m for m, _ in greedy_select(preds, models, tuples=tuples)], ordered)
    used = preds.where(F.col("model").isin(chosen))
    kept = tuples.groupBy(*chosen).agg(F.sum("__pos").alias("__pos"), F.sum("__n").alias("__n"))
    weights, weighted_auc = best_weights(kept, chosen, step, refine)
    simple = _auc_of(kept, {"simple_avg": _sum([F.col(f"`{m}`") for m in sorted(chosen)]) / F.lit(len(chosen))})
    simple_auc = simple.first()["auc"]
    matrix = materialize(
        pred_matrix(used, chosen).na.drop(subset=list(chosen)).join(folds, "row_id"), "stack_matrix"
    )
    # Every method is judged on the same rows: those that all chosen models score.
    rank_auc = _auc_of(ranked_tuples(matrix, chosen), {"rank_avg": rank_blend(chosen, chosen)}).first()["auc"]
    full, per_fold = fit_stack_ridge(matrix, chosen, alpha=alpha)
    ridge_auc = auc_by(apply_stack_oof(matrix, per_fold), "p", "y").first()["auc"]
    results = {
        "simple_avg": simple_auc, "weighted_avg": weighted_auc, "rank_avg": rank_auc, "ridge_stacking": ridge_auc
    }
    method = strategy if strategy in results else max(results, key=lambda k: results[k] or 0.0)
    choice = EnsembleChoice(
        method,
        results[method],
        tuple(chosen),
        weights if method == "weighted_avg" else {},
        full if method == "ridge_stacking" else None,
    )
    report = preds.sparkSession.createDataFrame(list(results.items()), "method string, auc double")
    return choice, report


def apply_ensemble(preds: DataFrame, choice: EnsembleChoice, keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """The chosen method on any split, with the fitted weights or ridge."""
    used = preds.where(F.col("model").isin(list(choice.models)))
    if choice.method == "weighted_avg":
        return blend_weighted(used, choice.weights, keep)
    if choice.method == "rank_avg":
        return blend_rank(used, keep, models=choice.models)
    if choice.method == "ridge_stacking":
        return pred_matrix(used, choice.models, keep).select(*keep, choice.ridge.expression().alias("p"))
    return blend_mean(used, keep, choice.models)


def candidates(preds: DataFrame, models: Sequence[str]) -> DataFrame:
    """Leaderboard of every model, the rank blend of all and the rank blend of the best two."""
    models = list(models)
    keep = [c for c in ("row_id", "y", "split") if c in preds.columns]
    tuples = ranked_tuples(pred_matrix(preds.where(F.col("model").isin(models)), models, keep), models).where(F.col("__n") > 0)
    solo = materialize(_auc_of(tuples, {m: F.col(f"__c{i}") for i, m in enumerate(models)}), "solo")
    order = [r["candidate"] for r in solo.orderBy(F.desc("auc"), "candidate").limit(2).collect()]
    blends = {"blend_all": models} | ({"blend_top2": order} if len(order) == 2 else {})
    return solo.unionByName(_auc_of(tuples, {name: rank_blend(models, members) for name, members in blends.items()}))


def best_candidate(board: DataFrame) -> DataFrame:
    return board.where(F.col("auc").isNotNull()).orderBy(F.desc("auc"), "candidate").limit(1)


def filter_models(preds: DataFrame, floor: float = 0.5) -> DataFrame:
    """Leave out missing scores and whole models whose AUC is not above ``floor``.

    The AUC table has one row per model, read as a short list.
    """
    usable = preds.where(F.col("p").isNotNull())
    good = [r["model"] for r in auc_by_model(usable).where(F.col("auc") > floor).collect()]
    return usable.where(F.col("model").isin(good))


def pred_corr(preds: DataFrame, models: Sequence[str], keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """(a, b, corr): absolute correlation between models' scores."""
    return corr_pairs(pred_matrix(preds, models, keep), models)


def diverse_select(preds: DataFrame, models: Sequence[str], n: int = 2, below: float = 0.95) -> DataFrame:
    """Best models by AUC, skipping any that correlates above ``below`` with one already taken.

    Decided on a models x models table.
    """
    scores = {r["model"]: r["auc"] for r in auc_by_model(preds).collect() if r["auc"] is not None}
    table = {(r["a"], r["b"]): r["corr"] or 0.0 for r in pred_corr(preds, models).collect()}
    taken: list[str] = []
    for m in sorted(scores, key=lambda m: (-scores[m], m)):
        close = [table.get((m, t), table.get((t, m), 0.0)) for t in taken]
        if len(taken) < n and all(c <= below for c in close):
            taken.append(m)
    rows = [(i + 1, m, scores[m]) for i, m in enumerate(taken)]
    return preds.sparkSession.createDataFrame(rows, "rank int, model string, auc double")


def rank_order(board: DataFrame) -> DataFrame:
    """Leaderboard positions; one row per candidate."""
    return board.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("auc"), "candidate")))

"""Ranking quality, blends, stacking and candidate choice on fixed-formula predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.operators import ensemble as ens
from scoreloom.operators import metrics
from scoreloom.operators.folds import assign_folds
from scoreloom.session import materialize
from scoreloom.suite import fixtures as fx
from scoreloom.suite.profiles import pair_corr_sql
from scoreloom.suite.registry import query, rounded

THREE = ("m1", "m2", "m3")
TWO = ("m1", "m4")


def _oof(spark, sf, models=fx.MODELS):
    return fx.predictions(spark, sf, models).where(F.col("split") == "oof")


def _unseen(spark, sf, models=fx.MODELS):
    return fx.predictions(spark, sf, models).where(F.col("split") == "test")


OOF = fx.pred_sql(split="oof")


@query("auc", f"{fx.pred_sql(('m4',))} SELECT round(auc, 9) AS auc FROM ({fx.auc_sql('preds', groups=())})")
def auc_query(spark, sf):
    return rounded(metrics.auc_by(fx.predictions(spark, sf, ("m4",)), "p", "y"), "auc", places=9)


@query("auc_by_model", f"{fx.pred_sql()} SELECT model, round(auc, 9) AS auc FROM ({fx.auc_sql('preds')})")
def auc_by_model_query(spark, sf):
    return rounded(ens.auc_by_model(fx.predictions(spark, sf)), "auc", places=9)


@query(
    "cv_mean_auc",
    f"""{fx.pred_sql()}, folded AS (SELECT preds.*, fold FROM preds JOIN
          (SELECT row_id, {fx.fold_sql('row_id', 'y')} AS fold FROM wide) f ON preds.row_id = f.row_id)
        SELECT model, round(avg(auc), 9) AS cv_auc, count(auc) AS folds
        FROM ({fx.auc_sql('folded', groups=('model', 'fold'))}) GROUP BY model""",
)
def cv_mean_auc_query(spark, sf):
    folded = assign_folds(fx.prediction_wide(spark, sf), "row_id", 5, 42, "y").drop("split")
    long = folded.unpivot(["row_id", "y", "fold"], list(fx.MODELS), "model", "p")
    return rounded(metrics.cv_mean_auc(long, "p", "y", "fold", ["model"]), "cv_auc", places=9)


@query(
    "fold_average",
    f"""{fx.pred_sql(THREE)} SELECT row_id, round(avg(p), 10) AS p FROM preds GROUP BY row_id""",
)
def fold_average_query(spark, sf):
    """Three score sets taken as three seeds of one model."""
    seeds = fx.predictions(spark, sf, THREE).withColumnRenamed("model", "seed")
    return rounded(ens.fold_average(seeds, ["row_id"]), "p", places=10)


@query(
    "pred_stats",
    f"""{fx.pred_sql()} SELECT model, round(avg(p), 8) AS mean, round(stddev_samp(p), 8) AS std, min(p) AS min,
        max(p) AS max, count(DISTINCT p) AS n_unique, count(p) AS n_scored FROM preds GROUP BY model""",
)
def pred_stats_query(spark, sf):
    return rounded(metrics.score_stats(fx.predictions(spark, sf), "p", ["model"]), "mean", "std", places=8)


@query("pred_matrix", f"WITH {fx.WIDE} SELECT row_id, y, m1, m2, m3, m4 FROM wide WHERE split = 'oof'")
def pred_matrix_query(spark, sf):
    return ens.pred_matrix(_oof(spark, sf), fx.MODELS)


@query("blend_mean", f"{OOF} SELECT row_id, y, round(avg(p), 10) AS p FROM preds GROUP BY row_id, y")
def blend_mean_query(spark, sf):
    return rounded(ens.blend_mean(_oof(spark, sf)), "p", places=10)


@query(
    "blend_weighted",
    f"""{OOF}, w(model, w) AS (VALUES ('m1', 0.6), ('m2', 0.3), ('m3', 0.1), ('m4', 0.0))
        SELECT row_id, y, round(sum(w * p) / sum(w), 10) AS p FROM preds JOIN w USING (model) GROUP BY row_id, y""",
)
def blend_weighted_query(spark, sf):
    """A negative weight counts zero, and m4 has none."""
    return rounded(ens.blend_weighted(_oof(spark, sf), {"m1": 6, "m2": 3, "m3": 1, "m9": -2}), "p", places=10)


RANKED = f"ranked AS (SELECT *, {fx.rank_sql('p', ('model', 'split'))} AS r FROM preds)"


@query("blend_rank", f"{OOF}, {RANKED} SELECT row_id, y, round(avg(r), 6) AS p FROM ranked GROUP BY row_id, y")
def blend_rank_query(spark, sf):
    return rounded(ens.blend_rank(_oof(spark, sf)), "p", places=6)


@query(
    "rank_average_minmax",
    f"""{OOF}, {RANKED}, b AS (SELECT row_id, y, avg(r) AS p FROM ranked GROUP BY row_id, y)
        SELECT row_id, y, round((p - (SELECT min(p) FROM b)) / (SELECT max(p) - min(p) FROM b), 6) AS p FROM b""",
)
def rank_average_minmax_query(spark, sf):
    return rounded(ens.rank_average_minmax(_oof(spark, sf)), "p", places=6)


SOLO = f"solo AS ({fx.auc_sql('preds')})"
BOARD = f"""{SOLO}, {RANKED}, top2 AS (SELECT model FROM solo ORDER BY auc DESC, model LIMIT 2),
  b_all AS (SELECT row_id, y, list_sum(list(r ORDER BY model)) / count(r) AS p FROM ranked GROUP BY row_id, y),
  b_two AS (SELECT row_id, y, list_sum(list(r ORDER BY model)) / count(r) AS p FROM ranked WHERE model IN (SELECT model FROM top2) GROUP BY row_id, y),
  board AS (SELECT model AS candidate, auc FROM solo UNION ALL SELECT 'blend_all', auc FROM ({fx.auc_sql('b_all', groups=())})
    UNION ALL SELECT 'blend_top2', auc FROM ({fx.auc_sql('b_two', groups=())}))"""


@query("candidates", f"{OOF}, {BOARD} SELECT candidate, round(auc, 6) AS auc FROM board")
def candidates_query(spark, sf):
    return rounded(ens.candidates(_oof(spark, sf), fx.MODELS), "auc", places=6)


@query(
    "blend_top2",
    f"""{OOF}, {SOLO}, {RANKED}, top2 AS (SELECT model FROM solo ORDER BY auc DESC, model LIMIT 2)
        SELECT row_id, y, round(avg(r), 6) AS p FROM ranked WHERE model IN (SELECT model FROM top2) GROUP BY row_id, y""",
)
def blend_top2_query(spark, sf):
    preds = _oof(spark, sf)
    best = [r["model"] for r in ens.auc_by_model(preds).orderBy(F.desc("auc"), "model").limit(2).collect()]
    return rounded(ens.blend_rank(preds.where(F.col("model").isin(best))), "p", places=6)


@query("best_candidate", f"{OOF}, {SOLO} SELECT model AS candidate, round(auc, 8) AS auc FROM solo ORDER BY auc DESC, model LIMIT 1")
def best_candidate_query(spark, sf):
    board = ens.auc_by_model(_oof(spark, sf)).withColumnRenamed("model", "candidate")
    return rounded(ens.best_candidate(board), "auc", places=8)


def grid_values(n: int, step: float = 0.25) -> str:
    return ", ".join(f"({i}, {', '.join(map(str, g))})" for i, g in enumerate(ens.simplex_grid(n, step)))


def search_sql(models, split="oof") -> str:
    names = ", ".join(f"w_{m}" for m in models)
    blend = " + ".join(f"CAST(w_{m} AS DOUBLE) * {m}" for m in models)
    return (
        f"grid(candidate, {names}) AS (VALUES {grid_values(len(models))}),"
        f" scored AS (SELECT candidate, y, {blend} AS p FROM wide CROSS JOIN grid WHERE split = '{split}'),"
        f" found AS ({fx.auc_sql('scored', groups=('candidate',))})"
    )


@query(
    "blend_weight_search",
    f"""WITH {fx.WIDE}, {search_sql(THREE)} SELECT candidate, CAST(w_m1 AS DOUBLE) AS w_m1, CAST(w_m2 AS DOUBLE) AS w_m2,
        CAST(w_m3 AS DOUBLE) AS w_m3, round(auc, 8) AS auc FROM found JOIN grid USING (candidate)""",
)
def blend_weight_search_query(spark, sf):
    return rounded(ens.blend_weight_search(_oof(spark, sf, THREE), THREE), "auc", places=8)


SUBSETS = {"1": "m1", "2": "m2", "3": "m3", "12": "(m1 + m2) / 2", "13": "(m1 + m3) / 2", "23": "(m2 + m3) / 2",
           "123": "(m1 + m2 + m3) / 3"}


def greedy_sql() -> str:
    """Greedy selection over three models from the AUC of all seven subsets."""
    scored = " UNION ALL ".join(f"SELECT '{k}' AS s, y, {e} AS p FROM wide WHERE split = 'oof'" for k, e in SUBSETS.items())
    return f"""WITH {fx.WIDE}, scored AS ({scored}), a AS ({fx.auc_sql('scored', groups=('s',))}),
      one AS (SELECT s, auc FROM a WHERE length(s) = 1 ORDER BY auc DESC, s LIMIT 1),
      two AS (SELECT replace(a.s, one.s, '') AS added, a.s AS pair, a.auc FROM a, one
              WHERE length(a.s) = 2 AND contains(a.s, one.s) AND a.auc - one.auc > 1e-4 ORDER BY a.auc DESC, a.s LIMIT 1),
      three AS (SELECT replace(replace('123', substr(two.pair, 1, 1), ''), substr(two.pair, 2, 1), '') AS added, a.auc
                FROM a, two WHERE a.s = '123' AND a.auc - two.auc > 1e-4)
      SELECT 1 AS step, 'm' || s AS model, round(auc, 8) AS auc FROM one
      UNION ALL SELECT 2, 'm' || added, round(auc, 8) FROM two UNION ALL SELECT 3, 'm' || added, round(auc, 8) FROM three"""


@query("greedy_select", greedy_sql())
def greedy_select_query(spark, sf):
    chosen = ens.greedy_select(_oof(spark, sf, THREE), THREE)
    rows = [(i + 1, m, round(a, 8)) for i, (m, a) in enumerate(chosen)]
    return spark.createDataFrame(rows, "step int, model string, auc double")




def ridge_sql(source: str, alpha: float = 1000.0) -> str:
    """Out-of-fold two-model ridge with the 2x2 inverse written out."""
    names = ("n", "sa", "sb", "sy", "saa", "sab", "sbb", "say", "sby")
    rest = ", ".join(f"sum({c}) OVER () - {c} AS {c}" for c in names)
    return f"""sums AS (SELECT fold, CAST(count(*) AS DOUBLE) AS n, sum(a) AS sa, sum(b) AS sb, CAST(sum(y) AS DOUBLE) AS sy,
        sum(a * a) AS saa, sum(a * b) AS sab, sum(b * b) AS sbb, sum(a * y) AS say, sum(b * y) AS sby FROM {source} GROUP BY fold),
      rest AS (SELECT fold, {rest} FROM sums),
      mom AS (SELECT fold, sa / n AS ma, sb / n AS mb, sy / n AS my, saa - sa * sa / n + {alpha} AS caa,
        sab - sa * sb / n AS cab, sbb - sb * sb / n + {alpha} AS cbb, say - sa * sy / n AS ca, sby - sb * sy / n AS cb FROM rest),
      fit AS (SELECT fold, ma, mb, my, (ca * cbb - cb * cab) / (caa * cbb - cab * cab) AS wa,
        (cb * caa - ca * cab) / (caa * cbb - cab * cab) AS wb FROM mom),
      stacked AS (SELECT row_id, y, my + wa * (a - ma) + wb * (b - mb) AS p FROM {source} JOIN fit USING (fold))"""


TWO_FOLDED = (
    f"rows2 AS (SELECT row_id, y, m1 AS a, m4 AS b, {fx.fold_sql('row_id', 'y')} AS fold FROM wide WHERE split = 'oof')"
)


@query("stack_ridge", f"WITH {fx.WIDE}, {TWO_FOLDED}, {ridge_sql('rows2')} SELECT row_id, y, round(p, 8) AS p FROM stacked")
def stack_ridge_query(spark, sf):
    matrix = materialize(ens.pred_matrix(_oof(spark, sf, TWO), TWO).join(fx.prediction_folds(spark, sf), "row_id"), "matrix")
    _, per_fold = ens.fit_stack_ridge(matrix, TWO)
    return rounded(ens.apply_stack_oof(matrix, per_fold).select("row_id", "y", "p"), "p", places=8)


@query(
    "stack_ridge_rank",
    f"""{fx.pred_sql(TWO, 'oof')}, {RANKED}, rows2 AS (SELECT row_id, y, {fx.fold_sql('row_id', 'y')} AS fold,
          max(r) FILTER (WHERE model = 'm1') AS a, max(r) FILTER (WHERE model = 'm4') AS b FROM ranked GROUP BY row_id, y),
        {ridge_sql('rows2', 100.0)} SELECT row_id, y, round(p, 6) AS p FROM stacked""",
)
def stack_ridge_rank_query(spark, sf):
    ranked = ens.ranked_predictions(_oof(spark, sf, TWO))
    matrix = materialize(ens.pred_matrix(ranked, TWO).join(fx.prediction_folds(spark, sf), "row_id"), "matrix")
    _, per_fold = ens.fit_stack_ridge(matrix, TWO, alpha=100.0)
    return rounded(ens.apply_stack_oof(matrix, per_fold).select("row_id", "y", "p"), "p", places=6)


@query(
    "meta_ensemble",
    f"""WITH {fx.WIDE}, {search_sql(TWO)}, {TWO_FOLDED}, {ridge_sql('rows2')},
          mean2 AS (SELECT y, (a + b) / 2 AS p FROM rows2),
          rank2 AS (SELECT y, ({fx.rank_sql('a')} + {fx.rank_sql('b')}) / 2 AS p FROM rows2)
        SELECT 'simple_avg' AS method, round(auc, 6) AS auc FROM ({fx.auc_sql('mean2', groups=())})
        UNION ALL SELECT 'weighted_avg', round(max(auc), 6) FROM found
        UNION ALL SELECT 'rank_avg', round(auc, 6) FROM ({fx.auc_sql('rank2', groups=())})
        UNION ALL SELECT 'ridge_stacking', round(auc, 6) FROM ({fx.auc_sql('stacked', groups=())})""",
)
def meta_ensemble_query(spark, sf):
    _, report = ens.meta_ensemble(_oof(spark, sf, TWO), fx.prediction_folds(spark, sf), TWO, refine=0)
    return rounded(report, "auc", places=6)


@query(
    "apply_ensemble",
    f"""WITH {fx.WIDE}, {search_sql(TWO)}, best AS (SELECT candidate FROM found ORDER BY auc DESC, candidate LIMIT 1)
        SELECT row_id, round(w_m1 * m1 + w_m4 * m4, 10) AS p FROM wide, grid JOIN best USING (candidate)
        WHERE split = 'test'""",
)
def apply_ensemble_query(spark, sf):
    """Weights found out of fold, applied to the unseen split."""
    weights, auc = ens.best_weights(ens.score_tuples(_oof(spark, sf, TWO), TWO), TWO, refine=0)
    choice = ens.EnsembleChoice("weighted_avg", auc, TWO, weights)
    return rounded(ens.apply_ensemble(_unseen(spark, sf, TWO), choice), "p", places=10)


@query(
    "weight_threshold",
    f"""{OOF}, w(model, w) AS (VALUES ('m1', 0.6 / 0.96), ('m2', 0.36 / 0.96))
        SELECT row_id, y, round(sum(w * p) / sum(w), 10) AS p FROM preds JOIN w USING (model) GROUP BY row_id, y""",
)
def weight_threshold_query(spark, sf):
    kept = ens.drop_light_models({"m1": 0.6, "m2": 0.36, "m3": 0.04})
    return rounded(ens.blend_weighted(_oof(spark, sf), kept), "p", places=10)


@query(
    "filter_models",
    f"""{OOF}, seen AS (SELECT model, row_id, y, p FROM preds WHERE NOT (model = 'm3' AND p = 0)),
          s AS ({fx.auc_sql('seen')}) SELECT model, row_id, y, p FROM seen WHERE model IN (SELECT model FROM s WHERE auc > 0.5)""",
)
def filter_models_query(spark, sf):
    gone = (F.col("model") == "m3") & (F.col("p") == 0)
    preds = _oof(spark, sf).drop("split").withColumn("p", F.when(~gone, F.col("p")))
    return ens.filter_models(preds, 0.5)


@query("pred_corr", f"WITH {fx.WIDE}, oof AS (SELECT * FROM wide WHERE split = 'oof') {pair_corr_sql(fx.MODELS, 'oof')}")
def pred_corr_query(spark, sf):
    return rounded(ens.pred_corr(_oof(spark, sf), fx.MODELS), "corr")


@query(
    "diverse_select",
    f"""WITH {fx.WIDE}, oof AS (SELECT *, 2 * m1 AS m1b FROM wide WHERE split = 'oof'),
          preds AS (SELECT 'm1' AS model, y, m1 AS p FROM oof UNION ALL SELECT 'm1b', y, m1b FROM oof
                    UNION ALL SELECT 'm4', y, m4 FROM oof),
          s AS ({fx.auc_sql('preds')}), o AS (SELECT model, auc, row_number() OVER (ORDER BY auc DESC, model) AS k FROM s),
          k AS (SELECT (SELECT abs(corr(m1, m4)) FROM oof) AS c14)
        SELECT CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS rank, model, round(auc, 8) AS auc FROM o, k AS kk
        WHERE model <> 'm1b'""",
)
def diverse_select_query(spark, sf):
    """m1b is m1 doubled, so only one of the two can be taken (m1 comes first by name)."""
    wide = fx.prediction_wide(spark, sf).where(F.col("split") == "oof").withColumn("m1b", F.col("m1") * 2)
    preds = wide.unpivot(["row_id", "y"], ["m1", "m1b", "m4"], "model", "p")
    return rounded(ens.diverse_select(preds, ["m1", "m1b", "m4"], 2, 0.9), "auc", places=8)

"""Ordered target statistics and the bounded weight search, against SQL that does the whole work."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.operators import ensemble as ens
from scoreloom.operators import models
from scoreloom.operators.encode import one_hot_sparse, unit_place
from scoreloom.operators.folds import assign_folds
from scoreloom.operators.ordered import apply_totals, fit_ordered, ordered_rates
from scoreloom.session import materialize
from scoreloom.suite import fixtures as fx
from scoreloom.suite.ensembles import THREE, search_sql
from scoreloom.suite.registry import query, rounded

#: One text column with a level for a few rows each, one with three levels for all rows.
WIDE_CATS = ("part", "l_returnflag")


def _line(spark, sf):
    parts = fx.table(spark, sf, "lineitem").select(
        fx.line_id().alias("id"), F.col("l_partkey").cast("string").alias("part"), "l_returnflag",
        (F.col("l_linestatus") == "F").cast("int").alias("target"), *fx.LINE_NUMERIC, "l_shipdate",
    )
    return parts


PARTS = f"""rows0 AS (SELECT {fx.LINE_ID_SQL} AS id, CAST(l_partkey AS VARCHAR) AS part, l_returnflag,
  CAST(l_linestatus = 'F' AS INTEGER) AS target, l_shipdate FROM lineitem),
  rows1 AS (SELECT *, md5(concat_ws('-', id, '42')) AS stamp FROM rows0), base AS (SELECT avg(target) AS prior FROM rows1)"""


def _ordered(c: str) -> str:
    w = f"OVER (PARTITION BY {c} ORDER BY stamp, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"round((coalesce(sum(target) {w}, 0) + prior) / (count(*) {w} + 1), 8) AS {c}__ots"


@query("ordered_stats", f"WITH {PARTS} SELECT id, {', '.join(map(_ordered, WIDE_CATS))} FROM rows1, base")
def ordered_stats(spark, sf):
    rows = materialize(_line(spark, sf).select("id", "target", *WIDE_CATS), "ordered_rows")
    out = ordered_rates(rows, fit_ordered(rows, WIDE_CATS, "target"), "target", "id")
    names = [f"{c}__ots" for c in WIDE_CATS]
    return rounded(out.select("id", *[F.col(n)[0].alias(n) for n in names]), *names, places=8)


def _left_out(c: str) -> str:
    """The values that leave out the next fold and the row's own."""
    w = f"OVER (PARTITION BY {c} ORDER BY stamp, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    whole = f"OVER (PARTITION BY {c})"
    skipped = [f"CASE WHEN fold <> {f} THEN target END" for f in range(5)]
    prior = [f"(SELECT avg(target) FROM folded WHERE fold <> {f})" for f in range(5)]

    def rate(over: str) -> str:
        return ", ".join(f"(coalesce(sum({t}) {over}, 0) + {p}) / (count({t}) {over} + 1)" for t, p in zip(skipped, prior))

    return f"""round(list_extract([{rate(w)}], (fold + 1) % 5 + 1), 8) AS {c}__next,
      round(list_extract([{rate(whole)}], fold + 1), 8) AS {c}__own"""


@query(
    "ordered_stats_folds",
    f"""WITH {PARTS}, folded AS (SELECT *, {fx.fold_sql('id', 'target')} AS fold FROM rows1)
        SELECT id, fold, {', '.join(map(_left_out, WIDE_CATS))} FROM folded""",
)
def ordered_stats_folds(spark, sf):
    """Fits of a cross-validation read their own fold's place; here the next fold and the row's own are shown."""
    rows = materialize(assign_folds(_line(spark, sf).select("id", "target", *WIDE_CATS), "id", 5, 42, "target"), "ordered_folds")
    out = ordered_rates(rows, fit_ordered(rows, WIDE_CATS, "target", "fold"), "target", "id", "fold")
    shown = {}
    for c in WIDE_CATS:
        shown[f"{c}__next"] = F.get(f"{c}__ots", F.pmod(F.col("fold") + 1, F.lit(5)))
        shown[f"{c}__own"] = F.get(f"{c}__ots", F.col("fold"))
    return rounded(out.select("id", "fold", *[x.alias(n) for n, x in shown.items()]), *shown, places=8)


@query(
    "ordered_stats_unseen",
    f"""WITH {PARTS.replace('base AS (SELECT avg(target) AS prior FROM rows1)', "tr AS (SELECT * FROM rows1 WHERE l_shipdate < TIMESTAMP '1999-01-01')")},
          base AS (SELECT avg(target) AS prior FROM tr), seen AS (SELECT part, sum(target) AS pos, count(*) AS n FROM tr GROUP BY part)
        SELECT id, round((coalesce(pos, 0) + prior) / (coalesce(n, 0) + 1), 8) AS part__ots
        FROM rows1 LEFT JOIN seen USING (part), base WHERE l_shipdate >= TIMESTAMP '1999-01-01'""",
)
def ordered_stats_unseen(spark, sf):
    """Rows that were not fitted read the totals of all fitted rows."""
    rows = _line(spark, sf)
    later = F.col("l_shipdate") >= F.lit(fx.SPLIT_DATE).cast("timestamp_ntz")
    enc = fit_ordered(rows.where(~later), ["part"], "target")
    out = apply_totals(rows.where(later).select("id", "part"), enc, "id")
    return rounded(out.select("id", F.col("part__ots")[0].alias("part__ots")), "part__ots", places=8)


@query(
    "one_hot_sparse",
    """WITH seen AS (SELECT o_orderkey, coalesce(CAST(o_custkey AS VARCHAR), '__NA__') AS v, o_orderdate < TIMESTAMP '1996-01-01' AS early FROM orders),
            coded AS (SELECT *, dense_rank() OVER (ORDER BY v) - 1 AS place FROM seen)
       SELECT o_orderkey, early, CAST(place AS INTEGER) AS place, (SELECT count(DISTINCT v) FROM seen) AS size FROM coded""",
)
def one_hot_sparse_query(spark, sf):
    """The one entry of each row's vector, over both splits of a column with far more levels than one-hot columns allow."""
    rows = fx.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).alias("early")
    )
    splits, size = one_hot_sparse([rows.where("early"), rows.where("not early")], "o_custkey", "v")
    shown = splits[0].unionByName(splits[1])
    return shown.select("o_orderkey", "early", unit_place("v").alias("place"), F.lit(size).cast("long").alias("size"))


@query(
    "fit_cat_wide",
    f"""WITH {PARTS}, folded AS (SELECT id, target, {fx.fold_sql('id', 'target', 2)} AS fold FROM rows1)
        SELECT id AS row_id, target AS y, true AS scored FROM folded""",
)
def fit_cat_wide(spark, sf):
    """The category-aware family with a text column of more levels than it can index; every row is scored out of fold."""
    rows = _line(spark, sf).select("id", "target", *WIDE_CATS, *fx.LINE_NUMERIC)
    cats = models.indexable(rows, WIDE_CATS, 100)
    cols = models.Columns("id", "target", fx.LINE_NUMERIC, cats, wide=tuple(c for c in WIDE_CATS if c not in cats))
    preds = models.oof_scores("cat", rows, cols, None, 2, (42,), {"iterations": 3, "depth": 3})
    return preds.select("row_id", "y", F.col("p").between(0.0, 1.0).alias("scored"))


@query(
    "best_blend_weights",
    f"""WITH {fx.WIDE}, {search_sql(THREE)}, best AS (SELECT * FROM found ORDER BY auc DESC, candidate LIMIT 1)
        SELECT candidate, CAST(w_m1 AS DOUBLE) AS w_m1, CAST(w_m2 AS DOUBLE) AS w_m2, CAST(w_m3 AS DOUBLE) AS w_m3,
        round(auc, 8) AS auc FROM best JOIN grid USING (candidate)""",
)
def best_blend_weights(spark, sf):
    """The winner of the whole grid, most of which histograms rule out."""
    preds = fx.predictions(spark, sf, THREE).where(F.col("split") == "oof")
    best, _ = ens.best_grid_point(ens.score_tuples(preds, THREE), THREE)
    return rounded(best, "auc", places=8)

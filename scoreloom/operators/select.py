"""Feature selection: correlation pruning, importance, strategy presets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.scalar import bin_index, null_to_zero
from scoreloom.operators.features import quantile_edges
from scoreloom.operators.ordering import exact_quantiles
from scoreloom.operators.profile import corr_pairs
from scoreloom.session import materialize

# Importance quantile, feature cap and correlation limit of each strategy.
STRATEGIES = {
    "conservative": {"importance_quantile": 0.3, "max_features": 60, "corr_above": 0.98},
    "moderate": {"importance_quantile": 0.2, "max_features": 50, "corr_above": 0.95},
    "aggressive": {"importance_quantile": 0.1, "max_features": 40, "corr_above": 0.90},
}


def correlated_columns(df: DataFrame, columns: Sequence[str], above: float = 0.95) -> DataFrame:
    """(column): features whose absolute correlation with any earlier one exceeds ``above``."""
    pairs = corr_pairs(df, columns)
    return pairs.where(F.col("corr") > above).select(F.col("b").alias("column")).distinct()


def mutual_information(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """(column, mi) in nats from quantile bins; missing values count as zero.

    Each row becomes one (column, bin, class) cell, combined map-side: at most
    columns x bins x classes rows are shuffled.
    """
    filled = materialize(df.select(target, *[null_to_zero(F.col(f"`{c}`")).alias(c) for c in columns]), "mi_input")
    edges = quantile_edges(filled, columns, bins)
    binned = filled.select(target, *[bin_index(F.col(f"`{c}`"), edges[c]).alias(c) for c in columns])
    cells = (
        binned.unpivot([target], list(columns), "column", "bin")
        .groupBy("column", "bin", F.col(target).alias("class"))
        .agg(F.count("*").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("column")).cast("double")
    by_bin = F.sum("n").over(Window.partitionBy("column", "bin")).cast("double")
    by_class = F.sum("n").over(Window.partitionBy("column", "class")).cast("double")
    n = F.col("n").cast("double")
    parts = cells.withColumn("part", n / total * F.ln(n * total / (by_bin * by_class)))
    return parts.groupBy("column").agg(F.sum("part").alias("mi"))


def average_importance(importances: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each importance divided by its maximum, then averaged into ``avg_importance``.

    The table has one row per feature.
    """
    everything = Window.partitionBy(F.lit(0))
    scaled = []
    for c in columns:
        top = F.max(c).over(everything)
        scaled.append(F.when(top > 0, F.col(c) / top).otherwise(F.col(c)))
    total = scaled[0]
    for s in scaled[1:]:
        total = total + s
    return importances.withColumn("avg_importance", total / len(columns))


def select_by_importance(
    importances: DataFrame, score: str, quantile: float = 0.2, max_features: int = 50
) -> DataFrame:
    """Features at or above the importance quantile, strongest first, at most ``max_features``."""
    cut = exact_quantiles(importances, [score], [quantile])[score][0]
    kept = importances.where(F.col(score) >= F.lit(cut))
    return kept.orderBy(F.desc(score), "column").limit(max_features)


def select_features(
    df: DataFrame, numeric: Sequence[str], cats: Sequence[str], importances: DataFrame, score: str = "avg_importance",
    strategy: str = "moderate",
) -> tuple[list[str], dict[str, object]]:
    """Correlation pruning, importance cut and cap; categoricals are always kept.

    Returns the kept names in table order and a report.
    """
    config = STRATEGIES.get(strategy, STRATEGIES["moderate"])
    dropped = {r["column"] for r in correlated_columns(df, numeric, config["corr_above"]).collect()}
    remaining = importances.where(~F.col("column").isin(list(dropped))) if dropped else importances
    best = select_by_importance(remaining, score, config["importance_quantile"], config["max_features"]).collect()
    chosen = {r["column"] for r in best}
    kept = [c for c in numeric if c in chosen] + [c for c in dict.fromkeys(cats)]
    report = {
        "original_features": len(numeric) + len(cats),
        "corr_removed": len(dropped),
        "final_features": len(kept),
        "selected_cats": len(cats),
        "top_10_features": [(r["column"], r[score]) for r in best[:10]],
    }
    return kept, report
